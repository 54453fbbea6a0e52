"""Spellings one edit apart: deletion neighbourhoods meet by equality, so close keys are found without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.session import checkpointed


def deletions(key: Column) -> Column:
    """The key and every key with one character less. Two keys one edit apart (replace, insert, delete, swap neighbours) share one."""
    shorter = F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.concat(F.substr(key, F.lit(1), i - 1), F.substr(key, i + 1)))
    return F.when(F.length(key) > 0, F.array_distinct(F.concat(F.array(key), shorter)))


def swapped(a: Column, b: Column) -> Column:
    """``b`` is ``a`` with two neighbouring characters swapped."""
    swaps = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: F.concat(F.substr(a, F.lit(1), i - 1), F.substr(a, i + 1, F.lit(1)), F.substr(a, i, F.lit(1)), F.substr(a, i + 2)),
    )
    return (F.length(a) == F.length(b)) & F.array_contains(swaps, b)


def one_edit(a: Column, b: Column) -> Column:
    return (F.levenshtein(a, b, 1) >= 0) | swapped(a, b)


def followed(step: DataFrame) -> DataFrame:
    """(node, target) with every chain of targets followed to its end. Each step leads upward in one order, so none is a cycle."""
    at = checkpointed(step)
    while True:
        onward = at.select(F.col("node").alias("target"), F.col("target").alias("onward"))
        at = checkpointed(at.join(onward, "target", "left").select("node", F.coalesce("onward", "target").alias("target"), F.col("onward").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def standard_spellings(counts: DataFrame, scope: list[str], key: str, n: str = "n", ratio: int = 2, shortest: int = 5) -> DataFrame:
    """(scope, key, standard): each key with the most frequent key one edit away that is ``ratio`` times as frequent, else
    itself; followed to the end. ``counts`` has one row per scope and key, so hot keys are already one row.

    Keys shorter than ``shortest`` keep themselves; nulls are left out; ties go to the first in order of the text.
    """
    base = counts.where(F.col(key).isNotNull()).select(*scope, F.col(key).alias("_k"), F.col(n).alias("_n"))
    near = base.where(F.length("_k") >= shortest).withColumn("_v", F.explode(deletions(F.col("_k"))))
    other = near.select(*scope, F.col("_k").alias("_k2"), F.col("_n").alias("_n2"), "_v")
    pairs = near.join(other, [*scope, "_v"]).where(
        (F.col("_n2") >= F.col("_n") * ratio) & ((F.col("_n2") > F.col("_n")) | (F.col("_k2") < F.col("_k"))) & (F.col("_k") != F.col("_k2")) & one_edit(F.col("_k"), F.col("_k2"))
    )
    node = lambda c: F.concat_ws("\x1f", *scope, c)
    best = pairs.groupBy(*scope, "_k").agg(F.min(F.struct((-F.col("_n2")).alias("a"), F.col("_k2").alias("b")))["b"].alias("_b")).select(node("_k").alias("node"), node("_b").alias("target"))
    ends = followed(best).select(F.col("node").alias("_node"), F.element_at(F.split("target", "\x1f"), -1).alias("_s"))
    return base.join(ends, node("_k") == F.col("_node"), "left").select(*scope, F.col("_k").alias(key), F.coalesce("_s", "_k").alias("standard"))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")
