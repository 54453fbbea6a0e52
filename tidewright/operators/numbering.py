"""Consecutive numbers over a distributed sort, and duplicate flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.session import checkpointed


def sequential_ids(df: DataFrame, order: list[Column | str], name: str = "ID") -> DataFrame:
    """``df`` with numbers 1..n in the order given. The sort is range-partitioned and each partition counts for itself; only
    one row per partition (its size) is gathered, so no task ever holds the whole table. Ties must be broken by ``order``."""
    placed = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    sizes = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))  # one row per partition
    numbered = placed.withColumn("_part", F.shiftright("_at", 33)).join(offsets, "_part")
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return numbered.withColumn(name, number.cast("bigint")).drop("_part", "_at", "_before")


def group_numbers(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """(key, name): distinct keys numbered by the first row they appear in; null keys are left out."""
    firsts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"))
    return sequential_ids(firsts, ["_first", key], name).select(key, name)


def flag_repeated(df: DataFrame, key: Column, name: str) -> DataFrame:
    """``df`` with a flag for rows whose non-blank key occurs more than once. Counts are combined before the shuffle; a hot
    key is one row of the small side, and its rows stay where they are or are split by the engine. Rows without a key pass
    beside the join."""
    keyed = df.withColumn("_k", F.nullif(key, F.lit("")))
    some = keyed.where("_k is not null")
    twice = some.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k", F.lit(True).alias(name))
    flagged = some.join(twice, "_k", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return flagged.unionByName(keyed.where("_k is null").withColumn(name, F.lit(False))).drop("_k")


def ordered_distinct(df: DataFrame, keys: list[str], items: Column, order: str, name: str) -> DataFrame:
    """(keys, name): the items of all rows of a key in order of first appearance, equal but for case once, joined by `` | ``.
    Items are reduced to distinct ones before they are gathered."""
    rows = df.select(*keys, F.col(order).alias("_o"), F.posexplode(items).alias("_p", "_v")).where(F.col("_v").isNotNull() & (F.col("_v") != ""))
    once = rows.groupBy(*keys, F.lower("_v").alias("_l")).agg(F.min(F.struct("_o", "_p", "_v")).alias("_f"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("_f")), lambda x: x["_v"]), " | ")
    return once.groupBy(*keys).agg(listed.alias(name))
