"""Organisations and contacts as two linked tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import values as v
from tidewright.functions.text import strip
from tidewright.functions.urls import organisation_key
from tidewright.operators.numbering import group_numbers, ordered_distinct
from tidewright.session import checkpointed


def best_values(df: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """(key, columns): the longest value of each column, of equally long ones the most frequent, then the first seen.

    Values are counted per key before they are compared, so a hot key is reduced to its distinct values first.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), strip(c).alias("value")) for c in columns]))
    counted = df.select(key, order, cells.alias("c")).where("c.value <> ''").groupBy(key, "c.column", "c.value").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    rank = F.struct(F.length("value").alias("l"), "n", (-F.col("first")).alias("f"))
    best = counted.groupBy(key, "column").agg(F.max_by("value", rank).alias("value"))
    return best.groupBy(key).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


def with_key(contacts: DataFrame) -> DataFrame:
    return contacts.withColumn("Organisation_Key", organisation_key())


def organisations(contacts: DataFrame, order: str = "ID") -> DataFrame:
    """One row per organisation key, numbered by first appearance: best values, ids of its contacts, their number."""
    keyed = checkpointed(with_key(contacts).where("Organisation_Key is not null"))
    columns = [c for c in v.ORGANISATION_COLUMNS if c in contacts.columns]
    counts = keyed.groupBy("Organisation_Key").agg(F.count(F.lit(1)).alias("Contact_Count"))
    related = ordered_distinct(keyed, ["Organisation_Key"], F.array(F.col(order).cast("string")), order, "Related_Contact_IDs")
    out = group_numbers(keyed, "Organisation_Key", order, "Organisation_ID").join(counts, "Organisation_Key").join(related, "Organisation_Key", "left")
    out = out.join(best_values(keyed, "Organisation_Key", columns, order), "Organisation_Key", "left")
    return out.select("Organisation_ID", "Organisation_Key", *columns, "Related_Contact_IDs", "Contact_Count")


def contacts_split(contacts: DataFrame, orgs: DataFrame) -> DataFrame:
    """Contact columns and further ones with the number of the organisation, null without a key. The key of a shared host can
    hold many rows; the join is a plain equi-join that the engine splits or turns into a broadcast by its statistics."""
    keys = orgs.select("Organisation_Key", "Organisation_ID")
    kept = [c for c in contacts.columns if c not in v.ORGANISATION_COLUMNS]
    return with_key(contacts).join(keys, "Organisation_Key", "left").select("ID", "Organisation_ID", *[c for c in kept if c != "ID"])
