"""Incremental runs: new page files arrive as a stream, each micro-batch passes the batch transforms and is upserted by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators import pages as pg


def upsert_parquet(new: DataFrame, path: str, epoch: int) -> None:
    """Write the batch under its own epoch; readers take the latest epoch of each key. A repeated epoch overwrites itself, so a
    restarted batch leaves one copy."""
    new.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest record of each key of an upserted table."""
    df = spark.read.parquet(path).drop("epoch")
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), "_epoch").alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest if c != "_epoch"])


def page_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = pg.page_names) -> StreamingQuery:
    """Stream of page files (site, url, page_type, page_ord, html): parse, transform, upsert; stops when all is read."""
    source = spark.readStream.schema("site string, url string, page_type string, page_ord int, html string").parquet(folder)

    def batch(df: DataFrame, epoch: int) -> None:
        upsert_parquet(transform(pg.parsed_pages(df)), out, epoch)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_counts(events: DataFrame, time: str, keys: list[str], width: str = "1 day", delay: str = "7 days") -> DataFrame:
    """Windowed counts of a stream with a watermark for rows that arrive late."""
    return events.withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))
