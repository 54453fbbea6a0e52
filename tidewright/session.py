"""Session helpers: table access, checkpoint folder, size-checked broadcast."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast; beyond either the join shuffles.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``. Without that setting a folder is made only where driver and executors are one
    process (``local`` masters: tests, the bench); on a cluster, whose machines could not read it, that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = context.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidewright-")
    context.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: the data are computed once and survive a lost executor.

    Files go when the frame is no longer referenced if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on; else with
    the folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows of ``size`` bytes in all, else unchanged (the join then
    shuffles). Looks at ``limit + 1`` rows at most; pass a frame that is cheap to evaluate, such as a checkpointed one.
    """
    widths = [F.octet_length(F.col(f"`{c}`")) if t in ("string", "binary") else F.octet_length(F.to_json(F.struct(f"`{c}`"))) if "<" in t else F.lit(8) for c, t in df.dtypes]
    long = F.coalesce(F.sum(sum((F.coalesce(w, F.lit(0)) for w in widths), F.lit(0))), F.lit(0))
    rows, bytes_ = df.limit(limit + 1).agg(F.count(F.lit(1)), long).first()
    return F.broadcast(df) if rows <= limit and bytes_ <= size else df
