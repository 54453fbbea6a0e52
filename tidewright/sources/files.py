"""File sources and sinks: CSV exports with unknown encoding and header offset, reports, caches, optional and required inputs."""

from __future__ import annotations

import csv
import io
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Encodings tried in order.
ENCODINGS = ["utf-8-sig", "utf-8", "cp1252", "latin-1"]


def decode(raw: bytes) -> str:
    """The text in the first encoding that fits."""
    for encoding in ENCODINGS:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def read_exports(spark: SparkSession, folder: str, header_rows: dict[str, int] | None = None, skip: tuple[str, ...] = ("selection.csv",)) -> DataFrame:
    """(Source_File, Source_Row, cells) of every CSV file of a folder: ``cells`` maps header to text.

    Files are read whole by the executors, one file per task (exports are files that people send, not the corpus); the header
    stands in row ``header_rows[file]`` (from 0), repeated headers get a running suffix ``.1``; rows are numbered as in the file.
    An empty folder or a file without rows gives no rows.
    """
    offsets = dict(header_rows or {})

    def rows(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                name = os.path.basename(path)
                if name in skip:
                    continue
                lines = list(csv.reader(io.StringIO(decode(bytes(content)), newline="")))
                start = offsets.get(name, 0)
                if len(lines) <= start:
                    continue
                seen: dict[str, int] = {}
                header = []
                for h in lines[start]:
                    header.append(h if h not in seen else f"{h}.{seen[h]}")
                    seen[h] = seen.get(h, 0) + 1
                data = [x for x in lines[start + 1 :] if x]
                yield pd.DataFrame({
                    "Source_File": name, "Source_Row": [str(i + start + 2) for i in range(len(data))],
                    "cells": [dict(zip(header, [*x, *[""] * (len(header) - len(x))], strict=False)) for x in data],
                })

    schema = T.StructType([T.StructField("Source_File", T.StringType()), T.StructField("Source_Row", T.StringType()), T.StructField("cells", T.MapType(T.StringType(), T.StringType()))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", "content")
    return files.mapInPandas(rows, schema)


def map_exports(exports: DataFrame, mappings: dict[str, dict[str, str]], targets: list[str]) -> DataFrame:
    """Exports in the target columns: each file by its mapping (target to header, or a constant), blank where there is none.
    Mappings are a small literal of the plan; files without one are left out."""
    table = F.create_map(*[F.lit(x) for f, m in mappings.items() for t, h in m.items() for x in (f"{f}\x1f{t}", h)])
    known = exports.where(F.col("Source_File").isin(list(mappings)))

    def one(target: str):  # noqa: ANN202
        header = table[F.concat(F.col("Source_File"), F.lit(f"\x1f{target}"))]
        constant = F.when(header.startswith("__CONSTANT__:"), F.substr(header, F.lit(14)))
        return F.coalesce(constant, F.regexp_replace(F.try_element_at("cells", header), r"(?U)^\s+|\s+$", ""), F.lit("")).alias(target)

    return known.select("Source_File", "Source_Row", *[one(t) for t in targets if t not in ("Source_File", "Source_Row")])


def import_report(exports: DataFrame, mappings: dict[str, dict[str, str]]) -> DataFrame:
    """(Source_File, n_rows, state): OK or NO MAPPING."""
    state = F.when(F.col("Source_File").isin(list(mappings)), "OK").otherwise("NO MAPPING")
    return exports.groupBy("Source_File").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("state", state)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of our own: strings only, quotes doubled, line breaks within quotes, blanks as ""."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    return df.select(*[F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV files with quotes doubled and blanks for null; with ``bom`` the first header starts with a byte order mark."""
    out = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    if bom and out.columns:
        out = out.withColumnRenamed(out.columns[0], "﻿" + out.columns[0])
    out.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The parquet table at ``path``, or an empty one of this schema."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def first_existing(spark: SparkSession, *paths: str) -> DataFrame:
    """The first parquet table that is there; an error if none is."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(", ".join(paths))


def write_lines(df: DataFrame, path: str, *columns: str) -> None:
    """A text report, one line per row."""
    df.select(F.concat_ws("  ", *columns).alias("value")).write.mode("overwrite").text(path)
