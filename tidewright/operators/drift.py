"""Schemas that drift between the loads of a file: report every change and read all loads into one table.

Each (file, load) has a schema version: its set of headers with the modal JSON type of each, condensed into a fingerprint.
Versions that follow each other are compared and the differences become explicit migration steps: ``rename`` (the old
header is gone and a new one holds the same values on the rows both loads share), ``default`` (removed: the field is null
from then on; added: it was null before) and ``cast`` (the type of most cells changed). A cell of any load reaches its
newest header by the chain of its file's renames, folded in order of load; values stay texts, so defaults are nulls and casts
are reported only.

Work is keyed by (file, load, row), so a file that holds a third of all rows is spread over all tasks; per file only
schema steps are gathered, whose number does not grow with the rows.

Payloads that are no JSON object give no cells and are counted by ``unreadable``. Null and empty cells count for the
presence of a header, not for its type or its values. An empty table gives no changes. Rows that repeat within a load
count once for the comparison of values (the largest record_id) and each time for the modal type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.session import checkpointed

#: Share of the shared rows' values that must agree for a rename.
RENAME_AGREEMENT = 0.8


def json_kind(variant: Column) -> Column:
    """text, number, boolean, list, object, or null for JSON null, empty text, empty list and empty object."""
    schema = F.schema_of_variant(variant)
    text = variant.cast("string")
    return (
        F.when(schema == "VOID", F.lit(None))
        .when(schema == "STRING", F.when(text.rlike(r"(?U)\S"), F.lit("text")))
        .when(schema == "BOOLEAN", F.lit("boolean"))
        .when(schema.startswith("ARRAY"), F.when(text != "[]", F.lit("list")))
        .when(schema.startswith("OBJECT"), F.when(text != "{}", F.lit("object")))
        .otherwise(F.lit("number"))
    )


def cells(records: DataFrame) -> DataFrame:
    """(record_id, source_file, load_no, source_row, field, kind, value): one row per header and record."""
    parsed = records.select(
        "record_id", F.col("Source_File").alias("source_file"), "load_no", F.col("Source_Row").alias("source_row"), F.try_parse_json("payload").alias("_p")
    ).where(F.schema_of_variant("_p").startswith("OBJECT"))
    out = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_p").outer()))
    return out.select(
        "record_id", "source_file", "load_no", "source_row", F.col("key").alias("field"), json_kind(F.col("value")).alias("kind"), F.col("value").cast("string").alias("value")
    )


def unreadable(records: DataFrame) -> DataFrame:
    """Rows per (source_file, load_no) whose payload is no JSON object."""
    bad = ~F.coalesce(F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT"), F.lit(False))
    return records.groupBy(F.col("Source_File").alias("source_file"), "load_no").agg(F.count_if(bad).alias("n_unreadable"))


def versions(cell: DataFrame) -> DataFrame:
    """(source_file, load_no, prev_load, next_load, field, kind): headers of each load with their modal type (null if all
    cells are empty; of equally frequent types the first by name). Counts are combined before the shuffle."""
    counts = cell.groupBy("source_file", "load_no", "field", "kind").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("kind", F.struct(F.col("kind").isNotNull(), "n", _reverse(F.col("kind"))))
    fields = counts.groupBy("source_file", "load_no", "field").agg(best.alias("kind"))
    per_file = Window.partitionBy("source_file").orderBy("load_no")
    loads = fields.select("source_file", "load_no").distinct()
    loads = loads.withColumn("prev_load", F.lag("load_no").over(per_file)).withColumn("next_load", F.lead("load_no").over(per_file))
    return fields.join(loads, ["source_file", "load_no"])


def _reverse(kind: Column) -> Column:
    """Orders the five kinds against their names, so that max_by takes the first by name among equals."""
    return -F.coalesce(F.ascii(kind) * 256 + F.ascii(F.substring(kind, 2, 1)), F.lit(0))


def fingerprints(version: DataFrame) -> DataFrame:
    """(source_file, load_no, n_fields, fingerprint): sha-256 of the sorted header and type list of each load."""
    entry = F.concat_ws("\x1f", "field", F.coalesce("kind", F.lit("")))
    listed = F.array_join(F.array_sort(F.collect_list(entry)), "\x1e")
    return version.groupBy("source_file", "load_no").agg(F.count(F.lit(1)).cast("bigint").alias("n_fields"), F.sha2(listed, 256).alias("fingerprint"))


def changes(cell: DataFrame) -> DataFrame:
    """(source_file, load_no, change_kind, old_field, new_field) against the same file's load before."""
    v = checkpointed(versions(cell))
    old = v.where(F.col("next_load").isNotNull()).select("source_file", F.col("next_load").alias("load_no"), "field", F.col("kind").alias("old_kind"), F.lit(True).alias("was"))
    new = v.where(F.col("prev_load").isNotNull()).select("source_file", "load_no", "field", "kind", F.lit(True).alias("is"))
    both = checkpointed(old.join(new, ["source_file", "load_no", "field"], "full"))
    typed = both.where("was and is and old_kind <> kind").select("source_file", "load_no", F.lit("type_changed").alias("change_kind"), F.col("field").alias("old_field"), F.col("field").alias("new_field"))
    gone = both.where("is is null").select("source_file", "load_no", "field")
    come = both.where("was is null").select("source_file", "load_no", "field")
    renamed = checkpointed(renames(cell, v, gone, come))
    left = gone.join(renamed.select("source_file", "load_no", F.col("old_field").alias("field")), ["source_file", "load_no", "field"], "left_anti")
    right = come.join(renamed.select("source_file", "load_no", F.col("new_field").alias("field")), ["source_file", "load_no", "field"], "left_anti")
    return (
        typed.unionByName(renamed.select("source_file", "load_no", F.lit("renamed").alias("change_kind"), "old_field", "new_field"))
        .unionByName(left.select("source_file", "load_no", F.lit("removed").alias("change_kind"), F.col("field").alias("old_field"), F.lit("").alias("new_field")))
        .unionByName(right.select("source_file", "load_no", F.lit("added").alias("change_kind"), F.lit("").alias("old_field"), F.col("field").alias("new_field")))
    )


def renames(cell: DataFrame, v: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """(source_file, load_no, old_field, new_field): pairs of a header gone and a header come whose values agree on at
    least ``RENAME_AGREEMENT`` of the shared rows; one partner each, the best agreement and then the likest name first.

    Values meet by equality on (file, load, row, value), never as pairs of all headers over all rows.
    """
    key = ["source_file", "load_no", "source_row"]
    filled = cell.where("kind is not null").groupBy(*key, "field").agg(F.max_by("value", "record_id").alias("value"))
    following = v.select("source_file", F.col("load_no").alias("at"), "next_load").distinct()
    rows = cell.select(*key).distinct()
    before = (
        filled.withColumnRenamed("load_no", "at").join(following, ["source_file", "at"]).where("next_load is not null").drop("at").withColumnRenamed("next_load", "load_no")
        .join(gone, ["source_file", "load_no", "field"]).join(rows, key, "left_semi")
    )
    rows_before = rows.withColumnRenamed("load_no", "at").join(following, ["source_file", "at"]).where("next_load is not null").select("source_file", F.col("next_load").alias("load_no"), "source_row")
    after = filled.join(come, ["source_file", "load_no", "field"]).join(rows_before, key, "left_semi")
    n_old = before.groupBy("source_file", "load_no", F.col("field").alias("old_field")).agg(F.count(F.lit(1)).alias("n_old"))
    n_new = after.groupBy("source_file", "load_no", F.col("field").alias("new_field")).agg(F.count(F.lit(1)).alias("n_new"))
    same = before.withColumnRenamed("field", "old_field").join(after.withColumnRenamed("field", "new_field"), [*key, "value"])
    agreed = same.groupBy("source_file", "load_no", "old_field", "new_field").agg(F.count(F.lit(1)).alias("n_same"))
    pairs = agreed.join(n_old, ["source_file", "load_no", "old_field"]).join(n_new, ["source_file", "load_no", "new_field"])
    pairs = pairs.withColumn("share", F.col("n_same") / F.greatest("n_old", "n_new")).where(F.col("share") >= RENAME_AGREEMENT)
    distance = F.levenshtein(F.lower("old_field"), F.lower("new_field"))
    order = [F.col("share").desc(), F.col("n_same").desc(), distance, F.col("old_field"), F.col("new_field")]
    first = F.row_number().over(Window.partitionBy("source_file", "load_no", "old_field").orderBy(*order))
    second = F.row_number().over(Window.partitionBy("source_file", "load_no", "new_field").orderBy(*order))
    return pairs.withColumn("_a", first).withColumn("_b", second).where("_a = 1 and _b = 1").select("source_file", "load_no", "old_field", "new_field")


def migration_steps(change: DataFrame) -> DataFrame:
    """(source_file, load_no, step, old_field, new_field): the changes as rules rename, default and cast."""
    step = F.when(F.col("change_kind") == "renamed", "rename").when(F.col("change_kind") == "type_changed", "cast").otherwise("default")
    return change.select("source_file", "load_no", step.alias("step"), "old_field", "new_field")


def newest_names(version: DataFrame, change: DataFrame) -> DataFrame:
    """(source_file, load_no, field, newest): the name of each header after all later renames of its file, in order."""
    rename = F.struct("load_no", "old_field", "new_field")
    chains = change.where("change_kind = 'renamed'").groupBy("source_file").agg(F.array_sort(F.collect_list(rename)).alias("chain"))
    follow = F.aggregate(
        F.filter(F.coalesce("chain", F.array().cast("array<struct<load_no:int,old_field:string,new_field:string>>")), lambda s: s["load_no"] > F.col("load_no")),
        F.struct(F.lit(-1).alias("at"), F.col("field").alias("name")),
        lambda acc, s: F.when((s["old_field"] == acc["name"]) & (s["load_no"] > acc["at"]), F.struct(s["load_no"].alias("at"), s["new_field"].alias("name"))).otherwise(acc),
        lambda acc: acc["name"],
    )
    return version.join(chains, "source_file", "left").select("source_file", "load_no", "field", follow.alias("newest"))


def staging_columns(cell: DataFrame, names: DataFrame, staging: DataFrame, columns: list[str], agreement: float = 0.5) -> DataFrame:
    """(source_file, newest, column_name): the staging column each migrated header feeds, voted by equal values on equal
    (Source_File, Source_Row): the column that agrees on most cells, if on ``agreement`` of them or more."""
    migrated = cell.where("kind is not null").join(names, ["source_file", "load_no", "field"]).select("source_file", "source_row", "newest", "value").distinct()
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]))
    known = staging.select(F.col("Source_File").alias("source_file"), F.col("Source_Row").alias("source_row"), stack.alias("x")).select("source_file", "source_row", "x.*")
    known = known.where(F.col("value").rlike(r"(?U)\S")).distinct()
    votes = migrated.join(known, ["source_file", "source_row", "value"]).groupBy("source_file", "newest", "column_name").agg(F.count(F.lit(1)).alias("n"))
    total = migrated.groupBy("source_file", "newest").agg(F.count(F.lit(1)).alias("n_all"))
    best = Window.partitionBy("source_file", "newest").orderBy(F.col("n").desc(), "column_name")
    ranked = votes.join(total, ["source_file", "newest"]).where(F.col("n") >= agreement * F.col("n_all")).withColumn("_r", F.row_number().over(best))
    return ranked.where("_r = 1").select("source_file", "newest", "column_name")


def consolidate(records: DataFrame, staging: DataFrame, columns: list[str]) -> DataFrame:
    """Every record in the staging columns, whatever its file called them: (record_id, source_file, load_no, source_row,
    extra, the columns). ``extra`` is a JSON object of the migrated fields that feed no staging column."""
    cell = checkpointed(cells(records))
    names = newest_names(versions(cell), changes(cell))
    target = staging_columns(cell, names, staging, columns)
    placed = cell.join(names, ["source_file", "load_no", "field"]).join(target, ["source_file", "newest"], "left")
    one = [F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in columns]
    entry = F.when(F.col("column_name").isNull() & F.col("value").isNotNull(), F.struct(F.col("newest").alias("k"), F.col("value").alias("v")))
    extra = F.to_json(F.map_from_entries(F.array_sort(F.collect_set(entry))))
    rows = placed.groupBy("record_id", "source_file", "load_no", "source_row").agg(extra.alias("extra"), *one)
    rest = records.select("record_id", F.col("Source_File").alias("source_file"), "load_no", F.col("Source_Row").alias("source_row"))
    return rest.join(rows.drop("source_file", "load_no", "source_row"), "record_id", "left")
