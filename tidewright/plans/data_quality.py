"""Queries of the general training-data operators (problems 1, 6 and 7) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import NO_VALUE_WORDS
from tidewright.operators import drift, packed
from tidewright.operators import profile as prof
from tidewright.session import checkpointed, table

# The 28 data columns of the staging table.
STAGING_COLUMNS = [
    "Organisation_Name", "Contact_Name", "Email", "Email_Alternatives", "Phone", "Phone_Alternatives", "Website", "Website_Alternatives",
    "LinkedIn", "Social_Media", "Role", "Organisation_Type", "Sector", "Location", "Address", "Description", "Status", "Notes", "Tags",
    "Responsible_Person", "Project_or_Event", "Last_Contact_Date", "Email_Count", "Direction", "Relationship_Strength",
    "Last_Subject_Line", "Source_Document", "Original_Contact_Info",
]


def p1_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile of Email, Website and Contact_Name by load."""
    p = prof.profile(table(spark, d, "staging_all_rows"), "load_no", prof.CONTACT_FORMS)
    return p.select(
        "load_no", "column_name", "n_rows", "n_null", "n_missing", "n_pattern", "n_distinct", "n_top", "min_value", "max_value", "min_len", "max_len",
        *[F.col(f"sum_len_{k}").cast("string").alias(f"sum_len_{k}") for k in range(1, 5)],
    )


def p1_shift_scores(spark: SparkSession, d: str) -> DataFrame:
    """Standardised difference of the text length of each column against the load before."""
    p = prof.against_previous(prof.profile(table(spark, d, "staging_all_rows"), "load_no", prof.CONTACT_FORMS), "load_no")
    return p.select("load_no", "column_name", F.round("mean_len", 6).alias("mean_len"), F.round("std_len", 6).alias("std_len"), F.round("smd_len", 6).alias("smd_len"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells that break their column's form and loads whose quality jumps."""
    rows = table(spark, d, "staging_all_rows")
    cells = prof.violations(rows, "row_id", prof.CONTACT_FORMS).select(F.lit("pattern").alias("finding"), "column_name", F.col("row_id").cast("bigint").alias("key_no"))
    jumps = prof.shifts(prof.profile(rows, "load_no", prof.CONTACT_FORMS), "load_no")
    return cells.unionByName(jumps.select(F.lit("shift").alias("finding"), "column_name", F.col("load_no").cast("bigint").alias("key_no")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Changes of headers and types of each file from load to load."""
    return drift.changes(checkpointed(drift.cells(table(spark, d, "raw_records"))))


def p6_versions(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprint of the schema of each file and load."""
    return drift.fingerprints(drift.versions(drift.cells(table(spark, d, "raw_records"))))


def p6_consolidated(spark: SparkSession, d: str) -> DataFrame:
    """All records in the staging columns."""
    return drift.consolidate(table(spark, d, "raw_records"), table(spark, d, "staging_all_rows"), STAGING_COLUMNS)


def _packed_cells(spark: SparkSession, d: str) -> DataFrame:
    contacts = packed.cells_of(table(spark, d, "contacts_raw"), "contacts_raw", "ID", ["Email_Alternatives", "Website_Alternatives", "Phone_Alternatives"])
    return contacts.unionByName(packed.cells_of(table(spark, d, "staging_all_rows"), "staging_all_rows", "row_id", ["Original_Contact_Info"]))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Every value of each cell that holds two or more."""
    return packed.several(_packed_cells(spark, d))


def p7_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value of each cell that is not blank, cells with one value included."""
    return packed.split_packed(_packed_cells(spark, d))


QUERIES = {
    "p1_found": p1_found, "p1_profile": p1_profile, "p1_shift_scores": p1_shift_scores,
    "p6_found": p6_found, "p6_versions": p6_versions, "p6_consolidated": p6_consolidated,
    "p7_found": p7_found, "p7_values": p7_values,
}

_WORDS = ", ".join(f"'{w}'" for w in NO_VALUE_WORDS)
_TRIM = r"regexp_replace(value, '^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$', '', 'g')"
_LABELS = r"([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}"
_WEB = r"(?i)https?:|www\.|[a-z0-9-]\.(example|test|invalid|com|net|org|info|de|at|ch|eu|fr|io|uk)([^\p{L}\p{N}]|$)"
_CELLS = rf"""
WITH stacked AS (
  SELECT row_id, load_no, 'Email' AS column_name, Email AS value FROM staging_all_rows
  UNION ALL SELECT row_id, load_no, 'Website', Website FROM staging_all_rows
  UNION ALL SELECT row_id, load_no, 'Contact_Name', Contact_Name FROM staging_all_rows),
marked AS (
  SELECT *, coalesce(NOT regexp_matches(value, '[\p{{L}}\p{{N}}]')
      OR (length(value) < 40 AND lower(regexp_replace(value, '[^\p{{L}}\p{{N}}]', '', 'g')) IN ({_WORDS})), true) AS absent,
    CASE column_name
      WHEN 'Email' THEN regexp_full_match({_TRIM}, '[A-Za-z0-9_%+-]+(\.[A-Za-z0-9_%+-]+)*@{_LABELS}')
      WHEN 'Website' THEN regexp_full_match({_TRIM}, '([Hh][Tt][Tt][Pp][Ss]?://)?{_LABELS}(:[0-9]+)?([/?][^\s\p{{Z}}|;,]*)?')
      ELSE length({_TRIM}) >= 2 AND regexp_matches(value, '\p{{L}}')
        AND NOT regexp_matches({_TRIM}, '[\p{{Nd}}@\r\n\v\f\x{{85}}\x{{2028}}\x{{2029}}]') AND NOT regexp_matches({_TRIM}, '{_WEB}') END AS ok
  FROM stacked),
counted AS (
  SELECT load_no, column_name, value, absent, (NOT absent AND NOT ok) AS broken, count(*) AS n FROM marked GROUP BY ALL),
profiled AS (
  SELECT load_no, column_name, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS n_null,
    coalesce(sum(n) FILTER (absent), 0)::BIGINT AS n_missing, coalesce(sum(n) FILTER (broken), 0)::BIGINT AS n_pattern,
    count(*) FILTER (NOT absent) AS n_distinct, coalesce(max(n) FILTER (NOT absent), 0)::BIGINT AS n_top,
    min(value) FILTER (NOT absent) AS min_value, max(value) FILTER (NOT absent) AS max_value,
    min(length(value)) FILTER (NOT absent)::INT AS min_len, max(length(value)) FILTER (NOT absent)::INT AS max_len,
    {", ".join(f"coalesce(sum(n * length(value)::HUGEINT ** {k}) FILTER (NOT absent), 0)::HUGEINT AS sum_len_{k}" for k in range(1, 5))}
  FROM counted GROUP BY ALL)"""
_SHIFT_TERM = "abs({a} * {n0} - {b} * {n1}) * 5 >= {n1} * {n0}"

ORACLE = {
    "p1_profile": _CELLS + " SELECT * REPLACE (" + ", ".join(f"sum_len_{k}::VARCHAR AS sum_len_{k}" for k in range(1, 5)) + ") FROM profiled",
    "p1_found": _CELLS + """,
base AS (SELECT *, greatest(n_rows - n_missing, 1) AS n_present FROM profiled)
SELECT 'pattern' AS finding, column_name, row_id::BIGINT AS key_no FROM marked WHERE NOT absent AND NOT ok
UNION ALL
SELECT 'shift', a.column_name, a.load_no::BIGINT FROM base a JOIN base b ON b.column_name = a.column_name AND b.load_no = a.load_no - 1
WHERE """ + " OR ".join([
        _SHIFT_TERM.format(a="a.n_missing", b="b.n_missing", n1="a.n_rows", n0="b.n_rows"),
        _SHIFT_TERM.format(a="a.n_pattern", b="b.n_pattern", n1="a.n_rows", n0="b.n_rows"),
        _SHIFT_TERM.format(a="a.n_top", b="b.n_top", n1="a.n_present", n0="b.n_present"),
    ]),
    "p1_shift_scores": _CELLS + """,
m AS (SELECT load_no, column_name, n_rows - n_missing AS n, CASE WHEN n_rows > n_missing THEN sum_len_1::DOUBLE / (n_rows - n_missing) END AS mean, sum_len_2::DOUBLE AS s2 FROM profiled),
s AS (SELECT load_no, column_name, mean, CASE WHEN n > 0 THEN sqrt(greatest(s2 / n - mean * mean, 0)) END AS std FROM m)
SELECT a.load_no, a.column_name, round(a.mean, 6) AS mean_len, round(a.std, 6) AS std_len,
    CASE WHEN a.std * a.std + b.std * b.std > 0 THEN round(abs(a.mean - b.mean) / sqrt((a.std * a.std + b.std * b.std) / 2), 6) END AS smd_len
FROM s a LEFT JOIN s b ON b.column_name = a.column_name AND b.load_no = a.load_no - 1""",
    "p6_found": """
WITH c AS (SELECT record_id, Source_File AS f, load_no AS l, Source_Row AS r, e.key AS k, e.type AS t, e.value AS v, e.value ->> '$' AS x
    FROM raw_records, json_each(payload) e WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
q AS (SELECT *, CASE WHEN t = 'NULL' THEN NULL WHEN t = 'VARCHAR' THEN CASE WHEN regexp_matches(x, '[^\\s\\p{Z}]') THEN 'text' END WHEN t = 'BOOLEAN' THEN 'boolean'
    WHEN t = 'ARRAY' THEN CASE WHEN json_array_length(v) > 0 THEN 'list' END WHEN t = 'OBJECT' THEN CASE WHEN v::VARCHAR <> '{}' THEN 'object' END ELSE 'number' END AS kind FROM c),
n AS (SELECT f, l, k, kind, count(*) AS n FROM q GROUP BY ALL),
ver AS (SELECT f, l, k, kind FROM n QUALIFY row_number() OVER (PARTITION BY f, l, k ORDER BY kind IS NULL, n DESC, kind) = 1),
loads AS (SELECT f, l, lag(l) OVER (PARTITION BY f ORDER BY l) AS p FROM (SELECT DISTINCT f, l FROM ver)),
new AS (SELECT v.*, p FROM ver v JOIN loads USING (f, l) WHERE p IS NOT NULL),
old AS (SELECT v.f, loads.l, v.k, v.kind FROM ver v JOIN loads ON loads.f = v.f AND loads.p = v.l),
come AS (SELECT f, l, p, k FROM new WHERE NOT EXISTS (FROM old o WHERE o.f = new.f AND o.l = new.l AND o.k = new.k)),
gone AS (SELECT o.f, o.l, loads.p, k FROM old o JOIN loads USING (f, l) WHERE NOT EXISTS (FROM new w WHERE w.f = o.f AND w.l = o.l AND w.k = o.k)),
cell AS (SELECT f, l, r, k, arg_max(x, record_id) AS x FROM q WHERE kind IS NOT NULL GROUP BY ALL),
rws AS (SELECT DISTINCT f, l, r FROM q),
a AS (SELECT g.f, g.l, g.k, c.r, c.x FROM gone g JOIN cell c ON c.f = g.f AND c.l = g.p AND c.k = g.k JOIN rws s ON s.f = g.f AND s.l = g.l AND s.r = c.r),
b AS (SELECT g.f, g.l, g.k, c.r, c.x FROM come g JOIN cell c ON c.f = g.f AND c.l = g.l AND c.k = g.k JOIN rws s ON s.f = g.f AND s.l = g.p AND s.r = c.r),
na AS (SELECT f, l, k, count(*) AS n FROM a GROUP BY ALL), nb AS (SELECT f, l, k, count(*) AS n FROM b GROUP BY ALL),
same AS (SELECT a.f, a.l, a.k AS o, b.k AS w, count(*) AS n FROM a JOIN b USING (f, l, r, x) GROUP BY ALL),
ranked AS (SELECT same.*, same.n / greatest(na.n, nb.n) AS share FROM same JOIN na ON na.f = same.f AND na.l = same.l AND na.k = o JOIN nb ON nb.f = same.f AND nb.l = same.l AND nb.k = w WHERE same.n / greatest(na.n, nb.n) >= 0.8),
ren AS (SELECT f, l, o, w FROM ranked QUALIFY row_number() OVER (PARTITION BY f, l, o ORDER BY share DESC, n DESC, levenshtein(lower(o), lower(w)), o, w) = 1
    AND row_number() OVER (PARTITION BY f, l, w ORDER BY share DESC, n DESC, levenshtein(lower(o), lower(w)), o, w) = 1)
SELECT f AS source_file, l AS load_no, 'renamed' AS change_kind, o AS old_field, w AS new_field FROM ren
UNION ALL SELECT f, l, 'removed', k, '' FROM gone WHERE NOT EXISTS (FROM ren WHERE ren.f = gone.f AND ren.l = gone.l AND ren.o = gone.k)
UNION ALL SELECT f, l, 'added', '', k FROM come WHERE NOT EXISTS (FROM ren WHERE ren.f = come.f AND ren.l = come.l AND ren.w = come.k)
UNION ALL SELECT new.f, new.l, 'type_changed', new.k, new.k FROM new JOIN old ON old.f = new.f AND old.l = new.l AND old.k = new.k WHERE old.kind <> new.kind""",
    "p6_versions": """
WITH f AS (SELECT Source_File AS source_file, load_no, unnest(json_keys(payload)) AS field, payload FROM raw_records),
k AS (SELECT source_file, load_no, field, payload -> ('$."' || field || '"') AS j FROM f),
t AS (SELECT source_file, load_no, field, CASE
    WHEN json_type(j) IS NULL OR json_type(j) = 'NULL' THEN NULL
    WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN regexp_matches(j ->> '$', '\\S') THEN 'text' END
    WHEN json_type(j) = 'BOOLEAN' THEN 'boolean'
    WHEN json_type(j) = 'ARRAY' THEN CASE WHEN json_array_length(j) > 0 THEN 'list' END
    WHEN json_type(j) = 'OBJECT' THEN CASE WHEN len(json_keys(j)) > 0 THEN 'object' END ELSE 'number' END AS kind FROM k),
c AS (SELECT source_file, load_no, field, kind, count(*) AS n FROM t GROUP BY ALL),
v AS (SELECT source_file, load_no, field, kind FROM c
      QUALIFY row_number() OVER (PARTITION BY source_file, load_no, field ORDER BY kind IS NULL, n DESC, kind) = 1)
SELECT source_file, load_no, count(*) AS n_fields,
  sha256(array_to_string(list_sort(list(field || chr(31) || coalesce(kind, ''))), chr(30))) AS fingerprint
FROM v GROUP BY ALL""",
}
