"""Queries of the operators for training texts and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import NO_VALUE_WORDS
from tidewright.llm import leakage, mojibake, names, pii, places, survivors, tokenizer
from tidewright.session import checkpointed, table


def _places(spark: SparkSession, d: str) -> DataFrame:
    contacts = table(spark, d, "contacts_enriched")
    return places.places(checkpointed(places.addresses(contacts, "ID", "Address", "Address_Alternatives", "Location")), "ID")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of contacts that name the same street and number in the same town."""
    found = places.pairs(_places(spark, d), "ID")
    return found.select(F.col("id_a").cast("bigint").alias("id_a"), F.col("id_b").cast("bigint").alias("id_b"))


def p2_places(spark: SparkSession, d: str) -> DataFrame:
    """Every address with its standard place and how far it could be told."""
    return _places(spark, d)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows whose names differ and denote one organisation, or one person of one organisation."""
    contacts = table(spark, d, "contacts_raw")
    classes = checkpointed(names.organisation_classes(contacts))
    orgs = names.organisation_pairs(classes).withColumn("column_name", F.lit("Organisation_Name"))
    found = orgs.unionByName(names.person_pairs(contacts, classes).withColumn("column_name", F.lit("Contact_Name")))
    return found.select("column_name", F.col("id_a").cast("bigint").alias("id_a"), F.col("id_b").cast("bigint").alias("id_b"))


def p3_organisations(spark: SparkSession, d: str) -> DataFrame:
    """The organisation class of every row that tells one."""
    return names.organisation_classes(table(spark, d, "contacts_raw"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells of Organisation_Name and Description that are damaged by a wrong encoding."""
    found = mojibake.damaged_cells(table(spark, d, "staging_all_rows"), "row_id", ["Organisation_Name", "Description"])
    return found.select(F.col("row_id").cast("bigint").alias("row_id"), "column_name")


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    """The damaged cells with the original text where it can be had."""
    return mojibake.damaged_cells(table(spark, d, "staging_all_rows"), "row_id", ["Organisation_Name", "Description"])


def _claims(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    claim = checkpointed(survivors.claims(table(spark, d, "duplicate_list"), "ID", "duplicate_group", "Source_File", survivors.FIELDS, "selected", "updated_at"))
    p, quality = survivors.truth(claim, survivors.known_names(table(spark, d, "organisations_enriched")))
    return claim, p, quality


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The member whose cell survives, by group and field."""
    claim, p, _ = _claims(spark, d)
    return survivors.survivors(claim, p).select(F.col("grp").alias("duplicate_group"), F.col("field").alias("column_name"), F.col("id").cast("bigint").alias("id"))


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each group, with every further value judged true."""
    claim, p, _ = _claims(spark, d)
    return survivors.records(claim, p).withColumnRenamed("grp", "duplicate_group")


def p5_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sensitivity and specificity of each source file."""
    _, _, quality = _claims(spark, d)
    return quality.select("source", F.round("sensitivity", 6).alias("sensitivity"), F.round("specificity", 6).alias("specificity"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return tokenizer.encode(table(spark, d, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold twelve or more consecutive words of a test item."""
    return leakage.leaks(table(spark, d, "documents"), "doc_id", table(spark, d, "eval_items"), "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items with the number of documents that hold them."""
    return p9_found(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct piece of personal information of each document, as written."""
    return pii.pieces(table(spark, d, "documents"), "doc_id", "text")


def p10_texts(spark: SparkSession, d: str) -> DataFrame:
    """The texts with typed placeholders."""
    return pii.redact(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {
    "p2_found": p2_found, "p2_places": p2_places,
    "p3_found": p3_found, "p3_organisations": p3_organisations,
    "p4_found": p4_found, "p4_restored": p4_restored, "p5_found": p5_found, "p5_records": p5_records, "p5_sources": p5_sources,
    "p10_found": p10_found, "p10_texts": p10_texts,
    "p8_ids": p8_ids, "p9_found": p9_found, "p9_items": p9_items,
}

_WORDS = r"regexp_extract_all(replace(strip_accents(lower(text)), 'ß', 'ss'), '[\p{L}\p{N}]+')"
_LEAKS = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM eval_items),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - 10)) AS k FROM i WHERE len(w) >= 12)),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - 10)) AS k FROM d WHERE len(w) >= 12)),
f AS (SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (t))"""

_WORDS_NONE = ", ".join(f"'{w}'" for w in NO_VALUE_WORDS)

ORACLE = {
    "p5_found": rf"""
WITH m AS (SELECT try_cast(nullif(regexp_extract(duplicate_group, '^[^0-9]*([0-9]{{1,18}})([.,]0*)?[^0-9]*$', 1), '') AS BIGINT) AS duplicate_group,
    ID, upper(regexp_replace(selected, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')) IS NOT DISTINCT FROM 'X' AS marked, updated_at,
    Organisation_Name, Contact_Name, Email, Phone, Website, Address FROM duplicate_list),
u AS (UNPIVOT m ON Organisation_Name, Contact_Name, Email, Phone, Website, Address INTO NAME column_name VALUE v),
c AS (SELECT * FROM u WHERE duplicate_group IS NOT NULL AND regexp_matches(v, '[\p{{L}}\p{{N}}]')
  AND NOT (length(v) < 40 AND lower(regexp_replace(v, '[^\p{{L}}\p{{N}}]', '', 'g')) IN ({_WORDS_NONE})))
SELECT duplicate_group, column_name, ID AS id FROM c
QUALIFY row_number() OVER (PARTITION BY duplicate_group, column_name ORDER BY marked DESC, updated_at DESC NULLS LAST, ID) = 1""",
    "p9_found": _LEAKS + " SELECT doc_id, item_id FROM f",
    "p9_items": _LEAKS + " SELECT item_id, count(*) AS n_docs FROM f GROUP BY item_id",
}
