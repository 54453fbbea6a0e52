"""Column profiles by load: grouped distinct counts, missing shares, ranges, pattern violations, mergeable power sums.

The plan aggregates twice. The first aggregation groups by (load, column, text) with a map-side combine, so a hot load or
a text that fills a third of the rows leaves each task as one row; all later steps work on distinct texts or on load totals.
Moments are kept as exact integer sums of powers of the text length, so profiles of parts (files, days, shards) add up
without loss and shifts between loads are read off the sums as standardised differences.

Nulls count as missing; an empty table gives an empty profile; rows that repeat count each time; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.text import is_missing, strip

# Possessive quantifiers: no backtracking on very long texts.
_LABELS = r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)++[A-Za-z]{2,}"
EMAIL_FORM = rf"^[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+@{_LABELS}$"
WEBSITE_FORM = rf"^(?:[Hh][Tt][Tt][Pp][Ss]?://)?{_LABELS}(?::[0-9]++)?(?:[/?](?U:[^\s|;,])*+)?$"
WEB_ADDRESS = r"(?i)https?:|www\.|[a-z0-9-]\.(?:example|test|invalid|com|net|org|info|de|at|ch|eu|fr|io|uk)(?![\p{L}\p{N}])"

MAX_POWER = 4


def email_form(c: Column) -> Column:
    """The stripped text is one well-formed e-mail address."""
    return strip(c).rlike(EMAIL_FORM)


def website_form(c: Column) -> Column:
    """The stripped text is one well-formed web address, scheme in either case or absent."""
    return strip(c).rlike(WEBSITE_FORM)


def person_form(c: Column) -> Column:
    """Two or more characters with a letter, without digit, ``@``, line break or web address."""
    s = strip(c)
    return (F.length(s) >= 2) & s.rlike(r"\p{L}") & ~s.rlike(r"[\p{Nd}@\r\n\x0B\x0C\x{85}\x{2028}\x{2029}]") & ~s.rlike(WEB_ADDRESS)


Forms = dict[str, Callable[[Column], Column]]
CONTACT_FORMS: Forms = {"Email": email_form, "Website": website_form, "Contact_Name": person_form}


def violations(df: DataFrame, key: str, forms: Forms) -> DataFrame:
    """(column_name, key) of every cell that is not missing and breaks its column's form. One narrow pass."""
    marks = F.array_compact(F.array(*[F.when(~is_missing(F.col(n)) & ~form(F.col(n)), F.lit(n)) for n, form in forms.items()]))
    return df.select(F.col(key), F.explode(marks).alias("column_name"))


def value_counts(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(by, column_name, value, n): rows of each distinct text, nulls included; pre-aggregated before the shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    return df.select(by, F.explode(cells).alias("cell")).groupBy(by, "cell.column_name", "cell.value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, by: str, forms: Forms) -> DataFrame:
    """One row for each (by, column_name): counts, ranges, the most frequent text and exact power sums of the text length."""
    counts = value_counts(df, by, list(forms))
    ok = F.lit(True)
    for name, form in forms.items():
        ok = F.when(F.col("column_name") == name, form(F.col("value"))).otherwise(ok)
    counts = counts.withColumn("absent", is_missing(F.col("value"))).withColumn("broken", ~F.col("absent") & ~ok)
    present, broken, length = ~F.col("absent"), F.col("broken"), F.length("value").cast("decimal(38,0)")

    def power(k: int) -> Column:
        term = F.col("n").cast("decimal(38,0)")
        for _ in range(k):
            term = (term * length).cast("decimal(38,0)")
        return F.coalesce(F.sum(F.when(present, term)), F.lit(0)).cast("decimal(38,0)").alias(f"sum_len_{k}")

    return counts.groupBy(by, "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.coalesce(F.sum(F.when(broken, F.col("n"))), F.lit(0)).alias("n_pattern"),
        F.count(F.when(present, 1)).alias("n_distinct"),
        F.coalesce(F.max(F.when(present, F.col("n"))), F.lit(0)).alias("n_top"),
        F.min(F.when(present, F.col("value"))).alias("min_value"),
        F.max(F.when(present, F.col("value"))).alias("max_value"),
        F.min(F.when(present, F.length("value"))).alias("min_len"),
        F.max(F.when(present, F.length("value"))).alias("max_len"),
        *[power(k) for k in range(1, MAX_POWER + 1)],
    )


def merge_profiles(parts: DataFrame, by: str) -> DataFrame:
    """Add up the mergeable fields of profiles of disjoint parts. Distinct counts and top counts need the texts and are left out."""
    sums = ["n_rows", "n_null", "n_missing", "n_pattern", *[f"sum_len_{k}" for k in range(1, MAX_POWER + 1)]]
    return parts.groupBy(by, "column_name").agg(
        *[F.sum(c).cast("decimal(38,0)" if c.startswith("sum") else "bigint").alias(c) for c in sums],
        *[f(c).alias(c) for f, c in ((F.min, "min_value"), (F.max, "max_value"), (F.min, "min_len"), (F.max, "max_len"))],
    )


def with_moments(profiles: DataFrame) -> DataFrame:
    """Mean and standard deviation of the text length from the power sums; null where no cell is present."""
    n = F.col("n_rows") - F.col("n_missing")
    s1, s2 = F.col("sum_len_1").cast("double"), F.col("sum_len_2").cast("double")
    mean = F.when(n > 0, s1 / n)
    return profiles.withColumn("mean_len", mean).withColumn("std_len", F.when(n > 0, F.sqrt(F.greatest(s2 / n - mean * mean, F.lit(0.0)))))


def against_previous(profiles: DataFrame, by: str) -> DataFrame:
    """Each profile beside that of ``by - 1`` (fields with suffix ``_prev``, null if there is none) and the standardised
    difference of the mean text length: |m1 - m0| / sqrt((s1² + s0²) / 2), null where undefined."""
    p = with_moments(profiles)
    fields = ["n_rows", "n_missing", "n_pattern", "n_top", "mean_len", "std_len"]
    before = p.select((F.col(by) + 1).cast(dict(p.dtypes)[by]).alias(by), "column_name", *[F.col(c).alias(f"{c}_prev") for c in fields])
    pooled = F.sqrt((F.pow("std_len", F.lit(2)) + F.pow("std_len_prev", F.lit(2))) / 2)
    return p.join(before, [by, "column_name"], "left").withColumn("smd_len", F.when(pooled > 0, F.abs(F.col("mean_len") - F.col("mean_len_prev")) / pooled))


def shifts(profiles: DataFrame, by: str, fifths: int = 1) -> DataFrame:
    """(column_name, by) where the share of missing cells, of pattern cells or of the most frequent text differs from the
    load before by ``fifths``/5 or more. Shares are compared as integers, so a difference of exactly 0.2 counts."""
    p = against_previous(profiles, by).where(F.col("n_rows_prev").isNotNull())

    def jump(part: Column, whole: Column, part0: Column, whole0: Column) -> Column:
        big = [x.cast("decimal(19,0)") for x in (part, F.greatest(whole, F.lit(1)), part0, F.greatest(whole0, F.lit(1)))]
        return F.abs(big[0] * big[3] - big[2] * big[1]) * 5 >= big[1] * big[3] * fifths

    rows, rows0 = F.col("n_rows"), F.col("n_rows_prev")
    found = jump(F.col("n_missing"), rows, F.col("n_missing_prev"), rows0)
    found |= jump(F.col("n_pattern"), rows, F.col("n_pattern_prev"), rows0)
    found |= jump(F.col("n_top"), rows - F.col("n_missing"), F.col("n_top_prev"), rows0 - F.col("n_missing_prev"))
    return p.where(found).select("column_name", by)


def constant_columns(profiles: DataFrame) -> DataFrame:
    """Profiles of columns that hold one text only."""
    return profiles.where((F.col("n_distinct") == 1) & (F.col("n_missing") == 0))


def rank_by_missing(profiles: DataFrame, by: str) -> DataFrame:
    """Loads of each column, the largest share of missing cells first."""
    share = F.col("n_missing") / F.col("n_rows")
    return profiles.withColumn("missing_rank", F.row_number().over(Window.partitionBy("column_name").orderBy(share.desc(), F.col(by))))
