"""One surviving record for each group of duplicates, field by field.

Every cell that is not missing is a claim of its source (the file the row came from) for a value of a field of the group.
A latent truth model with two-sided source quality is fitted by expectation-maximisation: a source has a sensitivity (it
gives true values) and a specificity (it doesn't give false ones); a value of a group is true with a probability that
follows from the sources that claim it and from those that claim something else. Values stand for themselves, so several
values of a field can be true at once. The reviewer's mark, then the latest update decide which cell survives; the model
decides what they leave open, and which values of multi-valued fields are kept beside the survivor.

The likelihood of "claimed something else" is a sum over the sources of the field minus those of the value, so every step
is a sum per field, per value or per source: nothing pairs the members of a group with each other, sums are combined before
the shuffle, and a group or source with a third of all rows stays a sequence of partial sums. Each round is checkpointed.

Groups written differently (" 17", "0017", "17.0") are one; rows without a group number are left out. Rows that repeat
count once per source and value. A field whose cells are all missing has no survivor. Ties go to the smaller id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.text import is_missing, match_key, strip
from tidewright.session import checkpointed

FIELDS = ["Organisation_Name", "Contact_Name", "Email", "Phone", "Website", "Address"]
MULTI_VALUED = ["Email", "Phone", "Website", "Address"]
ROUNDS = 4
#: Prior of a value, and of an organisation name that is known.
PRIOR, PRIOR_KNOWN = 0.5, 0.9
#: Pseudo-counts (successes, failures) of sensitivity and specificity.
PSEUDO_SENSITIVITY, PSEUDO_SPECIFICITY = (7.0, 3.0), (9.0, 1.0)


def group_number(c: Column | str) -> Column:
    """The number of a group as bigint, however it is written; null if there is none."""
    return F.nullif(F.regexp_extract(c, r"^\D*?(\d{1,18})(?:[.,]0*)?\D*$", 1), F.lit("")).cast("bigint")


def is_marked(c: Column | str) -> Column:
    """An X in either case, blanks aside."""
    return F.coalesce(F.upper(strip(c)) == "X", F.lit(False))


def value_key(field: Column, value: Column) -> Column:
    """Values of a field that are written differently and mean the same."""
    phone = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"\(0\)", ""), r"\D", ""), r"^(?:0049|49|0)", "")
    site = F.regexp_replace(F.regexp_replace(F.lower(strip(value)), r"^(?:https?://)?(?:www\.)?", ""), r"[/?].*$|:\d+.*$", "")
    return (
        F.when(field == "Phone", phone).when(field == "Website", site).when(field == "Email", F.lower(F.regexp_replace(value, r"\s", "")))
        .otherwise(F.replace(match_key(value), F.lit(" "), F.lit("")))
    )


def claims(members: DataFrame, key: str, group: str, source: str, fields: list[str], mark: str | None = None, updated: str | None = None) -> DataFrame:
    """(grp, field, value, vkey, id, source, marked, updated_at) of the cells that are not missing."""
    cells = F.filter(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]), lambda c: ~is_missing(c["value"]))
    rows = members.select(
        group_number(group).alias("grp"), F.col(key).alias("id"), F.coalesce(F.col(source), F.lit("")).alias("source"),
        (is_marked(mark) if mark else F.lit(False)).alias("marked"), (F.col(updated) if updated else F.lit(None).cast("timestamp")).alias("updated_at"), F.explode(cells).alias("c"),
    ).where("grp is not null")
    return rows.select("grp", "c.field", "c.value", value_key(F.col("c.field"), F.col("c.value")).alias("vkey"), "id", "source", "marked", "updated_at")


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def truth(claim: DataFrame, known: DataFrame | None = None, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """((grp, field, vkey, p), (source, sensitivity, specificity)) of the fitted model.

    ``known`` has a column vkey of known organisation names. With no claims both results are empty.
    """
    votes = checkpointed(claim.select("grp", "field", "vkey", "source").distinct())
    voters = checkpointed(votes.select("grp", "field", "source").distinct())
    facts = votes.select("grp", "field", "vkey").distinct()
    prior = F.lit(_logit(PRIOR))
    if known is not None:
        sure = known.select("vkey").distinct().withColumn("field", F.lit("Organisation_Name")).withColumn("_known", F.lit(True))
        facts = facts.join(sure, ["field", "vkey"], "left")
        prior = F.when(F.col("_known"), F.lit(_logit(PRIOR_KNOWN))).otherwise(prior)
    facts = checkpointed(facts.select("grp", "field", "vkey", prior.alias("prior")))
    a, b = PSEUDO_SENSITIVITY
    c, d = PSEUDO_SPECIFICITY
    quality = votes.select("source").distinct().select("source", F.lit(a / (a + b)).alias("sensitivity"), F.lit(c / (c + d)).alias("specificity"))
    p = facts.select("grp", "field", "vkey", F.lit(0.5).alias("p"))
    for _ in range(rounds):
        # Expectation: silence of every source of the field, corrected for the sources that claim the value.
        silent = F.log((1 - F.col("sensitivity")) / F.col("specificity"))
        spoken = F.log(F.col("sensitivity") / (1 - F.col("specificity")))
        q = quality.select("source", silent.alias("no"), (spoken - silent).alias("yes"))
        of_field = voters.join(q, "source").groupBy("grp", "field").agg(F.sum("no").alias("no"))
        of_value = votes.join(q, "source").groupBy("grp", "field", "vkey").agg(F.sum("yes").alias("yes"))
        odds = facts.join(of_value, ["grp", "field", "vkey"]).join(of_field, ["grp", "field"])
        p = checkpointed(odds.select("grp", "field", "vkey", (1 / (1 + F.exp(-F.least(F.greatest(F.col("prior") + F.col("no") + F.col("yes"), F.lit(-30.0)), F.lit(30.0))))).alias("p")))
        # Maximisation: expected true and false values that each source gave, of those it could have given.
        total = p.groupBy("grp", "field").agg(F.sum("p").alias("t"), F.sum(1 - F.col("p")).alias("f"))
        could = voters.join(total, ["grp", "field"]).groupBy("source").agg(F.sum("t").alias("t"), F.sum("f").alias("f"))
        gave = votes.join(p, ["grp", "field", "vkey"]).groupBy("source").agg(F.sum("p").alias("gt"), F.sum(1 - F.col("p")).alias("gf"))
        fitted = could.join(gave, "source")
        quality = checkpointed(
            fitted.select("source", ((F.col("gt") + a) / (F.col("t") + a + b)).alias("sensitivity"), ((F.col("f") - F.col("gf") + c) / (F.col("f") + c + d)).alias("specificity"))
        )
    return p, quality


def survivors(claim: DataFrame, p: DataFrame) -> DataFrame:
    """(grp, field, id, value, vkey, p): the cell that survives: marked before others, then the latest, then the likeliest
    value, then the smaller id. One aggregation with map-side combine."""
    scored = claim.join(p, ["grp", "field", "vkey"], "left")
    order = F.struct("marked", F.coalesce("updated_at", F.lit("0001-01-01").cast("timestamp")).alias("u"), F.coalesce("p", F.lit(0.0)).alias("p"), (-F.col("id")).alias("i"))
    best = scored.groupBy("grp", "field").agg(F.max_by(F.struct("id", "value", "vkey", "p"), order).alias("b"))
    return best.select("grp", "field", "b.*")


def records(claim: DataFrame, p: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """(grp, the surviving fields, the further true values of multi-valued fields joined by `` | ``)."""
    best = survivors(claim, p)
    true = claim.join(p.where("p >= 0.5"), ["grp", "field", "vkey"]).where(F.col("field").isin(MULTI_VALUED)).groupBy("grp", "field", "vkey").agg(F.min("value").alias("value"), F.max("p").alias("p"))
    others = true.join(best.select("grp", "field", "vkey"), ["grp", "field", "vkey"], "left_anti")
    more = others.groupBy("grp", "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("o"), "value"))), lambda x: x["value"]), " | ").alias("more"))
    long = best.join(more, ["grp", "field"], "left")
    one = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    rest = [F.max(F.when(F.col("field") == f, F.col("more"))).alias(f"{f}_Alternatives") for f in fields if f in MULTI_VALUED]
    return long.groupBy("grp").agg(*one, *rest)


def known_names(organisations: DataFrame, column: str = "Organisation_Name") -> DataFrame:
    """(vkey) of the known organisation names."""
    return organisations.where(~is_missing(column)).select(value_key(F.lit("Organisation_Name"), F.col(column)).alias("vkey"))

