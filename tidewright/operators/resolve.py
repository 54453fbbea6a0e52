"""Cleaning and resolving contacts: clusters within an organisation, conflicts, merged rows, review overrides, previews.

Clusters follow from joins on keys, not from a walk through the rows: strong names group by their key; a one-word name goes
to the only strong name of the organisation that has the word; a row without a name goes to the only cluster that has its
e-mail, else to the organisation's sole cluster, else to the organisation's own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import contact as c
from tidewright.functions import values as v
from tidewright.functions.text import clean, match_key, split_pipes
from tidewright.functions.urls import website_domain
from tidewright.operators.numbering import ordered_distinct
from tidewright.session import checkpointed


def clean_contacts(raw: DataFrame, mode: str = "compat") -> DataFrame:
    """Addresses, sites and telephones extracted and split into first and further ones, names cleaned, issues listed."""
    found = raw.withColumns({
        "_e": c.emails("Email", "Email_Alternatives", mode=mode), "_w": c.urls("Website", "Website_Alternatives"), "_p": c.phones("Phone", "Phone_Alternatives"),
        "_n0": c.clean_name("Contact_Name"), "_o": c.organisation_name("Organisation_Name"), "_l": c.organisation_leftovers("Organisation_Name"),
    })
    found = found.withColumn("_n", F.when((F.col("_n0") != "") & (F.col("_o") != "") & (match_key("_n0") == match_key("_o")), "").otherwise(F.col("_n0")))
    name, low = F.col("_n"), F.lower(F.col("_n"))
    several = F.lit(False)
    for m in v.SEVERAL_PEOPLE_MARKS:
        several = several | low.contains(m)
    rules = [
        ((clean("Contact_Name") != "") & (name == ""), F.lit("Contact name cleared as invalid")),
        ((clean("Organisation_Name") != "") & (F.col("_o") == ""), F.lit("Organisation name cleared as invalid")),
        (F.col("_l") != "", F.concat(F.lit("Organisation field contained additional lines: "), F.col("_l"))),
        (F.size("_e") > 1, F.lit("Multiple emails extracted")),
        (F.size("_w") > 1, F.lit("Multiple websites extracted")),
        (name.contains("\n"), F.lit("Contact name contains multiple lines")),
        (name.rlike(r"\p{Nd}"), F.lit("Contact name contains numbers")),
        ((name != "") & (c.words("_n") == 1), F.lit("Contact name has one word")),
        (low.isin(v.GENERIC_CONTACT_WORDS), F.lit("Contact name looks generic")),
        (several, F.lit("Contact name may contain multiple people")),
    ]
    first = lambda a: F.coalesce(F.get(a, 0), F.lit(""))
    rest = lambda a: F.array_join(F.slice(a, F.lit(2), F.greatest(F.size(a), F.lit(1))), " | ")
    new = {
        "Email": first("_e"), "Email_Alternatives": rest("_e"), "Website": first("_w"), "Website_Alternatives": rest("_w"), "Phone": first("_p"), "Phone_Alternatives": rest("_p"),
        "Contact_Name": name, "Organisation_Name": F.col("_o"), "Email_Domain": c.domain_last(first("_e")),
        "Cleaning_Issues": F.array_join(F.array_compact(F.array(*[F.when(cond, text) for cond, text in rules])), " | "),
    }
    plain = {x: clean(x) for x in v.CONTACT_COLUMNS if x not in new and x != "ID"}
    return found.select("ID", *[(new | plain)[x].alias(x) for x in [*v.CONTACT_COLUMNS[1:], "Cleaning_Issues"]])


def exclusion_reasons(cleaned: DataFrame) -> DataFrame:
    """``cleaned`` with the reasons to leave a row out, "" for none."""
    org, site, email, name = (clean(x) != "" for x in ("Organisation_Name", "Website", "Email", "Contact_Name"))
    rules = [
        (F.lower(clean("Email")).endswith("@gmail.com"), "Contact has a Gmail email address"),
        (~org & ~site & ~email & ~name, "No organisation, website, email, or contact name"),
        (~org & ~site & ~email & name, "Only contact name available"),
    ]
    return cleaned.withColumn("Exclusion_Reason", F.array_join(F.array_compact(F.array(*[F.when(x, F.lit(t)) for x, t in rules])), " | "))


def organisation_name_reason(col: str = "Organisation_Name"):  # noqa: ANN201
    """Why an organisation's name needs review, "" if it doesn't."""
    s = F.col(col)
    return (
        F.when(s.rlike(r"(?i)^[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}$"), "Organisation name is an email address")
        .when(s.rlike(r"^[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4}"), "Organisation name looks like a date or form submission").otherwise("")
    )


def contact_clusters(cleaned: DataFrame, order: str = "ID") -> DataFrame:
    """``cleaned`` with ``org_key`` and ``cluster``, a label unique within the organisation. Rows without an organisation
    have "" and are clusters of their own."""
    name = F.col("Contact_Name")
    base = cleaned.withColumns({
        "org_key": match_key("Organisation_Name"), "_key": match_key("Contact_Name"), "_mail": F.lower(clean("Email")), "_order": F.col(order),
        "_kind": F.when(c.is_strong_name(name), "strong").when(c.is_weak_name(name), "weak").otherwise("none"),
    })
    base = checkpointed(base)  # keys are read by every branch below and computed once
    rows = base.where("org_key <> ''")
    strong = rows.where("_kind = 'strong'").withColumn("cluster", F.concat(F.lit("s:"), F.col("_key")))
    tokens = strong.select("org_key", "cluster", F.explode(F.split("_key", " ")).alias("_key")).distinct()
    only = tokens.groupBy("org_key", "_key").agg(F.min("cluster").alias("_c"), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    weak = rows.where("_kind = 'weak'").join(only, ["org_key", "_key"], "left")
    weak = weak.withColumn("cluster", F.coalesce("_c", F.concat(F.lit("w:"), F.col("_order").cast("string")))).drop("_c")
    named = strong.unionByName(weak)
    mails = named.where("_mail <> ''").select("org_key", "_mail", "cluster").distinct()
    by_mail = mails.groupBy("org_key", "_mail").agg(F.min("cluster").alias("_c"), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    sole = named.groupBy("org_key").agg(F.min("cluster").alias("_s"), F.count_distinct("cluster").alias("_n")).where("_n = 1").drop("_n")
    nameless = rows.where("_kind = 'none'").join(by_mail, ["org_key", "_mail"], "left").join(sole, "org_key", "left")
    nameless = nameless.withColumn("cluster", F.coalesce("_c", "_s", F.lit("o:"))).drop("_c", "_s")
    alone = base.where("org_key = ''").withColumn("cluster", F.concat(F.lit("r:"), F.col("_order").cast("string")))
    return named.unionByName(nameless).unionByName(alone).drop("_key", "_mail", "_kind", "_order")


def cluster_conflicts(clustered: DataFrame, keys: tuple[str, ...] = ("org_key", "cluster"), order: str = "ID") -> DataFrame:
    """(keys, n_rows, conflicts): fields in which the rows of a group disagree, in order, joined by `` | ``. Two aggregations:
    the first finds the longest address and the strong name, the second checks the others against them."""
    k = list(keys)
    tidy = lambda x: F.regexp_replace(clean(x), r"[.,;:]+$", "")
    rows = clustered.withColumns({
        "_mail": F.nullif(F.lower(tidy("Email")), F.lit("")), "_host": F.nullif(website_domain("Website"), F.lit("")), "_name": F.nullif(match_key(c.clean_name(tidy("Contact_Name"))), F.lit("")),
        "_addr": F.nullif(match_key(tidy("Address")), F.lit("")), "_role": F.nullif(match_key(tidy("Role")), F.lit("")), "_loc": F.nullif(match_key(tidy("Location")), F.lit("")),
    })
    rows = rows.withColumn("_strong", F.when(F.size(F.split("_name", " ")) >= 2, F.col("_name"))).withColumn("_weak", F.when(F.size(F.split("_name", " ")) == 1, F.col("_name")))
    first = rows.groupBy(*k).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_mail").alias("_nm"), F.count_distinct("_host").alias("_nh"), F.count_distinct("_strong").alias("_ns"), F.max("_strong").alias("_s"),
        F.count_distinct("_weak").alias("_nw"), F.count_distinct("_role").alias("_nr"), F.count_distinct("_loc").alias("_nl"),
        F.max_by("_addr", F.when(F.col("_addr").isNotNull(), F.struct(F.length("_addr").alias("l"), (-F.col(order)).alias("o")))).alias("_long"),
    )
    # Agreement is checked on distinct values, so a hot group sends few rows.
    values = rows.select(*k, "_weak", "_addr").distinct().join(first.select(*k, "_s", "_long"), k)
    second = values.groupBy(*k).agg(
        F.bool_and(F.coalesce(F.array_contains(F.split("_s", " "), F.col("_weak")), F.lit(True))).alias("_fits"), F.bool_and(F.coalesce(F.contains(F.col("_long"), F.col("_addr")), F.lit(True))).alias("_nested")
    )
    names = (F.col("_ns") > 1) | ((F.col("_ns") == 1) & ~F.col("_fits")) | ((F.col("_ns") == 0) & (F.col("_nw") > 1))
    rules = [("Email", F.col("_nm") > 1), ("Website", F.col("_nh") > 1), ("Contact_Name", names), ("Address", ~F.col("_nested")), ("Role", F.col("_nr") > 1), ("Location", F.col("_nl") > 1)]
    listed = F.array_join(F.array_compact(F.array(*[F.when(x, F.lit(t)) for t, x in rules])), " | ")
    return first.join(second, k).select(*k, "n_rows", listed.alias("conflicts"))


def recommended_rows(clustered: DataFrame, keys: tuple[str, ...] = ("org_key", "cluster"), order: str = "ID") -> DataFrame:
    """(keys, recommended): the row that tells most, the first of equals."""
    return clustered.groupBy(*keys).agg(F.max_by(order, F.struct(c.row_priority().alias("s"), (-F.col(order)).alias("o"))).alias("recommended"))


def merge_clusters(clustered: DataFrame, keys: tuple[str, ...] = ("org_key", "cluster"), order: str = "ID") -> DataFrame:
    """One row per group: the row that tells most, its gaps filled by the first row that has a value, best name and address,
    sites, alternatives and sources pooled. Meant for groups without conflicts."""
    k = list(keys)
    rows = checkpointed(clustered.withColumns({"_s": c.row_priority(), "_o": F.col(order)}))
    tidy = lambda x: F.regexp_replace(clean(x), r"[.,;:]+$", "")
    later = -F.col("_o")

    def best_text(column: str, *score) -> object:  # noqa: ANN002
        t = tidy(column)
        return F.coalesce(F.max_by(t, F.when(t != "", F.struct(*score, later.alias("o")))), F.lit("")).alias(column)

    top = F.max_by(F.struct(*v.CONTACT_COLUMNS), F.struct("_s", later.alias("o"))).alias("_top")
    fills = ["Email", "Email_Domain", "Phone", "LinkedIn", "Role", "Organisation_Type", "Sector", "Location", "Description", "Responsible_Person"]
    agg = rows.groupBy(*k).agg(
        top, best_text("Organisation_Name", c.words(tidy("Organisation_Name")).alias("w"), F.length(tidy("Organisation_Name")).alias("l")),
        best_text("Contact_Name", c.words(tidy("Contact_Name")).alias("w"), F.length(tidy("Contact_Name")).alias("l")), best_text("Address", c.address_quality(tidy("Address")).alias("q")),
        *[F.min_by(clean(x), F.when(clean(x) != "", F.col("_o"))).alias(f"_{x}") for x in fills],
    )
    sites = ordered_distinct(rows.withColumn("_x", F.array(tidy("Website"))), k, F.col("_x"), "_o", "_sites")
    more = ordered_distinct(rows, k, split_pipes("Website_Alternatives"), "_o", "_more_sites")
    pooled = {x: ordered_distinct(rows, k, items, "_o", f"_pool_{x}") for x, items in (
        ("Email_Alternatives", split_pipes("Email_Alternatives")), ("Phone_Alternatives", split_pipes("Phone_Alternatives")), ("Source_File", F.array(tidy("Source_File"))), ("Source_Row", F.array(tidy("Source_Row"))))}
    out = agg.join(sites, k, "left").join(more, k, "left")
    for df in pooled.values():
        out = out.join(df, k, "left")
    all_sites = F.concat(F.split(F.coalesce("_sites", F.lit("")), r" \| "), F.split(F.coalesce("_more_sites", F.lit("")), r" \| "))
    lowered = F.transform(all_sites, lambda x: F.lower(x))
    unique = F.filter(all_sites, lambda x, i: (x != "") & (F.array_position(lowered, F.lower(x)) == i + 1))
    site = F.coalesce(F.nullif(clean("_top.Website"), F.lit("")), F.get(unique, 0), F.lit(""))
    new = {
        "Organisation_Name": F.col("Organisation_Name"), "Contact_Name": F.col("Contact_Name"), "Address": F.col("Address"), "Website": site,
        "Website_Alternatives": F.array_join(F.filter(unique, lambda x: F.lower(x) != F.lower(site)), " | "),
    }
    new |= {x: F.coalesce(F.nullif(clean(f"_top.{x}"), F.lit("")), f"_{x}", F.lit("")) for x in fills} | {x: F.coalesce(f"_pool_{x}", F.lit("")) for x in pooled}
    return out.select(*k, *[new.get(x, F.col(f"_top.{x}")).alias(x) for x in v.CONTACT_COLUMNS])


def resolved_contacts(cleaned: DataFrame, order: str = "ID") -> DataFrame:
    """Single rows and rows in conflict as they are, compatible clusters merged; ``outcome`` tells which."""
    rows = checkpointed(contact_clusters(cleaned, order))
    judged = checkpointed(rows.join(cluster_conflicts(rows, order=order), ["org_key", "cluster"]))
    kept = judged.where("n_rows = 1 or conflicts <> ''").select(*v.CONTACT_COLUMNS, F.when(F.col("n_rows") == 1, "single").otherwise("conflict").alias("outcome"))
    merged = merge_clusters(judged.where("n_rows > 1 and conflicts = ''"), order=order)
    return kept.unionByName(merged.select(*v.CONTACT_COLUMNS, F.lit("merged").alias("outcome")))


def review_list(cleaned: DataFrame, order: str = "ID") -> DataFrame:
    """Rows of clusters in conflict: group label, recommended row marked X, the fields in conflict."""
    rows = checkpointed(contact_clusters(cleaned, order))
    state = cluster_conflicts(rows, order=order).where("n_rows > 1 and conflicts <> ''")
    judged = rows.join(state, ["org_key", "cluster"]).join(recommended_rows(rows, order=order), ["org_key", "cluster"])
    mark = F.when(F.col(order) == F.col("recommended"), "X").otherwise("")
    return judged.select(order, F.concat_ws("/", "org_key", "cluster").alias("duplicate_group"), mark.alias("selected"), F.lit("yes").alias("to_verify"), F.col("conflicts").alias("verify_reason"))


def organisation_preview(contacts: DataFrame, order: str = "ID") -> DataFrame:
    """One row per organisation key: best name and address, longest texts, lists of types and sectors, the recommended row's
    site, profile and telephone, distinct contacts and conflicts."""
    rows = contacts.withColumn("org_key", match_key("Organisation_Name")).where("org_key <> ''")
    k, later = ["org_key"], (-F.col(order)).alias("o")
    tidy = lambda x: F.regexp_replace(clean(x), r"[.,;:]+$", "")
    longest = lambda x: F.coalesce(F.max_by(clean(x), F.when(clean(x) != "", F.struct(F.length(clean(x)).alias("l"), later))), F.lit("")).alias(x)
    person = F.when((clean("Contact_Name") != "") | (clean("Email") != ""), F.struct(match_key("Contact_Name").alias("n"), F.lower(clean("Email")).alias("e")))
    name, addr = tidy("Organisation_Name"), tidy("Address")
    agg = rows.groupBy(*k).agg(
        F.max_by(name, F.struct(c.words(name).alias("w"), F.length(name).alias("l"), later)).alias("Organisation_Name"),
        F.max_by(F.struct(F.col(order).alias("i"), clean("Website").alias("w"), clean("LinkedIn").alias("l"), clean("Phone").alias("p")), F.struct(c.row_priority().alias("s"), later)).alias("_r"),
        longest("Location"), longest("Description"), F.coalesce(F.max_by(addr, F.when(addr != "", F.struct(c.address_quality(addr).alias("q"), later))), F.lit("")).alias("Address"),
        F.count_distinct(person).alias("Contact_Count"),
    )
    types = ordered_distinct(rows, k, F.array(tidy("Organisation_Type")), order, "Organisation_Type")
    sectors = ordered_distinct(rows, k, F.array(tidy("Sector")), order, "Sector")
    state = cluster_conflicts(rows, ("org_key",), order).select("org_key", "conflicts")
    out = agg.join(types, k, "left").join(sectors, k, "left").join(state, k)
    return out.select(
        "org_key", "Organisation_Name", F.col("_r.w").alias("Website"), F.coalesce("Organisation_Type", F.lit("")).alias("Organisation_Type"), F.coalesce("Sector", F.lit("")).alias("Sector"), "Location", "Address",
        "Description", F.col("_r.l").alias("LinkedIn"), F.col("_r.p").alias("Phone"), F.col("_r.i").alias("Recommended_Base_ID"), "Contact_Count", F.col("conflicts").alias("Conflicting_Fields"),
    )


def apply_review(staged: DataFrame, duplicate_list: DataFrame, name_review: DataFrame | None = None, key: str = "ID") -> DataFrame:
    """Rows of ``staged`` that reviews keep, with their edits: of a group to verify only the rows marked exactly X stay and take
    every column of the list; name reviews drop rows marked ``no`` and their columns win over those of the list, blanks too."""
    cols = [x for x in staged.columns if x != key]
    ident = F.trim(F.col(key).cast("string"))

    def edits(df: DataFrame, tag: str) -> DataFrame:
        shared = [x for x in cols if x in df.columns]
        return df.groupBy(ident.alias("_id")).agg(F.max(F.struct(*shared)).alias(f"_{tag}")) if shared else df.select(ident.alias("_id"), F.lit(None).alias(f"_{tag}")).distinct()

    verify = duplicate_list.where("to_verify = 'yes'")
    groups = verify.groupBy(ident.alias("_id")).agg(F.lit(True).alias("_in_group"), F.max(F.col("selected") == "X").alias("_chosen"))
    out = staged.withColumn("_id", ident).join(groups, "_id", "left").join(edits(verify.where("selected = 'X'"), "dup"), "_id", "left")
    out = out.where("_in_group is null or _chosen")
    sources = [("dup", duplicate_list)]
    if name_review is not None:
        chosen = F.coalesce(F.trim("selected"), F.lit("yes"))
        out = out.join(name_review.where(chosen == "no").select(ident.alias("_id")).distinct(), "_id", "left_anti").join(edits(name_review.where(chosen != "no"), "org"), "_id", "left")
        sources = [("org", name_review), *sources]

    def value(x: str) -> object:
        expr = F.col(x)
        for tag, df in reversed(sources):
            if x in df.columns:
                expr = F.when(F.col(f"_{tag}").isNotNull(), F.col(f"_{tag}.{x}")).otherwise(expr)
        return expr.alias(x)

    return out.select(key, *[value(x) for x in cols])
