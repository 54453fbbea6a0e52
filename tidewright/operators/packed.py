"""Cells that pack several values: split them into one row per value, position kept.

A cell is cut into tokens: quoted runs, delimiters and ordinary runs. Its *skeleton* is the token sequence with every
ordinary run replaced by the class of its content (E e-mail, U web address, N number, W words) and every quoted run by Q.
Which delimiters separate values is decided once per distinct skeleton; the resulting rule (token ranges) is joined back
and applied by position, so the decision cost follows the number of skeletons and not the number of rows.

Rules. ``|``, ``;``, tabs, line breaks and ``•`` always separate; `` / ``, `` & ``, `` und ``, `` oder ``, `` u. ``,
`` and ``, `` or `` with blanks around them separate; a comma separates unless it stands between two runs of words
("Berg, Anna") or is followed, without a blank, by a run that is no value of its own (``liste?a=1,2``); a blank separates
two e-mail or web addresses. Delimiters within quotes never separate. Empty items are dropped and not counted.

Null and blank cells give no rows; a cell with one value gives no rows in ``several`` and one row in ``split_packed``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import strip
from tidewright.session import broadcast_if_small, checkpointed

_HARD = r"|;•\t\n\r\x{85}\x{2028}\x{2029}"
_BLANK = r"[ \x{A0}]"
_BETWEEN = r"(?:/|&|(?i:und|oder|and|or|u\.))"
_WORD = rf"[^\s\x{{A0}}{_HARD},\"'][^\s\x{{A0}}{_HARD},]*+"
#: A word that is an e-mail or web address.
_ADDRESS = rf"(?:[^\s{_HARD},\"'@]++@[^\s{_HARD},\"']++|(?i:https?://|www\.)[^\s{_HARD},\"']++|(?:[\p{{L}}\p{{N}}_-]++\.)++\p{{L}}{{2,}}+(?:[:/?][^\s{_HARD},\"']*+)?)(?![^\s{_HARD},])"
_QUOTED = rf"""(?:"(?:[^"]++|"")*+"|'[^'\n{_HARD[:1]};]*+')(?=\s*(?:$|[{_HARD},]|{_BLANK}))"""
_SEPARATOR = rf"{_BLANK}*+[{_HARD},]{_BLANK}*+|{_BLANK}++{_BETWEEN}{_BLANK}++(?={_BLANK}*+\S)"
_RUN = rf"(?:{_WORD}|[\"'][^\s{_HARD},]*+)(?:{_BLANK}++(?!{_BETWEEN}{_BLANK}){_WORD})*+"
#: Quoted runs where a token begins with a quote; separators with their blanks; an address before another; other runs.
TOKEN = rf"{_QUOTED}|{_SEPARATOR}|{_ADDRESS}(?={_BLANK}++[\"']?{_ADDRESS})|{_RUN}|{_BLANK}++|\s|."


def tokens(cell: Column) -> Column:
    """The tokens of a cell in order; joined they are the cell."""
    return F.regexp_extract_all(cell, F.lit(TOKEN), F.lit(0))


def token_class(t: Column) -> Column:
    """``;`` for a separator, ``,`` and ``, `` for commas without and with blanks, Q for quoted runs, E N n U W for other
    runs by content, "" for blanks and empty quotes."""
    return (
        F.when(t.rlike(rf"^{_BLANK}*+,{_BLANK}*+$"), F.when(t == ",", F.lit(",")).otherwise(F.lit(", ")))
        .when(t.rlike(rf"^(?:{_BLANK}*+[{_HARD}]{_BLANK}*+|{_BLANK}++{_BETWEEN}{_BLANK}++)$"), F.lit(";"))
        .when(t.rlike(r"""^(?:\s*+|"\s*+"|'\s*+')$"""), F.lit(""))
        .when(t.rlike(r"""^(?:".*"|'.*')$"""), F.lit("Q"))
        .when(t.contains("@"), F.lit("E"))
        .when(t.rlike(rf"^{_ADDRESS}$"), F.lit("U"))
        .when(t.rlike(r"\d"), F.when(t.rlike(r"(?:\d\D*+){5}"), F.lit("N")).otherwise(F.lit("n")))
        .otherwise(F.lit("W"))
    )


def skeleton(toks: Column) -> Column:
    return F.array_join(F.transform(toks, token_class), "\x01")


def resolve(skel: str) -> list[list[int]]:
    """Token ranges [first, count] (first from 1) of the values of a skeleton, empty ones left out."""
    marks = skel.split("\x01")

    def separates(i: int) -> bool:
        if marks[i] not in (",", ", "):
            return marks[i] == ";"
        before = next((x for x in reversed(marks[:i]) if x), "")
        after = marks[i + 1] if i + 1 < len(marks) else ""
        if before == "W" and after == "W":
            return False
        return not (marks[i] == "," and before in ("E", "U") and after in ("n", "W", "N"))

    def between_addresses(i: int) -> bool:
        return marks[i] in ("E", "U", "Q") and i > 1 and marks[i - 1] == "" and marks[i - 2] in ("E", "U", "Q")

    items, start = [], 0
    for i in range(len(marks) + 1):
        end = i == len(marks) or separates(i)
        if end or between_addresses(i):
            if any(x not in ("", ",", ", ", ";") for x in marks[start:i]):
                items.append([start + 1, i - start])
            start = i + 1 if end else i
    return items


@F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def _resolve_all(skeletons: pd.Series) -> pd.Series:
    return skeletons.map(resolve)


def unquote(item: Column) -> Column:
    """Without quotes that enclose it whole; doubled double quotes inside become one."""
    double = item.rlike(r'^"(?:[^"]++|"")*+"$')
    single = item.rlike(r"^'[^'\n]*+'$")
    inner = F.regexp_replace(item, r"(?s)^.(.*).$", "$1")
    return F.when(double, strip(F.replace(inner, F.lit('""'), F.lit('"')))).when(single, strip(inner)).otherwise(item)


def cells_of(df: DataFrame, table_name: str, key: str, columns: list[str]) -> DataFrame:
    """(table_name, row_key, column_name, cell) of the non-blank cells of ``columns``."""
    packed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("cell")) for c in columns])
    rows = df.select(F.lit(table_name).alias("table_name"), F.col(key).cast("bigint").alias("row_key"), F.explode(packed).alias("x"))
    return rows.select("table_name", "row_key", "x.column_name", "x.cell").where(F.col("cell").rlike(r"(?U)\S"))


def split_packed(cells: DataFrame, least: int = 1) -> DataFrame:
    """(table_name, row_key, column_name, pos, item) of the cells that hold ``least`` or more values.

    Distinct skeletons are collected by an aggregation with map-side combine, resolved once and broadcast only while they
    are few (``session.BROADCAST_ROWS``); otherwise the join shuffles on the skeleton and the engine splits hot ones.
    """
    if least > 1:  # without any delimiter a cell holds one value and needs no rule
        cells = cells.where(F.col("cell").rlike(rf"[{_HARD},]|{_BLANK}{_BETWEEN}{_BLANK}|[@.].*{_BLANK}.*[@.]|[\"'@.]{_BLANK}++[\"']|[\"']{_BLANK}++\S*[@.]"))
    cut = cells.withColumn("toks", tokens(strip("cell"))).withColumn("skel", skeleton(F.col("toks")))
    rules = checkpointed(cut.select("skel").distinct().withColumn("rule", _resolve_all("skel")))
    ruled = cut.join(broadcast_if_small(rules.where(F.size("rule") >= least)), "skel")
    items = F.transform("rule", lambda r: unquote(strip(F.array_join(F.slice("toks", r[0], r[1]), ""))))
    return ruled.select("table_name", "row_key", "column_name", F.posexplode(items).alias("p", "item")).select(
        "table_name", "row_key", "column_name", (F.col("p") + 1).cast("int").alias("pos"), "item"
    )


def several(cells: DataFrame) -> DataFrame:
    """``split_packed`` for cells that hold two or more values."""
    return split_packed(cells, 2)


def pack(items: DataFrame, delimiter: str = " | ") -> DataFrame:
    """The inverse: values of each cell in order, joined; values that hold the delimiter or a quote are quoted."""
    quoted = F.when(F.col("item").rlike(r"[|;,\"\n\t]"), F.concat(F.lit('"'), F.replace("item", F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col("item"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", quoted.alias("v"))))
    return items.groupBy("table_name", "row_key", "column_name").agg(F.array_join(F.transform(ordered, lambda x: x["v"]), delimiter).alias("cell"))
