"""Text that was decoded with the wrong character encoding: find it and restore it.

Every legacy code page gives a table from character to byte. A text is mapped back through a table and an automaton over
the bytes (lead byte C2-F4 with its number of continuation bytes 80-BF) marks the maximal spans that are well-formed
UTF-8 of two or more bytes; only those spans are decoded, the rest of the text stays as it is. Repeated passes undo text
that was damaged twice. Three kinds of damage leave no multibyte spans and are recognised beside the automaton: a single
byte text read in another code page (its letters turn into symbols, box lines, Greek or Cyrillic inside Latin words),
byte pairs read as UTF-16, and letters lost to ``?`` or U+FFFD, which are reported but can't be restored.

A JVM regular expression generated from the same tables selects the cells that can be damaged at all; only those pass
through the Arrow-batched function. Null and empty cells are never damaged. Rows are independent: no shuffle.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.memo import memo

# Code pages that texts are commonly misread in.
CODE_PAGES = ["cp1252", "cp850", "cp437", "mac_roman", "cp1251"]
# Letters of the languages at hand that prove a misread single-byte text, and what they are read as.
TELLING = "äöüÄÖÜßé"
MAX_PASSES = 4


@memo
def byte_table(page: str) -> dict[str, int]:
    """Character to byte for the upper half of a code page; undefined bytes stand for the C1 control of the same number."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            table[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            table[chr(b)] = b
    if page == "cp1252":  # also texts decoded as latin-1
        for b in range(0x80, 0xA0):
            table.setdefault(chr(b), b)
    return table


def _need(lead: int) -> int:
    """Continuation bytes that a lead byte asks for; 0 if it is no lead byte."""
    return 1 if 0xC2 <= lead <= 0xDF else 2 if 0xE0 <= lead <= 0xEF else 3 if 0xF0 <= lead <= 0xF4 else 0


def well_formed_spans(text: str, page: str) -> list[tuple[int, int, str]]:
    """Maximal spans (start, end, decoded) of ``text`` that are well-formed multibyte UTF-8 in the bytes of ``page``."""
    table, spans, i, n = byte_table(page), [], 0, len(text)
    while i < n:
        start, out = i, []
        while i < n and (need := _need(table.get(text[i], 0))):
            part = [table.get(c, 0) for c in text[i : i + need + 1]]
            if len(part) <= need or any(not 0x80 <= b <= 0xBF for b in part[1:]):
                break
            try:
                out.append(bytes(part).decode("utf-8"))
            except UnicodeDecodeError:
                break
            i += need + 1
        if out and _plausible(text, start, i, "".join(out)):
            spans.append((start, i, "".join(out)))
        i = max(i, start + 1)
    return spans


def _script(char: str) -> str:
    return unicodedata.name(char, "").partition(" ")[0] if char.isalpha() else ""


def _plausible(text: str, start: int, end: int, decoded: str) -> bool:
    """Not by chance: decoded characters are assigned and in use, and a lone letter fits the script of its surroundings."""
    if any(unicodedata.category(c) in ("Cn", "Co", "Cs") or 0x180 <= ord(c) < 0x300 for c in decoded):
        return False
    before = text[start - 1] if start else ""
    after = text[end] if end < len(text) else ""
    if len(decoded) > 1:
        return True
    scripts = {_script(c) for c in (before, after) if c} - {""}
    own = _script(decoded)
    if own and own != "LATIN":
        return own in scripts  # a single letter of another script would stand among its like
    return "CYRILLIC" not in scripts or _script(text[start]) != "CYRILLIC"


def decode_spans(text: str) -> str:
    """``text`` with the spans of its best-fitting code page decoded, again until nothing changes."""
    for _ in range(MAX_PASSES):
        best = max(((well_formed_spans(text, p), -k, p) for k, p in enumerate(CODE_PAGES)), key=lambda x: (sum(e - s for s, e, _ in x[0]), x[1]))[0]
        if not best:
            break
        for s, e, decoded in reversed(best):
            text = text[:s] + decoded + text[e:]
    return text


@memo
def _misread(page: str) -> dict[str, str]:
    """Character of ``page`` to what the same byte means in cp1252."""
    out = {}
    for char, b in byte_table(page).items():
        try:
            out[char] = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            continue
    return out


@memo
def _telling_pattern(page: str) -> re.Pattern:
    """Within a Latin word, or at its beginning: a character that isn't Latin but means a telling letter."""
    marks = [c for c, r in _misread(page).items() if r in TELLING and _script(c) != "LATIN"]
    extra = "|(?<=[A-Za-z])õ(?=[A-DF-Za-df-z])|(?<=[A-Z])Í(?=[A-Z])" if page == "cp850" else ""
    inside = "".join(map(re.escape, marks))
    latin = "A-Za-zÀ-ÖØ-öø-žﬁﬂ"
    return re.compile(rf"(?<=[{latin}])[{inside}](?=[{latin}{inside}])|(?<![\w{inside}])[{inside}](?=[{latin}]{{2}}){extra}")


def reread(text: str) -> str:
    """A single-byte text read in another code page, read as cp1252; unchanged without evidence."""
    wide = [c for c in text if c > "\x7f"]
    scores = ((len(_telling_pattern(p).findall(text)), sum(c in _misread(p) for c in wide), -k, p) for k, p in enumerate(CODE_PAGES[1:]))
    best = max(scores, key=lambda x: x[:3])
    if not best[0]:
        return text
    back = _misread(best[3])
    return "".join(back.get(c, c) for c in text)


_WIDE = re.compile(r"[^\x00-\xff]{3,}")


def unpair(text: str) -> str:
    """Runs of characters that are byte pairs of a Latin text, read as that text."""

    def run(m: re.Match) -> str:
        for order in ("utf-16-le", "utf-16-be"):
            raw = m[0].encode(order, "surrogatepass")
            plain = sum(32 <= b < 127 for b in raw)
            letters = sum(chr(b).isalpha() or b == 32 for b in raw if b < 127)
            if plain >= 0.75 * len(raw) and letters >= 0.6 * len(raw) and all(b >= 32 for b in raw):
                return raw.decode("cp1252", "replace")
        return m[0]

    return _WIDE.sub(run, text)


_LOST = re.compile(r"�|(?<![\w?])\?+(?=[^\W\d_]{2})|(?<=[^\W\d_])\?+(?=[^\W\d_])")

def lost_letters(text: str) -> bool:
    """A letter was replaced by U+FFFD, or by ``?`` inside or at the head of a word that is no web address."""
    if "�" in text:
        return True
    if "?" not in text:
        return False
    words = (w for w in text.split() if "?" in w and not ("/" in w or "=" in w or "@" in w or "." in w.rstrip(".")))
    return any(_LOST.search(w) for w in words)


def restore(text: str | None) -> tuple[bool, str | None]:
    """(damaged, restored text); the restored text is null where nothing could be restored."""
    if not text:
        return False, None
    fixed = decode_spans(text)
    if fixed == text:
        fixed = reread(text)
    if fixed == text:
        fixed = unpair(text)
    damaged = fixed != text or lost_letters(text) or bool(re.search(r"[\x80-\x84\x86-\x9f]", text))
    return damaged, fixed if fixed != text else None


@F.pandas_udf(T.StructType([T.StructField("damaged", T.BooleanType()), T.StructField("restored", T.StringType())]))
def _restore_all(texts: pd.Series) -> pd.DataFrame:
    seen: dict[str | None, tuple[bool, str | None]] = {}
    return pd.DataFrame([seen.setdefault(t, r) if (r := seen.get(t)) else seen.setdefault(t, restore(t)) for t in texts], columns=["damaged", "restored"])


def _java_class(chars: set[str]) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in sorted(chars))


@memo
def suspect_pattern() -> str:
    """Java pattern that every damaged cell matches: lead and continuation character of one code page side by side, a
    telling character beside a letter, a run of wide characters, U+FFFD or C1 controls, or ``?`` before a letter."""
    parts = []
    for page in CODE_PAGES:
        table = byte_table(page)
        lead = {c for c, b in table.items() if _need(b)}
        tail = {c for c, b in table.items() if 0x80 <= b <= 0xBF}
        parts.append(f"[{_java_class(lead)}][{_java_class(tail)}]")
    telling = {c for p in CODE_PAGES[1:] for c, r in _misread(p).items() if r in TELLING and _script(c) != "LATIN"} | {"õ", "Í"}
    parts.append(f"[{_java_class(telling)}]\\p{{IsLatin}}|\\p{{IsLatin}}[{_java_class(telling)}]")
    parts.append(r"[^\x00-\xff]{3}|[\x{80}-\x{84}\x{86}-\x{9f}\x{fffd}]|\?\p{L}")
    return "|".join(parts)


def damaged_cells(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column_name, text, restored) of every damaged cell of ``columns``; ``restored`` null where nothing helps."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("text")) for c in columns])
    suspects = F.filter(cells, lambda c: c["text"].rlike(suspect_pattern()))
    rows = df.select(key, F.explode(suspects).alias("cell")).select(key, "cell.column_name", "cell.text")
    checked = rows.withColumn("r", _restore_all("text"))
    return checked.where("r.damaged").select(key, "column_name", "text", F.col("r.restored").alias("restored"))


def repaired(text: Column) -> Column:
    """The text with damage undone where possible, else as it is."""
    return F.when(text.rlike(suspect_pattern()), F.coalesce(_restore_all(text)["restored"], text)).otherwise(text)
