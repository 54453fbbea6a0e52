"""Byte-level BPE of a whole corpus inside the JVM.

A text is cut into words by the tokenizer's public pattern. Words that are tokens get their id at once. All others are
made distinct over the corpus and encoded once each: the bytes of the word are an array of pieces and a fold merges, step
by step, the adjacent pair of the lowest rank. Ranks come from a literal of the plan: an array of small maps, addressed by
the CRC of the piece, so a lookup scans about a dozen entries instead of the whole vocabulary. The encoded words are joined
back to their places. Pieces are the hexadecimal text of their bytes; decoding concatenates them and turns them into bytes.

Null and empty texts have an empty list. Special tokens are never produced; their strings are ordinary text. Texts and words
of any length are encoded whole. Rows that repeat a doc_id keep their own texts.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import checkpointed

#: Folder of the public vocabulary files; a parameter, never copied.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BUCKETS = 8192
#: Bytes of a word up to which it is encoded by the fold.
LONG = 512
#: Stands for "no such pair".
NONE = 2**31 - 1

#: Fixed value: the public word pattern of this tokenizer family, with white space as Unicode has it.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"


def read_ranks(name: str = "byte_bpe_50k", folder: str | None = None) -> dict[bytes, int]:
    """Token bytes to rank, which is also the id. The number of entries is fixed by the vocabulary file."""
    with open(os.path.join(folder or TOKENIZERS, f"{name}.tiktoken"), "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


@lru_cache(maxsize=4)
def _bucket_json(name: str, folder: str) -> str:
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in read_ranks(name, folder).items():
        key = token.hex().upper()
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return json.dumps(buckets, separators=(",", ":"))


def rank_literal(name: str = "byte_bpe_50k", folder: str | None = None) -> Column:
    """The rank map as a constant of the plan, folded once when the query is optimised."""
    return F.from_json(F.lit(_bucket_json(name, folder or TOKENIZERS)), "array<map<string,int>>")


def rank(piece: Column, ranks: Column) -> Column:
    """Rank of a piece (hexadecimal text), null if it is no token."""
    return F.element_at(F.element_at(ranks, (F.crc32(piece.cast("binary")) % BUCKETS + 1).cast("int")), piece)


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def merge(pieces: Column, ranks: Column) -> Column:
    """Fold over an array of pieces: merge the adjacent pair of the lowest rank, the leftmost of equals, until none is left."""

    def pair(a: Column, b: Column) -> Column:
        return F.coalesce(rank(F.concat(a, b), ranks), F.lit(NONE))

    def step(acc: Column, _: Column) -> Column:
        best = F.array_min(acc["r"])

        def merged(i: Column) -> Column:
            p, r = acc["p"], acc["r"]

            def joined(m: Column) -> Column:
                left = F.when(i > 1, F.array(pair(F.element_at(p, F.greatest(i - 1, F.lit(1))), m))).otherwise(F.array().cast("array<int>"))
                right = F.when(i + 1 < F.size(p), F.array(pair(m, F.element_at(p, F.least(i + 2, F.size(p)))))).otherwise(F.array().cast("array<int>"))
                return F.struct(
                    F.concat(F.slice(p, 1, i - 1), F.array(m), F.slice(p, i + 2, F.size(p))).alias("p"),
                    F.concat(F.slice(r, 1, F.greatest(i - 2, F.lit(0))), left, right, F.slice(r, i + 2, F.size(p))).alias("r"),
                )

            return _let(F.concat(F.element_at(p, i), F.element_at(p, i + 1)), joined)

        return F.when(F.coalesce(best, F.lit(NONE)) == NONE, acc).otherwise(_let(F.array_position(acc["r"], best).cast("int"), merged))

    def fold(p: Column) -> Column:
        none = F.array().cast("array<int>")
        pairs = F.when(F.size(p) > 1, F.transform(F.slice(p, 1, F.size(p) - 1), lambda a, i: pair(a, F.element_at(p, i + 2)))).otherwise(none)
        steps = F.when(F.size(p) > 1, F.sequence(F.lit(1), F.size(p) - 1)).otherwise(none)
        return F.aggregate(steps, F.struct(p.alias("p"), pairs.alias("r")), step, lambda acc: acc["p"])

    return _let(pieces, fold)


def word_bytes(word: Column) -> Column:
    """The bytes of a word as an array of pieces."""
    h = F.hex(F.encode(word, "utf-8"))
    return F.transform(F.sequence(F.lit(1), F.length(h), F.lit(2)), lambda i: F.substr(h, i, F.lit(2)))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a word of any length: pairs wait in a heap, so n bytes take about n log n steps."""
    n = len(word)
    piece: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i]
        if piece[i] is None or j >= n or len(piece[i]) + len(piece[j]) != size:
            continue
        piece[i], piece[j] = piece[i] + piece[j], None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n:
                pair = piece[k] + piece[after[k]]
                if (r := ranks.get(pair)) is not None:
                    heapq.heappush(heap, (r, k, len(pair)))
    return [ranks[x] for x in piece if x is not None]


def _long_words(ranks: dict[bytes, int]):  # noqa: ANN202
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(words: pd.Series) -> pd.Series:
        return words.map(lambda w: merge_long(w.encode("utf-8"), ranks))

    return ids


def encode_words(words: DataFrame, ranks: Column, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(word, ids) for distinct non-empty words. A step of the fold copies the pieces, so a word of n bytes costs n * n; words
    beyond ``LONG`` bytes, which natural text doesn't have, are merged through a heap."""
    short = words.where(F.octet_length("word") <= LONG).withColumn("_p", merge(word_bytes(F.col("word")), ranks)).select("word", F.transform("_p", lambda p: rank(p, ranks)).alias("ids"))
    long = words.where(F.octet_length("word") > LONG).select("word", _long_words(read_ranks(name, folder))("word").alias("ids"))
    return short.unionByName(long)


def encode(docs: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(key, ids) for every row of ``docs``.

    Each text is cut once; what is kept of it are the ids of words that are tokens and the other words with their places.
    Only these other words are shuffled, to meet their encoding, and documents that have any meet their ids again by row
    number. Frequent words are tokens, so the words that shuffle have no heavy hitters by nature; where one has, the engine
    splits the skewed join partition. Texts are never shuffled.
    """
    ranks = rank_literal(name, folder)
    cut = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(PATTERN), F.lit(0))
    known = lambda w: rank(F.hex(F.encode(w, "utf-8")), ranks)
    marked = F.transform(cut, lambda w: _let(known(w), lambda k: F.struct(k.alias("id"), F.when(k.isNull(), w).alias("word"))))
    source = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), marked.alias("m"))
    others = F.filter(F.transform("m", lambda x, i: F.struct(i.alias("pos"), x["word"].alias("word"))), lambda x: x["word"].isNotNull())
    rows = checkpointed(source.select("_row", "_key", F.transform("m", lambda x: x["id"]).alias("known"), others.alias("others")))
    rare = rows.select("_row", F.explode("others").alias("x")).select("_row", "x.*")
    encoded = encode_words(rare.select("word").distinct(), ranks, name, folder)
    placed = rare.join(encoded, "word").select("_row", F.lit(None).cast("array<int>").alias("known"), F.struct("pos", "ids").alias("x"))
    mixed = rows.where(F.size("others") > 0).select("_row", "_key", "known", F.lit(None).cast("struct<pos:int,ids:array<int>>").alias("x"))
    placed = placed.select("_row", F.lit(None).cast(rows.schema["_key"].dataType).alias("_key"), "known", "x")
    gathered = mixed.unionByName(placed).groupBy("_row").agg(F.first("_key", True).alias("_key"), F.first("known", True).alias("known"), F.collect_list("x").alias("x"))
    told = F.filter(F.transform("known", lambda k, i: F.struct(i.alias("pos"), F.array(k).alias("ids"))), lambda y: y["ids"][0].isNotNull())
    ids = F.flatten(F.transform(F.array_sort(F.concat(told, F.col("x"))), lambda y: y["ids"]))
    plain = rows.where(F.size("others") == 0).select(F.col("_key").alias(key), F.col("known").alias("ids"))
    return gathered.select(F.col("_key").alias(key), ids.alias("ids")).unionByName(plain)


def decode(tokens: DataFrame, key: str, ids: str = "ids", name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(key, text): the bytes of the ids, concatenated, as text."""
    ordered = [t.hex().upper() for t, _ in sorted(read_ranks(name, folder).items(), key=lambda x: x[1])]
    pieces = F.from_json(F.lit(json.dumps(ordered)), "array<string>")
    joined = F.array_join(F.transform(ids, lambda i: F.element_at(pieces, i + 1)), "")
    return tokens.select(key, F.decode(F.unhex(joined), "utf-8").alias("text"))
