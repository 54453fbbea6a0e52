"""Evaluation texts inside training texts: documents that hold a passage of a test item, by size-partitioned MinHash containment.

A passage is ``words`` consecutive words of an item (twelve), its set the eight five-word shingles in it. Whether a set Q of
q shingles lies in a set X of x shingles shows in their MinHash values: the least hash of X is that of Q with probability
q / x. Against a whole document that is next to nothing, so the sets of documents are partitioned by size: short documents
are one set of up to 8 or up to 12 shingles, longer ones blocks of up to 16 shingles that overlap by seven, so that every
passage lies whole in a block. Each size class has as many hash functions as it takes for a miss below ``MISS`` (1, 13 and 20;
every function is a band of its own), and a passage has the signature of all of them. Passages with repeated shingles have
smaller sets, for which that bound does not hold; they are looked up by the hash of the whole passage instead.

Values of documents first pass a Bloom filter of the items' values, whose size is fixed, so nearly all of them end where they
are computed; the few left are joined by equality, and every pair that meets is verified by the exact words of the passage
inside the exact words of the block. Words are hashed once and combined by rolling arithmetic over a whole Arrow batch.

Words are runs of letters and digits; case, accents and what stands between words don't matter. Null, empty and short
texts hold nothing; items of fewer than twelve words are never found. Repeated documents are found each by its own id.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.memo import memo
from tidewright.session import broadcast_if_small, checkpointed

WORDS = 12
SHINGLE = 5
#: Bound on the probability that a passage and the block that holds it share no value.
MISS = 1e-6
#: Size classes of document sets, as multiples of the number of shingles of a passage.
CLASSES = (1.0, 1.5, 2.0)
#: Bits of the Bloom filter: 2 MB, whatever the number of items.
BLOOM_BITS = 1 << 24

_WORD = re.compile(r"[^\W_]+")
_TURN = np.uint64(0x9E3779B97F4A7C15)


@memo
def _marks() -> re.Pattern:
    """Combining marks of the basic plane."""
    return re.compile("[" + "".join(re.escape(chr(c)) for c in range(0x300, 0x10000) if unicodedata.combining(chr(c))) + "]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, lower case, without accents, ß as ss."""
    if not text:
        return []
    s = text.lower()
    if not s.isascii():
        s = _marks().sub("", unicodedata.normalize("NFKD", s.replace("ß", "ss")))
    return _WORD.findall(s)


def functions_of(size: float, passage: int, miss: float = MISS) -> int:
    """Hash functions that sets of up to ``size`` shingles need, so that a passage inside is missed with probability ``miss``."""
    return 1 if size <= passage else math.ceil(math.log(miss) / math.log(1 - passage / size))


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """The hash function number ``seed``."""
    x = (h ^ np.uint64(seed * 0x2545F4914F6CDD1D % 2**64)) * _TURN
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Batch:
    """Words and shingle hashes of a batch of texts."""

    def __init__(self, texts: list[str], n_words: int, shingle: int) -> None:
        self.words = [words(t) for t in texts]
        self.n_words, self.shingle, self.q = n_words, shingle, n_words - shingle + 1
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        codes, unique = pd.factorize(np.array(list(chain.from_iterable(self.words)), dtype=object))
        hashed = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in unique], dtype=np.uint64)
        self.h = np.concatenate([hashed[codes] if len(codes) else hashed, np.zeros(n_words, dtype=np.uint64)])
        self.shingles = self._rolled(shingle)
        self.n = np.where(sizes >= n_words, sizes - shingle + 1, 0)

    def _rolled(self, length: int) -> np.ndarray:
        out = np.zeros(len(self.h) - length + 1, dtype=np.uint64)
        for k in range(length):
            out = out * np.uint64(0x100000001B3) + _mixed(self.h[k : len(out) + k], 1)
        return out

    def minima(self, first: np.ndarray, last: np.ndarray, n_functions: int) -> np.ndarray:
        """(sets, functions): least values of the shingles from ``first`` up to before ``last``."""
        at = np.stack([first, last], axis=1).ravel()
        out = np.empty((len(first), n_functions), dtype=np.uint64)
        for f in range(n_functions):
            out[:, f] = np.minimum.reduceat(np.append(_mixed(self.shingles, f + 2), np.uint64(2**64 - 1)), at)[::2] if len(at) else 0
        return out

    def repeating(self) -> tuple[np.ndarray, np.ndarray]:
        """(first words, values) of the passages in which a shingle stands twice."""
        near = np.zeros(len(self.shingles), dtype=bool)  # equal to one of the q - 1 shingles before
        gap = np.full(len(self.shingles), self.q, dtype=np.int64)
        for lag in range(self.q - 1, 0, -1):
            same = self.shingles[lag:] == self.shingles[:-lag]
            near[lag:] |= same
            gap[lag:][same] = lag
        starts = [np.arange(self.at[i], self.at[i] + self.n[i] - self.q + 1) for i in np.nonzero(self.n)[0]]
        starts = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
        if not near.any() or not len(starts):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        # A passage from s repeats if some shingle k in it has its twin at k - gap >= s.
        twin = np.where(near, np.arange(len(near)) - gap, -1)
        padded = np.append(twin, np.full(self.q, -1))
        latest = np.maximum.reduce([padded[k : k + len(twin)] for k in range(self.q)])
        starts = starts[latest[starts] >= starts]
        return starts, _mixed(self._rolled(self.n_words)[starts], 0)

    def passage(self, i: int, first: int, last: int) -> str:
        """Words of text ``i`` that the shingles from ``first`` up to before ``last`` cover."""
        a = first - self.at[i]
        return " ".join(self.words[i][a : a + last - first + self.shingle - 1])


_PIECES = T.ArrayType(T.StructType([T.StructField("value", T.LongType()), T.StructField("passage", T.StringType())]))


def _item_values(n_words: int, shingle: int, n_functions: int) -> Callable:
    @F.pandas_udf(_PIECES)
    def values(texts: pd.Series) -> pd.Series:
        b = _Batch(list(texts), n_words, shingle)
        repeated = dict(zip(*(x.tolist() for x in b.repeating()), strict=True))
        out = []
        for i in range(len(b.words)):
            first = b.at[i] + np.arange(max(b.n[i] - b.q + 1, 0))
            least = b.minima(first, first + b.q, n_functions).view(np.int64).tolist()
            rows = []
            for s, signature in zip(first.tolist(), least, strict=True):
                text = b.passage(i, s, s + b.q)
                rows += [(np.uint64(repeated[s]).astype(np.int64).item(), text)] if s in repeated else [(v, text) for v in signature]
            out.append(list(dict.fromkeys(rows)))
        return pd.Series(out)

    return values


def _block_values(n_words: int, shingle: int, bloom: np.ndarray) -> Callable:
    q = n_words - shingle + 1
    sizes = [int(q * c) for c in CLASSES]
    needed = np.array([functions_of(s, q) for s in sizes])
    step = sizes[-1] - q + 1

    @F.pandas_udf(_PIECES)
    def values(texts: pd.Series) -> pd.Series:
        b = _Batch(list(texts), n_words, shingle)
        doc, first = [], []
        for i in np.nonzero(b.n)[0]:
            starts = np.arange(0, max(b.n[i] - sizes[-1] + step, 1), step)
            doc.append(np.full(len(starts), i))
            first.append(b.at[i] + starts)
        out: list[list] = [[] for _ in b.words]
        if not doc:
            return pd.Series(out)
        doc_, first_ = np.concatenate(doc), np.concatenate(first)
        last_ = np.minimum(first_ + sizes[-1], (b.at[:-1] + b.n)[doc_])
        least = b.minima(first_, last_, int(needed.max()))
        used = np.arange(least.shape[1])[None, :] < needed[np.searchsorted(sizes, last_ - first_)][:, None]
        bit = least & np.uint64(BLOOM_BITS - 1)
        hit = used & ((bloom[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        for k, f in zip(*np.nonzero(hit), strict=True):
            out[doc_[k]].append((int(least[k, f].astype(np.int64)), b.passage(doc_[k], first_[k], last_[k])))
        starts, whole = b.repeating()
        bit = whole & np.uint64(BLOOM_BITS - 1)
        hit = ((bloom[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        for s, v in zip(starts[hit].tolist(), whole[hit].astype(np.int64).tolist(), strict=True):
            i = int(np.searchsorted(b.at, s, side="right")) - 1
            out[i].append((v, b.passage(i, s, s + q)))
        return pd.Series([list(dict.fromkeys(x)) for x in out])

    return values


@F.pandas_udf(T.BinaryType())
def _bitmap(parts: pd.Series) -> pd.Series:
    """Places 0 to 8191 as a bitmap of 1024 bytes."""

    def one(places) -> bytes:  # noqa: ANN001
        bits = np.zeros(8192, dtype=np.uint8)
        bits[np.asarray(places, dtype=np.int64)] = 1
        return np.packbits(bits, bitorder="little").tobytes()

    return parts.map(one)


def bloom_filter(values: DataFrame) -> np.ndarray:
    """Bitmap of the low bits of ``value``. At most ``BLOOM_BITS`` bits reach the driver, as 1024-byte rows."""
    low = F.col("value").bitwiseAND(F.lit(BLOOM_BITS - 1))
    parts = values.select(F.shiftright(low, 13).cast("int").alias("part"), low.bitwiseAND(F.lit(8191)).cast("int").alias("place")).distinct()
    out = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
    for r in parts.groupBy("part").agg(F.collect_list("place").alias("places")).select("part", _bitmap("places").alias("bits")).collect():
        out[r.part * 1024 : (r.part + 1) * 1024] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def item_signatures(items: DataFrame, key: str, text: str, n_words: int = WORDS, shingle: int = SHINGLE) -> DataFrame:
    """(value, key, window): the values of every passage of every item."""
    q = n_words - shingle + 1
    values = _item_values(n_words, shingle, functions_of(int(q * CLASSES[-1]), q))
    found = items.select(key, F.explode(values(F.col(text))).alias("x"))
    return found.select("x.value", key, F.col("x.passage").alias("window")).distinct()


def leaks(docs: DataFrame, doc_key: str, items: DataFrame, item_key: str, text: str = "text", n_words: int = WORDS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_key, item_key): documents that hold ``n_words`` or more consecutive words of an item.

    The item side is broadcast while it is small (``session.broadcast_if_small``); beyond that the join shuffles the values that
    passed the filter and the engine splits hot ones.
    """
    queries = checkpointed(item_signatures(items, item_key, text, n_words, shingle))
    values = _block_values(n_words, shingle, bloom_filter(queries))
    met = docs.select(doc_key, F.explode(values(F.col(text))).alias("x")).select(doc_key, "x.value", "x.passage").join(broadcast_if_small(queries), "value")
    inside = F.concat(F.lit(" "), "passage", F.lit(" ")).contains(F.concat(F.lit(" "), "window", F.lit(" ")))
    return met.where(inside).select(doc_key, item_key).distinct()
