"""Benchmark decontamination with spaced seeds.

A seed mask such as ``1110111`` looks at a window of words and ignores those under
a 0, so a substituted word there does not spoil the match.  Every window of every
benchmark item is hashed under every mask and joined with the same hashes of the
documents; each hit fixes an alignment (a diagonal), along which the overlap is
verified word by word: a stretch counts if it has at least ``min_words`` equal
words (a whole item, if shorter) and ``min_identity`` of its words are equal.  Of
a diagonal the stretch with the most matches over mismatches is reported if it
counts, else the longest one that does.

The benchmark is cut by hash into blocks of about ``block_bytes`` of text.  One
block at a time is sent to the tasks, whatever the benchmark's size; the documents
are never shuffled and their seeds are joined where they are made.

Words are runs of ASCII letters and digits or of non-ASCII characters, A-Z
lower-cased; non-ASCII punctuation and blanks part words, and every character of
a script that is written without blanks (Chinese characters, kana, Thai, Lao,
Tibetan, Burmese, Khmer) is a word.  Edge cases: null or empty texts overlap with
nothing; items with fewer than ``SHORTEST`` words are searched as a whole, every
word equal, and those without words not at all; equal items are reported each; rows that share an id are searched each and equal
overlaps reported once; a null id is carried along; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acqlens.llm.common import (U64, WORD_HASHES, free_name, mix, remembered, slices, stored, stretches,
                                utf8, working)

# Fixed masks of six words each: whole, and with gaps that skip every third,
# fourth or fifth word, neighbours, or scattered words.
MASKS = ("111111", "1110111", "11011011", "1111011", "110100111", "1010101011")
SHORTEST = 6
# Fixed masks of shorter items: all of one to five words.
_WHOLE = tuple("1" * n for n in range(1, SHORTEST))
OVERLAP = ("doc_id long, item_id long, doc_word int, item_word int, n_words int, n_equal int")

_AS_WORDS = bytes(c if c >= 128 or 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32
                  for c in range(256))
# Fixed ranges: letters of scripts without blanks.
_ALONE = re.compile("[\u0e01-\u0eff\u0f00\u0f18-\u0fbc\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3021-\u3029"
                    "\u3031-\u3035\u3041-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff"
                    "\uff66-\uff9f\U00020000-\U0003ffff]")
_BREAKS = re.compile("[%s]" % "".join(
    c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c)[0] in "PZ"))


class _Several(dict):
    """non-ASCII run -> whether it is to be parted, remembered for short ones."""

    def __missing__(self, run: bytes) -> bool:
        plain = run.decode("utf-8", "surrogateescape")
        several = bool(_BREAKS.search(plain) or _ALONE.search(plain))
        if len(run) <= 64:
            if len(self) >= 100_000:
                self.clear()
            self[run] = several
        return several


_SEVERAL = remembered("word hashes", _Several())


def _parted(run: bytes) -> list[bytes]:
    """The words of a run: parted at punctuation and around single characters."""
    plain = _BREAKS.sub(" ", run.decode("utf-8", "surrogateescape"))
    return _ALONE.sub(r" \g<0> ", plain).encode("utf-8", "surrogateescape").split()


def _split(text: bytes) -> list[bytes]:
    runs = text.translate(_AS_WORDS).split()
    if text.isascii():
        return runs
    several = {r for r in set(runs) if not r.isascii() and _SEVERAL[r]}
    if not several:
        return runs
    return [w for r in runs for w in (_parted(r) if r in several else (r,))]


def words(text: bytes) -> np.ndarray:
    return np.concatenate([WORD_HASHES.of(_split(part)) for part in stretches(text)])


def seeds(ids: np.ndarray, mask: int) -> np.ndarray:
    """The hash under mask number ``mask`` of every window of ``ids``."""
    shape = (MASKS + _WHOLE)[mask]
    places = [k for k, c in enumerate(shape) if c == "1"]
    n = len(ids) - len(shape) + 1
    if n <= 0:
        return np.zeros(0, U64)
    h = np.full(n, mask + 1, U64)
    for k in places:
        h = (h ^ ids[k:k + n]) * U64(0x9E3779B97F4A7C15)
        h ^= h >> U64(29)
    return mix(h)


class SeedIndex:
    """The seeds of one block of items, in hash order."""

    def __init__(self, items: list[tuple[int, bytes]], filter_bits: int = 22):
        self.items = [(i, w) for i, t in items if len(w := words(t))]
        hashes, item, at, used = [], [], [], set()
        for k, (_, w) in enumerate(self.items):
            masks = range(len(MASKS)) if len(w) >= SHORTEST else [len(MASKS) + len(w) - 1]
            used.update(masks)
            for m in masks:
                h = seeds(w, m)
                hashes.append(h)
                item.append(np.full(len(h), k, np.int64))
                at.append(np.arange(len(h)))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        h = join(hashes, U64)
        order = np.argsort(h, kind="stable")
        self.hashes, self.item, self.at = h[order], join(item, np.int64)[order], join(at, np.int64)[order]
        self.masks = sorted(used)
        # most windows hash to nowhere: one look at a bit table tells
        self.low = U64((1 << filter_bits) - 1)
        self.some = np.zeros(1 << filter_bits, bool)
        self.some[(self.hashes & self.low).astype(np.int64)] = True

    def diagonals(self, ids: np.ndarray) -> set[tuple[int, int]]:
        """(item, document place of the item's first word) of all hits."""
        found = set()
        for m in self.masks:
            h = seeds(ids, m)
            near = np.flatnonzero(self.some[(h & self.low).astype(np.int64)])
            if not len(near):
                continue
            lo = np.searchsorted(self.hashes, h[near], "left")
            hi = np.searchsorted(self.hashes, h[near], "right")
            for p, a, b in zip(near[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                found.update(zip(self.item[a:b].tolist(), (p - self.at[a:b]).tolist()))
        return found

    def overlap(self, ids: np.ndarray, item: int, first: int, min_words: int,
                min_identity: float) -> tuple[int, int, int, int] | None:
        """(document word, item word, length, equal words) of the best stretch, or
        else of the longest between two equal words, that meets both limits."""
        other = self.items[item][1]
        a, b = max(0, -first), min(len(other), len(ids) - first)
        equal = ids[first + a:first + b] == other[a:b]
        least, places = min(min_words, len(other)), np.flatnonzero(equal)
        if len(places) < least:
            return None
        total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -1))])
        rise = total - np.minimum.accumulate(total)
        end = int(rise.argmax())
        start = end - int(np.flatnonzero(rise[:end + 1][::-1] == 0)[0])
        n, hits = end - start, int(equal[start:end].sum())
        if hits < least or hits < min_identity * n:
            # equal words over what the identity asks for, before and after each
            # equal word; for each end the first start from which that did not fall
            share = Fraction(str(min_identity)).limit_denominator(1_000_000)
            k = np.arange(len(places))
            before = share.denominator * k - share.numerator * places
            after = before + (share.denominator - share.numerator)
            begin = np.searchsorted(-np.minimum.accumulate(before), -after)
            length = np.where(k + 1 - begin >= least, places + 1 - places[begin], 0)
            last = int(length.argmax())
            if not length[last]:
                return None
            start, n, hits = int(places[begin[last]]), int(length[last]), last + 1 - int(begin[last])
        return first + a + start, a + start, n, hits


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 10,
             min_identity: float = 0.7, block_bytes: int = 8 << 20, id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text") -> DataFrame:
    """One row a verified overlap between a document and a benchmark item."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"),
                             F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    found = []
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        sent = spark.sparkContext.broadcast(
            sorted(((r[0], r[1].encode()) for r in block.collect()), key=lambda r: (r[0] is not None, r)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            working("word hashes")
            index = SeedIndex(sent.value)
            for batch in batches:
                for part in slices(batch, 256, 1):
                    out = []
                    for doc, text in zip(part.column(0).to_pylist(), utf8(part.column(1))):
                        ids = words(text)
                        hits = {(index.items[item][0], *o) for item, first in index.diagonals(ids)
                                if (o := index.overlap(ids, item, first, min_words, min_identity))}
                        out += [(doc, item, at, q, n, e) for item, at, q, n, e in hits]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out), (
                                pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()))],
                            ["doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal"])

        found.append(rows.mapInArrow(run, OVERLAP))
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out.distinct()


def without_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                     **options) -> DataFrame:
    """``docs`` without the documents that overlap with an item."""
    name = free_name(docs, "llm_hit")
    hit = stored(overlaps(docs, benchmark, id_col=id_col, **options)
                 .select(F.col("doc_id").alias(name)).distinct(), "overlaps")
    return docs.join(hit, F.col(id_col).cast("long").eqNullSafe(F.col(name)), "left_anti")
