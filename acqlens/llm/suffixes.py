"""Suffix-array dedup: removes what repeats earlier in a corpus, by the byte.

A byte goes if a string of ``length`` bytes that covers it also starts earlier, in
a document with a smaller id or earlier in the same one.  Deciding that means
bringing equal strings together, which a distributed merge sort of suffixes does;
its volume is cut down in two steps that lose nothing.

1. *Anchors.*  The gram with the smallest hash among the grams of a string is its
   anchor.  Equal strings have equal anchors at equal offsets, and neighbouring
   starts mostly share theirs: the starts of one anchor are a segment, and only
   segments travel, about one in 30 bytes.
2. *Duplicate detection*, as in prefix-doubling string sorting.  Segments of equal
   anchor and equal text (64-bit hashes of both) repeat the first of them
   wholly; a segment whose anchor occurs in no other text repeats nothing.  Each
   task drops its own repeats before the shuffle.

What is left, the first occurrences of different texts around one anchor, is
sorted: their suffixes from the anchor on are sorted in each task, front-coded
and sent to the task that owns the anchor, where a loser tree that never compares
known prefixes merges the runs (``stringmerge``).  The shared lengths it returns
say, for every offset, which suffixes agree far enough to the right; agreement to
the left of the anchor is refined byte by byte; first occurrences per agreeing
set follow exactly.

*Hot anchors*, those with more than ``hot`` segments, would pile up in one task.
Their segments are taken apart into their strings, each sent by its own 128-bit
digest, again after dropping a task's own repeats.

Edge cases: null or empty text has no bytes; documents that share an id, and
those without one (which come first), are told apart and put in order by the hash
of their text; texts shorter than ``length`` stay whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from acqlens.llm.common import U64, bucketed, mix, slices, stored, utf8
from acqlens.llm.stringmerge import common, front_decode, merge

GRAM = 32
CHUNK = 1 << 20          # bytes hashed at a time
BLOCK = 500_000          # segments a task holds before it sends them
_POSITION_BITS = 22
_BASE = 0xD6E8FEB86659FD93
_LETTERS = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_LETTERS_2 = mix(_LETTERS + U64(0x632BE59BD9B4E019))
SEGMENT, WINDOW, REPEAT = 0, 1, 2


# -- hashes and segments of a stretch of bytes -----------------------------------

class Rolling:
    """Hashes of substrings by prefix sums of a polynomial over bytes."""

    up = down = np.zeros(0, U64)

    def __init__(self, data: np.ndarray, letters: np.ndarray = _LETTERS):
        n = len(data) + 1
        if n > len(Rolling.up):
            size = max(n, CHUNK + 4096)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(size, base, U64)
                powers[0] = 1
                setattr(Rolling, name, np.multiply.accumulate(powers))
        self.sums = np.zeros(n, U64)
        np.cumsum(letters[data] * Rolling.up[:n - 1], out=self.sums[1:])

    def at(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * Rolling.down[start])


def segments(data: np.ndarray, ends: np.ndarray, length: int):
    """Segments of the documents that lie in ``data`` one after the other and end
    at ``ends``: first start, last start, anchor, hash of the anchor."""
    n, roll = len(data) - length + 1, Rolling(data)
    if n <= 0:
        none = np.zeros(0, np.int64)
        return roll, none, none, none, np.zeros(0, U64)
    h = roll.at(slice(0, len(data) - GRAM + 1), slice(GRAM, len(data) + 1))
    low = U64((1 << _POSITION_BITS) - 1)
    window, width, span = h & ~low | np.arange(len(h), dtype=U64), 1, length - GRAM + 1
    while 2 * width <= span:
        window, width = np.minimum(window[:-width], window[width:]), 2 * width
    window = np.minimum(window[:n], window[span - width:span - width + n])
    anchor = (window & low).astype(np.int64)
    ok = np.ones(n, bool)  # the string of a start lies in one document
    for e in ends.tolist():
        ok[max(0, e - length + 1):min(n, e)] = False
    change = anchor[1:] != anchor[:-1]
    first, last = ok.copy(), ok.copy()
    first[1:] &= change | ~ok[:-1]
    last[:-1] &= change | ~ok[1:]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    return roll, lo, hi, anchor[lo], h[anchor[lo]]


def packed(lo: np.ndarray, offset: np.ndarray, kind: int, n: np.ndarray) -> np.ndarray:
    """First start, anchor's offset from it, kind and number of starts in 64 bits."""
    return lo << 17 | offset << 10 | kind << 8 | n


def unpacked(x: np.ndarray):
    return x >> 17, x >> 10 & 127, x >> 8 & 3, x & 255


def side_by_side(rows: Iterator[tuple[int, bytes]], length: int):
    """(data, ends, document of each end, place in the document of each begin):
    documents side by side, long ones in parts that overlap by a string."""
    held, size = [], 0

    def out():
        ends = np.cumsum([len(t) for _, _, t in held])
        return (np.frombuffer(b"".join(t for _, _, t in held), np.uint8), ends,
                np.array([d for d, _, _ in held], np.int64), np.array([b for _, b, _ in held], np.int64))

    for doc, text in rows:
        for begin in range(0, max(1, len(text) - length + 1), CHUNK):
            part = text[begin:begin + CHUNK + length - 1] if len(text) > CHUNK else text
            if size and size + len(part) > CHUNK:
                yield out()
                held, size = [], 0
            held.append((doc, begin, part))
            size += len(part)
    if held:
        yield out()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for part in slices(batch, 256, 1):
            yield from zip(part.column(0).to_pylist(), utf8(part.column(1)))


def _first_of_each(keys: list[np.ndarray], doc: np.ndarray, pack: np.ndarray):
    """Order by keys, document and place; which rows begin a new key in it."""
    order = np.lexsort((pack, doc, *reversed(keys)))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, new


def _segment_rows(data, ends, docs, begins, length):
    """(anchor's hash, text's hash, document, packed) of a stretch's segments."""
    roll, lo, hi, anchor, gram = segments(data, ends, length)
    where = np.searchsorted(ends, lo, "right")
    shift = begins[where] - np.concatenate([[0], ends])[where]
    text = mix(roll.at(lo, hi + length) + ((anchor - lo) << 8 | hi - lo).astype(U64))
    return roll, lo, hi, gram, text, docs[where], packed(lo + shift, anchor - lo, SEGMENT, hi - lo + 1), shift


# -- hot anchors -----------------------------------------------------------------

def hot_anchors(texts: DataFrame, length: int, hot: int, most: int = 100_000) -> np.ndarray:
    """Hashes of the anchors with over ``hot`` different texts around them.

    Each block of a task reports the anchors it met with two texts or more, and the
    counts are added up: what is not counted is at most one text a block.  (A text
    that stands in several blocks counts in each, so an anchor may be taken for hot
    early, which changes no result.)  At most the ``most`` most frequent are
    returned: any other anchor then has, besides one text a block, less than a
    ``most``-th of all segments and needs no splitting.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, hashes, size = [], [], 0

        def flush():
            g, t = np.concatenate(grams), np.concatenate(hashes)
            order = np.lexsort((t, g))
            g, t = g[order], t[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
            value, count = np.unique(g[new], return_counts=True)
            often = count > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(value[often].view("<i8")), pa.array(count[often])], ["gram", "n"])

        for part in side_by_side(_rows(batches), length):
            _, _, _, gram, text, *_ = _segment_rows(*part, length)
            grams.append(gram)
            hashes.append(text)
            size += len(gram)
            if size >= BLOCK:
                yield flush()
                grams, hashes, size = [], [], 0
        if size:
            yield flush()

    often = (texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
             .where(F.col("n") > hot).orderBy(F.col("n").desc(), "gram").limit(most))
    return np.sort(np.array([r["gram"] for r in often.collect()], np.int64)).view(U64)


# -- duplicate detection -----------------------------------------------------------

_ITEMS = ["route", "key", "doc", "pack"]


def items(texts: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    """(route, key, doc, pack): segments by anchor and text, strings of hot anchors
    by their digest, and what repeats within a task's block already marked so."""
    sent = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            route, key, doc, pack = (np.concatenate(c) for c in zip(*held))
            order, new = _first_of_each([route, key], doc, pack)
            route, key, doc, pack = (c[order] for c in (route, key, doc, pack))
            pack = np.where(new, pack, pack & ~np.int64(3 << 8) | REPEAT << 8)
            # repeats need no company: any task passes them on
            route = np.where(new, route, mix(doc.view(U64) + pack.view(U64)))
            for at in range(0, len(doc), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[at:at + 100_000].view("<i8")) for c in (route, key, doc, pack)], _ITEMS)

        for part in side_by_side(_rows(batches), length):
            roll, lo, hi, gram, text, doc, pack, shift = _segment_rows(*part, length)
            if len(sent.value) and len(gram):
                near = np.searchsorted(sent.value, gram)
                near[near == len(sent.value)] = 0
                is_hot = sent.value[near] == gram
                if is_hot.any():
                    n = (hi - lo + 1)[is_hot]
                    start = np.repeat(lo[is_hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    second = Rolling(part[0], _LETTERS_2)
                    place = start + np.repeat(shift[is_hot], n)
                    held.append((roll.at(start, start + length), second.at(start, start + length),
                                 np.repeat(doc[is_hot], n),
                                 packed(place, np.zeros_like(place), WINDOW, np.ones_like(place))))
                    gram, text, doc, pack = (c[~is_hot] for c in (gram, text, doc, pack))
                    size += len(start)
            held.append((gram, text, doc, pack))
            size += len(gram)
            if size >= BLOCK:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return texts.mapInArrow(run, "route long, key long, doc long, pack long")


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From items in order: repeats, and first segments whose anchor has others."""
    rest = None

    def groups(route, key, doc, pack):
        kind = pack >> 8 & 3
        new = np.ones(len(route), bool)
        new_route = new.copy()
        new_route[1:] = route[1:] != route[:-1]
        new[1:] = new_route[1:] | (key[1:] != key[:-1])
        number = np.cumsum(new_route) - 1
        texts = np.bincount(number, weights=new)
        repeat = ~new | (kind == REPEAT)
        unsure = new & (kind == SEGMENT) & (texts[number] > 1)
        pack = np.where(repeat, pack & ~np.int64(3 << 8) | REPEAT << 8, pack)
        keep = repeat | unsure
        return pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(pack[keep])], ["doc", "pack"])

    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            now = [np.concatenate(c) for c in zip(rest, now)]
        if not len(now[0]):
            continue
        whole = int(np.searchsorted(now[0], now[0][-1]))  # the last route may go on
        if whole:
            yield groups(*(c[:whole] for c in now))
        rest = [c[whole:] for c in now]
    if rest is not None:
        yield groups(*rest)


# -- sorting what is left ------------------------------------------------------------

_OPEN = pa.list_(pa.struct([("gram", pa.int64()), ("pack", pa.int64()), ("text", pa.binary())]))


def _opened(length: int):
    """Attaches the texts of the segments that are to be sorted; finishes the
    documents that have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, out = zstandard.ZstdDecompressor(), []
        schema = pa.schema([("doc", pa.int64()), ("z", pa.binary()), ("repeats", pa.list_(pa.int64())),
                            ("open", _OPEN), *_RESULT])
        held = 0
        for batch in batches:
            for part in slices(batch, 256):
                for doc, z, packs in zip(*(part.column(i).to_pylist() for i in range(3))):
                    text = unzip.decompress(z)
                    pack = np.array(packs or [], np.int64)
                    lo, offset, kind, n = unpacked(pack)
                    repeats = pack[kind == REPEAT]
                    row = {"doc": doc, "z": None, "repeats": None, "open": None}
                    opens = np.flatnonzero(kind == SEGMENT)
                    if len(opens):
                        row |= {"z": z, "repeats": repeats, "open": [
                            {"gram": xxhash.xxh3_64_intdigest(text[a + o:a + o + GRAM]) - (1 << 63), "pack": p,
                             "text": text[a:a + k - 1 + length]}
                            for a, o, k, p in zip(*(c[opens].tolist() for c in (lo, offset, n, pack)))]}
                    else:
                        row |= result(text, repeats, length)
                    out.append(row)
                    held += len(z)
                if held > 8 << 20 or len(out) > 2000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


_RUNS = ("bucket int, shared binary, sizes binary, rests binary, offsets binary, lefts binary, docs binary, "
         "packs binary")


def _sorted_runs(buckets: int, block: int = 100_000):
    """Front-coded sorted runs of a task's suffixes, one a bucket and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def flush():
            held.sort()
            at = 0
            while at < len(held):
                end, bucket = at, held[at][0]
                shared, rests, last = [], [], b""
                while end < len(held) and held[end][0] == bucket:
                    s = held[end][1]
                    shared.append(common(last, s, 0))
                    rests.append(s[shared[-1]:])
                    last = s
                    end += 1
                part = held[at:end]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket], pa.int32()),
                    "shared": [np.array(shared, np.uint8).tobytes()],
                    "sizes": [np.array([len(r) for r in rests], np.uint8).tobytes()],
                    "rests": [b"".join(rests)],
                    "offsets": [np.array([len(p[2]) for p in part], np.uint8).tobytes()],
                    "lefts": [b"".join(p[2] for p in part)],
                    "docs": [np.array([p[3] for p in part], "<i8").tobytes()],
                    "packs": [np.array([p[4] for p in part], "<i8").tobytes()]})
                at = end
            held.clear()

        for batch in batches:
            for doc, gram, pack, text in zip(*(c.to_pylist() for c in batch.columns)):
                offset = pack >> 10 & 127
                held.append((gram % buckets, text[offset:], text[:offset], doc, pack))
            if len(held) >= block:
                yield from flush()
        if held:
            yield from flush()

    return run


def _cut(sizes: np.ndarray, data: bytes) -> list[bytes]:
    ends = np.cumsum(sizes.astype(np.int64)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _merged(length: int):
    """Merges the runs of a bucket; gives the starts that repeat an earlier one."""

    def run(table: pa.Table) -> pa.Table:
        runs, lefts, docs, packs = [], [], [], []
        for r in table.to_pylist():
            shared = np.frombuffer(r["shared"], np.uint8)
            rests = _cut(np.frombuffer(r["sizes"], np.uint8), r["rests"])
            runs.append((shared.tolist(), front_decode(shared.tolist(), rests)))
            lefts.append(_cut(np.frombuffer(r["offsets"], np.uint8), r["lefts"]))
            docs.append(np.frombuffer(r["docs"], "<i8"))
            packs.append(np.frombuffer(r["packs"], "<i8"))
        of, at, shared = merge(runs)
        begin = np.cumsum([0, *map(len, docs)])[:-1]
        flat = begin[of] + at
        doc, pack = np.concatenate(docs)[flat], np.concatenate(packs)[flat]
        every = [x for part in lefts for x in part]
        lo, offset, _, n = unpacked(pack)
        found_doc, found_start = repeated_starts(shared, [every[i] for i in flat.tolist()], doc, lo, offset, n,
                                                 length)
        return pa.table({"doc": found_doc, "start": found_start})

    return run


def repeated_starts(shared: np.ndarray, lefts: list[bytes], doc: np.ndarray, lo: np.ndarray,
                    offset: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, with the length each shares with the one before: the
    (document, start) whose string another suffix holds at an earlier start.

    At distance d before the anchor, two strings are equal if the suffixes share
    length - d bytes and the d bytes to their left are equal.
    """
    most = int(offset.max(initial=0))
    before = np.zeros((len(doc), most + 1), np.int64)  # byte at distance d, from column 1
    for i, left in enumerate(lefts):
        before[i, 1:len(left) + 1] = np.frombuffer(left, np.uint8)[::-1]
    left_set, docs, starts = np.zeros(len(doc), np.int64), [], []
    for d in range(most + 1):
        if d:
            _, left_set = np.unique(left_set << 8 | before[:, d], return_inverse=True)
        right_set = np.cumsum(shared < length - d)
        use = np.flatnonzero((offset >= d) & (d > offset - n))
        if not len(use):
            continue
        start = (lo + offset - d)[use]
        key = right_set[use] * (len(doc) + 1) + left_set[use]
        order, new = _first_of_each([key], doc[use], start)
        docs.append(doc[use][order][~new])
        starts.append(start[order][~new])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(docs), join(starts)


# -- results -------------------------------------------------------------------------

_RESULT = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.int64())),
           ("kept_sha256", pa.string())]
REMOVED = "n_bytes long, n_removed long, n_spans long, spans array<long>, kept_sha256 string"


def result(text: bytes, repeats: np.ndarray, length: int) -> dict:
    """What is left of a text without the strings at the starts in ``repeats``
    (packed); ``spans`` are begin and end of each removed run, flat."""
    lo, _, _, n = unpacked(repeats)
    order = np.argsort(lo, kind="stable")
    begin, end = lo[order], np.maximum.accumulate((lo + n - 1 + length)[order]) if len(lo) else lo
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    begins, ends = begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)] if len(end) else end
    kept = hashlib.sha256()
    for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(text)]):
        kept.update(text[a:b])
    return {"n_bytes": len(text), "n_removed": int((ends - begins).sum()), "n_spans": len(begins),
            "spans": np.column_stack([begins, ends]).reshape(-1).tolist(), "kept_sha256": kept.hexdigest()}


def _finished(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        schema = pa.schema([("doc", pa.int64()), *_RESULT])
        for batch in batches:
            for part in slices(batch, 1000):
                out = []
                for row in part.to_pylist():
                    if row["z"] is not None:
                        starts = np.array(row.pop("starts") or [], np.int64)
                        ones = packed(starts, np.zeros_like(starts), REPEAT, np.ones_like(starts))
                        packs = np.concatenate([np.array(row["repeats"], np.int64), ones])
                        row |= result(unzip.decompress(row["z"]), packs, length)
                    out.append(row)
                yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(doc, doc_id, text) with ``doc`` unique and in the order of the ids, and
    whether it differs from the id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    doubtful = rows.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if doubtful.isEmpty():
        return rows.withColumn("doc", F.col("doc_id")), False
    return stored(rows.withColumn("h", F.xxhash64("text")).orderBy("doc_id", "h").drop("h")
                  .withColumn("doc", F.monotonically_increasing_id()), "numbered"), True


def dedup_bytes(docs: DataFrame, length: int = 100, hot: int = 4096, bucket_rows: int = 25_000,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256."""
    if not GRAM <= length <= 127:
        raise ValueError(f"length must be from {GRAM} to 127")
    rows, renumbered = _numbered(docs, id_col, text_col)
    texts = rows.select("doc", "text")
    order = ["route", "key", "doc", "pack"]
    found = stored(items(texts, length, hot_anchors(texts, length, hot)).repartition("route")
                   .sortWithinPartitions(*order).mapInArrow(_judged, "doc long, pack long"), "found")

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, 256, 1):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(squeeze.compress, utf8(part.column(1))), pa.binary())],
                    ["doc", "z"])

    packs = found.groupBy("doc").agg(F.collect_list("pack").alias("packs"))
    opened = (texts.mapInArrow(zipped, "doc long, z binary").join(packs, "doc", "left").select("doc", "z", "packs")
              .mapInArrow(_opened(length), "doc long, z binary, repeats array<long>, "
                          f"open array<struct<gram:long,pack:long,text:binary>>, {REMOVED}"))
    opened = bucketed(opened, "opened", "doc")
    waiting = opened.select("doc", F.explode("open").alias("o")).select("doc", "o.*")
    n = opened.agg(F.sum(F.size("open")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-max(0, n) // bucket_rows))
    repeated = (waiting.select("doc", "gram", "pack", "text").mapInArrow(_sorted_runs(buckets), _RUNS)
                .groupBy("bucket").applyInArrow(_merged(length), "doc long, start long"))
    starts = repeated.groupBy("doc").agg(F.collect_list("start").alias("starts"))
    done = (opened.drop("open").join(starts, "doc", "left").mapInArrow(_finished(length), f"doc long, {REMOVED}"))
    if not renumbered:
        return done.withColumnRenamed("doc", "doc_id")
    return done.join(rows.select("doc", "doc_id"), "doc").drop("doc")


def suffix_report(docs: DataFrame, **options) -> DataFrame:
    return dedup_bytes(docs, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
