"""Near-duplicate documents: SuperMinHash signatures, banding, verification on
full shingle sets, union-find groups.

SuperMinHash gives every element one random permutation of the signature's
places and the values 0 + r, 1 + r', 2 + r'', ... along it; a place keeps its
smallest value.  The ranks an element sends to different places are therefore
correlated, which lowers the variance against independent minima.  As soon as no
place holds a value of rank j or more, higher ranks cannot change anything and
the document stops early: long documents after one or two ranks.

Documents with equal sets are collapsed first.  44 bands of 4 values miss a pair
of similarity 0.75 with probability 5e-8.  Within a bucket not all pairs are
formed: every member is verified against a centre, the member that shares the
most buckets with others, and linked members are merged.  Buckets that still
hold several components go on with 16 further centres, and what is still open
then with every member as a centre, so no link is lost to a cap.  Before both of
these rounds the shingles that only one of the remaining documents has are taken
off, and the others counted by class: two sets share at most the smaller count of
each class, and pairs (and documents) that cannot reach the similarity with that
are not compared.  Heavily edited copies, which link with nothing, drop out here.
Verification is exact: sizes of intersection and union of the full sets.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased.  A
set holds the distinct five-word shingles as 64-bit hashes; with one to four
words the whole sequence is the only element.

Edge cases: null or empty text and text without words has an empty set and links
with nothing; rows that share an id are one node (linked by it); rows with a null
id take no part in links and keep a null component; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from acqlens.llm.common import U64, WORD_HASHES, bucketed, mix, slices, stored, stretches, utf8, working
from acqlens.llm.components import components

SHINGLE = 5
_FACTORS = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9),
            U64(0x27D4EB2F165667C5), U64(0xD6E8FEB86659FD93)]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashed = [np.concatenate([WORD_HASHES.of(p.lower().split()) for p in stretches(t)]) for t in texts]
    sizes = np.array([len(h) for h in hashed], np.int64)
    flat = np.concatenate(hashed) if hashed else np.zeros(0, U64)
    n, sets, at = len(flat), [], 0
    if n >= SHINGLE:
        rolled = np.zeros(n - SHINGLE + 1, U64)
        for k, f in enumerate(_FACTORS):
            rolled += mix(flat[k:n - SHINGLE + 1 + k] * f)
        rolled = mix(rolled)
    for size in sizes.tolist():
        if size >= SHINGLE:
            sets.append(np.unique(rolled[at:at + size - SHINGLE + 1]))
        elif size:
            few = np.array([size], U64)
            for k in range(size):
                few = mix(few + flat[at + k:at + k + 1] * _FACTORS[k])
            sets.append(few)
        else:
            sets.append(np.zeros(0, U64))
        at += size
    return sets


def super_minhash(sets: list[np.ndarray], places: int, block: int = 1 << 16) -> np.ndarray:
    """One row of ``places`` (at most 255) unsigned 32-bit values a set: the rank
    in the top 8 bits, a random fraction below.  Rows of empty sets hold the
    largest value.  A set of over ``block`` elements is done in blocks: the
    signature of a union is the smaller value at each place."""
    if any(len(s) > block for s in sets):
        return np.stack([np.minimum.reduce([_signatures([s[i:i + block]], places)[0]
                                            for i in range(0, max(1, len(s)), block)]) for s in sets])
    return _signatures(sets, places)


def _signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    top = np.uint32(0xFFFFFFFF)
    best = np.full((len(sets), places), top, np.uint32)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.zeros(0, U64)
    order = None  # each element's permutation so far, made once rank 1 is needed
    for rank in range(places):
        if not len(element):
            break
        x = mix(element + U64((rank + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        swap = rank + (((x & U64(0xFFFFFFFF)) * U64(places - rank)) >> U64(32)).astype(np.int64)
        if order is None:
            place, first = swap, swap
        else:
            rows = np.arange(len(element))
            place = order[rows, swap].astype(np.int64)
            order[rows, swap] = order[rows, rank]
        value = (U64(rank) << U64(24) | (x >> U64(40))).astype(np.uint32)
        np.minimum.at(best.reshape(-1), of * places + place, value)
        open_sets = best.max(axis=1) >= np.uint32(rank + 1 << 24)
        keep = open_sets[of]
        if order is None:
            element, of, first = element[keep], of[keep], first[keep]
            order = np.tile(np.arange(places, dtype=np.uint8), (len(element), 1))
            rows = np.arange(len(element))
            order[rows, first] = 0
        elif not keep.all():
            element, of, order = element[keep], of[keep], order[keep]
    return best


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """(doc, n, digest, bands): set size, 128-bit digest of the set, one 64-bit
    key a band (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        working("word hashes")
        for batch in batches:
            for part in slices(batch, 128, 1):
                sets = shingle_sets(utf8(part.column(1)))
                sig = super_minhash(sets, bands * rows).reshape(len(sets), bands, rows)
                keys = np.zeros((len(sets), bands), U64)
                for r in range(rows):
                    keys = mix(keys + sig[:, :, r].astype(U64) + U64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([k.tobytes() if len(s) else None for k, s in zip(keys.view("<i8"), sets)],
                             pa.binary())],
                    ["doc", "n", "digest", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, "doc long, n long, digest binary, bands binary")


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 4096):
            keys = [np.frombuffer(k, "<i8") for k in part.column(1).to_pylist()]
            if keys:
                grid = np.stack(keys)
                doc = np.repeat(part.column(0).to_numpy(zero_copy_only=False), grid.shape[1])
                # the band number goes into the key: equal values of two bands differ
                key = mix(grid.view(U64) + np.arange(1, grid.shape[1] + 1, dtype=U64) * _FACTORS[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.reshape(-1).view("<i8")), pa.array(doc)], ["bucket", "doc"])


def _verified(percent: int):
    """Keeps the pairs (a, b, ea, eb) with 100 |a & b| >= percent |a | b|."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for i, (ea, eb) in enumerate(zip(batch.column(2), batch.column(3))):
                known, other = (np.frombuffer(e.as_buffer(), "<u8") for e in (ea, eb))
                if not len(known):  # an id that stands on an empty text too
                    continue
                at = np.searchsorted(known, other)
                at[at == len(known)] = 0
                both = int((known[at] == other).sum())
                if 100 * both >= percent * (len(known) + len(other) - both):
                    hit.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(hit, pa.int64())),
                 batch.column(1).take(pa.array(hit, pa.int64()))], ["a", "b"])

    return run


def _elements(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """(doc, elements) of the documents in ``wanted``, bucketed by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("word hashes")
        for batch in batches:
            for part in slices(batch, 128, 1):
                sets = shingle_sets(utf8(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["doc", "elements"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return _by_doc(texts.join(wanted, "doc", "left_semi").select("doc", "text")
                   .mapInArrow(run, "doc long, elements binary"))


def _by_doc(elements: DataFrame) -> DataFrame:
    """Stored with one file a bucket: without dealing by document first every task
    of a broadcast join would write to every bucket."""
    buckets = int(elements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed(elements.repartition(buckets, "doc"), "elements", "doc")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 512):
            sets = [np.frombuffer(e.as_buffer(), "<i8") for e in part.column(1)]
            doc = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))],
                ["doc", "element"])


def _shareable(elements: DataFrame, classes: int = 32) -> DataFrame:
    """(doc, profile): per class of shingles (by hash), how many of a document's
    occur in another document of ``elements`` too.  Two documents cannot share
    more of a class than the smaller of their counts."""
    rows = elements.select("doc", "elements").mapInArrow(_unpacked, "doc long, element long")
    kind = F.pmod("element", F.lit(classes))
    private = (rows.groupBy("element").agg(F.min("doc").alias("doc"), F.max("doc").alias("x"))
               .where("doc = x").groupBy("doc")
               .agg(F.array(*[F.count_if(kind == k) for k in range(classes)]).alias("private")))
    every = rows.groupBy("doc").agg(F.array(*[F.count_if(kind == k) for k in range(classes)]).alias("every"))
    sets = elements.groupBy("doc").agg(F.count("*").alias("sets"))
    # an id on several rows has several sets: nothing is taken off for it
    less = F.zip_with("every", "private", lambda x, y: x - y)
    usable = (F.col("sets") == 1) & F.col("private").isNotNull()
    return (every.join(sets, "doc").join(private, "doc", "left")
            .select("doc", F.when(usable, less).otherwise(F.col("every")).alias("profile")))


def _total(x) -> "F.Column":
    return F.aggregate(x, F.lit(0).cast("long"), lambda t, v: t + v)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                percent: int = 75, bands: int = 44, rows: int = 4) -> DataFrame:
    """(doc, n, component): one row a row of ``docs``."""
    sets = stored(signatures(docs, id_col, text_col, bands, rows), "sets")
    real = sets.where("n > 0 AND doc IS NOT NULL")
    copies = stored(real.groupBy("n", "digest").agg(F.min("doc").alias("rep")), "copies")
    member = stored(real.select("doc", "n", "digest").join(copies, ["n", "digest"])
                    .select("doc", "rep").distinct(), "members")
    distinct = real.join(member.where("doc = rep").select("doc").distinct(), "doc", "left_semi")

    keys = stored(distinct.select("doc", "bands").mapInArrow(_band_rows, "bucket long, doc long")
                  .distinct(), "bands")
    shared = keys.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    keys = stored(keys.join(shared, "bucket"), "shared")
    weight = keys.groupBy("doc").agg(F.sum("size").alias("weight"))
    sizes = real.groupBy("doc").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    node = stored(weight.join(sizes, "doc"), "nodes")
    elements = _elements(docs, id_col, text_col, node.select("doc"))

    # the smallest copy stands for its copies; an id on rows with different sets joins them
    links = member.where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    order = Window.partitionBy("bucket").orderBy(F.col("weight").desc(), "doc")
    alive = stored(keys.select("bucket", "doc").join(node, "doc")
                   .withColumn("open", F.col("most")).withColumn("comp", F.col("doc")), "open")
    for centres in (1, 16, None):
        first = alive
        if centres:
            first = stored(alive.withColumn("place", F.row_number().over(order))
                           .where(F.col("place") <= centres).drop("place"), "centres")
        c = first.select("bucket", F.col("doc").alias("a"), F.col("comp").alias("ca"),
                         F.col("least").alias("la"), F.col("most").alias("ma"),
                         F.col("open").alias("oa"), *[F.col("profile").alias("pa")][:centres != 1])
        # a pair must be able to reach the similarity, by its sizes and by what
        # it can share at most
        can = (100 * F.col("ma") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("la"))
        shares = [F.least("open", "oa")]
        if centres != 1:
            shares.append(_total(F.zip_with("profile", "pa", lambda x, y: F.least(x, y))))
        for both in shares:
            can = can & (100 * both >= percent * (F.col("la") + F.col("least") - both))
        side = F.col("a") < F.col("doc") if centres is None else F.col("a") != F.col("doc")
        pairs = (alive.join(c, "bucket").where((F.col("ca") != F.col("comp")) & side & can)
                 .select("a", F.col("doc").alias("b")).distinct())
        # the key of the second join is an expression, so that both of its sides
        # are shuffled and a frequent centre can be split
        left = elements.select(F.col("doc").bitwiseXOR(F.lit(0)).alias("a"), F.col("elements").alias("ea"))
        linked = (stored(pairs, "pairs")
                  .join(elements.select(F.col("doc").alias("b"), F.col("elements").alias("eb")), "b")
                  .join(left, "a").select("a", "b", "ea", "eb").mapInArrow(_verified(percent), "a long, b long"))
        links = stored(links.unionByName(linked), "links")
        groups = components(links)
        if centres is None:
            break
        # centres have met all others of their bucket; what is left goes on if it
        # still belongs to several components
        rest = (alive.select("bucket", "doc", "weight", "least", "most").join(first.select("bucket", "doc"), ["bucket", "doc"], "left_anti")
                .join(groups, F.col("doc") == F.col("node"), "left")
                .withColumn("comp", F.coalesce("root", "doc")).drop("node", "root"))
        rest = stored(rest, "open")
        several = rest.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")) \
            .where("x <> y").select("bucket")
        rest = stored(rest.join(several, "bucket", "left_semi"), "open")
        if rest.isEmpty():
            break
        # go on with the sets of what is left, and with what these can share at most
        elements = _by_doc(elements.join(rest.select("doc").distinct(), "doc", "left_semi"))
        profile = _shareable(elements).withColumn("open", _total("profile"))
        alive = stored(rest.join(profile, "doc").where(100 * F.col("open") >= percent * F.col("least")), "open")
    return (sets.select("doc", "n").join(groups, F.col("doc") == F.col("node"), "left")
            .select("doc", "n", F.coalesce("root", "doc").alias("component")))


def near_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    return near_groups(docs, **options).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        (F.col("doc").eqNullSafe(F.col("component"))).alias("kept"))
