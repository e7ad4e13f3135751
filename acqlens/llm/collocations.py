"""Phrase collocations by set-oriented mining (SETM) of occurrence relations.

R1 holds every word's occurrence: the place in its piece and the word.  R(k) is
R(k-1) merge-joined with itself: an occurrence of k-1 words and the one that
starts a word later in the same piece make an occurrence of k words.  Groups of
equal phrases are counted, and only occurrences of frequent ones are kept (the
semi-join) before the next extension, since a frequent phrase has frequent parts.

The relations are persisted in chunks of about ``chunk_words`` occurrences, a row
a chunk, sorted by place.  Places number the words of a chunk's pieces through,
with a gap after each piece, so the next place is always the same piece.  A chunk
never leaves its row: its groups go out pre-counted, one row a chunk and group,
are summed over all chunks in a shuffle on the group, and the frequent ones come
back to the chunks that hold them.  A frequent word is one row a chunk in that
shuffle, however often it occurs.  A group is named by the smallest (chunk, number
in the chunk) that holds it, so words and phrases need no hash.

Words: A-Z lower-cased, pieces split at ``.,;:!?`` and ASCII line ends, words at
blanks and tabs.  The score of a phrase of a occurrences cut in two parts of l and
r is floor(1000000 a a / (l r)), in whole numbers of 38 digits; its lowest cut
counts, the first at equal scores.  A candidate is dropped if a longer candidate
that contains it has ``share`` percent of its occurrences or more.

Edge cases: a null text is empty; a null language is ``und``; rows that share an
id, and rows with none, count each for itself; ties of score and count go by the
phrase's bytes; an empty table gives no rows; other columns are not read.  Very
long texts are read in stretches cut at piece ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from acqlens.llm.common import slices, stored, trim, utf8

_END = b"\xff"  # no byte of UTF-8 text
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _END * 10)
#: bits of a group's name: task, chunk of the task, number in the chunk
_TASK, _CHUNK, _NUMBER = 20, 16, 27


class _Numbers(dict):
    """word of one language -> its number in the chunk."""

    def __init__(self, lang: str, words: list[bytes], langs: list[str]):
        super().__init__({_END: -1})
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return n


def _stretches(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    at = 0
    while len(text) - at > size:
        cut = text.find(_END, at + size)
        if cut < 0:
            break
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:] + _END


def _gaps(at: np.ndarray) -> bytes:
    """Rising places as steps, nearly all of them 1, which compress to nothing."""
    return np.diff(at, prepend=np.int32(0)).astype(np.int32).tobytes()


def _occurrences(chunk_words: int):
    """R1 by chunk, with the chunk's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        words: list[bytes] = []
        langs: list[str] = []
        by_lang: dict[str, _Numbers] = {}
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            if task >> _TASK or number >> _CHUNK or held >> _NUMBER:
                raise OverflowError("more tasks, chunks or words than a group's name has room for")
            ids = np.concatenate(parts)
            at = np.flatnonzero(ids >= 0).astype(np.int32)
            of = ids[at]
            one = pa.array([0, len(words)], pa.int32())
            out = pa.RecordBatch.from_arrays([
                pa.array([task << _CHUNK | number], pa.int64()),
                pa.array([_gaps(at)], pa.binary()), pa.array([of.tobytes()], pa.binary()),
                pa.ListArray.from_arrays(one, pa.array(langs, pa.string())),
                pa.ListArray.from_arrays(one, pa.array(words, pa.binary()).cast(pa.string())),
                pa.array([np.bincount(of, minlength=len(words)).astype(np.int64).tobytes()], pa.binary())],
                ["chunk", "at", "of", "langs", "words", "n"])
            number, held = number + 1, 0
            for state in (words, langs, by_lang, parts):
                state.clear()
            trim()
            return out

        for batch in batches:
            for part in slices(batch, 256, 1):
                for lang, text in zip(part.column(0).to_pylist(), utf8(part.column(1))):
                    for stretch in _stretches(text.lower().translate(_ENDS)):
                        known = by_lang.get(lang)
                        if known is None:
                            known = by_lang[lang] = _Numbers(lang, words, langs)
                        tokens = stretch.replace(_END, b" \xff ").split()
                        parts.append(np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)))
                        held += len(tokens)
                        if held >= chunk_words:
                            yield flush()
        if words:
            yield flush()
        trim()

    return run


def _names(chunk: int, start: int, size: int) -> pa.Array:
    return pa.array((chunk << _NUMBER) + np.arange(start, start + size))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups of R1: one row a chunk and word."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = batch.column(0)[row].as_py()
            langs, words = batch.column(1)[row].values, batch.column(2)[row].values
            n = np.frombuffer(batch.column(3)[row].as_buffer(), np.int64)
            for i in range(0, len(n), 1 << 16):
                part = n[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [_names(chunk, i, len(part)), langs[i:i + len(part)], words[i:i + len(part)], pa.array(part)],
                    ["own", "lang", "word", "n"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups of a longer relation: one row a chunk and phrase."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = batch.column(0)[row].as_py()
            head, tail, n = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in (1, 2, 3))
            for i in range(0, len(n), 1 << 16):
                s = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [_names(chunk, i, len(n[s])), pa.array(head[s]), pa.array(tail[s]), pa.array(n[s])],
                    ["own", "head", "tail", "n"])


_LONGER = pa.schema([("chunk", pa.int64()), ("at", pa.binary()), ("of", pa.binary()),
                     ("head", pa.binary()), ("tail", pa.binary()), ("n", pa.binary())])


def _extend(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """A chunk's relation, semi-joined with its frequent groups and merge-joined
    with itself at the next place."""
    if not relation.num_rows or not frequent.num_rows:
        return _LONGER.empty_table()
    row = {c: relation.column(c)[0] for c in ("chunk", "at", "of")}
    at, of = (np.frombuffer(row[c].as_buffer(), np.int32) for c in ("at", "of"))
    at = np.cumsum(at, dtype=np.int32)
    number, name = (frequent.column(c).to_numpy() for c in ("number", "name"))
    dense = np.full(max(int(of.max(initial=-1)), int(number.max())) + 1, -1, np.int32)
    dense[number] = np.arange(len(number), dtype=np.int32)
    of = dense[of]
    keep = of >= 0
    at, of = at[keep], of[keep]
    here = np.flatnonzero(at[1:] == at[:-1] + 1)
    pair = of[here].astype(np.int64) << 32 | of[here + 1]
    group, of, n = np.unique(pair, return_inverse=True, return_counts=True)
    del pair, dense, keep
    trim()
    columns = (of.astype(np.int32), name[group >> 32], name[group & 0xFFFFFFFF], n)
    return pa.table([pa.array([row["chunk"].as_py()], pa.int64()), pa.array([_gaps(at[here])], pa.binary()),
                     *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns]],
                    schema=_LONGER)


def _frequent(groups: DataFrame, key: list[str], least: int) -> DataFrame:
    """(own, name) of the groups whose phrase occurs at least ``least`` times in all
    chunks together: the group's name and that of its phrase, the smallest of its
    groups' names.  The row of that group also has the phrase's key and count f."""
    phrase = Window.partitionBy(*key)
    rows = groups.select("own", *key, F.sum("n").over(phrase).alias("f"), F.min("own").over(phrase).alias("name"))
    once = lambda c: F.when(F.col("own") == F.col("name"), F.col(c)).alias(c)
    return stored(rows.where(F.col("f") >= least).select("own", "name", *map(once, [*key, "f"])), "frequent")


def _by_chunk(known: DataFrame) -> DataFrame:
    return known.select(F.shiftright("own", _NUMBER).alias("chunk"),
                        F.col("own").bitwiseAND((1 << _NUMBER) - 1).alias("number"), "name").groupBy("chunk")


def frequent_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text",
                     lang_col: str = "lang", chunk_words: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of the phrases of up to ``max_words`` words that
    occur at least ``min_count`` times, (lang, n) with all words of a language)."""
    relation = stored(
        docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                    F.col(text_col).alias("text"))
        .mapInArrow(_occurrences(chunk_words),
                    "chunk long, at binary, of binary, langs array<string>, words array<string>, n binary"),
        "occurrences")
    words = relation.select("chunk", "langs", "words", "n").mapInArrow(
        _words, "own long, lang string, word string, n long")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    known = _frequent(words, ["lang", "word"], min_count)
    level = known.where("f IS NOT NULL").select("name", "lang", F.col("word").alias("phrase"),
                                             F.lit(1).alias("size"), "f")
    last = level.select(F.col("name").alias("tail"), F.col("phrase").alias("last"))
    levels = [level]
    for size in range(2, max_words + 1):
        relation = stored(
            relation.select("chunk", "at", "of").groupBy("chunk")
            .cogroup(_by_chunk(known))
            .applyInArrow(_extend, "chunk long, at binary, of binary, head binary, tail binary, n binary"),
            "occurrences")
        groups = relation.select("chunk", "head", "tail", "n").mapInArrow(
            _groups, "own long, head long, tail long, n long")
        known = _frequent(groups, ["head", "tail"], min_count)
        level = stored(
            known.where("f IS NOT NULL").select("name", "head", "tail", "f")
            .join(level.select(F.col("name").alias("head"), "lang", "phrase"), "head").join(last, "tail")
            .select("name", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"),
                    F.lit(size).alias("size"), "f", "last"), "phrases")
        last = level.select(F.col("name").alias("tail"), "last")
        level = level.drop("last")
        levels.append(level)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return stored(every.select("lang", "phrase", "size", "f"), "phrases"), totals


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50,
                 top: int = 2000, **options) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    every, totals = frequent_phrases(docs, max_words, min_count, **options)
    made = F.split("phrase", " ")
    part = lambda start, length: F.array_join(F.slice(made, start, length), " ")
    candidates = every.where("size > 1")
    cuts = (candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "cut", F.col("f").alias("a"), part(F.lit(1), F.col("cut")).alias("first"),
                    part(F.col("cut") + 1, F.col("size")).alias("rest")))
    cuts = (cuts.join(every.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(every.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.select("lang", "phrase", "a", "cut", "l", "r",
                       (exact("a") * exact("a") * F.lit(1_000_000)).cast("decimal(38,0)").alias("above"),
                       (exact("l") * exact("r")).cast("decimal(38,0)").alias("below"))
    scored = (cuts.withColumn("score", F.expr("above div below"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
              .select("lang", "phrase", "a", "low.score", "low.l", "low.r"))
    # the parts of two words and more that a longer candidate contains
    parts = (candidates.where("size > 2")
             .withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
             .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
             .select("lang", part(F.col("start"), F.col("length")).alias("phrase"), F.col("f").alias("longer")))
    inside = parts.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (scored.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
