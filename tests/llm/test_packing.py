import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from acqlens.llm import idmatrix, sospack
from acqlens.llm.tokens import WordEncoder, default_tokenizer

SCHEMA = "doc_id long, text string, piece string, offset string"


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(default_tokenizer(), keep=50)


ODD = "aZ09 '\t\n\x0b\x0c\r\x1c\x1f.,!?-İıßΣσςéÉ́̇　 \xa0\x85中ñÅǅſ’s"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*ODD, "<|endoftext|>", "<|start", "oftext|>", "don't ", "Word "]), max_size=25))
def test_ids_equal_the_tokenizers(parts):
    enc = _shared()
    text = "".join(parts)
    assert enc.encode(text) == enc.encode_whole(text)


def test_words_with_a_tail_of_signs_need_no_whole_tokenizer():
    enc = WordEncoder(default_tokenizer())
    signs = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
    texts = [f"Word{a}{b} élan{a}{b}{a} {a}{b}{a}\nword{a}" for a in signs for b in signs]
    texts += ["schenach,*** thonea.%%% ###", "rock' rock'' don't rock'n' 'tis' ' \" o'", f"end{signs}", signs]
    whole, asked = enc.encode_whole, []
    enc.encode_whole = lambda chunk: asked.append(chunk) or whole(chunk)
    assert enc.encode_many(texts) == list(map(whole, texts))
    assert set(asked) == {"don't", "rock'n'", "'tis'"}


_made = []


def _shared():
    if not _made:
        _made.append(WordEncoder(default_tokenizer(), keep=50))
    return _made[0]


def documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    more = [(None, "null id"), (9001, None), (9002, ""), (9003, "same"), (9003, "same"), (9004, "long words " * 9000)]
    rows = [tuple(r) for r in docs.collect()] + more
    return rows, spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)


def wanted(rows, encoder, size=2048):
    out = []
    for doc, text in rows:
        ids = np.frombuffer(encoder.encode_whole(text or ""), "<u4").tolist() + [0]
        out += [(doc, k, s, ids[s:s + size]) for k, s in enumerate(range(0, len(ids), size))]
    return out


def test_sum_of_squares_packing(spark, sf, encoder):
    rows, df = documents(spark, sf)
    want = wanted(rows, encoder)
    got = sospack.pack_documents(df).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(
        ((d, k, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, k, s, i in want), key=key)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(len(i) for *_, i in want) // 2048)
    assert least <= len(held) <= least + 2
    groups = sospack.pack_documents(df, group_rows=50).collect()
    assert sum(r.length for r in groups) == sum(r.length for r in got)


def test_rule_minimises_the_sum_of_squares():
    rng = np.random.default_rng(3)
    gaps = sospack.SquaredGaps(12)
    open_gaps = {}
    for length in rng.integers(1, 13, 300).tolist():
        before = np.bincount([g for g in open_gaps.values() if 0 < g < 12], minlength=13)
        costs = {}
        for g in {g for g in open_gaps.values() if g >= length}:
            after = before.copy()
            after[g] -= 1
            if g > length:
                after[g - length] += 1
            costs[g] = int((after[1:12] ** 2).sum())
        number, offset = gaps.place(length)
        if costs:
            assert costs[12 - offset] == min(costs.values())
        else:
            assert offset == 0
        assert open_gaps.get(number, 12) == 12 - offset
        open_gaps[number] = 12 - offset - length


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sospack.pack_documents(empty).count() == 0
    assert idmatrix.id_matrices(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing_against_a_plain_search(lengths):
    rows = idmatrix.best_fit_decreasing(lengths, 20)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(20 - n)
    assert sorted(20 - sum(lengths[i] for i in r) for r in rows) == sorted(room)


def test_id_matrices(spark, sf, encoder, tmp_path):
    rows, df = documents(spark, sf)
    want = {}
    for d, k, _, ids in wanted(rows, encoder):
        want.setdefault((d, k), []).append(ids)
    path = f"{tmp_path}/matrix"
    idmatrix.write_matrices(df, path, shard_tokens=30_000, block_rows=7)
    seen = 0
    for block in spark.read.schema(idmatrix.MATRIX).parquet(path).collect():
        shape = (block.n_rows, block.row_length)
        ids = np.frombuffer(block.input_ids, f"<u{block.id_bytes}").reshape(shape)
        resets = np.unpackbits(np.frombuffer(block.position_resets, np.uint8), count=ids.size).reshape(shape)
        for r, ends in enumerate(block.cu_seqlens):
            assert np.flatnonzero(resets[r]).tolist() == ends[:-1]
            assert not ids[r, ends[-1]:].any()
            for doc, piece, a, b in zip(block.doc_ids[r], block.pieces[r], ends, ends[1:]):
                want[(doc, piece)].remove(ids[r, a:b].tolist())
                seen += 1
    assert not any(want.values()) and seen > len(rows)
    read = idmatrix.read_rows(spark, path).collect()
    assert sum(r.n_segments for r in read) == seen
    assert all(r.resets == r.cu_seqlens[:-1] and r.n_tokens == r.cu_seqlens[-1] for r in read)
