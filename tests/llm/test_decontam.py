import random
from fractions import Fraction

from acqlens.llm import decontam

SCHEMA = "doc_id long, text string, item_id long, llm_hit int"


def vocabulary(seed, n=4000):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(n)]


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, 1) for r in docs], SCHEMA)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, decontam.overlaps(d, b, **options).collect()),
                  key=lambda r: tuple((v is not None, v) for v in r))


def brute(docs, items, min_words=10, identity=0.7, anchor=6):
    """All diagonals; those with a window that some mask matches; the stretch with the
    most matches over mismatches if it counts, else the longest one that does."""
    split = lambda t: (t or "").encode().translate(decontam._AS_WORDS).split()
    out = set()
    for doc, text in docs:
        w = split(text)
        for item, other in items:
            o = split(other)
            if len(o) < decontam.SHORTEST:
                continue
            for first in range(-len(o) + 1, len(w)):
                equal = [0 <= first + q < len(w) and w[first + q] == o[q] for q in range(len(o))]
                if sum(equal) < 6 or not any(
                        all(p + k < len(o) and equal[p + k] for k, c in enumerate(m) if c == "1")
                        and p + len(m) <= len(o) and 0 <= first + p and first + p + len(m) <= len(w)
                        for m in decontam.MASKS for p in range(len(o))):
                    continue
                a, b = max(0, -first), min(len(o), len(w) - first)
                best = None
                for s in range(a, b):
                    score = 0
                    for e in range(s, b):
                        score += 1 if equal[e] else -1
                        if best is None or score > best[0]:
                            best = (score, s, e + 1)
                _, s, e = best
                hits = sum(equal[s:e])
                least, share = min(min_words, len(o)), Fraction(str(identity))
                if hits < least or hits < share * (e - s):
                    longest = [(s - e, e, s, n) for s in range(a, b) for e in range(s + 1, b + 1)
                               if equal[s] and equal[e - 1] and (n := sum(equal[s:e])) >= least and n >= share * (e - s)]
                    if not longest:
                        continue
                    _, e, s, hits = min(longest)
                out.add((doc, item, first + s, s, e - s, hits))
    return out


def test_stretches_of_diagonals_that_fail_as_a_whole(spark):
    """Every third word replaced, or a copied start and a rewritten rest: the best
    stretch misses the identity, a shorter one meets it."""
    words = vocabulary(5)
    rng = random.Random(6)
    items = [(k, " ".join(rng.choices(words, k=rng.randint(23, 60)))) for k in range(12)]
    docs = []
    for d in range(48):
        passage = items[d % 12][1].split()
        if d < 24:
            passage = [w if i % 3 != 2 else "zzz" for i, w in enumerate(passage)]
        else:
            keep = rng.randint(10, 16)
            passage = [w if i < keep or rng.random() < 0.58 else "zzz" for i, w in enumerate(passage)]
        docs.append((d, " ".join(rng.choices(words, k=5) + passage + rng.choices(words, k=5))))
    got = found(spark, docs, items)
    assert set(got) == brute(docs, items) and {r[0] for r in got} >= set(range(24))


def test_planted_passages_exact_and_with_substitutions(spark):
    words = vocabulary(1)
    rng = random.Random(2)
    items = [(k, " ".join(rng.choices(words, k=rng.randint(15, 50)))) for k in range(30)]
    docs, planted = [], set()
    for d in range(120):
        text = rng.choices(words, k=rng.randint(0, 120))
        if d % 4 == 0:
            k, item = rng.choice(items)
            passage = item.split()
            if d % 8 == 0:  # every fifth word replaced, as one might to hide a copy
                passage = [w if i % 5 != 3 else "zzz" for i, w in enumerate(passage)]
            if d % 12 == 0:
                passage = [w.upper() + "," for w in passage]
            at = rng.randint(0, len(text))
            text[at:at] = passage
            planted.add((d, k))
        docs.append((d, " ".join(text)))
    got = found(spark, docs, items)
    assert {(r[0], r[1]) for r in got} == planted
    assert set(got) == brute(docs, items)
    assert set(found(spark, docs, items, block_bytes=600)) == set(got)  # several blocks of items


def test_nulls_empty_short_long_and_repeated(spark):
    item = " ".join(vocabulary(3)[:20])
    filler = " ".join(vocabulary(4))
    docs = [(1, None), (2, ""), (None, item), (3, filler * 60 + " " + item + " " + filler), (4, item), (4, item)]
    got = found(spark, docs, [(7, item), (8, None), (9, ""), (10, "too few words"), (None, item)])
    assert {(r[0], r[1]) for r in got} == {(d, i) for d in (None, 3, 4) for i in (None, 7)}
    assert len(got) == 6
    assert found(spark, [], [(7, item)]) == found(spark, docs, []) == []


def test_filter_keeps_clean_documents_and_columns(spark):
    item = " ".join(vocabulary(5)[:18])
    d = spark.createDataFrame([(1, "clean text", 0, 5), (2, item, 0, 6), (None, None, 0, 7), (3, None, 0, 8)], SCHEMA)
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontam.without_overlaps(d, b)
    assert kept.columns == d.columns
    assert sorted(r.llm_hit for r in kept.collect()) == [5, 7, 8]


def counting_stretch(equal, min_words, share):
    """The most matches over mismatches if that counts, else the longest that does."""
    spans = [(s, e, sum(equal[s:e])) for s in range(len(equal)) for e in range(s + 1, len(equal) + 1)]
    counts = [x for x in spans if x[2] >= min_words and 10 * x[2] >= share * (x[1] - x[0])]
    most = max(2 * h - (e - s) for s, e, h in spans)
    best = [x for x in counts if 2 * x[2] - (x[1] - x[0]) == most]
    return {e - s for s, e, _ in best or counts if equal[s] and equal[e - 1]}, bool(best), counts


def check_stretch(item, doc):
    index = decontam.SeedIndex([(1, " ".join(item).encode())])
    ids = decontam.words(" ".join(doc).encode())
    equal = [a == b for a, b in zip(item, doc)]
    got = index.overlap(ids, 0, 0, 10, 0.7)
    lengths, best, counts = counting_stretch(equal, 10, 7)
    assert (got is None) == (not counts)
    if got:
        at, q, n, hits = got
        assert at == q and hits == sum(equal[q:q + n]) >= 10 and 10 * hits >= 7 * n
        assert n in lengths if best else n == max(lengths)
    return got


def test_part_of_a_stretch_counts_where_the_whole_does_not(spark):
    words = vocabulary(6)
    rng = random.Random(7)
    docs, items = [], []
    for n in range(20, 61):  # every third word replaced
        item = rng.sample(words, n)
        doc = [w if i % 3 != 2 else "zzz" for i, w in enumerate(item)]
        assert check_stretch(item, doc)
        docs.append((n, " ".join(doc)))
        items.append((n, " ".join(item)))
    assert {(r[0], r[1]) for r in found(spark, docs, items)} == {(n, n) for n in range(20, 61)}
    for trial in range(150):
        copied, rate = ((15, 0.55), (12, 0.6), (0, 0.62))[trial % 3]
        item = rng.sample(words, 60)
        doc = [w if i < copied or rng.random() < rate else "zzz" for i, w in enumerate(item)]
        got = check_stretch(item, doc)
        assert got or not copied


def test_scripts_without_blanks_and_short_items(spark):
    chinese = "数据去重是训练语言模型之前的重要步骤，重复的文本会浪费计算并且泄漏评测题目。"
    thai = "การกำจัดข้อมูลซ้ำเป็นขั้นตอนสำคัญก่อนการฝึกแบบจำลองภาษา"
    kana = "じゅうふくしたぶんしょうはけいさんをむだにする。"
    quoted = "«vier fünf sechs» – sieben, acht… neun zehn elf zwölf dreizehn"
    items = [(1, chinese), (2, thai), (3, kana), (4, quoted), (5, "Blue Whale"), (6, "东京塔"), (7, "!?"), (8, "…")]
    docs = [(11, "前言。其他内容" + chinese.replace("，", "") + "后面还有别的话"), (12, "ก่อนหน้า" + thai),
            (13, "「" + kana + "」"), (14, "eins vier fünf sechs sieben acht neun zehn elf zwölf dreizehn"),
            (15, "a blue, whale and a blue whale"), (16, "我们去看东京塔吧"), (17, "blue wha le 东京 塔楼 … !?"),
            (18, "blue sky whale")]
    got = found(spark, docs, items)
    assert {(r[0], r[1]) for r in got} == {(11, 1), (12, 2), (13, 3), (14, 4), (15, 5), (16, 6), (17, 6)}
    assert [r[2:] for r in got if r[0] == 15] == [(1, 0, 2, 2), (5, 0, 2, 2)]
    assert all(r[4] == r[5] for r in got)
