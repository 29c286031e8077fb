"""Hard negatives, spelling variants and common lines against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from snapmill.llm import hardneg, lineindex, wordindex
from snapmill.llm.queries import op12_spelling

VECTORS = "vec_id long, embedding array<double>, label int"


# --- hard negatives

def brute_negatives(rows, every=50, positives=5, negatives=3, low=50, high=95):
    fit = [(i, tuple(int(np.floor(256 * x)) for x in v), y) for i, v, y in rows
           if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    fit = sorted(set(fit))
    out = []
    for a, va, ya in fit:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, y) for i, v, y in fit if i != a)
        for s, p, _ in [r for r in scored if r[2] == ya][:positives]:
            inside = [(n, m) for n, m, y in scored if y != ya and low * -s <= 100 * -n <= high * -s]
            out += [(a, p, k + 1, m, -s, -n) for k, (n, m) in enumerate(inside[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    got = hardneg.mine(spark.createDataFrame(rows, VECTORS), **options)
    assert [f.name for f in got.schema] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, width, seed=0, labels=4, hot=0.5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(labels, width))
    out = []
    for i in range(n):
        y = 0 if rng.random() < hot else int(rng.integers(labels))
        v = base[y] + 2.5 * rng.normal(size=width)
        out.append((i, (v / np.linalg.norm(v)).tolist(), y))
    return out


def test_negatives_equal_brute_force_over_many_blocks(spark):
    rows = vectors(400, 12)
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(40)] + [(2000 + i, rows[7][1], 3) for i in range(40)]
    expected = brute_negatives(rows, every=10)
    assert expected and mined(spark, rows, every=10, block=32, anchor_block=4) == expected
    assert mined(spark, rows, every=10) == expected


def test_fields_are_exact_at_every_width():
    rng = np.random.default_rng(1)
    for low, high in ((-300, 300), (-5, 3), (0, 7), (-2**30, 2**30), (-2**40, 2**41), (-2**62, 2**62)):
        a, c = rng.integers(low, high + 1, (70, 13)), rng.integers(low, high + 1, (131, 13))
        layout = hardneg.Fields(low, high, 13)
        assert (layout.scores(a, c, layout.pack(c)) == a.astype(object) @ c.astype(object).T).all()


def test_odd_vectors(spark):
    rows = vectors(120, 4)
    rows += [(None, [1.0] * 4, 0), (150, None, 0), (200, [1.0, None, 0.0, 0.0], 0), (250, [float("nan")] * 4, 1), (300, [float("inf")] * 4, 1),
             (350, [0.5] * 4, None), (400, [0.0] * 4, 2), (450, [], 1), (500, [0.7, 0.7], 1)]
    rows += rows[:3]
    expected = brute_negatives(rows)
    assert expected and mined(spark, rows) == expected
    assert mined(spark, rows[:1]) == [] and mined(spark, []) == []


def test_scores_beyond_a_machine_word(spark):
    rows = [(50, [1e9, 1.0], 0), (1, [9e8, 1.0], 0), (2, [7e8, 5.0], 1), (3, [8e8, 5.0], 1), (4, [1.0, 1.0], 1)]
    assert mined(spark, rows) == [(50, 1, r, n, None, None) for r, n in ((1, 3), (2, 2))]
    rows = [(50, [3e6, 1.0], 0), (1, [2e6, 1.0], 0), (2, [1.5e6, 5.0], 1)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_other_columns_do_not_matter(spark):
    rows = vectors(120, 4)
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("block", "bucket", "q", "rank", "anchor_id"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted(tuple(r) for r in hardneg.mine(df).collect()) == brute_negatives(rows)


# --- spelling variants

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near_of = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in near_of.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near_of[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def found_variants(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_search_schemes_equal_brute_force():
    rng = random.Random(3)
    for letters in ("ab", "abcdeéÿ"):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(300)})
        size = np.array([len(w) for w in words])
        got = set()
        q, w = wordindex.FMIndex(words).near(words, size - size // 2)
        got |= {(words[i], words[j]) for i, j in zip(q, w, strict=True)}
        back = [x[::-1] for x in words]
        q, w = wordindex.FMIndex(back).near(back, size // 2)
        got |= {(words[i], words[j]) for i, j in zip(q, w, strict=True)}
        assert got == {(a, b) for a in words for b in words if near(a, b)}


@pytest.mark.parametrize("shard_chars", [40, 65_536])
def test_variants_equal_brute_force(spark, shard_chars):
    rng = random.Random(5)
    letters = "abcé×÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 7))) for _ in range(120)]
    docs = [(i if i % 9 else None, " ".join(rng.choice(words[:1 + int(rng.random() ** 2 * 119)]) for _ in range(60))) for i in range(60)]
    docs += [(100, "camera " * 40), (101, "camere " * 12 + "camerre " * 4)]
    docs += [(7, None), (8, ""), (9, "Straße STRAßE straße Étés éTÉS 1234 中文")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    expected = brute_variants(docs)
    assert any(r[2] != r[0] and r[2] != r[1] for r in expected), "no chain of two forms in the fixture"
    assert found_variants(wordindex.variants(df, shard_chars=shard_chars)) == expected


def test_long_words_and_empty_tables(spark):
    long = "a" * 3_000
    docs = [(i, f"{long} {long[1:]} {long}b") for i in range(1, 5)]
    assert found_variants(wordindex.variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute_variants(docs)
    assert wordindex.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert wordindex.variants(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == []


def test_the_query_over_a_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.word: r for r in op12_spelling(spark, SF).collect()}
    n = Counter()
    for w, r in got.items():
        n[w] = r.n
    # all words and counts, and the neighbours of a part of them
    expected = {}
    for w, _, _, c, _, _ in _counted(docs):
        expected[w] = c
    assert {w: r.n for w, r in got.items()} == expected
    for w in sorted(expected)[::20]:
        assert got[w].n_near == sum(near(w, v) for v in expected), w


def _counted(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return [(w, None, w, c, 0, None) for w, c in n.items() if len(w) >= 5 and c >= 3]


# --- common lines

def brute_lines(docs, min_docs=10):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))

    held = Counter()
    for _, text in docs:
        held.update({key(line) for line in (text or "").split("\n")} - {""})
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        drop = [held[key(x)] >= min_docs for x in lines]
        kept = "\n".join(x for x, d in zip(lines, drop, strict=True) if not d)
        out.append((doc_id, len(lines), sum(drop), kept, max((held[key(x)] for x, d in zip(lines, drop, strict=True) if d), default=0)))
    return sorted(out, key=str)


def line_docs():
    rng = random.Random(9)
    pool = [f"line {i}" for i in range(60)] + ["  Subscribe NOW\t", "subscribe now", "ÉTÉ", "été", "", "   ", "\x0bv\x0c", "a "]
    docs = []
    for i in range(80):
        lines = [rng.choice(pool[:3 + i]) for _ in range(rng.randint(1, 12))]
        docs.append((i // 2 if i % 7 else None, "\n".join(lines + ["Share this"] * (i % 3))))
    return [*docs, (500, None), (501, ""), (502, "\n\n"), (503, "x" * 200_000 + "\nline 1\r"), (504, "\n".join(["line 1"] * 3_000)), docs[3], docs[3]]


def as_rows(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept, r.most_docs) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"shard_keys": 3}, {"index_bytes": 0}, {"index_bytes": 0, "shard_keys": 3, "cell_probes": 20}])
def test_lines_equal_brute_force_on_both_ways(spark, options):
    docs = line_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("row", "high", "kept", "shard", "n_docs"):
        df = df.withColumn(name, F.lit(1))
    expected = brute_lines(docs)
    assert any(r[2] for r in expected) and as_rows(lineindex.drop_common_lines(df, **options)) == expected


def test_no_common_line_and_no_rows(spark):
    docs = [(1, "a\nb"), (2, None), (None, "c")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for bound in (0, 1 << 20):
        assert as_rows(lineindex.drop_common_lines(df, index_bytes=bound)) == brute_lines(docs)
        assert lineindex.drop_common_lines(df.limit(0), index_bytes=bound).collect() == []
    kept = lineindex.drop_common_lines(df, min_docs=1).where("doc_id = 1").first()
    assert (kept.kept, kept.n_dropped) == ("", 2) and hashlib.sha256(b"").hexdigest() == hashlib.sha256(kept.kept.encode()).hexdigest()


def test_perfect_hash_is_minimal_and_refuses_others():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2**63, (20_000, 2)).astype(np.uint64)
    keys[1, 1] = keys[0, 1]
    keys[3, 0] = keys[2, 0]
    table = lineindex.PerfectHash.build(keys[:, 0], keys[:, 1], np.arange(20_000) + 10)
    assert sorted(table.slots(keys[:, 0], keys[:, 1]).tolist()) == list(range(20_000))
    table = lineindex.PerfectHash.unpack(*table.pack())
    assert (table.probe(keys[:, 0], keys[:, 1]) == np.arange(20_000) + 10).all()
    assert not table.probe(keys[:, 0] + np.uint64(1), keys[:, 1]).any()
    # about three bits a key beside the arrays
    assert len(table.pack()[1]) * 8 < 5 * 20_000
    assert lineindex.PerfectHash.build(*[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64)).slots(keys[:, 0], keys[:, 1]).max() == -1
