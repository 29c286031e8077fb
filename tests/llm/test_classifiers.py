"""Toxicity, quality and language: held-out accuracy on the tables, defined results on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmill.llm import langid, quality, toxicity
from snapmill.llm.common import fold

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows(spark):
    long_text = "the and of " * 60_000
    return spark.createDataFrame(
        [(1, None, None, None, None), (None, "the and of", "en", None, 1), (3, "", "en", "x", 0), (4, long_text, "en", "x", 1),
         (5, "the and of to", "en", "x", 1), (5, "the and of to", "en", "x", 1), (6, "123 !!! 456 \u00bd", None, "x", 1)], DOC
    ).withColumns({"score": F.lit(7), "label": F.lit("clash"), "predicted": F.lit(None).cast("int"), "fp": F.lit(1)})


def accuracy(found, labels, label):
    rows = found.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    return np.mean([r["predicted"] == r[label] for r in rows])


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels")}


def test_quality_held_out(tables):
    found = quality.quality(tables["documents"], tables["labels"])
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert accuracy(found, tables["labels"], "quality") > 0.95
    kept = quality.keep_good(tables["documents"], tables["labels"])
    assert kept.columns == tables["documents"].columns
    assert kept.count() == found.where("predicted = 1").count()


def test_toxicity_held_out(tables):
    found = toxicity.toxicity(tables["documents"], tables["labels"])
    assert accuracy(found, tables["labels"], "toxic") > 0.9
    assert found.where("score < 0 or score > 1 or predicted != cast(score >= 0.5 as int)").count() == 0


def test_language_held_out(tables):
    found = langid.language(tables["documents"]).join(tables["documents"].select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() / found.count() > 0.97


def test_odd_rows_of_classifiers(spark, tables):
    docs = odd_rows(spark)
    for rows in (quality.quality(docs, tables["labels"]).collect(), toxicity.toxicity(docs, tables["labels"]).collect()):
        assert len(rows) == 7
        assert all(0 <= r.score <= 1 for r in rows)
    nothing = tables["labels"].limit(0)
    assert {r.score for r in quality.quality(docs, nothing).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity(docs, nothing).collect()} == {0.0}
    assert quality.quality(docs.limit(0), tables["labels"]).count() == 0
    assert quality.keep_good(docs, nothing).count() == 7


def test_odd_rows_of_language(spark):
    rows = langid.language(odd_rows(spark), held=99).collect()
    assert len(rows) == 7
    got = {(r.doc_id, r.lang_pred) for r in rows}
    assert got == {(1, "und"), (None, "en"), (3, "und"), (4, "en"), (5, "en"), (6, "und")}
    assert {r.lang_pred for r in langid.language(odd_rows(spark).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.language(odd_rows(spark).limit(0)).count() == 0


def test_fold_is_crc32_of_text(spark):
    import zlib
    rows = spark.range(50).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def brute_phrases(text, sample):
    n, at = 0, 0
    while at < len(text):
        end = at
        while end < len(text) and text[at:end + 1] in sample:
            end += 1
        at = max(end, at + 1)
        n += 1
    return n


def test_cross_parsing_against_brute_force():
    samples = {"a": "the cat sat on the mat and the dog", "b": "der hund und die katze auf der matte"}
    model = langid.build(samples)
    texts = ["the dog and the cat", "die katze", "mat", "d", ""]
    got = model.phrases(texts)
    for i, t in enumerate(texts):
        for k, s in enumerate(samples.values()):
            assert got[i, k] == brute_phrases(t, s)


def test_rare_letters_against_brute_force(monkeypatch):
    """The searched moves give the same phrases as the table; scripts of very many letters are whole."""
    rng = np.random.default_rng(3)
    han = "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 600, 900))
    kana = "".join(chr(0x3042 + int(i)) for i in rng.integers(0, 40, 400))
    samples = {"en": "the cat sat on the mat and the dog", "ja": kana + han[:60], "zh": han}
    texts = ["the dog", han[100:140], han[5:9] + "cat" + kana[7:11], kana[:30], "\U0001F600" + han[3:5], "дом", "", "x" + han[890:]]
    expected = [[brute_phrases(t, s) for s in samples.values()] for t in texts]
    for common in (96, 4, 2, 100_000):
        monkeypatch.setattr(langid, "COMMON", common)
        assert langid.build(samples).phrases(texts).tolist() == expected, common


def test_three_scripts(spark):
    rng = np.random.default_rng(4)
    han = [chr(0x4E00 + int(i)) for i in rng.integers(0, 2_500, 500)]
    words = {"zh": ["".join(rng.choice(han, 2)) for _ in range(200)], "el": ["".join(rng.choice(list("αβγδεζηθικλμ"), 5)) for _ in range(200)],
             "en": ["".join(rng.choice(list("etaoinshrdlu"), 5)) for _ in range(200)], "ru": ["".join(rng.choice(list("абвгдежзикл"), 5)) for _ in range(200)]}
    rows = [(i, " ".join(rng.choice(words[lang], 40)), lang) for i, lang in enumerate(list(words) * 60)]
    found = langid.language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").collect()
    true = {i: lang for i, _, lang in rows}
    assert len(found) > 30 and all(r.lang_pred == true[r.doc_id] for r in found)


def test_suffix_automaton_accepts_exactly_the_substrings():
    rng = np.random.default_rng(1)
    s = rng.integers(1, 4, 60).tolist()
    edges = langid.automaton(s)
    inside = {tuple(s[i:j]) for i in range(60) for j in range(i + 1, min(i + 6, 61))}
    for _ in range(300):
        w = tuple(rng.integers(1, 4, rng.integers(1, 6)).tolist())
        state = 0
        for c in w:
            state = edges[state].get(c, -1) if state >= 0 else -1
        assert (state >= 0) == (w in inside)


def test_statistics_are_finite():
    for t in ("", " ", "\n\n", "A", "é" * 5000, "x " * 100_000):
        assert np.isfinite(quality.statistics(t)).all()


def test_distinct_grams_by_stamp():
    stamp = np.zeros(toxicity.BUCKETS, np.int32)
    g = toxicity.grams("abc abc abc xyz")
    assert sorted(toxicity.distinct(g, stamp)) == np.unique(g).tolist()


def labelled_texts(n=160):
    rng = np.random.default_rng(8)
    good = ["".join(rng.choice(list("abcdefg"), int(k))) for k in rng.integers(2, 9, 60)]
    bad = ["".join(rng.choice(list("defghij!1"), int(k))) for k in rng.integers(2, 9, 60)]
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.4)
        pool = bad if y else good
        rows.append((i, "\n".join(" ".join(rng.choice(pool if rng.random() < 0.8 else good, int(rng.integers(1, 9)))) for _ in range(int(rng.integers(1, 5)))), y))
    return rows


def test_discriminant_equals_plain_densities(spark):
    rows = labelled_texts()
    model = quality.fit(spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5))
    x, y = np.array([quality.statistics(t) for _, t, _ in rows]), np.array([v for *_, v in rows])
    covariances = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(covariances[k] * (y == k).mean() for k in (0, 1))
    logs = []
    for k in (0, 1):
        c = 0.9 * covariances[k] + 0.1 * pooled
        c = 0.95 * c + 0.05 * np.diag(np.diag(c) + 1e-4) + 1e-4 * np.eye(len(c))
        d = x - x[y == k].mean(axis=0)
        logs.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,ij->i", d, np.linalg.solve(c, d.T).T))
    assert np.allclose(model.means, [x[y == k].mean(axis=0) for k in (0, 1)])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -40, 40))), atol=1e-6)


def test_log_count_ratios_and_weights_are_optimal(spark):
    rows = labelled_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5)
    held = [set(toxicity.grams(t).tolist()) for _, t, _ in rows]
    y = np.array([v for *_, v in rows])
    counts = {}
    for found, label in zip(held, y, strict=True):
        for g in found:
            counts.setdefault(g, [0, 0])[label] += 1
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    plain = {g: np.log(((b + 1) / (n1 + 2)) / ((a + 1) / (n0 + 2))) for g, (a, b) in counts.items() if a + b >= 3}
    strength = {g: abs(plain[g]) / np.sqrt(1 / (counts[g][1] + 1) + 1 / (counts[g][0] + 1)) for g in plain}
    buckets, r = toxicity.ratios(df, 200, 3)
    assert np.allclose(r, [plain[g] for g in buckets.tolist()])
    assert sorted(buckets.tolist()) == sorted(sorted(plain, key=lambda g: (-round(strength[g], 9), g))[:200])

    model = toxicity.fit(df, 200, 3, regularisation=0.01)
    at = {g: i for i, g in enumerate(sorted(buckets.tolist()))}
    ratio = np.array([plain[g] for g in at])
    x = np.zeros((len(rows), len(at)))
    for i, found in enumerate(held):
        for g in found & at.keys():
            x[i, at[g]] = ratio[at[g]]
    used = ratio != 0
    w = np.where(used, model.table[list(at)] / np.where(used, ratio, 1.0), 0.0)
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(x.T @ (p - y) / len(y) + 0.01 * w).max() < 1e-3 and abs((p - y).mean()) < 1e-3
    assert np.allclose([model.score(t) for _, t, _ in rows], p, atol=1e-5)
