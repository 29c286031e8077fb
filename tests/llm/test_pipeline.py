"""The pipeline's stages on a small folder against brute force, and the registered queries."""

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from snapmill.llm import decontam, quality, similar

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_against_brute_force(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in quality.keep_good(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    sets = {i: set(similar.shingles(t or "").tolist()) for i, t in rows.items()}
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(rows)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    seen, cut = set(), {}
    for i in (i for i in ids if find(i) == i):
        raw = (rows[i] or "").encode()
        mark = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                mark[k:k + 100] = True
            seen.add(raw[k:k + 100])
        cut[i] = np.frombuffer(raw, np.uint8)[~mark].tobytes().decode("utf-8", "ignore")
    cut = {i: t for i, t in cut.items() if t or not rows[i]}
    table = spark.createDataFrame([(i, t) for i, t in cut.items()], "doc_id long, text string")
    leaks = {r.doc_id for r in decontam.contaminated(table, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    words = {i: len(t.encode().split()) for i, t in cut.items() if i not in leaks}
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == words


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
