"""SimHash linking, shingle similarity and repeat removal against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snapmill.llm import runindex, similar, simhash
from snapmill.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOC).withColumns(
        {"fp": F.lit("clash"), "start": F.lit(1), "component_id": F.lit(-1)})


def corpus():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(300)]
    base = [" ".join(rng.choice(words, n)) for n in (80, 120, 200, 40)]
    rows = []
    for b in base:
        rows += [b, b]
        for _ in range(12):
            w = b.split(" ")
            for k in rng.integers(0, len(w), 2):
                w[k] = rng.choice(words)
            rows.append(" ".join(w))
    rows += ["", None, "  \t", "one", "one two", "One TWO", "é ü", "x" * 5000, " ".join(rng.choice(words, 20_000))]
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("dense", [simhash.DENSE, 2])
def test_near_duplicates_against_all_pairs(spark, dense):
    rows = corpus()
    fp = {i: plain_fingerprint(t) for i, t in rows}
    want = closure(list(fp), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 3)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, rows), dense=dense).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.fingerprint == f"{fp[i]:016x}" for i, r in got.items())


def test_near_duplicates_of_odd_tables(spark):
    assert simhash.near_duplicates(docs_of(spark, [(1, "a")]).limit(0)).count() == 0
    rows = simhash.near_duplicates(docs_of(spark, [(None, "a b c d"), (None, "q"), (7, "a b c d"), (7, "a b c d"), (2, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (0, 7), (2, 2), (7, 7), (7, 7)]


def test_golay_keys_meet_within_three_bits():
    code, rng = simhash.Golay(), np.random.default_rng(0)
    assert sorted(set(code.count.tolist())) == [1, 6]
    for x in rng.integers(-2**63, 2**63 - 1, 300):
        y = int(np.int64(x).view(np.uint64))
        for b in rng.choice(64, 3, replace=False):
            y ^= 1 << int(b)
        pair = np.array([np.int64(x).view(np.uint64), y], np.uint64).view(np.int64)
        key, row, side = simhash.keys(pair, code)
        for a, b in ((0, 1), (1, 0)):
            assert set(key[(row == a) & (side == 0)]) & set(key[(row == b) & (side == 1)])


def test_golay_is_perfect():
    code = simhash.Golay()
    words = np.random.default_rng(2).integers(0, 1 << 23, 500)
    near, count = code.near(words)
    flipped = words ^ (1 << np.random.default_rng(3).integers(0, 23, 500))
    other, _ = code.near(flipped)
    for i in range(500):
        assert near[i, 0] in other[i, :6] and other[i, 0] in near[i, :6]


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame([*path, *star, (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_similar_groups_against_all_pairs(spark):
    rows = corpus()
    sets = {i: set(similar.shingles(t or "").tolist()) for i, t in rows}
    want = closure(list(sets), lambda i, j: sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    got = {r.doc_id: r.group_id for r in similar.groups(docs_of(spark, rows)).collect()}
    assert all(want[i] == want[got[i]] for i in got)  # nothing is linked that is not similar
    assert sum(got[i] != want[i] for i in got) <= 2
    kept = similar.keep_one(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i in got if got[i] == i}


def test_keep_one_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (4, "unlike any other text here at all")]
    kept = similar.keep_one(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 4]
    assert similar.keep_one(docs_of(spark, rows).limit(0)).count() == 0


def test_spanning_forest_has_the_smallest_distances():
    a, b, d = (np.array(x) for x in ([1, 1, 2, 8], [2, 3, 3, 9], [5, 2, 3, 1]))
    x, y, z = similar.spanning(a, b, d)
    assert sorted(zip(x.tolist(), y.tolist(), z.tolist(), strict=True)) == [(1, 3, 2), (2, 3, 3), (8, 9, 1)]


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        mark = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            s = raw[k:k + length]
            if s in seen:
                mark[k:k + length] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate(([0], mark.astype(int), [0]))) == 1).sum())
        out[i] = (len(raw), int(mark.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~mark].tobytes()).hexdigest())
    return out


def repeat_rows():
    rng = np.random.default_rng(9)

    def text(n):
        return "".join(rng.choice(list("abcde éü\n"), n))

    passages = [text(n) for n in (130, 100, 99, 260)]
    rows = [text(150) + passages[i % 4] + text(60) + passages[(i + 1) % 4] + text(40) for i in range(24)]
    rows += ["a" * 400, "ab" * 300, "a" * 99, "a" * 100, None, "", passages[0], passages[0], passages[3] * 3, "\0" * 250, "x" + passages[3][5:200]]
    rows += [text(300) * 2, text(20_000) + passages[1]]
    return [(i, t) for i, t in zip(rng.permutation(len(rows)).tolist(), rows, strict=True)]


@pytest.mark.parametrize(("length", "gram", "salt_rows"), [(100, 32, 16_384), (100, 32, 2), (100, 27, 16_384), (30, 8, 16_384)])
def test_repeats_against_all_strings(spark, length, gram, salt_rows):
    rows = repeat_rows()
    found = runindex.remove_repeats(docs_of(spark, rows), length, gram, salt_rows).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found}
    assert got == brute_repeats(rows, length)


def test_repeats_of_odd_tables(spark):
    p = "0123456789" * 3 + "abcdefghij" * 8
    assert runindex.remove_repeats(docs_of(spark, [(1, p)]).limit(0)).count() == 0
    rows = runindex.remove_repeats(docs_of(spark, [(None, p), (5, p + "1"), (5, p + "1"), (3, p), (5, p + "2")])).collect()
    # equal rows are one place; of different texts of one id one comes first; a null id comes last
    assert sorted((r.doc_id or 99, r.n_removed) for r in rows) == [(3, 0), (5, len(p)), (5, len(p)), (5, len(p)), (99, len(p))]


def test_cut_repeats_keeps_columns_and_whole_characters(spark):
    p = "é" + " ".join(str(i * i) for i in range(100, 160)) + "é"
    docs = docs_of(spark, [(1, p), (2, "x" + p + "yz"), (3, p), (4, None), (5, "")])
    out = {r.doc_id: r for r in runindex.cut_repeats(docs).collect()}
    assert set(out) == {1, 2, 4, 5}
    assert out[1].text == p and out[2].text == "xyz" and out[2].n_chars == 3 and out[4].text is None
    assert runindex.cut_repeats(docs).columns == docs.columns


def test_suffix_order_is_that_of_sorted_suffixes():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ab"), n)).encode() for n in (30, 7, 30, 1, 45)] + [b"abab", b"abab"]
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    rest = np.repeat(ends - 1, [len(t) + 1 for t in texts]) - np.arange(len(raw))
    order, _, _ = runindex.sort_suffixes(raw, rest, 20)
    plain = sorted(range(len(raw)), key=lambda i: (raw[i:i + rest[i]].tobytes(), i))
    assert order.tolist() == plain


def test_links_at_just_the_similarity_are_all_found(spark):
    """Pairs of 5 and 4, and of 45 and 36 shingles: a Jaccard similarity of 0.8, beside a line that all texts share."""
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for n, line in ((5, ""), (45, ""), (45, " all of the texts here end with this very same line")):
        for _ in range(40):
            words = [f"w{v}" for v in rng.integers(0, 10**9, n + 4)]
            shorter = words[:len(words) - (n + (10 if line else 0)) // 5]
            rows += [(at, " ".join(words) + line), (at + 1, " ".join(shorter) + line)]
            at += 2
    sets = {i: set(similar.shingles(t).tolist()) for i, t in rows}
    near = [i for i in range(0, at, 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])]
    assert len(near) >= 80
    got = {r.doc_id: r.group_id for r in similar.groups(docs_of(spark, rows)).collect()}
    want = {i: i - 1 if i % 2 and i - 1 in near else i for i in range(at)}
    assert got == want


def test_first_shingles_put_common_ones_last():
    hashes = np.arange(1, 11, dtype=np.uint64)
    common = np.array([1, 2], np.uint64)
    assert similar.prefix(hashes, common, np.array([1, 0]), 0.8).tolist() == [3, 4, 5]
    assert similar.prefix(hashes[:2], common, np.array([1, 0]), 0.8).tolist() == [2]
    assert similar.prefix(hashes[:0], common, np.array([1, 0]), 0.8).tolist() == []


def test_pairs_of_allowed_sizes_are_complete():
    rng = np.random.default_rng(6)
    n, root = rng.integers(1, 40, 60), rng.integers(0, 9, 60)
    for most in (7, 1 << 20):
        got = [tuple(sorted(p)) for i, j in similar.near_sizes(n, root, 0.8, most) for p in zip(i.tolist(), j.tolist(), strict=True)]
        want = [(i, j) for i in range(60) for j in range(i + 1, 60) if root[i] != root[j] and min(n[i], n[j]) >= 0.8 * max(n[i], n[j])]
        assert sorted(got) == want


def near_copies(count, n=120, changed=6):
    """Texts of one passage with `changed` words of their own: any two are just below or above the similarity."""
    rng = np.random.default_rng(8)
    base, rows = [f"w{v}" for v in range(n)], []
    for i in range(count):
        words = list(base)
        for at in rng.choice(n - 3 * changed, rng.integers(1, changed), replace=False):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_links_of_a_large_group_stay_few(spark):
    """All nodes apart: the forests of four tasks hand on less than a link per node each time they are cut, and every similar pair is in the whole pass."""
    rows = near_copies(80, changed=2)
    marked = similar.fingerprints(docs_of(spark, rows)).localCheckpoint()
    nodes = marked.withColumn("root", F.col("node"))
    assert nodes.select("node").distinct().count() == 80
    node = {r.doc_id: r.node for r in marked.collect()}
    sets = {node[i]: set(similar.shingles(t).tolist()) for i, t in rows}
    like = {(min(a, b), max(a, b)) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(like) == 80 * 79 // 2
    shared = similar.shared_firsts(nodes)
    known = nodes.select("node", "root")
    few = {(r.a, r.b) for r in similar.rest_links(shared, known, whole=False).collect()}
    every = [(r.a, r.b) for r in similar.rest_links(shared, known).collect()]
    assert like <= set(every) and len(every) == len(set(every))
    assert few <= set(every) and len(few) < 8 * 80
    links = spark.createDataFrame(every, "a long, b long")
    assert {(r.a, r.b) for r in similar.reaching(links, nodes).collect()} >= like
    # texts that share too little hand on nothing, however many they are
    apart = [(i, " ".join([f"s{v}" for v in range(76)] + [f"own{i}x{v}" for v in range(20)])) for i in range(80)]
    nodes = similar.fingerprints(docs_of(spark, apart)).withColumn("root", F.col("node")).localCheckpoint()
    assert similar.rest_links(similar.shared_firsts(nodes), nodes.select("node", "root")).count() == 0


def test_a_large_group_of_near_copies_against_all_pairs(spark):
    rows = near_copies(60) + [(100 + i, t + " and an end") for i, t in near_copies(20, 60, 8)]
    sets = {i: set(similar.shingles(t).tolist()) for i, t in rows}
    want = closure(sorted(sets), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    assert {r.doc_id: r.group_id for r in similar.groups(docs_of(spark, rows)).collect()} == want


def test_parity_bits_differ_no_more_than_the_sets():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for k in (0, 1, 5, 60, 300):
        other = np.concatenate((base[k:], rng.integers(0, 1 << 63, k // 2, dtype=np.uint64)))
        bits = int(np.bitwise_count(similar.parities(base) ^ similar.parities(other)).sum())
        assert bits <= k + k // 2 and (bits > 0) == (k > 0)
