"""Page text, token files, packing, decontamination and neighbours."""

import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmill.llm import anngraph, decontam, packing, pagetext, tokenfile

DOC = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav><div class="ad">Buy this thing now please.</div>
<article><h1>Head &amp; line</h1><p>First   block of words that are many enough to count here.</p><p>Second<br>block &eacute;, <b>bold</b> text
goes on and on for the reader of it.</p><div class="related">Read this too</div><p>Third block with some more words to read.</p></article>
<div id="comments"><p>Nice article, thanks a lot.</p></div><footer>&copy; me</footer></body></html>"""


def tokenizer_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def test_main_text(spark):
    rows = [(1, "u", PAGES), (1, "u", PAGES), (2, None, None), (None, "v", ""), (4, "w", "just text"), (5, "x", "<p>unclosed <b>tag"),
            (6, "y", "<script>var x = 1;"), (7, "z", "a < b && c > d &lt; e &#x41;"), (8, "q", "<p>" + "word " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "tag": F.lit(1)})
    got = pagetext.main_text(pages).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    want = ("Head & line\nFirst block of words that are many enough to count here.\nSecond block é, bold text goes on and on for the reader of it."
            "\nThird block with some more words to read.")
    assert text[1] == want
    assert text[2] == "" and text[None] == "" and text[4] == "just text" and text[5] == "unclosed tag" and text[6] == ""
    assert text[7] == "a < b && c > d < e A"
    assert len(text[8].split()) == 50_000
    assert all(r.n_chars == len(r.text) for r in got)
    assert pagetext.main_text(pages.limit(0)).count() == 0


def test_main_text_equals_the_marked_content(spark):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in pagetext.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>)", r.html, re.S)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\0", inner.replace("<br>", " "))).split("\0")
        assert r.text == "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


def test_best_run_is_the_maximum_of_all_runs():
    source = "<a>x y</a><p>one two three</p><nav>m</nav><p>four five</p><li>z</li><p>six seven eight nine</p>"
    costs = {"p": 0.1, "/p": 0.1, "li": 1.5, "/li": 1.5, "a": 3.0, "/a": 3.0}
    page = pagetext.Page(source)
    blocks = page.blocks
    best = max(itertools.combinations(range(len(blocks) + 1), 2), key=lambda ij: sum(
        (0 if b[2] else len(b[0].split())) - (sum(costs.get(t, pagetext.UNKNOWN) for t in b[1]) if k else 0)
        for k, b in enumerate(blocks[ij[0]:ij[1]])))
    assert pagetext.content(source, costs) == "\n".join(b[0] for b in blocks[best[0]:best[1]] if not b[2])


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_values_survive_their_bytes(n):
    rng = np.random.default_rng(n)
    v = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) >> rng.integers(0, 32, n).astype(np.uint32)
    control, data = tokenfile.pack_values(v)
    assert len(control) == -(-n // 4)
    assert tokenfile.unpack_values(control, data, n).tolist() == v.tolist()


def test_token_file_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    texts = ["it's a test.", None, "", "two  spaces \n and\ttabs ", "Übung №5 日本語 ²", "<|endoftext|> x", "I'LL we've 'tis", "a_b 12 3.5", "x " * 30_000, "\x1c\x85"]
    rows = [(7 * i % 10, x) for i, x in enumerate(texts)] + [(3, texts[9]), (None, "last")]
    docs = spark.createDataFrame([(i, x, None, None, 1) for i, x in rows], DOC).withColumns({"ids": F.lit(1), "part": F.lit(2)})
    got = tokenfile.token_file(docs, tokenizer_path()).collect()
    want = sorted(((-1 if i is None else i), np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, x in rows)
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.start, r.n_tokens, bytes(r.ids)) for r in got)
    assert [(k, b) for k, _, _, b in got] == want
    starts = np.cumsum([0] + [n for _, _, n, _ in got])
    assert [s for _, s, _, _ in got] == starts[:-1].tolist()
    assert tokenfile.token_file(docs.limit(0), tokenizer_path()).count() == 0


def test_token_queries_agree_with_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in tokenfile.token_file(docs, tokenizer_path()).collect():
        assert zlib.crc32(bytes(r.ids)) == zlib.crc32(np.array(t.encode(text[r.doc_id], add_special_tokens=False).ids + [2], "<u4").tobytes())


def test_boundaries_against_all_choices():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        counts = rng.integers(1, 9, len(lengths))
        for k in (1, 2, 3):
            def padding(bounds):
                return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths.tolist(), counts.tolist(), strict=True))
            best = min(padding((*x, lengths[-1])) for x in itertools.combinations(lengths[:-1].tolist(), min(k, len(lengths)) - 1))
            got = packing.boundaries(lengths, counts, k)
            assert padding(got) == best and len(got) <= k and got[-1] == lengths[-1]


def test_packing_fills_batches(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 50)), None, None, 1) for i in range(300)]
    rows += [(1000, None, None, None, None), (None, "a b", None, None, 1), (7, "x y z", None, None, 1), (2000, "w " * 333, None, None, 1)]
    docs = spark.createDataFrame(rows, DOC).withColumns({"bucket": F.lit(1), "n": F.lit(2), "salt": F.lit("s")})
    got = packing.pack(docs, longest=40, buckets=4, budget=200).collect()
    assert sum(r.n_tokens for r in got) == sum(len((r[1] or "").split()) for r in rows)
    assert len({(r.batch_id, r.slot) for r in got}) == len(got)
    by = {}
    for r in got:
        assert r.n_tokens <= r.bucket_length and r.n_padding == r.bucket_length - r.n_tokens
        by.setdefault(r.batch_id, []).append(r)
    partly = {}
    for batch in by.values():
        bound = batch[0].bucket_length
        assert {r.bucket_length for r in batch} == {bound} and len(batch) * bound <= 200
        assert sorted(r.slot for r in batch) == list(range(len(batch)))
        if len(batch) < 200 // max(bound, 1):
            partly[bound] = partly.get(bound, 0) + 1
    assert all(n == 1 for n in partly.values()) and sorted(by) == list(range(len(by)))
    assert packing.pack(docs.limit(0)).count() == 0


ARTICLE = ("<html><body><nav><ul><li><a href='/'>Home</a></li><li>All topics</li></ul></nav><article><h1>A title of the page</h1>"
           "<p>{} Some more words of the first paragraph of this long article follow here without any end in sight.</p>"
           "<p>The last words of it are these, and there are quite a lot of them in this paragraph too.</p></article><footer>foot</footer></body></html>")


@pytest.mark.parametrize("odd, text", [
    ("<b title=it's>kept</b>", "kept"), ("<a href=/x?q=it's>a link</a> goes on", "a link goes on"), ('<a href="/x>open quote</a> goes on', "open quote goes on"),
    ("<a href='/x>open quote</a> it's on", "open quote it's on"), ("x <math><mi>a</mi><mo>+</mo><mn>1</mn></math> y", "x a+1 y"),
    ('<b title="a > b">quoted</b>', "quoted"), ("<b data-x='<i>x</i>'>data</b>", "data"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<object data=x>instead</object>", "instead"), ('<b class = "y"id=z>no space</b>', "no space")])
def test_malformed_markup_loses_and_leaks_nothing(odd, text):
    words = text + " Some more words of the first paragraph of this long article follow here without any end in sight."
    last = "The last words of it are these, and there are quite a lot of them in this paragraph too."
    assert pagetext.content(ARTICLE.format(odd), {}).split("\n")[-2:] == [words, last]


def test_an_open_tag_ends_with_the_page():
    assert pagetext.content('<p>text of the page</p><p class="x', {}) == "text of the page"
    assert pagetext.content("<a " + 'b="c" ' * 50_000, {}) == ""


ITEM = "If Anna buys 12 apples for 3 dollars each and then sells 5 of them to Peter for 4 dollars how much money does Anna have left"


def test_contamination(spark):
    other = "Completely different words are written in this line of the text so that nothing at all is shared with any question here"
    swapped = ITEM.replace("Anna", "Maria").replace("Peter", "John").replace("12", "47").replace(" 3 ", " 6 ").replace(" 5 ", " 9 ")
    mixed = ITEM.replace("Anna", "Maria", 1).replace("12 apples", "3 apples").replace("for 3", "for 12")
    rows = [(1, f"Some text before it. {ITEM} and some text after it."), (2, f"so {swapped} yes"), (3, other), (4, None), (5, ""),
            (6, ITEM[:60]), (7, f"{ITEM} {ITEM}"), (7, other), (None, ITEM), (8, mixed + " " + other)]
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], DOC).withColumns({"item_id": F.lit(1), "window": F.lit(2), "slots": F.lit(3)})
    bench = spark.createDataFrame([(1, ITEM), (2, other + " indeed"), (3, None), (None, ITEM), (4, "short one")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    assert {(1, 1), (2, 1), (7, 1), (3, 2), (7, 2), (8, 2)} <= got
    assert not {d for d, _ in got} & {4, 5, 6}
    # the broadcast and the shuffled join agree
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, memory_windows=3).collect()} == got
    kept = decontam.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 4, 5, 6]
    assert decontam.contaminated(docs.limit(0), bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0


NAMES = "Yesterday Anna met Peter and Maria near Berlin while Otto and Clara walked to Vienna with John for 3 hours"


def test_recased_and_rewrapped_copies_are_found(spark):
    words = NAMES.split()
    rows = [(1, NAMES.upper()), (2, NAMES.lower()), (3, "\n".join([" ".join(words[:6]), " ".join(words[6:11]), " ".join(words[11:])])),
            (4, "x " * 50_000 + NAMES.title() + " y" * 50_000), (5, NAMES.replace("Anna", "Eva").replace("3", "8")),
            (10, "A title without a mark\n" + NAMES.replace("Anna", "Eva").replace("Peter", "Ann")),
            (6, " ".join(sorted(words))), (7, "He said: what is love? Nobody knew. The End, of all"), (8, "WHAT IS LOVE"), (9, "what love is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, NAMES), (2, "What is love?")], "item_id long, text string")
    expected = {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (7, 2), (8, 2), (10, 1)}
    for bound in (1_000_000, 3):
        got = decontam.contaminated(docs, bench, memory_windows=bound).collect()
        assert {(r.doc_id, r.item_id) for r in got} == expected
        assert all(r.share == r.n_matched / r.n_windows for r in got)


def brute_contaminated(docs, bench, size=5, similarity=0.8):
    """Windows as tuples, every pair of texts, without hashes, joins or numbered words."""
    def template(text, by_line):
        out, initial = [], True
        for line in text.split("\n"):
            initial = initial or by_line
            for raw in line.split():
                out += decontam.word(raw, initial)
                initial = raw[-1] in ".!?:"
        return out

    def plain(text):
        return [low for raw in text.split() if (low := raw.strip(decontam.EDGE).lower())]

    def cut(tokens, n):
        n = min(n, len(tokens))
        return [tuple(tokens[i:i + n]) for i in range(len(tokens) - n + 1)] if n else []

    found = {}
    for d, text in docs:
        both, our_plain = [cut(template(text, by), size) for by in (False, True)], plain(text)
        for i, item in bench:
            theirs, their_plain = cut(template(item, False), size), plain(item)
            if not theirs:
                continue
            pairs = {(w, p, tuple(v for _, v in a), tuple(v for _, v in b)) for w, a in enumerate(theirs) for ours in both
                     for p, b in enumerate(ours) if [t for t, _ in a] == [t for t, _ in b]}
            pairs = [(w, p, list(a), list(b)) for w, p, a, b in sorted(pairs, key=lambda x: (x[1], x[0]))]
            one = (decontam.best_occurrence(pairs, len(theirs), similarity * len(theirs)) if pairs else 0, len(theirs))
            n = min(size, len(their_plain))
            held = set(cut(our_plain, n)) if len(our_plain) >= n else set()
            windows = cut(their_plain, n)
            two = (sum(w in held for w in windows), len(windows))
            best = max((one, two), key=lambda x: x[0] / x[1])
            if best[0] >= similarity * best[1]:
                found[d, i] = (best[1], best[0])
    return found


def test_contamination_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    vocabulary = ["cat", "Anna", "Peter", "12", "7", "5kg", "km", "runs", "house.", "the", "three", "Berlin,", "and", "OF"]
    bench = [(i, " ".join(rng.choice(vocabulary, int(n)))) for i, n in enumerate([3, 4, 7, 12, 12, 20, 30])]
    docs = []
    for d in range(60):
        w = rng.choice(vocabulary, int(rng.integers(0, 60))).tolist()
        item = bench[int(rng.integers(len(bench)))][1].split()
        for _ in range(int(rng.integers(0, 3))):
            item[int(rng.integers(len(item)))] = str(rng.choice(vocabulary))
        at = int(rng.integers(len(w) + 1))
        text = " ".join(w[:at] + item + w[at:])
        docs.append((d, text.upper() if d % 7 == 0 else text.replace(" ", "\n", 3) if d % 5 == 0 else text))
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    expected = brute_contaminated(docs, bench)
    assert len(expected) > 20 and {(r.doc_id, r.item_id): (r.n_windows, r.n_matched) for r in got.collect()} == expected


def test_slots_must_agree():
    same = [(0, ["7", "", "anna"], ["9", "", "eva"]), (1, ["7", "", ""], ["9", "", ""]), (2, ["", "anna", ""], ["", "eva", ""])]
    assert decontam.consistent(same) == {0, 1, 2}
    assert decontam.consistent([*same, (3, ["7", "", ""], ["5", "", ""])]) == {0, 1, 2}
    assert decontam.consistent([*same, (4, ["8", "", ""], ["9", "", ""])]) == {0, 1, 2}


def test_variants_of_an_item_side_by_side(spark):
    item = "Of {0} red and {1} blue cars {0} take {1} men and {0} women to {1} towns with {0} coins and {1} notes"
    exact, first, second = item.format(12, 7), item.format(31, 8), item.format(45, 20)
    longer = item.format(31, 8).replace("women to", "women quite soon to")
    rows = [(1, "What is 12 + 7? What is 13 + 5?"), (2, f"{exact} . {first}"), (3, f"{first} . {second}"),
            (4, " . ".join(item.format(20 + i, 90 - i) for i in range(9))), (5, f"{exact.replace('12', '9', 2)} . {longer} . {item.format(3, 9)[:40]}"),
            # every value is replaced by another one each time
            (6, item.replace("{0}", "{}").replace("{1}", "{}").format(*range(50, 58))),
            # texts repeated with one id do not contradict one another
            (7, first), (7, second)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, exact), (2, "What is 12 + 7?")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_matched for r in decontam.contaminated(docs, bench).collect()}
    n = len(decontam.windows(decontam.Canonical().tokens(exact).templates[0]))
    assert got == {(1, 2): 1, (2, 1): n, (3, 1): n, (4, 1): n, (5, 1): n, (7, 1): n}


def test_neighbours_against_all_pairs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (None, x[0].tolist()), (5060, [1.0, 2.0]), (5080, [None] + [1.0] * 23),
             (5100, [float("inf")] + [1.0] * 23), (7, x[7].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"a": F.lit(1), "rank": F.lit(2), "shard": F.lit(3)})
    got = {}
    for r in anngraph.nearest(table, shard_rows=1000).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 20))
    x = x.astype(np.float64)
    hits = 0
    for q, found in got.items():
        found.sort()
        score = x @ x[q]
        assert [n for n, _, _ in found] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        best = sorted((-round(score[v], 9), v) for v in range(3000) if v != q)[:20]
        hits += len({v for _, v in best} & {v for _, v, _ in found})
    assert hits / (20 * len(got)) > 0.9
    few = {r.query_id: 0 for r in anngraph.nearest(table.where("vec_id in (0, 20, 21)")).collect()}
    assert set(few) == {0, 20}
    assert anngraph.nearest(table.limit(0)).count() == 0


def test_lines_and_words_are_encoded_apart(spark):
    """Single ends of line part the words that are remembered; doubled ones and ones beside other white space do not."""
    encoder = tokenfile.Encoder(tokenizer_path())
    rows = ["one two.\nThree four,\nfive", "a\nb", "\na", "a\n", "a\n\nb", "a\r\nb x", "a\xa0\nb y", "x y\n1b", "x's\n's y", "é.\nÉ a", "\n", ""]
    got = encoder.encode(rows)
    assert got == [np.array(encoder.tokenizer.encode(x, add_special_tokens=False).ids, encoder.kind).tobytes() for x in rows]
    assert not any("\n" in w for w in encoder.words if w not in rows[2:])


def test_workers_forget_the_encoder_after_its_pass(spark):
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(64)], "doc_id long, text string").repartition(8)
    tokenfile.write(docs, tokenizer_path(), tokenfile.scratch_path(spark, "tokens"))

    def held(batches):
        import pandas as pd
        for b in batches:
            yield pd.DataFrame({"n": [tokenfile.encoder_of.cache_info().currsize] * len(b)})

    assert sum(r.n for r in docs.coalesce(1).mapInPandas(held, "n int").collect()) == 0
