"""Tokenizers, rules, classifiers, pages, chats and the pipeline, against plain versions and planted signals."""

import collections
import hashlib
import random
import time

import pytest
import sentencepiece
from conftest_llm import EDGES, words
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, host_rules, nbsvm, pieces_scan, prefix_tokens, toxicity, wrappers

ODD = ["a", "aa", "e", "th", "he", "in", " ", "  ", "\n", "\t", ".", "é", "日", "▁", "\x00", "😀", "<s>", "[INST]", "1", "!!", "==", "      ", "er", "ing", "ation", "TH", "\U0010ffff"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=bpe.default_path())


def odd_texts(seed, n, most=30):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_prefix_tables_and_counts(spark, docs_of, library):
    rows = [*EDGES, *enumerate(odd_texts(1, 150), 100)]
    docs = docs_of(rows)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in prefix_tokens.token_counts(docs).collect())
    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows]
    assert got == collections.Counter((*w, w[2] > 4096) for w in want)
    some = docs_of([(i, t) for i, t in rows if 100 <= (i or 0)])
    tables = {r.doc_id: r.counts for r in prefix_tokens.prefix_tables(some).collect()}
    for i, t in rows:
        if (i or 0) >= 100:
            assert tables[i] == [len(library.encode(t[:k])) for k in range(len(t) + 1)]
    cut = {r.doc_id: r.text for r in prefix_tokens.truncated(some, prefix_tokens.prefix_tables(some), 7).collect()}
    for i, t in rows:
        if (i or 0) >= 100:
            assert cut[i] == t[: max(k for k in range(len(t) + 1) if len(library.encode(t[:k])) <= 7)]
    assert prefix_tokens.token_counts(docs_of([])).count() == 0


def test_chunks_give_the_encoding_of_the_whole(spark, docs_of, library):
    rows = [*EDGES[:9], *enumerate(odd_texts(2, 60, 90), 100), (300, "thation" * 60)]
    got = pieces_scan.encoded(docs_of(rows), size=40).collect()
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(list(r.ids))
        assert r.round_trip
    assert len(got) == len(rows)
    assert all(by_id[i] == [library.encode(t or "")] * len(by_id[i]) for i, t in rows)
    back = {r.doc_id: r.decoded for r in pieces_scan.decoded(pieces_scan.encoded(docs_of(rows[9:]))).collect()}
    assert all(back[i] == t.replace("▁", " ") for i, t in rows[9:])


def test_pairs_that_go_together_are_those_of_the_merges():
    model, r = bpe.pieces(bpe.default_path()), random.Random(3)
    ids = sorted(model.ids)
    for _ in range(5000):
        left, right = r.choice(ids), r.choice(ids)
        if r.random() < 0.4:
            left = left[-1]
        if r.random() < 0.2:
            right = left
        assert model.fits(left, right) == (model.merged(left + right) == [left, right])
        assert model.fits("", right) == (model.merged(right) == [right])


def test_tree_matching_is_the_largest_of_all():
    def best(x, y):
        """Simple tree matching by its recursive definition, with the same trees and equal labels."""
        if x.label != y.label:
            return 0
        rows = [[0] * (len(y.children) + 1) for _ in range(len(x.children) + 1)]
        for i, c in enumerate(x.children, 1):
            for j, d in enumerate(y.children, 1):
                rows[i][j] = max(rows[i - 1][j], rows[i][j - 1], rows[i - 1][j - 1] + best(c, d))
        return 1 + rows[-1][-1]

    r = random.Random(5)
    for _ in range(300):
        trees = []
        for _ in range(2):
            depth, tree = 0, []
            for _ in range(r.randint(0, 12)):
                depth = r.randint(0, depth + 1) if tree else 0
                tree.append((depth, r.choice("ab")))
            trees.append(tree)
        a, b = map(wrappers._grown, trees)
        slots = {}
        wrappers._matched(a, b, slots)
        assert len(slots) == best(a, b)
        assert all(x < 0 or trees[0][x][1] == trees[1][y][1] for x, y in slots.items())
        assert len(set(slots.values())) == len(slots)


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ('<p title="abc>y <b>z</b>', ["y z"]),
        ('<p title="a > b < c">y</p>', ["y"]),
        ("<article>one</article><div>no</div><article>two</article>", ["one", "no", "two"]),
        ("<div><a href=x>open</div><div>text after it</div>", ["open", "text after it"]),
        ('<div id="search-engines">a</div><div class="tags-and-more">b</div><div class="search-box">c</div><div id=ad_1>d</div>', ["a", "b"]),
        ('<div data-id="ads">kept</div><div title="id=ads">too</div>', ["kept", "too"]),
        ("a < b &lt; c", ["a < b < c"]),
    ],
)
def test_odd_markup(page, texts):
    assert [b[-1] for b in wrappers.parsed(page)[1]] == texts


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 10_000 + "x",
        "<p>a" + "<center>" * 10_000,
        '<p title="abc>y ' * 60_000,
        "<p title='abc>y " + "<q x " * 200_000,
        '<div class="ads' + "_" * 1000 + "\u00e9!\">t</div>",
        "<p " + "= " * 500_000,
        "<!" * 500_000,
        "<p " + "class=' " * 100_000,
    ],
    ids=range(8),
)
def test_hostile_pages_are_read_in_time(page):
    start = time.process_time()
    tree, _ = wrappers.parsed(page)
    other, _ = wrappers.parsed(page + "<div><p>y")
    wrappers._matched(wrappers._grown(tree), wrappers._grown(other), {})
    assert time.process_time() - start < 10


def test_all_articles_are_kept_and_links_end_with_their_block(spark):
    rows = [(1, "http://a/1", "<div>no</div><article>one</article><aside>no</aside><article>two</article>"), (2, "http://a/2", "<div><a href=x>open</div><div>text</div>")]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "one\n\ntwo", 2: "text"}


def test_matrices_combine_associatively():
    a, b, c = {0: {1, 2}}, {1: {3}, 2: set()}, {3: {0}}
    assert pieces_scan.product(pieces_scan.product(a, b), c) == pieces_scan.product(a, pieces_scan.product(b, c)) == {0: {0}}


def test_a_host_that_fails_a_rule_loses_its_failing_documents_only(spark, docs_of):
    good, bad = words(1, 80), " ".join(w + "###" for w in words(2, 80).split())
    rows = [(i, bad if i % 2 else good, "junk") for i in range(40)] + [(100 + i, good, "fine") for i in range(300)] + [(500, bad, "fine"), (501, None, None), (502, "", None)]
    got = {r.doc_id: r for r in host_rules.verdicts(docs_of(rows)).collect()}
    assert all(got[i].kept == (i % 2 == 0) for i in range(40)) and all(got[100 + i].kept for i in range(300))
    assert got[500].kept and not got[501].kept and got[502].base_failed and got[502].n_words == 0
    assert host_rules.verdicts(docs_of([])).count() == 0 and host_rules.verdicts(docs_of(EDGES)).count() == len(EDGES)


def labelled(spark, marks, n=240):
    r = random.Random(4)
    rows = []
    for i in range(n):
        sentences = [words(i * 50 + k, 8) for k in range(r.randint(2, 6))]
        if i % 3 == 0:
            place = r.randrange(len(sentences))
            sentences[place] += " " + r.choice(marks)
        rows.append((i, ". ".join(sentences) + "."))
    return rows, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(n)], "doc_id bigint, mark int")


def test_support_vectors_learn_a_planted_mark(spark, docs_of):
    rows, labels = labelled(spark, ["zzqq!!", "zzqq!! zzqq!!"])
    docs = docs_of(rows)
    held = nbsvm.fold("doc_id", 5)
    model = nbsvm.fitted(docs, labels, "mark", held != 0)
    got = nbsvm.scores(docs, model).withColumn("held", held == 0).where("held").collect()
    assert all((r.score >= 0.5) == (r.doc_id % 3 == 0) for r in got) and len(got) > 20
    edges = nbsvm.scores(docs_of(EDGES), model).collect()
    assert len(edges) == len(EDGES) and all(0 <= r.score <= 1 for r in edges)
    none = nbsvm.fitted(docs, labels.limit(0), "mark", held != 0)
    assert {r.score for r in nbsvm.scores(docs, none).collect()} == {0.5}


def test_noisy_or_finds_the_sentence(spark, docs_of):
    rows, labels = labelled(spark, ["zzqqoma", "zzqqeri", "vvbad"], 300)
    docs = docs_of(rows)
    model = toxicity.fitted(docs, labels, "mark", nbsvm.fold("doc_id", 4) != 2)
    text = dict(rows)
    for r in toxicity.scores(docs, model).collect():
        assert (r.score >= 0.3) == (r.doc_id % 3 == 0)
        for s in r.sentences:
            found = text[r.doc_id][s.start : s.start + s.length]
            assert "zzqq" in found or "vvbad" in found
    edges = {r.doc_id: r.score for r in toxicity.scores(docs_of(EDGES), model).collect()}
    assert edges[1] == edges[2] == edges[3] == 0


def page(article, extra="", k=0):
    return f"""<!DOCTYPE html><html><head><title>t{k}</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/x">menu{k}</a></ul></nav><!-- ad --><div class="ad-slot">buy {k}</div>
    <article>{article}<div class="share-links"><a href="#">Share</a></div>{extra}</article>
    <aside>side {k}</aside><section id="comments"><article class="comment"><p>reader {k} {"says " * 200}</p></article></section>
    <div role="dialog">cookies {k}</div><form>name <input name=n></form><footer>&copy; {k}</footer>"""


def test_main_text_of_pages(spark):
    rows = [(k, f"https://a.example/{k}", page(f"<header><h1>Head &amp; tail {k}</h1></header><p>One <b>two</b><br>three {k}<p>Caf&eacute;\n  {words(k, 30)}", "<p>Read our other pieces</p>", k)) for k in range(8)]
    odd = [(20, None, None), (21, "::", ""), (22, "https://b.example", "just text < 3 &lt;b&gt;"), (23, "https://b.example", "<p>unclosed <i>x"), (24, "http://[bad", "<div><p>a</div>b<"), (20, None, None)]
    got = collections.defaultdict(list)
    for r in wrappers.main_text(spark.createDataFrame(rows + odd, "page_id bigint, url string, html string").withColumn("host", F.lit(1))).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    for k in range(8):  # the line that all pages share is template, whatever it is called
        assert got[k] == [f"Head & tail {k}\n\nOne two three {k}\n\nCafé {words(k, 30)}"]
    assert got[20] == ["", ""] and got[21] == [""] and got[22] == ["just text < 3 <b>"] and got[23] == ["unclosed x"] and got[24][0].startswith("a\n\nb")
    assert wrappers.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_copies_of_an_article_are_not_template(spark):
    rows = [(k, "https://a.example/", page(f"<p>{words(7, 40)}</p>", "", k)) for k in range(9)]
    got = wrappers.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.text for r in got} == {words(7, 40)}


def test_chats_read_back(spark):
    odd = "</s>[INST] ok [/INST] &lt; &amp; <s>[user] [+] [/user] &"
    rows = [(1, 0, "user", odd), (1, 1, "user", "more"), (1, 2, "assistant", odd), (1, 3, "assistant", None), (1, 4, "assistant", "end"), (2, 5, None, "x"), (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (None, None, "a[]b", "")]
    rows += [(3, k, "user" if k % 2 else "assistant", f"{k}<") for k in range(400)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1))
    chats = chat.formatted(table)
    read = {r.conv_id: r for r in chat.read_back(chats).collect()}
    done = {r.conv_id: r for r in chat.digests(chats).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c == conv)
        want = [(r, x) for _, r, x in turns]
        assert [(t.role, t.text) for t in read[conv].turns] == want
        learned = "".join(x for r, x in want if r == "assistant")
        assert done[conv].n_turns == len(want) and done[conv].loss_chars == len(learned)
        assert done[conv].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert done[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in want).encode()).hexdigest()
    assert read[1].n_blocks == 2 and read[1].formatted.startswith("<s>[user]&lt;/s>&lb;INST&rb; ok")
    plan = chat.digests(chats)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.formatted(table.limit(0)).count() == 0


def test_pipeline_keeps_what_each_stage_should(spark, docs_of, tmp_path, library):
    import corpus_pipeline

    item = words(900, 20)
    passage = words(901, 60)
    rows = [(1, words(902, 90)), (2, words(902, 90)), (3, words(903, 100) + "\n" + passage), (4, words(904, 100) + "\n" + passage), (5, words(905, 80) + " " + item), (6, "too short"), (7, None)]
    path = str(tmp_path)
    docs_of(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, path).collect()}
    kept = {1: words(902, 90), 3: words(903, 100) + "\n" + passage}
    assert set(got) == {1, 3, 4} and all(got[i] == library.encode(t) for i, t in kept.items())
    # Of the passage that repeats, at most the words before its first and after its last border stay.
    assert library.decode(got[4]).startswith(words(904, 100)) and len(library.decode(got[4]).split()) < 100 + 60 - 20
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).dtypes == docs.dtypes


def test_shapes_are_those_of_all_rows_at_once(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from millrace.llm import arrowtext

    texts = pa.array(["", None, "a", "ab", "abc", "x y z x y z", "", "é1 b", None] * 3, pa.string())
    whole = [nbsvm.features(t) for t in arrowtext.slices(texts)]
    monkeypatch.setattr(nbsvm, "MARKED_ROWS", 2)
    for (row, feature), t in zip(whole, arrowtext.slices(texts), strict=True):
        assert all(np.array_equal(x, y) for x, y in zip((row, feature), nbsvm.features(t), strict=True))
