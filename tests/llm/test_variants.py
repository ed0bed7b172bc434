"""Spelling variants against plain pair-by-pair comparison, with groups small enough for every way a pair can be found."""

import collections
import random
import re
import zlib

import pytest
from conftest_llm import EDGES

from millrace.llm import variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    n = {w: k for w, k in counts.items() if k >= 2}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def corpus(seed, letters, lengths, words, docs):
    r = random.Random(seed)
    vocab = ["".join(r.choice(letters) for _ in range(r.choice(lengths))) for _ in range(words)]
    often = vocab[: max(1, words // 20)]
    return [(i, " ".join(r.choice(often if r.random() < 0.6 else vocab) for _ in range(60))) for i in range(docs)]


@pytest.mark.parametrize("group", [1, 3, 40, variants.GROUP])
def test_against_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(variants, "GROUP", group)
    rows = corpus(1, "ab", [7, 8, 9], 200, 60) + corpus(2, "abcé×", [7, 8], 400, 60)
    rows += [(500, "aaaaaaa aaaaaaaa AAAAAAAAA aaaaaaa aaaaaaaa aaaaaaaaa abababab bababab abababab bababab")]
    got = variants.grouped(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = expected(rows)
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert any(r.form for r in got) and max(r.n_near for r in got) > 5


def test_middles_alone_join_pairs(spark, monkeypatch):
    """With groups of one no pair shares a beginning or an ending, so all pairs come from what is left."""
    monkeypatch.setattr(variants, "GROUP", 1)
    words = ["abcdefg", "abcxefg", "abcdeg", "abcdeffg", "xbcdefg", "abcdefx", "abcdefgg", "zzzzzzz", "zzzzzzzz"]
    vocab = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n bigint")
    got = collections.Counter(frozenset((r.a, r.b)) for r in variants.near_pairs(vocab).collect())
    want = {frozenset((a, b)) for a in words for b in words if a != b and one_edit(a, b)}
    assert got == collections.Counter(want)


def test_the_acceptor_is_minimal():
    import numpy as np

    words = sorted({a + b for a in ("ab", "cd", "abc") for b in ("xyz", "xy", "w")})
    made = variants.Acceptor(np.zeros(len(words), np.int64), words)

    def endings(prefix):
        return frozenset(w[len(prefix) :] for w in words if w.startswith(prefix))

    assert made.state.max() + 1 == len({endings(w[:k]) for w in words for k in range(len(w) + 1)})


def test_long_words_edges_and_other_columns(spark, docs_of):
    long = [(20, "y" * 20_000 + " " + "y" * 19_999), (21, "y" * 20_000 + " " + "y" * 19_999), (22, "q" + "yx" * 9_000), (23, "q" + "yx" * 9_000), (24, "yx" * 9_000), (25, "yx" * 9_000)]
    rows = [*EDGES, *long, (None, "lettering lettering"), (30, "Lettering Ärmelkanal ärmelkanal"), (30, "Lettering Ärmelkanal ärmelkanal")]
    docs = docs_of(rows).selectExpr("*", "1 as word", "2 as n", "'x' as r", "3 as h")
    assert set(map(tuple, variants.grouped(docs).collect())) == expected(rows)
    assert variants.grouped(docs_of([])).count() == 0
