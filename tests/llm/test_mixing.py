"""Mixing sources: targets against a plain round-by-round fill, copies, edge rows."""

import collections
import random
import re

import pytest
from conftest_llm import EDGES, words

from millrace.llm import mixing


def filled(sizes, weights, share, most):
    """Targets by dealing what is over again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        if not rest:
            return {s: most * sizes[s] for s in order}
        level = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in rest)
        over = [s for s in rest if level * weight[s] >= most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in order}
        full.update(over)


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


@pytest.mark.parametrize("few", [mixing.FEW, 3])
def test_targets_and_copies(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "FEW", few)
    r = random.Random(3)
    names = [None, "", "a", "Z", "é", "\U0001f600", "￮", "hot", "tiny", "none"]
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else r.choice(names[:7])
        rows.append((i, words(i, r.randint(0, 60)), source))
    rows += [(1000, "one two", "tiny"), (1001, "", "none"), (1002, None, "none"), (None, words(5, 9), "a"), (3, words(9, 7), "a"), (3, words(9, 7), "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.repetitions(docs).collect()
    assert collections.Counter((x.doc_id, x.size) for x in got) == collections.Counter((i, size(t)) for i, t, _ in rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = filled(sizes, (3, 1, 2), 1.5, 2.0)
    of = {i: s for i, t, s in rows if i not in (None, 3)}
    taken = collections.Counter()
    for x in got:
        assert 0 <= x.copies <= 2
        if x.doc_id in of:
            s = of[x.doc_id]
            assert x.source_size == sizes[s] and x.target == pytest.approx(want[s])
            rate = want[s] / sizes[s] if sizes[s] else 0
            assert x.copies in (int(rate), int(rate) + (rate % 1 > 0))
            taken[s] += x.size * x.copies
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in ("hot", "é", "￮"):
        assert taken[s] == pytest.approx(want[s], rel=0.35)
    assert sorted(map(tuple, mixing.repetitions(docs).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    copies = collections.Counter()
    for x in got:
        copies[x.doc_id] += x.copies
    mix = collections.Counter(x.doc_id for x in mixing.mixed(docs).collect())
    assert mix == +copies


def test_edges_and_clashing_columns(spark, docs_of):
    rows = mixing.repetitions(docs_of(EDGES)).collect()
    assert len(rows) == len(EDGES) and {x.size for x in rows if x.doc_id in (1, 2, 3)} == {0}
    assert mixing.repetitions(docs_of([])).count() == 0 and mixing.mixed(docs_of([])).count() == 0
    nothing = mixing.repetitions(docs_of([(1, None), (2, " ")])).collect()
    assert [(x.target, x.copies) for x in nothing] == [(0.0, 0)] * 2
    odd = docs_of(EDGES).selectExpr("*", "1 as size", "'x' as rate", "2 as _key", "3 as _row", "4 as target")
    assert mixing.mixed(odd).columns == odd.columns
    assert collections.Counter(x.doc_id for x in mixing.mixed(odd).collect()) == collections.Counter(x.doc_id for x in mixing.mixed(docs_of(EDGES)).collect())


def test_the_plan_has_no_python(spark, docs_of, capsys):
    for made in (mixing.repetitions(docs_of(EDGES)), mixing.mixed(docs_of(EDGES))):
        made.explain()
        assert not any(x in capsys.readouterr().out for x in ("Python", "Arrow", "InPandas", "CartesianProduct"))
