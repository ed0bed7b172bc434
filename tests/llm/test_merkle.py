"""The Merkle manifest against plain trees, and what a changed text does to its proof."""

import collections
import hashlib
import zlib

import pytest
from conftest_llm import EDGES

from millrace.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """The root, and for each leaf its (left, right) of every level."""
    level, paths, at = list(nodes), [[] for _ in nodes], list(range(len(nodes)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            run = range(i // 8 * 8, min(len(level), i // 8 * 8 + 8))
            paths[leaf].append(("".join(level[k] for k in run if k < i), "".join(level[k] for k in run if k > i)))
        level, at = [h(*level[k : k + 8]) for k in range(0, len(level), 8)], [i // 8 for i in at]
    return level[0], paths


def expected(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = collections.defaultdict(list)
    for i, t, lang, source, n in rows:
        leaf = h(*map(field, (i, source, lang, n, t)))
        hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        changed = h(*map(field, (i, source, lang, n, t and t.translate(lower)))) if hit else leaf
        groups[lang].append((i is not None, i or 0, leaf, changed))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g])]) for g in langs]
    root, above = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), more in zip(langs, trees, above):
        for (known, i, leaf, changed), path in zip(sorted(groups[g]), paths):
            at = changed
            for left, right in path + more:
                at = h(left, at, right)
            out.append((i if known else None, leaf, subroot, root, h(*[x for p in path + more for x in p]), at, at == root))
    return collections.Counter(out)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("least", [merkle.LEAST_ROWS, 20])
def test_against_plain_trees(spark, monkeypatch, least):
    monkeypatch.setattr(merkle, "LEAST_ROWS", least)
    sizes = {None: 1, "": 8, "a": 9, "Z": 64, "é": 65, "zz": 513, "\U0001f600": 2, "￮": 7}
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"Text {i}" if i % 5 else None, lang, None if i % 7 == 0 else "s:1", i if i % 3 else None))
            i = (i * 7 + 3) % 100_003
    rows += [(None, "A", "a", "s", 1), (None, "A", "a", "s", 1), (4, "Same", "a", "s", 1), (4, "Same", "a", "s", 1), (4, "same", "a", "s", 1)]
    got = merkle.audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert collections.Counter(map(tuple, got)) == expected(rows)
    assert {r.verified for r in got} == {True, False}


def test_many_groups_of_one(spark):
    rows = [(i, "Word", f"l{i:04d}", "s", 4) for i in range(530)]
    assert collections.Counter(map(tuple, merkle.audit(spark.createDataFrame(rows, SCHEMA)).collect())) == expected(rows)


def test_edges_and_other_columns(spark, docs_of):
    docs = docs_of(EDGES)
    got = merkle.audit(docs.selectExpr("*", "1 as leaf", "2 as root", "'x' as path", "0 as _rank")).collect()
    assert collections.Counter(map(tuple, got)) == expected([(i, t, "en", "src", len(t or "")) for i, t in EDGES])
    assert merkle.audit(docs_of([])).count() == 0
    one = merkle.audit(docs_of([(7, "one")])).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == h("")
