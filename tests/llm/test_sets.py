"""N-gram join, paragraph dedup and decontamination against brute force."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import EDGES, words

from millrace.llm import arrowtext as at
from millrace.llm import decontaminate, linking, ngram_join, paragraphs, sieve

LOWER = bytes(range(256)).lower()


def bag(text, least=1):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < least:
        return frozenset()
    return frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4))


def classes(bags):
    """{key: smallest key of its component}; keys with empty bags are alone."""
    keys = sorted(bags)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = bags[a], bags[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: find(k) for k in keys}


def near_copies(seed, n, copies, edits):
    """A text and copies of it with single words changed: more copies than a short run holds."""
    r = random.Random(seed)
    base = words(seed, n).split()
    out = [" ".join(base)]
    for k in range(copies):
        w = list(base)
        for _ in range(r.randint(1, edits)):
            w[r.randrange(n)] = f"new{k}{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus():
    texts = near_copies(5, 150, 60, 9) + near_copies(6, 30, 5, 2) + [words(k, 50) for k in range(20, 60)] + ["", "one two", "one two", None]
    shared = words(99, 30)
    texts += [words(k, 12) + " " + shared for k in range(200, 230)]  # many texts, one passage, no links
    return list(enumerate(texts))


@pytest.fixture(params=["plain", "small bounds"])
def mode(request, monkeypatch):
    if request.param == "small bounds":
        monkeypatch.setattr(linking, "SMALL_RUN", 2)
        monkeypatch.setattr(linking, "SMALL_ROWS", 0)
        monkeypatch.setattr(linking, "TASK_LINKS", 7)


def test_similarity_classes_are_those_of_all_pairs(spark, docs_of, mode):
    rows = corpus()
    want = classes({i: bag(t) for i, t in rows})
    got = {r.doc_id: r for r in ngram_join.similarity_classes(docs_of(rows)).collect()}
    assert {i: (len(bag(t)), want[i]) for i, t in rows} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}


def test_a_text_with_copies_links_with_its_extensions(spark, docs_of, mode):
    rows = []
    for added in (10, 17, 25, 33):
        for longer in (1, 20):  # a short run and a long one
            base = words(1000 + added * 50 + longer, 104)
            texts = [base] * 4 + [f"{base} {words(added * 10_000 + longer * 100 + k, added)}" for k in range(longer)]
            rows += list(enumerate(texts, len(rows)))
    want = classes({i: bag(t) for i, t in rows})
    got = {r.doc_id: r.component_id for r in ngram_join.similarity_classes(docs_of(rows)).collect()}
    assert got == want


def test_similarity_edges(spark, docs_of):
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(docs_of(EDGES)).collect()))
    assert len(got) == len(EDGES)
    by_id = {r[0]: r for r in got}
    assert by_id[1] == (1, 0, 1) and by_id[2] == (2, 0, 2) and by_id[3] == (3, 0, 3)
    assert by_id[4] == (4, 1, 4) and by_id[5] == (5, 1, 4)
    assert by_id[-1][2] == 6 and by_id[6][2] == 6 and by_id[7][2] == 6
    assert ngram_join.similarity_classes(docs_of([])).count() == 0


def test_components_of_a_long_path(spark, monkeypatch):
    monkeypatch.setattr(linking, "TASK_LINKS", 50)
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1001)], "a bigint, b bigint")
    got = {r.node: r.component for r in linking.components(links).collect()}
    assert got == {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000}


def cut(text):
    """Paragraphs as lists of words: a border is a word whose hash is the smallest of seven on either side."""
    part = next(at.slices(pa.array([text or ""]), lower=True))
    starts, ends, _ = part.words(at.NOT_SPACE)
    h = part.hashes(starts, ends).tolist()
    w = (text or "").encode().translate(LOWER).split()
    begin = [i for i in range(len(w)) if i == 0 or (all(h[i] < x for x in h[max(0, i - 7) : i]) and all(h[i] <= x for x in h[i + 1 : i + 8]))]
    return [w[i:j] for i, j in zip(begin, [*begin[1:], len(w)])]


def paragraphs_wanted(rows):
    """Repeats of what another document has first, in runs of 20 words and more."""
    cuts = {i: cut(t) for i, t in rows}
    bags = {(i, k): bag(b" ".join(p).decode()) for i, ps in cuts.items() for k, p in enumerate(ps)}
    root = classes(bags)
    out = set()
    for i, ps in cuts.items():
        run = []
        for k in range(len(ps) + 1):
            if k < len(ps) and root[i, k][0] != i:
                run.append(k)
            else:
                if sum(len(ps[x]) for x in run) >= 20:
                    out |= {(i, x) for x in run}
                run = []
    return out


def test_removals_are_those_of_all_pairs(spark, docs_of, mode):
    r = random.Random(8)
    pool = near_copies(11, 60, 25, 3) + near_copies(12, 8, 3, 1) + [words(k, r.randint(3, 60)) for k in range(300, 340)] + ["", "a b", words(7, 80)]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 6)))) for i in range(50)]
    got = paragraphs.removals(docs_of(rows)).collect()
    assert {(x.doc_id, x.paragraph) for x in got} == paragraphs_wanted(rows) and len(got) > 20
    assert all(x.kept_doc < x.doc_id for x in got)


def shared_runs(texts, size=51):
    """Documents that hold ``size`` words in a row of a document before them."""
    first, out = {}, set()
    for i in sorted(texts):
        w = (texts[i] or "").lower().split()
        for k in range(len(w) - size + 1):
            if first.setdefault(tuple(w[k : k + size]), i) != i:
                out.add(i)
    return out


def test_long_passages_go_whatever_is_around_them_and_short_ones_stay(spark, docs_of):
    r = random.Random(5)
    rows, long, short = [], [words(k, r.randint(85, 120)) for k in range(600, 625)], [words(k, r.randint(8, 12)) for k in range(650, 675)]
    for i in range(120):
        passage = r.choice(long).split() if i % 2 else r.choice(short).split()
        lines = [words(700 + 3 * i, r.randint(5, 40)), " ".join(passage), words(701 + 3 * i, r.randint(5, 40))]
        if i % 3 == 0:  # inside a longer line
            lines = [" ".join(lines)]
        elif i % 3 == 1:  # wrapped
            lines[1] = "\n".join(" ".join(passage[k : k + 9]) for k in range(0, len(passage), 9))
        rows.append((i, "\n".join(lines)))
    got = {x.doc_id: x for x in paragraphs.deduplicated(docs_of(rows)).collect()}
    flagged, repeated = {i for i, x in got.items() if x.n_removed}, shared_runs(dict(rows))
    assert flagged == repeated and len(repeated) > 20
    assert not shared_runs({i: x.text for i, x in got.items()})


def test_most_passages_of_60_words_go(spark, docs_of):
    rows = [(i, " ".join([words(900 + 3 * i, 20), words(800 + i % 60, 60), words(901 + 3 * i, 20)])) for i in range(120)]
    got = {x.doc_id for x in paragraphs.deduplicated(docs_of(rows)).collect() if x.n_removed}
    assert got <= set(range(60, 120)) and len(got) >= 0.8 * 60


def test_dedup_edges(spark, docs_of):
    passage = words(50, 55)
    rows = [*EDGES, (20, f"{words(51, 20)}\n{passage}\n\nend"), (21, f"begin\n{passage}\n{words(52, 20)}"), (22, passage)]
    got = collections.defaultdict(list)
    for x in paragraphs.deduplicated(docs_of(rows).withColumnRenamed("lang", "node").withColumnRenamed("source", "paragraph")).collect():
        got[x.doc_id].append(x)
    assert got[1][0].text is None and got[2][0].text == "" and got[3][0].text == " \n\t "
    assert passage in got[20][0].text and got[20][0].n_removed == 0
    assert got[21][0].text.startswith("begin\n") and got[21][0].text.endswith(words(52, 20)) and got[21][0].removed[0].kept_doc == 20
    assert len(got[22][0].text.split()) < 20 and len(got[6]) == 2 and got[6][0].text == got[6][1].text == words(1, 60)
    assert got[None][0].text == "" and got[8][0].n_removed == 0
    assert paragraphs.deduplicated(docs_of([])).count() == 0
    odd = docs_of(rows).selectExpr("*", "1 as row", "2 as gone", "'x' as removed")
    assert paragraphs.without_repeats(odd).columns == odd.columns and paragraphs.without_repeats(docs_of([])).count() == 0


def test_many_short_rows_do_not_fill_a_worker():
    import tracemalloc

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60_000)), "source": list(range(60_000)), "text": [f"word {k}" for k in range(60_000)]})
    rows, ended = 0, []
    tracemalloc.start()
    for out in ngram_join._profile([batch]):
        rows += out.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60_000 + ngram_join.BLOCKS and peak < 110e6  # 60,000 rows of marks at once are 123 MB
    assert list(at.tidied(lambda batches: (ended.append(b) or b for b in batches))([1, 2])) == ended == [1, 2]


def test_long_and_short_slices_give_the_same_hashes(monkeypatch):
    texts = [words(k, 400) for k in range(6)] + ["", "é" * 70, "a b"]
    column = pa.array(texts)

    def sets():
        out = []
        for part in at.slices(column):
            starts, ends, first = part.words(at.NOT_SPACE)
            off, _, found = at.shingle_sets(part.hashes(starts, ends), first)
            out += [found[off[i] : off[i + 1]].tolist() for i in range(part.rows)]
        return out

    whole = sets()
    monkeypatch.setattr(at, "SLICE_BYTES", 97)
    monkeypatch.setattr(at, "_kept", [])
    assert sets() == whole and len(whole) == len(texts)
    assert [len(x) for x in whole] == [len({tuple(t.split(" ")[i : i + 5]) for i in range(max(1, len(t.split(" ")) - 4))}) if t else 0 for t in texts]


def brute_contamination(docs, items):
    import hashlib
    import re

    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").encode().translate(LOWER))
    out = {}
    for i, t in docs:
        w, hit, ids = split(t), set(), set()
        for item, text in items:
            b = split(text)
            k = min(13, len(b))
            for s in range(len(b) - k + 1) if b else ():
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == b[s : s + k]:
                        hit |= set(range(p, p + k))
                        ids.add(str(item))
        out[i] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def bridge():
    """A row without id that alone joins two others."""
    first, more, end = words(80, 104), words(81, 20), words(82, 20)
    return [(1, first), (None, f"{first} {more}"), (2, f"{first} {more} {end}"), (None, words(83, 50))]


def test_a_near_copy_without_id_joins_two_documents(spark, docs_of):
    got = {r.n_shingles: r.component_id for r in ngram_join.similarity_classes(docs_of(bridge())).collect()}
    assert got == {100: 1, 120: 1, 140: 1, 46: None}


def test_a_passage_that_only_a_row_without_id_shares(spark, docs_of):
    passage = words(84, 70)
    rows = [(None, passage + " " + words(85, 20)), (None, words(86, 20) + " " + passage), (3, words(87, 30))]
    got = sorted((x.n_removed > 0, len((x.text or "").split())) for x in paragraphs.deduplicated(docs_of(rows)).collect())
    assert [g[0] for g in got] == [False, False, True] and got[2][1] < 60


def test_contamination_is_that_of_brute_force(spark, docs_of):
    items = [(1, words(70, 20)), (2, words(71, 13)), (10, words(72, 7)), (11, "Alpha, beta!"), (12, "zz"), (13, ""), (14, None), (15, words(70, 20)), (16, "aa " * 30)]
    rows = [
        (1, words(73, 30) + " " + words(70, 20) + " " + words(74, 5)), (2, words(70, 20)), (3, " ".join(words(70, 20).split()[2:15])), (4, " ".join(words(70, 20).split()[:12])),
        (5, words(72, 7).upper() + " ALPHA -- Beta? zz"), (6, "aa " * 40), (7, None), (8, ""), (9, words(75, 3000) + " zz"), (10, "…"), (11, words(71, 13) + " " + words(71, 13)),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(docs_of(rows), bench).collect()}
    assert got == brute_contamination(rows, items)
    assert decontaminate.contamination(docs_of(EDGES), bench).count() == len(EDGES)
    assert decontaminate.contamination(docs_of([]), bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs_of(rows), bench.limit(0)).collect()} == {0}


def test_a_contaminated_row_without_id_is_found(spark, docs_of):
    bench = spark.createDataFrame([(1, words(70, 20))], "item_id bigint, text string")
    got = decontaminate.contamination(docs_of([(None, words(70, 20)), (None, words(76, 20)), (1, words(70, 20))]), bench).collect()
    assert sorted((r.doc_id or 0, r.n_hit, r.n_items, r.contaminated) for r in got) == [(0, 0, 0, False), (0, 20, 1, True), (1, 20, 1, True)]


def test_word_hash_depends_on_every_byte():
    starts, ends = np.array([0, 4, 8]), np.array([3, 7, 11])
    part = next(at.slices(pa.array(["abc acb abd"])))
    assert len(set(part.hashes(starts, ends).tolist())) == 3


def test_pairs_across_components_are_all_found_and_early_tokens_suppress_no_pair(spark):
    r = random.Random(3)
    own = {v: (r.sample(range(-60, 60), r.randint(1, 40)), r.randrange(9)) for v in range(80)}
    rows = [(t, v, 10, 0, 0, c) for v, (tokens, c) in own.items() for t in tokens]
    long = spark.createDataFrame(rows, "token bigint, node bigint, n int, pos int, own int, component bigint")
    got = [(p.a, p.b) for p in linking._across(long, 75, None).collect()]
    want = {(a, b) for a in own for b in own if a < b and own[a][1] != own[b][1] and set(own[a][0]) & set(own[b][0])}
    assert len(got) == len(set(got)) and set(got) == want


def test_rare_members_give_all_links_and_few_other_pairs(spark, mode):
    r = random.Random(4)
    common = list(range(1, 9))
    bags = {v: frozenset([*r.sample(common, 5), *r.sample(range(100, 10**6), r.randint(4, 9))]) for v in range(300)}
    for v in range(300, 340):  # near copies of some
        some = sorted(bags[v - 300])
        bags[v] = frozenset([*some[:-1], 10**7 + v])
    sets = spark.createDataFrame([(v, sorted(s)) for v, s in bags.items()], "node bigint, s array<bigint>")
    rows = linking.rare_members(sets, 75).collect()
    assert all(x.token in bags[x.node] and x.n == len(bags[x.node]) for x in rows)
    by_token = collections.defaultdict(set)
    for x in rows:
        by_token[x.token].add(x.node)
    met = {(a, b) for nodes in by_token.values() for a in nodes for b in nodes if a < b}
    links = {(a, b) for a in bags for b in bags if a < b and 100 * len(bags[a] & bags[b]) >= 75 * len(bags[a] | bags[b])}
    assert links <= met and len(links) > 20 and len(met) < 1000  # 50,000 pairs share a common member

    verified = []
    rows = [(t, v, len(s), 0) for v, s in bags.items() for t in s if t in common]  # keys that say little: long runs only

    def verify(pairs):
        pairs = linking.stage(pairs)
        verified.append(pairs.count())
        return linking.verified(pairs, lambda wanted: sets.join(wanted, "node", "left_semi"), 75)

    met = linking.meet(spark.createDataFrame(rows, "token bigint, node bigint, n int, pos int"), 75)
    assert {x.node for x in linking.not_alone(met).collect()} == set(bags)
    _, found = linking.linked_of(met, 75, verify, members=lambda nodes: sets.join(nodes, "node", "left_semi"))
    got = {x.node: x.component for x in found.collect()}
    want = {k: x for k, x in classes(bags).items() if any(k in p for p in links)}
    assert got == want and sum(verified) < 3 * linking.ROUNDS * len(bags)


def test_a_paragraph_that_one_slice_holds_twice_is_not_alone(spark, docs_of):
    rows = [(1, words(60, 40)), (2, words(60, 40)), (3, words(61, 40))]
    assert len(next(paragraphs._bands()([pa.RecordBatch.from_pydict({"text": [t for _, t in rows]})])).column("node").unique()) > 3
    assert {x.doc_id for x in paragraphs.removals(docs_of(rows).coalesce(1)).collect()} == {2}


def nodes_of(plan):
    children = plan.children()
    return [plan, *[x for i in range(children.size()) for x in nodes_of(children.apply(i))]]


def test_sets_are_read_without_moving_texts(spark, docs_of, monkeypatch):
    r = random.Random(9)
    pool = near_copies(13, 40, 40, 2) + [words(k, 40) for k in range(400, 420)]
    docs = docs_of([(i, " ".join(r.choice(pool) for _ in range(3))) for i in range(60)])
    joined, real = [], linking.stage

    def seen(df):
        nodes = nodes_of(df._jdf.queryExecution().optimizedPlan())
        if any(x.nodeName() == "MapInArrow" for x in nodes):
            joined.extend(x.output().mkString(",") for x in nodes if x.nodeName() == "Join")
        return real(df)

    monkeypatch.setattr(linking, "stage", seen)
    got = {(x.doc_id, x.paragraph) for x in paragraphs.removals(docs).collect()}
    assert len(got) > 20 and joined and not [x for x in joined if "text#" in x]
    monkeypatch.setattr(sieve, "passing", lambda bits, keys: np.ones(len(keys), bool))  # a filter too full to say anything
    assert {(x.doc_id, x.paragraph) for x in paragraphs.removals(docs).collect()} == got


@pytest.mark.parametrize("blocks", [1, 4, 64])
def test_a_filter_passes_its_own_keys_and_few_others(spark, monkeypatch, blocks):
    monkeypatch.setattr(sieve, "MOST_BLOCKS", blocks)
    keys = at.mix(np.arange(60_000, dtype=np.uint64))
    mine = spark.createDataFrame([(x,) for x in keys[:30_000].view(np.int64).tolist()], "key bigint").repartition(5)
    bits = sieve.made(mine, 30_000)
    assert bits.shape == (min(blocks, 16), 4096)
    assert sieve.passing(bits, keys[:30_000]).all()
    assert sieve.passing(bits, keys[30_000:]).mean() < (0.01 if blocks == 64 else 0.7 if blocks == 4 else 1.1)
    assert not sieve.passing(sieve.made(mine.where("false"), 0), keys).any()
