"""Links between sets that share keys, and the components the links make.

A key shared by few sets gives all their pairs. A key shared by more gives no pairs
among them: in a few rounds each set is paired with some hubs, the sets that share most,
which joins a group of near copies into one component; afterwards only sets that share
such a key and still lie in different components are paired, and never the largest
component's sets among themselves. Where keys say little about similarity, these last pairs are
found by members instead: each set's rarest ones, so many that two sets that link have one in
common. Every pair that could join two components is verified, so components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.llm.arrowtext import tidied
from millrace.sources import stage

#: A key of at most so many sets gives all pairs: at most half as many pairs for each row.
SMALL_RUN = 12
ROUNDS = 2
_SCHEMA = "kind int, token bigint, a bigint, b bigint, n int, pos int"
_ARROW = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def _batch(kind, token, a, b, n, pos) -> pa.RecordBatch:
    arrays = [np.full(len(a), kind, np.int32), token, a, b, n, pos]
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(arrays, _ARROW, strict=True)], schema=_ARROW)


def _meet(percent: int, prefix: Callable | None = None, order: Callable | None = None):
    """Rows sorted by (token, node) in; out: pairs of short runs (kind 0), the
    rows of long runs (kind 1), how many tokens a node shares with any other (kind 2, n),
    with ``prefix`` the place in ``order`` of each node's last token (kind 3, token), else nodes that come twice with a token (kind 4)."""

    def possible(na, nb, pa_, pb):
        least, most = np.minimum(na, nb), np.maximum(na, nb)
        overlap = np.minimum(pa_, pb) + np.minimum(na - pa_, nb - pb)
        return (100 * least >= percent * most) & ((100 + percent) * overlap >= percent * (na + nb))

    def closed(t, v, n, p):
        """Whole runs only."""
        edge = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.empty(0, int)
        size = np.diff(np.append(edge, len(t)))
        run = np.repeat(np.arange(len(edge)), size)
        big = (size > SMALL_RUN)[run] if len(t) else np.empty(0, bool)
        left, right = [], []
        for d in range(1, SMALL_RUN):
            i = np.flatnonzero((run[: -d or None][: len(run) - d] == run[d:]) & ~big[d:]) if len(run) > d else np.empty(0, int)
            if not len(i):
                break
            i = i[possible(n[i], n[i + d], p[i], p[i + d])]
            left.append(v[i]), right.append(v[i + d])
        if left and sum(map(len, left)):
            pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
            empty = np.zeros(pairs.shape[1], np.int64)
            yield _batch(0, empty, pairs[0], pairs[1], empty, empty)
        shared = (size > 1)[run] if len(t) else big
        if shared.any():
            nodes, counts = np.unique(v[shared], return_counts=True)
            yield _batch(2, nodes, nodes, nodes, counts, np.zeros(len(nodes), np.int64))
        if big.any():
            yield _batch(1, t[big], v[big], v[big], n[big], p[big])

    def run(batches):
        held = [np.empty(0, np.int64)] * 4
        hot = last = None  # the token of a long run that goes on, and the last row seen
        place = order() if prefix else None
        for batch in batches:
            t, v, n, p = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("token", "node", "n", "pos"))
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
            if len(t) and last == (t[0], v[0]):
                new[0] = False
            if len(t):
                last = (t[-1], v[-1])
            if not prefix and not new.all():
                twice = np.unique(v[~new])
                none = np.zeros(len(twice), np.int64)
                yield _batch(4, none, twice, twice, none, none)
            t, v, n, p = t[new], v[new], n[new], p[new]
            if prefix:
                end = p == prefix(n) - 1
                yield _batch(3, place(t[end]), v[end], v[end], n[end], p[end])
            if hot is not None:
                k = int(np.searchsorted(t, hot, "right"))
                if k:
                    yield _batch(1, t[:k], v[:k], v[:k], n[:k], p[:k])
                    yield _batch(2, v[:k], v[:k], v[:k], np.ones(k, np.int64), p[:k])
                t, v, n, p = t[k:], v[k:], n[k:], p[k:]
            if not len(t):
                continue
            t, v, n, p = (np.concatenate(x) for x in zip(held, (t, v, n, p), strict=True))
            cut = int(np.searchsorted(t, t[-1]))
            if len(t) - cut > SMALL_RUN:
                hot, cut = t[-1], len(t)
            else:
                hot = None
            yield from closed(t[:cut], v[:cut], n[:cut], p[:cut])
            held = [x[cut:] for x in (t, v, n, p)]
        yield from closed(*held)

    return run


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def without_own(n: Column, own: Column, last: Column, other_last: Column) -> Column:
    """The most that a set of ``n`` members can have in common with another, by its ``own`` tokens.

    Those are the tokens of its prefix that no other prefix holds. The other set may hold them
    behind its prefix, unless its prefix ends at the same place of the order or a later one.
    """
    return F.when(last <= other_last, n - own).otherwise(n)


def _may_reach(percent: int, x: str, y: str, ordered: bool) -> Column:
    """Whether two nodes' sizes, places of a common token and, if ``ordered``, tokens that only they have allow a link.

    What is common lies before both places or after them, and as :func:`without_own` says.
    """
    c = lambda side, name: F.col(f"{side}.{name}")
    na, nb = c(x, "n"), c(y, "n")
    around = F.least(c(x, "pos"), c(y, "pos")) + F.least(na - c(x, "pos"), nb - c(y, "pos"))
    own = [without_own(na, c(x, "own"), c(x, "last"), c(y, "last")), without_own(nb, c(y, "own"), c(y, "last"), c(x, "last"))] if ordered else []
    overlap = F.least(around, *own) if own else around
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * overlap >= percent * (na + nb))


def marked_overlap(na: Column, nb: Column, a: Column, b: Column) -> Column:
    """The most that two sets can have in common, by the cells each marks: a cell marked by one alone holds a member of one alone."""
    alone = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, k: s + k)
    return F.least(na - alone(a, b), nb - alone(b, a))


def meet(rows: DataFrame, percent: int, prefix: Callable | None = None, order: Callable | None = None) -> DataFrame:
    """What :func:`_meet` says of ``rows`` (token, node, n, pos), written."""
    return stage(rows.repartition("token").sortWithinPartitions("token", "node").mapInArrow(tidied(_meet(percent, prefix, order)), _SCHEMA))


def not_alone(met: DataFrame) -> DataFrame:
    """(node) of :func:`meet` without ``prefix``: those that share a token with another node, or come more than once."""
    return met.where("kind in (2, 4)").select(F.col("a").alias("node")).distinct()


def linked(
    rows: DataFrame,
    percent: int,
    verify: Callable[[DataFrame], DataFrame],
    prefix: Callable | None = None,
    order: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None,
    marks: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) and the components (node, component) of the nodes that have any.

    ``rows``: token, node, n (size of the node's set), pos (place of the token in the
    node's own order of tokens; 0 where there is none). Two nodes are compared if they
    share a token and their sizes and places allow ``percent``. ``prefix`` gives from n (array or column) the
    number of tokens each node has in ``rows``, where tokens are members of the set and the first
    of it in one order of all tokens; ``order`` makes, once for each task, a function from tokens to
    their places in that order. ``verify`` gets distinct pairs (a < b), with ``prefix`` with columns own_a, own_b, last_a and
    last_b as in :func:`without_own`, and returns those that link. ``marks`` gives
    (node, marks) for nodes, for :func:`marked_overlap`. A component is named by its smallest node.
    """
    return linked_of(meet(rows, percent, prefix, order), percent, verify, prefix, marks)


def linked_of(
    met: DataFrame,
    percent: int,
    verify: Callable[[DataFrame], DataFrame],
    prefix: Callable | None = None,
    marks: Callable[[DataFrame], DataFrame] | None = None,
    weights: Callable[[DataFrame], DataFrame] | None = None,
    members: Callable[[DataFrame], DataFrame] | None = None,
    chances: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """:func:`linked` of what :func:`meet` gives.

    ``weights`` gives (node, weight) for nodes: the
    heaviest nodes become hubs, by default those with the largest shared part; so do ``chances``
    random ones of each token. ``members`` gives (node, s) for nodes, s all members of the set; it may repeat rows. With it, the nodes that
    hubs have left in different components are compared where rare members say that they may link, as in
    :func:`rare_members`, not wherever they share a token.
    """
    if prefix:
        of_node = met.where("kind in (2, 3)").groupBy(F.col("a").alias("node"))
        shared = F.sum(F.when(F.col("kind") == 2, F.col("n"))).cast("int")
        last, size = (F.max(F.when(F.col("kind") == 3, F.col(c))) for c in ("token", "n"))
        owns = stage(of_node.agg(shared.alias("shared"), (prefix(size) - shared).cast("int").alias("own"), last.alias("last")).where("shared > 0").drop("shared"))

    def with_own(pairs: DataFrame) -> DataFrame:
        for x in "ab" if prefix else "":
            pairs = pairs.join(owns.select(F.col("node").alias(x), F.col("own").alias(f"own_{x}"), F.col("last").alias(f"last_{x}")), x)
        return pairs

    few = met.where("kind = 0").select(*_pairs(F.col("a"), F.col("b")))
    long = met.where("kind = 1").select("token", F.col("a").alias("node"), "n", "pos")
    if long.isEmpty():
        links = stage(verify(with_own(few.distinct())))
        return links, components(links)
    long = long.join(owns, "node") if prefix else long.withColumns({"own": F.lit(0), "last": F.lit(0)})
    if weights:
        long = stage(long)
        long = long.join(weights(long.select("node").distinct()), "node")
    else:
        long = long.withColumn("weight", -F.col("own") / F.col("n"))
    long = stage(long.withColumn("component", F.col("node")))
    links = stage(verify(with_own(few.union(_to_hubs(long, percent, 0, chances, bool(prefix))).distinct())))
    found = components(links)
    for turn in range(1, ROUNDS):
        long = _unsettled(long, found)
        if long.isEmpty():
            return links, found
        links = stage(links.union(verify(with_own(_to_hubs(long, percent, turn, chances, bool(prefix))))).distinct())
        found = components(links)
    long = _unsettled(long, found)
    if not long.isEmpty():
        if members:
            nodes = stage(long.select("node", "component").distinct())
            sets = _once(members(nodes.select("node")))
            rare = stage(rare_members(sets, percent).join(nodes, "node").withColumns({"own": F.lit(0), "last": F.lit(0)}))
            more = verified(_across(rare, percent, None), lambda wanted: sets.join(wanted, "node", "left_semi"), percent)
        else:
            more = verify(with_own(_across(long, percent, marks, bool(prefix))))
        links = stage(links.union(more).distinct())
        found = components(links)
    return links, found


def rare_members(sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, pos): the first members of each set (node, s) by how many sets hold them, rarest first.

    So many are kept that two sets of similarity ``percent`` have one in common; members of one set alone
    take their places, but no rows.
    """
    each = sets.select("node", F.size("s").alias("n"), F.explode("s").alias("token"))
    held = each.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    mine = W.partitionBy("node")  # at most a set's members
    placed = each.join(held, "token").withColumn("pos", F.col("n") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("held", "token")) - 1)
    return placed.where(F.col("pos") <= F.col("n") - F.floor((percent * F.col("n") + 99) / 100)).select("token", "node", "n", F.col("pos").cast("int").alias("pos"))


def _unsettled(long: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of tokens whose nodes lie in more than one component, with their component."""
    placed = long.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parted = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    return stage(placed.join(parted.select("token"), "token", "left_semi"))


_PLACE = ("node", "n", "pos", "own", "last", "component")


def _to_hubs(long: DataFrame, percent: int, turn: int, chances: int, ordered: bool) -> DataFrame:
    """Each node with some of the nodes that share most and some random ones, at most ``chances`` + 2 pairs for a node."""
    place = F.struct(*_PLACE)
    coarse = F.round(F.col("weight"), 1)  # so that ties are broken by chance
    chance = [F.xxhash64("node", F.lit(turn * 100 + i)) for i in range(chances + 2)]
    hubs = long.groupBy("token").agg(
        F.max_by(place, F.struct("weight", chance[0])).alias("h0"),
        F.max_by(place, F.struct(coarse, chance[1])).alias("h1"),
        *[F.max_by(place, chance[i]).alias(f"h{i}") for i in range(2, chances + 2)],
    )
    names = [f"h{i}" for i in range(chances + 2)]
    mine = long.alias("x").join(hubs, "token").select(*[F.col(f"x.{c}") for c in _PLACE], *names)
    best = []
    for i in range(chances + 2):
        fits = (F.col(f"h{i}.component") != F.col("component")) & _may_reach(percent, "self", f"h{i}", ordered)
        best.append(F.min_by(F.when(fits, F.col(f"h{i}.node")), F.when(fits, F.xxhash64(f"h{i}.node", F.lit(turn)))).alias(f"b{i}"))
    per_node = mine.withColumn("self", F.struct(*_PLACE)).groupBy("node").agg(*best)
    one = per_node.select("node", F.explode(F.array_compact(F.array_distinct(F.array(*[f"b{i}" for i in range(chances + 2)])))).alias("hub"))
    return one.select(*_pairs(F.col("node"), F.col("hub"))).distinct()


#: How many of a node's tokens travel with it, the smallest of each residue, to tell where a pair has met before.
EARLY = 16


def _across(long: DataFrame, percent: int, marks: Callable[[DataFrame], DataFrame] | None, ordered: bool = False) -> DataFrame:
    """All pairs that share a token, lie in different components, and may link.

    A pair is left to the smallest token that both sides are known to have: bounds hold at every
    common token, and at the smallest of all nothing else is left. So near copies, which share
    many tokens, come out about once and not once for each of them.
    """
    early = [f"early_{i}" for i in range(EARLY)]
    residue = F.pmod("token", F.lit(EARLY))
    least = long.groupBy("node").agg(*[F.min(F.when(residue == i, F.col("token"))).alias(e) for i, e in enumerate(early)])
    if marks:
        least = least.join(marks(least.select("node")), "node")
    long = stage(long.join(least, "node"))
    main = long.groupBy("token", "component").count().groupBy("token").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    rest = long.join(main, "token").where("component != main")
    x, y = rest.alias("x"), long.alias("y")
    once = (F.col("y.component") == F.col("x.main")) | (F.col("x.node") < F.col("y.node"))
    before = F.lit(False)
    for e in early:
        before |= F.coalesce((F.col(f"x.{e}") == F.col(f"y.{e}")) & (F.col(f"x.{e}") < F.col("x.token")), F.lit(False))
    possible = once & ~before & _may_reach(percent, "x", "y", ordered)
    meets = (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component")) & possible
    if marks:
        most = marked_overlap(F.col("x.n"), F.col("y.n"), F.col("x.marks"), F.col("y.marks"))
        meets &= F.when(possible, (100 + percent) * most >= percent * (F.col("x.n") + F.col("y.n")))
    return x.join(y, meets).select(*_pairs(F.col("x.node"), F.col("y.node"))).distinct()


#: Rows of one or two numbers that every executor may hold: a few tens of MB.
SMALL_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """``df``, written; with a broadcast hint if it is counted to have at most ``SMALL_ROWS`` rows."""
    kept = stage(df)
    return F.broadcast(kept) if kept.count() <= SMALL_ROWS else kept


def _once(sets: DataFrame) -> DataFrame:
    """``sets`` (node, s), written, with one row for each node. Only where rows repeat a doc_id does a node come twice, so only then are sets moved for it."""
    kept = stage(sets)
    rows, nodes = kept.agg(F.count("*"), F.countDistinct("node")).first()
    return kept if rows == nodes else stage(kept.groupBy("node").agg(F.first("s").alias("s")))


def verified(pairs: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """The pairs whose sets' exact Jaccard similarity is ``percent`` or more. ``sets``: nodes (node) to (node, s); it may repeat rows."""
    pairs = stage(pairs)
    have = _once(sets(stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return (
        pairs.join(have.select(F.col("node").alias("a"), F.col("s").alias("s_a")), "a")
        .join(have.select(F.col("node").alias("b"), F.col("s").alias("s_b")), "b")
        .where(100 * both >= percent * (F.size("s_a") + F.size("s_b") - both))
        .select("a", "b")
    )


#: Links that one task joins by itself.
TASK_LINKS = 500_000


def _forest(batches):
    """The links of a partition, as links of every node to the smallest node of its component there."""
    import pandas as pd

    u, v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in batches:
        u.append(batch.column("u").to_numpy()), v.append(batch.column("v").to_numpy())
    ends, nodes = pd.factorize(np.concatenate(u + v), sort=True)
    a, b = np.split(ends, 2)
    root = np.arange(len(nodes))
    while True:  # smallest numbers move along links, then paths are halved until they are flat
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low), np.minimum.at(new, root[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    other = np.flatnonzero(root != np.arange(len(root)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[other], pa.int64()), pa.array(nodes[root[other]], pa.int64())], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b); a component's name is its smallest node.

    Each task first replaces its links, ``TASK_LINKS`` or so, by a flat forest. If there are more tasks
    than one, two steps alternate until nothing changes: every node's smaller neighbours
    move to the smallest of them, then its larger neighbours move to its smallest
    neighbour. Each round's links are written, and no node's links are gathered.
    """
    edges = stage(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    tasks = 1 + edges.count() // TASK_LINKS
    edges = stage(edges.repartition(tasks).mapInArrow(_forest, "u bigint, v bigint"))
    before = None
    while tasks > 1:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small_star = moved.union(low.select("u", F.col("m").alias("v"))).distinct()
        around = small_star.union(small_star.select(F.col("v"), F.col("u")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = stage(around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
