"""N-gram Jaccard join by rare-first prefix filtering.

Tokens are 64-bit hashes of five-word shingles. All sets are ordered by one global order,
rare shingles first; two sets of similarity t share a token among the first
n - ceil(t * n) + 1 of either. Rarity comes from a counting sketch of fixed size over the
shingles of all documents: it decides only how many candidates there are, never the result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrowtext as at
from millrace.llm.linking import linked, marked_overlap, small, verified, without_own
from millrace.sources import stage

PERCENT = 75
#: 4 million cells: the more there are, the later common shingles hide the rare ones of their cells.
SKETCH_BITS = 22
BLOCKS = 16
#: Shingles that a task counts at a time.
COUNTED = 1 << 22
#: Hash cells of the suffix filter; each set marks the cells that its shingles fall into.
CELLS = 2048


def _sets(texts: at.Texts):
    starts, ends, first = texts.words(at.NOT_SPACE)
    return at.shingle_sets(texts.hashes(starts, ends), first)


def _profile(batches):
    """A row for each document (block NULL), and this task's share of the sketch in blocks (doc_id NULL)."""
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    waiting: list[np.ndarray] = []
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
    names = ["doc_id", "source", "n_shingles", "key", "marks", "block", "counts"]

    def out(arrays):
        return pa.RecordBatch.from_arrays([pa.array(x, k) if not isinstance(x, pa.Array) else x for x, k in zip(arrays, kinds, strict=True)], names)

    def count():
        if waiting:
            np.add(sketch, np.bincount(np.concatenate(waiting), minlength=1 << SKETCH_BITS), out=sketch, casting="unsafe")
            waiting.clear()

    for batch in batches:
        for texts in at.slices(batch.column("text"), lower=True):
            off, rows, found = _sets(texts)
            waiting.append((found >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
            if sum(map(len, waiting)) > COUNTED:
                count()
            marks = np.zeros(texts.rows * CELLS, bool)
            marks[rows * CELLS + (found & np.uint64(CELLS - 1)).astype(np.int64)] = True
            marks = np.packbits(marks).view(np.int64)
            key, _ = at.set_keys(off, found)
            none = [None] * texts.rows
            ids = [batch.column(c).slice(texts.low, texts.rows).cast(pa.int64()) for c in ("doc_id", "source")]
            yield out([*ids, np.diff(off).astype(np.int64), at.signed(key), at.lists(np.arange(texts.rows + 1) * (CELLS // 64), marks), none, none])
    count()
    none = [None] * BLOCKS
    yield out([none, none, none, none, none, np.arange(BLOCKS, dtype=np.int32), [zlib.compress(x.tobytes(), 1) for x in np.split(sketch, BLOCKS)]])


def _sums(batches) -> dict[int, np.ndarray]:
    """The sum of each block's counts, row by row in constant memory."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
            # a task's counts have four bytes each, sums have eight
            wide = np.frombuffer(zlib.decompress(counts.as_buffer()), np.uint64 if block >= BLOCKS else np.uint32)
            total.setdefault(block % BLOCKS, np.zeros(len(wide), np.uint64))
            total[block % BLOCKS] += wide
    return total


def _blocks(of: dict[int, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(of), pa.int32()), pa.array(list(of.values()), pa.binary())], ["block", "counts"])


def _added(batches):
    """One row for each block of a partition: the sum of its counts."""
    yield _blocks({b + BLOCKS: zlib.compress(x.tobytes(), 1) for b, x in _sums(batches).items()})


def _ranked(batches):
    """One row for each block: the logarithms of its counts, a byte each."""
    yield _blocks({b: np.log2(x.astype(np.float64) + 1).astype(np.uint8).tobytes() for b, x in _sums(batches).items()})


def profiles(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, source, n_shingles, key, marks) of every row, and each sketch cell's logarithmic rarity."""
    both = stage(docs.select("doc_id", "text", at.source().alias("source")).mapInArrow(at.tidied(_profile), "doc_id bigint, source bigint, n_shingles bigint, key bigint, marks array<bigint>, block int, counts binary"))
    parts = both.where("block is not null").select("block", "counts").mapInArrow(_added, "block int, counts binary")
    blocks = parts.repartition(BLOCKS, "block").mapInArrow(_ranked, "block int, counts binary").collect()  # 4 MB at any input
    rank = np.concatenate([np.frombuffer(x.counts, np.uint8) for x in sorted(blocks)]) if blocks else np.zeros(1 << SKETCH_BITS, np.uint8)
    return both.where("block is null").drop("block", "counts"), rank


def _prefix(n, percent: int):
    """How many of a set's n tokens have one in common with any set that links with it. For arrays and columns."""
    if isinstance(n, Column):
        return n - F.floor((percent * n + 99) / 100) + 1
    return n - (percent * n + 99) // 100 + 1


def prefixes(docs: DataFrame, shared: Broadcast, percent: int = PERCENT) -> DataFrame:
    """token, node (key of the set), n, pos: the first tokens of each set in rare-first order (``shared``: the rank of each sketch cell)."""

    def make(texts: at.Texts, _) -> pa.RecordBatch:
        off, rows, found = _sets(texts)
        key, n = at.set_keys(off, found)[0], np.diff(off)
        rarity = shared.value[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        found = found[np.argsort(rows * 64 + rarity, kind="stable")]
        pos = np.arange(len(rows)) - off[rows]
        first = pos < _prefix(n, percent)[rows]
        rows, found, pos = rows[first], found[first], pos[first]
        arrays = [at.signed(found), at.signed(key[rows]), pa.array(n[rows], pa.int32()), pa.array(pos, pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, ["token", "node", "n", "pos"])

    return docs.select("text").mapInArrow(at.per_slice("text", make, lower=True), "token bigint, node bigint, n int, pos int")


def _rare_first(shared: Broadcast):
    """Makes a function from tokens to their places in the order of :func:`prefixes`."""

    def make():
        low = 64 - SKETCH_BITS
        place = np.empty(1 << SKETCH_BITS, np.uint32)  # of each sketch cell; a cell has one rank, so tokens of a cell are neighbours
        place[np.argsort(shared.value, kind="stable")] = np.arange(1 << SKETCH_BITS, dtype=np.uint32)

        def places(tokens: np.ndarray) -> np.ndarray:
            t = tokens.view(np.uint64)
            p = place[(t >> np.uint64(low)).astype(np.int64)].astype(np.uint64) << np.uint64(low) | t & np.uint64((1 << low) - 1)
            return (p ^ np.uint64(1 << 63)).view(np.int64)

        return places

    return make


def _full_sets(texts: at.Texts, _) -> pa.RecordBatch:
    off, _rows, found = _sets(texts)
    return pa.RecordBatch.from_arrays([at.signed(at.set_keys(off, found)[0]), at.lists(off, found.view(np.int64))], ["node", "s"])


def similarity_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Sets: distinct five-word shingles of the words ``[^\\x20\\x09-\\x0D]+``, A-Z in lower
    case; a text of one to four words is one shingle. Two rows link when 100 * common >=
    ``percent`` * union; component_id is the smallest doc_id reachable by links.

    NULL, empty and white texts have no shingles, link with nothing and are their own
    component. Equal sets are one node, so copies and repeated rows cost one node. A NULL
    doc_id is never the smallest; a component of NULLs alone has NULL. Only doc_id and
    text are read. Sets are known by 64-bit keys and shingles by 64-bit hashes.
    """
    rows, rank = profiles(docs)

    by_key = rows.select(F.col("key").alias("node"), F.col("n_shingles").alias("n"), "source", "marks")

    def known_of(nodes: DataFrame) -> DataFrame:
        some = by_key.join(nodes, "node", "left_semi").groupBy("node")
        return some.agg(F.min("n").alias("n"), F.min("source").alias("source"), F.max("marks").alias("marks"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = stage(pairs)
        known = stage(known_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
        side = lambda x: known.select(*[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "marks")])
        free = lambda x, y: without_own(F.col(f"n_{x}"), F.col(f"own_{x}"), F.col(f"last_{x}"), F.col(f"last_{y}"))
        room = F.least(free("a", "b"), free("b", "a"), marked_overlap(F.col("n_a"), F.col("n_b"), F.col("marks_a"), F.col("marks_b")))
        likely = (
            pairs.join(side("a"), F.col("a") == F.col("node_a"))
            .join(side("b"), F.col("b") == F.col("node_b"))
            .where((100 + percent) * room >= percent * (F.col("n_a") + F.col("n_b")))
            .select("a", "b")
        )

        def sets(wanted: DataFrame) -> DataFrame:
            sources = known.join(wanted, "node", "left_semi").select("source")
            some = docs.select(at.source().alias("source"), "text").join(small(sources), "source", "left_semi").select("text")
            full = some.mapInArrow(at.per_slice("text", _full_sets, lower=True), "node bigint, s array<bigint>")
            return full.join(wanted, "node", "left_semi")

        return verified(likely, sets, percent)

    marks = lambda nodes: known_of(nodes).select("node", "marks")
    shared = docs.sparkSession.sparkContext.broadcast(rank)  # one byte for each sketch cell
    _, found = linked(prefixes(docs, shared, percent), percent, verify, lambda n: _prefix(n, percent), _rare_first(shared), marks)
    return _named(rows, found)


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    placed = rows.join(found.withColumnRenamed("node", "key"), "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "key")).alias("component")
    )
    least = stage(placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")))
    return placed.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
