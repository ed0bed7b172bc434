"""A Merkle manifest of a table: a hash tree per group, a tree over the groups, and a proof per row.

A row's rank in its group, in digits of base 8, is its path through the group's tree.
Blocks of ``FAN ** LEVELS`` nodes come together in one shuffle; inside a block the digits are
grouped away one after the other, and each node holds its children as structs. What is
left, a node per block, is the next tier's table, so no task holds more than a block.
Proofs go the other way: a block takes the path above it, by one join with a row per
block, and every level is a transform over the children and an explode.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import ROWS_PER_TASK, join_by, running
from millrace.sources import stage

FAN_BITS = 3
LEVELS = 3
#: Ranks are counted in parts of so many rows at least, and of a 256th of all rows.
LEAST_ROWS = 2_000
NO_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon and the value: no two lists of fields read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """A row's digest from doc_id, source, lang, n_chars and text, or another text in its place."""
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(F.col("text") if text is None else text))


def folded(start: Column, path: Column) -> Column:
    """The root that a digest and a path lead to."""
    return F.aggregate(path, start, lambda at, p: digest(p["left"], at, p["right"]))


def siblings(path: Column) -> Column:
    """The digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


@dataclass
class Manifest:
    """Trees that are written. ``tiers`` (lowest first) hold blocks of the groups' trees, ``top`` of the tree over the groups."""

    by: str
    tiers: list[DataFrame]
    top: list[DataFrame]

    def subroots(self) -> DataFrame:
        """(group, subroot): one row for each group."""
        return self.tiers[-1].select(self.by, F.col("h").alias("subroot"))

    def root(self) -> DataFrame:
        """One row, or none for an empty table."""
        return self.top[-1].select(F.col("h").alias("root"))

    def proofs(self) -> DataFrame:
        """What was carried, with leaf, subroot, root and path: (left, right) digests of each level from the leaf to the root."""
        start = self.top[-1].select("_all", F.lit(0).cast("bigint").alias("_rank"), F.lit(None).cast("int").alias("_none"), F.col("h").alias("root"))
        start = start.withColumn("path", F.array().cast(NO_PATH)).drop("_none")
        groups = _descended(self.top, start, ["_all"], ["root"])
        begin = groups.select("in.*", F.lit(0).cast("bigint").alias("_rank"), "root", F.col("h").alias("subroot"), "path")
        rows = _descended(self.tiers, begin, [self.by], ["root", "subroot"])
        return rows.select("in.*", F.col("h").alias("leaf"), "subroot", "root", "path")


def _levels(n: str) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: octal digits of the last rank, none for a lone leaf."""
    last = F.conv((F.col(n) - 1).cast("string"), 10, 2**FAN_BITS)
    return F.when(F.col(n) <= 1, 0).otherwise(F.length(last))


def _digit(place: int) -> Column:
    return F.shiftright("_rank", FAN_BITS * place).bitwiseAND(F.lit(2**FAN_BITS - 1)).cast("int")


def _rolled(rows: DataFrame, keys: list[str], below: int) -> DataFrame:
    """Blocks of ``rows`` (keys, _levels, _rank, h, in), ``below`` levels up already, as one nested row each."""
    fixed = [*keys, "_levels", "_block"]
    places = [f"_d{j}" for j in range(LEVELS)]
    nodes = rows.withColumn("_block", F.shiftright("_rank", FAN_BITS * LEVELS))
    nodes = nodes.withColumns({p: _digit(j) for j, p in enumerate(places)}).repartition(*keys, "_block")
    for j in range(LEVELS):
        child = F.struct(F.col(places[j]).alias("d"), "h", "in")
        nodes = nodes.groupBy(*fixed, *places[j + 1 :]).agg(F.sort_array(F.collect_list(child)).alias("in"))
        # A tree that has its root by now has one node left, which stays as it is.
        joined = F.array_join(F.transform("in", lambda k: k["h"]), "")
        nodes = nodes.withColumn("h", F.when(F.col("_levels") > below + j, digest(joined)).otherwise(F.col("in")[0]["h"]))
    return nodes.withColumnRenamed("_block", "_rank")


def _tower(rows: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Tiers of blocks up to one block for each key."""
    most = rows.agg(F.max("_levels")).first()[0] or 0
    tiers = []
    for below in range(0, max(most, 1), LEVELS):
        tiers.append(stage(_rolled(rows, keys, below)))
        rows = tiers[-1].withColumn("in", F.lit(0))
    return tiers


def _descended(tiers: list[DataFrame], top: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """The lowest nodes below ``top`` (keys, _rank, path, kept), with their paths."""
    at = top
    for tier in reversed(range(len(tiers))):
        rows = join_by(tiers[tier].drop("h"), at, [*keys, "_rank"])
        for j in reversed(range(LEVELS)):
            part = lambda low, n: F.array_join(F.transform(F.slice("in", low, n), lambda k: k["h"]), "")  # noqa: E731, B023
            beside = F.transform("in", lambda k, i: F.struct(k.alias("k"), part(F.lit(1), i).alias("left"), part(i + 2, F.lit(2**FAN_BITS)).alias("right")))
            rows = rows.select(*keys, "_levels", "_rank", *kept, "path", F.explode(beside).alias("c"))
            step = F.array(F.struct(F.col("c.left").alias("left"), F.col("c.right").alias("right")))
            path = F.when(F.col("_levels") > tier * LEVELS + j, F.concat(step, "path")).otherwise(F.col("path"))
            rank = F.col("_rank") * 2**FAN_BITS + F.col("c.k.d")
            rows = rows.select(*keys, "_levels", rank.alias("_rank"), *kept, path.alias("path"), F.col("c.k.h").alias("h"), F.col("c.k.in").alias("in"))
        at = rows.select(*keys, "_rank", *kept, "path")
    return rows


def manifest(leaves: DataFrame, by: str, order: list[str], carry: list[str]) -> Manifest:
    """Trees over ``leaves``: a column ``leaf`` of digests, grouped by ``by`` and ranked by ``order``.

    NULLs come first in both. Rows that are equal in ``order`` are ranked by their leaves; rows that
    are equal in these too have one digest and take places next to each other.
    ``carry`` names the columns (of types that sort) that proofs give back.
    """
    named = leaves.select(F.col(by).alias(by), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col("leaf").alias("h"), F.struct(*carry).alias("in"))
    rows = stage(named.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())))
    part = min(ROWS_PER_TASK, max(LEAST_ROWS, rows.count() // 256))
    places = [*[f"_o{i}" for i in range(len(order))], "h", "_tie"]
    placed = running(rows, [by], places, {"_rank": F.lit(1).cast("bigint")}, {"_n": F.lit(1).cast("bigint")}, False, part)
    placed = placed.select(by, _levels("_n").alias("_levels"), "_rank", "h", "in")
    tiers = _tower(placed, [by])
    groups = running(tiers[-1].select(by, "h"), [], [by], {"_rank": F.lit(1).cast("bigint")}, {"_n": F.lit(1).cast("bigint")}, False)
    groups = groups.select(F.lit(0).alias("_all"), _levels("_n").alias("_levels"), "_rank", "h", F.struct(by).alias("in"))
    return Manifest(by, tiers, _tower(groups, ["_all"]))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def audit(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: a manifest of ``docs``
    (doc_id, source, lang, n_chars, text) held against texts of which a third is lower-cased.

    One row for each row of ``docs``. NULL fields have a mark of their own in the digest, empty texts
    are texts, a NULL lang is a group, the first. Repeated rows are leaves of their own. A NULL doc_id comes first and
    is not tampered with. An empty table gives no rows. Other columns are not read.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(hit, leaf(F.translate("text", _UPPER, _LOWER)))
    leaves = docs.select("doc_id", "lang", leaf().alias("leaf"), changed.alias("_changed"))
    rows = manifest(leaves, "lang", ["doc_id"], ["doc_id", "_changed"]).proofs()
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded(F.coalesce("_changed", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
