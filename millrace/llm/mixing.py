"""Mixing sources to target weights, with DataFrame functions only.

Words are summed by source, every source gets a target, and the target over what the
source holds is its rate: each document is repeated floor(rate) times, and once more
with a chance of what is left of the rate, drawn from a hash of its doc_id. No order, no
state and no second look at the corpus: one row per source is all that travels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running
from millrace.sources import stage

#: A word is a run of other characters than these.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: At most so many sources are sent to every task: all of them, or else those that hold one document in ``FEW``.
FEW = 20_000
#: The draw is a whole number below 2^52, taken from the first 13 digits of an MD5.
DRAWS = 2.0**52


def word_count(text: Column | str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; every word becomes one letter first, so no list of words is made. NULL: 0."""
    letters = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(letters, SPACE, "")), F.lit(0)).cast("bigint")


def _key(source: Column | str) -> Column:
    """A source as 32 characters whatever its length; NULL is a source too."""
    source = F.col(source) if isinstance(source, str) else source
    return F.md5(F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-")))


def cycled(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``sources`` with ``weight``: the given weights in turn, over the sources by code point, NULL last."""
    named = sources.withColumn("_none", F.col("source").isNull())
    placed = running(named, [], ["_none", "source"], {"_place": F.lit(1)}, include_current=False)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    return placed.withColumn("weight", F.get(listed, (F.col("_place") % len(weights)).cast("int"))).drop("_none", "_place")


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target`` and ``rate``.

    ``share`` of all sizes is dealt by weight. No target exceeds ``most`` times its source's size;
    what is over goes to the others by weight until none exceeds it. By ascending limit
    per weight, sources are at their limits up to the first whose limit is above its share of what is left.
    """
    rows = sources.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("_ratio", F.col("_cap") / F.col("weight")).withColumn("_none", F.col("source").isNull())
    sums = {"_caps": F.col("_cap"), "_weights": F.col("weight")}
    totals = {"_all": F.col("source_size"), "_weight": F.col("weight")}
    rows = running(rows, [], ["_ratio", "_none", "source"], sums, totals, include_current=False)
    left = lambda caps, weights: (F.col("_all") * F.lit(float(share)) - caps) / (F.col("_weight") - weights)
    rows = stage(rows.withColumn("_full", F.col("_cap") <= left(F.col("_caps"), F.col("_weights")) * F.col("weight")))
    full = rows.where("_full").agg(F.coalesce(F.sum("_cap"), F.lit(0.0)).alias("c"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).first()
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(left(F.lit(full["c"]), F.lit(full["w"])) * F.col("weight"))
    # Sizes of 0 have no rate; a limit of no words is reached at once.
    rows = rows.withColumn("target", target).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    return rows.select(*sources.columns, "target", "rate")


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` with what ``rates`` says of their ``_key``. A source with many documents is never a shuffle key."""
    if rates.count() <= FEW:
        return rows.join(F.broadcast(rates), "_key")
    total = rates.agg(F.sum("_docs")).first()[0]
    busy = F.col("_docs") * FEW >= total
    seen = rows.join(F.broadcast(rates.where(busy).withColumn("_busy", F.lit(True))), "_key", "left")
    late = seen.where("_busy is null").select(*rows.columns).join(rates.where(~busy), "_key")
    return seen.where("_busy").drop("_busy").unionByName(late)


def _rates(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    per_source = stage(sized.groupBy("_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("_docs")))
    return stage(targets(cycled(per_source, weights), share, most).select("_key", "source_size", "target", "rate", "_docs"))


def _copies(rate: Column, draw: Column) -> Column:
    whole = F.floor(rate)
    return (whole + (draw < rate - whole).cast("int")).cast("bigint")


def _draw(seed: str) -> Column:
    """A number from 0 to below 1 from the document's id, or from its text where that is NULL."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("text")), F.lit("-"))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 13), 16, 10).cast("double") / F.lit(DRAWS)


def repetitions(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, copies: how often the mix takes each row of ``docs`` (doc_id, source, text).

    NULL texts have size 0; a source without words is not taken; a NULL source is one
    source, the last. Rows of one doc_id share their draw; a NULL doc_id draws by its text. An empty
    table gives no rows. Other columns are not read.
    """
    sized = stage(docs.select("doc_id", "source", _key("source").alias("_key"), word_count("text").alias("size"), _draw(seed).alias("_u")))
    rows = _with_rates(sized, _rates(sized, weights, share, most))
    return rows.select("doc_id", "size", "source_size", "target", _copies(F.col("rate"), F.col("_u")).alias("copies"))


def mixed(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mix itself: the rows of ``docs``, with all their columns, as often as :func:`repetitions` says."""
    sized = docs.select("source", _key("source").alias("_key"), word_count("text").alias("size"))
    rates = _rates(sized, weights, share, most)
    packed = docs.select(F.struct("*").alias("_row"), _key("source").alias("_key"), _draw(seed).alias("_u"))
    rows = _with_rates(packed, rates).select("_row", _copies(F.col("rate"), F.col("_u")).alias("_n")).where("_n > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).select("_row.*")
