"""Benchmark decontamination as a prefix-filtered set join.

A benchmark window is a run of 13 words of an item (all words of a shorter item). Its
tokens are its shingles of five words. A document can hold a window only if it holds the
window's rarest shingle, so each window is joined on that one alone, with its place and
length, and then compared word by word. Rarity is the number of times a shingle occurs in
all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrowtext as at
from millrace.sources import stage

WINDOW = 13
#: Bits of the filter that a document's shingles pass before they become rows: 2 MB whatever the benchmark's size.
FILTER_BITS = 24


def _words(texts: at.Texts, starts, ends, low: int, high: int) -> list[str]:
    return [texts.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[low:high], ends[low:high], strict=True)]


def _item_windows(batches):
    """A row for each shingle of each window: item_id, words of the window, token, width and offset of the shingle."""
    for batch in batches:
        for texts in at.slices(batch.column("text"), lower=True):
            starts, ends, first = texts.words(at.LETTER_DIGIT)
            h = texts.hashes(starts, ends)
            ids = batch.column("item_id").slice(texts.low, texts.rows).to_pylist()
            out = {"item_id": [], "words": [], "token": [], "width": [], "offset": []}
            for row in range(texts.rows):
                low, high = int(first[row]), int(first[row + 1])
                for at_word in range(low, max(low + 1, high - WINDOW + 1)) if high > low else ():
                    end = min(high, at_word + WINDOW)
                    words, width = _words(texts, starts, ends, at_word, end), min(at.WIDTH, end - at_word)
                    tokens = at.windows(h[at_word:end], np.array([0, end - at_word]), width)[0].view(np.int64)
                    for offset, token in enumerate(tokens.tolist()):
                        for k, v in zip(out, (ids[row], words, token, width, offset), strict=True):
                            out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.int64()), pa.array(out["words"], pa.list_(pa.string())), pa.array(out["token"], pa.int64()), pa.array(out["width"], pa.int32()), pa.array(out["offset"], pa.int32())], list(out))


def _places(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = tokens.view(np.uint64)
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (t & mask).astype(np.int64), ((t >> np.uint64(FILTER_BITS)) & mask).astype(np.int64)


def _marked(batches):
    bits = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        for places in _places(batch.column("token").to_numpy()):
            bits[places] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])


def _either(batches):
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for batch in batches:
        for x in batch.column("bits"):
            bits |= np.frombuffer(x.as_buffer(), np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], ["bits"])


def _scan(docs: DataFrame, bits: np.ndarray, widths: list[int]) -> DataFrame:
    """A row for each document (token NULL), and one for each of its shingles that the filter passes, with the words around it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2 MB

    def passing(tokens: np.ndarray) -> np.ndarray:
        ok = np.ones(len(tokens), bool)
        for places in _places(tokens):
            ok &= (shared.value[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1
        return ok

    def make(texts: at.Texts, batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, ends, first = texts.words(at.LETTER_DIGIT)
        h, n = texts.hashes(starts, ends), np.diff(first)
        within = np.arange(len(h)) - np.repeat(first[:-1], n)
        key = at.mix(at.row_sums(h * at.mix(within.astype(np.uint64) + at.PLACE[5]), first) + n.astype(np.uint64))
        rows, tokens, pos, around, before = [np.arange(texts.rows)], [], [], [], []
        for width in widths:
            found, where = at.windows(h, first, width)
            ok = passing(found)
            found, where = found[ok], where[ok]
            row = np.searchsorted(first, where, "right") - 1
            rows.append(row), tokens.append(found.view(np.int64)), pos.append(where - first[row])
            for r, w in zip(row.tolist(), where.tolist(), strict=True):
                low, high = max(int(first[r]), w - WINDOW + 1), min(int(first[r + 1]), w + WINDOW)
                around.append(_words(texts, starts, ends, low, high)), before.append(w - low)
        rows = np.concatenate(rows)
        none = [None] * texts.rows
        numbers = lambda x: none + np.concatenate(x).tolist() if x else none
        doc_id = batch.column("doc_id").cast(pa.int64()).take(pa.array(rows))
        arrays = [doc_id, at.signed(key[rows]), pa.array(n[rows], pa.int64()), pa.array(numbers(tokens), pa.int64()), pa.array(numbers(pos), pa.int64()), pa.array(none + before, pa.int32()), pa.array(none + around, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "n_words", "token", "pos", "before", "around"])

    schema = "doc_id bigint, key bigint, n_words bigint, token bigint, pos bigint, before int, around array<string>"
    return docs.select("doc_id", "text").mapInArrow(at.per_slice("text", make, lower=True), schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of ``docs`` (doc_id, text).

    Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, A-Z in lower case. n_hit counts the
    document's words inside any occurrence of a window of ``benchmark`` (item_id, text);
    items are those with an occurring window. contaminated: n_hit > 0 and 20 * n_hit >= n_words.

    NULL, empty and wordless texts have no words, no hits and are not contaminated; such
    items have no window. An empty benchmark hits nothing. Repeated rows of either table change
    nothing: equal texts get equal answers, and an item counts once. An item without id is left out.
    Other columns are not read.
    """
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    schema = "item_id bigint, words array<string>, token bigint, width int, offset int"
    windows = stage(items.mapInArrow(_item_windows, schema))
    widths = [r.width for r in windows.select("width").distinct().collect()]  # five at most
    marked = windows.select("token").mapInArrow(_marked, "bits binary").repartition(1).mapInArrow(_either, "bits binary").first()
    scanned = stage(_scan(docs, np.frombuffer(marked.bits, np.uint8), sorted(widths)))
    rows, met = scanned.where("token is null"), scanned.where("token is not null")

    often = met.groupBy("token").agg(F.count("*").alias("often"))
    shingles = windows.select("words", "token", "offset").distinct().join(often, "token")
    complete = F.count("*") == F.size("words") - F.least(F.lit(at.WIDTH), F.size("words")) + 1
    rarest = (
        shingles.groupBy("words")
        .agg(F.min_by(F.struct("token", "offset"), F.struct("often", "offset")).alias("rare"), complete.alias("complete"))
        .where("complete")  # a window of which one shingle occurs nowhere occurs nowhere
        .select("words", F.size("words").alias("length"), "rare.token", "rare.offset")
    )
    at_start = (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("length") <= F.col("n_words"))
    equal = F.slice("around", F.col("before") - F.col("offset") + 1, F.col("length")) == F.col("words")
    found = stage(
        met.join(rarest, "token").where(at_start & (F.col("before") >= F.col("offset"))).where(equal)
        .select("doc_id", "key", (F.col("pos") - F.col("offset")).alias("start"), "length", "words")
        .distinct()
    )
    return _summed(rows, found, windows)


def _summed(rows: DataFrame, found: DataFrame, windows: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    same = ["doc_id", "key"]
    # words covered: of each occurrence in order, those beyond all earlier ones; a partition is one text
    order = Window.partitionBy(*same).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = found.withColumn("end", F.col("start") + F.col("length")).withColumn("reach", F.max("end").over(order))
    earlier = F.lag("reach", 1, 0).over(Window.partitionBy(*same).orderBy("start", "length"))
    hit = reach.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", earlier))).groupBy(*same).agg(F.sum("new").alias("n_hit"))
    named = found.select(*same, "words").distinct().join(windows.select("words", "item_id").distinct(), "words")
    items = named.groupBy(*same).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    both = hit.alias("h").join(items.alias("i"), F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("h.key") == F.col("i.key"))).select("h.*", "i.items")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    joined = rows.select("doc_id", "key", "n_words").alias("r").join(both.alias("f"), (F.col("r.doc_id").eqNullSafe(F.col("f.doc_id"))) & (F.col("r.key") == F.col("f.key")), "left")
    return joined.select(
        "r.doc_id",
        "n_words",
        n_hit.cast("bigint").alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
