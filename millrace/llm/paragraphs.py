"""Near-duplicate paragraphs by MinHash banding, verified and removed by component.

A paragraph is a run of words between borders that the words themselves set: it begins at
a word whose hash is the smallest of ``REACH`` words on either side. So a passage has the same paragraphs
inside a longer line, or wrapped at other places, and white space counts for nothing. Its set is that of its
five-word shingles; equal sets are one node. Three bands of one minimum hash find a pair of
similarity 0.75 with a chance of 1 - 0.25^3 = 0.984; what collides is compared
exactly, in long runs of a band where rare shingles allow a link. Of each component the first paragraph stays where it is. In other documents
connected paragraphs of ``RUN_WORDS`` words or more that repeat are taken out; shorter repeats stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.llm import arrowtext as at
from millrace.llm import sieve
from millrace.llm.linking import linked_of, meet, not_alone, small, verified
from millrace.sources import stage

BANDS, ROWS = 3, 1
PERCENT = 75
#: Paragraphs are more than so many words long, but for a text's first and last; twice that on average.
REACH = 7
#: Borders depend on 7 words around them. By simulation, of passages of 60 words 0.86 hold 20 words and more in whole
#: paragraphs whatever is around them, of 70 words 0.97; of 51 words 0.57, more where a line or text begins with them.
RUN_WORDS = 20


def borders(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The words that begin a paragraph; ``h`` are word hashes, ``first`` each row's first word (rows + 1)."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    least = np.ones(len(h), bool)
    for j in range(1, REACH + 1):
        apart = row[j:] != row[:-j]
        least[j:] &= (h[j:] < h[:-j]) | apart
        least[: max(len(h) - j, 0)] &= (h[:-j] <= h[j:]) | apart
    least[first[:-1][np.diff(first) > 0]] = True
    return np.flatnonzero(least)


class _Paragraphs:
    """The paragraphs of a slice: row, number in the row, words, byte span, and set (offsets, paragraph, hashes)."""

    def __init__(self, texts: at.Texts):
        starts, ends, first = texts.words(at.NOT_SPACE)
        h = texts.hashes(starts, ends)
        begin = borders(h, first)
        bound = np.append(begin, len(h))
        self.row = np.searchsorted(first, begin, "right") - 1
        self.number = np.arange(len(begin)) - np.searchsorted(begin, first[:-1])[self.row] if len(begin) else begin
        self.words = np.diff(bound)
        self.low, self.high = starts[begin], ends[bound[1:] - 1]
        self.off, _, self.found = at.shingle_sets(h, bound)


def _minima(off: np.ndarray, found: np.ndarray) -> list[np.ndarray]:
    if len(off) < 2:
        return [np.empty(0, np.uint64)] * (BANDS * ROWS)
    return [np.minimum.reduceat(at.mix(found ^ at.PLACE[8 + j]), off[:-1]) for j in range(BANDS * ROWS)]


def _places():
    def make(texts: at.Texts, batch: pa.RecordBatch) -> pa.RecordBatch:
        p = _Paragraphs(texts)
        ids = [batch.column(c).cast(pa.int64()).take(pa.array(p.row)) for c in ("doc_id", "source")]
        numbers = [pa.array(x, pa.int32()) for x in (p.number, p.words)]
        return pa.RecordBatch.from_arrays([*ids, *numbers, at.signed(at.set_keys(p.off, p.found)[0])], ["doc_id", "source", "paragraph", "words", "node"])

    return at.per_slice("text", make, lower=True)


def _bands():
    def make(texts: at.Texts, _) -> pa.RecordBatch:
        p = _Paragraphs(texts)
        key, n, least = at.set_keys(p.off, p.found)[0], np.diff(p.off), _minima(p.off, p.found)
        tokens = [at.mix(sum(least[ROWS * b + r] * at.PLACE[40 + r] for r in range(ROWS)) + at.PLACE[42 + b]) for b in range(BANDS)]
        # A set that a slice holds more than once comes twice, with one band.
        _, once, count = np.unique(key, return_index=True, return_counts=True)
        which = [np.concatenate([once, once[count > 1]]), *[once] * (BANDS - 1)]
        rows = np.concatenate(which)
        return pa.RecordBatch.from_arrays(
            [at.signed(np.concatenate([t[i] for t, i in zip(tokens, which, strict=True)])), at.signed(key[rows]), pa.array(n[rows], pa.int32()), pa.array(np.zeros(len(rows), np.int32))],
            ["token", "node", "n", "pos"],
        )

    return at.per_slice("text", make, lower=True)


def _place_keys(source: np.ndarray, node: np.ndarray) -> np.ndarray:
    return at.mix(node.view(np.uint64) + at.mix(source.view(np.uint64) ^ at.PLACE[6]))


def _text_keys(source: np.ndarray) -> np.ndarray:
    return at.mix(source.view(np.uint64) ^ at.PLACE[7])


def _wanted(batches):
    """What :func:`_sets` looks up of rows (node, source): a key for each row, and one for its text."""
    for batch in batches:
        source, node = (batch.column(c).to_numpy() for c in ("source", "node"))
        yield pa.RecordBatch.from_arrays([at.signed(np.concatenate([_place_keys(source, node), _text_keys(np.unique(source))]))], ["key"])


def _sets(shared: Broadcast):
    """The sets of the texts and paragraphs that the filter ``shared`` of :func:`_wanted` passes."""

    def make(texts: at.Texts, batch: pa.RecordBatch) -> pa.RecordBatch:
        p = _Paragraphs(texts)
        node = at.set_keys(p.off, p.found)[0].view(np.int64)
        source = batch.column("source").to_numpy()[p.row]
        keys, once = np.unique(_place_keys(source, node), return_index=True)
        hit = once[sieve.passing(shared.value, keys)]
        spans = [p.found[p.off[i] : p.off[i + 1]] for i in hit]
        sizes = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int64)
        values = np.concatenate(spans) if spans else np.empty(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(source[hit]), pa.array(node[hit]), at.lists(sizes, values.view(np.int64))], ["source", "node", "s"])

    per_slice = at.per_slice("text", make, lower=True)
    some = lambda batch: batch.filter(pa.array(sieve.passing(shared.value, _text_keys(batch.column("source").to_numpy()))))
    return lambda batches: per_slice(map(some, batches))


def _cut(batches):
    """Texts without the paragraphs numbered in ``gone``; a line that goes as a whole takes its line break with it."""
    for batch in batches:
        texts, gone = batch.column("text").to_pylist(), batch.column("gone").to_pylist()
        for part in at.slices(batch.column("text"), lower=True):
            here = [i for i in range(part.low, part.low + part.rows) if gone[i]]
            if not here:
                continue
            p = _Paragraphs(part)
            for i in here:
                mine = np.flatnonzero(p.row == i - part.low)
                raw, begin, kept, done = texts[i].encode(), part.off[i - part.low], [], 0
                for number in _runs(sorted(gone[i]), len(mine)):
                    low, high = int(p.low[mine[number[0]]] - begin), int(p.high[mine[number[1]]] - begin)
                    if (low == 0 or raw[low - 1] == 10) and high < len(raw) and raw[high] == 10:
                        high += 1
                    elif high == len(raw) and low > 0 and raw[low - 1] == 10:
                        low -= 1
                    kept.append(raw[done : max(low, done)])
                    done = high
                texts[i] = b"".join([*kept, raw[done:]]).decode()
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def _runs(numbers: list[int], size: int) -> list[tuple[int, int]]:
    """Consecutive numbers as (first, last); numbers of another row with the same id are left out."""
    out: list[tuple[int, int]] = []
    for k in numbers:
        if k >= size:
            break
        if out and out[-1][1] == k - 1:
            out[-1] = (out[-1][0], k)
        else:
            out.append((k, k))
    return out


def removals(docs: DataFrame, percent: int = PERCENT, run_words: int = RUN_WORDS) -> DataFrame:
    """doc_id, source, paragraph, words, kept_doc, kept_paragraph: every paragraph to take out, and the one that stays for it.

    Paragraphs of ``docs`` (doc_id, text) are numbered from 0 in each text; words are ``[^\\x20\\x09-\\x0D]+``, A-Z
    count as a-z. Two link when their sets of five-word shingles have a Jaccard
    similarity of ``percent`` or more (a shorter paragraph is one shingle). Of each component the paragraph with the smallest
    (doc_id, paragraph) stays, a NULL doc_id last; those of the same document stay with it. Of the others, connected ones of
    ``run_words`` words or more in all go.

    NULL and empty texts have no paragraphs. Rows of the same doc_id are taken for one
    document: their paragraphs of one number stay or go together; so are rows without doc_id
    of the same text. ``source`` tells documents apart. Ties have one order. Other columns are not read.
    """
    text = docs.select("doc_id", "text", at.source().alias("source"))
    met = meet(text.select("text").mapInArrow(_bands(), "token bigint, node bigint, n int, pos int"), percent)
    # most paragraphs are alone with their bands, so they neither stay for another nor go
    places = text.mapInArrow(_places(), "doc_id bigint, source bigint, paragraph int, words int, node bigint")
    places = stage(places.join(small(not_alone(met)), "node", "left_semi"))
    at_place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("source"), F.col("paragraph"))

    def sets(wanted: DataFrame) -> DataFrame:
        # texts stay where they are: only sets that the filter passes are moved
        where = stage(places.join(wanted, "node", "left_semi").groupBy("node").agg(F.min_by("source", at_place).alias("source")))
        shared = docs.sparkSession.sparkContext.broadcast(sieve.made(where.mapInArrow(_wanted, "key bigint"), where.count()))
        some = text.select("text", "source").mapInArrow(_sets(shared), "source bigint, node bigint, s array<bigint>")
        return some.join(where, ["source", "node"], "left_semi").select("node", "s")

    def weights(nodes: DataFrame) -> DataFrame:
        return places.join(nodes, "node", "left_semi").groupBy("node").agg(F.count("*").cast("double").alias("weight"))

    _, found = linked_of(met, percent, lambda pairs: verified(pairs, sets, percent), weights=weights, members=sets, chances=10)
    found = stage(found)
    per_node = places.groupBy("node").agg(F.count("*").alias("n"), F.min(at_place).alias("first"))
    joined = per_node.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = joined.groupBy("component").agg(F.sum("n").alias("n"), F.min("first").alias("kept")).where("n > 1")
    kept = stage(joined.select("node", "component").join(groups, "component").select("node", "kept"))
    same = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("source") == F.col("kept.source"))
    again = places.join(kept, "node").where(~same).groupBy("doc_id", "source", "paragraph").agg(F.max("words").alias("words"), F.min("kept").alias("kept"))
    document = W.partitionBy("doc_id", "source")
    again = again.withColumn("run", F.col("paragraph") - F.row_number().over(document.orderBy("paragraph")))
    again = again.withColumn("run_words", F.sum("words").over(W.partitionBy("doc_id", "source", "run"))).where(F.col("run_words") >= run_words)
    return again.select("doc_id", "source", "paragraph", "words", F.col("kept.doc_id").alias("kept_doc"), F.col("kept.paragraph").alias("kept_paragraph"))


def _left(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """(row, text, removed): the rows of ``docs`` as structs, the text that is left, and what :func:`removals` names of each.

    Only texts of which something goes are joined with it.
    """
    per_doc = gone.groupBy(F.col("doc_id").alias("_doc"), F.col("source").alias("_source")).agg(
        F.sort_array(F.collect_list(F.struct("paragraph", "words", "kept_doc", "kept_paragraph"))).alias("removed")  # at most a document's paragraphs
    )
    per_doc = stage(per_doc)
    ids = small(per_doc.select("_source").distinct())
    rows = docs.select(F.struct("*").alias("row"), at.source().alias("_source"), "doc_id", "text")
    none = F.array().cast("array<struct<paragraph:int,words:int,kept_doc:bigint,kept_paragraph:int>>")
    whole = rows.join(ids, "_source", "left_anti").select("row", "text", none.alias("removed"))
    some = rows.join(ids, "_source", "left_semi")
    some = some.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_doc")) & (some["_source"] == per_doc["_source"]), "left")
    some = some.select(F.struct("row", F.coalesce("removed", none).alias("removed")).alias("row"), "text", F.transform("removed", lambda r: r["paragraph"]).alias("gone"))
    schema = f"row {some.schema['row'].dataType.simpleString()}, text string"
    return whole.unionByName(some.mapInArrow(at.tidied(_cut), schema).select("row.row", "text", "row.removed"))


def without_repeats(docs: DataFrame, percent: int = PERCENT, run_words: int = RUN_WORDS) -> DataFrame:
    """``docs`` with all columns and the texts that :func:`deduplicated` leaves; rows of which no word is left go."""
    left = _left(docs, removals(docs, percent, run_words)).where((F.size("removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("removed") == 0, F.col("row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def deduplicated(docs: DataFrame, percent: int = PERCENT, run_words: int = RUN_WORDS) -> DataFrame:
    """doc_id, n_removed, removed (paragraph, words, kept_doc, kept_paragraph) and the text that is left, for every row of ``docs``.

    What :func:`removals` names is taken out; the rest of a text is unchanged, with the few words before the first
    and after the last border of a passage. A NULL text stays NULL. A text that goes as a whole is empty.
    """
    left = _left(docs.select("doc_id", "text"), removals(docs, percent, run_words))
    return left.select("row.doc_id", F.size("removed").cast("bigint").alias("n_removed"), "removed", "text")
