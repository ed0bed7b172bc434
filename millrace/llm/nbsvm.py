"""Quality scores by naive Bayes support vectors.

A text is the set of its n-grams: words, word pairs, and triples of character shapes.
Each indicator is scaled by the logarithm of how much likelier it is in one class than in the
other, and a linear hinge-loss model is fitted to the scaled sets by dual coordinate descent.
The margin becomes a probability by a logistic curve fitted on sample rows kept apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrowtext as at

#: Labelled rows of each class that the model is fitted on, at most.
SAMPLE = 4000
SHAPES = 1 << 15
WORDS = 1 << 17
SIZE = SHAPES + 2 * WORDS + 64
#: Rows whose shapes are marked at a time, a byte for each shape: 8 MB, however short the texts are.
MARKED_ROWS = 256

# letters by case, digits and white space are one shape each, signs of ASCII their own
_SHAPE = np.zeros(256, np.int64)
for _i, _c in enumerate(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _SHAPE[_c] = 1 + _i % 25
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 26, 27, 28, 27
_SHAPE[[9, 11, 12, 13, 32]], _SHAPE[10] = 29, 30


def features(texts: at.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct n-grams of each row, sorted."""
    code = _SHAPE[texts.data]
    found = []
    for low in range(0, texts.rows, MARKED_ROWS):
        off = texts.off[low : low + MARKED_ROWS + 1]
        part = code[off[0] : off[-1]]
        row_of = np.repeat(np.arange(len(off) - 1), np.diff(off))
        marks = np.zeros((len(off) - 1) * SHAPES, bool)
        if len(part) > 2:
            inside = row_of[2:] == row_of[:-2]
            marks[(row_of[2:] * SHAPES + part[:-2] * 1024 + part[1:-1] * 32 + part[2:])[inside]] = True
        hit = np.flatnonzero(marks)
        found.append((low + hit // SHAPES) * SIZE + hit % SHAPES)
    starts, ends, first = texts.words(at.NOT_SPACE)
    h = texts.hashes(starts, ends)
    word_row = np.repeat(np.arange(texts.rows), np.diff(first))
    found.append(np.unique(word_row * SIZE + SHAPES + (h % np.uint64(WORDS)).astype(np.int64)))
    pairs, where = at.windows(h, first, 2)
    found.append(np.unique(word_row[where] * SIZE + SHAPES + WORDS + (pairs % np.uint64(WORDS)).astype(np.int64)))
    # how much of the text repeats itself, how long it is, and how long its words are, in steps
    n = np.diff(first)
    triples, where = at.windows(h, first, 3)
    order = np.lexsort((triples, word_row[where]))
    again = np.zeros(len(order), bool)
    again[1:] = (triples[order][1:] == triples[order][:-1]) & (word_row[where][order][1:] == word_row[where][order][:-1])
    repeated = np.bincount(word_row[where][order][again], minlength=texts.rows)
    steps = [np.ceil(10 * repeated / np.maximum(1, n)), 16 + np.log2(n + 1).clip(0, 23), 40 + (np.diff(texts.off) / np.maximum(1, n)).clip(0, 23)]
    found += [np.arange(texts.rows) * SIZE + SHAPES + 2 * WORDS + s.astype(np.int64) for s in steps]
    every = np.sort(np.concatenate(found))
    return every // SIZE, every % SIZE


def fold(doc_id: str, parts: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def sample_of(labels: DataFrame, label: str, learn_from: Column, most: int) -> tuple[DataFrame, float]:
    """(doc_id, label) of at most ``most`` rows of each class, by the order of a hash of doc_id; and the share of
    label 1 among all rows to learn from. Of several labels of one doc_id the larger one holds."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn_from).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    mean = rows.agg(F.avg("label")).first()[0]
    one = lambda v: rows.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return one(0).union(one(1)), 0.5 if mean is None else float(mean)


def _rows(batches):
    for batch in batches:
        for texts in at.slices(batch.column("text")):
            row, feature = features(texts)
            off = np.searchsorted(row, np.arange(texts.rows + 1))
            labels = batch.column("label").slice(texts.low, texts.rows)
            ids = batch.column("doc_id").slice(texts.low, texts.rows)
            yield pa.RecordBatch.from_arrays([ids, labels, at.lists(off, feature.astype(np.int32))], ["doc_id", "label", "features"])


def _descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: weights of the scaled features, and the bias."""
    random = np.random.Generator(np.random.PCG64(7))
    w, bias, alpha = np.zeros(SIZE), 0.0, np.zeros(len(rows))
    values = [ratio[r] / max(1e-9, np.sqrt(np.sum(ratio[r] ** 2))) for r in rows]
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = y[i] * (np.dot(w[r], v) + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cost[i])  # a scaled row has length 1, its bias feature too
            if new != alpha[i]:
                w[r] += (new - alpha[i]) * y[i] * v
                bias += (new - alpha[i]) * y[i]
                alpha[i] = new
    return w, bias


def _curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve, by Newton's method with a little shrinkage."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, s = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        ga, gb = np.dot(g, margin) + 1e-2 * (a - 1), g.sum() + 1e-2 * b
        haa, hab, hbb = np.dot(s, margin**2) + 1e-2, np.dot(s, margin), s.sum() + 1e-2
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -5, 5), b - np.clip(db, -5, 5)
        if abs(da) + abs(db) < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def _fit(share: float, smoothing: float, cost: float, rounds: int):
    def run(batches):
        ids, labels, rows = [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            labels += batch.column("label").to_pylist()
            rows += [x.values.to_numpy() for x in batch.column("features")]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], labels[i]))
        y, rows = np.array([labels[i] for i in order], float), [rows[i] for i in order]
        w, bias, a, b = np.zeros(SIZE), 0.0, 1.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        if 0 < y.sum() < len(y):
            apart = np.arange(len(y)) % 4 == 3
            learn = np.flatnonzero(~apart) if 0 < y[~apart].sum() < (~apart).sum() else np.arange(len(y))
            counts = [np.bincount(np.concatenate([rows[i] for i in learn if y[i] == k]), minlength=SIZE) + smoothing for k in (1, 0)]
            ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
            of = np.array([share / max(1, y[learn].sum()), (1 - share) / max(1, (1 - y[learn]).sum())])
            costs = cost * len(learn) * np.where(y[learn] == 1, of[0], of[1])
            w, bias = _descent([rows[i] for i in learn], np.where(y[learn] == 1, 1.0, -1.0), ratio, costs, rounds)
            size = np.array([max(1e-9, np.sqrt(np.sum(ratio[r] ** 2))) for r in rows])
            margin = np.array([np.dot(w[r], ratio[r]) for r in rows]) / size + bias
            test = np.flatnonzero(apart) if 0 < y[apart].sum() < apart.sum() else np.arange(len(y))
            natural = np.where(y[test] == 1, share / max(1, y[test].sum()), (1 - share) / max(1, (1 - y[test]).sum())) * len(test)
            a, b = _curve(margin[test], y[test], natural)
            w = np.stack([w * ratio, ratio**2])
        else:
            w = np.zeros((2, SIZE))
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary()), pa.array([bias]), pa.array([a]), pa.array([b])], ["weights", "bias", "slope", "offset"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, sample: int = SAMPLE, smoothing: float = 0.5, cost: float = 1.0, rounds: int = 15) -> dict:
    """The model: two numbers for each feature (weight, squared scale), bias, slope and offset: about 2 MB at any input."""
    chosen, share = sample_of(labels, label, learn_from, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(_rows, "doc_id bigint, label int, features array<int>")
    out = rows.repartition(1).mapInArrow(_fit(share, smoothing, cost, rounds), "weights binary, bias double, slope double, offset double").first()
    return {"weights": np.frombuffer(out.weights, np.float32).reshape(2, SIZE), "bias": out.bias, "slope": out.slope, "offset": out.offset}


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score, the probability of label 1, for every row of ``docs`` (doc_id, text).

    NULL and empty texts have the score of a text without n-grams but for its length. Repeated rows get equal answers.
    Only doc_id and text are read, and doc_id is only passed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: at.Texts, batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        row, feature = features(texts)
        dot = np.bincount(row, m["weights"][0][feature], minlength=texts.rows)
        size = np.sqrt(np.maximum(1e-18, np.bincount(row, m["weights"][1][feature], minlength=texts.rows)))
        z = m["slope"] * (dot / size + m["bias"]) + m["offset"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(at.per_slice("text", make), "doc_id bigint, score double")
