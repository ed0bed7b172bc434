"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score of the words in it;
a document's score is the noisy-or of its sentences': the chance that at least one of them is
toxic. Only documents have labels; which sentences earn them is learned on the way, and
then tells where to look.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrowtext as at
from millrace.llm.nbsvm import sample_of

#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE = 2000
SIZE = 1 << 18
#: Besides whole words, their first so many bytes are features: words that share a stem share weights.
STEMS = (4, 5, 6)
THRESHOLD = 0.3
_STOP = np.ones(256, bool)
_STOP[np.frombuffer(b".!?\n", np.uint8)] = False


def _sentences(texts: at.Texts):
    """Word features in the order of words, the sentence of each, each sentence's row, and its bytes; sentences without words are left out."""
    starts, ends, _ = texts.words(at.LETTER_DIGIT)
    spans = [texts.hashes(starts, ends), *[texts.hashes(starts, np.minimum(ends, starts + k)) for k in STEMS]]
    feature = (np.stack(spans, axis=1).ravel() % np.uint64(SIZE)).astype(np.int64)
    low, high, _ = texts.spans(_STOP[texts.data])
    sentence = np.searchsorted(low, starts, "right") - 1
    used, sentence = np.unique(sentence, return_inverse=True)
    low, high, sentence = low[used], high[used], np.repeat(sentence, len(spans))
    return feature, sentence, np.searchsorted(texts.off, low, "right") - 1, low, high


def _rows(batches):
    for batch in batches:
        for texts in at.slices(batch.column("text"), lower=True):
            feature, sentence, row, _, _ = _sentences(texts)
            feature, sentence = _distinct(feature, sentence)
            words = np.searchsorted(row[sentence], np.arange(texts.rows + 1)) if len(sentence) else np.zeros(texts.rows + 1, int)
            begin = np.searchsorted(row, np.arange(texts.rows))
            owner = row[sentence] if len(sentence) else sentence
            number = sentence - begin[owner] if len(sentence) else sentence
            part = batch.slice(texts.low, texts.rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), at.lists(words, feature.astype(np.int32)), at.lists(words, number.astype(np.int32))], ["doc_id", "label", "features", "sentences"])


def _distinct(feature: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(sentence * SIZE + feature)
    return key % SIZE, key // SIZE


def _fit(share: float, rounds: int, least_errors: float, least_ratio: float, shrink: float):
    def run(batches):
        docs = []
        for batch in batches:
            for x in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), batch.column("features"), batch.column("sentences"), strict=True):
                docs.append((x[0], x[1], x[2].values.to_numpy(), x[3].values.to_numpy()))
        docs.sort(key=lambda d: (d[0], d[1]))
        y = np.array([d[1] for d in docs], float)
        weights, bias = np.zeros(SIZE), float(np.log(max(share, 1e-3) / 50))
        if 0 < y.sum() < len(y):
            with_it = [np.bincount(np.concatenate([np.unique(d[2]) for d in docs if d[1] == k]), minlength=SIZE) for k in (1, 0)]
            n1, n0 = y.sum(), (1 - y).sum()
            rate = (with_it[0] + with_it[1]) / (n1 + n0)
            chance = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n1 + 1 / n0))
            known_by = (with_it[0] / n1 - with_it[1] / n0) / chance  # in standard errors
            counts = [len(np.unique(d[3])) for d in docs]
            begin = np.concatenate([[0], np.cumsum(counts)])
            feature = np.concatenate([d[2] for d in docs])
            sentence = np.concatenate([begin[i] + np.unique(d[3], return_inverse=True)[1] for i, d in enumerate(docs)])
            feature, sentence = _distinct(feature, sentence)
            ratio = np.log((with_it[0] + 0.5) / n1 / ((with_it[1] + 0.5) / n0))
            use = (known_by >= least_errors)[feature] & (ratio >= least_ratio)[feature]
            known, feature = np.unique(feature[use], return_inverse=True)
            sentence = sentence[use]
            owner = np.repeat(np.arange(len(docs)), counts)
            cost = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum())
            # begin with the log-ratio of documents that have the feature, as naive Bayes would
            w, b = ratio[known], bias
            m, v, mb, vb = np.zeros(len(known)), np.zeros(len(known)), 0.0, 0.0
            for t in range(1, rounds + 1):
                z = np.bincount(sentence, w[feature], minlength=begin[-1]) + b
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                none = np.exp(np.clip(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(docs)), -60, 0))
                some = np.maximum(1 - none, 1e-9)
                # d loss / d z: p for a clean document, -p (1 - P) / P for a toxic one
                g = p * (cost * np.where(y == 1, -none / some, 1.0))[owner]
                gw = np.bincount(feature, g[sentence], minlength=len(known)) + shrink * w / len(docs)
                gb = g.sum()
                m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
                rate = 0.2 if t < rounds * 0.7 else 0.05
                w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
                b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-6)
            weights[known], bias = w, float(b)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, sample: int = SAMPLE, rounds: int = 300, least_errors: float = 4.0, least_ratio: float = 1.1, shrink: float = 0.005) -> dict:
    """The model: a weight for each word feature and a bias, about 1 MB at any input.

    Features enter if they are commoner in toxic documents by ``least_errors`` standard errors and by
    the logarithm ``least_ratio``: a toxic document has what clean ones lack, and words of
    clean sentences say nothing of the others.
    """
    chosen, share = sample_of(labels, label, learn_from, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(_rows, "doc_id bigint, label int, features array<int>, sentences array<int>")
    out = rows.repartition(1).mapInArrow(_fit(share, rounds, least_errors, least_ratio, shrink), "weights binary, bias double").first()
    return {"weights": np.frombuffer(out.weights, np.float32), "bias": out.bias}


def scores(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, and sentences: (start, length, score) in code points of those that score ``threshold`` or more.

    Sentences end at ``.``, ``!``, ``?`` and line breaks; A-Z count as a-z. Score: the noisy-or of
    all sentences. NULL, empty and wordless texts have no sentence and the score 0. Repeated
    rows get equal answers. Only doc_id and text are read, and doc_id is only passed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: at.Texts, batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, bias = shared.value["weights"], shared.value["bias"]
        feature, sentence, row, low, high = _sentences(texts)
        hot = weights[feature] != 0
        feature, sentence_of = _distinct(feature[hot], sentence[hot])
        z = np.bincount(sentence_of, weights[feature], minlength=len(low)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(row, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=texts.rows)
        chars = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
        bad = np.flatnonzero(p >= threshold)
        off = np.searchsorted(row[bad], np.arange(texts.rows + 1)).astype(np.int32)
        start = chars[low[bad]] - chars[texts.off[row[bad]]]
        spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(chars[high[bad]] - chars[low[bad]], pa.int64()), pa.array(p[bad])], ["start", "length", "score"])
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(-np.expm1(none)), pa.ListArray.from_arrays(pa.array(off), spans)], ["doc_id", "score", "sentences"])

    schema = "doc_id bigint, score double, sentences array<struct<start:bigint,length:bigint,score:double>>"
    return docs.select("doc_id", "text").mapInArrow(at.per_slice("text", make, lower=True), schema)
