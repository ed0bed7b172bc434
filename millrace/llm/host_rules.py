"""Quality rules of documents, and verdicts on their hosts.

Each document is measured once. Rule failures are added up by host (``source``), every
host's rate is shrunk toward a beta prior fitted to all hosts, and the host's verdict on
a rule is joined back: a document that fails a rule goes if its host is known to fail it.
A single odd document of a host that is clean otherwise stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrowtext as at
from millrace.sources import stage

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _repeats(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices sorted by row and key, whether each equals the one before it)."""
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    same = np.zeros(len(keys), bool)
    same[1:] = (rows[order][1:] == rows[order][:-1]) & (keys[order][1:] == keys[order][:-1])
    return order, same


def _measure(texts: at.Texts, batch: pa.RecordBatch) -> pa.RecordBatch:
    inside = at.NOT_SPACE[texts.data]
    starts, ends, first = texts.spans(inside)
    word_chars = at.row_sums((inside & ((texts.data & 0xC0) != 0x80)).astype(np.int64), texts.off)
    n_symbols = at.row_sums(_SYMBOL[texts.data].astype(np.int64), texts.off)

    low, high, _ = texts.spans(texts.data != 10)
    total = np.concatenate([[0], np.cumsum(inside)])
    worded = total[high] > total[low]
    low, high = low[worded], high[worded]
    line_row = np.searchsorted(texts.off, low, "right") - 1
    order, same = _repeats(line_row, texts.hashes(low, high))
    n_dup = np.bincount(line_row[order][same], minlength=texts.rows)

    found, where = at.windows(texts.hashes(starts, ends), first, 3)
    order, same = _repeats(np.searchsorted(first, where, "right") - 1, found)
    twice = same.copy()
    twice[:-1] |= same[1:]
    covered = np.zeros(len(starts) + 2, bool)
    for j in range(3):
        covered[where[order][twice] + j] = True
    n_repeat = at.row_sums(covered[: len(starts)].astype(np.int64), first)
    counts = [np.diff(first), word_chars, n_symbols, n_dup, n_repeat, np.bincount(line_row, minlength=texts.rows)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("source").cast(pa.string()), *[pa.array(c, pa.int64()) for c in counts]], ["doc_id", "source", *_COUNTS])


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source and the counts of every row: words ``[^\\x20\\x09-\\x0D]+`` of the whole text, their code
    points, characters of ``[#*$%&|<>]``, lines with a word that repeat an earlier one, words in
    three-word windows found twice or more, and lines with a word. NULL text counts as empty."""
    schema = "doc_id bigint, source string, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    return docs.select("doc_id", "source", "text").mapInArrow(at.per_slice("text", _measure), schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: Rules whose failures are judged by host.
RULES = {
    "symbols": lambda: 5 * F.col("n_symbols") > F.col("n_words"),
    "dup_lines": lambda: (F.col("n_dup_lines") > 3) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
}


def host_rates(measured: DataFrame, rules=RULES) -> DataFrame:
    """host, n, and for each rule ``rate_<rule>``: the host's failure rate shrunk by an empirical beta prior.

    The prior's mean is the rate of all documents; its weight follows from how far the
    hosts' own rates lie apart beyond chance (method of moments), between 1 and a
    million documents. A NULL source is the host ''.
    """
    by = measured.groupBy(F.coalesce("source", F.lit("")).alias("host"))
    hosts = stage(by.agg(F.count("*").alias("n"), *[F.sum(r().cast("long")).alias(f"bad_{k}") for k, r in rules.items()]))
    sums = [F.sum("n").alias("n"), F.count("*").alias("hosts"), F.sum(F.col("n") * F.col("n")).alias("nn")]
    for k in rules:
        sums += [F.sum(f"bad_{k}").alias(k), F.sum(F.col(f"bad_{k}") * F.col(f"bad_{k}") / F.col("n")).alias(f"{k}_sq")]
    one = hosts.agg(*sums).first()  # one row of totals
    out = [F.col("host"), F.col("n")]
    for k in rules:
        mean = (one[k] or 0) / (one["n"] or 1)
        chance = mean * (1 - mean)
        # weighted variance of the hosts' rates, less what chance alone gives
        free = (one["n"] or 1) - (one["nn"] or 0) / (one["n"] or 1)
        apart = ((one[f"{k}_sq"] or 0.0) - (one["n"] or 0) * mean * mean - max(0, one["hosts"] - 1) * chance) / free if free > 0 else 0.0
        weight = min(1e6, max(1.0, chance / apart - 1)) if apart > 0 else 1e6
        out.append(((F.col(f"bad_{k}") + weight * mean) / (F.col("n") + weight)).alias(f"rate_{k}"))
    return hosts.select(*out)


def verdicts(docs: DataFrame, host_limit: float = 0.02, rules=RULES) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs`` (doc_id, text, source).

    base_failed: under 50 words, or more than half of the words in repeated three-word
    windows. kept: not base_failed, and no rule that both the document fails and its
    host's shrunk failure rate exceeds ``host_limit``.

    NULL and empty texts have no words and fail the base rule. Rows are judged one by one,
    so repeated rows get the same answer twice. Other columns are not read.
    """
    measured = stage(measures(docs))
    hosts = stage(host_rates(measured, rules))
    joined = measured.withColumn("host", F.coalesce("source", F.lit(""))).join(hosts.drop("n"), "host", "left")
    bad = F.lit(False)
    for k, rule in rules.items():
        bad = bad | (rule() & (F.col(f"rate_{k}") > host_limit))
    return joined.select("doc_id", *_COUNTS[:5], base_failed().alias("base_failed"), (~base_failed() & ~bad).alias("kept"))
