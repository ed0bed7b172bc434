"""Token counts of all prefixes by dynamic programming.

The encoding of a prefix is that of a shorter prefix and one more piece, so its count
follows from the shorter one's. Parts that no piece crosses (a word with the spaces
before it) have a table each; a text's table is its parts' tables, each raised by what is before it.
Counts, truncation and budgets are read from tables; nothing is encoded again.
"""

from __future__ import annotations

import array
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import bpe

LIMIT = 4096
def part_table(model: bpe.Pieces, part: str, last: list[int], numbers: list[int]) -> bytes | array.array:
    """The number of tokens of every prefix of ``part``, from the empty one to all of it; a byte each where that is enough."""
    counts = model.counts(part, last, numbers)
    return bytes(counts) if max(counts) < 256 else array.array("I", counts)


def text_table(model: bpe.Pieces, text: str) -> list[int]:
    """The number of tokens of every prefix of ``text``, by code points, from the empty one to all of it."""
    table, before = [0], 0
    for part in model.parts.findall(model.normal(text)):
        counts = model.counts(part, *model.last_pieces(part))
        table += [before + c for c in counts[1:]]
        before += counts[-1]
    return [0, *table[2:]] if text else [0]  # the space put before the text is no prefix of its own


def _fitting(tables: list, limit: int) -> int:
    """The longest prefix of at most ``limit`` tokens, in code points of the text, from its parts' ``tables``."""
    ends = np.cumsum([table[-1] for table in tables])
    i = int(np.searchsorted(ends, limit, "right"))
    chars = sum(len(table) - 1 for table in tables[:i])
    if i < len(tables):
        before = int(ends[i - 1]) if i else 0
        chars += max((k for k, c in enumerate(tables[i]) if before + c <= limit), default=0)
    return max(0, chars - 1)


#: Each part's table, for the parts met last; kept as long as the worker lives.
_memory: dict[str, bpe.Memory] = {}


def _counter(path: str, limit: int):
    def run(batches):
        model = bpe.pieces(path)
        memory = _memory.setdefault(path, bpe.Memory(part_table))
        for batch in batches:
            n_bytes, n_tokens, fitting = [], [], []
            for texts in bpe.text_groups(batch.column("text")):
                split = [model.parts.findall(model.normal(text)) for text in texts]
                known = memory.learn(model, itertools.chain.from_iterable(split))
                for text, parts in zip(texts, split, strict=True):
                    tables = [known[part] for part in parts]
                    total = sum([table[-1] for table in tables])
                    n_bytes.append(len(text.encode()))
                    n_tokens.append(total)
                    fitting.append(len(text) if total <= limit else _fitting(tables, limit))
            arrays = [batch.column("doc_id").cast(pa.int64()), *[pa.array(x, pa.int64()) for x in (n_bytes, n_tokens, fitting)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_tokens", "fitting_chars"])

    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fitting_chars for every row of ``docs`` (doc_id, text).

    n_tokens is what the model's own library gives without begin and end marks; strings of
    special tokens are ordinary text. fitting_chars: code points of the longest prefix of at
    most ``limit`` tokens.

    NULL and empty texts have no bytes and no tokens. Repeated rows get equal answers. Other columns are not read.
    """
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, fitting_chars bigint"
    counted = docs.select("doc_id", "text").mapInArrow(_counter(path or bpe.default_path(), limit), schema)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fitting_chars")


def prefix_tables(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and counts: at place i the number of tokens of the first i code points. NULL text counts as empty."""
    path = path or bpe.default_path()

    def run(batches):
        model = bpe.pieces(path)
        for batch in batches:
            tables = [text_table(model, value.as_py() or "") for value in batch.column("text")]
            off = np.concatenate([[0], np.cumsum([len(t) for t in tables])]).astype(np.int32)
            values = np.fromiter(itertools.chain.from_iterable(tables), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(off), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), lists], ["doc_id", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, counts array<int>")


def truncated(docs: DataFrame, tables: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id and the longest prefix of each text whose count in ``tables`` is at most ``limit``; no text is encoded."""
    longest = F.array_max(F.transform("counts", lambda c, i: F.when(c <= limit, i)))
    fit = tables.select("doc_id", longest.alias("fit"))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(fit, "doc_id").select("doc_id", F.expr("substring(text, 1, fit)").alias("text"))
