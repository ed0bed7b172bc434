"""SentencePiece encoding of whole texts, giant ones in chunks, and decoding.

The lattice of a text has an edge for every piece; an edge after an edge costs nothing if
the two pieces are the encoding of their text and minus infinity otherwise, so the one
finite path is the encoding (see ``bpe``). The state at a place is the piece that
covers it. A chunk's matrix says, for every state at its begin and at its end, whether a
finite path leads from one to the other. Matrices are multiplied in the max-plus way,
which is associative; the states at all borders follow from the products, and every
chunk then finds its own path between its two states.

Where a text has a place that no piece crosses (before a space, at a line break), all
paths meet there; only what lies before a chunk's first and after its last such place is scanned.
"""

from __future__ import annotations

import array
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import bpe
from millrace.llm.arrowtext import tidied
from millrace.sources import stage

#: Code points of a chunk; longer texts are cut.
CHUNK = 1 << 16
#: Parts whose ids a worker keeps, twice at most: some 20 MB.
KEPT_PARTS = 60_000
#: A state's number: characters of the piece before the border, then after it.
_SIDE = 1024
START = 0


def _ids(model: bpe.Pieces, part: str, last: list[int], numbers: list[int]) -> bytes:
    out, end = [], len(part)
    while end:
        number = numbers[end]
        if number < model.size:
            out.append(number)
        else:
            out += reversed(model.ids_of(part[end - 1]))
        end -= last[end]
    out.reverse()
    return array.array("i", out).tobytes()


_memory: dict[str, bpe.Memory] = {}


def _known(path: str) -> tuple[bpe.Pieces, bpe.Memory]:
    return bpe.pieces(path), _memory.setdefault(path, bpe.Memory(_ids, KEPT_PARTS))


def _whole(path: str):
    """Texts of one chunk: every part's path, from memory where it was met before."""

    def run(batches):
        model, memory = _known(path)
        for batch in batches:
            done = 0
            for texts in bpe.text_groups(batch.column("text")):
                split = [model.parts.findall(model.normal(text)) for text in texts]
                known = memory.learn(model, itertools.chain.from_iterable(split))
                found = [b"".join(map(known.__getitem__, parts)) for parts in split]
                same = [model.decoded(np.frombuffer(ids, np.int32).tolist()) == text.replace(bpe.SPACE, " ") for ids, text in zip(found, texts, strict=True)]
                off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(done, len(texts)).cast(pa.int64()), lists, pa.array(same)], ["doc_id", "ids", "round_trip"])
                done += len(texts)

    return run


def _cut(path: str, size: int):
    def run(batches):
        model = bpe.pieces(path)
        size_ = max(size, 2 * model.longest)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
                normal = model.normal(text.as_py())
                count = -(-len(normal) // size_)
                for k in range(count):
                    low, high = k * size_, min(len(normal), (k + 1) * size_)
                    parts = [[row], [k], [count], [normal[max(0, low - model.longest) : low]], [normal[low:high]], [normal[high : high + model.longest]]]
                    yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["row", "chunk", "chunks", "left", "body", "right"])

    return run


class Chunk:
    """A chunk between its borders ``low`` and ``high`` within the text around it."""

    def __init__(self, model: bpe.Pieces, left: str, body: str, right: str):
        self.model, self.text = model, left + body + right
        self.low, self.high = len(left), len(left) + len(body)
        # places that no piece crosses
        ends = [m.end() for m in model.parts.finditer(self.text)]
        inside = [e for e in [0, *ends] if self.low <= e <= self.high and self._safe(e)]
        self.first, self.last = (inside[0], inside[-1]) if inside else (None, None)

    def _safe(self, at: int) -> bool:
        """Whether ``at`` parts the whole text too: the cut text's own ends do not count, but for those of the text itself."""
        if at == 0:
            return self.low == 0
        if at == len(self.text):
            return self.high == len(self.text)
        return True

    def states(self, border: int) -> list[int]:
        """All pieces that cover the character before ``border``; at the text's begin there is one state."""
        if border == 0:
            return [START]
        out = []
        for begin in range(max(0, border - self.model.longest), border):
            for end in range(border, min(len(self.text), begin + max(1, self.model.longest)) + 1):
                if end - begin == 1 or self.text[begin:end] in self.model.ids:
                    out.append((border - begin) * _SIDE + end - border)
        return out

    def _walk(self, begin: dict[tuple[int, int], int], stop: int) -> tuple[dict, dict]:
        """From (end, length) of last pieces with their masks: the masks of all that are reached up to the first
        piece that ends at ``stop`` or after, and the piece before each."""
        masks, back, todo = dict(begin), {}, {}
        for (end, length), _ in begin.items():
            todo.setdefault(end, set()).add(length)
        text, model = self.text, self.model
        at = min(todo, default=stop)
        while at < stop:
            for length in sorted(todo.get(at, ())):
                left = text[at - length : at]
                for step in range(1, min(model.longest, len(text) - at) + 1):
                    piece = text[at : at + step]
                    if (step == 1 or piece in model.ids) and model.fits(left, piece):
                        key = (at + step, step)
                        masks[key] = masks.get(key, 0) | masks[at, length]
                        back.setdefault(key, (at, length))
                        todo.setdefault(at + step, set()).add(step)
            at += 1
        return masks, back

    def _place(self, state: int, border: int) -> tuple[int, int]:
        before, after = divmod(state, _SIDE)
        return border + after, before + after

    def matrix(self) -> list[tuple[int, int]]:
        """The finite entries: (state at the begin, state at the end)."""
        into, out = self.states(self.low), self.states(self.high)
        begin = {}
        for k, state in enumerate(into):
            place = self._place(state, self.low)
            begin[place] = begin.get(place, 0) | 1 << k
        if self.first is None or self.first == self.high:
            masks, _ = self._walk(begin, self.high)
        else:
            masks, _ = self._walk(begin, self.first)
            reached = 0
            for (end, _), mask in masks.items():
                reached |= mask if end == self.first else 0
            if self.last == self.high:  # no piece crosses the border, and the part that ends there is all inside
                last = self._last_piece()
                return [(x, last) for k, x in enumerate(into) if reached >> k & 1]
            masks, _ = self._walk({(self.last, 0): reached}, self.high)
        found = []
        for state in out:
            mask = masks.get(self._place(state, self.high), 0)
            found += [(x, state) for k, x in enumerate(into) if mask >> k & 1]
        return found

    def _last_piece(self) -> int:
        """The state at ``high`` if that is the end of a part between ``first`` and ``high``."""
        *_, part = self.model.parts.findall(self.text[self.first : self.high])
        return self.model.last_pieces(part)[0][-1] * _SIDE

    def path(self, memory: bpe.Memory, x: int, y: int) -> bytes:
        """The ids of the pieces after state ``x`` up to that of state ``y``."""
        here = self._place(x, self.low)
        there = self._place(y, self.high)
        if here == there and x != START:
            return b""
        if self.first is None or self.first == self.high:
            return self._trace({here: 1}, there, self.high)
        masks, back = self._walk({here: 1}, self.first)
        head = self._unwound(back, here, next(k for k in masks if k[0] == self.first))
        parts = self.model.parts.findall(self.text[self.first : self.last])
        known = memory.learn(self.model, parts)
        middle = b"".join(map(known.__getitem__, parts))
        tail = self._trace({(self.last, 0): 1}, there, self.high) if self.last < self.high else b""
        return head + middle + tail

    def _trace(self, begin: dict, there: tuple[int, int], stop: int) -> bytes:
        _, back = self._walk(begin, stop)
        return self._unwound(back, next(iter(begin)), there)

    def _unwound(self, back: dict, here: tuple[int, int], there: tuple[int, int]) -> bytes:
        out = []
        while there != here:
            out.append(self.text[there[0] - there[1] : there[0]])
            there = back[there]
        return np.array(list(itertools.chain.from_iterable(map(self.model.ids_of, reversed(out)))), np.int32).tobytes()


def product(a: dict[int, set[int]], b: dict[int, set[int]]) -> dict[int, set[int]]:
    """The max-plus product of two matrices of zeros and minus infinities, each by its finite entries."""
    return {x: set().union(*(b.get(y, ()) for y in ys)) for x, ys in a.items()}


def _matrices(path: str):
    def run(batches):
        model = bpe.pieces(path)
        for batch in batches:
            for x in batch.select(["row", "chunk", "left", "body", "right"]).to_pylist():
                entries = Chunk(model, x["left"], x["body"], x["right"]).matrix()
                arrays = [pa.array([x["row"]]), pa.array([x["chunk"]]), pa.array([[a for a, _ in entries]], pa.list_(pa.int32())), pa.array([[b for _, b in entries]], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "chunk", "begin", "end"])

    return run


def _borders(pdf):
    """One text's matrices: the state at every border of the only finite path."""
    pdf = pdf.sort_values("chunk")
    tables = []
    for begin, end in zip(pdf["begin"], pdf["end"], strict=True):
        table: dict[int, set[int]] = {}
        for a, b in zip(begin, end, strict=True):
            table.setdefault(int(a), set()).add(int(b))
        tables.append(table)
    upto = list(itertools.accumulate(tables, product))  # from the text's begin to each border
    state = next(s for s in sorted(upto[-1][START]) if s % _SIDE == 0)
    ends = [state]
    for k in range(len(tables) - 1, 0, -1):
        state = next(x for x in sorted(upto[k - 1][START]) if state in tables[k].get(x, ()))
        ends.append(state)
    ends.reverse()
    return pdf[["row", "chunk"]].assign(x=[START, *ends[:-1]], y=ends)


def _paths(path: str):
    def run(batches):
        model, memory = _known(path)
        for batch in batches:
            for x in batch.to_pylist():
                ids = np.frombuffer(Chunk(model, x["left"], x["body"], x["right"]).path(memory, x["x"], x["y"]), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([x["row"]]), pa.array([x["chunk"]]), pa.array([ids], pa.list_(pa.int32()))], ["row", "chunk", "ids"])

    return run


def _giants(docs: DataFrame, path: str, size: int) -> DataFrame:
    long = stage(docs.where(F.length("text") > size).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    cut = long.select("row", "text").mapInArrow(_cut(path, size), "row bigint, chunk bigint, chunks bigint, left string, body string, right string")
    chunks = stage(cut.repartition("row", "chunk"))
    matrices = chunks.mapInArrow(_matrices(path), "row bigint, chunk bigint, begin array<int>, end array<int>")
    # a text has at most 2 GB, so its matrices are some ten thousand short lists
    states = matrices.groupBy("row").applyInPandas(_borders, "row bigint, chunk bigint, x int, y int")
    paths = chunks.join(states, ["row", "chunk"]).mapInArrow(tidied(_paths(path)), "row bigint, chunk bigint, ids array<int>")
    whole = paths.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("c")).select("row", F.flatten("c.ids").alias("ids"))
    both = long.join(whole, "row").select("doc_id", "ids", "text")
    return decoded(both, path).select("doc_id", "ids", (F.col("decoded") == F.translate("text", bpe.SPACE, " ")).alias("round_trip"))


def encoded(docs: DataFrame, path: str | None = None, size: int = CHUNK) -> DataFrame:
    """doc_id, ids and round_trip for every row of ``docs`` (doc_id, text).

    ids: what the model's own library gives for the whole text, without begin and end marks.
    round_trip: whether decoding gives the text again (the sign U+2581, which the model writes
    for a space, comes back as a space). Texts of more than ``size`` code points are cut into chunks of that length.

    NULL and empty texts have no ids. Repeated rows get equal answers. Other columns are not read.
    """
    path = path or bpe.default_path()
    short = docs.select("doc_id", "text").where(F.col("text").isNull() | (F.length("text") <= size))
    return short.mapInArrow(tidied(_whole(path)), "doc_id bigint, ids array<int>, round_trip boolean").unionByName(_giants(docs, path, size))


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` (ids, and whatever else) with ``decoded``, the text of the ids. NULL ids give an empty text."""
    path = path or bpe.default_path()

    @F.pandas_udf("string")
    def text_of(ids):
        model = bpe.pieces(path)
        return ids.map(lambda x: "" if x is None else model.decoded(list(x)))

    return rows.withColumn("decoded", text_of("ids"))
