"""Spelling variants: words of a corpus that are one edit apart, by composing finite-state machines.

The vocabulary's minimal acyclic acceptor A is composed with a transducer E that makes
exactly one edit, and with A again; the pairs that A . E . A accepts are the near words.

* States of A are the right languages of the words' prefixes, told apart by 64-bit
  hashes; arcs carry the number of words that sort before them, so a path also gives the word's number.
* Before its edit, A . E . A is in the same state twice. So pairs begin at the states where A
  branches or ends: two arcs with different labels (a replaced code point) or one arc against
  none (a deleted one). After it both sides read the same labels. Pairs of equal states
  accept all their words at once.
* Each distinct pair of states is composed once; results are placed at every prefix that leads to it.

Words are dealt by their initial states: the shortest beginnings that at most ``GROUP``
words share. A pair whose edit lies inside that beginning has a common ending, and is found
among the words read backwards, dealt by their endings. What is left are pairs that
differ where neither reaches; they meet on what remains of them without
the edited code point, which at most an alphabet of words shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrowtext import mix
from millrace.llm.linking import small
from millrace.sources import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that share an initial state, at most.
GROUP = 2_000
#: Code points that one composition takes at once, if whole groups allow; a group is never cut.
CELLS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def vocabulary(docs: DataFrame, least: int, times: int, slips: int) -> DataFrame:
    """(word, n): the lower-cased letter runs of all texts, with n of at least ``times``.

    Where ``slips`` divides the hash of document and run, a code point of the run is left out.
    Runs below ``least`` code points cannot give a word and are not read.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))).alias("r"))
    runs = runs.select("d", F.translate("r", UPPER, LOWER).alias("r"))
    runs = runs.select("r", F.crc32(F.concat("d", F.lit(":"), "r").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("r")).cast("int")
    slipped = F.concat(F.substring("r", F.lit(1), at), F.substring("r", at + 2, F.length("r")))
    words = runs.select(F.when(F.col("h") % slips == 0, slipped).otherwise(F.col("r")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


class Acceptor:
    """The minimal acyclic acceptor of sorted groups of distinct words, and the tree of their prefixes.

    ``root`` numbers each word's group. Tree nodes come by depth, then order; ``state`` is a node's state.
    """

    def __init__(self, root: np.ndarray, words: list[str]):
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        # A cell for every prefix of every word, from its group's root to the word itself.
        off = np.concatenate([[0], np.cumsum(size + 1)])
        word = np.repeat(np.arange(len(words)), size + 1)
        depth = np.arange(off[-1]) - off[word]
        label = np.zeros(off[-1], np.int64)
        label[depth > 0] = codes
        # Cells that share the prefix with the word before: as long as labels agree.
        earlier = np.minimum(off[np.maximum(word - 1, 0)] + depth, off[-1] - 1)
        agree = (word > 0) & (earlier < off[word]) & (label[earlier] == label) & ((depth > 0) | (root[word] == root[np.maximum(word - 1, 0)]))
        first_apart = np.minimum.reduceat(np.where(agree, np.iinfo(np.int64).max, depth), off[:-1])
        new = depth >= first_apart[word]
        order = np.lexsort((word, depth))
        node = np.empty(off[-1], np.int64)
        node[order] = np.cumsum(new[order]) - 1
        begin = order[new[order]]
        self.base = word[begin]
        self.depth = depth[begin]
        self.ends = np.zeros(len(begin), bool)
        self.ends[node[off[1:] - 1]] = True
        self.parent = np.where(self.depth > 0, node[np.maximum(begin - 1, 0)], -1)
        self.label = label[begin]
        self.state = self._states(node, label, off, word, len(begin))
        # Arcs of one node for each state.
        shown = np.full(self.state.max() + 1 if len(begin) else 0, -1, np.int64)
        shown[self.state[::-1]] = np.arange(len(begin))[::-1]
        self.count = np.bincount(node, minlength=len(begin))[shown]
        self.final = self.ends[shown]
        kids = np.flatnonzero(self.depth > 0)
        kids = kids[shown[self.state[self.parent[kids]]] == self.parent[kids]]
        arcs = np.lexsort((self.label[kids], self.state[self.parent[kids]]))
        kids = kids[arcs]
        self.source, self.read, self.target = self.state[self.parent[kids]], self.label[kids], self.state[kids]
        self.skip = self.base[kids] - self.base[self.parent[kids]]
        self.arc_key = self.source << np.int64(21) | self.read
        self.first_arc = np.searchsorted(self.source, np.arange(len(shown) + 1))

    @staticmethod
    def _states(node, label, off, word, nodes) -> np.ndarray:
        """Equal numbers for nodes that the same endings follow: sums of the endings' hashes."""
        n = len(label)
        up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        cell = mix(label.astype(np.uint64) + np.uint64(77))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(cell * up[:n], dtype=np.uint64)])
        here = np.arange(n)
        ending = (sums[off[word + 1]] - sums[here + 1]) * down[here + 1]
        left = (off[word + 1] - here).astype(np.uint64)
        by_node = np.argsort(node, kind="stable")
        edge = np.searchsorted(node[by_node], np.arange(nodes))
        total = np.add.reduceat(mix(ending * np.uint64(31) + left)[by_node], edge) if nodes else np.zeros(0, np.uint64)
        return np.unique(total, return_inverse=True)[1].astype(np.int64)

    def starts(self) -> tuple[np.ndarray, ...]:
        """After the edit: (node, state), (node, state) of both sides, and a label that may not come next."""
        kids = np.flatnonzero(self.depth > 0)
        kids = kids[np.lexsort((self.label[kids], self.parent[kids]))]
        above = self.parent[kids]
        left, right, bar = [], [], []
        shift = 1
        while shift < len(kids):
            i = np.flatnonzero(above[:-shift] == above[shift:])
            if not len(i):
                break
            left.append(kids[i]), right.append(kids[i + shift]), bar.append(np.full(len(i), -1))
            shift += 1
        # x c y against x y, where y does not begin with c: so each pair has one place. A node that
        # neither ends nor branches goes on with c on both sides.
        degree = np.bincount(above, minlength=len(self.depth))
        i = np.flatnonzero((degree[above] > 1) | self.ends[above])
        left.append(kids[i]), right.append(above[i]), bar.append(self.label[kids[i]])
        return np.concatenate(left), np.concatenate(right), np.concatenate(bar)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pairs of words that are one edit apart, each once."""
        left, right, bar = self.starts()
        states = np.stack([self.state[left], self.state[right], bar])
        distinct, which = np.unique(states, axis=1, return_inverse=True)
        which = which.ravel()
        found, a, b = self._composed(*distinct)
        order = np.argsort(found, kind="stable")
        found, a, b = found[order], a[order], b[order]
        edge = np.searchsorted(found, np.arange(distinct.shape[1] + 1))
        many = np.diff(edge)[which]
        start = np.repeat(np.arange(len(which)), many)
        place = np.arange(len(start)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(edge[which], many)
        return self.base[left[start]] + a[place], self.base[right[start]] + b[place]

    def _composed(self, a, b, bar) -> tuple[np.ndarray, ...]:
        """(start, word, word): what both states accept, as numbers of words from each state on."""
        who, x, y = np.arange(len(a)), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        out = []
        while len(who):
            same = (a == b) & (bar < 0)
            many = self.count[a[same]]
            each = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            out.append((np.repeat(who[same], many), np.repeat(x[same], many) + each, np.repeat(y[same], many) + each))
            who, a, b, x, y, bar = (v[~same] for v in (who, a, b, x, y, bar))
            both = self.final[a] & self.final[b]
            out.append((who[both], x[both], y[both]))
            # The side with fewer arcs is read, the other looked up.
            swap = np.diff(self.first_arc)[a] > np.diff(self.first_arc)[b]
            a, b, x, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, y, x), np.where(swap, x, y)
            many = np.diff(self.first_arc)[a]
            row = np.repeat(np.arange(len(a)), many)
            arc = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + self.first_arc[a][row]
            key = b[row] << np.int64(21) | self.read[arc]
            other = np.searchsorted(self.arc_key, key)
            hit = (other < len(self.arc_key)) & (self.read[arc] != bar[row])
            hit[hit] = self.arc_key[other[hit]] == key[hit]
            row, arc, other = row[hit], arc[hit], other[hit]
            x, y = x[row] + self.skip[arc], y[row] + self.skip[other]
            a, b, x, y = (np.where(swap[row], v, u) for u, v in ((self.target[arc], self.target[other]), (self.target[other], self.target[arc]), (x, y), (y, x)))
            who, bar = who[row], np.full(len(row), -1)
        return tuple(np.concatenate(v) if out else np.zeros(0, np.int64) for v in (zip(*out, strict=True) if out else ((), (), ())))


_PAIRS = pa.schema([("back", pa.bool_()), ("a", pa.string()), ("na", pa.int64()), ("ka", pa.int32()), ("b", pa.string()), ("nb", pa.int64())])
_PAIRS_DDL = "back boolean, a string, na bigint, ka int, b string, nb bigint"


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (back, key, read, n, front) sorted by (back, key, read) in, pairs of near words out."""

    def composed(rows):
        back, key, words, n, front = rows
        root = np.concatenate([[0], np.cumsum([key[i] != key[i - 1] or back[i] != back[i - 1] for i in range(1, len(key))])])
        one, two = Acceptor(root, words).pairs()
        for low in range(0, len(one), 50_000):
            i, j = one[low : low + 50_000].tolist(), two[low : low + 50_000].tolist()
            turned = [words[k][::-1] if back[k] else words[k] for k in i], [words[k][::-1] if back[k] else words[k] for k in j]
            yield pa.RecordBatch.from_pydict(
                {"back": [back[k] for k in i], "a": turned[0], "na": [n[k] for k in i], "ka": [front[k] for k in i], "b": turned[1], "nb": [n[k] for k in j]}, _PAIRS
            )

    held, cells = ([], [], [], [], []), 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("back", "key", "read", "n", "front")), strict=True):
            if cells >= CELLS and (row[1], row[0]) != (held[1][-1], held[0][-1]):
                yield from composed(held)
                held, cells = ([], [], [], [], []), 0
            for column, value in zip(held, row, strict=True):
                column.append(value)
            cells += len(row[2]) + 1
    if held[0]:
        yield from composed(held)


def _beginning(word: Column, k: int) -> Column:
    """The first k code points of a word and its end mark."""
    return F.substring(F.concat(word, F.lit("\0")), 1, k)


def dealt(vocab: DataFrame) -> DataFrame:
    """(back, read, word, n, k, key): every word as read from either end, with the shortest beginning ``key``, of k code
    points and an end mark where it is the whole word, that at most ``GROUP`` words share."""
    rest = vocab.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("back"), "word", "n")
    rest = rest.withColumn("read", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")))
    out, k = None, 1
    while True:
        keyed = rest.withColumn("k", F.lit(k)).withColumn("key", _beginning(F.col("read"), k))
        hot = stage(keyed.groupBy("back", "key").agg(F.count("*").alias("_n")).where(F.col("_n") > GROUP).select("back", "key"))
        if not hot.count():
            return keyed if out is None else out.unionByName(keyed)
        hot = small(hot)
        done = keyed.join(hot, ["back", "key"], "left_anti").select(*keyed.columns)
        out = done if out is None else out.unionByName(done)
        rest = stage(keyed.join(hot, ["back", "key"], "left_semi").select(*rest.columns))
        k += 1


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, na, b, nb): every two words of ``vocab`` (word, n) that are exactly one edit apart, once."""
    words = stage(dealt(vocab))
    ends = words.groupBy("word", "n").agg(F.max(F.when(~F.col("back"), F.col("k"))).alias("front"), F.max(F.when(F.col("back"), F.col("k"))).alias("tail"))
    ends = stage(ends)
    rows = words.join(ends.select("word", "front"), "word").select("back", "key", "read", "n", "front")
    rows = rows.repartition("back", "key").sortWithinPartitions("back", "key", "read")
    found = rows.mapInArrow(_near, _PAIRS_DDL)
    # A pair that shares its beginning was found from the front.
    common = (F.col("ka") <= F.length("a")) & (F.substring("a", F.lit(1), F.col("ka")) == F.substring("b", F.lit(1), F.col("ka")))
    found = found.where(~F.col("back") | ~common).select("a", "na", "b", "nb")
    return found.unionByName(_between(ends))


def _between(ends: DataFrame) -> DataFrame:
    """Pairs whose edit lies inside both words' beginnings and both words' endings.

    A word has a row for each place that both reach, with and without the code point there. Few
    words have any: the beginning and the ending would have to overlap.
    """
    size = F.length("word")
    low = F.greatest(F.lit(0), size - F.col("tail"))
    cut = ends.where(F.col("front") + F.col("tail") > size)
    at = cut.select("*", F.explode(F.sequence(low, F.least(F.col("front") - 1, size))).alias("i"))
    head, here, after = F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("i") + 1, F.lit(1)), F.substring("word", F.col("i") + 2, size)
    without = at.where(F.col("i") < size).select("word", "n", "tail", head.alias("x"), here.alias("c"), after.alias("y"))
    # An insertion leaves one code point more behind the place.
    plain = at.where(F.col("i") > size - F.col("tail")).select("word", "n", "tail", head.alias("x"), F.lit("").alias("c"), F.concat(here, after).alias("y"))
    rows = stage(without.unionByName(plain))
    left = rows.select("x", "y", F.col("word").alias("a"), F.col("n").alias("na"), F.col("tail").alias("ta"), F.col("c").alias("ca"))
    right = rows.select("x", "y", F.col("word").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"))
    one_place = (F.col("cb") != "") | ~F.startswith("y", "ca")
    common = (F.col("ta") <= F.length("a")) & (F.expr("right(a, ta)") == F.expr("right(b, ta)"))
    pairs = left.join(right, ["x", "y"]).where(F.col("ca") > F.col("cb")).where(one_place & ~common)
    return pairs.select("a", "na", "b", "nb")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last word that forms lead to. Forms make no circles."""
    reach = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        step = reach.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = stage(reach.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        reach = longer.select("word", "root")
        if not longer.where("_moved").limit(1).count():
            return reach


def grouped(docs: DataFrame, least: int = 7, times: int = 2, slips: int = 31, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id, text) of ``least`` code points and ``times`` occurrences.

    A word's form is the commonest word one edit away (of equally common ones the smallest by code point), if it is
    ``ratio`` times as common. NULL and empty texts have no words; repeated rows count again; a NULL doc_id
    is hashed as an empty one. An empty table gives no rows. Other columns are not read. One word is held as a whole, however long.
    """
    vocab = stage(vocabulary(docs, least, times, slips))
    pairs = near_pairs(vocab)
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("o"), F.col("nb").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("o"), F.col("na").alias("m")))
    best = pairs.select(F.explode(ways).alias("p")).select("p.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "o")).alias("best"))
    rows = vocab.join(best, "word", "left")
    formed = F.col("best.m") * -1 >= F.col("n") * ratio
    rows = stage(rows.select("word", F.when(formed, F.col("best.o")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(formed, -F.col("best.m")).alias("form_n")))
    out = rows.join(rooted(rows.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
