"""Spelling variants: words one edit apart, found by K-d trees over letter counts.

A word's vector has the number of each letter. One code point put in, taken out or
replaced moves it by an L1 distance of two at most, and of that by one up and one down:
replacing keeps the length and moves one letter up and one down, putting in makes the
word one longer and moves one letter up. So words of length ``l`` are searched for in
the trees of lengths ``l`` and ``l + 1``, with that budget up and down. A subtree whose box
lies beyond it is not entered; what is left is verified letter by letter.

Counts are written as marks, one bit each: letter ``a`` has its first, second, third and
fourth bit set if it occurs once, twice, and so on. Distances and boxes are then counts
of bits. Letters beyond a-z share six groups, and a fifth ``a`` has no bit of its own: that
only brings vectors closer, so no pair is lost.

Work is spread by the upper part of the trees, which is grown on a sample of at most
``sample`` words (the first by a hash): its leaves are cells. Each word belongs to the one
cell it falls into, and is sent as a query to the others that its budget reaches. Cells
aim at ``cell_words`` words, by the number of words there are; all words are indexed,
whatever the sample was. A task holds the words of one cell at a time, builds the lower part of
the tree and lets queries stream by. Only words without equal letter counts can be
parted, so a cell of many anagrams may be larger; a word has as many as letters allow.

Texts that are NULL have no words, nor have empty ones. A NULL id counts as empty where
ids are needed. Repeated rows are counted as often as they are there, and words of any
length are kept whole. Without words the results have no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellgauge.llm.common import staged

# Fixed value: the code points that words are made of.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKS = 4  # bits of a letter
_GROUPS = 6  # of letters beyond a-z
_LEAF = 48
_QUERIES = 8192
_PAIRS = 1 << 20


# --- words and how often they occur ---------------------------------------------------


def word_counts(
    docs: DataFrame,
    text_column: str = "text",
    changed: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``(word, n)`` over all texts: runs of letters with A-Z in lower case.
    ``changed`` may make another word of each, with the columns of its row at hand.
    Occurrences are summed before the shuffle."""
    lowered = F.translate(F.col(text_column), _UPPER, _LOWER)
    runs = F.explode(F.regexp_extract_all(lowered, F.lit(f"([{LETTERS}]+)"), F.lit(1)))
    words = docs.withColumn("_word", runs)
    word = F.col("_word") if changed is None else changed(F.col("_word"))
    return words.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"))


# --- trees over letter counts -----------------------------------------------------------


def marks(points: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length, given as a matrix of code points: two
    64-bit numbers each."""
    n = len(points)
    known = (points >= 97) & (points <= 122)
    letters = np.where(known, points - 97, 26 + points % _GROUPS).astype(np.int64)
    counts = np.bincount(
        (np.arange(n)[:, None] * 32 + letters).ravel(), minlength=n * 32
    ).reshape(n, 32)
    bits = (counts[:, :, None] > np.arange(_MARKS)).reshape(n, 128)
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64)


def _moves(need: np.ndarray, have: np.ndarray) -> np.ndarray:
    """How many marks of ``need`` are not in ``have``."""
    return np.bitwise_count(need & ~have).sum(axis=-1, dtype=np.int64)


@dataclass
class Tree:
    """Nodes from the root on. ``must`` and ``may`` are a node's box: marks that all
    vectors in it have, and that some may have."""

    must: list[np.ndarray]
    may: list[np.ndarray]
    splits: list[tuple[int, int, int] | None]  # bit, node without it, node with it
    members: list[np.ndarray]  # of leaves

    @classmethod
    def grown(cls, vectors: np.ndarray, leaf: int, tight: bool) -> Tree:
        """Split at the letter count that halves a node best, until a node has ``leaf``
        vectors or equal ones only. Boxes are those of the vectors if ``tight``, else
        all that the splits allow, so that other vectors find a place as well."""
        tree = cls([], [], [], [])
        full = np.full(2, np.iinfo(np.uint64).max, np.uint64)
        todo = [(np.arange(len(vectors)), np.zeros(2, np.uint64), full, -1, 0)]
        while todo:
            rows, must, may, parent, side = todo.pop()
            node, held = len(tree.splits), vectors[rows]
            if parent >= 0:
                bit, *ends = tree.splits[parent]
                ends[side] = node
                tree.splits[parent] = (bit, *ends)
            if tight:
                must = np.bitwise_and.reduce(held, axis=0)
                may = np.bitwise_or.reduce(held, axis=0)
            tree.must.append(must)
            tree.may.append(may)
            tree.members.append(rows)
            tree.splits.append(None)
            if len(rows) <= leaf:
                continue
            held_bits = np.unpackbits(held.astype(">u8").view(np.uint8).reshape(len(rows), 16), axis=1)
            uneven = np.abs(2 * held_bits.sum(axis=0, dtype=np.int64) - len(rows))
            bit = int(uneven.argmin())
            if uneven[bit] == len(rows):
                continue  # all are equal
            word, mask = bit // 64, np.uint64(1 << (63 - bit % 64))
            has = held_bits[:, bit] > 0
            more, less = must.copy(), may.copy()
            more[word] |= mask
            less[word] &= ~mask
            tree.splits[node] = (bit, -1, -1)
            tree.members[node] = rows[:0]
            todo.append((rows[has], more, may, node, 1))
            todo.append((rows[~has], must, less, node, 0))
        return tree

    def reached(self, vectors: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, each with the numbers of the vectors that reach its box by ``up``
        marks more and ``down`` marks less at most."""
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            held = vectors[rows]
            near = (_moves(self.must[node], held) <= up) & (_moves(held, self.may[node]) <= down)
            rows = rows[near]
            if not len(rows):
                continue
            split = self.splits[node]
            if split is None:
                yield node, rows
            else:
                todo += [(split[1], rows), (split[2], rows)]

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into."""
        found = np.empty(len(vectors), np.int64)
        for node, rows in self.reached(vectors, 0, 0):
            found[rows] = node
        return found


# --- letter by letter ---------------------------------------------------------------------


def points_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    joined = "".join(words).encode("utf-32-le")
    return np.frombuffer(joined, np.uint32).reshape(len(words), -1)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By row: whether one code point replaced in ``a``, or put into it, gives ``b``."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    alike = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return alike + after >= n


def _pairs(tree: Tree, members: np.ndarray, queries: np.ndarray, up: int, down: int):
    """Pairs ``(query, member)`` that leaves reach, by their letter counts, a bounded
    number at a time."""
    for node, rows in tree.reached(queries, up, down):
        inside = tree.members[node]
        step = max(1, _PAIRS // len(inside))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            q, m = queries[some][:, None, :], members[inside][None, :, :]
            near = (_moves(m, q) <= up) & (_moves(q, m) <= down)
            i, j = np.nonzero(near)
            if len(i):
                yield some[i], inside[j]


# --- cells ------------------------------------------------------------------------------


class _Best:
    """Of words: how many near ones were found, and which of them is the most frequent."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.words, self.counts = words, counts
        self.near = np.zeros(len(words), np.int64)
        self.best_n = np.zeros(len(words), np.int64)
        self.best: list[str | None] = [None] * len(words)

    def add(self, here: np.ndarray, there: np.ndarray, other: _Best) -> None:
        """Pairs of own words and words of ``other``."""
        self.near += np.bincount(here, minlength=len(self.words))
        n = other.counts[there]
        # The most frequent of each word's new ones, or several as frequent.
        order = np.lexsort((n, here))
        last = np.append(here[order][1:] != here[order][:-1], True)
        most = np.zeros(len(self.words), np.int64)
        most[here[order][last]] = n[order][last]
        for w, o in zip(here[n == most[here]].tolist(), there[n == most[here]].tolist(), strict=True):
            word, k = other.words[o], int(other.counts[o])
            if k > self.best_n[w] or (k == self.best_n[w] and word < self.best[w]):
                self.best_n[w], self.best[w] = k, word

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.words, pa.string()),
                pa.array(self.counts, pa.int64()),
                pa.array(self.near, pa.int64()),
                pa.array(self.best_n, pa.int64(), mask=self.best_n == 0),
                pa.array(self.best, pa.string()),
            ],
            names=["word", "n", "n_near", "best_n", "best"],
        )


_PARTS = "word string, n long, n_near long, best_n long, best string"
_CELLS = "length int, cell int, query_length int, word string, n long"


class _Cell:
    """The words of one cell, and their tree."""

    def __init__(self, length: int, words: list[str], counts: np.ndarray):
        self.length, self.found = length, _Best(words, counts)
        if words:
            self.points = points_of(words)
            self.vectors = marks(self.points)
            self.tree = Tree.grown(self.vectors, _LEAF, tight=True)

    def within(self) -> None:
        """Pairs of the cell's own words, each once."""
        if self.found.words:
            for a, b in _pairs(self.tree, self.vectors, self.vectors, 1, 1):
                once = a < b
                self._take(self.found, self.points, a[once], b[once])

    def ask(self, length: int, words: list[str], counts: np.ndarray) -> pa.RecordBatch | None:
        if not self.found.words:
            return None
        queries, points = _Best(words, counts), points_of(words)
        down = 1 if length == self.length else 0
        for a, b in _pairs(self.tree, self.vectors, marks(points), 1, down):
            self._take(queries, points, a, b)
        return queries.batch()

    def _take(self, queries: _Best, points: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, (_PAIRS << 2) // (self.length + 1))
        for at in range(0, len(a), step):
            i, j = a[at : at + step], b[at : at + step]
            right = one_edit(points[i], self.points[j])
            if right.any():
                queries.add(i[right], j[right], self.found)
                self.found.add(j[right], i[right], queries)


def _sent(
    batches: Iterator[pa.RecordBatch], trees: dict[int, Tree]
) -> Iterator[pa.RecordBatch]:
    """Every word to its own cell (``query_length`` 0) and as a query to those of its own
    length that come after, and of the next length, which its budget reaches."""
    whole = Tree.grown(np.zeros((0, 2), np.uint64), 0, tight=False)
    for batch in batches:
        words = np.array(batch.column("word").to_pylist(), object)
        counts = batch.column("n").to_numpy()
        lengths = np.array([len(w) for w in words], np.int64)
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            vectors = marks(points_of(words[rows].tolist()))
            own, longer = trees.get(length, whole), trees.get(length + 1, whole)
            home = own.home(vectors)
            sent = [(length, home, np.arange(len(rows)), 0)]
            for node, some in own.reached(vectors, 1, 1):
                some = some[home[some] < node]
                sent.append((length, np.full(len(some), node), some, length))
            for node, some in longer.reached(vectors, 1, 0):
                sent.append((length + 1, np.full(len(some), node), some, length))
            for to, cells, some, kind in sent:
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), to, np.int32)),
                            pa.array(cells.astype(np.int32)),
                            pa.array(np.full(len(some), kind, np.int32)),
                            pa.array(words[rows[some]].tolist(), pa.string()),
                            pa.array(counts[rows[some]]),
                        ],
                        names=["length", "cell", "query_length", "word", "n"],
                    )


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, its own words first. They are held; queries are not."""
    key, members, counts = None, [], []
    cell: _Cell | None = None

    def built() -> _Cell:
        made = _Cell(key[0], members, np.array(counts, np.int64))
        made.within()
        return made

    for batch in batches:
        for part in _stretches(batch):
            here = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
            kind = part.column(2)[0].as_py()
            if here != key:
                if key is not None:
                    yield (cell or built()).found.batch()
                key, members, counts, cell = here, [], [], None
            if kind == 0:
                members += part.column(3).to_pylist()
                counts += part.column(4).to_pylist()
            else:
                cell = cell or built()
                asked = cell.ask(kind, part.column(3).to_pylist(), part.column(4).to_numpy())
                if asked is not None:
                    yield asked
    if key is not None:
        yield (cell or built()).found.batch()


def _stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of one cell and kind, of a bounded number of rows."""
    keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    bounds = [0, *cuts.tolist(), len(keys)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        for at in range(a, b, _QUERIES):
            yield batch.slice(at, min(_QUERIES, b - at))


# --- tables --------------------------------------------------------------------------------


def near_words(words: DataFrame, cell_words: int = 8192, sample: int = 200_000) -> DataFrame:
    """For each of the distinct words ``(word, n)``: ``n_near``, how many of the others are
    one edit away, and ``best``, the most frequent of these (of equal ones the first in
    code-point order), with ``best_n``."""
    total = words.count()
    # At most ``sample`` words.
    chosen = words.orderBy(F.xxhash64("word"), "word").limit(sample).select("word").toArrow()
    by_length: dict[int, list[str]] = {}
    for word in chosen.column("word").to_pylist():
        by_length.setdefault(len(word), []).append(word)
    leaf = max(16, round(cell_words * min(1.0, sample / max(total, 1))))
    trees = {
        length: Tree.grown(marks(points_of(held)), leaf, tight=False)
        for length, held in by_length.items()
    }
    for tree in trees.values():
        tree.members = []  # the sample itself is not sent
    return (
        words.select("word", "n")
        .mapInArrow(lambda batches: _sent(batches, trees), _CELLS)
        .repartition("length", "cell")
        .sortWithinPartitions("length", "cell", "query_length")
        .mapInArrow(_searched, _PARTS)
        .groupBy("word")
        .agg(
            F.max("n").alias("n"),
            F.sum("n_near").alias("n_near"),
            F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
            .alias("top"),
        )
        .select("word", "n", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))
    )


def variants(
    words: DataFrame, ratio: int = 5, cell_words: int = 8192, sample: int = 200_000
) -> DataFrame:
    """``near_words`` with each word's ``form``, the best near word if that is ``ratio``
    times as frequent at least, its count ``form_n``, and ``root``, where forms lead.
    Words have to be distinct.

    A form is more frequent by a factor, so chains are short; they are followed by
    doubling, one join a round.
    """
    taken = F.col("best_n") >= ratio * F.col("n")
    found = staged(
        near_words(words, cell_words, sample).select(
            "word",
            F.when(taken, F.col("best")).alias("form"),
            "n",
            "n_near",
            F.when(taken, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    steps = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = staged(
            steps.join(onward, "root", "left").select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "spelling-roots",
        )
        if steps.filter("moved").isEmpty():
            break
        steps = steps.select("word", "root")
    return found.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
