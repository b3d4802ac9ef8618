"""Benchmark decontamination by SimHash of item-sized windows.

A document is slid over in windows of as many words as a benchmark item has; a text
shorter than the item is one window. Windows that hold too few shingles of the
benchmark to reach the similarity are passed over, which loses none. The others get
a 64-bit SimHash of their shingle counts. An index over four blocks of the items'
fingerprints finds every item within ``radius`` bits: one block of two such
fingerprints differs by ``radius // 4`` bits at most, and all block values that near are
looked up. At the default radius of 19 one random fingerprint in seven gets through;
altered items of similarity 0.8 were found to be 17 bits apart at most. Those pairs are
verified by the weighted Jaccard similarity of
their shingles, weighted by count: sum of minima over sum of maxima.

Words are runs of letters and digits in lower case. An item of fewer words than a
shingle is one shingle by itself. Items and documents without a word match nothing,
NULL texts included. Items repeated under other ids match each by itself; repeated
rows of documents give their rows again. Texts of any length are read whole.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellgauge.llm.common import changed_rows, staged, text_slices, texts_of
from wellgauge.session import workspace

_WORD = re.compile(r"[^\W_]+")
_BLOCKS, _BLOCK_BITS = 4, 16
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd: mixes word numbers to a key
_CHUNK = 4096  # windows hashed at a time


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _bits(shingles: list[tuple[str, ...]]) -> np.ndarray:
    """Per shingle a row of -1 and 1, one for each bit of its hash."""
    hashes = np.array(
        [xxhash.xxh64_intdigest(" ".join(s).encode()) for s in shingles], ">u8"
    )
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of sums, as eight bytes each."""
    return np.packbits(sums > 0, axis=1)


class Index:
    """Benchmark items: vocabulary, shingles, and fingerprints by block."""

    def __init__(self, items: list[tuple[object, str]], shingle: int, similarity: float, radius: int):
        self.shingle, self.similarity, self.radius = shingle, similarity, radius
        split = [(i, words(text or "")) for i, text in items]
        self.items = [(i, w) for i, w in split if w]
        self.vocabulary = {w: n for n, w in enumerate(sorted({x for _, ws in self.items for x in ws}))}
        self.bags = []
        sizes: dict[int, list[int]] = {}
        for n, (_, ws) in enumerate(self.items):
            sizes.setdefault(len(ws), []).append(n)
            k = min(shingle, len(ws))
            self.bags.append(Counter(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)))
        prints = [
            _pack((_bits(list(b.elements()))).sum(axis=0, keepdims=True))[0] for b in self.bags
        ]
        self.prints = np.array(prints, np.uint8).reshape(-1, 8)
        self.sizes = {size: _SizeClass(members, self) for size, members in sorted(sizes.items())}
        # Keys of all shingles by their length; for each size, which of them it has.
        self.known: dict[int, np.ndarray] = {}
        for size, members in self.sizes.items():
            found = {s for m in members.members for s in self.bags[m]}
            numbers = np.array([[self.vocabulary[w] for w in s] for s in found], np.int64)
            members.keys = np.unique(_keys(numbers.T))
            k = min(shingle, size)
            self.known[k] = np.union1d(self.known.get(k, members.keys[:0]), members.keys)
        for size, members in self.sizes.items():
            members.has = np.isin(self.known[min(shingle, size)], members.keys)


def _keys(columns: np.ndarray) -> np.ndarray:
    """One number per column of word numbers. Equal shingles have equal keys; others
    may, which costs a look but no result."""
    key = np.zeros(columns.shape[1], np.uint64)
    for row in columns:
        key = (key ^ row.astype(np.uint64)) * _FACTOR
        key ^= key >> np.uint64(29)
    return key


def _blocks(fingerprint: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fingerprint).view(np.uint16)


@functools.cache
def _masks(reach: int) -> np.ndarray:
    """All differences of ``reach`` bits at most within a block."""
    return np.array(
        [
            sum(1 << b for b in flipped)
            for n in range(min(reach, _BLOCK_BITS) + 1)
            for flipped in combinations(range(_BLOCK_BITS), n)
        ],
        np.uint16,
    )


class _SizeClass:
    """Items of the same number of words, by the values of their blocks."""

    def __init__(self, members: list[int], index: Index):
        self.members = np.array(members)
        self.masks = _masks(index.radius // _BLOCKS)
        self.holders: list[dict[int, list[int]]] = []
        self.present = np.zeros((_BLOCKS, 1 << _BLOCK_BITS), bool)
        for block in range(_BLOCKS):
            table: dict[int, list[int]] = {}
            for m in members:
                table.setdefault(int(_blocks(index.prints[m])[block]), []).append(m)
            self.holders.append(table)
            self.present[block, list(table)] = True

    def candidates(self, window: np.ndarray) -> list[int]:
        """Members that have a block near to the window's."""
        found: set[int] = set()
        for block, value in enumerate(_blocks(window)):
            near = self.masks ^ value
            for value in near[self.present[block, near]].tolist():
                found.update(self.holders[block][value])
        return sorted(found)

    def within(self, window: np.ndarray, index: Index) -> list[int]:
        """All members whose fingerprint is within the radius of the window's."""
        candidates = self.candidates(window)
        if not candidates:
            return []
        apart = np.bitwise_count(index.prints[candidates] ^ window).sum(axis=1)
        return [m for m, d in zip(candidates, apart, strict=True) if d <= index.radius]


def matches(text: str, index: Index) -> list[tuple[int, float, int, int]]:
    """``(item number, similarity, first word, words)`` of the best window for each
    item that reaches the similarity, the first of equals."""
    tokens = words(text)
    get = index.vocabulary.get
    numbers = np.fromiter(map(get, tokens, repeat(-1)), np.int64, len(tokens))
    best: dict[int, tuple[float, int, int]] = {}
    hits: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k, known in index.known.items():
        n = len(numbers) - k + 1
        if n < 1:
            continue
        in_items = numbers >= 0
        every = in_items[:n].copy()
        for i in range(1, k):
            every &= in_items[i : i + n]
        whole = np.flatnonzero(every)
        if len(whole):
            keys = _keys(np.stack([numbers[whole + i] for i in range(k)]))
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            same = known[at] == keys
            if same.any():
                hits[k] = whole[same], at[same]
    for size, members in index.sizes.items() if hits else ():
        k = min(index.shingle, size)
        if k not in hits:
            continue
        places, shingles = hits[k]
        places = places[members.has[shingles]]
        width = min(size, len(tokens)) - k + 1  # shingles of a window
        need = size - k + 1
        # What both must share for the similarity, were all they share in order.
        least = index.similarity / (1 + index.similarity) * (width + need)
        if len(places) < least - 1e-9:
            continue
        run = np.zeros(len(tokens) - k + 2, np.int64)
        run[places + 1] = 1
        run = np.cumsum(run)
        starts = np.flatnonzero(run[width:] - run[:-width] >= least - 1e-9)
        for chunk in np.split(starts, range(_CHUNK, len(starts), _CHUNK)):
            for start, window in _fingerprints(tokens, chunk, width, k):
                for m in members.within(window, index):
                    bag = Counter(tuple(tokens[i : i + k]) for i in range(start, start + width))
                    shared = (bag & index.bags[m]).total()
                    similarity = shared / (width + need - shared)
                    if similarity >= index.similarity - 1e-12:
                        if m not in best or similarity > best[m][0]:
                            best[m] = (similarity, start, width + k - 1)
    return [(m, *found) for m, found in sorted(best.items())]


def _fingerprints(
    tokens: list[str], starts: np.ndarray, width: int, k: int
) -> Iterator[tuple[int, np.ndarray]]:
    """SimHash of the windows at ``starts``, from running sums over each stretch of
    windows that overlap."""
    if not len(starts):
        return
    for stretch in np.split(starts, np.flatnonzero(np.diff(starts) > width) + 1):
        first, last = int(stretch[0]), int(stretch[-1]) + width
        rows = _bits([tuple(tokens[i : i + k]) for i in range(first, last)])
        sums = np.concatenate([np.zeros((1, rows.shape[1]), np.int32), np.cumsum(rows, axis=0)])
        at = stretch - first
        yield from zip(stretch.tolist(), _pack(sums[at + width] - sums[at]), strict=True)


# --- Spark ----------------------------------------------------------------------


def item_blocks(
    benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int
) -> Iterator[tuple[list[tuple[object, str]], bool]]:
    """The benchmark in blocks of about ``block_bytes``, each small enough for every
    task, and whether a block is the last. A block is read when it is asked for; whoever stores what one has found before
    asking for the next has one in the driver, however large the benchmark is."""
    rows = benchmark.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = rows.filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for block in range(blocks):
        of_block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block
        held = rows.filter(of_block).orderBy("id", "text").collect()  # about block_bytes
        yield [(r.id, r.text) for r in held], block == blocks - 1


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    radius: int = 19,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """One row per document row and benchmark item found in it: both ids,
    ``similarity``, and ``start`` and ``end`` of the best window in code points."""
    kind = docs.schema[id_column].dataType.simpleString()
    item_kind = benchmark.schema[item_id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, `{item_id_column}` {item_kind}, similarity double, "
        "start int, end int"
    )
    texts = docs.select(id_column, text_column)
    path = workspace(docs.sparkSession, "contaminations")
    parts = []
    for items, last in item_blocks(benchmark, item_id_column, item_text_column, block_bytes):
        found = texts.mapInArrow(
            _finder(items, shingle, similarity, radius, id_column, text_column, item_id_column),
            schema,
        )
        if last and not parts:
            return found  # the only block
        parts.append(f"{path}/{len(parts)}")
        found.write.parquet(parts[-1])
    return docs.sparkSession.read.schema(found.schema).parquet(*parts)


def _finder(items, shingle, similarity, radius, id_column, text_column, item_id_column):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, shingle, similarity, radius)
        for batch in text_slices(batches, text_column):
            at, ids, scores, begins, ends = [], [], [], [], []
            for row, raw in enumerate(texts_of(batch, text_column)):
                text = raw.decode("utf-8", "replace")
                found = matches(text, index)
                places = word_places(text) if found else []
                for item, score, first, count in found:
                    at.append(row)
                    ids.append(index.items[item][0])
                    scores.append(score)
                    begins.append(places[first][0])
                    ends.append(places[first + count - 1][1])
            if at:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(id_column).take(pa.array(at)),
                        pa.array(ids),
                        pa.array(scores, pa.float64()),
                        pa.array(begins, pa.int32()),
                        pa.array(ends, pa.int32()),
                    ],
                    names=[id_column, item_id_column, "similarity", "start", "end"],
                )

    return rows


def word_places(text: str) -> list[tuple[int, int]]:
    """Where each of ``words(text)`` stands in the text, in code points."""
    lowered = text.lower()
    if len(lowered) == len(text):
        return [m.span() for m in _WORD.finditer(lowered)]
    # A few letters become two in lower case: count back to the text's own places.
    own = [i for i, c in enumerate(text) for _ in c.lower()]
    own.append(len(text))
    return [(own[m.start()], own[m.end() - 1] + 1) for m in _WORD.finditer(lowered)]


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    radius: int = 19,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    kept = docs
    for items, last in item_blocks(benchmark, item_id_column, item_text_column, block_bytes):
        kept = changed_rows(kept, _keeper(items, shingle, similarity, radius, text_column))
        if not last:
            kept = staged(kept, "without-items")
    return kept


def _keeper(items, shingle, similarity, radius, text_column):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, shingle, similarity, radius)
        for batch in text_slices(batches, text_column):
            clean = [
                not matches(raw.decode("utf-8", "replace"), index)
                for raw in texts_of(batch, text_column)
            ]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return rows
