"""Byte-level BPE encoding and decoding.

Boundaries between pre-tokens are found without a regular expression. Each code
point is looked up in an array of classes; a class is a transition function on a
few states, the functions form a small monoid, and composing them is associative.
So a text is cut into blocks, all blocks are reduced side by side, the block totals
are scanned by doubling, and a second pass marks the starts. The slices between
starts are merged pair by pair, once per distinct slice as long as it is cached.

Texts that are NULL or empty give no ids. Repeated rows are encoded each by itself.
A text of any length is encoded whole. Bytes that are no UTF-8 are signs of one byte each
and come back as they were; texts beside them are not touched. Columns other than id and
text are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wellgauge.llm.common import text_slices, texts_of

# --- classes and states -------------------------------------------------------

# Classes of code points, after a look at the one or two that follow.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACES, LAST_SPACE, JOINING, RESET = range(9)
# States after a code point: a new token is due; the open token is one joining
# blank; a run of letters, numbers, others, white space; one or two letters of a
# contraction are still to come.
FRESH, JOINED, LETTERS, NUMBERS, OTHERS, BLANKS, ONE_MORE, TWO_MORE = range(8)

_RUNS = {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS}


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether this code point starts a token."""
    if kind == RESET:
        return FRESH, False
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    if kind == SPACES:
        return BLANKS, state != BLANKS
    if kind == LAST_SPACE:
        return FRESH, True
    if kind == JOINING:
        return JOINED, True
    if kind in (SHORT, LONG):
        if state in (JOINED, OTHERS):
            return OTHERS, False
        return (ONE_MORE if kind == SHORT else TWO_MORE), True
    run = _RUNS[kind]
    return run, state not in (JOINED, run)


N_STATES, N_KINDS = 8, 9
NEXT = np.array([[_step(s, k)[0] for k in range(N_KINDS)] for s in range(N_STATES)], np.uint8)
STARTS = np.array([[_step(s, k)[1] for k in range(N_KINDS)] for s in range(N_STATES)], bool)


@functools.cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of class functions: their state maps, the table of their
    products, and the number of each class's own function. Number 0 is identity."""
    own = [tuple(int(NEXT[s, k]) for s in range(N_STATES)) for k in range(N_KINDS)]
    found = {tuple(range(N_STATES)): 0}
    queue = [tuple(range(N_STATES))]
    for f in queue:
        for g in own:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                queue.append(h)
    maps = np.array(queue, np.uint8)
    product = np.array(
        [[found[tuple(int(maps[b][s]) for s in maps[a])] for b in range(len(maps))]
         for a in range(len(maps))],
        np.uint16,
    )
    return maps, product, np.array([found[f] for f in own], np.uint16)


@functools.cache
def code_point_classes() -> np.ndarray:
    """For each code point: letter, number, white space (SPACES) or other."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACES)):
        for match in regex.finditer(pattern, every):
            first, last = ord(match[0][0]), ord(match[0][-1])
            table[first : last + 1] = np.where(
                table[first : last + 1] == OTHER, kind, table[first : last + 1]
            )
    table[0xD800:0xE000] = OTHER
    return table


_APOSTROPHE = ord("'")
# What may follow an apostrophe as one token with it.
_SHORT_ENDS = "stmd"
_LONG_ENDS = ("re", "ve", "ll")


def classify(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Class of each code point; ``breaks`` are positions that separate texts."""
    kinds = code_point_classes()[points]
    kinds[breaks] = RESET
    white = kinds == SPACES
    ends = np.ones(len(points), bool)  # the next is white space or none
    ends[:-1] = white[1:] | (kinds[1:] == RESET)
    last = white & ~ends
    kinds[last] = LAST_SPACE
    kinds[last & (points == 0x20)] = JOINING
    quotes = np.flatnonzero((points == _APOSTROPHE) & (kinds == OTHER))
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        kinds[quotes[np.isin(one, [ord(c) for c in _SHORT_ENDS])]] = SHORT
        for end in _LONG_ENDS:
            kinds[quotes[(one == ord(end[0])) & (two == ord(end[1]))]] = LONG
    return kinds


def token_starts(kinds: np.ndarray, block: int = 512) -> np.ndarray:
    """Whether each code point starts a pre-token, by a blocked associative scan."""
    n = len(kinds)
    if not n:
        return np.zeros(0, bool)
    maps, product, own = _monoid()
    size = len(maps)
    rows = -(-n // block)
    padded = np.full(rows * block, RESET, np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, block).T)
    flat = product.ravel()
    # Each block's function, all blocks at once.
    own_size = own.astype(np.uint16)
    total = own_size[columns[0]].astype(np.intp)
    for j in range(1, block):
        total = flat[total * size + own_size[columns[j]]].astype(np.intp)
    # Inclusive scan of the block functions by doubling.
    step = 1
    while step < rows:
        total[step:] = flat[total[:-step] * size + total[step:]]
        step *= 2
    state = np.zeros(rows, np.intp)  # before each block; the first starts fresh
    state[1:] = maps[total[:-1], FRESH]
    following, begins = NEXT.ravel(), STARTS.ravel()
    marks = np.empty((block, rows), bool)
    for j in range(block):
        at = state * N_KINDS + columns[j]
        marks[j] = begins[at]
        state = following[at].astype(np.intp)
    return np.ascontiguousarray(marks.T).ravel()[:n]


def pretoken_offsets(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """All texts as one byte string, and the byte offset of each pre-token in it."""
    joined = b"".join(texts)
    # One separator after each text; it is no part of any token. A byte that is no UTF-8
    # becomes a lone surrogate, which is of the class of other signs and one byte wide.
    read = [t.decode("utf-8", "surrogateescape") for t in texts]
    whole = "\0".join([*read, ""]).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(whole, np.uint32)
    breaks = np.cumsum(np.array([len(t) for t in read], np.int64) + 1) - 1
    marks = token_starts(classify(points, breaks))
    widths = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
    widths[(points >= 0xD800) & (points < 0xE000)] = 1
    widths[breaks] = 0
    offsets = np.cumsum(widths, dtype=np.int64) - widths
    return joined, offsets[marks]


# --- merging ------------------------------------------------------------------


class Codec:
    """Ranks of a vocabulary, with cached merges. Ids are ranks."""

    def __init__(self, rank_file: str, cached: int = 1 << 18):
        with open(rank_file, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.cached = cached
        self.merged = _Merged(self.ranks)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte offset at which each ends, and how many of
        them end with or before each text."""
        joined, starts = pretoken_offsets(texts)
        if len(self.merged) > self.cached:
            self.merged.clear()  # bounded memory; what is met again is merged again
        stops = np.append(starts, len(joined))[1:].tolist()
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), stops, strict=True)]
        ids = np.fromiter(chain.from_iterable(map(self.merged.__getitem__, pieces)), np.int32)
        ends = np.cumsum(self.lengths[ids])
        text_ends = np.cumsum([len(t) for t in texts])
        return ids, ends, np.searchsorted(ends, text_ends, "right")

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """Bytes of ids that end at the given offsets, counted from the first."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        # Source position of each byte: its token's place plus the way into it.
        shift = np.repeat(self.places[ids] - (ends - lengths), lengths)
        return self.token_bytes[shift + np.arange(len(shift))].tobytes()


class _Merged(dict):
    """Ids by slice; a slice that is missing is merged and kept."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)
        ids = merge_pairs(piece, self.ranks) if rank is None else (rank,)
        if len(piece) <= 64:
            self[piece] = ids
        return ids


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Join the pair of lowest rank, the leftmost of equals, until none is left."""
    return _merge_short(piece, ranks) if len(piece) <= 48 else _merge_long(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """A plain search for the lowest pair is quickest over few parts."""
    none = 1 << 62
    get = ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (lowest := min(pairs)) < none:
        i = pairs.index(lowest)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return tuple([ranks[part] for part in parts])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """A heap of pairs over a linked list: a very long piece takes n log n steps."""
    n = len(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(piece[i : after[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, after[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, end = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and after[i] == j and after[j] == end):
            continue  # one of the two has been joined with another meanwhile
        alive[j] = False
        after[i] = end
        if end < n:
            before[end] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return tuple(out)


@functools.lru_cache(maxsize=2)
def codec(rank_file: str) -> Codec:
    """One codec per Python worker and file."""
    return Codec(rank_file)


# --- Spark --------------------------------------------------------------------

# Text encoded at a time. Arrays and slices of it take some fifty times its size, so
# this, and the longest text, bounds what a Python worker holds.
ENCODED_BYTES = 1 << 19

def encode_batches(
    batches: Iterator[pa.RecordBatch], rank_file: str, id_column: str, text_column: str
) -> Iterator[pa.RecordBatch]:
    """Ids and end offsets per row, in slices of bounded size."""
    bpe = codec(rank_file)
    for batch in text_slices(batches, text_column, ENCODED_BYTES):
        texts = texts_of(batch, text_column)
        ids, ends, upto = bpe.encode(texts)
        base = np.cumsum([0, *map(len, texts)])
        rows = np.append(0, upto)
        per_row = np.diff(rows)
        local = ends - np.repeat(base[:-1], per_row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(id_column),
                pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids)),
                pa.ListArray.from_arrays(
                    pa.array(rows, pa.int32()), pa.array(local.astype(np.int32))
                ),
            ],
            names=[id_column, "ids", "ends"],
        )


def decode_batches(
    batches: Iterator[pa.RecordBatch], rank_file: str
) -> Iterator[pa.RecordBatch]:
    """Add ``decoded``, the bytes of each row's ids."""
    bpe = codec(rank_file)
    for batch in batches:
        decoded = []
        ids, ends = batch.column("ids"), batch.column("ends")
        for tokens, offsets in zip(ids, ends, strict=True):
            if tokens.is_valid and offsets.is_valid:
                places = offsets.values.to_numpy(zero_copy_only=False)
                decoded.append(bpe.decode(tokens.values.to_numpy(zero_copy_only=False), places))
            else:
                decoded.append(b"")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(decoded, pa.large_binary())],
            names=[*batch.schema.names, "decoded"],
        )


def encode(
    docs: DataFrame, rank_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Token ids of each whole text, with the byte offset at which each token ends.

    Returns the id column, ``ids`` and ``ends``. No shuffle: each task encodes the
    rows it reads. Every node must have the rank file at its path.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        lambda batches: encode_batches(batches, rank_file, id_column, text_column),
        f"`{id_column}` {kind}, ids array<int>, ends array<int>",
    )


def decode(encoded: DataFrame, rank_file: str, id_column: str = "doc_id") -> DataFrame:
    """Texts of ``encode``'s rows as bytes, in a column ``decoded``. NULL ids give
    no bytes."""
    kind = encoded.schema[id_column].dataType.simpleString()
    rows = encoded.select(id_column, "ids", "ends")
    return rows.mapInArrow(
        lambda batches: decode_batches(batches, rank_file),
        f"`{id_column}` {kind}, ids array<int>, ends array<int>, decoded binary",
    ).drop("ids", "ends")
