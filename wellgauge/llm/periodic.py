"""Periodic runs of words, found online by a sparse dynamic programme over diagonals.

Words are numbered from 0. On the diagonal of lag ``q`` a cell is set where a word
equals the one ``q`` before it, and holds how many words in a row have done so. A run
of smallest period ``q`` is a stretch that shows as ``length - q`` set cells in a row;
it has to be ``min_length`` words long and twice ``q``, and is as long as it can be.

The programme goes over the words once. Each word adds one to the match length of
every active lag, or ends it; a lag that ends with enough matches emits its run at
once. Lags become active by earlier occurrences of the words seen so far. Two things
keep them few, whatever the text is, and change no result:

- A run of period ``q`` needs ``q`` matches, and ``min_length - q``. So an occurrence
  opens a lag from ``m`` to ``2m - 1`` only where the last ``m`` words occur there, for
  ``m`` a power of two; its match length is ``m`` then.
- Two stretches that end together, have periods ``p < q`` and share ``p + q`` words have
  a common smaller period (Fine and Wilf), so the longer lag is never the smallest
  period and is not opened.

NULL, empty and blank texts have no words and no runs. Repeated rows are read row by
row, and rows keep their id whatever it is. Invalid UTF-8 is split and compared as
bytes, and shown with replacement characters in the collapsed text of its own row. A
text of any length is read whole, by one task; occurrences are gathered for a few
megabytes of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wellgauge.llm.common import text_slices, texts_of

MIN_LENGTH = 12

Run = tuple[int, int, int]  # start, length, smallest period
_RUNS = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


def words_of(text: bytes) -> list[bytes]:
    """What stands between ASCII white space."""
    return text.split()


# --- earlier occurrences ---------------------------------------------------------


def _word_numbers(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word of all texts, one after another; words of different
    texts never share one."""
    numbers = np.empty(sum(map(len, texts)), np.int64)
    done = first = 0
    for words in texts:
        known: dict[bytes, int] = {}
        numbers[done : done + len(words)] = [known.setdefault(w, len(known)) for w in words]
        numbers[done : done + len(words)] += first
        done, first = done + len(words), first + len(known)
    return numbers


def _class_numbers(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal keys, and how often each number occurs."""
    _, numbers, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return numbers, counts


def _equal_pairs(ends: np.ndarray, grams: np.ndarray, before: np.ndarray, low: int, high: int):
    """Pairs ``(end, lag)``, ``low <= lag < high``, of equal grams that follow different
    words. ``ends`` ascends.

    Occurrences of a gram are taken in blocks that follow the same word. Nearby
    occurrences of a periodic gram follow the same word but for the first, so the
    pairs of different blocks are few even where those of one block are not.
    """
    order = np.argsort(grams, kind="stable")
    ends, grams, before = ends[order], grams[order], before[order]
    fresh = np.ones(len(ends), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (before[1:] != before[:-1])
    starts = np.flatnonzero(fresh)
    stops = np.append(starts[1:], len(ends))
    later = np.arange(len(starts))
    found_ends, found_lags = [], []
    for back in range(1, len(starts)):
        later = later[later >= back]
        earlier = later - back
        close = (grams[starts[later]] == grams[starts[earlier]]) & (
            ends[starts[later]] - ends[stops[earlier] - 1] < high
        )
        later = later[close]
        if not len(later):
            break
        earlier = later - back
        differ = before[starts[later]] != before[starts[earlier]]
        for b, a in zip(later[differ].tolist(), earlier[differ].tolist(), strict=True):
            here, there = ends[starts[b] : stops[b]], ends[starts[a] : stops[a]]
            here = here[: np.searchsorted(here, there[-1] + high)]
            first = np.searchsorted(there, here - high + 1)
            last = np.searchsorted(there, here - low, "right")
            n = np.maximum(last - first, 0)
            if n.any():
                at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found_ends.append(np.repeat(here, n))
                found_lags.append(np.repeat(here, n) - there[at])
    if not found_ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_ends), np.concatenate(found_lags)


def _openings(texts: list[list[bytes]], min_length: int):
    """``(end, lag, matches)``: where, counted over all texts one after another, an
    earlier occurrence opens a lag, and how many words match by then."""
    words = _word_numbers(texts)
    total = len(words)
    text_of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first_of = np.repeat(np.cumsum([0, *map(len, texts)])[:-1], [len(t) for t in texts])
    # The word before a gram; the start of a text differs from every word and start.
    before_word = np.empty(total, np.int64)
    if total:
        before_word[1:] = words[:-1]
        at_start = np.flatnonzero(np.arange(total) == first_of)
        before_word[at_start] = -1 - at_start
    # The least number of matches that any run has: of lags q, the greater of q and
    # min_length - q. Grams start at the power of two below it.
    least = max(1, -(-min_length // 2))
    size, grams, starts = 1, words, np.arange(total)
    while len(starts):
        if 2 * size > least:
            ends = starts + size - 1
            low = 1 if size <= least else size
            end, lag = _equal_pairs(ends, grams, before_word[starts], low, 2 * size)
            for e, q in zip(end.tolist(), lag.tolist(), strict=True):
                yield e, q, size
        # Grams of twice the size, of those that occur again.
        place = np.full(total + 1, -1, np.int64)
        place[starts] = grams
        second = np.minimum(starts + size, total)
        same_text = second < total
        same_text[same_text] = text_of[second[same_text]] == text_of[starts[same_text]]
        whole = same_text & (place[second] >= 0)
        starts, second = starts[whole], second[whole]
        numbers, counts = _class_numbers(place[starts] * (total + 1) + place[second])
        again = counts[numbers] > 1
        starts, grams, size = starts[again], numbers[again], 2 * size


# --- the programme over diagonals --------------------------------------------------


def _online(
    words: list[bytes], opened: dict[int, list[tuple[int, int]]], min_length: int
) -> list[Run]:
    """Runs of one text in the order in which they end. ``opened`` has, by word, the
    lags that earlier occurrences open there with their match lengths."""
    runs: list[Run] = []
    active: dict[int, int] = {}
    todo = sorted(opened, reverse=True)
    i, n = 0, len(words)

    def ended(lag: int, matches: int) -> None:
        if matches >= lag and matches + lag >= min_length:
            runs.append((i - matches - lag, matches + lag, lag))

    while todo or active:
        if not active:
            i = todo[-1]  # no lag to follow until then
        if i == n:
            for lag, matches in active.items():
                ended(lag, matches)
            break
        word = words[i]
        gone = []
        for lag in active:
            if words[i - lag] == word:
                active[lag] += 1
            else:
                gone.append(lag)
        for lag in gone:
            ended(lag, active.pop(lag))
        if todo and todo[-1] == i:
            for lag, matches in sorted(opened[todo.pop()]):
                if not any(q < lag <= held and matches >= q for q, held in active.items()):
                    active[lag] = matches
        i += 1
    return runs


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[Run]]:
    """The runs of each text, by start, then period."""
    firsts = np.cumsum([0, *map(len, texts)])
    by_text: dict[int, dict[int, list[tuple[int, int]]]] = {}
    for end, lag, matches in _openings(texts, min_length):
        text = int(np.searchsorted(firsts, end, "right")) - 1
        opened = by_text.setdefault(text, {})
        opened.setdefault(end - int(firsts[text]), []).append((lag, matches))
    return [
        sorted(_online(words, by_text[i], min_length), key=lambda r: (r[0], r[2]))
        if i in by_text
        else []
        for i, words in enumerate(texts)
    ]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(steps)[:-1] == 0)
    return [words[i] for i in kept.tolist()]


# --- tables ------------------------------------------------------------------------


def run_batches(
    batches: Iterator[pa.RecordBatch],
    id_column: str,
    text_column: str,
    min_length: int = MIN_LENGTH,
) -> Iterator[pa.RecordBatch]:
    """``find_runs`` for batches that hold the two columns."""
    for batch in text_slices(batches, text_column):
        texts = [words_of(t) for t in texts_of(batch, text_column)]
        found = runs_of(texts, min_length)
        kept = [
            b" ".join(collapsed(words, runs)).decode("utf-8", "replace")
            for words, runs in zip(texts, found, strict=True)
        ]
        rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in f] for f in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(id_column),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(rows, _RUNS),
                pa.array(kept, pa.string()),
            ],
            names=[id_column, "n_words", "runs", "collapsed"],
        )


def find_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_length: int = MIN_LENGTH,
) -> DataFrame:
    """Per row: the id, ``n_words``, ``runs`` (structs of start, length and period, by
    start, then period) and ``collapsed``, the words that stand in no run after its
    first period, joined by one space. No shuffle."""
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        lambda batches: run_batches(batches, id_column, text_column, min_length),
        f"`{id_column}` {kind}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )
