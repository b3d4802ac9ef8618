"""SimHash near-duplicates by deletion variants.

A fingerprint has 64 bits. To find all pairs within ``radius`` bits it is cut into
``radius // 2 + 1`` segments, so that one segment of any such pair differs in one bit
at most. Each segment is indexed once per bit with that bit taken out; two segments
that differ in one bit at most agree in one of these variants. Pairs that meet on a
variant are verified on all 64 bits.

Only distinct fingerprints are joined, so copies cost no pairs, whatever their
number. Texts without any word, empty and NULL ones have fingerprint zero and are
linked like others. Rows with the same id are rows of their own; a group takes the
smallest id it has, NULL only if it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellgauge.llm.common import staged, text_slices, texts_of
from wellgauge.llm.components import components

BITS = 64
_LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))
# Bits of each byte value, most significant first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, repeats included; of the whole
    sequence if it is shorter; nothing if there is no word."""
    words = text.translate(_LOWER).split()  # ASCII white space, as for any bytes
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.append(0, ends[: -shingle]).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64
    )


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set where it is set in more than half of the hashes."""
    if not len(hashes):
        return 0
    columns = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate(
        [np.bincount(columns[:, i], minlength=256) @ _BYTE_BITS for i in range(8)]
    )
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, fp)`` of each whole text; ``fp`` is the fingerprint as a signed long."""
    kind = docs.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_column):
            found = [fingerprint(shingle_hashes(t, shingle)) for t in texts_of(batch, text_column)]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(signed)], names=[id_column, "fp"]
            )

    return docs.select(id_column, text_column).mapInArrow(rows, f"`{id_column}` {kind}, fp long")


def _segments(radius: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    n = radius // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _without(bit: int) -> int:
    """A signed long with all bits set but one."""
    return ~(1 << bit) if bit < BITS - 1 else (1 << bit) - 1


def _segment(fp: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def fingerprint_links(fps: DataFrame, radius: int) -> DataFrame:
    """All pairs ``(a, b)``, ``a < b``, of the distinct fingerprints in ``fps.fp``
    that differ in ``radius`` bits at most, each once."""
    if radius < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    segments = _segments(radius)
    variants = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(start + i).cast("byte").alias("bit"),
                    _segment(F.col("fp"), start, width)
                    .bitwiseAND(F.lit(_without(i)))
                    .alias("rest"),
                )
                for start, width in segments
                for i in range(width)
            ]
        )
    ).alias("v")
    index = fps.select("fp", variants).select("fp", "v.bit", "v.rest")
    left = index.withColumnRenamed("fp", "a")
    right = index.withColumnRenamed("fp", "b")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    # A pair is taken on the first segment that differs in one bit at most, and
    # there on the bit that differs, or on the first bit if none does.
    first_bit, settled = F.lit(None).cast("int"), []
    for start, width in reversed(segments):
        part = _segment(differing, start, width)
        bit = (
            F.when(part == 0, F.lit(start))
            .when(part < 0, F.lit(BITS - 1))  # the sign, of which 1 cannot be taken
            .otherwise(F.lit(start) + F.bit_count(part - 1))  # ones below the single one
        )
        first_bit = F.when(F.bit_count(part) <= 1, bit).otherwise(first_bit)
        settled.append(part)
    return (
        left.join(right, ["bit", "rest"])
        .filter(F.col("a") < F.col("b"))
        .filter(F.bit_count(differing) <= radius)
        .filter(F.col("bit") == first_bit)
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: the id, ``fp`` and ``component_id``, the smallest
    id that links reach, over any number of steps."""
    prints = staged(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    groups = staged(
        prints.groupBy("fp").agg(F.min(id_column).alias("lowest")), "fingerprint-groups"
    )
    reached = components(fingerprint_links(groups.select("fp"), radius))
    reached = reached.withColumnsRenamed({"node": "fp", "component": "root"})
    rooted = groups.join(reached, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    labels = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(id_column, "fp", "component_id")


def representatives(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the one of the
    smallest id, NULL last; of rows with that id, the one whose text hashes lowest."""
    row = F.struct(
        F.col(id_column).isNull().alias("no_id"),
        F.col(id_column).alias("id"),
        F.xxhash64(text_column).alias("text_hash"),
    )
    keyed = docs.select(row.alias("row"), F.col(text_column).alias("text"))
    labels = near_duplicates(keyed, shingle, radius, "row", "text")
    kept = labels.select(F.col("component_id").alias("row")).distinct()
    # Repeated rows agree in id and text: the first will do.
    repeats = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    return (
        docs.select(row.alias("row"), F.struct("*").alias("whole"))
        .join(kept, "row")
        .withColumn("repeat", repeats)
        .filter("repeat = 1")
        .select("whole.*")
    )
