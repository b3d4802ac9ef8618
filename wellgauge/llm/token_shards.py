"""Token ids as binary shards in training order.

The texts of a table, one after another, are packed into sequences of ``length`` ids;
the last one is padded. A keyed Feistel permutation gives each sequence's number its
global slot, and slots are cut into ranges, one file each. A record is the ids of one
sequence and a line feed, so every record has the same stride: the sequence at a slot is
found by arithmetic, and reading can go on at any slot.

The order of the texts is a matter of data alone: with ``by_id`` that of id and text
(by hash), whatever files and partitions hold them; else that of the files' paths and of
the rows in them, for which the table must be read from files. Sizes are summed up in
this order into a staged table, where each text has the number of its first id. Texts
are joined to it and cut where sequences begin, so neither the result nor a repeated
task depends on how rows are dealt out.

Ids are numbers of ``width`` bytes, little-endian: 1, 2 or 4. They come from a column
of arrays, such as ``bpe.encode`` gives, or else are the bytes of the text in UTF-8. The
greatest number of that width is END, which follows each text, and the next smaller one
PAD; ids have to be smaller than both. Beside the shards, a table of the texts' ids and
first ids tells which texts a sequence holds.

NULL and empty texts give END alone. Repeated rows are packed each by itself. A text of
any length runs through as many sequences as it takes. A table without rows gives no
file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellgauge.llm.common import quoted, running_totals, staged, text_slices, texts_of
from wellgauge.llm.feistel import inverted, permute, permuted

_SEPARATOR = b"\n"


def end_of(width: int) -> int:
    return (1 << 8 * width) - 1


def pad_of(width: int) -> int:
    return end_of(width) - 1


# No byte of UTF-8 has these values.
END, PAD = end_of(1), pad_of(1)


@dataclass(frozen=True)
class Shards:
    """Where the sequences of a written table are."""

    path: str
    sequences: int
    length: int  # ids of a sequence
    per_shard: int
    seed: int
    width: int = 1  # bytes of an id

    @property
    def stride(self) -> int:
        return self.length * self.width + len(_SEPARATOR)

    @property
    def documents(self) -> str:
        """Folder of the table of texts."""
        return f"{self.path}-documents"

    @property
    def shards(self) -> int:
        return -(-self.sequences // self.per_shard)

    def place(self, number: int) -> tuple[int, int]:
        """Shard and byte offset of a sequence."""
        slot = permute(number, self.sequences, self.seed)
        return slot // self.per_shard, slot % self.per_shard * self.stride


def write_shards(
    texts: DataFrame,
    path: str,
    seed: int,
    length: int = 512,
    text_column: str = "text",
    shard_bytes: int = 32 << 20,
    id_column: str = "doc_id",
    by_id: bool = False,
    ids_column: str | None = None,
    width: int = 1,
    broadcast_rows: int = 500_000,
) -> Shards:
    """Write the sequences of all texts, or of the ids in ``ids_column``, which has to
    be read from files, as it is read twice. One shuffle brings each range of slots to
    the task that writes its file, in order. The numbers of first ids go to the texts if
    there are ``broadcast_rows`` at most, about 100 bytes each; of more texts, another
    shuffle brings the texts to the numbers."""
    if width not in (1, 2, 4) or (ids_column is None and width != 1):
        raise ValueError("ids have 1, 2 or 4 bytes, those of a text 1")
    text = F.col(quoted(ids_column or text_column))
    size = F.octet_length(text) if ids_column is None else F.size(text)
    n = F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long") + 1
    doc = F.col(quoted(id_column))
    if by_id:
        key = [doc.alias("id"), F.xxhash64(text).alias("hash")]
    else:
        key = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    place = F.struct(*key, n.alias("n")).alias("place")
    rows = texts.select(place, doc.alias("doc"), text.alias("text"))
    path_of = Shards(path, 0, length, 1, seed, width).documents
    _starts(rows.select("place", "doc")).write.parquet(path_of)
    starts = texts.sparkSession.read.parquet(path_of)
    rows = rows.select("place", "text")
    if ids_column is not None:
        kind = rows.schema["place"].dataType.simpleString()
        rows = rows.mapInArrow(_packed(width), f"place {kind}, text binary")
    ids, most, count = starts.agg(
        F.sum(F.col("n") * F.col("copies")), F.max("copies"), F.count(F.lit(1))
    ).first()
    ids, total = ids or 0, -(-(ids or 0) // length)
    per_shard = max(1, shard_bytes // (length * width + len(_SEPARATOR)))
    shards = Shards(path, total, length, per_shard, seed, width)
    starts = starts.drop("doc")
    placed = rows.join(F.broadcast(starts) if count <= broadcast_rows else starts, "place")
    if (most or 1) > 1:  # texts of one place are the same: any may be the first
        copy = F.row_number().over(Window.partitionBy("place").orderBy("first")) - 1
        repeated = placed.filter("copies > 1")
        numbered = repeated.withColumn("first", F.col("first") + copy * F.col("n"))
        placed = placed.filter("copies = 1").unionByName(numbered)
    slot = permuted(F.col("number"), max(total, 1), seed)
    shard = F.call_function("div", F.col("slot"), F.lit(per_shard)).cast("int")
    (
        placed.select("first", "text")
        .mapInArrow(_pieces(ids, length, width), "number long, at int, piece binary")
        .select(slot.alias("slot"), "at", "piece")
        .repartitionById(max(shards.shards, 1), shard)
        .sortWithinPartitions("slot", "at")
        .select("piece")
        .mapInArrow(_records(length * width), "record binary")
        # The text writer passes bytes on as they are and ends each by the separator.
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", _SEPARATOR.decode())
        .text(path)
    )
    return shards


def _starts(rows: DataFrame) -> DataFrame:
    """Each place once, with the ids ``n`` of a text there, its ``doc``, how many
    ``copies`` there are, and the number of the ``first`` id of the first of them.

    Places are sorted in ranges, whose totals are summed up first: ranges may be cut
    anywhere, and are staged so that they are cut once."""
    places = rows.groupBy("place").agg(
        F.first("doc").alias("doc"), F.count(F.lit(1)).alias("copies")
    )
    places = places.select("place", "doc", F.col("place.n").alias("n"), "copies")
    ranges = places.repartitionByRange("place").withColumn("part", F.spark_partition_id())
    ranges = staged(ranges, "sequence-ranges")
    size = F.col("n") * F.col("copies")
    totals = ranges.groupBy("part").agg(F.sum(size).alias("size"))
    bases = running_totals(totals, "part", "size", "base")  # one row per range
    before = (
        Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranges.withColumn("before", F.coalesce(F.sum(size).over(before), F.lit(0)))
        .join(F.broadcast(bases), "part")
        .select("place", "doc", "n", "copies", (F.col("base") + F.col("before")).alias("first"))
    )


def _packed(width: int):
    """Lists of ids as bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("text")
            ids = lists.flatten()
            numbers = ids.fill_null(-1).to_numpy()
            if len(numbers) and not 0 <= numbers.min() <= numbers.max() < pad_of(width):
                raise ValueError(f"an id is NULL, or does not fit {width} bytes with END and PAD")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            cuts = np.append(0, np.cumsum(sizes, dtype=np.int64)) * width
            data = pa.py_buffer(numbers.astype(f"<u{width}").tobytes())
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(lists), [None, pa.py_buffer(cuts), data]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), packed.cast(pa.binary())], names=["place", "text"]
            )

    return rows


def _pieces(total: int, length: int, width: int):
    """Ids of the texts, cut where sequences begin, and the padding of the last one."""
    end, pad = (x.to_bytes(width, "little") for x in (end_of(width), pad_of(width)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = texts_of(batch)
            first = batch.column("first").to_numpy()
            sizes = np.array([len(t) // width + 1 for t in texts], np.int64)
            stops = first + sizes
            # Each text is cut at its start and at every multiple of the length in it.
            counts = (stops - 1) // length - first // length + 1
            of = np.repeat(np.arange(len(texts)), counts)
            within = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            number = first[of] // length + within
            start = np.maximum(number * length, first[of])
            base = np.cumsum(sizes) - sizes
            cuts = np.append(base[of] + start - first[of], sizes.sum()) * width
            ids = b"".join(t + end for t in texts)
            pieces = pa.Array.from_buffers(
                pa.large_binary(), len(of), [None, pa.py_buffer(cuts), pa.py_buffer(ids)]
            )
            yield _piece_batch(number, start - number * length, pieces.cast(pa.binary()))
            if (stops == total).any() and total % length:
                padding = pad * (-total % length)
                yield _piece_batch([total // length], [total % length], pa.array([padding]))

    return rows


def _piece_batch(number, at, pieces: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(number, pa.int64()), pa.array(at, pa.int32()), pieces],
        names=["number", "at", "piece"],
    )


def _records(size: int):
    """Records of ``size`` bytes from their pieces in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = b""
        for batch in batches:
            data = rest + b"".join(batch.column(0).to_pylist())
            count = len(data) // size
            rest = data[count * size :]
            fixed = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(size), count, [None, pa.py_buffer(data)]
            )
            yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary())], names=["record"])
        if rest:
            raise ValueError("a shard ends within a record")

    return rows


def read_shards(spark: SparkSession, shards: Shards, first_slot: int = 0) -> DataFrame:
    """``slot``, ``shard``, ``position`` (its record in the shard), ``sequence`` (its
    number before the permutation) and ``ids``, as bytes and without padding, of all
    sequences from ``first_slot`` on."""
    schema = "slot long, shard int, position long, ids binary"
    if not shards.sequences:
        return spark.createDataFrame([], f"{schema}, sequence long")
    first_shard = first_slot // shards.per_shard
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(shards.path)
        .withColumn("shard", F.regexp_extract("path", r"part-(\d+)", 1).cast("int"))
        .filter(F.col("shard") >= first_shard)
        .select("shard", "content")
    )
    per_shard, stride = shards.per_shard, shards.stride
    size, pad = shards.length * shards.width, pad_of(shards.width)
    kind = f"<u{shards.width}"

    def unpadded(record: bytes) -> bytes:
        # PAD stands at the end of the last sequence alone, and END before it.
        if record[-shards.width :] != pad.to_bytes(shards.width, "little"):
            return record
        last = np.flatnonzero(np.frombuffer(record, kind) != pad)[-1]
        return record[: (last + 1) * shards.width]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_buffer()
                if len(data) % stride:
                    raise ValueError(f"shard {shard} ends within a record")
                base = shard * per_shard
                start = max(0, first_slot - base)
                for at in range(start, len(data) // stride, 8192):
                    some = range(at, min(at + 8192, len(data) // stride))
                    ids = [
                        unpadded(data[p * stride : p * stride + size].to_pybytes())
                        for p in some
                    ]
                    places = np.arange(some.start, some.stop)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(base + places),
                            pa.array(np.full(len(some), shard, np.int32)),
                            pa.array(places),
                            pa.array(ids, pa.binary()),
                        ],
                        names=["slot", "shard", "position", "ids"],
                    )

    number = inverted(F.col("slot"), shards.sequences, shards.seed)
    return files.mapInArrow(rows, schema).withColumn("sequence", number)


def documents_of(spark: SparkSession, shards: Shards) -> DataFrame:
    """``sequence`` and ``doc_ids``: the ids of the texts that each sequence holds a part
    of, in order. There are at most ``length`` of them."""
    texts = spark.read.parquet(shards.documents)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    each = texts.select("doc", "n", "first", copy.alias("copy")).select(
        "doc", "n", (F.col("first") + F.col("copy") * F.col("n")).alias("first")
    )
    length = F.lit(shards.length).cast("long")
    start = F.call_function("div", F.col("first"), length)
    last = F.call_function("div", F.col("first") + F.col("n") - 1, length)
    return (
        each.select("first", "doc", F.explode(F.sequence(start, last)).alias("sequence"))
        .groupBy("sequence")
        .agg(F.sort_array(F.collect_list(F.struct("first", "doc"))).alias("held"))
        .select("sequence", F.col("held.doc").alias("doc_ids"))
    )
