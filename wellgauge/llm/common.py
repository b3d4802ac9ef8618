"""What several operators share: staged tables, row numbers, bounded Arrow slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from wellgauge.session import workspace

SLICE_BYTES = 4 << 20


def staged(table: DataFrame, purpose: str) -> DataFrame:
    """The table, written to the cluster's shared folder and read again.

    Cuts the lineage at a point that outlives executors, so that nothing above is
    computed twice or lost with one of them.
    """
    spark: SparkSession = table.sparkSession
    path = workspace(spark, purpose)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text at most; a text
    that is longer gets a batch of its own."""
    for batch in batches:
        values = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start)


def changed_rows(
    docs: DataFrame,
    change: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """The rows that ``change`` makes of those it is given, with the same columns.
    Rows travel as one struct, so columns may have any name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = (pa.RecordBatch.from_struct_array(batch.column(0)) for batch in batches)
        for batch in change(whole):
            yield pa.RecordBatch.from_arrays([batch.to_struct_array()], names=["row"])

    schema = StructType([StructField("row", docs.schema, False)])
    return docs.select(F.struct("*").alias("row")).mapInArrow(run, schema).select("row.*")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of each text; NULL counts as empty."""
    values = batch.column(column).cast(pa.large_binary())
    return [v or b"" for v in values.to_pylist()]


def columns_of(table: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col(quoted(name)) for name in table.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(table: DataFrame, name: str) -> str:
    """A name that no column of the table has."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(
    table: DataFrame, bucket: Column, order: Sequence[Column], buckets: int
) -> DataFrame:
    """``row``, a struct of all columns, and ``number``: its place from 0 without gaps,
    ordered by bucket, then ``order`` (NULL first).

    Buckets (0 to ``buckets - 1``) are counted first and numbered from the running
    total of those before, so rows are sorted within their bucket only and never
    meet in one task. The running totals are ``buckets`` rows, a fixed bound. Rows
    that agree in everything are numbered in any order among themselves.
    """
    rows = table.select(
        F.struct("*").alias("row"),
        bucket.cast("int").alias("bucket"),
        F.struct(*order).alias("key"),
    )
    counts = table.groupBy(bucket.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    bases = running_totals(counts, "bucket", "n", "base")
    within = F.row_number().over(Window.partitionBy("bucket").orderBy("key"))
    return (
        rows.select("row", "bucket", within.alias("within"))
        .join(F.broadcast(bases), "bucket")
        .select("row", (F.col("base") + F.col("within") - 1).alias("number"))
    )


def running_totals(counts: DataFrame, key: str, count: str, name: str) -> DataFrame:
    """Key and the total of the counts of all smaller keys. For a table of few rows:
    one task orders them."""
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(key, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(name))
