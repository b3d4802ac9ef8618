"""Reports on what the job reads: counts, rejects and payload types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellgauge.operators.decode import number_of


def partition_counts(table: DataFrame, stage: str) -> DataFrame:
    """Rows per physical partition, stamped and marked with the stage."""
    return (
        table.groupBy(F.spark_partition_id().alias("partition_id"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("@timestamp", F.current_timestamp().cast("string"))
        .withColumn("stage", F.lit(stage))
    )


def reject_counts(raw: DataFrame) -> DataFrame:
    """Messages per name, and how many carry a payload that gives no number."""
    return count_rejected(rejections(raw))


def rejections(raw: DataFrame) -> DataFrame:
    """Name of each message, and whether its payload gives no number."""
    return raw.select("name", payload_rejected(F.col("payload")).alias("is_rejected"))


def payload_rejected(payload: Column) -> Column:
    """Whether there is a payload and it gives no number."""
    return payload.isNotNull() & number_of(payload).isNull()


def count_rejected(marked: DataFrame) -> DataFrame:
    return marked.groupBy("name").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if("is_rejected").alias("rejected"),
    )


def payload_profile(raw: DataFrame) -> DataFrame:
    """Which fields the payloads hold, and the type their values agree on.

    One row per field: how many values are of each JSON kind, and the type that
    JSON schema inference would settle on. A field that a payload repeats counts
    once, with its last value, as decoding takes it. A row with a NULL field counts the
    payloads that hold no field at all: missing, malformed, empty or no object.
    """
    entries = F.map_entries(F.from_json("payload", "map<string, variant>"))
    values = raw.select(F.explode_outer(_last_of_each_key(entries)).alias("entry")).select(
        F.col("entry.key").alias("field"),
        _outer_type(F.schema_of_variant("entry.value")).alias("type"),
    )

    # Types are few: count them first, then look at each only once.
    types = values.groupBy("field", "type").agg(F.count(F.lit(1)).alias("n"))
    kinds = types.select("field", "n", _kind(F.col("type")).alias("kind"))
    counted = kinds.groupBy("field").agg(
        F.sum("n").alias("messages"),
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(column)
            for kind, column in _KINDS.items()
        ],
    )
    return counted.withColumn("inferred_type", _settled_type())


_KINDS = {
    "BIGINT": "integers",
    "DECIMAL": "big_integers",
    "DOUBLE": "fractions",
    "BOOLEAN": "booleans",
    "STRING": "texts",
    "STRUCT": "objects",
    "ARRAY": "arrays",
}


def _last_of_each_key(entries: Column) -> Column:
    """Entries that no later one repeats; NULL stays NULL.

    The entries are bound to a name first, or Spark would parse a payload again for each
    mention. Keys are sorted with their places, so that the last of a key stands before
    another one.
    """

    def last(entries: Column) -> Column:
        keys = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"], i.alias("at"))))

        def kept(keys: Column) -> Column:
            ends = F.filter(keys, lambda k, i: ~F.get(keys, i + 1)["key"].eqNullSafe(k["key"]))
            return F.transform(ends, lambda k: F.get(entries, k["at"]))

        return _bound(keys, kept)

    return _bound(entries, last)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is mentioned."""
    return F.transform(F.array(value), use)[0]


def _outer_type(variant_type: Column) -> Column:
    """The type without what is nested in it."""
    return F.substring_index(variant_type, "<", 1)


def _kind(variant_type: Column) -> Column:
    """JSON kind of a value; NULL for JSON null and for a missing field."""
    decimal = r"^DECIMAL\((\d+),(\d+)\)$"
    digits = F.regexp_extract(variant_type, decimal, 1).try_cast("int")
    scale = F.regexp_extract(variant_type, decimal, 2).try_cast("int")
    return (
        F.when(variant_type == "VOID", F.lit(None))
        # 6.0 arrives as a decimal without fraction digits; what does not fit
        # a BIGINT was written as an integer.
        .when((scale == 0) & (digits > 18), "DECIMAL")
        .when(variant_type.startswith("DECIMAL"), "DOUBLE")
        .when(variant_type == "OBJECT", "STRUCT")
        .otherwise(variant_type)
    )


def _settled_type() -> Column:
    seen = {kind: F.col(column) > 0 for kind, column in _KINDS.items()}
    numeric = ("BIGINT", "DECIMAL", "DOUBLE")
    n_other = sum(F.when(seen[k], 1).otherwise(0) for k in _KINDS if k not in numeric)
    any_number = seen["BIGINT"] | seen["DECIMAL"] | seen["DOUBLE"]
    n_kinds = n_other + F.when(any_number, 1).otherwise(0)
    return (
        F.when(F.col("field").isNull(), F.lit(None))
        .when(n_kinds != 1, "STRING")  # mixed kinds, or nothing but nulls
        .when(seen["DOUBLE"], "DOUBLE")
        .when(seen["DECIMAL"], "DECIMAL")
        .when(seen["BIGINT"], "BIGINT")
        .when(seen["BOOLEAN"], "BOOLEAN")
        .when(seen["STRUCT"], "STRUCT")
        .when(seen["ARRAY"], "ARRAY")
        .otherwise("STRING")
    )
