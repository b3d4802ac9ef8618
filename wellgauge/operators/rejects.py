"""Messages that decoding makes nothing of, kept as they came.

Landing keeps a row for every message, but of a message that gives none of the envelope
fields the row is all NULL and the content is gone. These functions keep it, byte for
byte, with its place in the log and the reason. All work on batch and on streaming
DataFrames, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellgauge.functions import text
from wellgauge.operators.decode import decoded
from wellgauge.schemas import ENVELOPE, MESSAGE_LOG, REJECTS

NO_VALUE = "no value"
BLANK = "blank"
NO_JSON = "no JSON"
NO_FIELD = "an object without a known field"
JSON_ARRAY = "an array"
JSON_VALUE = "a value without fields"


def undecoded(messages: DataFrame) -> DataFrame:
    """The messages whose envelope is all NULL, with the ``reason``. Log columns that the
    messages do not have are NULL."""
    lost = messages.filter(_nothing(decoded("value")))
    held = set(lost.columns)
    columns = [
        (F.col(f.name) if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in MESSAGE_LOG.fields
    ]
    return lost.select(*columns, reject_reason(text("value")).alias("reason")).select(*REJECTS.names)


def _nothing(envelope: Column) -> Column:
    return F.coalesce(*[envelope[f"{name}"] for name in ENVELOPE.names]).isNull()


def reject_reason(value: Column) -> Column:
    """Why a text gives no envelope field."""
    # One parse: its type is bound once and looked at several times.
    kinds = F.array(F.schema_of_variant(F.try_parse_json(value)))

    def named(kind: Column) -> Column:
        return (
            F.when(kind.isNull(), NO_JSON)
            .when(kind.startswith("OBJECT"), NO_FIELD)
            .when(kind.startswith("ARRAY"), JSON_ARRAY)
            .otherwise(JSON_VALUE)
        )

    return (
        F.when(value.isNull(), NO_VALUE)
        .when(~value.rlike(r"\S"), BLANK)
        .otherwise(F.transform(kinds, named)[0])
    )
