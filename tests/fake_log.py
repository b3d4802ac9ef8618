"""A message log that answers with the options it was opened with.

Stands in for a broker: it shows which options reach the reader, and it can be
told to fail.
"""

import json

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    InputPartition,
    SimpleDataSourceStreamReader,
)

SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)


def _row(options):
    text = json.dumps({"name": "options", "payload": json.dumps(dict(options))})
    return (b"k", text.encode(), "t", 0, 0, None, 0)


class FakeLog(DataSource):
    @classmethod
    def name(cls):
        return "fake_log"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Batch(self.options)

    def simpleStreamReader(self, schema):
        return _Stream(self.options)


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        yield _row(self.options)


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)

    def initialOffset(self):
        return {"at": 0}

    def read(self, start):
        if self.options.get("fail") == "true":
            raise RuntimeError("the log is gone")
        if start["at"]:
            return iter([]), start
        return iter([_row(self.options)]), {"at": 1}

    def readBetweenOffsets(self, start, end):
        return iter([_row(self.options)] if start["at"] < end["at"] else [])

    def commit(self, end):
        pass
