import zlib
from collections import Counter

import pytest
from llm_cases import documents, no_documents
from pyspark.sql import functions as F

from wellgauge.llm import feistel, sharding, token_shards
from wellgauge.llm.common import staged
from wellgauge.session import workspace


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 256, 1000, 4099])
def test_a_permutation_that_can_be_undone(spark, n):
    places = [feistel.permute(i, n, 7) for i in range(n)]
    assert sorted(places) == list(range(n))
    assert [feistel.invert(p, n, 7) for p in places] == list(range(n))
    rows = spark.range(n).select("id", feistel.permuted(F.col("id"), n, 7).alias("p"))
    rows = rows.withColumn("q", feistel.inverted(F.col("p"), n, 7)).collect()
    assert all(r.p == places[r.id] and r.q == r.id for r in rows)


def test_large_numbers_and_keys(spark):
    n = (1 << 60) - 12_345
    rows = spark.range(200).select((F.col("id") * (1 << 52)).alias("id"))
    rows = rows.select("id", feistel.permuted(F.col("id"), n, 3).alias("p")).collect()
    assert all(feistel.permute(r.id, n, 3) == r.p and feistel.invert(r.p, n, 3) == r.id for r in rows)
    assert feistel.permute(5, 1000, 1) != feistel.permute(5, 1000, 2)
    with pytest.raises(ValueError):
        feistel.grid(0)


def test_shards(spark):
    table = documents(spark).withColumn("shard", F.lit("replaced"))
    rows = sharding.shard_rows(table, ["doc_id", "text"], 3, seed=1, buckets=16)
    assert rows.columns == [*(c for c in table.columns if c != "shard"), "shard", "slot"]
    found = rows.collect()
    counts = Counter(r.shard for r in found)
    assert len(found) == table.count() and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))


def test_the_same_rows_in_another_order_go_to_the_same_place(spark):
    table = spark.range(1000).withColumn("crc", F.crc32(F.col("id").cast("string")))
    one = sharding.shard_rows(table, ["id"], 8, seed=5).collect()
    other = sharding.shard_rows(table.orderBy(F.desc("crc")).repartition(7), ["id"], 8, 5).collect()
    assert sorted(one) == sorted(other)
    numbers = {sharding.number_at(r.shard, r.slot, 1000, 8, 5) for r in one}
    assert numbers == set(range(1000))
    assert all(
        sharding.place_of(sharding.number_at(r.shard, r.slot, 1000, 8, 5), 1000, 8, 5)
        == (r.shard, r.slot)
        for r in one[:50]
    )


def test_more_shards_than_rows_and_no_rows(spark):
    one = sharding.shard_rows(spark.range(1), ["id"], 8, 5).collect()
    assert [tuple(r)[2] for r in one] == [0]
    assert sharding.shard_rows(no_documents(spark), ["doc_id"], 8, 5).collect() == []


def test_registered_sharding(spark):
    from wellgauge.llm.queries import op6_sharding

    d = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in op6_sharding(spark, d).collect()}
    for doc in spark.read.parquet(f"{d}/documents.parquet").collect():
        text = (doc.text or "").encode()
        row = found.pop(doc.doc_id)
        assert (row.size, row.text_crc32, row.law) == (len(text) + 1, zlib.crc32(text), "rows")
    assert not found


def read_back(spark, table, **options):
    shards = token_shards.write_shards(table, workspace(spark, "shards"), seed=9, **options)
    rows = token_shards.read_shards(spark, shards).orderBy("sequence").collect()
    assert [r.sequence for r in rows] == list(range(shards.sequences))
    assert sorted(r.slot for r in rows) == list(range(shards.sequences))
    for r in rows[:20]:
        assert shards.place(r.sequence) == (r.shard, r.position * shards.stride)
    return shards, b"".join(bytes(r.ids) for r in rows)


def test_texts_come_back_in_order(spark):
    table = staged(documents(spark).coalesce(1), "one-file")
    texts = [(r.text or "").encode() for r in table.collect()]
    shards, ids = read_back(spark, table, length=64, shard_bytes=10_000)
    assert ids == b"".join(t + b"\xff" for t in texts)
    assert shards.shards > 10


def test_texts_of_several_files_come_back(spark):
    table = staged(documents(spark).repartition(3), "three-files")
    want = sorted((r.text or "").encode() for r in table.collect())
    _, ids = read_back(spark, table)
    assert sorted(t.rstrip(b"\xfe") for t in ids.split(b"\xff")[:-1]) == want


def test_reading_goes_on_at_a_slot(spark):
    table = staged(documents(spark), "files")
    shards = token_shards.write_shards(
        table, workspace(spark, "shards"), seed=9, length=64, shard_bytes=10_000
    )
    every = {r.slot: r.ids for r in token_shards.read_shards(spark, shards).collect()}
    rest = {r.slot: r.ids for r in token_shards.read_shards(spark, shards, 500).collect()}
    assert rest == {s: ids for s, ids in every.items() if s >= 500}


def test_no_texts(spark):
    shards, ids = read_back(spark, staged(no_documents(spark), "none"))
    assert shards.sequences == 0 and ids == b""


def test_registered_token_shards(spark):
    import hashlib

    from wellgauge.llm.queries import op4_token_shards

    d = "/root/testdata/sf0.001"
    texts = [r.text.encode() for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    ids = b"".join(t + b"\xff" for t in texts)
    found = op4_token_shards(spark, d).collect()
    want = [hashlib.sha256(ids[i : i + 512]).hexdigest() for i in range(0, len(ids), 512)]
    assert [r.ids_sha256 for r in sorted(found, key=lambda r: r.sequence)] == want


def test_the_order_does_not_depend_on_files_or_splits(spark):
    """The same rows in one file or many, read in one split or many."""
    rows = documents(spark).unionAll(
        spark.range(500).select(
            (F.col("id") % 200).alias("doc_id"),  # repeated ids, some with the same text
            F.repeat(F.lit("some text "), (F.col("id") % 40).cast("int")).alias("text"),
            *[F.lit(None).alias(c) for c in documents(spark).columns[2:]],
        )
    )
    few = staged(rows.coalesce(1), "one-file")
    many = staged(rows.repartition(5, F.xxhash64("text")), "five-files")
    by_key, by_place = [], []
    for table, split in ((few, "128m"), (many, "128m"), (many, "2k")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            by_key.append(read_back(spark, table, length=64, by_id=True)[1])
            by_place.append(read_back(spark, table, length=64)[1])
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert by_key[0] == by_key[1] == by_key[2]
    assert by_place[1] == by_place[2]
    shuffled = read_back(spark, many, length=64, by_id=True, broadcast_rows=0)[1]
    assert shuffled == by_key[0]
    want = sorted((r.text or "").encode() for r in rows.collect())
    for ids in (by_key[0], *by_place):
        assert sorted(ids.split(b"\xff")[:-1]) == want


@pytest.mark.parametrize(("width", "greatest"), [(1, 253), (2, 65_533), (4, (1 << 31) - 1)])
def test_ids_of_a_vocabulary_come_back(spark, width, greatest):
    rows = [(1, [0, 10, greatest]), (2, None), (3, []), (0, list(range(200))), (3, [7] * 90), (3, [7] * 90)]
    table = staged(spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(2), "ids")
    shards, data = read_back(
        spark, table, length=16, shard_bytes=200, by_id=True, ids_column="ids", width=width
    )
    ids = [int.from_bytes(data[i : i + width], "little") for i in range(0, len(data), width)]
    end = token_shards.end_of(width)
    assert ids[:201] == [*range(200), end] and ids[201:205] == [0, 10, greatest, end]
    assert Counter(ids[205:]) == {7: 180, end: 4} and len(data) // width == 389
    held = token_shards.documents_of(spark, shards).orderBy("sequence").collect()
    assert [r.sequence for r in held] == list(range(shards.sequences))
    docs = [d for i, t in sorted(rows, key=lambda r: r[0]) for d in [i] * (len(t or []) + 1)]
    for r in held:
        assert list(dict.fromkeys(r.doc_ids)) == list(dict.fromkeys(docs[r.sequence * 16 :][:16]))


@pytest.mark.parametrize("bad", [254, 255, 256, -1, None])
def test_ids_that_do_not_fit_are_refused(spark, bad):
    table = staged(spark.createDataFrame([(1, [1, bad])], "doc_id long, ids array<int>"), "ids")
    with pytest.raises(Exception, match="does not fit 1 bytes"):
        token_shards.write_shards(table, workspace(spark, "shards"), 9, ids_column="ids")


def test_registered_bpe_shards(spark):
    import hashlib

    import numpy as np

    from wellgauge.llm import bpe
    from wellgauge.llm.queries import RANKS, op4_bpe_shards

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    docs.sort(key=lambda r: r.doc_id)
    ids, owners = [], []
    for doc in docs:
        made = bpe.codec(RANKS).encode([doc.text.encode()])[0].tolist() + [0xFFFF]
        ids += made
        owners += [doc.doc_id] * len(made)
    assert max(i for i in ids if i != 0xFFFF) > 255
    data = np.array(ids, "<u2").tobytes()
    want = [
        (hashlib.sha256(data[2 * i : 2 * i + 1024]).hexdigest(), list(dict.fromkeys(owners[i : i + 512])))
        for i in range(0, len(ids), 512)
    ]
    found = sorted(op4_bpe_shards(spark, d).collect(), key=lambda r: r.sequence)
    assert [(r.ids_sha256, r.doc_ids) for r in found] == want
    assert sum(r.n_ids for r in found) == len(ids)
