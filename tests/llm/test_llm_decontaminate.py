import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, no_documents, prose
from pyspark.sql import DataFrameWriter

from wellgauge.llm import decontaminate as dc

ITEMS = "item_id long, text string"


def brute(texts, items, shingle=5, least=0.8):
    found = set()
    for doc, text in texts:
        words = dc.words(text or "")
        for item, wanted in items:
            own = dc.words(wanted or "")
            if not own or not words:
                continue
            k = min(shingle, len(own))
            bag = Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
            width = min(len(own), len(words)) - k + 1
            best = 0.0
            for i in range(len(words) - k + 1 - width + 1) if width > 0 else ():
                window = Counter(tuple(words[j : j + k]) for j in range(i, i + width))
                shared = (window & bag).total()
                best = max(best, shared / (width + bag.total() - shared))
            if best >= least - 1e-12:
                found.add((doc, item, round(best, 9)))
    return found


def altered(text, seed):
    rnd = random.Random(seed)
    words = text.split()
    at = rnd.randrange(len(words))
    change = rnd.randrange(5)
    if change == 0:
        words[at] = "changed"
    elif change == 1:
        del words[at]
    elif change == 2:
        words.insert(at, "added")
    elif change == 3:
        words = words[: -rnd.randint(1, 6)]
    return " ".join(words).upper() if seed % 2 else ", ".join(words)


@pytest.fixture(scope="module")
def cases():
    items = [(i, prose(i, 10 + 3 * i, 60)) for i in range(25)]
    items += [(100, "short one"), (101, "Word"), (102, None), (103, ""), (104, items[3][1]), (105, "!?")]
    texts = [(i, prose(1000 + i, 150)) for i in range(30)]
    for i in range(120):
        rnd = random.Random(i)
        item = items[rnd.randrange(25)][1]
        texts.append((100 + i, f"{prose(i, rnd.randrange(60))} {altered(item, i)} {prose(i + 1, 40)}"))
    texts += [(900, "a short ONE here"), (901, "word"), (902, None), (903, ""), (904, items[20][1][:-9])]
    return texts, items


def test_all_contaminations_and_no_others(spark, cases):
    texts, items = cases
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = dc.contaminations(docs, spark.createDataFrame(items, ITEMS)).collect()
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in found}
    assert got == brute(texts, items) and len(got) == len(found) > 60


def test_blocks_of_items_give_the_same(spark, cases):
    texts, items = cases
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame(items, ITEMS)
    whole = dc.contaminations(docs, items).collect()
    blocks = dc.contaminations(docs, items, block_bytes=1500).collect()
    assert sorted(whole) == sorted(blocks)
    clean = {r.doc_id for r in dc.without_contaminated(docs, items, block_bytes=1500).collect()}
    assert clean == {i for i, _ in texts} - {r.doc_id for r in whole}


def test_spans_hold_the_passage(spark):
    text = f"İ {prose(1)} The QUICK, brown fox jumps over the lazy dog. {prose(2)}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(9, "the quick brown fox jumps over the lazy dog")], ITEMS)
    row = dc.contaminations(docs, items).first()
    assert text[row.start : row.end] == "The QUICK, brown fox jumps over the lazy dog"
    assert row.similarity == 1.0


def test_every_fingerprint_within_the_radius_is_found():
    items = [(i, prose(i, 30)) for i in range(40)]
    index = dc.Index(items, 5, 0.8, radius=24)
    members = index.sizes[30]
    rnd = random.Random(1)
    for _ in range(300):
        window = index.prints[rnd.randrange(40)].copy()
        for bit in rnd.sample(range(64), rnd.randint(0, 40)):
            window[bit // 8] ^= 1 << (bit % 8)
        apart = [sum(int(a ^ b).bit_count() for a, b in zip(p, window, strict=True)) for p in index.prints]
        assert members.within(window, index) == [i for i, d in enumerate(apart) if d <= 24]


def test_few_random_fingerprints_get_through():
    index = dc.Index([(i, prose(i, 30)) for i in range(200)], 5, 0.8, radius=19)
    members, rng = index.sizes[30], np.random.default_rng(2)
    windows = rng.integers(0, 256, size=(400, 8), dtype=np.uint8)
    passed = sum(len(members.candidates(w)) for w in windows)
    assert passed <= 0.15 * 400 * 200


def every_match(texts, items, shingle=5, similarity=0.8):
    """All documents and items: the best window by its exact similarity, from the places
    at which a document has shingles of the item."""
    found = set()
    split = [(i, dc.words(t or "")) for i, t in texts]
    places = []
    for _, tokens in split:
        at = {}
        for k in {shingle, *(len(w) for _, t in items if 0 < len(w := dc.words(t)) < shingle)}:
            for p in range(len(tokens) - k + 1):
                at.setdefault(tuple(tokens[p : p + k]), []).append(p)
        places.append(at)
    for item, text in items:
        own = dc.words(text)
        k = min(shingle, len(own))
        bag = Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1)) if own else Counter()
        for (doc, tokens), at in zip(split, places, strict=True):
            hits = sorted((p, s) for s in bag for p in at.get(s, ()))
            width = min(len(own), len(tokens)) - k + 1
            best = 0
            for start in {s for p, _ in hits for s in range(max(0, p - width + 1), p + 1)}:
                if start + width + k - 1 > len(tokens):
                    continue
                low = bisect_left(hits, (start,))
                inside = Counter(s for _, s in hits[low : bisect_left(hits, (start + width,))])
                shared = (inside & bag).total()
                best = max(best, shared / (width + bag.total() - shared))
            if hits and best >= similarity - 1e-12:
                found.add((doc, item, round(best, 9)))
    return found


def test_registered_query_by_brute_force_over_all_documents(spark):
    from wellgauge.llm.queries import op7_decontaminate

    d = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in op7_decontaminate(spark, d).collect()}
    assert got == every_match(texts, items) and got


def test_one_block_of_the_benchmark_is_held_at_a_time(spark, cases, monkeypatch):
    """Twelve blocks: what one has found is stored before the next one is read."""
    texts, items = cases
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    table = spark.createDataFrame(items, ITEMS)
    items = [(i, t) for i, t in items if t is not None]
    size = sum(len(t.encode()) for _, t in items)
    read, stored = [], []
    finder, parquet = dc._finder, DataFrameWriter.parquet

    def block(held, *rest):
        read.append(len(held))
        assert len(stored) == len(read) - 1
        return finder(held, *rest)

    def written(self, path, *rest, **options):
        parquet(self, path, *rest, **options)
        stored.append(path)

    with monkeypatch.context() as patch:
        patch.setattr(dc, "_finder", block)
        patch.setattr(DataFrameWriter, "parquet", written)
        found = dc.contaminations(docs, table, block_bytes=-(-size // 12))
    assert len(read) == 12 and sum(read) == len(items)
    assert sorted(found.collect()) == sorted(dc.contaminations(docs, table).collect())


def test_awkward_rows(spark):
    table = documents(spark)
    items = spark.createDataFrame(
        [(1, "the same words twice over, in two rows of one id"), (2, None)], ITEMS
    )
    kept = dc.without_contaminated(table, items)
    assert kept.schema.simpleString() == table.schema.simpleString()
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "7", "8", "None", "None"]
    assert [r.doc_id for r in dc.contaminations(table, items).orderBy("doc_id").collect()] == [5, 5, 6]


def test_no_rows(spark):
    none, items = no_documents(spark), spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    assert dc.contaminations(none, items).collect() == []
    assert dc.contaminations(documents(spark), items.limit(0)).collect() == []
    assert dc.without_contaminated(documents(spark), items.limit(0)).count() == documents(spark).count()


def test_registered_query_by_brute_force(spark):
    from wellgauge.llm.queries import op7_decontaminate

    d = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    shared = {s for _, t in items for s in [dc.words(t)[:5] and tuple(dc.words(t)[2:7])]}
    near = [(i, t) for i, t in texts if any(" ".join(s) in " ".join(dc.words(t)) for s in shared if s)]
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in op7_decontaminate(spark, d).collect()}
    assert got == brute(near, items)
