import random
import re

import pytest
import xxhash
from llm_cases import TEXTS, documents, no_documents, prose
from pyspark.sql import functions as F

from wellgauge.llm import simhash
from wellgauge.llm.components import components


def brute_print(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    n = max(len(words) - shingle + 1, 1) if words else 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(n)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_as_by_definition(spark):
    texts = [t for _, t in TEXTS] + ["One", "one TWO", "ÀÉ B\x0bc d e f", prose(1), "a b c a b c a b c"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fp % 2**64 for r in simhash.fingerprints(table).collect()}
    assert got == {i: brute_print(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_all_links_within_the_radius_once(spark, radius):
    rnd = random.Random(radius)
    prints = {rnd.getrandbits(64) for _ in range(40)} | {0, 2**64 - 1}
    for fp in list(prints)[:25]:
        for _ in range(6):
            flipped = rnd.sample(range(64), rnd.randint(1, radius + 2))
            prints.add(fp ^ sum(1 << b for b in flipped))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = sorted(tuple(r) for r in simhash.fingerprint_links(table, radius).collect())
    want = sorted(
        (a, b)
        for a in signed
        for b in signed
        if a < b and ((a ^ b) % 2**64).bit_count() <= radius
    )
    assert got == want


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(60)], None])
def test_components(spark, links):
    if links is None:
        rnd = random.Random(4)
        links = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(60)]
    table = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(table).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == roots(nodes, [x for x in links if x[0] != x[1]])


def near_copies():
    base = prose(7, 3000).split()
    rows = [(i, prose(100 + i, 60)) for i in range(20)]
    for i in range(20, 60):
        words = list(base)
        words[random.Random(i).randrange(len(words))] = "other"
        rows.append((i, " ".join(words)))
    return rows


def test_near_duplicates_as_by_brute_force(spark):
    rows = near_copies()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()}
    prints = {i: brute_print(t) for i, t in rows}
    links = [
        (a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2
    ]
    assert got == roots(list(prints), links) and len(set(got.values())) < 40


def test_awkward_rows(spark):
    table = documents(spark)
    found = simhash.near_duplicates(table).collect()
    assert len(found) == table.count()
    empty = {r.component_id for r in found if r.fp == 0}
    assert empty == {1}  # NULL, empty and blank texts
    assert {r.component_id for r in found if r.doc_id in (5, 6)} == {5}


def test_one_row_of_each_group_stays_as_it_was(spark):
    table = documents(spark)
    kept = simhash.representatives(table)
    assert kept.columns == table.columns and kept.schema.simpleString() == table.schema.simpleString()
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "7", "8", "None"]
    assert kept.filter(F.col("`a.b`") != "own a.b").count() == 0


def test_no_rows(spark):
    assert simhash.near_duplicates(no_documents(spark)).collect() == []
    assert simhash.representatives(no_documents(spark)).collect() == []


def test_copies_make_no_pairs(spark):
    table = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"))
    found = simhash.near_duplicates(table)
    assert found.select("component_id").distinct().collect() == [(0,)]
