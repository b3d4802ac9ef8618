import hashlib
import random
import re
import zlib

import pytest
from llm_cases import TEXTS, documents, no_documents
from pyspark.sql import functions as F

from wellgauge.llm import periodic, queries


def brute(words, min_length=12):
    """All runs by trying every period on every pair of words."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(min_length, 2 * q) and not any(
                a <= start and i <= a + size and q % p == 0 for a, size, p in found
            ):
                found.append((start, i - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def a_text(rnd):
    letters = "abcd"[: rnd.choice([1, 2, 2, 3, 4])]
    n, words = rnd.randint(0, 70), []
    if rnd.random() < 0.4:
        return [rnd.choice(letters).encode() for _ in range(n)]
    while len(words) < n:
        root = [rnd.choice(letters) for _ in range(rnd.randint(1, 14))]
        words += root * rnd.randint(1, 5) + root[: rnd.randint(0, len(root))]
    return [w.encode() for w in words]


@pytest.mark.parametrize("min_length", [12, 1, 5, 20])
def test_runs_as_by_brute_force(min_length):
    rnd = random.Random(min_length)
    seen = 0
    for _ in range(400):
        texts = [a_text(rnd) for _ in range(rnd.randint(1, 4))]
        want = [brute(t, min_length) for t in texts]
        assert periodic.runs_of(texts, min_length) == want
        seen += sum(map(len, want))
    assert seen > 400


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return [c.encode() for c in b[:n]]


def test_many_overlapping_runs():
    text = fibonacci(600)
    assert periodic.runs_of([text]) == [brute(text)]
    there_and_back = [b"a", b"b"] * 100 + [b"b", b"a"] * 100
    assert periodic.runs_of([there_and_back]) == [brute(there_and_back)]


def test_long_repetitions_need_few_lags():
    """One word over and over, and many copies of a line, in texts of 200,000 words."""
    assert periodic.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    lines = [w for i in range(20_000) for w in (b"%d" % i, *b"a b c d e f g h i".split())]
    assert periodic.runs_of([lines]) == [[]]
    openings = list(periodic._openings([[b"a", b"b", b"c"] * 40_000], 12))
    assert len(openings) < 200_000


def contract_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def contract_row(doc_id, text):
    words = contract_words(doc_id, text)
    runs = brute(words)
    inside = {i for s, size, q in runs for i in range(s + q, s + size)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in inside)
    return (
        doc_id,
        len(runs),
        *top,
        None if top[0] is None else 1000 * top[1] // top[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query_as_by_brute_force(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i, " ".join(w.decode() for w in a_text(rnd))) for i in range(150)]
    rows += [(i, " ".join(f"w{rnd.randrange(50)}" for _ in range(120))) for i in range(150, 400)]
    # The long text in the shared fixture has periods of 977 words; trying all takes long.
    rows += [r for r in TEXTS if len(r[1] or "") < 1000] + [(8, " ".join("a" * 40))]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = sorted((contract_row(i, t) for i, t in rows), key=str)
    assert got == want and sum(r[1] for r in want) > 100


def test_awkward_rows(spark):
    table = documents(spark).withColumn("runs", F.lit("own"))
    found = periodic.find_runs(table)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_words, by_id[1].runs, by_id[1].collapsed) == (0, [], "")
    assert by_id[2].collapsed == by_id[3].collapsed == ""
    assert [tuple(r) for r in by_id[4].runs] == [(0, 40_000, 977)]
    assert len(by_id[4].collapsed.split()) == 977
    assert len([r for r in rows if r.doc_id == 5]) == 2 and by_id[8].n_words == 1


def test_no_rows(spark):
    assert periodic.find_runs(no_documents(spark)).collect() == []


def test_invalid_bytes_stay_in_their_row(spark):
    bad = spark.sql("select 1L as doc_id, cast(X'FF2061FF' as string) as text")
    good = spark.createDataFrame([(2, "x y " * 8)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic.find_runs(bad.unionAll(good)).collect()}
    assert got[1].n_words == 2 and [tuple(r) for r in got[2].runs] == [(0, 16, 2)]
    assert got[2].collapsed == "x y"
