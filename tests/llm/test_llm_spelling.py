import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import TEXTS, documents, no_documents
from pyspark.sql import functions as F

from wellgauge.llm import queries, spelling

RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def one_edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]


def brute(counts, ratio=5):
    """Word -> (form, root, n, n_near, form_n), by trying every edit."""
    letters = sorted({c for w in counts for c in w})
    found, forms = {}, {}
    for word, n in counts.items():
        others = {o for o in one_edits(word, letters) if o != word and o in counts}
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] < ratio * n:
            best = None
        forms[word] = best
        found[word] = (best, len(others), counts[best] if best else None)
    out = {}
    for word, (form, n_near, form_n) in found.items():
        root = word
        while forms[root]:
            root = forms[root]
        out[word] = (form, root, counts[word], n_near, form_n)
    return out


def result(table):
    rows = table.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def a_vocabulary(seed, size=900):
    """Few letters, many neighbours and anagrams, ties of counts, and chains of forms."""
    rnd = random.Random(seed)
    words = {}
    while len(words) < size:
        word = "".join(rnd.choice("abcéÿ") for _ in range(rnd.randint(6, 9)))
        words[word] = rnd.choice([5, 5, 6, 25, 30, 150, 5**6])
    for k in range(6):
        words["chain" + "x" * k + "ed"] = 5 ** (k + 1)
    words["q" * 4000], words["q" * 3999] = 7, 70
    return words


@pytest.mark.parametrize("cell_words, sample", [(8192, 200_000), (40, 200_000), (30, 100)])
def test_as_by_trying_every_edit(spark, cell_words, sample):
    counts = a_vocabulary(cell_words)
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = result(spelling.variants(table, 5, cell_words, sample))
    assert got == brute(counts)
    assert got["chained"][1] == "chain" + "x" * 5 + "ed"


def test_one_edit_agrees_with_its_definition():
    rnd = random.Random(1)
    for n in (1, 2, 6):
        a = ["".join(rnd.choice("ab") for _ in range(n)) for _ in range(400)]
        for m in (n, n + 1):
            b = ["".join(rnd.choice("ab") for _ in range(m)) for _ in range(400)]
            got = spelling.one_edit(spelling.points_of(a), spelling.points_of(b))
            assert got.tolist() == [near(x, y) for x, y in zip(a, b, strict=True)]


def test_trees_lose_no_near_vector_and_prune():
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefghijklmnopqrst", k=8)) for _ in range(4000)]
    vectors = spelling.marks(spelling.points_of(words))
    tree = spelling.Tree.grown(vectors, 32, tight=True)
    met, visited = set(), 0
    for node, rows in tree.reached(vectors[:200], 1, 1):
        visited += len(rows) * len(tree.members[node])
        met |= {(i, j) for i in rows.tolist() for j in tree.members[node].tolist()}
    for i in range(200):
        need = np.bitwise_count(vectors & ~vectors[i]).sum(axis=1)
        spare = np.bitwise_count(vectors[i] & ~vectors).sum(axis=1)
        assert {(i, j) for j in np.flatnonzero((need <= 1) & (spare <= 1)).tolist()} <= met
    assert visited < 0.25 * 200 * 4000
    places = tree.home(vectors)
    assert all(i in tree.members[p] for i, p in enumerate(places.tolist()))


def contract_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in RUNS.findall(text or ""):
            word = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def stored(table, folder, name="documents"):
    table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_query_as_by_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    words = ["thingér", "thinger", "thingers", "Thinger", "THINGÉR", "÷×øœ", "naïvely", "naively"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(60))) for i in range(200)]
    rows += TEXTS
    want = brute(contract_counts(rows))
    got = result(queries.op11_spelling(spark, stored(documents(spark, rows), tmp_path)))
    assert got == want and any(w[0] for w in want.values())


def test_query_on_given_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert result(queries.op11_spelling(spark, sf_dir)) == brute(contract_counts(docs))


def test_repeats_count_and_other_columns_do_not_matter(spark):
    table = documents(spark).select("*", F.lit("x").alias("_word"), F.lit("y").alias("n"))
    got = {r.word: r.n for r in spelling.word_counts(table).collect()}
    assert got["word"] == 40_000 and got["same"] == 3 and got["a" * 30_000] == 1


def test_no_words(spark, tmp_path):
    assert result(queries.op11_spelling(spark, stored(no_documents(spark), tmp_path))) == {}
    only = documents(spark, [(1, None), (2, ""), (3, "1 2 3")])
    assert spelling.word_counts(only).collect() == []


def test_invalid_bytes_stay_in_their_row(spark):
    bad = spark.sql("select 1L as doc_id, cast(X'66666EFF8061626364' as string) as text")
    good = spark.createDataFrame([(2, "plain wording here")], "doc_id long, text string")
    got = {r.word for r in spelling.word_counts(bad.unionAll(good)).collect()}
    assert {"plain", "wording", "here"} <= got
