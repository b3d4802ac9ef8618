import random

import numpy as np
import pytest
from llm_cases import documents, no_documents, prose
from pyspark.sql import functions as F

from wellgauge.llm import toxicity as tx

LABELS = "doc_id long, toxic int"
MILD, HARSH = ["rude", "daftly", "sillier"], ["vilest", "hateful", "brutish"]


def graded(n, seed=0):
    """Texts whose grade shows in the marks they hold."""
    rows = []
    for i in range(n):
        rnd = random.Random(seed * 10_000 + i)
        words = prose(seed * 10_000 + i, rnd.randint(20, 120)).split()
        grade = rnd.choice([0, 0, 0, 1, 2])
        for _ in range(3 * (grade > 0)):
            words.insert(rnd.randrange(len(words)), rnd.choice(MILD if grade == 1 else HARSH + MILD))
        if grade == 2:
            words.insert(0, rnd.choice(HARSH))
        rows.append((i, " ".join(words), grade))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.createDataFrame(graded(600), "doc_id long, text string, toxic int")
    return tx.train(rows, rows.select("doc_id", "toxic"), "toxic")


def test_held_out_grades(spark, model):
    rows = spark.createDataFrame(graded(300, seed=1), "doc_id long, text string, toxic int")
    found = tx.score(rows, model).join(rows.select("doc_id", "toxic"), "doc_id").collect()
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    assert np.mean([r.grade == r.toxic for r in found]) > 0.9
    assert np.mean([(r.p_toxic > 0.5) == (r.toxic > 0) for r in found]) > 0.98
    by_grade = [np.mean([r.expected_severity for r in found if r.toxic == g]) for g in range(3)]
    assert by_grade[0] < 0.2 < 0.8 < by_grade[1] < by_grade[2]


def test_gradient_by_differences():
    rnd = np.random.default_rng(1)
    rows, columns = rnd.integers(0, 30, 90), rnd.integers(0, 8, 90)
    grades = np.concatenate([[0, 1, 2, 3], rnd.integers(0, 4, 26)])
    x = rnd.normal(size=8 + 3) * 0.5
    value, gradient = tx._loss(x, rows, columns, grades, 8, 3, 0.3)
    for i in range(len(x)):
        step = np.zeros(len(x))
        step[i] = 1e-6
        up = tx._loss(x + step, rows, columns, grades, 8, 3, 0.3)[0]
        down = tx._loss(x - step, rows, columns, grades, 8, 3, 0.3)[0]
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-4)


def test_probabilities_add_up(model):
    exceed = model.exceed(np.linspace(-20, 20, 9))
    assert (np.diff(exceed, axis=1) <= 0).all() and (exceed >= 0).all() and (exceed <= 1).all()


def test_awkward_rows(spark, model):
    table = documents(spark)
    found = tx.score(table, model).collect()
    assert len(found) == table.count()
    empty = {r.p_toxic for r in found if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and max(empty) < 0.5
    kept = tx.without_toxic(table, model)
    assert kept.schema.simpleString() == table.schema.simpleString()
    assert sorted(map(str, kept.collect())) == sorted(map(str, table.collect()))


def test_toxic_rows_go(spark, model):
    table = documents(spark, [(1, "a vilest hateful brutish thing"), (2, "w1 w2"), (None, "hateful, vilest, brutish")])
    assert [r.doc_id for r in tx.without_toxic(table, model).collect()] == [2]


def test_labels_with_gaps(spark):
    table = documents(spark)
    for rows in ([], [(1, None), (None, 1)], [(77, 1), (78, 0)], [(4, 0), (7, 0)], [(4, 1)]):
        labels = spark.createDataFrame(rows, LABELS)
        model = tx.train(table, labels, "toxic", split_yes=True)
        assert tx.without_toxic(table, model).count() == table.count()


def test_no_rows(spark, model):
    assert tx.score(no_documents(spark), model).collect() == []
    trained = tx.train(no_documents(spark), spark.createDataFrame([(1, 1)], LABELS), "toxic")
    assert trained.weights == {}


def test_all_telling_features_take_part(spark):
    """However many there are."""
    many = " ".join(f"z{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(9_000))
    rows = [(i, many if i % 3 == 0 else prose(i), int(i % 3 == 0)) for i in range(45)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tx.train(table, table.select("doc_id", "toxic"), "toxic")
    assert len(model.weights) >= 9_000
    few = tx.train(table, table.select("doc_id", "toxic"), "toxic", min_texts=16)
    assert few.weights == {} or len(few.weights) < 9_000


def test_a_bounded_sample_is_taken(spark):
    rows = spark.createDataFrame(graded(200), "doc_id long, text string, toxic int")
    doubled = rows.unionAll(rows)
    one = tx.train(doubled, rows, "toxic", max_labelled=100)
    assert one == tx.train(rows, rows.unionAll(rows), "toxic", max_labelled=100)


def test_registered_labels_held_out(spark):
    from wellgauge.llm.queries import _table

    # The smaller tables hold out 15 toxic texts of 96, too few to judge by.
    d = "/root/testdata/sf0.1"
    documents, labels = _table(spark, d, "documents"), _table(spark, d, "labels")
    fitted = labels.filter(F.xxhash64("doc_id") % 4 != 0)
    model = tx.train(documents, fitted, "toxic", split_yes=True)
    rest = labels.join(fitted.select("doc_id"), "doc_id", "left_anti")
    found = tx.score(documents, model).join(rest, "doc_id").collect()
    right = np.mean([(r.p_toxic > 0.5) == (r.toxic == 1) for r in found])
    clean = [r.p_toxic > 0.5 for r in found if not r.toxic]
    assert right > 0.93 and sum(clean) <= 0.01 * len(clean)


def held_out(spark, d, fold):
    """Whether toxic and clean texts of every fourth label were taken as toxic."""
    documents = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    fitted = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)) != fold)
    model = tx.train(documents, fitted, "toxic", split_yes=True)
    rest = labels.join(fitted.select("doc_id"), "doc_id", "left_anti")
    found = tx.score(documents, model).join(rest, "doc_id").collect()
    return [[r.p_toxic > 0.5 for r in found if r.toxic == toxic] for toxic in (1, 0)]


def test_toxic_texts_held_out_are_found(spark):
    toxic, clean = held_out(spark, "/root/testdata/sf0.1", 0)
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_toxic_texts_held_out_of_few_labels_are_found(spark):
    folds = [held_out(spark, "/root/testdata/sf0.01", fold) for fold in range(4)]
    toxic, clean = (sum(parts, []) for parts in zip(*folds, strict=True))
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.02 * len(clean)
