"""Classifiers without classes, bounded samples, written tables and the errors of the store."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from genoweave.llm import common, mixing, pii, queries, samples, sharding, simhash, toxicity

SMALL = Path("/root/testdata/sf0.001")
DOCS = "doc_id long, text string, key int, `a.b` int"


def test_toxicity_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "Fine words. " * 1000, 0, 0), (2, None, 0, 0), (3, "x", 0, 0), (None, "y", 0, 0), (3, "x", 0, 0)], DOCS)
    kind = "doc_id long, toxic int"
    for labels in ([], [(1, 0), (3, 0)], [(1, 1)], [(1, None), (None, 1), (3, 7)], [(1, 0), (3, 1)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, kind))
        assert model is None  # one class, or no feature that tells them apart
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == 5 and {r["score"] for r in rows} == {0.0} and {r["worst_start"] for r in rows} == {None}
    assert toxicity.score(docs.where("false"), None).count() == 0


def test_noisy_or_of_sentences_by_hand():
    import math

    model = toxicity.Model(-2.0, {"bad": 3.0, "^bad": 1.0, "word": 0.5})
    total, each = model.scorer()("A bad, bad word. Fine!\nBadly put. ")
    p = [1 / (1 + math.exp(-z)) for z in (-2 + 3 + 0.5 + 3, -2.0, -2 + 1)]  # "bad," and "bad" are two tokens; "badly" begins like bad
    assert [round(q, 12) for _, _, q in each] == [round(q, 12) for q in p]
    assert abs(total - (1 - math.prod(1 - q for q in p))) < 1e-12


def test_samples_are_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * (100 + i), i, 0) for i in range(60)] + [(5, "y" * 3000, 1, 0)] * 500 + [(6, None, 0, 0)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(6, 0)], "doc_id long, quality int")
    every = samples.labelled(docs, labels, "quality", 100)
    assert [r[0] for r in every] == list(range(60)) and [r[1] for r in every] == [i % 2 for i in range(60)]
    assert every[5][2] == "x" * 105 and every[6][2] is None  # the shortest of a key's texts
    some = samples.labelled(docs, labels, "quality", 100, most=1000)
    for y in (0, 1):
        assert 0 < sum(len(r[2] or "") for r in some if r[1] == y) <= 1000
    assert set(some) < set(every) and some == samples.labelled(docs.repartition(3), labels, "quality", 100, most=1000)
    assert samples.labelled(docs.where("false"), labels, "quality", 100) == []


@pytest.mark.skipif(not SMALL.is_dir(), reason="no tables here")
@pytest.mark.parametrize("name", ["op2_vantage_point", "op3_simhash", "op5_toxicity", "op6_packing", "op7_quality", "op10_personal_data", "op11_systematic", "op12_kd_filtering", "op13_range_finder"])
def test_nothing_but_results_is_left(spark, name):
    folder = Path(common.shared_dir(spark).removeprefix("file:")) / "genoweave"
    before = set(folder.iterdir()) if folder.exists() else set()
    found = queries.QUERIES[name](spark, str(SMALL))
    found.count()
    left = set(folder.iterdir()) - before if folder.exists() else set()
    read = {f.removeprefix("file:").removeprefix("//").rsplit("/", 1)[0] for f in found.inputFiles()}
    assert {str(p) for p in left} <= read and len(left) <= 1


def test_groups_leave_one_table(spark):
    folder = Path(common.shared_dir(spark).removeprefix("file:")) / "genoweave"
    docs = spark.createDataFrame([(1, "a b c d e f g", 0, 0), (2, "a b c d e f g", 0, 0), (3, "other", 0, 0)], DOCS)
    before = set(folder.iterdir()) if folder.exists() else set()
    assert sorted(r["component_id"] for r in simhash.near_duplicates(docs).collect()) == [1, 1, 3]
    assert len(set(folder.iterdir()) - before) == 1


def test_the_model_of_planted_texts_is_the_same_again(spark):
    assert pii.fit(spark) == pii.fitted(spark) and pii.fitted(spark) is pii.fitted(spark)


def test_the_store_tells_conflicts_from_other_errors(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", 0, 0)], DOCS)
    store = sharding.Store(spark, f"file://{tmp_path}/s", target=1 << 20, fanout=4)
    store.append(docs, F.lit(0), F.lit(1).cast("long"))
    with pytest.raises(sharding.Conflict):
        store.commit(store.entries(1), 0, docs.schema)

    class Other:
        """A file system on which the version is not there: the rename failed for another reason."""

        def __init__(self, fs):
            self.create, self.delete = fs.create, fs.delete

        def exists(self, _):
            return False

    store._fs = Other(store._fs)
    with pytest.raises(Exception) as e:
        store.commit(store.entries(1), 0, docs.schema)
    assert not isinstance(e.value, sharding.Conflict)


def test_mixing_targets_of_many_sources(spark):
    totals = spark.createDataFrame([(10 * (i + 1), float((5, 2, 1)[i % 3])) for i in range(50)], "source_size long, weight double")
    rows = mixing.targets(totals, 1.5, 2.0).collect()
    assert abs(sum(r["target"] for r in rows) - 1.5 * sum(r["source_size"] for r in rows)) < 1e-6
    level = max(r["target"] / r["weight"] for r in rows)
    assert all(abs(r["target"] - min(2 * r["source_size"], level * r["weight"])) < 1e-6 for r in rows)
