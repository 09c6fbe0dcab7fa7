"""Gold counts merged from signed changes against the full recompute."""

from __future__ import annotations

import random

from talentflow.operators import views
from talentflow.plans import gold
from talentflow.schemas import SILVER
from talentflow.sources import tables


def posting(key, company, source, technologies):
    return (key, company, "title", None, None, None, None, technologies, source, None, None)


def batch_of(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def same_as_recompute(spark, silver, root):
    table = tables.read_silver(spark, silver)
    assert content(gold.active_companies(spark, silver, root)) == content(views.active_companies(table, ordered=False))
    assert content(gold.tech_trends(spark, silver, root)) == content(views.tech_trends(table, ordered=False))


def test_inserts_and_replacements_equal_the_recompute(spark, tmp_dir):
    silver, root = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    rng = random.Random(11)
    names = ["Spark", "SQL", "Kafka", None]
    for _ in range(4):
        keys = rng.sample(range(60), 25)
        rows = [
            posting(f"k{k}", f"c{rng.randrange(4)}", f"s{rng.randrange(3)}", rng.choice([None, [], rng.choices(names, k=3)]))
            for k in keys
        ]
        assert gold.upsert_and_count(batch_of(spark, rows), silver, root) == 25
        assert all(
            gold._stored(spark, gold.counts_path(root, name), gold._version(spark, silver)) is not None for name in gold.COUNTS
        )
        same_as_recompute(spark, silver, root)


def test_a_group_that_empties_disappears(spark, tmp_dir):
    silver, root = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    gold.upsert_and_count(batch_of(spark, [posting("a", "old", "x", ["SQL"]), posting("b", "new", "x", None)]), silver, root)
    gold.upsert_and_count(batch_of(spark, [posting("a", "new", "y", ["Git"])]), silver, root)
    assert content(gold.active_companies(spark, silver, root)) == [("new", 2, 2)]
    assert content(gold.tech_trends(spark, silver, root)) == [("Git", 1)]


def test_only_changes_are_counted(spark, tmp_dir, monkeypatch):
    silver, root = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    gold.upsert_and_count(batch_of(spark, [posting(f"k{i}", "c", "s", ["SQL"]) for i in range(20)]), silver, root)

    def never(*_):
        raise AssertionError("counted Silver anew")

    monkeypatch.setattr(gold, "_all_rows", never)
    gold.upsert_and_count(batch_of(spark, [posting("k3", "d", "s", ["SQL", "Git"])]), silver, root)
    assert content(gold.active_companies(spark, silver, root)) == [("c", 19, 1), ("d", 1, 1)]
    assert content(gold.tech_trends(spark, silver, root)) == [("Git", 1), ("SQL", 20)]


def test_counts_of_another_version_are_not_used(spark, tmp_dir):
    silver, root = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    gold.upsert_and_count(batch_of(spark, [posting("a", "c", "s", ["SQL"])]), silver, root)
    tables.upsert_snapshot(batch_of(spark, [posting("b", "c", "t", ["Git"])]), silver)  # not counted, as if the job had died
    same_as_recompute(spark, silver, root)
    gold.upsert_and_count(batch_of(spark, [posting("b", "d", "t", None)]), silver, root)
    same_as_recompute(spark, silver, root)


def test_an_empty_batch_changes_nothing(spark, tmp_dir):
    silver, root = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    assert gold.upsert_and_count(batch_of(spark, []), silver, root) == 0
    assert tables.read_silver(spark, silver) is None
    gold.upsert_and_count(batch_of(spark, [posting("a", "c", "s", ["SQL"])]), silver, root)
    assert gold.upsert_and_count(batch_of(spark, []), silver, root) == 0
    same_as_recompute(spark, silver, root)
