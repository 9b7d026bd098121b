import hashlib

import pytest
from pyspark.sql import functions as F

from tagwright.operators import labels as lb, pool as pl, sampling as sp
from tagwright.sources import tables
from tagwright.sources.learners import load_learner, prepend_saved, save_learner


@pytest.fixture(scope="module")
def pool(spark):
    rows = [(1, 0), (2, 0), (3, 1), (4, 1), (5, None), (6, 2), (7, 2)]
    return spark.createDataFrame(rows, "id long, classLabel int")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def order(keys, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def test_minority_ties_nulls_and_empty(pool):
    row = pl.minority_stats(pool).first()
    assert (row["minority_class"], row["minority_rows"], row["majority_rows"]) == (0, 2, 5)
    row = pl.minority_stats(pool.limit(0)).first()
    assert (row["minority_class"], row["minority_rows"], row["majority_rows"]) == (1, 0, 0)


def test_split_by_ids(spark, pool):
    removed, rest = pl.split_by_ids(pool, [1, 7])
    assert ids(removed) == [1, 7] and ids(rest) == [2, 3, 4, 5, 6]
    table = spark.createDataFrame([(1,), (7,)], "id long")
    assert ids(pl.split_by_ids(pool, table)[1]) == [2, 3, 4, 5, 6]


def test_undersample_and_balance(spark, pool):
    removed, rest = pl.undersample(pool, 2, seed=3)
    assert ids(removed) == sorted(order([3, 4, 5, 6, 7], 3)[:2])
    assert sorted(ids(removed) + ids(rest)) == [1, 2, 3, 4, 5, 6, 7]
    assert pl.balance(pool, seed=3).count() == 4
    with pytest.raises(ValueError):
        pl.balance(pool.limit(0), seed=3)


def test_duplicate_ids_fail(pool):
    with pytest.raises(ValueError, match="duplicate"):
        pl.append_unique(pool, pool.where("id = 3"))


def test_move_random(pool):
    rest, labeled = pl.move_random(pool, pool.limit(0), 3, seed=9)
    assert labeled.count() == 3 and sorted(ids(rest) + ids(labeled)) == [1, 2, 3, 4, 5, 6, 7]
    with pytest.raises(ValueError):
        pl.move_random(pool.limit(0), pool, 3, seed=9)


@pytest.mark.parametrize("limit", [20_000, 5])
@pytest.mark.parametrize("n", [0, 1, 500, 999, 1000, 2000])
def test_random_cut_is_exact(spark, monkeypatch, limit, n):
    monkeypatch.setattr(sp, "SORTED_LIMIT", limit)
    chosen, rest = sp.take_random(spark.range(1000), n, seed=4)
    assert ids(chosen) == sorted(order(range(1000), 4)[:n])
    assert rest.count() == max(1000 - n, 0)


def test_random_subset_ignores_partitioning(spark):
    rows = spark.range(1000)
    assert ids(sp.ratio_split(rows, 0.3, 1)[0]) == ids(sp.ratio_split(rows.repartition(13), 0.3, 1)[0])


def test_hash_rank_with_one_dominant_group(spark):
    rows = spark.range(2000).withColumn("g", F.when(F.col("id") < 1800, 0).otherwise(F.col("id") % 3))
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["g"], []).append(r["id"])
    expected = {k: i + 1 for g in groups.values() for i, k in enumerate(order(g, 7))}
    assert {r["id"]: r["rank"] for r in sp.hash_rank(rows, "g", 7).collect()} == expected


def test_one_hot(pool, spark):
    rows = {(r["id"], r["class"]): r["y"] for r in lb.one_hot(pool).collect()}
    assert len(rows) == 21 and rows[(3, 1)] == 1 and rows[(3, 0)] == 0
    assert [rows[(5, c)] for c in (0, 1, 2)] == [0, 0, 0]
    two = pool.where("classLabel < 2 OR classLabel IS NULL")
    assert {r["class"] for r in lb.one_hot(two, drop_first_of_two=True).collect()} == {1}
    assert {r["class"] for r in lb.one_hot(pool, drop_first_of_two=True).collect()} == {0, 1, 2}


def test_label_maps(pool, spark):
    collapsed = {r["id"]: r["classLabel"] for r in lb.collapse_classes(pool, {2: 0, 0: 0}).collect()}
    assert collapsed[6] == 0 and collapsed[3] == 1 and collapsed[5] is None
    assert pl.label_column(lb.mask_labels(pool)).where("classLabel IS NOT NULL").count() == 0
    assert lb.fill_labels(pool).where("id = 5").first()["classLabel"] == 0
    names = spark.createDataFrame([(0, "none"), (1, "one")], "class int, name string")
    for source in (names, {0: "none", 1: "one"}):
        got = {r["id"]: r["name"] for r in lb.name_classes(pool, source).collect()}
        assert got[1] == "none" and got[3] == "one" and got[6] is None and got[5] is None


def test_seed_pool_test(pool):
    seeds, unlabeled, test = lb.seed_pool_test(pool, [1, 3], 3, seed=5)
    assert ids(seeds) == [1, 3] and unlabeled.count() == 3 and test.count() == 2


def test_unpivot(spark):
    wide = spark.createDataFrame([(1, 0.0, 2), (2, 3.0, 0)], "id long, a double, b int")
    assert tables.unpivot_features(wide, ["id"], ["a", "b"]).count() == 4
    rows = tables.unpivot_features(wide, ["id"], ["a", "b"], keep_zeros=False).collect()
    assert {(r["id"], r["feature"], r["value"]) for r in rows} == {(1, "b", 2.0), (2, "a", 3.0)}


def test_csv_keeps_quotes_and_newlines(spark, tmp_path):
    rows = [(1, 'says "hi",\nthen leaves', "pos"), (2, "naïve", "neg")]
    tables.write_csv(spark.createDataFrame(rows, tables.RAW_SCHEMA), str(tmp_path / "raw"))
    got = tables.read_raw_csv(spark, str(tmp_path / "raw"))
    assert sorted(tuple(r) for r in got.collect()) == rows


def test_stopword_sources(spark, tmp_path):
    (tmp_path / "words.txt").write_text("The\n\nand\nthe\n")
    got = tables.read_word_list(spark, str(tmp_path / "words.txt"))
    assert sorted(r["word"] for r in got.collect()) == ["and", "the"]
    assert "the" in tables.default_stopwords()


def test_saved_learner_round_trip(spark, tmp_path, pool, capsys):
    path = str(tmp_path)
    assert load_learner(spark, path, "nothing") is None
    assert "does not exist yet" in capsys.readouterr().out
    model = spark.createDataFrame([("m", "f", 1.0)], "model_id string, feature string, weight double")
    save_learner(path, "three", pool.where("id < 4"), model, {"tp": 2}, True)
    saved = load_learner(spark, path, "three")
    assert saved["metrics"] == {"tp": 2} and saved["naive_bayes"] is True
    assert ids(saved["labeled"]) == [1, 2, 3] and saved["model"].collect() == model.collect()
    restored = prepend_saved(saved["labeled"], pool.where("id > 2"))
    assert ids(restored) == [1, 2, 3, 4, 5, 6, 7]


def test_a_learner_is_saved_over_its_own_rows(spark, tmp_path, pool):
    path = str(tmp_path)
    model = spark.createDataFrame([("m", 1.0)], "model_id string, weight double")
    save_learner(path, "three", pool.where("id < 3"), model, {}, False)
    first = load_learner(spark, path, "three")["labeled"]
    save_learner(path, "three", first.union(pool.where("id = 5")), model, {"tp": 1}, False)
    assert ids(load_learner(spark, path, "three")["labeled"]) == [1, 2, 5] and ids(first) == [1, 2]


def test_csv_keeps_every_text(spark, tmp_path):
    texts = ["", None, " x ", "\t", "a\r\nb", "a\rb", "\r", "a\nb", '"', '""', 'say "a, b"', ",", "\\", "#c", "null", "  "]
    rows = [(i, t, None if i % 2 else "") for i, t in enumerate(texts)]
    tables.write_csv(spark.createDataFrame(rows, tables.RAW_SCHEMA), str(tmp_path / "t"))
    assert sorted(map(tuple, tables.read_raw_csv(spark, str(tmp_path / "t")).collect())) == rows


def test_subsets_of_one_repeated_id(spark):
    df = spark.range(30_000).select(F.lit(1).cast("long").alias("id"))
    with pytest.raises(ValueError, match="share one id"):
        sp.random_cut(df, 25_000, 1)


def test_results_are_written(spark, tmp_path, pool):
    tables.write_results(pool.where("id < 3"), pool.where("id > 2"), str(tmp_path))
    read = spark.read.csv(str(tmp_path / "all_unlabeled_data_predictions"), header=True)
    assert read.count() == 5 and (tmp_path / "all_labeled_data").is_dir()
