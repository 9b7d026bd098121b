"""Registered queries over labels and labeled/unlabeled sets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import labels as lb, pool as pl, training as tr
from ..operators.sampling import hash_rank, ratio_split, take_random
from ..sources import tables
from ..sources.learners import load_learner, prepend_saved, save_learner
from ..sources.scratch import scratch_root
from .registry import LABELED_DOCS, labeled_documents, query, table, vectors

NAMES = {0: "low", 1: "high"}


@query(
    "one_hot",
    """SELECT e.vec_id AS id, c.label AS class, (e.label = c.label)::INTEGER AS y
    FROM embeddings e, (SELECT DISTINCT label FROM embeddings) c""",
)
def one_hot(spark, sf_dir):
    return lb.one_hot(vectors(spark, sf_dir))


@query(
    "one_hot_binary",
    f"WITH {LABELED_DOCS} SELECT id, 1 AS class, coalesce((classLabel = 1)::INTEGER, 0) AS y FROM ld",
)
def one_hot_binary(spark, sf_dir):
    return lb.one_hot(labeled_documents(spark, sf_dir), drop_first_of_two=True)


@query(
    "collapse_classes",
    "SELECT vec_id AS id, CASE WHEN label IN (2, 3) THEN 0 ELSE label END AS classLabel FROM embeddings",
)
def collapse_classes(spark, sf_dir):
    return lb.collapse_classes(vectors(spark, sf_dir), {0: 0, 2: 0, 3: 0}).select("id", "classLabel")


MASK_FILL = f"""WITH {LABELED_DOCS} SELECT id, NULL::INTEGER AS masked, coalesce(classLabel, 0) AS filled FROM ld"""


@query("mask_fill_labels", MASK_FILL)
def mask_fill_labels(spark, sf_dir):
    rows = labeled_documents(spark, sf_dir).select("id", "classLabel", F.col("classLabel").alias("masked"))
    return lb.fill_labels(lb.mask_labels(rows, "masked")).select("id", "masked", F.col("classLabel").alias("filled"))


@query(
    "class_names",
    f"""WITH {LABELED_DOCS} SELECT id, classLabel, CASE classLabel WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS name FROM ld""",
)
def class_names(spark, sf_dir):
    names = spark.createDataFrame(list(NAMES.items()), "class int, name string")
    return lb.name_classes(labeled_documents(spark, sf_dir).select("id", "classLabel"), names)


CONCAT_SETS = """SELECT d.doc_id AS id, l.quality AS classLabel,
    CASE WHEN l.doc_id IS NULL THEN 'unlabeled' ELSE 'labeled' END AS split
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@query("concat_sets", CONCAT_SETS)
def concat_sets(spark, sf_dir):
    rows = labeled_documents(spark, sf_dir).select("id", "classLabel")
    return lb.concat_sets(
        {"labeled": rows.where("classLabel IS NOT NULL"), "unlabeled": rows.where("classLabel IS NULL")}
    )


SEED_POOL_TEST = """WITH rest AS (SELECT vec_id AS id,
    row_number() OVER (ORDER BY md5('5:' || vec_id), vec_id) AS rn FROM embeddings WHERE vec_id NOT IN (0, 1))
  SELECT vec_id AS id, 'seed' AS split FROM embeddings WHERE vec_id IN (0, 1)
  UNION ALL SELECT id, CASE WHEN rn <= (SELECT count(*) * 3 // 4 FROM embeddings) THEN 'pool' ELSE 'test' END FROM rest"""


@query("seed_pool_test", SEED_POOL_TEST)
def seed_pool_test(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("id")
    seeds, pool, test = lb.seed_pool_test(rows, [0, 1], rows.count() * 3 // 4, seed=5)
    return lb.concat_sets({"seed": seeds, "pool": pool, "test": test})


MINORITY = f"""WITH {LABELED_DOCS}, c AS (SELECT classLabel, count(*) AS n FROM ld WHERE classLabel IS NOT NULL GROUP BY 1),
  m AS (SELECT classLabel, n FROM c ORDER BY n, classLabel LIMIT 1)
  SELECT classLabel AS minority_class, n AS minority_rows, (SELECT count(*) FROM ld) - n AS majority_rows FROM m"""


@query("minority_stats", MINORITY)
def minority_stats(spark, sf_dir):
    return pl.minority_stats(labeled_documents(spark, sf_dir))


REMOVE_BY_ID = f"""WITH {LABELED_DOCS} SELECT id, classLabel,
    CASE WHEN id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'removed' ELSE 'rest' END AS part FROM ld"""


@query("remove_by_id", REMOVE_BY_ID)
def remove_by_id(spark, sf_dir):
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    rows = labeled_documents(spark, sf_dir).select("id", "classLabel")
    removed, rest = pl.split_by_ids(rows, toxic)
    return lb.concat_sets({"removed": removed, "rest": rest}, "part")


BALANCE = """WITH r AS (SELECT doc_id AS id, quality AS classLabel,
    row_number() OVER (PARTITION BY quality ORDER BY md5('3:' || doc_id), doc_id) AS rn FROM labels),
  n AS (SELECT count(*) FILTER (quality = 0) AS mn, count(*) FILTER (quality = 1) AS mj FROM labels)
  SELECT id, classLabel FROM r, n WHERE classLabel = 0 OR rn > mj - mn"""


@query("undersample_balance", BALANCE)
def undersample_balance(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("classLabel"))
    return pl.balance(rows, seed=3)


@query("append_unique", f"WITH {LABELED_DOCS} SELECT id, classLabel FROM ld")
def append_unique(spark, sf_dir):
    rows = labeled_documents(spark, sf_dir).select("id", "classLabel")
    return pl.append_unique(rows.where("classLabel IS NOT NULL"), rows.where("classLabel IS NULL"))


RANDOM_MOVE = """WITH r AS (SELECT vec_id AS id, label AS classLabel,
    row_number() OVER (ORDER BY md5('9:' || vec_id), vec_id) AS rn FROM embeddings)
  SELECT id, classLabel, CASE WHEN rn <= 100 THEN 'labeled' ELSE 'pool' END AS part FROM r"""


@query("random_move", RANDOM_MOVE)
def random_move(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("id", "classLabel")
    pool, labeled = pl.move_random(rows, rows.limit(0), 100, seed=9)
    return lb.concat_sets({"labeled": labeled, "pool": pool}, "part")


RANDOM_SUBSET = """WITH r AS (SELECT o_orderkey AS id,
    row_number() OVER (ORDER BY md5('4:' || o_orderkey), o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
  SELECT id FROM r WHERE rn <= n // 2"""


@query("random_subset", RANDOM_SUBSET)
def random_subset(spark, sf_dir):
    """Half of a larger table in exact random order, without sorting it."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return take_random(rows, rows.count() // 2, seed=4)[0]


RATIO_SPLIT = """WITH r AS (SELECT vec_id AS id, label AS classLabel,
    row_number() OVER (ORDER BY md5('11:' || vec_id), vec_id) AS rn, count(*) OVER () AS n FROM embeddings)
  SELECT id, classLabel, CASE WHEN rn <= floor(n * 0.8) THEN 'training' ELSE 'testing' END AS part FROM r"""


@query("ratio_split", RATIO_SPLIT)
def split(spark, sf_dir):
    training, testing = ratio_split(vectors(spark, sf_dir).select("id", "classLabel"), 0.8, seed=11)
    return lb.concat_sets({"training": training, "testing": testing}, "part")


FOLDS = """SELECT vec_id AS id, label AS classLabel,
  ((row_number() OVER (PARTITION BY label ORDER BY md5('7:' || vec_id), vec_id) - 1) % 5)::BIGINT AS fold FROM embeddings"""


@query("stratified_folds", FOLDS)
def stratified_folds(spark, sf_dir):
    ranked = hash_rank(vectors(spark, sf_dir).select("id", "classLabel"), "classLabel", 7)
    return ranked.select("id", "classLabel", ((F.col("rank") - 1) % 5).alias("fold"))


@query("set_columns", f"WITH {LABELED_DOCS} SELECT id, classLabel FROM ld")
def set_columns(spark, sf_dir):
    rows = labeled_documents(spark, sf_dir)
    ids = pl.instance_ids(pl.sample_columns(rows))
    return ids.join(pl.label_column(rows), "id")


UNPIVOT = """SELECT l_orderkey, l_linenumber, feature, value FROM (
    SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature,
      unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM lineitem)"""


@query("unpivot_features", UNPIVOT + " WHERE value <> 0")
def unpivot_features(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return tables.unpivot_features(wide, ["l_orderkey", "l_linenumber"], names, keep_zeros=False)


@query("unpivot_features_zeros", UNPIVOT)
def unpivot_features_zeros(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return tables.unpivot_features(wide, ["l_orderkey", "l_linenumber"], names)


def _fresh(spark, name):
    return f"{scratch_root(spark)}/tagwright-{name}-{uuid.uuid4().hex}"


@query("raw_csv_roundtrip", "SELECT doc_id AS id, text, lang AS sentiment FROM documents")
def raw_csv_roundtrip(spark, sf_dir):
    path = _fresh(spark, "csv")
    docs = table(spark, sf_dir, "documents")
    tables.write_csv(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("sentiment")), path)
    return tables.read_raw_csv(spark, path)


WIDE_CSV = """SELECT l_orderkey * 8 + l_linenumber AS id, strftime(l_shipdate, '%Y-%m-%d') AS origText, l_linenumber AS classLabel,
  l_quantity, l_discount FROM lineitem"""


@query("wide_csv_roundtrip", WIDE_CSV)
def wide_csv_roundtrip(spark, sf_dir):
    path = _fresh(spark, "wide")
    wide = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("origText"),
        F.col("l_linenumber").alias("classLabel"), "l_quantity", "l_discount",
    )
    tables.write_csv(wide, path)
    return tables.read_feature_csv(spark, path, tables.wide_schema(["l_quantity", "l_discount"]))


WRITE_RESULTS = f"""WITH {LABELED_DOCS} SELECT id, CASE WHEN id % 5 = 0 THEN '' WHEN id % 5 = 1 THEN ' ' || origText || chr(13) || chr(10)
    ELSE origText END AS origText, classLabel, classLabel IS NOT NULL AS labeled FROM ld"""


@query("write_results", WRITE_RESULTS)
def write_results(spark, sf_dir):
    """Labeled rows and the rest as the two result tables, read back: blanks at the edges, empty
    texts and line ends are as they were."""
    path = _fresh(spark, "results")
    rows = labeled_documents(spark, sf_dir)
    text = F.when(F.col("id") % 5 == 0, "").when(F.col("id") % 5 == 1, F.concat(F.lit(" "), "origText", F.lit("\r\n"))).otherwise(F.col("origText"))
    rows = rows.select("id", text.alias("origText"), "classLabel")
    tables.write_results(rows.where("classLabel is not null"), rows.where("classLabel is null"), path)
    read = lambda name: tables.read_csv(spark, f"{path}/{name}", "id LONG, origText STRING, classLabel INT")
    done = read("all_labeled_data").withColumn("labeled", F.lit(True))
    return done.union(read("all_unlabeled_data_predictions").withColumn("labeled", F.lit(False)))


@query("word_list_roundtrip", "SELECT DISTINCT lower(trim(lang || source)) AS word FROM documents")
def word_list_roundtrip(spark, sf_dir):
    path = _fresh(spark, "words")
    table(spark, sf_dir, "documents").select(F.concat("lang", "source")).write.text(path)
    return tables.read_word_list(spark, path)


SAVE_LOAD = f"""WITH {LABELED_DOCS} SELECT id, classLabel, CASE WHEN classLabel IS NULL THEN 'pool' ELSE 'saved' END AS part FROM ld"""


@query("save_load_roundtrip", SAVE_LOAD)
def save_load_roundtrip(spark, sf_dir):
    """Saved labeled rows come back in front of a pool that does not hold them, after a save over
    the rows that a load returned; the model scores as before."""
    rows = labeled_documents(spark, sf_dir)
    labeled, pool = rows.where("classLabel IS NOT NULL"), rows.where("classLabel IS NULL")
    path = _fresh(spark, "learner")
    rows_of = vectors(spark, sf_dir)
    binary = rows_of.select("id", (F.col("classLabel") == 3).cast("int").alias("classLabel"))
    model = tr.fit_margin(rows_of.select("id", "vec"), binary, tr.MarginParams(kernel="linear", tolerance=1e-2))
    save_learner(path, "quality", labeled.where("id % 2 = 0"), model.table(spark), {}, False)
    first = load_learner(spark, path, "quality")["labeled"]
    save_learner(path, "quality", first.unionByName(labeled.where("id % 2 = 1")), model.table(spark), {"tp": 1}, True)
    saved = load_learner(spark, path, "quality")
    restored_model = tr.MarginModel.from_table(saved["model"])
    if (restored_model.weights != model.weights).any() or saved["metrics"] != {"tp": 1}:
        raise AssertionError("the saved learner came back changed")
    restored = prepend_saved(saved["labeled"], pool)
    part = F.when(F.col("classLabel").isNull(), "pool").otherwise("saved")
    return restored.select("id", "classLabel", part.alias("part"))
