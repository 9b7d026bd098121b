"""Preparing class labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .sampling import take_random


def class_array(df: DataFrame, label_col: str = "classLabel") -> Column:
    """The distinct labels in order, as a scalar subquery; its size is the class count."""
    return df.select(F.sort_array(F.collect_set(label_col))).scalar()


def one_hot(
    df: DataFrame, label_col: str = "classLabel", drop_first_of_two: bool = False,
    keep: Iterable[str] = ("id",), class_col: str = "class", out_col: str = "y",
) -> DataFrame:
    """Long one-hot matrix: one row per (row, class) with a 0/1 value.

    Rows without a label are 0 for every class.  With ``drop_first_of_two`` and exactly two
    classes only the second stays.  The class list is one small array, so the fan-out is a
    narrow explode."""
    classes = class_array(df, label_col)
    if drop_first_of_two:
        classes = F.when(F.size(classes) == 2, F.slice(classes, 2, 1)).otherwise(classes)
    fanned = df.select(*keep, F.col(label_col).alias("_label"), F.explode(classes).alias(class_col))
    hit = F.coalesce((F.col("_label") == F.col(class_col)).cast("int"), F.lit(0))
    return fanned.select(*keep, class_col, hit.alias(out_col))


def collapse_classes(df: DataFrame, mapping: Mapping, label_col: str = "classLabel") -> DataFrame:
    """Replace labels by a value map; labels outside the map stay."""
    label, replaced = F.col(label_col), F.col(label_col)
    for old, new in mapping.items():
        replaced = F.when(label == F.lit(old), F.lit(new)).otherwise(replaced)
    return df.withColumn(label_col, replaced.cast(df.schema[label_col].dataType))


def mask_labels(df: DataFrame, label_col: str = "classLabel") -> DataFrame:
    return df.withColumn(label_col, F.lit(None).cast(df.schema[label_col].dataType))


def fill_labels(df: DataFrame, label_col: str = "classLabel", value: int = 0) -> DataFrame:
    return df.fillna(value, [label_col])


def name_classes(
    df: DataFrame, names: Mapping | DataFrame, label_col: str = "classLabel", out_col: str = "name"
) -> DataFrame:
    """Attach class names given as a mapping or a ``(class, name)`` table.

    The table has one row per class; it is read as one map value, so a class holding most
    rows does not pile them up in one join task."""
    if isinstance(names, DataFrame):
        pairs = F.collect_list(F.struct("class", "name"))
        lookup = names.select(F.map_from_entries(pairs)).scalar()
    else:
        lookup = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return df.withColumn(out_col, F.try_element_at(lookup, F.col(label_col)))


def concat_sets(sets: Mapping[str, DataFrame], split_col: str = "split") -> DataFrame:
    """Union of named sets; each row carries its set's name and keeps its own id."""
    combined = None
    for name, df in sets.items():
        tagged = df.withColumn(split_col, F.lit(name))
        combined = tagged if combined is None else combined.unionByName(tagged)
    return combined


def seed_pool_test(
    df: DataFrame, seed_ids: Iterable, pool_size: int, seed: int, id_col: str = "id"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chosen seed rows, a random pool of exactly ``pool_size`` others, and the remainder."""
    is_seed = F.col(id_col).isin(list(seed_ids))
    pool, test = take_random(df.where(~is_seed), pool_size, seed, id_col)
    return df.where(is_seed), pool, test
