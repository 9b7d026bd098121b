"""Licence statements in texts, found by voting on diagonals.  Column functions only.

Every rolling three-word gram of every text is joined by its hash with the places of equal grams in
a short list of templates, and the words themselves are compared.  A match votes for a diagonal: its
place in the text less its place in the template.  Two kinds of template:

- base phrases count where all grams of the phrase vote for one diagonal, which is a place where the
  phrase's words stand consecutively;
- notices count where neighbouring diagonals together hold enough of the template.  Diagonals are
  merged in bands of ``2 * SLACK`` that begin every ``SLACK``, so words left out or put in shift a
  notice by up to ``SLACK`` without losing it, and a band spans little more of a text than the
  template is long.  A merged span is verified: at least ``SHARE`` of the template's grams and all
  grams of its key phrase.

A text is scanned once.  It is one row until its grams meet the templates, whose number is a
parameter; only matches and one mark for each text are shuffled, with votes added up before.

Defined results for odd rows: a null or empty text has no words and no labels; rows of one id are
rows of their own, a null id stays null; very long texts are scanned whole; equal places of two
labels count for both; an empty table has no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.lookup import fits_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
SLACK = 8
SHARE = 0.75
MOST_WORDS = 63 + GRAM - 1  # places of a template are bits of a long


@dataclass(frozen=True)
class Template:
    """``base``: found only where all words stand consecutively.  ``key``: words of the text that a
    span must hold whole."""

    label: str
    text: str
    base: bool = False
    key: str = ""


BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
# Sentences of public licence notices.
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license",
        key="the apache license version 2",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    Template(
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation",
        key="the gnu general public license",
    ),
    Template(
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
        "published by the free software foundation",
        key="the gnu lesser general public license",
    ),
    Template(
        "agpl",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
        "published by the free software foundation",
        key="the gnu affero general public license",
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        key="the mozilla public license",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template(
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    ),
)


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none where it is null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _grams(rows: DataFrame, carried: list[str]) -> DataFrame:
    """A row for each place of ``w``: ``at`` from 0 and the words ``a``, ``b``, ``c`` there, null
    beyond the end."""
    shifted = [F.slice("w", k + 1, F.greatest(F.size("w"), F.lit(1))).alias(name) for k, name in enumerate("abc")]
    zipped = rows.select(*carried, *shifted).select(*carried, F.posexplode(F.arrays_zip("a", "b", "c")).alias("at", "g"))
    return zipped.select(*carried, "at", "g.a", "g.b", "g.c")


def key_bits(template: Template) -> int:
    """The places of the grams of the key phrase, as bits."""
    key, own = template.key.split(), template.text.split()
    first = next((i for i in range(len(own)) if key and own[i : i + len(key)] == key), 0)
    return ((1 << max(0, len(key) - GRAM + 1)) - 1) << first


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """t, label, base, n (grams), needed (bits of the key), place, a, b, c, key (hash of the gram)."""
    rows = [
        F.struct(
            F.lit(i).alias("t"), F.lit(x.label).alias("label"), F.lit(x.base).alias("base"),
            F.lit(key_bits(x)).cast("long").alias("needed"), F.lit(x.text).alias("text"),
        )
        for i, x in enumerate(templates)
    ]
    listed = spark.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*").withColumn("w", words(F.col("text")))
    listed = listed.withColumn("n", F.size("w") - (GRAM - 1))
    grams = _grams(listed, ["t", "label", "base", "n", "needed", "w"]).drop("w")
    return grams.where(F.col("c").isNotNull()).select(
        "t", "label", "base", "n", "needed", F.col("at").alias("place"), "a", "b", "c", F.xxhash64("a", "b", "c").alias("key")
    )


def _checked(templates: Sequence[Template]) -> int:
    """Number of words of all templates."""
    total = 0
    for template in templates:
        size = len(template.text.split())
        if not GRAM <= size <= MOST_WORDS:
            raise ValueError(f"a template needs {GRAM} to {MOST_WORDS} words, {template.label!r} has {size}; split a longer one")
        if template.key and (f" {template.key} " not in f" {template.text} " or len(template.key.split()) < GRAM):
            raise ValueError(f"the key of {template.label!r} is not a part of its text of {GRAM} words or more")
        total += size
    return total


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = BASE + NOTICES) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_base (places of base phrases),
    first_word and last_word (least and greatest of their starts), base_labels, labels (with those
    of notices), score (the greatest share of a template found in one place)."""
    spark = docs.sparkSession
    size = _checked(templates)
    listed = template_grams(spark, templates)
    # Three empty words, which no text has, stand before each text: a gram that every text has.
    mark = spark.range(1).select(
        F.lit(-1).alias("t"), F.lit("").alias("label"), F.lit(True).alias("base"), F.lit(1).alias("n"),
        F.lit(0).cast("long").alias("needed"), F.lit(0).alias("place"), F.lit("").alias("a"), F.lit("").alias("b"),
        F.lit("").alias("c"), F.xxhash64(F.lit(""), F.lit(""), F.lit("")).alias("key"),
    )
    listed = listed.unionByName(mark).withColumnsRenamed({"a": "x", "b": "y", "c": "z"})
    if fits_broadcast(size, 400):
        listed = F.broadcast(listed)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("own")).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", F.size("own").alias("n_words"),
        F.concat(F.array(F.lit(""), F.lit(""), F.lit("")), "own").alias("w"),
    )
    grams = _grams(rows, ["uid", "doc_id", "n_words", "w"]).drop("w").withColumn("key", F.xxhash64("a", "b", "c"))
    hits = grams.join(listed, "key").where((F.col("a") == F.col("x")) & (F.col("b") == F.col("y")) & (F.col("c") == F.col("z")))
    marked = F.col("t") == -1
    hits = hits.select(
        "uid", "t", "label", "base", "n", "needed", (F.col("at") - GRAM - F.col("place")).alias("diagonal"),
        F.expr("shiftleft(1L, place)").alias("bit"),
        F.when(marked, F.col("doc_id")).alias("doc_id"), F.when(marked, F.col("n_words")).alias("n_words"),
    )
    of = ["uid", "t", "label", "base", "n", "needed"]
    carried = [F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words")]
    votes = hits.groupBy(*of, "diagonal").agg(F.bit_or("bit").alias("bits"), *carried)
    band = F.floor(F.col("diagonal") / SLACK).cast("int")
    bands = F.when(F.col("base"), F.array("diagonal")).otherwise(F.array(band - 1, band))
    spans = votes.withColumn("band", F.explode(bands)).groupBy(*of, "band").agg(F.bit_or("bits").alias("bits"), *carried)
    share = F.when(F.col("t") >= 0, F.bit_count("bits") / F.col("n")).otherwise(0.0)
    needed = F.col("bits").bitwiseAND(F.col("needed")) == F.col("needed")
    spans = spans.withColumn("share", share).withColumn("place", F.col("base") & (F.col("share") == 1))
    spans = spans.withColumn("found", F.col("place") | (~F.col("base") & (F.col("share") >= SHARE) & needed))
    labels = lambda kind: F.array_join(F.array_sort(F.collect_set(F.when(F.col(kind), F.col("label")))), ",")
    start = F.when(F.col("place"), F.col("band").cast("long"))
    return spans.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(F.col("place"), 1)).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        labels("place").alias("base_labels"), labels("found").alias("labels"), F.max("share").alias("score"),
    ).drop("uid")
