"""The language of a text, by Bayes' rule from three kinds of evidence.

* The text: byte trigrams of its letters under a naive Bayes model of each language, trained on
  the counts of all labelled texts.  Neighbouring trigrams are not independent, so the evidence
  of a long text is held to that of a few hundred.
* The declared language, as reliable as the rows show: how often it agrees with the text alone.
* The address: how often each language was found on the host, smoothed with the domain, that
  with the address suffix, and that with all rows.  These counts are grouped sums of the
  languages that the text alone suggests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.lookup import lookup_join
from ..sources.scratch import materialize
from .arrays import blocks, frees, utf8

FEATURE_BITS = 15
EVIDENCE = 200.0  # trigrams that a text counts for at most
SMOOTHING = 20.0  # texts' worth of the wider level
LETTERS = np.full(256, 0x20, dtype=np.uint32)
LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # log probability of each feature, one row per language


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all texts one after another, offsets of the texts in them): hashed trigrams
    that don't consist of blanks alone."""
    values, offsets = utf8(column)
    own = LETTERS[values]
    if len(own) < 3:
        return np.empty(0, np.int64), np.zeros(len(column) + 1, np.int64)
    gram = (own[:-2] << np.uint32(16)) | (own[1:-1] << np.uint32(8)) | own[2:]
    valid = gram != 0x202020
    for edge in (offsets[1:] - 1, offsets[1:] - 2):  # trigrams that reach into the next text
        valid[edge[(edge >= 0) & (edge < len(valid))]] = False
    feature = (gram[valid] * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)
    counts = np.concatenate([[0], np.cumsum(valid), [valid.sum()] * 2])
    return feature.astype(np.int64), counts[offsets].astype(np.int64)


def language_tag(declared: Column) -> Column:
    """The language of a tag, without region or script and in lower case: ``en`` for ``EN``, ``en-US``
    or ``en_GB``.  Null for a blank tag."""
    first = F.regexp_extract(declared, r"^\s*([^\s_-]+)", 1)
    return F.when(first != "", F.lower(first))


def fit_text(texts: DataFrame, text: str = "text", language: str = "lang") -> TextModel:
    """Add-one estimates from all rows with a language, however few it has.  Tags are read by
    ``language_tag``, so spellings of one language are one.  Null and empty texts add nothing.  The
    model has a row of 256 KB for each language."""
    rows = texts.select(texts[text].alias("_text"), language_tag(texts[language]).alias("_lang")).where("_lang is not null")
    languages = tuple(sorted(r[0] for r in rows.select("_lang").distinct().collect()))
    place = {name: i for i, name in enumerate(languages)}
    size = 1 << FEATURE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # of the languages that the task meets
        for block in blocks(batches, "_text"):
            which = np.array([place.get(x, -1) for x in block.column("_lang").to_pylist()], dtype=np.int64)
            feature, offsets = features(block.column("_text"))
            of = np.repeat(which, np.diff(offsets))
            for i in np.unique(which[which >= 0]).tolist():
                found = np.bincount(feature[of == i], minlength=size)
                sums[i] = sums[i] + found if i in sums else found
        for i, found in sums.items():
            (j,) = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), i)), pa.array(j), pa.array(found[j])], names=["i", "j", "n"])

    counted = rows.mapInArrow(frees(count), "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas()
    sums = np.ones((len(languages), size))
    sums[counted["i"].to_numpy(np.int64), counted["j"].to_numpy(np.int64)] += counted["n"].to_numpy(np.float64)
    return TextModel(languages, np.log(sums / sums.sum(axis=1, keepdims=True)))


def text_scores(rows: DataFrame, model: TextModel, text: str) -> DataFrame:
    """``rows`` with _n (trigrams) and _ll (mean log likelihood per language, null without any)."""
    shared = rows.sparkSession.sparkContext.broadcast(model.weights)
    added = [T.StructField("_n", T.LongType()), T.StructField("_ll", T.ArrayType(T.DoubleType()))]
    schema = T.StructType(rows.schema.fields + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for block in blocks(batches, text):
            feature, offsets = features(block.column(text))
            n = np.diff(offsets)
            some = np.flatnonzero(n)
            mean = np.zeros((block.num_rows, len(weights)))
            for i, row in enumerate(weights):
                if len(some):
                    mean[some, i] = np.add.reduceat(row[feature], offsets[:-1][some]) / n[some]
            scores = pa.array([m.tolist() if k else None for m, k in zip(mean, n, strict=True)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(n), scores], names=schema.names)

    return rows.mapInArrow(frees(run), schema)


def _log(values: Column) -> Column:
    return F.transform(values, lambda x: F.log(x))


def _sum(*terms: Column) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = F.zip_with(total, term, lambda a, b: a + b)
    return total


def _smoothed(counts: Column, wider: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, wider, lambda n, p: (n + SMOOTHING * p) / (total + SMOOTHING))


def _priors(votes: DataFrame, n: int) -> DataFrame:
    """(host, prior) from (host, vote, n): smoothed level by level, by grouped sums."""
    add = [F.sum(F.col("v")[i]).cast("double") for i in range(n)]
    hosts = votes.groupBy("_host").agg(*[F.sum(F.when(F.col("vote") == i, F.col("n")).otherwise(0)).alias(f"c{i}") for i in range(n)])
    hosts = hosts.select("_host", F.array(*[F.col(f"c{i}").cast("double") for i in range(n)]).alias("v"))
    hosts = hosts.withColumn("_domain", F.substring_index("_host", ".", -2)).withColumn("_suffix", F.substring_index("_host", ".", -1))
    hosts = materialize(hosts, "host-votes")
    domains = hosts.groupBy("_domain", "_suffix").agg(F.array(*add).alias("d"))
    suffixes = hosts.groupBy("_suffix").agg(F.array(*add).alias("s"))
    every = hosts.agg(*add).first()
    total = sum(x or 0.0 for x in every)
    base = F.array(*[F.lit(((x or 0.0) + 1.0) / (total + n)) for x in every])
    suffixes = suffixes.select("_suffix", _smoothed(F.col("s"), base).alias("s"))
    domains = domains.join(suffixes, "_suffix").select("_domain", _smoothed(F.col("d"), F.col("s")).alias("d"))
    return hosts.join(domains, "_domain").select("_host", _smoothed(F.col("v"), F.col("d")).alias("prior"))


def identify(
    rows: DataFrame, model: TextModel, text: Column, declared: Column, address: Column, keep: list[str], least: float = 0.5,
    keep_text: bool = False,
) -> DataFrame:
    """The columns ``keep`` of each row with language, confidence and accepted, and the text as
    a column text, if it is kept.

    ``text``, ``declared`` and ``address`` (a host name, or any name of a source) are columns of
    ``rows``; each may be null, and what is missing is no evidence.  A declaration is read by
    ``language_tag``, as the model's languages are.  The language is the one
    with the largest posterior, the first by name among equals; it is null, and the row not
    accepted, if the text has no letters.  A row is accepted when the posterior reaches
    ``least`` and the text is likelier in that language than as evenly mixed letters.  Repeated
    rows are judged alike.  Columns may have any names."""
    n = len(model.languages)
    packed = F.struct(*[rows[c] for c in keep])
    source = rows.select(
        packed.alias("_keep"), text.alias("_text"), language_tag(declared).alias("_declared"),
        F.coalesce(F.lower(address), F.lit("")).alias("_host"),
    )
    body = [F.col("_text").alias("text")] if keep_text else []
    if not n:
        none = source.select("_keep.*", *body, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"))
        return none.withColumn("accepted", F.lit(False))
    scored = text_scores(source, model, "_text")
    best = F.array_position("_ll", F.array_max("_ll")) - 1
    names = F.array(*[F.lit(x) for x in model.languages])
    votes = source.select("_text", "_declared", "_host")
    votes = materialize(
        text_scores(votes, model, "_text").withColumn("vote", best.cast("int")).where("vote is not null")
        .groupBy("_host", "_declared", "vote").agg(F.count(F.lit(1)).alias("n")), "language-votes",
    )
    agree = votes.where(F.col("_declared").isin(*model.languages)).agg(
        F.sum("n"), F.sum(F.when(F.col("_declared") == names[F.col("vote")], F.col("n")).otherwise(0))
    ).first()
    reliable = min(0.99, ((agree[1] or 0) + 1) / ((agree[0] or 0) + 2)) if n > 1 else 0.5
    each = votes.groupBy("_host", "vote").agg(F.sum("n").alias("n"))
    priors = materialize(_priors(each, n), "host-priors")
    base = F.lit(math.log(1.0 / n))
    joined = lookup_join(scored, priors, "_host", F.xxhash64("_text"), 80 + 8 * n, "left")
    known = F.col("_declared").isin(*model.languages)
    claim = F.transform(
        names, lambda x: F.when(~F.coalesce(known, F.lit(False)), F.lit(0.0))
        .when(x == F.col("_declared"), F.lit(math.log(reliable))).otherwise(F.lit(math.log((1 - reliable) / max(n - 1, 1))))
    )
    weight = F.col("_n") * F.lit(EVIDENCE) / (F.col("_n") + F.lit(EVIDENCE))
    prior = F.coalesce(_log(F.col("prior")), F.transform(names, lambda x: base))
    posterior = _sum(F.transform("_ll", lambda x: x * weight), claim, prior)
    out = joined.withColumn("_post", posterior).withColumn("_top", F.array_max("_post"))
    at = F.array_position("_post", F.col("_top")).cast("int") - 1
    share = F.lit(1.0) / F.aggregate("_post", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top")))
    even = -math.log(1 << FEATURE_BITS)
    out = out.select(
        "_keep.*", *body, F.when(F.col("_n") > 0, names[at]).alias("language"),
        F.when(F.col("_n") > 0, share).otherwise(F.lit(0.0)).alias("confidence"),
        F.coalesce((F.col("_n") > 0) & (share >= least) & (F.col("_ll")[at] > even), F.lit(False)).alias("accepted"),
    )
    return out


def page_text(html: Column) -> Column:
    """The text of a page: no scripts, styles, comments or tags."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->", " "), r"<[^>]*>", " ")


def page_language(html: Column) -> Column:
    """The language that the html tag declares, or null."""
    found = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1)
    return F.when(found != "", found)


def host(url: Column) -> Column:
    """The host name of an address, or null."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))
