"""From raw documents to token ids: language, lines, near copies, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and
reads it again as the next stage's documents.  Rows keep all columns of ``documents`` up to the
last stage.  A stage's decisions take effect: it drops rows or rewrites texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagwright.llm import language
from tagwright.llm.catalog import table, tokenizer_path
from tagwright.llm.contamination import benchmark_hits, contaminated
from tagwright.llm.jaccard import similar_groups
from tagwright.llm.lines import deduplicate_lines
from tagwright.llm.pieces import KEPT_LEAN, encode_documents
from tagwright.operators.lookup import fits_broadcast
from tagwright.sources.scratch import materialize


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the other columns as one, so that no name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias("row"))


def _unpacked(rows: DataFrame, columns: list[str], **changed) -> DataFrame:
    changed["text"] = F.col("text")
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an accepted language; texts without letters and texts that no language
    makes likelier than mixed letters go.  The text model is trained on the stage's own rows."""
    model = language.fit_text(docs)
    rows = _packed(docs)
    found = language.identify(rows, model, rows["text"], rows["row.lang"], rows["row.source"], ["row"], keep_text=True)
    return _unpacked(found.where("accepted"), docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier line up to a word."""
    found = deduplicate_lines(_packed(docs), carry=("row",))
    return _unpacked(found, docs.columns, n_chars=F.length("text").cast(docs.schema["n_chars"].dataType))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    groups = similar_groups(docs)
    gone = materialize(groups.where("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    if fits_broadcast(gone.count(), 16):
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    found = benchmark_hits(_packed(docs), table(spark, sf_dir, "benchmark"), carry=("row",), keep_text=True)
    return _unpacked(found.where(~contaminated(F.col("n_hit"), F.col("n_words"))), docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit) and the text that the ids decode to."""
    return encode_documents(docs, tokenizer_path("piece_bpe_32k.model"), kept=KEPT_LEAN)


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("encoding", encoding_stage),
]

# No SQL encodes with a BPE model; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
