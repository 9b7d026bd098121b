"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import language, manifest
from .contamination import benchmark_hits, contaminated
from .jaccard import similar_groups
from .licenses import BASE, NOTICES, SHARE, SLACK, Template, key_bits, scan_licenses
from .lines import deduplicate_lines
from .passages import near_passages
from .pieces import encode_documents
from .quality import score_documents
from .substrings import remove_repeats
from .surrogates import replace_entities
from .vectors import cosine_links
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; ids and texts as digests."""
    coded = encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


UPPER, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP3_SQL = rf"""WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER_LETTERS}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER_LETTERS}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[s:s + 12], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
dwin AS (
  SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS t
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s
        FROM dw CROSS JOIN (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
occ AS (SELECT doc_id, s, item_id, win.m FROM dwin JOIN win ON dwin.m = win.m AND dwin.t = win.t),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id"""


@query("op3_decontamination", OP3_SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items they come from."""
    found = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


OP10_SQL = rf"""WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER_LETTERS}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM dw WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sh x JOIN sh y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(doc_id, m) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT link.b, reach.m FROM reach JOIN link ON reach.doc_id = link.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(m) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN reach r ON d.doc_id = r.doc_id GROUP BY ALL"""


@query("op10_jaccard_join", OP10_SQL)
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose word shingles are three quarters common."""
    return similar_groups(table(spark, sf_dir, "documents"))


OP8_SQL = """WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT p.vec_id AS a, q.vec_id AS b
  FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= 0.93),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
reach(vec_id, m) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT link.b, reach.m FROM reach JOIN link ON reach.vec_id = link.a)
SELECT d.vec_id, coalesce(n.n, 0) AS n_links, min(m) AS component_id, d.vec_id = min(m) AS kept
FROM embeddings d LEFT JOIN n ON d.vec_id = n.a JOIN reach r ON d.vec_id = r.vec_id GROUP BY d.vec_id, n.n"""


@query("op8_embedding_dedup", OP8_SQL)
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label, one row per vector."""
    return cosine_links(table(spark, sf_dir, "embeddings"))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document outside repeated 200-byte strings."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP7_SQL = r"""WITH ln AS (
  SELECT doc_id, i - 1 AS no, parts[i] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
judged AS (
  SELECT doc_id, no, w, array_to_string(w, ' ') AS t
  FROM (SELECT doc_id, no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM ln) WHERE len(w) >= 5),
cls AS (SELECT t, any_value(w) AS w, min((doc_id, no)) AS first FROM judged GROUP BY t),
del AS (
  SELECT t, first, i, md5(array_to_string(w[:i - 1] || w[i + 1:], ' ')) AS v
  FROM (SELECT t, first, w, unnest(range(1, len(w) + 1)) AS i FROM cls)),
same AS (SELECT v, i, min(first) AS m FROM del GROUP BY v, i),
whole AS (SELECT md5(t) AS v, first AS m FROM cls),
less AS (SELECT v, min(first) AS m FROM del GROUP BY v),
near AS (
  SELECT DISTINCT t FROM (
    SELECT del.t FROM del JOIN same ON del.v = same.v AND del.i = same.i WHERE same.m < del.first
    UNION ALL SELECT del.t FROM del JOIN whole ON del.v = whole.v WHERE whole.m < del.first
    UNION ALL SELECT cls.t FROM cls JOIN less ON md5(cls.t) = less.v WHERE less.m < cls.first)),
gone AS (
  SELECT j.doc_id, j.no FROM judged j JOIN cls ON j.t = cls.t LEFT JOIN near ON j.t = near.t
  WHERE (j.doc_id, j.no) > cls.first OR near.t IS NOT NULL),
kept AS (
  SELECT ln.doc_id, count(*) AS n_lines, count(gone.no) AS n_removed,
    string_agg(line, chr(10) ORDER BY ln.no) FILTER (WHERE gone.no IS NULL) AS body
  FROM ln LEFT JOIN gone ON ln.doc_id = gone.doc_id AND ln.no = gone.no GROUP BY ln.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(body, '')) END AS text_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id"""


@query("op7_line_dedup", OP7_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier one up to a word."""
    found = deduplicate_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("text_sha256")
    )


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (declared by its column, address: its source) and of every
    page (declared by its html tag, address: its host)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.fit_text(docs)
    one = language.identify(docs, model, docs["text"], docs["lang"], docs["source"], ["doc_id"])
    html = pages["html"]
    two = language.identify(
        pages, model, language.page_text(html), language.page_language(html), language.host(pages["url"]), ["page_id"]
    )
    both = one.unionByName(two, allowMissingColumns=True)
    return both.select("doc_id", "page_id", "language", F.round("confidence", 6).alias("confidence"), "accepted")


@query("op9_pii_surrogates")
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    found = replace_entities(table(spark, sf_dir, "documents"), "registered-query")
    return found.select("doc_id", "n_entities", "text")


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of the documents labelled good."""
    found = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "language", "trusted", "n_bytes", F.round("cross_entropy", 5).alias("cross_entropy"),
        F.round(F.exp("cross_entropy"), 3).alias("perplexity"), "threshold", "kept",
    )


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat, nearly or exactly, in any document."""
    return near_passages(table(spark, sf_dir, "documents"))


def _level(table: str, k: int) -> str:
    return f"""{table}{k + 1} AS (
  SELECT tree, idx // 8 AS idx, (n + 7) // 8 AS n,
    CASE WHEN n = 1 THEN any_value(hash) ELSE sha256(string_agg(hash, '' ORDER BY idx)) END AS hash
  FROM {table}{k} GROUP BY tree, idx // 8, n)"""


def _step(table: str, climb: str, k: int) -> str:
    return f"""{climb}{k + 1} AS (
  SELECT c.uid, c.tree, c.lang_no, c.idx // 8 AS idx,
    CASE WHEN any_value(t.n) = 1 THEN c.folded ELSE
      sha256(string_agg(CASE WHEN t.idx = c.idx THEN c.folded ELSE t.hash END, '' ORDER BY t.idx)) END AS folded,
    c.proof || coalesce(string_agg(t.hash, '' ORDER BY t.idx) FILTER (t.idx <> c.idx), '') AS proof
  FROM {climb}{k} c JOIN {table}{k} t ON c.tree = t.tree AND c.idx // 8 = t.idx // 8
  GROUP BY c.uid, c.tree, c.lang_no, c.idx, c.folded, c.proof)"""


def manifest_sql(levels: int = 8, top_levels: int = 4) -> str:
    """Up to 8 ** levels rows of a language and 8 ** top_levels languages."""
    h = lambda text: "sha256(" + " || ".join(
        f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)
    ) + ")"
    bit = "CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1))::BIGINT) ELSE c END"
    crc = f"""xor(list_reduce(range(0, 8 * strlen(doc_id::VARCHAR)),
      lambda c, i: xor(({bit}) >> 1, 3988292384 * (({bit}) & 1)), 4294967295::BIGINT), 4294967295)"""
    parts = [
        f"""d AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER_LETTERS}') ELSE text END AS t FROM documents)""",
        f"leaf AS (SELECT row_number() OVER () AS uid, doc_id, lang, {h('text')} AS leaf, {h('t')} AS changed FROM d)",
        """pos AS (SELECT uid, doc_id, leaf, changed, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM leaf)""",
        "a0 AS (SELECT tree, idx, n, leaf AS hash FROM pos)",
        *[_level("a", k) for k in range(levels)],
        f"b0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, hash FROM a{levels})",
        *[_level("b", k) for k in range(top_levels)],
        "c0 AS (SELECT uid, tree, tree AS lang_no, idx, changed AS folded, '' AS proof FROM pos)",
        *[_step("a", "c", k) for k in range(levels)],
        f"e0 AS (SELECT uid, 0 AS tree, lang_no, lang_no AS idx, folded, proof FROM c{levels})",
        *[_step("b", "e", k) for k in range(top_levels)],
    ]
    return "WITH " + ", ".join(parts) + f"""
SELECT doc_id, leaf, a{levels}.hash AS subroot, b{top_levels}.hash AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = b{top_levels}.hash AS verified
FROM pos JOIN e{top_levels} e ON pos.uid = e.uid JOIN a{levels} ON a{levels}.tree = pos.tree CROSS JOIN b{top_levels}"""


OP12_SQL = manifest_sql()


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document audited against the manifest, a third of them with changed letters."""
    docs = table(spark, sf_dir, "documents")
    return manifest.audit(manifest.build_manifest(docs, manifest.lower_text(docs)))


def licenses_sql(templates: tuple[Template, ...] = BASE + NOTICES) -> str:
    values = ", ".join(f"({i}, '{x.label}', {x.base}, {key_bits(x)}, '{x.text}')" for i, x in enumerate(templates))
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return rf"""WITH tw AS (SELECT t, label, base, needed, string_split(txt, ' ') AS w FROM (VALUES {values}) v(t, label, base, needed, txt)),
tg AS (
  SELECT t, label, base, needed, len(w) - 2 AS n, p, array_to_string(w[p + 1:p + 3], ' ') AS g
  FROM (SELECT *, unnest(range(0, len(w) - 2)) AS p FROM tw)),
dw AS (
  SELECT row_number() OVER () AS uid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER_LETTERS}'), {word}) AS w FROM documents),
dg AS (
  SELECT uid, p, array_to_string(w[p + 1:p + 3], ' ') AS g FROM (SELECT uid, w, unnest(range(0, len(w) - 2)) AS p FROM dw)),
hit AS (SELECT uid, t, label, base, needed, n, dg.p - tg.p AS diagonal, tg.p AS place FROM dg JOIN tg ON dg.g = tg.g),
banded AS (
  SELECT *, CASE WHEN base THEN diagonal ELSE floor(diagonal / {SLACK}) - shift END AS band
  FROM hit, (VALUES (0), (1)) s(shift) WHERE shift = 0 OR NOT base),
span AS (
  SELECT uid, label, base, band, count(DISTINCT place) / any_value(n) AS share,
    bit_or(1::BIGINT << place) & any_value(needed) = any_value(needed) AS whole
  FROM banded GROUP BY uid, t, label, base, band),
found AS (
  SELECT uid, label, share, base AND share = 1 AS place, (base AND share = 1) OR (NOT base AND share >= {SHARE} AND whole) AS ok, band FROM span),
each AS (
  SELECT uid, count(*) FILTER (place) AS n_base, min(band) FILTER (place) AS first_word, max(band) FILTER (place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ok) AS labels, max(share) AS score
  FROM found GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM dw LEFT JOIN each ON dw.uid = each.uid"""


OP13_SQL = licenses_sql()


@query("op13_license_scan", OP13_SQL)
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence statements of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the sixteen leading whitened components of the distinct vectors."""
    return whiten(table(spark, sf_dir, "embeddings"))
