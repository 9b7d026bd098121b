"""Registered queries over document text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as tx
from ..operators.knn import pair_cosines_packed
from ..plans.features import weighted_terms
from ..sources.scratch import materialize
from .registry import query, rounded, sql_list, table

# Fixed value: the short function-word list of the registered queries.
STOPWORDS = (
    "the", "of", "and", "to", "in", "is", "for", "that", "with", "as", "by", "on", "this", "are",
    "der", "die", "das", "und", "ist", "von", "mit", "el", "los", "las", "que", "por", "con",
    "le", "les", "des", "du", "et", "la", "une",
)
RANK_THRESHOLD = 5.0

TOKENS = r"""tok AS (SELECT doc_id, list_filter(
    regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
    lambda x: regexp_matches(x, '^\p{L}+$') AND length(x) > 1) AS tokens FROM documents)"""
STOPPED = f"""{TOKENS}, st AS (SELECT doc_id,
    list_filter(tokens, lambda x: x NOT IN ({sql_list(STOPWORDS)})) AS tokens FROM tok)"""
EXPLODED = f"""{STOPPED}, ex AS (SELECT doc_id, unnest(tokens) AS term,
    generate_subscripts(tokens, 1) AS pos FROM st)"""
COUNTS = f"""{EXPLODED}, bag AS (SELECT doc_id, term, count(*) AS tf FROM ex GROUP BY ALL)"""
WEIGHTS = f"""{COUNTS}, dfs AS (SELECT term, count(*) AS df, sum(tf) AS tf FROM bag GROUP BY term),
  idf AS (SELECT term, ln((SELECT count(*) FROM documents)::DOUBLE / (1 + df)) AS idf FROM dfs),
  wd AS (SELECT doc_id, term, ln(1 + tf) / nullif(idf, 0) AS weight FROM bag JOIN idf USING (term)
    WHERE idf <> 0),
  wn AS (SELECT doc_id, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight
    FROM wd)"""


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def stopped(spark, sf_dir):
    """Cleaned token arrays."""
    return tx.remove_stopwords(tx.tokenize(documents(spark, sf_dir)), STOPWORDS)


@query("tokens_clean", f"WITH {TOKENS} SELECT doc_id, array_to_string(tokens, ' ') AS text, len(tokens)::BIGINT AS n_tokens FROM tok")
def tokens_clean(spark, sf_dir):
    tokens = tx.tokenize(documents(spark, sf_dir))
    return tokens.select(
        "doc_id", F.array_join("tokens", " ").alias("text"), F.size("tokens").cast("long").alias("n_tokens")
    )


@query("stopwords_removed", f"WITH {STOPPED} SELECT doc_id, array_to_string(tokens, ' ') AS text FROM st")
def stopwords_removed(spark, sf_dir):
    return tx.rejoin(stopped(spark, sf_dir))


NGRAMS_2 = f"""WITH {EXPLODED}, g AS (SELECT doc_id, term || ' ' ||
    lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS term FROM ex)
  SELECT doc_id, term, count(*) AS tf FROM g WHERE term IS NOT NULL GROUP BY ALL"""


@query("ngrams_2", NGRAMS_2)
def ngrams_2(spark, sf_dir):
    return tx.bag_of_words(stopped(spark, sf_dir), 2)


@query("vocabulary", f"WITH {EXPLODED} SELECT DISTINCT term FROM ex")
def vocabulary(spark, sf_dir):
    return tx.vocabulary(stopped(spark, sf_dir))


VOCABULARY_SPAN = f"""WITH {EXPLODED} SELECT DISTINCT term FROM (SELECT term || ' ' ||
    lead(term, 1) OVER w || ' ' || lead(term, 2) OVER w AS term FROM ex WINDOW w AS (ORDER BY doc_id, pos))
  WHERE term IS NOT NULL"""


@query("vocabulary_span", VOCABULARY_SPAN)
def vocabulary_span(spark, sf_dir):
    return tx.vocabulary(stopped(spark, sf_dir), 3, span_documents=True)


@query("bag_of_words", f"WITH {COUNTS} SELECT doc_id, term, tf FROM bag")
def bag_of_words(spark, sf_dir):
    return tx.bag_of_words(stopped(spark, sf_dir))


def _weights(spark, sf_dir, mode):
    tokens = stopped(spark, sf_dir)
    docs = documents(spark, sf_dir)
    return tx.tfidf(tx.bag_of_words(tokens), docs, mode, frequency=tx.term_table(tokens))


@query("tfidf_divide", f"WITH {WEIGHTS} SELECT doc_id, term, round(weight, 6) + 0.0 AS weight FROM wd")
def tfidf_divide(spark, sf_dir):
    return _weights(spark, sf_dir, "divide").withColumn("weight", rounded("weight"))


@query(
    "tfidf_multiply",
    f"WITH {WEIGHTS} SELECT doc_id, term, round(ln(1 + tf) * idf, 6) + 0.0 AS weight FROM bag JOIN idf USING (term)",
)
def tfidf_multiply(spark, sf_dir):
    return _weights(spark, sf_dir, "multiply").withColumn("weight", rounded("weight"))


@query("tfidf_l2", f"WITH {WEIGHTS} SELECT doc_id, term, round(weight, 6) + 0.0 AS weight FROM wn")
def tfidf_l2(spark, sf_dir):
    weights = weighted_terms(documents(spark, sf_dir), STOPWORDS)
    return weights.withColumn("weight", rounded("weight"))


RANKED = f"""{WEIGHTS}, ranked AS (SELECT term, tf::BIGINT AS tf, df,
    (1 + ln(tf)) * ln((SELECT count(*) FROM documents)::DOUBLE / df) AS score FROM dfs)"""


@query("term_rank", f"WITH {RANKED} SELECT term, tf, df, round(score, 6) + 0.0 AS score FROM ranked")
def term_rank(spark, sf_dir):
    counts = tx.bag_of_words(stopped(spark, sf_dir))
    ranked = tx.term_rank(counts, documents(spark, sf_dir))
    return ranked.withColumn("score", rounded("score"))


TOP_TERMS = f"""WITH {RANKED}, r AS (SELECT term, score, row_number() OVER (ORDER BY score DESC, term)::INTEGER AS rank FROM ranked)
  SELECT term, round(score, 6) + 0.0 AS score, rank FROM r WHERE rank <= 800"""


@query("top_terms", TOP_TERMS)
def top_terms(spark, sf_dir):
    """The ranked vocabulary of a wide feature table."""
    counts = tx.bag_of_words(stopped(spark, sf_dir))
    best = tx.top_terms(tx.term_rank(counts, documents(spark, sf_dir)), 800)
    return best.select("term", rounded("score").alias("score"), "rank")


RANK_STOPWORDS = f"""WITH {RANKED}, kept AS (SELECT ex.doc_id, ex.term, ex.pos FROM ex
    JOIN ranked ON ex.term = ranked.term AND ranked.score > {RANK_THRESHOLD}),
  j AS (SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS text FROM kept GROUP BY doc_id)
  SELECT d.doc_id, coalesce(j.text, '') AS text FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id"""


@query("rank_stopwords", RANK_STOPWORDS)
def rank_stopwords(spark, sf_dir):
    tokens = tx.drop_low_ranked(stopped(spark, sf_dir), RANK_THRESHOLD)
    return tx.rejoin(tokens)


DICTIONARY_SHARE = rf"""WITH {STOPPED}, words AS (SELECT DISTINCT unnest(list_filter(
      regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'),
      lambda x: regexp_matches(x, '^\p{{L}}+$') AND length(x) > 1 AND x NOT IN ({sql_list(STOPWORDS)}))) AS word
    FROM benchmark),
  ex AS (SELECT doc_id, unnest(tokens) AS term FROM st),
  hits AS (SELECT doc_id, count(*)::DOUBLE AS n FROM ex JOIN words ON term = word GROUP BY doc_id)
  SELECT st.doc_id, round(CASE WHEN len(tokens) > 0 THEN coalesce(n, 0) / len(tokens) END, 6) AS share
  FROM st LEFT JOIN hits ON st.doc_id = hits.doc_id"""


@query("dictionary_share", DICTIONARY_SHARE)
def dictionary_share(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("text")
    words = tx.dictionary_words(items, STOPWORDS, stems=False)
    shares = tx.dictionary_share(stopped(spark, sf_dir), words)
    return shares.withColumn("share", rounded("share"))


def _porter_sql() -> str:
    """The published suffix rules.  They are given as one CTE per step over distinct tokens, written with
    whole-word patterns instead of the counting used on the Spark side."""
    c, v = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
    m0, m1, m1_only = f"^({c})?{v}{c}", f"^({c})?{v}{c}{v}{c}", f"^({c})?{v}{c}({v})?$"
    vowel, short = f"^({c})?[aeiouy]", f"^{c}[aeiouy][^aeiouwxy]$"

    def swap(pairs, condition):
        # longest suffix first; a suffix that matches without its condition ends the step
        whens = []
        for suffix, new in sorted(pairs, key=lambda p: -len(p[0])):
            head = f"left(w, length(w) - {len(suffix)})"
            whens.append(
                f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {condition(suffix, head)} THEN {head} || '{new}' ELSE w END"
            )
        return "CASE WHEN length(token) <= 2 THEN w " + " ".join(whens) + " ELSE w END"

    measured = lambda suffix, head: f"regexp_matches({head}, '{m0}')"
    step2 = [
        ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
        ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
        ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
        ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ]
    step3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
    step4 = [(s, "") for s in (
        "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
        "ism", "ate", "iti", "ous", "ive", "ize",
    )]
    removable = lambda suffix, head: f"regexp_matches({head}, '{m1}')" + (
        f" AND regexp_matches({head}, '[st]$')" if suffix == "ion" else ""
    )
    head1 = "left(w, length(w) - 1)"
    return f"""
  s0 AS (SELECT token, regexp_replace(token, '^y', 'Y') AS w FROM words),
  s1 AS (SELECT token, CASE WHEN length(token) <= 2 THEN w
      WHEN w LIKE '%sses' OR w LIKE '%ies' THEN left(w, length(w) - 2)
      WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN {head1}
      ELSE w END AS w FROM s0),
  s2 AS (SELECT token, w, CASE WHEN length(token) <= 2 OR w LIKE '%eed' THEN NULL
      WHEN w LIKE '%ed' AND regexp_matches(left(w, length(w) - 2), '{vowel}') THEN left(w, length(w) - 2)
      WHEN w LIKE '%ing' AND regexp_matches(left(w, length(w) - 3), '{vowel}') THEN left(w, length(w) - 3)
      END AS cut FROM s1),
  s3 AS (SELECT token, CASE
      WHEN length(token) > 2 AND w LIKE '%eed' AND regexp_matches(left(w, length(w) - 3), '{m0}')
        THEN left(w, length(w) - 1)
      WHEN cut IS NULL THEN w
      WHEN regexp_matches(cut, '(at|bl|iz)$') THEN cut || 'e'
      WHEN regexp_matches(cut, '[^aeiouylsz]$') AND right(cut, 1) = left(right(cut, 2), 1) AND length(cut) > 1
        THEN left(cut, length(cut) - 1)
      WHEN regexp_matches(cut, '{m1_only}') AND regexp_matches(cut, '{short}') THEN cut || 'e'
      ELSE cut END AS w FROM s2),
  s4 AS (SELECT token, CASE WHEN length(token) > 2 AND w LIKE '%y' AND regexp_matches({head1}, '{vowel}')
      THEN {head1} || 'i' ELSE w END AS w FROM s3),
  s5 AS (SELECT token, {swap(step2, measured)} AS w FROM s4),
  s6 AS (SELECT token, {swap(step3, measured)} AS w FROM s5),
  s7 AS (SELECT token, {swap(step4, removable)} AS w FROM s6),
  s8 AS (SELECT token, CASE WHEN length(token) > 2 AND w LIKE '%e' AND (regexp_matches({head1}, '{m1}')
        OR (regexp_matches({head1}, '{m1_only}') AND NOT regexp_matches({head1}, '{short}')))
      THEN {head1} ELSE w END AS w FROM s7),
  stems AS (SELECT token, lower(CASE WHEN length(token) > 2 AND w LIKE '%ll' AND regexp_matches(w, '{m1}')
      THEN {head1} ELSE w END) AS stem FROM s8)"""


PORTER = _porter_sql()
STEM_DICTIONARY = f"""WITH {STOPPED}, words AS (SELECT DISTINCT unnest(tokens) AS token FROM st), {PORTER}
  SELECT token, stem FROM stems"""


@query("stem_dictionary", STEM_DICTIONARY)
def stem_dictionary(spark, sf_dir):
    return tx.stem_dictionary(stopped(spark, sf_dir))


STEMMED_TEXT = f"""WITH {EXPLODED}, words AS (SELECT DISTINCT term AS token FROM ex), {PORTER},
  j AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS text FROM ex JOIN stems ON term = token
    WHERE stem NOT IN ({sql_list(STOPWORDS)}) GROUP BY doc_id)
  SELECT d.doc_id, coalesce(j.text, '') AS text FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id"""


@query("stemmed_text", STEMMED_TEXT)
def stemmed_text(spark, sf_dir):
    return tx.rejoin(tx.prepare(documents(spark, sf_dir), STOPWORDS))


PAIR_COUNTS = f"""WITH {COUNTS}, asked AS (SELECT d.doc_id, t.term FROM documents d,
    (SELECT unnest(['ing', 'er', 'on']) AS term) t)
  SELECT a.doc_id, a.term, coalesce(bag.tf, 0) AS tf FROM asked a LEFT JOIN bag
    ON a.doc_id = bag.doc_id AND a.term = bag.term"""


@query("counts_of", PAIR_COUNTS)
def counts_of(spark, sf_dir):
    """Explicit zeros for requested cells of the count table."""
    terms = F.array(*[F.lit(t) for t in ("ing", "er", "on")])
    asked = documents(spark, sf_dir).select("doc_id", F.explode(terms).alias("term"))
    return tx.counts_of(asked, tx.bag_of_words(stopped(spark, sf_dir)))


PAIR_COSINES_TEXT = f"""WITH {WEIGHTS}, pairs AS (SELECT doc_id AS a, doc_id + 1 AS b FROM documents
    WHERE doc_id + 1 IN (SELECT doc_id FROM documents)),
  dots AS (SELECT a, b, sum(x.weight * y.weight) AS s FROM pairs JOIN wn x ON x.doc_id = a
    JOIN wn y ON y.doc_id = b AND y.term = x.term GROUP BY a, b)
  SELECT p.a, p.b, round(coalesce(s, 0), 6) + 0.0 AS similarity FROM pairs p LEFT JOIN dots d ON p.a = d.a AND p.b = d.b"""


@query("pair_cosines_text", PAIR_COSINES_TEXT)
def pair_cosines_text(spark, sf_dir):
    docs = documents(spark, sf_dir)
    weights = materialize(weighted_terms(docs, STOPWORDS, packed=True), "weights")
    following = docs.select((F.col("doc_id") - 1).alias("a"), F.col("doc_id").alias("b"))
    pairs = docs.select(F.col("doc_id").alias("a")).join(following, "a")
    found = pair_cosines_packed(pairs, weights, "doc_id")
    return found.withColumn("similarity", rounded("similarity"))
