"""Narrow (shuffle-free) text expressions over one document row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .porter import stem_tokens  # noqa: F401  (re-exported)

def clean_tokens(text: Column, min_len: int = 1) -> Column:
    """Lower-case tokens longer than ``min_len``, a null text giving an empty array.

    Letters and digits make up tokens, anything else separates them, and tokens with a digit
    are dropped: one regular-expression pass finds the all-letter runs that no letter or
    digit touches."""
    word = rf"(?<![\p{{L}}\p{{N}}])\p{{L}}{{{min_len + 1},}}+(?![\p{{L}}\p{{N}}])"
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(word), F.lit(0))


def explode_tokens(tokens: Column, name: str):
    """One row per token.  The outer form with ``present`` afterwards keeps the optimizer
    from evaluating the token expression a second time for a size filter."""
    return F.explode_outer(tokens).alias(name)


def present(name: str) -> Column:
    return F.col(name).isNotNull()


def without_words(tokens: Column, words: Sequence[str]) -> Column:
    """Drop listed words; repeats and order of the remaining tokens survive.

    A literal list becomes a hash set inside the expression, so there is no join."""
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(list(words)))


def run_lengths(terms: Column) -> Column:
    """(term, tf) for each distinct element: run lengths of the sorted array.

    The one-element arrays give the sorted array and the starts of its runs a name, so each is
    worked out once."""

    def runs(s: Column, starts: Column) -> Column:
        following = lambda i: F.coalesce(F.get(starts, i + 1), F.size(s) + 1)
        return F.transform(
            starts, lambda p, i: F.struct(F.get(s, p - 1).alias("term"), (following(i) - p).cast("long").alias("tf"))
        )

    def counted(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(s)), lambda p: (p == 1) | (F.get(s, p - 1) != F.get(s, p - 2)))
        return F.transform(F.array(first), lambda starts: runs(s, starts))[0]

    return F.when(F.size(terms) > 0, F.transform(F.array(F.sort_array(terms)), counted)[0])


def ngrams(tokens: Column, n: int) -> Column:
    """Contiguous n-token windows joined by a space; empty if there are fewer than n."""
    if n == 1:
        return tokens
    starts = F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))
