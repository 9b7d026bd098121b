"""Registered queries and the SQL each one is checked against."""

from . import bayes_queries, class_queries, corpus, margin_queries, neighbour_queries, sets, sparse_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
