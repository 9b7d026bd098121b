"""A seeded, engine-independent pseudo-random order: the md5 of ``seed:id``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(seed: int, id_col: str | Column) -> Column:
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))
