"""Per-feature likelihood terms as SQL expressions over SQL operands.

Text keeps a term one expression however many classes it is repeated for.  Underflow and
undefined values are NULL, never NaN.
"""

from __future__ import annotations

import math

DENSITIES = ("gaussian", "bernoulli", "multinoulli")


def literal(value) -> str:
    """A Python number or string as a SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def literal_array(values) -> str:
    return "array(" + ", ".join(literal(v) for v in values) + ")"


def gaussian_log_density(x: str, mean: str, std: str) -> str:
    """Log of the normal density; NULL where the density itself underflows to 0."""
    exponent = f"-pow({x} - {mean}, 2D) / (2D * pow({std}, 2D))"
    return f"ln(nullif(exp({exponent}) / ({literal(math.sqrt(2.0 * math.pi))} * {std}), 0D))"


def probability_term(probability: str, log_terms: bool) -> str:
    """A raw probability as it is, or its log when the textbook form is asked for."""
    return f"ln(nullif({probability}, 0D))" if log_terms else probability


def bernoulli_term(x: str, mean: str, log_terms: bool = False) -> str:
    return probability_term(f"if({x} <> 0, {mean}, 1D - {mean})", log_terms)
