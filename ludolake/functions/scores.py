"""Arithmetic of the scored marts, as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_score(terms: Sequence[tuple[Column, float]]) -> Column:
    """Sum of ``column * weight`` in double precision, added left to right."""
    return reduce(add, [term.cast("double") * F.lit(float(weight)) for term, weight in terms])


def inverted(percentile: Column) -> Column:
    """100 - p, so that a low percentile scores high."""
    return F.lit(100) - percentile


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else 0.

    A missing numerator counts as 0.
    """
    return F.when(
        denominator > 0, F.coalesce(numerator, F.lit(0.0)) / denominator
    ).otherwise(F.lit(0.0))


def bayesian_rating(rating: Column, votes: Column, mean: Column, prior_votes: Column) -> Column:
    """v/(v+m) * R + m/(v+m) * C.

    The vote count passes through a 32-bit float, as in the published scores.
    """
    total = votes + prior_votes
    return (votes.cast("float") / total) * rating + (prior_votes / total) * mean
