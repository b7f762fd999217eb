"""Rows of topic proportions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounding_digits(eps: float) -> int:
    """Digits that a proportion is rounded to: 0.02 gives 3, 0.0001 gives 5."""
    return math.ceil(abs(math.log10(eps))) + 1


def parse_dense(fields: Column) -> Column:
    """Fields idx, name, p0, p1, ...: an array of (t, p), t being the place."""
    return F.transform(F.slice(fields, 3, F.greatest(F.size(fields) - 2, F.lit(0))), lambda p, t: F.struct(t.alias("t"), p.cast("double").alias("p")))


def parse_sparse(fields: Column) -> Column:
    """Fields idx, name, (topic, p)*: an array of (t, p)."""
    pairs = F.floor((F.size(fields) - 2) / 2).cast("int")
    item = lambda k: F.struct(
        F.get(fields, 2 * k).cast("int").alias("t"), F.get(fields, 2 * k + 1).cast("double").alias("p")
    )
    return F.when(pairs > 0, F.transform(F.sequence(F.lit(1), F.greatest(pairs, F.lit(1))), item)).otherwise(F.array().cast("array<struct<t:int,p:double>>"))


def above(topics: Column, eps: float) -> Column:
    """Topics with p of at least eps, p rounded after the comparison; sorted by the rounded p, then the topic."""
    kept = F.transform(
        F.filter(topics, lambda x: x["p"] >= eps), lambda x: F.struct((-F.round(x["p"], rounding_digits(eps))).alias("m"), x["t"].alias("t"))
    )
    return F.transform(F.array_sort(kept), lambda x: F.struct(x["t"].alias("t"), (-x["m"]).alias("p")))
