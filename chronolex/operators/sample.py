"""Deterministic stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolex.functions.ids import sample_score_md5, stratum_key


def scored(rows: DataFrame, fields=("newspaper", "decade"), score: Column | None = None) -> DataFrame:
    """Add stratum and score (default: the md5 of seed 42)."""
    return rows.withColumns({"stratum": stratum_key(F.col("ci_id"), fields), "score": sample_score_md5(F.col("ci_id")) if score is None else score})


def top_of_strata(rows: DataFrame, k: int | None, row: str = "row") -> DataFrame:
    """The k rows of each stratum with the least scores; of equal ones the greater row stays. None or 0: all.

    Spark cuts each partition's rows to k for a stratum before the shuffle.
    """
    if not k:
        return rows
    order = Window.partitionBy("stratum").orderBy("score", F.desc(row))
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def dedupe(rows: DataFrame, row: str = "row") -> DataFrame:
    """One row for each id, the first by score."""
    order = Window.partitionBy("ci_id").orderBy("score", F.desc(row))
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def sample(rows: DataFrame, size: int, per_stratum: int | None = None, min_per_stratum: int = 0, guarantee: bool = False) -> DataFrame:
    """The best-scored rows: capped in each stratum, then one for each id, then ``size`` of all.

    The cap comes before the ids are made unique, so repeated rows use it up. ``min_per_stratum`` changes nothing unless
    ``guarantee`` asks for it; then so many of each stratum come first.
    """
    chosen = dedupe(top_of_strata(rows, per_stratum))
    if guarantee and min_per_stratum:
        rank = F.row_number().over(Window.partitionBy("stratum").orderBy("score", "ci_id"))
        return chosen.withColumn("_late", rank > min_per_stratum).orderBy("_late", "score", "ci_id").limit(size).drop("_late")
    return chosen.orderBy("score", "ci_id").limit(size)


def stratum_counts(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of each stratum before and after the selection."""
    before = rows.groupBy("stratum").agg(F.count("*").alias("available"))
    after = chosen.groupBy("stratum").agg(F.count("*").alias("selected"))
    return before.join(after, "stratum", "full").na.fill(0, ["available", "selected"])
