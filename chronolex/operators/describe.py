"""Topic descriptions from topic-word weights (topic, word, weight)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def word_probabilities(weights: DataFrame, min_score: float = 0.01, min_probability: float = 0.0001) -> DataFrame:
    """Add prob: the share of a word in its topic, over words of a weight above min_score (strictly).

    The sum comes before the cut by probability; topics without weight vanish.
    """
    total = F.sum("weight").over(Window.partitionBy("topic"))
    kept = weights.where(F.col("weight") > min_score).withColumn("_total", total).where("_total > 0")
    return kept.withColumn("prob", F.col("weight") / F.col("_total")).where(F.col("prob") >= min_probability).drop("_total")


def top_words(probs: DataFrame, n: int = 200) -> DataFrame:
    """The n likeliest words of each topic with their rank; ties by the word."""
    order = Window.partitionBy("topic").orderBy(F.desc("prob"), "word")
    return probs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def descriptions(ranked: DataFrame) -> DataFrame:
    """One row for each topic: word_probs, an ordered array of (word, prob)."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "word", "prob")))
    return ranked.groupBy("topic").agg(F.transform(ordered, lambda x: F.struct(x["word"].alias("word"), x["prob"].alias("prob"))).alias("word_probs"))


def runs(rows: DataFrame, order: str, value: str = "topic", block: int = 100_000) -> DataFrame:
    """Add run: the number of the stretch of equal neighbouring values that a row lies in, by the whole numbers ``order``.

    Rows are numbered within blocks of the order; one row for each block tells how many runs lie before it and whether its
    first goes on from the last block, so no task gets all rows.
    """
    named = rows.withColumn("_block", F.floor(F.col(order) / block))
    w = Window.partitionBy("_block").orderBy(order)
    new = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    first = F.when(F.row_number().over(w) == 1, 1).otherwise(new)
    inner = named.withColumn("_new", first).withColumn("_at", F.sum("_new").over(w))
    whole = F.struct(F.col(value).alias("v"))
    blocks = inner.groupBy("_block").agg(F.max("_at").alias("n"), F.min_by(whole, order).alias("head"), F.max_by(whole, order).alias("tail"))
    over = Window.orderBy("_block")
    goes_on = F.coalesce(F.lag("tail").over(over).eqNullSafe(F.col("head")), F.lit(False)).cast("int")
    blocks = blocks.withColumn("_less", goes_on).withColumn("_before", F.sum(F.col("n") - F.col("_less")).over(over) - F.col("n"))
    out = inner.join(blocks.select("_block", "_before"), "_block").withColumn("run", F.col("_before") + F.col("_at"))
    return out.select(*rows.columns, "run")
