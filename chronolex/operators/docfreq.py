"""Document frequencies of lemmas in eligible texts (rows of ci_id and lemmas)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolex.operators.vocab import word_counts


def document_frequencies(texts: DataFrame) -> DataFrame:
    """Per lemma: rows that hold it (a repeated id counts again) and occurrences, both counted in batches of texts before one shuffle."""
    counts = word_counts(texts, F.col("lemmas"), (), rows=True)
    return counts.select(F.col("word").alias("lemma"), F.col("d").alias("document_frequency"), F.col("n").alias("total_frequency"))


def rare(freqs: DataFrame, max_df: int) -> DataFrame:
    """Lemmas of at most max_df documents, rarest first."""
    if max_df < 1:
        raise ValueError("max_df must be 1 at least")
    return freqs.where(F.col("document_frequency") <= max_df).orderBy("document_frequency", F.desc("total_frequency"), "lemma")


def rare_ids(texts: DataFrame, max_df: int) -> DataFrame:
    """The lemmas of at most max_df rows, with the sorted ids of these.

    One id more than that of each lemma is enough to tell, so Spark cuts the rows of frequent lemmas before the shuffle.
    """
    pairs = texts.select("ci_id", F.explode(F.array_distinct("lemmas")).alias("lemma"))
    first = pairs.withColumn("_rank", F.row_number().over(Window.partitionBy("lemma").orderBy("ci_id"))).where(F.col("_rank") <= max_df + 1)
    ids = first.groupBy("lemma").agg(F.array_sort(F.collect_list("ci_id")).alias("document_ids"))
    return ids.where(F.size("document_ids") <= max_df)


def totals(texts: DataFrame, max_df: int) -> DataFrame:
    """Documents, tokens, vocabulary size and reported lemmas, one row, from one pass: the null lemma stands for the documents."""
    marked = texts.select(F.concat(F.array(F.lit(None).cast("string")), "lemmas").alias("lemmas"))
    freqs = document_frequencies(marked)
    word = F.col("lemma").isNotNull()
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return freqs.agg(
        zero(F.when(~word, F.col("document_frequency"))).alias("documents"), zero(F.when(word, F.col("total_frequency"))).alias("tokens"),
        F.count_if(word).alias("vocabulary"), F.count_if(word & (F.col("document_frequency") <= max_df)).alias("reported"),
    )
