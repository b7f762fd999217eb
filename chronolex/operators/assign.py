"""Topic assignments of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolex.functions.ids import format_topic_id, normalize_ci_ref
from chronolex.functions.topics import above


def first_of_id(rows: DataFrame, order: str = "idx") -> DataFrame:
    """Add ci_ref, the normalised name, and keep the first row of each."""
    w = Window.partitionBy("ci_ref").orderBy(order)
    return rows.withColumn("ci_ref", normalize_ci_ref(F.col("name"))).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def assignments(rows: DataFrame, eps: float = 0.02) -> DataFrame:
    """Rows with topics (t, p) cut at eps and sorted; a document without any topic stays."""
    return rows.withColumn("topics", above(F.col("topics"), eps)).withColumn("min_p", F.lit(eps))


def last_text(texts: DataFrame) -> DataFrame:
    """The text of each normalised id; of several the one of the last line."""
    return texts.groupBy(normalize_ci_ref(F.col("id")).alias("ci_ref")).agg(F.max_by("text", "line").alias("original_text"))


def with_texts(assigned: DataFrame, texts: DataFrame) -> DataFrame:
    """Add original_text, null where there is none."""
    return assigned.join(last_text(texts), "ci_ref", "left")


def with_words(assigned: DataFrame, words: DataFrame) -> DataFrame:
    """One row for each topic of a document with the topic's words (topic, words), an empty array where there are none."""
    each = assigned.select("ci_ref", F.explode("topics").alias("x")).select("ci_ref", "x.t", "x.p")
    return each.join(words, each["t"] == words["topic"], "left").select("ci_ref", "t", "p", F.coalesce("words", F.array().cast("array<string>")).alias("words"))


def named_topics(assigned: DataFrame, model: str, lang: str, topics: int) -> DataFrame:
    """The topics with names instead of numbers."""
    each = assigned.select("ci_ref", F.posexplode("topics").alias("pos", "x"))
    each = each.withColumn("t", format_topic_id(F.col("x.t"), model, F.lit(lang), topics))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "t", F.col("x.p").alias("p"))))
    return each.groupBy("ci_ref").agg(F.transform(ordered, lambda x: F.struct(x["t"].alias("t"), x["p"].alias("p"))).alias("topics"))
