"""Topic models with pyspark.ml."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vectorizer(vocab: list[str]) -> CountVectorizerModel:
    """A count vectorizer over a fixed vocabulary; other words are dropped.

    The vocabulary goes to the JVM as one text: ``from_vocabulary`` sends each word by itself, which takes minutes for a million.
    """
    if not vocab or any("\0" in w for w in vocab):
        return CountVectorizerModel.from_vocabulary(vocab, inputCol="lemmas", outputCol="features")
    words = SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile("\0").split("\0".join(vocab), -1)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", words)
    model.setInputCol("lemmas").setOutputCol("features")
    model._set(vocabSize=len(vocab))
    return model


def bag_of_words(texts: DataFrame, vocab: DataFrame | None = None, on: Iterable[str] = ()) -> DataFrame:
    """Counts (on, ci_id, lemma, n) of the words of a frozen vocabulary (on, lemma); other words are dropped. Without one all words count.

    Texts are shuffled by their id, not their words, which are counted where the text is.
    """
    by = [*on, "ci_id"]
    each = texts.select(*by, "lemmas").repartition(*[F.col(c) for c in by]).select(*by, F.explode("lemmas").alias("lemma"))
    counts = each.groupBy(*by, "lemma").agg(F.count("*").alias("n"))
    return counts if vocab is None else counts.join(vocab, [*on, "lemma"], "left_semi").select(*by, "lemma", "n")


def train(vectors: DataFrame, k: int, iterations: int = 20, optimizer: str = "em", seed: int = 42) -> LDAModel:
    return LDA(k=k, maxIter=iterations, optimizer=optimizer, seed=seed, optimizeDocConcentration=optimizer == "online").fit(vectors)


def weights(model: LDAModel, vocab: list[str], n: int | None = None) -> DataFrame:
    """Rows (topic, word, weight), the n heaviest words of each topic (default: all)."""
    topics = model.describeTopics(n or len(vocab))
    pairs = F.explode(F.arrays_zip("termIndices", "termWeights")).alias("x")
    words = topics.sparkSession.createDataFrame(pa.table({"place": pa.array(range(len(vocab)), pa.int32()), "word": pa.array(vocab, pa.string())}))
    rows = topics.select("topic", pairs).select("topic", F.col("x.termIndices").alias("place"), F.col("x.termWeights").alias("weight"))
    return rows.join(words, "place").select("topic", "word", "weight")


def infer(model: LDAModel, vectors: DataFrame) -> DataFrame:
    """Rows (ci_id, topics), an array of the proportions."""
    return model.transform(vectors).select("ci_id", vector_to_array("topicDistribution").alias("topics"))
