"""Validated topic labels: predicates over labels, and the loop that asks a labeller."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.functions.text import term_key

#: The types and confidences that a label may have.
TOPIC_TYPES = [
    "theme", "newspaper_genre", "political_news", "local_news", "international_news", "advertisement", "obituary", "culture_entertainment", "sports", "religion",
    "legal_administrative", "war_military", "economy_commerce", "literary_narrative", "family_everyday_life", "ocr_noise", "mixed_uncertain",
]
CONFIDENCES = ["high", "medium", "low"]
#: What a label must have.
REQUIRED = ["label_short", "label_long", "topic_type", "confidence", "rationale", "representative_terms"]


def term_lookup(words: DataFrame) -> DataFrame:
    """Per topic the key of each word and the word; of words with one key the last. words: topic_id, pos, word."""
    return words.groupBy("topic_id", term_key(F.col("word")).alias("key")).agg(F.max_by("word", "pos").alias("canonical"))


def resolve(labels: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (topic_id, pos, term, resolved): the words that each term stands for, null where it can't be resolved.

    A term is looked up as a whole, else by its words, all of which must be found.
    """
    lookup = term_lookup(words)
    terms = labels.select("topic_id", F.posexplode("representative_terms").alias("pos", "term"))
    whole = terms.withColumn("key", term_key(F.col("term"))).join(lookup, ["topic_id", "key"], "left")
    pieces = terms.select("topic_id", "pos", F.posexplode(F.split(F.btrim("term"), r"\s+")).alias("part", "piece")).withColumn("key", term_key(F.col("piece")))
    pieces = pieces.join(lookup.withColumnRenamed("canonical", "word"), ["topic_id", "key"], "left")
    joined = pieces.groupBy("topic_id", "pos").agg(
        F.count("*").alias("n"), F.count("word").alias("known"), F.array_sort(F.collect_list(F.struct("part", "word"))).alias("parts")
    )
    out = whole.join(joined, ["topic_id", "pos"], "left")
    split = F.when((F.col("n") > 1) & (F.col("n") == F.col("known")), F.transform("parts", lambda x: x["word"]))
    return out.select("topic_id", "pos", "term", F.when(F.col("canonical").isNotNull(), F.array("canonical")).otherwise(split).alias("resolved"))


def validate(labels: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (topic_id, reason): the first rule that a label breaks, null if none."""
    found = resolve(labels, words).groupBy("topic_id").agg(F.count_if(F.col("resolved").isNull()).alias("unknown"), F.sum(F.size(F.coalesce("resolved", F.array()))).alias("total"))
    missing: Column = F.lit(False)
    for name in REQUIRED:
        missing |= F.col(name).isNull()
    reason = (
        F.when(missing, "missing_field")
        .when(~F.col("topic_type").isin(TOPIC_TYPES), "topic_type")
        .when(~F.col("confidence").isin(CONFIDENCES), "confidence")
        .when(~F.size("representative_terms").between(5, 10), "term_count")
        .when(F.col("unknown") > 0, "unknown_term")
        .when(~F.col("total").between(5, 10), "resolved_count")
    )
    return labels.join(found, "topic_id", "left").select("topic_id", reason.alias("reason"))


def same_ids(labels: DataFrame, topics: DataFrame) -> DataFrame:
    """Ids that occur oftener on one side, with the side: empty if both are the same bag."""
    a, b = labels.select("topic_id"), topics.select("topic_id")
    return a.exceptAll(b).withColumn("side", F.lit("label")).union(b.exceptAll(a).withColumn("side", F.lit("topic")))


def summary(labels: DataFrame) -> DataFrame:
    """Labels by confidence, with the ids of noise and of mixed topics."""
    ids = lambda kind: F.array_sort(F.collect_list(F.when(F.col("topic_type") == kind, F.col("topic_id"))))
    return labels.groupBy("confidence").agg(F.count("*").alias("labels"), ids("ocr_noise").alias("noise"), ids("mixed_uncertain").alias("mixed"))


class Labeler(Protocol):
    """Answers a prompt with the text of a JSON object that follows the schema (see ``response_schema``)."""

    def __call__(self, prompt: str, schema: dict) -> str: ...


class FileLabeler:
    """Answers with the content of a file on any Hadoop path, for runs without a model; of several files with one after the other."""

    def __init__(self, spark: SparkSession, *uris: str):
        self.answers = [spark.read.text(u, wholetext=True).first()[0] for u in uris]
        self.asked = 0

    def __call__(self, prompt: str, schema: dict) -> str:
        self.asked += 1
        return self.answers[min(self.asked, len(self.answers)) - 1]


def response_schema(ids: list[str]) -> dict:
    """The JSON schema of an answer for a batch: one closed object for each topic, with nothing missing and nothing else."""
    text = {"type": "string"}
    fields = {
        "topic_id": {"type": "string", "enum": ids}, "topic_type": {"type": "string", "enum": TOPIC_TYPES}, "confidence": {"type": "string", "enum": CONFIDENCES},
        "representative_terms": {"type": "array", "items": text, "minItems": 5, "maxItems": 10},
    }
    fields |= {n: text for n in REQUIRED if n not in fields}
    label = {"type": "object", "properties": fields, "required": [*fields], "additionalProperties": False}
    labels = {"type": "array", "items": label, "minItems": len(ids), "maxItems": len(ids)}
    return {"type": "object", "properties": {"labels": labels}, "required": ["labels"], "additionalProperties": False}


def checked(spark: SparkSession, labels: list[dict], topics: list[dict]) -> tuple[list[dict], str | None]:
    """The labels with their terms in the topics' own spelling, in the topics' order, and what is wrong with them (null: nothing).

    The ids must be those of the topics, each once; then each label is judged by the rules of ``validate``.
    """
    if not isinstance(labels, list) or not all(isinstance(x, dict) for x in labels):
        return [], "labels is not a list of objects"
    order = [t["topic_id"] for t in topics]
    if sorted(map(str, order)) != sorted(str(x.get("topic_id")) for x in labels):
        return [], "the ids of the labels are not those of the topics"
    types = "topic_id string, label_short string, label_long string, topic_type string, confidence string, rationale string, representative_terms array<string>"
    names = [x.split()[0] for x in types.split(", ")]
    given = spark.createDataFrame([tuple(x.get(n) for n in names) for x in labels], types)
    words = spark.createDataFrame([(t["topic_id"], i, w) for t in topics for i, w in enumerate(t["words"])], "topic_id string, pos int, word string")
    wrong = sorted((r["topic_id"], r["reason"]) for r in validate(given, words).collect() if r["reason"])
    if wrong:
        return [], "; ".join(f"{t}: {r}" for t, r in wrong)
    own: dict[str, list] = {}
    for r in resolve(given, words).orderBy("topic_id", "pos").collect():
        own.setdefault(r["topic_id"], []).extend(r["resolved"])
    out = [{n: x.get(n) for n in names} | {"representative_terms": own[x["topic_id"]]} for x in labels]
    return sorted(out, key=lambda x: order.index(x["topic_id"])), None


def prompt(topics: list[dict], known: list[dict]) -> str:
    """The task for a batch of topics (topic_id, words), in our own words, with the labels given so far."""
    return "\n".join(
        [
            "Name each topic of a topic model of historical newspapers. Answer with a JSON object whose list `labels` has one object for each topic, with",
            f"topic_id and {', '.join(REQUIRED)}. topic_type is one of {', '.join(TOPIC_TYPES)}; confidence one of {', '.join(CONFIDENCES)}.",
            "representative_terms are five to ten words copied from the topic's words.",
            "Labels given before: " + json.dumps([{k: x[k] for k in ("topic_id", "label_short")} for x in known], ensure_ascii=False),
            *[json.dumps({"topic_id": t["topic_id"], "words": t["words"]}, ensure_ascii=False) for t in topics],
        ]
    )


def batches(topics: Iterable[dict], size: int | None = None, max_chars: int | None = None) -> Iterator[list[dict]]:
    """Fixed batches, or as many topics as a prompt of max_chars holds; the first always fits."""
    batch: list[dict] = []
    for t in topics:
        if batch and (size and len(batch) == size or max_chars and len(prompt([*batch, t], [])) > max_chars):
            yield batch
            batch = []
        batch.append(t)
    if batch:
        yield batch


def _answer(labeler: Labeler, ask: str, batch: list[dict]):
    try:
        return json.loads(labeler(ask, response_schema([t["topic_id"] for t in batch])))["labels"], None
    except (ValueError, TypeError, KeyError) as e:
        return [], f"no JSON object with labels: {e}"


def label_all(spark: SparkSession, topics: list[dict], labeler: Labeler, size: int | None = None, max_chars: int | None = 60_000, source: str = "model") -> list[dict]:
    """Labels of all topics (topic_id, words): batch by batch, each with one chance of repair, earlier labels shown to later batches.

    What can't be repaired ends the run. At the end all labels together are validated once more. Labels carry generated_by.
    """
    done: list[dict] = []
    for batch in batches(topics, size, None if size else max_chars):
        ask = prompt(batch, done)
        got, wrong = _answer(labeler, ask, batch)
        good, wrong = ([], wrong) if wrong else checked(spark, got, batch)
        if wrong:
            got, again = _answer(labeler, f"{ask}\nThe last answer was refused: {wrong}", batch)
            good, wrong = ([], again) if again else checked(spark, got, batch)
            if wrong:
                raise ValueError(wrong)
        done += good
    final, wrong = checked(spark, done, topics)
    if wrong:
        raise ValueError(wrong)
    return [x | {"generated_by": source} for x in final]
