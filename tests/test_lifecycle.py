"""A whole run over a small corpus: prepare, train, label, publish."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chronolex import __main__ as cli
from chronolex.operators import labels
from chronolex.plans import lifecycle
from chronolex.sources import readers, writers

#: Words of three planted topics.
PLANTED = [[a + "".join(x) for x in zip("bcdfghjklm", "aeiouaeiou", "nrstlnrstl")] for a in ("ma", "so", "ti")]


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    at, rnd, lines = tmp_path_factory.mktemp("corpus"), random.Random(5), []
    for i in range(90):
        words = [rnd.choice(PLANTED[i % 3]) for _ in range(40)]
        toks = [{"t": w.capitalize(), "p": "NOUN" if k % 4 else "VERB", "l": w if k % 5 else ""} for k, w in enumerate(words)]
        lines.append(json.dumps({"ci_id": f"gdl-18{i % 30 + 50}-01-02-a-i{i:04d}", "sents": [{"lg": "fr", "tok": toks}], "tsents": [{"lg": "de", "tok": toks}]}))
    lines += ["", "{bad", json.dumps({"id": "jdg-1900-01-02-a-i0001", "sents": []}), json.dumps({"sents": []}), json.dumps({"ci_id": "jdg-1900-01-02-a-i0002"})]
    (at / "docs.jsonl").write_text("\n".join(lines) + "\n")
    (at / "deny.txt").write_text(PLANTED[0][0].upper() + "\tx\n")
    return at


@pytest.fixture(scope="module")
def run(corpus, tmp_path_factory):
    return lifecycle.Run(
        out=str(tmp_path_factory.mktemp("out") / "run"), lang="fr", prefix=str(corpus), suffix=".jsonl", min_freq=2, min_tokens=8, min_unique=3, topics=3, iterations=30,
        sample_size=60, per_stratum=20, smoke_docs=5, exclude=[str(corpus / "deny.txt")], min_score=0.0,
    )


@pytest.fixture(scope="module")
def done(spark, run):
    lifecycle.prepare(spark, run)
    lifecycle.train(spark, run)
    return run


def test_prepared(spark, done):
    vocab = [tuple(r) for r in spark.read.csv(done.at("vocab.tsv"), sep="\t").collect()]
    assert len(vocab) == 29 and PLANTED[0][0] not in dict(vocab) and [int(n) for _, n in vocab] == sorted((int(n) for _, n in vocab), reverse=True)
    manifest = writers.read_json(spark, done.at("vocab.manifest.json"))
    assert manifest["counts"]["output_vocab_size"] == 29 and manifest["counts"]["exclude_words"] == 1 and len(manifest["sha256"]) == 1
    counts = writers.read_json(spark, done.at("eligible.stats.json"))["counts"]
    assert counts["input_lines"] == 95 and counts["json_errors"] == 2 and counts["missing_ci_id"] == 1 and counts["docs_seen"] == 92
    assert counts["docs_seen"] == counts["docs_written"] + counts["rejected_too_short"] and "rejected_too_long" not in counts
    assert readers.eligible(spark.read.text(done.at("eligible-lines"))).count() == counts["docs_written"] == sum(writers.read_json(spark, done.at("eligible.stats.json"))["strata"].values())
    assert writers.read_json(spark, done.at("char-table.json"))["char_normalization"] == {} and spark.read.text(done.at("singletons/words")).count() == 0


def test_trained(spark, done):
    manifest = writers.read_json(spark, done.at("sample.manifest.json"))
    assert manifest["counts"]["sample_rows"] == 60 and max(manifest["selected_by_stratum"].values()) <= 20
    scores = [r["score"] for r in spark.read.parquet(done.at("sample")).orderBy("score").collect()]
    assert len(scores) == 60 and all(len(x) == 8 for x in scores)
    topics = spark.read.parquet(done.at("doc-topics")).collect()
    assert all(len(r["topics"]) == 3 and abs(sum(r["topics"]) - 1) < 1e-9 for r in topics)
    found = {frozenset(x["word"] for x in r["word_probs"][:9]) for r in spark.read.json(done.at("descriptions")).collect()}
    assert all(any(len(f & set(p)) >= 8 for f in found) for p in PLANTED)
    smoke = spark.read.json(done.at("smoke")).collect()
    assert len(smoke) == 5 and all(r["topics"][0]["t"].startswith("tm-fr-run_tp") and r["topic_count"] == 3 for r in smoke)


def test_saved_model_infers_alike(spark, done):
    coder, model = lifecycle.load_model(spark, done.out)
    again = model.transform(coder.transform(spark.read.parquet(done.at("sample")))).select("ci_id", F.unwrap_udt("topicDistribution").alias("v"))
    want = {r["ci_id"]: list(r["topics"]) for r in spark.read.parquet(done.at("doc-topics")).collect()}
    assert all(max(abs(a - b) for a, b in zip(r["v"]["values"], want[r["ci_id"]])) < 1e-6 for r in again.collect())


def answer(spark, done, **change):
    topics = readers.topic_descriptions(spark.read.text(done.at("descriptions"))).collect()
    rows = [{"topic_id": t["topic_id"], "label_short": "x", "label_long": "y", "topic_type": "theme", "confidence": "high", "rationale": "z", "representative_terms": [w.upper() for w in t["words"][:5]]} | change for t in topics]
    return json.dumps({"labels": rows})


def test_labels_after_the_fact(spark, done, tmp_path):
    good, bad = answer(spark, done), answer(spark, done, topic_type="nonsense")
    (tmp_path / "good.json").write_text(good)
    (tmp_path / "bad.json").write_text(bad)
    assert cli.main(["label", done.at("descriptions"), str(tmp_path / "labels"), "--answers", str(tmp_path / "bad.json"), str(tmp_path / "good.json"), "--terms", "20"]) == 0
    rows = spark.read.json(str(tmp_path / "labels")).collect()
    assert len(rows) == 3 and all(w == w.lower() for r in rows for w in r["representative_terms"]) and {r["generated_by"] for r in rows} == {"model"}
    with pytest.raises(ValueError, match="topic_type"):
        lifecycle.label(spark, done.at("descriptions"), str(tmp_path / "never"), lambda ask, schema: bad)
    with pytest.raises(ValueError, match="ids"):
        lifecycle.label(spark, done.at("descriptions"), str(tmp_path / "never"), lambda ask, schema: json.dumps({"labels": json.loads(good)["labels"][:2]}))
    with pytest.raises(ValueError, match="no JSON"):
        lifecycle.label(spark, done.at("descriptions"), str(tmp_path / "never"), lambda ask, schema: "[]")


def test_published(spark, done, tmp_path):
    got = lifecycle.publish(spark, done, str(tmp_path / "final"))
    bundle = str(tmp_path / "final/inference/models/tm")
    config = writers.read_json(spark, f"{bundle}/config.json")
    assert config["preprocessing"]["min_lemmas"] == 8 and set(config["artifacts"].values()) <= {p.rpartition("/")[2] for p in got}
    assert len(lifecycle.load_model(spark, bundle)[0].vocabulary) == 29 and not any(p.endswith("labels") for p in got)


def test_command_line_and_environment(spark, corpus, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"out": str(tmp_path / "o"), "lang": "fr", "inputs": [str(corpus / "docs.jsonl")], "min_freq": 2}))
    assert cli.main(["prepare", str(tmp_path / "c.json")]) == 0 and spark.read.parquet(str(tmp_path / "o/eligible")).count() > 0
    assert set(lifecycle.check_environment(spark)) == {"spark", "java", "python"}


def test_response_schema():
    schema = labels.response_schema(["a", "b"])["properties"]["labels"]
    assert set(schema["items"]["required"]) == {"topic_id", *labels.REQUIRED} and not schema["items"]["additionalProperties"] and schema["minItems"] == 2


def test_batches():
    topics = [{"topic_id": str(i), "words": ["w" * 50]} for i in range(7)]
    assert [len(b) for b in labels.batches(topics, 3)] == [3, 3, 1]
    room = len(labels.prompt(topics[:2], []))
    assert [len(b) for b in labels.batches(topics, None, room)] == [2, 2, 2, 1] and [len(b) for b in labels.batches(topics, None, 10)] == [1] * 7
