"""Operators of the corpus over small tables, by what the reference's rules say."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from chronolex.functions import ids, text
from chronolex.operators import describe, docfreq, eligible, lda, vocab
from chronolex.sources import readers, writers
from chronolex.streaming.eligible import eligible_stream

TOKEN = lambda t, p="NOUN", l=None: {"t": t, "p": p, "l": l}  # noqa: E731, E741


def lingproc(spark, rows):
    return readers.parse_lingproc(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))


@pytest.fixture
def docs(spark):
    sents = [{"lg": "fr", "tok": [TOKEN("Les", "DET"), TOKEN("Écoles", l="école"), TOKEN("Paris", "PROPN"), TOKEN("Œuvre", l=" ")]}, {"lg": "de", "tok": [TOKEN("Haus")]}]
    rows = [
        {"ci_id": "a", "sents": sents, "tsents": [{"lg": "fr", "tokens": [TOKEN("Titre")]}]},
        {"ci_id": "a", "sents": sents[:1]},
        {"ci_id": "b", "sents": [{"lg": "fr", "tok": [TOKEN("inconnu")]}]},
        {"id": "c"},
    ]
    return lingproc(spark, rows).select("ci_id", "doc.sents", "doc.tsents")


def test_document_lemmas(spark, docs):
    known = vocab.members(vocab.normalize_frequencies(spark.createDataFrame([("fr", "école", 3), ("fr", "ecole", 2), ("fr", "paris", 5), ("fr", "œuvre", 5), ("fr", "titre", 5)], "lang string, lemma string, freq long")), 5, 9)
    raws = eligible.raw_lemmas(pos=["NOUN", "PROPN"], lang="fr")
    got = eligible.document_lemmas(docs, known.select("raw", "lemma"), raws)
    assert sorted(tuple((r["ci_id"], *r["lemmas"])) for r in got.collect()) == [("a", "ecole", "paris", "oeuvre"), ("a", "ecole", "paris", "oeuvre", "titre"), ("b",), ("c",)]
    judged = eligible.judge(got, 1, 1, 3)
    assert sorted((r["ci_id"], r["reason"] or "") for r in judged.collect()) == [("a", ""), ("a", "long"), ("b", "short"), ("c", "short")]
    vocabulary = spark.createDataFrame([("ecole",), ("titre",)], "lemma string")
    again = eligible.lookup(docs.select(F.explode(raws).alias("raw")), vocabulary, 3)
    assert {tuple(r) for r in again.collect()} == {("école", "ecole"), ("titre", "titre")}
    assert eligible.document_lemmas(docs.limit(0), known.select("raw", "lemma"), raws).count() == 0


def test_lemmas_beyond_those_held(spark, monkeypatch):
    """Whether workers hold all words, the frequent ones or none, texts are the same."""
    texts = [(f"d{i % 3}", ["fr", "de", None][i % 3], " ".join(f"w{j * j % (i + 2)}" for j in range(i))) for i in range(40)]
    docs = spark.createDataFrame(texts, "ci_id string, lang string, words string").repartition(3)
    freqs = vocab.word_frequencies(docs, F.col("words"))
    known = freqs.select("lang", F.col("word").alias("raw"), "freq", F.when(~F.col("word").endswith("4"), F.upper("word")).alias("lemma"))
    want = sorted((i, x or "", [w.upper() for w in t.split() if x and not w.endswith("4")]) for i, x, t in texts)
    for held in (10**6, 9, 0):
        monkeypatch.setattr(eligible, "HOT", held)
        for rows, words in ((known, F.col("words")), (known.drop("freq"), F.split("words", " "))):
            got = eligible.document_lemmas(docs, rows, words, ("ci_id", "lang"), ("lang",)).collect()
            assert sorted((r["ci_id"], r["lang"] or "", r["lemmas"]) for r in got) == want


def test_word_counts(spark, monkeypatch):
    monkeypatch.setattr(vocab, "HELD", 3)
    texts = [("fr", ["a", "b", "a", None]), ("fr", ["a", ""]), (None, ["a"]), ("de", []), ("fr", None)] * 20
    rows = spark.createDataFrame(texts, "lang string, words array<string>").repartition(3)
    got = {(r["lang"], r["word"]): (r["n"], r["d"]) for r in vocab.word_counts(rows, F.col("words"), rows=True).collect()}
    assert got == {("fr", "a"): (60, 40), ("fr", "b"): (20, 20), ("fr", None): (20, 20), ("fr", ""): (20, 20), (None, "a"): (20, 20)}
    assert {tuple(r) for r in vocab.word_frequencies(rows, F.col("words"), ()).collect()} == {("a", 80), ("b", 20)}


def test_each_distinct_lemma_is_normalised_once(spark):
    rows = spark.createDataFrame([("fr", "École", 3)] * 2, "lang string, lemma string, n long")
    counted = vocab.merge_normalized(vocab.normalize_frequencies(rows.groupBy("lang", "lemma").agg(F.sum("n").alias("freq"))))
    looked = eligible.lookup(rows.withColumnRenamed("lemma", "raw"), spark.createDataFrame([("fr", "ecole")], "lang string, lemma string"), 3, on=("lang",))
    for df in (counted, looked):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("translate(lower(") == 1 and plan.index("translate(lower(") < plan.rindex("Aggregate [")
    assert [tuple(r) for r in counted.collect()] == [("fr", "ecole", 6)] and [tuple(r) for r in looked.collect()] == [("fr", "École", "ecole")]


def test_counters(spark, docs):
    parsed = readers.parse_lingproc(spark.createDataFrame([("",), ("{x",), ('{"ci_id": ""}',), ('{"ci_id": "a"}',)], "value string"))
    judged = eligible.judge(spark.createDataFrame([("a", ["x"] * 9), ("b", ["x", "y"]), ("c", [])], "ci_id string, lemmas array<string>"), 1, 2, 5)
    assert eligible.counters(parsed, judged).first().asDict() == {
        "input_lines": 4, "json_errors": 2, "missing_ci_id": 1, "docs_seen": 3, "accepted_vocab_tokens": 11, "rejected_too_short": 1, "rejected_too_few_unique": 1, "rejected_too_long": 0, "docs_written": 1,
    }


def test_not_an_object_is_fatal(spark):
    for bad in ("[1]", "3", '"x"', "null"):
        with pytest.raises(Exception, match="not a JSON object"):
            readers.parse_lingproc(spark.createDataFrame([(bad,)], "value string")).collect()


def test_lenient_id(spark):
    lines = spark.createDataFrame([('{"id": "x"}',), ('{"ci_id": "y", "id": "x"}',)], "value string")
    assert [r["status"] for r in readers.parse_lingproc(lines, only_ci_id=True).collect()] == ["no_id", "ok"]


def test_token_extraction(spark, tmp_path):
    fr = lambda *toks: {"lg": "fr", "tok": list(toks)}
    rows = [
        {"ci_id": "a", "sents": [{"lg": "de", "tok": [TOKEN("Haus")]}, fr(TOKEN("Eins", l="Un"), TOKEN("maison"))]},
        {"ci_id": "b", "sents": [{"lg": "de", "tok": []}]},
        {"ci_id": "a", "sents": [fr(TOKEN("porte"), {"p": "NOUN"}, TOKEN("jamais")), fr(TOKEN("perdu"))]},
        {"ci_id": "c", "sents": [fr()]},
        {"ci_id": "a", "sents": [fr(TOKEN("fin"))]},
    ]
    (tmp_path / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    docs = readers.lingproc(spark, str(tmp_path / "x.jsonl"))
    got = eligible.extract_tokens(docs, ["NOUN"], ["fr"], order=("file", "line"))
    assert sorted((r["ci_id"], r["language"], *r["tokens"]) for r in got.collect()) == [("a", "fr", "fin"), ("a", "fr", "maison", "porte"), ("c", "fr")]
    single = eligible.extract_tokens(docs, ["NOUN"], ["fr"])
    assert sorted((r["ci_id"], *r["tokens"]) for r in single.collect()) == [("a", "fin"), ("a", "maison"), ("a", "porte"), ("c",)]
    writers.write_tokens(got, str(tmp_path / "out"))
    assert "a\tfr\tmaison porte" in {r[0] for r in spark.read.text(str(tmp_path / "out")).collect()}


def test_runs(spark):
    values = [1, 1, 2, None, None, 2, 2, 2, 3, 3, 3, 1]
    rows = spark.createDataFrame(list(enumerate(values)), "at long, topic int").repartition(5)
    want, run = [], 0
    for i, v in enumerate(values):
        run += i == 0 or v != values[i - 1]
        want.append(run)
    for block in (2, 3, 100):
        assert [r["run"] for r in describe.runs(rows, "at", block=block).orderBy("at").collect()] == want


def test_document_frequencies(spark):
    texts = spark.createDataFrame([("d1", ["a", "b", "a"]), ("d1", ["a"]), ("d2", ["c", "a"]), ("d3", [])], "ci_id string, lemmas array<string>")
    freqs = docfreq.document_frequencies(texts)
    assert {tuple(r) for r in freqs.collect()} == {("a", 3, 4), ("b", 1, 1), ("c", 1, 1)}
    assert {(r["lemma"], *r["document_ids"]) for r in docfreq.rare_ids(texts, 2).collect()} == {("b", "d1"), ("c", "d2")}
    assert docfreq.totals(texts, 2).first().asDict() == {"documents": 4, "tokens": 6, "vocabulary": 3, "reported": 2}
    assert docfreq.totals(texts.limit(0), 2).first().asDict() == {"documents": 0, "tokens": 0, "vocabulary": 0, "reported": 0}
    ranked = spark.createDataFrame([("x", 1, 1), ("y", 1, 7), ("z", 9, 9)], "lemma string, document_frequency long, total_frequency long")
    assert [r["lemma"] for r in docfreq.rare(ranked, 2).collect()] == ["y", "x"]


def test_character_table():
    deleted = "¨¯¸˜˝᾿₌≠≮≯™®©°§†‡•·…�"
    assert {text.fold_char(c) for c in deleted} == {""} and {text.fold_char(c) for c in "’‘ʼʻ`´′‹›"} == {"'"}
    assert {text.fold_char(c) for c in "‐‑‒–—−⸗"} == {"-"} and {text.fold_char(c) for c in "«»“”„‟"} == {'"'}
    assert [text.fold_char(c) for c in "ӧþÐŒ"] == ["o", "th", "d", "oe"] and [text.fold_char(c) for c in "đ^~¶日"] == [None] * 5
    assert text.fold_char("ﬀ") == "ff" and text.fold_char("ﬅ") == "st" and text.fold_char("\u0301") is None


def test_backtick_counts_in_the_ratio(spark):
    got = spark.createDataFrame([("``abc``",), ("a´bcd",), ("abcd≠",)], "w string").select(text.normalize_lemma(F.col("w"))).collect()
    assert [r[0] for r in got] == [None, "abcd", "abcd"]


def test_score_by_value(spark):
    row = spark.createDataFrame([("GDL-1899-01-02-a-i0001",), (None,)], "c string").select(ids.sample_score(F.col("c"), 42)).collect()
    assert bytes(row[0][0]) == hashlib.blake2b(b"42\tGDL-1899-01-02-a-i0001", digest_size=8).digest() and row[1][0] is None


def test_collections(spark):
    names = spark.createDataFrame([("BNL/x",), ("BNF/y",), ("SNL/z",), ("B.L/q",)], "name string")
    find = lambda p: sorted(r["name"] for r in readers.collections(names, p).collect())
    assert find("BN[LF]/*") == ["BNF/y", "BNL/x"] and find("B.L/*") == ["B.L/q"] and find("[!B]*") == ["SNL/z"] and find("?N?/?") == ["BNF/y", "BNL/x", "SNL/z"]


def test_topic_models(spark):
    planted = [["ab", "cd", "ef"], ["gh", "ij", "kl"]]
    texts = spark.createDataFrame([(f"d{i}", planted[i % 2] * 5) for i in range(30)], "ci_id string, lemmas array<string>").repartition(2).cache()
    coder = lda.vectorizer(sorted(sum(planted, [])))
    vectors = coder.transform(texts).select("ci_id", "features").cache()
    fits = [lda.weights(lda.train(vectors, 2, 20), coder.vocabulary).orderBy("topic", "word").collect() for _ in range(2)]
    assert all(abs(a["weight"] - b["weight"]) < 1e-6 for a, b in zip(*fits)) and len(fits[0]) == 12
    tops = lda.weights(lda.train(vectors, 2, 20), coder.vocabulary, 3).groupBy("topic").agg(F.sort_array(F.collect_list("word")).alias("w")).collect()
    assert sorted(r["w"] for r in tops) == planted
    unseen = coder.transform(spark.createDataFrame([("x", ["ab", "zz"]), ("y", ["zz"])], "ci_id string, lemmas array<string>"))
    assert all(abs(sum(r["topics"]) - 1) < 1e-9 or sum(r["topics"]) == 0 for r in lda.infer(lda.train(vectors, 2, 5), unseen).collect())


def test_large_vocabulary(spark, monkeypatch):
    """A vocabulary goes to the JVM whole, not word by word, with the places it had."""
    words = [f"w{i:05d}é" for i in range(20000)] + ["", "two words", "a\nb"]
    texts = spark.createDataFrame([("d", ["w00003é", "a\nb", "w19999é", "w00003é", "else", "two words", ""])], "ci_id string, lemmas array<string>")
    monkeypatch.setattr(type(lda.vectorizer(["x"])), "_new_java_array", staticmethod(lambda *a: pytest.fail("word by word")))
    coder = lda.vectorizer(words)
    f = coder.transform(texts).first()["features"]
    assert (f.size, dict(zip(map(int, f.indices), f.values))) == (20003, {3: 2, 19999: 1, 20000: 1, 20001: 1, 20002: 1})
    assert coder.vocabulary == words


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    doc = lambda i, *ws: json.dumps({"ci_id": i, "sents": [{"lg": "fr", "tok": [TOKEN(w) for w in ws]}]})
    (tmp_path / "in/1.jsonl").write_text(doc("a", "Maison", "porte") + "\n{bad\n")
    vocabulary = spark.createDataFrame([("maison",), ("porte",)], "lemma string")
    follow = lambda: eligible_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), vocabulary, "fr", ["NOUN"], (1, 1, 9)).awaitTermination()
    follow()
    (tmp_path / "in/2.jsonl").write_text(doc("b", "porte", "rien") + "\n" + doc("c", "rien"))
    follow()
    follow()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["ci_id"], *r["lemmas"]) for r in got) == [("a", "maison", "porte"), ("b", "porte")]
