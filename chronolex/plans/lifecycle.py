"""The three ways in: prepare vocabulary and texts, train and describe a model, publish a bundle; besides, labels after the fact.

All results of a run lie below one folder, as listed in ``Run``; each step reads what the one before it wrote.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml.clustering import DistributedLDAModel, LDAModel, LocalLDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.functions.ids import format_topic_id, newspaper, sample_score, sample_score_md5
from chronolex.functions.text import char_table, normalize_lemma
from chronolex.operators import assign, describe, docfreq, eligible, labels, lda, sample, vocab
from chronolex.sources import readers, writers
from chronolex.sources.storage import checkpoint


@dataclass
class Run:
    """The settings of a run; limits are those that the reference's option of the same meaning has by default."""

    out: str
    lang: str
    run_id: str = "run"
    #: Lingproc files (JSON lines), by path or below a prefix.
    inputs: list[str] = field(default_factory=list)
    prefix: str | None = None
    suffix: str = ""
    #: Lemma and character frequencies (one JSON object); without it both are counted from the inputs.
    lemma_freqs: str | None = None
    min_char_count: int = 1
    min_alpha: int = 3
    min_ratio: float = 0.75
    min_freq: int = 400
    max_freq: int = 2_000_000
    min_length: int = 3
    exclude: list[str] = field(default_factory=list)
    include: str | None = None
    pos: list[str] = field(default_factory=lambda: ["NOUN", "PROPN"])
    titles: bool = True
    min_tokens: int = 10
    min_unique: int = 5
    max_tokens: int = 1500
    singleton_df: int = 4
    exclusion_df: int = 2
    sample_size: int = 1_000_000
    per_stratum: int | None = None
    min_per_stratum: int = 0
    strata: list[str] = field(default_factory=lambda: ["newspaper", "decade"])
    seed: int = 42
    #: blake2b as the reference has it, or md5, which any engine can compute.
    score: str = "blake2b"
    topics: int = 100
    iterations: int = 50
    optimizer: str = "em"
    min_score: float = 0.01
    min_probability: float = 0.0001
    words: int = 200
    label_terms: int = 50
    eps: float = 0.02
    smoke_docs: int = 1000
    overwrite: bool = False

    @property
    def model_id(self) -> str:
        return f"tm-{self.lang}-{self.run_id}"

    def at(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"


def check_environment(spark: SparkSession) -> dict:
    """Versions, and proof that the executors run Java and Python and share a checkpoint folder; raises where one is missing."""
    from chronolex.sources.storage import shared_dir

    ran = spark.range(1).select(F.java_method(F.lit("java.lang.System"), F.lit("getProperty"), F.lit("java.version")).alias("java")).first()["java"]
    python = spark.range(1).mapInPandas(lambda it: (p.assign(v=__import__("platform").python_version())[["v"]] for p in it), "v string").first()["v"]
    folder = f"{shared_dir(spark)}/environment-check"
    spark.range(1).write.mode("overwrite").parquet(folder)
    if spark.read.parquet(folder).count() != 1:
        raise RuntimeError(f"executors can't share {folder}")
    return {"spark": spark.version, "java": ran, "python": python}


def _documents(spark: SparkSession, run: Run) -> tuple[list[str], DataFrame]:
    paths = readers.listing(spark, run.inputs, run.prefix, run.suffix)
    if not paths:
        raise FileNotFoundError("no input files")
    return paths, readers.parse_lingproc(readers.numbered_lines(spark, paths))


def _raw_freqs(spark: SparkSession, run: Run, docs: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Lemma frequencies (lang, lemma, freq), and those of their characters."""
    if run.lemma_freqs:
        freqs = readers.frequencies(spark, run.lemma_freqs).select(F.lit(run.lang).alias("lang"), F.col("item").alias("lemma"), "freq")
        chars = readers.char_frequencies(spark, run.lemma_freqs)
    else:
        raws = eligible.raw_lemmas(run.titles, lang=run.lang)
        freqs = vocab.lemma_frequencies(docs.select(F.lit(run.lang).alias("lang"), F.explode(raws).alias("lemma")))
        chars = vocab.char_frequencies(freqs)
    return freqs, {r["ch"]: r["freq"] for r in chars.select("ch", "freq").collect()}


def _sums(spark: SparkSession, uris: list[str]) -> dict[str, str]:
    found = [u for u in uris if writers.exists(spark, u)]
    return {u: r["sha256"] for u in found for r in readers.checksums(spark, [u]).collect()}


def make_vocabulary(spark: SparkSession, run: Run) -> DataFrame:
    """Steps of the vocabulary: character table, normalised lemmas, vocabulary and its manifest; all are written below ``run.out``."""
    paths, lines = _documents(spark, run)
    docs = lines.where("status = 'ok'").select("ci_id", "doc.sents", "doc.tsents")
    freqs, counts = _raw_freqs(spark, run, docs)
    table = char_table(counts, run.min_char_count)
    writers.write_char_table(spark, table, counts, run.at("char-table.json"), {"run_id": run.run_id, "language": run.lang, "min_count": run.min_char_count})
    normalized = checkpoint(vocab.normalize_frequencies(freqs, table, run.min_alpha, run.min_ratio))
    merged = vocab.merge_normalized(normalized)
    about = {"run_id": run.run_id, "language": run.lang, "min_alpha": run.min_alpha, "min_ratio": run.min_ratio}
    writers.write_normalized(spark, merged, vocab.diagnostics(normalized), vocab.removed_top(normalized), vocab.examples(normalized), run.at("normalized"), about)
    deny = [readers.word_list(spark, u) for u in run.exclude]
    include = readers.word_list(spark, run.include) if run.include else None
    words = vocab.vocabulary(merged.withColumnRenamed("norm", "lemma"), run.min_freq, run.max_freq, run.min_length, vocab.union_lists(*deny) if deny else None, include)
    writers.write_tsv(words.select("lemma", "freq"), run.at("vocab.tsv"), order=[F.desc("freq"), "lemma"])
    out = readers.vocabulary(spark, run.at("vocab.tsv"))
    lists = [*run.exclude, *([run.include] if run.include else [])]
    manifest = {
        "created_at": writers.now(), "run_id": run.run_id, "language": run.lang, "inputs": paths, "source_lemmafreq": run.lemma_freqs,
        "criteria": {"min_frequency": run.min_freq, "max_frequency": run.max_freq, "min_length": run.min_length, "exclude_vocabs": run.exclude, "include_vocab": run.include},
        "sha256": _sums(spark, [*lists, *([run.lemma_freqs] if run.lemma_freqs else [])]),
        "counts": {
            "source_vocab_size": normalized.count(), "normalized_vocab_size": merged.count(), "output_vocab_size": out.count(),
            "exclude_words": sum(x.count() for x in deny), "include_words": include.count() if include is not None else 0,
        },
    }
    writers.write_json(spark, manifest, run.at("vocab.manifest.json"), overwrite=True)
    return out


def make_eligible(spark: SparkSession, run: Run) -> DataFrame:
    """Eligible texts (newspaper, ci_id, lemmas) of the vocabulary on disk, as Parquet and as lines for each newspaper, with counts and strata."""
    paths, lines = _documents(spark, run)
    table = readers.char_table(spark, run.at("char-table.json"))
    docs = lines.where("status = 'ok'").select("ci_id", "doc.sents", "doc.tsents")
    raws = eligible.raw_lemmas(run.titles, run.pos, run.lang)
    each = docs.select(F.explode(raws).alias("raw")).distinct()
    named = each.withColumn("lemma", normalize_lemma(F.col("raw"), table, run.min_length))
    known = named.join(readers.vocabulary(spark, run.at("vocab.tsv")), "lemma", "left_semi").select("raw", "lemma")
    judged = checkpoint(eligible.judge(eligible.document_lemmas(docs, known, raws), run.min_tokens, run.min_unique, run.max_tokens))
    kept = judged.where("reason is null").withColumn("newspaper", newspaper(F.col("ci_id")))
    kept.select("ci_id", "newspaper", "lemmas").write.mode("overwrite").parquet(run.at("eligible"))
    writers.write_eligible(kept, run.at("eligible-lines"))
    counts = eligible.counters(lines, judged).first().asDict() | {"input_files": len(paths)}
    strata = {f"{r['newspaper']}\t{r['decade']}": r["docs"] for r in eligible.strata(judged).orderBy("newspaper", "decade").collect()}
    manifest = {
        "created_at": writers.now(), "run_id": run.run_id, "language": run.lang, "inputs": paths, "vocab": run.at("vocab.tsv"),
        "criteria": {
            "pos_tags": sorted(run.pos), "min_lemma_length": run.min_length, "min_vocab_tokens": run.min_tokens, "min_unique_lemmas": run.min_unique,
            "max_tokens": run.max_tokens, "include_titles": run.titles,
        },
        "counts": {k: v for k, v in counts.items() if v}, "strata": strata,
    }
    writers.write_json(spark, manifest, run.at("eligible.stats.json"), overwrite=True)
    return spark.read.parquet(run.at("eligible"))


def make_rare_lists(spark: SparkSession, run: Run) -> None:
    """Lemmas of few documents, for review: the singleton list and the list that the next vocabulary may exclude."""
    texts = spark.read.parquet(run.at("eligible"))
    freqs = checkpoint(docfreq.document_frequencies(texts))
    for name, most in (("singletons", run.singleton_df), ("rare", run.exclusion_df)):
        totals = docfreq.totals(texts, most).first().asDict()
        rare = docfreq.rare(freqs, most).join(docfreq.rare_ids(texts, most), "lemma").orderBy("document_frequency", F.desc("total_frequency"), "lemma")
        writers.write_rare(spark, rare, run.at(name), {"counts": totals, "criteria": {"max_document_frequency": most}})
        writers.write_tsv(rare.drop("document_ids"), run.at(f"{name}/lemmas.tsv"), header=True)


def prepare(spark: SparkSession, run: Run) -> None:
    """Vocabulary, eligible texts and the lists for review; afterwards a reviewed list may go into ``exclude`` and the step be run again."""
    make_vocabulary(spark, run)
    make_eligible(spark, run)
    make_rare_lists(spark, run)


def make_sample(spark: SparkSession, run: Run) -> DataFrame:
    """The stratified sample in the order of its scores, as lines and as Parquet, with a manifest."""
    line = F.concat_ws("\t", "ci_id", F.lit("DUMMY"), F.array_join("lemmas", " "))
    rows = spark.read.parquet(run.at("eligible")).select("ci_id", "lemmas", line.alias("row"))
    score = {"blake2b": sample_score, "md5": sample_score_md5}[run.score](F.col("ci_id"), run.seed)
    scored = checkpoint(sample.scored(rows, run.strata, score))
    chosen = checkpoint(sample.sample(scored, run.sample_size, run.per_stratum, run.min_per_stratum))
    chosen.select("ci_id", "lemmas", "score").write.mode("overwrite").parquet(run.at("sample"))
    chosen.orderBy("score", "ci_id").select(F.col("row").alias("value")).write.mode("overwrite").text(run.at("sample-lines"))
    strata = sample.stratum_counts(scored, chosen).orderBy("stratum").collect()
    manifest = {
        "created_at": writers.now(), "run_id": run.run_id, "language": run.lang, "inputs": [run.at("eligible")],
        "criteria": {"sample_size": run.sample_size, "seed": run.seed, "strata": sorted(run.strata), "min_per_stratum": run.min_per_stratum, "max_per_stratum": run.per_stratum},
        "counts": {"input_rows": scored.count(), "malformed_rows": 0, "candidate_rows": sample.dedupe(sample.top_of_strata(scored, run.per_stratum)).count(), "sample_rows": chosen.count()},
        "stratum_counts": {r["stratum"]: r["available"] for r in strata}, "selected_by_stratum": {r["stratum"]: r["selected"] for r in strata if r["selected"]},
    }
    writers.write_json(spark, manifest, run.at("sample.manifest.json"), overwrite=True)
    return spark.read.parquet(run.at("sample"))


def make_model(spark: SparkSession, run: Run) -> None:
    """The vectorizer over the vocabulary, the model, its keys and weights, and the topics of the sample."""
    words = [r["lemma"] for r in readers.vocabulary(spark, run.at("vocab.tsv")).orderBy("lemma").collect()]
    coder = lda.vectorizer(words)
    coder.write().overwrite().save(run.at("vectorizer"))
    vectors = checkpoint(coder.transform(spark.read.parquet(run.at("sample"))).select("ci_id", "features"))
    model = lda.train(vectors, run.topics, run.iterations, run.optimizer, run.seed)
    model.write().overwrite().save(run.at("model"))
    lda.weights(model, words).write.mode("overwrite").parquet(run.at("weights"))
    writers.write_jsonl(describe.descriptions(lda.weights(model, words, 20).withColumnsRenamed({"weight": "prob"}).withColumn("rank", -F.col("prob"))), run.at("keys"))
    lda.infer(model, vectors).write.mode("overwrite").parquet(run.at("doc-topics"))
    about = {"created_at": writers.now(), "run_id": run.run_id, "model": run.model_id, "environment": check_environment(spark), "documents": vectors.count(), "vocabulary": len(words)}
    about |= {k: v for k, v in asdict(run).items() if k in ("lang", "topics", "iterations", "optimizer", "seed")}
    writers.write_json(spark, about, run.at("training.json"), overwrite=True)


def load_model(spark: SparkSession, folder: str) -> tuple[CountVectorizerModel, LDAModel]:
    """The vectorizer and the model of a run or bundle; which kind of model, its metadata tells."""
    kind = spark.read.text(f"{folder}/model/metadata").first()[0]
    model = DistributedLDAModel if "DistributedLDAModel" in kind else LocalLDAModel
    return CountVectorizerModel.load(f"{folder}/vectorizer"), model.load(f"{folder}/model")


def make_descriptions(spark: SparkSession, run: Run) -> DataFrame:
    """Topic descriptions (id, topic, lg, topic_model, word_probs) as JSON lines."""
    probs = describe.word_probabilities(spark.read.parquet(run.at("weights")), 0.0 if run.optimizer != "em" else run.min_score, run.min_probability)
    rows = describe.descriptions(describe.top_words(probs, run.words))
    rows = rows.withColumns({"lg": F.lit(run.lang), "topic_model": F.lit(run.model_id), "id": format_topic_id(F.col("topic"), run.model_id, F.lit(run.lang), run.topics, 1)})
    writers.write_jsonl(rows, run.at("descriptions"))
    return spark.read.json(run.at("descriptions"))


def infer(spark: SparkSession, run: Run, texts: DataFrame, out: str, original: DataFrame | None = None) -> DataFrame:
    """Topic assignments of texts (ci_id, lemmas) by the saved model, as bzip2 JSON lines: words outside the vocabulary are dropped."""
    coder, model = load_model(spark, run.out.rstrip("/"))
    rows = lda.infer(model, coder.transform(texts))
    pairs = F.transform("topics", lambda p, t: F.struct(t.alias("t"), p.alias("p")))
    named = assign.first_of_id(rows.select(F.col("ci_id").alias("name"), F.col("ci_id").alias("idx"), pairs.alias("topics")))
    given = assign.assignments(named, run.eps).withColumn("topics", F.transform("topics", lambda x: F.struct(format_topic_id(x["t"], run.model_id, F.lit(run.lang), run.topics).alias("t"), x["p"].alias("p"))))
    given = given.withColumns({"topic_model": F.lit(run.model_id), "topic_count": F.lit(run.topics), "lang": F.lit(run.lang)})
    given = given.select("topic_model", "topic_count", "lang", "ci_ref", "topics", "min_p")
    given = assign.with_texts(given, original) if original is not None else given
    writers.write_jsonl(given, out, "bzip2")
    return spark.read.json(out)


def label(spark: SparkSession, descriptions: str, out: str, labeler: labels.Labeler, terms: int = 50, size: int | None = None, max_chars: int | None = 60_000) -> DataFrame:
    """Validated labels of a description file, whatever made it, as gzip JSON lines; no training comes before."""
    topics = [r.asDict() for r in readers.topic_descriptions(spark.read.text(descriptions)).orderBy("topic_id").collect()]
    topics = [{"topic_id": t["topic_id"], "words": t["words"][:terms]} for t in topics]
    got = labels.label_all(spark, topics, labeler, size, max_chars)
    kinds = "topic_id string, label_short string, label_long string, topic_type string, confidence string, rationale string, representative_terms array<string>, generated_by string"
    names = [x.split()[0] for x in kinds.split(", ")]
    writers.write_jsonl(spark.createDataFrame([tuple(x[n] for n in names) for x in got], kinds).coalesce(1), out, "gzip")
    return spark.read.json(out)


def train(spark: SparkSession, run: Run, labeler: labels.Labeler | None = None) -> None:
    """Sample, model, descriptions, labels (if there is a labeller) and the inference of the best-scored documents as a proof."""
    chosen = make_sample(spark, run)
    make_model(spark, run)
    make_descriptions(spark, run)
    if labeler is not None:
        label(spark, run.at("descriptions"), run.at("labels"), labeler, run.label_terms)
    infer(spark, run, chosen.orderBy("score", "ci_id").limit(run.smoke_docs), run.at("smoke"))


#: What a bundle holds, and what is published besides.
BUNDLE = ["vectorizer", "model", "vocab.tsv", "char-table.json", "descriptions", "config.json"]
RESULTS = ["vocab.manifest.json", "eligible.stats.json", "sample.manifest.json", "keys", "weights", "doc-topics", "smoke", "training.json", "labels"]


def publish(spark: SparkSession, run: Run, target: str) -> list[str]:
    """Write the inference configuration, then copy bundle and results to a target; what a run has not made (labels) is left out."""
    pre = {"mode": "normalized-lemma-vocab-v1", "upos": run.pos, "min_lemma_length": run.min_length, "min_vocab_tokens": run.min_tokens, "min_unique_lemmas": run.min_unique, "include_titles": run.titles}
    model = {"id": run.model_id, "topics": run.topics, "engine": f"spark.ml LDA ({run.optimizer})", "language": run.lang}
    config = writers.inference_config(model, {"run_id": run.run_id, "inputs": run.prefix or run.inputs}, pre, {n: n for n in BUNDLE[:-1]})
    writers.write_json(spark, config, run.at("config.json"), overwrite=True)
    base = target.rstrip("/")
    pairs = [(run.at(n), f"{base}/inference/models/tm/{n}") for n in BUNDLE]
    pairs += [(run.at(n), f"{base}/{n}") for n in RESULTS if writers.exists(spark, run.at(n))]
    return writers.copy(spark, reduce(lambda a, p: [*a, *p], pairs, []), run.overwrite)
