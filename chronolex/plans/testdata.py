"""The test tables as input of the operators: annotated documents, topic rows, labels.

Rules are deterministic and simple enough for SQL, which ``oracles`` repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.sources.storage import spread

#: Limits for these small tables: frequency, length, tokens, distinct lemmas, tokens again; document frequency.
MIN_FREQ, MAX_FREQ, MIN_LENGTH = 3, 100_000, 3
LIMITS = (8, 5, 1500)
POS = ["NOUN", "PROPN"]
MAX_DF = 2
EXCLUDE = [["the", "and", "les", "der"], ["was", "with", "the", "que"]]
INCLUDE = ["this", "that", "pour", "avec", "eine", "para"]
EPS = 0.02

TOPICS = [
    ("m_tp0_fr", ["guerre", "général", "armée", "front", "soldat", "ennemi", "paix"]),
    ("m_tp1_fr", ["Zürich", "new", "york", "bourse", "prix", "marché", "banque"]),
    ("m_tp2_fr", ["messe", "église", "curé", "Eglise", "fête", "prière", "saint"]),
]
LABELS = [
    ("m_tp0_fr", "War", "War and peace", "war_military", "high", "words of war", ["guerre", "general", "ARMÉE", "front", "paix"]),
    ("m_tp1_fr", "Trade", "Trade and stocks", "economy_commerce", "medium", "words of trade", ["zurich", "new york", "bourse", "prix"]),
    ("m_tp1_fr2", "Trade", "Trade", "commerce", "medium", "bad type", ["zurich", "new york", "bourse", "prix", "banque"]),
    ("m_tp2_fr", "Church", "Church life", "religion", "low", "church", ["messe", "église", "cure", "fete", "dimanche"]),
    ("m_tp3_fr", "Noise", "Noise", "ocr_noise", "none", "bad confidence", ["a", "b", "c", "d", "e"]),
    ("m_tp4_fr", "Noise", "Noise", "ocr_noise", "low", None, ["a", "b", "c", "d", "e"]),
    ("m_tp5_fr", "Mixed", "Mixed", "mixed_uncertain", "low", "too few", ["a", "b"]),
    ("m_tp5_fr", "Mixed", "Mixed", "mixed_uncertain", "high", "twice", ["a", "b"]),
]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ci_id(doc: Column, source: Column) -> Column:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    year = (1850 + doc % 150).cast("string")
    return F.concat_ws("-", source, year, two(1 + doc % 12), two(1 + doc % 28), F.concat(F.lit("a-i"), F.lpad((doc % 10000).cast("string"), 4, "0")))


def _annotated(t: Column) -> dict[str, Column]:
    """Part of speech and lemma of a token: they follow from its surface."""
    capital = F.left(t, F.lit(1)) != F.lower(F.left(t, F.lit(1)))
    pos = F.when(capital, "PROPN").when(F.length(t) % 5 == 0, "VERB").otherwise("NOUN")
    return {"p": pos, "l": F.when(F.length(t) % 7 == 0, "").otherwise(F.lower(t))}


def annotated(rows: DataFrame) -> DataFrame:
    """Add p and l to rows of surfaces t."""
    return rows.withColumns(_annotated(F.col("t")))


def surfaces(spark: SparkSession, d: str) -> DataFrame:
    """Rows (ci_id, lang, words): the surfaces of ``corpus`` in order, body first, then title, as a text of words between blanks.

    A table of distinct surfaces holds all annotations, so those who count or look words up need no structure for each token.
    """
    text, end = F.coalesce("text", F.lit("")), F.instr(F.coalesce("text", F.lit("")), "\n")
    body = F.when(end > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise("")
    words = F.concat_ws(" ", F.replace(body, F.lit("\n"), F.lit(" ")), F.substring_index(text, "\n", 1))
    docs = spread(table(spark, d, "documents"))
    return docs.select(ci_id(F.col("doc_id"), F.col("source")).alias("ci_id"), "lang", words.alias("words"))


def corpus(spark: SparkSession, d: str, keep: tuple = ()) -> DataFrame:
    """Annotated documents: a line is a sentence, the first line the title, a word between blanks a token."""

    def token(t: Column) -> Column:
        return F.struct(t.alias("t"), *[c.alias(n) for n, c in _annotated(t).items()])

    def sentence(line: Column) -> Column:
        words = F.filter(F.split(line, " "), lambda x: x != "")
        none = F.lit(None).cast("array<struct<t:string,p:string,l:string>>")
        return F.struct(F.col("lang").alias("lg"), F.transform(words, token).alias("tok"), none.alias("tokens"))

    docs = spread(table(spark, d, "documents")).select("doc_id", "lang", ci_id(F.col("doc_id"), F.col("source")).alias("ci_id"), F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    return docs.select(
        *keep,
        "ci_id",
        "lang",
        F.transform(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))), sentence).alias("sents"),
        F.transform(F.slice("lines", 1, 1), sentence).alias("tsents"),
    )


def words(spark: SparkSession, rows: list[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in rows], "word string")


def topic_weights(spark: SparkSession, d: str) -> DataFrame:
    """Sources as topics: occurrences of the words of their documents."""
    docs = table(spark, d, "documents").select(F.substring("source", 4, 9).cast("int").alias("topic"), F.explode(F.split(F.lower("text"), r"[ \n]")).alias("word"))
    return docs.where("word <> ''").groupBy("topic", "word").agg(F.count("*").cast("double").alias("weight"))


def doc_topics(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as topic rows: fields idx, name and the shares of the squares, rounded; names repeat and carry paths and suffixes."""
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x)
    shares = v.withColumn("s", total).withColumn("p", F.transform("e", lambda x: F.round(x * x / F.col("s"), 6)))
    bare = F.concat(F.lit("src"), (F.col("vec_id") % 20).cast("string"), F.lit("-1900-01-01-a-i"), F.lpad((F.col("vec_id") % 400).cast("string"), 4, "0"))
    name = F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit("out/x/"), bare, F.lit(".txt"))).when(F.col("vec_id") % 3 == 1, F.concat(bare, F.lit("_p1"))).otherwise(bare)
    return shares.select(F.col("vec_id").alias("idx"), name.alias("name"), F.concat(F.array(F.col("vec_id").cast("string"), name), F.col("p").cast("array<string>")).alias("fields"))


def topics(spark: SparkSession) -> DataFrame:
    rows = [(t, i, w) for t, ws in TOPICS for i, w in enumerate(ws)]
    return spark.createDataFrame(rows, "topic_id string, pos int, word string")


def labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        LABELS, "topic_id string, label_short string, label_long string, topic_type string, confidence string, rationale string, representative_terms array<string>"
    )
