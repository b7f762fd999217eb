"""Scans. All go through Spark's readers, so local paths, s3a and other Hadoop file systems work, and .bz2 and .gz are decoded."""

from __future__ import annotations

import json
from fnmatch import fnmatch, translate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = "array<struct<t:string,p:string,l:string>>"
SENTENCES = f"array<struct<lg:string,tok:{TOKEN},tokens:{TOKEN}>>"
LINGPROC = f"ci_id string, id string, sents {SENTENCES}, tsents {SENTENCES}"


def listing(spark: SparkSession, inputs: list[str], prefix: str | None = None, suffix: str = "") -> list[str]:
    """Explicit paths and those below a prefix with a suffix, each once, sorted."""
    found = set(inputs)
    if prefix:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(prefix)
        found |= {r["path"] for r in files.select("path").collect()}
    return sorted(found)


def collections(names: DataFrame, pattern: str) -> DataFrame:
    """Newspapers (column name) that match a shell pattern such as ``BNL/*`` or ``[AB]*``; * also spans slashes."""
    return names.where(F.col("name").rlike("^" + translate(pattern)))


def matches(name: str, pattern: str) -> bool:
    return fnmatch(name, pattern)


def frequencies(spark: SparkSession, path: str, key: str = "freqs") -> DataFrame:
    """Rows (item, freq) of one JSON object's map; a missing map or one that isn't an object is an error."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", f"{key} map<string,bigint>")[key].alias("m"))
    checked = parsed.select(F.when(F.col("m").isNull(), F.raise_error(F.lit(f"{key} is not an object"))).otherwise(F.col("m")).alias("m"))
    return checked.select(F.explode("m").alias("item", "freq"))


def char_frequencies(spark: SparkSession, path: str, key: str = "char_freqs") -> DataFrame:
    """Rows (ch, freq); each key is one character."""
    rows = frequencies(spark, path, key)
    return rows.select(F.when(F.length("item") == 1, F.col("item")).otherwise(F.raise_error(F.concat(F.lit("not one character: "), F.col("item")))).alias("ch"), "freq")


def char_table(spark: SparkSession, path: str) -> dict[str, str]:
    """The replacements of a normalisation table; null deletes and becomes ''."""
    text = spark.read.text(path, wholetext=True).first()[0]
    table = json.loads(text)["char_normalization"]
    for k, v in table.items():
        if len(k) != 1 or not (v is None or isinstance(v, str)):
            raise ValueError(f"bad entry of the character table: {k!r}")
    return {k: v or "" for k, v in table.items()}


def parse_lingproc(lines: DataFrame, value: str = "value", only_ci_id: bool = False) -> DataFrame:
    """Add doc (the parsed object, null if the line is none), status and ci_id to lines of JSON.

    Status: ok, json_error (also blank lines) or no_id; an empty id counts as missing. The id is ci_id or else id, with
    ``only_ci_id`` ci_id alone. JSON that is no object is an error that ends the query.
    """
    line = F.col(value)
    ok = F.try_parse_json(line).isNotNull()
    other = F.raise_error(F.concat(F.lit("not a JSON object: "), F.left(line, F.lit(80)))).cast("boolean")
    valid = F.when(ok, F.when(line.rlike(r"^\s*\{"), True).otherwise(other)).otherwise(False)
    out = lines.withColumn("_valid", valid).withColumn("doc", F.when(F.col("_valid"), F.from_json(value, LINGPROC, {"mode": "PERMISSIVE"})))
    ids = [F.nullif(c, F.lit("")) for c in ("doc.ci_id", *(() if only_ci_id else ("doc.id",)))]
    status = F.when(~F.col("_valid"), "json_error").when(F.col("ci_id").isNull(), "no_id").otherwise("ok")
    return out.withColumn("ci_id", F.coalesce(*ids)).withColumn("status", status).drop("_valid")


def numbered_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Rows (value, file, line) of text files; line grows within a file, whatever its splits."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"))
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), at.alias("line"))


def lingproc(spark: SparkSession, paths: list[str] | str, only_ci_id: bool = False) -> DataFrame:
    """Documents (ci_id, sents, tsents, file, line) of JSON lines; lines with errors or without an id are skipped."""
    good = parse_lingproc(numbered_lines(spark, paths), only_ci_id=only_ci_id).where("status = 'ok'")
    return good.select("ci_id", "doc.sents", "doc.tsents", "file", "line")


def parse_eligible(value: Column) -> tuple[Column, Column]:
    """Whether a line has three fields, and its fields; only the first two tabs part them."""
    fields = F.split(value, "\t", 3)
    return F.size(fields) == 3, fields


def eligible(lines: DataFrame) -> DataFrame:
    """Rows (ci_id, label, lemmas, row) of lines of three fields; others are left out."""
    ok, fields = parse_eligible(F.col("value"))
    rows = lines.where(ok).select(fields[0].alias("ci_id"), fields[1].alias("label"), F.filter(F.split(fields[2], r"\s+"), lambda x: x != "").alias("lemmas"), F.col("value").alias("row"))
    return rows


def head(spark: SparkSession, path: str, n: int) -> bytes:
    """The first bytes of a file, of which nothing more is read."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        got = [stream.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in got if b >= 0)


def text_or_mislabelled(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of files, some of which are plain text in spite of the name .bz2.

    Each file's first bytes tell, before anything is read. Spark takes the codec from the name, so such a plain file is one row before it is cut into
    lines, and can have 2 GB at most.
    """
    plain = [p for p in paths if p.endswith(".bz2") and head(spark, p, 3) != b"BZh"]
    good = [p for p in paths if p not in set(plain)]
    out = spark.read.text(good) if good else None
    if plain:
        content = F.regexp_replace(F.col("content").cast("string"), r"\r?\n\z", "")
        lines = spark.read.format("binaryFile").load(plain).where("length > 0").select(F.explode(F.split(content, r"\r?\n|\r")).alias("value"))
        out = lines if out is None else out.unionByName(lines)
    return out if out is not None else spark.createDataFrame([], "value string")


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """Words (first field, lower case), each once. A missing file is an empty list."""
    try:
        return words_of(spark.read.text(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "word string")


def words_of(lines: DataFrame) -> DataFrame:
    return lines.select(F.lower(F.split("value", "\t")[0]).alias("word")).where("word <> ''").distinct()


def commented_tsv(lines: DataFrame) -> DataFrame:
    """Rows (fields) of lines that don't begin with #; white space at the ends goes before the line is cut, and empty fields with it."""
    return lines.where(~F.startswith("value", F.lit("#"))).select(F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), "\t").alias("fields"))


def topic_word_weights(spark: SparkSession, path: str) -> DataFrame:
    """Rows (topic, word, weight) of lines of three fields; a bad number is an error."""
    f = F.split("value", "\t", -1)
    return spark.read.text(path).where(F.size(f) == 3).select(f[0].cast("int").alias("topic"), f[1].alias("word"), f[2].cast("double").alias("weight"))


def topic_keys(lines: DataFrame, n: int) -> DataFrame:
    """Rows (topic, words): the first n words; lines with a bad number or under three fields are left out."""
    f = F.split("value", "\t")
    rows = lines.where(F.size(f) >= 3).select(f[0].try_cast("int").alias("topic"), F.slice(F.split(F.btrim(f[2]), r"\s+"), 1, n).alias("words"))
    return rows.where("topic is not null")


def topic_descriptions(lines: DataFrame) -> DataFrame:
    """Rows (topic_id, words): the id is the first of id, topic_id and topic; words are objects or strings. A topic without words is an error."""
    kept = lines.where(F.trim("value") != "").select(
        F.from_json("value", "id string, topic_id string, topic string, lg string, topic_model string, word_probs array<string>").alias("x")
    )
    word = lambda w: F.coalesce(F.get_json_object(F.when(F.startswith(w, F.lit("{")), w), "$.word"), w)
    rows = kept.select(F.coalesce("x.id", "x.topic_id", "x.topic").alias("topic_id"), F.transform("x.word_probs", word).alias("words"))
    return rows.withColumn("words", F.when(F.size("words") > 0, F.col("words")).otherwise(F.raise_error(F.concat(F.lit("no words: "), F.col("topic_id"))).cast("array<string>")))


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Rows (lemma): the first column of a vocabulary, in lower case, each once."""
    return words_of(spark.read.text(path)).withColumnRenamed("word", "lemma")


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows (path, sha256) of files."""
    return spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))
