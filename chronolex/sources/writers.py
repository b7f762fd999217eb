"""Sinks. Large results are written by Spark in parts; manifests and configurations are small and written as one file."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _path(spark, uri)
    return fs.exists(path)


def guard(spark: SparkSession, uri: str, overwrite: bool = False) -> None:
    """Remote results are not overwritten unless asked for; local ones are."""
    if not overwrite and uri.startswith(("s3://", "s3a://")) and exists(spark, uri):
        raise FileExistsError(uri)


def write_json(spark: SparkSession, value: dict, uri: str, sort: bool = True, overwrite: bool = False) -> None:
    """One JSON file."""
    guard(spark, uri, overwrite)
    path, fs = _path(spark, uri)
    out = fs.create(path, True)
    try:
        out.write(bytearray((json.dumps(value, ensure_ascii=False, sort_keys=sort, indent=2) + "\n").encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, uri: str) -> dict:
    return json.loads(spark.read.text(uri, wholetext=True).first()[0])


def write_tsv(df: DataFrame, uri: str, header: bool = False, order: list | None = None, mode: str = "overwrite") -> None:
    """Tab-separated parts; arrays become words with blanks between. An order holds over all parts."""
    guard(df.sparkSession, uri, mode == "overwrite" and not uri.startswith("s3"))
    flat = df.select(*[F.array_join(c, " ").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    (flat.orderBy(*order) if order else flat).write.mode(mode).csv(uri, sep="\t", header=header, quote="", escape="", emptyValue="")


def write_eligible(docs: DataFrame, uri: str, mode: str = "overwrite") -> None:
    """Eligible texts as lines of id, DUMMY and lemmas, one folder for each newspaper."""
    line = F.concat_ws("\t", "ci_id", F.lit("DUMMY"), F.array_join("lemmas", " "))
    docs.select("newspaper", line.alias("value")).write.mode(mode).partitionBy("newspaper").text(uri)


def write_jsonl(df: DataFrame, uri: str, compression: str = "none", mode: str = "overwrite") -> None:
    """JSON lines, such as topic descriptions, assignments (bzip2) and labels (gzip)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(uri, compression=compression)


def word_file(df: DataFrame, uri: str, column: str = "lemma", mode: str = "overwrite") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(uri)


def copy(spark: SparkSession, pairs: list[str], overwrite: bool = False, skip_existing: bool = False) -> list[str]:
    """Copy files or folders, given as source, target, source, target, ...; all targets are looked at before anything is copied."""
    if len(pairs) % 2:
        raise ValueError("sources and targets must come in pairs")
    todo = list(zip(pairs[::2], pairs[1::2]))
    if skip_existing:
        todo = [(s, t) for s, t in todo if not exists(spark, t)]
    for _, target in todo:
        guard(spark, target, overwrite)
    conf = spark._jsc.hadoopConfiguration()
    for source, target in todo:
        (a, fa), (b, fb) = _path(spark, source), _path(spark, target)
        if fb.exists(b) and fb.getFileStatus(b).isDirectory():
            fb.delete(b, True)  # else a folder would be copied into the old one
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fa, a, fb, b, False, True, conf)
    return [t for _, t in todo]


def parse_bool(value: str) -> bool:
    """Whether a text means yes."""
    word = value.strip().lower()
    # The words for yes and no.
    if word in ("1", "true", "yes", "y", "on"):
        return True
    if word in ("0", "false", "no", "n", "off", ""):
        return False
    raise ValueError(f"not a truth value: {value!r}")


def split_csv(value: str) -> list[str]:
    return [x.strip() for x in value.split(",") if x.strip()]


def inference_config(model: dict, linguistic: dict, preprocessing: dict, artifacts: dict) -> dict:
    """The configuration that goes with a model; the least number of tokens stands under both of its names."""
    pre = dict(preprocessing)
    if "min_vocab_tokens" in pre:
        pre["min_lemmas"] = pre["min_vocab_tokens"]
    if isinstance(pre.get("upos"), str):
        pre["upos"] = split_csv(pre["upos"])
    return {"model": model, "linguistic_preprocessing": linguistic, "preprocessing": pre, "artifacts": artifacts}


def write_normalized(spark: SparkSession, normalized: DataFrame, diagnostics: DataFrame, removed: DataFrame, examples: DataFrame, uri: str, about: dict) -> None:
    """The normalised lemmas: a folder with freqs (Parquet), examples (JSON lines) and diagnostics.json (metadata, totals and the most frequent removed forms)."""
    normalized.write.mode("overwrite").parquet(f"{uri}/freqs")
    write_jsonl(examples, f"{uri}/examples")
    totals = [r.asDict() for r in diagnostics.collect()]
    gone = [[r["lemma"], r["freq"]] for r in removed.collect()]
    write_json(spark, {"metadata": {"created_at": now(), **about}, "diagnostics": totals, "most_common_removed": gone}, f"{uri}/diagnostics.json", overwrite=True)


def write_char_table(spark: SparkSession, table: dict[str, str], counts: dict[str, int], uri: str, about: dict) -> None:
    """The character table (null deletes) with a report of each character: code point, name, category, count, replacement."""
    from chronolex.functions.text import char_report

    rows = sorted(((c, *char_report(c), counts.get(c, 0), table[c]) for c in table), key=lambda r: (-r[4], r[0]))
    report = [dict(zip(("char", "codepoint", "name", "category", "count", "replacement"), (*r[:5], r[5] or None))) for r in rows]
    value = {"metadata": {"created_at": now(), **about}, "char_normalization": {c: r or None for c, r in table.items()}, "report": report}
    write_json(spark, value, uri, overwrite=True)


def write_tokens(docs: DataFrame, uri: str, mode: str = "overwrite") -> None:
    """Token rows as lines of id, language and tokens."""
    docs.select(F.concat_ws("\t", "ci_id", "language", F.array_join("tokens", " ")).alias("value")).write.mode(mode).text(uri)


def write_rare(spark: SparkSession, rare: DataFrame, uri: str, about: dict) -> None:
    """Lemmas of few documents: a word list that the next vocabulary can exclude, and all their figures as JSON lines with a manifest."""
    word_file(rare.select("lemma"), f"{uri}/words")
    write_jsonl(rare, f"{uri}/lemmas")
    write_json(spark, {"created_at": now(), "source_word_output": f"{uri}/words", "document_ids": "included" if "document_ids" in rare.columns else "suppressed", **about}, f"{uri}/diagnostics.json", overwrite=True)
