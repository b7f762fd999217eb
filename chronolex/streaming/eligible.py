"""The extraction over unbounded input: it keeps no state from one document to the next."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronolex.operators import eligible
from chronolex.sources.readers import parse_lingproc


def eligible_stream(
    spark: SparkSession, folder: str, out: str, checkpoint: str, vocab: DataFrame, lang: str, pos: Iterable[str], limits: tuple[int, int, int], min_length: int = 3
) -> StreamingQuery:
    """Follow a folder of lingproc files; each batch's eligible documents are added to ``out`` as Parquet, once."""

    def batch(lines: DataFrame, number: int) -> None:
        docs = parse_lingproc(lines).where("status = 'ok'").select("ci_id", "doc.sents", "doc.tsents")
        raws = eligible.raw_lemmas(pos=pos, lang=lang)
        known = eligible.lookup(docs.select(F.explode(raws).alias("raw")), vocab, min_length)
        judged = eligible.judge(eligible.document_lemmas(docs, known, raws), *limits)
        judged.where("reason is null").select("ci_id", "lemmas").write.mode("overwrite").parquet(f"{out}/batch={number}")

    lines = spark.readStream.text(folder)
    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
