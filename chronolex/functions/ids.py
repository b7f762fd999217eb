"""Identifiers of content items, strata, sampling scores and topics."""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The patterns of the ids of content items, and of references to them.
CI_ID = r"^(.+?)-(\d{4})-\d{2}-\d{2}-"
CI_REF = r"^(.+?/)?([^/]+?-\d{4}-\d{2}-\d{2}-\w-i\d{4})[^/]*$"


def newspaper(ci_id: Column) -> Column:
    return F.when(ci_id.rlike(CI_ID), F.regexp_extract(ci_id, CI_ID, 1)).otherwise("unknown")


def year(ci_id: Column) -> Column:
    """The year as text without leading zeros, or ``unknown``."""
    return F.when(ci_id.rlike(CI_ID), F.regexp_extract(ci_id, CI_ID, 2).cast("int").cast("string")).otherwise("unknown")


def decade(ci_id: Column) -> Column:
    digits = F.regexp_extract(ci_id, CI_ID, 2).cast("int")
    return F.when(ci_id.rlike(CI_ID), F.concat((digits - digits % 10).cast("string"), F.lit("s"))).otherwise("unknown")


def stratum_key(ci_id: Column, fields: set[str] | list[str]) -> Column:
    """The parts newspaper, year and decade, in that order whatever the order of fields; without fields ``all``."""
    parts = [f(ci_id) for name, f in (("newspaper", newspaper), ("year", year), ("decade", decade)) if name in fields]
    return F.concat_ws("|", *parts) if parts else F.lit("all")


def normalize_ci_ref(ref: Column) -> Column:
    """The bare id of a reference with a leading path and a trailing suffix; others stay."""
    return F.regexp_replace(ref, CI_REF, "$2")


def sample_score_md5(ci_id: Column, seed: int = 42) -> Column:
    """A score that orders ids at random, as text; any engine can compute it."""
    return F.md5(F.concat(F.lit(f"{seed}\t"), ci_id))


def sample_score(ci_id: Column, seed: int = 42) -> Column:
    """The score of eight bytes, which Spark compares as unsigned numbers."""

    @F.pandas_udf("binary")
    def digest(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else hashlib.blake2b(f"{seed}\t{x}".encode(), digest_size=8).digest())

    return digest(ci_id)


def topic_id_width(topics: int, at_least: int = 0) -> int:
    """Digits of a topic's number; descriptions use one at least, assignments none."""
    return max(at_least, math.ceil(math.log10(topics)))


def format_topic_id(topic: Column, model: str, lang: Column, topics: int, at_least: int = 0) -> Column:
    """``{model}_tp{number}_{lang}``; lpad would cut longer numbers, so it pads only shorter ones."""
    digits, width = topic.cast("string"), topic_id_width(topics, at_least)
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(f"{model}_tp"), padded, F.lit("_"), lang)
