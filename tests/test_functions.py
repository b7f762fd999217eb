"""Functions against the golden cases and a plain Python model."""

import pytest
from pyspark.sql import functions as F

from chronolex.functions import ids, text, topics

NORMS = [
    ("économie", "economie"), ("-accidents", "accidents"), ("''''''ssbbi", None), ("Æther", "aether"), ("ßtraße", "sstrasse"), ("œuvre-", "oeuvre"), (" mot ", "mot"),
    ("ÉCOLE", "ecole"), ("foo©bar", "foobar"), ("x1y", None), ("²abc", None), ("ab", None), ("日本", None), ("a.b-c'd", None), ("abcdefgh!!!!!!!!", None), ("", None), (None, None),
]


def test_normalize_lemma(spark):
    rows = spark.createDataFrame([(w,) for w, _ in NORMS], "w string").select(text.normalize_lemma(F.col("w"))).collect()
    assert [r[0] for r in rows] == [n for _, n in NORMS]


def test_fold_char():
    assert [text.fold_char(c) for c in "éœ—’äßſﬁ´a"] == ["e", "oe", "-", "'", "a", "ss", "s", "fi", "'", None]
    with pytest.raises(ValueError):
        text.char_table({"ab": 1})
    assert text.char_report("é") == ("U+00E9", "LATIN SMALL LETTER E WITH ACUTE", "Ll")


def test_ids(spark):
    row = spark.createDataFrame([("GDL-1899-01-02-a-i0001",)], "c string").select(
        ids.stratum_key(F.col("c"), ["decade", "newspaper"]), ids.stratum_key(F.col("c"), []), ids.stratum_key(F.lit("odd"), ["year"]),
        ids.normalize_ci_ref(F.lit("x/y/GDL-1899-01-02-a-i0001.txt")), ids.format_topic_id(F.lit(7), "m", F.lit("fr"), 100), ids.sample_score(F.col("c")),
    ).first()
    assert tuple(row)[:5] == ("GDL|1890s", "all", "unknown", "GDL-1899-01-02-a-i0001", "m_tp07_fr")
    assert len(row[5]) == 8


def test_topics(spark):
    assert [topics.rounding_digits(x) for x in (0.02, 0.0001)] == [3, 5]
    df = spark.createDataFrame([(["0", "n", "0.5", "0.01", "0.49"],)], "f array<string>")
    got = df.select(topics.above(topics.parse_dense(F.col("f")), 0.02)).first()[0]
    assert [(x["t"], x["p"]) for x in got] == [(0, 0.5), (2, 0.49)]
    sparse = spark.createDataFrame([(["0", "n", "3", "0.5", "1", "0.4"],), (["0", "n"],)], "f array<string>")
    assert [[(x["t"], x["p"]) for x in r[0]] for r in sparse.select(topics.parse_sparse(F.col("f"))).collect()] == [[(3, 0.5), (1, 0.4)], []]
