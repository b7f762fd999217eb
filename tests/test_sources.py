"""Readers and writers over small files."""

import pytest

from chronolex.sources import readers, writers


def test_frequencies(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"freqs": {"Foo": 2, "foo": 1}, "char_freqs": {"é": 3}}')
    assert {tuple(r) for r in readers.frequencies(spark, str(tmp_path / "f.json")).collect()} == {("Foo", 2), ("foo", 1)}
    assert [tuple(r) for r in readers.char_frequencies(spark, str(tmp_path / "f.json")).collect()] == [("é", 3)]
    with pytest.raises(Exception, match="not an object"):
        readers.frequencies(spark, str(tmp_path / "f.json"), "nothing").collect()


def test_lingproc(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"ci_id":"a","sents":[]}\n\n{bad\n{"id":"b"}\n{"ci_id":""}\n')
    lines = readers.parse_lingproc(spark.read.text(str(tmp_path / "d.jsonl")))
    assert [r["status"] for r in lines.collect()] == ["ok", "json_error", "json_error", "ok", "no_id"]
    assert [r["ci_id"] for r in readers.lingproc(spark, str(tmp_path / "d.jsonl")).collect()] == ["a", "b"]


def test_mislabelled(spark, tmp_path):
    import bz2

    (tmp_path / "a.bz2").write_bytes(b"plain\nlines\n")
    (tmp_path / "b.bz2").write_bytes(bz2.compress(b"packed\n"))
    rows = readers.text_or_mislabelled(spark, [str(tmp_path / "a.bz2"), str(tmp_path / "b.bz2")])
    assert sorted(r[0] for r in rows.collect()) == ["lines", "packed", "plain"]


def test_mislabelled_files_of_one_name(spark, tmp_path):
    import bz2

    for d, content in (("a", b"plain"), ("b", bz2.compress(b"packed")), ("c", b"")):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.bz2").write_bytes(content)
    assert readers.head(spark, str(tmp_path / "a/x.bz2"), 3) == b"pla" and readers.head(spark, str(tmp_path / "c/x.bz2"), 3) == b""
    rows = readers.text_or_mislabelled(spark, [str(tmp_path / d / "x.bz2") for d in "abc"])
    assert sorted(r[0] for r in rows.collect()) == ["packed", "plain"] and readers.text_or_mislabelled(spark, []).count() == 0


def test_listing(spark, tmp_path):
    for name in ("a.jsonl", "d/b.jsonl", "d/c.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    found = readers.listing(spark, [], str(tmp_path), ".jsonl")
    assert [p.rpartition("/")[2] for p in found] == ["a.jsonl", "b.jsonl"] and readers.listing(spark, ["z", "z", "y"]) == ["y", "z"]


def test_tables(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"char_normalization": {"é": "e", "©": null}}')
    assert readers.char_table(spark, str(tmp_path / "t.json")) == {"é": "e", "©": ""}
    (tmp_path / "t.json").write_text('{"char_normalization": {"ab": "e"}}')
    with pytest.raises(ValueError):
        readers.char_table(spark, str(tmp_path / "t.json"))
    (tmp_path / "w.tsv").write_text("0\tmot\t1.5\n0\tx\n1\tautre\t2\n")
    assert [tuple(r) for r in readers.topic_word_weights(spark, str(tmp_path / "w.tsv")).collect()] == [(0, "mot", 1.5), (1, "autre", 2.0)]
    (tmp_path / "w.tsv").write_text("0\tmot\tmany\n")
    with pytest.raises(Exception, match="many"):
        readers.topic_word_weights(spark, str(tmp_path / "w.tsv")).collect()


def test_written_tables(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2, ["x", "y"]), ("a", 1, [])], "lemma string, n int, ids array<string>")
    writers.write_tsv(rows, str(tmp_path / "t"), header=True, order=["lemma"])
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a\t1\t", "b\t2\tx y", "lemma\tn\tids"]
    writers.word_file(rows, str(tmp_path / "w"))
    assert {r["word"] for r in readers.word_list(spark, str(tmp_path / "w")).collect()} == {"a", "b"}
    for codec, end in (("bzip2", ".bz2"), ("gzip", ".gz")):
        writers.write_jsonl(rows, str(tmp_path / codec), codec)
        assert any(p.name.endswith(end) for p in (tmp_path / codec).iterdir()) and spark.read.json(str(tmp_path / codec)).count() == 2
    docs = spark.createDataFrame([("g-1900-01-02-a-i0001", "g", ["mot", "x"])], "ci_id string, newspaper string, lemmas array<string>")
    writers.write_eligible(docs, str(tmp_path / "e"))
    assert (tmp_path / "e/newspaper=g").is_dir() and readers.eligible(spark.read.text(str(tmp_path / "e"))).first()["lemmas"] == ["mot", "x"]
    writers.write_char_table(spark, {"é": "e", "©": ""}, {"é": 3, "©": 9}, str(tmp_path / "c.json"), {})
    assert readers.char_table(spark, str(tmp_path / "c.json")) == {"é": "e", "©": ""}
    assert [r["codepoint"] for r in writers.read_json(spark, str(tmp_path / "c.json"))["report"]] == ["U+00A9", "U+00E9"]
    assert len(readers.checksums(spark, [str(tmp_path / "c.json")]).first()["sha256"]) == 64
    writers.guard(spark, str(tmp_path / "c.json"))  # local files may be overwritten


def test_guard(spark, monkeypatch):
    monkeypatch.setattr(writers, "exists", lambda spark, uri: True)
    with pytest.raises(FileExistsError):
        writers.guard(spark, "s3://bucket/x")
    writers.guard(spark, "s3a://bucket/x", overwrite=True)


def test_missing_word_list(spark, tmp_path):
    assert readers.word_list(spark, str(tmp_path / "none.txt")).count() == 0


def test_writers(spark, tmp_path):
    writers.write_json(spark, {"b": 1, "a": [2]}, str(tmp_path / "m.json"))
    assert writers.read_json(spark, str(tmp_path / "m.json")) == {"a": [2], "b": 1}
    with pytest.raises(ValueError):
        writers.copy(spark, ["a"])
    assert writers.copy(spark, [str(tmp_path / "m.json"), str(tmp_path / "n.json")]) == [str(tmp_path / "n.json")]
    assert writers.copy(spark, [str(tmp_path / "m.json"), str(tmp_path / "n.json")], skip_existing=True) == []
    assert writers.inference_config({}, {}, {"min_vocab_tokens": 8, "upos": "NOUN, PROPN"}, {})["preprocessing"] == {"min_vocab_tokens": 8, "min_lemmas": 8, "upos": ["NOUN", "PROPN"]}
    assert [writers.parse_bool(x) for x in ("TRUE", "on", "0")] == [True, True, False]
