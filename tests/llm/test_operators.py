"""The operators against brute force over a small table with nulls, empty texts, ties, repeated rows and odd columns."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronolex.llm import bpe, embeddings, langid, packing, pii, quality, simhash, substrings, wrappers

P = pytest.importorskip("public_tokenizers")

PASSAGE = " ".join(f"shared{i} word{i % 7}" for i in range(40))
TEXTS = [
    (1, "Alpha beta gamma. " * 30), (2, "Alpha beta gamma. " * 30), (3, None), (4, ""), (5, "  \n\t "), (6, PASSAGE + " tail one two three"),
    (7, "A quite other beginning stands here, then " + PASSAGE), (8, "mail a.b@c.d.e_x@d.ef 1.2.3.4 +1 (743) 555-3824, 4111 1111 1111 1111 é"), (8, "mail again"), (None, "no id"), (9, "x" * 100_000),
    (10, "naïve <|endoftext|> text's 12 don't stop"), (11, "1 " * 3000),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 0.5) for i, t in TEXTS], "doc_id long, text string, lang string, ids double").repartition(3)


def test_bpe(spark, docs):
    import base64

    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = bpe.read_ranks(path)
    coded = bpe.encode(docs, tokens, P.PATTERN)
    assert coded.columns == ["doc_id", "text", "lang", "ids"]
    for r in bpe.decode(coded, tokens).collect():
        assert r["ids"] == model.encode_ordinary(r["text"] or "") and bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.digests(docs.limit(0), tokens, P.PATTERN).count() == 0


def plain_quality(t):
    """The base counts by a plain loop."""
    t = t or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
    repeated = {p for k in range(len(ws) - 2) if wins[tuple(ws[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(ws) < 50 or 100 * len(repeated) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), failed


def test_quality(spark, docs):
    prose = [" ".join(f"word{(i * 7 + j) % 90}" for j in range(i)) for i in range(0, 120, 13)]
    odd = ["a\u00a0b c\u2003d " * 20, "x | y > z » q\n" * 3, "é#*$ &|<>\u000b%\r\n\x0c" * 9, "same line here\nsame line here\n\n \nother", "🙂 🙂 🙂 🙂"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(prose + odd)], "doc_id long, text string")
    for table in (docs.select("doc_id", "text"), rows):
        got = quality.assess(table).collect()
        assert len(got) == table.count()
        for r in got:
            counts = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
            assert counts == plain_quality(r["text"]) and not (r["kept"] and r["base_failed"])
    text = "".join(" ".join(f"{w}{i}" for w in "Ein guter Satz steht hier und endet so wie er soll".split()) + ".\n" for i in range(9))
    cases = [(text, True), (text + "Home | News > Sport » Wetter | Kontakt\n" * 2 + "We use cookies.", True), (text + "ein langer satz ganz ohne zeichen der nicht endet und immer weiter geht bis zum schluss \n" * 9, False)]
    got = quality.assess(spark.createDataFrame([(t,) for t, _ in cases], "text string")).collect()
    assert {r["text"]: r["kept"] for r in got} == dict(cases) and all(r["clean_text"].startswith(text.rstrip()) for r in got)
    clash = rows.select("text", F.lit(1).alias("_counts"), F.lit(2).alias("n_words"), F.lit(3).alias("kept"))
    assert quality.assess(clash).columns[:2] == ["text", "_counts"] and quality.assess(clash).count() == rows.count() and quality.assess(rows.limit(0)).count() == 0


def test_language(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(40)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    test = spark.createDataFrame([("the dog",), ("die katze",), ("123",), (None,)], "text string")
    assert [r["lang_pred"] for r in langid.identify(test, model).collect()] == ["en", "de", "und", "und"]
    assert langid.identify(test, {}).first()["lang_pred"] == "und"


def test_substrings(spark, docs):
    spans = {(r["doc_id"], r["is_copy"]): r for r in substrings.repeats(docs).collect()}
    assert spans[7, True]["ref_doc_id"] == 6 and spans[2, True]["ref_doc_id"] == 1 and {k for k, _ in spans} == {1, 2, 6, 7}
    left = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(docs).where("doc_id is not null").collect()}
    assert left[7].split() == "A quite other beginning stands here, then".split() and 2 not in left and left[6] == TEXTS[5][1] and left[3] is None
    assert substrings.repeats(docs.limit(0)).count() == 0


def test_substrings_behind_quotes(spark):
    passage = [f"shared{i}" for i in range(50)]
    fill = lambda n, k: [f"own{n}x{i}" for i in range(k)]
    quotes = lambda n: fill(n, 60) + passage[:40] + fill(n + 10, 60) + passage[10:] + fill(n + 20, 60)
    rows = [(1, quotes(100)), (2, fill(200, 20) + passage + fill(210, 20)), (3, quotes(300)), (4, fill(400, 30) + passage + fill(410, 30))]
    got = {tuple(r) for r in substrings.repeats(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    assert got == {(2, 20, 70, False, 2), (4, 30, 80, True, 2)}


def test_substrings_near_duplicates(spark):
    """At the threshold, one word of 50 changed, three hash functions and a second partner find what two functions and the leader miss."""
    rows = []
    for i in range(300):
        passage = [f"p{i}x{j}" for j in range(50)]
        for d in range(2):
            own = [f"own{i}d{d}x{j}" for j in range(60)]
            rows.append((2 * i + d, " ".join(own + passage[:25] + ["changed" if d else passage[25]] + passage[26:] + own[::-1])))
    found = {r["doc_id"] for r in substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("is_copy").collect()}
    assert len(found) >= 0.98 * 300
    passage = [f"near{j}" for j in range(60)]
    own = lambda n: [f"o{n}x{j}" for j in range(60)]
    rows = [(1, own(1) + passage[:40] + own(2) + passage[20:] + own(3))]
    rows += [(n, own(4 * n) + passage[:30] + [f"new{n}"] + passage[31:] + own(4 * n + 1)) for n in (2, 3)]
    got = substrings.repeats(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).where("is_copy").collect()
    assert [(r["doc_id"], r["ref_doc_id"]) for r in got] == [(3, 2)]


def test_substrings_far_places(spark):
    passage, far = " ".join(f"shared{i}" for i in range(60)), (1 << 21) + 7
    rows = [(1, "before " + passage + " after"), (2, " ".join(map(str, range(far))) + " " + passage)]
    got = {tuple(r) for r in substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, 61, False, 1), (2, far, far + 60, True, 1)}


def plain_links(vecs, label, least=0.93):
    unit = vecs.astype(float) / np.linalg.norm(vecs.astype(float), axis=1)[:, None]
    return (unit @ unit.T >= least) & (label[:, None] == label) & ~np.eye(len(vecs), dtype=bool)


def clustered(rng, n, dim):
    """Random vectors, near ones at distances about the threshold, and copies."""
    base = rng.normal(size=(n, dim))
    near = np.concatenate([base[: n // 2] + s * np.linalg.norm(base[0]) / dim**0.5 * rng.normal(size=(n // 2, dim)) for s in (0.05, 0.2, 0.3, 0.38)])
    return np.concatenate([base, near, base[: n // 4] * 3]).astype(np.float32)


@pytest.mark.parametrize("tile, dim", [(4096, 8), (16, 16), (8, 5), (5, 64)])
def test_embeddings(spark, monkeypatch, tile, dim):
    """Against all pairs, with one cell and with many cells of several chunks, over one and over all coordinates of a block."""
    monkeypatch.setattr(embeddings, "TILE", tile)
    monkeypatch.setattr(embeddings, "STEP", 7)
    rng = np.random.default_rng(tile)
    vecs = clustered(rng, 40, dim)
    label = np.arange(len(vecs)) % 7 // 5
    rows = [(int(i), v.tolist(), int(x)) for i, (v, x) in enumerate(zip(vecs, label))]
    rows += [(1000, None, 0), (1001, [0.0] * dim, 0), (1002, [float("nan")] * dim, 0), (1003, vecs[0].tolist(), None), (1004, [], 0), (1005, [float("inf")] * dim, 0), (1006, [None] * dim, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embeddings.components(table).collect()}
    near = plain_links(vecs, label)
    reach = classes(list(zip(*np.nonzero(near))), len(vecs))
    assert near.sum() > 100 and len(got) == len(rows)
    for i in range(len(vecs)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), reach[i], reach[i] == i)
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(1000, 1007))
    assert embeddings.components(table.limit(0)).count() == 0


def test_embeddings_cells():
    """Of two rows within the budget one finds the other's cell, or they share theirs."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    for levels in (0, 1, 4, 7, 12):
        edges = [np.unique(np.quantile(x[:, c], np.arange(1, 1 << h) / (1 << h))) if h else np.zeros(0) for c, h in enumerate(embeddings.halvings(levels, 4))]
        row, cell, home = embeddings.cells_within(x, edges, 0.3)
        own = dict(zip(row[home].tolist(), cell[home].tolist()))
        probes = set(zip(row[~home].tolist(), cell[~home].tolist()))
        assert sorted(own) == list(range(300)) and len(probes) == (~home).sum()
        for i, j in zip(*np.nonzero(((x[:, None] - x) ** 2).sum(2) <= 0.3)):
            assert own[i] == own[j] or ((i, own[j]) in probes) != ((j, own[i]) in probes)


def test_embeddings_repeated_keys(spark):
    """Vectors under one key have their own links; doubles are not cut to floats; labels are compared as they are."""
    e1, e2 = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, e1, "a"), (5, e2, "a"), (7, [1.0, 0.01, 0.0], "a"), (9, e2, "b"), (4, [1e300, 1.0, 0.0], "a"), (3, [1e-300, 0.0, 0.0], "b")]
    got = [tuple(r) for r in embeddings.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()]
    assert sorted(got) == [(3, 0, 3, True), (4, 2, 4, True), (5, 0, 5, True), (5, 2, 4, False), (7, 2, 4, False), (9, 0, 9, True)]


@pytest.mark.parametrize("tile", [4096, 3])
def test_embeddings_chains(spark, monkeypatch, tile):
    """Chains whose places follow no order of the ids stay whole: the smallest neighbours alone don't join 3 and 4 of 1, 3, 4, 2."""
    monkeypatch.setattr(embeddings, "TILE", tile)
    monkeypatch.setattr(embeddings, "STEP", 4)
    chains = [[1, 3, 4, 2], [11, 16, 13, 18, 17, 12, 15, 14, 10]]
    at = lambda k: [math.cos(math.radians(20 * k)), math.sin(math.radians(20 * k))]
    rows = [(i, at(k), c) for c, chain in enumerate(chains) for k, i in enumerate(chain)]
    got = {r["vec_id"]: tuple(r)[1:] for r in embeddings.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {i: (1 + (0 < k < len(chain) - 1), min(chain), i == min(chain)) for chain in chains for k, i in enumerate(chain)}


def test_embeddings_without_key(spark):
    """Rows without a key are compared as all others, and join what they link."""
    rows = [(8, [1.0, 0.0], 0), (None, [0.94, 0.342], 0), (3, [0.77, 0.64], 0), (9, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (None, None, 1)]
    got = [tuple(r) for r in embeddings.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()]
    assert sorted(got, key=str) == sorted([(8, 1, 3, False), (None, 2, 3, False), (3, 1, 3, True), (9, 0, 9, True), (None, 0, None, True), (None, 0, None, True)], key=str)


def plain_fingerprint(t):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    runs = [b" ".join(ws[k : k + 3]) for k in range(max(1, len(ws) - 2))] if ws else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(links, n):
    """The smallest place that links reach from each place."""
    found = list(range(n))
    for _ in range(n):
        last = list(found)
        for i, j in links:
            found[i] = found[j] = min(found[i], found[j])
        if last == found:
            return found
    return found


def test_simhash(spark, docs):
    got = [(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"], bytes(r["digest"])) for r in simhash.components(docs).collect()]
    texts = {hashlib.md5((t or "").encode()).digest(): t for _, t in TEXTS}
    fps = [plain_fingerprint(texts[g[3]]) for g in got]
    assert [g[1] for g in got] == fps
    part = classes([(i, j) for i in range(len(got)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3], len(got))
    for i in range(len(got)):
        members = [got[j][0] for j in range(len(got)) if part[j] == part[i] and got[j][0] is not None]
        assert got[i][2] == (min(members) if members else None)
    kept = sorted((r["doc_id"], r["text"] or "") for r in simhash.near_dedup(docs).where("doc_id is not null").collect())
    assert [k for k, _ in kept] == [1, 3, 6, 7, 8, 8, 9, 10, 11] and {t for k, t in kept if k == 8} == {t for k, t in TEXTS if k == 8}
    assert simhash.near_dedup(docs).where("doc_id is null").count() == 1 and simhash.near_dedup(docs.limit(0)).count() == 0


def test_simhash_repeated_keys(spark):
    """Texts of one key are documents of their own; a repeated row counts once; columns may have any names."""
    a, b, c = "one two three four", "quite another text of words", "and a third one that differs"
    rows = [(3, a), (8, a), (8, b), (8, b), (5, c), (None, a)]
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, fp long, digest string")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.near_dedup(docs).collect())
    assert got == [(0, a), (3, a), (5, c), (8, b)] and simhash.near_dedup(docs).columns == docs.columns


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_simhash_links(spark, radius):
    """Planted pairs of 1 to 5 bits, and chains: links are within the radius, and reach all that all pairs reach."""
    rng, fps = np.random.default_rng(radius), set()
    for base in rng.integers(0, 1 << 63, 60, dtype=np.uint64).tolist():
        fps.add(base)
        x = base
        for d in (1, 2, 3, 4, 5):
            for bits in (rng.choice(64, d, replace=False), rng.choice(32, d, replace=False), 32 + rng.choice(32, d, replace=False)):
                fps.add(base ^ sum(1 << int(b) for b in bits))
            x ^= 1 << int(rng.integers(64))
            fps.add(x)
    fps = sorted(fps)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(table, radius).collect()]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in got)
    at = {f: i for i, f in enumerate(fps)}
    want = classes([(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius], len(fps))
    assert classes([(at[a], at[b]) for a, b in got], len(fps)) == want


def test_simhash_large_group(spark, monkeypatch):
    """All variants of a half in one group, compared in several passes, give what one pass gives."""
    fps = np.unique(np.random.default_rng(3).integers(0, 1 << 12, 1500)).astype(np.int64)
    key = np.zeros(len(fps), np.int64) + 1  # the upper half, which is zero
    whole = simhash.meetings(key, fps, 3)
    monkeypatch.setattr(simhash, "SLAB", 10_000)
    assert len(whole) and (simhash.meetings(key, fps, 3) == whole).all()


def test_wrappers(spark):
    body = "<nav><a>menu</a></nav><div class='sidebar'>side</div><article><h1>T &amp; t</h1><p>One <b>two</b>\n three<p>four<div class=comments>no</div></article><footer>f</footer>"
    rows = [(1, "http://a.b/1", body), (2, "http://a.b/2", body.replace("One", "Uno")), (3, None, None), (4, "x", ""), (5, "http://c.d/", "<div><div id=content><p>Just some long text here</p><p>more</p></div><div>f</div></div>")]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "T & t\nOne two three\nfour", 2: "T & t\nUno two three\nfour", 3: "", 4: "", 5: "Just some long text here\nmore"}


def test_wrappers_drop_fixed_texts(spark):
    head = "The same opening of eighty characters and more, which all of the articles of this host share: "
    page = lambda i: f"<div class=top>A long line of the template that stands on each page</div><article id='post-{i}'><p>{head}{i}<p>Text {i} of the page<p>Send us mail</p><div class=box>Read our offers</div></article>"
    plain = lambda i: f"<div class=a>A very long line of the template that stands on each page of it</div><div class=b><p>Some text {i}</div>"
    rows = [(i, f"http://a.b/{i}", page(i)) for i in range(5)] + [(10 + i, f"http://c.d/{i}", plain(i)) for i in range(5)] + [(20 + i, f"http://e.f/{i}", page(1)) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"{head}{i}\nText {i} of the page" and got[10 + i] == f"Some text {i}" for i in range(5))
    assert all(got[20 + i] == f"{head}1\nText 1 of the page\nSend us mail\nRead our offers" for i in range(4))
    paths = {json.dumps(wrappers.main_path(wrappers.generalise(wrappers.parse(page(i))))) for i in range(30)}
    assert len(paths) == 1


@pytest.fixture(scope="module")
def spec():
    return open(P.path("word_bpe_49k.json")).read()


def test_word_tokenizer(spec):
    """Words one by one, in any company, have the ids that the tokenizer itself gives."""
    from tokenizers import Tokenizer

    plain, own, rnd = Tokenizer.from_str(spec), packing.WordTokenizer(spec), random.Random(4)
    parts = [*"aXTJWhy İıßéÉŉǰΑΆσς1²½٣一한ㅎ\u00a0\u200b\u2003\x85\x1c\t\n.,;:!?#%$*&|)'’<>", "\u030c", "\u0308", "\u0331", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "'s", "'LL", "J\u030c.", "aX&İ#%", "été;", "Don't."]
    texts = ["".join(rnd.choice(parts) if rnd.random() < 0.85 else chr(rnd.choice([rnd.randint(1, 0x24F), rnd.randint(0x300, 0x370), rnd.randint(0x370, 0x2FFF), rnd.randint(0xFB00, 0xFDFF)])) for _ in range(rnd.randint(0, 20))) for _ in range(6000)]
    for k in range(0, len(texts), 300):
        for t, ids in zip(texts[k : k + 300], own.encode(texts[k : k + 300])):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t


def check_packed(rows, want, size=2048):
    """Pieces of each document follow one another and hold its ids; sequences have no gaps and but one is nearly empty."""
    by, seq = {}, {}
    for r in rows:
        by.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        seq.setdefault(r["sequence_id"], []).append(r)
    found = Counter()
    for key, pieces in by.items():
        for ids in (w for w in want[key[0]] if len(w) == key[1]):
            at = 0
            while at < len(ids):
                r = next((r for r in pieces if r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())), None)
                assert r is not None, key
                pieces.remove(r)
                at += r["length"]
            assert at == len(ids)
            found[key[0]] += 1
        assert not pieces
    assert found == Counter({k: len(v) for k, v in want.items()})
    fill = []
    for pieces in seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= size
        fill.append(at)
    return fill


def test_word_tokenizer_memo(spec, monkeypatch):
    """Words learnt first stay where many are forgotten; words that the model gets directly have the tokenizer's ids."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "MEMO_WORDS", 40)
    monkeypatch.setattr(packing, "MEMO_STEMS", 40)
    plain, own = Tokenizer.from_str(spec), packing.WordTokenizer(spec)
    assert own.direct and not packing._is_plain(json.loads(spec) | {"post_processor": {"type": "ByteLevel"}})
    for k in range(6):
        texts = ["the of and", " ".join(f"w{chr(97 + k)}{chr(97 + j)}x, Zug{j} na\u00efve don't \u00c9t\u00e9" for j in range(20))]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert b"the" in own.memo or k == 0


def test_packing(spark, docs, spec):
    """Null and repeated ids, null and empty texts, each row once."""
    from tokenizers import Tokenizer

    model, want = Tokenizer.from_str(spec), {}
    for i, t in TEXTS:
        want.setdefault(i, []).append(np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    fill = check_packed(packing.pack(docs, spec).collect(), want)
    assert sorted(fill)[1:] == [2048] * (len(fill) - 1)
    extra = docs.select("doc_id", "text", F.lit(1).alias("part"), F.lit(2).alias("open"))
    check_packed(packing.pack(extra, spec).collect(), want)
    assert packing.pack(docs.limit(0), spec).count() == 0
    ids = packing.pack(docs.where("doc_id = 7"), spec, with_ids=True).collect()
    assert b"".join(bytes(r["ids"]) for r in sorted(ids, key=lambda r: r["start"])) == want[7][0].tobytes()


def test_packing_many(spark, spec):
    """Many documents over many partitions: two rounds of merging, little padding."""
    from tokenizers import Tokenizer

    model, rnd = Tokenizer.from_str(spec), random.Random(6)
    rows = [(i, " ".join(rnd.choices(["alpha", "beta", "tokenization", "ça", "über!"], k=int(rnd.paretovariate(1) * 30) % 4000))) for i in range(700)]
    want = {i: [np.array([*model.encode(t, add_special_tokens=False).ids, 1], "<u4")] for i, t in rows}
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(40), spec).collect()
    fill = check_packed(got, want)
    assert sum(fill) / (2048 * len(fill)) > 0.97


def test_pii(spark, docs):
    got = {(r["doc_id"], r["n_phone"]): r for r in pii.digests(pii.find(docs.select("doc_id", "text"))).collect()}
    t = TEXTS[7][1]
    at = lambda x: f"{t.index(x)}:{t.index(x) + len(x)}"
    want = f"email:{at('a.b@c.d.e')},email:{at('_x@d.ef')},ip:{at('1.2.3.4')},card:{at('4111 1111 1111 1111')},phone:{at('+1 (743) 555-3824')}"
    assert got[8, 1]["spans"] == want and got[8, 1]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    red = {(r["doc_id"], len(r["text"] or "") > 20): r["text"] for r in pii.redact_documents(docs.select("doc_id", "text")).collect()}
    assert red[8, True] == "mail [EMAIL][EMAIL] [IP] [PHONE], [CARD] é" and red[3, False] is None


def test_pii_bootstrap(spark):
    rows = [(i, f"call telephone: +1 (743) 555-38{i:02d} now") for i in range(9)] + [(99, "call telephone: 743-555-9999 now"), (98, "about 743-555-9999 things")]
    got = {r["doc_id"]: r["spans"] for r in pii.digests(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[99] == "phone:16:28" and got[1].startswith("phone:16:")


def test_pii_bootstrap_groups(spark):
    luhn = lambda n: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(n))) % 10 == 0
    cards = [n for n in (f"411111111111{k:04d}" for k in range(400)) if luhn(n)]
    grouped = [" ".join(n[k : k + 4] for k in range(0, 16, 4)) for n in cards]
    rows = [(i, f"call telephone: +1 (743) 555-38{i:02d} now, card: {grouped[i]} ok") for i in range(30)]
    found = {"743 555 9999": 12, "(743) 555-9999": 14, "743-555-9999 12": 12, "743 555-9999 5th": 12}
    rows += [(90 + i, f"call telephone: {x} now") for i, x in enumerate(found)] + [(98, "about 212 555 0000 things"), (99, "pay card: 5500 0000 1111 2223 ok")]
    got = {r["doc_id"]: r["spans"] for r in pii.digests(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert [got[90 + i] for i in range(4)] == [f"phone:16:{16 + n}" for n in found.values()]
    assert got[98] == "" and got[99] == "card:10:29"


def test_classifier(spark):
    from chronolex.llm import classifier

    docs = spark.createDataFrame([(i, "good clean prose here" if i % 2 else "buy %%% now $$$") for i in range(60)] + [(70, None), (71, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(0, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    w = classifier.train(docs, classifier.quality_labels(labels))
    got = {r["doc_id"]: r["score"] for r in classifier.score(docs, w).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i in range(60)) and 0 <= got[70] == got[71] <= 1
    assert not classifier.train(docs, classifier.quality_labels(labels.limit(0))).any()
