"""Language identification by hyperdimensional n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolex.llm.common import batched, portions, slices

#: Components of a hypervector; letters of an n-gram are three.
DIM = 512
CHUNK = 256
#: Distinct letters in a chunk up to which trigrams are counted in a table rather than sorted.
DENSE = 72

_letters: dict = {}


def letter_classes() -> np.ndarray:
    """For each code point its number among the letters, from 1; 0 for all that isn't a letter."""
    if "classes" not in _letters:
        is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _letters["classes"] = np.where(is_letter, np.cumsum(is_letter), 0).astype(np.int32)
    return _letters["classes"]


def letter_vectors(classes: np.ndarray) -> np.ndarray:
    """Random vectors of +1 and -1, one for each letter class, that depend on nothing but the class."""
    memo = _letters.setdefault("vectors", {})
    for c in classes.tolist():
        if c not in memo:
            memo[c] = np.random.Generator(np.random.Philox(key=c + 7)).integers(0, 2, DIM, dtype=np.int8) * 2 - 1
    return np.stack([memo[c] for c in classes.tolist()]).astype(np.int8)


def bundles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bundled trigram vector of each text, and whether it has a letter.

    Lower-case letters count; each run of other characters is one blank. A trigram's vector binds (multiplies) the
    letters' vectors, the first permuted (rotated) twice and the second once; a text's is the sum.
    """
    cls = letter_classes()
    coded = [np.frombuffer((" " + t.lower() + " ").encode("utf-32-le"), "<u4") for t in texts]
    sizes = np.array([len(c) for c in coded])
    flat = cls[np.concatenate(coded)]
    owner = np.repeat(np.arange(len(texts)), sizes)
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != 0) | (flat[:-1] != 0) | (owner[1:] != owner[:-1])
    flat, owner = flat[keep], owner[keep]
    seen = np.flatnonzero(np.bincount(flat))
    letters = np.zeros(len(texts), bool)
    letters[owner[flat != 0]] = True
    local = np.zeros(seen[-1] + 1, np.int64)
    local[seen] = np.arange(len(seen))
    x, a = local[flat], len(seen)
    code = (x[:-2] * a + x[1:-1]) * a + x[2:]
    same = owner[:-2] == owner[2:]
    code, owner = code[same], owner[:-2][same]
    if a <= DENSE:
        grams = np.flatnonzero(np.bincount(code, minlength=1))
        place = np.zeros(a**3, np.int32)
        place[grams] = np.arange(len(grams))
        at = place[code]
    else:
        grams, at = np.unique(code, return_inverse=True)
    out = np.zeros((len(texts), DIM), np.float32)
    if len(grams):
        vec = letter_vectors(seen)
        bound = np.roll(vec, 2, axis=1)[grams // (a * a)] * np.roll(vec, 1, axis=1)[grams // a % a] * vec[grams % a]
        step = max(1, 8_000_000 // len(grams))
        bound = bound.astype(np.float32)
        for k in range(0, len(texts), step):
            own = (owner >= k) & (owner < k + step) if step < len(texts) else slice(None)
            n = min(step, len(texts) - k)
            counts = np.bincount((owner[own] - k) * len(grams) + at[own], minlength=n * len(grams)).astype(np.float32)
            out[k : k + n] = counts.reshape(n, len(grams)) @ bound
    return out, letters


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """A prototype for each language: the sum of the unit bundles of its documents.

    Each partition sends one vector for each language that it holds; these are added up by key. Null languages
    and texts without letters don't count. The result's size depends on the number of languages only.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for k, end in portions(whole["text"].str.len().to_numpy(), CHUNK):
                batch = whole.iloc[k:end]
                vec, has = bundles(batch["text"].tolist())
                vec = vec / np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)
                langs = batch["lang"].to_numpy()
                for name in set(langs[has]):
                    total[name] = total.get(name, 0) + vec[has & (langs == name)].sum(0, dtype=np.float64)
        # Whole numbers add up alike in any order.
        yield pd.DataFrame([(n, i, round(float(x) * 1e6)) for n, v in total.items() for i, x in enumerate(v)], columns=["lang", "i", "x"])

    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    sums = batched(rows).mapInPandas(part, "lang string, i int, x long").groupBy("lang", "i").agg(F.sum("x").alias("x"))
    found: dict[str, np.ndarray] = {}
    for r in sums.collect():
        found.setdefault(r["lang"], np.zeros(DIM))[r["i"]] = r["x"]
    return dict(sorted(found.items()))


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """Append lang_pred and score: the language whose prototype has the greatest cosine with the text, and that cosine.

    A null text, one without letters, or no prototype at all: ``und`` and 0. Ties go to the first name. Input columns of
    these names are replaced; all others pass through.
    """
    df = df.drop("lang_pred", "score")
    names = np.array([*prototypes, "und"], dtype=object)
    unit = np.stack([v / max(np.linalg.norm(v), 1e-9) for v in prototypes.values()]).astype(np.float32) if prototypes else np.zeros((1, DIM), np.float32)

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, whole.schema.get_field_index(text), CHUNK):
                vec, has = bundles([t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()])
                cos = vec @ unit.T / np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)
                best = cos.argmax(1)
                has &= bool(prototypes)
                pred = pa.array(names[np.where(has, best, len(names) - 1)], pa.string())
                score = np.where(has, np.clip(cos[np.arange(len(best)), best], 0, 1), 0).astype(float)
                yield pa.RecordBatch.from_arrays([*batch.columns, pred, pa.array(score)], [*batch.schema.names, "lang_pred", "score"])

    from pyspark.sql import types as T

    return batched(df).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
