"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolex.llm.common import batched, portions, release, slices

#: Buckets of the feature hash (a power of two); bucket 0 is the bias.
BUCKETS = 1 << 18
CHUNK = 256
MEMO_WORDS, MEMO_CHARS = 200_000, 64
#: Characters that are words of their own.
MARKS = "!#$%&()*+,-./:;<=>?@[]^_{|}~\""

_memo: dict[str, int] = {}


def _hash_words(words: list[str]) -> np.ndarray:
    import xxhash

    new = [w for w in set(words) if w not in _memo]
    if len(_memo) + len(new) > MEMO_WORDS:
        _memo.clear()
        new = list(set(words))
    for w in new:
        _memo[w] = xxhash.xxh64_intdigest(w.encode())
    out = np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))
    for w in new:
        if len(w) > MEMO_CHARS:
            del _memo[w]
    return out


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a batch: (row, bucket, value), sorted by row and bucket.

    Words are parts between white space, marks stand alone. Features are the words and pairs of neighbouring words, hashed;
    a pair of equal words is one feature of its own. Values are the logarithms of one plus the counts, divided by their norm.
    """
    parts = []
    for t in texts:
        for m in MARKS:
            if m in t:
                t = t.replace(m, f" {m} ")
        parts.append(t.split())
    sizes = np.array([len(p) for p in parts])
    h = _hash_words([w for p in parts for w in p])
    row = np.repeat(np.arange(len(texts)), sizes)
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x632BE59BD9B4E019))
    pair[h[:-1] == h[1:]] = 0x5851F42D4C957F2D
    same = row[:-1] == row[1:]
    key = np.concatenate([h, pair[same]])
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    bucket = (key >> np.uint64(40)).astype(np.int64) % (BUCKETS - 1) + 1
    code, count = np.unique(np.concatenate([row, row[:-1][same]]) * BUCKETS + bucket, return_counts=True)
    row, value = code // BUCKETS, np.log1p(count)
    norm = np.sqrt(np.bincount(row, value**2, minlength=len(texts)))
    return row, code % BUCKETS, value / norm[row]


class Ftrl:
    """Follow-the-regularised-leader with a learning rate for each coordinate."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(BUCKETS), np.zeros(BUCKETS)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: float, weight: float) -> None:
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        s = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - s * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", max_rows: int = 8192, epochs: int = 3) -> np.ndarray:
    """Weights by bucket, learnt from the texts of a bounded sample of the labels (rows of key and a label of 0 or 1).

    max_rows: the bound. Where there are more labels, those whose keys have the lowest hashes serve, of each kind about half
    the bound (at most that and the spread of a hash); the sample is small enough to be broadcast, so no text is shuffled. One
    task learns, as the updates follow one another; classes weigh alike. Without any row all weights are zero.
    """
    y = labels.where(F.col(label).isin(0, 1)).select(
        F.col(key).alias("key"), F.col(label).cast("int").alias("label"), F.xxhash64(F.lit(17), F.col(key).cast("string")).alias("at")
    )
    counts = {r["label"]: r["n"] for r in y.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return np.zeros(BUCKETS)
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, min(1.0, max_rows / 2 / n)).otherwise(share)
    sample = y.where(F.pmod("at", F.lit(1 << 30)) < share * float(1 << 30)).withColumn("one", F.lit(1))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(sample), "key").select("at", "text", "label", "one")
    heavy = {v: sum(counts.values()) / len(counts) / n for v, n in counts.items()}

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for k, end in portions(whole["text"].str.len().to_numpy(), CHUNK):
                batch = whole.iloc[k:end]
                row, bucket, value = features(batch["text"].tolist())
                ends = np.searchsorted(row, np.arange(len(batch) + 1))
                cut = lambda x, t: [x[a:b].astype(t).tobytes() for a, b in zip(ends, ends[1:])]
                yield pd.DataFrame({"at": batch["at"].to_numpy(), "label": batch["label"].to_numpy(), "one": 1, "bucket": cut(bucket, "<i4"), "value": cut(value, "<f4")})

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "label"])
        model = Ftrl()
        data = [
            (np.append(np.frombuffer(b, "<i4"), 0), np.append(np.frombuffer(v, "<f4").astype(float), 1.0), y)
            for b, v, y in zip(pdf["bucket"], pdf["value"], pdf["label"])
        ]
        # By hash, so in no order of the table; another rotation in each round.
        for e in range(epochs):
            for at, value, y in data[e * len(data) // epochs :] + data[: e * len(data) // epochs]:
                model.learn(at, value, y, min(8.0, heavy[y]))
        w = model.weights(slice(None))
        return pd.DataFrame({"weights": [w.astype("<f4").tobytes()]})

    small = batched(sample).mapInPandas(hashed, "at long, label int, one int, bucket binary, value binary")
    found = small.groupBy("one").applyInPandas(learn, "weights binary").collect()
    return np.frombuffer(bytes(found[0]["weights"]), "<f4").astype(float) if found else np.zeros(BUCKETS)


def score(df: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability of label 1 as a double; a null text counts as empty and gets that of the bias.

    An input column of that name is replaced; all others pass through. The weights have a fixed size and are broadcast.
    """
    df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(weights)
    at = df.columns.index(text)

    def run(batches):
        w = shared.value
        try:
            yield from scored(batches, w)
        finally:
            release(_memo)

    def scored(batches, w):
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, at, CHUNK):
                row, bucket, value = features([t or "" for t in batch.column(at).to_pylist()])
                dot = np.bincount(row, w[bucket] * value, minlength=batch.num_rows) + w[0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(dot, -35, 35))))], [*batch.schema.names, out])

    return batched(df).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))


def quality_labels(labels: DataFrame) -> DataFrame:
    """One label for each id: of several the lowest; ids and labels that are null don't count."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
