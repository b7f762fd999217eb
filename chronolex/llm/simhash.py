"""SimHash near-duplicates: meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolex.llm.common import batched, checkpoint, connected_components, release, slices, small

#: Variants that a task compares at a time.
SLAB = 1_000_000
SHINGLE, SEED = 3, 42


def fingerprint(text: str | None) -> int:
    """64 bits: each is 1 if it is set in over half of the XXH64 hashes of the text's word shingles."""
    import xxhash

    # bytes: lower() changes A-Z only, split() splits at \x20 and \x09-\x0D only
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - SHINGLE + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    h = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65536):
        ones += np.unpackbits(h[k : k + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Append the signed 64-bit fingerprint of each text; without words (also null) it is zero."""
    df = df.drop(out)
    at = df.columns.index(text)

    def run(batches: Iterator):
        import pyarrow as pa

        try:
            for whole in batches:
                for batch in slices(whole, at):
                    got = pa.array([fingerprint(t) for t in batch.column(at).to_pylist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([*batch.columns, got], [*batch.schema.names, out])
        finally:
            release()

    return batched(df).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.LongType())]))


def balls(radius: int, bits: int = 32) -> list[np.ndarray]:
    """For each radius up to the given one the masks of so many bits at most, lightest first."""
    out = [np.zeros(1, np.uint64)]
    for _ in range(radius):
        last = out[-1][np.bitwise_count(out[-1]) == len(out) - 1]
        more = np.unique((last[:, None] | (np.uint64(1) << np.arange(bits, dtype=np.uint64))).ravel())
        out.append(np.concatenate([out[-1], more[np.bitwise_count(more) == len(out)]]))
    return out


def meetings(key: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Rows (a, b) of fingerprints that have a variant in common, for rows of whole groups sorted by key.

    A key is a half of a variant and its side; the fingerprints of a group complete it to variants of all 64 bits by flipping
    bits of their other half. Of those that share a variant the nearest leads, ties by value, and the others are paired with it: if
    two are within the radius by way of that variant, so is each from the leader. Work grows with the number of variants.
    """
    none = np.zeros((0, 2), np.int64)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    if not several.any():
        return none
    key, u = key[several], fp[several].view(np.uint64)
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    side = (key & 1).astype(bool)  # 1: the key is of the upper half
    low, high = u & np.uint64(0xFFFFFFFF), u >> np.uint64(32)
    free = np.where(side, low, high)
    flipped = np.bitwise_count(np.where(side, high, low) ^ (key >> 1).astype(np.uint64)).astype(np.int64)
    # Bits left to flip. With an odd radius two that differ in so many bits have different parities: the even one goes one bit farther.
    left = radius // 2 - flipped + (radius % 2) * ((flipped == 0) & (np.bitwise_count(u) % 2 == 0))
    masks = balls(int(left.max()))
    size = np.array([len(m) for m in masks])[left]
    edges, k = [], 0
    ends = np.cumsum(size)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    stops = np.append(starts[1:], len(group))
    while k < len(starts):
        base = ends[starts[k]] - size[starts[k]]
        n = max(k + 1, int(np.searchsorted(ends[stops - 1], base + SLAB, "right")))
        rows = np.arange(starts[k], stops[n - 1])
        passes = int(-(-size[rows].sum() // SLAB))  # over one only for a single large group: a share of its variants each
        for p in range(passes):
            code, far, who = [], [], []
            for d, m in enumerate(masks):
                own = rows[left[rows] == d]
                if not len(own):
                    continue
                v = (free[own][:, None] ^ m).ravel()
                w = np.repeat(own, len(m))
                f = (np.bitwise_count(m)[None, :] + flipped[own].astype(np.uint8)[:, None]).ravel()
                if passes > 1:
                    mine = (v * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(passes) == p
                    v, w, f = v[mine], w[mine], f[mine]
                code.append((group[w] - group[rows[0]]).astype(np.uint64) << np.uint64(32) | v)
                far.append(f)
                who.append(w)
            code, far, who = np.concatenate(code), np.concatenate(far), np.concatenate(who)
            order = np.argsort(code, kind="stable")
            c = code[order]
            first = np.concatenate([[True], c[1:] != c[:-1]])
            shared = ~first
            shared[:-1] |= ~first[1:]
            order = order[shared]
            if not len(order):
                continue
            code, far, value = code[order], far[order], u[who[order]]
            order = np.lexsort((value, far, code))
            code, value = code[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            lead = np.repeat(value[first], np.diff(np.append(first, len(code))))
            ok = (lead != value) & (np.bitwise_count(lead ^ value) <= radius)
            edges.append(np.unique(np.stack([lead[ok], value[ok]], 1).view(np.int64), axis=0))
        k = n
    return np.unique(np.concatenate(edges), axis=0) if edges else none


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in ``radius`` bits at most, enough of them to reach all that all pairs reach.

    Each fingerprint emits all variants of its 64 bits within half the radius; two that are near have one in common. With an
    odd radius those of even parity go one bit farther, as half the radius is no whole number and only fingerprints of different
    parity differ in so many bits. Of two that are near, one half differs in half the radius at most: one of the two flips those bits and the variants
    go by that half. So the variants that share a half are shuffled as one row of their fingerprint (66 rows for a radius of three) and
    are completed and compared behind the shuffle (see ``meetings``), deduplicated and verified over all bits. No bucket is
    compared in pairs, so work grows as the number of fingerprints, however many share a half.
    """
    masks = F.array(*[F.lit(m) for m in balls(radius // 2)[-1].tolist()])

    def variants(half, side: int):
        return F.transform(masks, lambda m: half.bitwiseXOR(m) * 2 + side)

    keys = F.concat(variants(F.col("fp").bitwiseAND(0xFFFFFFFF), 0), variants(F.shiftrightunsigned("fp", 32), 1))
    rows = fps.select(F.explode(keys).alias("key"), "fp").repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator):
        import pyarrow as pa

        def out(key, fp):
            edges = meetings(key, fp, radius)
            return pa.RecordBatch.from_arrays([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], ["a", "b"])

        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        try:
            for batch in batches:
                key = np.concatenate([key, batch.column(0).to_numpy()])
                fp = np.concatenate([fp, batch.column(1).to_numpy()])
                end = np.searchsorted(key, key[-1]) if len(key) else 0  # the last group may go on
                if end > 100_000:
                    yield out(key[:end], fp[:end])
                    key, fp = key[end:], fp[end:]
            if len(key):
                yield out(key, fp)
        finally:
            release()

    return rows.mapInArrow(run, "a long, b long").distinct()


def _digest(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def components(df: DataFrame, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, fp, digest (of the text) and component_id, the smallest key that links reach.

    Equal fingerprints are one node, so groups of copies cost one row in the search. Rows with a null key
    take part with their text; a component that has only such rows has a null component_id. Rows that repeat a key are rows of
    their own, each with the component of its text.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"), _digest(F.col(text)).alias("digest"))
    docs = checkpoint(fingerprints(docs).drop("text"))
    nodes = checkpoint(docs.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("n")))
    parts = connected_components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = checkpoint(parts.join(nodes, "fp").select("fp", "component", "least"))
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component", "component_id")
    # Only fingerprints of several rows or with links need be looked up; a checkpoint of these on one side lets Spark split a hot one on the other.
    known = nodes.join(named, "fp", "left").where((F.col("n") > 1) | F.col("component").isNotNull())
    known = checkpoint(known.select("fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("component", "fp").alias("component"), F.lit(True).alias("shared")))
    out = docs.join(small(known, 40), "fp", "left")
    own = F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), "fp", "digest", F.coalesce("component", "fp").alias("component"), own.alias("component_id"))


def near_dedup(df: DataFrame, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each component stays, that of the smallest key; columns are those of ``df``.

    A key may repeat: its texts are documents of their own, of which those of other components stay. Of rows of one component under its smallest key
    the one whose text has the smallest digest stays, once. Rows with a null key stay, as nothing names them.
    """
    own = {n: f"c{i}" for i, n in enumerate(df.columns)}
    rows = df.select(*[F.col(f"`{n}`").alias(c) for n, c in own.items()])
    found = components(df.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text")), radius)
    each = checkpoint(found.groupBy("doc_id", "digest", "component").agg(F.count("*").alias("n")))
    kept = each.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("kept"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    drop = each.join(small(checkpoint(kept), 48), "component").where(F.struct("doc_id", "digest") != F.col("kept")).select("doc_id", "digest")
    rows = rows.withColumns({"doc_id": F.col(own[key]), "digest": _digest(F.col(own[text]))})
    out = rows.where("doc_id is not null").join(small(checkpoint(drop), 32), ["doc_id", "digest"], "left_anti")
    if not each.where("n > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "digest"])
    return out.unionByName(rows.where("doc_id is null")).select(*[F.col(c).alias(n) for n, c in own.items()])
