"""Near-duplicate embeddings: subspace pigeonhole join with exact verification."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolex.llm.common import checkpoint, connected_components, small

#: Blocks that the rotated vectors are split into.
BLOCKS = 8
#: Vectors that a task holds on one side of a comparison; larger cells are cut into pairs of chunks.
TILE = 4096
#: Vectors that the places of cuts are taken from; they decide about speed only.
SAMPLE = 20_000
#: Most halvings of a coordinate.
HALVINGS = 4
STEP = 512


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix; distances stay as they are, each block gets a like share of them."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _linked(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, block: int, cuts: list[slice], budgets: np.ndarray, least: float, same: bool):
    """Places (i, j) of the pairs that are within the block's budget, within that of no block before it, and verified."""
    sa, sb = a[:, cuts[block]], b[:, cuts[block]]
    near = (sa**2).sum(1)[:, None] + (sb**2).sum(1) - 2 * sa @ sb.T <= budgets[block] + 1e-6
    if same:
        near &= np.tri(len(a), len(b), -1, dtype=bool).T
    i, j = np.nonzero(near)
    out = []
    for k in range(0, len(i), 50_000):
        p, q = i[k : k + 50_000], j[k : k + 50_000]
        x, y = raw_a[p], raw_b[q]
        cos = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
        ok = cos >= least
        p, q = p[ok], q[ok]
        # The same sums in each task, so each pair counts in exactly one block: the first within its budget.
        square = (a[p] - b[q]) ** 2
        within = np.stack([square[:, c].sum(1) <= t for c, t in zip(cuts, budgets)], 1) if len(p) else np.zeros((0, len(cuts)), bool)
        mine = within.argmax(1) == block
        out.append((p[mine], q[mine]))
    return tuple(np.concatenate(z) for z in zip(*out)) if out else (i, j)


def halvings(levels: int, dim: int) -> list[int]:
    """How often each coordinate of a block is halved, ``levels`` times in all, one after the other."""
    levels = min(levels, HALVINGS * dim)
    return [levels // dim + (c < levels % dim) for c in range(dim)]


def cells_within(x: np.ndarray, edges: list[np.ndarray], budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, whether it is the row's own): the cells, cut by the edges of each coordinate, within the squared distance ``budget`` of each row.

    Of the others only those behind the own one: of two rows within the budget that lie in different cells, each is within it of the other's cell,
    so one of them finds the other.
    """
    row, cell, spent, order = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x)), np.zeros(len(x), np.int64)
    for c, cuts in enumerate(edges):
        if not len(cuts):
            continue
        own, found = np.searchsorted(cuts, x[:, c], "right"), []
        for k in range(len(cuts) + 1):
            low = cuts[k - 1] - x[row, c] if k else np.full(len(row), -np.inf)
            high = x[row, c] - cuts[k] if k < len(cuts) else np.full(len(row), -np.inf)
            mine = own[row]
            gap = np.where(mine == k, 0.0, np.maximum(np.maximum(low, high), 0))
            ahead = np.where(order == 0, np.sign(k - mine), order)  # the first coordinate that differs decides
            ok = (spent + gap**2 <= budget) & (ahead >= 0)
            found.append((row[ok], cell[ok] * (len(cuts) + 1) + k, (spent + gap**2)[ok], ahead[ok]))
        row, cell, spent, order = (np.concatenate(z) for z in zip(*found))
    return row, cell, order == 0


def _unite(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Join the classes of each pair (p, q); root holds the smallest place of each place's class."""
    while True:
        x, y = root[p], root[q]
        apart = x != y
        if not apart.any():
            return
        p, q = p[apart], q[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def links(df: DataFrame, least: float = 0.93, blocks: int = BLOCKS) -> DataFrame:
    """Rows (id, n, other) for vectors of one label with a cosine of ``least`` or more; df: id, weight, label, embedding (all of one length).

    The squared distance of two unit vectors with that cosine is R = 2 - 2 * least at most, so in one block of the rotated
    space it is within that block's share of R. Each block is range-joined: a label's vectors lie in cells of a k-d grid, whose coordinates are halved
    in turn until a cell holds TILE vectors or so; a vector is sent to its own cell and, as a probe, to those behind it whose squared distance, over
    all coordinates of the block, is within the share. There blocks are compared, and full vectors decide. For each cell n adds up the weights of the
    vectors that are linked to id there, and other is the smallest that id reaches there by links, id itself included: these stars have the components
    of the links, which the smallest neighbours alone don't (of a chain 1, 3, 4, 2 they lose the link from 3 to 4); so a group of copies costs as many
    rows as it has vectors.
    """
    spark = df.sparkSession
    first = df.select(F.size("embedding").alias("d")).first()
    if first is None:
        return spark.createDataFrame([], "id long, n long, other long")
    dim = int(first["d"])
    blocks = min(blocks, dim)
    cuts = [slice(x[0], x[-1] + 1) for x in np.array_split(np.arange(dim), blocks)]
    budgets = (2 - 2 * least) * np.array([c.stop - c.start for c in cuts]) / dim * (1 + 1e-9) + 1e-12
    turn = rotation(dim)

    def turned(vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no square is too large or too small
        return np.round((unit / np.linalg.norm(unit, axis=1, keepdims=True)) @ turn, 12)

    counts = checkpoint(df.groupBy("label").agg(F.count("*").alias("many")))
    top = counts.agg(F.max("many")).first()[0]
    edges: dict[tuple, np.ndarray] = {}  # by coordinate and number of halvings
    if top > TILE:
        share = min(1.0, SAMPLE / counts.agg(F.sum("many")).first()[0])
        drawn = df.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < share * (1 << 30)).select("embedding").limit(2 * SAMPLE).collect()
        points = turned(np.array([r["embedding"] for r in drawn], float)) if drawn else np.zeros((1, dim))
        edges = {(c, h): np.unique(np.quantile(points[:, c], np.arange(1, 1 << h) / (1 << h))) for c in range(dim) for h in range(1, HALVINGS + 1)}
    kind, number = df.schema["label"].dataType.simpleString(), df.schema["embedding"].dataType.simpleString()
    sized = df.join(small(counts, 32), "label").withColumn("levels", F.ceil(F.greatest(F.log2(F.col("many") / TILE), F.lit(0.0))).cast("int"))

    def cells(batches):
        for pdf in batches:
            unit = turned(np.array(pdf["embedding"].tolist(), float))
            levels = pdf["levels"].to_numpy()
            for n in np.unique(levels).tolist():
                rows = np.flatnonzero(levels == n)
                for b in range(blocks):
                    size = cuts[b].stop - cuts[b].start
                    own = [edges[cuts[b].start + c, h] if h else np.zeros(0) for c, h in enumerate(halvings(n, size))]
                    row, cell, home = cells_within(unit[rows][:, cuts[b]], own, budgets[b] * (1 + 1e-6) + 1e-9)
                    for k in range(0, len(row), STEP * 8):
                        at = rows[row[k : k + STEP * 8]]
                        part = pdf.iloc[at][["label", "id", "weight", "embedding"]]
                        yield part.assign(block=b, cell=cell[k : k + STEP * 8], probe=~home[k : k + STEP * 8])[["label", "block", "cell", "probe", "id", "weight", "embedding"]]

    spread = sized.select("label", "id", "weight", "embedding", "levels").mapInPandas(cells, f"label {kind}, block int, cell long, probe boolean, id long, weight long, embedding {number}")
    by = ["label", "block", "cell"]
    sizes = spread.select(*by, "probe").groupBy(*by).agg(F.count_if("probe").alias("probes"), F.count_if(~F.col("probe")).alias("homes"))
    sizes = checkpoint(sizes.where("homes > 0 and homes + probes > 1").withColumn("parts", F.ceil(F.greatest("homes", "probes") / TILE).cast("int")))
    # Chunk i of what is held against chunk j: all pairs of chunks meet, each in a task of its own.
    chunk = F.pmod(F.xxhash64("id"), "parts").cast("int")
    many = F.sequence(F.lit(0), F.col("parts") - 1)
    left = F.when(F.col("probe"), F.transform(many, lambda j: F.struct(chunk.alias("i"), j.alias("j"), F.lit(0).alias("side"))))
    right = F.concat(
        F.transform(many, lambda i: F.struct(i.alias("i"), chunk.alias("j"), F.lit(1).alias("side"))),
        F.transform(F.filter(many, lambda j: j > chunk), lambda j: F.struct((-chunk - 1).alias("i"), j.alias("j"), F.lit(0).alias("side"))),
        F.transform(F.filter(many, lambda i: i <= chunk), lambda i: F.struct((-i - 1).alias("i"), chunk.alias("j"), F.lit(1).alias("side"))),
    )
    # i below 0: chunks -i-1 and j of the homes among themselves; i from 0: probes' chunk i against homes' chunk j.
    dealt = spread.join(small(sizes.select(*by, "parts"), 48), by).select(*by, "id", "weight", "embedding", F.explode(F.coalesce(left, right)).alias("x"))
    dealt = dealt.select(*by, "x.i", "x.j", "x.side", "id", "weight", "embedding")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        block, i, j = int(pdf["block"].iloc[0]), int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        pdf = pdf.sort_values("id", kind="stable")
        v = np.array(pdf["embedding"].tolist(), float)
        v /= np.abs(v).max(axis=1, keepdims=True)
        side, ids, weight = pdf["side"].to_numpy(), pdf["id"].to_numpy(), pdf["weight"].to_numpy()
        unit = turned(v)
        right = np.flatnonzero(side == 1)
        left = right if i == -j - 1 else np.flatnonzero(side == 0)
        n, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for a in range(0, len(left), STEP):
            for b in range(a if left is right else 0, len(right), STEP):
                x, y = left[a : a + STEP], right[b : b + STEP]
                p, q = _linked(unit[x], unit[y], v[x], v[y], block, cuts, budgets, least, left is right and a == b)
                p, q = x[p], y[q]
                np.add.at(n, p, weight[q])
                np.add.at(n, q, weight[p])
                _unite(root, p, q)
        hit = n > 0
        return pd.DataFrame({"id": ids[hit], "n": n[hit], "other": ids[root[hit]]})

    return dealt.groupBy(*by, "i", "j").applyInPandas(meet, "id long, n long, other long")


def components(df: DataFrame, least: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: key, n_links (other vectors linked directly), component_id (the smallest key in reach) and kept (whether that is its own).

    Equal vectors of a label are compared once, with their number as weight. Vectors that are null, empty, zero or hold null or
    non-finite components, and those without a label link with nothing; they stay alone. Rows that
    repeat a key are vectors of their own, with their own links; so are those without a key, which name no component. Vectors of different lengths link with nothing of another length. Components keep
    the precision that the table has, sums are in double precision.
    """
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    v = F.col(vector).cast(kind)
    good = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    fine = F.coalesce(good & F.col(label).isNotNull(), F.lit(False))
    rows = df.select(F.col(key).cast("long").alias("id"), F.when(fine, F.col(label)).alias("label"), F.when(fine, v).alias("embedding"))
    groups = rows.where("embedding is not null").groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    groups = checkpoint(groups)
    if groups.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1 or rep is null").isEmpty():
        groups = groups.withColumn("node", F.col("rep"))
    else:  # several vectors under one key or none: numbers in the order of the keys, none last, tell them apart
        groups = checkpoint(groups.orderBy(F.asc_nulls_last("rep"), "label", "embedding").withColumn("node", F.monotonically_increasing_id()))
    lengths = [r[0] for r in groups.select(F.size("embedding")).distinct().collect()]
    found = None
    for d in sorted(lengths):
        part = groups.where(F.size("embedding") == d).select(F.col("node").alias("id"), "weight", "label", "embedding")
        got = links(part, least)
        found = got if found is None else found.unionByName(got)
    out = rows.join(groups, ["label", "embedding"], "left").select("id", "node", "rep", "weight")
    if found is None:
        return out.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    met = checkpoint(found.groupBy("id", "other").agg(F.sum("n").alias("n")))
    count = met.groupBy("id").agg(F.sum("n").alias("n"))
    parts = connected_components(met.select(F.col("id").alias("a"), F.col("other").alias("b")))
    reps = groups.select(F.col("node").alias("component"), F.col("rep").alias("component_id"))
    named = parts.join(reps, "component").select(F.col("node").alias("id"), "component_id")
    facts = count.join(named, "id", "full").withColumnRenamed("id", "node")
    out = out.join(facts, "node", "left")
    component = F.coalesce("component_id", "rep", "id")
    return out.select(
        F.col("id").alias(key),
        (F.coalesce("weight", F.lit(1)) - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )
