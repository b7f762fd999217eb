"""Helpers that several operators share: tables, checkpoints and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.sources.storage import BATCH_ROWS, batched, checkpoint, spread  # noqa: F401

#: ASCII white space, the separator of words in all contracts: space and \x09-\x0D.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set, read by Spark only, so that any Hadoop path works; a small one is spread over all cores."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: Bytes of a table, reckoned from its own rows, up to which it is broadcast; beyond, it is joined by a shuffle.
BROADCAST_BYTES = 16_000_000


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """The table, marked for a broadcast if its rows, counted, take BROADCAST_BYTES at most."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def portions(sizes: np.ndarray, rows: int = 256, size: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Stretches (first, end) of rows of these sizes: so many rows, and together of such a size, at most; a larger row is alone."""
    ends = np.cumsum(np.asarray(sizes, np.int64))
    k = 0
    while k < len(ends):
        n = max(1, min(rows, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + size, "right")) - k))
        yield k, min(k + n, len(ends))
        k += n


def slices(batch, at: int, rows: int = 256, size: int = 4_000_000) -> Iterator:
    """Slices of an Arrow batch of so many rows and bytes of its text column ``at`` at most; a longer text is alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    for a, b in portions(sizes, rows, size):
        yield batch.slice(a, b - a)


def release(*memos) -> None:
    """Empty memos and hand freed memory back to the system: a Python worker stays alive between tasks."""
    import contextlib
    import ctypes

    import pyarrow as pa

    for memo in memos:
        memo.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row.

    Catalyst copies an expression into each place that uses it, also into lambdas, where it would be
    evaluated for each element; a lambda over an array of one element keeps it in a variable.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, null as the empty text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, mod 5; rows with 0 are held out. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph, as rows (node, component); component is the smallest node.

    Alternating large-star and small-star steps: each turns the edges into stars around the smallest
    neighbour, so the rounds grow with the logarithm of the component size, and no step holds a
    component in one task: the minimum of a hub's neighbours is pre-aggregated before the shuffle and the
    join on the hub can be split by adaptive execution. Nodes without edges don't occur in the result.
    """
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u != v")
        .distinct()
    )
    e = checkpoint(e)
    signature = None
    while True:
        # Large star: each larger neighbour of a node is tied to the smallest of the node's neighbourhood.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        )
        # Small star: each node and its smaller neighbours are tied to the smallest of these.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u != v")
            .distinct()
        )
        e = checkpoint(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == signature:
            break
        signature = now
    hubs = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(hubs)
