"""Frequencies and vocabularies."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chronolex.functions.text import normalize_lemma, once, py_strip
from chronolex.sources.storage import batched

#: Distinct words that a Python worker counts together before it hands them on.
HELD = 500_000


def arrow_words() -> tuple:
    """Two functions over Arrow columns, made here so that they go to the workers with those who use them.

    word_lists: a column of arrays of words as it is, one of texts as the words between its blanks (empty ones among them). rows_by: the distinct
    values of columns, each with the places of its rows.
    """

    def word_lists(column):
        import pyarrow as pa
        import pyarrow.compute as pc

        return pc.split_pattern(column, " ") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column

    def rows_by(columns: list) -> list[tuple]:
        import numpy as np

        places: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(*[c.to_pylist() for c in columns])):
            places.setdefault(key, []).append(i)
        return [(key, np.array(at)) for key, at in places.items()]

    return word_lists, rows_by


def word_counts(docs: DataFrame, words: Column, by: Iterable[str] = ("lang",), rows: bool = False) -> DataFrame:
    """Rows (by, word, n) of the words of each row, an array or a text of words between blanks; with ``rows`` also the rows that hold the word, as d.

    Words are counted in batches of columns, so Spark shuffles and adds up a row for each distinct word of a task, not one for each word.
    """
    by, sums = list(by), ["n", *(["d"] if rows else [])]
    word_lists, rows_by = arrow_words()
    given = docs.select(*by, F.lit(0).alias("_all"), words.alias("_words"))
    schema = StructType([*[given.schema[c] for c in by], StructField("word", StringType()), *[StructField(c, LongType()) for c in sums]])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        types, held = None, []

        def together():
            found = pa.concat_tables(held).group_by([*by, "word"], use_threads=False).aggregate([(c, "sum") for c in sums])
            return found.rename_columns({f"{c}_sum": c for c in sums}).select(types.names)

        for b in batches:
            lists, keys = word_lists(b.column(len(by) + 1)), [b.column(i) for i in range(len(by) or 1)]
            types = types or pa.schema([*[(c, k.type) for c, k in zip(by, keys)], ("word", lists.type.value_type), *[(c, pa.int64()) for c in sums]])
            for key, at in rows_by(keys):
                mine = lists if len(at) == b.num_rows else lists.take(pa.array(at))
                coded = mine.flatten().dictionary_encode(null_encoding="encode")
                code, kinds = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
                counts = [np.bincount(code, minlength=kinds)]
                if rows:
                    size = pc.fill_null(pc.list_value_length(mine), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                    once_a_row = np.unique(np.repeat(np.arange(len(size)), size) * max(kinds, 1) + code)
                    counts.append(np.bincount(once_a_row % max(kinds, 1), minlength=kinds))
                of = [pa.repeat(pa.scalar(v, k.type), kinds) for v, k in zip(key if by else (), keys)]
                held.append(pa.table([*of, coded.dictionary, *[pa.array(c, pa.int64()) for c in counts]], schema=types))
            if sum(map(len, held)) > 2 * HELD:
                held = [together()]
                if len(held[0]) > HELD:
                    yield from held.pop().to_batches()
        if held:
            yield from together().to_batches()

    return batched(given).mapInArrow(run, schema).groupBy(*by, "word").agg(*[F.sum(c).alias(c) for c in sums])


def word_frequencies(docs: DataFrame, words: Column, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Rows (by, word, freq): occurrences of the words that are not empty; see ``word_counts``."""
    return word_counts(docs, words, by).where("word <> ''").withColumnRenamed("n", "freq")


def lemma_frequencies(tokens: DataFrame, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Occurrences of each lemma: partial sums before the shuffle."""
    return tokens.groupBy(*by, "lemma").agg(F.count("*").alias("freq"))


def char_frequencies(freqs: DataFrame, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Occurrences of each character, from lemma frequencies, so each distinct lemma is taken apart once."""
    chars = freqs.select(*by, "freq", F.explode(F.filter(F.split("lemma", ""), lambda c: c != "")).alias("ch"))
    return chars.groupBy(*by, "ch").agg(F.sum("freq").alias("freq"))


def normalize_frequencies(freqs: DataFrame, table: dict[str, str] | None = None, min_alpha: int = 3, min_ratio: float = 0.75) -> DataFrame:
    """Add norm, null where the lemma is rejected; each row is normalised once, not each use of norm, nor each occurrence before it was counted."""
    return once(freqs, "norm", normalize_lemma(F.col("lemma"), table, min_alpha, min_ratio))


def merge_normalized(normalized: DataFrame, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Frequencies of the normalised lemmas."""
    return normalized.where("norm is not null").groupBy(*by, "norm").agg(F.sum("freq").alias("freq"))


def diagnostics(normalized: DataFrame, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Types and occurrences: in all, kept under a normal form, removed, changed."""
    kept, changed = F.col("norm").isNotNull(), F.col("norm").isNotNull() & (F.col("norm") != F.col("lemma"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("freq"))), F.lit(0))
    return normalized.groupBy(*by).agg(
        F.count("*").alias("input_types"),
        F.sum("freq").alias("input_freq"),
        F.countDistinct("norm").alias("normalized_types"),
        total(kept).alias("normalized_freq"),
        F.count_if(~kept).alias("removed_types"),
        total(~kept).alias("removed_freq"),
        F.count_if(changed).alias("changed_types"),
        total(changed).alias("changed_freq"),
    )


def examples(normalized: DataFrame, n: int = 10, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Up to n changed raw forms of each normal form, most frequent first, ties by the form."""
    order = Window.partitionBy(*by, "norm").orderBy(F.desc("freq"), "lemma")
    changed = normalized.where("norm is not null and norm <> lemma").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return changed.groupBy(*by, "norm").agg(F.array_sort(F.collect_list(F.struct("rank", "lemma", "freq"))).alias("forms"))


def removed_top(normalized: DataFrame, n: int = 100) -> DataFrame:
    """The most frequent rejected forms."""
    return normalized.where("norm is null").orderBy(F.desc("freq"), "lemma").limit(n)


def vocabulary(
    freqs: DataFrame, min_freq: int, max_freq: int, min_length: int = 3, exclude: DataFrame | None = None, include: DataFrame | None = None, lemma: str = "lemma"
) -> DataFrame:
    """Rows whose lemma, stripped and in lower case, is long and frequent enough and passes the lists.

    Both frequencies are inclusive. Lower-casing merges no rows. Lists have a column word; an empty include list lets
    all pass.
    """
    out = freqs.withColumn(lemma, F.lower(py_strip(F.col(lemma)))).where((F.col(lemma) != "") & (F.length(lemma) >= min_length) & F.col("freq").between(min_freq, max_freq))
    if exclude is not None:
        out = out.join(exclude.select(F.col("word").alias(lemma)), lemma, "left_anti")
    if include is not None and not include.isEmpty():
        out = out.join(include.select(F.col("word").alias(lemma)), lemma, "left_semi")
    return out


def members(normalized: DataFrame, min_freq: int, max_freq: int, min_length: int = 3, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Rows (by, raw, lemma): the raw lemmas whose normalised lemma, with all its spellings together, is within the limits.

    One pass over the distinct lemmas (by, lemma, freq, norm) gives both the vocabulary and what leads to it.
    """
    named = memberships(normalized.withColumn("raw", F.col("lemma")), min_freq, max_freq, min_length, by)
    return named.where(F.col("lemma").isNotNull()).select(*by, "raw", "lemma")


def memberships(normalized: DataFrame, min_freq: int, max_freq: int, min_length: int = 3, by: Iterable[str] = ("lang",)) -> DataFrame:
    """Rows (by, raw, freq, norm) with lemma: their normalised lemma if it is within the limits, else null. Several raw forms may share a lemma."""
    ok = F.col("norm").isNotNull() & (F.length("norm") >= min_length)
    # Forms without a normalised one are no group, and need not meet in one task.
    total = F.sum("freq").over(Window.partitionBy(*by, "norm", F.when(~ok | F.col("norm").isNull(), F.col("raw"))))
    return normalized.withColumn("lemma", F.when(ok & total.between(min_freq, max_freq), F.col("norm")))


def union_lists(*lists: DataFrame) -> DataFrame:
    """All words of several lists, once."""
    out = lists[0].select("word")
    for more in lists[1:]:
        out = out.union(more.select("word"))
    return out.distinct()
