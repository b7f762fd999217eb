"""Personal data: four fixed patterns, and bootstrapped contextual extraction, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolex.llm.common import checkpoint, let

KINDS = ["email", "ip", "card", "phone"]
#: Kinds that only the bootstrap finds, in their order after the others.
LEARNT = ["secret"]
#: The contract's patterns in forms that neither back-track nor recurse on long runs: a run of characters is tried from its
#: start, or from the end of the last match inside it, and taken whole.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A run of characters of identifiers that holds a digit or an at sign: what a learnt pattern may discover.
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9@+._%-]))[A-Za-z+._%-]*+[0-9@][A-Za-z0-9@+._%-]*+"
#: Groups of digits joined by blanks, hyphens and brackets: a candidate, unless a run of characters at its start is one by itself.
GROUPED = r"(?<![A-Za-z0-9@+._%-])(?:\([0-9]{2,5}\)[\x20-]?+|[0-9]{2,5}[\x20-])[0-9]{2,5}(?![A-Za-z0-9@%])(?:[\x20-][0-9]{2,5}(?![A-Za-z0-9@%])){0,4}+"
#: What a candidate must look like to be of a kind, where fixed patterns don't say so.
SHAPES = {
    "email": r"^[^@]{2,}@[^@]{2,}$",
    "ip": r"^[0-9]{1,3}(\.[0-9]{1,3}){2,3}$",
    "card": r"^[0-9][0-9\x20.-]{10,22}[0-9]$",
    "phone": r"^[+(]?[0-9][0-9\x20().-]{5,18}[0-9]$",
    "secret": r"^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9_+.-]{16,}$",
}
#: Long mixes of letters and digits are seeds of secrets: they teach patterns, but are found themselves only in the context of a learnt one.
SEED = r"^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9]{32,}$"
#: The word before an identifier, with the marks between that stand alone, as in ``key = "``.
BEFORE = r"(\S*[\p{L}\p{N}]\S*(?:\s+[^\p{L}\p{N}\s]+)*|\S+)\s*$"
#: Code points of context that are looked at on each side.
CONTEXT = 48
SPAN = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def _word(text: Column, pattern: str) -> Column:
    """A neighbouring word, in lower case, digits as 0."""
    return F.regexp_replace(F.lower(F.regexp_extract(text, pattern, 1)), "[0-9]", "0")


def matches(text: Column, pattern: str) -> Column:
    """All matches with their places in code points and the words next to them.

    The parts between matches give the places: each begins where the lengths of all before it end.
    """

    def place(m: Column, p: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(p, i))
            end = start + F.length(F.get(m, i))
            left = _word(F.right(F.get(p, i), F.lit(CONTEXT)), BEFORE)
            right = _word(F.left(F.get(p, i + 1), F.lit(CONTEXT)), r"^\s*(\S+)")
            span = F.struct(start.alias("start"), end.alias("end"), F.get(m, i).alias("value"), left.alias("left"), right.alias("right"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), zero, step, lambda acc: acc["out"])

    none = F.array().cast(SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda p: place(m, p))))


def _luhn(digits: Column) -> Column:
    ds = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(ds, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of a kind's pattern counts."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda x: x.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the columns base (array of kind, start, end, value, left, right) and more (candidates that overlap none of them)."""
    t = F.coalesce(F.col(text), F.lit(""))
    gate = {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+"))}
    none = F.array().cast(SPAN)

    def of(kind: str) -> Column:
        kept = F.filter(F.when(gate.get(kind, F.lit(True)), matches(t, PATTERNS[kind])).otherwise(none), lambda x: valid(kind, x["value"]))
        return F.transform(kept, lambda x: F.struct(F.lit(kind).alias("kind"), *[x[n].alias(n) for n in ("start", "end", "value", "left", "right")]))

    found = df.withColumn("base", F.concat(*[of(k) for k in KINDS]))
    def shape(value: Column) -> Column:
        out = F.lit(False)
        for s in SHAPES.values():
            out |= value.rlike(s)
        return out

    def over(x: Column, y: Column) -> Column:
        return (x["start"] < y["end"]) & (y["start"] < x["end"])

    def free(pattern: str) -> Column:
        return F.filter(F.filter(matches(t, pattern), lambda x: shape(x["value"])), lambda x: ~F.exists("base", lambda b: over(b, x)))

    def joined(single: Column, grouped: Column) -> Column:
        return F.concat(F.filter(single, lambda x: ~F.exists(grouped, lambda g: over(g, x))), grouped)

    def both(single: Column) -> Column:
        apart = F.filter(free(GROUPED), lambda g: ~F.exists(single, lambda x: (x["start"] <= g["start"]) & (g["start"] < x["end"])))
        return let(apart, lambda grouped: joined(single, grouped))

    return found.withColumn("more", let(free(CANDIDATE), both))


def bootstrap(occurrences: DataFrame, rounds: int = 3, min_seeds: int = 4, min_confidence: float = 0.8) -> DataFrame:
    """Candidates that confident patterns give a kind, as rows (rid, kind, start, end).

    occurrences: rid, kind (null: a candidate), start, end, value, left, right. A pattern is a pair of the words around an
    identifier, or the word before it. Patterns and values form a graph: in each round a pattern's confidence in a kind is the
    share of the kind's values among all its values, weighed down where there are few; a candidate's is that of the
    complement of all its patterns failing; those over the threshold are labelled and count in the next round. Seeds of
    the kinds in LEARNT are candidates as well.
    """
    kinds = KINDS + LEARNT
    both = F.array(F.concat(F.lit("L "), F.col("left")), F.concat(F.lit("B "), F.col("left"), F.lit(" "), F.col("right")))
    edges = occurrences.where("left <> ''").select("rid", "start", "end", "kind", "value", F.explode(both).alias("pattern"))
    # One row for a pattern, value and kind, however often it occurs.
    graph = checkpoint(edges.groupBy("pattern", "value", "kind").agg(F.count("*").alias("n")))
    open_ = F.col("kind").isNull() | F.col("kind").isin(LEARNT)
    learnt = None
    for _ in range(rounds):
        known = graph if learnt is None else graph.join(learnt, "value", "left").withColumn("kind", F.coalesce("kind", "new")).drop("new")
        totals = known.groupBy("pattern").agg(F.count("*").alias("all"), *[F.sum((F.coalesce("kind", F.lit("")) == k).cast("int")).alias(k) for k in kinds])
        split = F.explode(F.array(*[F.struct(F.lit(k).alias("as"), F.col(k).alias("hits")) for k in kinds]))
        sure = (
            totals.select("pattern", "all", split.alias("s"))
            .select("pattern", F.col("s.as").alias("as"), F.col("s.hits").alias("hits"), (F.col("s.hits") / (F.col("all") + 1)).alias("confidence"))
            .where((F.col("hits") >= min_seeds) & (F.col("confidence") >= 0.5))
        )
        shape = F.lit(False)
        for k in kinds:
            shape |= (F.col("as") == k) & F.col("value").rlike(SHAPES[k])
        votes = graph.where(open_).drop("kind").distinct().join(sure, "pattern").where(shape)
        per = votes.groupBy("value", "as").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))).alias("score"))
        best = per.where(F.col("score") >= min_confidence).groupBy("value").agg(F.max_by("as", F.struct("score", "as")).alias("new"))
        learnt = checkpoint(best)
    found = occurrences.where(open_).join(learnt, "value")
    return found.select("rid", F.col("new").alias("kind"), "start", "end")


def find(df: DataFrame, text: str = "text", keep: list[str] | None = None, rounds: int = 3) -> DataFrame:
    """The columns ``keep`` (default: all but the text) with base_spans and spans, arrays of (kind, start, end).

    Places are in code points, ends exclusive; arrays are sorted by kind as listed and start. A null text counts as empty
    and has no spans. spans holds the base ones and those that the bootstrap adds, which overlap none of them. Rows are told
    apart by their place in the input, so repeated and null ids do no harm.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    names = [f"c{i}" for i in range(len(keep))]
    rows = scan(df.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.monotonically_increasing_id().alias("rid"), F.col(text).alias("text")))
    rows = checkpoint(rows.select("rid", *names, "base", "more"))
    span = ["start", "end", "value", "left", "right"]
    seeds = rows.select("rid", F.explode("base").alias("x")).select("rid", "x.kind", *[f"x.{n}" for n in span])
    others = rows.select("rid", F.explode("more").alias("x")).select("rid", *[f"x.{n}" for n in span])
    others = others.withColumn("kind", F.when(F.col("value").rlike(SEED), "secret"))
    added = bootstrap(seeds.unionByName(others), rounds)
    added = added.groupBy("rid").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS + LEARNT) for x in (k, i)])

    def ordered(spans: Column) -> Column:
        keyed = F.array_sort(F.transform(spans, lambda x: F.struct(order[x["kind"]].alias("at"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
        return F.transform(keyed, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    base = F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    out = rows.select("rid", *names, base.alias("base")).join(added, "rid", "left")
    both = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>"))))
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], ordered(F.col("base")).alias("base_spans"), ordered(both).alias("spans"))


def digests(df: DataFrame) -> DataFrame:
    """Counts by kind of the base spans, their hash, all spans as text and their number, for a table with base_spans, spans and doc_id."""

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return df.select("doc_id", *counts, F.sha2(said(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (of overlapping ones all together) replaced by its kind in brackets."""

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        put = F.when(x["start"] >= acc["at"], F.concat(gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], put).alias("out"))

    by_place = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    done = F.aggregate(by_place, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """The documents with redacted texts; n_chars (if there is one) follows the text where that changes. A null text stays."""
    found = find(df, text, keep=df.columns)
    out = found.withColumn(text, redact(F.col(text), F.col("spans")))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length(text)).otherwise(F.col("n_chars")).cast(df.schema["n_chars"].dataType))
    return out.select(df.columns)
