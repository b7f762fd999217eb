"""Line-first quality rules, in DataFrame expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolex.llm.common import SPACE, let, words

NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Characters that count as symbols, and those of white space.
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\x0c\r"
#: What separates the entries of a navigation line.
SEPARATORS = ["|", ">", "»", "›", "•", "·", "/", "::"]
#: Phrases of boilerplate lines in English, German, French and Spanish, in lower case.
BOILERPLATE = [
    "accept cookies",
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "licensed under the",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "we use cookies",
    "alle rechte vorbehalten",
    "cookies akzeptieren",
    "newsletter abonnieren",
    "wir verwenden cookies",
    "accepter les cookies",
    "mentions légales",
    "tous droits réservés",
    "aceptar cookies",
    "aviso legal",
    "todos los derechos reservados",
]
#: A line fails if over one in so many of its characters in words is a symbol.
SYMBOL_SHARE = 10
#: A line of so many words fails without any punctuation mark.
LONG_LINE = 12
#: A document that loses over this share (of its characters in words) is rejected.
MAX_LOST = 0.4


def _chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.regexp_replace(text, SPACE + "+", ""))


def _any(chars: str) -> str:
    """The class of these characters."""
    return "[" + re.sub(r"([\]\\^&-])", r"\\\1", chars) + "]"


def _count(text: Column, chars: str) -> Column:
    """How many of these characters a text has (a pattern is several times as fast as a translation)."""
    return F.length(text) - F.length(F.regexp_replace(text, _any(chars), ""))


def repeated_words(w: Column) -> Column:
    """Words of the list that lie in a three-word window found twice or more, the first included.

    A window is one long: the upper bits of its hash and its place in the lower ones, as many as the places need. Sorted, as plain
    numbers, windows with one hash are neighbours, which are then compared by their words. Each of those found covers three
    words less those that the next one covers.
    """
    places = F.sequence(F.lit(0), F.size(w) - 3)

    def found(bits: Column) -> Column:
        packed = F.transform(places, lambda i: F.call_function("shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long")))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def same(x: Column, y: Column) -> Column:
            # Most neighbours differ in their hashes, so words are seldom looked at.
            p, q = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
            equal = (F.get(w, p) == F.get(w, q)) & (F.get(w, p + 1) == F.get(w, q + 1)) & (F.get(w, p + 2) == F.get(w, q + 2))
            return F.coalesce((x.bitwiseXOR(y) <= mask) & (x.bitwiseXOR(y) >= 0) & equal, F.lit(False))

        def twice(s: Column) -> Column:
            both = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
            return F.sort_array(F.transform(both, lambda x: x.bitwiseAND(mask)))

        return let(F.sort_array(packed), twice)

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(p, k + 1) - x, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda a, x: a + x)

    bits = F.length(F.bin(F.size(w).cast("long")))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(let(bits, found), covered))


def line_passes(line: Column) -> Column:
    """The rules for a line with a word: punctuation, navigation, boilerplate.

    What costs more is reckoned only for lines that hold a character of the kind.
    """
    ws = F.split(F.btrim(line, F.lit(BLANKS)), SPACE + "+")
    symbols = line.rlike(_any(SYMBOLS)) & (_count(line, SYMBOLS) * SYMBOL_SHARE > _chars(line))
    shouts = line.rlike("[!?]") & (_count(line, "!?") > F.size(ws))
    bare = ~line.rlike(_any(".,;:!?…。、，؟।\"'»)-")) & (F.size(ws) >= LONG_LINE)

    def listed(w: Column) -> Column:
        separators = F.size(F.filter(w, lambda x: x.isin(SEPARATORS)))
        return (separators >= 3) & (separators * 5 >= F.size(w))

    navigation = line.rlike("|".join(map(re.escape, SEPARATORS))) & let(ws, listed)

    def phrase(lower: Column) -> Column:
        out = F.lit(False)
        for p in BOILERPLATE:
            out |= F.contains(lower, F.lit(p))
        return out

    return ~(symbols | shouts | bare | navigation | let(F.lower(line), phrase))


def assess(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the base counts, base_failed, lost_chars, clean_text and kept to a table of texts.

    A null text counts as one without words. Lines without a word are neither judged nor lost; clean_text is the text
    without the lines that fail, null if the text is. Columns of these names are replaced, all others pass through.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE))
    counts = let(words(F.col(text)), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("r")))
    clean = F.filter(F.split(t, "\n"), lambda x: ~x.rlike(NOT_SPACE) | line_passes(x))
    lost = F.aggregate(F.filter(lines, lambda x: ~line_passes(x)), F.lit(0).cast("long"), lambda a, x: a + _chars(x).cast("long"))
    named = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_chars", "clean_text", "kept"]
    own = "_counts"
    while own in df.columns:
        own += "_"
    found = df.drop(*named).withColumn(own, counts)
    found = found.withColumns(
        {
            "n_words": F.col(f"{own}.n"),
            "word_chars": _chars(t).cast("long"),
            "n_symbols": _count(t, SYMBOLS).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": F.col(f"{own}.r"),
            "lost_chars": lost,
            "clean_text": F.when(F.col(text).isNotNull(), F.array_join(clean, "\n")),
        }
    ).drop(own)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= MAX_LOST * F.col("word_chars"))).select(*df.drop(*named).columns, *named)


#: The same in SQL for DuckDB. Symbols and blanks are spelled out.
_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, i, u.w AS w FROM (
    SELECT r, unnest(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w,
           generate_subscripts(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> ''), 1) AS i FROM d
  ) u
), n AS (
  SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY r
), g AS (
  SELECT r, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY i)
), two AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g WHERE g IS NOT NULL
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM two, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY r
), l AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line FROM d
), judged AS (
  SELECT r, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
         length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
         length(line) - length(regexp_replace(line, '[!?]', '', 'g')) AS marks,
         length(line) - length(regexp_replace(line, '[.,;:!?…。、，؟।"''»)-]', '', 'g')) AS punctuation,
         list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, lower(line) AS low
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), verdict AS (
  SELECT r, line, chars,
         symbols * 10 > chars OR marks > len(ws) OR (len(ws) >= 12 AND punctuation = 0)
         OR (len(list_filter(ws, lambda x: x IN ('|', '>', '»', '›', '•', '·', '/', '::'))) >= 3
             AND len(list_filter(ws, lambda x: x IN ('|', '>', '»', '›', '•', '·', '/', '::'))) * 5 >= len(ws))
         OR {phrases} AS bad
  FROM judged
), v AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE bad), 0) AS lost FROM verdict GROUP BY r
), a AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN n USING (r) LEFT JOIN rep USING (r) LEFT JOIN v USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.4 * word_chars AS kept
FROM a
"""
SQL = _SQL.replace("{phrases}", " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE))
