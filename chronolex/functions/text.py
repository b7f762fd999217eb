"""Normalisation of historical and noisy spellings, as Catalyst expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What Python's str.strip() takes for white space: a class for patterns, and the characters.
PY_SPACE = r"[\s\x1c-\x1f\x85]"
PY_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters, and what stands for them.
LETTERS = {
    "œ": "oe", "Œ": "oe", "æ": "ae", "Æ": "ae", "ß": "ss", "ﬁ": "fi", "ﬂ": "fl", "ſ": "s", "þ": "th", "Þ": "th", "ð": "d", "Ð": "d", "ø": "o", "ı": "i", "ł": "l", "ӧ": "o",
}
#: Signs that are dropped, and those that become an ASCII sign.
DROPPED = "¨¯¸˜˝᾿₌≠≮≯™®©°§†‡•·…�"
SIGNS = {"'": "’‘ʼʻ`´′‹›", "-": "‐‑‒–—−⸗", '"': "«»“”„‟"}
#: Signs that are stripped from both ends of a lemma.
BOUNDARY = " \t\n\r" ".,;:!?()[]{}" "\"'" "-_\\/|~^=+*@#$%&§°£€¥¢©®™" "•■□▲►▼★♦✓†‡¶"


def fold_char(ch: str) -> str | None:
    """What a character becomes: '' deletes it, None leaves it.

    The fixed values come first; other characters are decomposed, and count if plain ASCII that differs remains.
    """
    if ch in LETTERS:
        return LETTERS[ch]
    if ch in DROPPED:
        return ""
    for sign, variants in SIGNS.items():
        if ch in variants:
            return sign
    if ch.isascii():
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
    return plain.lower() if plain and plain.isascii() and plain != ch else None


def char_report(ch: str) -> tuple[str, str, str]:
    """Code point, Unicode name and category."""
    return f"U+{ord(ch):04X}", unicodedata.name(ch, ""), unicodedata.category(ch)


def char_table(counts: dict[str, int], min_count: int = 1) -> dict[str, str]:
    """The replacements of the characters that occur often enough; '' deletes."""
    if any(len(c) != 1 for c in counts):
        raise ValueError("a key of the character frequencies is not one character")
    return {c: r for c, n in sorted(counts.items()) if n >= min_count and (r := fold_char(c)) is not None}


@cache
def latin_table() -> dict[str, str]:
    """The table of all letters of the Latin blocks and of the fixed values."""
    fixed = [*LETTERS, *DROPPED, *"".join(SIGNS.values())]
    chars = {chr(c) for c in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00))} | set(fixed)
    return char_table(dict.fromkeys(chars, 1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: Catalyst would copy it into each place that uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The table with a column that is evaluated once for each of its rows.

    A filter on it would else be pushed below an aggregation, to each row that is counted, and the value copied into each use; neither passes a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def py_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(PY_BLANKS))


def translate(c: Column, table: dict[str, str]) -> Column:
    """Replace characters by a table: one native translation, then those that become several characters, in texts with any of them."""
    if any(len(k) != 1 for k in table):
        raise ValueError("a key of the table is not one character")
    single = {k: v for k, v in table.items() if len(v) == 1}
    gone = [k for k, v in table.items() if not v]
    several = {k: v for k, v in table.items() if len(v) > 1}

    def expand(x: Column) -> Column:
        out = x
        for k, v in several.items():
            out = F.replace(out, F.lit(k), F.lit(v))
        return F.when(x.rlike(f"[{''.join(several)}]"), out).otherwise(x) if several else x

    return let(F.translate(c, "".join(single) + "".join(gone), "".join(single.values())), expand)


def normalize_lemma(lemma: Column, table: dict[str, str] | None = None, min_alpha: int = 3, min_ratio: float = 0.75) -> Column:
    """The normalised lemma, or null where it is rejected.

    Lower case, table, strip, boundary signs, inner ``.``, ``-`` and ``'``; then only a-z may be left, at least ``min_alpha``
    of them, and at least ``min_ratio`` of the length before the boundary signs went.
    """

    def check(base: Column) -> Column:
        core = F.translate(F.btrim(base, F.lit(BOUNDARY)), ".-'", "")
        return let(core, lambda c: F.when(c.rlike("^[a-z]+$") & (F.length(c) >= min_alpha) & (F.length(c) / F.length(base) >= min_ratio), c))

    return let(py_strip(translate(F.lower(lemma), latin_table() if table is None else table)), check)


def term_key(term: Column) -> Column:
    """A key under which spellings of a term agree: without accents, one blank between words, lower case.

    Composed letters are folded by the Latin table, without expansions; combining marks are dropped.
    """
    accents = {k: v for k, v in latin_table().items() if len(v) == 1 and k.isalpha() and k not in LETTERS}
    bare = F.regexp_replace(translate(F.lower(term), accents), r"\p{Mn}+", "")
    return F.btrim(F.regexp_replace(bare, f"(?U){PY_SPACE}+", " "))
