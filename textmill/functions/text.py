"""Text columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Code point ranges that count as emoji (the sixth from the end is wide: it
# also holds CJK, kana and hangul).
EMOJI_RANGES = [
    ("1F1E6", "1F1FF"),
    ("1F300", "1F5FF"),
    ("1F600", "1F64F"),
    ("1F680", "1F6FF"),
    ("1F700", "1F77F"),
    ("1F780", "1F7FF"),
    ("1F800", "1F8FF"),
    ("1F900", "1F9FF"),
    ("1FA00", "1FAFF"),
    ("2702", "27B0"),
    ("24C2", "1F251"),
    ("2600", "26FF"),
    ("2300", "23FF"),
    ("200D", "200D"),
    ("FE0F", "FE0F"),
]

# Pieces of the wide range that are symbols: enclosed letters to arrows, and enclosed ideographs.
STRICT_WIDE = [("24C2", "24FF"), ("25A0", "27BF"), ("2900", "297F"), ("2B00", "2BFF"), ("1F000", "1F251")]

# Fixed value: the published GPT-2 pre-token pattern.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def whitespace_words(text: Column) -> Column:
    """Words between white space; an empty or blank text has none."""
    parts = F.split(strip(text), r"(?U)[\s\x1c-\x1f]+", -1)
    return F.when(strip(text) == "", F.array().cast("array<string>")).otherwise(parts)


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return lowered_tokens(F.lower(text))


def lowered_tokens(text: Column) -> Column:
    """``word_tokens`` of a text that is in lower case."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def ngrams(words: Column, low: int, high: int) -> Column:
    """Word n-grams of sizes ``low``..``high``, joined by one space."""
    if high < low:
        return F.array().cast("array<string>")

    def build(bound: Column) -> Column:
        def of_size(n: int) -> Column:
            if n == 1:
                return bound
            heads = F.slice(bound, F.lit(1), F.greatest(F.size(bound) - (n - 1), F.lit(0)))
            # Element access, as slice() copies its whole input at every call.
            return F.transform(heads, lambda w, i: F.concat_ws(" ", w, *[F.get(bound, i + k) for k in range(1, n)]))

        return F.concat(*[of_size(n) for n in range(low, high + 1)])

    return let(words, build)


def ngrams_prefix(text: Column, n: int, s: int) -> Column:
    """Sizes ``n`` down to ``s + 1`` over the first ``n`` words; short texts give short slices."""

    def build(words: Column) -> Column:
        starts = [(size, start) for size in range(n, s, -1) for start in range(1, n - size + 2)]
        return F.array(*[F.array_join(F.slice(words, F.lit(start), F.lit(size)), " ") for size, start in starts])

    if n <= s:
        return F.array().cast("array<string>")
    return let(whitespace_words(F.replace(text, F.lit("\n"), F.lit(""))), build)


def normalize_for_scoring(text: Column) -> Column:
    """Lower case with newlines deleted, so words across a line break join up."""
    return F.replace(F.lower(text), F.lit("\n"), F.lit(""))


def sanitize(text: Column) -> Column:
    """Collapse runs of newlines into one."""
    return F.regexp_replace(text, "\n+", "\n")


def remove_literals(text: Column, literals: Sequence[str], keep_newline: bool = False) -> Column:
    """Delete each literal, in order. ``keep_newline``: each one only matches before a newline."""
    for literal in literals:
        text = F.replace(text, F.lit(literal + "\n" if keep_newline else literal), F.lit(""))
    return text


def strip_think(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<think>.*?</think>", "")


def strip_special_tokens(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<\|.*?\|>", "")


def remove_prompt(text: Column, prompt: Column) -> Column:
    """Delete every occurrence of the prompt; an empty prompt changes nothing."""
    return F.replace(text, prompt, F.lit(""))


def _emoji_class(strict: bool) -> str:
    ranges = [r for r in EMOJI_RANGES if not (strict and r == ("24C2", "1F251"))]
    ranges += STRICT_WIDE if strict else []
    return "[" + "".join(rf"\x{{{a}}}-\x{{{b}}}" for a, b in ranges) + "]"


def contains_emoji(text: Column, strict: bool = False) -> Column:
    return F.rlike(text, F.lit(_emoji_class(strict)))


def strip_emoji(text: Column, strict: bool = False) -> Column:
    return F.regexp_replace(text, _emoji_class(strict) + "+", "")


def url_host(url: Column) -> Column:
    """Lower-case host; NULL for a text that is no URL."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def token_count(text: Column, how: str = "whitespace") -> Column:
    """``whitespace`` words, or ``pretoken`` pieces (a lower bound on byte-pair tokens)."""
    if how == "whitespace":
        return F.size(whitespace_words(text))
    if how == "pretoken":
        return F.regexp_count(text, F.lit("(?U)" + PRETOKEN))
    raise ValueError(f"unknown token count {how!r}: use 'whitespace' or 'pretoken'")


def preview(text: Column, length: int = 100) -> Column:
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def code_points(text: Column) -> Column:
    """An empty pattern splits a text at its code points, without a regex."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "", -1))


def char_ngrams(text: Column, n: int) -> Column:
    """Overlapping runs of ``n`` characters, in linear time."""
    return let(
        code_points(text),
        lambda chars: F.transform(
            F.slice(chars, F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(0))),
            lambda _, i: F.concat(*[F.get(chars, i + k) for k in range(n)]),
        ),
    )
