"""Is a file text? Tests on its first bytes and on its name."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 1024
NUL_BLOCK = 512
NONTEXT_SHARE = 0.30


def _head(content: Column, size: int) -> Column:
    return F.substring(content, 1, size)


def is_text_decode(content: Column, size: int = BLOCK) -> Column:
    """The first bytes are valid UTF-8; a character cut at the edge is not."""
    return F.is_valid_utf8(_head(content, size).cast("string"))


def is_text_nul(content: Column, size: int = NUL_BLOCK) -> Column:
    """No NUL byte and valid UTF-8; unreadable content is no text."""
    head = _head(content, size)
    return F.coalesce(
        ~F.contains(head, F.lit(bytearray(b"\x00"))) & F.is_valid_utf8(head.cast("string")), F.lit(False)
    )


def is_text_control(content: Column, size: int = BLOCK) -> Column:
    """Under 30 % of the bytes lie outside printable ASCII; empty content passes."""
    chars = F.decode(_head(content, size), "ISO-8859-1")  # one character per byte
    other = F.length(F.regexp_replace(chars, r"[\t\n\x0B\f\r\x20-\x7E]", ""))
    return F.when(F.length(chars) == 0, True).otherwise(other / F.length(chars) < NONTEXT_SHARE)


def is_text_mime(name: Column) -> Column:
    """The file name's type starts with ``text/`` (the standard table; one encoding suffix is skipped)."""
    known = mimetypes.MimeTypes(filenames=())
    text_suffixes = sorted(s.lstrip(".") for s, kind in known.types_map[True].items() if kind.startswith("text/"))
    encodings = "|".join(sorted(s.lstrip(".") for s in known.encodings_map))
    base = F.regexp_replace(F.regexp_extract(name, r"([^/\\]*)$", 1), rf"(?<=.)\.(?:{encodings})$", "")
    return F.lower(F.regexp_extract(base, r"[^.].*\.([^.]+)$", 1)).isin(text_suffixes)


def text_votes(content: Column, name: Column) -> dict[str, Column]:
    return {
        "decode": is_text_decode(content),
        "control": is_text_control(content),
        "mime": is_text_mime(name),
    }


def is_text_combined(content: Column, name: Column) -> Column:
    """A strict majority of the three tests."""
    votes = text_votes(content, name).values()
    return sum((v.cast("int") for v in votes), F.lit(0)) > len(votes) // 2


def text_test(method: str, content: Column, name: Column) -> Column:
    tests = {**text_votes(content, name), "nul": is_text_nul(content), "combined": is_text_combined(content, name)}
    if method not in tests:
        raise ValueError(f"unknown method {method!r}: use one of {sorted(tests)}")
    return tests[method]
