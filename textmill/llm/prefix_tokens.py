"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary (``op7_token_counts``).

A text falls into pre-tokens that are encoded one by one. Inside a pre-token the encoding of every
prefix ends with exactly one token t such that (last token of the shorter prefix, t) is a pair which
merging leaves alone; so one pass over the byte positions stores ``count[i] = count[i - len(t)] + 1``,
the exact token count of every prefix. Counts at pre-token ends are running sums of those tables, and
a prefix that ends inside a pre-token is its running sum plus one look-up: truncation and budget
questions never encode again.

Pre-tokens are cut for a whole slice of texts at once (numpy on code points), hashed, and the table of
each distinct one is built once per task and kept in a cache of bounded size. Nothing is shuffled.

Added tokens of the file ('<|endoftext|>') are one token each wherever they stand in a text, as in the library; what lies
between them is cut as a text of its own, and a prefix that ends inside such a string holds ordinary text there.

Null and empty texts have 0 tokens. Repeated rows give repeated rows. Columns of the input other than
the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import kit

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
KEPT = 1_000_000  # pre-token counts a task keeps at most
# Fixed value: the public pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_names() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: itself if printable, else 256 and up in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Prefix tables of pre-tokens for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        added = content.get("added_tokens") or []
        if odd := [t["content"] for t in added if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]:
            raise ValueError(f"added tokens that look at their surroundings are not supported: {odd}")
        # the first one in the text counts, of several at one place the longest
        strings = sorted((t["content"] for t in added if t["content"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, strings)) or r"(?!)")
        names = byte_names()
        as_bytes = lambda piece: bytes(names[c] for c in piece)
        self.vocabulary = {as_bytes(p) for p in model["vocab"] if all(c in names for c in p)}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        self.reach: dict[bytes, int] = {}  # longest token that ends with these three bytes
        for token in self.vocabulary:
            if len(token) > 2:
                self.reach[token[-3:]] = max(self.reach.get(token[-3:], 3), len(token))
        self.pattern = regex.compile(PATTERN)
        self.fits = lru_cache(1 << 18)(self.pair_stays)
        self.whole = lru_cache(1 << 17)(lambda token: self.merge(token) == [token])

    def merge(self, word: bytes) -> list[bytes]:
        """Encode a short byte string by applying merges in rank order; used on pairs of tokens alone."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.ranks.get(p, 1 << 60))
            if best not in self.ranks:
                break
            joined, i = [], 0
            while i < len(parts):
                if tuple(parts[i : i + 2]) == best:
                    joined.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return parts

    def pair_stays(self, left: bytes, right: bytes) -> bool:
        return self.merge(left + right) == [left, right]

    def extend(self, word: bytes, counts: list[int], last: list[bytes]) -> None:
        """Carry the tables of a prefix of ``word`` on to its end."""
        reach, vocabulary, fits, whole = self.reach, self.vocabulary, self.fits, self.whole
        for end in range(len(counts), len(word) + 1):
            for start in range(max(0, end - reach.get(word[end - 3 : end], 3) if end > 2 else 0), end):
                token = word[start:end]
                if token in vocabulary and whole(token) and (not start or fits(last[start], token)):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break

    def table(self, word: bytes) -> list[int]:
        """count[i] = tokens of the first i bytes of one pre-token."""
        counts: list[int] = [0]
        self.extend(word, counts, [b""])
        return counts

    def totals(self, words: list[bytes]) -> Iterator[int]:
        """Token count of each of the sorted ``words``; neighbours share the tables of their common prefix."""
        before, counts, last = b"", [0], [b""]
        for word in words:
            same = len(commonprefix((before, word)))
            del counts[same + 1 :], last[same + 1 :]
            self.extend(word, counts, last)
            before = word
            yield counts[-1]

    def pretokens(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def added_spans(self, text: str) -> list[tuple[int, int]]:
        """Start and end of every added token in ``text``."""
        return [m.span() for m in self.added.finditer(text)]

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of every prefix of ``text``, by code points (``len(text) + 1`` numbers)."""
        counts, at = [0], 0
        for start, end in self.added_spans(text):
            # a prefix that ends inside the added token is ordinary text since the last one
            part = self.prefix_counts(text[at : end - 1])
            base = counts[-1]
            counts += [base + n for n in part[1:]]
            counts.append(base + part[start - at] + 1)
            at = end
        return counts[:-1] + [counts[-1] + n for n in self.plain_counts(text[at:])]

    def plain_counts(self, text: str) -> list[int]:
        """As ``prefix_counts``, for a text without added tokens."""
        counts, total = [0], 0
        for piece in self.pretokens(text):
            table = self.table(piece.encode())
            base, blank = len(counts) - 1, self.blank_tail(text, len(counts) - 1)
            for n in range(1, len(piece) + 1):
                counts.append(self.cut(text, base, piece, n, total, table, counts, blank))
            total += table[-1]
        return counts

    @staticmethod
    def blank_tail(text: str, end: int) -> int:
        while end and text[end - 1].isspace():
            end -= 1
        return end

    def cut(self, text, base, piece, n, total, table, counts, blank) -> int:
        """Tokens of the prefix ending after ``n`` characters of the pre-token at ``base``."""
        head = piece[:n]
        if head.isspace():  # white space at the end is one pre-token
            return counts[blank] + self.table(text[blank : base + n].encode())[-1]
        if n < len(piece) and piece[0] == "'" and piece in ("'re", "'ve", "'ll", "'s", "'t", "'m", "'d"):
            return total + sum(self.table(p.encode())[-1] for p in self.pretokens(head))
        return total + table[len(head.encode())]


def classes() -> np.ndarray:
    """Class of every code point: 0 other, 1 letter, 2 number, 3 white space (by the pattern's own library)."""
    found = np.zeros(0x110000, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for code, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
        for m in regex.finditer(pattern, points):
            a, b = (x + (0x800 if x >= 0xD800 else 0) for x in m.span())
            found[a:b] = code
    return found


def cut_points(points: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, for texts without an apostrophe.

    Runs of one class are pre-tokens; the last white space before other characters stands alone, and
    joins what follows if it is a plain space.
    """
    n = len(points)
    start = np.ones(n, bool)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start[1:] = (kinds[1:] != kinds[:-1]) | edge[1:-1]
    ahead = np.zeros(n, bool)  # a non-blank follows in the same text
    ahead[:-1] = (kinds[1:] != 3) & ~edge[1:-1]
    lone = (kinds == 3) & ahead
    start |= lone
    joins = np.flatnonzero(lone & (points == 32)) + 1
    start[joins] = False
    return np.flatnonzero(start)


def count_batches(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    counter, kinds_of = PrefixCounter(path), classes()
    values = kit.mix(np.arange(0x110000, dtype=np.uint64) * kit.MULTIPLIER + np.uint64(1))
    known: dict[str, int] = {}
    for batch in batches:
        for part in kit.slices(batch):
            whole = ["" if t is None else t for t in part.column(1).to_pylist()]
            texts, shares, spans = [], [0], {}  # stretches between added tokens, each cut as a text of its own
            for i, text in enumerate(whole):
                at = 0
                if counter.added.search(text):
                    spans[i] = counter.added_spans(text)
                    for a, b in spans[i]:
                        texts.append(text[at:a])
                        at = b
                texts.append(text[at:] if at else text)
                shares.append(len(texts))
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            starts = cut_points(points, kinds_of[points], offsets)
            quoted = [i for i, t in enumerate(texts) if "'" in t]
            if quoted:  # contractions: cut these texts by the pattern itself
                again = np.isin(np.searchsorted(offsets, starts, "right") - 1, quoted)
                own = [np.cumsum([offsets[i], *map(len, counter.pretokens(texts[i])[:-1])]) for i in quoted]
                starts = np.sort(np.concatenate([starts[~again], *own]))
            ends = np.append(starts[1:], len(points))
            _, first, which = np.unique(kit.span_hashes(values[points], starts, ends), return_index=True, return_inverse=True)
            joined = "".join(texts)
            words = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            if len(known) > KEPT:
                known.clear()
            new = sorted({w.encode("utf-8", "surrogatepass") for w in words if w not in known})
            known.update((w.decode("utf-8", "surrogatepass"), n) for w, n in zip(new, counter.totals(new)))
            totals = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            running = np.concatenate([[0], np.cumsum(totals[which])])
            offsets = offsets[shares]
            bounds = np.searchsorted(starts, offsets)
            tokens = running[bounds[1:]] - running[bounds[:-1]] + np.diff(shares) - 1
            fits = []
            for i, text in enumerate(whole):
                if tokens[i] <= limit:
                    fits.append(len(text))
                    continue
                if i in spans:
                    fits.append(longest_mixed(counter, text, limit))
                    continue
                a, b = bounds[i], bounds[i + 1]
                at = int(np.searchsorted(running[a : b + 1], running[a] + limit, "right")) - 1  # whole pre-tokens that fit
                fits.append(longest_fit(counter, text, int(starts[a + at] - offsets[i]), int(running[a + at] - running[a]), limit))
            n_bytes = np.diff(kit.raw(part.column(1))[1])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_bytes), pa.array(tokens), pa.array(tokens > limit), pa.array(fits, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )


def longest_mixed(counter: PrefixCounter, text: str, limit: int) -> int:
    """Characters of the longest prefix within ``limit`` tokens, for a text that may hold added tokens."""
    at = spent = 0
    for start, end in counter.added_spans(text):
        total = spent + 1
        for piece in counter.pretokens(text[at:start]):
            total += counter.table(piece.encode())[-1]
            if total > limit:
                break
        if total > limit:  # ends before this one does; up to there it is ordinary text
            return at + longest_mixed(counter, text[at : end - 1], limit - spent)
        at, spent = end, total
    base = at
    for piece in counter.pretokens(text[at:]):
        total = spent + counter.table(piece.encode())[-1]
        if total > limit:
            used = longest_fit(counter, text[at:], base - at, spent, limit)
            return at + used
        base, spent = base + len(piece), total
    return len(text)


def longest_fit(counter: PrefixCounter, text: str, base: int, spent: int, limit: int) -> int:
    """Characters of the longest prefix within ``limit`` tokens; ``base`` whole pre-tokens end there with ``spent``.

    The pre-token that exceeds the limit is looked up character by character in its table; white space
    before it counts as the pre-token it would be at the end of a text.
    """
    blank = counter.blank_tail(text, base)
    tail = base
    while tail < len(text) and text[tail].isspace():
        tail += 1
    piece = counter.pattern.match(text, base).group()
    table = counter.table(piece.encode("utf-8", "surrogatepass"))
    before = {blank: spent - sum(counter.table(p.encode())[-1] for p in counter.pretokens(text[blank:base]))}
    best = blank
    for n in range(blank + 1, base + 1):
        if before[blank] + counter.table(text[blank:n].encode())[-1] <= limit:
            best = n
    for n in range(1, len(piece) + 1):
        if counter.cut(text, base, piece, n, spent, table, before, blank) <= limit:
            best = base + n
    return best


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, whether they exceed ``limit``, and the characters of the longest prefix within it."""
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(
        lambda batches: count_batches(batches, path, limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long",
    )


def prefix_tables(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id and ``counts``, the token count of every prefix of the text by code points (element 0 is 0)."""

    def rows(batches):
        counter = PrefixCounter(path)
        for batch in batches:
            for part in kit.slices(batch):
                found = [counter.prefix_counts(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "counts"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(rows, "doc_id long, counts array<int>")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(kit.tables(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op7_token_counts": op7_token_counts}
ORACLE_SQL: dict[str, str] = {}
