"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding (``op2_pieces``).

Every way to cut a text into vocabulary pieces is a path through its piece lattice. Forward filtering
sums, left to right, the weight of all paths to each position; backward sampling then draws one path from
its exact probability, right to left. Draws come from a hash of (seed, row key, position), so a row gets
the same segmentation on every run, in every partitioning. ``sample=False`` takes the best path instead.

The vocabulary files hold merge ranks, no probabilities: a piece of rank r weighs ``-log(r + RANK_SHIFT)``,
times ``alpha`` (smaller is flatter). A space is written as U+2581. A character without piece, and a literal
U+2581, is written as its UTF-8 bytes' pieces, so decoding always gives the text back; no dummy space is
put before the text. Pieces hold space signs at their start alone (one before other characters, or a run of them with nothing
after it), so the lattice falls apart before each run of spaces (and around characters that stand in no longer piece): units are
filtered once per distinct unit of a slice of texts, all units of one length at a time, and sampled per occurrence. With a file
that has a piece with a space sign after another character, texts are not cut at spaces.

Nothing is shuffled. A long unit is filtered whole (its lattice takes about 130 bytes a character), its chances do not depend on its length. Null and empty texts have no pieces. A null key counts as key 0; rows that repeat in
key and text get equal segmentations; of equally good paths ``sample=False`` takes the one with the shorter last piece. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import kit

VOCABULARY = "piece_bpe_32k.model"
ALPHA = 1.0
SEED = 11
RANK_SHIFT = 8.0
UNKNOWN = -18.0  # weight of a character written as bytes
SPACE, LITERAL = 0x2581, 0x110000  # the space sign; the number that stands for a literal one
SLOT_MASK = np.uint64((1 << 20) - 1)
VALUES = kit.mix(np.arange(0x110001, dtype=np.uint64) * kit.MULTIPLIER + np.uint64(3))


class Vocabulary:
    """Pieces of one model file, with look-up by hash."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_ids = np.full(256, -1, np.int32)
        self.ids: dict[str, int] = {}
        self.weight = np.full(size, UNKNOWN)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes.append(bytes([value]))
                continue
            self.bytes.append(piece.replace("▁", " ").encode())
            usual = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            if usual:
                self.ids[piece] = i
                self.weight[i] = -np.log(-model.get_score(i) + RANK_SHIFT)
        self.longest = max(map(len, self.ids))
        self.cut_at_spaces = not any("▁" in p.lstrip("▁") for p in self.ids)
        points = [np.frombuffer(p.encode("utf-32-le"), np.uint32) for p in self.ids]
        cuts = np.concatenate([[0], np.cumsum([len(p) for p in points])])
        hashes = kit.span_hashes(VALUES[np.concatenate(points)], cuts[:-1], cuts[1:])
        order = np.argsort(hashes)
        # two entries more that no piece has: an empty slot, and a slot that several pieces share
        self.hashes = np.append(hashes[order], np.zeros(2, np.uint64))
        self.found = np.append(np.fromiter(self.ids.values(), np.int32)[order], np.full(2, -1, np.int32))
        self.crowded = len(order) + 1
        slot = (self.hashes[:-2] & SLOT_MASK).astype(np.int64)
        self.slots = np.full(int(SLOT_MASK) + 1, len(order), np.int32)
        self.slots[slot] = np.arange(len(order))
        _, back, times = np.unique(slot, return_inverse=True, return_counts=True)
        self.slots[slot[times[back] > 1]] = self.crowded
        self.alone = np.ones(0x110001, bool)  # characters that no longer piece holds
        self.alone[np.concatenate([p for p in points if len(p) > 1])] = False

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number of each hash, or -1."""
        at = self.slots[(hashes & SLOT_MASK).astype(np.int64)]
        found = np.where(self.hashes[at] == hashes, self.found[at], -1)
        shared = np.flatnonzero(at == self.crowded)
        if len(shared):
            at = np.minimum(np.searchsorted(self.hashes[:-2], hashes[shared]), len(self.hashes) - 3)
            found[shared] = np.where(self.hashes[at] == hashes[shared], self.found[at], -1)
        return found

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "surrogatepass")


def uniform(seed: int, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    x = kit.mix(kit.mix(keys.astype(np.uint64) + np.uint64(seed * int(kit.MULTIPLIER) % (1 << 64))) ^ (places.astype(np.uint64) * kit.INVERSE))
    return (x >> np.uint64(11)) / float(1 << 53)


def lattice(vocab: Vocabulary, symbols: np.ndarray, alpha: float, sample: bool) -> tuple[np.ndarray, np.ndarray]:
    """For units of one length (rows of ``symbols``): piece numbers and the running chance of each last piece.

    ``ids[u, j, l]`` is the piece of length l+1 that ends at position j+1; ``chance[u, j, l]`` the probability that the
    piece ending there has at most that length.
    """
    n, size = symbols.shape
    span = min(size, vocab.longest)
    ids = np.full((n, size, span), -1, np.int32)
    score = np.full((n, size, span), -np.inf, np.float32)
    up, down = kit.powers(size + 1)
    sums = np.zeros((n, size + 1), np.uint64)
    np.cumsum(symbols * up[:size], axis=1, out=sums[:, 1:])
    weight = np.append(alpha * vocab.weight, -np.inf).astype(np.float32)  # the last one serves -1
    for width in range(1, span + 1):
        hashes = kit.mix((sums[:, width:] - sums[:, :-width]) * down[: size + 1 - width] + np.uint64(width))
        ids[:, width - 1 :, width - 1] = vocab.look_up(hashes.ravel()).reshape(hashes.shape)
    score = weight[ids]
    score[:, :, 0] = np.where(ids[:, :, 0] >= 0, score[:, :, 0], alpha * UNKNOWN)
    total = np.zeros((n, size + 1))  # in double precision, and only differences between near places are used
    for j in range(size):
        width = min(span, j + 1)
        near = score[:, j, :width] + (total[:, j - np.arange(width)] - total[:, j, None])
        most = near.max(1)
        if sample:
            share = np.exp(near - most[:, None])
            whole = share.sum(1)
            score[:, j, :width] = share / whole[:, None]
            most = most + np.log(whole)
        else:
            score[:, j, :width] = near - most[:, None]
        total[:, j + 1] = total[:, j] + most
    if sample:
        possible = ids >= 0
        possible[:, :, 0] = True
        chance = np.cumsum(np.where(possible, score, 0), axis=2, dtype=np.float32)
        last = span - 1 - possible[:, :, ::-1].argmax(2)  # the longest piece there: rounding leads no further
        chance[np.arange(span) >= last[:, :, None]] = 2
    else:
        chance = (np.arange(span) >= score.argmax(2)[:, :, None]).astype(np.float32)
    return ids, chance


def encode_slice(vocab: Vocabulary, texts: list[str], keys: np.ndarray, alpha: float, seed: int, sample: bool) -> tuple[np.ndarray, np.ndarray]:
    """Piece numbers of all texts in a row, and the bounds of each text's share."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if not len(points):
        return np.zeros(0, np.int32), offsets
    blank = points == 32
    shown = np.where(points == SPACE, LITERAL, np.where(blank, SPACE, points))
    alone = vocab.alone[shown]
    start = alone.copy()
    start[1:] |= alone[:-1]
    if vocab.cut_at_spaces:  # at the first space of a run
        start[1:] |= blank[1:] & ~blank[:-1]
    start[offsets[:-1][offsets[:-1] < len(points)]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(points))
    symbols = VALUES[shown]
    owner = np.searchsorted(offsets, starts, "right") - 1
    _, first, unit_of = np.unique(kit.span_hashes(symbols, starts, ends), return_index=True, return_inverse=True)
    lengths = (ends - starts)[first]
    chosen = np.full(len(points), -1, np.int64)  # piece number + 1 at each place where a piece starts; 0: bytes
    order = np.argsort(unit_of, kind="stable")  # occurrences by unit
    bounds = np.searchsorted(unit_of[order], np.arange(len(first) + 1))
    for size in np.unique(lengths):
        units = np.flatnonzero(lengths == size)
        step = max(1, (1 << 19) // (int(size) * min(int(size), vocab.longest)))
        for begin in range(0, len(units), step):
            some = units[begin : begin + step]
            at = starts[first[some]]
            ids, chance = lattice(vocab, symbols[at[:, None] + np.arange(size)], alpha, sample)
            counts = bounds[some + 1] - bounds[some]
            local = np.repeat(np.arange(len(some)), counts)
            run = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            places = order[np.repeat(bounds[some], counts) + run]
            head = starts[places]
            inside = head - offsets[owner[places]]
            own_keys = keys[owner[places]]
            position = np.full(len(places), int(size))
            while len(places):
                draw = uniform(seed, own_keys, inside + position) if sample else np.full(len(places), 0.5)
                rows = chance[local, position - 1]
                width = np.minimum((rows <= draw[:, None]).sum(1) + 1, np.minimum(position, rows.shape[1]))
                piece = ids[local, position - 1, width - 1]
                position = position - width
                chosen[head + position] = piece + 1
                left = position > 0
                if not left.all():
                    places, local, head, inside, own_keys, position = (x[left] for x in (places, local, head, inside, own_keys, position))
    taken = np.flatnonzero(chosen >= 0)
    picked = chosen[taken] - 1
    counts = np.ones(len(taken), np.int64)
    odd = np.flatnonzero(picked < 0)
    fill = [vocab.byte_ids[np.frombuffer(chr(points[taken[i]]).encode("utf-8", "surrogatepass"), np.uint8)] for i in odd]
    counts[odd] = [len(f) for f in fill]
    out = np.repeat(picked, counts).astype(np.int32)
    if len(odd):
        where = np.cumsum(counts)[odd] - counts[odd]
        spread = np.repeat(where - np.concatenate([[0], np.cumsum(counts[odd])[:-1]]), counts[odd]) + np.arange(counts[odd].sum())
        out[spread] = np.concatenate(fill)
    ends_at = np.concatenate([[0], np.cumsum(counts)])
    return out, ends_at[np.searchsorted(taken, offsets)]


def encode(
    docs: DataFrame, path: str, alpha: float = ALPHA, seed: int = SEED, sample: bool = True, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, number of pieces, the pieces, and whether decoding them gives the text back."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(path)
        for batch in batches:
            for part in kit.slices(batch):
                texts = ["" if t is None else t for t in part.column(1).to_pylist()]
                keys = part.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids, bounds = encode_slice(vocab, texts, keys, alpha, seed, sample)
                listed = ids.tolist()
                same = [vocab.decode(listed[a:b]) == t for a, b, t in zip(bounds[:-1], bounds[1:], texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "pieces", "lossless"],
                )

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(rows, "doc_id long, n_pieces long, pieces array<int>, lossless boolean")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ``pieces``; null pieces give null."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(path)
        for batch in batches:
            texts = [None if p is None else vocab.decode(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "pieces").mapInArrow(rows, "doc_id long, text string")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(kit.tables(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op2_pieces": op2_pieces}
ORACLE_SQL: dict[str, str] = {}
