"""Divergence between the sources of each language, priced on hash-consed count trees (``op13_source_audit``).

A language keeps the terms that stand in at least ``LEAST_DOCS`` of its documents. Every (language, source) group and
every language gives each kept term a smoothed share in billionths, ``p = 1 + (SCALE * (count + PSEUDO)) div (N + PSEUDO * V)``.
Two groups diverge by the sum of ``abs(p - q)`` over all kept terms (part ``pair``); a group's over-used terms are those with
``p > q`` against its language (part ``term``, the first ``TERMS``).

Terms are counted in their tasks (exact byte strings, A-Z lower-cased), so texts never move. The kept terms of a language are
dealt by hash over blocks of about ``BLOCK`` terms; inside a block term ids run from the commonest to the rarest term, so that
rare terms stand together. A task holds one block of at most two tiles of ``TILE`` or so sources and builds a segment tree over the
term ids for each of them: equal leaves (counts) and equal inner nodes (pairs of children) get one number for all trees of
the task. A simultaneous walk down two trees keeps the distinct pairs of nodes of each level with the number of places
where they stand, so equal pairs are expanded and priced once. Block sums are added up. Counts and divisors use whole numbers alone.

Null text, lang and source count as ''. A group without terms has count 0 for all kept terms; a language without kept terms
gives pairs of value 0 and no term rows. Repeated rows count as often as they stand, ids play no part. Ties rank by the item's
UTF-8 bytes. Very long texts are handled whole (a task holds a slice of texts, one text at least). An empty table gives an empty
result. Only named columns are read, so further columns cannot clash.

Work of part ``pair`` grows with the square of the sources of one language, as its result does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm import kit
from textmill.plans import bounded_broadcast, hot_values, salted_join

LEAST_DOCS = 30
SCALE = 1_000_000_000
PSEUDO = 5
TERMS = 50
BLOCK = 2048  # terms of a block, about
TILE = 32  # sources of a tile, about
COUNT_BYTES = 8 << 20  # text bytes counted at once

SEPARATOR = np.ones(256, bool)  # of terms: ASCII but for letters
SEPARATOR[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def codes_of(column: pa.DictionaryArray) -> np.ndarray:
    return column.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def count_slice(part: pa.RecordBatch) -> pa.RecordBatch:
    """``(lang, source, term, n, docs)`` of a batch (text, lang, source): occurrences, and rows holding the term."""
    data, offsets = kit.raw(part.column(0))
    solid = ~SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    places = np.cumsum(solid) - 1  # of each term byte once separators are gone
    ends = np.append(places[starts], int(solid.sum())) if len(starts) else np.zeros(1, np.int64)
    letters = pa.py_buffer(np.ascontiguousarray(kit.LOWER[data[solid]]))
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), letters).dictionary_encode()
    rows = np.searchsorted(offsets, starts, "right") - 1
    kinds = max(1, len(terms.dictionary))
    held, times = np.unique(rows * kinds + codes_of(terms), return_counts=True)  # a text and a term
    lang, source = (part.column(i).dictionary_encode() for i in (1, 2))
    places = len(source.dictionary)
    owner = (codes_of(lang) * places + codes_of(source))[held // kinds]
    key, back = np.unique(owner * kinds + held % kinds, return_inverse=True)
    n, docs, owner = np.bincount(back, times, len(key)), np.bincount(back, minlength=len(key)), key // kinds
    names = lang.dictionary.take(pa.array(owner // places)), source.dictionary.take(pa.array(owner % places)), terms.dictionary.take(pa.array(key % kinds))
    return pa.RecordBatch.from_arrays(
        [*[x.cast(pa.string()) for x in names], *[pa.array(x.astype(np.int64)) for x in (n, docs)]], names=["lang", "source", "term", "n", "docs"]
    )


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in kit.slices(batch, limit=COUNT_BYTES):
            yield count_slice(part)


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` over all texts."""
    found = docs.select(text_of("text"), text_of("lang"), text_of("source")).mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + (SCALE * (counts + PSEUDO)) div total`` without overflow, for counts up to total < 9 * 10^15: long division in thousands."""
    rest, found = counts + PSEUDO, np.zeros(np.broadcast(counts, total).shape, np.int64)
    found, rest = rest // total, rest % total
    for _ in range(3):  # SCALE is 1000 ** 3
        rest = rest * 1000
        found = found * 1000 + rest // total
        rest = rest % total
    return found + 1


def consed(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Segment trees over the columns of ``counts`` (trees x 2^k), equal nodes numbered once.

    Returns the leaf values by node number, for each level upwards the (left, right) children by node number, and the roots.
    """
    leaves, nodes = np.unique(counts, return_inverse=True)
    nodes = nodes.reshape(counts.shape)
    levels, width = [], len(leaves)
    while nodes.shape[1] > 1:
        pairs, numbers = np.unique(nodes[:, 0::2] * np.int64(width) + nodes[:, 1::2], return_inverse=True)
        nodes = numbers.reshape(nodes.shape[0], -1)
        levels.append((pairs // width, pairs % width))
        width = len(pairs)
    return leaves, levels, nodes[:, 0]


def divergences(counts: np.ndarray, size: int, totals: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sum of ``abs(p - q)`` over the first ``size`` term ids for each pair of rows (left[i], right[i]) of ``counts``."""
    leaves, levels, roots = consed(counts)
    # distinct (pair of trees, node, node) of one level and the number of places where they stand together
    pair, a, b, times = np.arange(len(left)), roots[left], roots[right], np.ones(len(left), np.int64)
    for children in reversed(levels):
        a = np.concatenate([side[a] for side in children])
        b = np.concatenate([side[b] for side in children])
        width = max(int(a.max()), int(b.max())) + 1
        key, back = np.unique((np.tile(pair, 2) * np.int64(width) + a) * width + b, return_inverse=True)
        times = np.bincount(back, np.tile(times, 2), len(key)).astype(np.int64)  # at most the leaves of a block: exact
        pair, a, b = key // width // width, key // width % width, key % width
    price = np.abs(shares(leaves[a], totals[left[pair]]) - shares(leaves[b], totals[right[pair]]))
    # leaves beyond the terms of the block are 0 in all trees; take them off again
    found = np.zeros(len(left), np.int64)
    np.add.at(found, pair, price * times)
    spare = counts.shape[1] - size
    if spare:
        zero = np.zeros(1, np.int64)
        found -= spare * np.abs(shares(zero, totals[left]) - shares(zero, totals[right]))
    return found


def price_block(frame: pd.DataFrame) -> pd.DataFrame:
    """``(lang, source, item, value)``, source < item: the block's share of every pair of its two tiles' sources."""
    heads = frame[frame["place"] < 0].sort_values("source")
    names, tiles, totals = heads["source"].to_numpy(), heads["tile"].to_numpy(), heads["total"].to_numpy(np.int64)
    size = int(heads["size"].iloc[0])
    rows = frame[frame["place"] >= 0]
    counts = np.zeros((len(names), 1 << max(0, size - 1).bit_length()), np.int64)
    counts[pd.Index(names).get_indexer(rows["source"]), rows["place"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    one, two = int(heads["one"].iloc[0]), int(heads["two"].iloc[0])
    own, other = np.flatnonzero(tiles == one), np.flatnonzero(tiles == two)
    left, right = (x.ravel() for x in np.meshgrid(own, other, indexing="ij"))
    if one == two:
        left, right = left[left < right], right[left < right]
    first, second = np.where(names[left] < names[right], left, right), np.where(names[left] < names[right], right, left)
    value = divergences(counts, size, totals, left, right) if len(left) else np.zeros(0, np.int64)
    lang = heads["lang"].iloc[0]
    plain = lambda x: pd.Series(x, dtype=object)  # noqa: E731 - empty text columns too
    return pd.DataFrame({"lang": plain([lang] * len(left)), "source": plain(names[first]), "item": plain(names[second]), "value": value})


def share(n, total):
    return (1 + F.expr(f"cast({SCALE} as decimal(10, 0)) * cast({n} + {PSEUDO} as decimal(18, 0)) div cast({total} as decimal(20, 0))")).cast("long")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: all pairs of sources of each language, and each group's over-used terms."""
    spark = docs.sparkSession
    folder = kit.scratch(spark)
    groups = docs.select(text_of("lang"), text_of("source")).distinct()
    counts = kit.written(term_counts(docs), folder, "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
    kept = kit.written(kept, folder, "kept")
    vocab = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("of_lang").alias("lang_n"))
    rows = kit.written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "of_lang"), folder, "rows")
    sums = rows.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    many = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    none = F.lit(0).cast("long")
    groups = groups.join(sums, ["lang", "source"], "left").join(many, "lang").join(vocab, "lang", "left").select(
        "lang", "source", "sources", F.coalesce("terms", none).alias("terms"),
        F.coalesce(F.coalesce("own_n", none) + PSEUDO * F.col("terms"), none).alias("total"), F.coalesce(F.col("lang_n") + PSEUDO * F.col("terms"), none).alias("lang_total"),
    )
    groups = kit.written(groups, folder, "groups")

    # part term: the first `top` of each group
    own, hot = ["lang", "source"], hot_values(rows, ["lang", "source"])
    used = salted_join(rows, groups.select("lang", "source", "total", "lang_total"), own, hot, F.col("term"))
    excess = used.withColumn("value", share("n", "total") - share("of_lang", "lang_total")).where("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    terms = excess.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    # part pair: blocks of term ids, tiles of sources
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)).cast("long")
    tiles = F.ceil(F.col("sources") / TILE).cast("long")
    spot = Window.partitionBy("lang", "block").orderBy(F.desc("of_lang"), "term")
    sizes_of, fits = bounded_broadcast(kit.written(vocab.select("lang", "terms"), folder, "vocab"))
    placed = kept.join(sizes_of, "lang") if fits else salted_join(kept, sizes_of, ["lang"], hot_values(kept, ["lang"]), F.col("term"))
    placed = placed.select("lang", "term", "of_lang", F.pmod(F.xxhash64("term"), blocks).alias("block")).repartition("lang", "block")
    placed = kit.written(placed.select("lang", "term", "block", (F.row_number().over(spot) - 1).alias("place")), folder, "places")
    sizes = placed.groupBy("lang", "block").agg(F.count("*").alias("size"))
    members = groups.where("terms > 0 and sources > 1").select("lang", "source", "total", tiles.alias("tiles"), F.pmod(F.xxhash64("source", F.lit(1)), tiles).alias("tile"))
    hot_lang = hot_values(groups, ["lang"])
    heads = salted_join(members, sizes, ["lang"], hot_lang, F.col("source")).select("lang", "source", "tile", "tiles", "total", "block", "size", F.lit(-1).alias("place"), none.alias("n"))
    cells = rows.select("lang", "source", "term", "n").join(placed, ["lang", "term"])
    cells = salted_join(cells, members.select("lang", "source", "tile", "tiles"), own, hot, F.col("term"))
    cells = cells.select("lang", "source", "tile", "tiles", none.alias("total"), "block", none.alias("size"), "place", "n")
    others = F.sequence(none, F.col("tiles") - 1)  # every pair of tiles meets once
    cell = F.transform(others, lambda t: F.struct(F.least(t, F.col("tile")).alias("one"), F.greatest(t, F.col("tile")).alias("two")))
    dealt = heads.unionByName(cells).select("lang", "source", "tile", "total", "block", "size", "place", "n", F.explode(cell).alias("cell"))
    dealt = dealt.select("*", "cell.one", "cell.two").drop("cell")
    priced = dealt.groupBy("lang", "block", "one", "two").applyInPandas(price_block, "lang string, source string, item string, value long")
    sums = kit.written(priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), folder, "pairs")
    kit.keep_only(spark, folder, ("rows", "groups", "pairs"))
    every = salted_join(groups.select("lang", "source"), groups.select("lang", F.col("source").alias("item")), ["lang"], hot_lang, F.col("source")).where(F.col("source") != F.col("item"))  # as many as the result has
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = every.join(both, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    nearest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(nearest)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(kit.tables(spark, sf_dir, "documents").select("text", "lang", "source"))


SQL = rf"""
with docs as (select row_number() over () as row, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
words as (select row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
counts as (select lang, source, term, count(*)::hugeint as n, count(distinct row) as docs from words group by all),
kept as materialized (select lang, term, sum(n)::hugeint as n from counts group by all having sum(docs) >= {LEAST_DOCS}),
vocab as (select lang, count(*)::hugeint as v, sum(n)::hugeint as n from kept group by lang),
own as materialized (select c.lang, c.source, c.term, c.n from counts c join kept using (lang, term)),
grps as materialized (select g.lang, g.source, coalesce(s.n, 0) + {PSEUDO} * coalesce(v.v, 0) as total, coalesce(v.n, 0) + {PSEUDO} * coalesce(v.v, 0) as lang_total
    from (select distinct lang, source from docs) g left join (select lang, source, sum(n)::hugeint as n from own group by all) s using (lang, source) left join vocab v using (lang)),
dense as materialized (select g.lang, g.source, k.term, 1 + ({SCALE}::hugeint * (coalesce(o.n, 0) + {PSEUDO})) // g.total as p, 1 + ({SCALE}::hugeint * (k.n + {PSEUDO})) // g.lang_total as q, coalesce(o.n, 0) as n
    from grps g join kept k using (lang) left join own o on o.lang = g.lang and o.source = g.source and o.term = k.term),
pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0)::bigint as value
    from grps a join grps b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
    union all select lang, source, 'term', term, (p - q)::bigint from dense where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from every)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {TERMS}"""

QUERIES = {"op13_source_audit": op13_source_audit}
ORACLE_SQL = {"op13_source_audit": SQL}
