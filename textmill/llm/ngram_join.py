"""N-gram Jaccard self-join, size-aware, and the components of its links (``op1_ngram_join``).

A document's set holds the hashes of its five-word shingles. Two sets link when ``100 * common >= 75 * union``; then they share
at least ``ceil(0.75 n)`` elements, n the size of either. In one common order of all elements (rare ones first), the
first ``n - ceil(0.75 n) + l`` elements of both share l of them. Heavy-light on that:

* small sets (under a boundary) enumerate all 2-subsets of their l = 2 prefix; two small sets that link have one in common;
* large sets scan inverted lists: each element of their l = 1 prefix. Small sets that are large enough to
  link with a large one are put into the lists too.

The boundary is the size with the least estimated cost (rows of subsets against rows and partners of lists), from
the histogram of sizes and the element counts. The order comes from a count sketch of fixed width over all documents; any order
that all sets share is right, the sketch only makes it a good one.

Equal sets are one node. In each list the smallest node leads; leader and members are verified exactly, and the links join
nodes to components. A list whose nodes now lie in one component is done: pairs inside it add nothing. Of the
others, short lists verify their remaining pairs across components. Long ones that overlap form a canopy, which is
dealt into tiles of bounded size; one task per pair of tiles counts the overlaps of nodes of different
components over the tile's inverted lists and reports spanning links only. So every link counts, and a group of near copies is never
expanded into its pairs. Lists of very frequent elements are split by salts chosen from the sketch.

Null, empty and word-less texts have size 0, no links, and their own id as component. Rows with a null id take no part
and get a null component. Rows with equal ids count as one document; repeated rows repeat in the result. Nodes are 64-bit fingerprints of
sets. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm import kit
from textmill.llm.components import components

WORDS = 5
NUMERATOR, DENOMINATOR = 3, 4  # the threshold
LEAST_SKETCH, MOST_SKETCH = 18, 24  # powers of two of the sketch's width
CHUNK = 1 << 14  # counters of one sketch row
SPLIT = 4096  # members of a list before it is salted
SHORT = 24  # members of a list whose pairs are verified one by one
TILE = 1024  # nodes of a tile
LARGEST_SMALL = 64  # the boundary is sought up to this size
MOST_BITS = 26  # of the filter of needed nodes, a power of two
PLACES = kit.mix(np.arange(1, 65, dtype=np.uint64) * kit.INVERSE)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted inside it, and the bounds of the rows."""
    rows = len(offsets) - 1
    starts, ends, owner = kit.word_spans(data, offsets)
    hashes = kit.word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    counts = np.bincount(owner, minlength=rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = max(0, len(hashes) - words + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(words):
        grams += hashes[k : k + n] * PLACES[k]
    inside = owner[:n] == owner[words - 1 :] if n else np.zeros(0, bool)
    grams, gram_owner = kit.mix(grams[inside]), owner[:n][inside]
    short = np.flatnonzero((counts > 0) & (counts < words))
    whole = np.array([int((hashes[first[r] : first[r + 1]] * PLACES[words : words + counts[r]]).sum(dtype=np.uint64)) for r in short], np.uint64)
    grams = np.concatenate([grams, kit.mix(whole + np.uint64(7))])
    gram_owner = np.concatenate([gram_owner, short])
    order = np.lexsort((grams, gram_owner))
    grams, gram_owner = grams[order], gram_owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (gram_owner[1:] != gram_owner[:-1])
    grams, gram_owner = grams[fresh], gram_owner[fresh]
    return grams, np.searchsorted(gram_owner, np.arange(rows + 1))


def nodes_of(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A fingerprint of each set (0 for an empty one)."""
    sizes = np.diff(bounds)
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(kit.mix(grams + np.uint64(13)), out=total[1:])
    sums = total[bounds[1:]] - total[bounds[:-1]]
    np.cumsum(kit.mix(grams ^ kit.INVERSE), out=total[1:])
    sums ^= kit.mix(total[bounds[1:]] - total[bounds[:-1]] + sizes.astype(np.uint64))
    return np.where(sizes > 0, kit.mix(sums), np.uint64(0)).view(np.int64)


def per_slice(kernel):
    """A mapInArrow function from ``kernel(ids, grams, bounds)`` (a record batch or None) over slices of (doc_id, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kit.slices(batch):
                out = kernel(part.column(0), *shingle_sets(*kit.raw(part.column(1))))
                if out is not None:
                    yield out

    return rows


def first_of_each(grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes, and the rows that are the first with their (not empty) set in this slice."""
    nodes = nodes_of(grams, bounds)
    own = np.unique(nodes, return_index=True)[1]
    return nodes, np.sort(own[np.diff(bounds)[own] > 0])


def measured(ids, grams, bounds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(bounds)), pa.array(nodes_of(grams, bounds))], names=["doc_id", "n", "node"])


def sketch(docs: DataFrame, width: int) -> np.ndarray:
    """Counts of elements over all documents by the low bits of their hash: ``width`` counters, fixed by the caller."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for part in kit.slices(batch):
                grams, bounds = shingle_sets(*kit.raw(part.column(1)))
                total += np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width)
        chunks = total.astype(np.int32).reshape(-1, CHUNK)
        kept = np.flatnonzero(chunks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int32)), pa.array([chunks[i].tobytes() for i in kept], pa.binary())], names=["chunk", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
        capped = [np.minimum(s, 2**31 - 1).astype(np.int32).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(capped, pa.binary())], names=["chunk", "counts"])

    parts = docs.mapInArrow(counted, "chunk int, counts binary").repartition("chunk").mapInArrow(added, "chunk int, counts binary")
    found = np.zeros((width // CHUNK, CHUNK), np.int32)
    for batch in parts.toArrow().to_batches():  # 4 * width bytes
        for chunk, row in zip(batch.column(0).to_pylist(), batch.column(1)):
            found[chunk] = np.frombuffer(row.as_buffer(), np.int32)
    return found.ravel()


def overlap_needed(n):
    """Least overlap of a set of size n with a linked one."""
    return -(-NUMERATOR * n // DENOMINATOR)


def choose_boundary(sizes: dict[int, int], counts: np.ndarray) -> int:
    """The size from which sets scan lists, by least estimated cost.

    A small set costs a row for each 2-subset, a set in the lists a row for each prefix element and the partners it
    meets there: the count at the lower quartile of elements, as prefixes hold the rarest quarter.
    """
    ordered = np.sort(counts[counts > 0]).astype(np.float64)
    partners = float(ordered[np.searchsorted(np.cumsum(ordered), ordered.sum() / 4)] - 1) if len(ordered) else 0.0
    partners = min(partners, 64.0)

    def cost(b: int) -> float:
        light = sum(f * math.comb(n - overlap_needed(n) + 2, 2) for n, f in sizes.items() if 1 < n < b)
        heavy = sum(f * (n - overlap_needed(n) + 1) * (1 + partners) for n, f in sizes.items() if n >= overlap_needed(b))
        return light + heavy

    return min(range(2, LARGEST_SMALL + 1), key=cost)


def signatures(grams: np.ndarray, bounds: np.ndarray, own: np.ndarray, counts: np.ndarray, boundary: int, salt_from: float):
    """Row, signature and number of salts of every prefix element or 2-subset of the rows ``own``."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    use = np.isin(owner, own)
    grams, owner = grams[use], owner[use]
    weight = counts[(grams & np.uint64(len(counts) - 1)).astype(np.int64)]
    order = np.lexsort((grams, weight, owner))
    grams, owner, weight = grams[order], owner[order], weight[order]
    first = np.searchsorted(owner, np.arange(len(sizes)))
    place = np.arange(len(grams)) - first[owner]
    n = sizes[owner]
    spare = n - overlap_needed(n)
    listed = (n >= overlap_needed(boundary)) & (n > 1) & (place < spare + 1)
    rows, keys = [owner[listed]], [grams[listed]]
    salts = [np.maximum(1, np.ceil(weight[listed] / SPLIT)) * (weight[listed] > salt_from) + (weight[listed] <= salt_from)]
    small = (n > 1) & (n < boundary)
    for k in range(1, LARGEST_SMALL):  # pairs of prefix elements k places apart
        left = np.flatnonzero(small & (place + k < spare + 2))
        if not len(left):
            break
        rows.append(owner[left])
        keys.append(kit.mix(grams[left] + grams[left + k] * np.uint64(3)))
        low = np.minimum(weight[left], weight[left + k])
        salts.append(np.maximum(1, np.ceil(low / SPLIT)) * (low > salt_from) + (low <= salt_from))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(salts).astype(np.int64)


def linked(a: int, b: int, common: int) -> bool:
    return common * DENOMINATOR >= NUMERATOR * (a + b - common)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes whose sets link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                keep.append(linked(len(a), len(b), common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("u"), F.col("grams").alias("x"))
    right = sets.select(F.col("node").alias("v"), F.col("grams").alias("y"))
    both = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "x", "y")
    return both.mapInArrow(rows, "u long, v long")


def tile_links(key, frame: pd.DataFrame) -> pd.DataFrame:
    """Spanning links between nodes of different components in a pair of tiles, by scanning the tile's inverted lists."""
    frame = frame.drop_duplicates("node").reset_index(drop=True)
    sets = [np.frombuffer(g, np.uint64) for g in frame["grams"]]
    sizes = np.array([len(s) for s in sets])
    parent = pd.factorize(frame["component"])[0].astype(np.int64)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(len(sets)), sizes)[order]
    ids = np.concatenate([[0], np.cumsum(flat[order][1:] != flat[order][:-1])])
    element = np.empty(len(flat), np.int64)
    element[order] = ids
    heads = np.searchsorted(ids, np.arange(ids[-1] + 2))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    common_first = np.argmax(np.bincount(parent))
    out = []
    for y in np.flatnonzero(parent != common_first):
        own = element[bounds[y] : bounds[y + 1]]
        lengths = heads[own + 1] - heads[own]
        at = np.repeat(heads[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        common = np.bincount(owner[at], minlength=len(sets))
        hit = np.flatnonzero((common * DENOMINATOR >= NUMERATOR * (sizes + sizes[y] - common)) & (parent != parent[y]))
        while len(hit):
            x = hit[0]
            out.append((int(frame["node"][y]), int(frame["node"][x])))
            parent[parent == parent[x]] = parent[y]
            hit = hit[parent[hit] != parent[y]]
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def node_filter(nodes: DataFrame, bits: int) -> np.ndarray:
    """A bit table of ``2**bits`` bits, one set for each node."""
    word = F.expr(f"cast((node & {(1 << bits) - 1}) >> 5 as int)").alias("word")
    word = nodes.groupBy(word).agg(F.expr("bit_or(shiftleft(1L, cast(node & 31 as int)))").alias("mask"))
    table = np.zeros(1 << (bits - 5), np.uint32)
    found = word.toArrow()  # at most a row of 12 bytes for each word
    table[found["word"].to_numpy()] = found["mask"].to_numpy() & 0xFFFFFFFF
    return table


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).unionAll(pairs.select("v")).distinct()


def sets_of(docs: DataFrame, nodes: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, grams) of the given distinct nodes. A broadcast bit table of bounded size spares most other sets the shuffle."""
    nodes = kit.written(nodes, folder, name)
    count = nodes.count()
    bits = min(MOST_BITS, max(16, (16 * count).bit_length()))
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(node_filter(nodes, bits))

    def kernel(ids, grams, bounds):
        found, own = first_of_each(grams, bounds)
        low = found[own] & ((1 << bits) - 1)
        own = own[(sent.value[low >> 5] >> (low & 31).astype(np.uint32)) & 1 == 1]
        packed = [grams[bounds[r] : bounds[r + 1]].tobytes() for r in own]
        return pa.RecordBatch.from_arrays([pa.array(found[own]), pa.array(packed, pa.binary())], names=["node", "grams"])

    return docs.mapInArrow(per_slice(kernel), "node long, grams binary").join(nodes, "node", "left_semi").dropDuplicates(["node"])


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder = kit.scratch(spark)
    measures = kit.written(docs.mapInArrow(per_slice(measured), "doc_id long, n long, node long"), folder, "measures")
    total = measures.agg(F.sum("n")).first()[0] or 0
    sizes = {r["n"]: r["count"] for r in measures.where(F.col("n") <= 2 * LARGEST_SMALL).groupBy("n").count().collect()}
    width = 1 << min(MOST_SKETCH, max(LEAST_SKETCH, (total // 64).bit_length()))
    counts = sketch(docs, width)
    boundary = choose_boundary(sizes, counts)
    salt_from = SPLIT + 4 * total / width
    sent = spark.sparkContext.broadcast(counts)

    def signed(ids, grams, bounds):
        nodes, own = first_of_each(grams, bounds)
        rows, keys, salts = signatures(grams, bounds, own, sent.value, boundary, salt_from)
        salt = (nodes[rows].view(np.uint64) >> np.uint64(20)) % salts.astype(np.uint64)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(salts > 1), pa.array(nodes[rows]), pa.array(np.diff(bounds)[rows].astype(np.int32))],
            names=["sig", "salt", "salted", "node", "n"],
        )

    signs = docs.mapInArrow(per_slice(signed), "sig long, salt int, salted boolean, node long, n int").repartition("sig", "salt")
    within = Window.partitionBy("sig", "salt")
    lists = signs.dropDuplicates(["sig", "salt", "node"]).withColumn("lead", F.min(F.struct("node", "n")).over(within)).withColumn("members", F.count(F.lit(1)).over(within))
    lists = lists.where((F.col("members") > 1) | F.col("salted")).select("sig", "salted", "node", "n", "lead")
    lists = kit.written(lists, folder, "lists")
    # leaders of a salted list meet under the smallest of them
    salted = lists.where("salted").select("sig", "lead").distinct()
    over = salted.join(salted.groupBy("sig").agg(F.min("lead").alias("top")), "sig").select(F.col("top").alias("a"), F.col("lead").alias("b"))
    stars = lists.select(F.col("lead").alias("a"), F.struct("node", "n").alias("b")).unionAll(over)
    stars = stars.select(F.col("a.node").alias("u"), F.col("b.node").alias("v"), F.col("a.n").alias("nu"), F.col("b.n").alias("nv"))
    near = F.least("nu", "nv") * DENOMINATOR >= F.greatest("nu", "nv") * NUMERATOR
    stars = kit.written(stars.where((F.col("u") != F.col("v")) & near).select("u", "v").distinct(), folder, "stars")
    sets = kit.written(sets_of(docs, ends_of(stars), folder, "sets-nodes"), folder, "sets")
    parts = kit.written(components(kit.written(verified(stars, sets), folder, "links"), folder, "parts"), folder, "parts")

    # lists whose nodes lie in several components
    placed = lists.select("sig", "node", "n").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("sig").agg(F.count(F.lit(1)).alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where((F.col("low") != F.col("high")) & (F.col("members") > 2)).select("sig", "members")
    placed = kit.written(placed.join(mixed, "sig"), folder, "placed")
    short, long = placed.where(F.col("members") <= SHORT), placed.where(F.col("members") > SHORT)
    a = short.select("sig", F.col("node").alias("u"), F.col("component").alias("cu"), F.col("n").alias("nu"))
    b = short.select("sig", F.col("node").alias("v"), F.col("component").alias("cv"), F.col("n").alias("nv"))
    across = a.join(b, "sig").where((F.col("u") < F.col("v")) & (F.col("cu") != F.col("cv")) & near).select("u", "v").distinct()
    across = kit.written(across.join(stars, ["u", "v"], "left_anti"), folder, "across")
    late = ends_of(across).unionAll(long.select("node")).distinct()
    more_sets = kit.written(sets_of(docs, late, folder, "more-nodes"), folder, "more-sets")
    more = verified(across, more_sets)
    if not long.isEmpty():
        heads = long.groupBy("sig").agg(F.min("node").alias("head"))
        canopy_edges = long.join(heads, "sig").where(F.col("node") != F.col("head")).select(F.col("node").alias("u"), F.col("head").alias("v")).distinct()
        canopies = components(canopy_edges, folder, "canopies").withColumnRenamed("component", "canopy")
        members = long.select("node", "component").distinct().join(canopies, "node")
        tiles = members.groupBy("canopy").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
        dealt = members.join(tiles, "canopy").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        dealt = dealt.select("*", other.alias("other")).select(
            "canopy", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "node", "component"
        )
        found = dealt.join(more_sets, "node").groupBy("canopy", "a", "b").applyInPandas(tile_links, "u long, v long")
        more = more.unionAll(found)
    more = kit.written(more, folder, "more")
    label = parts.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    joined = more.join(label, "u", "left").join(parts.select(F.col("node").alias("v"), F.col("component").alias("cv")), "v", "left")
    joined = joined.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    upper = components(joined, folder, "upper").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    final = parts.join(upper, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    single = upper.join(parts, "component", "left_anti").select(F.col("component").alias("node"), F.col("whole").alias("component"))
    final = kit.written(final.unionAll(single), folder, "final")

    # the smallest id of each set, then of each component
    ids = measures.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    ids = ids.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = ids.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = kit.written(ids.join(least, "component").select("node", "component_id"), folder, "by-node")
    kit.keep_only(spark, folder, ("measures", "by-node"))
    return measures.join(by_node, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(kit.tables(spark, sf_dir, "documents"))


ORACLE = r"""
with words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as s from words),
sized as (select doc_id, len(s) as n, s from sets),
nodes as (select list_sort(s) as s, n, min(doc_id) as node from sized where n > 0 group by all),
elements as (select node, n, unnest(s) as e from nodes),
pairs as (select a.node as u, b.node as v from elements a join elements b on a.e = b.e and a.node < b.node
    and 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (with recursive r(node, seen) as (
    select u, u from (select u from pairs union select v from pairs)
    union
    select x.node, r.seen from r join (select u, v as node from pairs union all select v, u from pairs) x on x.u = r.node)
  select node, min(seen) as component_id from r group by node)
select z.doc_id, cast(z.n as bigint) as n_shingles, case when z.n > 0 then coalesce(reach.component_id, nodes.node) else z.doc_id end as component_id
from sized z left join nodes on nodes.n = z.n and nodes.s = list_sort(z.s) left join reach on reach.node = nodes.node
"""

QUERIES = {"op1_ngram_join": op1_ngram_join}
ORACLE_SQL = {"op1_ngram_join": ORACLE}
