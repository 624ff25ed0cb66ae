"""Secret scan with multipart credential linking (``op6_secrets``), in DataFrame functions alone.

Three kinds of span are always reported: ``assign`` (a secret-like name, ``=`` or ``:`` and a value), ``access``
(access identifiers) and ``hex`` (long hexadecimal runs). Three more are weak alone: ``ident`` (a user or client name
being assigned), ``endpoint`` (a URL up to its host and port) and ``bare`` (a long run with lower case, upper case and
digits, outside any span above). A weak span is reported when its complementary parts stand in the same scope, ``SCOPE`` code points
around its start: an ``ident`` needs a secret (assign, hex or bare), a ``bare`` needs an identifier (ident or access) or an endpoint, an
``endpoint`` needs an identifier and a secret.

Places: a text is split by the pattern, and the lengths of gaps and matches are summed up by a window inside
the text, so no text leaves its row. The interval join of parts and scopes is a range window over the spans
of one text; its cost is linear in their number and no pairs are made. Only numbers are shuffled, by id
and digest of the text; equal rows are counted before the shuffle and come back as often as they went in.

A very long text costs time in proportion to its length and its matches. An empty table gives no rows. Null and empty texts have no spans. Null ids form rows like others. Only named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.functions.text import let
from textmill.llm import kit

BLOCK = 4096  # code points; a text is cut into such blocks before its stretches are taken
SCOPE = 256  # code points to either side of a span's start
KINDS = ("assign", "access", "hex", "ident", "endpoint", "bare")  # the first three are the base, in this order
# The patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# The weak kinds.
IDENT = r"""(?i)(client_?id|user_?name|user|login|account|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
ENDPOINT = r"https?://[A-Za-z0-9.-]+(:[0-9]+)?"
BARE = r"[A-Za-z0-9+/]{32,}"
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, IDENT, ENDPOINT, BARE)))


def holds(kind: str, hit: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "assign":
        return F.length(F.regexp_extract(hit, PATTERNS[kind], 2)) >= 6
    if kind == "ident":
        return F.length(F.regexp_extract(hit, PATTERNS[kind], 2)) >= 3
    if kind == "bare":
        return hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9]")
    return F.lit(True)


def measured(text: Column, number: int) -> Column:
    """For each match of a kind: kind, number in the text, length of the gap before it, its length, whether it counts."""
    kind = KINDS[number]
    pattern = F.lit(PATTERNS[kind])
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
    pairs = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"))
    found = F.transform(
        F.filter(pairs, lambda p: p["hit"].isNotNull()),
        lambda p, i: F.struct(
            F.lit(number).alias("kind"), i.alias("nr"), p["gap"].cast("long").alias("gap"), F.length(p["hit"]).cast("long").alias("size"), holds(kind, p["hit"]).alias("good")
        ),
    )
    return F.when(text.rlike(PATTERNS[kind]), found)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, digest (md5 of the text) and ``spans``, an array of (start, kind number, end) sorted so; rows repeat as in ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = ["doc_id", "digest"]
    none = F.array().cast("array<struct<kind:int,nr:int,gap:bigint,size:bigint,good:boolean>>")
    hits = F.concat(*(F.coalesce(measured(text, i), none) for i in range(len(KINDS))))
    # the text ends here: what is exploded holds numbers alone
    measures = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("digest"), hits.alias("hits"))
    rows = measures.select(*own, F.explode_outer("hits").alias("h")).select(*own, "h.*")
    rows = rows.groupBy(*own, "kind", "nr").agg(F.first("gap").alias("gap"), F.first("size").alias("size"), F.first("good").alias("good"), F.count(F.lit(1)).alias("copies"))
    so_far = Window.partitionBy(*own, "kind").orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
    spans = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).withColumn("start", F.col("end") - F.col("size"))
    base, weak = F.col("good") & (F.col("kind") < 3), F.col("good") & (F.col("kind") >= 3)
    before = Window.partitionBy(*own).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*own).orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, 0)
    covered = F.coalesce(F.max(F.when(base, F.col("end"))).over(before) > F.col("start"), F.lit(False))
    covered = covered | F.coalesce(F.min(F.when(base, F.col("start"))).over(after) < F.col("end"), F.lit(False))
    spans = spans.withColumn("counts", F.col("good") & ~((F.col("kind") == 5) & covered))
    near = Window.partitionBy(*own).orderBy("start").rangeBetween(-SCOPE, SCOPE)

    def about(*kinds: int) -> Column:
        return F.coalesce(F.max(F.col("counts") & F.col("kind").isin(*kinds)).over(near), F.lit(False))

    user, secret, place = about(1, 3), about(0, 2, 5), about(4)
    linked = F.when(F.col("kind") == 3, secret).when(F.col("kind") == 5, user | place).otherwise(user & secret)
    spans = spans.withColumn("told", F.col("counts") & (base | (weak & linked)))
    told = F.when(F.col("told"), F.struct("start", "kind", "end"))
    whole = spans.groupBy(*own).agg(F.array_sort(F.collect_list(told)).alias("spans"), F.max("copies").alias("copies"))
    return whole.select(*own, "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    of = lambda number: F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
    return scan(kit.tables(spark, sf_dir, "documents")).select(
        "doc_id",
        *(of(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])),
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def any_hit(text: Column) -> Column:
    """Whether a text holds a match of any kind (texts without one have no spans)."""
    found = F.lit(False)
    for pattern in PATTERNS.values():
        found = found | F.coalesce(text.rlike(pattern), F.lit(False))
    return found


def merged(spans: DataFrame) -> DataFrame:
    """``__id, __key, __spans``: the spans of each text of ``scan``, overlapping ones as one (start, end), sorted."""
    own = ["doc_id", "digest"]
    each = spans.select(*own, F.explode("spans").alias("s")).select(*own, "s.start", "s.end", "s.kind").distinct()
    line = Window.partitionBy(*own).orderBy("start", "kind")
    begins = F.coalesce(F.col("start") >= F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = each.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = runs.groupBy(*own, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__key")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))


def stretch(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text given in blocks of ``BLOCK``."""
    place = lambda x: F.floor(x / BLOCK).cast("int")
    inside = lambda x: (x % BLOCK).cast("int")
    first, last = place(start), place(end)
    piece = F.substring(F.get(blocks, first), inside(start) + 1, (end - start).cast("int"))
    rest = F.concat(
        F.substring(F.get(blocks, first), inside(start) + 1, F.lit(BLOCK)),
        F.array_join(F.slice(blocks, first + 2, last - first - 1), ""),
        F.coalesce(F.substring(F.get(blocks, last), F.lit(1), inside(end)), F.lit("")),
    )
    return F.when(start >= end, "").when(first == last, piece).otherwise(rest)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each reported span replaced by ``mark`` and ``n_chars`` counted anew; other texts and all columns stay.

    Only texts with a possible hit are joined with their spans; overlapping spans become one. The stretches between spans are
    joined once, so the cost is linear in the text and its spans.
    """
    columns = docs.columns
    hit = docs.where(any_hit(F.col("text"))).withColumn("__digest", F.md5(F.col("text").cast("binary")))
    spans = merged(scan(hit.select("doc_id", "text")))
    both = hit.join(spans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__key")), "left")
    number = F.size("__spans")
    begin = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("__spans", i - 1)["end"])
    end = lambda i: F.when(i == number, F.length("text").cast("long")).otherwise(F.get("__spans", i)["start"])
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    walked = let(blocks, lambda own: F.array_join(F.transform(F.sequence(F.lit(0), number), lambda i: stretch(own, begin(i), end(i))), mark))
    cleaned = both.withColumn("text", F.when(F.col("__spans").isNotNull(), walked).otherwise(F.col("text")))
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("__spans").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return docs.where(~any_hit(F.col("text"))).select(*columns).unionByName(cleaned.select(*columns))


ORACLE = rf"""
with patterns(kind, re) as (values
  (0, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']? *[:=] *["'']?[A-Za-z0-9+/_.=-]+'),
  (1, 'AKIA[A-Z0-9]+'), (2, '[0-9a-f]+'),
  (3, '(?:[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Uu][Ss][Ee][Rr]_?[Nn][Aa][Mm][Ee]|[Uu][Ss][Ee][Rr]|[Ll][Oo][Gg][Ii][Nn]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Kk][Ee][Yy]_?[Ii][Dd])["'']? *[:=] *["'']?[A-Za-z0-9@._-]+'),
  (4, 'https?://[A-Za-z0-9.-]+(?::[0-9]+)?'), (5, '[A-Za-z0-9+/]+')),
names as (select ['assign', 'access', 'hex', 'ident', 'endpoint', 'bare'] as n),
docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
lists as (select row, kind, [length(x) for x in string_split_regex(text, re)] as gaps, regexp_extract_all(text, re) as hits
  from docs, patterns where regexp_matches(text, re)),
parts as (select row, kind, unnest(range(1, len(hits) + 1)) as nr, unnest(hits) as hit, unnest(gaps[:len(hits)]) as gap from lists),
placed as (select row, kind, hit, sum(gap + length(hit)) over (partition by row, kind order by nr) as stop, length(hit) as size from parts),
kept as (select row, kind, hit, cast(stop - size as bigint) as start, cast(stop as bigint) as stop from placed
  where case kind when 0 then length(regexp_replace(hit, '^[A-Za-z_]+["'']? *[:=] *["'']?', '')) >= 6
    when 1 then size >= 20 when 2 then size >= 24
    when 3 then length(regexp_replace(hit, '^[A-Za-z_]+["'']? *[:=] *["'']?', '')) >= 3
    when 4 then true
    else size >= 32 and regexp_matches(hit, '[a-z]') and regexp_matches(hit, '[A-Z]') and regexp_matches(hit, '[0-9]') end),
usable as (select * from kept k where not (kind = 5 and exists (
  select 1 from kept b where b.row = k.row and b.kind < 3 and b.start < k.stop and b.stop > k.start))),
told as (select * from usable u where kind < 3
  or (kind in (3, 4) and exists (select 1 from usable o where o.row = u.row and o.kind in (0, 2, 5) and abs(o.start - u.start) <= {SCOPE})
      and (kind = 3 or exists (select 1 from usable o where o.row = u.row and o.kind in (1, 3) and abs(o.start - u.start) <= {SCOPE})))
  or (kind = 5 and exists (select 1 from usable o where o.row = u.row and o.kind in (1, 3, 4) and abs(o.start - u.start) <= {SCOPE}))),
sums as (select row, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
  string_agg(n[kind + 1] || ':' || start || ':' || stop, ',' order by start, kind) filter (kind < 3) as base,
  string_agg(n[kind + 1] || ':' || start || ':' || stop, ',' order by start, kind) as spans from told, names group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join sums using (row)
"""

QUERIES = {"op6_secrets": op6_secrets}
ORACLE_SQL = {"op6_secrets": ORACLE}
