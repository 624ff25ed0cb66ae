"""Column functions over whole tables. ``documents`` hold no tags or emoji, so those are added by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.common import sql_grams, sql_words, table
from textmill.functions import bloom, codec, filetype, udf
from textmill.functions import text as tx
from textmill.sources import files

LITERALS = ["ing ", "the", "en"]


def _docs(spark, folder):
    return table(spark, folder, "documents")


def _text(expression, base=None):
    """A query giving ``doc_id`` and a digest and length of a text column."""

    def run(spark, folder):
        docs = _docs(spark, folder).withColumn("text", F.col("text") if base is None else base())
        changed = docs.select("doc_id", expression(F.col("text")).alias("t"))
        return changed.select("doc_id", F.md5("t").alias("digest"), F.length("t").cast("long").alias("n"))

    return run


def _text_sql(expression: str) -> str:
    return f"select doc_id, md5(t) as digest, len(t) as n from (select doc_id, {expression} as t from documents)"


def _tag(open_, close):
    return F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(open_), "text", F.lit(close), "text")).otherwise(F.col("text"))


def _tag_sql(open_: str, close: str) -> str:
    return f"case when doc_id % 3 = 0 then '{open_}' || text || '{close}' || text else text end"


EMOJI_ADDED = {0: "😀", 1: "☀️", 2: "漢字", 3: ""}


def _emoji(spark, folder):
    added = F.element_at(F.array(*[F.lit(v) for v in EMOJI_ADDED.values()]), (F.col("doc_id") % 4 + 1).cast("int"))
    docs = _docs(spark, folder).select("doc_id", F.concat("text", added).alias("t"))
    return docs.select(
        "doc_id",
        tx.contains_emoji(F.col("t")).alias("wide"),
        tx.contains_emoji(F.col("t"), strict=True).alias("strict"),
        F.length(tx.strip_emoji(F.col("t"))).cast("long").alias("n_left"),
    )


# First and last code points that count as emoji, then the widest one and those that stand for it in strict mode.
EMOJI_POINTS = [
    (0x1F1E6, 0x1F1FF), (0x1F300, 0x1F5FF), (0x1F600, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F700, 0x1F77F), (0x1F780, 0x1F7FF), (0x1F800, 0x1F8FF),
    (0x1F900, 0x1F9FF), (0x1FA00, 0x1FAFF), (0x2702, 0x27B0), (0x2600, 0x26FF), (0x2300, 0x23FF), (0x200D, 0x200D), (0xFE0F, 0xFE0F),
]
WIDE_POINTS = [(0x24C2, 0x1F251)]
STRICT_POINTS = [(0x24C2, 0x24FF), (0x25A0, 0x27BF), (0x2900, 0x297F), (0x2B00, 0x2BFF), (0x1F000, 0x1F251)]


def _emoji_sql() -> str:
    """Counts code points within the ranges instead of matching a pattern."""
    cases = " ".join(f"when {k} then '{v}'" for k, v in EMOJI_ADDED.items())
    wide, strict = (", ".join(map(str, EMOJI_POINTS + more)) for more in (WIDE_POINTS, STRICT_POINTS))
    return f"""
        with points as (select doc_id, unicode(unnest(regexp_extract_all(text || (case doc_id % 4 {cases} end), '(?s).'))) as c from documents),
        kinds as (select distinct c from points),
        wide as (select distinct c from kinds join (values {wide}) r(low, high) on c between low and high),
        strict as (select distinct c from kinds join (values {strict}) r(low, high) on c between low and high)
        select doc_id, bool_or(c in (from wide)) as wide, bool_or(c in (from strict)) as strict, count(*) filter (where c not in (from wide)) as n_left
        from points group by doc_id"""


# A caller's own tokenizer: pieces between single blanks.
WORDS = udf.tokenizer_count(lambda text: [x for x in text.split(" ") if x])


def _lateral(spark, folder):
    """The SQL table function over every text.

    Texts are not grouped by n-gram: only edges are, and all n-grams of an id that has several rows.
    """
    udf.register(spark)
    return spark.sql(
        """with d as (
               select {docs}.doc_id, text, several is not null as several
               from {docs} left join (select doc_id, true as several from {docs} group by doc_id having count(*) > 1) r on {docs}.doc_id <=> r.doc_id),
           counted as (
               select doc_id, several, case when several or is_edge then ngram end as gram, count(*) as n, count_if(is_first) as n_first
               from (select doc_id, several, grams from d, lateral tm_ngram_rows(d.text, 1, 3)) lateral view outer inline(grams) g as ngram, is_first, is_edge
               where ngram is not null group by 1, 2, 3)
           select doc_id, sum(n) as n_grams, sum(if(several, 1L, n_first)) as n_distinct, min(gram) as first_gram, max(gram) as last_gram
           from counted group by doc_id""",
        docs=_docs(spark, folder).select("doc_id", "text"),
    )


def _indexes(args):
    def run(spark, folder):
        found = bloom.index_list(F.col("text"), **args)
        return _docs(spark, folder).select("doc_id", *[c.alias(f"i{n}") for n, c in enumerate(found)])

    return run


def sql_sliced(item: str, power2: int, k: int) -> list[str]:
    """The k bit positions of an item, from one digest."""
    found = []
    for i in range(k):
        low = (k - 1 - i) * (256 // k)
        skip, rest = low // 4, low % 4
        width = min((power2 + rest + 3) // 4, 64 - skip)
        piece = f"substr(sha256({item}), {64 - skip - width + 1}, {width})"
        found.append(f"((('0x' || {piece})::bigint >> {rest}) & {(1 << power2) - 1})")
    return found


def _indexes_sql(found: list[str]) -> str:
    return f"select doc_id, {', '.join(f'{sql} as i{n}' for n, sql in enumerate(found))} from documents"


def _salted_sql(size: int, k: int) -> list[str]:
    found = []
    for i in range(k):
        rest = "0::hugeint"
        for start in range(1, 65, 8):
            rest = f"(({rest} * 4294967296 + ('0x' || substr(sha256('{i}' || text), {start}, 8))::bigint) % {size})"
        found.append(f"{rest}::bigint")
    return found


CHAINED_SQL = [
    f"(('0x' || substr(sha256(unhex(sha256(text)) || '{i}'::blob), 58, 7))::bigint & {(1 << 27) - 1})" for i in range(6)
]


def _roundtrip(spark, folder):
    docs = _docs(spark, folder).select("doc_id", "text")
    out = None
    for algo, level in (("zlib", 6), ("zstd", 3), ("gz", 9), ("lz4", 1), ("zlib", 0)):
        part = docs.select(
            "doc_id",
            F.lit(f"{algo}-{level}").alias("codec"),
            F.md5(codec.decompress(codec.compress(F.col("text"), level, algo), algo, level)).alias("digest"),
        )
        out = part if out is None else out.unionByName(part)
    return out


# File bytes and names for the text tests: some documents get a NUL, a cut character or a binary tail.
def _as_files(spark, folder):
    kind = F.col("doc_id") % 5
    content = (
        F.when(kind == 1, F.concat(F.unhex(F.lit("00")), F.encode("text", "UTF-8")))
        .when(kind == 2, F.concat(F.unhex(F.lit("C3")), F.encode("text", "UTF-8")))
        .when(kind == 3, F.unhex(F.repeat(F.lit("80"), 700)))
        .otherwise(F.encode("text", "UTF-8"))
    )
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("doc_id") % 7 + 1).cast("int"))
    return _docs(spark, folder).select(
        "doc_id", F.concat(F.lit("/data/f"), F.col("doc_id").cast("string"), suffix).alias("path"), content.alias("content")
    )


SUFFIXES = [".txt", ".md", ".bin", ".csv", ".HTML", "", ".css.gz"]
_SUFFIX_IS_TEXT = [True, True, False, True, True, False, True]

# Valid text has no invalid bytes apart from a character cut by the block edge. The share of other
# bytes is counted on hex digits: printable bytes are 09 to 0D and 20 to 7E.
FILES_SQL = f"""
    raw as (select doc_id, doc_id % 5 as kind, doc_id % 7 as sfx,
        case doc_id % 5 when 1 then '\\x00'::blob || encode(text) when 2 then '\\xC3'::blob || encode(text)
             when 3 then unhex(repeat('80', 700)) else encode(text) end as content from documents),
    head as (select *, hex(content[1:1024]) as h, hex(content[1:512]) as h5 from raw),
    utf as (select *,
        regexp_full_match(h, '{{u}}') as v_decode,
        regexp_full_match(h5, '{{u}}') and not regexp_full_match(h5, '(?:..)*?00(?:..)*') as v_nul,
        case when h = '' then true else
            len(regexp_replace(h, '(0[9A-D]|[2-6].|7[0-9A-E])|(..)', '\\2', 'g')) / len(h) < 0.30 end as v_control,
        case sfx {' '.join(f'when {i} then {str(v).lower()}' for i, v in enumerate(_SUFFIX_IS_TEXT))} end as v_mime
        from head)"""
_C = "[89AB]."
UTF8_HEX = (
    rf"(?:[0-7].|C[2-9A-F]{_C}|D.{_C}|E0[AB].{_C}|E[1-9A-CEF]{_C}{_C}|ED[89].{_C}"
    rf"|F0[9AB].{_C}{_C}|F[1-3]{_C}{_C}{_C}|F48.{_C}{_C})*"
)
FILES_SQL = FILES_SQL.replace("{u}", UTF8_HEX)


def _votes(spark, folder):
    rows = _as_files(spark, folder)
    name = files.file_name(F.col("path"))
    votes = filetype.text_votes(F.col("content"), name)
    return rows.select(
        "doc_id",
        *[v.alias(k) for k, v in votes.items()],
        filetype.is_text_combined(F.col("content"), name).alias("combined"),
    )


def _text_filter(spark, folder):
    rows, out = _as_files(spark, folder), None
    for method in ("decode", "control", "mime", "nul", "combined"):
        part = files.filter_text_files(rows, method).select("doc_id", F.lit(method).alias("method"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("method").agg(F.count("*").alias("n"), F.sum("doc_id").alias("id_sum"))


def _examples(spark, folder):
    talk = table(spark, folder, "conversations")
    item = F.to_json(
        F.struct(
            F.array(
                F.struct(F.col("text").alias("input"), F.lit(None).cast("string").alias("role")),
                F.struct(F.lit(None).cast("string").alias("input"), F.col("role").alias("role")),
            ).alias("examples")
        )
    )
    packed = talk.select("conv_id", "turn", F.when(F.col("turn") == 3, F.lit("{broken")).otherwise(item).alias("value"))
    return files.examples_of(packed, keep=("conv_id", "turn")).withColumn("example", F.col("example").cast("long"))


QUERIES = {
    "sanitize": _text(tx.sanitize, lambda: F.regexp_replace("text", r"\. ", ".\n\n")),
    "remove_literals": _text(lambda t: tx.remove_literals(t, LITERALS)),
    "strip_think": _text(tx.strip_think, lambda: _tag("a<think>x\ny</think>", "<think>")),
    "strip_special_tokens": _text(tx.strip_special_tokens, lambda: _tag("<|im\nstart|>", "<|end|>")),
    "remove_prompt": lambda s, d: table(s, d, "conversations").select(
        "conv_id",
        "turn",
        tx.remove_prompt(tx.sanitize(F.col("text")), F.substring("text", 1, 3)).alias("left"),
    ),
    "ngrams_prefix": lambda s, d: _docs(s, d).select(
        "doc_id", F.array_join(tx.ngrams_prefix(F.col("text"), 4, 1), "|").alias("grams")
    ),
    "content_hashes": lambda s, d: _docs(s, d).select(
        "doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5")
    ),
    "bloom_indexes": _indexes({"power2": 27, "k": 8}),
    "bloom_indexes_b": _indexes({"power2": 27, "k": 6, "family": "chained"}),
    "bloom_indexes_a": _indexes({"k": 6, "family": "salted", "size": 100_000_000}),
    "emoji_flags": _emoji,
    "url_host": lambda s, d: table(s, d, "pages").select("page_id", tx.url_host(F.col("url")).alias("host")),
    "token_counts": lambda s, d: _docs(s, d).select(
        "doc_id", tx.token_count(F.col("text")).cast("long").alias("tok")
    ),
    "token_counts_custom": lambda s, d: _docs(s, d).select("doc_id", WORDS(F.col("text")).cast("long").alias("tok")),
    "ngrams_lateral": _lateral,
    "compress_roundtrip": _roundtrip,
    "text_vote": _votes,
    "text_filter": _text_filter,
    "examples_extract": _examples,
}

ORACLE = {
    "sanitize": _text_sql(r"regexp_replace(regexp_replace(text, '\. ', '.' || chr(10) || chr(10), 'g'), '\n+', chr(10), 'g')"),
    "remove_literals": _text_sql("replace(replace(replace(text, 'ing ', ''), 'the', ''), 'en', '')"),
    "strip_think": _text_sql(
        "regexp_replace("
        + _tag_sql("a<think>x' || chr(10) || 'y</think>", "<think>")
        + ", '(?s)<think>.*?</think>', '', 'g')"
    ),
    "strip_special_tokens": _text_sql(
        "regexp_replace(" + _tag_sql("<|im' || chr(10) || 'start|>", "<|end|>") + r", '(?s)<\|.*?\|>', '', 'g')"
    ),
    "remove_prompt": r"""select conv_id, turn,
        replace(regexp_replace(text, '\n+', chr(10), 'g'), substr(text, 1, 3), '') as "left" from conversations""",
    "ngrams_prefix": f"""
        with words as (select doc_id, {sql_words("replace(text, chr(10), '')")} as w from documents)
        select doc_id, array_to_string([{', '.join(
            f"array_to_string(w[{start}:{start + size - 1}], ' ')" for size in (4, 3, 2) for start in range(1, 6 - size)
        )}], '|') as grams from words""",
    "content_hashes": "select doc_id, sha256(text) as sha256, md5(text) as md5 from documents",
    "bloom_indexes": _indexes_sql(sql_sliced("text", 27, 8)),
    "bloom_indexes_b": _indexes_sql(CHAINED_SQL),
    "bloom_indexes_a": _indexes_sql(_salted_sql(100_000_000, 6)),
    "emoji_flags": _emoji_sql(),
    "url_host": r"select page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)) as host from pages",
    "token_counts": f"select doc_id, len({sql_words('text')}) as tok from documents",
    "token_counts_custom": "select doc_id, len(list_filter(string_split(text, ' '), lambda x: x <> '')) as tok from documents",
    "ngrams_lateral": f"""
        with w as (select doc_id, {sql_words('text')} as w from documents)
        select doc_id, count(*) as n_grams, count(distinct gram) as n_distinct, min(gram) as first_gram, max(gram) as last_gram
        from {sql_grams('w', 1, 3)} group by doc_id""",
    "compress_roundtrip": """
        select doc_id, codec, md5(text) as digest
        from documents, (values ('zlib-6'), ('zstd-3'), ('gz-9'), ('lz4-1'), ('zlib-0')) c(codec)""",
    "text_vote": f"""
        with {FILES_SQL}
        select doc_id, v_decode as decode, v_control as control, v_mime as mime,
               (v_decode::int + v_control::int + v_mime::int) > 1 as combined from utf""",
    "text_filter": f"""
        with {FILES_SQL},
        votes as (select doc_id, unnest(['decode', 'control', 'mime', 'nul', 'combined']) as method,
            unnest([v_decode, v_control, v_mime, v_nul, (v_decode::int + v_control::int + v_mime::int) > 1]) as ok from utf)
        select method, count(*) as n, cast(sum(doc_id) as bigint) as id_sum from votes where ok group by method""",
    "examples_extract": """
        select conv_id, turn, 0::bigint as example, replace(text, chr(10), '\\n') as input
        from conversations where turn <> 3""",
}

