"""Table access and SQL pieces shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(value: Column | str) -> Column:
    """Floats are compared at six decimals; a negative zero becomes zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6) + F.lit(0.0)


# SQL of the shared text rules. RE2's \s lacks the vertical tab and non-ASCII spaces, so they are named.
WS = r"[\s\x0B\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda x: x <> '')"


def sql_strip(text: str) -> str:
    return rf"regexp_replace(regexp_replace({text}, '^{WS}+', ''), '{WS}+$', '')"


def sql_tokens(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def sql_fused(text: str) -> str:
    return f"replace(lower({text}), chr(10), '')"


def sql_grams(source: str, low: int, high: int, key: str = "doc_id") -> str:
    """Subquery of ``(key, gram)`` rows from a relation with ``key`` and a word array ``w``."""
    grams = []
    for n in range(low, high + 1):
        rest = "".join(f" || ' ' || lead(w, {k}) over o" for k in range(1, n))
        grams.append(f"w{rest}")
    return f"""(select {key}, gram from (
        select {key}, unnest([{', '.join(grams)}]) as gram
        from (select {key}, unnest(w) as w, generate_subscripts(w, 1) as p from {source})
        window o as (partition by {key} order by p)) where gram is not null)"""


def sql_lines(source: str = "documents", text: str = "text", keys: str = "doc_id") -> str:
    """Subquery of ``(keys, pos, line)`` rows; ``pos`` counts from 0."""
    parts = f"string_split({text}, chr(10))"
    return f"(select {keys}, unnest({parts}) as line, generate_subscripts({parts}, 1) - 1 as pos from {source})"


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """``(seq, line)`` of every line of ``documents``."""
    docs = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return docs.select((F.shiftleft("doc_id", 32) + F.col("pos")).alias("seq"), "line")


LINES = f"(select doc_id * 4294967296 + pos as seq, line from {sql_lines()})"


def generations(spark: SparkSession, folder: str) -> DataFrame:
    """``(gen, prompt, text)``: each assistant turn that follows a user turn.

    Turns meet through an equi-join on conversation and turn, so a long conversation is
    spread over many tasks.
    """
    talk = table(spark, folder, "conversations")
    asked = talk.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    told = talk.where("role = 'assistant'").select("conv_id", "turn", "text")
    return told.join(asked, ["conv_id", "turn"]).select(
        (F.shiftleft("conv_id", 20) + F.col("turn")).alias("gen"), "prompt", "text"
    )


GENERATIONS = """(select a.conv_id * 1048576 + a.turn as gen, u.text as prompt, a.text as text
    from conversations a join conversations u on u.conv_id = a.conv_id and u.turn + 1 = a.turn
    where a.role = 'assistant' and u.role = 'user')"""
