"""Places where a caller plugs in Python: responders, tokenizers, SQL names."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill import schemas
from textmill.functions import codec

Responder = Callable[[pd.Series], tuple[list[str], list[int]]]


def respond_with(fn: Responder, batch: int | None = None, timed: bool = False) -> Callable[[DataFrame], DataFrame]:
    """Turn ``fn(prompts) -> (responses, token counts)`` into a table function over prompts.

    ``fn`` sees at most ``batch`` prompts at once (as many as Arrow sends otherwise). ``timed`` adds ``td``: the
    seconds of a batch, in equal shares to its rows, so that sums over rows are seconds spent. The walk writes each level once; a task
    that is run again replaces its rows with their seconds.
    """

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            step = batch or len(frame)
            for start in range(0, len(frame), max(1, step)):
                prompts = frame["prompt"].iloc[start : start + step]
                begun = time.perf_counter()
                responses, toks = fn(prompts)
                spent = time.perf_counter() - begun
                made = pd.DataFrame({"prompt": prompts.to_numpy(), "response": list(responses), "tok": list(toks)})
                yield made.assign(td=spent / len(prompts)) if timed else made

    return lambda prompts: prompts.select("prompt").mapInPandas(batches, schemas.TIMED_RESPONSES if timed else schemas.RESPONSES)


def tokenizer_count(encode: Callable[[str], list]) -> Callable[[Column], Column]:
    """Token count with a caller's tokenizer, in Arrow batches."""

    @F.pandas_udf(T.IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(encode(t)), na_action="ignore").astype("Int32")

    return count


# Words are cut at the same white space as everywhere else; all of it runs in the JVM.
NGRAMS_SQL = r"""
create or replace temporary function tm_ngrams(content string, low int, high int) returns table(ngram string)
return select explode(flatten(transform(
    filter(sequence(least(low, size(w)), least(high, size(w))), n -> n >= low and n > 0),
    n -> transform(sequence(0, size(w) - n), i -> array_join(slice(w, i + 1, n), ' ')))))
from (select filter(split(content, r'(?U)[\s\x1c-\x1f]+', -1), x -> x <> '') as w)
"""

# One row for a text, so that Spark takes it as a column of that text; the rows of ``tm_ngrams`` it joins back by the whole text.
# N-grams come sorted, equal ones are neighbours: ``is_first`` marks one of each, ``is_edge`` the smallest and the largest.
NGRAM_ROWS_SQL = r"""
create or replace temporary function tm_ngram_rows(content string, low int, high int) returns table(grams array<struct<ngram string, is_first boolean, is_edge boolean>>)
return select get(transform(array(filter(split(content, r'(?U)[\s\x1c-\x1f]+', -1), x -> x <> '')), w ->
    get(transform(array(sort_array(flatten(transform(
        filter(sequence(least(low, size(w)), least(high, size(w))), n -> n >= low and n > 0),
        n -> transform(sequence(0, size(w) - n), i -> array_join(slice(w, i + 1, n), ' ')))))), s ->
        transform(s, (g, i) -> struct(g as ngram, i = 0 or g <> get(s, i - 1) as is_first, i = 0 or i = size(s) - 1 as is_edge))), 0)), 0)
"""


def register(spark: SparkSession) -> None:
    """SQL names: the codecs, and ``LATERAL tm_ngrams(text, low, high)`` for white-space n-grams, ``tm_ngram_rows`` for an array of them."""
    codec.register(spark)
    spark.sql(NGRAMS_SQL)
    spark.sql(NGRAM_ROWS_SQL)
