import re
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.functions import udf


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t"))).first()[0]


def test_strip_characters_are_pythons():
    assert set(tx.WHITESPACE) == {chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()}


@pytest.mark.parametrize(
    ("fn", "given_", "wanted"),
    [
        (tx.sanitize, "a\n\n\nb", "a\nb"),
        (tx.sanitize, "  a b  ", "  a b  "),
        (tx.strip_think, "a<think>x\ny</think>b", "ab"),
        (tx.strip_special_tokens, "a<|x\ny|>b", "ab"),
        (tx.normalize_for_scoring, "The lazy\ncat", "the lazycat"),
        (lambda t: tx.remove_prompt(t, F.lit("ab")), "abcab", "c"),
        (lambda t: tx.remove_prompt(t, F.lit("")), "abc", "abc"),
        (lambda t: tx.remove_literals(t, ["b", "ac"]), "abc", ""),
        (lambda t: tx.remove_literals(t, ["b"], keep_newline=True), "ab\nb", "ab"),
        (lambda t: tx.ngrams_prefix(t, 3, 1), "a b c", ["a b c", "a b", "b c"]),
        (lambda t: tx.ngrams_prefix(t, 3, 1), "a", ["a", "a", ""]),
        (tx.contains_emoji, "x😀", True),
        (tx.contains_emoji, "漢", True),
        (lambda t: tx.contains_emoji(t, strict=True), "漢", False),
        (tx.strip_emoji, "a😀b", "ab"),
        (tx.url_host, "https://WWW.Example.com:8/x", "www.example.com"),
        (tx.url_host, "no url", None),
        (lambda t: tx.token_count(t, "pretoken"), "it's  10 dogs!", 6),
        (lambda t: tx.char_ngrams(t, 3), "a😀bc", ["a😀b", "😀bc"]),
        (lambda t: tx.char_ngrams(t, 3), "ab", []),
    ],
)
def test_golden(spark, fn, given_, wanted):
    assert one(spark, given_, fn) == wanted


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x1c\xa0 é_1", max_size=12), min_size=1, max_size=20))
def test_words_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        "t",
        tx.strip(F.col("t")).alias("s"),
        tx.whitespace_words(F.col("t")).alias("w"),
        tx.word_tokens(F.col("t")).alias("k"),
        tx.ngrams(tx.whitespace_words(F.col("t")), 1, 3).alias("g"),
    ).collect()
    for r in rows:
        words = r.t.split()
        assert r.s == r.t.strip()
        assert r.w == words
        assert r.k == re.findall(r"\b\w\w+\b", r.t.lower())
        assert r.g == [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_unknown_token_count():
    with pytest.raises(ValueError):
        tx.token_count("t", "bpe")


def test_plug_ins(spark):
    udf.register(spark)
    rows = spark.sql("select ngram from values ('a b c') v(t), lateral tm_ngrams(t, 1, 2)").collect()
    assert sorted(r[0] for r in rows) == ["a", "a b", "b", "b c", "c"]
    assert spark.sql("select tm_decompress(tm_compress('héy'), null)").first()[0] == "héy"
    count = udf.tokenizer_count(lambda t: list(t))
    assert spark.createDataFrame([("abc",)], "t string").select(count(F.col("t"))).first()[0] == 3
    answer = udf.respond_with(lambda prompts: ([p + "!" for p in prompts], [1] * len(prompts)))
    assert answer(spark.createDataFrame([("x",)], "prompt string")).first() == ("x", "x!", 1)
