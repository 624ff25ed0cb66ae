import json
import mimetypes
import random

import pytest
from pyspark.sql import functions as F

from textmill.functions import filetype
from textmill.operators import ingest, language, store
from textmill.sources import files


def test_read_lines_and_files(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    (tmp_path / "d" / "a.txt").write_bytes(b"one\r\ntwo\xff\rthree")
    (tmp_path / "d" / "sub" / "b.md").write_bytes("é".encode())
    lines = tmp_path / "lines"
    lines.write_text("  a b \n\n\tc\n")
    assert [r.line for r in files.read_lines(spark, str(lines)).collect()] == ["a b", "", "c"]
    assert [r.prompt for r in files.read_prompts(spark, str(lines)).collect()] == ["  a b ", "", "\tc"]
    assert sorted(r.text for r in files.read_whole_files(spark, str(tmp_path / "d")).collect()) == ["one\ntwo\nthree", "é"]
    assert [r.text for r in files.read_txt_dir(spark, str(tmp_path / "d")).collect()] == ["one\ntwo\nthree"]
    assert [r.length for r in files.list_files(spark, str(tmp_path / "d")).collect()] == [15]
    assert files.with_suffix(files.read_whole_files(spark, str(tmp_path / "d")), ".md").count() == 1
    report = ingest.count_tokens(files.read_txt_dir(spark, str(tmp_path / "d"))).collect()
    assert [(r.tok, r.running_tokens) for r in report] == [(3, 3)]


def test_task_examples(spark, tmp_path):
    (tmp_path / "x").mkdir()
    good = {"examples": [{"input": "a\nb", "target": 1}, {"target": 2}, "text", {"input": 5}, {"input": "c"}, {"input": None}]}
    (tmp_path / "good.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "x" / "list.json").write_text(json.dumps([{"examples": [{"input": "no"}]}]))
    (tmp_path / "x" / "other.json").write_text(json.dumps({"examples": "no list"}))
    (tmp_path / "x" / "bad.json").write_text("{broken")
    (tmp_path / "x" / "skip.txt").write_text(json.dumps({"examples": [{"input": "no"}]}))
    rows = files.read_task_examples(spark, str(tmp_path)).collect()
    assert sorted((r.example, r.input) for r in rows) == [(0, "a\\nb"), (4, "c")]
    assert [r.path.rsplit("/", 1)[1] for r in files.bad_task_files(spark, str(tmp_path)).collect()] == ["bad.json"]


CONTENTS = [b"", b"plain text", b"\xc3", b"\xc3\xa9", b"ab\x00cd", b"\x80" * 40, b"a" * 1023 + b"\xc3\xa9", b"a" * 511 + b"\xc3\xa9", "é".encode() * 20 + b"a" * 99]


@pytest.mark.parametrize("content", CONTENTS)
def test_content_tests(spark, content):
    printable = bytes(range(0x20, 0x7F)) + b"\t\n\r\x0b\x0c"

    def utf8(block):
        try:
            block.decode("utf-8")
            return True
        except UnicodeDecodeError:
            return False

    head = content[:1024]
    df = spark.createDataFrame([(bytearray(content),)], "c binary")
    got = df.select(filetype.is_text_decode(F.col("c")), filetype.is_text_nul(F.col("c")), filetype.is_text_control(F.col("c"))).first()
    other = len(head.translate(None, printable))
    assert tuple(got) == (utf8(head), b"\x00" not in content[:512] and utf8(content[:512]), not head or other / len(head) < 0.30)


def test_names(spark):
    guess = mimetypes.MimeTypes(filenames=()).guess_type
    names = ["a.txt", "b.TXT", "c.md", "d.bin", "e.csv.gz", "f", ".txt", "g.tar", "h.html.bz2", "i.py", "j.json", "k.txt.bin", "l.css"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", filetype.is_text_mime(F.col("n")).alias("m"))
    for r in df.collect():
        assert r.m == (guess(r.n)[0] or "").startswith("text/"), r.n


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        filetype.text_test("magic", F.col("c"), F.col("n"))


def test_split_and_content_addressed(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_bytes(b"same")
    (source / "b.md").write_bytes(b"same")
    (source / "c.bin").write_bytes(b"\x00\xff" * 50)
    found = files.read_files(spark, str(source))
    files.split_text_binary(found, str(tmp_path / "split"))
    assert {(r.label, r.name) for r in spark.read.parquet(str(tmp_path / "split")).collect()} == {("txt", "a.txt"), ("txt", "b.md"), ("bin", "c.bin")}
    assert (source / "a.txt").exists()
    for _ in range(2):
        ingest.write_content_addressed(found, str(tmp_path / "ca"))
    rows = spark.read.parquet(str(tmp_path / "ca")).collect()
    assert [(r.name, bytes(r.content)) for r in rows] == [("51037a4a37730f52c8732586d3aaa316.txt", b"same")]


def test_ingest(spark):
    empty = spark.createDataFrame([], "data binary")
    lines = spark.createDataFrame([(1, " a b "), (2, "a b"), (3, "c")], "seq long, line string")
    assert sorted((r.seq, r.word, r.tok) for r in ingest.ingest_lines(lines, empty).collect()) == [(1, "archive", 2), (3, "archive", 1)]
    long = "w " * 21
    texts = spark.createDataFrame([("p1", long + "X\n"), ("p2", long + "X\n"), ("p3", long + "\n"), ("p4", "w " * 20)], "path string, text string")
    # p2 repeats p1; p4 has 20 tokens, not more; tokens are counted before cleaning.
    rows = ingest.ingest_files(texts, empty, ["X"], minimum=20)
    assert sorted((r.path, r.tok) for r in rows.collect()) == [("p1", 22), ("p3", 21)]
    assert store.store_texts(rows.withColumn("compression_algo", F.lit(None).cast("string"))).count() == 2


def test_languages(spark, tmp_path):
    known = spark.createDataFrame([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "en"), ("x", None)], "text string, lang string")
    model = language.train(known)
    lines = spark.createDataFrame([(1, " the dog "), (2, "the dog"), (3, "die Katze"), (4, "ab")], "seq long, line string")
    routed = language.route_languages(lines, model)
    assert sorted((r.seq, r.lang) for r in routed.collect()) == [(1, "en"), (3, "de"), (4, "undetected")]
    files.write_by_language(routed, str(tmp_path / "out"))
    back = spark.read.text(str(tmp_path / "out"))
    assert {(r.lang, r.value) for r in back.collect()} == {("en", "the dog"), ("de", "die Katze"), ("undetected", "ab")}
    with pytest.raises(ValueError):
        language.train(known.limit(0))


def test_language_join_without_broadcast(spark, monkeypatch):
    known = spark.createDataFrame([("the cat and the dog", "en"), ("der Hund und die Katze", "de")], "text string, lang string")
    model = language.train(known)
    lines = spark.createDataFrame([(1, "the dog"), (3, "die Katze"), (4, "ab")], "doc_id long, text string")
    wanted = sorted(map(str, language.detect(lines, model).collect()))
    monkeypatch.setattr(language, "BROADCAST_BYTES", 0)
    assert sorted(map(str, language.detect(lines, model).collect())) == wanted


def test_many_languages_against_definition(spark):
    """Naive Bayes over 60 languages, written out: also for texts that share a trigram with few or none of them."""
    from collections import Counter
    from math import log

    known = [(f"w{i:03d} q{i % 7}z the{i}", f"l{i:02d}") for i in range(60)] + [("", "none")]
    model = language.train(spark.createDataFrame(known, "text string, lang string"))
    cut = lambda t: [t.lower()[i : i + 3] for i in range(len(t) - 2)]
    counts = {lang: Counter(cut(text)) for text, lang in known}
    vocabulary = len({g for c in counts.values() for g in c})
    assert model.vocabulary == vocabulary
    texts = [(1, "w007 the7"), (2, "q3z"), (3, "xyxyxy"), (4, "the"), (5, "ab"), (6, ""), (7, None), (8, "the59 the59")]

    def best(text):
        grams = cut(text or "")
        cost = lambda c: sum(log(c.total() + vocabulary) - log(c[g] + 1) for g in grams)
        return min((round(cost(c), 9), lang) for lang, c in counts.items())[1] if grams else "undetected"

    found = language.detect(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang for r in found} == {i: best(t) for i, t in texts}


def test_languages_are_found_without_rows_of_trigrams(spark, monkeypatch):
    rng = random.Random(3)
    letters = "abcdeäßЖ語😀\0 İ\n"
    known = [("".join(rng.choice(letters[i % 4 :]) for _ in range(rng.randint(0, 60))), f"l{i % 9}") for i in range(90)] + [(None, "l0"), ("abc", None), ("", "none")]
    model = language.train(spark.createDataFrame(known, "text string, lang string").repartition(3))
    counts = {}
    for text, lang in known:
        for i in range(len((text or "").lower()) - 2):
            if lang is not None:
                counts[(text.lower()[i : i + 3], lang)] = counts.get((text.lower()[i : i + 3], lang), 0) + 1
    assert {(r.gram, r.c["lang"]): r.c["n"] for r in model.grams.select("gram", F.explode("counts").alias("c")).collect()} == counts
    texts = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))) for i in range(200)] + [(900, None), (901, "zzzz"), (902, "ab"), (903, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(language, "TEXT_BYTES", 50)
    monkeypatch.setattr(language, "PAIRS", 30)
    found = language.detect(df, model)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(language, "BROADCAST_BYTES", 0)
    joined = language.detect(df, model)
    assert "Generate" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, joined.collect())) and found.count() == len(texts)
