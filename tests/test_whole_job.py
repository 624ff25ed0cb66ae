"""Registered queries on small tables of their own."""

import pytest
from pyspark.sql import functions as F

from textmill.catalog import columns as column_queries
from textmill.catalog import files as file_queries
from textmill.catalog import frontier as frontier_queries
from textmill.catalog import phrases as phrase_queries
from textmill.catalog import walks as walk_queries
from textmill.operators import expand
from textmill.sources import files as sources


def test_every_turn_is_a_file_of_its_own(spark, tmp_path):
    rows = [(0, 0, "user", "a\nb"), (0, 1, "assistant", "c"), (17, 0, "user", "d"), (17, 0, "user", "d2"), (-3, None, "user", "é")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = file_queries.QUERIES["read_whole_files"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(c, t, x) for c, t, _, x in rows], key=repr)


def test_phrases_are_counted_without_sorting_them(spark, tmp_path):
    rows = [(1, "b a b a c"), (1, "a z"), (2, "one"), (3, None), (4, "x y x y x y")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = phrase_queries.QUERIES["phrase_candidates"](spark, str(tmp_path))
    assert "SortAggregate" not in found._jdf.queryExecution().sparkPlan().toString().split("Generate")[1].split("HashAggregate")[0]
    counts = {}
    for doc, text in rows:
        words = (text or "").split()
        grams = {" ".join(words[i : i + n]) for n in range(2, 11) for i in range(len(words) - n + 1)}
        counts[doc] = counts.get(doc, []) + sorted(grams)
    assert {r.doc_id: (r.n_phrases, r.n_chars, r.first_phrase, r.last_phrase) for r in found.collect()} == {
        doc: (len(g), sum(map(len, g)), min(g), max(g)) for doc, g in counts.items() if g
    }


def test_lateral_ngrams_are_grouped_by_text(spark, tmp_path):
    rows = [(1, "b a b a b"), (1, "a b z"), (2, "one"), (3, None), (4, "x y x y x y"), (None, "n n"), (None, "n m")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = column_queries.QUERIES["ngrams_lateral"](spark, str(tmp_path))
    assert "Join Inner" not in found._jdf.queryExecution().optimizedPlan().toString()  # no join on the text
    grams = {}
    for doc, text in rows:
        words = (text or "").split()
        grams.setdefault(doc, []).extend(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    assert {r.doc_id: (r.n_grams, r.n_distinct, r.first_gram, r.last_gram) for r in found.collect()} == {
        doc: (len(g), len(set(g)), min(g), max(g)) for doc, g in grams.items() if g
    }


def test_text_files_are_small_and_decoded_as_before(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(file_queries, "LINES_PER_FILE", 3)
    spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "\n\ne")], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    path = file_queries._text_folder(spark, str(tmp_path))
    assert sorted(r.text for r in sources.read_txt_dir(spark, path).collect()) == sorted(["a\nb\nc\n", "d\n\n\n", "e\n"])
    raw = [b"a\r\nb\rc", b"\xff\xc3\xa9\r\n\xc3", b"\xed\xa0\x80x", "é\r\r\n".encode()]
    (tmp_path / "raw").mkdir()
    for i, data in enumerate(raw):
        (tmp_path / "raw" / f"{i}.txt").write_bytes(data)
    found = {r.path[-5]: r.text for r in sources.read_txt_dir(spark, str(tmp_path / "raw")).collect()}
    assert found == {str(i): d.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n") for i, d in enumerate(raw)}


def test_bloom_walk_is_not_ended_by_a_full_filter(spark, tmp_path):
    docs = [(d, "\n".join(f"line {d} {i}" for i in range(25))) for d in range(3)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    talk = spark.range(30_000).select("id", F.lit(0).cast("long"), F.lit("user"), F.concat(F.lit("said "), "id")).toDF("conv_id", "turn", "role", "text")
    talk.write.parquet(f"{tmp_path}/conversations.parquet")
    found = walk_queries.QUERIES["expand_bloom"](spark, str(tmp_path)).collect()
    # A line is answered by the next two, so each level reaches two lines further.
    assert sorted((r.word, r.prompt, r.depth) for r in found) == sorted((f"line {d} 0", f"line {d} {i}", (i + 1) // 2) for d in range(3) for i in range(19))


class Caught(Exception):
    pass


def answers_of(spark, folder, monkeypatch, query):
    """The table that a walk's query answers from; the walk is not run."""

    def caught(rows):
        raise Caught(rows)

    monkeypatch.setattr(expand, "table_responder", caught)
    with pytest.raises(Caught) as found:
        query(spark, folder)
    return found.value.args[0]


def test_answers_of_prefixed_lines_are_moved_once(spark, tmp_path, monkeypatch):
    docs = [(1, "a\nb\nc\na\nMore about a\nx"), (0, "b\nq\n\nb"), (2, None), (3, "More about a\nz"), (4, "é\n语\né")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = answers_of(spark, str(tmp_path), monkeypatch, frontier_queries.QUERIES["expand_prefixed"])
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    plain = {}
    for doc, text in sorted(docs):
        lines = (text or "").split("\n")
        for i, line in enumerate(lines[:-1]):
            plain.setdefault(line, "\n".join(lines[i + 1 : i + 3]))
    wanted = {}
    for prompt, response in [*plain.items(), *((f"More about {p}", f"{r}\n{p}") for p, r in plain.items())]:
        wanted[prompt] = min(wanted.get(prompt, response), response)
    assert {r.prompt: r.response for r in found.collect()} == wanted
