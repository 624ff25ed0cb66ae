"""Substring dedup by line and sentence hashing (``op9_unit_dedup``).

Units of a text are its lines and the sentences inside them, so a passage pasted into the middle of a line
is found by the sentences it holds. A unit is normalised (A-Z lower-cased, white space collapsed and trimmed) and gets a
128-bit digest. Digests are grouped over all documents; the earliest occurrence by (doc_id, start) stays,
every other one is reported with its place in the original text. Lines count from ``LINE_WORDS`` words on and sentences from
``SENTENCE_WORDS``: shorter ones repeat by chance.

Grouping is a plain aggregate (combined in each task, so a unit that fills a third of the corpus is one row per task),
and only digests that repeat go into the join that finds the later occurrences. Its other side, the unit
rows, can be split where one digest is hot; no group is ever gathered.

Null and empty texts have no units. Rows with equal id and start are one occurrence (so an exact repeat of a row
removes nothing from it); a null id ranks first. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm import kit

LINE_WORDS = 5
SENTENCE_WORDS = 8
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?"]] = True
SCHEMA = "doc_id long, high long, low long, line boolean, line_start int, start int, stop int"


def units(data: np.ndarray, offsets: np.ndarray, line_words: int, sentence_words: int):
    """Row, two digests, whether a line, start of its line, start and end (code points) of every unit."""
    starts, ends, owner = kit.word_spans(data, offsets)
    if not len(starts):
        return None
    breaks = np.concatenate([[0], np.cumsum((data == 10) | (data == 13))])
    first_of_line = np.ones(len(starts), bool)
    first_of_line[1:] = (owner[1:] != owner[:-1]) | (breaks[starts[1:]] != breaks[ends[:-1]])
    first_of_sentence = first_of_line.copy()
    first_of_sentence[1:] |= ENDS[data[ends[:-1] - 1]]
    hashes = kit.word_hashes(data, starts, ends)
    other = kit.mix(hashes ^ kit.INVERSE) + kit.span_hashes(kit.LOWER_VALUES[data] * kit.INVERSE + np.uint64(5), starts, ends)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lines = np.flatnonzero(first_of_line)
    sentences = np.flatnonzero(first_of_sentence)
    line_ends, sentence_ends = np.append(lines[1:], len(starts)), np.append(sentences[1:], len(starts))
    inner = ~(first_of_line[sentences] & (np.append(first_of_line, True)[sentence_ends]))  # no whole line
    long = sentence_ends - sentences >= sentence_words
    line_long = line_ends - lines >= line_words
    first = np.concatenate([lines[line_long], sentences[inner & long]])
    last = np.concatenate([line_ends[line_long], sentence_ends[inner & long]])
    is_line = np.arange(len(first)) < line_long.sum()
    line_of = lines[np.searchsorted(lines, first, "right") - 1]
    row = owner[first]
    base = points[offsets[row]]
    return (
        row, kit.span_hashes(hashes, first, last), kit.span_hashes(other, first, last), is_line,
        points[starts[line_of]] - base, points[starts[first]] - base, points[ends[last - 1]] - base,
    )


def unit_rows(docs: DataFrame, line_words: int, sentence_words: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kit.slices(batch):
                found = units(*kit.raw(part.column(1)), line_words, sentence_words)
                if found is None:
                    continue
                row, high, low, is_line, line_start, start, stop = found
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(is_line)]
                    + [pa.array(x.astype(np.int32)) for x in (line_start, start, stop)],
                    names=["doc_id", "high", "low", "line", "line_start", "start", "stop"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, SCHEMA)


def repeated_units(docs: DataFrame, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS) -> DataFrame:
    """One row for each occurrence to remove: doc_id, start, stop (code points), line, and where the unit stays (keep_doc_id, keep_start).

    A sentence is left out where its whole line goes.
    """
    found = unit_rows(docs, line_words, sentence_words)
    place = F.struct("doc_id", "start")
    first = found.groupBy("high", "low").agg(F.min(place).alias("kept"), F.max(place).alias("last"))
    first = first.where(~F.col("kept").eqNullSafe(F.col("last"))).select("high", "low", "kept")
    later = found.join(first, ["high", "low"]).where(~place.eqNullSafe(F.col("kept")))
    same_line = Window.partitionBy("doc_id", "line_start")
    return (
        later.withColumn("whole", F.max("line").over(same_line))
        .where(F.col("line") | ~F.col("whole"))
        .select("doc_id", "start", "stop", "line", F.col("kept.doc_id").alias("keep_doc_id"), F.col("kept.start").alias("keep_start"))
    )


def remove_units(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with the reported places cut out of ``text`` and ``kept``, the (start, stop) of what is left in the original text."""
    spans = repeated.groupBy(F.col("doc_id").alias("__id")).agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("__cut"))
    both = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    size = F.length("text")
    edge = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("left"))

    def step(a, s):
        gap = F.when(s["start"] > a["at"], F.array(F.struct(a["at"].alias("start"), s["start"].alias("stop")))).otherwise(F.array())
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.concat(a["left"], gap).alias("left"))

    def end(a):
        tail = F.when(size > a["at"], F.array(F.struct(a["at"].alias("start"), size.alias("stop")))).otherwise(F.array())
        return F.concat(a["left"], tail)

    kept = F.aggregate(F.coalesce(F.col("__cut"), F.array()), edge, step, end)
    pieces = F.transform(F.col("kept"), lambda s: F.substring(F.col("text"), s["start"] + 1, s["stop"] - s["start"]))
    return both.withColumn("kept", kept).withColumn("text", F.when(F.col("__cut").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))).drop("__cut")


def op9_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(kit.tables(spark, sf_dir, "documents"))


ORACLE = rf"""
with lines as (select doc_id, unnest(string_split_regex(text, '[\n\r]')) as line, unnest(range(1, len(string_split_regex(text, '[\n\r]')) + 1)) as nr
  from documents where text is not null),
placed as (select doc_id, nr, line, sum(length(line) + 1) over (partition by doc_id order by nr) - length(line) - 1 as pos from lines),
body as (select doc_id, nr, cast(pos + length(regexp_extract(line, '^[\t-\r ]*')) as int) as line_start,
  regexp_replace(line, '^[\t-\r ]+|[\t-\r ]+$', '', 'g') as line from placed),
pieces as (select doc_id, nr, line_start, line, unnest(regexp_extract_all(line, '.*?[.!?](?:[\t-\r ]+|$)|.+$')) as piece,
  unnest(range(1, len(regexp_extract_all(line, '.*?[.!?](?:[\t-\r ]+|$)|.+$')) + 1)) as part,
  len(regexp_extract_all(line, '.*?[.!?](?:[\t-\r ]+|$)|.+$')) as parts from body),
sentences as (select doc_id, nr, line_start, false as line, parts, regexp_replace(piece, '[\t-\r ]+$', '') as unit,
  cast(line_start + sum(length(piece)) over (partition by doc_id, nr order by part) - length(piece) as int) as start from pieces),
units as (select doc_id, line_start, line, unit, start from sentences where parts > 1
    and len(regexp_extract_all(unit, '[^\t-\r ]+')) >= {SENTENCE_WORDS}
  union all select doc_id, line_start, true, line, line_start from body where len(regexp_extract_all(line, '[^\t-\r ]+')) >= {LINE_WORDS}),
keyed as (select doc_id, line_start, line, start, cast(start + length(unit) as int) as stop,
  translate(regexp_replace(unit, '[\t-\r ]+', ' ', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from units),
ranked as (select *, first(doc_id) over w as keep_doc_id, first(start) over w as keep_start from keyed window w as (partition by key order by doc_id, start)),
later as (select *, max(line) over (partition by doc_id, line_start) as whole from ranked where doc_id <> keep_doc_id or start <> keep_start)
select doc_id, start, stop, line, keep_doc_id, keep_start from later where line or not whole
"""

QUERIES = {"op9_unit_dedup": op9_unit_dedup}
ORACLE_SQL = {"op9_unit_dedup": ORACLE}
