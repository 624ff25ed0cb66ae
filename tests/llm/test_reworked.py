"""Operators against slow twins: convolution, redaction, short benchmark items, bounds of the approximation file, pipeline stages."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.llm import decontaminate, html_density, kit, secrets, toxicity, vafile

corpus_pipeline = pytest.importorskip("corpus_pipeline")

# 8 ----------------------------------------------------------------------------------------------------------------


def test_pooling_is_a_convolution_with_maximum():
    rng = np.random.default_rng(4)
    net = toxicity.Network(rng)
    sizes = [0, 1, 2, 3, 0, 9, 1, 4]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    numbers = rng.integers(0, 6, (bounds[-1], 3)).astype(toxicity.NUMBER)  # few words, so that maxima tie
    best, at = net.pooled(net.vectors(numbers), bounds, where=True)
    for row, size in enumerate(sizes):
        words = [sum(net.table[int(b)] for b in numbers[bounds[row] + i]) for i in range(size)]
        for i, (w, bank) in enumerate(zip(toxicity.WIDTHS, net.banks)):
            for f in range(toxicity.FILTERS):
                answers = [sum(float(words[p + k] @ bank[k][:, f]) for k in range(w)) for p in range(size - w + 1)]
                place = i * toxicity.FILTERS + f
                top = max(answers, default=0.0)
                assert best[row, place] == pytest.approx(max(top, 0), abs=1e-5)
                if top > 1e-5:
                    assert answers[at[row, place] - bounds[row]] == pytest.approx(top, abs=1e-5)
                elif top < -1e-5 or not answers:
                    assert at[row, place] == -1


def test_training_lowers_the_loss_of_a_plain_task():
    rng = np.random.default_rng(2)
    numbers = rng.integers(0, 500, (3000, 3)).astype(toxicity.NUMBER)
    bounds = np.arange(0, 3001, 10)
    labels = (np.add.reduceat((numbers[:, 0] < 12).astype(int), bounds[:-1]) > 0).astype(np.int64)
    net = toxicity.train(numbers, bounds, labels)
    found = net.odds(numbers, bounds)
    assert found[labels == 1].min() > np.quantile(found[labels == 0], 0.95)


# 6 ----------------------------------------------------------------------------------------------------------------


def test_redaction_of_many_spans(spark):
    rng = random.Random(1)
    parts = [rng.choice(["token=abcdefgh ", "ä plain word ", "0123456789abcdef0123456789 ", "password='hunter22'", "AKIA" + "B" * 16 + " ", "😀 "]) for _ in range(3000)]
    texts = ["".join(parts), "nothing here", "secret: " + "x" * 9000 + " end", None, "", "token=token=abcdefgh0123456789abcdef01234567"]
    rows = [(i, t, 1 if t is None else len(t), "s") for i, t in enumerate(texts)] + [(0, texts[0], len(texts[0]), "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    held = {r.doc_id: r.spans for r in secrets.scan(docs).collect()}
    assert len(held[0]) > 1500

    def cut(text, spans):
        out, at = "", 0
        for start, _, end in sorted(spans):
            if start >= at:
                out, at = out + text[at:start] + "[SECRET]", end
            at = max(at, end)
        return out + text[at:]

    got = sorted(((r.doc_id, r.text, r.n_chars, r.spans) for r in secrets.redact(docs).collect()), key=repr)
    want = [(i, t if t is None or not held[i] else cut(t, held[i]), n, s) for i, t, n, s in rows]
    want = [(i, t, n if t is None or not held[i] else len(t), s) for i, t, n, s in want]
    assert got == sorted(want, key=repr)
    plan = secrets.scan(docs)._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.split("\n") if "Generate explode" in line and "hits" in line)
    assert "text#" not in generate  # what is exploded holds numbers alone


# 5 ----------------------------------------------------------------------------------------------------------------


def test_short_items_stand_whole(spark):
    items = [(1, "Maple"), (2, "What is it?"), (3, "漢字文"), (4, " \n"), (5, None), (6, "Maple"), (7, "a")]
    docs = [(1, "A maple tree."), (2, "maples and Mapleton"), (3, "So: what  is\nit? Yes"), (4, "これは漢字文です"), (5, "somewhat is it?"), (6, None), (7, "b MAPLE")]
    found = decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id, r.distance) for r in found.collect()}
    assert got == {(1, 1, 0), (1, 6, 0), (1, 7, 0), (3, 2, 0), (4, 3, 0), (7, 1, 0), (7, 6, 0)}
    first = {(r.doc_id, r.item_id): (r.start, r.stop) for r in found.collect()}
    assert first[3, 2] == (4, 16) and first[1, 7] == (0, 1)


def test_blocks_are_searched_one_after_the_other(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    alive, most = set(), []
    context = type(spark.sparkContext)
    make = context.broadcast

    def counted(self, value):
        sent = make(self, value)
        if isinstance(value, list):
            alive.add(id(sent))
            most.append(len(alive))
            destroy = sent.destroy
            sent.destroy = lambda: (alive.discard(id(sent)), destroy())
        return sent

    monkeypatch.setattr(context, "broadcast", counted)
    items = spark.createDataFrame([(i, f"item number {i} of the benchmark, long enough to be told apart") for i in range(5)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"x Item number {i} of the benchmark, long enough to be told apart y") for i in range(9)], "doc_id long, text string")
    rows = decontaminate.find_items(docs, items).where("distance = 0").collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(i, i) for i in range(5)]
    assert len(most) == 3 and max(most) == 1 and not alive
    # items differ by one digit, which the budget covers: every text holds all of them
    assert decontaminate.without_items(docs.unionByName(docs.limit(1).selectExpr("90L as doc_id", "'clean' as text")), items).collect() == [(90, "clean")]
    assert len(most) == 6 and max(most) == 1


# 3 ----------------------------------------------------------------------------------------------------------------


def test_bounds_hold_and_scores_are_exact_for_large_values():
    rng = np.random.default_rng(1)
    for most in (300, 2**29, 2**40):
        values = rng.integers(-most, most, (50, 4))
        width, cells = vafile.approximate(values, vafile.BITS)
        lower, upper = vafile.bounds(values[:5], width, cells)
        exact = [[sum(int(a) * int(b) for a, b in zip(q, v)) for v in values] for q in values[:5]]
        assert (lower <= np.array(exact, float)).all() and (upper >= np.array(exact, float)).all()
        rows = [(q, v, values[q].tolist(), values[v].tolist()) for q in range(5) for v in range(50)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())])], names=["rep", "entry", "q", "v"]
        )
        found = next(vafile.exact_scores(iter([batch])))
        assert found.column(2).to_pylist() == [min(max(x, -(1 << 63)), (1 << 63) - 1) for line in exact for x in line]


def test_few_exact_vectors_are_read(spark, monkeypatch):
    rng = np.random.default_rng(6)
    values = rng.normal(0, 1, (3000, 16)).astype(np.float32)
    values[700:1700] = values[5]  # one vector in a third of all rows
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(kit, "keep_only", lambda *_: None)
    held = []
    scratch = kit.scratch
    monkeypatch.setattr(kit, "scratch", lambda s: held.append(scratch(s)) or held[-1])
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vafile.top_k(table.where("vec_id % 50 = 0"), table).collect()}
    whole = np.floor(256 * values.astype(np.float64)).astype(np.int64)
    for q in range(0, 3000, 50):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:5]
        assert [got[q, n] for n in range(1, 6)] == [(i, int(scores[i])) for i in order]
    read = sum(spark.read.parquet(f"{held[0]}/{name}").count() for name in ("first", "second"))
    pairs = spark.read.parquet(f"{held[0]}/reps").count() * spark.read.parquet(f"{held[0]}/exact").count()
    assert read < 0.05 * pairs
    for name in ("cells",):
        assert "grid" not in spark.read.parquet(f"{held[0]}/{name}").columns


# pipeline ----------------------------------------------------------------------------------------------------------

CLEAN = "The harbour was quiet that morning and the boats lay still along the wall while gulls went round number"
ITEM = "A question of the benchmark that nobody should find in any training text, word for word or nearly so."


def documents(spark):
    rows = [(i, f"{CLEAN} {i}. Then page {i * 7} told of {i * 13} other things, one after {i * 31} and so on to the end {i}.") for i in range(40)]
    rows += [(100, rows[3][1]), (101, rows[3][1] + " tail"), (102, rows[3][1]), (200, f"Before. {ITEM} After, more words follow here."), (201, f"{ITEM.upper()}x")]
    rows += [(300, "Words and password = hunter2222 and more words of this text."), (None, "no id"), (400, None), (401, ""), (402, "  \n")]
    rows += [(500 + i, f"you vile rotten fool {i} go away now you rotten thing {i * 3}") for i in range(20)]
    frame = spark.createDataFrame([(i, t, "en", f"s{n % 3}", 0 if t is None else len(t), 1.0, True, "k") for n, (i, t) in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, n_chars long, toxic_score double, toxic_flag boolean, component_id string")
    return frame.repartition(3)


@pytest.fixture
def stage_folder(spark, tmp_path):
    labels = [(i, 1, 0) for i in range(40)] + [(500 + i, 0, 1) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_pipeline_stage_by_stage(spark, stage_folder):
    docs = spark.read.parquet(f"{stage_folder}/documents.parquet")
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)
    calm = corpus_pipeline.drop_toxic(spark, docs, stage_folder)
    assert calm.columns == docs.columns
    toxic = {i for i in range(500, 520)}
    assert set(ids(docs)) - set(ids(calm)) == toxic  # the clean rows, null and empty ones among them, stay
    calm = docs.where(~F.coalesce(F.col("doc_id") >= 500, F.lit(False)))
    unique = corpus_pipeline.drop_near_duplicates(spark, calm, stage_folder)
    assert unique.columns == docs.columns and set(ids(calm)) - set(ids(unique)) == {100, 101, 102}
    pure = corpus_pipeline.drop_contaminated(spark, unique, stage_folder)
    assert pure.columns == docs.columns and set(ids(unique)) - set(ids(pure)) == {200, 201}
    safe = corpus_pipeline.redact_secrets(spark, pure, stage_folder)
    assert safe.columns == docs.columns and ids(safe) == ids(pure)
    changed = {r.doc_id: r for r in safe.where(F.col("text").contains("[SECRET]")).collect()}
    assert set(changed) == {300} and changed[300].text == "Words and [SECRET] and more words of this text." and changed[300].n_chars == len(changed[300].text)
    encoded = corpus_pipeline.encode_pieces(spark, safe, stage_folder)
    assert ids(encoded) == ids(safe)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "sentencepiece"]


def test_pipeline_from_end_to_end(spark, stage_folder, tmp_path):
    left = {r.doc_id for r in corpus_pipeline.run(spark, stage_folder).collect()}
    assert left == {*range(40), 300, None, 400, 401, 402}
    empty = tmp_path / "empty"
    for name in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{stage_folder}/{name}.parquet").limit(0).write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


# 4 ----------------------------------------------------------------------------------------------------------------

LONG = "This paragraph is part of the article and long enough to be dense with text, one clause after the other."


def test_article_without_article_tag_comes_back_whole():
    page = (
        "<body><nav><a href=x>Home</a></nav><div id='content'><h1>Title</h1>"
        f"<h2 id='search'>Search</h2><p>{LONG}</p><section id='social-history'><h3>Social history</h3><p>{LONG}</p></section>"
        f"<h2><span id='Related_work'>Related work</span></h2><p class='legal'>{LONG}</p><h2 class='section-header'>Header</h2><p id='notice'>{LONG}</p>"
        "<p>Then <math><mi>x</mi>=1</math> and <label>so</label> holds.</p><p class='reply-quote'>As a reply he said no.</p></div>"
        "<div class='sidebar'><p>Read this other long text that is no part of the article at all.</p></div>"
        f"<p class='cookie-notice'>We use cookies.</p><div class='comments'><p>{LONG} I disagree.</p></div><footer>(c)</footer></body>"
    )
    want = ["Title", "Search", LONG, "Social history", LONG, "Related work", LONG, "Header", LONG, "Then x=1 and so holds.", "As a reply he said no."]
    assert html_density.main_text(page).split("\n\n") == want


def slow_density(page, node):
    """Composite density of a node from all of its descendants, by the formula."""
    import math

    def below(n):
        found = [n]
        for child in range(1, len(page.parent)):
            if page.parent[child] == n:
                found += below(child)
        return found

    def counted(n):
        inside = [x for x in below(n) if not page.out[x]]
        texts = [(x, "".join(t.split())) for x, t in page.runs if x in inside]
        links = [x for x in inside if x != n and page.name[x] == "a"]
        return sum(len(t) for _, t in texts), sum(len(t) for x, t in texts if page.link[x]), len(inside) - 1, len(links)

    c, lc, t, lt = counted(node)
    body_c, body_lc, _, _ = counted(page.body)
    if not c or page.out[node]:
        return 0.0
    t, lt = max(t, 1), max(lt, 1)
    base = max(math.log(c / max(c - lc, 1) * lc + body_lc / max(body_c, 1) * c + math.e), 1.001)
    return c / t * math.log(1 + c / max(lc, 1) * t / lt) / math.log(base)


def test_densities_follow_the_formula():
    rng = random.Random(9)

    def part(depth):
        if depth == 0 or rng.random() < 0.2:
            return "word " * rng.randrange(0, 12)
        name = rng.choice(["div", "p", "a", "ul", "li", "span", "nav", "section"])
        return f"<{name}>" + "".join(part(depth - 1) for _ in range(rng.randrange(1, 4))) + f"</{name}>"

    for _ in range(25):
        page = html_density.Page("<body>" + part(5) + "tail</body>")
        _, _, density, total = page.measured()
        slow = [slow_density(page, n) for n in range(len(page.parent))]
        assert density == pytest.approx(slow)
        for node in range(len(page.parent)):
            kids = [n for n in range(1, len(page.parent)) if page.parent[n] == node]
            assert total[node] == pytest.approx(sum(slow[k] for k in kids) if kids else slow[node])


# 2 ----------------------------------------------------------------------------------------------------------------


def test_chances_do_not_depend_on_the_length_of_a_unit():
    import public_tokenizers

    from textmill.llm import pieces

    vocab = pieces.Vocabulary(public_tokenizers.path(pieces.VOCABULARY))
    word = "thenthereintheother"

    def chances(text):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        return pieces.lattice(vocab, pieces.VALUES[points][None], 1.0, True)[1][0]

    short, long = chances(word * 4), chances(word * 4000)
    assert np.abs(short[-len(word) :] - long[-len(word) :]).max() < 1e-5
