import math
import random
import re
from collections import Counter

import pytest

from textmill.operators import tfidf


def grams(tokens, low, high):
    return [" ".join(tokens[i : i + n]) for n in range(low, high + 1) for i in range(len(tokens) - n + 1)]


def tokens(text):
    return re.findall(r"\b\w\w+\b", text.lower())


def brute_scores(text, corpus):
    df = Counter(t for d in corpus for t in set(grams(tokens(d), 1, 3)))
    counts = Counter(grams(tokens(text.lower().replace("\n", "")), 1, 3))
    weights = {t: c * (math.log((1 + len(corpus)) / (1 + df[t])) + 1) for t, c in counts.items() if t in df}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {t: w / norm for t, w in weights.items()}


def brute_rank(text, corpus, minimum, low, high):
    """Every stretch of ``low`` to ``high`` words that the text spells, tested one by one."""
    known = brute_scores(text, corpus)
    words = text.lower().replace("\n", "").split()
    spelt = {" ".join(words[a:b]) for b in range(len(words) + 1) for a in range(b) if low <= b - a <= high}

    def score(phrase):
        return known[phrase] if known.get(phrase, 0) > minimum else 0.0

    def wanted(phrase):
        return len(spelt) < low or score(phrase) >= minimum

    return [(p, score(p)) for p in sorted(filter(wanted, spelt), key=lambda p: (-score(p), p))]


def random_corpus(seed, n, words="aa bb cc dd ee x".split()):
    rng = random.Random(seed)
    return ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", ", "]) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_every_term_of_the_sample_counts(sample_corpus):
    texts = [r.text for r in sample_corpus.collect()]
    assert tfidf.document_frequency(sample_corpus).count() == len({t for x in texts for t in grams(tokens(x), 1, 3)})


def test_sample_scores(spark, sample_corpus):
    texts = [r.text for r in sample_corpus.orderBy("doc_id").collect()]
    asked = ["seven green boats at dawn", "The quiet\nharbour, a wall"]
    found = {}
    for r in tfidf.tfidf_scores(frame(spark, asked), sample_corpus, 0.0).collect():
        found.setdefault(r.doc_id, {})[r.term] = round(r.score, 9)
    assert found == {i: {t: round(s, 9) for t, s in brute_scores(x, texts).items()} for i, x in enumerate(asked)}


def test_accessors(spark):
    docs = frame(spark, ["Rain, rain on the slate roof.", "The roof holds."])
    counts = {(r.doc_id, r.term): r.tf for r in tfidf.term_frequency(docs).collect()}
    assert counts[0, "rain"] == 2 and counts[0, "rain rain"] == 1 and (1, "rain") not in counts
    weights = {r.term: r.idf for r in tfidf.idf(docs).collect()}
    assert weights["roof"] == pytest.approx(1.0) and weights["rain"] == pytest.approx(math.log(1.5) + 1)
    top = tfidf.top_terms(docs, docs, 2).where("doc_id = 0").orderBy("rank").collect()
    assert top[0].term == "rain" and [r["rank"] for r in top] == [1, 2]


def test_empty_and_single(spark):
    empty, single = frame(spark, []), frame(spark, ["single document only"])
    assert tfidf.tfidf_scores(single, empty, 0.0).count() == 0
    assert tfidf.tfidf_scores(empty, single, 0.0).count() == 0
    assert tfidf.tfidf_expanding(empty).count() == 0
    assert tfidf.tfidf_scores(single, single, 0.0).count() == 6


@pytest.mark.parametrize(("minimum", "low", "high"), [(0.2, 2, 10), (0.01, 1, 6), (0.2, 3, 3), (0.0, 2, 4), (0.3, 4, 10)])
def test_rank_matches_brute_force(spark, minimum, low, high):
    texts = random_corpus(low * 10 + high, 40)
    docs = frame(spark, texts)
    found = {}
    for r in tfidf.rank_phrases(docs, docs, minimum, low, high).collect():
        found.setdefault(r.doc_id, []).append((r["rank"], r.ngram, round(r.score, 9)))
    for i, text in enumerate(texts):
        wanted = [(n + 1, g, round(s, 9)) for n, (g, s) in enumerate(brute_rank(text, texts, minimum, low, high))]
        assert sorted(found.get(i, [])) == wanted


def test_expanding_matches_refits(spark, monkeypatch):
    from textmill.plans import ordering

    monkeypatch.setattr(ordering, "PROBES_PER_BLOCK", 2)  # several blocks even on few rows
    texts = random_corpus(5, 60)
    found = {}
    for r in tfidf.tfidf_expanding(frame(spark, texts), 0.1).collect():
        found.setdefault(r.doc_id, {})[r.term] = round(r.score, 9)
    for i, text in enumerate(texts):
        wanted = {t: round(s, 9) for t, s in brute_scores(text, texts[: i + 1]).items() if s > 0.1} if tokens(text) else {}
        assert found.get(i, {}) == wanted


@pytest.fixture
def many_slices(monkeypatch):
    """Slices and buckets of a few texts each."""
    for name, size in (("SLICE_TEXT", 60), ("BUCKET_TEXT", 90), ("TASK_TEXT", 150), ("BATCH_WORDS", 7)):
        monkeypatch.setattr(tfidf, name, size)


def exchanges(df):
    """Shuffles of the plan, with the rows that go through them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]


def by_doc(rows):
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, {})[r.term] = round(r.score, 9)
    return found


def test_scores_move_no_terms(spark, many_slices):
    """Rows of a text and a term went through two shuffles, by term and by text (F4)."""
    texts = [*random_corpus(1, 50), "Åsa Straße\nΣΑΣ 東京 tower, 東京 tower", "", None]
    docs = frame(spark, texts)
    scores = tfidf.tfidf_scores(docs, docs, 0.1)
    assert all("_slice" in x or "_bucket" in x for x in exchanges(scores))
    known = [t or "" for t in texts]
    wanted = {i: {t: round(s, 9) for t, s in brute_scores(x, known).items() if s > 0.1} for i, x in enumerate(known) if tokens(x)}
    assert by_doc(scores.collect()) == {i: w for i, w in wanted.items() if w}


def test_scores_against_another_corpus(spark, many_slices):
    corpus, asked = random_corpus(2, 40), random_corpus(3, 30, "aa bb zz ee x".split())
    found = by_doc(tfidf.tfidf_scores(frame(spark, asked), frame(spark, corpus), 0.0).collect())
    wanted = {i: {t: round(s, 9) for t, s in brute_scores(x, corpus).items()} for i, x in enumerate(asked) if brute_scores(x, corpus)}
    assert found == wanted


def test_rows_of_one_id_share_a_norm(spark, many_slices):
    docs = spark.createDataFrame([(1, "aa bb"), (1, "cc"), (None, "aa"), (None, "dd")], "doc_id long, text string")
    found = {}
    for r in tfidf.tfidf_scores(docs, docs, 0.0).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.score**2
    assert found == {1: pytest.approx(1.0), None: pytest.approx(1.0)}


def test_ranked_phrases_move_no_terms(spark, many_slices):
    """Every term of a text, phrase or not, was joined by term and ranked by text (F6)."""
    texts = [*random_corpus(4, 50), "aa", "Åsa Straße, aa", "", "aa  bb\naa bb"]
    docs = frame(spark, texts)
    ranked = tfidf.rank_phrases(docs, docs, 0.1, 2, 5)
    assert all("_slice" in x or "_bucket" in x or "doc_id" in x for x in exchanges(ranked))
    assert "Sort [_slice" in ranked._jdf.queryExecution().executedPlan().toString().split("regexp_extract_all")[-1]  # texts, not words
    found = {}
    for r in ranked.collect():
        found.setdefault(r.doc_id, []).append((r["rank"], r.ngram, round(r.score, 9)))
    for i, text in enumerate(texts):
        wanted = [(n + 1, g, round(s, 9)) for n, (g, s) in enumerate(brute_rank(text, texts, 0.1, 2, 5))]
        assert sorted(found.get(i, [])) == wanted


def test_top_terms_move_only_the_best(spark, many_slices):
    """All terms of all texts went to the ranking (F5)."""
    texts = random_corpus(6, 50)
    docs = frame(spark, texts)
    top = tfidf.top_terms(docs, docs, 3)
    assert not any("_salt" in x for x in exchanges(top))
    found = {}
    for r in top.collect():
        found.setdefault(r.doc_id, []).append((r["rank"], r.term, round(r.score, 9)))
    for i, text in enumerate(texts):
        scores = {t: round(s, 9) for t, s in brute_scores(text, texts).items()} if tokens(text) else {}
        best = sorted(scores, key=lambda t: (-scores[t], t))[:3]
        assert sorted(found.get(i, [])) == [(n + 1, t, scores[t]) for n, t in enumerate(best)]


def test_top_phrases_move_no_terms(spark, tmp_path):
    """(F9)"""
    from textmill.catalog import phrases

    frame(spark, random_corpus(7, 30)).write.parquet(f"{tmp_path}/documents.parquet")
    assert not any("_salt" in x for x in exchanges(phrases.top_phrases(spark, str(tmp_path))))


def test_expanding_moves_no_terms(spark, many_slices):
    """Running counts per term were sums over a window of all rows of a text and a term (F8)."""
    texts = [*random_corpus(8, 60), "", "Åsa Straße"]
    growing = tfidf.tfidf_expanding(frame(spark, texts), 0.1)
    assert all("_slice" in x or "_bucket" in x for x in exchanges(growing))
    found = by_doc(growing.collect())
    for i, text in enumerate(texts):
        wanted = {t: round(s, 9) for t, s in brute_scores(text, texts[: i + 1]).items() if s > 0.1} if tokens(text) else {}
        assert found.get(i, {}) == wanted


def test_document_frequency_moves_no_terms(spark, many_slices):
    """Terms went to their counts as text (F18, F22)."""
    texts = [*random_corpus(9, 60), "zz Åsa", "zz 東京", None]
    docs = frame(spark, texts)
    counted = tfidf.document_frequency(docs)
    assert all("_slice" in x or "_bucket" in x for x in exchanges(counted))
    found = [(r.term, r.df) for r in counted.collect()]
    assert sorted(found) == sorted(Counter(t for x in texts for t in set(grams(tokens(x or ""), 1, 3))).items())


def test_idf_report_takes_the_smallest_term_by_bytes(spark, tmp_path):
    from textmill.catalog import phrases

    frame(spark, ["zz", "Åsa", "東京", "qq qq", "qq"]).write.parquet(f"{tmp_path}/documents.parquet")
    report = phrases.QUERIES["idf"](spark, str(tmp_path))
    assert "first_term" in report.columns and "SortAggregate" not in report._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[-1]
    assert {r.df: (r.n_terms, r.first_term) for r in report.collect()} == {1: (4, "qq qq"), 2: (1, "qq")}


def _slice_of(texts):
    import pyarrow as pa

    return pa.table({"_fit": [tokens(t) for t in texts], "_score": [tokens(t.replace("\n", "")) for t in texts]})


def test_a_slice_is_gone_through_in_steps(monkeypatch):
    """All terms of a slice were held with their places at once, so slices were small and a term was sent once for each of them (F5, F8, F9)."""
    import numpy as np

    monkeypatch.setattr(tfidf, "STEP_WORDS", 40)
    texts = random_corpus(10, 80)
    table, groups = _slice_of(texts), np.repeat(np.arange(16), 5)
    steps = list(tfidf._steps(table, groups))
    assert len(steps) > 4 and sum(part.num_rows for _, part in steps) == 80
    assert all(start % 5 == 0 for start, _ in steps)  # texts of one id stay together
    hashes, counts = tfidf._counts(table)
    df = Counter(t for x in texts for t in set(grams(tokens(x), 1, 3)))
    scored = {t for x in texts for t in grams(tokens(x.replace("\n", "")), 1, 3)}
    assert sorted(counts.tolist()) == sorted([*df.values(), *[0] * len(scored - set(df))])
    assert (np.diff(hashes.view(np.uint64)) > 0).all() and np.array_equal(tfidf._hashes(table), hashes)


def test_ranked_phrases_to_a_rank(spark):
    """All phrases above the least score went to the ranking (F9); equal scores are decided there, also over rows of one id."""
    texts = random_corpus(11, 40)
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = lambda found: sorted((r.doc_id, r.ngram, round(r.score, 9), r["rank"]) for r in found.collect())
    whole = tfidf.rank_phrases(docs, docs, 0.01, 1, 6)
    assert rows(tfidf.rank_phrases(docs, docs, 0.01, 1, 6, top=3)) == [r for r in rows(whole) if r[3] <= 3]
