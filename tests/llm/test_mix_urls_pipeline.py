"""Mixing, the URL filter and the pipeline."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import language, mixing, pieces, urls
from tests.conftest import plan
from tests.llm.test_text_operators import SCHEMA, SF_DIR, SPACE, _components, _sets, odd_texts, words_of


def _targets(sizes):
    """Rounds of giving out what is left by weight, until nobody is above the limit."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        share = sum(w for s, w in weight.items() if s not in full)
        level = {s: left * w / share for s, w in weight.items() if s not in full} if share else {}
        over = [s for s in level if level[s] > 3 * sizes[s]]
        if not over:
            return {**full, **level}
        for s in over:
            full[s] = 3 * sizes[s]


def _planned(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.stored(mixing.sizes(df), "sizes")
    plan_ = mixing.plan_mix(sized, group=7)
    return df, plan_, plan_.withColumn("taken", mixing.words_taken()).collect()


@pytest.mark.parametrize("shape", ["even", "skewed", "single", "odd"])
def test_targets_and_what_is_taken(spark, shape):
    if shape == "odd":
        rows = [(i, t, None if i % 4 == 0 else f"s{i % 3}") for i, t in enumerate(odd_texts())] + [(1, "word", "s1")] * 3
    else:
        rows = [(i, " ".join(["w"] * (i * 13 % 40)), {
            "even": f"s{i % 5}", "skewed": "hot" if i % 3 else f"s{i % 11}", "single": "one"}[shape]) for i in range(300)]
    _, _, got = _planned(spark, rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    want = _targets(sizes)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(taken[s] == int(want[s] + 1e-9) for s in taken)


def test_every_document_starts_where_the_one_before_ends(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "hot" if i % 3 else "cold") for i in range(200)]
    _, _, got = _planned(spark, rows)
    for source in ("hot", "cold"):
        at = 0
        for r in sorted((r for r in got if r.source == source), key=lambda r: (r.mark, r.id)):
            assert r.start == at and r.mark == hashlib.md5(str(r.id).encode()).hexdigest()
            at += r.size


def test_positions_follow_the_curriculum(spark):
    rows = [(i, " ".join(["w"] * 10), f"s{i % 3}") for i in range(900)]
    _, planned, _ = _planned(spark, rows)
    due = mixing.copies(planned).collect()
    assert [r.position for r in due] == sorted(r.position for r in due) and 0 <= due[0].position and due[-1].position < 1
    for r in due[::50]:  # the integral of the weight up to the position is what stands in front
        demand = r.target * (r.position + r.slope * (r.position ** 2 - r.position))
        assert demand == pytest.approx(r["round"] * r.source_size + r.start, abs=1e-6)
    early = [sum(r.source == s and r.position < 0.5 for r in due) / sum(r.source == s for r in due) for s in ("s0", "s1", "s2")]
    assert early[0] > 0.55 and early[1] == pytest.approx(0.5, abs=0.02) and early[2] < 0.45
    assert "rangepartitioning" in plan(mixing.copies(planned)) and "Python" not in plan(mixing.copies(planned))


def test_mixed_documents_repeat(spark):
    rows = [(i, " ".join([f"w{i}"] * 10), "big" if i < 300 else "small") for i in range(310)] + [(0, " ".join(["w0"] * 10), "big")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("position", F.lit("kept"))
    out = mixing.mix(df)
    assert out.columns == df.columns
    count = {r.source: (r["count"], r.d) for r in out.groupBy("source").agg(
        F.count("*").alias("count"), F.countDistinct("doc_id").alias("d")).collect()}
    assert count["small"] == (30, 10)  # three times each
    assert count["big"][0] == 281
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert mixing.mix(blank).count() == 0 and {r.taken for r in _planned(spark, [(1, None, None), (2, " ", "a")])[2]} == {0}


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1", "https://example.org/es", "https://example.org/es/x?y#z",
    "https://a.example.org/en/1999", "https://a.example.org/en/2", "https://notexample.org/es/1", "https://x.com/fr/1",
    "https://com/de/5", "https://x.com/de?a=/de/", "https://y.net/fr/1", "https://free-bets.example.net/en/24",
    "https://garden.example.net/en/24#top", "ftp://h?x", "http://h#y", "https://org", "https://adult-x.example.com/en/31"]


def _rule(url):
    """Host, path and the longest rule that fits."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        tail = rest[len(host):]
        path = re.match(r"[^?#]*", tail)[0]
        host = host.translate({c: c + 32 for c in range(65, 91)})
    found = (None, None)
    for verdict, rule in urls.RULES:
        rule_host, _, rule_path = rule.partition("/")
        fits = (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path)
        if fits and (found[0] is None or len(rule) > len(found[0])):
            found = (rule, verdict)
    return host, path, *found


@pytest.fixture(scope="module")
def model(spark):
    return urls.train(spark)


def test_rules_and_the_model_for_the_rest(spark, model):
    pages = spark.createDataFrame([(i, u, "old", "x") for i, u in enumerate(URLS)], "page_id long, url string, host string, score string")
    got = {r.page_id: r for r in urls.judge_urls(pages, model).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = _rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (verdict or ("block" if got[i].p_block >= model.limit else "allow")) and got[i].score == "x"
    assert got[14].verdict == "block" and got[15].verdict == "allow" and got[19].verdict == "block"
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(empty, model).count() == 0


def test_model_works_in_a_session_that_observes_metrics(spark, model):
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    pages = spark.createDataFrame([(1, "https://h.example.net/en/1")], "page_id long, url string")
    assert urls.judge_urls(pages, urls.train(spark)).count() == urls.judge_urls(pages, model).count() == 1
    assert len(urls.judge_urls(pages, urls.train(spark)).collect()) == 1


FAMILIES = ("free-bets", "adult-x", "casino-win", "cheap-pills", "spam-farm", "ads-track")


def test_model_learns_its_table_and_tells_hosts_apart(spark, model):
    labelled = urls.labelled_table()
    assert len(set(labelled)) == len(labelled) > 500 and not any(f in url for url, _ in labelled for f in FAMILIES)
    table = spark.createDataFrame(labelled, "url string, label int")
    rows = urls.judge_urls(table, model, rules=()).collect()
    assert sum((r.verdict == "block") == bool(r.label) for r in rows) >= 0.99 * len(rows)
    judged = urls.judge_urls(spark.read.parquet(f"{SF_DIR}/../sf0.1/pages.parquet").select("page_id", "url"), model, rules=())
    family = F.regexp_extract("host", "|".join(FAMILIES), 0)
    found = {r.f: (r.blocked, r.n) for r in judged.groupBy(family.alias("f")).agg(
        F.sum((F.col("verdict") == "block").cast("int")).alias("blocked"), F.count("*").alias("n")).collect()}
    for name in FAMILIES:
        assert found[name][0] >= 0.9 * found[name][1] > 0, (name, found)
    assert found[""][0] <= 0.02 * found[""][1], found


def test_grams_are_all_pieces_of_three_to_five(spark):
    df = spark.createDataFrame([("ab-cd",), ("",), ("é🙂",)], "t string")
    for text, got in df.select("t", urls.grams(F.col("t"))).collect():
        marked = f"^{text}$"
        assert got == [marked] + [marked[i:i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)]


def test_regression_equals_one_by_newton_steps(spark):
    labelled = urls.labelled_table()[::9]
    model = urls.train(spark, labelled, buckets=256, penalty=0.01)
    table = spark.createDataFrame(labelled, "url string, label int")
    host, path = urls.url_parts(F.col("url"))
    rows = urls.features(table.select("url", "label", host.alias("host"), path.alias("path")), 256).collect()
    x, y = np.array([[*r.features.toArray(), 1.0] for r in rows]), np.array([r.label for r in rows], float)
    ridge = np.diag([0.01] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + ridge + 1e-12 * np.eye(len(w)), x.T @ (p - y) / len(y) + ridge @ w)
    want = 1 / (1 + np.exp(-x @ w))
    by_url = dict(zip((r.url for r in rows), want))
    assert max(abs(r.p_block - by_url[r.url]) for r in urls.judge_urls(table, model, rules=(), buckets=256).collect()) < 0.01
    weights = urls.small_fit([r.features.indices.tolist() for r in rows], y, x.shape[1] - 1, 0.01, steps=600)
    assert abs(1 / (1 + np.exp(-x @ weights)) - want).max() < 0.01


def _pipeline(rows, vocabulary_model):
    """All stages on the driver; the language model's verdicts are given as ids to keep."""
    groups = {}
    for r in rows:
        groups.setdefault(SPACE.sub("", r.text or ""), []).append(r)
    rows = [min(g, key=lambda r: (-len(r.text or ""), r.doc_id)) for g in groups.values()]
    kept = {i for i, _, c in _components(_sets([(r.doc_id, r.text) for r in rows])) if i == c}
    rows = [r for r in rows if r.doc_id in kept]
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(words_of(r.text))
    target, due = _targets(sizes), []
    for source in sizes:
        own = sorted((r for r in rows if r.source == source), key=lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id))
        for step in range(3):
            at = step * sizes[source]
            for r in own:
                n = len(words_of(r.text))
                if n and 2 * at + n <= 2 * target[source]:
                    due.append((r.doc_id, tuple(vocabulary_model.encode(r.text))))
                at += n
    return sorted(due)


def test_pipeline(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "source_mix", "sentencepiece"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = language.keep_known_languages(docs).collect()
    assert len(known) >= 0.95 * docs.count()
    got = sorted((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == _pipeline(known, sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH))


def test_stages_take_odd_tables(spark):
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 4}", None, "id", "no", 1, 2) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows + rows[6:9], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() > 0 and stage(spark, empty, SF_DIR).count() == 0, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF_DIR).count() == docs.count() and last(spark, empty, SF_DIR).count() == 0


def test_held_out_remainders(spark):
    from lakestrata.llm.frames import remainder
    df = spark.createDataFrame([(0,), (17,), (-3,), (None,)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", remainder("doc_id", 7).alias("m")).collect()}
    assert all(m == zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, m in got.items())
