"""Operators and stages on tables whose other columns have the names that operators use inside."""

import pytest

import corpus_pipeline
from lakestrata.llm import codes, exact, hosts, jaccard, merkle, passages, secrets, substrings, urls
from tests.llm.test_text_operators import SF_DIR, odd_texts

NAMES = ("__id __times __key __kept __digest raw said host_grams features ids id key row node group text_key digest due_id "
         "kept_id time times bits score prediction probability c0 size component").split()


@pytest.fixture(scope="module")
def docs(spark):
    texts = odd_texts()
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 3}", i, *range(len(NAMES))) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[8:10], "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{name}` int" for name in NAMES))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, stage):
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_DIR)
    assert out.count() > 0
    if stage != "sentencepiece":
        assert out.dtypes == docs.dtypes
        assert {tuple(r)[5:] for r in out.collect()} == {tuple(range(len(NAMES)))}


@pytest.mark.parametrize("run", [
    exact.exact_groups, jaccard.similar_groups, merkle.manifest, secrets.scan, hosts.judge, passages.remove_earlier,
    substrings.remove_repeated,
])
def test_operators(docs, run):
    assert run(docs).count() == docs.count()


def test_urls_keep_other_columns(spark):
    names = [n for n in NAMES if n not in ("host", "path")]
    pages = spark.createDataFrame([(1, "https://a.example.net/en", *range(len(names)))] * 2,
                                  "page_id long, url string, " + ", ".join(f"`{n}` int" for n in names))
    out = urls.judge_urls(pages, urls.train(spark)).collect()
    assert len(out) == 2 and [out[0][n] for n in names] == list(range(len(names)))


def test_vectors(spark):
    vectors = spark.createDataFrame([(i, [float(i)] * 8, 1, *range(len(NAMES))) for i in range(20)],
                                    "vec_id long, embedding array<float>, label int, " + ", ".join(f"`{n}` int" for n in NAMES))
    assert codes.compress(vectors).count() == 20
