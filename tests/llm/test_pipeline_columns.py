"""Stages of the pipeline over tables with awkward rows and clashing columns."""

import collections
import random

import pytest

import corpus_pipeline

#: Names that the stages and their operators use themselves.
CLASHING = ("n_words kept perplexity lower upper base_failed m row doc failed step low high _hash hash component text_hash e digest rep least pseudonyms _found kinds "
            "size source_size source_rank weight target taken positions position order_hash before copies closes of missing _part _row near last").split()


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(17)
    words = [f"w{i}" for i in range(300)]
    text = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(60, 120)))
    rows = [(i, text(), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", None])) for i in range(60)]
    rows += [(100, rows[0][1], "en", "a"), rows[1], rows[1], (None, text(), None, None), (None, text(), "en", "b"), (200, None, "en", "a"), (201, "", "en", "a"),
             (202, "call 4111 1111 1111 1111 " + text(), "en", "a"), (203, text() * 40, "de", "b")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, 7, *[f"{c}!" for c in CLASHING]) for r in rows], schema)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_of_the_caller_come_through(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, "")
    assert out.columns == docs.columns and out.schema == docs.schema
    rows = out.collect()
    assert rows and all(r[c] == f"{c}!" for r in rows for c in CLASHING) and all(r["n_chars"] == 7 for r in rows)
    known = collections.Counter((r["doc_id"], r["lang"], r["source"]) for r in docs.collect())
    assert all((r["doc_id"], r["lang"], r["source"]) in known for r in rows)
    if name == "pii":
        assert len(rows) == docs.count()
        texts = {r["doc_id"]: r["text"] for r in rows}
        assert texts[200] is None and texts[201] == "" and "4111 1111 1111 1111" not in texts[202]
    empty = stage(spark, docs.limit(0), "")
    assert empty.columns == docs.columns and empty.count() == 0


def test_pseudonym_key_of_the_session(spark, docs):
    stage = dict(corpus_pipeline.STAGES)["pii"]
    found = []
    for key in (None, "one", "two"):
        if key:
            spark.conf.set("spark.corpus.pseudonymKey", key)
        found.append({r["doc_id"]: r["text"] for r in stage(spark, docs, "").collect()}[202])
    spark.conf.unset("spark.corpus.pseudonymKey")
    assert len(set(found)) == 3


def test_last_stage_over_awkward_rows(spark, docs):
    packed = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, docs, "")
    assert packed.selectExpr("count(distinct sequence_id)").first()[0] >= 1
    assert dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, docs.limit(0), "").count() == 0
