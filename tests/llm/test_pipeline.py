"""The pipeline's stages on small tables, each against what its operator says of the same rows."""

from __future__ import annotations

import pytest
from conftest import DATA

import corpus_pipeline
from loamworks.llm import linededup, quality, toxicity
from loamworks.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = table(spark, SF, "documents"), []
    top = tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(top / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns_and_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "line_dedup", "simhash_near_dedup", "best_fit_packing"]
    assert all(after.columns == COLUMNS for _, after in stages[:-1])


def test_filters_take_effect(spark, stages):
    labels, docs = table(spark, SF, "labels"), table(spark, SF, "documents")
    (before, after) = stages[0]
    grammar = toxicity.learn(docs, labels)
    assert ids(after) == ids(toxicity.score(before, grammar).filter("score < 0.5"))
    (before, after) = stages[1]
    assert ids(after) == ids(quality.score(before, quality.learn(docs, labels)).filter("score >= 0.5"))
    good = labels.filter("toxic = 0 and quality = 1").select("doc_id").join(docs, "doc_id")
    assert good.join(after, "doc_id", "left_semi").count() > 0.97 * good.count()


def test_lines_and_copies_go(spark, stages):
    before, after = stages[2]
    assert ids(before) == ids(after)
    again = linededup.mark(after).agg({"n_dropped": "sum"}).first()[0]
    assert again == 0
    before, after = stages[3]
    assert after.groupBy("text").count().filter("count > 1").count() == 0 and set(ids(after)) <= set(ids(before))


def test_every_kept_document_is_packed(stages):
    before, after = stages[4]
    assert sorted(set(ids(after))) == ids(before)


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(map(tuple, stages[-1][1].drop("sequence_id", "offset").collect()))


CLASHING = "_id _row_hash _drops n_lines n_dropped kept_lines score id_ node label component name row first".split()


def test_clashing_columns_pass_through(spark):
    docs = table(spark, DATA, "documents")
    mine = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, mine, DATA)
        assert found.columns == mine.columns
        rows = found.select("doc_id", *CLASHING).collect()
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in CLASHING)
    assert corpus_pipeline.STAGES[-1][1](spark, mine, DATA).count() > 0


ODD = [(None, None), (None, "a b c"), (1, ""), (1, None), (2, "one line here of some words"), (2, "one line here of some words"), (3, "one line here of some words\nx"), (9, "long " * 50_000)]


def test_odd_rows_pass_the_stages(spark):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    after = [stage(spark, docs, DATA) for _, stage in corpus_pipeline.STAGES]
    assert after[0].filter("text is null").count() == 2 and after[2].count() == len(ODD)
    assert {(r["doc_id"], r["text"]) for r in after[2].collect()} == {(i, "x" if i == 3 else t) for i, t in ODD}
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in after[3].collect()) == sorted([(0, "a b c"), (1, ""), (2, ODD[4][1]), (3, ODD[6][1]), (9, ODD[7][1])])
    assert after[4].filter("piece = 0").count() == len(ODD)


def test_empty_documents(spark):
    docs = table(spark, DATA, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0
