"""The pipeline's stages, each on its own input, against plain Python."""

import os
import re
import shutil

import pytest
from test_operators import ODD, brute_components, brute_hits, documents

import corpus_pipeline
from railyard.llm import quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, SF))
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_quality_keeps_what_it_accepts(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.score >= quality.GOOD}
    assert texts(stages["quality"]) == {i: t for i, t in texts(stages["documents"]).items() if i in good}


def test_one_document_of_each_group_stays(stages):
    before = texts(stages["quality"])
    wanted = {c for _, c in brute_components(sorted(before.items()), 5, 80).values()}
    assert texts(stages["near_duplicates"]) == {i: before[i] for i in wanted}


def test_repeated_and_missing_ids(spark):
    base = " ".join(f"a{i}" for i in range(60))
    other = " ".join(f"b{i}" for i in range(60))
    third = " ".join(f"c{i}" for i in range(60))
    rows = [(-5, base), (7, base + " end"), (7, other), (9, other + " end"), (7, other), (None, third), (None, third),
            (None, third + " end"), (None, other), (None, None), (8, ""), (8, None), (None, "lone words without an id")]
    got = corpus_pipeline.one_of_each(spark, documents(spark, rows), SF)
    out = [(r.doc_id, r.text) for r in got.collect()]
    thirds = [t for i, t in out if t in (third, third + " end")]
    assert len(thirds) == 1 and got.columns == list(corpus_pipeline.COLUMNS)
    rest = [x for x in out if x[1] not in thirds]
    want = [(-5, base), (7, other), (8, ""), (8, None), (None, None), (None, "lone words without an id")]
    assert sorted(rest, key=str) == sorted(want, key=str)


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(stages["near_duplicates"]), texts(stages["decontamination"])
    for i, text in before.items():
        n, hit, _ = brute_hits(text, items)
        assert (i in after) == (not hit or 20 * hit < n)
        if i in after and not hit:
            assert after[i] == text
        if i in after:
            assert brute_hits(after[i], items)[1] == 0


def test_personal_data_goes_and_the_rest_stays(stages):
    before, after = texts(stages["decontamination"]), texts(stages["pii"])
    assert before.keys() == after.keys()
    for r in stages["pii"]:
        assert r.n_chars == len(r.text)
    for i, text in before.items():
        found = re.findall(r"[\w.]+@[\w.]+|\+1 \(\d+\) [\d-]+|\b\d+\.\d+\.\d+\.\d+\b|\b[0-9a-f]{40}\b", text)
        assert all(x not in after[i] for x in found)
        if not re.search(r"\d", text):
            assert after[i] == text


def test_packing_holds_every_document(stages):
    assert {r.doc_id for r in stages["packing"]} == texts(stages["pii"]).keys()


def test_run_with_odd_rows_and_clashing_columns(spark, tmp_path):
    sf = str(tmp_path)
    for name in ("benchmark", "labels"):
        shutil.copy(f"{SF}/{name}.parquet", sf)
    clean = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [*((100 + r.doc_id, r.text) for r in clean), *ODD]
    for extra in ("score", "spans", "pii"):
        documents(spark, rows, extra=extra).write.mode("overwrite").parquet(os.path.join(sf, "documents.parquet"))
        docs = spark.read.parquet(os.path.join(sf, "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.cut(stage(spark, docs, sf))
            assert docs.columns == [*corpus_pipeline.COLUMNS, extra]
            assert {r[extra] for r in docs.select(extra).distinct().collect()} == {"mine"}
    empty = spark.read.parquet(os.path.join(sf, "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.cut(stage(spark, empty, sf))
    assert empty.count() == 0
