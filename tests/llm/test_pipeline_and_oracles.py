import pytest

import corpus_pipeline
from creditspark.llm import decontam, jaccard_join, packing, pii, quality_classifier, queries
from tests.oracle_harness import compare, duck

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, key):
    res = compare(queries.QUERIES[key](spark, SF), duck(SF), queries.ORACLES[key])
    assert res["hash_match"] and not res["type_diffs"], res


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    stage = dict(corpus_pipeline.STAGES)
    first = stage["quality"](spark, docs, SF)
    kept = {r["doc_id"] for r in quality_classifier.report(docs, labels).filter("kept").collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in first.collect())
    assert {d for d, _ in rows} == kept and first.columns == docs.columns
    second = stage["near_duplicates"](spark, first, SF)
    parts = brute.jaccard_components(rows, 5, 80)
    rows = sorted((r["doc_id"], r["text"]) for r in second.collect())
    assert {d for d, _ in rows} == {d for d, _, c in parts if d == c} and second.columns == docs.columns
    third = stage["decontamination"](spark, second, SF)
    hit = {d for d, _, n, _ in brute.decontaminate(rows, [tuple(r) for r in items.select("item_id", "text").collect()]) if n}
    rows = [(d, t) for d, t in rows if d not in hit]
    assert sorted((r["doc_id"], r["text"]) for r in third.collect()) == rows and hit
    fourth = stage["personal_data"](spark, third, SF)
    rows = [(d, pii.redact(t, pii.find(t))) for d, t in rows]
    assert sorted((r["doc_id"], r["text"]) for r in fourth.collect()) == rows and fourth.columns == docs.columns
    last = stage["packing"](spark, fourth, SF).collect()
    ids = packing.WordIds(packing.word_tokenizer_path())([t for _, t in rows])
    assert {(r["doc_id"], r["doc_tokens"]) for r in last} == {(d, len(x) + 1) for (d, _), x in zip(rows, ids)}
    assert sum(r["length"] for r in last) == sum(len(x) + 1 for x in ids)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_plans_of_native_operators_hold_no_python(spark):
    for key in ("op3_decontam", "op8_quality_rules"):
        plan = queries.QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_no_all_pairs(spark):
    for key in queries.QUERIES:
        plan = queries.QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, key


def test_modules_are_documented():
    for m in (decontam, jaccard_join, packing, pii, quality_classifier):
        assert "ull" in m.__doc__ and "epeat" in m.__doc__
