"""Physical-plan checks: pruning reaches the scan, no single-partition window over rows."""

import contextlib
import io
import re

import __spark_entry__ as entry

QUERIES = entry.queries()


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def read_schemas(txt: str) -> dict[str, str]:
    out = {}
    for loc, schema in re.findall(r"Location: \S+ \[file:[^\]]*/(\w+)\.parquet\]\n(?:[A-Za-z]+: [^\n]*\n)*?"
                                  r"ReadSchema: (struct<[^\n]*>)", txt):
        out.setdefault(loc, schema)
    return out


def test_column_pruning_reaches_scans(spark, sf_small):
    txt = plan_text(QUERIES["column_subset"](spark, sf_small))
    rs = read_schemas(txt)
    # bal needs only the order key and the extended price of line items
    assert rs["lineitem"] == "struct<l_orderkey:bigint,l_extendedprice:double>"
    assert "o_totalprice" not in rs["orders"] and "o_orderdate" not in rs["orders"]
    assert "c_acctbal" not in rs.get("customer", "")


def test_filters_pushed_to_scan(spark, sf_small):
    txt = plan_text(QUERIES["inner_join"](spark, sf_small))
    assert "PushedFilters" in txt


def test_running_sum_window_is_partitioned_by_bucket(spark, sf_small):
    from creditspark.operators import evaluate as E
    from creditspark.sources import fixtures as fx
    txt = plan_text(E.roc_curve(fx.scored(spark, sf_small), "p", "tag", n_buckets=8))
    specs = re.findall(r"\(\d+\) Window\nInput \[\d+\]: \[[^\n]*\]\nArguments: \[[^\n]*\], \[([^\]]*)\]", txt)
    # the row-level running sum is partitioned by bucket; the other windows run over the bucket table
    assert any("__bkt" in spec for spec in specs)


def test_no_cross_join_operators(spark, sf_small):
    for key in ["roc_curve", "auc", "lift", "cutoff_sweep", "stratified_split", "holdout_stability",
                "dup_rows", "woe_apply", "iv_ranking", "box_stats", "histogram", "class_shares"]:
        df = QUERIES[key](spark, sf_small)
        txt = plan_text(df)
        assert "NestedLoopJoin" not in txt and "CartesianProduct" not in txt, key
