"""Physical-plan properties: no Python UDF, lookups broadcast, filters and
column pruning at the scan."""

from fixtures import SF_SMALL
from gable.plans import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_anywhere(spark):
    for name in ("url_extract", "benchmark_select", "target_encode_apply", "geo_chain", "ensemble_weights"):
        p = plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_lookups_are_broadcast(spark):
    p = plan(catalog.QUERIES["benchmark_select"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(catalog.QUERIES["segment_filter"](spark, SF_SMALL))
    assert "PushedFilters: [In(c_mktsegment" in p or "PushedFilters: [IsNotNull(c_mktsegment)" in p
    p2 = plan(catalog.QUERIES["dedup_rows"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p2


def test_target_encoding_apply_has_no_shuffle_of_rows(spark):
    p = plan(catalog.QUERIES["target_encode_apply"](spark, SF_SMALL))
    # the fitted tables are checkpointed and broadcast; the order rows are
    # only scanned, projected and probed
    assert "SortMergeJoin" not in p


def test_stage3_transform_does_not_shuffle_rows(spark):
    from gable.plans import star
    rows, _ = star.run(spark, SF_SMALL)
    rows.write.format("noop").mode("overwrite").save()
    p = plan(rows)
    # input is the checkpointed split frame; every fitted table is broadcast
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p
    assert p.count("BroadcastHashJoin") == 4


def test_no_cartesian_or_nested_loop_join_anywhere(spark):
    for name in sorted(catalog.ORACLE):
        df = catalog.QUERIES[name](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        p = plan(df)
        assert "NestedLoop" not in p and "Cartesian" not in p and "EvalPython" not in p, name
