"""Plan checks: pushdown, pruning, no cartesian products."""

import __spark_entry__ as E


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pushdown_and_pruning(spark, sf_dir):
    q = E.queries()
    p = plan(q["pushed_filter_scan"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_extendedprice), IsNotNull(l_returnflag), GreaterThan(l_extendedprice" in p
    p2 = plan(q["pruned_scan"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in p2


def test_no_cartesian_products(spark, sf_dir):
    q = E.queries()
    for name in ("score_features_flagship", "asof_features", "similar_items", "assign_users", "roc_auc",
                 "resolve_query_item", "describe_features", "latency_quantiles"):
        p = plan(q[name](spark, sf_dir))
        assert "CartesianProduct" not in p, name
        assert "NestedLoop" not in p, name


def test_plans_are_built_without_jobs_or_kept_frames(spark, sf_dir):
    q = E.queries()
    spark.catalog.clearCache()
    tracker = spark.sparkContext.statusTracker()
    for name in ("roc_auc", "behavioral_features", "drift_report", "assign_users", "stratified_split",
                 "describe_features", "category_codes", "resolve_query_item", "merchant_risk"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        df = q[name](spark, sf_dir)
        assert not tracker.getJobIdsForGroup(f"build-{name}"), name
        df.write.format("noop").mode("overwrite").save()
        assert spark._jsparkSession.sharedState().cacheManager().isEmpty(), name
    spark.sparkContext.setJobGroup("tests", "")


def test_top_k_limited_per_task(spark, sf_dir):
    # as on large tables: below the threshold a request's rows already sit in one task
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.queries()["similar_items"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_snapshot_time_filter_reaches_the_scan(spark, sf_dir):
    p = plan(E.queries()["materialize_latest"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts," in p and "LessThanOrEqual(ts," in p


def test_neighbour_search_is_no_cartesian_product(spark, sf_dir):
    for name in ("ann_top_k", "all_items_top_n"):
        p = plan(E.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in p and "NestedLoop" not in p, name
