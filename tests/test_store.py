"""The bucketed store: no exchange of the stored side, versions, schema."""

import pytest

from tessera.operators.online import online_lookup
from tessera.sources import store as st

SCHEMA = "k string, t timestamp_ntz, v double"


def rows(*xs):
    import datetime as dt
    return [(k, dt.datetime(2024, 1, 1, h), v) for k, h, v in xs]


def exchanges_above_store(df, name):
    """Exchanges between the root and the scan of the store, by the plan's indentation."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [i for i, x in enumerate(lines) if f".{name}[" in x or f".{name} " in x or name in x and "Scan" in x]
    assert at, lines
    depth = lambda x: len(x) - len(x.lstrip(" :+-*(0123456789)"))
    d, found = depth(lines[at[0]]), []
    for x in reversed(lines[:at[0]]):
        if depth(x) < d:
            d = depth(x)
            found.append(x)
    return [x for x in found if "Exchange" in x]


def test_upsert_and_lookup_without_an_exchange_of_the_store(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name = st.version_name("edge_store")
        store = st.create_if_absent(spark, name, spark.createDataFrame([], SCHEMA).schema, "k")
        assert st.create_if_absent(spark, name, store.schema, "k").count() == 0
        with pytest.raises(ValueError, match="not struct"):
            st.create_if_absent(spark, name, spark.createDataFrame([], "k string, t string").schema, "k")
        one = st.upsert(store, spark.createDataFrame(rows(("a", 1, 1.0), ("b", 5, 2.0)), SCHEMA),
                        st.version_name("edge_store"), "k", ["t"])
        batch = spark.createDataFrame(rows(("a", 2, 3.0), ("b", 4, 9.0), ("c", 1, 4.0)), SCHEMA)
        name2 = st.version_name("edge_store")
        two = st.upsert(one, batch, name2, "k", ["t"])
        assert {r["k"]: r["v"] for r in two.collect()} == {"a": 3.0, "b": 2.0, "c": 4.0}
        assert {r["k"]: r["v"] for r in one.collect()} == {"a": 1.0, "b": 2.0}  # the old version stays
        looked = online_lookup(spark.createDataFrame([("a",), ("z",), (None,)], "k string"), two, "k")
        assert {r["k"]: r["store_v"] for r in looked.collect()} == {"a": 3.0, "z": None, None: None}
        assert exchanges_above_store(looked, name2) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
