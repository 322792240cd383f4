"""One document of each group stays, whatever the ids."""

import random

from tessera.llm import simhash


def kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()), key=repr)


def test_rows_that_share_an_id_but_not_a_group(spark):
    rows = [(1, "the first text is about one thing only"), (1, "another text that tells of something else"),
            (2, "the first text is about one thing only"), (3, "yet another and quite different text here")]
    assert kept(spark, rows) == sorted([rows[0], rows[1], rows[3]], key=repr)


def test_copies_without_an_id_collapse(spark):
    rows = [(None, "a copy that stands three times here")] * 3 + [(None, "alone and without an id it is")] \
        + [(7, "has an id in one of its copies"), (None, "has an id in one of its copies")]
    assert kept(spark, rows) == sorted([rows[0], rows[3], rows[4]], key=repr)


def test_one_row_of_each_component(spark):
    rnd = random.Random(5)
    base = [" ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") * 3 for _ in range(30)) for _ in range(40)]
    rows = [(rnd.choice([i, i, 3, None]), rnd.choice(base)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    group = {r["text"]: r["fp"] for r in simhash.near_duplicates(df).join(
        df.selectExpr("text", "xxhash64(text) AS _th").distinct(), "_th").collect()}
    label = {t: min(f for f in set(group.values()) if bin((f ^ group[t]) % (1 << 64)).count("1") <= 2) for t in group}
    got = kept(spark, rows)
    assert len(got) == len({label[t] for _, t in rows}) == len({label[t] for _, t in got})


def test_no_side_that_grows_is_broadcast(spark):
    """The probes of a small table are many rows by their explode: its size says nothing of them."""
    rows = [(i, f"the words {i} {i * 7} and {i % 5} of a text") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    fps = simhash.save(simhash.fingerprints(df), "fingerprints")
    for frame in (simhash.links(fps.select("fp").distinct()), simhash.near_duplicates(df), simhash.keep_one(df)):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
