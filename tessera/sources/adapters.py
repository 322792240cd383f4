"""Logical tables of the use cases, derived from the input tables.

Each adapter has a SQL twin in ``tessera.plans.sql`` so that every query can be
checked against an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.windows import trailing_sums
from tessera.sources.tables import Tables

DAY = 86_400


def trust_score(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("long")


def transactions(t: Tables, with_velocity: bool = True) -> DataFrame:
    """Fraud transactions from events (one row per event)."""
    return transactions_from(t.events, with_velocity)


def transactions_from(e: DataFrame, with_velocity: bool = True) -> DataFrame:
    """The transaction projection of an events frame (batch or stream)."""
    trust = trust_score()
    foreign = F.when(F.col("event_id") % 20 < 3, 1).otherwise(0).cast("long")
    mismatch = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0).cast("long")
    df = e.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.format_string("user_%04d", F.col("user_id")).alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.col("ts").alias("created_timestamp"),
        F.col("value").alias("amount"),
        F.hour("ts").cast("long").alias("transaction_hour"),
        F.col("event_type").alias("merchant_category"),
        foreign.alias("foreign_transaction"),
        mismatch.alias("location_mismatch"),
        trust.alias("device_trust_score"),
        (F.lit(18) + F.col("user_id") % 62).cast("long").alias("cardholder_age"),
    )
    if with_velocity:
        df = trailing_sums(df, ["user_id"], "timestamp",
                           {"velocity_last_24h": (DAY, F.lit(1).cast("long"))})
    else:
        df = df.withColumn("velocity_last_24h", F.lit(None).cast("long"))
    fraud = (((F.col("device_trust_score") < 40) & (F.col("amount") > 60))
             | ((F.col("foreign_transaction") == 1) & (F.col("location_mismatch") == 1)))
    return df.withColumn("is_fraud", F.when(fraud, 1).otherwise(0).cast("long"))


def sentiment_texts(t: Tables) -> DataFrame:
    """Labelled texts: category -1 if toxic, 1 if quality, else 0."""
    cat = (F.when(F.col("toxic") == 1, -1).when(F.col("quality") == 1, 1).otherwise(0))
    return (t.documents.join(t.labels, "doc_id", "inner")
            .select("doc_id", F.col("text").alias("clean_text"), cat.cast("int").alias("category")))


def second_corpus(t: Tables) -> DataFrame:
    """Conversation turns as the second labelled corpus (role gives the label)."""
    cat = F.when(F.col("role") == "assistant", 1).when(F.col("role") == "user", 0).otherwise(-1)
    return t.conversations.select(
        "conv_id", "turn", F.col("text").alias("clean_comment"), cat.cast("int").alias("category"))


def books(t: Tables) -> DataFrame:
    """Book catalog from documents."""
    title = F.substring_index(F.col("text"), "\n", 1)
    return t.documents.select(
        F.col("doc_id").alias("book_id"),
        title.alias("title"),
        F.lit(None).cast("string").alias("subtitle"),
        F.col("source").alias("authors"),
        F.col("text").alias("description"),
        F.col("lang").alias("categories"),
        F.lit(None).cast("string").alias("publisher"),
        F.col("source").alias("search_category"),
        F.lit(None).cast("double").alias("average_rating"),
        F.lit(None).cast("long").alias("ratings_count"),
    )


def request_log(t: Tables) -> DataFrame:
    """Call log of a scoring service from events."""
    return request_log_from(t.events)


def request_log_from(events: DataFrame) -> DataFrame:
    """The same of an events frame (batch or stream)."""
    k = trust_score()
    ok = (k % 20) != 0
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        F.col("user_id"),
        F.col("event_type").alias("endpoint"),
        F.col("value").alias("latency_ms"),
        ok.alias("success"),
        F.when(~ok, F.concat(F.lit("E"), k.cast("string"))).alias("error"),
    )


def run_log(t: Tables) -> DataFrame:
    """Experiment runs from orders."""
    return t.orders.select(
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("start_time"),
        F.col("o_totalprice").alias("metric"),
        F.col("o_orderstatus").alias("status"),
    )


def ratings(t: Tables) -> DataFrame:
    """Implicit ratings: customer x part, total quantity."""
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.sum("l_quantity").alias("quantity")))


def requests(t: Tables) -> DataFrame:
    """Scoring requests from events: every feature optional, some keys unknown to
    the store (user id + 1000), some empty-string categories."""
    e = t.events
    eid = F.col("event_id")

    def unless(cond, value):
        return F.when(cond, F.lit(None)).otherwise(value)

    user = F.when(eid % 17 == 0, F.col("user_id") + 1000).otherwise(F.col("user_id"))
    cat = F.when(eid % 6 == 2, F.lit(None)).when(eid % 13 == 0, F.lit("")).otherwise(F.col("event_type"))
    return e.select(
        eid.cast("string").alias("transaction_id"),
        F.format_string("user_%04d", user).alias("user_id"),
        unless(eid % 11 == 0, F.col("value")).cast("double").alias("amount"),
        unless(eid % 5 == 1, F.hour("ts")).cast("long").alias("transaction_hour"),
        cat.alias("merchant_category"),
        unless(eid % 4 == 3, F.when(eid % 20 < 3, 1).otherwise(0)).cast("long").alias("foreign_transaction"),
        unless(eid % 9 == 4, F.when(eid % 10 == 0, 1).otherwise(0)).cast("long").alias("location_mismatch"),
        unless(eid % 7 == 5, trust_score()).cast("long").alias("device_trust_score"),
        unless(eid % 3 == 0, eid % 5).cast("long").alias("velocity_last_24h"),
        unless(eid % 8 == 6, F.lit(18) + F.col("user_id") % 62).cast("long").alias("cardholder_age"),
    )
