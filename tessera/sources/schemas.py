"""Fixed schemas for the input tables and the logical tables built on them.

Files are read with an explicit ``StructType`` (no inference, no schema merge).
"""

from pyspark.sql import types as T

TS = T.TimestampNTZType()

TABLE_SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([T.StructField("r_regionkey", T.IntegerType()),
                            T.StructField("r_name", T.StringType())]),
    "nation": T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                            T.StructField("n_name", T.StringType()),
                            T.StructField("n_regionkey", T.IntegerType())]),
    "customer": T.StructType([T.StructField("c_custkey", T.LongType()),
                              T.StructField("c_name", T.StringType()),
                              T.StructField("c_nationkey", T.IntegerType()),
                              T.StructField("c_acctbal", T.DoubleType()),
                              T.StructField("c_mktsegment", T.StringType())]),
    "supplier": T.StructType([T.StructField("s_suppkey", T.LongType()),
                              T.StructField("s_name", T.StringType()),
                              T.StructField("s_nationkey", T.IntegerType()),
                              T.StructField("s_acctbal", T.DoubleType())]),
    "part": T.StructType([T.StructField("p_partkey", T.LongType()),
                          T.StructField("p_name", T.StringType()),
                          T.StructField("p_brand", T.StringType()),
                          T.StructField("p_type", T.StringType()),
                          T.StructField("p_size", T.IntegerType()),
                          T.StructField("p_retailprice", T.DoubleType())]),
    "orders": T.StructType([T.StructField("o_orderkey", T.LongType()),
                            T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderstatus", T.StringType()),
                            T.StructField("o_totalprice", T.DoubleType()),
                            T.StructField("o_orderdate", TS),
                            T.StructField("o_orderpriority", T.StringType())]),
    "lineitem": T.StructType([T.StructField("l_orderkey", T.LongType()),
                              T.StructField("l_partkey", T.LongType()),
                              T.StructField("l_suppkey", T.LongType()),
                              T.StructField("l_linenumber", T.IntegerType()),
                              T.StructField("l_quantity", T.DoubleType()),
                              T.StructField("l_extendedprice", T.DoubleType()),
                              T.StructField("l_discount", T.DoubleType()),
                              T.StructField("l_tax", T.DoubleType()),
                              T.StructField("l_returnflag", T.StringType()),
                              T.StructField("l_linestatus", T.StringType()),
                              T.StructField("l_shipdate", TS)]),
    "events": T.StructType([T.StructField("event_id", T.LongType()),
                            T.StructField("ts", TS),
                            T.StructField("user_id", T.LongType()),
                            T.StructField("event_type", T.StringType()),
                            T.StructField("value", T.DoubleType()),
                            T.StructField("props", T.StringType())]),
    "documents": T.StructType([T.StructField("doc_id", T.LongType()),
                               T.StructField("text", T.StringType()),
                               T.StructField("lang", T.StringType()),
                               T.StructField("source", T.StringType()),
                               T.StructField("n_chars", T.LongType())]),
    "embeddings": T.StructType([T.StructField("vec_id", T.LongType()),
                                T.StructField("embedding", T.ArrayType(T.FloatType())),
                                T.StructField("label", T.IntegerType())]),
    "pages": T.StructType([T.StructField("page_id", T.LongType()),
                           T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType())]),
    "benchmark": T.StructType([T.StructField("item_id", T.LongType()),
                               T.StructField("text", T.StringType())]),
    "labels": T.StructType([T.StructField("doc_id", T.LongType()),
                            T.StructField("quality", T.IntegerType()),
                            T.StructField("toxic", T.IntegerType())]),
    "conversations": T.StructType([T.StructField("conv_id", T.LongType()),
                                   T.StructField("turn", T.LongType()),
                                   T.StructField("role", T.StringType()),
                                   T.StructField("text", T.StringType())]),
}

# The eight model features of the fraud use case, in model order.
FRAUD_FEATURES = [
    "amount", "transaction_hour", "merchant_category", "foreign_transaction",
    "location_mismatch", "device_trust_score", "velocity_last_24h", "cardholder_age",
]

# Typed schema of the model input (float64 amount, int8 category code, int64 rest).
FRAUD_MODEL_SCHEMA = T.StructType([
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_hour", T.LongType()),
    T.StructField("merchant_category", T.ByteType()),
    T.StructField("foreign_transaction", T.LongType()),
    T.StructField("location_mismatch", T.LongType()),
    T.StructField("device_trust_score", T.LongType()),
    T.StructField("velocity_last_24h", T.LongType()),
    T.StructField("cardholder_age", T.LongType()),
])

# Online snapshot table keyed by user (typed as the online store declares it).
ONLINE_USER_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_hour", T.IntegerType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("foreign_transaction", T.IntegerType()),
    T.StructField("location_mismatch", T.IntegerType()),
    T.StructField("device_trust_score", T.DoubleType()),
    T.StructField("velocity_last_24h", T.IntegerType()),
    T.StructField("cardholder_age", T.IntegerType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
])
