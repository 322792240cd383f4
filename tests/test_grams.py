"""Terms counted in batches: as the occurrences one by one; the texts are not taken apart again for the weights."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import features as ft
from tessera.operators import grams
from tessera.operators import text as tt


def texts(spark, unique):
    rnd = random.Random(5)
    words = ["the", "café", "and", "x1", "naïve", "b2", "zz", "über_all", "of", "ss"]
    rows = [(None if i % 41 == 0 else i if unique else i % 50, None if i % 13 == 0 else " ".join(
        rnd.choices(words, k=rnd.choice([0, 1, 2, 30])))) for i in range(1, 200)]
    return spark.createDataFrame(rows, "id long, text string").repartition(3)


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("stop", [True, False])
def test_counts_are_those_of_the_occurrences(spark, unique, stop):
    docs = texts(spark, unique)
    key = lambda df, *c: sorted(map(repr, df.select(*c).collect()))
    old = tt.doc_terms(docs, "id", "text", stop)
    vocab, terms = tt.fit_text(docs, "id", "text", 1, 1.0, 10 ** 6, stop)
    assert key(terms, "id", "term", "tf") == key(old, "id", "term", "tf")
    assert key(vocab, *vocab.columns) == key(tt.fit_vocabulary(docs, old, "id", 1, 1.0, 10 ** 6), *vocab.columns)


def test_runs_of_texts_and_buckets(spark):
    import pyarrow as pa
    lists = [["a", "b"], None, [], ["b"], ["the", "a", "b", "a", "b"], ["b", "a"]] * 3
    all_runs = {}
    for most in (1, 4, 1 << 18):
        was, grams.TOKENS = grams.TOKENS, most
        try:
            out = []
            for words, code, text, pairs in grams._runs(pa.array(lists, pa.list_(pa.string())), pa.array(["the"])):
                names = words.to_pylist()
                h = grams._hashes(words)
                one, two = grams._buckets(h, code, pairs, 1 << 20)
                out += [(int(t), names[c], int(b)) for t, c, b in zip(text, code, one, strict=True)]
                out += [(int(text[p]), f"{names[code[p]]} {names[code[p + 1]]}", int(b)) for p, b in zip(pairs, two, strict=True)]
        finally:
            grams.TOKENS = was
        all_runs[most] = sorted(out)
    assert all_runs[1] == all_runs[4] == all_runs[1 << 18]
    expected = [(i, t) for i, ws in enumerate(lists) for ws in [[w for w in ws or [] if w != "the"]]
                for t in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]
    assert [x[:2] for x in all_runs[4]] == sorted(expected)
    assert len({x[1:] for x in all_runs[4]}) == len({x[1] for x in all_runs[4]})  # a term has one bucket


def test_weights_do_not_read_the_texts_again(spark, tmp_path):
    from tessera.plans.q_text import book_index
    from tessera.sources.schemas import TABLE_SCHEMAS
    from tessera.sources.tables import Tables
    rows = [(i, f"title {i % 7}\nsome words of text {i % 5} here", "en", "s", 30) for i in range(40)]
    spark.createDataFrame(rows, TABLE_SCHEMAS["documents"]).write.parquet(f"{tmp_path}/documents.parquet")
    p = book_index(Tables(spark, str(tmp_path)))[2]._jdf.queryExecution().executedPlan().toString()
    assert os.path.basename(str(tmp_path)) not in p and "regexp_extract_all" not in p


def test_weighted_text_is_trimmed_as_the_pattern_does(spark):
    ends = ["", " ", "\t\n", "\x0b\f\r\n", "  ", " \u0085", "\n ", "   ", "\xa0 "]
    rows = [(a + "Some longer Text é" + b,) for a in ends for b in ends] + [("",), (" \t ",), ("short",), (None,)]
    df = spark.createDataFrame(rows, "description string")
    other = ["title", "subtitle", "authors", "categories", "publisher", "search_category"]
    books = df.select("*", *[F.lit(None).cast("string").alias(c) for c in other])
    got = ft.weighted_text(books).select("description", "combined_features")
    joined = F.concat_ws(" ", *[F.lit("")] * 10, F.coalesce("description", F.lit("")))
    want = df.select("description", F.regexp_replace(F.lower(joined), r"^\s+|\s+$", "").alias("c")).where(F.length("c") > 10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("btrim") <= 1
