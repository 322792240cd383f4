"""Texts in a language without a reference stay by default, and are told."""

import random

from tessera.llm import quality

POLISH = ("wczoraj po południu poszliśmy razem nad rzekę, żeby zobaczyć jak wysoko podniosła się woda. "
          "stary młyn stał jeszcze na swoim miejscu, ale most został zamknięty przez straż. "
          "moja siostra powiedziała, że pamięta podobną powódź sprzed dwudziestu lat. ")


def texts(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        sentences = POLISH.split(". ")[:3]
        ws = [w for s in sentences for w in s.split()]
        rnd.shuffle(ws)
        rows = []
        while ws:
            k = rnd.randint(5, 9)
            rows.append(" ".join(ws[:k]).capitalize() + ".")
            ws = ws[k:]
        prose = " ".join(rows) + f" {i} " + " ".join(rnd.sample(POLISH.split(), 30)) + "."
        out.append((2 * i, prose))
        out.append((2 * i + 1, " | ".join(f"{w.strip('.,')}{'abcdefg'[k % 7]}" for k, w in enumerate(prose.split()))))
    return out


def judged(spark, rows, rules):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r["doc_id"]: r["quality"] for r in quality.measure(df, rules=rules).collect()}


def test_unknown_language_is_kept_and_told(spark):
    rows = texts(1, 60)
    q = judged(spark, rows, quality.RUNNING_TEXT)
    for i, v in q.items():
        assert not v["base_failed"] and v["near_reference"] is False
        assert v["kept"] == (i % 2 == 0), rows[i]  # prose stays, the same words in cells go
    strict = quality.QualityRules(max_common_alone=0.278, keep_unknown=False)
    assert not any(v["kept"] for v in judged(spark, rows, strict).values())
    assert all(v["near_reference"] is None and v["kept"] for i, v in judged(spark, rows, None).items() if i % 2 == 0)


def test_known_language_and_short_texts(spark):
    english = "the man went to the house of his friend and said that it is a good day in the town. " * 2
    english += "they sat in the garden and talked of the old days until it was dark and the rain came to them. "
    rows = [(0, english), (1, "only a few words"), (2, None)]
    q = judged(spark, rows, quality.RUNNING_TEXT)
    assert q[0]["near_reference"] is True and q[1]["near_reference"] is None and q[2]["near_reference"] is None
