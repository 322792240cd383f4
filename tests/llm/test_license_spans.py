"""Labels and scores of the license scan: relatives told apart, runs bounded in the text, and
a plain version over generated texts."""

import random
import re

import pytest

from tessera.llm import licenses
from tessera.llm.queries import QUERIES

FILL = "Some other words that have nothing to do with it at all"


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan_licenses(df).collect()}


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY 4.0.", "cc-by"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-nc"),
    ("Licensed under CC BY-SA 4.0.", "cc-by,cc-sa"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc-by,cc-nc,cc-sa"),
    ("Released under the MIT License.", "mit"),
    ("Released under the BSD license.", ""),
    ("This work is licensed under the GNU General Public License", "gpl,gpl-notice"),
    ("This work is licensed under a Creative Commons Attribution license", "cc-notice"),
    ("This work is licensed under a Creative Commons license", ""),
    ("This work is dedicated to the public domain", "public-domain"),
    ("This work is dedicated to my public", ""),
    ("Licensed under " + FILL + " 4 0 and by nc", ""),  # far apart: no run
    (None, ""), ("", ""),
])
def test_labels(spark, text, labels):
    assert scan(spark, [text])[0][0] == labels
    if text:
        many = " ".join([FILL, text, FILL * 30, text, FILL])
        assert scan(spark, [many])[0][0] == labels


def plain(text, min_share=0.6, gap=2):
    ws = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
    spans, labels = [], set()
    for tid, (label, words, must) in enumerate([(*p, "") for p in licenses.PHRASES] + list(licenses.TEMPLATES)):
        t = words.split()
        if tid < len(licenses.PHRASES):
            labels |= {label for i in range(len(ws)) if ws[i:i + len(t)] == t}
            continue
        lines = {}
        for p in range(len(ws) - 1):
            for i in range(len(t) - 1):
                if ws[p:p + 2] == t[i:i + 2]:
                    lines.setdefault(p - i, []).append((p, i))
        runs, last, line = [], None, None
        for first, d in sorted((min(v)[0], d) for d, v in lines.items()):
            if last is None or abs(d - line) > gap or first - last > gap + 1:
                runs.append([])
                last = -1 if last is None else last
            runs[-1] += lines[d]
            last, line = max(last, max(lines[d])[0]), d
        for run in runs:
            held = {i + x for _, i in run for x in (0, 1)}
            covered = {p + x for p, _ in run for x in (0, 1)}
            lo, hi = min(covered), max(covered)
            share = max(0.0, 1 - max(len(t) - len(held), hi - lo + 1 - len(covered)) / len(t))
            if share >= min_share and {t.index(m) for m in must.split()} <= held:
                spans.append((lo, -hi, tid, share, label))
    chains, reach = [], -1
    for s in sorted(spans):
        if s[0] > reach:
            chains.append([])
        chains[-1].append(s)
        reach = max(reach, -s[1])
    best = [s for c in chains for s in c if s[3] == max(x[3] for x in c)]
    labels |= {s[4] for s in best}
    whole = any(ws[i:i + len(p.split())] == p.split() for _, p in licenses.PHRASES for i in range(len(ws)))
    return ",".join(sorted(labels)), max([1.0] * whole + [s[3] for s in best], default=0.0)


def test_against_plain(spark):
    rnd = random.Random(11)
    texts = []
    for _ in range(400):
        ws = []
        for _ in range(rnd.randint(1, 4)):
            part = rnd.choice([t for _, t, *_ in licenses.TEMPLATES + licenses.PHRASES] + [FILL.lower()]).split()
            part = [w for w in part if rnd.random() > 0.12]
            for _ in range(rnd.choice([0, 0, 1, 2])):
                part.insert(rnd.randint(0, len(part)), rnd.choice(["nc", "sa", "the", "license", "new"]))
            ws += part
        texts.append(" ".join(ws))
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        labels, score = plain(t)
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-12, (t, got[i], labels, score)
    assert len({g[0] for g in got.values()}) > 15


def test_given_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in QUERIES["op3_license_scan"](spark, sf_dir).collect()}
    for r in rows:
        labels, score = plain(r["text"])
        assert got[r["doc_id"]][0] == labels and abs(got[r["doc_id"]][1] - score) < 1e-12
