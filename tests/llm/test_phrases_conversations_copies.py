"""Phrase collocations, conversation repair and exact dedup against plain versions of
their contracts, on the given tables and on made rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import audits, conversations, copies, phrases
from tessera.llm.queries import ORACLE, QUERIES

SPACES = " \t\n\v\f\r"


# plain versions ------------------------------------------------------------------

def plain_phrases(rows, longest, least, first):
    upper = {i: i + 32 for i in range(65, 91)}
    count, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for i in range(len(ws)):
                for k in range(1, min(longest, len(ws) - i) + 1):
                    count[lang, tuple(ws[i:i + k])] += 1
    often = {p: a for p, a in count.items() if a >= least and len(p[1]) > 1}
    inside = collections.defaultdict(int)  # the most that a longer one with these words occurs
    for (lang, q), b in often.items():
        for k in range(2, len(q)):
            for i in range(len(q) - k + 1):
                inside[lang, q[i:i + k]] = max(inside[lang, q[i:i + k]], b)
    out = collections.defaultdict(list)
    for (lang, p), a in often.items():
        if inside[lang, p] >= a:
            continue
        score, _, le, r = min((1000 * a * total[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k,
                               count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((" ".join(p), a, le, r, total[lang], score))
    return sorted((lang, i + 1, *row) for lang, held in out.items() for i, row in enumerate(
        sorted(held, key=lambda x: (-x[5], -x[1], x[0].encode()))[:first]))


def plain_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
            for c, v in out.items()}


def plain_edits(rows):
    """The least (cost, audit), edit strings carried whole."""
    best = {0: (0, "")}

    def offer(to, q, x):
        if q not in to or x < to[q]:
            to[q] = x

    def inserted(held):
        for _ in range(4):
            for q, (c, s) in list(held.items()):
                offer(held, audits._NEXT[q], (c + 5, s + "I"))
        return held

    for role, fault in rows:
        after = {}
        for q, (c, s) in inserted(best).items():
            offer(after, q, (c + 2, s + "D"))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                to = audits._KEEP.get((q, role[:1]))
                if to is not None:
                    offer(after, to, (c + more, s + "K"))
                offer(after, audits._NEXT[q], (c + 1 + more, s + "R"))
        best = after
    best = inserted(best)
    return min(best[q] for q in (0, 3) if q in best)


def plain_repair(rows):
    out = []
    for conv, held in plain_damage(rows).items():
        seen, marked = set(), []
        for _, role, text in held:
            ink = text.strip(SPACES)
            marked.append("blank" if not ink else "duplicate" if (role, text) in seen
                          else "truncated" if ink[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        roles = [r for _, r, _ in held]
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit = plain_edits(list(zip(roles, marked)))
        kept, at, last = [], 0, ""
        for e in audit:
            role, text = ("", "") if e == "I" else held[at][1:]
            at += e != "I"
            if e == "D":
                continue
            if e in "IR":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            kept.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(k[:1] for k in kept))
        n = [marked.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def plain_copies(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        t = t or ""
        groups["".join(c for c in t if c not in SPACES)].append((-len(t), i is None, i))
    out = []
    for plain, held in groups.items():
        keep = min(held, key=lambda x: (x[0], x[1], x[2] or 0))
        rest = sorted(((i is not None, i or 0), n, i) for n, _, i in held)
        first = True
        for _, n, i in rest:
            stays = first and (n, i) == (keep[0], keep[2])
            first = first and not stays
            out.append((i, keep[2], len(held), stays, hashlib.sha256(plain.encode()).hexdigest()))
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_of(spark, sf_dir, table, *cols):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols).collect()]


# the queries on the given tables --------------------------------------------------

def test_op11_given(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "documents", "lang", "text")
    want = plain_phrases(rows, 5, 100, 2000)
    assert want and got(QUERIES["op11_phrases"](spark, sf_dir)) == sorted(want, key=repr)


def test_op12_given(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    want = plain_repair(rows)
    assert len({r[0] for r in rows}) == len(want)
    assert got(QUERIES["op12_conversation_repair"](spark, sf_dir)) == sorted(want, key=repr)


def test_op13_given(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "documents", "doc_id", "text")
    assert got(QUERIES["op13_exact_dedup"](spark, sf_dir)) == sorted(plain_copies(rows), key=repr)


# 11 -------------------------------------------------------------------------------

CLASH = ", phrase string, w1 int, n int, f int, word string, a int, lost int, row int, best int, size int, `x.y` int"
EXTRA = ("p", 1, 2, 3, "w", 4, 5, 6, 7, 8, 9)


def made_texts(seed, n):
    rnd = random.Random(seed)
    words = ["The", "the", "of", "new", "york", "city", "É", "naïve", " ", "x" * 300, "a\x00b", "日本"]
    out = []
    for _ in range(n):
        lang = rnd.choice(["en", "en", "en", "fr", None])
        ws = [rnd.choice(words[:rnd.choice([3, 6, 12])]) for _ in range(rnd.randint(0, 30))]
        out.append((lang, "".join(w + rnd.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\r"]) for w in ws)))
    passage = "all the people of new york city said so"
    out += [("en", passage)] * (n // 3) + [(None, None), ("en", ""), ("de", " \t ")]
    return out


@pytest.mark.parametrize("seed, words_a_part", [(1, 32_000_000), (2, 400)])
def test_phrases_made(spark, monkeypatch, seed, words_a_part):
    monkeypatch.setattr(phrases, "_WORDS", words_a_part)  # many parts
    rows = made_texts(seed, 300)
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], "lang string, text string" + CLASH).repartition(5)
    for least in (3, 20):
        assert got(phrases.top_collocations(df, first=40, least=least)) == \
            sorted(plain_phrases(rows, 5, least, 40), key=repr)


def test_phrases_empty(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert phrases.top_collocations(df).count() == 0
    one = spark.createDataFrame([("en", "a " * 5000)], "lang string, text string")  # one long text
    assert got(phrases.top_collocations(one)) == plain_phrases([("en", "a " * 5000)], 5, 100, 2000)


def test_sums_that_go_out_in_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "_HELD", 10)
    rnd = random.Random(4)
    parts = [[(rnd.choice("abcdefghijklmnopqrst"), rnd.randint(1, 9)) for _ in range(7)] for _ in range(30)]
    tables = (pa.table({"k": [k for k, _ in p], "n": [n for _, n in p]}) for p in parts)
    got, want = collections.Counter(), collections.Counter()
    for b in phrases._summed(tables, ["k"]):
        keys = b.column("k").to_pylist()
        assert len(keys) == len(set(keys))
        for k, n in zip(keys, b.column("n").to_pylist()):
            got[k] += n
    for k, n in (x for p in parts for x in p):
        want[k] += n
    assert got == want
    packed, want = collections.Counter(), collections.Counter()
    for b in phrases._packed(iter([np.array([5, 70_000, 5]), np.arange(9), np.array([70_000])])):
        for block, low, n in zip(*[c.to_pylist() for c in b.columns]):
            for i, c in zip(np.frombuffer(low, "<u2"), np.frombuffer(n, "<u4")):
                packed[(block << 16) + int(i)] += int(c)
    want.update([5, 70_000, 5, *range(9), 70_000])
    assert packed == want


def test_quicksort_counts():
    rnd = np.random.default_rng(3)
    keys = rnd.integers(0, 4, (500, 5)).astype(np.int32)
    for row in keys:
        row[rnd.integers(1, 6):] = -1
    weight = rnd.integers(1, 5, 500)
    for least in (1, 7, 60):
        want = collections.Counter()
        for row, w in zip(keys.tolist(), weight.tolist()):
            for d in range(1, 6):
                if row[d - 1] < 0:
                    break
                want[tuple(row[:d])] += w
        found = [(tuple(keys[at, :d].tolist()), n) for at, d, n in phrases.quicksort_counts(keys, weight, least)]
        assert len(found) == len(dict(found)) and dict(found) == {p: n for p, n in want.items() if n >= least}


def test_scores_beyond_64_bits(spark):
    """1000 a n and l r far above 2**63."""
    a, n, le, r = 3 * 10 ** 12 + 7, 9 * 10 ** 13 + 1, 4 * 10 ** 12 + 9, 5 * 10 ** 12 + 3
    found = spark.createDataFrame([("en", "p q", 2, a)], "lang string, phrase string, size int, f bigint")
    counts = spark.createDataFrame([("en", "p", le), ("en", "q", r)], "lang string, phrase string, f bigint")
    total = spark.createDataFrame([("en", n)], "lang string, n bigint")
    assert phrases._scored(found, counts, total).first()["score"] == 1000 * a * n // (le * r)


# 12 -------------------------------------------------------------------------------

def made_turns(seed, n):
    rnd = random.Random(seed)
    out = []
    for conv in [None, *range(n)]:
        turn = rnd.choice([0, 5])
        for _ in range(rnd.randint(0, 9)):
            turn += rnd.choice([0, 1, 1, 1, 1, 3])
            out.append((conv, rnd.choice([turn] * 9 + [None]),
                        rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                        rnd.choice(["Yes.", "No", "Why? \n", " \t", "", None, " ", "So!", "é", "x" * 5000])))
    return out


@pytest.mark.parametrize("settle", [1, 3, 1024])
def test_repair_made(spark, monkeypatch, settle):
    rows = made_turns(settle, 250)
    monkeypatch.setattr(conversations, "Repair", lambda: audits.Repair(settle))
    cols = "conv_id bigint, turn bigint, role string, text string"
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], cols + CLASH).repartition(4)
    assert got(conversations.repair_conversations(conversations.damage(df))) == sorted(plain_repair(rows), key=repr)


def test_repaired_turns_and_hash(spark):
    rows = made_turns(9, 60)
    df = conversations.damage(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    whole = {r["conv_id"]: r for r in conversations.repair_conversations(df).collect()}
    turns = collections.defaultdict(list)
    for r in conversations.repaired_turns(df).collect():
        turns[r["conv_id"]].append((r["place"], r["edit"], r["role"], r["text"]))
    for conv, r in whole.items():
        held = sorted(turns[conv])
        assert [x[0] for x in held] == list(range(len(held)))
        assert "".join(x[1] for x in held) == r["audit"].replace("D", "")
        text = "\n".join(f"{x[2]}:{x[3]}" for x in held)
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_repair_empty_and_long(spark):
    cols = "conv_id string, turn int, role string, text string"
    assert conversations.repair_conversations(spark.createDataFrame([], cols)).count() == 0
    rows = [("c", i, ("user", "assistant", "user")[i % 3], f"Turn {i}.") for i in range(5000)]
    r = conversations.repair_conversations(spark.createDataFrame(rows, cols)).first()
    cost, audit = plain_edits([(role, None) for _, _, role, _ in rows])
    assert (r["cost"], r["audit"]) == (cost, audit)


@pytest.mark.parametrize("base, mod", [(1_000_003, (1 << 61) - 1), (1, 3)])
def test_edit_strings_with_collisions(base, mod):
    """With a hash that collides all the time, comparisons are still those of the letters."""
    rnd = random.Random(mod)
    s = audits.Strings(base, mod)
    plain = {0: ""}
    for _ in range(400):
        node, letter = rnd.choice(list(plain)[-30:]), rnd.choice("DK")
        plain[s.add(node, letter)] = plain[node] + letter
    nodes = list(plain)
    for _ in range(3000):
        x, y = rnd.choice(nodes), rnd.choice(nodes)
        assert s.less(x, y) == (plain[x] < plain[y])
        shared = s.common(x, y)
        assert plain[x].startswith(plain[shared]) and plain[y].startswith(plain[shared])


# 13 -------------------------------------------------------------------------------

def made_copies(seed, n):
    rnd = random.Random(seed)
    base = ["", "alpha beta", "alphabeta", "é x", "éx", "same text " * 500, " ", "\x1c"]
    out = [(rnd.choice([i, i, i, None]), rnd.choice([None, *base, f"only {i}"])) for i in range(n)]
    out += [(i, None if t is None else " ".join(t) if rnd.random() < .3 else t + "\n\t") for i, t in out[::3]]
    hot = [(10_000 + i, " hot text" + " " * (i % 3)) for i in range(n)]
    return out + hot + hot[:5]


@pytest.mark.parametrize("bits, parts", [(1, 1000), (3, 1000), (2, 7)])
def test_copies_made(spark, bits, parts):
    rows = made_copies(bits, 200)
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], "doc_id bigint, text string" + CLASH).repartition(9)
    found = copies.find_copies(df, bits=bits, parts=parts)
    assert got(found) == sorted(plain_copies(rows), key=repr)
    kept = copies.drop_copies(df)
    assert kept.columns == df.columns
    want = sorted((str(i), n) for i, keep, n, stays, _ in plain_copies(rows) if stays)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == [i for i, _ in want]


def test_copies_empty(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert copies.find_copies(df).count() == 0 and copies.drop_copies(df).count() == 0


def test_copies_plan_is_native(spark, sf_dir):
    plan = QUERIES["op13_exact_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


@pytest.mark.parametrize("name", ["op11_phrases", "op13_exact_dedup"])
def test_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    want = con.execute(f"select {', '.join(df.columns)} from ({ORACLE[name]})").fetchall()
    assert got(df) == sorted(map(tuple, want), key=repr)
