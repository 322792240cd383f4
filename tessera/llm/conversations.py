"""Conversation structure repair: damage for tests of robustness, faults of rows, and
the cheapest edits that give a legal order of roles.

Faults are found by Spark's functions and one window; the edits of a conversation by
the persistent DP of ``audits``, which reads its rows in order as a stream.  The
result of a conversation is one edit string and the chained hash of its texts, so its
rows pass one task in order whatever the method; they are sorted by Spark (which
spills) and only those whose edits are still open are held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tessera.llm.audits import Repair

_INK = r"[^\x20\x09-\x0D]"
_COLUMNS = ["conv_id", "turn", "role", "text"]
_OUT_ROWS = 4096


def _plain(df: DataFrame) -> DataFrame:
    """The four columns, null roles and texts as one space."""
    return df.select(F.col("conv_id"), F.col("turn").cast("long"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damage(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost): rows damaged by crc32(``conv_id:turn``) % 20:
    0 is lost (kept as a marked row, so that its conversation is still known), 1 has
    an empty text, 2 no ``[.!?]``, 3 stands twice, 4 is of role user.  Null keys count
    as one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = _plain(df).withColumn("kind", F.crc32(key) % 20)
    kind = F.col("kind")
    text = F.when(kind.isin(0, 1), F.lit("")) \
        .when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (kind == 0).alias("lost"),
                       F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                       ).drop("col")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: blank, duplicate (role and text seen earlier in the
    conversation), truncated or null, the first that holds; in partitions of whole
    conversations, ordered by turn (nulls first; ties by role and text)."""
    seen = Window.partitionBy("conv_id", "lost", "role", F.sha2("text", 256)) \
        .orderBy(F.asc_nulls_first("turn"))
    rest = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = F.when(~F.col("text").rlike(_INK), F.lit("blank")) \
        .when(F.col("nth") > 1, F.lit("duplicate")) \
        .when(~F.substring(rest, -1, 1).isin(".", "!", "?"), F.lit("truncated"))
    return rows.repartition("conv_id").withColumn("nth", F.row_number().over(seen)) \
        .withColumn("fault", fault) \
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "nth")


class _Conversation:
    """Counts, edits and the digest of one conversation."""

    def __init__(self, key):
        self.key = key
        self.n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first = self.turn = self.initial = None
        self.turns = 0
        self.edits: list[str] = []
        self.hash, self.begun = hashlib.sha256(), False
        self.repair = Repair()

    def add(self, turn, role: str, text: str, fault: str | None) -> Iterator[tuple[str, str, str]]:
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.initial = role[:1]
        if fault:
            self.n[fault] += 1
        yield from self._told(self.repair.add(role, text, fault))

    def finish(self) -> tuple[tuple, list[tuple[str, str, str]]]:
        cost, rest = self.repair.finish()
        rest = list(self._told(rest))
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.key, gaps, *self.n.values(), cost, "".join(self.edits), self.hash.hexdigest()), rest

    def _told(self, edits) -> Iterator[tuple[str, str, str]]:
        for e, role, text in edits:
            self.edits.append(e)
            if e != "D":
                self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
                self.begun = True
                yield e, role, text


def _walk(batches: Iterator[pa.RecordBatch], schema: pa.Schema, of: str) -> Iterator[pa.RecordBatch]:
    """One row per conversation (``of`` 'conversation') or per row of the repaired ones."""
    out: list[tuple] = []
    now: _Conversation | None = None
    place = 0

    def end() -> None:
        nonlocal place
        row, rest = now.finish()
        if of == "conversation":
            out.append(row)
        else:
            out.extend((now.key, place + i, *x) for i, x in enumerate(rest))
        place = 0

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [()] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)],
                                          schema=schema)

    for b in batches:
        for key, turn, role, text, lost, fault in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if now is None or key != now.key:
                if now is not None:
                    end()
                now = _Conversation(key)
            if lost:
                continue
            for x in now.add(turn, role, text, fault):
                if of != "conversation":
                    out.append((key, place, *x))
                    place += 1
            if len(out) >= _OUT_ROWS:
                yield batch()
    if now is not None:
        end()
        yield batch()


def _run(rows: DataFrame, of: str, columns: str) -> DataFrame:
    if "lost" not in rows.columns:
        rows = _plain(rows).withColumn("lost", F.lit(False))
    kind = rows.schema["conv_id"].dataType
    ordered = faults(rows.select(*_COLUMNS, "lost")).select(*_COLUMNS, "lost", "fault")
    names = [c.split()[0] for c in columns.split(", ")]
    types = {"string": pa.string(), "bigint": pa.int64()}
    schema = pa.schema([("conv_id", to_arrow_type(kind))]
                       + [(n, types[c.split()[1]]) for n, c in zip(names, columns.split(", "), strict=True)])
    run: Callable = lambda it: _walk(it, schema, of)
    return ordered.mapInArrow(run, f"conv_id {kind.simpleString()}, {columns}")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)
    per conversation of ``rows`` (conv_id, turn, role, text; ``lost`` marks rows that are
    not there, as ``damage`` does).

    ``audit`` holds the cheapest edits that make the roles' initials ``(s?(ua)+)?``, one
    letter each in order: Keep costs nothing, Rerole 1, Delete 2 (required for blank and
    duplicate rows), Insert 5, a truncated row that stays 5; of equal costs the ASCII-least.
    Null roles and texts count as one space; rows without a turn come first; equal turns
    are ordered by role and text; repeated rows are duplicates; a null conv_id is a
    conversation like any other, and one without rows has zeros, an empty audit and the hash of
    nothing.  An empty table gives an empty result.  Texts of any length are read whole.
    Columns beside these are not read, whatever their names."""
    return _run(rows, "conversation", "gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
                                      "illegal bigint, cost bigint, audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) per row of the repaired conversations: the same
    edits as ``repair_conversations``, deleted rows left out, ``place`` counted from 0."""
    return _run(rows, "turn", "place bigint, edit string, role string, text string")
