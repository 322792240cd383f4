"""Secret scan with multipart credential linking.

Strong patterns report by themselves.  Weak ones (a short value after ``pwd=``,
``key:`` and the like) are parts of a credential only together with the other
parts: they are reported where an access identifier and an endpoint, or either
with ``need_both`` off, start within ``scope`` code points of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import keyed, on_document

_VALUE = r"[\"']?\x20*[:=]\x20*[\"']?"
_ASSIGN = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
           r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])" + _VALUE)
#: kind: (expression, least length of its last part, expression before that part)
PATTERNS = {
    "assign": (_ASSIGN + r"[A-Za-z0-9+/_.=-]+", 12, _ASSIGN),
    "access": (r"AKIA[A-Z0-9]+", 18, ""),
    "hex": (r"[0-9a-f]+", 16, ""),
    "weak": (r"\b(?:[pP][wW][dD]|[pP][aA][sS][sS]|[kK][eE][yY]|[aA][uU][tT][hH])" + _VALUE
             + r"[A-Za-z0-9+/_.=-]+", 6,
             r"(?:[pP][wW][dD]|[pP][aA][sS][sS]|[kK][eE][yY]|[aA][uU][tT][hH])" + _VALUE),
    "ident": (r"\b(?:[uU][sS][eE][rR](?:[nN][aA][mM][eE])?|[lL][oO][gG][iI][nN]"
              r"|[cC][lL][iI][eE][nN][tT]_[iI][dD])" + _VALUE + r"[A-Za-z0-9_.@-]+", 0, ""),
    "endpoint": (r"[a-z]+://[A-Za-z0-9.-]+(?::[0-9]+)?", 0, ""),
}
#: The kinds reported by themselves, in the order of ties.
STRONG = ["assign", "access", "hex"]
REPORTED = [*STRONG, "weak"]
_RUN = {"hex": r"[0-9a-f]{16,}", "access": r"AKIA[A-Z0-9]{14,}"}


def _matches(kind: str, regex: str) -> Column:
    """Each match in column ``kind`` with the length of the text since the last one."""
    return F.when(F.size(kind) > 0, F.transform(
        F.arrays_zip(F.col(kind).alias("m"), F.split("_text", regex).alias("gap")),
        lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"),
                              F.length(z["gap"]).alias("gap"), z["m"].alias("m")))
    ).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,m:string>>"))


def parts(docs: DataFrame) -> DataFrame:
    """(``_id``, ``_th``, kind, start, end) of all matches of all patterns in
    ``_text``, leftmost and non-overlapping per kind, in code points, end
    exclusive; matches whose last part is too short are dropped.

    A match starts after all text before it: the pieces between matches (split
    by the same expression) and the matches themselves, summed up in order.
    """
    found = docs
    for kind, (regex, _, _) in PATTERNS.items():
        # a run of one class that is too short cannot hide a longer one
        found = found.withColumn(kind, F.regexp_extract_all(
            "_text", F.lit(_RUN.get(kind, regex)), F.lit(0)))
    cells = [_matches(k, _RUN.get(k, regex)) for k, (regex, _, _) in PATTERNS.items()]
    rows = (found.filter(sum((F.size(k) for k in PATTERNS), F.lit(0)) > 0)
            .select("_id", "_th", F.explode(F.concat(*cells)).alias("z"))
            .select("_id", "_th", "z.*").filter("m IS NOT NULL").distinct())
    in_order = Window.partitionBy("_id", "_th", "kind").orderBy("i") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("m")
    least = F.lit(0)
    for kind, (_, n, before) in PATTERNS.items():
        if before:
            last = F.when(F.col("kind") == kind, F.regexp_replace(F.col("m"), r"\A" + before, "")) \
                .otherwise(last)
        least = F.when(F.col("kind") == kind, n).otherwise(least)
    size = F.length("m")
    return (rows.withColumn("end", F.sum(F.col("gap") + size).over(in_order))
            .filter(F.length(last) >= least)
            .select("_id", "_th", "kind", (F.col("end") - size).alias("start"), "end"))


def link(spans: DataFrame, scope: int, need_both: bool) -> DataFrame:
    """Drop identifiers and endpoints, and weak spans without their other parts.

    The interval join of weak spans with the scopes around identifiers and
    endpoints: since any one part in reach suffices, the nearest of each kind
    before and after, found in one pass in order of start, decides.
    """
    order = Window.partitionBy("_id", "_th").orderBy("start", "end", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("_id", "_th").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def near(kinds: list[str]) -> Column:
        at = F.when(F.col("kind").isin(kinds), F.col("start"))
        return (F.coalesce(F.col("start") - F.max(at).over(before) <= scope, F.lit(False))
                | F.coalesce(F.min(at).over(after) - F.col("start") <= scope, F.lit(False)))

    ident, endpoint = near(["ident", "access"]), near(["endpoint"])
    linked = ident & endpoint if need_both else ident | endpoint
    return (spans.withColumn("linked", linked)
            .filter(F.col("kind").isin(STRONG) | ((F.col("kind") == "weak") & F.col("linked")))
            .drop("linked"))


def secret_spans(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 scope: int = 200, need_both: bool = False) -> DataFrame:
    """Per document with secrets (``_id``, ``_th``): ``spans``, an array of
    (start, k, kind, end) by start, then kind as listed in ``REPORTED``."""
    spans = link(parts(keyed(df, text_col, id_col)), scope, need_both)
    k = F.array_position(F.array(*map(F.lit, REPORTED)), F.col("kind")).cast("int")
    return spans.groupBy("_id", "_th").agg(F.array_sort(F.collect_list(F.struct(
        F.col("start").cast("long").alias("start"), k.alias("k"), "kind",
        F.col("end").cast("long").alias("end")))).alias("spans"))


def scan_secrets(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 **options) -> DataFrame:
    """(``id_col``, ``spans``), one row per row of ``df``; see ``secret_spans``.

    A null or empty text has an empty array.  Repeated rows (same id, same text)
    each get their spans; an empty table gives an empty result.
    """
    found = secret_spans(df, text_col, id_col, **options)
    docs = keyed(df, text_col, id_col).select("_id", "_th")
    return on_document(docs, found, "left").select(
        F.col("_id").alias(id_col), F.coalesce("spans", F.array().cast(
            "array<struct<start:bigint,k:int,kind:string,end:bigint>>")).alias("spans"))


def redact(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           mark: str = "[SECRET]", **options) -> DataFrame:
    """``df`` with every reported span of ``text_col`` replaced by ``mark``;
    spans that overlap or touch are replaced as one.  All rows and columns stay;
    texts without a secret, null among them, stay as they are."""
    found = secret_spans(df, text_col, id_col, **options).withColumnRenamed("spans", "_spans")
    cols = [F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("_th"),
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    text = F.col(f"_row.`{text_col}`")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        joins = (s["start"] <= acc["at"]) & (acc["at"] > 0)
        out = F.when(joins, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mark)))
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    masked = F.aggregate("_spans", start, step, lambda acc: F.concat(
        acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))))
    out = [F.when(F.col("_spans").isNull(), text).otherwise(masked).alias(text_col)
           if c == text_col else k for c, k in zip(df.columns, cols, strict=True)]
    return on_document(rows, found, "left").select(*out)
