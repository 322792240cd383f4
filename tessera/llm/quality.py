"""Quality rules: repetition counts and distribution divergence.

A document's histograms of character classes and of common words are held
against language references by the Jensen-Shannon distance; too short texts
are not judged by a histogram.  Built-in functions only, no shuffle: every
count is made inside the document's row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, words

#: Shares of character classes in running text, and of the most
#: common words of each language (lower case) among its words.
CHAR_REFERENCE = {"letter": 0.80, "digit": 0.01, "space": 0.155, "other": 0.035}
WORD_REFERENCES = {
    "en": {"the": 0.06, "of": 0.033, "and": 0.028, "to": 0.026, "in": 0.021, "a": 0.02,
           "is": 0.011, "that": 0.01},
    "fr": {"de": 0.05, "la": 0.028, "le": 0.024, "et": 0.021, "les": 0.019, "des": 0.017,
           "en": 0.013, "un": 0.011},
    "de": {"der": 0.033, "die": 0.031, "und": 0.028, "in": 0.018, "den": 0.012, "von": 0.01,
           "zu": 0.01, "das": 0.01},
    "es": {"de": 0.058, "la": 0.036, "que": 0.028, "el": 0.027, "en": 0.026, "y": 0.025,
           "los": 0.016, "se": 0.011},
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """Limits.  Base: fewer than ``min_words`` words, or over ``max_repeat_pct``
    percent of them in repeated 3-word windows.  Divergence, for texts of
    ``min_chars`` code points: character classes further than ``max_chars``; or
    further than ``max_chars_odd`` in a text of ``min_common_words`` words whose
    common words are further than ``max_common`` from every language (lists and
    tables have few common words, so this alone is no fault, unless
    ``max_common_alone`` is given: then a text of ``min_alone_words`` words whose
    common words are further than this from every language is near no reference.  It
    fails if its character classes are further than ``max_chars_alone`` too, or over
    ``max_sign_words`` of its words have neither letter nor digit (cells of a table); else
    it is running text in a language without a reference, and stays unless
    ``keep_unknown`` is false)."""

    min_words: int = 50
    max_repeat_pct: int = 50
    min_chars: int = 400
    max_chars: float = 0.30
    max_chars_odd: float = 0.22
    min_common_words: int = 200
    max_common: float = 0.25
    min_alone_words: int = 50
    max_common_alone: float | None = None
    max_chars_alone: float = 0.113
    max_sign_words: float = 0.1
    keep_unknown: bool = True
    chars: dict = field(default_factory=lambda: CHAR_REFERENCE)
    common: dict = field(default_factory=lambda: WORD_REFERENCES)


#: The rules of op9 and the pipeline, where running text is wanted and lists and
#: tables are not.  The distance is the one that one in a hundred texts of
#: ``min_alone_words`` words drawn from a language reference exceeds (0.263 to 0.278,
#: by language); of 60 words, under five in a thousand do.  A text without any
#: common word is 0.284 away.  The character distance is the one that one in a thousand texts
#: of 250 code points, hardly more than ``min_alone_words`` words, drawn from the reference exceeds.
RUNNING_TEXT = QualityRules(max_common_alone=0.278)


def _js_distance(p: list[Column], q: list[float]) -> Column:
    """Square root of the Jensen-Shannon divergence in bits, 0 to 1."""
    total = F.lit(0.0)
    for a, b in zip(p, q, strict=True):
        m = (a + F.lit(b)) / 2
        total = total + F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
        if b > 0:
            total = total + F.lit(b) * F.log2(F.lit(b) / m)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def class_shares(text: Column, word_chars: Column) -> Column:
    """Shares of digits, white space, other ASCII signs and letters (all other
    code points) in a text with ``word_chars`` code points that aren't white space."""
    rest = F.regexp_replace(text, r"[A-Za-z\x20\x09-\x0D\x{80}-\x{10FFFF}]+", "")

    def shares(x: Column) -> Column:
        n = F.length(text)
        other = F.length(F.regexp_replace(x, "[0-9]+", ""))
        return F.array((F.length(x) - other) / n, (n - word_chars) / n, other / n,
                       (word_chars - F.length(x)) / n)

    return F.get(F.transform(F.array(rest), shares), F.lit(0))


def word_shares(ws: Column, common: list[str]) -> Column:
    """The share of each word of ``common`` among the words of a text."""
    longest = max(map(len, common))
    joined = F.lower(F.concat(F.lit(" "), F.array_join(
        F.filter(ws, lambda w: F.length(w) <= longest), "  "), F.lit(" ")))

    def shares(j: Column) -> Column:
        n = F.length(j)
        return F.array(*[(n - F.length(F.replace(j, F.lit(f" {w} "), F.lit(""))))
                         / F.lit(len(w) + 2) / F.size(ws) for w in common])

    return F.get(F.transform(F.array(joined), shares), F.lit(0))


def char_distance(shares: Column, reference: dict) -> Column:
    names = ["digit", "space", "other", "letter"]
    return _js_distance([F.get(shares, i) for i in range(len(names))],
                        [reference[k] for k in names])


def word_distance(shares: Column, references: dict, common: list[str]) -> Column:
    """Distance to the nearest language; words outside its list are one class."""
    distances = []
    for ref in references.values():
        p = [F.get(shares, common.index(w)) for w in ref]
        rest = F.greatest(F.lit(0.0), F.lit(1.0) - sum(p[1:], p[0]))
        distances.append(_js_distance([*p, rest], [*ref.values(), 1 - sum(ref.values())]))
    return F.least(*distances)


def window_hashes(ws: Column) -> Column:
    """A hash of each 3-word window; none for fewer words."""
    n = F.greatest(F.size(ws) - 2, F.lit(0))
    return F.transform(F.arrays_zip(F.slice(ws, 1, n), F.slice(ws, 2, n), F.slice(ws, 3, n)),
                       lambda z: F.xxhash64(z))


def repeated_words(h: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, the first included.

    Sorted by hash and place, windows with a neighbour of their own hash repeat; all
    64 bits count at any length.  The sorted starts of these give the words covered:
    each adds the distance to the next one, three at most.
    """
    def starts(a: Column) -> Column:
        placed = F.sort_array(F.transform(a, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            same = lambda e, o: F.coalesce(e["h"] == o["h"], F.lit(False))
            return F.filter(s, lambda e, j: same(e, F.get(s, j + 1)) | same(e, F.get(s, j - 1)))

        return F.sort_array(F.transform(
            F.get(F.transform(F.array(placed), repeats), F.lit(0)),
            lambda e: e["i"].cast("long")))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda a, j: F.least(
            F.lit(3).cast("long"), F.coalesce(F.get(p, j + 1) - a, F.lit(3).cast("long"))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    # one-element arrays bind a value once for all its uses
    covered = F.get(F.transform(F.transform(F.array(h), starts), total), F.lit(0))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")) \
        .otherwise(covered)


def measure(df: DataFrame, text_col: str = "text", rules: QualityRules | None = None) -> DataFrame:
    """``df`` with a struct column ``quality``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (long), char_distance, word_distance (double),
    base_failed, near_reference (whether its common words are near a language's; null where the
    text is too short or no rule asks), kept (boolean).

    A null text counts as empty: no words, all counts 0, distances null, and it
    fails by ``min_words``.  Rows are judged one by one, so repeated rows all
    get a verdict and an empty table gives an empty result; a column of ``df``
    that is itself named ``quality`` is replaced.
    """
    r = rules or QualityRules()
    text = F.coalesce(F.col(text_col), F.lit(""))
    ws = F.col("_q_words")
    lines = F.col("_q_lines")
    n = F.size(ws).cast("long")
    common = sorted({w for ref in r.common.values() for w in ref})
    alone = r.max_common_alone is not None
    least = min(r.min_common_words, r.min_alone_words) if alone else r.min_common_words
    # one projection per step: values that are used twice are named first
    d = (df.withColumn("_q_words", words(F.col(text_col), WHITE))
         .withColumn("_q_lines", F.filter(F.split(text, "\n"), lambda x: F.rlike(
             x, F.lit(r"[^\x20\x09-\x0D]"))))
         .withColumn("_q_hash", window_hashes(ws))
         .withColumn("_q_rep", repeated_words(F.col("_q_hash")))
         .withColumn("_q_n", F.length(F.array_join(ws, "")))
         .withColumn("_q_cs", F.when((F.length(text) >= r.min_chars) | F.lit(alone) & (F.size(ws) >= least),
                                     class_shares(text, F.col("_q_n"))))
         .withColumn("_q_ws", F.when(F.size(ws) >= least, word_shares(ws, common)))
         .withColumn("_q_cd", F.when(F.col("_q_cs").isNotNull(),
                                     char_distance(F.col("_q_cs"), r.chars)))
         .withColumn("_q_wd", F.when(F.col("_q_ws").isNotNull(),
                                     word_distance(F.col("_q_ws"), r.common, common))))
    failed = (n < r.min_words) | (100 * F.col("_q_rep") > r.max_repeat_pct * n)
    cd = F.when(F.length(text) >= r.min_chars, F.col("_q_cd"))
    far = (F.coalesce(cd > r.max_chars, F.lit(False))
           | F.coalesce((n >= r.min_common_words) & (F.col("_q_wd") > r.max_common)
                        & (cd > r.max_chars_odd), F.lit(False)))
    near = F.lit(None).cast("boolean")
    if alone:
        near = F.when(n >= r.min_alone_words, F.col("_q_wd") <= r.max_common_alone)
        signs = F.size(F.filter(ws, lambda w: ~F.rlike(w, F.lit(r"[A-Za-z0-9\x{80}-\x{10FFFF}]"))))
        odd = F.lit(True) if not r.keep_unknown else (
            (F.col("_q_cd") > r.max_chars_alone) | (signs > r.max_sign_words * n))
        far = far | F.when(~near, odd).otherwise(False)  # signs are counted for these only
    out = F.struct(
        n.alias("n_words"),
        F.col("_q_n").cast("long").alias("word_chars"),
        (F.size(F.split(text, f"[{SYMBOLS}]", -1)) - 1).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.col("_q_rep").alias("n_repeat_words"),
        cd.alias("char_distance"), F.col("_q_wd").alias("word_distance"),
        near.alias("near_reference"), failed.alias("base_failed"), (~failed & ~far).alias("kept"))
    return d.withColumn("quality", out).drop(
        "_q_words", "_q_lines", "_q_hash", "_q_rep", "_q_n", "_q_cs", "_q_ws", "_q_cd", "_q_wd")


def keep_good(df: DataFrame, text_col: str = "text",
              rules: QualityRules | None = None) -> DataFrame:
    """The rows of ``df`` that pass, with its own columns."""
    judged = measure(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                               F.col(f"`{text_col}`").alias("_t")), "_t", rules)
    # a filter would be pushed below the measuring steps and repeat them per use
    passed = F.array_repeat("_row", F.col("quality.kept").cast("int"))
    return judged.select(F.explode(passed).alias("_row")).select("_row.*")
