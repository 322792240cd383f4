"""Projections, encodings and request shaping (feature matrix side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.joins import bounded_broadcast
from tessera.functions.ranking import dense_codes
from tessera.sources.schemas import FRAUD_MODEL_SCHEMA

# Merchant category maps of the two scoring services, default code 4.
CATEGORY_MAP_SERVICE = {"Electronics": 0, "Travel": 1, "Grocery": 2, "Dining": 3, "Other": 4}
CATEGORY_MAP_STORE_SERVICE = {
    "Grocery": 0, "Gas": 1, "Restaurant": 2, "Retail": 3, "Other": 4,
    "Travel": 5, "Entertainment": 6, "Healthcare": 7, "Electronics": 8,
}
CATEGORY_DEFAULT_CODE = 4


def fit_category_codes(df: DataFrame, col: str) -> DataFrame:
    """Alphabetical codes 0..k-1 of the distinct non-null values (a code table)."""
    return dense_codes(df, col, code_col="code")


def apply_category_codes(df: DataFrame, col: str, codes: DataFrame, out_col: str | None = None,
                         missing_code: int = -1, max_codes: int | None = 100_000) -> DataFrame:
    """Replace ``col`` by its code; null and unseen values get ``missing_code``.

    The code table is broadcast, so the rows are not shuffled by a few values; a code
    of ``max_codes`` or more fails the query.  None lifts the limit: the join shuffles."""
    out_col = out_col or col
    code = F.col("code")
    if max_codes is not None:
        code = F.when(code >= max_codes, F.raise_error(F.lit(f"more than {max_codes} codes"))).otherwise(code)
    table = codes.select(col, code.alias("_code"))
    joined = df.join(bounded_broadcast(table, bound=max_codes), on=col, how="left")
    return joined.withColumn(out_col, F.coalesce(F.col("_code"), F.lit(missing_code))).drop("_code")


def category_codes(df: DataFrame, col: str = "merchant_category") -> DataFrame:
    """Fit on ``df`` and apply to it (the training-time encoding)."""
    codes = fit_category_codes(df, col)
    return apply_category_codes(df, col, codes, out_col=col + "_code")


def map_codes(col: str | Column, mapping: dict, default: int = CATEGORY_DEFAULT_CODE) -> Column:
    """Static dictionary encoding with a default for unknown or null values."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), F.lit(default)) \
        if mapping else F.lit(default)


def binary_category(col: str | Column, positive_zero: str = "Grocery") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.lit(positive_zero), 0).otherwise(1)


def encoding_skew(df: DataFrame, col: str = "merchant_category") -> DataFrame:
    """One row per distinct category with the codes of the training encoding and
    the two serving encodings; ``skew`` is true when they disagree."""
    fitted = fit_category_codes(df, col)
    return (fitted.select(
        F.col(col).alias("category"),
        F.col("code").alias("train_code"),
        map_codes(col, CATEGORY_MAP_SERVICE).alias("serve_code"),
        map_codes(col, CATEGORY_MAP_STORE_SERVICE).alias("store_serve_code"),
        binary_category(col).alias("binary_code"))
        .withColumn("skew", (F.col("train_code") != F.col("serve_code"))
                    | (F.col("serve_code") != F.col("store_serve_code"))))


def feature_matrix(df: DataFrame, codes: DataFrame | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """The eight model features in model order, typed as the model expects
    (int8 category code)."""
    codes = codes if codes is not None else fit_category_codes(df, "merchant_category")
    coded = apply_category_codes(df, "merchant_category", codes)
    return coded.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name)
                                 for f in FRAUD_MODEL_SCHEMA.fields])


def weighted_text(books: DataFrame, min_len: int = 10) -> DataFrame:
    """Weighted catalog text: title x2, subtitle, authors x2, categories x3,
    search_category x2, description; nulls as '', lower-cased and stripped,
    keep rows longer than ``min_len`` characters."""
    fields = ["title", "subtitle", "authors", "description", "categories", "publisher", "search_category"]
    filled = books.na.fill("", subset=fields)
    order = (["title"] * 2 + ["subtitle"] + ["authors"] * 2 + ["categories"] * 3
             + ["search_category"] * 2 + ["description"])
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in order]))
    # the regex's $ also stands before one last of these characters; other texts are trimmed without it
    cleaned = F.when(F.right(text, F.lit(1)).isin("\u0085", "\u2028", "\u2029"), F.regexp_replace(text, r"^\s+|\s+$", "")) \
        .otherwise(F.btrim(text, F.lit(" \t\n\x0b\f\r")))
    # made by a generator: a plain column would be made a second time for the filter under it
    return (filled.select("*", F.explode_outer(F.array(cleaned)).alias("combined_features"))
            .where(F.length("combined_features") > min_len))


def truncate_text(col: str | Column, n: int = 200) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.substring(c, 1, n), F.lit(""))


def zero_pad_id(col: str | Column, prefix: str = "user_", width: int = 4) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"{prefix}%0{width}d", c)


def move_column(df: DataFrame, col: str, after: str | None = None) -> DataFrame:
    """Column order: ``col`` right after ``after`` (or first when None)."""
    rest = [c for c in df.columns if c != col]
    if after is None:
        return df.select(col, *rest)
    i = rest.index(after) + 1
    return df.select(*rest[:i], col, *rest[i:])


def threshold_decision(prob: str | Column, cut: float = 0.5) -> tuple[Column, Column]:
    p = F.col(prob) if isinstance(prob, str) else prob
    flag = p > F.lit(cut)
    return flag, F.when(flag, F.lit("FRAUD")).otherwise(F.lit("LEGIT"))


# Sentiment label names.
SENTIMENT_NAMES = {-1: "Negative", 0: "Neutral", 1: "Positive"}


def label_name(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.element_at(
        F.create_map(*[x for k, v in SENTIMENT_NAMES.items() for x in (F.lit(k), F.lit(v))]), c)


def override_by_class(df: DataFrame, classes: DataFrame, key: str, class_col: str,
                      overrides: dict[str, dict]) -> DataFrame:
    """Set features of the keys listed in ``classes`` (one row per key) to the values
    of their class; other rows keep theirs."""
    out = df.join(classes.select(key, F.col(class_col).alias("_class")), key, "left")
    for c in sorted({c for values in overrides.values() for c in values}):
        new = F.col(c)
        for name, values in overrides.items():
            if c in values:
                new = F.when(F.col("_class") == name, F.lit(values[c])).otherwise(new)
        out = out.withColumn(c, new)
    return out.drop("_class")


#: The code points that Unicode counts as white space, as Python's ``str.strip`` does.
WHITE_SPACE = "\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def blank_text(col: str):
    """Whether a text is null or holds nothing but white space of any script."""
    return F.col(col).isNull() | ~F.rlike(F.col(col), F.lit(f"[^{WHITE_SPACE}]"))
