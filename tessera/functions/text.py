"""Text expressions that stay inside the JVM: lower-casing, accent stripping,
tokenising, stop words, 1-2-grams and in-row term counting."""

from __future__ import annotations

import functools
import glob
import os
import unicodedata
import zipfile

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: token rule equivalent to the vectoriser's (?u)\b\w\w+\b
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


@functools.lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(from, to) strings for ``translate``: every Latin letter whose canonical
    decomposition is one base letter plus combining marks maps to that letter.
    Built from the Unicode database over the Latin blocks (a rule, not a list)."""
    src, dst = [], []
    for cp in list(range(0x00C0, 0x0250)) + list(range(0x1E00, 0x1F00)):
        ch = chr(cp)
        dec = unicodedata.normalize("NFKD", ch)
        base = "".join(c for c in dec if not unicodedata.combining(c))
        if len(base) == 1 and base != ch and len(dec) > 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    s, d = accent_table()
    # in ASCII texts nothing is looked up
    return F.when(F.octet_length(c) > F.char_length(c), F.translate(c, s, d)).otherwise(c)


def tokens(col: str | Column, accents: bool = True) -> Column:
    """Lower-case, then strip accents, then words of two or more word characters."""
    c = F.col(col) if isinstance(col, str) else col
    low = F.lower(c)
    if accents:
        low = strip_accents(low)
    return F.regexp_extract_all(low, F.lit(TOKEN_PATTERN), 0)


@functools.lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop-word list, read from the MLlib jar."""
    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for j in jars:
        with zipfile.ZipFile(j) as z:
            name = "org/apache/spark/ml/feature/stopwords/english.txt"
            if name in z.namelist():
                return tuple(z.read(name).decode("utf-8").split())
    from pyspark.ml.feature import StopWordsRemover
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def remove_stop_words(arr: Column, words=None) -> Column:
    """Drop stop words from a token array: each token is looked up in the set of them."""
    stop = list(words if words is not None else english_stop_words())
    if not stop:
        return arr
    return F.filter(arr, lambda x: ~x.isin(stop))


def bigrams(arr: Column) -> Column:
    """Adjacent token pairs 'a b', as one native regex over the space-joined
    tokens (a lookahead anchored at each token start)."""
    return F.regexp_extract_all(F.array_join(arr, " "), F.lit(r"(?:^| )(?=(\S+ \S+))"), 1)


def uni_and_bigrams(arr: Column) -> Column:
    return F.concat(arr, bigrams(arr))


def terms_sql(col: str) -> str:
    """``uni_and_bigrams(tokens(col))`` as SQL text, for stages that are saved with a model."""
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    src, dst = accent_table()
    low = f"translate(lower(coalesce(`{col}`, '')), {quoted(src)}, {quoted(dst)})"
    toks = f"regexp_extract_all({low}, {quoted(TOKEN_PATTERN)}, 0)"
    pairs = quoted(r"(?:^| )(?=(\S+ \S+))")
    return f"concat({toks}, regexp_extract_all(array_join({toks}, ' '), {pairs}, 1))"
