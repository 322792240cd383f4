"""Evaluation metrics as aggregations: confusion matrix, per-class and macro
metrics, classification report, binary metrics, tie-aware ROC AUC, slices,
business rates and scorer agreement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ranking import attach_totals, prefix_sums


def _div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_matrix(df: DataFrame, actual: str, pred: str, labels: Sequence[int]) -> DataFrame:
    """Rows = actual label, one column per predicted label (fixed order), zeros filled."""
    names = {lab: f"pred_{'m' if lab < 0 else ''}{abs(lab)}" for lab in labels}
    g = df.groupBy(actual).pivot(pred, list(labels)).agg(F.count(F.lit(1)))
    for lab in labels:
        g = g.withColumnRenamed(str(lab), names[lab])
    return g.fillna(0, list(names.values())).select(actual, *[F.col(n).cast("long") for n in names.values()])


def per_class(df: DataFrame, actual: str, pred: str, labels: Sequence[int]) -> DataFrame:
    """precision / recall / F1 / support per label (0 where a denominator is 0);
    one aggregation pass over the data, then a tiny unpivot."""
    aggs = []
    for lab in labels:
        a, p = F.col(actual) == lab, F.col(pred) == lab
        aggs += [F.sum((a & p).cast("long")).alias(f"tp_{lab}"), F.sum(p.cast("long")).alias(f"pp_{lab}"),
                 F.sum(a.cast("long")).alias(f"sup_{lab}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(lab).alias("label"), F.coalesce(F.col(f"tp_{lab}"), F.lit(0)).alias("tp"),
                     F.coalesce(F.col(f"pp_{lab}"), F.lit(0)).alias("pp"),
                     F.coalesce(F.col(f"sup_{lab}"), F.lit(0)).alias("support")) for lab in labels]
    long = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    prec = _div(F.col("tp"), F.col("pp"))
    rec = _div(F.col("tp"), F.col("support"))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return long.select("label", prec.alias("precision"), rec.alias("recall"), f1.alias("f1_score"),
                       F.col("support").cast("long").alias("support"), "tp")


def macro_metrics(df: DataFrame, actual: str, pred: str, labels: Sequence[int]) -> DataFrame:
    pc = per_class(df, actual, pred, labels)
    return pc.agg(F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
                  F.avg("f1_score").alias("macro_f1"),
                  (F.sum("tp") / F.sum("support")).alias("accuracy"))


def classification_report(df: DataFrame, actual: str, pred: str, labels: Sequence[int],
                          names: dict | None = None) -> DataFrame:
    """Per-class rows, then accuracy, macro avg and weighted avg (support-weighted)."""
    pc = per_class(df, actual, pred, labels)
    nm = names or {}
    name = F.element_at(F.create_map(*[x for k, v in nm.items() for x in (F.lit(k), F.lit(v))]), F.col("label")) \
        if nm else F.col("label").cast("string")
    cls = pc.select(name.alias("row"), "precision", "recall", "f1_score", "support")
    tot = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
                 F.sum(F.col("precision") * F.col("support")).alias("wp"),
                 F.sum(F.col("recall") * F.col("support")).alias("wr"),
                 F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), _div(F.col("tp"), F.col("n")).alias("f1_score"),
                     F.col("n").alias("support"))
    mac = tot.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                     F.col("mf").alias("f1_score"), F.col("n").alias("support"))
    wei = tot.select(F.lit("weighted avg").alias("row"), _div(F.col("wp"), F.col("n")).alias("precision"),
                     _div(F.col("wr"), F.col("n")).alias("recall"), _div(F.col("wf"), F.col("n")).alias("f1_score"),
                     F.col("n").alias("support"))
    return cls.unionByName(acc).unionByName(mac).unionByName(wei)


def binary_metrics(df: DataFrame, label: str, pred: str, groups: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    tp = F.sum((y & p).cast("long"))
    fp = F.sum((~y & p).cast("long"))
    fn = F.sum((y & ~p).cast("long"))
    tn = F.sum((~y & ~p).cast("long"))
    g = df.groupBy(*groups).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return g.select(*groups, "tp", "fp", "fn", "tn", prec.alias("precision"), rec.alias("recall"),
                    f1.alias("f1"), _div(F.col("tp") + F.col("tn"), n).alias("accuracy"))


def roc_auc(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Exact, tie-aware ROC AUC (Mann-Whitney): per distinct score the positive
    and negative counts; AUC = sum(pos * (neg_below + neg/2)) / (P * N).
    Ranks come from distributed prefix sums over distinct scores."""
    groups = list(groups)
    per = df.groupBy(*groups, score).agg(F.sum((F.col(label) == 1).cast("long")).alias("_pos"),
                                         F.sum((F.col(label) != 1).cast("long")).alias("_neg"))
    return auc_of_counts(per, score, groups)


def auc_of_counts(per: DataFrame, score: str, groups: Sequence[str], also: Sequence = ()) -> DataFrame:
    """``roc_auc`` of one row per (groups, score) with its counts ``_pos`` and ``_neg``, and
    the aggregates ``also`` over the same rows."""
    ranked = prefix_sums(per, score, ["_neg"], groups)
    part = ranked.groupBy(*groups).agg(
        F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") * 0.5)).alias("_u"),
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"), *also)
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("_u") / (F.col("n_pos") * F.col("n_neg")))
    rest = [c for c in part.columns if c not in (*groups, "_u", "n_pos", "n_neg")]
    return part.select(*groups, "n_pos", "n_neg", auc.alias("auc"), *rest)


def slice_metrics(df: DataFrame, label: str, pred: str, score: str, slices: Sequence[Sequence[str]]) -> DataFrame:
    """Binary metrics and AUC of every slice of every list of columns in ``slices`` (an empty
    list: all rows), in one scan: (slice, slice_value, n, tp, fp, fn, tn, precision, recall, f1, auc).

    GROUPING SETS reduce the rows to one per (list, values, score), from which confusion
    counts and AUC follow.  ``slice`` names the columns (joined by a comma, '' for all rows);
    ``slice_value`` is their values as an array of strings.  A null value is a slice of its own: rows
    are told apart by the grouping's number, not by nulls.
    """
    y, p = F.col(label) == 1, F.col(pred) == 1
    names = list(dict.fromkeys(c for s in slices for c in s))
    base = df.select(*[F.col(c).cast("string").alias(f"_s{i}") for i, c in enumerate(names)],
                     F.col(score).alias("_score"), F.coalesce(y, F.lit(False)).alias("_y"),
                     F.coalesce(p, F.lit(False)).alias("_p"))
    column = {c: f"_s{i}" for i, c in enumerate(names)}
    sets = [[*[F.col(column[c]) for c in s], F.col("_score")] for s in slices]
    n = lambda c: F.sum(c.cast("long"))
    per = base.groupingSets(sets, *[F.col(column[c]) for c in names], F.col("_score")).agg(
        F.grouping_id().alias("_set"), n(F.col("_y")).alias("_pos"), n(~F.col("_y")).alias("_neg"),
        n(F.col("_y") & F.col("_p")).alias("_tp"), n(~F.col("_y") & F.col("_p")).alias("_fp"))
    # the grouping's number has a bit for each column that the set leaves out, the score's last
    number = {sum(0 if c in s else 1 << len(names) - i for i, c in enumerate(names)): s for s in slices}
    if len(number) < len(slices):
        raise ValueError("slices repeat a set of columns")
    tag, value = None, None
    for k, s in number.items():
        is_set = F.col("_set") == k
        text, values = F.lit(",".join(s)), F.array(*[F.col(column[c]) for c in s]).cast("array<string>")
        tag = F.when(is_set, text) if tag is None else tag.when(is_set, text)
        value = F.when(is_set, values) if value is None else value.when(is_set, values)
    told = per.select(tag.alias("slice"), value.alias("slice_value"), "_score", "_pos", "_neg", "_tp", "_fp")
    out = auc_of_counts(told, "_score", ["slice", "slice_value"],
                        [F.sum("_tp").alias("tp"), F.sum("_fp").alias("fp")])
    out = out.withColumn("fn", F.col("n_pos") - F.col("tp")).withColumn("tn", F.col("n_neg") - F.col("fp"))
    prec, rec = _div(F.col("tp"), F.col("tp") + F.col("fp")), _div(F.col("tp"), F.col("n_pos"))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return out.select("slice", "slice_value", (F.col("n_pos") + F.col("n_neg")).alias("n"), "tp", "fp", "fn", "tn",
                      prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), "auc")


def scorer_agreement(a: DataFrame, b: DataFrame, key: str, score: str, cut: float = 0.5) -> DataFrame:
    j = a.select(key, F.col(score).alias("_a")).join(b.select(key, F.col(score).alias("_b")), key)
    same = ((F.col("_a") > cut) == (F.col("_b") > cut)).cast("double")
    return j.agg(F.count(F.lit(1)).alias("n"), F.avg(same).alias("agreement_rate"),
                 F.avg(F.abs(F.col("_a") - F.col("_b"))).alias("mean_abs_diff"))
