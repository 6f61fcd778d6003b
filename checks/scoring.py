"""Evaluation of a prediction table."""

from __future__ import annotations

from checks.registry import check
from checks.views import view, with_views
from tidemark import rules
from tidemark.operators import explain as ex, metrics as me

LONG = (
    "SELECT entity_id, y_true AS y, 'model_a' AS model, model_a_probability AS p FROM predictions "
    "UNION ALL SELECT entity_id, y_true, 'model_b', model_b_probability FROM predictions"
)


def scored(query, views="predictions", **ctes):
    return with_views(views, query, long=LONG, **ctes)


def long(spark, sf):
    return me.to_long(view(spark, sf, "predictions"))


def points_sql(by="model", source="long"):
    """Per distinct score, counts at it and strictly above it."""
    window = f"OVER (PARTITION BY {by} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (
        f"SELECT *, coalesce(sum(pos) {window}, 0) AS pos_above, coalesce(sum(neg) {window}, 0) AS neg_above, "
        f"sum(pos) OVER (PARTITION BY {by}) AS np, sum(neg) OVER (PARTITION BY {by}) AS nn "
        f"FROM (SELECT {by}, p AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM {source} GROUP BY ALL)"
    )


AUROC = "sum(neg * (pos_above + pos / 2)) / (max(np) * max(nn))"
AP = "sum(pos / np * (pos_above + pos) / (pos_above + pos + neg_above + neg))"
RATES = (
    "tp / CAST(nullif(tp + fn, 0) AS DOUBLE) AS sensitivity, tn / CAST(nullif(tn + fp, 0) AS DOUBLE) AS specificity, "
    "tp / CAST(nullif(tp + fp, 0) AS DOUBLE) AS ppv, tn / CAST(nullif(tn + fn, 0) AS DOUBLE) AS npv, "
    "(tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy"
)
F1 = "2 * ppv * sensitivity / nullif(ppv + sensitivity, 0) AS f1"
CELLS = (
    "count(*) FILTER (y = 0 AND p < t) AS tn, count(*) FILTER (y = 0 AND p >= t) AS fp, "
    "count(*) FILTER (y = 1 AND p < t) AS fn, count(*) FILTER (y = 1 AND p >= t) AS tp"
)
RATE_NAMES = "sensitivity specificity ppv npv accuracy f1"


def rates_sql(source):
    return f"SELECT *, {F1} FROM (SELECT *, {RATES} FROM ({source}))"


def cells_sql(threshold):
    return f"SELECT model, {CELLS} FROM (SELECT *, CAST({threshold} AS DOUBLE) AS t FROM long) GROUP BY model"


@check("K01_wide_to_long", scored("SELECT y, model, p FROM long"), "p")
def _(spark, sf):
    return long(spark, sf)


@check("K02_auroc", scored(f"SELECT model, {AUROC} AS roc_auc FROM points GROUP BY model", points=points_sql()), "roc_auc")
def _(spark, sf):
    return me.auroc(long(spark, sf))


@check(
    "K03_average_precision",
    scored(f"SELECT model, {AP} AS average_precision FROM points GROUP BY model", points=points_sql()),
    "average_precision",
)
def _(spark, sf):
    return me.average_precision(long(spark, sf))


@check("K04_brier_score", scored("SELECT model, avg((p - y) * (p - y)) AS brier_score FROM long GROUP BY model"), "brier_score")
def _(spark, sf):
    return me.brier(long(spark, sf))


@check("E14_confusion_counts", scored(cells_sql("0.5")))
def _(spark, sf):
    return me.confusion(long(spark, sf))


@check("K05_K07_metrics_at_half", scored(rates_sql(f"SELECT *, CAST(0.5 AS DOUBLE) AS threshold FROM ({cells_sql('0.5')})")), RATE_NAMES)
def _(spark, sf):
    return me.threshold_metrics(long(spark, sf), 0.5)


@check("K05_metrics_beyond_all_scores", scored(rates_sql(f"SELECT *, CAST(2 AS DOUBLE) AS threshold FROM ({cells_sql('2')})")), RATE_NAMES)
def _(spark, sf):
    return me.threshold_metrics(long(spark, sf), 2.0)


SWEEP = rates_sql(
    f"SELECT model, t AS threshold, {CELLS} FROM long, "
    "(SELECT CAST(0.05 AS DOUBLE) + i * CAST(0.05 AS DOUBLE) AS t FROM range(19) AS r(i)) GROUP BY model, t"
)


@check("K06_threshold_sweep", scored(SWEEP), f"threshold {RATE_NAMES}")
def _(spark, sf):
    return me.threshold_sweep(long(spark, sf)).selectExpr(
        "model", "threshold", "tn", "fp", "fn", "tp", *RATE_NAMES.split()
    )


@check(
    "K08_roc_points",
    scored(
        "SELECT model, score AS threshold, (neg_above + neg) / nn AS fpr, (pos_above + pos) / np AS tpr FROM points "
        "UNION ALL SELECT DISTINCT model, CAST('Infinity' AS DOUBLE), 0, 0 FROM long",
        points=points_sql(),
    ),
    "fpr tpr",
)
def _(spark, sf):
    return me.roc_curve(long(spark, sf))


@check(
    "K09_precision_recall_points",
    scored(
        "SELECT model, score AS threshold, (pos_above + pos) / (pos_above + pos + neg_above + neg) AS precision, "
        "(pos_above + pos) / np AS recall FROM points UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1, 0 FROM long",
        points=points_sql(),
    ),
    "precision recall",
)
def _(spark, sf):
    return me.pr_curve(long(spark, sf))


@check("K10_prevalence_baseline", scored("SELECT model, avg(y) AS prevalence FROM long GROUP BY model"), "prevalence")
def _(spark, sf):
    return me.event_rate(long(spark, sf))


@check(
    "K11_calibration_curve",
    scored(
        "SELECT model, CAST(len(list_filter(edges, lambda e: e < p)) AS INT) AS bin, avg(p) AS mean_predicted, "
        "avg(y) AS fraction_positive, count(*) AS n FROM long JOIN edge USING (model) GROUP BY 1, 2",
        edge="SELECT model, quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM long GROUP BY model",
    ),
    "mean_predicted fraction_positive",
)
def _(spark, sf):
    return me.calibration_curve(long(spark, sf))


# The same Newton steps.
NEWTON = {
    "xs": "SELECT model, CAST(y AS DOUBLE) AS y, ln(q / (1 - q)) AS x FROM (SELECT *, least(greatest(p, 1e-6), 1 - 1e-6) AS q FROM long)",
    "fit": "SELECT model, 0 AS k, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM (SELECT DISTINCT model FROM long) UNION ALL "
    "SELECT model, k + 1, a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) "
    "FROM (SELECT model, k, a, b, sum(y - f) AS g0, sum((y - f) * x) AS g1, sum(f * (1 - f)) AS h00, sum(f * (1 - f) * x) AS h01, "
    "sum(f * (1 - f) * x * x) AS h11 FROM (SELECT *, 1 / (1 + exp(-(a + b * x))) AS f FROM fit JOIN xs USING (model) WHERE k < 15) GROUP BY ALL)",
}
SLOPES = "SELECT model, a AS calibration_intercept, b AS calibration_slope FROM fit WHERE k = 15"


@check("K12_calibration_slope", scored(SLOPES, **NEWTON).replace("WITH ", "WITH RECURSIVE ", 1), "calibration_intercept calibration_slope")
def _(spark, sf):
    return me.calibration_slope(long(spark, sf), ["model_a", "model_b"])


# Scores with two values make the logistic fit pass through both event rates.
TWO_VALUED = "CASE WHEN p < 0.25 THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END"


@check(
    "K12_calibration_slope_of_two_scores",
    scored(
        "SELECT model, round(lo - (hi - lo) / (ln(0.6 / 0.4) - ln(0.2 / 0.8)) * ln(0.2 / 0.8), 3) AS calibration_intercept, "
        "round((hi - lo) / (ln(0.6 / 0.4) - ln(0.2 / 0.8)), 3) AS calibration_slope FROM (SELECT model, "
        "max(CASE WHEN p < 0.5 THEN ln(r / (1 - r)) END) AS lo, max(CASE WHEN p > 0.5 THEN ln(r / (1 - r)) END) AS hi "
        f"FROM (SELECT model, {TWO_VALUED} AS p, avg(y) AS r FROM long GROUP BY ALL) GROUP BY model)"
    ),
)
def _(spark, sf):
    rows = long(spark, sf).selectExpr("model", "y", f"{TWO_VALUED} AS p")
    fit = me.calibration_slope(rows, ["model_a", "model_b"])
    return fit.selectExpr("model", *[f"round({c}, 3) AS {c}" for c in ("calibration_intercept", "calibration_slope")])


@check(
    "K13_confusion_matrix",
    scored(
        "SELECT model, observed, predicted, CAST(sum(hit) AS BIGINT) AS n FROM (SELECT model, o AS observed, q AS predicted, "
        "CASE WHEN y = o AND CAST(p >= 0.5 AS INT) = q THEN 1 ELSE 0 END AS hit "
        "FROM long, (VALUES (0), (1)) a(o), (VALUES (0), (1)) b(q)) GROUP BY ALL"
    ),
)
def _(spark, sf):
    return me.confusion_cells(me.confusion(long(spark, sf)))


@check(
    "K14_threshold_series",
    scored(
        "UNPIVOT (SELECT model, threshold, coalesce(sensitivity, -1) AS sensitivity, coalesce(specificity, -1) AS specificity, "
        f"coalesce(ppv, -1) AS ppv, coalesce(npv, -1) AS npv FROM ({SWEEP})) "
        "ON sensitivity, specificity, ppv, npv INTO NAME metric VALUE value"
    ).replace("UNPIVOT (", "SELECT model, threshold, metric, nullif(value, -1) AS value FROM (UNPIVOT (", 1) + ")",
    "threshold value",
)
def _(spark, sf):
    return me.threshold_series(me.threshold_sweep(long(spark, sf)))


PERFORMANCE = (
    f"SELECT * FROM (SELECT model, {AUROC} AS roc_auc, {AP} AS average_precision FROM points GROUP BY model) "
    "JOIN (SELECT model, avg((p - y) * (p - y)) AS brier_score FROM long GROUP BY model) USING (model)"
)


@check("K15_performance", scored(PERFORMANCE, points=points_sql()), "roc_auc average_precision brier_score")
def _(spark, sf):
    return me.performance(long(spark, sf))


@check(
    "D13_performance_with_calibration",
    scored(
        f"SELECT s.*, c.mean_p, c.mean_y FROM ({PERFORMANCE}) s LEFT JOIN "
        "(SELECT model, avg(p) AS mean_p, avg(y) AS mean_y FROM long WHERE model = 'model_a' GROUP BY model) c USING (model)",
        points=points_sql(),
    ),
    "roc_auc average_precision brier_score mean_p mean_y",
)
def _(spark, sf):
    rows = long(spark, sf)
    calibration = rows.filter("model = 'model_a'").groupBy("model").agg({"p": "avg", "y": "avg"})
    calibration = calibration.withColumnsRenamed({"avg(p)": "mean_p", "avg(y)": "mean_y"})
    return me.performance_summary(me.performance(rows), calibration)


@check(
    "K15_performance_with_slope",
    scored(f"SELECT * FROM ({PERFORMANCE}) JOIN ({SLOPES}) USING (model)", points=points_sql(), **NEWTON).replace("WITH ", "WITH RECURSIVE ", 1),
    "roc_auc average_precision brier_score calibration_intercept calibration_slope",
)
def _(spark, sf):
    rows = long(spark, sf)
    return me.performance_summary(me.performance(rows), me.calibration_slope(rows, ["model_a", "model_b"]))


# -- subgroups -----------------------------------------------------------------

MEMBERS = " UNION ALL ".join(f"SELECT *, '{n}' AS subgroup FROM attached WHERE {r}" for n, r in rules.SUBGROUPS.items())
SUBGROUP_CTES = {
    "attached": "SELECT * FROM long JOIN attributes USING (entity_id)",
    "members": MEMBERS,
}


def attached(spark, sf):
    rows = me.to_long(view(spark, sf, "predictions"), keep=["entity_id"])
    return ex.attach(rows, view(spark, sf, "attributes"), "entity_id")


@check(
    "D14_attach_attributes",
    scored("SELECT * FROM attached", "predictions attributes", attached=SUBGROUP_CTES["attached"]),
    "p",
)
def _(spark, sf):
    return attached(spark, sf)


@check(
    "C16_subgroup_members",
    scored("SELECT subgroup, model, entity_id FROM members", "predictions attributes", **SUBGROUP_CTES),
)
def _(spark, sf):
    return ex.subgroups(attached(spark, sf)).select("subgroup", "model", "entity_id")


SUBGROUP_PERFORMANCE = (
    "SELECT * FROM (SELECT subgroup, model, count(*) AS n, CAST(sum(y) AS BIGINT) AS events, avg(y) AS event_rate "
    "FROM members GROUP BY ALL HAVING count(*) >= 50 AND count(DISTINCT y) = 2) JOIN "
    f"(SELECT subgroup, model, {AUROC} AS roc_auc, {AP} AS average_precision FROM points GROUP BY ALL) USING (subgroup, model)"
)


@check(
    "L05_subgroup_performance",
    scored(SUBGROUP_PERFORMANCE, "predictions attributes", **SUBGROUP_CTES, points=points_sql("subgroup, model", "members")),
    "event_rate roc_auc average_precision",
)
def _(spark, sf):
    return ex.subgroup_performance(attached(spark, sf))
