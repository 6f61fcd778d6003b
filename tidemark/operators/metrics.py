"""Binary-classifier evaluation from a long table (model, y, p)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalar import clipped_logit
from tidemark.operators.profile import require_columns
from tidemark.operators.ranking import exact_quantiles, running_totals
from tidemark.session import stage

SUFFIX = "_probability"

# Newton steps of a calibration line after which it counts as having no finite fit.
NEWTON_STEPS = 60

# Start, step and number of thresholds in a sweep.
SWEEP_START, SWEEP_STEP, SWEEP_SIZE = 0.05, 0.05, 19


def sweep_thresholds() -> list[float]:
    return [SWEEP_START + i * SWEEP_STEP for i in range(SWEEP_SIZE)]


def _score(p: str, probability: bool = False) -> Column:
    """The score, where a null or NaN (or no probability) ends the job: a metric
    over fewer rows than were given would be wrong without a sign."""
    bad = F.col(p).isNull() | F.isnan(F.col(p).cast("double"))
    if probability:
        bad = bad | (F.col(p) < 0) | (F.col(p) > 1)
    text = "a score is null, NaN or no probability" if probability else "a score is null or NaN"
    return F.when(bad, F.raise_error(F.lit(text)).cast("double")).otherwise(F.col(p).cast("double"))


def to_long(predictions: DataFrame, y: str = "y_true", keep: Sequence[str] = ()) -> DataFrame:
    """(keep, y, model, p): one row per entity and `<model>_probability` column."""
    require_columns(predictions, [y])
    columns = [c for c in predictions.columns if c.endswith(SUFFIX)]
    if not columns:
        raise ValueError(f"no column ends with {SUFFIX}")
    models = [F.col(c).alias(c.removesuffix(SUFFIX)) for c in columns]
    names = [c.removesuffix(SUFFIX) for c in columns]
    ids = [*keep, y]
    return predictions.select(*ids, *models).unpivot(ids, names, "model", "p").withColumnRenamed(y, "y")


def score_points(
    long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p", most: int | None = None
) -> DataFrame:
    """Per distinct score: positives and negatives at it and strictly above it.

    Equal scores collapse before the shuffle, so a constant score is no hot spot.
    `most` is the rows that a group has at most, where that is known.
    """
    counts = long.groupBy(*by, _score(p).alias("score")).agg(
        F.sum(F.col(y)).cast("long").alias("pos"), F.sum(1 - F.col(y)).cast("long").alias("neg")
    )
    return running_totals(counts, by, "score", ["pos", "neg"], most=most)


def ranking_metrics(
    long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p", most: int | None = None
) -> DataFrame:
    """AUROC (ties count half) and step-wise average precision per group.

    Null where a class is absent.
    """
    d = {c: F.col(c).cast("double") for c in ("pos", "neg", "pos_above", "neg_above")}
    precision = (d["pos_above"] + d["pos"]) / (d["pos_above"] + d["pos"] + d["neg_above"] + d["neg"])
    sums = score_points(long, by, y, p, most).groupBy(*by).agg(
        F.sum(d["neg"] * (d["pos_above"] + d["pos"] / 2)).alias("_won"),
        F.sum(d["pos"] * precision).alias("_precision"),
        F.sum(d["pos"]).alias("_pos"),
        F.sum(d["neg"]).alias("_neg"),
    )
    return sums.select(
        *by,
        F.try_divide(F.col("_won"), F.col("_pos") * F.col("_neg")).alias("roc_auc"),
        F.try_divide(F.col("_precision"), F.col("_pos")).alias("average_precision"),
    )


def auroc(long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p") -> DataFrame:
    return ranking_metrics(long, by, y, p).select(*by, "roc_auc")


def average_precision(long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p") -> DataFrame:
    return ranking_metrics(long, by, y, p).select(*by, "average_precision")


def brier(long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p") -> DataFrame:
    return long.groupBy(*by).agg(F.avg((_score(p, probability=True) - F.col(y)) ** 2).alias("brier_score"))


def event_rate(long: DataFrame, by: Sequence[str] = ("model",), y: str = "y") -> DataFrame:
    """The precision of random scores."""
    return long.groupBy(*by).agg(F.avg(y).alias("prevalence"))


def confusion(
    long: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",), y: str = "y", p: str = "p"
) -> DataFrame:
    positive, predicted = F.col(y) == 1, _score(p) >= F.lit(float(threshold))
    return long.groupBy(*by).agg(
        F.count_if(~positive & ~predicted).alias("tn"),
        F.count_if(~positive & predicted).alias("fp"),
        F.count_if(positive & ~predicted).alias("fn"),
        F.count_if(positive & predicted).alias("tp"),
    )


def confusion_cells(counts: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Confusion counts as (observed, predicted, n) rows."""
    cells = F.array(
        *[
            F.struct(F.lit(o).alias("observed"), F.lit(q).alias("predicted"), F.col(c).alias("n"))
            for c, o, q in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        ]
    )
    return counts.select(*by, F.inline(cells))


def with_rates(counts: DataFrame) -> DataFrame:
    """Rates from tn, fp, fn, tp; null where a denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rated = counts.withColumns(
        {
            "sensitivity": F.try_divide(tp, tp + fn),
            "specificity": F.try_divide(tn, tn + fp),
            "ppv": F.try_divide(tp, tp + fp),
            "npv": F.try_divide(tn, tn + fn),
            "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
        }
    )
    ppv, sensitivity = F.col("ppv"), F.col("sensitivity")
    return rated.withColumn("f1", F.try_divide(2 * ppv * sensitivity, ppv + sensitivity))


def threshold_metrics(
    long: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",), y: str = "y", p: str = "p"
) -> DataFrame:
    counts = confusion(long, threshold, by, y, p)
    return with_rates(counts.withColumn("threshold", F.lit(float(threshold))))


def threshold_sweep(
    long: DataFrame,
    thresholds: Sequence[float] | None = None,
    by: Sequence[str] = ("model",),
    y: str = "y",
    p: str = "p",
) -> DataFrame:
    """Metrics at many ascending thresholds from one pass.

    A row is counted once, under the number of thresholds it reaches; the few
    counts per group are then summed from the top. No row meets a threshold grid.
    """
    grid = sorted(float(t) for t in (sweep_thresholds() if thresholds is None else thresholds))
    reached = reduce(add, [(F.col("_p") >= F.lit(t)).cast("int") for t in grid]) if grid else F.lit(0)
    levels = long.withColumn("_p", _score(p)).groupBy(*by, reached.alias("_level")).agg(
        F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) == 0).alias("_neg")
    )
    # At most len(grid) + 1 rows per group from here on.
    passed = [
        F.struct(
            F.lit(t).alias("threshold"),
            F.when(F.col("_level") > i, F.col("_pos")).otherwise(0).alias("tp"),
            F.when(F.col("_level") > i, F.col("_neg")).otherwise(0).alias("fp"),
            F.when(F.col("_level") > i, 0).otherwise(F.col("_pos")).alias("fn"),
            F.when(F.col("_level") > i, 0).otherwise(F.col("_neg")).alias("tn"),
        )
        for i, t in enumerate(grid)
    ]
    cells = levels.select(*by, F.inline(F.array(*passed)))
    counts = cells.groupBy(*by, "threshold").agg(*[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")])
    return with_rates(counts)


def threshold_series(
    sweep: DataFrame, metrics: Sequence[str] = ("sensitivity", "specificity", "ppv", "npv"),
    by: Sequence[str] = ("model",),
) -> DataFrame:
    """The sweep as (model, threshold, metric, value)."""
    return sweep.unpivot([*by, "threshold"], list(metrics), "metric", "value")


def _with_totals(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Class totals next to each point. One row per group is broadcast; `by`
    names models or subgroups, which are few."""
    totals = points.groupBy(*by).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    return points.join(F.broadcast(totals), list(by))


def roc_curve(long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin at infinity."""
    points = _with_totals(score_points(long, by, y, p), by)
    curve = points.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_above") + F.col("neg"), F.col("_neg")).alias("fpr"),
        F.try_divide(F.col("pos_above") + F.col("pos"), F.col("_pos")).alias("tpr"),
    )
    origin = long.select(*by).distinct().select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(origin)


def pr_curve(long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point
    (1, 0) without a threshold."""
    points = _with_totals(score_points(long, by, y, p), by)
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    curve = points.select(
        *by,
        F.col("score").alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        F.try_divide(tp, F.col("_pos")).alias("recall"),
    )
    end = long.select(*by).distinct().select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def calibration_curve(
    long: DataFrame, bins: int = 10, by: Sequence[str] = ("model",), y: str = "y", p: str = "p"
) -> DataFrame:
    """Mean score and event share per quantile bin; a bin is the number of inner
    edges below the score, and empty bins are absent (runs jobs for the edges)."""
    long = long.withColumn(p, _score(p, probability=True))
    inner = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(long, by, p, inner).groupBy(*by).agg(F.collect_list("quantile").alias("_edges"))
    # One row of `bins - 1` numbers per group.
    placed = long.join(F.broadcast(edges), list(by))
    below = F.size(F.filter("_edges", lambda e: e < F.col(p)))
    return placed.groupBy(*by, below.alias("bin")).agg(
        F.avg(p).alias("mean_predicted"),
        F.avg(y).alias("fraction_positive"),
        F.count("*").alias("n"),
    )


def calibration_slope(long: DataFrame, models: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """Intercept and slope of the outcome on the logit of the score, per model.

    An unpenalised logistic fit by Newton steps for all models together: a step is
    one aggregate of six sums per model over staged (model, outcome, logit) rows
    (runs a job a step). A step that lowers the likelihood is halved. Null where no
    finite fit exists: one class only, one score only, or classes set apart by it.
    """
    rows = long.filter(F.col("model").isin(list(models))).select(
        "model", F.col(y).cast("double").alias("_y"), _score(p, probability=True).alias("_p")
    )
    rows = stage(rows.select("model", "_y", clipped_logit("_p").alias("_x")), "logits")
    best = {m: (0.0, 0.0) for m in models}
    sums = _newton_sums(rows, best)
    best = {m: best[m] for m in best if m in sums}
    tried, open_models = {m: _newton_step(best[m], sums[m]) for m in best}, set(best)
    for _ in range(NEWTON_STEPS):
        open_models = {m for m in open_models if tried[m] is not None and max(abs(a - b) for a, b in zip(tried[m], best[m])) > 1e-12}
        if not open_models:
            break
        new = _newton_sums(rows, {m: tried[m] for m in open_models})
        for m in open_models:
            if new[m]["likelihood"] < sums[m]["likelihood"] - 1e-9 * abs(sums[m]["likelihood"]):
                tried[m] = tuple((a + b) / 2 for a, b in zip(best[m], tried[m]))
            else:
                best[m], sums[m] = tried[m], new[m]
                tried[m] = _newton_step(best[m], sums[m])
    fits = [(m, *(best[m] if m in best and m not in open_models and tried[m] is not None else (None, None))) for m in models]
    return long.sparkSession.createDataFrame(fits, "model string, calibration_intercept double, calibration_slope double")


def _newton_sums(rows: DataFrame, at: dict[str, tuple[float, float]]) -> dict:
    """By model: gradient, Hessian and likelihood of the line given."""
    spark = rows.sparkSession
    # One row of three numbers per model.
    lines = spark.createDataFrame([(m, *line) for m, line in at.items()], "model string, _a double, _b double")
    x, y = F.col("_x"), F.col("_y")
    margin = F.col("_a") + F.col("_b") * x
    held = rows.join(F.broadcast(lines), "model").withColumns({"_m": margin, "_f": 1 / (1 + F.exp(-margin))})
    off, weight = y - F.col("_f"), F.col("_f") * (1 - F.col("_f"))
    # log(1 + exp(m)) without overflow.
    softplus = F.greatest(F.col("_m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_m")))
    found = held.groupBy("model").agg(
        F.sum(off).alias("g0"), F.sum(off * x).alias("g1"), F.sum(weight).alias("h00"), F.sum(weight * x).alias("h01"),
        F.sum(weight * x * x).alias("h11"), F.sum(y * F.col("_m") - softplus).alias("likelihood"),
    )
    return {r.model: r for r in found.collect()}


def _newton_step(line: tuple[float, float], s) -> tuple[float, float] | None:
    det = s["h00"] * s["h11"] - s["h01"] ** 2
    if not det > 1e-12 * s["h00"] * s["h11"]:
        return None
    return (
        line[0] + (s["h11"] * s["g0"] - s["h01"] * s["g1"]) / det,
        line[1] + (s["h00"] * s["g1"] - s["h01"] * s["g0"]) / det,
    )


def performance(long: DataFrame, by: Sequence[str] = ("model",), y: str = "y", p: str = "p") -> DataFrame:
    """AUROC, average precision and Brier score per group."""
    return ranking_metrics(long, by, y, p).join(brier(long, by, y, p), list(by))


def performance_summary(scores: DataFrame, calibration: DataFrame) -> DataFrame:
    """Scores per model with their calibration, where known."""
    return scores.join(calibration, "model", "left")
