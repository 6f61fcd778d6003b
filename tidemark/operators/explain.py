"""What drives the scores, and how well they hold in subgroups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from hashlib import md5
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.metrics import ranking_metrics
from tidemark.operators.ranking import hash_order, with_rank
from tidemark.rules import SUBGROUPS
from tidemark.session import stage

# Wording of the coefficient report.
POSITIVE = "positive association with predicted mortality"
NEGATIVE = "negative association with predicted mortality"


def coefficient_report(coefficients: DataFrame) -> DataFrame:
    """Odds ratio, magnitude and direction of (feature, coefficient) rows."""
    c = F.col("coefficient")
    return coefficients.select(
        "feature",
        "coefficient",
        F.exp(c).alias("odds_ratio"),
        F.abs(c).alias("absolute_coefficient"),
        F.when(c >= 0, POSITIVE).otherwise(NEGATIVE).alias("direction"),
    ).orderBy(F.desc("absolute_coefficient"), "feature")


def coef_table(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Coefficient report of a logistic model: one row per feature."""
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    return coefficient_report(spark.createDataFrame(rows, "feature string, coefficient double"))


def top_bottom(df: DataFrame, column: str, k: int = 15, tie: str = "feature") -> DataFrame:
    """The k largest and k smallest rows, tagged `side`."""
    top = df.orderBy(F.desc(column), tie).limit(k).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.asc(column), tie).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


# -- permutation importance ----------------------------------------------------


# Numbers that a chunk of shuffles sends, the shuffles of a chunk at most, and the
# decimals to which linear margins are compared.
CHUNK_CELLS = 1 << 24
MOST_SHUFFLES = 1024
MARGIN_DIGITS = 10

# A prime above any row count, so that its remainder has no divisor in common
# with the count.
PRIME = (1 << 61) - 1


class Shuffle(NamedTuple):
    """Row i receives the feature value of row (PRIME * i + shift) mod n.

    Row numbers already follow a random order, so such a map pairs rows at
    random; unlike a sort per shuffle it needs nothing but the row number.
    """

    feature: int
    shift: int


def _shuffles(features: Sequence[int], repeats: int, n: int, seed: int) -> list[Shuffle]:
    def shift(feature: int, repeat: int) -> int:
        return int(md5(f"{seed}:{feature}:{repeat}".encode()).hexdigest()[:15], 16) % n

    return [Shuffle(f, shift(f, r)) for f in features for r in range(repeats)]


def _by_slot(values: Sequence[float], kind: str = "bigint") -> Column:
    """An array literal; as text it is one node of the plan, whatever its length."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def shuffled_values(numbered: DataFrame, shuffles: Sequence[Shuffle], n: int) -> DataFrame:
    """(row, replaced): for each row number the array of values it receives.

    Each row sends its own value to the row that asks for it, so only numbers are
    shuffled, never whole vectors. An array holds one entry per shuffle.
    """
    # The product stays exact: 64 bits suffice below 2**31 rows.
    number = "long" if n < 1 << 31 else "decimal(38,0)"
    inverse = F.lit(pow(PRIME, -1, n)).cast(number)
    features, shifts = _by_slot([s.feature for s in shuffles], "int"), _by_slot([s.shift for s in shuffles])

    def donation(slot: Column) -> Column:
        steps = F.pmod(F.col("_row") - shifts[slot], F.lit(n)).cast(number)
        target = F.pmod(steps * inverse, F.lit(n).cast(number)).cast("long")
        return F.struct(target.alias("_row"), slot.alias("slot"), F.col("_x")[features[slot]].alias("value"))

    slots = F.sequence(F.lit(0), F.lit(len(shuffles) - 1))
    sent = numbered.select(F.inline(F.transform(slots, donation)))
    return sent.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("slot", "value"))).alias("replaced"))


def _received(base: DataFrame, shuffles: Sequence[Shuffle], n: int) -> DataFrame:
    """The rows with what they receive. Both sides lie by row number; the numbers sent,
    whose size Spark guesses from the files of the rows, do not pass through the driver."""
    return base.join(shuffled_values(base, shuffles, n).hint("merge"), "_row")


def _used(model: Model, wanted: Sequence[int]) -> list[int]:
    """Features that the model looks at; shuffling any other changes no score."""
    weights = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    return [f for f in wanted if weights[f]]


def _changed_scores(model: Model, received: DataFrame, shuffles: Sequence[Shuffle]) -> DataFrame:
    """(slot, y, score) of every row under every shuffle.

    A linear margin moves by coefficient times change of the feature, so nothing
    else of the row is looked at; margins count as equal to ten decimals, which
    is far above what rounding moves them and far below what tells rows apart.
    Trees see the row with one number replaced; a row that receives the number it
    had keeps the score it had, which `_margin` holds for them.
    """
    features = _by_slot([s.feature for s in shuffles], "int")
    new = received.select("_y", "_margin", "_x", F.explode("replaced").alias("_new"))
    new = new.select("_y", "_margin", "_x", F.col("_new.slot").alias("_slot"), F.col("_new.value").alias("_value"))
    if hasattr(model, "coefficients"):
        weights = _by_slot([float(model.coefficients[s.feature]) for s in shuffles], "double")
        moved = weights[F.col("_slot")] * (F.col("_value") - F.col("_x")[features[F.col("_slot")]])
        return new.select("_slot", "_y", F.round(F.col("_margin") + moved, MARGIN_DIGITS).alias("_score"))
    placed = new.withColumn("_here", features[F.col("_slot")])
    equal = F.col("_value") == F.col("_x")[F.col("_here")]
    kept = placed.filter(equal).select("_slot", "_y", F.col("_margin").alias("_score"))
    changed = F.concat(F.slice("_x", 1, F.col("_here")), F.array("_value"), F.slice("_x", F.col("_here") + 2, F.size("_x")))
    vectors = placed.filter(~equal).select("_slot", "_y", array_to_vector(changed).alias("features"))
    return kept.unionByName(_scored(model, vectors))


def _scored(model: Model, frame: DataFrame) -> DataFrame:
    return model.transform(frame).select("_slot", "_y", vector_to_array("probability")[1].alias("_score"))


def permutation_importance(
    model: Model,
    df: DataFrame,
    label: str,
    key: str,
    names: Sequence[str],
    n_repeats: int = 10,
    seed: int = 42,
    chunk: int | None = None,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """(feature, importance_mean, importance_std): the drop in AUROC when one
    feature is shuffled, over `n_repeats` shuffles (runs one job per chunk).

    Rows are numbered in a random order and written once, in buckets of their
    number; from then on only single numbers are sent to them, `chunk` shuffles at
    a time (as many as keep a chunk near CHUNK_CELLS numbers, 64 at least).
    Features that the model does not look at have no importance and cost nothing.
    Equal scores are counted map-side before they are ranked, and trees are asked
    only for rows whose number changed. One number per shuffle reaches the driver.
    """
    spark = df.sparkSession
    wanted = [names.index(f) for f in (names if features is None else features)]
    linear = hasattr(model, "coefficients")
    rows = df.select(key, F.col(label).cast("int").alias("_y"), "features")
    margin = vector_to_array("rawPrediction" if linear else "probability")[1]
    rows = model.transform(rows).withColumn("_margin", margin)
    numbered = with_rank(rows.select(key, "_y", "features", "_margin"), [], hash_order(key, seed), key, "_row")
    base = stage(numbered.select("_row", "_y", "_margin", vector_to_array("features").alias("_x")), "numbered", bucket_by="_row")
    n = base.count()
    score = F.round("_margin", MARGIN_DIGITS) if linear else F.col("_margin")
    before = _auroc(base.select(F.lit(0).alias("_slot"), "_y", score.alias("_score")), n).first().roc_auc
    used = _used(model, wanted)
    plan = _shuffles(used, n_repeats, n, seed)
    drops = [(names[f], 0.0) for f in wanted if f not in set(used)]
    chunk = chunk or max(64, min(MOST_SHUFFLES, CHUNK_CELLS // max(n, 1)))
    for start in range(0, len(plan), chunk):
        shuffles = plan[start : start + chunk]
        for row in _auroc(_changed_scores(model, _received(base, shuffles, n), shuffles), n).collect():
            drops.append((names[shuffles[row["_slot"]].feature], before - row.roc_auc))
    return (
        spark.createDataFrame(drops, "feature string, drop double")
        .groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )


def _auroc(scored: DataFrame, n: int) -> DataFrame:
    """AUROC per slot of `n` rows."""
    return ranking_metrics(scored, ["_slot"], "_y", "_score", most=n)


def union_models(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per-model tables under each other, tagged `model`."""
    tagged = [df.withColumn("model", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def importance_all(
    models: Mapping[str, Model], df: DataFrame, label: str, key: str, names: Sequence[str], **options
) -> DataFrame:
    return union_models(
        {m: permutation_importance(model, df, label, key, names, **options) for m, model in models.items()}
    )


def top_by_max(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The k keys with the largest maximum."""
    best = df.groupBy(key).agg(F.max(value).alias(value))
    return best.orderBy(F.desc(value), key).limit(k)


def semi_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    return df.join(top.select(key), key, "left_semi")


def pivot_models(
    df: DataFrame, models: Sequence[str], key: str = "feature", value: str = "importance_mean"
) -> DataFrame:
    return df.groupBy(key).pivot("model", list(models)).agg(F.first(value))


def row_max(columns: Sequence[str]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])


def compare_importance(importance: DataFrame, models: Sequence[str], k: int = 20) -> DataFrame:
    """The k features that matter most to any model, one column per model,
    ordered by their largest importance."""
    top = top_by_max(importance, "feature", "importance_mean", k)
    wide = pivot_models(semi_top(importance, top, "feature"), models)
    return wide.orderBy(row_max(models).asc(), "feature")


# -- subgroups -----------------------------------------------------------------


def attach(scores: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    """Scored rows with their raw attributes, matched by entity key."""
    return scores.join(attributes, key)


def subgroups(df: DataFrame, rules: Mapping[str, str] = SUBGROUPS) -> DataFrame:
    """One row per entity and subgroup it belongs to; an unknown attribute puts
    it in none. Rules are SQL predicates."""
    names = [F.when(F.expr(rule), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("subgroup", F.explode(F.array_compact(F.array(*names))))


def subgroup_performance(
    long: DataFrame,
    rules: Mapping[str, str] = SUBGROUPS,
    by: Sequence[str] = ("subgroup", "model"),
    min_n: int = 50,
) -> DataFrame:
    """Size, events, AUROC and average precision per subgroup and model.

    `long` holds (model, y, p) and the attributes that the rules read. Subgroups
    below `min_n` rows or with one class are left out.
    """
    members = subgroups(long, rules).select(*by, "y", "p")
    sizes = (
        members.groupBy(*by)
        .agg(F.count("*").alias("n"), F.sum("y").alias("events"), F.avg("y").alias("event_rate"))
        .filter((F.col("n") >= min_n) & (F.col("events") > 0) & (F.col("events") < F.col("n")))
    )
    return sizes.join(ranking_metrics(members, by), list(by))
