"""Split, preprocessing, training and scoring on the wide table."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks.features import wide_sql, wide_table
from checks.ingest import SPLIT_SQL
from checks.registry import check, cohort_df, cohort_sql
from checks.scoring import AUROC, points_sql
from checks.views import base, view, with_views
from tidemark import rules
from tidemark.operators import prep as pp, train as tr
from tidemark.operators.categories import CategoryTable
from tidemark.operators.explain import NEGATIVE, POSITIVE, PRIME, coef_table, permutation_importance
from tidemark.operators.profile import clean_vectors, split_types
from tidemark.session import stage

TARGET = rules.TARGET
NUMBERS = ["age_at_icu_admission", "hr_mean", "sodium_mean", "weight_kg", "ventilation_duration_hours", "hr_measurement_count"]
CATEGORIES = {"gender": "FM", "insurance": ["Private", "Public"], "marital_status": ["MARRIED", "SINGLE"]}

#: Arguments of the fits; empty for the library's own sizes.
MODELS = {"logistic_regression": {}, "random_forest": {}, "gradient_boosting": {}}
TRAINERS = {"logistic_regression": tr.train_logistic, "random_forest": tr.train_forest, "gradient_boosting": tr.train_boosting}


def split_wide(spark, sf):
    columns = ["stay_id", TARGET, *NUMBERS, *CATEGORIES]
    wide = stage(wide_table(spark, sf).select(*columns), "wide")
    return pp.stratified_split(wide, TARGET, "stay_id")


#: What is no feature of the whole wide table, and its text columns.
BANNED = [*dict.fromkeys([*rules.EXCLUDED_FEATURES, "stay_id", TARGET, "split"])]
ALL_TEXTS = ["gender", "first_careunit", "last_careunit", "admission_type", "admission_location", "insurance", "marital_status", "race"]


def all_rows(spark, sf):
    """Every column of the wide table, with its split."""
    return pp.stratified_split(stage(wide_table(spark, sf), "wide"), TARGET, "stay_id")


def all_train(spark, sf):
    """Staged training rows of all features, and the numeric ones."""
    train = stage(all_rows(spark, sf).filter("split = 'train'"), "train")
    numbers, texts = split_types(train, BANNED)
    assert sorted(texts) == sorted(ALL_TEXTS), texts
    return train, numbers


def fitted_few(spark, sf):
    """Staged rows of nine features with their split, and their preprocessor."""
    rows = stage(split_wide(spark, sf), "split")
    train = rows.filter("split = 'train'")
    return rows, pp.Preprocessor.fit(train, NUMBERS, list(CATEGORIES))


_kept = {}


def _once(spark, sf, name, make):
    """What several queries of a session read: made by the first that asks."""
    key = spark.sparkContext.applicationId, sf, name
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def fitted(spark, sf):
    """Staged rows with their split, and the preprocessor of all features."""

    def make():
        rows = stage(all_rows(spark, sf), "split")
        return rows, pp.Preprocessor.fit(rows.filter("split = 'train'"), exclude=BANNED)

    return _once(spark, sf, "fitted", make)


def vectors(spark, sf):
    """(stay_id, y, split, features), staged: the iterative fits read it often;
    and the feature names."""

    def make():
        rows, model = fitted(spark, sf)
        labelled = rows.withColumn("y", F.col(TARGET).cast("int"))
        return stage(model.transform_vector(labelled, ["stay_id", "y", "split"]), "vectors"), model.feature_names

    return _once(spark, sf, "vectors", make)


def model_of(spark, sf, name):
    """A model of all features, of the library's own size."""

    def make():
        return TRAINERS[name](vectors(spark, sf)[0].filter("split = 'train'"), "y", **MODELS[name])

    return _once(spark, sf, name, make)


SPLIT_CTES = {
    "placed": f"SELECT *, row_number() OVER (PARTITION BY {TARGET} ORDER BY md5('42:' || CAST(stay_id AS VARCHAR)), stay_id) AS r, "
    f"count(*) OVER (PARTITION BY {TARGET}) AS n FROM final",
    "split_rows": "SELECT * EXCLUDE (r, n), CASE WHEN r <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM placed",
    "train": "SELECT * FROM split_rows WHERE split = 'train'",
    # Every numeric feature, whatever the table has.
    "numbers": f"SELECT stay_id, split, CAST(COLUMNS(* EXCLUDE ({', '.join([*BANNED, *ALL_TEXTS])})) AS DOUBLE) FROM split_rows",
    "rows_long": 'SELECT * FROM numbers UNPIVOT INCLUDE NULLS (value FOR "column" IN (COLUMNS(* EXCLUDE (stay_id, split))))',
    "long": "SELECT \"column\", value FROM rows_long WHERE split = 'train'",
    "medians": 'SELECT "column", median(value) AS median FROM long GROUP BY 1 HAVING count(value) > 0',
    "scales": 'SELECT "column" AS feature, avg(v) AS mean, stddev_pop(v) AS scale FROM '
    '(SELECT "column", coalesce(value, median) AS v FROM long JOIN medians USING ("column")) GROUP BY 1 UNION ALL '
    "SELECT 'missingindicator_' || \"column\", avg(m), stddev_pop(m) FROM "
    '(SELECT "column", CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END AS m FROM long) GROUP BY 1 HAVING max(m) > 0',
    "texts_long": " UNION ALL ".join(f"SELECT stay_id, split, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM split_rows" for c in ALL_TEXTS),
    "texts": "SELECT \"column\", value FROM texts_long WHERE split = 'train'",
    "modes": 'SELECT "column", value AS mode FROM (SELECT "column", value, count(*) AS n FROM texts WHERE value IS NOT NULL GROUP BY 1, 2) '
    'QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1',
}


def model_sql(query, **ctes):
    return wide_sql(query, **SPLIT_CTES, **ctes)


check("J01_J09_stratified_split", SPLIT_SQL)(
    lambda spark, sf: pp.split_table(pp.stratified_split(cohort_df(spark, sf), TARGET, "stay_id"), "stay_id")
)


@check(
    "J01_split_of_events",
    with_views(
        "predictions",
        "SELECT entity_id, CASE WHEN r <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (SELECT entity_id, "
        "row_number() OVER (PARTITION BY y_true ORDER BY md5('7:' || CAST(entity_id AS VARCHAR)), entity_id) AS r, "
        "count(*) OVER (PARTITION BY y_true) AS n FROM predictions)",
    ),
)
def _(spark, sf):
    return pp.split_table(pp.stratified_split(view(spark, sf, "predictions"), "y_true", "entity_id", seed=7), "entity_id")


@check("C13_drop_excluded", cohort_sql("SELECT gender, race, mortality_after_24h FROM cohort"))
def _(spark, sf):
    chosen = cohort_df(spark, sf).select("subject_id", "stay_id", "intime", "gender", "race", TARGET)
    return pp.drop_excluded(chosen)


@check("J02_median_imputation", model_sql("SELECT * FROM medians"), "median")
def _(spark, sf):
    return pp.fit_impute(*all_train(spark, sf))


@check(
    "J03_missing_indicators",
    model_sql('SELECT "column", count(*) FILTER (value IS NULL) AS missing_n FROM long GROUP BY 1 HAVING count(*) > count(value)'),
)
def _(spark, sf):
    return pp.fit_indicators(*all_train(spark, sf))


@check("J04_standardise", model_sql("SELECT feature, mean, CASE WHEN scale = 0 THEN 1 ELSE scale END AS scale FROM scales"), "mean scale")
def _(spark, sf):
    return pp.fit_scale(*all_train(spark, sf))


@check("J05_most_frequent", model_sql("SELECT * FROM modes"))
def _(spark, sf):
    return pp.fit_mode(all_train(spark, sf)[0], ALL_TEXTS)


ONE_HOT = ", ".join(
    f"CASE WHEN coalesce({c}, (SELECT mode FROM modes WHERE \"column\" = '{c}')) = '{v}' THEN CAST(1 AS DOUBLE) ELSE 0 END AS \"{c}_{v}\""
    for c, values in CATEGORIES.items()
    for v in values
)


HOT = (
    'SELECT stay_id, split, t."column" || \'_\' || c.value AS feature, CAST(coalesce(t.value, mode) = c.value AS INT)::DOUBLE AS value '
    'FROM texts_long t JOIN (SELECT DISTINCT "column", value FROM texts WHERE value IS NOT NULL) c USING ("column") JOIN modes USING ("column")'
)


@check("J06_one_hot", model_sql(HOT))
def _(spark, sf):
    """Every category of every text column, a row for each flag."""
    rows = stage(all_rows(spark, sf), "split")
    model = pp.Preprocessor(numeric=(), categorical=pp._fit_texts(rows.filter("split = 'train'"), ALL_TEXTS))
    return model.transform(rows, ["stay_id", "split"]).unpivot(["stay_id", "split"], model.feature_names, "feature", "value")


WIDE_TEXTS = ["o_custkey", "o_orderpriority", "ordered", "final_status"]
WIDE_ROWS = (
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority, CAST(o_orderdate AS VARCHAR) AS ordered, "
    "nullif(o_orderstatus, 'P') AS final_status, o_orderdate < TIMESTAMP '1999-01-01' AS train FROM orders"
)
WIDE_LONG = " UNION ALL ".join(f"SELECT o_orderkey, train, {i} AS nr, {c} AS value FROM wide_rows" for i, c in enumerate(WIDE_TEXTS))


@check(
    "J06_category_table",
    f"WITH wide_rows AS ({WIDE_ROWS}), cells AS ({WIDE_LONG}), "
    "counted AS (SELECT nr, value, count(*) AS n FROM cells WHERE train AND value IS NOT NULL GROUP BY nr, value), "
    "places AS (SELECT nr, value, row_number() OVER (ORDER BY nr, value) - 1 AS place FROM counted), "
    "usual AS (SELECT nr, first(value ORDER BY n DESC, value) AS usual FROM counted GROUP BY nr), "
    "hit AS (SELECT o_orderkey, place FROM cells JOIN usual USING (nr) "
    "JOIN places ON places.nr = cells.nr AND places.value = coalesce(cells.value, usual)) "
    "SELECT o_orderkey, (SELECT count(*) FROM counted) AS size, coalesce(string_agg(place, ',' ORDER BY place), '') AS places "
    "FROM wide_rows LEFT JOIN hit USING (o_orderkey) GROUP BY o_orderkey",
)
def _(spark, sf):
    """Customers and days as categories: more values than an expression should hold."""
    rows = base(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderpriority",
        F.col("o_orderdate").cast("string").alias("ordered"),
        F.nullif("o_orderstatus", F.lit("P")).alias("final_status"),
        (F.col("o_orderdate") < "1999-01-01").alias("train"),
    )
    table = CategoryTable.fit(rows.where("train"), WIDE_TEXTS)
    # Vectors are read back from the sparse form that models get.
    vectors = table.vectors(rows, ["o_orderkey"]).select("o_orderkey", F.unwrap_udt("features").alias("v"))
    return vectors.select(
        "o_orderkey",
        F.col("v.size").cast("long").alias("size"),
        F.array_join(F.col("v.indices").cast("array<string>"), ",").alias("places"),
    )


SCALED = ", ".join(
    f"(coalesce({c}, (SELECT median FROM medians WHERE \"column\" = '{c}')) - (SELECT mean FROM scales WHERE feature = '{c}')) "
    f"/ (SELECT scale FROM scales WHERE feature = '{c}') AS {c}"
    for c in NUMBERS
)
INDICATED = ["hr_mean", "sodium_mean", "weight_kg", "hr_measurement_count"]
INDICATORS = ", ".join(
    f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END - (SELECT mean FROM scales WHERE feature = 'missingindicator_{c}')) "
    f"/ (SELECT scale FROM scales WHERE feature = 'missingindicator_{c}') AS missingindicator_{c}"
    for c in INDICATED
)


@check(
    "J07_J08_fit_and_transform",
    model_sql(f"SELECT stay_id, split, {SCALED}, {INDICATORS}, {ONE_HOT} FROM split_rows"),
    " ".join(NUMBERS + [f"missingindicator_{c}" for c in INDICATED]),
)
def _(spark, sf):
    rows, model = fitted_few(spark, sf)
    return model.transform(rows, ["stay_id", "split"])


STANDARD = "CASE WHEN s.scale = 0 THEN 1 ELSE s.scale END"


@check(
    "J07_J08_all_features",
    model_sql(
        f'SELECT stay_id, split, "column" AS feature, (coalesce(value, median) - s.mean) / {STANDARD} AS value '
        'FROM rows_long JOIN medians USING ("column") JOIN scales s ON s.feature = "column" UNION ALL '
        f"SELECT stay_id, split, s.feature, (CAST(value IS NULL AS INT) - s.mean) / {STANDARD} "
        "FROM rows_long JOIN scales s ON s.feature = 'missingindicator_' || \"column\" UNION ALL "
        'SELECT stay_id, split, t."column" || \'_\' || c.value, CAST(coalesce(t.value, mode) = c.value AS INT) '
        'FROM texts_long t JOIN (SELECT DISTINCT "column", value FROM texts WHERE value IS NOT NULL) c USING ("column") JOIN modes USING ("column")'
    ),
    "value",
)
def _(spark, sf):
    """Every feature of the wide table, a row for each value."""
    rows = stage(all_rows(spark, sf), "split")
    model = pp.Preprocessor.fit(rows.filter("split = 'train'"), exclude=BANNED)
    return model.transform(rows, ["stay_id", "split"]).unpivot(["stay_id", "split"], model.feature_names, "feature", "value")


@check(
    "J10_class_weights",
    with_views("predictions", "SELECT y_true, (SELECT count(*) FROM predictions) / (2 * CAST(count(*) AS DOUBLE)) AS weight FROM predictions GROUP BY y_true"),
    "weight",
)
def _(spark, sf):
    return pp.class_weights(view(spark, sf, "predictions"), "y_true")


@check(
    "I15_preprocessing_summary",
    model_sql(
        'SELECT count(*) AS original_rows, CAST((SELECT count(DISTINCT "column") FROM long) + 8 AS INT) AS original_features, '
        'CAST((SELECT count(DISTINCT "column") FROM long) AS INT) AS numeric_features, 8 AS categorical_features, '
        "CAST((SELECT count(*) FROM medians) + (SELECT count(*) FROM scales WHERE feature LIKE 'missingindicator_%') "
        '+ (SELECT count(DISTINCT "column" || value) FROM texts) AS INT) AS processed_features, '
        f"count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows, "
        f"avg({TARGET}) FILTER (split = 'train') AS train_event_rate, avg({TARGET}) FILTER (split = 'test') AS test_event_rate, "
        "42 AS random_state, CAST(0.2 AS DOUBLE) AS test_size FROM split_rows"
    ),
    "train_event_rate test_event_rate",
)
def _(spark, sf):
    rows, model = fitted(spark, sf)
    return pp.prep_summary(rows, TARGET, model)


def train_test(spark, sf):
    frame, names = vectors(spark, sf)
    return frame.filter("split = 'train'"), frame.filter("split = 'test'"), names


def scores_of(spark, sf, *names):
    test = train_test(spark, sf)[1]
    return tr.score({n: model_of(spark, sf, n) for n in names}, test, ["stay_id", "y"])


@check("J11_logistic_regression")
def _(spark, sf):
    return scores_of(spark, sf, "logistic_regression")


FEATURES = (
    'SELECT "column" AS feature FROM medians UNION ALL SELECT feature FROM scales WHERE feature LIKE \'missingindicator_%\' UNION ALL '
    'SELECT DISTINCT "column" || \'_\' || value FROM texts WHERE value IS NOT NULL UNION ALL SELECT \'intercept\''
)


@check("J11_L01_logistic_optimum", model_sql(f"SELECT feature, CAST(0 AS DOUBLE) AS gradient FROM ({FEATURES})"))
def _(spark, sf):
    """The fit of all features is where no coefficient wants to move."""
    train, _, names = train_test(spark, sf)
    slopes = tr.logistic_gradient(model_of(spark, sf, "logistic_regression"), train, "y", names)
    return slopes.select("feature", F.round(F.abs("gradient"), 4).alias("gradient"))


@check("J12_random_forest")
def _(spark, sf):
    return scores_of(spark, sf, "random_forest")


@check("J13_gradient_boosting")
def _(spark, sf):
    return scores_of(spark, sf, "gradient_boosting")


@check("J14_J15_predictions_of_all_models")
def _(spark, sf):
    return scores_of(spark, sf, *MODELS)


@check("J15_model_summary")
def _(spark, sf):
    return tr.model_summary(stage(scores_of(spark, sf, *MODELS), "predictions"), "y")


@check(
    "I14_clean_feature_vectors",
    model_sql("SELECT split, count(*) AS rows, CAST(0 AS BIGINT) AS null_n, CAST(0 AS BIGINT) AS infinite_n FROM split_rows GROUP BY split"),
)
def _(spark, sf):
    return clean_vectors(vectors(spark, sf)[0], by=["split"])


@check(
    "J14_scores_of_test_rows",
    model_sql(f"SELECT stay_id, {TARGET} AS y, TRUE AS is_probability FROM split_rows WHERE split = 'test'"),
)
def _(spark, sf):
    scored = scores_of(spark, sf, "logistic_regression")
    return scored.select("stay_id", "y", F.col("logistic_regression_probability").between(0, 1).alias("is_probability"))


# -- fits with a closed form: one 0/1 feature ----------------------------------

FLAGGED = (
    "SELECT entity_id, y_true AS y, CASE WHEN model_a_probability < 0.05 THEN 1 ELSE 0 END AS flag FROM predictions"
)
# Class-weighted event rate per flag value.
WEIGHTED = (
    "SELECT flag, sum(y * w) / sum(w) AS rate FROM (SELECT flag, y, "
    "(SELECT count(*) FROM flagged) / (2.0 * count(*) OVER (PARTITION BY y)) AS w FROM flagged) GROUP BY flag"
)


def flagged(spark, sf):
    rows = view(spark, sf, "predictions").select(
        "entity_id", F.col("y_true").alias("y"), (F.col("model_a_probability") < 0.05).cast("int").alias("flag")
    )
    vector = array_to_vector(F.array(F.col("flag").cast("double")))
    return stage(rows.withColumn("features", vector), "flagged")


def rate_per_flag(spark, sf, train):
    rows = flagged(spark, sf)
    scored = tr.score({"m": train(rows)}, rows, ["flag"])
    return scored.groupBy("flag").agg(F.round(F.avg("m_probability"), 4).alias("rate"))


RATE = with_views("predictions", "SELECT flag, round(rate, 4) AS rate FROM weighted", flagged=FLAGGED, weighted=WEIGHTED)


@check("J11_logistic_on_a_flag", RATE)
def _(spark, sf):
    return rate_per_flag(spark, sf, lambda rows: tr.train_logistic(rows, "y", c=1e9))


@check("J12_one_tree_on_a_flag", RATE)
def _(spark, sf):
    return rate_per_flag(spark, sf, lambda rows: tr.train_forest(rows, "y", trees=1, depth=1, bootstrap=False))


@check(
    "J13_one_round_on_a_flag",
    with_views(
        "predictions",
        "SELECT flag, round(1 / (1 + exp(-2 * avg(2 * y - 1))), 4) AS rate FROM flagged GROUP BY flag",
        flagged=FLAGGED,
    ),
)
def _(spark, sf):
    return rate_per_flag(spark, sf, lambda rows: tr.train_boosting(rows, "y", rounds=1, depth=1))


@check(
    "L01_coefficient_of_a_flag",
    with_views(
        "predictions",
        "SELECT 'flag' AS feature, round(c, 3) AS coefficient, round(abs(c), 3) AS absolute_coefficient, "
        f"CASE WHEN c >= 0 THEN '{POSITIVE}' ELSE '{NEGATIVE}' END AS direction FROM (SELECT "
        "max(CASE WHEN flag = 1 THEN ln(rate / (1 - rate)) END) - max(CASE WHEN flag = 0 THEN ln(rate / (1 - rate)) END) AS c "
        "FROM weighted)",
        flagged=FLAGGED,
        weighted=WEIGHTED,
    ),
)
def _(spark, sf):
    table = coef_table(spark, tr.train_logistic(flagged(spark, sf), "y", c=1e9), ["flag"])
    return table.select(
        "feature",
        F.round("coefficient", 3).alias("coefficient"),
        F.round("absolute_coefficient", 3).alias("absolute_coefficient"),
        "direction",
    )


# The shuffles follow from the row number alone, so SQL can repeat them.
@check(
    "L02_importance_of_a_flag",
    with_views(
        "predictions",
        "SELECT 'flag' AS feature, avg(drop) AS importance_mean, stddev_pop(drop) AS importance_std FROM "
        f"(SELECT r, (SELECT {AUROC} FROM points_before) - {AUROC} AS drop FROM points_after GROUP BY r)",
        flagged=FLAGGED,
        weighted=WEIGHTED,
        numbered="SELECT y, rate AS p, row_number() OVER (ORDER BY md5('42:' || CAST(entity_id AS VARCHAR)), entity_id) - 1 AS i, "
        "count(*) OVER () AS n FROM flagged JOIN weighted USING (flag)",
        before="SELECT 0 AS r, y, p FROM numbered",
        shifts="SELECT r, CAST('0x' || substr(md5('42:0:' || r), 1, 15) AS BIGINT) AS b FROM (VALUES (0), (1), (2)) AS t(r)",
        received=f"SELECT r, t.y, d.p FROM (SELECT *, ({PRIME} % n * i + b % n) % n AS donor FROM numbered, shifts) t "
        "JOIN numbered d ON d.i = t.donor",
        points_before=points_sql("r", "before"),
        points_after=points_sql("r", "received"),
    ),
    "importance_mean importance_std",
)
def _(spark, sf):
    rows = flagged(spark, sf)
    model = tr.train_logistic(rows, "y", c=1e9)
    return permutation_importance(model, rows, "y", "entity_id", ["flag"], n_repeats=3)
