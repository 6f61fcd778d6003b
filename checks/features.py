"""Cohort, dictionary, events, intervals, as-of and assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, cohort_df, cohort_sql
from checks.views import RULES, VIEWS, values_sql, view, with_views
from tidemark import rules
from tidemark.functions import scalar, timeline
from tidemark.operators import asof, assemble, cohort as co, dictionary as di, events as ev, intervals as iv
from tidemark.operators.ranking import with_position
from tidemark.plans import landmark_table as plan
from tidemark.rules import KEYS, Label
from tidemark.session import stage

K = ", ".join(KEYS)

# -- B: projections and scalar expressions -------------------------------------


@check("B01_project_rename", with_views("icustays", "SELECT stay_id, intime, los AS icu_los_days FROM icustays"), "icu_los_days")
def _(spark, sf):
    return view(spark, sf, "icustays").select("stay_id", "intime", F.col("los").alias("icu_los_days"))


@check(
    "B02_B04_landmark_column",
    with_views("icustays", "SELECT *, intime + INTERVAL '24' HOUR AS prediction_time FROM icustays"),
    "los",
)
def _(spark, sf):
    return view(spark, sf, "icustays").withColumn("prediction_time", timeline.landmark("intime"))


@check(
    "B03_age_at_event",
    with_views(
        "patients icustays",
        "SELECT stay_id, CAST(anchor_age + year(intime) - anchor_year AS INT) AS age "
        "FROM icustays JOIN patients USING (subject_id)",
    ),
)
def _(spark, sf):
    joined = view(spark, sf, "icustays").join(view(spark, sf, "patients"), "subject_id")
    return joined.select("stay_id", timeline.age_at("anchor_age", "anchor_year", "intime").alias("age"))


STAYS = with_views(
    "icustays admissions",
    "SELECT stay_id, CASE WHEN deathtime IS NULL THEN 1 WHEN deathtime >= intime + INTERVAL '24' HOUR THEN 1 "
    "ELSE 0 END AS survived_to_24h, CASE WHEN hospital_expire_flag = 1 AND deathtime > intime + INTERVAL '24' HOUR "
    "THEN 1 ELSE 0 END AS mortality_after_24h FROM icustays JOIN admissions USING (hadm_id, subject_id)",
)


@check("B05_B06_B07_eligibility_and_label", STAYS)
def _(spark, sf):
    stays = co.admitted_stays(view(spark, sf, "icustays"), view(spark, sf, "admissions"))
    return co.with_landmark(stays).select("stay_id", "survived_to_24h", "mortality_after_24h")


@check(
    "B08_fill_zero",
    with_views(
        "chartevents",
        "SELECT subject_id, coalesce(sum(valuenum), 0) AS total, max(coalesce(valuenum, 0)) AS top "
        "FROM chartevents GROUP BY subject_id",
    ),
    "total top",
)
def _(spark, sf):
    events = view(spark, sf, "chartevents").withColumn("top", F.col("valuenum"))
    sums = scalar.fill_zero(events, ["top"]).groupBy("subject_id").agg(
        F.sum("valuenum").alias("total"), F.max("top").alias("top")
    )
    return scalar.fill_zero(sums, ["total"])


CLIPPED = cohort_sql(
    f"SELECT {K}, greatest(starttime, intime) AS starttime, "
    "least(coalesce(endtime, prediction_time), prediction_time) AS endtime FROM ventilation "
    f"JOIN cohort USING ({K}) WHERE starttime < prediction_time AND (endtime IS NULL OR endtime > intime)",
    "ventilation",
)


@check("B09_B10_clip_interval", CLIPPED)
def _(spark, sf):
    met = iv.intervals_in_window(view(spark, sf, "ventilation"), cohort_df(spark, sf))
    return iv.clip_interval(met)


@check(
    "B11_hours_between",
    with_views(
        "ventilation",
        "SELECT stay_id, starttime, endtime, date_diff('microsecond', starttime, endtime) / CAST(3600000000 AS DOUBLE) "
        "AS hours FROM ventilation",
    ),
    "hours",
)
def _(spark, sf):
    hours = timeline.hours_between("starttime", "endtime").alias("hours")
    return view(spark, sf, "ventilation").select("stay_id", "starttime", "endtime", hours)


# Patterns over the part names: broader rules after narrower ones.
ICU_RULES = [
    Label("ring", like=("%ring%",)),
    Label("small_or_red", like=("%small%", "%red%")),
    Label("widget", like=("%WIDGET%", "%widget%")),
    Label("bolt", like=("%bolt%",), unlike=("%blue%",)),
]
ICU_CASE = (
    "CASE WHEN lower(label) LIKE '%ring%' THEN 'ring' "
    "WHEN lower(label) LIKE '%small%' OR lower(label) LIKE '%red%' THEN 'small_or_red' "
    "WHEN lower(label) LIKE '%WIDGET%' OR lower(label) LIKE '%widget%' THEN 'widget' "
    "WHEN lower(label) LIKE '%bolt%' AND lower(label) NOT LIKE '%blue%' THEN 'bolt' END"
)
LAB_RULES = [
    Label("blue_gear", equal=("blue gear", "blue gears")),
    Label("plain", like=("%gear%", "%plate%"), unlike=("%small%", "%large%")),
    Label("bolt", like=("%bolt%",)),
]
LAB_CASE = (
    "CASE WHEN lower(label) IN ('blue gear', 'blue gears') THEN 'blue_gear' "
    "WHEN (lower(label) LIKE '%gear%' OR lower(label) LIKE '%plate%') AND lower(label) NOT LIKE '%small%' "
    "AND lower(label) NOT LIKE '%large%' THEN 'plain' WHEN lower(label) LIKE '%bolt%' THEN 'bolt' END"
)


@check("B12_classify_icu_labels", with_views("d_items", f"SELECT itemid, label, {ICU_CASE} AS variable_name FROM d_items"))
def _(spark, sf):
    items = view(spark, sf, "d_items")
    return items.select("itemid", "label", scalar.classify("label", ICU_RULES).alias("variable_name"))


@check("B13_classify_lab_labels", with_views("d_labitems", f"SELECT itemid, label, {LAB_CASE} AS variable_name FROM d_labitems"))
def _(spark, sf):
    items = view(spark, sf, "d_labitems")
    return items.select("itemid", "label", scalar.classify("label", LAB_RULES).alias("variable_name"))


DICTIONARY = (
    "SELECT * FROM (SELECT 'icu' AS source_table, itemid, label, CAST(NULL AS VARCHAR) AS abbreviation, "
    "CAST(NULL AS VARCHAR) AS linksto, category, unitname, CAST(NULL AS VARCHAR) AS param_type, lownormalvalue, "
    f"CAST(NULL AS DOUBLE) AS highnormalvalue, CAST(NULL AS VARCHAR) AS fluid, {ICU_CASE} AS variable_name FROM d_items "
    "UNION ALL SELECT 'lab', itemid, label, NULL, NULL, category, NULL, NULL, NULL, NULL, fluid, "
    f"{LAB_CASE} FROM d_labitems) WHERE variable_name IS NOT NULL"
)


def rule_sql(rules):
    """CASE over lower-cased labels, first matching rule wins."""

    def test(rule):
        hits = [f"lower(label) LIKE '{p}'" for p in rule.like] + [f"lower(label) = '{v}'" for v in rule.equal]
        return " AND ".join([f"({' OR '.join(hits)})", *(f"lower(label) NOT LIKE '{p}'" for p in rule.unlike)])

    return "CASE " + " ".join(f"WHEN {test(r)} THEN '{r.variable}'" for r in rules) + " END"


def phrases(rules):
    """Texts that reach every rule, and some that only look like it."""
    own = [text.strip("%") for rule in rules for text in (*rule.like, *rule.equal, *rule.unlike)]
    return own + ["norepinephrine bitartrate", "bilirubin, direct", "bilirubin, indirect", "direct bilirubin", "sodium chloride", "none"]


def spelled(items, texts):
    """Labels made of the table's own and a phrase, in several spellings."""
    phrase = F.element_at(F.array(*map(F.lit, texts)), F.pmod("itemid", F.lit(len(texts))).cast("int") + 1)
    kind = F.pmod(F.floor(F.col("itemid") / len(texts)), F.lit(3))
    spelling = F.when(kind == 0, phrase).when(kind == 1, F.upper(phrase)).otherwise(F.concat_ws(" ", "label", phrase, F.lit("(x)")))
    return items.select("itemid", spelling.alias("label"))


def spelled_sql(view_name, texts):
    listed = "[" + ", ".join(f"'{t}'" for t in texts) + "]"
    return (
        f"SELECT itemid, CASE (itemid // {len(texts)}) % 3 WHEN 0 THEN phrase WHEN 1 THEN upper(phrase) "
        f"ELSE concat_ws(' ', label, phrase, '(x)') END AS label FROM "
        f"(SELECT itemid, label, {listed}[CAST(itemid % {len(texts)} AS INT) + 1] AS phrase FROM {view_name})"
    )


for _name, _view, _rules in (("B12_all_icu_labels", "d_items", rules.ICU_LABELS), ("B13_all_lab_labels", "d_labitems", rules.LAB_LABELS)):

    def _classified(spark, sf, view_name=_view, own=_rules):
        items = spelled(view(spark, sf, view_name), phrases(own))
        return items.withColumn("variable_name", scalar.classify("label", own))

    check(_name, with_views(_view, f"SELECT *, {rule_sql(_rules)} AS variable_name FROM ({spelled_sql(_view, phrases(_rules))})"))(_classified)


@check("B14_H01_G01_dictionary", with_views("d_items d_labitems", DICTIONARY), "lownormalvalue")
def _(spark, sf):
    return di.dictionary(view(spark, sf, "d_items"), view(spark, sf, "d_labitems"), ICU_RULES, LAB_RULES)


@check(
    "G01_dictionary_in_order",
    with_views(
        "d_items d_labitems",
        "SELECT *, row_number() OVER (ORDER BY source_table NULLS LAST, variable_name NULLS LAST, itemid NULLS LAST) AS position "
        f"FROM ({DICTIONARY})",
    ),
    "lownormalvalue",
)
def _(spark, sf):
    """The place that each row of the sorted dictionary has in it."""
    return with_position(di.dictionary(view(spark, sf, "d_items"), view(spark, sf, "d_labitems"), ICU_RULES, LAB_RULES))


@check(
    "B15_missing_end_flag",
    with_views("ventilation", "SELECT stay_id, starttime, CASE WHEN endtime IS NULL THEN 1 ELSE 0 END AS open FROM ventilation"),
)
def _(spark, sf):
    return view(spark, sf, "ventilation").select("stay_id", "starttime", scalar.is_null_flag("endtime").alias("open"))


@check(
    "B16_rate_per_kg_h",
    with_views(
        "inputevents",
        "SELECT stay_id, itemid, starttime, CASE WHEN amount - 10 > 0 THEN rate / (amount - 10) / 24 END AS rate_kg "
        "FROM inputevents",
    ),
    "rate_kg",
)
def _(spark, sf):
    rate = scalar.rate_per_kg_h("rate", F.col("amount") - 10).alias("rate_kg")
    return view(spark, sf, "inputevents").select("stay_id", "itemid", "starttime", rate)


@check(
    "B17_missing_indicator",
    with_views(
        "patients",
        "SELECT subject_id, CASE WHEN race IS NULL THEN 1 ELSE 0 END AS race_missing, "
        "CASE WHEN gender IS NULL THEN 1 ELSE 0 END AS gender_missing FROM patients",
    ),
)
def _(spark, sf):
    flags = {f"{c}_missing": F.col(c) for c in ("race", "gender")}
    return assemble.flag_missing(view(spark, sf, "patients"), flags).select("subject_id", *flags)


@check(
    "B18_ordered_first_element",
    with_views(
        "chartevents",
        "SELECT stay_id, list(valuenum ORDER BY charttime, valuenum)[1] AS value_first, "
        "list(valuenum ORDER BY charttime DESC, valuenum DESC)[1] AS value_last "
        "FROM chartevents WHERE valuenum IS NOT NULL GROUP BY stay_id",
    ),
)
def _(spark, sf):
    events = view(spark, sf, "chartevents").filter(F.col("valuenum").isNotNull())
    return ev.summarise(events, ["stay_id"]).select("stay_id", "value_first", "value_last")


@check(
    "B19_lenient_timestamp",
    with_views(
        "predictions",
        "SELECT event_id, try_cast(CASE WHEN event_id % 3 = 0 THEN 'not a time ' || event_id "
        "ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS parsed FROM events",
    ),
)
def _(spark, sf):
    text = F.expr("CASE WHEN event_id % 3 = 0 THEN 'not a time ' || event_id ELSE CAST(ts AS STRING) END")
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select("event_id", timeline.parse_ts(text).alias("parsed"))


@check(
    "B21_clipped_logit",
    with_views(
        "predictions",
        "SELECT entity_id, ln(q / (1 - q)) AS logit FROM (SELECT entity_id, "
        "least(greatest(model_b_probability, CAST(0.000001 AS DOUBLE)), 1 - CAST(0.000001 AS DOUBLE)) AS q FROM predictions)",
    ),
    "logit",
)
def _(spark, sf):
    logit = scalar.clipped_logit("model_b_probability").alias("logit")
    return view(spark, sf, "predictions").select("entity_id", logit)


# -- C: filters ----------------------------------------------------------------


@check("C01_adults", cohort_sql("SELECT stay_id, age_at_icu_admission, gender, anchor_year_group FROM adult"))
def _(spark, sf):
    stays = co.admitted_stays(view(spark, sf, "icustays"), view(spark, sf, "admissions"))
    adults = co.adult_stays(stays, view(spark, sf, "patients"))
    return adults.select("stay_id", "age_at_icu_admission", "gender", "anchor_year_group")


@check(
    "C02_F01_first_stay_by_rank",
    with_views(
        "icustays",
        "SELECT * FROM icustays QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY intime, stay_id) = 1",
    ),
    "los",
)
def _(spark, sf):
    stays = co.ranked(view(spark, sf, "icustays"), ["subject_id"], ["intime", "stay_id"], "rn")
    return stays.filter("rn = 1").drop("rn")


@check("C02_first_adult_stay", cohort_sql("SELECT * FROM first_stay"), "icu_los_days")
def _(spark, sf):
    return co.first_adult_stay(view(spark, sf, "icustays"), view(spark, sf, "patients"), view(spark, sf, "admissions"))


@check("C03_eligible_cohort", cohort_sql("SELECT * FROM cohort"), "icu_los_days")
def _(spark, sf):
    return cohort_df(spark, sf)


@check(
    "C04_half_open_window",
    with_views(
        "chartevents icustays",
        "SELECT stay_id, charttime, c.itemid FROM chartevents c JOIN icustays USING (stay_id, hadm_id, subject_id) "
        "WHERE charttime >= intime AND charttime < intime + INTERVAL '24' HOUR",
    ),
)
def _(spark, sf):
    joined = view(spark, sf, "chartevents").join(view(spark, sf, "icustays"), KEYS)
    inside = timeline.in_window("charttime", "intime", timeline.landmark("intime"))
    return joined.filter(inside).select("stay_id", "charttime", "itemid")


@check(
    "C05_up_to_landmark",
    with_views(
        "chartevents icustays",
        "SELECT stay_id, charttime, c.itemid FROM chartevents c JOIN icustays USING (stay_id, hadm_id, subject_id) "
        "WHERE charttime <= intime + INTERVAL '24' HOUR",
    ),
)
def _(spark, sf):
    joined = view(spark, sf, "chartevents").join(view(spark, sf, "icustays"), KEYS)
    known = timeline.up_to("charttime", timeline.landmark("intime"))
    return joined.filter(known).select("stay_id", "charttime", "itemid")


@check("C06_not_null_filter", with_views("chartevents", "SELECT stay_id, charttime, valuenum FROM chartevents WHERE valuenum IS NOT NULL"))
def _(spark, sf):
    return view(spark, sf, "chartevents").select("stay_id", "charttime", "valuenum").dropna(subset=["valuenum"])


VITAL_RULES = {
    "item": values_sql(RULES.vital_items, "itemid, variable"),
    "bound": values_sql(RULES.vital_ranges, "variable, low, high"),
}
LAB_RULE_CTES = {
    "item": values_sql(RULES.lab_items, "itemid, variable"),
    "bound": values_sql(RULES.lab_ranges, "variable, low, high"),
}


@check(
    "C07_plausible_vitals",
    with_views(
        "chartevents",
        "SELECT stay_id, charttime, variable, valuenum FROM chartevents JOIN item USING (itemid) "
        "JOIN bound USING (variable) WHERE valuenum BETWEEN low AND high",
        **VITAL_RULES,
    ),
)
def _(spark, sf):
    tagged = ev.tag_items(view(spark, sf, "chartevents"), RULES.vital_items)
    kept = ev.plausible(tagged, RULES.vital_ranges)
    return kept.select("stay_id", "charttime", "variable", "valuenum")


@check(
    "C08_plausible_labs",
    with_views(
        "labevents",
        "SELECT hadm_id, charttime, variable, valuenum FROM labevents JOIN item USING (itemid) "
        "JOIN bound USING (variable) WHERE valuenum BETWEEN low AND high",
        **LAB_RULE_CTES,
    ),
    "valuenum",
)
def _(spark, sf):
    tagged = ev.tag_items(view(spark, sf, "labevents"), RULES.lab_items)
    kept = ev.plausible(tagged, RULES.lab_ranges)
    return kept.select("hadm_id", "charttime", "variable", "valuenum")


@check("C09_non_negative", with_views("outputevents", "SELECT stay_id, charttime, value FROM outputevents WHERE value >= 0"), "value")
def _(spark, sf):
    return view(spark, sf, "outputevents").filter(F.col("value") >= 0).select("stay_id", "charttime", "value")


@check(
    "C10_item_list_and_range",
    with_views("chartevents", "SELECT stay_id, charttime, valuenum FROM chartevents WHERE itemid IN (5, 6) AND valuenum BETWEEN 20 AND 300"),
)
def _(spark, sf):
    kept = view(spark, sf, "chartevents").filter(F.col("itemid").isin(5, 6) & F.col("valuenum").between(20, 300))
    return kept.select("stay_id", "charttime", "valuenum")


@check(
    "C11_interval_overlap",
    with_views(
        "ventilation icustays",
        "SELECT stay_id, starttime, endtime FROM ventilation JOIN icustays USING (stay_id, hadm_id, subject_id) "
        "WHERE starttime < intime + INTERVAL '24' HOUR AND (endtime IS NULL OR endtime > intime)",
    ),
)
def _(spark, sf):
    joined = view(spark, sf, "ventilation").join(view(spark, sf, "icustays"), KEYS)
    met = timeline.overlaps("starttime", "endtime", "intime", timeline.landmark("intime"))
    return joined.filter(met).select("stay_id", "starttime", "endtime")


@check("C12_positive_length", with_views("ventilation", "SELECT stay_id, starttime, endtime FROM ventilation WHERE endtime > starttime"))
def _(spark, sf):
    return iv.positive_length(view(spark, sf, "ventilation")).select("stay_id", "starttime", "endtime")


# -- D: joins ------------------------------------------------------------------


@check(
    "D01_stays_patients",
    with_views("icustays patients", "SELECT stay_id, subject_id, gender, anchor_age FROM icustays JOIN patients USING (subject_id)"),
)
def _(spark, sf):
    joined = view(spark, sf, "icustays").join(view(spark, sf, "patients"), "subject_id")
    return joined.select("stay_id", "subject_id", "gender", "anchor_age")


@check(
    "D02_stays_admissions",
    with_views(
        "icustays admissions",
        "SELECT stay_id, hadm_id, icustays.subject_id, admittime, deathtime FROM icustays JOIN admissions USING (hadm_id, subject_id)",
    ),
)
def _(spark, sf):
    stays = co.admitted_stays(view(spark, sf, "icustays"), view(spark, sf, "admissions"))
    return stays.select("stay_id", "hadm_id", "subject_id", "admittime", "deathtime")


@check(
    "D03_tag_items",
    with_views("chartevents", "SELECT stay_id, charttime, itemid, variable, valuenum FROM chartevents JOIN item USING (itemid)", **VITAL_RULES),
)
def _(spark, sf):
    tagged = ev.tag_items(view(spark, sf, "chartevents"), RULES.vital_items)
    return tagged.select("stay_id", "charttime", "itemid", "variable", "valuenum")


@check(
    "D04_events_in_window",
    cohort_sql(
        f"SELECT {K}, charttime, itemid, valuenum FROM chartevents JOIN cohort USING ({K}) "
        "WHERE charttime >= intime AND charttime < prediction_time",
        "chartevents",
    ),
)
def _(spark, sf):
    events = view(spark, sf, "chartevents").drop("valueuom")
    return ev.events_in_window(events, cohort_df(spark, sf))


@check(
    "D05_assign_to_stay",
    cohort_sql(
        "SELECT subject_id, hadm_id, stay_id, charttime, itemid, valuenum FROM labevents JOIN cohort USING (subject_id, hadm_id) "
        "WHERE charttime >= intime AND charttime < prediction_time",
        "labevents",
    ),
    "valuenum",
)
def _(spark, sf):
    events = view(spark, sf, "labevents").drop("valueuom")
    return ev.assign_to_stay(events, cohort_df(spark, sf))


@check(
    "D06_D07_intervals_in_window",
    cohort_sql(
        f"SELECT {K}, starttime, endtime, itemid, intime, prediction_time FROM inputevents JOIN cohort USING ({K}) "
        "WHERE starttime < prediction_time AND (endtime IS NULL OR endtime > intime)",
        "inputevents",
    ),
)
def _(spark, sf):
    intervals = view(spark, sf, "inputevents").drop("rate", "amount")
    return iv.intervals_in_window(intervals, cohort_df(spark, sf))


IN_WINDOW = (
    f"SELECT {K}, charttime, variable, valuenum FROM chartevents JOIN item USING (itemid) JOIN bound USING (variable) "
    f"JOIN cohort USING ({K}) WHERE valuenum BETWEEN low AND high AND charttime >= intime AND charttime < prediction_time"
)
SUMMARY = (
    "SELECT {by}, min(valuenum) AS value_min, max(valuenum) AS value_max, avg(valuenum) AS value_mean, "
    "list(valuenum ORDER BY charttime, valuenum)[1] AS value_first, "
    "list(valuenum ORDER BY charttime DESC, valuenum DESC)[1] AS value_last, max(charttime) AS last_time, "
    "count(*) AS measurement_count FROM {source} GROUP BY {by}"
)


def vital_summary(spark, sf):
    tagged = ev.tag_items(view(spark, sf, "chartevents"), RULES.vital_items)
    return ev.summarise(ev.events_in_window(ev.plausible(tagged, RULES.vital_ranges), cohort_df(spark, sf)))


SUMMARY_CTES = {**VITAL_RULES, "kept": IN_WINDOW, "summary": SUMMARY.format(by=f"{K}, variable", source="kept")}
STATS = "value_min value_max value_mean value_first value_last"


@check("E01_E02_E03_summary", cohort_sql("SELECT * FROM summary", "chartevents", **SUMMARY_CTES), STATS)
def _(spark, sf):
    return vital_summary(spark, sf)


def pivot_sql(prefixes, counts=()):
    columns = []
    for variable, prefix in prefixes.items():
        for s in ("first", "last", "min", "max", "mean"):
            columns.append(f"max(CASE WHEN variable = '{variable}' THEN value_{s} END) AS {prefix}_{s}")
        if variable in counts:
            columns.append(f"max(CASE WHEN variable = '{variable}' THEN measurement_count END) AS {prefix}_measurement_count")
    return f"SELECT {K}, {', '.join(columns)} FROM summary GROUP BY {K}"


def stat_names(prefixes):
    return " ".join(f"{p}_{s}" for p in prefixes.values() for s in ("first", "last", "min", "max", "mean"))


VITALS_SQL = pivot_sql(RULES.vital_prefixes, ["heart_rate"])
LABS_IN_WINDOW = (
    f"SELECT {K}, charttime, variable, valuenum FROM labevents JOIN item USING (itemid) JOIN bound USING (variable) "
    "JOIN cohort USING (subject_id, hadm_id) "
    "WHERE valuenum BETWEEN low AND high AND charttime >= intime AND charttime < prediction_time"
)


@check(
    "E04_pivot_vitals",
    cohort_sql("SELECT * FROM wide", "chartevents", **SUMMARY_CTES, wide=VITALS_SQL),
    stat_names(RULES.vital_prefixes),
)
def _(spark, sf):
    return plan.vitals(view(spark, sf, "chartevents"), cohort_df(spark, sf), RULES)


@check(
    "E05_pivot_labs",
    cohort_sql(
        "SELECT * FROM wide",
        "labevents",
        **LAB_RULE_CTES,
        kept=LABS_IN_WINDOW,
        summary=SUMMARY.format(by=f"{K}, variable", source="kept"),
        wide=pivot_sql(RULES.lab_prefixes),
    ),
    stat_names(RULES.lab_prefixes),
)
def _(spark, sf):
    return plan.labs(view(spark, sf, "labevents"), cohort_df(spark, sf), RULES)


@check(
    "D08_vitals_for_every_stay",
    cohort_sql(f"SELECT * FROM (SELECT {K} FROM cohort) LEFT JOIN wide USING ({K})", "chartevents", **SUMMARY_CTES, wide=VITALS_SQL),
    stat_names(RULES.vital_prefixes),
)
def _(spark, sf):
    cohort = stage(cohort_df(spark, sf), "cohort")
    return assemble.left_features(cohort, plan.vitals(view(spark, sf, "chartevents"), cohort, RULES))


EXPOSURE_CTES = {
    "pressor": values_sql(RULES.pressor_items, "itemid, drug"),
    "cut": f"SELECT {K}, drug, greatest(starttime, intime) AS s, "
    "least(coalesce(endtime, prediction_time), prediction_time) AS e FROM inputevents JOIN pressor USING (itemid) "
    f"JOIN cohort USING ({K}) WHERE starttime < prediction_time AND (endtime IS NULL OR endtime > intime)",
    "pressors": f"SELECT {K}, 1 AS vasopressor_any_24h, "
    + ", ".join(f"max(CASE WHEN drug = '{i.variable}' THEN 1 ELSE 0 END) AS {i.variable}_24h" for i in RULES.pressor_items)
    + ", min(s) AS first_pressor_time, max(e) AS last_pressor_time, "
    "sum(date_diff('microsecond', s, e) / CAST(3600000000 AS DOUBLE)) AS pressor_exposure_hours "
    f"FROM cut WHERE e > s GROUP BY {K}",
}


@check("E08_E09_E10_E11_pressor_exposure", cohort_sql("SELECT * FROM pressors", "inputevents", **EXPOSURE_CTES), "pressor_exposure_hours")
def _(spark, sf):
    return plan.pressors(view(spark, sf, "inputevents"), cohort_df(spark, sf), RULES)


DRUG_FLAGS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ["vasopressor_any_24h"] + [f"{i.variable}_24h" for i in RULES.pressor_items])


@check(
    "D08_pressors_for_every_stay",
    cohort_sql(
        f"SELECT {K}, {DRUG_FLAGS}, first_pressor_time, last_pressor_time, "
        f"coalesce(pressor_exposure_hours, 0) AS pressor_exposure_hours FROM cohort LEFT JOIN pressors USING ({K})",
        "inputevents",
        **EXPOSURE_CTES,
    ),
    "pressor_exposure_hours",
)
def _(spark, sf):
    cohort = stage(cohort_df(spark, sf), "cohort")
    found = plan.pressors(view(spark, sf, "inputevents"), cohort, RULES)
    return assemble.left_features(cohort, found, zero=plan.pressor_zero(RULES))


VENT_CTES = {
    "vcut": f"SELECT {K}, greatest(starttime, intime) AS s, "
    "least(coalesce(endtime, prediction_time), prediction_time) AS e "
    f"FROM ventilation JOIN cohort USING ({K}) WHERE starttime < prediction_time AND (endtime IS NULL OR endtime > intime)",
    "vents": f"SELECT {K}, 1 AS seen, min(s) AS ventilation_start, max(e) AS ventilation_end, "
    "sum(date_diff('microsecond', s, e) / CAST(3600000000 AS DOUBLE)) AS ventilation_duration_hours "
    f"FROM vcut WHERE e > s GROUP BY {K}",
}


@check(
    "D11_ventilation_for_every_stay",
    cohort_sql(
        f"SELECT {K}, coalesce(seen, 0) AS mechanical_ventilation_24h, ventilation_start, ventilation_end, "
        f"coalesce(ventilation_duration_hours, 0) AS ventilation_duration_hours FROM cohort LEFT JOIN vents USING ({K})",
        "ventilation",
        **VENT_CTES,
    ),
    "ventilation_duration_hours",
)
def _(spark, sf):
    cohort = stage(cohort_df(spark, sf), "cohort")
    found = plan.ventilation(view(spark, sf, "ventilation"), cohort)
    return assemble.left_features(cohort, found, zero=plan.VENTILATION_ZERO)


WEIGHT_CTES = {
    "weights": f"SELECT {K}, valuenum AS weight_kg, charttime AS weight_time FROM chartevents JOIN cohort USING ({K}) "
    "WHERE itemid = 5 AND charttime <= prediction_time AND valuenum BETWEEN 20 AND 300 "
    f"QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY charttime DESC, valuenum DESC) = 1",
}
URINE_CTES = {
    "urine": f"SELECT {K}, sum(value) AS urine_output_ml_24h, count(*) AS urine_measurement_count, "
    "min(charttime) AS first_urine_time, max(charttime) AS last_urine_time "
    f"FROM outputevents JOIN cohort USING ({K}) WHERE itemid IN (1, 2) AND value >= 0 "
    f"AND charttime >= intime AND charttime < prediction_time GROUP BY {K}",
}


@check("D10_F02_as_of_last", cohort_sql("SELECT * FROM weights", "chartevents", **WEIGHT_CTES), "weight_kg")
def _(spark, sf):
    return plan.weight(view(spark, sf, "chartevents"), cohort_df(spark, sf), RULES)


@check(
    "F02_latest_per_key",
    with_views(
        "chartevents",
        "SELECT stay_id, charttime, itemid, valuenum FROM chartevents WHERE valuenum IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY stay_id ORDER BY charttime DESC, itemid DESC, valuenum DESC) = 1",
    ),
)
def _(spark, sf):
    events = view(spark, sf, "chartevents").select("stay_id", "charttime", "itemid", "valuenum").dropna()
    return co.latest_per_key(events, ["stay_id"], ["charttime", "itemid", "valuenum"])


@check("E06_E07_urine_sums", cohort_sql("SELECT * FROM urine", "outputevents", **URINE_CTES), "urine_output_ml_24h")
def _(spark, sf):
    return plan.urine(view(spark, sf, "outputevents"), cohort_df(spark, sf), RULES)


URINE_COLUMNS = (
    "coalesce(urine_output_ml_24h, 0) AS urine_output_ml_24h, "
    "CASE WHEN weight_kg > 0 THEN coalesce(urine_output_ml_24h, 0) / weight_kg / 24 END AS urine_output_ml_kg_h_24h, "
    "coalesce(urine_measurement_count, 0) AS urine_measurement_count, first_urine_time, last_urine_time, "
    "weight_kg, weight_time"
)


@check(
    "D09_urine_with_weight",
    cohort_sql(
        f"SELECT {K}, {URINE_COLUMNS} FROM cohort LEFT JOIN urine USING ({K}) LEFT JOIN weights USING ({K})",
        "outputevents chartevents",
        **URINE_CTES,
        **WEIGHT_CTES,
    ),
    "urine_output_ml_24h urine_output_ml_kg_h_24h weight_kg",
)
def _(spark, sf):
    cohort = stage(cohort_df(spark, sf), "cohort")
    return plan.urine_table(view(spark, sf, "outputevents"), view(spark, sf, "chartevents"), cohort, RULES)


def wide_table(spark, sf):
    sources = {n: view(spark, sf, n) for n in ("chartevents", "labevents", "ventilation", "inputevents", "outputevents")}
    return plan.landmark_table(stage(cohort_df(spark, sf), "cohort"), sources, RULES)


WIDE_VIEWS = "chartevents labevents inputevents ventilation outputevents"
WIDE_CTES = {
    **SUMMARY_CTES,
    "wide_vitals": VITALS_SQL,
    "lab_item": LAB_RULE_CTES["item"],
    "lab_bound": LAB_RULE_CTES["bound"],
    "lab_kept": LABS_IN_WINDOW.replace("item USING", "lab_item USING").replace("bound USING", "lab_bound USING"),
    "lab_summary": SUMMARY.format(by=f"{K}, variable", source="lab_kept"),
    "wide_labs": pivot_sql(RULES.lab_prefixes).replace("FROM summary", "FROM lab_summary"),
    **VENT_CTES,
    **EXPOSURE_CTES,
    **URINE_CTES,
    **WEIGHT_CTES,
    "final": f"SELECT c.* , v.* EXCLUDE ({K}), l.* EXCLUDE ({K}), "
    "coalesce(ve.seen, 0) AS mechanical_ventilation_24h, ve.ventilation_start, ve.ventilation_end, "
    "coalesce(ve.ventilation_duration_hours, 0) AS ventilation_duration_hours, "
    f"{DRUG_FLAGS}, first_pressor_time, last_pressor_time, "
    "coalesce(pressor_exposure_hours, 0) AS pressor_exposure_hours, "
    f"{URINE_COLUMNS}, 0 AS urine_output_missing "
    f"FROM (SELECT {', '.join(rules.WIDE_COHORT_COLUMNS)} FROM cohort) c "
    + " ".join(
        f"LEFT JOIN {table} {alias} ON " + " AND ".join(f"{alias}.{k} = c.{k}" for k in KEYS)
        for table, alias in [("wide_vitals", "v"), ("wide_labs", "l"), ("vents", "ve"), ("pressors", "p"), ("urine", "u"), ("weights", "w")]
    ),
}
WIDE_DOUBLES = " ".join(
    [
        stat_names(RULES.vital_prefixes),
        stat_names(RULES.lab_prefixes),
        "ventilation_duration_hours pressor_exposure_hours urine_output_ml_24h urine_output_ml_kg_h_24h weight_kg",
    ]
)


def wide_sql(query, **ctes):
    """`query` over the wide table, called `final`."""
    return cohort_sql(query, WIDE_VIEWS, **WIDE_CTES, **ctes)


check("D12_landmark_table", wide_sql("SELECT * FROM final"), WIDE_DOUBLES)(wide_table)


# -- G: sorts and limits -------------------------------------------------------


@check(
    "G05_preview",
    with_views("icustays", "SELECT stay_id, intime, first_careunit FROM icustays ORDER BY stay_id LIMIT 5"),
)
def _(spark, sf):
    from tidemark.operators.profile import preview

    return preview(view(spark, sf, "icustays").select("stay_id", "intime", "first_careunit"), ["stay_id"])
