"""Queries for cleaning, windows, filling, imputation (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuriver.operators import clean, impute, reshape, transform
from icuriver.operators.cohort import attach_feature
from icuriver.plans.registry import query, round_sql, rounded
from icuriver.plans.views import (
    CLINICAL, CLINICAL_FEATURES, FEATURES, WINDOWS, clinical, long_events, table, with_ctes,
)
from icuriver.plans.catalog_cohort import _COHORT_STEPS, _MEASURED, cohort_of, dictionary, measured, narrowed
from icuriver.session import cut_lineage, shared_folder
from icuriver.sources import sinks
from icuriver.sources.tables import restrict_to

V, TS = "visit_occurrence_id", "measurement_datetime"
KEY = [V, TS]
_CUT = """SELECT l.* FROM long l JOIN (SELECT feature_name, quantile_cont(CAST(value_as_number AS DOUBLE), 0.25) AS q1,
 quantile_cont(CAST(value_as_number AS DOUBLE), 0.75) AS q3 FROM long GROUP BY 1) q USING (feature_name)
 WHERE value_as_number BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"""
_ROUND_FEATURES = round_sql(*FEATURES)
_NO_VIEW = [f for f in FEATURES if f != "view"]


def windows(spark, sf):
    """Gap-filled 12 h windows of the event record."""
    wide = reshape.to_wide(long_events(spark, sf), FEATURES)
    return reshape.windowed_means(wide, FEATURES)


# averaging at equal times first changes a window mean; the event times are distinct
def _feature_averages(source, hours):
    cells = ", ".join(f"avg(value_as_number) FILTER (WHERE feature_name = '{f}') AS {f}" for f in FEATURES)
    return f"SELECT {V}, time_bucket(INTERVAL '{hours} hours', {TS}) AS {TS}, {cells} FROM {source} GROUP BY 1, 2"


@query("d1_outlier_cut_long", with_ctes(WINDOWS, _CUT))
def d1(spark, sf):
    return clean.drop_outliers_long(long_events(spark, sf), FEATURES)


@query(
    "d1_outlier_cut_fallback",
    with_ctes(("long",), """SELECT l.* FROM long l JOIN s USING (feature_name) WHERE value_as_number BETWEEN lo AND hi""",
        q="""SELECT feature_name, quantile_cont(CAST(value_as_number AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(value_as_number AS DOUBLE), 0.75) AS q3,
 quantile_cont(CAST(value_as_number AS DOUBLE), 0.01) AS p1, quantile_cont(CAST(value_as_number AS DOUBLE), 0.99) AS p99 FROM long GROUP BY 1""",
        o="""SELECT feature_name, q1, q3, p1, p99, avg(CASE WHEN value_as_number < q1 - 1.5 * (q3 - q1) OR value_as_number > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0 END) AS a,
 avg(CASE WHEN value_as_number < p1 OR value_as_number > p99 THEN 1.0 ELSE 0 END) AS b FROM long JOIN q USING (feature_name) GROUP BY ALL""",
        s="""SELECT feature_name, CASE WHEN a > 0.1 AND b > 0.1 THEN -1e300 WHEN a > 0.1 THEN p1 ELSE q1 - 1.5 * (q3 - q1) END AS lo,
 CASE WHEN a > 0.1 AND b > 0.1 THEN 1e300 WHEN a > 0.1 THEN p99 ELSE q3 + 1.5 * (q3 - q1) END AS hi FROM o"""),
)
def d1_fallback(spark, sf):
    return clean.drop_outliers_long(long_events(spark, sf), FEATURES, fallback=True)


_WIDE_CUTS = ", ".join(
    f"round(CASE WHEN {f} BETWEEN {f}_1 - 1.5 * ({f}_3 - {f}_1) AND {f}_3 + 1.5 * ({f}_3 - {f}_1) THEN {f} END, 6) AS {f}" for f in FEATURES
)
_WIDE_Q = "SELECT " + ", ".join(f"quantile_cont({f}, 0.25) AS {f}_1, quantile_cont({f}, 0.75) AS {f}_3" for f in FEATURES) + " FROM win"


@query("d2_outlier_null_wide", with_ctes(WINDOWS, f"SELECT {V}, {TS}, {_WIDE_CUTS} FROM win, q", q=_WIDE_Q))
def d2(spark, sf):
    rows = windows(spark, sf).select(*KEY, *FEATURES)
    return rounded(clean.null_outliers_wide(rows, FEATURES), *FEATURES)


@query(
    "d3_upper_percentile_cut",
    "SELECT event_id, value FROM events WHERE value < (SELECT quantile_cont(CAST(value AS DOUBLE), 0.99) FROM events)",
)
def d3(spark, sf):
    return clean.cut_upper(table(spark, sf, "events").select("event_id", "value"), "value")


@query(
    "d4_average_duplicates",
    f"""SELECT user_id AS {V}, date_trunc('day', ts) AS {TS}, event_type AS feature_name, round(avg(value), 6) AS value_as_number
    FROM events GROUP BY 1, 2, 3""",
)
def d4(spark, sf):
    days = long_events(spark, sf).withColumn(TS, F.date_trunc("day", TS).cast("timestamp_ntz"))
    return rounded(reshape.average_duplicates(days), "value_as_number")


@query(
    "d5_long_to_wide",
    with_ctes(("long",), f"SELECT {V}, {TS}, {_ROUND_FEATURES} FROM w", w="SELECT " + f"{V}, {TS}, " + ", ".join(
        f"avg(value_as_number) FILTER (WHERE feature_name = '{f}') AS {f}" for f in FEATURES) + " FROM long GROUP BY 1, 2"),
)
def d5(spark, sf):
    return rounded(reshape.to_wide(long_events(spark, sf), FEATURES), *FEATURES)


def _grid(hours, source, keys):
    return f"""SELECT {keys}, unnest(generate_series(min({TS}), max({TS}), INTERVAL '{hours} hours')) AS {TS} FROM {source} GROUP BY {keys}"""


_PERSON_LONG = """SELECT user_id - user_id % 2 AS person_id, user_id AS visit_occurrence_id, ts AS measurement_datetime,
 event_type AS feature_name, value AS value_as_number FROM events"""


@query(
    "d6_wide_resampled_by_person",
    with_ctes((), f"""SELECT g.person_id, g.{V}, g.{TS}, {_ROUND_FEATURES},
    row_number() OVER (PARTITION BY g.person_id, g.{V} ORDER BY g.{TS}) - 1 AS seq_id
    FROM g LEFT JOIN b USING (person_id, {V}, {TS})""",
    pl=_PERSON_LONG, b=_feature_averages("pl", 4).replace("SELECT ", "SELECT person_id, ").replace("GROUP BY 1, 2", "GROUP BY ALL"),
    g=_grid(4, "b", f"person_id, {V}")),
)
def d6(spark, sf):
    people = long_events(spark, sf).withColumn("person_id", F.col(V) - F.col(V) % 2)
    return rounded(reshape.wide_resampled(people, FEATURES), *FEATURES)


@query(
    "d7_merge_series",
    with_ctes((), f"""SELECT {V}, {TS}, {round_sql(*_NO_VIEW)}, view, round(view / click, 6) AS ratio
    FROM a FULL OUTER JOIN b USING ({V}, {TS})""",
    a=f"""SELECT user_id AS {V}, date_trunc('day', ts) AS {TS}, {', '.join(f"avg(value) FILTER (WHERE event_type = '{f}') AS {f}" for f in _NO_VIEW)}
    FROM events WHERE event_type <> 'view' GROUP BY 1, 2""",
    b=f"SELECT user_id AS {V}, date_trunc('day', ts) AS {TS}, value AS view FROM events WHERE event_type = 'view'"),
)
def d7(spark, sf):
    days = long_events(spark, sf).withColumn(TS, F.date_trunc("day", TS).cast("timestamp_ntz"))
    wide = reshape.to_wide(days, _NO_VIEW)
    views = days.where("feature_name = 'view'").select(*KEY, F.col("value_as_number").alias("view"))
    merged = reshape.merge_series(wide, views)
    return rounded(merged.withColumn("ratio", F.try_divide("view", "click")), *_NO_VIEW, "ratio")


@query("d8_gap_filled_windows", with_ctes(WINDOWS, f"SELECT {V}, {TS}, {_ROUND_FEATURES} FROM win"))
def d8(spark, sf):
    return rounded(windows(spark, sf), *FEATURES)


@query(
    "d8_windows_of_seven_hours",
    with_ctes((), f"""SELECT g.{V}, g.{TS}, round(value, 6) AS value FROM g LEFT JOIN b USING ({V}, {TS})""",
    a="SELECT user_id, date_trunc('day', min(ts)) AS d0 FROM events GROUP BY 1",
    b=f"""SELECT user_id AS {V}, d0 + to_hours(CAST(7 * (date_sub('microsecond', d0, ts) // 25200000000) AS INTEGER)) AS {TS},
    avg(value) AS value FROM events JOIN a USING (user_id) GROUP BY 1, 2""", g=_grid(7, "b", V)),
)
def d8_seven(spark, sf):
    rows = table(spark, sf, "events").select(F.col("user_id").alias(V), F.col("ts").alias(TS), "value")
    return rounded(reshape.windowed_means(rows, ["value"], hours=7), "value")


@query(
    "d9_sequence_numbers",
    with_ctes(WINDOWS, f"SELECT {V}, {TS}, row_number() OVER (PARTITION BY {V} ORDER BY {TS}) - 1 AS seq_id FROM win"),
)
def d9(spark, sf):
    return reshape.sequence_numbers(windows(spark, sf).select(*KEY))


@query(
    "d10_drop_empty_rows",
    with_ctes(WINDOWS, f"""SELECT {_ROUND_FEATURES} FROM win WHERE coalesce({', '.join(FEATURES)}) IS NOT NULL"""),
)
def d10(spark, sf):
    return rounded(clean.drop_empty_rows(windows(spark, sf).select(*FEATURES)), *FEATURES)


@query(
    "d10_drop_incomplete_rows",
    with_ctes(WINDOWS, f"SELECT {V}, {TS}, {_ROUND_FEATURES} FROM win WHERE click IS NOT NULL AND view IS NOT NULL"),
)
def d10_subset(spark, sf):
    return rounded(clean.drop_empty_rows(windows(spark, sf), ["click", "view"]), *FEATURES)


@query(
    "d11_attach_attributes",
    with_ctes(WINDOWS, f"""SELECT w.{V}, w.{TS}, {_ROUND_FEATURES}, c_acctbal, c_mktsegment
    FROM win w LEFT JOIN customer ON w.{V} = c_custkey"""),
)
def d11(spark, sf):
    people = table(spark, sf, "customer").withColumnRenamed("c_custkey", V)
    rows = windows(spark, sf).select(*KEY, *FEATURES)
    return rounded(reshape.attach_attributes(rows, people, ["c_acctbal", "c_mktsegment"]), *FEATURES)


def _yeo_johnson(v, lam):
    up = f"CASE WHEN abs({lam}) < 1e-12 THEN ln(1 + {v}) ELSE (pow({v} + 1, {lam}) - 1) / {lam} END"
    down = f"CASE WHEN abs(2 - {lam}) < 1e-12 THEN -ln(1 - {v}) ELSE -(pow(1 - {v}, 2 - {lam}) - 1) / (2 - {lam}) END"
    return f"CASE WHEN {v} >= 0 THEN {up} ELSE {down} END"


def _fitted_sql():
    """The likeliest exponent of each feature on a grid that is refined around the best one twice."""
    steps = transform.GRID_STEPS - 1
    cells = {"cell": " UNION ALL ".join(f"SELECT '{f}' AS f, {f}::DOUBLE AS v FROM win WHERE {f} IS NOT NULL" for f in FEATURES)}
    low, width = str(transform.GRID_LOW), transform.GRID_HIGH - transform.GRID_LOW
    for n in range(transform.REFINEMENTS + 1):
        of = "(SELECT DISTINCT f FROM cell)" if n == 0 else f"best{n - 1}"
        cells[f"grid{n}"] = f"SELECT f, {low} + {width}::DOUBLE * i / {steps} AS lam FROM {of}, range({steps + 1}) t(i)"
        cells[f"best{n}"] = f"""SELECT f, arg_max(lam, llf) AS lam FROM (SELECT f, lam, -count(*) / 2 * ln(var_pop({_yeo_johnson('v', 'lam')})) + (lam - 1) * sum(sign(v) * ln(1 + abs(v))) AS llf
 FROM cell JOIN grid{n} USING (f) GROUP BY f, lam) GROUP BY f"""
        low, width = f"lam - {width / steps}::DOUBLE", 2 * width / steps
    last = f"best{transform.REFINEMENTS}"
    cells["lams"] = "SELECT " + ", ".join(f"max(lam) FILTER (WHERE f = '{f}') AS {f}_l" for f in FEATURES) + f" FROM {last}"
    made = {f: _yeo_johnson(f, f"{f}_l") for f in FEATURES}
    cells["sk"] = "SELECT " + ", ".join(f"{_skew(f)} AS {f}_b, {_skew(f'({e})')} AS {f}_a" for f, e in made.items()) + " FROM win, lams"
    out = ", ".join(f"round(CASE WHEN abs({f}_b) > abs({f}_a) THEN {e} ELSE {f} END, 5) AS {f}" for f, e in made.items())
    return with_ctes(WINDOWS, f"SELECT {V}, {TS}, {out} FROM win, lams, sk", **cells)


def _skew(x):
    return f"(avg(pow({x}, 3)) - 3 * avg({x}) * avg(pow({x}, 2)) + 2 * pow(avg({x}), 3)) / pow(var_pop({x}), 1.5)"


@query("d12_power_transform", _fitted_sql())
def d12(spark, sf):
    # the windows are read in every round of the search
    rows = cut_lineage(windows(spark, sf))
    return rounded(transform.reduce_skew(rows, columns=FEATURES).select(*KEY, *FEATURES), *FEATURES, digits=5)


_LAMBDAS = {"click": 0.3, "error": 0.0, "purchase": 0.5, "signup": 1.5, "view": 2.0}


def _power_sql(f, lam):
    up = f"ln(1 + {f})" if lam == 0 else f"(pow({f} + 1, {lam}) - 1) / {lam}"
    return up


_POWER_CELLS = {f: _power_sql(f, lam) for f, lam in _LAMBDAS.items()}


@query(
    "d12_power_transform_fixed",
    with_ctes(WINDOWS, f"SELECT {V}, {TS}, " + ", ".join(
        f"round(CASE WHEN abs({f}_b) > abs({f}_a) THEN {e} ELSE {f} END, 6) AS {f}" for f, e in _POWER_CELLS.items()
    ) + " FROM win, sk", sk="SELECT " + ", ".join(f"{_skew(f)} AS {f}_b, {_skew(f'({e})')} AS {f}_a" for f, e in _POWER_CELLS.items()) + " FROM win"),
)
def d12_fixed(spark, sf):
    rows = windows(spark, sf).select(*KEY, *_LAMBDAS)
    return rounded(transform.apply_power(rows, _LAMBDAS), *_LAMBDAS)


def _z(dev):
    stats = ", ".join(f"avg({f}) AS {f}_m, {dev}({f}) AS {f}_s" for f in FEATURES)
    cells = ", ".join(f"round(({f} - {f}_m) / {f}_s, 6) AS {f}" for f in FEATURES)
    return with_ctes(WINDOWS, f"SELECT {V}, {TS}, {cells} FROM win, st", st=f"SELECT {stats} FROM win")


@query("d13_standardise", _z("stddev_samp"))
def d13(spark, sf):
    return rounded(clean.standardise(windows(spark, sf), ignore=[V]), *FEATURES)


@query("d14_standardise_population", _z("stddev_pop"))
def d14(spark, sf):
    scaled, _ = clean.standardise_population(windows(spark, sf), FEATURES)
    return rounded(scaled, *FEATURES)


@query(
    "d14_fitted_scaler",
    with_ctes(WINDOWS, " UNION ALL ".join(
        f'SELECT \'{f}\' AS "column", round(avg({f}), 6) AS mean, round(stddev_pop({f}), 6) AS scale FROM win' for f in FEATURES)),
)
def d14_scaler(spark, sf):
    return rounded(clean.fit_scaler(windows(spark, sf), FEATURES), "mean", "scale")


@query(
    "d15_missing_report",
    with_ctes(WINDOWS, " UNION ALL ".join(
        f'SELECT \'{f}\' AS "column", round(avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0 END) * 100, 6) AS missing_pct FROM win' for f in FEATURES)),
)
def d15(spark, sf):
    return rounded(clean.missing_report(windows(spark, sf), FEATURES), "missing_pct")


_POSITIONS = f"SELECT *, row_number() OVER (ORDER BY {V}, {TS}) AS pos FROM win"
_GAPS = " UNION ALL ".join(
    f"""SELECT '{f}' AS "column", CASE WHEN count(*) > 1 THEN avg(gap) ELSE 0 END AS mean_gap FROM
 (SELECT pos - lag(pos) OVER (ORDER BY pos) - 1 AS gap FROM p WHERE {f} IS NOT NULL)""" for f in FEATURES
)


@query("d16_mean_gaps", with_ctes(WINDOWS, 'SELECT "column", round(mean_gap, 6) AS mean_gap FROM g', p=_POSITIONS, g=_GAPS))
def d16(spark, sf):
    return rounded(impute.mean_gaps(windows(spark, sf), FEATURES), "mean_gap")


_PRESENT = " + ".join(f"CASE WHEN {f} IS NULL THEN 0 ELSE 1 END" for f in FEATURES)


@query(
    "d17_drop_sparse_rows",
    with_ctes(WINDOWS, f"SELECT {V}, {TS}, {_ROUND_FEATURES} FROM win WHERE ({_PRESENT}) / 5.0 >= 0.30"),
)
def d17(spark, sf):
    return rounded(clean.drop_sparse_rows(windows(spark, sf), FEATURES), *FEATURES)


def _fill_steps(source, unlimited=()):
    numbered = f"SELECT *, row_number() OVER (PARTITION BY {V} ORDER BY {TS}) AS rn FROM {source}"
    last = ", ".join(
        f"max(CASE WHEN {f} IS NOT NULL THEN rn END) OVER w AS {f}_rn, last_value({f} IGNORE NULLS) OVER w AS {f}_v" for f in FEATURES
    )
    carried = f"SELECT *, {last} FROM fn WINDOW w AS (PARTITION BY {V} ORDER BY {TS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return {"fn": numbered, "fc": carried}


def _limit(f):
    return f"(SELECT greatest(1, CAST(floor(mean_gap) AS INTEGER)) FROM g WHERE \"column\" = '{f}')"


_FILLED = ", ".join(f"CASE WHEN rn - {f}_rn <= {_limit(f)} THEN {f}_v END AS {f}" for f in FEATURES)


@query(
    "d18_limited_forward_fill",
    with_ctes(WINDOWS, f"SELECT {V}, {TS}, {_ROUND_FEATURES} FROM ff", p=_POSITIONS, g=_GAPS, **_fill_steps("win"),
              ff=f"SELECT {V}, {TS}, {_FILLED} FROM fc"),
)
def d18(spark, sf):
    return rounded(impute.forward_fill(cut_lineage(windows(spark, sf)), FEATURES), *FEATURES)


@query(
    "d19_unlimited_forward_fill",
    with_ctes(WINDOWS, f"SELECT {V}, {TS}, " + ", ".join(f"round({f}_v, 6) AS {f}" for f in FEATURES) + " FROM fc", **_fill_steps("win")),
)
def d19(spark, sf):
    rows = windows(spark, sf)
    return rounded(impute.forward_fill(rows, FEATURES, limits={}, unlimited=FEATURES), *FEATURES)


@query(
    "d20_split_by_visit",
    """WITH v AS (SELECT DISTINCT o_custkey AS visit_occurrence_id FROM orders),
    r AS (SELECT visit_occurrence_id, row_number() OVER (ORDER BY md5(visit_occurrence_id || ':42'), visit_occurrence_id) AS rk,
    count(*) OVER () AS n FROM v)
    SELECT visit_occurrence_id, CASE WHEN rk <= n - ceil(n * 0.4::DOUBLE) THEN 'train'
    WHEN rk <= n - ceil(ceil(n * 0.4::DOUBLE) * 0.5) THEN 'validation' ELSE 'test' END AS split FROM r""",
)
def d20(spark, sf):
    return impute.split_visits(table(spark, sf, "orders").select(F.col("o_custkey").alias(V)))


# --- nearest neighbours ---------------------------------------------------------------

_DIMS = [f"x{i}" for i in range(64)]
_HOLED = "SELECT vec_id, " + ", ".join(
    f"CASE WHEN (vec_id + {i}) % 4 = 0 THEN NULL ELSE CAST(embedding[{i + 1}] AS DOUBLE) END AS x{i}" for i in range(64)
) + " FROM embeddings"


def holed(spark, sf):
    """All embedding dimensions with every fourth cell missing."""
    cells = [f"CASE WHEN (vec_id + {i}) % 4 <> 0 THEN CAST(embedding[{i}] AS DOUBLE) END AS x{i}" for i in range(64)]
    return table(spark, sf, "embeddings").selectExpr("vec_id", *cells)


def _knn_sql(queries, donors, k, columns, key, within=None):
    """All pairs, ranked: the plain definition."""
    width = len(columns)
    shared = " + ".join(f"CASE WHEN q.{c} IS NULL OR d.{c} IS NULL THEN 0 ELSE 1 END" for c in columns)
    total = " + ".join(f"coalesce((q.{c} - d.{c}) * (q.{c} - d.{c}), 0)" for c in columns)
    same = f"q.{within} = d.{within}" if within else "TRUE"
    q_key = ", ".join(f"q.{c}" for c in key)
    d_key = ", ".join(f"d.{c}" for c in key)
    limit = k
    steps = {
        "pairs": f"""SELECT {', '.join(f'q.{c} AS q_{c}, d.{c} AS d_{c}' for c in key)}, {', '.join(f'd.{c} AS v_{c}, q.{c} IS NULL AS m_{c}' for c in columns)},
 ({total}) * {width} / nullif({shared}, 0) AS dist{f', (SELECT count(*) FROM {donors} x WHERE x.{within} = q.{within}) AS size' if within else ''}
 FROM {queries} q JOIN {donors} d ON {same}""",
    }
    order = ", ".join(f"d_{c}" for c in key)
    part = ", ".join(f"q_{c}" for c in key)
    outs = []
    for c in columns:
        steps[f"n_{c}"] = f"""SELECT {part}, avg(v_{c}) AS i FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY dist, {order}) AS rk
 FROM pairs WHERE m_{c} AND v_{c} IS NOT NULL AND dist IS NOT NULL) WHERE rk <= {limit} GROUP BY ALL"""
        mean = f"(SELECT avg({c}) FROM {donors} m{f' WHERE m.{within} = q.{within}' if within else ''})"
        outs.append(f"round(coalesce(q.{c}, n_{c}.i, {mean}), 9) AS {c}")
    joins = " ".join(f"LEFT JOIN n_{c} ON " + " AND ".join(f"q.{x} = n_{c}.q_{x}" for x in key) for c in columns)
    return steps, f"SELECT {q_key}, {', '.join(outs)} FROM {queries} q {joins}"


_SPLIT = {
    "holed": _HOLED,
    "train": "SELECT * FROM holed WHERE vec_id % 5 < 3",
    "rest": "SELECT * FROM holed WHERE vec_id % 5 >= 3",
}
_steps_rest, _body_rest = _knn_sql("rest", "train", 5, _DIMS, ["vec_id"])
_steps_train, _body_train = _knn_sql("train", "train", 5, _DIMS, ["vec_id"])
_steps_all, _body_all = _knn_sql("holed", "holed", "(SELECT greatest(2, least(CAST(floor(sqrt(count(*))) AS BIGINT), count(*) - 1)) FROM holed)", _DIMS, ["vec_id"])


@query("d21_knn_from_train", with_ctes((), _body_rest, **_SPLIT, **_steps_rest))
def d21(spark, sf):
    rows = holed(spark, sf)
    _, rest = impute.knn_fit_apply(rows.where("vec_id % 5 < 3"), [rows.where("vec_id % 5 >= 3")], _DIMS, ["vec_id"])
    return rounded(rest, *_DIMS, digits=9)


@query("d21_knn_of_train", with_ctes((), _body_train, **_SPLIT, **_steps_train))
def d21_train(spark, sf):
    (train,) = impute.knn_fit_apply(holed(spark, sf).where("vec_id % 5 < 3"), [], _DIMS, ["vec_id"])
    return rounded(train, *_DIMS, digits=9)


@query("d22_knn_of_table", with_ctes((), _body_all, **_SPLIT, **_steps_all))
def d22(spark, sf):
    return rounded(impute.knn_impute_dataset(holed(spark, sf), _DIMS, ["vec_id"]), *_DIMS, digits=9)


_steps_visit, _body_visit = _knn_sql(
    "win", "win", "greatest(2, least(CAST(floor(sqrt(size)) AS BIGINT), size - 1))", FEATURES, KEY, within=V
)


@query("d23_knn_within_visit", with_ctes(WINDOWS, _body_visit, **_steps_visit))
def d23(spark, sf):
    return rounded(impute.knn_impute_by_visit(cut_lineage(windows(spark, sf)), FEATURES, KEY), *FEATURES, digits=9)


@query(
    "d24_drop_sparse_columns",
    with_ctes((), "SELECT visit_occurrence_id, day, " + round_sql(*FEATURES) + " FROM w",
    w="SELECT user_id AS visit_occurrence_id, date_trunc('day', ts) AS day, " + ", ".join(f"avg(value) FILTER (WHERE event_type = '{f}') AS {f}" for f in FEATURES)
    + " FROM events GROUP BY 1, 2"),
)
def d24(spark, sf):
    days = long_events(spark, sf).withColumn("day", F.date_trunc("day", TS).cast("timestamp_ntz"))
    wide = reshape.to_wide(days, [*FEATURES, "no_such_event"], keys=(V, "day"))
    kept, _ = clean.drop_sparse_columns(wide, 99.5)
    return rounded(kept, *FEATURES)


@query(
    "d25_round_binary",
    "SELECT l_orderkey, l_partkey, CAST(round_even(l_quantity / 4, 0) AS INTEGER) AS half FROM lineitem",
)
def d25(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_quantity") / 4).alias("half"))
    return clean.round_binary(rows, ["half"])


@query(
    "d26_correlation",
    with_ctes(WINDOWS, " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM win" for a in FEATURES for b in FEATURES)),
)
def d26(spark, sf):
    return rounded(clean.correlation(windows(spark, sf), FEATURES), "correlation")


_COMPONENTS = 64


@query(
    "d26_correlation_of_many",
    f"""WITH e AS (SELECT vec_id, CAST(embedding[i] AS DOUBLE) AS x, i - 1 AS i FROM embeddings, unnest(range(1, {_COMPONENTS + 1})) AS t(i)),
    g AS (SELECT * FROM e WHERE x > -0.2)
    SELECT 'x' || a.i AS feature_a, 'x' || b.i AS feature_b, round(corr(a.x, b.x), 6) AS correlation
    FROM g a JOIN g b USING (vec_id) GROUP BY 1, 2""",
)
def d26_of_many(spark, sf):
    # components below -0.2 are the gaps
    x = [F.get("embedding", F.lit(i)).cast("double") for i in range(_COMPONENTS)]
    wide = table(spark, sf, "embeddings").select(*[F.when(c > -0.2, c).alias(f"x{i}") for i, c in enumerate(x)])
    return rounded(clean.correlation_of_many(wide, wide.columns), "correlation")


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "d27_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
 round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max
 FROM lineitem""" for c in _DESCRIBED),
)
def d27(spark, sf):
    return rounded(clean.describe(table(spark, sf, "lineitem"), _DESCRIBED), "mean", "std", "q25", "q50", "q75")


@query(
    "a5_gap_report_csv",
    with_ctes(WINDOWS, " UNION ALL ".join(
        f"SELECT '{f}' AS \"column\", round(avg(CASE WHEN {f} IS NULL THEN 100.0 ELSE 0 END), 6) AS missing_pct FROM win" for f in FEATURES)),
)
def a5(spark, sf):
    """The share of gaps of each feature, written as CSV twice over and read back."""
    path, report = shared_folder(spark), rounded(clean.missing_report(windows(spark, sf), FEATURES), "missing_pct")
    for _ in range(2):
        sinks.write_committed(report, path, "csv", header="true")
    return sinks.read_committed(spark, path, "csv", "column string, missing_pct double", header="true")


@query(
    "a6_metrics_json",
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM events GROUP BY 1""",
)
def a6(spark, sf):
    """Metrics of each event type, written as JSON and read back."""
    path = shared_folder(spark)
    metrics = table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    sinks.write_committed(rounded(metrics, "mean"), path, "json")
    return sinks.read_committed(spark, path, "json", "event_type string, n bigint, mean double, low double, high double")


@query(
    "d28_non_null_cells",
    with_ctes(WINDOWS, f"SELECT CAST(count({V}) + count({TS}) + {' + '.join(f'count({f})' for f in FEATURES)} AS BIGINT) AS cells FROM win"),
)
def d28(spark, sf):
    return clean.non_null_cells(windows(spark, sf))


@query(
    "d29_histogram",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    c AS (SELECT least(CAST(floor((value - lo) * 100 / (hi - lo)) AS BIGINT), 99) AS bin, count(*) AS count FROM events, e GROUP BY 1)
    SELECT bin, round(lo + (hi - lo) / 100 * bin, 6) AS bin_start, round(lo + (hi - lo) / 100 * (bin + 1), 6) AS bin_end,
    coalesce(count, 0) AS count FROM (SELECT unnest(range(100)) AS bin) LEFT JOIN c USING (bin), e""",
)
def d29(spark, sf):
    return rounded(clean.histogram(table(spark, sf, "events"), "value"), "bin_start", "bin_end")


# --- end to end -------------------------------------------------------------------------

_CUT_WINDOWS = {
    "cut": _CUT,
    "cb": _feature_averages("cut", 12),
    "cg": _grid(12, "cb", V),
    "win2": f"SELECT {V}, {TS}, {', '.join(FEATURES)} FROM cg LEFT JOIN cb USING ({V}, {TS})",
}
_FLAG_STEPS = _CUT_WINDOWS | {"p": _POSITIONS.replace("FROM win", "FROM win2"), "g": _GAPS} | _fill_steps("win2") | {
    "ff": f"SELECT {V}, {TS}, {_FILLED} FROM fc"
}


@query("d_flagship_cut_window_fill", with_ctes(("long",), f"SELECT {V}, {TS}, {_ROUND_FEATURES} FROM ff", **_FLAG_STEPS))
def flagship(spark, sf):
    """Outlier cut, gap-filled windows, limited forward fill."""
    kept = clean.drop_outliers_long(long_events(spark, sf), FEATURES)
    rows = reshape.windowed_means(reshape.to_wide(kept, FEATURES), FEATURES)
    # the gap statistics and the fill both read the windows
    return rounded(impute.forward_fill(cut_lineage(rows), FEATURES), *FEATURES)


_CLINICAL_CELLS = ", ".join(f"avg(v) FILTER (WHERE feature_name = '{f}') AS {f}" for f in CLINICAL_FEATURES)


@query(
    "d_clinical_windows_of_shock_cohort",
    with_ctes(CLINICAL, f"SELECT g.{V}, g.{TS}, {round_sql(*CLINICAL_FEATURES)} FROM g LEFT JOIN b USING ({V}, {TS})",
    **_COHORT_STEPS, mu=_MEASURED,
    named="""SELECT mu.*, d.feature_name FROM mu LEFT JOIN dictionary d ON mu.measurement_concept_id = d.concept_id
 WHERE visit_occurrence_id IN (SELECT visit_occurrence_id FROM cohort WHERE septic_shock)""",
    instants=f"SELECT {V}, {TS}, feature_name, avg(value_as_number) AS v FROM named GROUP BY ALL",
    b=f"SELECT {V}, time_bucket(INTERVAL '12 hours', {TS}) AS {TS}, {_CLINICAL_CELLS} FROM instants GROUP BY 1, 2",
    g=_grid(12, "b", V)),
)
def clinical_windows(spark, sf):
    """Cohort, measurements, features, pivot, windows in one plan."""
    t = clinical(spark, sf)
    shock = cut_lineage(cohort_of(narrowed(t)).where("septic_shock").select(V))
    rows = restrict_to(measured(spark, sf, t), shock, V)
    named = attach_feature(rows, dictionary(spark)).select(V, TS, "feature_name", "value_as_number")
    out = reshape.windowed_means(reshape.to_wide(named, CLINICAL_FEATURES), CLINICAL_FEATURES)
    return rounded(out, *CLINICAL_FEATURES)
