"""Queries for actions, trajectories, states, decision model, evaluation (E, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuriver.functions import concepts as C
from icuriver.operators import actions, clean, lloyd, mdp, ope, policy_run, reshape, states, timejoin, trajectory
from icuriver.plans.catalog_clean import _FILLED, _GAPS, _POSITIONS, _PRESENT, _fill_steps, windows
from icuriver.plans.catalog_cohort import DOSES_ALL, doses
from icuriver.plans.registry import query, round_sql, rounded
from icuriver.session import cut_lineage
from icuriver.plans.views import CLINICAL, CTE, DECISIONS, FEATURES, WINDOWS, clinical, decision_steps, table, with_ctes

V, TS = "visit_occurrence_id", "measurement_datetime"

# --- E: actions -------------------------------------------------------------------------

_EQUIV = f"""SELECT *, gamma * CASE WHEN contains(lower(item), 'epinephrine') THEN 1.0::DOUBLE WHEN contains(lower(item), 'norepinephrine') THEN 1.0::DOUBLE
 WHEN contains(lower(item), 'dopamine') THEN 0.01::DOUBLE WHEN contains(lower(item), 'dobutamine') THEN 0.01::DOUBLE END AS equiv_gamma FROM d"""
_EQUIV_STEPS = {"d": DOSES_ALL, "eq": _EQUIV}


def equivalents(spark, sf):
    return actions.equivalent_dose(doses(clinical(spark, sf), first_day=False, absolute=True))


@query(
    "e1_equivalent_dose",
    with_ctes(CLINICAL, f"SELECT {V}, item, start_datetime, {round_sql('gamma', 'equiv_gamma')} FROM eq", **_EQUIV_STEPS),
)
def e1(spark, sf):
    return rounded(equivalents(spark, sf).select(V, "item", "start_datetime", "gamma", "equiv_gamma"), "gamma", "equiv_gamma")


@query(
    "e2_mean_dose_per_drug",
    with_ctes(CLINICAL, "SELECT item, round(avg(equiv_gamma), 6) AS mean_dose FROM eq GROUP BY 1", **_EQUIV_STEPS),
)
def e2(spark, sf):
    return rounded(actions.mean_dose(equivalents(spark, sf)), "mean_dose")


@query(
    "e3_dose_bands",
    """WITH b AS (SELECT l_tax + l_discount * 4 AS x FROM lineitem), n AS (SELECT CASE WHEN x > 0.45 THEN '>0.45' WHEN x > 0.22 THEN ']0.22-0.45]'
    WHEN x > 0.08 THEN ']0.08-0.22]' WHEN x > 0 THEN ']0-0.08]' END AS band, x, count(*) AS n FROM b GROUP BY 1, 2),
    m AS (SELECT band, avg(x) AS mode_dose FROM (SELECT *, rank() OVER (PARTITION BY band ORDER BY n DESC) AS r FROM n) WHERE r = 1 GROUP BY 1)
    SELECT band, round(sum(x * n) / sum(n), 6) AS mean_dose, round(any_value(mode_dose), 6) AS mode_dose,
    round(sum(n) * 1.0::DOUBLE / (SELECT count(*) FROM b), 6) AS share FROM n JOIN m USING (band) GROUP BY band""",
)
def e3(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_tax") + F.col("l_discount") * 4).alias("equiv_gamma"))
    return rounded(actions.dose_bands(rows), "mean_dose", "mode_dose", "share")


_INFUSIONS = f"""SELECT user_id AS {V}, ts AS start_datetime, ts + to_microseconds(CAST(floor(value * 60000000) AS BIGINT)) AS stop_datetime,
 value / 100 AS equiv_gamma FROM events WHERE event_type = 'purchase'"""
_OVERLAP = f"""SELECT w.{V}, w.{TS}, coalesce(sum(equiv_gamma * h) / nullif(sum(h), 0), 0) AS average_gamma FROM
 (SELECT w.{V}, w.{TS}, i.equiv_gamma, date_sub('microsecond', greatest(i.start_datetime, w.{TS}), least(i.stop_datetime, w.{TS} + INTERVAL 12 HOUR)) / 3600000000.0::DOUBLE AS h
 FROM win w LEFT JOIN inf i ON w.{V} = i.{V} AND i.start_datetime < w.{TS} + INTERVAL 12 HOUR AND i.stop_datetime > w.{TS}) w GROUP BY 1, 2"""
_FLUID_SUM = f"""SELECT w.{V}, w.{TS}, coalesce(sum(e.value), 0) AS fluid_intake_sum FROM win w LEFT JOIN events e
 ON w.{V} = e.user_id AND e.event_type = 'view' AND e.ts >= w.{TS} AND e.ts <= w.{TS} + INTERVAL 12 HOUR GROUP BY 1, 2"""


def infusions(spark, sf):
    """Purchases as infusions that run for as many minutes as their value."""
    return table(spark, sf, "events").where("event_type = 'purchase'").select(
        F.col("user_id").alias(V),
        F.col("ts").alias("start_datetime"),
        F.timestamp_add("MICROSECOND", F.floor(F.col("value") * 60_000_000), F.col("ts")).alias("stop_datetime"),
        (F.col("value") / 100).alias("equiv_gamma"),
    )


def fluids(spark, sf):
    return table(spark, sf, "events").where("event_type = 'view'").select(
        F.col("user_id").alias(V), F.col("ts").alias(TS), F.col("value").alias("value_as_number")
    )


@query("e4_interval_overlap_mean", with_ctes(WINDOWS, f"SELECT {V}, {TS}, round(average_gamma, 6) AS average_gamma FROM o", inf=_INFUSIONS, o=_OVERLAP))
def e4(spark, sf):
    grid = windows(spark, sf).select(V, TS)
    return rounded(timejoin.window_overlap_mean(grid, infusions(spark, sf)), "average_gamma")


@query("e5_window_range_sum", with_ctes(WINDOWS, f"SELECT {V}, {TS}, round(fluid_intake_sum, 6) AS fluid_intake_sum FROM f", f=_FLUID_SUM))
def e5(spark, sf):
    grid = windows(spark, sf).select(V, TS)
    return rounded(timejoin.window_range_sum(grid, fluids(spark, sf)), "fluid_intake_sum")


def amounts(spark, sf):
    """Windows with mean dose and fluid sum."""
    grid = windows(spark, sf).select(V, TS)
    dosed = timejoin.window_overlap_mean(grid, infusions(spark, sf))
    return timejoin.window_range_sum(dosed, fluids(spark, sf))


_AMOUNTS = {"inf": _INFUSIONS, "o": _OVERLAP, "f": _FLUID_SUM, "am": f"SELECT * FROM o JOIN f USING ({V}, {TS})"}
_THRESHOLDS = """SELECT quantile_cont(fluid_intake_sum, 0.5) FILTER (WHERE fluid_intake_sum <> 0) AS fluid,
 quantile_cont(average_gamma, 0.5) FILTER (WHERE average_gamma <> 0) AS vasopressor FROM am"""
_CODES = f"""SELECT {V}, {TS}, CAST(CASE WHEN fluid_intake_sum > fluid THEN 2 WHEN fluid_intake_sum > 0 THEN 1 ELSE 0 END * 3
 + CASE WHEN average_gamma > vasopressor THEN 2 WHEN average_gamma > 0 THEN 1 ELSE 0 END AS INTEGER) AS action FROM am, th"""


@query("e6_action_thresholds", with_ctes(WINDOWS, f"SELECT {round_sql('fluid', 'vasopressor')} FROM th", **_AMOUNTS, th=_THRESHOLDS))
def e6_thresholds(spark, sf):
    return rounded(actions.action_thresholds(amounts(spark, sf), "fluid_intake_sum", "average_gamma"), "fluid", "vasopressor")


def coded(spark, sf):
    rows = amounts(spark, sf)
    fitted = actions.action_thresholds(rows, "fluid_intake_sum", "average_gamma")
    return actions.assign_actions(rows, fitted, "fluid_intake_sum", "average_gamma")


@query("e6_discrete_actions", with_ctes(WINDOWS, _CODES, **_AMOUNTS, th=_THRESHOLDS))
def e6(spark, sf):
    return coded(spark, sf).select(V, TS, "action")


@query(
    "e7_stored_thresholds",
    """SELECT l_orderkey, l_partkey, CAST(CASE WHEN l_quantity > 30 THEN 2 WHEN l_quantity > 0 THEN 1 ELSE 0 END * 3
    + CASE WHEN l_discount > 0.05 THEN 2 WHEN l_discount > 0 THEN 1 ELSE 0 END AS INTEGER) AS action FROM lineitem""",
)
def e7(spark, sf):
    stored = spark.range(1).select(F.lit(30.0).alias("fluid"), F.lit(0.05).alias("vasopressor"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount")
    return actions.assign_actions(rows, stored, "l_quantity", "l_discount").select("l_orderkey", "l_partkey", "action")


@query(
    "e8_action_grid",
    with_ctes(WINDOWS, """SELECT CAST(floor(a / 3) AS INTEGER) AS fluid, CAST(a % 3 AS INTEGER) AS vasopressor, count(action) AS count,
    round(count(action) * 1.0::DOUBLE / sum(count(action)) OVER (), 6) AS share
    FROM (SELECT unnest(range(9)) AS a) LEFT JOIN cd ON a = action GROUP BY a""", **_AMOUNTS, th=_THRESHOLDS, cd=_CODES),
)
def e8(spark, sf):
    return rounded(actions.action_grid(coded(spark, sf)), "share")


@query(
    "e9_outcome_share",
    with_ctes(("steps",), "SELECT died_in_hospital, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percentage FROM steps GROUP BY 1"),
)
def e9(spark, sf):
    return rounded(actions.outcome_share(decision_steps(spark, sf)), "percentage")


# --- E: trajectories --------------------------------------------------------------------


def numbered_steps(spark, sf):
    return reshape.sequence_numbers(decision_steps(spark, sf), order=("ts", "event_id"), start=1)


def rewarded_steps(spark, sf):
    return trajectory.terminal_reward(numbered_steps(spark, sf), order=("seq_id",))


def logged_transitions(spark, sf):
    return trajectory.decision_transitions(decision_steps(spark, sf), order=("ts", "event_id"))


def steps_and_policy(spark, sf):
    """Logged steps and the policy seen in them, both materialised."""
    steps = mdp.cut_lineage(logged_transitions(spark, sf))
    return steps, mdp.cut_lineage(mdp.observed_policy(steps))


@query("e10_terminal_reward", with_ctes(("steps", "rewarded"), f"SELECT {V}, seq_id, state, action, died_in_hospital, reward FROM rewarded"))
def e10(spark, sf):
    return rewarded_steps(spark, sf).select(V, "seq_id", "state", "action", "died_in_hospital", "reward")


@query("e11_transitions", with_ctes(DECISIONS, "SELECT * FROM transitions"))
def e11(spark, sf):
    return trajectory.transitions(rewarded_steps(spark, sf))


@query("e11_transitions_one_scan", with_ctes(DECISIONS, "SELECT * FROM transitions"))
def e11_one_scan(spark, sf):
    return logged_transitions(spark, sf)


@query(
    "e11_transitions_open_end",
    with_ctes(DECISIONS, f"SELECT {V}, seq_id, state, action, reward, nullif(next_state, -1) AS next_state, done FROM transitions"),
)
def e11_open(spark, sf):
    return trajectory.transitions(rewarded_steps(spark, sf), terminal=None)


@query("e12_longest_trajectory", with_ctes(DECISIONS, f"SELECT max(n) AS longest FROM (SELECT count(*) AS n FROM steps GROUP BY {V})"))
def e12(spark, sf):
    return trajectory.longest_trajectory(decision_steps(spark, sf))


@query(
    "e12_longest_by_done",
    with_ctes(DECISIONS, f"""SELECT max(n) AS longest FROM (SELECT count(*) AS n FROM
    (SELECT sum(done) OVER (ORDER BY {V}, seq_id ROWS UNBOUNDED PRECEDING) AS id FROM transitions) GROUP BY id)"""),
)
def e12_literal(spark, sf):
    return trajectory.longest_by_done(decision_steps(spark, sf))


_PADDED = f"""SELECT {V}, seq_id, state, action, reward, next_state, done FROM transitions UNION ALL
 SELECT {V}, unnest(range(n + 1, mx + 1)) AS seq_id, 0, 0, NULL, NULL, 1 FROM
 (SELECT {V}, count(*) AS n, max(count(*)) OVER () AS mx FROM steps GROUP BY 1)"""


@query("e13_padded_trajectories", with_ctes(DECISIONS, "SELECT * FROM padded", padded=_PADDED))
def e13(spark, sf):
    return trajectory.pad_trajectories(logged_transitions(spark, sf))


@query(
    "e14_behaviour_probability",
    with_ctes(DECISIONS, f"""SELECT {V}, seq_id, state, action, round(coalesce(probability, 0), 6) AS pscore
    FROM padded LEFT JOIN policy USING (state, action)""", padded=_PADDED),
)
def e14(spark, sf):
    steps, observed = steps_and_policy(spark, sf)
    out = trajectory.behaviour_probability(trajectory.pad_trajectories(steps), observed)
    return rounded(out.select(V, "seq_id", "state", "action", "pscore"), "pscore")


@query(
    "e14_behaviour_distribution",
    with_ctes(DECISIONS, f"SELECT {V}, seq_id, t.state, " + ", ".join(
        f"round(coalesce((SELECT probability FROM policy p WHERE p.state = t.state AND p.action = {a}), 0), 6) AS p{a}" for a in range(9)
    ) + " FROM transitions t"),
)
def e14_distribution(spark, sf):
    steps, observed = steps_and_policy(spark, sf)
    out = trajectory.behaviour_distribution(steps, observed)
    return rounded(out.select(V, "seq_id", "state", *[f"p{a}" for a in range(9)]), *[f"p{a}" for a in range(9)])


@query(
    "e15_logged_dataset",
    with_ctes(DECISIONS, f"""SELECT {V}, seq_id, state, action, reward, done, done AS terminal, round(coalesce(probability, 0), 6) AS pscore
    FROM padded LEFT JOIN policy USING (state, action)""", padded=_PADDED),
)
def e15(spark, sf):
    steps, observed = steps_and_policy(spark, sf)
    rows, _ = trajectory.logged_dataset(trajectory.pad_trajectories(steps), observed)
    return rounded(rows, "pscore")


@query(
    "e15_logged_dataset_size",
    with_ctes(DECISIONS, f"""SELECT CAST(count(*) AS BIGINT) AS size, count(DISTINCT {V}) AS n_trajectories,
    CAST(count(*) / count(DISTINCT {V}) AS BIGINT) AS step_per_trajectory, 'discrete' AS action_type, 9 AS n_actions, 1 AS action_dim, 1 AS state_dim
    FROM padded""", padded=_PADDED),
)
def e15_meta(spark, sf):
    steps, observed = steps_and_policy(spark, sf)
    return trajectory.logged_dataset(trajectory.pad_trajectories(steps), observed)[1]


# --- F: states --------------------------------------------------------------------------

_DIM = 64
_VECTORS = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"


def _centres_sql(k):
    return f"""SELECT CAST(state AS INTEGER) AS state, list(m ORDER BY i) AS c FROM (SELECT label % {k} AS state, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
    FROM embeddings, range(1, {_DIM + 1}) place(i) GROUP BY ALL) GROUP BY state"""


def label_centres(spark, sf, k):
    """Means of all vectors by label modulo k as fixed centres: the fitted part is given, the apply step is checked."""
    names = [f"x{i}" for i in range(_DIM)]
    rows = wide_vectors(spark, sf).withColumn("state", (F.col("label") % k).cast("int"))
    return states.cluster_means(rows, names).select("state", F.array(*names).alias("centre"))


_NEAREST = "SELECT vec_id, arg_min(state, (d, state)) AS state, min(d) AS d FROM (SELECT vec_id, state, list_distance(x, c) AS d FROM vecs, cen) GROUP BY 1"


def wide_vectors(spark, sf, dims=_DIM):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(dims)]
    )


# clusters of the states, and the counts that are tried
_STATES, _SIZES = 400, states.CLUSTER_SIZES


_KEYED = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) AS place FROM embeddings"


def _lloyd_steps(sizes, vectors=_KEYED, dims=_DIM):
    """Rounds from the rows of smallest md5, for all sizes at once, until no centre moves; ``fit`` has the last centres."""
    return {
        "vecs": vectors,
        "tol": f"SELECT {lloyd.TOLERANCE}::DOUBLE * avg(v) AS t FROM (SELECT i, var_pop(x[i]) AS v FROM vecs, range(1, {dims + 1}) p(i) GROUP BY i)",
        "lloyd": f"""SELECT 0 AS round, k, CAST(place - 1 AS INTEGER) AS state, x AS c, CAST('infinity' AS DOUBLE) AS shift
 FROM vecs JOIN (SELECT unnest({list(sizes)}) AS k) ON place <= k AND k <= (SELECT count(*) FROM vecs)
 UNION ALL SELECT round + 1, k, state, c, sum(moved) OVER (PARTITION BY k) FROM (
  SELECT l.round, l.k, l.state, coalesce(m.c, l.c) AS c, pow(list_distance(coalesce(m.c, l.c), l.c), 2) AS moved FROM lloyd l LEFT JOIN (
   SELECT k, state, list(v ORDER BY i) AS c FROM (SELECT k, state, i, avg(x[i]) AS v FROM (
    SELECT l.k, v.vec_id, any_value(v.x) AS x, arg_min(l.state, (list_distance(v.x, l.c), l.state)) AS state FROM vecs v, lloyd l WHERE l.shift > (SELECT t FROM tol) GROUP BY l.k, v.vec_id
   ), range(1, {dims + 1}) p(i) GROUP BY k, state, i) GROUP BY k, state) m ON m.k = l.k AND m.state = l.state
  WHERE l.shift > (SELECT t FROM tol) AND l.round < {lloyd.MAX_ROUNDS})""",
        "fit": "SELECT k, state, c FROM lloyd QUALIFY round = max(round) OVER (PARTITION BY k)",
        "near": "SELECT k, vec_id, arg_min(state, (list_distance(x, c), state)) AS state, min(list_distance(x, c)) AS d FROM vecs, fit GROUP BY k, vec_id",
    }


def _lloyd_sql(sizes, body):
    return with_ctes((), body, **_lloyd_steps(sizes))


@query("f1_kmeans_states", _lloyd_sql([_STATES], "SELECT vec_id, state FROM near"))
def f1(spark, sf):
    rows = cut_lineage(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    return states.assign_nearest(rows, lloyd.fit_states(rows, "embedding", "vec_id", _STATES), "embedding").select("vec_id", "state")


@query("f2_assign_nearest_centre", with_ctes((), "SELECT vec_id, state FROM near", vecs=_VECTORS, cen=_centres_sql(10), near=_NEAREST))
def f2(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return states.assign_nearest(rows, label_centres(spark, sf, 10), "embedding").select("vec_id", "state")


@query(
    "f3_cluster_count_sweep",
    _lloyd_sql(_SIZES, f"""SELECT CAST(k AS INTEGER) AS cluster_size, round((k * {_DIM} + k) * ln(n) + wss, 6) AS bic, round(2 * (k * {_DIM} + k) + wss, 6) AS aic, round(wss, 6) AS wss
 FROM (SELECT k, sum(d * d) AS wss, count(*) AS n FROM near GROUP BY k)"""),
)
def f3(spark, sf):
    return rounded(lloyd.sweep_sizes(table(spark, sf, "embeddings"), "embedding", "vec_id", _SIZES), "bic", "aic", "wss")


_SWEEP = " UNION ALL ".join(f"SELECT {k} AS k, * FROM ({_centres_sql(k)})" for k in (2, 5, 10, 20))


@query(
    "f3_information_criteria_fixed_centres",
    with_ctes((), f"""SELECT k AS cluster_size, round((k * {_DIM} + k) * ln(n) + wss, 6) AS bic, round(2 * (k * {_DIM} + k) + wss, 6) AS aic, round(wss, 6) AS wss
    FROM (SELECT k, sum(d * d) AS wss, count(*) AS n FROM (SELECT vec_id, k, min(list_distance(x, c)) AS d FROM vecs, sweep GROUP BY 1, 2) GROUP BY 1)""",
    vecs=_VECTORS, sweep=_SWEEP),
)
def f3_fixed(spark, sf):
    rows = table(spark, sf, "embeddings").select("embedding")
    costs = None
    for k in (2, 5, 10, 20):
        one = states.within_squares(rows, label_centres(spark, sf, k), "embedding").withColumn("cluster_size", F.lit(k))
        costs = one if costs is None else costs.unionByName(one)
    n = rows.agg(F.count(F.lit(1))).scalar()
    return rounded(states.information_criteria(costs, _DIM, n), "bic", "aic", "wss")


@query(
    "f4_cluster_means",
    "SELECT label, " + ", ".join(f"round(avg(embedding[{i + 1}]::DOUBLE), 6) AS x{i}" for i in range(_DIM)) + ", count(*) AS size FROM embeddings GROUP BY label",
)
def f4(spark, sf):
    names = [f"x{i}" for i in range(_DIM)]
    return rounded(states.cluster_means(wide_vectors(spark, sf), names, "label"), *names)


_POWERS = 1500


def _component(n):
    """Largest eigenvector of the centred centres' products by powers, and the products without it."""
    return {
        f"p{n}": f"""SELECT 0 AS round, list_transform(range(1, len(m) + 1), lambda i: sin(i)) AS u FROM m{n}
 UNION ALL SELECT round + 1, list_transform(w, lambda a: a / sqrt(list_inner_product(w, w))) FROM (SELECT round, list_transform(m, lambda r: list_inner_product(r, u)) AS w FROM p{n}, m{n} WHERE round < {_POWERS})""",
        f"e{n}": f"SELECT u, list_inner_product(u, list_transform(m, lambda r: list_inner_product(r, u))) AS l FROM p{n}, m{n} WHERE round = {_POWERS}",
        f"m{n + 1}": f"SELECT list_transform(m, lambda r, i: list_transform(r, lambda a, j: a - l * u[i] * u[j])) AS m FROM m{n}, e{n}",
        f"s{n}": f"""SELECT arg_max(sign(w), abs(w)) AS s FROM (SELECT i, sum(x[i] * u[place]) AS w FROM cen, e{n}, range(1, {_DIM + 1}) p(i) GROUP BY i)""",
    }


_CENTRED = {
    "mean": f"SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v, count(*) AS size FROM embeddings, range(1, {_DIM + 1}) p(i) GROUP BY label, i",
    "cen": "SELECT label, size, x, row_number() OVER (ORDER BY label) AS place FROM (SELECT label, any_value(size) AS size, list(c ORDER BY i) AS x FROM (SELECT *, v - avg(v) OVER (PARTITION BY i) AS c FROM mean) GROUP BY label)",
    "m1": "SELECT list(r ORDER BY place) AS m FROM (SELECT a.place, list(list_inner_product(a.x, b.x) ORDER BY b.place) AS r FROM cen a, cen b GROUP BY a.place)",
}


@query(
    "f5_principal_components",
    with_ctes((), "SELECT label, size, " + ", ".join(f"round(s{n}.s * sqrt(e{n}.l) * e{n}.u[place], 6) AS pca_{n}" for n in (1, 2, 3)) + " FROM cen, e1, s1, e2, s2, e3, s3",
              **_CENTRED, **_component(1), **_component(2), **_component(3)),
)
def f5(spark, sf):
    names = [f"x{i}" for i in range(_DIM)]
    centres = states.cluster_means(wide_vectors(spark, sf), names, "label")
    return rounded(states.principal_components(centres, names, 3, keep=["label", "size"]), "pca_1", "pca_2", "pca_3")


@query(
    "f6_labeling_agreement",
    with_ctes((), """SELECT round(mi / ((ha + hb) / 2), 6) AS nmi, round((pij - pa * pb / pt) / ((pa + pb) / 2 - pa * pb / pt), 6) AS ari FROM
    (SELECT sum(n / t * ln(n * t / (ra * cb))) AS mi, sum(n * (n - 1) / 2) AS pij, any_value(t * (t - 1) / 2) AS pt FROM ct),
    (SELECT -sum(ra / t * ln(ra / t)) AS ha, sum(ra * (ra - 1) / 2) AS pa FROM (SELECT DISTINCT label, ra, t FROM ct)),
    (SELECT -sum(cb / t * ln(cb / t)) AS hb, sum(cb * (cb - 1) / 2) AS pb FROM (SELECT DISTINCT state, cb, t FROM ct))""",
    vecs=_VECTORS, cen=_centres_sql(10), near=_NEAREST,
    ct="""SELECT label, state, n::DOUBLE AS n, (sum(n) OVER (PARTITION BY label))::DOUBLE AS ra, (sum(n) OVER (PARTITION BY state))::DOUBLE AS cb, (sum(n) OVER ())::DOUBLE AS t
    FROM (SELECT label, state, count(*) AS n FROM near JOIN vecs USING (vec_id) GROUP BY 1, 2)"""),
)
def f6(spark, sf):
    rows = table(spark, sf, "embeddings").select("label", "embedding")
    both = states.assign_nearest(rows, label_centres(spark, sf, 10), "embedding")
    return rounded(states.labeling_agreement(both, "label", "state"), "nmi", "ari")


@query(
    "f7_soft_assignment",
    with_ctes((), """SELECT vec_id, CAST(state AS INTEGER) AS state, round(exp(-2.0::DOUBLE * (d - dm)) / (sum(exp(-2.0::DOUBLE * (d - dm))) OVER (PARTITION BY vec_id) + 1e-8::DOUBLE), 6) AS weight
    FROM (SELECT vec_id, state, d, min(d) OVER (PARTITION BY vec_id) AS dm FROM (SELECT vec_id, state, list_distance(x, c) AS d FROM vecs, cen))""",
    vecs=_VECTORS, cen=_centres_sql(10)),
)
def f7(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    out = states.soft_assignment(rows, label_centres(spark, sf, 10), "embedding", alpha=2.0)
    return rounded(out.select("vec_id", F.posexplode("weights").alias("state", "weight")), "weight")


@query(
    "f8_clustering_loss",
    with_ctes((), """SELECT round(r + 0.5::DOUBLE * c, 6) AS loss, round(r, 6) AS loss_reconstruction, round(c, 6) AS loss_clustering FROM
    (SELECT avg(s) AS c FROM (SELECT vec_id, sum(d * exp(-d)) / (sum(exp(-d)) + 1e-8::DOUBLE) AS s FROM (SELECT vec_id, list_distance(x, c) AS d FROM vecs, cen) GROUP BY 1)),
    (SELECT avg(e) AS r FROM (SELECT list_sum(list_transform(x, lambda v: (v - round(v, 1)) * (v - round(v, 1)))) / 64 AS e FROM vecs))""",
    vecs=_VECTORS, cen=_centres_sql(10)),
)
def f8(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("x"))
    rebuilt = rows.withColumn("y", F.transform("x", lambda v: F.round(v, 1)))
    out = states.clustering_loss(rebuilt, label_centres(spark, sf, 10), "x", original="x", rebuilt="y", weight=0.5)
    return rounded(out, "loss", "loss_reconstruction", "loss_clustering")


@query("f9_embed_and_cluster")
def f9(spark, sf):
    rows = states.few_parts(wide_vectors(spark, sf)).cache()
    embedded, centres = states.embed_and_cluster(rows, [f"x{i}" for i in range(_DIM)], dims=8, k=_STATES, keep=["vec_id"])
    return embedded.select("vec_id", "embedding", "state")


_TRIALS = """SELECT l_orderkey * 10 + l_linenumber AS number, l_extendedprice / l_quantity AS value, l_returnflag, l_linestatus, l_linenumber FROM lineitem"""


def trials(spark, sf):
    """Order lines as trials: unit price is the value, flags are the parameters."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("number"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("value"), "l_returnflag", "l_linestatus", "l_linenumber",
    )


@query("f10_best_trial", with_ctes((), "SELECT number, round(value, 6) AS value FROM t ORDER BY t.value, number LIMIT 1", t=_TRIALS))
def f10(spark, sf):
    return rounded(states.best_trial(trials(spark, sf)).select("number", "value"), "value")


@query(
    "f10_trial_leaderboard",
    with_ctes((), " UNION ALL ".join(
        f"SELECT '{p}' AS parameter, CAST({p} AS VARCHAR) AS setting, round(min(value), 6) AS best, round(avg(value), 6) AS mean, count(value) AS trials FROM t GROUP BY {p}"
        for p in ("l_returnflag", "l_linestatus", "l_linenumber")), t=_TRIALS),
)
def f10_board(spark, sf):
    board = states.trial_leaderboard(trials(spark, sf), ["l_returnflag", "l_linestatus", "l_linenumber"])
    return rounded(board, "best", "mean")


# --- G ----------------------------------------------------------------------------------

_SWEEPS, _RATE, _DISCOUNT, _HORIZON = 100, 0.1, 0.99, 100


def _q_steps(n=_SWEEPS):
    return {
        "qr": f"""SELECT 0 AS round, state, action, r, 0.0::DOUBLE AS q FROM (SELECT DISTINCT state, action, expected_reward AS r FROM mdp)
 UNION ALL SELECT round + 1, q.state, q.action, q.r, q.q + {_RATE}::DOUBLE * (q.r + {_DISCOUNT}::DOUBLE * coalesce(a.e, 0) - q.q) FROM qr q LEFT JOIN (
  SELECT m.state, m.action, sum(probability * v) AS e FROM mdp m JOIN (
   SELECT state, CASE WHEN count(*) < 9 THEN greatest(max(q), 0) ELSE max(q) END AS v FROM qr GROUP BY state) v ON m.next_state = v.state GROUP BY m.state, m.action
  ) a ON a.state = q.state AND a.action = q.action WHERE round < {n}""",
        "qt": f"SELECT state, action, q FROM qr WHERE round = {n}",
    }


_Q = _q_steps()
_DENSE = "SELECT s.state, a.action, coalesce(q, 0) AS q FROM (SELECT DISTINCT state FROM mdp) s CROSS JOIN (SELECT unnest(range(9)) AS action) a LEFT JOIN qt USING (state, action)"
_GREEDY = "SELECT state, CAST(arg_min(action, (-q, action)) AS INTEGER) AS action FROM dense GROUP BY 1"
_GREEDY_STEPS = _Q | {"dense": _DENSE, "greedy": _GREEDY}
_EPSILON = """SELECT g.state, CAST(a.action AS INTEGER) AS action, CASE WHEN g.action = a.action THEN 0.7::DOUBLE ELSE 0 END + 0.3::DOUBLE / 9 AS probability
 FROM greedy g CROSS JOIN (SELECT unnest(range(9)) AS action) a"""


def model(spark, sf):
    return mdp.empirical_mdp(logged_transitions(spark, sf))


def learned(spark, sf, steps=None):
    """Model, Q-table and greedy policy, each materialised once."""
    m = mdp.cut_lineage(model(spark, sf) if steps is None else mdp.empirical_mdp(steps))
    q = mdp.cut_lineage(mdp.q_values(m, sweeps=_SWEEPS, rate=_RATE, discount=_DISCOUNT, cut_input=False))
    return m, q, mdp.greedy_policy(q, m)


_MDP_ROUND = "state, action, next_state, count, CAST(total_count AS BIGINT) AS total_count"


@query("g1_transition_probabilities", with_ctes(DECISIONS, f"SELECT {_MDP_ROUND}, round(probability, 6) AS probability FROM mdp"))
def g1(spark, sf):
    return rounded(mdp.transition_probabilities(logged_transitions(spark, sf)), "probability")


@query(
    "g1_transition_probabilities_open_end",
    with_ctes(DECISIONS, f"SELECT {_MDP_ROUND}, round(probability, 6) AS probability FROM mdp WHERE next_state <> -1"),
)
def g1_open(spark, sf):
    steps = trajectory.transitions(rewarded_steps(spark, sf), terminal=None)
    return rounded(mdp.transition_probabilities(steps), "probability")


@query(
    "g2_expected_reward",
    with_ctes(DECISIONS, "SELECT state, action, round(avg(reward), 6) AS expected_reward FROM transitions GROUP BY 1, 2"),
)
def g2(spark, sf):
    return rounded(mdp.expected_reward(logged_transitions(spark, sf)), "expected_reward")


@query("g3_empirical_mdp", with_ctes(DECISIONS, f"SELECT {_MDP_ROUND}, {round_sql('probability', 'expected_reward')} FROM mdp"))
def g3(spark, sf):
    return rounded(model(spark, sf), "probability", "expected_reward")


@query(
    "g4_observed_policy",
    with_ctes(DECISIONS, "SELECT state, action, count, CAST(total_count AS BIGINT) AS total_count, round(probability, 6) AS probability FROM policy"),
)
def g4(spark, sf):
    return rounded(mdp.observed_policy(logged_transitions(spark, sf)), "probability")


@query("g5_q_values", with_ctes(DECISIONS, "SELECT state, action, round(q, 6) AS q FROM qt", **_Q))
def g5(spark, sf):
    return rounded(mdp.q_values(model(spark, sf), sweeps=_SWEEPS, rate=_RATE, discount=_DISCOUNT), "q")


@query("g6_greedy_policy", with_ctes(DECISIONS, "SELECT * FROM greedy", **_GREEDY_STEPS))
def g6(spark, sf):
    return learned(spark, sf)[2]


@query(
    "g7_best_action_on_steps",
    with_ctes(DECISIONS, f"SELECT {V}, seq_id, t.state, t.action, g.action AS best_action FROM transitions t LEFT JOIN greedy g USING (state)", **_GREEDY_STEPS),
)
def g7(spark, sf):
    out = mdp.attach_best_action(logged_transitions(spark, sf), learned(spark, sf)[2])
    return out.select(V, "seq_id", "state", "action", "best_action")


@query(
    "g7_action_frequencies",
    with_ctes(DECISIONS, " UNION ALL ".join(
        f"SELECT '{c}' AS policy, a AS action, (SELECT count(*) FROM bt WHERE bt.{c} = a) AS count FROM (SELECT unnest(range(9)) AS a)" for c in ("action", "best_action")),
    **_GREEDY_STEPS, bt="SELECT t.action, g.action AS best_action FROM transitions t LEFT JOIN greedy g USING (state)"),
)
def g7_frequencies(spark, sf):
    out = mdp.attach_best_action(logged_transitions(spark, sf), learned(spark, sf)[2])
    return mdp.action_frequencies(out, ["action", "best_action"])


def _value_steps(policy):
    return {
        "mv": f"SELECT m.*, p.pi FROM mdp m JOIN ({policy}) p USING (state, action)",
        "ur": f"""SELECT 0 AS round, state, 0.0::DOUBLE AS m1, 0.0::DOUBLE AS m2 FROM (SELECT DISTINCT state FROM mdp)
 UNION ALL SELECT c.round + 1, mv.state, sum(pi * probability * (expected_reward + coalesce(u.m1, 0))),
 sum(pi * probability * (pow(expected_reward, 2) + 2 * expected_reward * coalesce(u.m1, 0) + coalesce(u.m2, 0)))
 FROM mv CROSS JOIN (SELECT DISTINCT round FROM ur WHERE round < {_HORIZON}) c LEFT JOIN ur u ON mv.next_state = u.state GROUP BY c.round, mv.state""",
        f"u{_HORIZON}": f"SELECT state, m1, m2 FROM ur WHERE round = {_HORIZON}",
    }


_VALUE_OUT = f"""SELECT round(avg(coalesce(m1, 0)), 6) AS mean_return, round(sqrt(avg(coalesce(m2, 0)) - pow(avg(coalesce(m1, 0)), 2)), 6) AS std_return
 FROM (SELECT DISTINCT state FROM mdp) s LEFT JOIN u{_HORIZON} USING (state)"""


@query(
    "g8_policy_value_greedy",
    with_ctes(DECISIONS, _VALUE_OUT, **_GREEDY_STEPS, **_value_steps("SELECT state, action, 1.0::DOUBLE AS pi FROM greedy")),
)
def g8(spark, sf):
    m, _, greedy = learned(spark, sf)
    return rounded(mdp.policy_value(greedy, m, steps=_HORIZON, cut_input=False), "mean_return", "std_return")


@query("g8_policy_value_observed", with_ctes(DECISIONS, _VALUE_OUT, **_value_steps("SELECT state, action, probability AS pi FROM policy")))
def g8_observed(spark, sf):
    steps = logged_transitions(spark, sf)
    out = mdp.policy_value(mdp.observed_policy(steps), mdp.empirical_mdp(steps), steps=_HORIZON)
    return rounded(out, "mean_return", "std_return")


@query(
    "g9_policy_alignment",
    with_ctes(DECISIONS, """SELECT x.i AS observed_action, y.i AS model_action, count(c.state) AS count,
    round(coalesce(count(c.state) * 1.0::DOUBLE / nullif(sum(count(c.state)) OVER (PARTITION BY x.i), 0), 0), 6) AS share
    FROM (SELECT unnest(range(9)) AS i) x CROSS JOIN (SELECT unnest(range(9)) AS i) y LEFT JOIN
    (SELECT u.state, u.action AS o, g.action AS m FROM (SELECT state, arg_min(action, (-probability, action)) AS action FROM policy GROUP BY 1) u JOIN greedy g USING (state)) c
    ON c.o = x.i AND c.m = y.i GROUP BY 1, 2""", **_GREEDY_STEPS),
)
def g9(spark, sf):
    _, _, greedy = learned(spark, sf)
    return rounded(mdp.alignment_matrix(mdp.observed_policy(logged_transitions(spark, sf)), greedy), "share")


@query(
    "g10_softmax_policy",
    with_ctes(DECISIONS, """SELECT state, CAST(action AS INTEGER) AS action, round(exp(q / 2) / sum(exp(q / 2)) OVER (PARTITION BY state), 6) AS probability FROM dense""", **_GREEDY_STEPS),
)
def g10(spark, sf):
    m, q, _ = learned(spark, sf)
    return rounded(mdp.softmax_policy(q, m, temperature=2.0), "probability")


@query("g11_epsilon_greedy", with_ctes(DECISIONS, "SELECT state, action, round(probability, 6) AS probability FROM eg", **_GREEDY_STEPS, eg=_EPSILON))
def g11(spark, sf):
    return rounded(mdp.epsilon_greedy(learned(spark, sf)[2], 0.3), "probability")


# evaluation: the target policy is epsilon-greedy on the learned Q-table
_OPE_STEPS = _GREEDY_STEPS | {
    "eg": _EPSILON,
    "lg": f"""SELECT t.{V}, t.seq_id - 1 AS t, t.state, t.action, t.reward, p.probability AS b, e.probability AS pi
 FROM transitions t JOIN policy p USING (state, action) JOIN eg e USING (state, action)""",
    "sv": "SELECT state, sum(eg.probability * coalesce(qt.q, 0)) AS v FROM eg LEFT JOIN qt USING (state, action) GROUP BY 1",
    "rn": f"""SELECT lg.*, exp(sum(ln(pi / b)) OVER (PARTITION BY {V} ORDER BY t)) AS w,
 coalesce(exp(sum(ln(pi / b)) OVER (PARTITION BY {V} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS wp FROM lg""",
}
_GAMMA = 0.95


def evaluation(spark, sf):
    # the steps feed the behaviour policy, the model and the estimator
    steps = mdp.cut_lineage(logged_transitions(spark, sf))
    observed = mdp.cut_lineage(mdp.observed_policy(steps))
    logged = trajectory.behaviour_probability(steps, observed).withColumn("t", F.col("seq_id") - 1)
    _, q, greedy = learned(spark, sf, steps)
    return logged, mdp.cut_lineage(mdp.epsilon_greedy(greedy, 0.3)), q


@query(
    "g12_direct_method",
    with_ctes(DECISIONS, "SELECT round(avg(v), 6) AS estimate FROM lg JOIN sv USING (state) WHERE t = 0", **_OPE_STEPS),
)
def g12(spark, sf):
    return rounded(ope.direct_method(*evaluation(spark, sf)), "estimate")


def _estimate(per_visit):
    return with_ctes(DECISIONS, f"SELECT round(avg(s), 4) AS estimate, 0 AS undefined_trajectories FROM ({per_visit})", **_OPE_STEPS)


@query(
    "g13_trajectory_importance_sampling",
    _estimate(f"SELECT exp(sum(ln(pi / b))) * sum(pow({_GAMMA}::DOUBLE, t) * reward) AS s FROM lg GROUP BY {V}"),
)
def g13(spark, sf):
    logged, policy, _ = evaluation(spark, sf)
    return rounded(ope.trajectory_sampling(logged, policy, discount=_GAMMA), "estimate", digits=4)


@query(
    "g14_per_decision_importance_sampling",
    _estimate(f"SELECT sum(pow({_GAMMA}::DOUBLE, t) * w * reward) AS s FROM rn GROUP BY {V}"),
)
def g14(spark, sf):
    logged, policy, _ = evaluation(spark, sf)
    return rounded(ope.per_decision_sampling(logged, policy, discount=_GAMMA), "estimate", digits=4)


@query(
    "g15_doubly_robust",
    _estimate(f"SELECT sum(pow({_GAMMA}::DOUBLE, t) * (w * (reward - coalesce(q, 0)) + wp * v)) AS s FROM rn LEFT JOIN qt USING (state, action) JOIN sv USING (state) GROUP BY {V}"),
)
def g15(spark, sf):
    logged, policy, q = evaluation(spark, sf)
    return rounded(ope.doubly_robust(logged, policy, q, discount=_GAMMA), "estimate", digits=4)


# --- one run, fitted on the training visits, evaluated on the others -----------------------

_SCALED = ", ".join(
    f"coalesce(({f} - (SELECT avg({f}) FROM kept WHERE split = 'train')) / (SELECT coalesce(nullif(stddev_pop({f}), 0), 1) FROM kept WHERE split = 'train'), 0)"
    for f in FEATURES
)
_WINDOW_KEY = f"{V} || ':' || CAST(CAST(epoch({TS}) AS BIGINT) AS VARCHAR)"
_RUN_STEPS = _AMOUNTS | {
    "sp": f"""SELECT {V}, CASE WHEN place <= n - ceil(n * 0.4::DOUBLE) THEN 'train' WHEN place <= n - ceil(ceil(n * 0.4::DOUBLE) * 0.5) THEN 'validation' ELSE 'test' END AS split
 FROM (SELECT {V}, row_number() OVER (ORDER BY md5({V} || ':42'), {V}) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT {V} FROM win))""",
    "p": _POSITIONS.replace("FROM win", f"FROM win SEMI JOIN (SELECT {V} FROM sp WHERE split = 'train') USING ({V})"),
    "g": _GAPS,
} | _fill_steps("win") | {
    "ff": f"SELECT {V}, {TS}, {_FILLED} FROM fc",
    "kept": f"SELECT * FROM ff JOIN sp USING ({V}) WHERE ({_PRESENT}) / 5.0 >= 0.30",
    "scaled": f"SELECT {V}, {TS}, split, {_WINDOW_KEY} AS vec_id, [{_SCALED}] AS x FROM kept",
} | {
    n: q for n, q in _lloyd_steps(
        [_STATES], "SELECT vec_id, x, row_number() OVER (ORDER BY md5(vec_id), vec_id) AS place FROM scaled WHERE split = 'train'", len(FEATURES)
    ).items() if n != "near"
} | {
    "stated": f"SELECT {V}, {TS}, arg_min(state, (list_distance(x, c), state)) AS state FROM scaled, fit GROUP BY ALL",
    "th": _THRESHOLDS.replace("FROM am", f"FROM am JOIN sp USING ({V}) WHERE split = 'train'"),
    "codes": _CODES,
    "steps": f"""SELECT {V}, row_number() OVER (PARTITION BY {V} ORDER BY {TS}) AS seq_id, state, action,
 CASE WHEN {V} % 4 = 0 THEN 1 ELSE 0 END AS died_in_hospital FROM stated JOIN codes USING ({V}, {TS})""",
    "rewarded": CTE["rewarded"],
    "moves": CTE["transitions"],
    "transitions": f"SELECT moves.* FROM moves JOIN sp USING ({V}) WHERE split = 'train'",
    "mdp": CTE["mdp"],
} | _GREEDY_STEPS | {
    "eg": _EPSILON,
    "held": f"SELECT moves.* FROM moves JOIN sp USING ({V}) WHERE split = 'test'",
    "policy": CTE["policy"].replace("FROM transitions", "FROM held"),
    "lg": f"""SELECT {V}, seq_id - 1 AS t, h.state, h.action, reward, coalesce(e.probability, 0) AS pi, nullif(coalesce(e.probability, 0), 0) / p.probability AS ratio
 FROM held h JOIN policy p USING (state, action) LEFT JOIN eg e USING (state, action)""",
    "sv": _OPE_STEPS["sv"],
    "rn": f"""SELECT lg.*, CASE WHEN min(pi) OVER upto > 0 THEN exp(sum(ln(ratio)) OVER upto) ELSE 0 END AS w,
 CASE WHEN t = 0 THEN 1 WHEN min(pi) OVER before > 0 THEN exp(sum(ln(ratio)) OVER before) ELSE 0 END AS wp FROM lg
 WINDOW upto AS (PARTITION BY {V} ORDER BY t), before AS (PARTITION BY {V} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "gains": f"""SELECT {V}, sum(pow({_GAMMA}::DOUBLE, t) * reward) AS observed, any_value(coalesce(v, 0)) FILTER (t = 0) AS direct,
 arg_max(w, t) * sum(pow({_GAMMA}::DOUBLE, t) * reward) AS trajectory, sum(pow({_GAMMA}::DOUBLE, t) * w * reward) AS per_decision,
 sum(pow({_GAMMA}::DOUBLE, t) * (w * (reward - coalesce(q, 0)) + wp * coalesce(v, 0))) AS doubly_robust
 FROM rn LEFT JOIN sv USING (state) LEFT JOIN qt USING (state, action) GROUP BY {V}""",
}
_METHODS = ("observed", "direct", "trajectory", "per_decision", "doubly_robust")


def run_rows(spark, sf):
    """Windows with amounts, features, outcome and a key, fitted on the training visits."""
    rows = windows(spark, sf).join(amounts(spark, sf), [V, TS]).withColumns({
        "died_in_hospital": (F.col(V) % 4 == 0).cast("int"),
        "window_key": F.concat_ws(":", F.col(V).cast("string"), F.unix_seconds(F.col(TS).cast("timestamp")).cast("string")),
    })
    return policy_run.fitted_rows(rows, FEATURES, "window_key", fluids="fluid_intake_sum", vasopressors="average_gamma", clusters=_STATES)


@query(
    "run_states_and_actions",
    with_ctes(WINDOWS, f"SELECT {V}, {TS}, split, state, action FROM stated JOIN codes USING ({V}, {TS}) JOIN sp USING ({V})", **_RUN_STEPS),
)
def run_states(spark, sf):
    return run_rows(spark, sf).select(V, TS, "split", "state", "action")


@query(
    "run_policy_on_test",
    with_ctes(WINDOWS, " UNION ALL ".join(f"SELECT '{m}' AS method, round(avg({m}), 4) AS estimate FROM gains" for m in _METHODS), **_RUN_STEPS),
)
def run_policy(spark, sf):
    rows = cut_lineage(run_rows(spark, sf))
    found = policy_run.evaluated_policy(rows, sweeps=_SWEEPS, rate=_RATE, discount=_DISCOUNT, gamma=_GAMMA)
    return rounded(found, "estimate", digits=4)
