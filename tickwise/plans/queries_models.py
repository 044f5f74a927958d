"""Registered model queries: Spark ML regressors/classifiers, forecasting, decisions.

Fitted-model outputs get a rows-only check (no SQL engine can refit the
models); closed-form pieces (OLS trend, labels of the trend forecast) also
carry an oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import cluster, decide, forecast, metrics, regress, select, study, trees, windows
from tickwise.plans import views as V
from tickwise.plans.catalog import register
from tickwise.plans.queries import AS_OF, company_names, once, rounded
from tickwise.schema import FEATURES
from tickwise.sources.files import assemble

ML_KEYS = ("l_orderkey", "l_linenumber")
ML_FEATURES = V.ML_FEATURES


def _ml_split(t, test_fraction: float = 0.3):
    return regress.hash_split(V.ml(t), ML_KEYS, test_fraction, seed=42)


def _fit_predict(t, algo: str, **params):
    train, test = _ml_split(t)
    model = regress.pipeline(ML_FEATURES, algo, **params).fit(train)
    return model, model.transform(test)


@register("m1_m3_m7_m21_linear_regression")
def m1_m3_m7_m21_linear_regression(t):
    _, pred = _fit_predict(t, "lr")
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS))


@register("m4_gbt_regression")
def m4_gbt_regression(t):
    _, pred = _fit_predict(t, "gbr")
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS))


@register("m5_random_forest_regression")
def m5_random_forest_regression(t):
    _, pred = _fit_predict(t, "rf")
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS))


@register("t3_feature_importances")
def t3_feature_importances(t):
    model, _ = _fit_predict(t, "rf")
    return rounded(regress.importances_frame(t.spark, model.stages[-1], ML_FEATURES))


@register("m6_isotonic_regression")
def m6_isotonic_regression(t):
    _, pred = _fit_predict(t, "ir", featureIndex=0)  # quantity
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS))


@register("m8_m9_m11_cross_validated_params")
def m8_m9_m11_cross_validated_params(t):
    train, _ = _ml_split(t)
    cv = regress.cross_validate(assemble(train, ML_FEATURES), "lr", preset="full", seed=42, parallelism=8)
    return regress.params_frame(t.spark, cv.bestModel)


@register("m12_coefficients")
def m12_coefficients(t):
    model, _ = _fit_predict(t, "lr")
    return rounded(regress.coefficients_frame(t.spark, model.stages[-1], ML_FEATURES))


@register("m13_training_summary")
def m13_training_summary(t):
    model, _ = _fit_predict(t, "lr")
    return rounded(regress.summary_frame(t.spark, model.stages[-1]))


@register("m10_ml_evaluator_metrics")
def m10_ml_evaluator_metrics(t):
    _, pred = _fit_predict(t, "lr")
    return rounded(metrics.regression_metrics(pred))


# Closed forms: one feature, an integer-key split and no regularisation have an exact SQL twin.


def _quantity_model(t, algo: str, **params):
    train, test = regress.modulo_split(V.ml(t), "l_orderkey", 0.3)
    model = regress.pipeline(["quantity"], algo, **params).fit(train)
    return model, train, model.transform(test)


def _ols(t):
    return _quantity_model(t, "lr", regParam=0.0, elasticNetParam=0.0, maxIter=100)


_SPLIT_SQL = """
WITH tr AS (SELECT label, quantity FROM ml WHERE l_orderkey % 100 >= 30),
te AS (SELECT l_orderkey, l_linenumber, label, quantity FROM ml WHERE l_orderkey % 100 < 30),
ols AS (SELECT regr_slope(label, quantity) AS slope, regr_intercept(label, quantity) AS intercept FROM tr),
pred AS (SELECT te.*, intercept + slope * quantity AS prediction FROM te, ols)
"""


@register("m2_m3_m7_m21_ols_predictions", views=("ml",), sql=_SPLIT_SQL + """
SELECT l_orderkey, l_linenumber, round(label, 4) AS label, round(prediction, 2) AS prediction FROM pred
""")
def m2_m3_m7_m21_ols_predictions(t):
    _, _, pred = _ols(t)
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS), prediction=2)


@register("m10_ols_evaluator", views=("ml",), sql=_SPLIT_SQL + """
SELECT 'rmse' AS metric, round(sqrt(avg((prediction - label) ** 2)), 3) AS value FROM pred
UNION ALL SELECT 'mae', round(avg(abs(prediction - label)), 3) FROM pred
UNION ALL SELECT 'r2', round(1 - sum((prediction - label) ** 2) / (var_pop(label) * count(*)), 3) FROM pred
""")
def m10_ols_evaluator(t):
    """Spark's evaluator on the fitted line."""
    _, _, pred = _ols(t)
    scored = once(pred.select("label", "prediction"))
    rows = [(m, float(regress.evaluator(m).evaluate(scored))) for m in ("rmse", "mae", "r2")]
    return rounded(t.spark.createDataFrame(rows, "metric STRING, value DOUBLE"), value=3)


@register("m12_ols_coefficients", views=("ml",), sql=_SPLIT_SQL + """
SELECT 'quantity' AS feature, round(slope, 2) AS coefficient FROM ols
UNION ALL SELECT '(intercept)', round(intercept, 2) FROM ols
""")
def m12_ols_coefficients(t):
    model, _, _ = _ols(t)
    return rounded(regress.coefficients_frame(t.spark, model.stages[-1], ["quantity"]), coefficient=2)


@register("m13_ols_training_summary", views=("ml",), sql=_SPLIT_SQL + """
, fit AS (SELECT label, intercept + slope * quantity AS p FROM tr, ols)
SELECT 'rmse' AS metric, round(sqrt(avg((p - label) ** 2)), 3) AS value FROM fit
UNION ALL SELECT 'r2', round(1 - sum((p - label) ** 2) / (var_pop(label) * count(*)), 3) FROM fit
""")
def m13_ols_training_summary(t):
    model, _, _ = _ols(t)
    return rounded(regress.summary_frame(t.spark, model.stages[-1]).where("metric IN ('rmse', 'r2')"), value=3)


@register("p15_ols_preview", views=("ml",), sql=_SPLIT_SQL + """
SELECT round(prediction, 2) AS prediction, round(label, 4) AS label, quantity FROM pred
ORDER BY l_orderkey, l_linenumber LIMIT 20
""")
def p15_ols_preview(t):
    _, _, pred = _ols(t)
    top = select.preview(pred.orderBy(*ML_KEYS), 20, ("prediction", "label", "features"))
    return rounded(top.select("prediction", "label", F.col("features")[0].alias("quantity")), prediction=2)


@register("m6_isotonic_closed_form", views=("ml",), sql=_SPLIT_SQL + """
, g AS (SELECT quantity AS q, sum(label) AS s, count(*) AS n FROM tr GROUP BY quantity),
blocks AS (SELECT a.q AS lo, b.q AS hi, sum(g.s) / sum(g.n) AS mean
           FROM g a JOIN g b ON a.q <= b.q JOIN g ON g.q BETWEEN a.q AND b.q GROUP BY a.q, b.q),
tails AS (SELECT g.q, lo, min(mean) AS m FROM g JOIN blocks ON lo <= g.q AND hi >= g.q GROUP BY g.q, lo),
iso AS (SELECT q, max(m) AS value FROM tails GROUP BY q)
SELECT l_orderkey, l_linenumber, round(label, 4) AS label, round(iso.value, 2) AS prediction
FROM te JOIN iso ON te.quantity = iso.q
""")
def m6_isotonic_closed_form(t):
    """The isotonic fit at a value is the largest over left ends of the smallest block mean (min-max formula)."""
    _, _, pred = _quantity_model(t, "ir")
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS), prediction=2)


_STUMP_SQL = _SPLIT_SQL + """
, g AS (SELECT quantity AS q, sum(label) AS s, count(*) AS n FROM tr GROUP BY quantity),
cut AS (SELECT a.q, sum(g.s) FILTER (WHERE g.q <= a.q) AS sl, sum(g.n) FILTER (WHERE g.q <= a.q) AS nl,
               sum(g.s) FILTER (WHERE g.q > a.q) AS sr, sum(g.n) FILTER (WHERE g.q > a.q) AS nr
        FROM g a, g GROUP BY a.q),
best AS (SELECT q, sl / nl AS l, sr / nr AS r FROM cut WHERE nr > 0 ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)
SELECT l_orderkey, l_linenumber, round(label, 4) AS label, round(CASE WHEN quantity <= q THEN l ELSE r END, 2) AS prediction
FROM te, best
"""


@register("m4_boosted_stump", views=("ml",), sql=_STUMP_SQL)
def m4_boosted_stump(t):
    """One boosting round of depth 1: the best cut on quantity and the means beside it."""
    _, _, pred = _quantity_model(t, "gbr", maxIter=1, maxDepth=1, maxBins=64)
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS), prediction=2)


@register("m5_forest_stump", views=("ml",), sql=_STUMP_SQL)
def m5_forest_stump(t):
    _, _, pred = _quantity_model(t, "rf", numTrees=1, maxDepth=1, bootstrap=False)
    return rounded(regress.predicted_vs_actual(pred, ML_KEYS), prediction=2)


@register("t3_stump_importance", views=("ml",), sql="""
SELECT 'quantity' AS feature, CAST(1.0 AS DOUBLE) AS importance FROM ml HAVING count(DISTINCT quantity) > 1
""")
def t3_stump_importance(t):
    """A single feature that splits carries all importance."""
    model, _, _ = _quantity_model(t, "rf", numTrees=1, maxDepth=1, bootstrap=False)
    return rounded(regress.importances_frame(t.spark, model.stages[-1], ["quantity"]))


@register("m14_best_regressor_per_company")
def m14_best_regressor_per_company(t):
    px = V.prices(t)
    rows, of = [], regress.per_company(px, ["close", *FEATURES])
    for c in company_names(px):
        for algo in ("lr", "gbr", "ir"):
            res, _ = regress.fit_best(of(c), algo, FEATURES, "close", "small", seed=7, company=c)
            rows.append((res.company, res.algo, res.rmse, res.params))
    return rounded(t.spark.createDataFrame(
        rows, "company STRING, algo STRING, rmse DOUBLE, best_params MAP<STRING, STRING>"))


@register("m15_repeated_experiment")
def m15_repeated_experiment(t):
    px = once(V.prices(t))
    return rounded(regress.experiment(px, company_names(px), ["lr", "ir"], runs=2, features=FEATURES,
                                      preset="small", threads=4))


@register("m8_m9_m11_m15_elastic_net_study")
def m8_m9_m11_m15_elastic_net_study(t):
    """The study's linear part at its size: 25 runs, 120 grid points, 3 folds, every company, one plan."""
    won = study.elastic_net_study(V.prices25(t), "company", FEATURES, "close")
    return rounded(won.select("company", "run", "rmse", "cv_rmse", "n_train", "n_test"))


_RIDGE = study.StudySpec(runs=3, axes={"maxIter": [300], "regParam": [0.1, 0.5, 0.9], "elasticNetParam": [0.0]})

_RIDGE_SQL = """
WITH r AS (SELECT company, open - avg(open) OVER c AS u, volume - avg(volume) OVER c AS v, close - avg(close) OVER c AS y,
           avg(open) OVER c AS mu, avg(volume) OVER c AS mv, avg(close) OVER c AS my, row_number() OVER (PARTITION BY company ORDER BY date) AS id
           FROM prices25 WINDOW c AS (PARTITION BY company)),
d AS (SELECT *, run, (id * 7 + run * 3 + id // 11) % 4 - 1 AS part FROM r, (SELECT unnest(range(3)) AS run)),
g AS (SELECT company, run, part, any_value(mu) AS mu, any_value(mv) AS mv, any_value(my) AS my, count(*)::DOUBLE AS n, sum(u) AS u, sum(v) AS v, sum(y) AS y,
        sum(u * u) AS uu, sum(v * v) AS vv, sum(y * y) AS yy, sum(u * v) AS uv, sum(u * y) AS uy, sum(v * y) AS vy FROM d GROUP BY company, run, part),
sides AS (SELECT f.company, f.run, f.part AS fold, sum(o.n) AS n, sum(o.u) AS u, sum(o.v) AS v, sum(o.y) AS y, sum(o.uu) AS uu, sum(o.vv) AS vv, sum(o.yy) AS yy,
        sum(o.uv) AS uv, sum(o.uy) AS uy, sum(o.vy) AS vy
  FROM g f JOIN g o ON o.company = f.company AND o.run = f.run AND o.part >= 0 AND (f.part = -1 OR o.part <> f.part) GROUP BY f.company, f.run, f.part),
m AS (SELECT *, u / n AS au, v / n AS av, y / n AS ay, uu / n - (u / n) * (u / n) AS cuu, vv / n - (v / n) * (v / n) AS cvv, yy / n - (y / n) * (y / n) AS cyy,
        uv / n - (u / n) * (v / n) AS cuv, uy / n - (u / n) * (y / n) AS cuy, vy / n - (v / n) * (y / n) AS cvy FROM sides),
s AS (SELECT *, CASE WHEN cuu > 1e-14::DOUBLE * uu / n THEN sqrt(cuu) END AS su, CASE WHEN cvv > 1e-14::DOUBLE * vv / n THEN sqrt(cvv) END AS sv,
        CASE WHEN cyy > 1e-14::DOUBLE * yy / n THEN sqrt(cyy) END AS sy FROM m),
p AS (SELECT *, 1 + reg / sy AS d, coalesce(cuv / (su * sv), 0) AS e, coalesce(cuy / (su * sy), 0) AS p1, coalesce(cvy / (sv * sy), 0) AS p2 FROM s, (SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS reg)),
w AS (SELECT company, run, fold, reg, coalesce((p1 * d - p2 * e) / (d * d - e * e) * sy / su, 0) AS b1,
        coalesce((p2 * d - p1 * e) / (d * d - e * e) * sy / sv, 0) AS b2, au, av, ay FROM p),
a AS (SELECT *, ay - b1 * au - b2 * av AS b0 FROM w),
e AS (SELECT a.*, g.mu, g.mv, g.my, sqrt((g.yy + b0 * b0 * g.n + b1 * b1 * g.uu + b2 * b2 * g.vv - 2 * b0 * g.y - 2 * b1 * g.uy - 2 * b2 * g.vy
        + 2 * b0 * b1 * g.u + 2 * b0 * b2 * g.v + 2 * b1 * b2 * g.uv) / g.n) AS rmse
  FROM a JOIN g ON g.company = a.company AND g.run = a.run AND g.part = a.fold),
cv AS (SELECT company, run, reg, avg(rmse) AS cv_rmse FROM e WHERE fold >= 0 GROUP BY company, run, reg),
won AS (SELECT * FROM cv QUALIFY row_number() OVER (PARTITION BY company, run ORDER BY cv_rmse, reg) = 1)
SELECT e.company, CAST(e.run AS INTEGER) AS run, CAST(e.reg AS VARCHAR) AS reg_param, round(cv_rmse, 4) AS cv_rmse, round(rmse, 4) AS rmse, round(b1, 4) AS of_open,
  round(b2, 4) AS of_volume, round(b0 + my - b1 * mu - b2 * mv, 4) AS intercept
FROM e JOIN won ON won.company = e.company AND won.run = e.run AND won.reg = e.reg WHERE fold = -1
"""


@register("m9_m11_m14_ridge_study", views=("prices25",), sql=_RIDGE_SQL)
def m9_m11_m14_ridge_study(t):
    """Cross-validated ridge of every company: the winner's parameter, errors and coefficients."""
    rows = V.prices25(t).select("company", "date", "open", "volume", "close").withColumn(
        "id", F.row_number().over(windows.series_window(order="date")).cast("long"))
    part = lambda run: (F.pmod(F.col("id") * 7 + run * 3 + F.floor(F.col("id") / 11), F.lit(4)) - 1).cast("int")
    won = study.elastic_net_study(rows, "company", ["open", "volume"], "close", _RIDGE, part)
    return rounded(won.select("company", "run", F.col("params")["regParam"].alias("reg_param"), "cv_rmse", "rmse",
                              F.col("coefficients")[0].alias("of_open"), F.col("coefficients")[1].alias("of_volume"), "intercept"))


# ---------------------------------------------------------------------------
# Forecast and decisions


def _history(t, value: str = "close"):
    return select.forecast_input(V.prices(t), value).na.drop()


@register("r1_r6_z1_forecast", bench=True)
def r1_r6_z1_forecast(t):
    fc = forecast.forecast(_history(t), forecast.ForecastSpec(periods=90, interval_width=0.95))
    return rounded(select.stamp_run_date(fc, as_of=AS_OF))


@register("r1_r3_r5_r6_forecast_identities", views=("prices",), sql="""
WITH h AS (SELECT DISTINCT company, date AS ds FROM prices WHERE close IS NOT NULL),
frame AS (SELECT * FROM h UNION ALL
          SELECT company, CAST(unnest(generate_series(last + 1, last + 90, INTERVAL 1 DAY)) AS DATE) AS ds
          FROM (SELECT company, max(ds) AS last FROM h GROUP BY company))
SELECT company, ds, true AS sums, true AS seasons, true AS symmetric, true AS additive FROM frame
""")
def r1_r3_r5_r6_forecast_identities(t):
    """The full model over history and future: what must hold for every row, whatever the fit."""
    fc = forecast.forecast(_history(t), forecast.ForecastSpec(periods=90, interval_width=0.95))
    near = lambda a, b: F.abs(a - b) <= 1e-6 * F.greatest(F.lit(1.0), F.abs(F.col("yhat")))
    c = F.col
    return fc.select(
        "company", "ds",
        near(c("yhat"), c("trend") + c("additive_terms")).alias("sums"),
        near(c("additive_terms"), c("weekly") + c("yearly") + c("daily")).alias("seasons"),
        near(c("yhat_upper") - c("yhat"), c("yhat") - c("yhat_lower")).alias("symmetric"),
        (c("multiplicative_terms") == 0).alias("additive"))


_TREND_ONLY = forecast.ForecastSpec(periods=30, n_changepoints=0, weekly_order=0, yearly_order=0)

_TREND_SQL = """
WITH fi AS (SELECT date AS ds, close AS y, company FROM prices),
fit AS (SELECT company, regr_slope(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS slope,
               regr_intercept(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS intercept FROM fi GROUP BY company),
frame AS (SELECT DISTINCT company, ds FROM fi
          UNION ALL
          SELECT company, CAST(unnest(generate_series(last + 1, last + 30, INTERVAL 1 DAY)) AS DATE) AS ds
          FROM (SELECT company, max(ds) AS last FROM fi GROUP BY company)),
fc AS (SELECT f.company, f.ds, fit.intercept + fit.slope * CAST(f.ds - DATE '1970-01-01' AS DOUBLE) AS yhat
       FROM frame f JOIN fit ON f.company = fit.company)
"""


@register("r2_r4_linear_trend_forecast", views=("prices",), sql=_TREND_SQL + """
SELECT company, ds, round(yhat, 4) AS yhat, round(yhat, 4) AS trend FROM fc
""")
def r2_r4_linear_trend_forecast(t):
    fc = forecast.forecast(_history(t), _TREND_ONLY)
    return rounded(fc.select("company", "ds", "yhat", "trend"))


@register("r7_w1_trend_forecast_labels", views=("prices",), sql=_TREND_SQL + """
SELECT company, ds, CAST(row_number() OVER w AS BIGINT) AS id,
       CASE WHEN yhat - lead(yhat) OVER w IS NULL THEN 0 WHEN yhat < lead(yhat) OVER w THEN 1 ELSE 2 END AS label
FROM fc WINDOW w AS (PARTITION BY company ORDER BY ds)
""")
def r7_w1_trend_forecast_labels(t):
    fc = forecast.forecast(_history(t), _TREND_ONLY)
    lab = windows.label_series(fc.select("company", "ds", "yhat"), "yhat", order="ds", keep_last=True)
    return lab.select("company", "ds", "id", "label")


def _decide(t, kind: str, **kw):
    spec = decide.DecideSpec(classifier=kind, **kw)
    return decide.decide(V.prices(t), "close", forecast.ForecastSpec(periods=90), spec, as_of=AS_OF)


@register("r7_m16_m19_decide_mlp")
def r7_m16_m19_decide_mlp(t):
    return rounded(_decide(t, "mlp"))


@register("m17_decide_random_forest")
def m17_decide_random_forest(t):
    return rounded(_decide(t, "rf"))


@register("m18_decide_decision_tree")
def m18_decide_decision_tree(t):
    return rounded(_decide(t, "dt"))


def _decided_labels(t, kind: str):
    """Held-out rows of the decision run on a closed-form forecast, with their labels."""
    out = decide.decide(V.prices(t), "close", _TREND_ONLY, decide.DecideSpec(classifier=kind), as_of=AS_OF)
    return out.where("prediction IS NOT NULL").select("company", "ds", "id", "label")


_DECIDED_SQL = _TREND_SQL + """, lab AS (
SELECT company, ds, CAST(row_number() OVER w AS BIGINT) AS id, lead(yhat) OVER w AS following,
       CASE WHEN yhat < lead(yhat) OVER w THEN 1 ELSE 2 END AS label
FROM fc WINDOW w AS (PARTITION BY company ORDER BY ds))
SELECT company, ds, id, label FROM lab WHERE following IS NOT NULL AND id % 5 = 0
"""


@register("r7_m16_decided_rows_mlp", views=("prices",), sql=_DECIDED_SQL)
def r7_m16_decided_rows_mlp(t):
    return _decided_labels(t, "mlp")


@register("m17_decided_rows_random_forest", views=("prices",), sql=_DECIDED_SQL)
def m17_decided_rows_random_forest(t):
    return _decided_labels(t, "rf")


@register("m18_decided_rows_decision_tree", views=("prices",), sql=_DECIDED_SQL)
def m18_decided_rows_decision_tree(t):
    return _decided_labels(t, "dt")


def _bar_rows(t):
    """Bars of every company with the label rule on the next close, numbered per company."""
    lab = windows.label_series(V.prices25(t).select("company", "date", "open", "high", "low", "close", "volume"), "close", order="date")
    return lab.withColumn("held_out", decide.held_out(0.2))


_BAR_FEATURES = ("open", "high", "low", "close", "volume")

_BAR_SQL = """
WITH lab AS (SELECT company, date, open, high, low, close, volume, row_number() OVER w AS id,
         CASE WHEN close < lead(close) OVER w THEN 1 ELSE 2 END AS label, lead(close) OVER w AS following
  FROM prices25 WINDOW w AS (PARTITION BY company ORDER BY date)),
rows_ AS (SELECT *, id % 5 = 0 AS held_out FROM lab WHERE following IS NOT NULL),
x AS (SELECT company, date, label, held_out, unnest([0, 1, 2, 3, 4]) AS feature, unnest([open, high, low, close, volume]) AS v FROM rows_),
cut AS (SELECT DISTINCT company, feature, unnest(ts) AS t FROM (
        SELECT company, feature, quantile_disc(v, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS ts FROM x WHERE NOT held_out GROUP BY company, feature)),
side AS (SELECT c.company, c.feature, c.t, count(*) FILTER (WHERE v <= t AND label = 1)::DOUBLE AS l1, count(*) FILTER (WHERE v <= t AND label = 2)::DOUBLE AS l2,
         count(*) FILTER (WHERE v > t AND label = 1)::DOUBLE AS r1, count(*) FILTER (WHERE v > t AND label = 2)::DOUBLE AS r2
  FROM cut c JOIN x ON x.company = c.company AND x.feature = c.feature AND NOT held_out GROUP BY ALL),
worth AS (SELECT *, (l1 * l1 + l2 * l2) / (l1 + l2) + (r1 * r1 + r2 * r2) / (r1 + r2) AS s,
         ((l1 + r1) * (l1 + r1) + (l2 + r2) * (l2 + r2)) / (l1 + l2 + r1 + r2) + 1e-9::DOUBLE * (l1 + l2 + r1 + r2) AS floor_
  FROM side WHERE l1 + l2 > 0 AND r1 + r2 > 0),
best AS (SELECT * FROM worth WHERE s > floor_ QUALIFY row_number() OVER (PARTITION BY company ORDER BY s DESC, feature, t) = 1),
root AS (SELECT company, count(*) FILTER (WHERE label = 1)::DOUBLE AS c1, count(*) FILTER (WHERE label = 2)::DOUBLE AS c2 FROM rows_ WHERE NOT held_out GROUP BY company),
seen AS (SELECT r.company, r.date, r.label,
    CASE WHEN b.t IS NULL THEN c1 WHEN x.v <= b.t THEN l1 ELSE r1 END AS n1, CASE WHEN b.t IS NULL THEN c2 WHEN x.v <= b.t THEN l2 ELSE r2 END AS n2
  FROM rows_ r JOIN root o ON o.company = r.company LEFT JOIN best b ON b.company = r.company
    LEFT JOIN x ON x.company = r.company AND x.date = r.date AND x.feature = b.feature WHERE r.held_out)
"""


def _bars_by_trees(t, spec):
    rows, values = once(_bar_rows(t)), F.array(*[F.col(c).cast("double") for c in _BAR_FEATURES])
    model = trees.fit(rows.where("NOT held_out"), "company", values, "label", "id", spec)
    return trees.score(rows.where("held_out"), model, "company", values, spec)


@register("m18_tree_predictions_depth_1", views=("prices25",), sql=_BAR_SQL + """
SELECT company, date, label, n1, n2, round(n1 / (n1 + n2), 4) AS p_buy, CAST(CASE WHEN n1 >= n2 THEN 1 ELSE 2 END AS DOUBLE) AS prediction FROM seen
""")
def m18_tree_predictions_depth_1(t):
    """The trees of all companies in one plan: class counts, share and prediction of every held-out bar."""
    out = _bars_by_trees(t, trees.TreeSpec(max_depth=1, max_bins=8))
    return rounded(out.select("company", "date", "label", F.col("rawPrediction")[1].alias("n1"), F.col("rawPrediction")[2].alias("n2"),
                              F.col("probability")[1].alias("p_buy"), "prediction"))


@register("m17_m18_bar_forest")
def m17_m18_bar_forest(t):
    out = _bars_by_trees(t, trees.TreeSpec(num_trees=20, max_depth=5, max_bins=16))
    return rounded(out.select("company", "date", "label", "prediction", F.col("probability")[1].alias("p_buy")))


@register("m20_decision_quality")
def m20_decision_quality(t):
    scored = _decide(t, "rf").select("label", F.col("prediction").cast("int").alias("prediction"))
    return rounded(metrics.classification_report(scored, [0, 1, 2]))


# ---------------------------------------------------------------------------
# M22 clustering



@register("m22_company_features", views=("prices25",), sql="""
SELECT company, round(avg(changeOverTime), 4) AS mean_return, round(stddev_samp(changeOverTime), 4) AS volatility,
       round(avg(volume), 4) AS avg_volume, round(avg(close), 4) AS mean_close
FROM prices25 GROUP BY company
""")
def m22_company_features(t):
    return rounded(cluster.company_features(V.prices25(t)))


@register("m22_mean_correlation", views=("prices25",), sql="""
WITH m AS (SELECT company, avg(changeOverTime) AS mu, stddev_pop(changeOverTime) AS sd, count(changeOverTime) AS n FROM prices25 GROUP BY company),
z AS (SELECT company, date, (changeOverTime - mu) / sd AS z, n FROM prices25 JOIN m USING (company) WHERE changeOverTime IS NOT NULL AND sd > 0),
c AS (SELECT a.company, sum(a.z * b.z) / a.n / (SELECT count(*) - 1 FROM m WHERE sd > 0) AS r
      FROM z a JOIN z b ON a.date = b.date AND a.company <> b.company GROUP BY a.company, a.n)
SELECT company, round(r, 4) AS mean_correlation FROM m LEFT JOIN c USING (company)
""")
def m22_mean_correlation(t):
    return rounded(cluster.mean_correlation(once(V.prices25(t).select("company", "date", "changeOverTime"))))


@register("m22_cluster_with_correlation")
def m22_cluster_with_correlation(t):
    px = once(V.prices25(t).select("company", "date", "changeOverTime", "volume", "close"))
    both = cluster.company_features(px).join(cluster.mean_correlation(px), "company")
    return cluster.cluster(once(both), k=4, seed=42, columns=(*cluster.FEATURE_COLUMNS, "mean_correlation"))


@register("m22_cluster_companies")
def m22_cluster_companies(t):
    return cluster.cluster(once(cluster.company_features(V.prices25(t))), k=4, seed=42)


@register("m22_silhouette_by_k")
def m22_silhouette_by_k(t):
    return rounded(cluster.silhouette_by_k(once(cluster.company_features(V.prices25(t))), (2, 3, 4, 5)))


# ---------------------------------------------------------------------------
# M2 time-ordered split (closed form) and P15 prediction preview


@register("m2_time_split", views=("prices",), sql="""
SELECT company, date, round(close, 4) AS close, CASE WHEN pr >= 0.8 THEN 'test' ELSE 'train' END AS split
FROM (SELECT company, date, close, percent_rank() OVER (PARTITION BY company ORDER BY date) AS pr FROM prices)
""")
def m2_time_split(t):
    """Every row with its side of the time-ordered split (last 20 % of each series = test)."""
    px = V.prices(t).select("company", "date", "close")
    train, test = regress.time_split(px, 0.2)
    return rounded(train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))))


@register("p15_prediction_preview")
def p15_prediction_preview(t):
    _, pred = _fit_predict(t, "lr")
    return rounded(select.preview(pred.orderBy(*ML_KEYS), 20, ("prediction", "label", "features")))


@register("m3_q12_lagged_feature_regression")
def m3_q12_lagged_feature_regression(t):
    """Next-day close from the previous day's fields only (no same-day leakage)."""
    data, names = regress.lagged_features(V.prices(t), list(FEATURES))
    train, test = regress.hash_split(data, ["company", "date"], 0.3)
    model = regress.pipeline(names, "lr", label="close").fit(train)
    return rounded(model.transform(test).select("company", "date", F.col("close").alias("label"), "prediction"))
