import warnings

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import SF01, lmp_rows
from market_engine.operators import ml
from market_engine.operators import ml_outputs as MO
from market_engine.operators.ranking import distributed_row_number, hex_bucket
from market_engine.plans import market
from market_engine.session import materialise_frame


@pytest.fixture(scope="module")
def stress(spark):
    return market.from_testdata(spark, SF01).stress


def test_distributed_row_number_equals_window(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    a = distributed_row_number(df, ["g"], hex_bucket(F.col("h"), 2), [F.col("h")], "rn")
    b = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("h")))
    assert a.exceptAll(b).count() == 0 and a.count() == 5000


def test_next_hour_target_methods_agree(stress):
    a = ml.next_hour_target(stress)
    b = ml.next_hour_target(stress, method="window")
    assert a.count() == stress.count() - 3
    assert a.exceptAll(b).count() == 0


def test_stratified_split_is_disjoint_stratified_and_deterministic(stress):
    fr = ml.next_hour_target(stress)
    s = ml.stratified_split(fr)
    c = {(r[0], r[1]): r[2] for r in s.groupBy(ml.TARGET, "is_test").count().collect()}
    import math
    for y in (0, 1):
        n = c.get((y, True), 0) + c.get((y, False), 0)
        assert c[(y, True)] == math.ceil(0.25 * n)
    assert s.count() == fr.count()
    assert s.exceptAll(ml.stratified_split(fr)).count() == 0


def test_split_of_a_class_with_one_row_is_not_stratified(stress):
    fr = ml.next_hour_target(stress)
    one = fr.filter(f"{ml.TARGET} = 1").orderBy("hour_utc", "trading_hub").limit(1)
    few = fr.filter(f"{ml.TARGET} = 0").unionByName(one)
    for method in ("distributed", "window"):
        n, test = ml.stratified_split(few, method=method).agg(F.count("*"), F.count_if("is_test")).first()
        assert n == few.count() and test == -(-n // 4)


def test_medians_equal_percentile_without_one_task(stress):
    cols = ["lmp_avg", "lmp_stddev", "demand_mwh", "hour_of_day"]
    got = ml.medians(stress, cols).first().asDict()
    want = stress.agg(*[F.percentile(F.col(c).cast("double"), 0.5).alias(c) for c in cols]).first().asDict()
    assert got == want
    assert "percentile(" not in ml.medians(stress, cols)._jdf.queryExecution().toString()


def test_hub_without_prices_keeps_its_row(spark):
    from market_engine.operators.stress import hub_thresholds
    df = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("B", None)], "trading_hub string, lmp_avg double")
    rows = {r.trading_hub: r.lmp_p95_threshold for r in hub_thresholds(df).collect()}
    assert rows["B"] is None and rows == {
        r.trading_hub: r.lmp_p95_threshold for r in hub_thresholds(df, method="aggregate").collect()}


def test_temporal_split(stress):
    fr = ml.next_hour_target(stress)
    s = ml.temporal_split(fr)
    tmax = s.filter("not is_test").agg(F.max("hour_utc")).first()[0]
    tmin = s.filter("is_test").agg(F.min("hour_utc")).first()[0]
    assert tmax < tmin


def test_guards(spark):
    from helpers import ops_rows
    flat = market.build(lmp_rows(spark, [(60 * h, "NP15", 1.0) for h in range(60)]), ops_rows(spark, []))
    with pytest.raises(ValueError):                 # one class: every hour ties at p95 -> all flagged
        ml.build_features(flat.stress)
    few = market.build(lmp_rows(spark, [(60 * h, "NP15", float(h % 7)) for h in range(20)]), ops_rows(spark, []))
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        ff = ml.build_features(few.stress)
    assert any("only" in str(x.message) for x in w)
    # no operations rows: the four demand columns are all NULL and dropped (T22)
    assert "demand_mwh" in ff.dropped_all_null and "demand_mwh" not in ff.numeric
    assert "lmp_lag_24h" in ff.dropped_all_null                             # 20 hours: no 24-row lag
    assert "lmp_lag_1h" in ff.numeric and ff.df.filter(F.col("lmp_lag_1h").isNull()).count() == 0  # median-filled


def test_auc_matches_evaluator_and_rank_formula(spark, stress):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    fr = ml.next_hour_target(stress)
    ours = ml.roc_auc(fr, score_col="lmp_avg").first().roc_auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    ref = ev.evaluate(fr.select(F.col("lmp_avg").alias("s"), F.col(ml.TARGET).cast("double").alias("y")))
    assert ours == pytest.approx(ref, abs=1e-9)
    one = fr.filter(F.col(ml.TARGET) == 0)
    assert ml.roc_auc(one, score_col="lmp_avg").first().roc_auc is None       # T21


def test_train_score_metrics_and_run_record(spark, stress, tmp_path_run):
    from market_engine.session import materialise_frame
    ff = ml.build_features(stress)
    s = materialise_frame(ml.stratified_split(ff.df))
    train, test = s.filter("not is_test"), s.filter("is_test")
    model = ml.train_classifier(train, ff.numeric, ff.categorical, max_iter=200)
    scored = ml.score(model, test)
    preds = MO.predictions(scored, "v1", "2024-02-01 00:00:00")
    assert preds.count() == test.count()
    assert preds.filter("predicted_spike_probability < 0 or predicted_spike_probability > 1").count() == 0
    m = MO.model_metrics(scored, train, "v1", "2024-02-01 00:00:00").first()
    assert m.training_row_count == train.count() and 0 <= m.accuracy <= 1 and m.roc_auc is not None
    path = MO.save_run(spark, model, MO.model_metrics(scored, train, "v1", "2024-02-01 00:00:00"), tmp_path_run + "/run")
    assert spark.read.parquet(path + "/metrics").count() == 1
    imp = MO.feature_importance(model, test, ["lmp_avg", "hour_of_day"])
    assert imp.count() == 2


def test_logreg_matches_weighted_l2_objective(spark):
    """M-8: Spark's fit equals a Newton solution of sum_i w_i logloss_i + ||b||^2 / 2 (C=1)."""
    import numpy as np
    rng = np.random.default_rng(0)
    n = 400
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=1.0, size=n) > 1.2).astype(int)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    X = np.c_[x, np.ones(n)]
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ beta))
        reg = np.r_[beta[:2], 0.0]
        g = X.T @ (w * (p - y)) + reg
        H = X.T @ (X * (w * p * (1 - p))[:, None]) + np.diag([1.0, 1.0, 0.0])
        beta -= np.linalg.solve(H, g)
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("f", VectorUDT()), T.StructField("y", T.DoubleType()),
                           T.StructField("w", T.DoubleType())])
    df = spark.createDataFrame([(Vectors.dense(x[i]), float(y[i]), float(w[i])) for i in range(n)], schema)
    lr = LogisticRegression(featuresCol="f", labelCol="y", weightCol="w", regParam=1.0 / w.sum(),
                            elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-10).fit(df)
    assert np.allclose(lr.coefficients.toArray(), beta[:2], atol=1e-5)
    assert lr.intercept == pytest.approx(beta[2], abs=1e-5)


def test_least_squares_equals_spark_and_takes_collinear_and_empty_input(spark, stress):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    cols = ["lmp_lag_1h", "lmp_lag_24h", "hour_of_day"]
    fr = ml.next_hour_target(stress)
    model = LinearRegression(featuresCol="f", labelCol="lmp_avg", solver="normal").fit(
        VectorAssembler(inputCols=cols, outputCol="f", handleInvalid="skip").transform(fr.filter("lmp_avg is not null")))
    ours = ml.least_squares(fr, cols)
    got = {r.feature: r.coefficient for r in ours.collect()}
    assert got[""] == pytest.approx(model.intercept, rel=1e-6)
    assert [got[c] for c in cols] == [pytest.approx(b, rel=1e-6) for b in model.coefficients]
    out = ml.forecast(fr, ours).filter("lmp_lag_24h is null").select("predicted_lmp").distinct().collect()
    assert [r.predicted_lmp for r in out] in ([], [None])
    twice = ml.least_squares(fr.withColumn("again", F.col("lmp_lag_1h")), ["lmp_lag_1h", "again"]).collect()
    one = ml.least_squares(fr, ["lmp_lag_1h"]).collect()
    assert twice[1].coefficient + twice[2].coefficient == pytest.approx(one[1].coefficient, rel=1e-6)
    assert ml.least_squares(fr.limit(0), cols).count() == 0


def test_fitted_inputs_of_training_rows_only(spark, tmp_path_run):
    from market_engine.operators import preprocess as PP
    schema = "hub string, x double, y double, z double"
    train = spark.createDataFrame([("A", 1.0, 5.0, None), ("B", None, 5.0, None), (None, 3.0, 5.0, None), ("A", 2.0, 5.0, None)], schema)
    fitted = PP.fit(train, ["x", "y", "z"], ["hub"])
    fitted.write.parquet(tmp_path_run + "/fitted")                       # the table is all that scoring needs
    fitted = spark.read.parquet(tmp_path_run + "/fitted")
    assert sorted((r.place, r.feature, r.level) for r in fitted.collect()) == [
        (0, "x", None), (1, "y", None), (3, "hub", "A"), (4, "hub", "B"), (5, "hub", "UNKNOWN")]   # z has no value
    new = spark.createDataFrame([("NEW", None, 6.0, 1.0), ("B", 4.0, None, 1.0), (None, 2.0, 5.0, None)], schema)
    got = {r.hub: r.inputs for r in PP.apply(new, fitted).collect()}
    sd = 0.5 ** 0.5
    assert got["NEW"] == [0.0, 1.0, 0.0, 0.0, 0.0] and got[None] == [0.0, 0.0, 0.0, 0.0, 1.0]
    assert got["B"] == [pytest.approx(2 / sd), 0.0, 0.0, 1.0, 0.0]
    p = PP.linear_probability(new, fitted, {("x", None): sd, ("hub", "B"): -2.0}, 1.0)
    assert {r.hub: r.predicted_spike_probability for r in p.collect()}["B"] == pytest.approx(1 / (1 + 2.718281828459045 ** -1))


def test_outputs_keep_prices_and_the_fit_is_stationary(spark, stress):
    ff = ml.build_features(stress)
    s = materialise_frame(ml.stratified_split(ff.df))
    train, test = s.filter("not is_test"), s.filter("is_test")
    model = ml.train_classifier(train, ff.numeric, ff.categorical)
    out = MO.predictions(ml.score(model, test), "v1")
    assert sorted(r.lmp_avg for r in out.collect()) == sorted(r.lmp_avg for r in test.collect())
    gradient = ml.fit_gradient(model, train).collect()
    beta = MO.scaled_coefficients(model, spark).collect()
    assert len(gradient) == len(beta) + 1 and max(abs(r.gradient) for r in gradient) < 1e-4
    assert {r.feature for r in beta} >= {"lmp_avg", "trading_hub=NP15"} and all(r.size == abs(r.coefficient) for r in beta)
    other = ml.train_classifier(train, ff.numeric, ff.categorical, max_iter=2)
    assert max(abs(r.gradient) for r in ml.fit_gradient(other, train).collect()) > 1e-3


def test_gbt(spark, stress):
    ff = ml.build_features(stress)
    s = ml.stratified_split(ff.df)
    m = ml.train_classifier(s.filter("not is_test"), ff.numeric, ff.categorical, kind="gbt")
    r = ml.binary_metrics(ml.score(m, s.filter("is_test"))).first()
    assert 0.0 <= r.accuracy <= 1.0 and r.n == s.filter("is_test").count()


def test_grouped_auc_equals_per_group(spark, stress):
    fr = ml.next_hour_target(stress)
    g = {r.trading_hub: r.roc_auc for r in ml.roc_auc(fr, score_col="lmp_avg", by=["trading_hub"]).collect()}
    for hub, auc in g.items():
        one = ml.roc_auc(fr.filter(F.col("trading_hub") == hub), score_col="lmp_avg").first().roc_auc
        assert auc == pytest.approx(one, abs=1e-12)
