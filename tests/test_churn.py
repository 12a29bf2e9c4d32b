"""The churn model against an independent solver of the same objective."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.operators.churn import FEATURES, churn_model


def _customers(spark, n, seed=3):
    rnd = np.random.default_rng(seed)
    start = dt.date(2020, 1, 1)
    rows = [(int(i), start + dt.timedelta(days=int(rnd.integers(0, 800))), int(rnd.integers(0, 800)), int(rnd.integers(1, 20)),
             float(rnd.gamma(2, 500)), float(rnd.gamma(2, 100)), bool(rnd.random() < 0.4)) for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id long, last_order_date date, " + ", ".join(
        f"{f} {t}" for f, t in zip(FEATURES, ("int", "int", "double", "double", "boolean"))))
    return df, df.agg(F.max("last_order_date").alias("_snap"))


def test_probabilities_are_those_of_the_objective(spark):
    df, snap = _customers(spark, 400)
    out = churn_model(df, snap).orderBy("customer_id").toPandas()
    raw = df.orderBy("customer_id").toPandas()
    x = raw[FEATURES].astype(float).to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    y = out.churned.to_numpy(float)
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(60):  # Newton on the mean loss with an L2 term of 1/n, the intercept free
        p = 1 / (1 + np.exp(-(x @ w + b)))
        s = p * (1 - p)
        z = np.column_stack([x, np.ones(len(x))])
        h = z.T @ (z * s[:, None]) / len(x) + np.diag([1 / len(x)] * len(w) + [0])
        g = z.T @ (p - y) / len(x) + np.append(w / len(x), 0)
        step = np.linalg.solve(h, g)
        w, b = w - step[:-1], b - step[-1]
    assert np.allclose(out.churn_prob, 1 / (1 + np.exp(-(x @ w + b))), atol=2e-3)
    assert set(out.status) == {"fitted"} and 0.5 < out.accuracy[0] <= 1


def test_small_tables_say_why_there_is_no_model(spark):
    df, snap = _customers(spark, 20)
    row = churn_model(df, snap).first()
    assert row.churn_prob is None and row.status == "too few customers"
    assert churn_model(df, snap, min_customers=10).first().status in ("fitted", "one class")
