"""Churn label (J10) and logistic churn model (J11), fitted by Spark aggregates.

Features: recency, frequency, monetary, AOV, prime flag; standardised with
the population standard deviation; L2 logistic regression (the sum of the
losses plus half the squared weights, the intercept free: an inverse
regularisation C = 1).  Recency leaks the label -- kept as in the original,
the in-sample accuracy is reported with it.

The fit is Newton's method.  A step needs the gradient and the curvature of
the objective: 27 sums over the customers, one aggregate without a shuffle
of rows.  The driver solves six equations a step and sees no customer.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import config
from ledgerloom.session import stored

FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value", "is_prime_member"]
MAX_STEPS = 60


def _score(weights: list[float]) -> Column:
    """The linear score of a standardised row, the intercept last."""
    total = F.lit(float(weights[-1]))
    for f, w in zip(FEATURES, weights):
        total = total + F.col(f) * float(w)
    return total


def _probability(weights: list[float]) -> Column:
    return 1 / (1 + F.exp(-_score(weights)))


def newton_fit(data: DataFrame, label: str = "churned", l2: float = 1.0) -> list[float]:
    """Weights (features, then the intercept) that minimise the sum of the
    logistic losses of standardised rows plus ``l2 / 2`` times the squared
    weights.  A step that does not lower the objective is halved; the fit ends
    when steps no longer change a weight's ninth digit."""
    names = [*FEATURES, "_one"]
    y = F.col(label).cast("double")
    rows = data.withColumn("_one", F.lit(1.0))
    k = len(names)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    ridge = np.diag([l2] * (k - 1) + [0.0])

    def look(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        p, z = _probability(w.tolist()), _score(w.tolist())
        seen = rows.withColumns({"_miss": p - y, "_s": p * (1 - p), "_loss": F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))})
        row = seen.agg(F.sum("_loss"), *[F.sum(F.col("_miss") * F.col(c)) for c in names],
                       *[F.sum(F.col("_s") * F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
        h = np.zeros((k, k))
        for (i, j), v in zip(pairs, row[1 + k :]):
            h[i, j] = h[j, i] = v
        return row[0] + 0.5 * w @ ridge @ w, np.array(row[1 : 1 + k]) + ridge @ w, h + ridge

    w = np.zeros(k)
    value, gradient, curvature = look(w)
    for _ in range(MAX_STEPS):
        step = np.linalg.solve(curvature, gradient)
        if np.abs(step).max() < 1e-10 * max(1.0, np.abs(w).max()):
            break
        for _ in range(30):
            after = look(w - step)
            if after[0] <= value + 1e-12 * abs(value):
                break
            step = step / 2
        w, (value, gradient, curvature) = w - step, after
    return w.tolist()


def churn_model(customers: DataFrame, snapshot: DataFrame, min_customers: int = 200, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per customer: the label, its probability, the model's in-sample
    accuracy and a status, and the columns ``keep``.  The model is fitted only
    with two classes and more than ``min_customers`` customers; elsewhere the
    status says why not, and probability and accuracy are null.  A null
    feature counts as 0, one without variance as no information."""
    c = stored(customers.crossJoin(F.broadcast(snapshot)).select(
        "customer_id", *[F.col(x).alias(f"k_{x}") for x in keep],
        (F.col("last_order_date") < F.date_sub("_snap", config.CHURN_DAYS)).cast("int").alias("churned"),
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES],
    ), "churn")
    # one aggregate row: n, class count, means, sds
    row = c.agg(F.count("*").alias("_n"), F.countDistinct("churned").alias("_classes"),
                *[F.avg(f).alias(f"_m_{f}") for f in FEATURES], *[F.stddev_pop(f).alias(f"_s_{f}") for f in FEATURES]).first()
    kept = [F.col(f"k_{x}").alias(x) for x in keep]
    if not (row["_classes"] == 2 and row["_n"] > min_customers):
        why = "one class" if row["_n"] > min_customers else "too few customers"
        none = F.lit(None).cast("double")
        return c.select("customer_id", "churned", none.alias("churn_prob"), none.alias("accuracy"), F.lit(why).alias("status"), *kept)
    scaled = c.withColumns({f: (F.col(f) - row[f"_m_{f}"]) / (row[f"_s_{f}"] or 1.0) for f in FEATURES})
    pred = scaled.withColumn("churn_prob", _probability(newton_fit(scaled)))
    acc = pred.agg(F.avg(((F.col("churn_prob") > 0.5) == (F.col("churned") == 1)).cast("double")).alias("accuracy"))
    return pred.crossJoin(F.broadcast(acc)).select("customer_id", "churned", "churn_prob", "accuracy", F.lit("fitted").alias("status"), *kept)
