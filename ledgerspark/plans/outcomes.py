"""Prediction queries: A-43, A-44, and calibration against labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import outcomes as O
from ledgerspark.plans.registry import query

ORDER = ["recorded_at", "tie", "line_no", "price"]
_SET = """s AS (SELECT *, CASE lower(outcome) WHEN 'true' THEN 1.0 WHEN 'partial' THEN 0.5 ELSE 0.0 END AS y FROM
 (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY prediction_id ORDER BY recorded_at DESC, tie DESC, line_no DESC, price DESC) = 1) WHERE outcome IS NOT NULL)"""
_SCORES = "count(*) AS n, round(avg(p), 10) AS mean_p, round(avg(y)::DOUBLE, 10) AS accuracy, round(avg((p - y) * (p - y)), 10) AS brier"


@query("a43_calibration", f"WITH {_SET} SELECT CASE WHEN p < 0.5 THEN '<0.5' WHEN p < 0.7 THEN '0.5-0.7' WHEN p < 0.9 THEN '0.7-0.9' ELSE '0.9+' END AS bucket, {_SCORES} FROM s GROUP BY 1")
def _(t):
    return O.calibration(t("predictions"), ORDER)


@query("a44_reliability", f"WITH {_SET} SELECT CASE WHEN p <= 0.2 THEN '0-0.2' WHEN p <= 0.4 THEN '0.2-0.4' WHEN p <= 0.6 THEN '0.4-0.6' WHEN p <= 0.8 THEN '0.6-0.8' ELSE '0.8-1' END AS bucket, {_SCORES} FROM s GROUP BY 1")
def _(t):
    return O.reliability(t("predictions"), ORDER)


for _grain, _fmt in (("day", "CAST(CAST(recorded_at AS DATE) AS STRING)"), ("week", "strftime(recorded_at, '%G-%V')"), ("month", "strftime(recorded_at, '%Y-%m')")):

    @query(f"a44_brier_by_{_grain}", f"WITH {_SET} SELECT {_fmt} AS period, {_SCORES} FROM s GROUP BY 1")
    def _(t, grain=_grain):
        return O.brier_over_time(t("predictions"), ORDER, grain)


for _key in ("task_type", "project"):

    @query(f"a44_accuracy_by_{_key}", f"WITH {_SET} SELECT {_key}, {_SCORES} FROM s GROUP BY 1")
    def _(t, key=_key):
        return O.accuracy_by(t("predictions"), ORDER, key)


@query("a43_calibration_of_labels", """
SELECT CASE WHEN p < 0.5 THEN '<0.5' WHEN p < 0.7 THEN '0.5-0.7' WHEN p < 0.9 THEN '0.7-0.9' ELSE '0.9+' END AS bucket, count(*) AS n, round(avg(p), 10) AS mean_p, round(avg(y), 10) AS accuracy, round(avg((p - y) * (p - y)), 10) AS brier
FROM (SELECT round((doc_id % 11) / 10.0, 1)::DOUBLE AS p, quality AS y FROM labels) GROUP BY 1""")
def _(t):
    rows = t("labels").select(F.col("doc_id").cast("string").alias("prediction_id"), F.round((F.col("doc_id") % 11) / 10, 1).alias("p"), F.when(F.col("quality") == 1, "TRUE").otherwise("FALSE").alias("outcome"))
    return O.calibration(rows, ["p"])
