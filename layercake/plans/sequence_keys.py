"""Sequence query keys: EMA anomalies, trailing windows, scoring, features.

Stand-ins: a device is a ``user_id``; its temperature is ``value``; the
reading time is ``ts`` with ``event_id`` as tie-break; humidity is the
``k`` field of ``props``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from layercake.functions.numeric import round_half_up
from layercake.operators import ml, sequences
from layercake.plans.registry import register
from layercake.session import configure, scratch_path, table

KEYS = ["device_id"]
ORDER = ["ts", "event_id"]


def readings(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("device_id"),
        "event_id",
        "ts",
        F.col("value").alias("temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("humidity"),
    )


def _w(n: int, partition: str = "PARTITION BY user_id") -> str:
    return f"({partition} ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


# The detector's recurrence over a device's whole history.
EMA_SQL = """SELECT device_id, event_id, ts, temperature, ROUND(ROUND(ema, 9), 6) AS ema,
       abs(temperature - ema) > 5 AS alert
FROM (SELECT user_id AS device_id, event_id, ts, value AS temperature,
        list_reduce(list_prepend(CAST(0.0 AS DOUBLE), list(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                                ROWS UNBOUNDED PRECEDING)),
                    lambda acc, x: acc * CAST(0.9 AS DOUBLE) + x * CAST(0.1 AS DOUBLE)) AS ema
      FROM events WHERE value IS NOT NULL)"""


@register("ema_anomaly", EMA_SQL, group="sequence")
def q_ema_anomaly(spark, sf_dir):
    configure(spark)
    df = readings(spark, sf_dir).drop("humidity")
    return sequences.ema_anomalies(df, KEYS, ORDER, "temperature", digits=6)


@register(
    "sequence_windows",
    f"""SELECT user_id AS device_id, event_id, ts,
           CAST(COUNT(*) OVER {_w(20)} AS INTEGER) AS window_len,
           COUNT(*) OVER {_w(20)} = 20 AS prediction_ready,
           FIRST_VALUE(value) OVER {_w(20)} AS window_first,
           value AS window_last,
           MAX(value) OVER {_w(20)} AS window_max
    FROM events""",
    group="sequence",
)
def q_sequence_windows(spark, sf_dir):
    configure(spark)
    df = readings(spark, sf_dir).drop("humidity")
    out = sequences.trailing_window(df, KEYS, ORDER, "temperature")
    return out.select(
        "device_id",
        "event_id",
        "ts",
        "window_len",
        "prediction_ready",
        F.col("window")[0].alias("window_first"),
        F.element_at("window", -1).alias("window_last"),
        F.array_max("window").alias("window_max"),
    )


def _score_sql() -> str:
    lags = " + ".join(
        f"{float(j + 1)} * LAG(value, {19 - j}) OVER (PARTITION BY user_id ORDER BY ts, event_id)"
        for j in range(20)
    )
    return f"""WITH s AS (
      SELECT user_id AS device_id, event_id, ts, value AS observed,
             CAST(COUNT(*) OVER {_w(20)} AS INTEGER) AS window_len,
             ({lags}) / 210.0 AS p
      FROM events),
    t AS (SELECT *, CASE WHEN window_len = 20 THEN p END AS prediction FROM s)
    SELECT device_id, event_id, ts, window_len, ROUND(prediction, 6) AS prediction, observed,
           CASE WHEN window_len = 20 THEN 'prediction' ELSE 'warmup' END AS kind FROM t
    UNION ALL
    SELECT device_id, event_id, ts, window_len, ROUND(prediction, 6), observed, 'alert' FROM t
    WHERE window_len = 20 AND abs(observed - prediction) > 5.0"""


@register("sequence_score", _score_sql(), group="sequence")
def q_sequence_score(spark, sf_dir):
    configure(spark)
    df = readings(spark, sf_dir).drop("humidity")
    out = sequences.score_sequences(df, KEYS, ORDER, "temperature", digits=6)
    return out.select("device_id", "event_id", "ts", "window_len", "prediction", "observed", "kind")


# Readings with gaps: NULL, NaN and a spike at fixed events.
GAPS_SQL = """CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 389 = 7 THEN CAST('NaN' AS DOUBLE)
                   WHEN event_id % 1009 = 11 THEN 1e4 ELSE value END"""


def gappy_readings(spark, sf_dir):
    return readings(spark, sf_dir).withColumn("temperature", F.expr(GAPS_SQL.replace("value", "temperature")))


def _gap_score_sql() -> str:
    scored = _score_sql().replace("FROM events)", f"FROM (SELECT * REPLACE ({GAPS_SQL} AS value) FROM events))")
    # NaN is the greatest double in SQL, but a reading that is none alerts nobody.
    return scored + " AND NOT isnan(observed - prediction)"


@register("sequence_gaps", _gap_score_sql(), group="sequence")
def q_sequence_gaps(spark, sf_dir):
    """NULL readings take a place in the window, NaN ones give NaN; both through the batch model."""
    configure(spark)
    df = gappy_readings(spark, sf_dir).drop("humidity")
    out = sequences.score_sequences(df, KEYS, ORDER, "temperature", scorer=sequences.model_scorer(load_weights), digits=6)
    return out.select("device_id", "event_id", "ts", "window_len", "prediction", "observed", "kind")


def load_weights():
    """The fixture model, as a worker loads it: batches of sequences -> predictions."""
    import numpy as np

    weights = np.array(sequences.linear_weights())
    return lambda batch: batch @ weights


@register("sequence_score_model", _score_sql(), group="sequence")
def q_sequence_score_model(spark, sf_dir):
    """The same records from a batch model, loaded once per Python worker."""
    configure(spark)
    df = readings(spark, sf_dir).drop("humidity")
    scorer = sequences.model_scorer(load_weights)
    out = sequences.score_sequences(df, KEYS, ORDER, "temperature", scorer=scorer, digits=6)
    return out.select("device_id", "event_id", "ts", "window_len", "prediction", "observed", "kind")


TEMP_FEATURES_SQL = f"""SELECT user_id AS device_id, event_id, value AS temperature,
         LAG(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS temp_lag_1,
         ROUND(AVG(value) OVER {_w(5)}, 6) AS temp_roll_mean_5,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity
  FROM events"""


GAP_FEATURES_SQL = TEMP_FEATURES_SQL.replace("FROM events", f"FROM (SELECT * REPLACE ({GAPS_SQL} AS value) FROM events)")


def temp_features_frame(spark, sf_dir):
    df = sequences.lag_features(readings(spark, sf_dir), KEYS, ORDER, "temperature")
    feats = ml.assemble(df, ["temp_lag_1", "temp_roll_mean_5", "humidity"])
    return feats.withColumn("temp_roll_mean_5", round_half_up("temp_roll_mean_5", 6))


@register("temp_features", TEMP_FEATURES_SQL, group="sequence")
def q_temp_features(spark, sf_dir):
    """Lag and 5-row mean per device, assembled; a missing feature stays missing."""
    configure(spark)
    return temp_features_frame(spark, sf_dir).select(
        "device_id", "event_id", "temperature", "temp_lag_1", "temp_roll_mean_5", "humidity"
    )


def _ols_sql() -> str:
    """Closed-form OLS in SQL: 3x3 covariance system by Cramer's rule."""
    a, b, c, e, f, i = "c11", "c12", "c13", "c22", "c23", "c33"
    det = f"({a}*({e}*{i}-{f}*{f}) - {b}*({b}*{i}-{f}*{c}) + {c}*({b}*{f}-{e}*{c}))"
    b1 = f"(d1*({e}*{i}-{f}*{f}) - {b}*(d2*{i}-{f}*d3) + {c}*(d2*{f}-{e}*d3)) / {det}"
    b2 = f"({a}*(d2*{i}-{f}*d3) - d1*({b}*{i}-{f}*{c}) + {c}*({b}*d3-d2*{c})) / {det}"
    b3 = f"({a}*({e}*d3-d2*{f}) - {b}*({b}*d3-d2*{c}) + d1*({b}*{f}-{e}*{c})) / {det}"
    return f"""WITH f AS (
        SELECT user_id AS device_id, event_id, value AS y,
               LAG(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS x1,
               AVG(value) OVER {_w(5)} AS x2,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x3
        FROM events),
    s AS (SELECT covar_pop(x1, x1) AS c11, covar_pop(x1, x2) AS c12, covar_pop(x1, x3) AS c13,
                 covar_pop(x2, x2) AS c22, covar_pop(x2, x3) AS c23, covar_pop(x3, x3) AS c33,
                 covar_pop(x1, y) AS d1, covar_pop(x2, y) AS d2, covar_pop(x3, y) AS d3,
                 avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my
          FROM f WHERE x1 IS NOT NULL AND x3 IS NOT NULL),
    k AS (SELECT {b1} AS b1, {b2} AS b2, {b3} AS b3, m1, m2, m3, my FROM s)
    SELECT f.device_id, f.event_id, f.y AS temperature,
           ROUND(k.my - k.b1 * k.m1 - k.b2 * k.m2 - k.b3 * k.m3
                 + k.b1 * f.x1 + k.b2 * f.x2 + k.b3 * f.x3, 4) AS prediction
    FROM f, k"""


PREDICT_SQL = _ols_sql()


def saved_model(spark, feats) -> str:
    """A linear model fitted to the features and saved; its path."""
    path = scratch_path(spark, "temperature_model")
    ml.fit_linear(feats, "temperature").save(path)
    return path


@register("linear_predict", PREDICT_SQL, group="sequence")
def q_linear_predict(spark, sf_dir):
    """Fit, save and reload a linear model on the features, then score every row.

    The normal-equation solver gives the least-squares solution, which the
    oracle computes in closed form.
    """
    configure(spark)
    feats = temp_features_frame(spark, sf_dir)
    model = ml.load_linear(saved_model(spark, feats))
    return ml.predict(model, feats).select(
        "device_id", "event_id", "temperature", round_half_up("prediction", 4).alias("prediction")
    )
