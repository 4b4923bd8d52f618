"""SQL over the given tables that computes the same results as the registered queries."""

from __future__ import annotations

from fieldgauge.operators.modeling import random_trials, trial_name

SENSORS = ["Temperature", "Humidity", "Light", "CO2", "HumidityRatio"]
INPUTS = ["Temperature", "Light", "CO2", "HumidityRatio"]
GOLD = [*SENSORS, "Occupancy"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
METRICS = ["accuracy", "precision", "recall", "f1"]


def r(expression: str, digits: int = 6) -> str:
    return f"(round({expression}, {digits}) + 0.0)"


def rs(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns)


READINGS = """readings AS (
  SELECT event_id, ts AS date, user_id, event_type,
         CAST(19 AS DOUBLE) + (value % 5) AS Temperature,
         CAST(20 + (user_id % 20) AS DOUBLE) AS Humidity,
         value AS Light,
         CAST(400 + 12 * CAST(json_extract_string(props, '$.k') AS INT) AS DOUBLE) AS CO2,
         CAST(0.0001 AS DOUBLE) * CAST(30 + (user_id % 20) AS DOUBLE) AS HumidityRatio,
         CAST(CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END AS BIGINT) AS Occupancy
  FROM events)"""
PREDICTIONS = (
    READINGS
    + """, predictions AS (
  SELECT *, CASE WHEN Temperature > 21.5 THEN 1 ELSE 0 END AS prediction FROM readings)"""
)
GOLD_ROWS = (
    READINGS
    + """, gold AS (
  SELECT * FROM readings
  WHERE (Occupancy = 0 AND Temperature < 22 AND CO2 < 720)
     OR (Occupancy = 1 AND Temperature > 21 AND Temperature < 23.1 AND CO2 < 1550))"""
)
GAPS = (
    READINGS
    + """, gaps AS (
  SELECT * REPLACE (CASE WHEN event_type <> 'view' THEN Humidity END AS Humidity) FROM readings)"""
)
REQUESTS = (
    PREDICTIONS
    + """, requests AS (
  SELECT *, event_id // 4096 AS block, strftime(date, '%Y-%m-%d') AS day,
         sha256(concat(user_id, '|', strftime(date, '%Y-%m-%d'), '|', event_id // 4096)) AS request_id
  FROM predictions),
positions AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY event_id) - 1 AS pos,
         min(epoch_us(date) // 1000) OVER (PARTITION BY request_id) AS request_ms
  FROM requests)"""
)
VARIED = (
    REQUESTS
    + """, varied AS (
  SELECT *, CASE WHEN user_id % 17 <> 0 AND user_id % 19 <> 0 THEN user_id % 29 END AS shape,
         count(*) OVER (PARTITION BY request_id) AS n
  FROM positions WHERE user_id % 10 <> 0),
named AS (SELECT * REPLACE (CASE WHEN shape = 0 THEN 'content-' ELSE request_id END AS request_id), request_id AS own FROM varied)"""
)
VARIED_CLEAN = (
    "shape NOT IN (5, 8, 9, 10) AND NOT (shape IN (3, 4) AND pos = 0) AND NOT (shape = 7 AND pos = n - 1)"
)
USABLE = "user_id % 10 <> 0 AND user_id % 17 <> 0 AND user_id % 19 <> 0"


def long(source: str, columns: list[str], keys: list[str]) -> str:
    """(keys, column, value) rows of several columns."""
    lead = "".join(f"{k}, " for k in keys)
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns
    )


def describe(source: str, columns: list[str], digits: int = 6) -> str:
    measures = {
        "mean": "avg(value)", "std": "stddev_samp(value)", "min": "min(value)",
        "p25": "quantile_cont(value, 0.25)", "p50": "quantile_cont(value, 0.5)",
        "p75": "quantile_cont(value, 0.75)", "max": "max(value)",
    }
    listed = ", ".join(f"{r(e, digits)} AS {n}" for n, e in measures.items())
    return f"""SELECT "column", count(value) AS count, {listed}
FROM ({long(source, columns, [])}) GROUP BY 1"""


def box(source: str, columns: list[str], label: str) -> str:
    return f"""vals AS ({long(source, columns, [label])}),
boxes AS (SELECT {label}, "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
                 quantile_cont(value, 0.75) AS q3 FROM vals GROUP BY 1, 2),
marked AS (SELECT vals.*, q1, med, q3,
                  value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
           FROM vals JOIN boxes USING ({label}, "column"))
SELECT "column", {label}, count(*) AS n, {r('max(q1)')} AS q1, {r('max(med)')} AS median,
       {r('max(q3)')} AS q3,
       {r('least(min(value) FILTER (inside), max(q1))')} AS whisker_low,
       {r('greatest(max(value) FILTER (inside), max(q3))')} AS whisker_high,
       count(*) FILTER (NOT inside) AS outliers
FROM marked GROUP BY 1, 2"""


def correlations(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        f"{r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS r FROM {source}"
        for a in columns
        for b in columns
    )


def metrics(source: str, prediction: str = "prediction", by: str = "") -> str:
    """Wide metric columns."""
    tp = f"CAST(count(*) FILTER (Occupancy = 1 AND {prediction} = 1) AS DOUBLE)"
    predicted = f"count(*) FILTER ({prediction} = 1)"
    actual = "count(*) FILTER (Occupancy = 1)"
    group = f" GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}
  CAST(count(*) FILTER (Occupancy = {prediction}) AS DOUBLE) / count(*) AS accuracy,
  CASE WHEN {predicted} = 0 THEN 0.0 ELSE {tp} / nullif({predicted}, 0) END AS "precision",
  CASE WHEN {actual} = 0 THEN 0.0 ELSE {tp} / nullif({actual}, 0) END AS recall,
  CASE WHEN {predicted} + {actual} = 0 THEN 0.0 ELSE 2 * {tp} / nullif({predicted} + {actual}, 0) END AS f1
FROM {source}{group}"""


def melted(source: str, lead: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {lead}'{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM {source}" for m in METRICS
    )


def histogram(bins: str, prefix: str = "") -> str:
    return f"""WITH {READINGS}, lim AS (SELECT min(Temperature) AS lo, max(Temperature) AS hi,
  CAST(count(*) AS DOUBLE) AS n, quantile_cont(Temperature, 0.75) - quantile_cont(Temperature, 0.25) AS iqr
  FROM readings), b AS (SELECT lo, hi - lo AS span, CAST({bins} AS DOUBLE) AS bins FROM lim),
placed AS (SELECT Occupancy, least(CAST(floor(bins * (Temperature - lo) / span) AS BIGINT),
                                   CAST(bins - 1 AS BIGINT)) AS bin FROM readings, b),
every AS (SELECT Occupancy, unnest(range(CAST(bins AS BIGINT))) AS bin, lo, span, bins
          FROM (SELECT DISTINCT Occupancy FROM readings), b)
SELECT Occupancy, bin, {r('lo + span * bin / bins')} AS "left", {r('lo + span * (bin + 1) / bins')} AS "right", count(placed.bin) AS n
FROM every LEFT JOIN placed USING (Occupancy, bin) GROUP BY Occupancy, bin, lo, span, bins"""


KDE = f"""WITH {READINGS}, vals AS ({long('readings', ['CO2', 'Light', 'Humidity', 'HumidityRatio'], ['Occupancy'])}),
counts AS (SELECT "column", Occupancy, value, count(*) AS n FROM vals GROUP BY 1, 2, 3),
stats AS (SELECT "column", Occupancy, CAST(count(*) AS DOUBLE) AS size, min(value) AS lo, max(value) AS hi,
                 stddev_samp(value) * power(CAST(count(*) AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS bw
          FROM vals GROUP BY 1, 2),
totals AS (SELECT "column", CAST(count(*) AS DOUBLE) AS total FROM vals GROUP BY 1),
grid AS (SELECT s."column", Occupancy, size, total, bw, CAST(p.point AS INT) AS point,
                lo - 3 * bw + p.point * ((hi + 3 * bw) - (lo - 3 * bw)) / 199 AS x
         FROM stats s JOIN totals t ON s."column" = t."column", range(200) p(point))
SELECT g."column", g.Occupancy, g.point, {r('any_value(x)')} AS x,
       {r('sum(n * exp(-0.5 * ((x - value) / bw) * ((x - value) / bw))) / any_value(bw * sqrt(2 * pi()) * size)')} AS density,
       {r('sum(n * exp(-0.5 * ((x - value) / bw) * ((x - value) / bw))) / any_value(bw * sqrt(2 * pi()) * total)')} AS scaled_density
FROM grid g JOIN counts c ON g."column" = c."column" AND g.Occupancy = c.Occupancy GROUP BY 1, 2, 3"""

PREFIX = "substr(md5(CAST(event_id AS VARCHAR)), 1, 4)"
SPLIT = f"CASE WHEN {PREFIX} < 'a3d7' THEN 'train' WHEN {PREFIX} < 'cccc' THEN 'validation' ELSE 'test' END"
RENAMED = (
    f"{r('Temperature')} AS room_temperature, {r('Light')} AS room_light, "
    f"{r('CO2')} AS co2_ppm, {r('HumidityRatio')} AS humidity_ratio"
)
FOLDS = (
    READINGS
    + """, folded AS (
  SELECT *, (row_number() OVER (PARTITION BY Occupancy ORDER BY md5(CAST(event_id AS VARCHAR)), event_id)) % 5 AS fold
  FROM readings)"""
)
TRIALS = (
    FOLDS
    + ", judged AS ("
    + " UNION ALL ".join(
        f"SELECT 'limit={x}' AS params, fold, Occupancy, CASE WHEN Temperature > {x} THEN 1 ELSE 0 END AS prediction "
        "FROM folded"
        for x in (20.5, 21.0, 21.5, 22.0)
    )
    + f"), wide AS ({metrics('judged', by='params, fold')}), per_fold AS ({melted('wide', 'params, fold, ')}), "
    "means AS (SELECT params, metric, avg(value) AS value FROM per_fold GROUP BY 1, 2)"
)
DAILY = (
    PREDICTIONS
    + """, log AS (
  SELECT strftime(date, '%Y-%m-%d') AS window_start, 0 AS model_id, Temperature, Light, CO2, HumidityRatio,
         prediction AS Occupancy FROM predictions)"""
)
DAILY_GOLD = (
    DAILY
    + """, gold AS (
  SELECT * FROM readings
  WHERE (Occupancy = 0 AND Temperature < 22 AND CO2 < 720)
     OR (Occupancy = 1 AND Temperature > 21 AND Temperature < 23.1 AND CO2 < 1550))"""
)
DAY_KEYS = ["window_start", "model_id"]
UNPACKED_COLUMNS = f"0 AS model_id, {rs(INPUTS)}, prediction AS Occupancy"

KS = f"""WITH {DAILY_GOLD}, cur AS ({long('log', INPUTS, DAY_KEYS)}), base AS ({long('gold', INPUTS, [])}),
points AS (SELECT DISTINCT window_start, model_id, "column", value FROM cur
           UNION SELECT w.window_start, w.model_id, b."column", b.value
           FROM (SELECT DISTINCT window_start, model_id FROM cur) w, (SELECT DISTINCT "column", value FROM base) b),
c AS (SELECT window_start, model_id, "column", value, count(*) AS n FROM cur GROUP BY 1, 2, 3, 4),
b AS (SELECT "column", value, count(*) AS n FROM base GROUP BY 1, 2),
f AS (SELECT p.*, coalesce(c.n, 0) AS cn, coalesce(b.n, 0) AS bn FROM points p
      LEFT JOIN c USING (window_start, model_id, "column", value) LEFT JOIN b USING ("column", value)),
cum AS (SELECT *, sum(cn) OVER w AS cu, sum(bn) OVER w AS bu, sum(cn) OVER g AS ct, sum(bn) OVER g AS bt FROM f
        WINDOW g AS (PARTITION BY window_start, model_id, "column"),
               w AS (PARTITION BY window_start, model_id, "column" ORDER BY value))
SELECT window_start, model_id, "column", CAST(max(ct) AS BIGINT) AS n,
       {r('max(abs(CAST(cu AS DOUBLE) / ct - CAST(bu AS DOUBLE) / bt))')} AS ks
FROM cum GROUP BY 1, 2, 3"""

PSI_EDGES = ", ".join(f"quantile_cont(value, {i / 10}) AS q{i}" for i in range(1, 10))
PSI_BIN = " + ".join(f"CAST(q{i} < value AS INT)" for i in range(1, 10))
PSI = f"""WITH {DAILY_GOLD}, cur AS ({long('log', INPUTS, DAY_KEYS)}), base AS ({long('gold', INPUTS, [])}),
edges AS (SELECT "column", {PSI_EDGES} FROM base GROUP BY 1),
cb AS (SELECT window_start, model_id, "column", {PSI_BIN} AS bin, count(*) AS n
       FROM cur JOIN edges USING ("column") GROUP BY 1, 2, 3, 4),
bb AS (SELECT "column", {PSI_BIN} AS bin, count(*) AS n FROM base JOIN edges USING ("column") GROUP BY 1, 2),
ct AS (SELECT window_start, model_id, "column", sum(n) AS total FROM cb GROUP BY 1, 2, 3),
bt AS (SELECT "column", sum(n) AS total FROM bb GROUP BY 1),
cells AS (SELECT ct.window_start, ct.model_id, "column", g.bin, ct.total AS ct,
                 greatest(CAST(coalesce(cb.n, 0) AS DOUBLE) / ct.total, 0.0001) AS a,
                 greatest(CAST(coalesce(bb.n, 0) AS DOUBLE) / bt.total, 0.0001) AS e
          FROM ct JOIN bt USING ("column") CROSS JOIN (SELECT range AS bin FROM range(10)) g
          LEFT JOIN cb USING (window_start, model_id, "column", bin) LEFT JOIN bb USING ("column", bin))
SELECT window_start, model_id, "column", CAST(max(ct) AS BIGINT) AS n, {r('sum((a - e) * ln(a / e))')} AS psi
FROM cells GROUP BY 1, 2, 3"""

CLASS_DRIFT = f"""WITH {DAILY_GOLD},
b AS (SELECT CAST(Occupancy AS INT) AS class, CAST(count(*) AS DOUBLE) AS n FROM gold GROUP BY 1),
a AS (SELECT window_start, model_id, CAST(Occupancy AS INT) AS class, CAST(count(*) AS DOUBLE) AS n
      FROM log GROUP BY 1, 2, 3),
w AS (SELECT window_start, model_id, sum(n) AS n_day FROM a GROUP BY 1, 2),
classes AS (SELECT class FROM b UNION SELECT class FROM a),
cells AS (SELECT w.window_start, w.model_id, n_day, (SELECT sum(n) FROM b) AS n_base,
                 coalesce(a.n, 0) AS a, coalesce(b.n, 0) AS b
          FROM w CROSS JOIN classes LEFT JOIN a USING (window_start, model_id, class) LEFT JOIN b USING (class))
SELECT window_start, model_id, CAST(max(n_day) AS BIGINT) AS n, {r('0.5 * sum(abs(a / n_day - b / n_base))')} AS tv_distance,
       {r('sum(power(a * sqrt(n_base / n_day) - b * sqrt(n_day / n_base), 2) / (a + b))')} AS chi_square
FROM cells WHERE a + b > 0 GROUP BY 1, 2"""

PREVIOUS = f"""WITH {DAILY}, cur AS ({long('log', INPUTS, DAY_KEYS)}),
days AS (SELECT window_start, model_id, lag(window_start) OVER (PARTITION BY model_id ORDER BY window_start) AS previous_start
         FROM (SELECT DISTINCT window_start, model_id FROM log)),
both_ AS (SELECT window_start, model_id, "column", value, 1 AS c, 0 AS p FROM cur
          UNION ALL SELECT d.window_start, d.model_id, "column", value, 0, 1
          FROM days d JOIN cur ON cur.window_start = d.previous_start AND cur.model_id = d.model_id),
counts AS (SELECT window_start, model_id, "column", value, sum(c) AS c, sum(p) AS p FROM both_ GROUP BY 1, 2, 3, 4),
cum AS (SELECT *, sum(c) OVER w AS cu, sum(p) OVER w AS pu, sum(c) OVER g AS ct, sum(p) OVER g AS pt FROM counts
        WINDOW g AS (PARTITION BY window_start, model_id, "column"),
               w AS (PARTITION BY window_start, model_id, "column" ORDER BY value)),
ks AS (SELECT window_start, model_id, "column",
              max(abs(CAST(cu AS DOUBLE) / nullif(ct, 0) - CAST(pu AS DOUBLE) / nullif(pt, 0))) AS ks FROM cum GROUP BY 1, 2, 3),
means AS (SELECT window_start, model_id, "column", count(*) AS n, avg(value) AS mean FROM cur GROUP BY 1, 2, 3)
SELECT window_start, model_id, "column", m.n, d.previous_start, {r('m.mean - q.mean')} AS mean_delta, {r('ks.ks')} AS ks
FROM means m JOIN days d USING (window_start, model_id) JOIN ks USING (window_start, model_id, "column")
JOIN means q ON q.window_start = d.previous_start AND q.model_id = m.model_id AND q."column" = m."column" """

ORACLES = {
    "gold_class_counts": f"WITH {GOLD_ROWS} SELECT Occupancy, count(*) AS n FROM gold GROUP BY 1",
    "gold_rows": f"WITH {GOLD_ROWS} SELECT {rs(SENSORS)}, Occupancy FROM gold",
    "gold_union": f"""WITH {READINGS}
SELECT {rs(SENSORS)}, Occupancy FROM readings WHERE Temperature < 22 AND CO2 < 720 AND Occupancy = 0
UNION ALL
SELECT {rs(SENSORS)}, Occupancy FROM readings
WHERE Temperature > 21 AND Temperature < 23.1 AND CO2 < 1550 AND Occupancy = 1""",
    "silver_typed": f"""WITH {READINGS}
SELECT epoch_us(date_trunc('second', date)) // 1000 AS at_ms, {rs(SENSORS)}, Occupancy FROM readings""",
    "cast_reject_rows": """SELECT event_id, concat_ws(',', CASE WHEN user_id % 3 = 0 THEN 'Temperature' END,
  CASE WHEN event_type = 'view' THEN 'Occupancy' END) AS bad_columns FROM events WHERE user_id % 3 = 0 OR event_type = 'view'""",
    "union_by_name_files": f"""WITH {GAPS}
SELECT epoch_us(date_trunc('second', date)) // 1000 AS at_ms, {rs(SENSORS)},
  CASE WHEN event_type <> 'view' THEN Occupancy END AS Occupancy FROM gaps""",
    "describe_numeric": f"WITH {READINGS} {describe('readings', GOLD)}",
    "nonnull_profile": f"WITH {GAPS}, t AS (SELECT date, {', '.join(GOLD)} FROM gaps) "
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS rows FROM t"
        for i, (c, t) in enumerate(
            [("date", "timestamp_ntz"), *[(c, "double") for c in SENSORS], ("Occupancy", "bigint")]
        )
    ),
    "hist_by_class": histogram("20"),
    "hist_auto_bins": histogram(
        "ceil((hi - lo) / CASE WHEN iqr > 0 THEN least(2 * iqr / power(n, CAST(1 AS DOUBLE) / 3), "
        "(hi - lo) / (log2(n) + 1)) ELSE (hi - lo) / (log2(n) + 1) END)"
    ),
    "hist_far_outlier": f"""WITH v AS (
  SELECT l_linestatus, CASE WHEN l_orderkey = 100 THEN 1e9 ELSE CAST(l_quantity AS DOUBLE) END AS x FROM lineitem),
lim AS (SELECT min(x) AS lo, max(x) - min(x) AS span, CAST(count(*) AS DOUBLE) AS n, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM v),
b AS (SELECT lo, span, CAST(ceil(span / least(2 * iqr / power(n, CAST(1 AS DOUBLE) / 3), span / (log2(n) + 1))) AS DOUBLE) AS bins FROM lim)
SELECT l_linestatus, least(CAST(floor(bins * (x - lo) / span) AS BIGINT), CAST(bins - 1 AS BIGINT)) AS bin,
  {r('any_value(lo + span * least(floor(bins * (x - lo) / span), bins - 1) / bins)')} AS "left",
  {r('any_value(lo + span * (least(floor(bins * (x - lo) / span), bins - 1) + 1) / bins)')} AS "right", count(*) AS n
FROM v, b GROUP BY 1, 2""",
    "kde_by_class": KDE,
    "box_by_class": f"WITH {READINGS}, {box('readings', SENSORS, 'Occupancy')}",
    "corr_long": f"WITH {READINGS} {correlations('readings', GOLD)}",
    "corr_with_gaps": f"WITH {GAPS} {correlations('gaps', GOLD)}",
    "head_rows": f"WITH {READINGS} SELECT event_id, {rs(SENSORS)}, Occupancy FROM readings ORDER BY event_id LIMIT 5",
    "lineitem_describe": describe("lineitem", LINE_NUMBERS, 4),
    "lineitem_box": f"WITH {box('lineitem', LINE_NUMBERS, 'l_linestatus')}",
    "lineitem_corr": correlations("lineitem", LINE_NUMBERS),
    "lineitem_group_quantiles": f"""SELECT l_returnflag, l_linestatus, "column", count(value) AS n,
  count(DISTINCT value) AS n_distinct, {r('quantile_cont(value, 0.05)')} AS p05, {r('quantile_cont(value, 0.95)')} AS p95
FROM ({long('lineitem', LINE_NUMBERS, ['l_returnflag', 'l_linestatus'])}) GROUP BY 1, 2, 3""",
    "surrogate_key": f"""WITH {READINGS}
SELECT row_number() OVER (ORDER BY date, event_id) AS Id, event_id, {rs(SENSORS)}, Occupancy FROM readings""",
    "surrogate_key_hot_lead": f"""SELECT row_number() OVER (ORDER BY ascii(o_orderstatus), o_orderkey) AS Id,
  ascii(o_orderstatus) AS status, o_orderkey, {r('o_totalprice')} AS o_totalprice FROM orders""",
    "feature_upsert": f"""SELECT o_orderkey, o_orderstatus,
  {r("CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice + 1 ELSE o_totalprice END", 2)} AS o_totalprice FROM orders""",
    "key_check": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "snapshot_changes": f"""WITH b AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
a AS (SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
      FROM orders WHERE o_orderpriority <> '5-LOW'),
c AS (
  SELECT 'insert' AS change_type, a.* FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
  UNION ALL SELECT 'delete', b.* FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
  UNION ALL SELECT 'update_preimage', b.* FROM b JOIN a USING (o_orderkey) WHERE a.o_totalprice <> b.o_totalprice
  UNION ALL SELECT 'update_postimage', a.* FROM a JOIN b USING (o_orderkey) WHERE a.o_totalprice <> b.o_totalprice)
SELECT change_type, o_orderkey, o_orderstatus, o_orderpriority, {r('o_totalprice', 2)} AS o_totalprice FROM c""",
    "feature_lookup": f"""WITH {GOLD_ROWS} SELECT readings.event_id AS Id, readings.Occupancy,
  {RENAMED.replace('round(', 'round(gold.')} FROM readings LEFT JOIN gold USING (event_id)""",
    "training_rename": f"WITH {READINGS} SELECT event_id AS Id, {RENAMED}, Occupancy FROM readings",
    "split_counts": f"SELECT {SPLIT} AS split, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1",
    "split_exact_counts": """WITH ranked AS (SELECT event_id,
    row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS rank, count(*) OVER () AS total FROM events),
sized AS (SELECT *, ceil(total * CAST(0.2 AS DOUBLE)) AS n_test FROM ranked),
tagged AS (SELECT event_id, CASE WHEN rank <= n_test THEN 'test'
    WHEN rank <= n_test + ceil((total - n_test) * CAST(0.2 AS DOUBLE)) THEN 'validation' ELSE 'train' END AS split FROM sized)
SELECT split, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM tagged GROUP BY 1""",
    "stratified_folds": f"""WITH {FOLDS} SELECT Occupancy, CAST(fold AS INT) AS fold, count(*) AS n,
  CAST(sum(event_id) AS BIGINT) AS id_sum FROM folded GROUP BY 1, 2""",
    "scaler_statistics": f"""WITH {READINGS} SELECT "column", {r('avg(value)')} AS mean, {r('stddev_pop(value)')} AS std
FROM ({long('readings', INPUTS, [])}) GROUP BY 1""",
    "scaled_features": f"WITH {READINGS} SELECT event_id, "
    + ", ".join(f"{r(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in INPUTS)
    + " FROM readings",
    "validation_csv_roundtrip": f"WITH {READINGS} SELECT {RENAMED}, Occupancy FROM readings WHERE {SPLIT} = 'validation'",
    "day_success_requests": f"""WITH {REQUESTS} SELECT request_id, CAST(max(request_ms) AS BIGINT) AS timestamp_ms,
  CAST(200 AS BIGINT) AS status_code FROM positions WHERE user_id % 10 <> 0 AND day = '2024-01-15' GROUP BY request_id""",
    "inference_unpacked": f"""WITH {VARIED} SELECT request_id, day AS date, pos, request_ms AS timestamp_ms,
  {UNPACKED_COLUMNS} FROM named WHERE {VARIED_CLEAN}""",
    "inference_append_table": f"""WITH {VARIED} SELECT request_id, day AS date, pos, request_ms AS timestamp_ms,
  {UNPACKED_COLUMNS} FROM named WHERE {VARIED_CLEAN}""",
    "inference_append_late_repeat": f"""WITH {VARIED} SELECT request_id, day AS date, pos, request_ms AS timestamp_ms,
  {UNPACKED_COLUMNS} FROM named WHERE {VARIED_CLEAN}""",
    "inference_row_dedup": f"""WITH {REQUESTS} SELECT DISTINCT 'shared' AS request_id, day AS date, 0 AS timestamp_ms,
  {UNPACKED_COLUMNS} FROM positions WHERE {USABLE}""",
    "inference_rejects": f"""WITH {VARIED}, whole AS (
  SELECT DISTINCT own, request_id, day AS date, user_id, shape, n FROM named)
SELECT request_id, date, CAST(NULL AS INT) AS pos,
  CASE WHEN user_id % 17 = 0 THEN 'malformed_request' WHEN user_id % 19 = 0 THEN 'unsupported_request'
       WHEN shape = 8 THEN 'null_request' WHEN shape = 9 THEN 'empty_request' ELSE 'bad_response' END AS reason
FROM whole WHERE shape IS NULL OR shape IN (8, 9, 10)
UNION ALL SELECT request_id, date, 0, 'bad_prediction' FROM whole WHERE shape IN (3, 4)
UNION ALL SELECT request_id, date, n, 'surplus_prediction' FROM whole WHERE shape = 6
UNION ALL SELECT request_id, date, n - 1, 'surplus_input' FROM whole WHERE shape = 7
UNION ALL SELECT request_id, day, pos, 'arity' FROM named WHERE shape = 5""",
    "inference_append_idempotent": f"""WITH {REQUESTS} SELECT request_id, day AS date, pos, request_ms AS timestamp_ms,
  {UNPACKED_COLUMNS} FROM positions WHERE {USABLE}""",
    "score_capture": f"""WITH {PREDICTIONS} SELECT CAST(event_id AS VARCHAR) AS request_id,
  strftime(date, '%Y-%m-%d') AS date, 0 AS pos, epoch_us(date) // 1000 AS timestamp_ms, {UNPACKED_COLUMNS} FROM predictions""",
    "confusion_matrix": f"WITH {PREDICTIONS} "
    + " UNION ALL ".join(
        f"SELECT {i} AS cell, {a} AS label, {p} AS prediction, "
        f"count(*) FILTER (Occupancy = {a} AND prediction = {p}) AS n FROM predictions"
        for i, (a, p) in enumerate([(1, 1), (1, 0), (0, 1), (0, 0)])
    ),
    "binary_metrics": f"WITH {PREDICTIONS}, wide AS ({metrics('predictions')}), m AS ({melted('wide')}) "
    f"SELECT metric, {r('value')} AS value FROM m",
    "cv_mean_metrics": f"WITH {TRIALS} SELECT params, metric, {r('value')} AS value FROM means",
    "best_trial": f"WITH {TRIALS} SELECT params, {r('-value')} AS loss FROM means WHERE metric = 'f1' "
    "ORDER BY -value, params LIMIT 1",
    "static_gate": f"""WITH {PREDICTIONS}, wide AS ({metrics('predictions')}), m AS ({melted('wide')})
SELECT metric, {r('value')} AS candidate, CAST(NULL AS DOUBLE) AS champion, value >= 0.10 AS value_ok,
  true AS absolute_ok, true AS relative_ok, value >= 0.10 AS passed,
  CASE WHEN value >= 0.10 THEN '' ELSE 'below threshold' END AS reason
FROM m WHERE metric IN ('accuracy', 'precision', 'recall')""",
    "champion_gate": f"""WITH {PREDICTIONS}, c AS (SELECT
  CAST(count(*) FILTER (Occupancy = prediction) AS DOUBLE) / count(*) AS cand,
  CAST(count(*) FILTER (Occupancy = 0) AS DOUBLE) / count(*) AS champ FROM predictions),
k AS (SELECT *, cand >= 0.85 AS v, cand - champ >= 0.5 AS a, (cand - champ) / champ >= 0.05 AS rel FROM c)
SELECT 'accuracy' AS metric, {r('cand')} AS candidate, {r('champ')} AS champion, v AS value_ok, a AS absolute_ok,
  rel AS relative_ok, v AND a AND rel AS passed,
  concat_ws('; ', CASE WHEN NOT v THEN 'below threshold' END, CASE WHEN NOT a THEN 'absolute gain too small' END,
            CASE WHEN NOT rel THEN 'relative gain too small' END) AS reason FROM k""",
    "gate_decision": f"""WITH {PREDICTIONS}, wide AS ({metrics('predictions')}), m AS ({melted('wide')})
SELECT bool_and(value >= 0.10) AS passed,
  coalesce(string_agg(CASE WHEN value < 0.10 THEN metric || ': below threshold' END, ', ' ORDER BY metric), '') AS reason
FROM m WHERE metric IN ('accuracy', 'precision', 'recall')""",
    "run_metric_rows": f"""WITH {PREDICTIONS}, wide AS ({metrics('predictions')}), m AS ({melted('wide')})
SELECT 'run-1' AS run_id, 'test' AS kind, metric AS name, {r('value')} AS value FROM m""",
    "baseline_table": f"""WITH {GOLD_ROWS} SELECT event_id AS Id, {rs(SENSORS)}, CAST(Occupancy AS DOUBLE) AS Occupancy,
  0 AS model_id FROM gold""",
    "daily_profile": f"""WITH {DAILY} SELECT window_start, model_id, "column", count(value) AS n,
  count(*) - count(value) AS nulls, count(DISTINCT value) AS n_distinct, {r('avg(value)')} AS mean,
  {r('stddev_samp(value)')} AS std, {r('min(value)')} AS min, {r('quantile_cont(value, 0.25)')} AS p25,
  {r('quantile_cont(value, 0.5)')} AS p50, {r('quantile_cont(value, 0.75)')} AS p75, {r('max(value)')} AS max
FROM ({long('log', [*INPUTS, 'Occupancy'], DAY_KEYS)}) GROUP BY 1, 2, 3""",
    "prediction_share": f"""WITH {DAILY} SELECT window_start, model_id, Occupancy, count(*) AS n,
  {r('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY window_start, model_id)')} AS share
FROM log GROUP BY 1, 2, 3""",
    "drift_mean": f"""WITH {DAILY_GOLD}, c AS (SELECT window_start, model_id, "column", count(*) AS n, avg(value) AS mean,
  stddev_samp(value) AS std FROM ({long('log', INPUTS, DAY_KEYS)}) GROUP BY 1, 2, 3),
b AS (SELECT "column", avg(value) AS bmean, stddev_samp(value) AS bstd FROM ({long('gold', INPUTS, [])}) GROUP BY 1)
SELECT window_start, model_id, "column", n, {r('mean')} AS mean, {r('bmean')} AS baseline_mean,
  {r('mean - bmean')} AS mean_delta, {r('std - bstd')} AS std_delta FROM c JOIN b USING ("column")""",
    "drift_ks": KS,
    "drift_psi": PSI,
    "drift_categorical": CLASS_DRIFT,
    "drift_vs_previous_day": PREVIOUS,
    "stream_unpacked": f"""WITH {VARIED} SELECT request_id, day AS date, pos, request_ms AS timestamp_ms,
  {UNPACKED_COLUMNS} FROM named WHERE {VARIED_CLEAN}""",
}
RULED = (
    READINGS
    + """, ruled AS (
  SELECT *, CAST(floor(Temperature) AS DOUBLE) AS warm, CAST(user_id % 7 AS DOUBLE) AS lamp,
         CASE WHEN floor(Temperature) >= 21 AND CO2 >= 800 THEN 1 ELSE 0 END AS label FROM readings)"""
)
#: A tree that fits the rule gives the label back, whatever its settings.
TRIAL_NAMES = ", ".join(f"('{trial_name(i, p)}')" for i, p in enumerate(random_trials()))
MEASURES = "(VALUES ('accuracy'), ('precision'), ('recall'), ('f1')) m(metric)"
ACCEPTED = f"""WITH {PREDICTIONS}, wide AS ({metrics('predictions')}), m AS ({melted('wide')}),
ok AS (SELECT bool_and(value >= 0.10) AS passed FROM m WHERE metric IN ('accuracy', 'precision', 'recall'))"""
ORACLES |= {
    "tree_predictions": f"WITH {RULED} SELECT event_id AS Id, CAST(label AS BIGINT) AS Occupancy, label AS prediction FROM ruled WHERE {SPLIT} = 'test'",
    "tree_evaluation": f"SELECT metric, CAST(1 AS DOUBLE) AS value FROM {MEASURES}",
    "tree_tuning": f"SELECT params, metric, CAST(1 AS DOUBLE) AS value FROM (VALUES {TRIAL_NAMES}) t(params), {MEASURES}",
    "tree_least_split": """WITH v AS (SELECT CAST(o_orderkey % 100 AS INT) AS tail, CAST(o_orderkey % 100 BETWEEN 60 AND 89 AS INT) AS label FROM orders),
node AS (SELECT count(*) AS whole, count(*) FILTER (tail >= 60) AS upper, avg(label) FILTER (tail >= 60) AS share FROM v)
SELECT tail, count(*) AS n, max(label) AS free,
  CASE WHEN tail < 60 THEN 0 WHEN any_value(upper >= whole // 2 + 1) THEN max(label) ELSE any_value(CAST(share > 0.5 AS INT)) END AS bound
FROM v, node GROUP BY tail""",
    "training_job": f"""SELECT kind, name, CAST(1 AS DOUBLE) AS value FROM (
  SELECT kind, metric AS name FROM (VALUES ('test'), ('validation')) k(kind), {MEASURES}
  UNION ALL SELECT 'cv', concat(trial, '/', metric)
    FROM (VALUES ('00:impurity=gini,maxDepth=None,minLeaf=1,minSplit=2'), ('01:impurity=entropy,maxDepth=50,minLeaf=5,minSplit=20')) t(trial), {MEASURES}
  UNION ALL SELECT 'gate', unnest(['accuracy', 'precision', 'recall'])
  UNION ALL SELECT 'alias', 'champion')""",
    "tree_score_capture": f"""WITH {RULED} SELECT CAST(event_id AS VARCHAR) AS request_id, strftime(date, '%Y-%m-%d') AS date, 0 AS pos,
  epoch_us(date) // 1000 AS timestamp_ms, {r('warm')} AS Temperature, {r('lamp')} AS Light, {r('CO2')} AS CO2,
  {r('HumidityRatio')} AS HumidityRatio, label AS Occupancy, 0 AS model_id FROM ruled""",
    "alias_promotion": ACCEPTED + """
SELECT 'accepted' AS "case", 'champion' AS alias, CASE WHEN passed THEN 'm2' ELSE 'm1' END AS model FROM ok
UNION ALL SELECT 'accepted', 'previous', CASE WHEN passed THEN 'm1' ELSE 'm0' END FROM ok
UNION ALL SELECT 'rejected', 'champion', 'm1' UNION ALL SELECT 'rejected', 'previous', 'm0'
UNION ALL SELECT 'first', 'champion', 'm2' FROM ok WHERE passed""",
    "table_roundtrip": f"""WITH {GOLD_ROWS} SELECT event_id, CO2, Occupancy, 'it''s gold,true' AS properties FROM gold""",
    "listed_files": "SELECT count(*) AS n FROM events GROUP BY event_type",
}
EVERY_PREVIOUS = PREVIOUS.replace(long("log", INPUTS, DAY_KEYS), long("log", [*INPUTS, "Occupancy"], DAY_KEYS))
ORACLES["monitor_by_day"] = f"""SELECT p.*, d.previous_start, d.mean_delta, d.ks FROM ({ORACLES['daily_profile']}) p
LEFT JOIN ({EVERY_PREVIOUS}) d ON p.window_start = d.window_start AND p.model_id = d.model_id AND p."column" = d."column" """
ORACLES["stream_daily_profile"] = ORACLES["daily_profile"]
ORACLES["feature_upsert_table"] = ORACLES["feature_upsert"]
