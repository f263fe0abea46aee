"""Oracle SQL for the feature, EDA, evaluation and decision queries (DuckDB dialect)."""

from __future__ import annotations

from peerscope.operators.evaluation import RANDOM_STATE
from peerscope.plans.oracle import MARKET, benchmark_sql, comparables_sql

REFERENCE = """
SELECT r.r_name AS city_name, n.n_name AS neighbourhood_name,
       'ZONE_' || CAST(n.n_nationkey // 5 AS VARCHAR) AS neighbourhood_group_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""

# Binding parameters (the TPC-H-like prices run to ~500k; the zone city is one region).
MAX_PRICE = 450000.0
ZONE_CITY = "EUROPE"
PERIODS = ["Early Spring", "Early Summer", "Early Autumn", "Early Winter"]


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"(POW(SIN((RADIANS({lat2}) - RADIANS({lat1})) / 2), 2) + COS(RADIANS({lat1})) * COS(RADIANS({lat2})) * "
         f"POW(SIN((RADIANS({lon2}) - RADIANS({lon1})) / 2), 2))")
    return f"(6371.0088 * (2 * ASIN(SQRT(CASE WHEN {h} > 1.0 THEN 1.0 ELSE {h} END))))"


def _joined(max_price_filter: bool) -> str:
    where = f"WHERE m.nightly_price <= {MAX_PRICE}" if max_price_filter else ""
    return f"""
SELECT m.*, ref.neighbourhood_group_name,
  CASE WHEN m.city_name = '{ZONE_CITY}' THEN ref.neighbourhood_group_name END AS venezia_group_name,
  CASE WHEN DATEDIFF('day', m.host_since, m.snapshot_date) IS NULL THEN NULL
       ELSE GREATEST(DATEDIFF('day', m.host_since, m.snapshot_date), 0) END AS host_tenure_days,
  COALESCE(m.period_label IN ('Early Summer', 'Early Autumn'), FALSE) AS season_peak_flag,
  COALESCE(m.period_label IN ('Early Spring', 'Early Winter'), FALSE) AS season_shoulder_flag
FROM ({MARKET}) m LEFT JOIN ({REFERENCE}) ref
  ON m.city_name IS NOT DISTINCT FROM ref.city_name AND m.neighbourhood_name IS NOT DISTINCT FROM ref.neighbourhood_name
{where}"""


MODEL_INPUT = _joined(True)

MODEL_INPUT_PROFILE = f"""
SELECT COUNT(*) FILTER (WHERE nightly_price <= {MAX_PRICE}) AS row_count,
       COUNT(*) - COUNT(*) FILTER (WHERE nightly_price <= {MAX_PRICE}) AS rows_removed_for_high_price_outliers,
       {MAX_PRICE} AS max_modeling_nightly_price,
       COUNT(*) FILTER (WHERE nightly_price <= {MAX_PRICE} AND neighbourhood_group_name IS NULL)
         / COUNT(*) FILTER (WHERE nightly_price <= {MAX_PRICE}) AS null_rate_after_join
FROM ({_joined(False)})"""

FEATURE_FRAME = f"""
WITH mi AS ({MODEL_INPUT}),
cc AS (SELECT city_name, MEDIAN(latitude) AS clat, MEDIAN(longitude) AS clon FROM mi
       WHERE city_name IS NOT NULL GROUP BY city_name),
nc AS (SELECT city_name, neighbourhood_name, MEDIAN(latitude) AS nlat, MEDIAN(longitude) AS nlon FROM mi
       WHERE city_name IS NOT NULL AND neighbourhood_name IS NOT NULL GROUP BY city_name, neighbourhood_name)
SELECT listing_id, snapshot_date, city_name, period_label, neighbourhood_name, nightly_price,
  accommodates_count, beds_count, bedrooms_count, rating_score, latitude, longitude, host_tenure_days,
  {hav('latitude', 'longitude', 'clat', 'clon')} AS distance_to_city_center_km,
  {hav('latitude', 'longitude', 'nlat', 'nlon')} AS distance_to_neighbourhood_center_km,
  room_type, is_superhost, season_peak_flag, season_shoulder_flag, venezia_group_name
FROM mi LEFT JOIN cc USING (city_name) LEFT JOIN nc USING (city_name, neighbourhood_name)"""

# ------------------------------------------------------------------------------------- EDA
M = f"({MARKET})"

ROWS_BY_CITY = f"SELECT city_name, COUNT(*) AS row_count FROM {M} WHERE city_name IS NOT NULL GROUP BY city_name"

ROWS_BY_CITY_PERIOD = (
    "SELECT city_name, "
    + ", ".join(f"COUNT(*) FILTER (WHERE period_label = '{p}') AS \"{p}\"" for p in PERIODS)
    + f" FROM {M} WHERE city_name IS NOT NULL GROUP BY city_name"
)


def _rank_sql(col: str, order: list[str]) -> str:
    whens = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(order, start=1))
    return f"CASE {col} {whens} ELSE {len(order) + 1} END"


ROOM_ORDER = ["Entire home", "Private room", "Hotel room", "Shared room"]
BAND_ORDER = ["1-2 guests", "3-4 guests", "5-6 guests", "7+ guests"]

ROOM_TYPE_SHARE = f"""
SELECT room_type, n / SUM(n) OVER () AS share, {_rank_sql('room_type', ROOM_ORDER)} AS display_rank
FROM (SELECT room_type, COUNT(*) AS n FROM {M} WHERE room_type IS NOT NULL GROUP BY room_type)"""


def median_by(keys: list[str]) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"SELECT {k}, MEDIAN(nightly_price) AS median_nightly_price FROM {M} WHERE {nn} GROUP BY {k}"


MEDIAN_BY_CITY_PERIOD = (
    "SELECT city_name, "
    + ", ".join(f"MEDIAN(nightly_price) FILTER (WHERE period_label = '{p}') AS \"{p}\"" for p in PERIODS)
    + f" FROM {M} WHERE city_name IS NOT NULL GROUP BY city_name"
)

BAND = """CASE WHEN accommodates_count < 0 THEN NULL WHEN accommodates_count <= 2 THEN '1-2 guests'
  WHEN accommodates_count <= 4 THEN '3-4 guests' WHEN accommodates_count <= 6 THEN '5-6 guests'
  WHEN accommodates_count > 6 THEN '7+ guests' END"""

MEDIAN_BY_BAND = f"""
SELECT accommodates_band, median_nightly_price, {_rank_sql('accommodates_band', BAND_ORDER)} AS display_rank FROM (
  SELECT {BAND} AS accommodates_band, MEDIAN(nightly_price) AS median_nightly_price FROM {M} GROUP BY 1)
WHERE accommodates_band IS NOT NULL AND median_nightly_price IS NOT NULL"""

_EXTREME_BASE = f"""
SELECT city_name, neighbourhood_name, COUNT(listing_id) AS listing_rows, MEDIAN(nightly_price) AS median_nightly_price,
       city_name || CHR(10) || neighbourhood_name AS label
FROM {M} WHERE city_name IS NOT NULL AND neighbourhood_name IS NOT NULL
GROUP BY city_name, neighbourhood_name HAVING COUNT(listing_id) >= 200"""

PRICE_EXTREMES = f"""
SELECT * FROM (SELECT *, 'Top priced' AS segment FROM ({_EXTREME_BASE})
               ORDER BY median_nightly_price DESC NULLS LAST, city_name, neighbourhood_name LIMIT 5)
UNION ALL
SELECT * FROM (SELECT *, 'Lower priced' AS segment FROM ({_EXTREME_BASE})
               ORDER BY median_nightly_price ASC NULLS LAST, city_name, neighbourhood_name LIMIT 5)"""

PRICE_EXTREMES_DISPLAY = f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY median_nightly_price ASC NULLS LAST, city_name, neighbourhood_name, segment) AS display_rank
FROM ({PRICE_EXTREMES})"""

REFERENCE_CARDINALITY = f"""
SELECT city_name, neighbourhood_name, COUNT(*) AS reference_rows
FROM (SELECT DISTINCT city_name, neighbourhood_name, room_type, accommodates_count FROM {M}) GROUP BY 1, 2 HAVING COUNT(*) > 1"""

CLEAN_TEXT = r"""
SELECT doc_id, c AS clean_text, length(c) AS clean_chars FROM (
  SELECT doc_id, NULLIF(trim(nfc_normalize(regexp_replace(text, '[\t-\r\x1c-\x20\x{85}\x{a0}]+', ' ', 'g'))), '') AS c FROM documents)"""

PRICE_HISTOGRAM = f"""
WITH p AS (SELECT CAST(nightly_price AS DOUBLE) AS x FROM {M} WHERE nightly_price IS NOT NULL),
cap AS (SELECT QUANTILE_CONT(x, 0.99) AS cap FROM p),
c AS (SELECT LEAST(x, cap) AS x FROM p, cap),
r0 AS (SELECT MIN(x) AS lo0, MAX(x) AS hi0 FROM c),
r AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
b AS (SELECT LEAST(CAST(FLOOR((x - lo) * (40.0 / (hi - lo))) AS BIGINT), 39) AS b, COUNT(*) AS n FROM c, r GROUP BY 1)
SELECT g.b + 1 AS bin, lo + g.b * ((hi - lo) / 40.0) AS bin_lower, lo + (g.b + 1) * ((hi - lo) / 40.0) AS bin_upper,
       CAST(COALESCE(n, 0) AS BIGINT) AS row_count
FROM r, (SELECT range AS b FROM range(40)) g LEFT JOIN b ON b.b = g.b"""

PRICE_BOXPLOT = f"""
SELECT q[1] AS q1, q[2] AS median, q[3] AS q3,
       GREATEST(mn, q[1] - 1.5 * (q[3] - q[1])) AS lower_whisker, LEAST(mx, q[3] + 1.5 * (q[3] - q[1])) AS upper_whisker
FROM (SELECT QUANTILE_CONT(nightly_price, [0.25, 0.5, 0.75]) AS q, MIN(nightly_price) AS mn, MAX(nightly_price) AS mx
      FROM {M} WHERE nightly_price IS NOT NULL)"""

HEATMAP_SCALE = f"""
SELECT MIN(median_nightly_price) AS min_value, MAX(median_nightly_price) AS max_value
FROM ({median_by(['city_name', 'period_label'])})"""

DATA_PROFILE = f"""
WITH s AS (SELECT COUNT(*) AS row_count, COUNT(DISTINCT listing_id) AS u,
                  QUANTILE_CONT(nightly_price, [0.25, 0.5, 0.75]) AS q, AVG(nightly_price) AS mean FROM {M})
SELECT 'row_count' AS metric, NULL::VARCHAR AS key, CAST(row_count AS DOUBLE) AS value FROM s
UNION ALL SELECT 'unique_listing_count', NULL, CAST(u AS DOUBLE) FROM s
UNION ALL SELECT 'target_median', NULL, q[2] FROM s
UNION ALL SELECT 'target_mean', NULL, mean FROM s
UNION ALL SELECT 'target_q1', NULL, q[1] FROM s
UNION ALL SELECT 'target_q3', NULL, q[3] FROM s
UNION ALL SELECT 'city_count', city_name, CAST(COUNT(*) AS DOUBLE) FROM {M} WHERE city_name IS NOT NULL GROUP BY city_name
UNION ALL SELECT 'period_count', period_label, CAST(COUNT(*) AS DOUBLE) FROM {M} WHERE period_label IS NOT NULL GROUP BY period_label"""

# ------------------------------------------------------------------------------ evaluation
SPLIT = """CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END"""
FM_SPLIT = f"""
SELECT *, {SPLIT} AS split FROM (
  SELECT *, CAST(('0x' || SUBSTR(MD5(CAST(listing_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) / 4294967296.0 AS u
  FROM ({FEATURE_FRAME}))"""

GROUP_SPLIT = f"SELECT listing_id, snapshot_date, split FROM ({FM_SPLIT})"


#: The prior of the ordered target statistics query (any number; SQL and Spark must share it).  Its target is
#: the price in cents: sums of whole numbers are the same in any order.  Means are given in thousandths of a cent.
ORDERED_PRIOR = 10_000_000.0


def _ordered(column: str, name: str) -> tuple[str, str]:
    """(output column, window) of one category's ordered statistic."""
    window = (f"w_{name} AS (PARTITION BY COALESCE(CAST({column} AS VARCHAR), '__missing__') ORDER BY h, listing_id, snapshot_date "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    mean = f"(COALESCE(SUM(ROUND(nightly_price * 100)) OVER w_{name}, 0) + {ORDERED_PRIOR}) / (COUNT(*) OVER w_{name} + 1)"
    return f"CAST(FLOOR({mean} * 1000.0) AS BIGINT) AS {name}_value", window


_ORDERED = [_ordered("room_type", "room_type"), _ordered("neighbourhood_name", "neighbourhood"), _ordered("is_superhost", "superhost")]
ORDERED_STATISTICS = f"""
SELECT listing_id, snapshot_date, {", ".join(c for c, _ in _ORDERED)}
FROM (SELECT *, md5(concat_ws(':', CAST(listing_id AS VARCHAR), CAST(snapshot_date AS VARCHAR), '{RANDOM_STATE}')) AS h
      FROM ({FM_SPLIT}) WHERE split = 'train')
WINDOW {", ".join(w for _, w in _ORDERED)}"""


def predictions(keys: list[str]) -> str:
    """Baseline predictor: train-split median price per group, else the train median."""
    k = ", ".join(keys)
    on = " AND ".join(f"g.{c} = f.{c}" for c in keys)
    return f"""
SELECT f.*, COALESCE(g.pred, (SELECT MEDIAN(nightly_price) FROM ({FM_SPLIT}) WHERE split = 'train')) AS prediction
FROM ({FM_SPLIT}) f LEFT JOIN (SELECT {k}, MEDIAN(nightly_price) AS pred FROM ({FM_SPLIT})
                               WHERE split = 'train' GROUP BY {k}) g ON {on}"""


BASE_KEYS = ["city_name", "room_type"]
SCORED = f"SELECT * FROM ({predictions(BASE_KEYS)}) WHERE split = 'test'"


def metrics_sql(scored: str) -> str:
    return f"""
SELECT AVG(ABS(nightly_price - prediction)) AS mae, SQRT(AVG(POW(nightly_price - prediction, 2))) AS rmse,
       AVG(CASE WHEN nightly_price > 0 THEN ABS(nightly_price - prediction) / nightly_price END) * 100 AS mape,
       COUNT(*) AS row_count FROM ({scored})"""


MODEL_METRICS = metrics_sql(SCORED)


def sliced_sql(scored: str, slices: list[str]) -> str:
    parts = [
        f"SELECT '{s}' AS slice, CAST({s} AS VARCHAR) AS value, AVG(ABS(nightly_price - prediction)) AS mae, "
        f"COUNT(*) AS row_count FROM ({scored}) WHERE {s} IS NOT NULL GROUP BY {s}"
        for s in slices
    ]
    return " UNION ALL ".join(parts)


SLICED_MAE = sliced_sql(SCORED, ["city_name", "period_label", "room_type"])

PRICE_BAND_MAE = f"""
WITH s AS ({SCORED}), e AS (SELECT QUANTILE_CONT(nightly_price, [1/3, 2/3]) AS e FROM s)
SELECT price_band, AVG(ABS(nightly_price - prediction)) AS mae, COUNT(*) AS row_count FROM (
  SELECT s.*, CASE WHEN nightly_price IS NULL THEN NULL WHEN nightly_price <= e[1] THEN 'lower'
                   WHEN nightly_price <= e[2] THEN 'middle' ELSE 'upper' END AS price_band FROM s, e)
WHERE price_band IS NOT NULL GROUP BY price_band"""

CALIBRATION = f"""
WITH s AS (SELECT CAST(nightly_price AS DOUBLE) AS y, CAST(prediction AS DOUBLE) AS p FROM ({SCORED})),
q AS (SELECT QUANTILE_CONT(y - p, [0.09999999999999998, 0.9]) AS q FROM s)
SELECT 'heldout_residual_quantiles' AS source, 0.8 AS confidence_level, q[1] AS lower_residual_quantile,
       q[2] AS upper_residual_quantile, AVG(CASE WHEN y >= p + q[1] AND y <= p + q[2] THEN 1.0 ELSE 0.0 END)
       AS empirical_coverage_rate
FROM s, q GROUP BY q"""

FM_RANGES = benchmark_sql(f"({FEATURE_FRAME})")

BENCHMARK_DIAGNOSTICS = f"""
WITH j AS (
  SELECT r.nightly_price, s.prediction,
    CASE WHEN r.nightly_price < r.benchmark_lower_bound THEN 'underpriced'
         WHEN r.nightly_price > r.benchmark_upper_bound THEN 'overpriced' ELSE 'aligned' END AS observed,
    CASE WHEN s.prediction < r.benchmark_lower_bound THEN 'underpriced'
         WHEN s.prediction > r.benchmark_upper_bound THEN 'overpriced' ELSE 'aligned' END AS predicted
  FROM ({FM_RANGES}) r JOIN ({SCORED}) s USING (listing_id, snapshot_date))
SELECT 'model_prediction_inside_benchmark_rate' AS metric, NULL::VARCHAR AS key,
       AVG(CASE WHEN predicted = 'aligned' THEN 1.0 ELSE 0.0 END) AS value FROM j
UNION ALL SELECT 'model_positioning_agreement_rate', NULL, AVG(CASE WHEN predicted = observed THEN 1.0 ELSE 0.0 END) FROM j
UNION ALL SELECT 'benchmark_positioning_mae', observed, AVG(ABS(nightly_price - prediction)) FROM j GROUP BY observed"""

MODELS = {
    "median_city": ["city_name"],
    "median_city_room": ["city_name", "room_type"],
    "median_city_neighbourhood_room": ["city_name", "neighbourhood_name", "room_type"],
}
BASELINE_MODEL = "median_city"


def _metrics_long() -> str:
    parts = []
    for name, keys in MODELS.items():
        sc = f"SELECT * FROM ({predictions(keys)}) WHERE split = 'test'"
        parts.append(f"SELECT '{name}' AS model, 'overall' AS slice, NULL AS value, AVG(ABS(nightly_price - prediction)) AS mae FROM ({sc})")
        parts.append(f"SELECT '{name}', 'city_name', city_name, AVG(ABS(nightly_price - prediction)) FROM ({sc}) "
                     "WHERE city_name IS NOT NULL GROUP BY city_name")
    return " UNION ALL ".join(parts)


MODEL_METRICS_LONG = _metrics_long()

CHAMPION_CHOICE = f"""
WITH m AS ({MODEL_METRICS_LONG}),
ov AS (SELECT model, mae FROM m WHERE slice = 'overall'),
ct AS (SELECT model, value AS city, mae FROM m WHERE slice = 'city_name'),
bc AS (SELECT city, mae AS bc FROM ct WHERE model = '{BASELINE_MODEL}'),
kept AS (SELECT ct.model, COUNT(*) AS k FROM ct JOIN bc USING (city)
         WHERE ct.model <> '{BASELINE_MODEL}' AND ct.mae <= bc.bc * 1.1 GROUP BY ct.model),
el AS (SELECT ov.model, ov.mae FROM ov LEFT JOIN kept USING (model)
       WHERE ov.model <> '{BASELINE_MODEL}' AND COALESCE(kept.k, 0) = (SELECT COUNT(*) FROM bc)
         AND ov.mae <= (SELECT mae FROM ov WHERE model = '{BASELINE_MODEL}') * 0.95),
w AS (SELECT ARG_MIN(model, (mae, model)) AS w FROM el),
o AS (SELECT ARG_MIN(model, (mae, model)) AS o FROM ov WHERE model <> '{BASELINE_MODEL}')
SELECT COALESCE(w, '{BASELINE_MODEL}') AS champion_model_name,
       CASE WHEN w IS NOT NULL THEN '{BASELINE_MODEL}' ELSE o END AS fallback_model_name FROM w, o"""

# ------------------------------------------------------------------------------- decisions
ESTIMATES = predictions(BASE_KEYS)

MODEL_INTERVAL = f"""
SELECT s.listing_id, s.snapshot_date, CAST(s.prediction AS DOUBLE) AS estimated_market_price,
  GREATEST(0.0, LEAST(s.prediction + c.lower_residual_quantile, s.prediction + c.upper_residual_quantile, s.prediction))
    AS model_estimate_lower_bound,
  GREATEST(s.prediction + c.lower_residual_quantile, s.prediction + c.upper_residual_quantile, s.prediction)
    AS model_estimate_upper_bound,
  c.confidence_level AS model_estimate_interval_confidence_level, c.source AS model_estimate_interval_source
FROM ({SCORED}) s, ({CALIBRATION}) c"""


def agreement_cols(est: str, lo: str, hi: str) -> str:
    inside = f"({lo} <= {est} AND {est} <= {hi})"
    gap = f"(CASE WHEN {inside} THEN 0.0 WHEN {est} < {lo} THEN {lo} - {est} ELSE {est} - {hi} END)"
    ratio = f"(CASE WHEN {inside} THEN 0.0 ELSE {gap} / GREATEST({hi} - {lo}, 1.0) END)"
    label = f"(CASE WHEN {inside} THEN 'strong' WHEN {ratio} <= 0.25 THEN 'medium' ELSE 'weak' END)"
    summary = (f"(CASE WHEN {inside} THEN 'Model estimate sits inside the benchmark range.' ELSE "
               f"'Model estimate is ' || CASE WHEN {label} = 'medium' THEN 'close to' ELSE 'far from' END || "
               f"' the benchmark range and sits ' || CASE WHEN {est} < {lo} THEN 'below' ELSE 'above' END || ' it.' END)")
    return (f"{label} AS model_benchmark_agreement_label, {gap} AS model_benchmark_gap_amount, "
            f"{ratio} AS model_benchmark_gap_ratio, {summary} AS model_benchmark_agreement_summary")


MODEL_AGREEMENT = f"""
SELECT s.listing_id, s.snapshot_date, CAST(s.prediction AS DOUBLE) AS estimated_market_price,
  r.benchmark_lower_bound, r.benchmark_upper_bound,
  {agreement_cols('CAST(s.prediction AS DOUBLE)', 'r.benchmark_lower_bound', 'r.benchmark_upper_bound')}
FROM ({SCORED}) s JOIN ({FM_RANGES}) r USING (listing_id, snapshot_date)"""

REQUESTS = "SELECT c_custkey AS listing_id, CAST(NULL AS DATE) AS snapshot_date FROM customer"

PRICE_DECISIONS = f"""
WITH fm AS ({FEATURE_FRAME}),
latest AS (SELECT listing_id, MAX(snapshot_date) AS latest FROM fm GROUP BY listing_id),
req AS (SELECT q.listing_id AS request_id, q.snapshot_date AS request_date,
               COALESCE(q.snapshot_date, l.latest) AS d FROM ({REQUESTS}) q LEFT JOIN latest l USING (listing_id)),
res AS (SELECT req.request_id, req.request_date, f.listing_id, f.snapshot_date,
               CASE WHEN f.listing_id IS NOT NULL THEN 'found' ELSE 'not_found' END AS status
        FROM req LEFT JOIN fm f ON f.listing_id = req.request_id AND f.snapshot_date = req.d),
rec AS (
  SELECT r.listing_id, r.snapshot_date, r.city_name, r.period_label, CAST(r.nightly_price AS DOUBLE) AS nightly_price,
    'benchmark_range' AS primary_decision_signal, 'benchmark_led_positioning' AS decision_policy,
    'The benchmark range is the primary decision signal. The model price estimate is retained as a supporting signal.'
      AS decision_signal_summary,
    r.benchmark_lower_bound, r.benchmark_upper_bound,
    CASE WHEN r.nightly_price < r.benchmark_lower_bound THEN 'underpriced'
         WHEN r.nightly_price > r.benchmark_upper_bound THEN 'overpriced' ELSE 'aligned' END AS price_positioning_label,
    r.benchmark_source, CAST(e.prediction AS DOUBLE) AS estimated_market_price,
    GREATEST(0.0, LEAST(e.prediction + c.lower_residual_quantile, e.prediction + c.upper_residual_quantile, e.prediction))
      AS model_estimate_lower_bound,
    GREATEST(e.prediction + c.lower_residual_quantile, e.prediction + c.upper_residual_quantile, e.prediction)
      AS model_estimate_upper_bound,
    c.confidence_level AS model_estimate_interval_confidence_level, c.source AS model_estimate_interval_source,
    'supporting_signal' AS model_estimate_role,
    {agreement_cols('CAST(e.prediction AS DOUBLE)', 'r.benchmark_lower_bound', 'r.benchmark_upper_bound')},
    ch.champion_model_name, ch.fallback_model_name, r.fallback_used
  FROM ({FM_RANGES}) r JOIN ({ESTIMATES}) e USING (listing_id, snapshot_date), ({CALIBRATION}) c, ({CHAMPION_CHOICE}) ch)
SELECT res.request_id, res.request_date, res.status, rec.* FROM res
LEFT JOIN rec ON rec.listing_id = res.listing_id AND rec.snapshot_date = res.snapshot_date"""

LISTING_BROWSE = f"""
SELECT * FROM ({MODEL_INPUT}) WHERE city_name = 'EUROPE'
ORDER BY city_name, period_label, listing_id, snapshot_date LIMIT 25"""

SERVING_METADATA = f"""
SELECT COUNT(*) AS row_count, STRING_AGG(DISTINCT city_name, '|' ORDER BY city_name) AS cities,
       STRING_AGG(DISTINCT period_label, '|' ORDER BY period_label) AS periods FROM ({FEATURE_FRAME})"""

# ------------------------------------------------------------------ cleaning and profiling
from peerscope.plans.oracle import MARKET as _MARKET  # noqa: E402

COERCE_TYPES = f"""
SELECT listing_id, NULL::BIGINT AS reviews_last_twelve_months, host_since, is_superhost,
  NULL::BIGINT AS host_listing_count, neighbourhood_name, beds_count, bedrooms_count, room_type, accommodates_count,
  nightly_price, NULL::BIGINT AS total_reviews, rating_score, NULL::DOUBLE AS accuracy_score,
  NULL::DOUBLE AS cleanliness_score, NULL::DOUBLE AS checkin_score, NULL::DOUBLE AS communication_score,
  NULL::DOUBLE AS location_score, NULL::DOUBLE AS value_score, NULL::DOUBLE AS reviews_per_month, city_name,
  period_label, NULL::DOUBLE AS bathrooms_count, NULL::VARCHAR AS bathroom_type, latitude, longitude, snapshot_date
FROM ({_MARKET})"""


def ascii_slug_sql(x: str) -> str:
    s = f"TRIM(REGEXP_REPLACE(LOWER(TRIM({x})), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"(CASE WHEN {x} IS NULL OR {s} = '' THEN 'unknown' ELSE {s} END)"


SLUG = f"""
SELECT p_partkey, {ascii_slug_sql('p_name')} AS name_slug, {ascii_slug_sql('p_brand')} AS brand_slug,
       {ascii_slug_sql('p_type')} AS type_slug FROM part"""

CANONICAL_JSON = "SELECT event_id, CAST(json(props) AS VARCHAR) AS props_json FROM events"

BOUNDARY_IDS = f"""
WITH f AS (SELECT CAST(n_nationkey AS BIGINT) AS raw_feature_index, n_name AS neighbourhood_name FROM nation),
j AS (SELECT f.*, r.city_name, r.neighbourhood_group_name FROM f LEFT JOIN ({REFERENCE}) r USING (neighbourhood_name)),
s AS (SELECT *, CONCAT_WS('_', {ascii_slug_sql('city_name')}, {ascii_slug_sql('neighbourhood_name')},
                 CASE WHEN neighbourhood_group_name IS NOT NULL THEN {ascii_slug_sql('neighbourhood_group_name')} END) AS slug
      FROM j)
SELECT slug || '_' || LPAD(CAST(ROW_NUMBER() OVER (PARTITION BY slug ORDER BY raw_feature_index) AS VARCHAR), 3, '0')
         AS boundary_id, city_name, neighbourhood_name, neighbourhood_group_name,
       NULL::VARCHAR AS geometry_type, NULL::VARCHAR AS geometry
FROM s"""

_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_INT = r"^[+-]?[0-9](_?[0-9])*$"
_FLOAT = (r"^[+-]?(([0-9](_?[0-9])*)?\.[0-9](_?[0-9])*|[0-9](_?[0-9])*\.?)([eE][+-]?[0-9](_?[0-9])*)?$"
          r"|^[+-]?(?i:nan|inf|infinity)$")


def _typ(t: str) -> str:
    return (f"CASE WHEN {t} IS NULL OR {t} = '' THEN 'empty' WHEN REGEXP_MATCHES({t}, '{_INT}') THEN 'integer' "
            f"WHEN REGEXP_MATCHES({t}, '{_FLOAT}') THEN 'float' "
            f"WHEN REGEXP_MATCHES({t}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND TRY_STRPTIME({t}, '%Y-%m-%d') IS NOT NULL "
            f"THEN 'date' ELSE 'string' END")


FIELD_PROFILE = f"""
WITH long AS (
  {" UNION ALL ".join(f"SELECT event_id AS _ord, '{c}' AS field, TRIM(CAST({c} AS VARCHAR)) AS text FROM events" for c in _EVENT_COLS)}),
typed AS (SELECT *, {_typ('text')} AS typ FROM long),
stats AS (SELECT field, COUNT(*) FILTER (WHERE text IS NOT NULL AND text <> '') AS non_empty_count,
                 COUNT(*) FILTER (WHERE text IS NULL OR text = '') AS null_count,
                 BOOL_OR(typ = 'integer') AS i, BOOL_OR(typ = 'float') AS f, BOOL_OR(typ = 'date') AS d,
                 BOOL_OR(typ = 'string') AS s,
                 COUNT(DISTINCT CASE WHEN text <> '' THEN text END) AS n_distinct
          FROM typed GROUP BY field),
firsts AS (SELECT field, text, MIN(_ord) AS first FROM long WHERE text IS NOT NULL AND text <> '' GROUP BY field, text),
samples AS (SELECT field, STRING_AGG(text, '|' ORDER BY first, text) AS sample_values FROM (
              SELECT *, ROW_NUMBER() OVER (PARTITION BY field ORDER BY first, text) AS rk FROM firsts) WHERE rk <= 5
            GROUP BY field),
inf AS (SELECT *, CASE WHEN NOT (i OR f OR d OR s) THEN 'string' WHEN i AND NOT (f OR d OR s) THEN 'integer'
                       WHEN (i OR f) AND NOT (d OR s) THEN 'float' WHEN d AND NOT (i OR f OR s) THEN 'date'
                       ELSE 'string' END AS inferred_type FROM stats)
SELECT field, inferred_type, null_count > 0 AS nullable, non_empty_count, null_count,
       COALESCE(sample_values, '') AS sample_values,
       (inferred_type = 'string' AND n_distinct <= 20) AS likely_categorical,
       n_distinct AS unique_values_observed, n_distinct > 20 AS unique_values_truncated
FROM inf LEFT JOIN samples USING (field)"""

CANDIDATE_KEYS = """
SELECT 'event_id' AS columns, COUNT(*) - COUNT(DISTINCT COALESCE(TRIM(CAST(event_id AS VARCHAR)), '')) AS duplicate_key_count,
       COUNT(*) - COUNT(DISTINCT COALESCE(TRIM(CAST(event_id AS VARCHAR)), '')) = 0 AS is_unique FROM events
UNION ALL
SELECT 'user_id,event_type', COUNT(*) - COUNT(DISTINCT ROW(COALESCE(TRIM(CAST(user_id AS VARCHAR)), ''),
       COALESCE(TRIM(event_type), ''))), COUNT(*) - COUNT(DISTINCT ROW(COALESCE(TRIM(CAST(user_id AS VARCHAR)), ''),
       COALESCE(TRIM(event_type), ''))) = 0 FROM events"""

COVERAGE = f"""
SELECT STRING_AGG(DISTINCT city_name, '|' ORDER BY city_name) AS cities,
       STRING_AGG(DISTINCT period_label, '|' ORDER BY period_label) AS periods,
       STRING_AGG(DISTINCT CAST(snapshot_date AS VARCHAR), '|' ORDER BY CAST(snapshot_date AS VARCHAR)) AS snapshot_dates
FROM ({_MARKET})"""

# ------------------------------------------------------------------------------- validation
RAW_MARKET = _MARKET.replace(") WHERE rn = 1", ")")
_CITIES = "('Firenze', 'Milano', 'Napoli', 'Roma', 'Venezia')"
_PERIODS = "('Early Spring', 'Early Summer', 'Early Autumn', 'Early Winter')"


def _label_finding(dataset: str, source: str, column: str, vocab: str, check: str, what: str) -> str:
    bad = f"STRING_AGG(DISTINCT {column}, ', ' ORDER BY {column}) FILTER (WHERE {column} NOT IN {vocab})"
    return (f"SELECT '{dataset}' AS dataset, '{check}' AS check_name, 'error' AS severity, "
            f"'Unexpected {what} found: ' || b || '.' AS message FROM (SELECT {bad} AS b FROM ({source})) WHERE b IS NOT NULL")


def _null_finding(dataset: str, source: str, column: str) -> str:
    return (f"SELECT '{dataset}', 'non_nullable_fields', 'error', 'Field `{column}` contains `' || CAST(n AS VARCHAR) || "
            f"'` null values but is non-nullable.' FROM (SELECT COUNT(*) FILTER (WHERE {column} IS NULL) AS n "
            f"FROM ({source})) WHERE n > 0")


def _pk_finding(dataset: str, source: str, pk: list[str]) -> str:
    k = ", ".join(pk)
    return (f"SELECT '{dataset}', 'primary_key_uniqueness', 'error', 'Primary key `{k}` contains `' || CAST(d AS VARCHAR) "
            f"|| '` duplicate rows.' FROM (SELECT COALESCE(SUM(n - 1), 0) AS d FROM (SELECT COUNT(*) AS n FROM ({source}) "
            f"GROUP BY {k})) WHERE d > 0")


def validation_sql(missing_city_columns: list[str], missing_neighbourhood_columns: list[str]) -> str:
    listing = RAW_MARKET
    counts = f"SELECT (SELECT COUNT(*) FROM ({_MARKET})) AS m, (SELECT COUNT(*) FROM ({listing})) AS n"
    parts = [
        "SELECT 'listing_snapshot', 'manifest_dataset_name', 'error', "
        "'Manifest dataset_name is `listing_export` instead of `listing_snapshot`.'",
        "SELECT 'listing_snapshot', 'manifest_row_count', 'error', 'Manifest row_count is `' || CAST(m AS VARCHAR) || "
        f"'` but dataset has `' || CAST(n AS VARCHAR) || '` rows.' FROM ({counts}) WHERE m <> n",
        "SELECT 'listing_snapshot', 'manifest_columns', 'error', "
        "'Manifest column list does not match the actual dataset columns.'",
        *[_null_finding("listing_snapshot", listing, c) for c in ("listing_id", "city_name", "period_label", "snapshot_date")],
        _pk_finding("listing_snapshot", listing, ["listing_id", "snapshot_date"]),
        _label_finding("listing_snapshot", listing, "city_name", _CITIES, "canonical_city_labels", "city labels"),
        _label_finding("listing_snapshot", listing, "period_label", _PERIODS, "canonical_period_labels", "period labels"),
        f"SELECT 'listing_snapshot', 'positive_nightly_price', 'error', '`nightly_price` contains `' || CAST(n AS VARCHAR) "
        f"|| '` non-positive values.' FROM (SELECT COUNT(*) FILTER (WHERE nightly_price <= 0) AS n FROM ({listing})) WHERE n > 0",
        f"SELECT 'listing_snapshot', 'coordinate_bounds', 'error', '`latitude` or `longitude` is out of bounds in `' || "
        f"CAST(n AS VARCHAR) || '` rows.' FROM (SELECT COUNT(*) FILTER (WHERE latitude < -90 OR latitude > 90 OR "
        f"longitude < -180 OR longitude > 180) AS n FROM ({listing})) WHERE n > 0",
        f"SELECT 'listing_snapshot', 'rating_bounds', 'error', '`rating_score` is outside the expected range [0, 5] in `' "
        f"|| CAST(n AS VARCHAR) || '` rows.' FROM (SELECT COUNT(*) FILTER (WHERE rating_score < 0 OR rating_score > 5) AS n "
        f"FROM ({listing})) WHERE n > 0",
        *[f"SELECT '{name}', 'missing_contract_columns', 'error', 'Missing required columns: {', '.join(missing)}.'"
          for name, missing in (("city_period_summary", missing_city_columns),
                                ("neighbourhood_period_summary", missing_neighbourhood_columns))],
        *[_label_finding(name, f"SELECT DISTINCT city_name, period_label FROM ({_MARKET})", column, labels,
                         f"canonical_{kind}_labels", f"{kind} labels")
          for name in ("city_period_summary", "neighbourhood_period_summary")
          for column, labels, kind in (("city_name", _CITIES, "city"), ("period_label", _PERIODS, "period"))],
        _null_finding("neighbourhood_boundary", "SELECT NULL::VARCHAR AS geometry_type FROM nation", "geometry_type"),
        _null_finding("neighbourhood_boundary", "SELECT NULL::VARCHAR AS geometry FROM nation", "geometry"),
        _label_finding("neighbourhood_boundary", f"SELECT city_name FROM nation n LEFT JOIN ({REFERENCE}) r "
                       f"ON r.neighbourhood_name = n.n_name", "city_name", _CITIES, "canonical_city_labels", "city labels"),
    ]
    body = " UNION ALL ".join(f"({p})" for p in parts)
    return f"SELECT * FROM ({body}) AS t(dataset, check_name, severity, message)"


def validation_status_sql(findings: str, datasets: list[str]) -> str:
    names = ", ".join(f"('{n}')" for n in datasets)
    return f"""
WITH f AS ({findings}), c AS (
  SELECT d.dataset, COUNT(f.dataset) AS findings FROM (VALUES {names}) AS d(dataset) LEFT JOIN f ON f.dataset = d.dataset GROUP BY 1
  UNION ALL SELECT 'overall', COUNT(*) FROM f)
SELECT dataset, CASE WHEN findings > 0 THEN 'failed' ELSE 'passed' END AS status, findings FROM c"""


_LOCATION = ("latitude", "longitude", "distance_to_city_center_km", "distance_to_neighbourhood_center_km")
_FLAGS = {"is_superhost": "superhost_status", "season_peak_flag": "peak_season", "season_shoulder_flag": "shoulder_season"}


def local_explanation_sql(terms: list[tuple]) -> str:
    """EXP1 + TOP3 over the feature frame for a fixed table of (column, category, coef, center, scale, fill)."""
    sums: dict[str, list[str]] = {}
    for column, category, coef, center, scale, fill in terms:
        if category is None:
            name = "location" if column in _LOCATION else column
            text = f"(COALESCE(CAST({column} AS DOUBLE), {fill}::DOUBLE) - {center}::DOUBLE) / {scale}::DOUBLE * {coef}::DOUBLE"
        elif column in _FLAGS and category != "true":
            continue
        else:
            name = _FLAGS.get(column, f"{column}={category}")
            text = f"CASE WHEN COALESCE(CAST({column} AS VARCHAR), '{fill}') = '{category}' THEN {coef}::DOUBLE ELSE 0 END"
        sums.setdefault(name, []).append(text)
    items = ", ".join(
        f"{{'feature': '{name}', 'contribution': {' + '.join(values)}}}" for name, values in sorted(sums.items())
    )
    return f"""
SELECT listing_id, snapshot_date, direction, CAST(rank AS INT) AS rank, feature, contribution FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY listing_id, snapshot_date, direction ORDER BY ABS(contribution) DESC, feature) AS rank
  FROM (SELECT listing_id, snapshot_date, d.feature AS feature, d.contribution AS contribution,
               CASE WHEN d.contribution > 0 THEN 'upward' ELSE 'downward' END AS direction
        FROM (SELECT listing_id, snapshot_date, UNNEST([{items}]) AS d FROM ({FEATURE_FRAME}))
        WHERE d.contribution <> 0))
WHERE rank <= 3"""


def decision_payload_sql(terms: list[tuple]) -> str:
    """The nested decision record, flattened (latest snapshot of each listing)."""
    return f"""
WITH fm AS ({FEATURE_FRAME}),
t AS (SELECT listing_id, MAX(snapshot_date) AS snapshot_date FROM fm GROUP BY listing_id),
c AS ({comparables_sql(f"({FEATURE_FRAME})")}),
near AS (
  SELECT target_listing_id, target_snapshot_date, MEDIAN(nightly_price) AS med,
    STRING_AGG(CAST(listing_id AS VARCHAR) || '@' || CAST(snapshot_date AS VARCHAR), '|' ORDER BY comparable_rank) AS ids
  FROM c GROUP BY ALL
),
x AS ({local_explanation_sql(terms)}),
drivers AS (
  SELECT listing_id, snapshot_date, STRING_AGG(feature, '|' ORDER BY rank) FILTER (direction = 'upward') AS up,
    STRING_AGG(feature, '|' ORDER BY rank) FILTER (direction = 'downward') AS down
  FROM x GROUP BY ALL
)
SELECT fm.listing_id, fm.snapshot_date, COALESCE(ids, '') AS comparables, COALESCE(up, '') AS upward_drivers,
  COALESCE(down, '') AS downward_drivers, COALESCE(med, fm.nightly_price) AS comparable_median_price,
  'linear_baseline' AS source_model_name, FALSE AS has_nan, TRUE AS in_json
FROM t JOIN fm USING (listing_id, snapshot_date)
LEFT JOIN near ON target_listing_id = fm.listing_id AND target_snapshot_date = fm.snapshot_date
LEFT JOIN drivers d ON d.listing_id = fm.listing_id AND d.snapshot_date = fm.snapshot_date"""
