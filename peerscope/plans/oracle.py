"""DuckDB-runnable SQL equivalents of the registered queries (the correctness oracle).

Every statement reads the driver's base tables only.  Computed doubles are rounded to
6 decimals on both sides (trigonometry differs in the last bits between engines).
"""

from __future__ import annotations

# The listing-role binding of the TPC-H-like tables (same text as peerscope.sources.testdata).
MARKET = """
SELECT * EXCLUDE (rn) FROM (
  SELECT o.o_custkey AS listing_id, CAST(o.o_orderdate AS DATE) AS snapshot_date, o.o_orderkey AS row_key,
    r.r_name AS city_name, n.n_name AS neighbourhood_name,
    CASE QUARTER(o.o_orderdate) WHEN 1 THEN 'Early Spring' WHEN 2 THEN 'Early Summer'
         WHEN 3 THEN 'Early Autumn' ELSE 'Early Winter' END AS period_label,
    CONCAT(CAST(YEAR(o.o_orderdate) AS VARCHAR), '-Q', CAST(QUARTER(o.o_orderdate) AS VARCHAR)) AS fine_period_label,
    c.c_mktsegment AS room_type, o.o_totalprice AS nightly_price,
    li.n_lines AS accommodates_count, CAST(FLOOR(li.qty / 50) AS BIGINT) AS beds_count,
    li.n_status AS bedrooms_count,
    (c.c_acctbal + 1000) / 2200 AS rating_score, c.c_acctbal > 5000 AS is_superhost,
    CAST(o.o_custkey % 3600 AS DOUBLE) / 10000 + 45 AS latitude,
    CAST((o.o_custkey * 7) % 3600 AS DOUBLE) / 10000 + 9 AS longitude,
    DATE '1994-06-01' + CAST(o.o_custkey % 1500 AS INTEGER) AS host_since,
    ROW_NUMBER() OVER (PARTITION BY o.o_custkey, CAST(o.o_orderdate AS DATE) ORDER BY o.o_orderkey) AS rn
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines, COUNT(DISTINCT l_linestatus) AS n_status,
                    SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) li
    ON li.l_orderkey = o.o_orderkey
) WHERE rn = 1
"""

SPARSE_MARKET = f"""
SELECT * REPLACE (STRFTIME(snapshot_date, '%Y-%m') AS period_label) FROM ({MARKET})
"""


def _clos(a: str, b: str, tol: float) -> str:
    g = f"(ABS(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE)) / {tol})"
    return f"(1.0 - CASE WHEN {g} > 1.0 THEN 1.0 ELSE {g} END)"


def haversine(t: str, c: str) -> str:
    h = (
        f"(POW(SIN((RADIANS({c}.latitude) - RADIANS({t}.latitude)) / 2), 2) + COS(RADIANS({t}.latitude)) * "
        f"COS(RADIANS({c}.latitude)) * POW(SIN((RADIANS({c}.longitude) - RADIANS({t}.longitude)) / 2), 2))"
    )
    return f"(6371.0088 * (2 * ASIN(SQRT(CASE WHEN {h} > 1.0 THEN 1.0 ELSE {h} END))))"


def score(t: str, c: str, local: str) -> str:
    return (
        f"(2.0 + CASE WHEN {local} THEN 3.0 ELSE 0.0 END"
        f" + 2.0 * {_clos(f'{t}.accommodates_count', f'{c}.accommodates_count', 2.0)}"
        f" + 1.0 * {_clos(f'{t}.beds_count', f'{c}.beds_count', 2.0)}"
        f" + 1.0 * {_clos(f'{t}.bedrooms_count', f'{c}.bedrooms_count', 2.0)}"
        f" + 0.75 * {_clos(f'{t}.rating_score', f'{c}.rating_score', 10.0)}"
        f" + 1.25 * EXP(-{haversine(t, c)} / 3.0))"
    )


def comparables_sql(market: str, top_n: int = 10, min_local_pool: int = 5) -> str:
    """All-pairs form of the comparable search (brute force; fine at the oracle scale)."""
    required = min(top_n, min_local_pool)
    return f"""
WITH m AS ({market}),
loc AS (SELECT city_name, period_label, room_type, neighbourhood_name, COUNT(*) AS local_n
        FROM m WHERE neighbourhood_name IS NOT NULL GROUP BY ALL),
t AS (SELECT m.*, COALESCE(loc.local_n - 1, 0) >= {required} AS is_local
      FROM m LEFT JOIN loc USING (city_name, period_label, room_type, neighbourhood_name)),
pairs AS (
  SELECT t.listing_id AS target_listing_id, t.snapshot_date AS target_snapshot_date,
         c.listing_id, c.snapshot_date, c.city_name, c.neighbourhood_name, c.room_type, c.nightly_price,
         {haversine('t', 'c')} AS distance_km, {score('t', 'c', 't.is_local')} AS similarity_score,
         NOT t.is_local AS used_city_fallback
  FROM t JOIN m c ON c.city_name = t.city_name AND c.period_label = t.period_label
       AND c.room_type = t.room_type AND (NOT t.is_local OR c.neighbourhood_name = t.neighbourhood_name)
  WHERE NOT (c.listing_id = t.listing_id AND c.snapshot_date = t.snapshot_date)),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY target_listing_id, target_snapshot_date
    ORDER BY similarity_score DESC NULLS LAST, nightly_price ASC NULLS LAST, listing_id, snapshot_date)
    AS comparable_rank FROM pairs)
SELECT * FROM ranked WHERE comparable_rank <= {top_n}
"""


def _med_mad_sql(market: str, keys: list[str], metrics: list[str], left_out: str = "FALSE") -> str:
    k = ", ".join(keys)
    meds = ", ".join(f"MEDIAN(CAST({m} AS DOUBLE)) AS {m}_median" for m in metrics)
    mads = ", ".join(
        f"MEDIAN(ABS(CAST(x.{m} AS DOUBLE) - y.{m}_median)) AS {m}_median_abs_deviation" for m in metrics
    )
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"""
  SELECT * FROM (SELECT {k}, {meds}, COUNT(*) AS _rows FROM ({market}) WHERE {nn} GROUP BY {k}) y
  JOIN (SELECT {", ".join("x." + c for c in keys)}, {mads}
        FROM ({market}) x JOIN (SELECT {k}, {meds} FROM ({market}) WHERE {nn} GROUP BY {k}) y USING ({k})
        GROUP BY {", ".join("x." + c for c in keys)}) z USING ({k})
  WHERE NOT ({left_out})"""


def _dominant_sql(market: str, keys: list[str], column: str, prefix: str) -> str:
    k = ", ".join(keys)
    return f"""
  SELECT {k}, FIRST({column} ORDER BY _n DESC, {column} ASC) AS dominant_{prefix},
         -SUM(_p * LN(_p)) AS {prefix}_entropy
  FROM (SELECT *, _n / SUM(_n) OVER (PARTITION BY {k}) AS _p
        FROM (SELECT {k}, {column}, COUNT(*) AS _n FROM ({market}) WHERE {column} IS NOT NULL GROUP BY {k}, {column}))
  GROUP BY {k}"""


def med_mad_sql(market: str, keys: list[str], metrics: list[str]) -> str:
    return f"SELECT * EXCLUDE (_rows) FROM ({_med_mad_sql(market, keys, metrics)})"


SUMMARY_METRICS_BOUND = ["accommodates_count", "nightly_price", "rating_score", "latitude", "longitude"]


def _stat_cols(metrics: list[str]) -> list[str]:
    out = []
    for m in metrics:
        out += [f"{m}_median", f"{m}_median_abs_deviation"]
    return out


def city_summary_sql(market: str, left_out: str = "FALSE", metrics: list[str] = SUMMARY_METRICS_BOUND) -> str:
    keys = ["city_name", "period_label"]
    cols = ", ".join(_stat_cols(metrics))
    return f"""
SELECT city_name, period_label, dominant_neighbourhood, neighbourhood_entropy, dominant_room_type,
       room_type_entropy, {cols}
FROM ({_med_mad_sql(market, keys, metrics, left_out)}) s
LEFT JOIN ({_dominant_sql(market, keys, 'neighbourhood_name', 'neighbourhood')}) USING (city_name, period_label)
LEFT JOIN ({_dominant_sql(market, keys, 'room_type', 'room_type')}) USING (city_name, period_label)"""


def neighbourhood_summary_sql(market: str, left_out: str = "FALSE", metrics: list[str] = SUMMARY_METRICS_BOUND) -> str:
    keys = ["city_name", "neighbourhood_name", "period_label"]
    cols = ", ".join(_stat_cols(metrics))
    return f"""
SELECT city_name, neighbourhood_name, period_label, dominant_room_type, room_type_entropy, {cols}
FROM ({_med_mad_sql(market, keys, metrics, left_out)}) s
LEFT JOIN ({_dominant_sql(market, keys, 'room_type', 'room_type')}) USING (city_name, neighbourhood_name, period_label)"""


def _mad_bounds_sql(med: str, mad: str) -> tuple[str, str]:
    return (f"GREATEST({med} - 1.4826 * {mad}, 1.0)", f"GREATEST({med} + 1.4826 * {mad}, {med})")


def benchmark_sql(market: str, top_n: int = 10, nb_left_out: str = "FALSE", ct_left_out: str = "FALSE",
                  with_label: bool = False) -> str:
    mad_lo, mad_hi = _mad_bounds_sql("a.med", "d.mad")
    nb_lo, nb_hi = _mad_bounds_sql("nb.nightly_price_median", "nb.nightly_price_median_abs_deviation")
    ct_lo, ct_hi = _mad_bounds_sql("ct.nightly_price_median", "ct.nightly_price_median_abs_deviation")
    rung = f"""CASE WHEN COALESCE(a.n, 0) >= 15 THEN 1 WHEN COALESCE(a.n, 0) >= 5 THEN 2
      WHEN nb.nightly_price_median IS NOT NULL THEN 3 WHEN ct.nightly_price_median IS NOT NULL THEN 4 ELSE 5 END"""
    body = f"""
WITH comps AS ({comparables_sql(market, top_n)}),
a AS (SELECT target_listing_id, target_snapshot_date, COUNT(*) AS n,
             QUANTILE_CONT(nightly_price, 0.25) AS q1, QUANTILE_CONT(nightly_price, 0.75) AS q3,
             MEDIAN(nightly_price) AS med FROM comps GROUP BY ALL),
d AS (SELECT c.target_listing_id, c.target_snapshot_date, MEDIAN(ABS(c.nightly_price - a.med)) AS mad
      FROM comps c JOIN a USING (target_listing_id, target_snapshot_date) GROUP BY ALL),
r AS (
  SELECT m.listing_id, m.snapshot_date, m.city_name, m.neighbourhood_name, m.period_label, m.nightly_price,
    {rung} AS rung, a.q1, a.q3, COALESCE(a.n, 0) AS n,
    {mad_lo} AS mad_lo, {mad_hi} AS mad_hi, {nb_lo} AS nb_lo, {nb_hi} AS nb_hi, {ct_lo} AS ct_lo, {ct_hi} AS ct_hi
  FROM ({market}) m
  LEFT JOIN a ON a.target_listing_id = m.listing_id AND a.target_snapshot_date = m.snapshot_date
  LEFT JOIN d ON d.target_listing_id = m.listing_id AND d.target_snapshot_date = m.snapshot_date
  LEFT JOIN ({neighbourhood_summary_sql(market, nb_left_out)}) nb
    ON nb.city_name = m.city_name AND nb.neighbourhood_name = m.neighbourhood_name AND nb.period_label = m.period_label
  LEFT JOIN ({city_summary_sql(market, ct_left_out)}) ct
    ON ct.city_name = m.city_name AND ct.period_label = m.period_label)
SELECT listing_id, snapshot_date, city_name, neighbourhood_name, period_label, nightly_price,
  CASE rung WHEN 1 THEN GREATEST(q1, 1.0) WHEN 2 THEN mad_lo WHEN 3 THEN nb_lo WHEN 4 THEN ct_lo
       ELSE GREATEST(nightly_price * 0.9, 1.0) END AS benchmark_lower_bound,
  CASE rung WHEN 1 THEN GREATEST(q3, q1) WHEN 2 THEN mad_hi WHEN 3 THEN nb_hi WHEN 4 THEN ct_hi
       ELSE nightly_price * 1.1 END AS benchmark_upper_bound,
  CASE rung WHEN 1 THEN 'comparable_iqr' WHEN 2 THEN 'comparable_mad' WHEN 3 THEN 'neighbourhood_period_summary'
       WHEN 4 THEN 'city_period_summary' ELSE 'listing_price_fallback' END AS benchmark_source,
  CAST(CASE WHEN rung IN (3, 4) THEN 0 ELSE n END AS BIGINT) AS comparable_count,
  rung >= 3 AS fallback_used
FROM r"""
    if not with_label:
        return body
    return f"""
SELECT *, CASE WHEN nightly_price < benchmark_lower_bound THEN 'underpriced'
               WHEN nightly_price > benchmark_upper_bound THEN 'overpriced' ELSE 'aligned' END
          AS price_positioning_label
FROM ({body})"""


def rounded(sql: str, columns: list[str], digits: int = 6) -> str:
    """Wrap ``sql`` so the listed double columns are rounded (as the Spark side does)."""
    if not columns:
        return sql
    rep = ", ".join(f"ROUND(\"{c}\", {digits}) AS \"{c}\"" for c in columns)
    return f"SELECT * REPLACE ({rep}) FROM ({sql})"
