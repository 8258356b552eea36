"""DuckDB SQL for every SQL-checkable query in ``clickseg.plans.catalog``.

Each text starts from the driver tables (``events``, ``part``), rebuilds the
adapter rows and runs the same chain of steps as the Spark operators, so a
match checks the whole chain.  Conventions for equal values in both engines:
computed columns are cast on both sides (Spark ``datediff`` is INT, DuckDB
``date_diff`` BIGINT; DuckDB sums integers to HUGEINT), money is summed as
DECIMAL(38,18), averages and other floating results are rounded to 6 places,
and timestamps are formatted as text.
"""

from __future__ import annotations

from clickseg.plans import logqueries
from clickseg.plans.params import CHECK_SALT, SEGMENTS

TS_FMT = "'%Y-%m-%d %H:%M:%S.%f'"

ADAPTER_SQL = """
base AS (
  SELECT event_id, ts, user_id AS uid, value AS v,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart' ELSE event_type END AS et
  FROM events),
j AS (SELECT b.*, p.p_brand, p.p_type, p.p_name FROM base b LEFT JOIN part p ON p.p_partkey = b.k),
one AS (
  SELECT event_id,
    CASE WHEN CAST(ts AS DATE) < DATE '2024-01-11' THEN '2024-01-a'
         WHEN CAST(ts AS DATE) < DATE '2024-01-21' THEN '2024-01-b' ELSE '2024-01-c' END AS source_file,
    ts AS event_time,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '  ' || upper(et) || ' ' ELSE et END AS event_type,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE k END AS product_id,
    k % 10 AS category_id,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 5 = 0 THEN lower(p_type)
         ELSE lower(p_type) || '.' || replace(p_name, ' ', '.') END AS category_code,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE ' ' || upper(p_brand) END AS brand,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN -v ELSE v END AS price,
    uid AS user_id,
    CASE WHEN event_id % 17 = 0 THEN NULL
         ELSE 's' || CAST(uid AS VARCHAR(20)) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR(10)) END AS user_session
  FROM j),
raw AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE event_id % 50 = 0)"""

CLEAN_SQL = f"""
p1 AS (SELECT * FROM raw
       WHERE event_time IS NOT NULL AND event_type IS NOT NULL AND product_id IS NOT NULL
         AND user_id IS NOT NULL AND price IS NOT NULL AND NOT isnan(price)),
p2 AS (SELECT * FROM (SELECT * REPLACE (coalesce(lower(trim(event_type)), '') AS event_type) FROM p1)
       WHERE event_type IN ('view', 'cart', 'purchase', 'remove_from_cart')),
p3 AS (SELECT * REPLACE (CASE WHEN price IS NULL OR price <= 0 THEN CAST(0 AS DOUBLE)
                              ELSE CAST(price AS DOUBLE) END AS price) FROM p2),
p4 AS (SELECT * REPLACE (coalesce(trim(lower(brand)), 'unknown') AS brand) FROM p3),
p5 AS (SELECT *,
         coalesce(string_split(category_code, '.')[1], 'unknown') AS category_level_1,
         coalesce(string_split(category_code, '.')[2], 'unknown') AS category_level_2,
         coalesce(string_split(category_code, '.')[3], 'unknown') AS category_level_3
       FROM p4),
p6 AS (SELECT * REPLACE (coalesce(brand, 'unknown') AS brand,
                         coalesce(category_code, 'unknown') AS category_code,
                         coalesce(user_session, 'unknown') AS user_session) FROM p5),
bounds AS (
  SELECT source_file, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
  FROM (SELECT source_file, quantile_disc(price, 0.25) AS q1, quantile_disc(price, 0.75) AS q3
        FROM p6 WHERE price IS NOT NULL AND price >= 0 GROUP BY source_file)),
p7 AS (SELECT p6.* FROM p6 JOIN bounds b ON p6.source_file = b.source_file
       WHERE p6.price IS NOT NULL AND p6.price >= 0
         AND p6.price >= b.lower_bound AND p6.price <= b.upper_bound),
d1 AS (SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY source_file, event_time, event_type, product_id, user_id, user_session
                                      ORDER BY event_id) AS rn FROM p7) WHERE rn = 1),
p8 AS (SELECT * REPLACE (sha256(CAST(user_id AS VARCHAR) || '{CHECK_SALT}') AS user_id,
                         sha256(user_session || '{CHECK_SALT}') AS user_session) FROM d1)"""

FEATURES_SQL = """
pu AS (
  SELECT user_id,
         count(*) AS events,
         count_if(event_type = 'view') AS views,
         count_if(event_type = 'cart') AS carts,
         count_if(event_type = 'purchase') AS purchases,
         coalesce(CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(CAST(price AS VARCHAR) AS DECIMAL(38,18)) END) AS DOUBLE), 0) AS monetary,
         max(CASE WHEN event_type = 'purchase' THEN event_time END) AS last_purchase,
         count(DISTINCT CASE WHEN event_type = 'purchase' THEN product_id END) AS unique_products
  FROM p8 GROUP BY user_id),
refd AS (SELECT CAST(max(last_purchase) AS DATE) AS ref FROM pu),
feat AS (
  SELECT user_id,
         CAST(date_diff('day', CAST(last_purchase AS DATE), ref) AS INTEGER) AS recency,
         CAST(purchases AS BIGINT) AS frequency,
         CAST(monetary AS DOUBLE) AS monetary,
         CAST(unique_products AS BIGINT) AS unique_products,
         CAST(views AS BIGINT) AS views,
         CAST(carts AS BIGINT) AS carts,
         CAST(purchases AS BIGINT) AS purchases,
         purchases / events AS conversion_rate
  FROM pu, refd WHERE purchases > 0)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


ROW_COLS = ("source_file, event_id, strftime(event_time, " + TS_FMT + ") AS event_time, event_type, "
            "product_id, category_id, category_code, brand, price, user_id, user_session")
LEVEL_COLS = ", category_level_1, category_level_2, category_level_3"


def _rows(stage: str, levels: bool) -> str:
    return (_with(ADAPTER_SQL, CLEAN_SQL)
            + f"SELECT {ROW_COLS}{LEVEL_COLS if levels else ''} FROM {stage}")


def cleaning_sql() -> dict[str, str]:
    return {
        "parquet_scan": _rows("raw", False),
        "drop_invalid_rows": _rows("p1", False),
        "clean_event_types": _rows("p2", False),
        "clean_prices": _rows("p3", False),
        "clean_brands": _rows("p4", False),
        "split_categories": _rows("p5", True),
        "fill_unknown": _rows("p6", True),
        "remove_outliers": _rows("p7", True),
        "drop_duplicates": _rows("d1", True),
        "pseudonymize": _rows("p8", True),
        "clean_events": _rows("p8", True),
        "purchase_filter": (_with(ADAPTER_SQL, CLEAN_SQL)
                            + f"SELECT {ROW_COLS}{LEVEL_COLS} FROM p8 WHERE event_type = 'purchase'"),
        "price_quartiles": (_with(ADAPTER_SQL, CLEAN_SQL)
                            + "SELECT source_file, q1, q3, lower_bound, upper_bound FROM bounds"),
        "price_quartile_sketches": (_with(ADAPTER_SQL, CLEAN_SQL)
                                    + "SELECT coalesce(source_file, 'all') AS source_file, count(*) AS n_values, "
                                    + "true AS q1_within, true AS q3_within FROM p6 WHERE price >= 0 "
                                    + "GROUP BY GROUPING SETS ((source_file), ())"),
        "distinct_users": _with(ADAPTER_SQL, CLEAN_SQL) + "SELECT DISTINCT user_id FROM p8",
        # The last month's frame lacks ``brand``: NULL after the union by name.
        "union_by_name": (_with(ADAPTER_SQL, CLEAN_SQL)
                          + f"SELECT * REPLACE (CASE WHEN source_file = '2024-01-c' THEN NULL "
                            f"ELSE brand END AS brand) FROM (SELECT {ROW_COLS}{LEVEL_COLS} FROM p8)"),
    }


def features_sql() -> dict[str, str]:
    w = _with(ADAPTER_SQL, CLEAN_SQL, FEATURES_SQL)
    return {
        "features": w + "SELECT * FROM feat",
        "features_from_state": w + "SELECT * FROM feat",
        "rfm": w + "SELECT user_id, recency, frequency, monetary, unique_products FROM feat",
        "reference_date": (w + "SELECT strftime(max(event_time), " + TS_FMT + ") AS reference_time "
                           "FROM p8 WHERE event_type = 'purchase'"),
        "rfm_no_purchases": (w + "SELECT DISTINCT user_id, CAST(NULL AS INTEGER) AS recency, "
                             "CAST(0 AS BIGINT) AS frequency, CAST(0 AS DOUBLE) AS monetary, "
                             "CAST(0 AS BIGINT) AS unique_products FROM p8 WHERE event_type <> 'purchase'"),
        "behavior": (w + "SELECT user_id, CAST(views AS BIGINT) AS views, CAST(carts AS BIGINT) AS carts, "
                     "CAST(purchases AS BIGINT) AS purchases, purchases / events AS conversion_rate FROM pu"),
    }


RAW_COLUMNS = ["event_time", "event_type", "product_id", "category_id", "category_code", "brand",
               "price", "user_id", "user_session"]
CLEAN_COLUMNS = RAW_COLUMNS + ["category_level_1", "category_level_2", "category_level_3"]
NUMERIC_RAW = ["product_id", "category_id", "price", "user_id"]


def _completeness(table: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) - count({c}) AS null_count, "
             f"CASE WHEN count(*) > 0 THEN CAST(count({c}) AS DOUBLE) / count(*) * 100 "
             f"ELSE CAST(0 AS DOUBLE) END AS completeness_pct FROM {table}" for c in cols]
    return " UNION ALL ".join(parts)


def _distribution(table: str) -> str:
    return (f"SELECT event_type, count(*) AS n_events, "
            f"CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS percent "
            f"FROM {table} GROUP BY event_type")


def _metrics(table: str, cols: list[str]) -> str:
    return (f"SELECT column_name || '_completeness' AS metric, completeness_pct AS value "
            f"FROM ({_completeness(table, cols)}) "
            f"UNION ALL SELECT 'event_type_' || coalesce(event_type, 'None') || '_percent' AS metric, "
            f"percent AS value FROM ({_distribution(table)})")


def quality_sql() -> dict[str, str]:
    w = _with(ADAPTER_SQL, CLEAN_SQL)
    describe = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
        f"round(CAST(max({c}) AS DOUBLE), 6) AS max FROM raw" for c in NUMERIC_RAW)
    compare = (f"SELECT a.metric, coalesce(b.value, 0) AS before, a.value AS after "
               f"FROM ({_metrics('p8', CLEAN_COLUMNS)}) a LEFT JOIN ({_metrics('raw', RAW_COLUMNS)}) b "
               f"ON a.metric = b.metric")
    steps = [("initial", "raw"), ("drop_invalid_rows", "p1"), ("clean_event_types", "p2"),
             ("remove_outliers", "p7"), ("drop_duplicates", "d1"), ("final", "p8")]
    counts = " UNION ALL ".join(
        f"SELECT {i} AS step_no, '{name}' AS step, (SELECT count(*) FROM {t}) AS n_rows"
        for i, (name, t) in enumerate(steps))
    return {
        "row_counts": (w + f"SELECT step_no, step, n_rows, CAST(n_rows AS DOUBLE) / "
                       f"(SELECT count(*) FROM raw) * 100 AS retention_pct FROM ({counts})"),
        "completeness": w + _completeness("raw", RAW_COLUMNS),
        "event_distribution": w + _distribution("raw"),
        "event_type_ranking": (w + _distribution("raw")
                               + " ORDER BY n_events DESC, event_type ASC NULLS LAST LIMIT 20"),
        "describe_numeric": w + describe,
        "quality_metrics": w + _metrics("raw", RAW_COLUMNS),
        "metric_compare": w + compare,
        "quality_comparison": (w + "SELECT metric, round(before, 6) AS before, round(after, 6) AS after, "
                               "round(after - before, 6) AS abs_diff, "
                               "round(CASE WHEN before <> 0 THEN (after - before) / before * 100 END, 6) "
                               f"AS relative_pct FROM ({compare})"),
    }


FEATS = ["recency", "frequency", "monetary", "unique_products", "views", "carts", "purchases",
         "conversion_rate"]


def _sum(terms: list[str]) -> str:
    return " + ".join(terms)


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


SCALE_SQL = (
    "\nsd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS s_{c}, avg({c}) AS m_{c}" for c in FEATS)
    + " FROM feat),\n"
    "zc AS (SELECT feat.*, " + ", ".join(
        f"CASE WHEN s_{c} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({c} AS DOUBLE) * (1.0 / s_{c}) END AS z_{c}, "
        f"CASE WHEN s_{c} = 0 THEN CAST(0 AS DOUBLE) ELSE (CAST({c} AS DOUBLE) - m_{c}) * (1.0 / s_{c}) END "
        f"AS y_{c}" for c in FEATS) + " FROM feat, sd)")

FROZEN_SQL = (
    "\nseeded AS (SELECT zc.*, CASE WHEN recency < 30 AND monetary > 500 THEN 0 "
    "WHEN frequency > 10 AND monetary < 200 THEN 1 WHEN recency > 90 THEN 2 "
    "WHEN conversion_rate < 0.1 THEN 3 ELSE 4 END AS seed FROM zc),\n"
    "cent AS (SELECT seed AS cluster, " + ", ".join(f"avg(z_{c}) AS c_{c}" for c in FEATS)
    + " FROM seeded GROUP BY seed),\n"
    "dist AS (SELECT s.user_id, c.cluster, "
    + _sum([f"(z_{c} - c_{c}) * (z_{c} - c_{c})" for c in FEATS]) + " AS d FROM seeded s CROSS JOIN cent c),\n"
    "pred AS (SELECT user_id, cluster AS prediction, d FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY d, cluster) AS rn FROM dist) WHERE rn = 1),\n"
    "predf AS (SELECT z.*, p.prediction, p.d FROM zc z JOIN pred p ON z.user_id = p.user_id),\n"
    "prof AS (SELECT prediction AS cluster, count(*) AS size, "
    "printf('%.1f%%', CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100) AS percentage, "
    "avg(recency) AS recency_mean, avg(frequency) AS frequency_mean, avg(monetary) AS monetary_mean, "
    "avg(conversion_rate) AS conversion_rate_mean FROM predf GROUP BY prediction),\n"
    "names AS (SELECT cluster, CASE WHEN recency_mean < 30 AND monetary_mean > 500 THEN 'Clients Premium' "
    "WHEN frequency_mean > 10 AND monetary_mean < 200 THEN 'Chasseurs de Promos' "
    "WHEN recency_mean > 90 THEN 'Clients Dormants' WHEN conversion_rate_mean < 0.1 THEN 'Window Shoppers' "
    "ELSE 'Cluster Moyen Cluster ' || CAST(cluster AS VARCHAR) END AS segment_name FROM prof)")

SILHOUETTE_SQL = (
    "\npts AS (SELECT user_id, prediction AS c, " + ", ".join(f"z_{c}" for c in FEATS) + ", "
    + _sum([f"z_{c} * z_{c}" for c in FEATS]) + " AS nx FROM predf),\n"
    "cs AS (SELECT c AS cluster, CAST(count(*) AS DOUBLE) AS n, sum(nx) AS psi, "
    + ", ".join(f"sum(z_{c}) AS t_{c}" for c in FEATS) + " FROM pts GROUP BY c),\n"
    "pd AS (SELECT p.user_id, p.c, s.cluster, s.n, nx + psi / s.n - 2 * ("
    + _sum([f"z_{c} * t_{c}" for c in FEATS]) + ") / s.n AS d FROM pts p CROSS JOIN cs s),\n"
    "per AS (SELECT user_id, max(CASE WHEN cluster = c THEN n END) AS na, "
    "max(CASE WHEN cluster = c THEN d * n / (n - 1) END) AS a, "
    "min(CASE WHEN cluster <> c THEN d END) AS b FROM pd GROUP BY user_id)")


# A model whose centers are the mean buyers of the naming rules, scaled by these means' own spread.
KNOWN_SQL = (
    "\nknown AS (SELECT seed AS rule, " + ", ".join(f"avg({c}) AS {c}" for c in FEATS) + " FROM seeded GROUP BY seed),\n"
    "spread AS (SELECT " + ", ".join(f"stddev_samp({c}) AS s_{c}" for c in FEATS) + " FROM known),\n"
    "far AS (SELECT f.user_id, k.rule, " + _sum([
        f"CASE WHEN s_{c} = 0 THEN 0 ELSE ((f.{c} - k.{c}) / s_{c}) * ((f.{c} - k.{c}) / s_{c}) END" for c in FEATS])
    + " AS d FROM feat f, known k, spread),\n"
    "ruled AS (SELECT user_id, rule FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d, rule) AS rn FROM far) "
    "WHERE rn = 1)")


def clustering_sql() -> dict[str, str]:
    w = _with(ADAPTER_SQL, CLEAN_SQL, FEATURES_SQL, SCALE_SQL, FROZEN_SQL)
    seg_values = ", ".join(
        f"({int(g['cluster'])}, {_sql_str(g['name'])}, {_sql_str(g['description'])}, "
        f"{_sql_str(g['strategy'])})" for g in SEGMENTS)
    measures = ["recency_mean", "frequency_mean", "monetary_mean", "conversion_rate_mean"]
    return {
        "assembled_columns": w + "SELECT user_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS) + " FROM feat",
        "k_search_facts": "SELECT CAST(range AS INTEGER) AS k, true AS silhouette_possible, true AS wss_possible FROM range(2, 11)",
        "best_k_of_table": (w + "SELECT CAST(product_id % 9 + 2 AS INTEGER) AS k, "
                            "floor(avg(CASE WHEN event_type = 'view' THEN 1.0 ELSE 0.0 END) * 10) / 10 AS silhouette, "
                            "CAST(count(*) AS DOUBLE) AS wss FROM p8 GROUP BY ALL ORDER BY silhouette DESC, k LIMIT 1"),
        "kmeans_facts": (w + f"SELECT CAST(2 AS BIGINT) AS n_centers, CAST({len(FEATS)} AS INTEGER) AS n_features, "
                         "count(*) AS n_users FROM feat"),
        "segmentation_facts": (w + "SELECT count(*) AS n_users, " + ", ".join(
            f"round(avg({c}), 6) AS {c}_mean" for c in ("recency", "frequency", "monetary", "conversion_rate"))
            + ", true AS all_named FROM feat"),
        "prediction_sample_facts": (w + "SELECT user_id, " + ", ".join(f"round(y_{c}, 6) AS {c}" for c in FEATS)
                                    + ", true AS in_model FROM zc ORDER BY user_id LIMIT 5"),
        "score_known_model": (_with(ADAPTER_SQL, CLEAN_SQL, FEATURES_SQL, SCALE_SQL, FROZEN_SQL, KNOWN_SQL)
                              + "SELECT user_id, CAST(rule AS INTEGER) AS rule FROM ruled"),
        "scale_nocenter": w + "SELECT user_id, " + ", ".join(
            f"round(z_{c}, 6) AS {c}" for c in FEATS) + " FROM zc",
        "scale_center": w + "SELECT user_id, " + ", ".join(
            f"round(y_{c}, 6) AS {c}" for c in FEATS) + " FROM zc",
        "assign_clusters": w + "SELECT user_id, prediction FROM pred",
        "silhouette": (_with(ADAPTER_SQL, CLEAN_SQL, FEATURES_SQL, SCALE_SQL, FROZEN_SQL, SILHOUETTE_SQL)
                       + "SELECT round(avg(CASE WHEN na <= 1 THEN 0 WHEN a < b THEN 1 - a / b "
                         "WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette FROM per"),
        "wss": w + "SELECT round(sum(d), 6) AS wss FROM pred",
        "cluster_stats": (w + "SELECT prediction, " + ", ".join(
            f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std"
            for c in ("recency", "frequency", "monetary"))
            + ", count(user_id) AS users FROM predf GROUP BY prediction"),
        "cluster_profiles": (w + "SELECT cluster, size, percentage, " + ", ".join(
            f"round({m}, 6) AS {m}" for m in measures) + " FROM prof"),
        "cluster_sizes": w + "SELECT prediction, count(*) AS n_users FROM predf GROUP BY prediction",
        "name_segments": w + "SELECT cluster, segment_name FROM names",
        "named_segments": (w + "SELECT p.cluster, size, percentage, " + ", ".join(
            f"round({m}, 6) AS {m}" for m in measures)
            + ", segment_name FROM prof p LEFT JOIN names n ON p.cluster = n.cluster"),
        "radar_profile": (w + " UNION ALL ".join(
            f"SELECT cluster, '{axis}' AS axis, round({expr}, 6) AS r FROM prof"
            for axis, expr in [("recency", "recency_mean / 150.0"),
                               ("frequency", "frequency_mean / 5.0"),
                               ("monetary", "monetary_mean / 800.0"),
                               ("conversion_rate", "conversion_rate_mean * 10.0")])),
        "cluster_comparison": (w + " UNION ALL ".join(
            f"SELECT p.cluster, CAST(p.cluster AS VARCHAR) || ' - ' || segment_name AS label, "
            f"'{m}' AS measure, round({m}, 6) AS value FROM prof p JOIN names n ON p.cluster = n.cluster"
            for m in measures)),
        "segment_recommendations": (
            w + f", seg(cluster, name, description, strategy) AS (VALUES {seg_values}) "
            "SELECT p.user_id, p.prediction, s.name, s.description, s.strategy, "
            "CASE WHEN s.cluster IS NULL THEN 'Cluster non reconnu' END AS warning "
            "FROM pred p LEFT JOIN seg s ON p.prediction = s.cluster"),
    }


def all_sql() -> dict[str, str]:
    out = {}
    out.update(cleaning_sql())
    out.update(features_sql())
    out.update(quality_sql())
    out.update(clustering_sql())
    out.update(logqueries.SQL)
    return out
