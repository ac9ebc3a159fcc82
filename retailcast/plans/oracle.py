"""DuckDB SQL for the oracle check: the same retail view, feature table and
scored table as `plans.base`, written as CTEs over the driver's views."""

from __future__ import annotations

RETAIL_CTE = """
g AS (
  SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS store_id,
         CAST(sum(l_quantity) AS BIGINT) AS units_sold,
         min(p_retailprice) AS base_price, max(l_discount) AS discount_pct
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2),
h AS (
  SELECT *, CAST(isodow(d) - 1 AS INTEGER) AS wd, CAST(dayofyear(d) AS BIGINT) AS doy,
         strftime(d, '%m-%d') AS md,
         (250 + (CAST(dayofyear(d) AS BIGINT) * 37 + store_id * 11) % 120) / 10.0::DOUBLE AS max_temp_c,
         ((CAST(dayofyear(d) AS BIGINT) * 53 + store_id * 29) % 130) / 10.0::DOUBLE AS rainfall_mm
  FROM g),
retail AS (
  SELECT CAST(date_diff('day', DATE '1995-01-01', d) AS BIGINT) * 100000000 + store_id AS record_id,
    strftime(d, '%Y-%m-%d') AS date, store_id,
    CASE wd WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday'
            WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END AS day_of_week,
    CASE WHEN wd >= 5 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN md IN ('01-01', '07-04', '12-25') THEN 1 ELSE 0 END AS is_holiday,
    CASE md WHEN '01-01' THEN 'New Year' WHEN '07-04' THEN 'Holiday_A' WHEN '12-25' THEN 'Holiday_B'
            ELSE 'None' END AS holiday_name,
    max_temp_c, rainfall_mm,
    CASE WHEN max_temp_c >= 32 THEN 1 ELSE 0 END AS is_hot_day,
    CASE WHEN rainfall_mm >= 5 THEN 1 ELSE 0 END AS is_rainy_day,
    base_price, discount_pct,
    CASE WHEN discount_pct >= 0.08 THEN 1 ELSE 0 END AS is_promo,
    CASE WHEN discount_pct >= 0.1 THEN 'bundle' WHEN discount_pct >= 0.08 THEN 'flyer' ELSE 'none' END AS promo_type,
    base_price * (1.0::DOUBLE - discount_pct) AS final_price,
    units_sold
  FROM h)"""

FEAT_CTE = """
feat0 AS (
  SELECT *,
    strftime(CAST(date AS DATE), '%Y-%m-%dT%H:%M:%SZ') AS event_time,
    CAST(year(CAST(date AS DATE)) AS INTEGER) AS year,
    CAST(month(CAST(date AS DATE)) AS INTEGER) AS month,
    CAST(day(CAST(date AS DATE)) AS INTEGER) AS day,
    CAST(dayofyear(CAST(date AS DATE)) AS INTEGER) AS day_of_year,
    CAST(isodow(CAST(date AS DATE)) - 1 AS INTEGER) AS day_of_week_index,
    base_price * discount_pct AS discount_amount,
    CAST(coalesce(is_promo = 1 OR is_holiday = 1, false) AS INTEGER) AS is_promo_or_holiday,
    CAST(('0x' || substr(md5('42:' || CAST(record_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 AS _bucket
  FROM retail),
feat AS (
  SELECT * EXCLUDE (_bucket),
    CAST(coalesce(CAST(units_sold AS DOUBLE) >= (SELECT quantile_cont(units_sold, 0.75) FROM retail), false) AS INTEGER) AS high_demand,
    CASE WHEN _bucket < 9000 THEN 'train' WHEN _bucket < 9500 THEN 'validation' ELSE 'test' END AS split_type
  FROM feat0)"""

SCORED_CTE = """
bl AS (
  SELECT store_id, day_of_week_index, avg(CAST(units_sold AS DOUBLE)) AS _key_mean
  FROM feat WHERE split_type = 'train' GROUP BY 1, 2),
scored AS (
  SELECT f.*, coalesce(bl._key_mean,
           (SELECT avg(CAST(units_sold AS DOUBLE)) FROM feat WHERE split_type = 'train')) AS prediction
  FROM feat f LEFT JOIN bl ON f.store_id = bl.store_id AND f.day_of_week_index = bl.day_of_week_index),
test AS (SELECT * FROM scored WHERE split_type = 'test'),
spread AS (SELECT * REPLACE (units_sold + (record_id * 31 % 21 - 10) * (1 + month % 4) / 2.0::DOUBLE AS prediction) FROM test)"""


def bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; wrap each call as BIGINT (Spark's type)."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(count_if(" + bigint_counts(sql[j + len(tok):k - 1]) + ") AS BIGINT)")
        i = k


def with_base(body: str, level: str = "scored", extra: str = "") -> str:
    """Prefix ``body`` with the CTE chain up to ``level`` (retail|feat|scored)."""
    ctes = [RETAIL_CTE]
    if level in ("feat", "scored"):
        ctes.append(FEAT_CTE)
    if level == "scored":
        ctes.append(SCORED_CTE)
    if extra:
        ctes.append(extra)
    return bigint_counts("WITH " + ",".join(ctes) + "\n" + body)
