"""SQL counterparts of the catalog queries, for checking results with another engine.

Written for DuckDB over the raw test tables. Shared sub-queries are kept as named fragments and
put in front of each statement that uses them.
"""

from __future__ import annotations

_ORDERS = """orders_d AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
      WHEN 'P' THEN 'canceled' END AS order_status,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_purchase_timestamp,
    o_orderdate + to_hours(CAST(o_orderkey % 24 + 1 AS INTEGER)) AS order_approved_at,
    o_orderdate + to_hours(CAST(o_orderkey % 24 + 24 * (1 + o_orderkey % 3) AS INTEGER))
      AS order_delivered_carrier_date,
    CASE WHEN o_orderkey % 97 <> 0
      THEN o_orderdate + to_hours(CAST(24 * (3 + o_orderkey % 41) AS INTEGER)) END
      AS order_delivered_customer_date,
    o_orderdate + to_hours(CAST(24 * (12 + o_orderkey % 29) AS INTEGER))
      AS order_estimated_delivery_date
  FROM orders)"""

_DERIVED = _ORDERS + """, derived AS (
  SELECT *, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
    CAST(month(order_purchase_timestamp) AS INTEGER) AS month,
    dayname(order_purchase_timestamp) AS day_of_week,
    CAST(hour(order_purchase_timestamp) AS INTEGER) AS hour,
    CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp))
      / 86400000000.0) AS INTEGER) AS delivery_days,
    CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END
      AS is_late
  FROM orders_d)"""

_DELIVERED = _DERIVED + """, delivered AS (
  SELECT * FROM derived
  WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL)"""

_ITEMS = """items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_extendedprice AS price,
    l_extendedprice * l_tax AS freight_value,
    l_extendedprice + l_extendedprice * l_tax AS item_total
  FROM lineitem), item_agg AS (
  SELECT order_id, count(order_item_id) AS num_items, sum(item_total) AS order_value,
    avg(price) AS avg_price
  FROM items GROUP BY order_id)"""

_PAYMENTS = """payments AS (
  SELECT l_orderkey AS order_id,
    CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
      WHEN 'R' THEN 'voucher' END AS payment_type,
    l_linenumber AS payment_installments,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS payment_value
  FROM lineitem), type_rank AS (
  SELECT order_id, payment_type,
    row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, payment_type) AS place
  FROM payments GROUP BY order_id, payment_type), payment_agg AS (
  SELECT p.order_id, sum(payment_value) AS total_payment,
    max(payment_installments) AS installments, max(t.payment_type) AS payment_type
  FROM payments p JOIN type_rank t ON p.order_id = t.order_id AND t.place = 1
  GROUP BY p.order_id)"""

_REVIEWS = """reviews AS (
  SELECT o_orderkey AS order_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
  FROM orders WHERE o_orderkey % 100 <> 0
  UNION ALL
  SELECT o_orderkey, 5 FROM orders WHERE o_orderkey % 50 = 1), review_agg AS (
  SELECT order_id, avg(review_score) AS review_score FROM reviews GROUP BY order_id)"""

_CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, n_name AS customer_state,
    c_mktsegment AS customer_city
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_MASTER = ", ".join([_DELIVERED, _ITEMS, _PAYMENTS, _REVIEWS, _CUSTOMERS]) + """, master AS (
  SELECT d.*, num_items, order_value, avg_price, total_payment, installments, payment_type,
    review_score, customer_state, customer_city
  FROM delivered d
  LEFT JOIN item_agg USING (order_id) LEFT JOIN payment_agg USING (order_id)
  LEFT JOIN review_agg USING (order_id) LEFT JOIN customers USING (customer_id))"""

_RFM = _MASTER + """, rfm AS (
  SELECT customer_id,
    CAST(floor((epoch_us((SELECT max(order_purchase_timestamp) FROM master))
      - epoch_us(max(order_purchase_timestamp))) / 86400000000.0) AS INTEGER) AS recency,
    count(order_id) AS frequency, coalesce(sum(total_payment), 0) AS monetary,
    avg(review_score) AS avg_review, avg(is_late) AS late_rate
  FROM master GROUP BY customer_id), edges AS (
  SELECT quantile_cont(recency, [0.25, 0.5, 0.75]) AS r,
    quantile_cont(frequency, [0.25, 0.5, 0.75]) AS f,
    quantile_cont(monetary, [0.25, 0.5, 0.75]) AS m,
    min(frequency) AS f0, max(frequency) AS f4, count(*) AS n
  FROM rfm), ranked AS (
  SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS place FROM rfm), scores AS (
  SELECT ranked.*,
    4 - CAST(recency > r[1] AS INTEGER) - CAST(recency > r[2] AS INTEGER)
      - CAST(recency > r[3] AS INTEGER) AS r_score,
    1 + CAST(monetary > m[1] AS INTEGER) + CAST(monetary > m[2] AS INTEGER)
      + CAST(monetary > m[3] AS INTEGER) AS m_score,
    1 + CAST(place > 1 + (n - 1) * 0.25 AS INTEGER) + CAST(place > 1 + (n - 1) * 0.5 AS INTEGER)
      + CAST(place > 1 + (n - 1) * 0.75 AS INTEGER) AS f_rank_score,
    1 + CAST(frequency > f[1] AS INTEGER) + CAST(frequency > f[2] AS INTEGER)
      + CAST(frequency > f[3] AS INTEGER) AS f_value_score,
    f0 < f[1] AND f[1] < f[2] AND f[2] < f[3] AND f[3] < f4 AS f_distinct
  FROM ranked, edges), etl_scored AS (
  SELECT customer_id, recency, frequency, monetary, r_score AS recency_score,
    CASE WHEN f_distinct THEN f_value_score ELSE f_rank_score END AS frequency_score,
    m_score AS monetary_score,
    r_score + CASE WHEN f_distinct THEN f_value_score ELSE f_rank_score END + m_score AS rfm_score
  FROM scores), etl_rfm AS (
  SELECT *, CASE WHEN rfm_score > 2 AND rfm_score <= 5 THEN 'At-Risk'
    WHEN rfm_score > 5 AND rfm_score <= 8 THEN 'Potential'
    WHEN rfm_score > 8 AND rfm_score <= 12 THEN 'Champions' END AS segment
  FROM etl_scored), ml_rfm AS (
  SELECT customer_id, recency, frequency, monetary, avg_review, late_rate,
    r_score AS "R", f_rank_score AS "F", m_score AS "M",
    r_score + f_rank_score + m_score AS rfm_score,
    CASE WHEN r_score + f_rank_score + m_score >= 10 THEN 'Champions'
      WHEN r_score + f_rank_score + m_score >= 7 THEN 'Loyal Customers'
      WHEN r_score + f_rank_score + m_score >= 5 THEN 'At-Risk' ELSE 'Lost' END AS rfm_segment
  FROM scores)"""

_UNITS = """units AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'test' END AS variant, user_id,
    CAST(ts AS DATE) AS day,
    max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS converted,
    coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0) AS revenue,
    CAST(count(CASE WHEN event_type = 'view' THEN 1 END) AS INTEGER) AS session_pages
  FROM events GROUP BY ALL)"""

_DELIVERED_ANY = _DERIVED + """, delivered_any AS (
  SELECT * FROM derived WHERE order_status = 'delivered')"""
_PLAUSIBLE = _DELIVERED_ANY + """, plausible AS (
  SELECT * FROM delivered_any WHERE delivery_days BETWEEN 0 AND 60)"""
_PAID = ", ".join([_PLAUSIBLE, _PAYMENTS]) + """, paid AS (
  SELECT d.*, total_payment FROM delivered_any d LEFT JOIN payment_agg USING (order_id))"""

_PREVIEW = _PAID + """, preview AS (
  SELECT customer_id,
    CAST(floor((epoch_us((SELECT max(order_purchase_timestamp) FROM orders_d))
      - epoch_us(max(order_purchase_timestamp))) / 86400000000.0) AS INTEGER) AS recency,
    count(order_id) AS frequency, sum(total_payment) AS monetary
  FROM paid WHERE total_payment IS NOT NULL GROUP BY customer_id)"""

_TREND = _PAID + """, trend AS (
  SELECT year, month, count(order_id) AS order_count, coalesce(sum(total_payment), 0) AS revenue,
    make_date(year, month, 1) AS period
  FROM paid GROUP BY year, month)"""

_PANEL = _MASTER + """, monthly AS (
  SELECT year, month, customer_state, count(order_id) AS order_count,
    coalesce(sum(total_payment), 0) AS total_revenue, avg(total_payment) AS avg_order_val,
    avg(review_score) AS avg_review, avg(is_late) AS late_rate, avg(delivery_days) AS avg_delivery,
    count(DISTINCT customer_id) AS num_customers
  FROM master WHERE customer_state IS NOT NULL GROUP BY ALL), lagged AS (
  SELECT *,
    lag(order_count, 1) OVER w AS lag_1_orders, lag(order_count, 2) OVER w AS lag_2_orders,
    lag(order_count, 3) OVER w AS lag_3_orders,
    CASE WHEN lag(order_count, 3) OVER w IS NOT NULL THEN (lag(order_count, 1) OVER w
      + lag(order_count, 2) OVER w + lag(order_count, 3) OVER w) / 3.0 END AS rolling_3m,
    CAST((month - 1) // 3 + 1 AS INTEGER) AS quarter,
    CAST((month - 1) // 3 + 1 = 4 AS INTEGER) AS is_q4,
    sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos,
    CAST(dense_rank() OVER (ORDER BY customer_state) - 1 AS INTEGER) AS state_enc
  FROM monthly WINDOW w AS (PARTITION BY customer_state ORDER BY year, month)), panel AS (
  SELECT * FROM lagged WHERE lag_3_orders IS NOT NULL AND avg_order_val IS NOT NULL
    AND avg_review IS NOT NULL AND avg_delivery IS NOT NULL)"""

_LATE = "round(100.0 * sum(is_late) / count(*), 1) AS late_rate_pct"


def _bars(source: str, column: str, bins: int, where: str = "TRUE") -> str:
    """Histogram of a column, bins between minimum and maximum, the last bin closed. A single
    distinct value gets a unit-wide range around it."""
    return f"""SELECT b.bin, l.lo + b.bin * (l.hi - l.lo) / {bins} AS bin_low,
      l.lo + (b.bin + 1) * (l.hi - l.lo) / {bins} AS bin_high, count(s.x) AS n
    FROM (SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin) b
    CROSS JOIN (SELECT min({column}) - CASE WHEN min({column}) = max({column})
        THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS lo,
      max({column}) + CASE WHEN min({column}) = max({column})
        THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hi
      FROM {source} WHERE {where}) l
    LEFT JOIN (SELECT CAST({column} AS DOUBLE) AS x FROM {source} WHERE {where}) s
      ON s.x >= l.lo + b.bin * (l.hi - l.lo) / {bins}
      AND (s.x < l.lo + (b.bin + 1) * (l.hi - l.lo) / {bins} OR b.bin = {bins} - 1)
    GROUP BY ALL"""


ORACLES: dict[str, str] = {
    "master": f"""WITH {_MASTER} SELECT order_id, customer_id, order_status,
      order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
      order_delivered_customer_date, order_estimated_delivery_date, year, month, day_of_week,
      hour, delivery_days, is_late, num_items, round(order_value, 6) AS order_value,
      round(avg_price, 6) AS avg_price, round(total_payment, 6) AS total_payment, installments,
      payment_type, round(review_score, 6) AS review_score, customer_state, customer_city
      FROM master""",
    "processed_orders": f"WITH {_DELIVERED} SELECT * FROM delivered",
    "processed_items": f"""WITH {_ITEMS} SELECT order_id, order_item_id, price,
      round(freight_value, 6) AS freight_value, round(item_total, 6) AS item_total FROM items""",
    "payments_per_order": f"""WITH {_PAYMENTS} SELECT order_id,
      round(total_payment, 6) AS total_payment, installments, payment_type FROM payment_agg""",
    "reviews_per_order": f"WITH {_REVIEWS} SELECT order_id, review_score FROM review_agg",
    "items_per_order": f"""WITH {_ITEMS} SELECT order_id, num_items,
      round(order_value, 6) AS order_value, round(avg_price, 6) AS avg_price FROM item_agg""",
    "rfm_base": f"""WITH {_RFM} SELECT customer_id, recency, frequency,
      round(monetary, 6) AS monetary FROM rfm""",
    "rfm_etl_scored": f"""WITH {_RFM} SELECT customer_id, recency, frequency,
      round(monetary, 6) AS monetary, recency_score, frequency_score, monetary_score, rfm_score,
      segment FROM etl_rfm""",
    "rfm_ml_scored": f"""WITH {_RFM} SELECT customer_id, recency, frequency,
      round(monetary, 6) AS monetary, round(avg_review, 6) AS avg_review,
      round(late_rate, 6) AS late_rate, "R", "F", "M", rfm_score, rfm_segment FROM ml_rfm""",
    "rfm_recommendations": f"""WITH {_RFM} SELECT customer_id, rfm_score, rfm_segment,
      CASE rfm_segment
      WHEN 'Champions' THEN 'Reward with loyalty program. Ask for reviews. Early access to new products.'
      WHEN 'Loyal Customers' THEN 'Upsell higher-value products. Offer membership benefits.'
      WHEN 'At-Risk' THEN 'Send win-back email campaign with discount. Survey for dissatisfaction.'
      WHEN 'Lost' THEN 'Final re-engagement attempt. Otherwise suppress from campaigns.'
      END AS recommendation FROM ml_rfm""",
    "rfm_segment_counts": f"""WITH {_RFM} SELECT rfm_segment, count(*) AS n FROM ml_rfm
      GROUP BY rfm_segment""",
    "q01_monthly_revenue": f"""WITH {_MASTER} SELECT year, month,
      count(DISTINCT order_id) AS total_orders, round(sum(total_payment), 2) AS revenue,
      round(avg(total_payment), 2) AS avg_order_value,
      round(avg(delivery_days), 1) AS avg_delivery_days,
      CAST(sum(is_late) AS BIGINT) AS late_orders, {_LATE}
      FROM master GROUP BY year, month ORDER BY year, month""",
    "q02_top_states": f"""WITH {_MASTER} SELECT customer_state,
      count(DISTINCT order_id) AS total_orders, round(sum(total_payment), 2) AS revenue,
      round(avg(review_score), 2) AS avg_review_score,
      round(avg(delivery_days), 1) AS avg_delivery_days, {_LATE}
      FROM master GROUP BY customer_state
      ORDER BY revenue DESC NULLS LAST, customer_state LIMIT 10""",
    "q03_payment_mix": f"""WITH {_MASTER} SELECT payment_type, count(*) AS total_orders,
      round(sum(total_payment), 2) AS total_revenue,
      round(avg(installments), 1) AS avg_installments,
      round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_orders
      FROM master GROUP BY payment_type""",
    "q04_delivery_by_state": f"""WITH {_MASTER} SELECT customer_state,
      count(*) AS total_orders, CAST(sum(is_late) AS BIGINT) AS late_orders, {_LATE},
      round(avg(delivery_days), 1) AS avg_delivery_days,
      round(avg(CASE WHEN is_late = 1 THEN delivery_days END), 1) AS avg_late_days
      FROM master GROUP BY customer_state HAVING count(*) > 100
      ORDER BY late_rate_pct DESC, customer_state LIMIT 15""",
    "q05_review_vs_delivery": f"""WITH {_MASTER} SELECT review_score,
      count(*) AS order_count, round(avg(delivery_days), 1) AS avg_delivery_days,
      round(avg(total_payment), 2) AS avg_order_value,
      CAST(sum(is_late) AS BIGINT) AS late_orders, {_LATE}
      FROM master WHERE review_score IS NOT NULL GROUP BY review_score""",
    "q06_hourly": f"""WITH {_MASTER} SELECT hour, count(*) AS orders,
      round(avg(total_payment), 2) AS avg_revenue,
      round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_of_orders
      FROM master GROUP BY hour""",
    "q07_weekday": f"""WITH {_MASTER} SELECT day_of_week, count(*) AS orders,
      round(sum(total_payment), 2) AS total_revenue,
      round(avg(total_payment), 2) AS avg_order_value,
      round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_of_orders
      FROM master GROUP BY day_of_week""",
    "q08_top_customers": f"""WITH {_MASTER}, spend AS (
      SELECT customer_id, count(DISTINCT order_id) AS total_orders,
        round(sum(total_payment), 2) AS total_spend,
        round(avg(total_payment), 2) AS avg_order_value,
        round(avg(review_score), 2) AS avg_review,
        min(order_purchase_timestamp) AS first_order, max(order_purchase_timestamp) AS last_order
      FROM master GROUP BY customer_id)
      SELECT * FROM spend
      WHERE total_spend >= (SELECT quantile_cont(total_spend, 0.95) FROM spend)
      ORDER BY total_spend DESC, customer_id LIMIT 100""",
    "q09_status_funnel": f"""WITH {_ORDERS} SELECT order_status, count(*) AS orders,
      round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct
      FROM orders_d GROUP BY order_status""",
    "q10_mom_growth": f"""WITH {_MASTER}, m AS (
      SELECT *, row_number() OVER (ORDER BY year, month) AS place FROM (
        SELECT year, month, round(sum(total_payment), 2) AS revenue FROM master GROUP BY ALL))
      SELECT now.year, now.month, now.revenue, past.revenue AS prev_month_revenue,
        CASE WHEN past.revenue <> 0
          THEN round((now.revenue / past.revenue - 1) * 100.0, 1) END AS mom_growth_pct
      FROM m AS now LEFT JOIN m AS past ON past.place = now.place - 1""",
    "q11_segment_summary": f"""WITH {_RFM}, whole AS (SELECT sum(monetary) AS money FROM etl_rfm), part AS (
      SELECT segment, count(*) AS n, sum(recency) AS days, sum(frequency) AS bought,
        sum(monetary) AS money, count(monetary) AS paid FROM etl_rfm GROUP BY segment)
      SELECT segment, n AS customers, round(part.money, 2) AS total_revenue,
        round(100.0 * part.money / whole.money, 1) AS revenue_share_pct,
        round(part.money / paid, 2) AS avg_spend, round(days / n, 0) AS avg_recency_days,
        round(bought / n, 1) AS avg_orders FROM part, whole""",
    "q12_campaign": f"""WITH {_MASTER}, assigned AS (
      SELECT c_custkey AS customer_id,
        CASE WHEN c_custkey % 2 = 0 THEN 'control' ELSE 'test' END AS variant
      FROM customer WHERE c_custkey % 5 <> 0)
      , spent AS (
      SELECT customer_id, count(*) AS bought, count(total_payment) AS paid,
        sum(total_payment) AS money FROM master GROUP BY customer_id), sums AS (
      SELECT variant, count(*) AS users, CAST(sum(bought) AS BIGINT) AS orders,
        sum(money) AS money, sum(paid) AS paid
      FROM assigned JOIN spent USING (customer_id) GROUP BY variant)
      SELECT variant, users, orders, round(CAST(orders AS DOUBLE) / users, 4) AS conversion_rate,
        round(money, 2) AS total_revenue, round(money / paid, 2) AS avg_order_value,
        round(money / users, 2) AS revenue_per_user FROM sums""",
    "shape_profile": """SELECT 'orders' AS table_name, count(*) AS n_rows, 8 AS n_cols FROM orders
      UNION ALL SELECT 'order_items', count(*), 4 FROM lineitem
      UNION ALL SELECT 'order_payments', count(*), 4 FROM lineitem
      UNION ALL SELECT 'order_reviews', sum(CASE WHEN o_orderkey % 100 = 0 THEN 0
        WHEN o_orderkey % 50 = 1 THEN 2 ELSE 1 END)::BIGINT, 2 FROM orders
      UNION ALL SELECT 'customers', count(*), 4 FROM customer
      UNION ALL SELECT 'products', count(*), 6 FROM part
      UNION ALL SELECT 'sellers', count(*), 4 FROM supplier""",
    "null_profile": """SELECT 'order_delivered_customer_date' AS column_name, count(*) AS nulls
      FROM orders WHERE o_orderkey % 97 = 0 HAVING count(*) > 0""",
    "status_counts": f"""WITH {_ORDERS} SELECT order_status, count(*) AS n FROM orders_d
      GROUP BY order_status""",
    "delivery_overview": f"""WITH {_DERIVED} SELECT count(*) AS total_orders,
      count(*) FILTER (order_status = 'delivered') AS delivered_orders,
      round_even(100.0 * count(*) FILTER (order_status = 'delivered') / count(*), 1)
        AS delivered_pct,
      CAST(sum(is_late) FILTER (order_status = 'delivered') AS BIGINT) AS late_orders,
      round_even(100.0 * sum(is_late) FILTER (order_status = 'delivered')
        / count(*) FILTER (order_status = 'delivered'), 1) AS late_pct,
      round_even(avg(delivery_days) FILTER (order_status = 'delivered'), 1) AS avg_delivery_days
      FROM derived""",
    "monthly_trend": f"""WITH {_TREND} SELECT year, month, order_count,
      round(revenue, 4) AS revenue, period, round(revenue / 1e6, 6) AS revenue_millions
      FROM trend WHERE period < DATE '2018-09-01'""",
    "peak_month": f"""WITH {_TREND} SELECT strftime(period, '%B %Y') AS label, order_count
      FROM trend WHERE period < DATE '2018-09-01' ORDER BY order_count DESC, period LIMIT 1""",
    "delivery_histogram": f"WITH {_PLAUSIBLE} {_bars('plausible', 'delivery_days', 40)}",
    "late_split": f"""WITH {_PLAUSIBLE} SELECT CASE WHEN is_late = 1 THEN 'Late' ELSE 'On-Time' END
      AS delivery, count(*) AS orders,
      round_even(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct
      FROM plausible GROUP BY is_late""",
    "delivery_by_weekday": f"""WITH {_PLAUSIBLE}, week AS (
      SELECT CAST(i AS INTEGER) AS position, dayname(DATE '2024-01-01' + CAST(i - 1 AS INTEGER))
        AS day_of_week FROM range(1, 8) r(i))
      SELECT position, w.day_of_week, substr(w.day_of_week, 1, 3) AS label,
        round(avg(delivery_days), 6) AS avg_days
      FROM week w LEFT JOIN plausible p ON p.day_of_week = w.day_of_week GROUP BY ALL""",
    "hourly_peak_flags": f"""WITH {_DERIVED}, h AS (
      SELECT hour, count(*) AS orders FROM derived GROUP BY hour)
      SELECT hour, orders, CASE WHEN row_number() OVER (ORDER BY orders DESC, hour) <= 3
        THEN 1 ELSE 0 END AS is_peak FROM h""",
    "peak_hour": f"""WITH {_DERIVED} SELECT hour AS peak_hour, count(*) AS orders FROM derived
      GROUP BY hour ORDER BY orders DESC, hour LIMIT 1""",
    "payment_type_rows": f"""WITH {_PAYMENTS} SELECT payment_type, count(order_id) AS n,
      round(sum(payment_value), 4) AS total_value, round(avg(payment_value), 6) AS avg_value,
      round(sum(payment_value) / 1e6, 6) AS total_millions
      FROM payments GROUP BY payment_type""",
    "review_dist": f"""WITH {_REVIEWS} SELECT review_score, count(*) AS n,
      round_even(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct
      FROM reviews GROUP BY review_score""",
    "review_overview": f"""WITH {_REVIEWS} SELECT round_even(avg(review_score), 2) AS avg_score,
      count(*) FILTER (review_score = 5) AS five_star,
      round_even(100.0 * count(*) FILTER (review_score = 5) / count(*), 1) AS five_star_pct
      FROM reviews""",
    "late_by_review_crosstab": f"""WITH {_DELIVERED_ANY}, {_REVIEWS}
      SELECT CASE WHEN is_late = 1 THEN 'Late' ELSE 'On-Time' END AS delivery, review_score,
        count(*) AS n
      FROM delivered_any JOIN reviews USING (order_id) WHERE review_score IS NOT NULL
      GROUP BY is_late, review_score""",
    "state_stats": f"""WITH {_PAID}, {_CUSTOMERS} SELECT customer_state,
      count(order_id) AS orders, round(coalesce(sum(total_payment), 0), 4) AS revenue,
      round(avg(delivery_days), 6) AS avg_delivery,
      round(coalesce(sum(total_payment), 0) / 1e6, 6) AS revenue_millions
      FROM paid JOIN customers USING (customer_id) WHERE customer_state IS NOT NULL
      GROUP BY customer_state""",
    "top_states_by_orders": f"""WITH {_PAID}, {_CUSTOMERS} SELECT customer_state,
      count(order_id) AS orders, round(coalesce(sum(total_payment), 0), 4) AS revenue
      FROM paid JOIN customers USING (customer_id) WHERE customer_state IS NOT NULL
      GROUP BY customer_state ORDER BY orders DESC, customer_state LIMIT 10""",
    "distinct_states": f"WITH {_CUSTOMERS} SELECT DISTINCT customer_state FROM customers",
    "distinct_people": f"""WITH {_CUSTOMERS} SELECT count(DISTINCT customer_unique_id)
      AS unique_customers FROM customers""",
    "rfm_preview": f"""WITH {_PREVIEW} SELECT customer_id, recency, frequency,
      round(monetary, 6) AS monetary FROM preview""",
    "rfm_histograms": f"""WITH {_PREVIEW}, clipped AS (
      SELECT least(recency, 500) AS recency, least(frequency, 10) AS frequency,
        least(monetary, 1000) AS monetary FROM preview), bars AS (
      SELECT 'recency' AS feature, * FROM ({_bars('clipped', 'recency', 50)})
      UNION ALL SELECT 'frequency', * FROM ({_bars('clipped', 'frequency', 20)})
      UNION ALL SELECT 'monetary', * FROM ({_bars('clipped', 'monetary', 50)}))
      SELECT feature, bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, n
      FROM bars""",
    "rfm_describe": f"""WITH {_PREVIEW}, long AS (
      SELECT 'recency' AS feature, CAST(recency AS DOUBLE) AS v FROM preview
      UNION ALL SELECT 'frequency', CAST(frequency AS DOUBLE) FROM preview
      UNION ALL SELECT 'monetary', monetary FROM preview)
      SELECT feature, count(v) AS n, round_even(avg(v), 2) AS mean,
        round_even(stddev_samp(v), 2) AS std, round_even(min(v), 2) AS min,
        round_even(quantile_cont(v, 0.25), 2) AS q25, round_even(quantile_cont(v, 0.5), 2) AS q50,
        round_even(quantile_cont(v, 0.75), 2) AS q75, round_even(max(v), 2) AS max
      FROM long GROUP BY feature""",
    "eda_summary": f"""WITH {_PAID}, {_CUSTOMERS}, {_REVIEWS} SELECT
      (SELECT count(*) FROM orders) AS total_orders,
      (SELECT count(*) FROM delivered_any) AS delivered_orders,
      (SELECT count(DISTINCT customer_unique_id) FROM customers) AS unique_customers,
      (SELECT count(*) FROM supplier) AS unique_sellers,
      (SELECT round_even(avg(review_score), 2) FROM reviews) AS avg_review_score,
      (SELECT round_even(100.0 * sum(is_late) / count(*), 1) FROM plausible) AS late_rate_pct,
      (SELECT round_even(avg(delivery_days), 1) FROM plausible) AS avg_delivery_days,
      (SELECT customer_state FROM delivered_any JOIN customers USING (customer_id)
        WHERE customer_state IS NOT NULL
        GROUP BY customer_state ORDER BY count(*) DESC, customer_state LIMIT 1) AS top_state,
      (SELECT hour FROM derived GROUP BY hour ORDER BY count(*) DESC, hour LIMIT 1) AS peak_hour,
      (SELECT payment_type FROM payments GROUP BY payment_type
        ORDER BY count(*) DESC, payment_type LIMIT 1) AS top_payment""",
    "demand_features": f"""WITH {_PANEL} SELECT year, month, customer_state, order_count,
      round(total_revenue, 4) AS total_revenue, round(avg_order_val, 6) AS avg_order_val,
      round(avg_review, 6) AS avg_review, round(late_rate, 6) AS late_rate,
      round(avg_delivery, 6) AS avg_delivery, num_customers, lag_1_orders, lag_2_orders,
      lag_3_orders, round(rolling_3m, 6) AS rolling_3m, quarter, is_q4,
      round(month_sin, 6) AS month_sin, round(month_cos, 6) AS month_cos, state_enc
      FROM panel""",
    "forecast_inputs": f"""WITH {_PANEL}, latest AS (
      SELECT * FROM panel
      QUALIFY row_number() OVER (PARTITION BY customer_state ORDER BY year DESC, month DESC) = 1),
      steps AS (
      SELECT latest.*, CAST(a AS INTEGER) AS ahead,
        CAST(month + a - 1 AS INTEGER) % 12 + 1 AS out_month,
        CAST(year + (month + a - 1) // 12 AS INTEGER) AS out_year
      FROM latest CROSS JOIN range(1, 4) r(a))
      SELECT customer_state, ahead, out_year, out_month, year, out_month AS month,
        CAST((out_month - 1) // 3 + 1 AS INTEGER) AS quarter,
        CAST((out_month - 1) // 3 + 1 = 4 AS INTEGER) AS is_q4,
        round(sin(2 * pi() * out_month / 12), 6) AS month_sin,
        round(cos(2 * pi() * out_month / 12), 6) AS month_cos, state_enc,
        order_count AS lag_1_orders, lag_1_orders AS lag_2_orders, lag_2_orders AS lag_3_orders,
        round(rolling_3m, 6) AS rolling_3m, round(avg_order_val, 6) AS avg_order_val,
        round(avg_review, 6) AS avg_review, round(late_rate, 6) AS late_rate,
        round(avg_delivery, 6) AS avg_delivery, num_customers
      FROM steps""",
    "experiment_population": f"""WITH {_UNITS} SELECT variant, user_id, day, converted,
      round(revenue, 6) AS revenue, session_pages FROM units""",
    "ab_metrics": f"""WITH {_UNITS} SELECT variant, count(user_id) AS users,
      CAST(sum(converted) AS BIGINT) AS conversions, round(sum(revenue), 4) AS total_revenue,
      round(avg(revenue), 6) AS avg_revenue,
      round(sum(converted) / count(user_id), 6) AS conversion_rate,
      round(sum(revenue) / count(user_id), 6) AS revenue_per_user
      FROM units GROUP BY variant""",
    "ab_duplicate_units": f"""WITH {_UNITS} SELECT variant, user_id, count(*) AS n FROM units
      GROUP BY variant, user_id HAVING count(*) > 1""",
    "ab_ztest_stats": f"""WITH {_UNITS}, s AS (
      SELECT count(*) FILTER (variant = 'control') AS n_control,
        count(*) FILTER (variant = 'test') AS n_test,
        CAST(sum(converted) FILTER (variant = 'control') AS BIGINT) AS x_control,
        CAST(sum(converted) FILTER (variant = 'test') AS BIGINT) AS x_test
      FROM units), p AS (
      SELECT *, x_control / n_control AS p1, x_test / n_test AS p2,
        (x_control + x_test) / (n_control + n_test) AS pool FROM s)
      SELECT n_control, n_test, x_control, x_test, round(p1, 6) AS control_cvr,
        round(p2, 6) AS test_cvr, round((p2 - p1) / p1 * 100, 6) AS lift_pct,
        round((p2 - p1) / sqrt(pool * (1 - pool) * (1 / n_control + 1 / n_test)), 6) AS z_stat
      FROM p""",
    "ab_welch_stats": f"""WITH {_UNITS}, s AS (
      SELECT count(*) FILTER (variant = 'control') AS n1,
        avg(revenue) FILTER (variant = 'control') AS m1,
        var_samp(revenue) FILTER (variant = 'control') AS v1,
        count(*) FILTER (variant = 'test') AS n2, avg(revenue) FILTER (variant = 'test') AS m2,
        var_samp(revenue) FILTER (variant = 'test') AS v2
      FROM units)
      SELECT n1 AS n_control, round(m1, 6) AS control_avg, round(v1, 4) AS var_control,
        n2 AS n_test, round(m2, 6) AS test_avg, round(v2, 4) AS var_test,
        round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t_stat,
        round((v1 / n1 + v2 / n2) ** 2
          / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1)), 4) AS degrees,
        round((m2 - m1) / m1 * 100, 6) AS lift_pct
      FROM s""",
    "power_check": f"""WITH {_UNITS}, s AS (
      SELECT day, count(*) FILTER (variant = 'control') AS n_control,
        count(*) FILTER (variant = 'test') AS n_test,
        sum(converted) FILTER (variant = 'control') / count(*) FILTER (variant = 'control') AS p1
      FROM units GROUP BY day), r AS (
      SELECT *, CASE WHEN p1 > 0 AND p1 + 0.02 < 1 THEN
        CAST(ceil((1.959963984540054 * sqrt(2 * (p1 + 0.01) * (1 - p1 - 0.01))
        + 0.8416212335729143 * sqrt(p1 * (1 - p1) + (p1 + 0.02) * (1 - p1 - 0.02))) ** 2
        / (0.02 * 0.02)) AS BIGINT) END AS required_n FROM s)
      SELECT day, n_control, n_test, round(p1, 6) AS control_cvr, required_n,
        CASE WHEN n_control > 0 AND n_test > 0
          THEN CAST(least(n_control, n_test) >= required_n AS INTEGER) END AS enough FROM r""",
    "revenue_p99": f"""WITH {_UNITS} SELECT variant, count(revenue) AS n,
      round(quantile_cont(revenue, 0.99), 6) AS p99 FROM units GROUP BY variant""",
    "revenue_histogram": f"""WITH {_UNITS}, c AS (
      SELECT variant, least(revenue, quantile_cont(revenue, 0.99) OVER (PARTITION BY variant))
        AS revenue FROM units), bars AS (
      SELECT 'control' AS variant, *
        FROM ({_bars('c', 'revenue', 50, "variant = 'control'")})
      UNION ALL SELECT 'test', * FROM ({_bars('c', 'revenue', 50, "variant = 'test'")}))
      SELECT variant, bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, n
      FROM bars""",
    "kpi_records": f"""WITH {_UNITS}, m AS (
      SELECT variant, count(user_id) AS users, CAST(sum(converted) AS BIGINT) AS conversions,
        CAST(round(sum(revenue)) AS BIGINT) AS total_revenue,
        CAST(round(avg(revenue)) AS BIGINT) AS avg_revenue,
        round(sum(converted) / count(user_id), 4) AS conversion_rate,
        CAST(round(sum(revenue) / count(user_id)) AS BIGINT) AS revenue_per_user
      FROM units GROUP BY variant)
      SELECT CAST(to_json(struct_pack(variant := variant, users := users,
        conversions := conversions, total_revenue := total_revenue, avg_revenue := avg_revenue,
        conversion_rate := conversion_rate, revenue_per_user := revenue_per_user)) AS VARCHAR)
        AS record, true AS has_time
      FROM m""",
    "request_validation": f"""WITH {_CUSTOMERS}, requests AS (
      SELECT c_custkey AS request_id,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN r_name
          WHEN c_mktsegment <> 'BUILDING' THEN n_name END AS state,
        CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey % 12 + 1 AS INTEGER) END AS month,
        2001 AS year, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS avg_order_val
      FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)
      SELECT *, CASE WHEN state IS NULL THEN 'Missing field: state'
        WHEN month IS NULL THEN 'Missing field: month'
        WHEN state NOT IN (SELECT customer_state FROM customers)
          THEN 'Unknown state: ' || state END AS error
      FROM requests""",
}


def _mann_whitney(by: str) -> str:
    """Ranks by the pairwise definition: tied values share the mean of their positions."""
    group, comma = (f"PARTITION BY {by}", f"{by},") if by else ("", "")
    per = f"GROUP BY {by}" if by else ""
    tie_by = f"GROUP BY {comma} session_pages"
    tie_sum = "(SELECT sum(t ** 3 - t) FROM ties" + (f" WHERE ties.{by} = s.{by})" if by else ")")
    return f"""WITH {_UNITS}, ranked AS (
      SELECT *, rank() OVER ({group} ORDER BY session_pages)
        + (count(*) OVER ({"PARTITION BY " + comma if by else "PARTITION BY "} session_pages) - 1)
        / 2.0 AS place FROM units), ties AS (
      SELECT {comma} CAST(count(*) AS DOUBLE) AS t FROM units {tie_by}), s AS (
      SELECT {comma} count(*) FILTER (variant = 'control') AS n_control,
        count(*) FILTER (variant = 'test') AS n_test,
        sum(place) FILTER (variant = 'control') AS r1,
        quantile_cont(session_pages, 0.5) FILTER (variant = 'control') AS control_median,
        quantile_cont(session_pages, 0.5) FILTER (variant = 'test') AS test_median
      FROM ranked {per}), u AS (
      SELECT *, r1 - n_control * (n_control + 1) / 2.0 AS u_stat,
        {tie_sum} AS tie_sum, CAST(n_control AS DOUBLE) * n_test AS pairs,
        CAST(n_control + n_test AS DOUBLE) AS n FROM s)
      SELECT {comma} n_control, n_test, u_stat, tie_sum, control_median, test_median,
        round((greatest(u_stat, pairs - u_stat) - pairs / 2 - 0.5)
          / sqrt(pairs / 12 * (n + 1 - tie_sum / (n * (n - 1)))), 6) AS z_stat
      FROM u"""


ORACLES["ab_mannwhitney_stats"] = _mann_whitney("")
ORACLES["ab_daily_mannwhitney"] = _mann_whitney("day")
# The sketch keeps every value below its accuracy (10,000 customers) and then returns a value
# that occurs; above that, the limit of 100 rows decides.
ORACLES["q08_top_customers_approx"] = ORACLES["q08_top_customers"].replace(
    "quantile_cont(total_spend", "quantile_disc(total_spend"
)

# Sketched answers differ between engines; what is compared is the exact side and that the true error
# is within the tolerance.
ORACLES["q08_edge_error"] = f"""WITH {_MASTER}, spend AS (
  SELECT customer_id, sum(total_payment) AS s FROM master GROUP BY customer_id)
  SELECT count(s) AS n, CAST(0.95 AS DOUBLE) AS share, true AS within FROM spend"""
ORACLES["month_sketches"] = f"""WITH {_MASTER}
  SELECT year, month, count(total_payment) AS n FROM master
  WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month"""
ORACLES["year_quantile_errors"] = f"""WITH {_MASTER}, y AS (
  SELECT year, count(total_payment) AS n FROM master
  WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year)
  SELECT year, n, share, true AS within FROM y,
    (SELECT unnest([CAST(0.5 AS DOUBLE), 0.95, 0.99]) AS share) AS s WHERE n > 0"""
ORACLES["year_customer_errors"] = f"""WITH {_MASTER}
  SELECT year, count(DISTINCT customer_id) AS customers, true AS within FROM master
  WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year HAVING count(customer_id) > 0"""

ORACLES["segment_request_validation"] = """WITH requests AS (
  SELECT c_custkey AS request_id,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_custkey % 90 AS VARCHAR) END AS recency,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'often' ELSE CAST(c_custkey % 7 + 1 AS VARCHAR) END
      AS frequency,
    CASE WHEN c_custkey % 11 > 0 THEN CAST(c_custkey AS VARCHAR) || '.5' END AS monetary
  FROM customer)
  SELECT *, CASE WHEN recency IS NULL THEN 'Missing field: recency'
    WHEN monetary IS NULL THEN 'Missing field: monetary'
    WHEN TRY_CAST(frequency AS DOUBLE) IS NULL THEN 'Invalid field: frequency' END AS error
  FROM requests"""

ORACLES["raw_landing"] = f"""WITH {_ORDERS}
  SELECT order_status, strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS n,
    count(order_delivered_customer_date) AS delivered
  FROM orders_d GROUP BY ALL"""

ORACLES["stored_master_by_month"] = f"""WITH {_MASTER}
  SELECT year, month, count(*) AS n, CAST(sum(is_late) AS BIGINT) AS late FROM master GROUP BY ALL"""

ORACLES["naive_forecast_metrics"] = f"""WITH {_PANEL}
  SELECT round(avg(abs(order_count - lag_1_orders)), 6) AS mae,
    round(sqrt(avg((order_count - lag_1_orders) ** 2)), 6) AS rmse,
    round(1 - sum((order_count - lag_1_orders) ** 2)
      / (var_pop(order_count) * count(*)), 6) AS r2 FROM panel"""

ORACLES["demand_folds"] = f"""WITH {_PANEL}, placed AS (
  SELECT customer_state, year, month,
    CAST(ntile(5) OVER (ORDER BY customer_state, year, month) - 1 AS INTEGER) AS fold FROM panel)
  SELECT fold, count(*) AS n, min_by(customer_state, (customer_state, year, month)) AS customer_state,
    min_by(year, (customer_state, year, month)) AS year,
    min_by(month, (customer_state, year, month)) AS month FROM placed GROUP BY fold"""

ORACLES["scaled_measures"] = f"""WITH {_RFM}, long AS (
  SELECT 'recency' AS measure, CAST(recency AS DOUBLE) AS value FROM rfm UNION ALL
  SELECT 'frequency', CAST(frequency AS DOUBLE) FROM rfm UNION ALL
  SELECT 'monetary', monetary FROM rfm)
  SELECT measure, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS deviation
  FROM long GROUP BY measure"""

ORACLES["rule_cluster_profile"] = f"""WITH {_RFM}, clustered AS (
  SELECT *, customer_id % 4 AS cluster FROM rfm), named AS (
  SELECT cluster, ['Hibernating', 'Promising', 'Loyal', 'Champions'][
    row_number() OVER (ORDER BY avg(monetary), cluster)] AS cluster_label
  FROM clustered GROUP BY cluster)
  SELECT cluster_label, count(customer_id) AS customers, round_even(avg(recency), 1) AS avg_recency,
    round_even(avg(frequency), 1) AS avg_frequency, round_even(avg(monetary), 1) AS avg_monetary
  FROM clustered JOIN named USING (cluster) GROUP BY cluster_label"""

# Two-sided tail areas by Simpson's rule: of the normal density over [|x|, |x| + 40], and of
# Student's density after x = |t| + s / (1 - s).
_NORMAL_TAIL = """(SELECT 2 * sum(w * exp(-((x + step) ** 2) / 2)) / sqrt(2 * pi()) FROM (
  SELECT 0.005 * i AS step, CASE WHEN i IN (0, 8000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * 0.005 / 3 AS w FROM range(0, 8001) r(i)))"""
_STUDENT_TAIL = """(SELECT 2 * sum(w / (1 - s) ** 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)
    - 0.5 * ln(df * pi()) - (df + 1) / 2 * ln(1 + (x + s / (1 - s)) ** 2 / df))) FROM (
  SELECT i / 20000.0::DOUBLE AS s, CASE WHEN i = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    / 60000.0::DOUBLE AS w FROM range(0, 20000) r(i)))"""

ORACLES["ab_tests"] = f"""WITH z AS ({ORACLES["ab_ztest_stats"]}), t AS ({ORACLES["ab_welch_stats"]}),
  u AS ({ORACLES["ab_mannwhitney_stats"]}), found AS (
  SELECT 'Z-test (conversion rate)' AS test, round_even(control_cvr, 4) AS control_value,
    round_even(test_cvr, 4) AS test_value, round_even(lift_pct, 2) AS lift_pct,
    round_even(z_stat, 4) AS statistic, abs(z_stat) AS x, CAST(NULL AS DOUBLE) AS df,
    ' difference' AS what FROM z UNION ALL
  SELECT 'Welch t-test (revenue per user)', round_even(control_avg, 2), round_even(test_avg, 2),
    round_even(lift_pct, 2), round_even(t_stat, 4), abs(t_stat), degrees, ' revenue difference'
  FROM t UNION ALL
  SELECT 'Mann-Whitney U (session pages)', control_median, test_median, NULL,
    round_even(u_stat, 2), greatest(z_stat, 0), NULL, NULL FROM u), tails AS (
  SELECT *, CASE WHEN df IS NULL THEN {_NORMAL_TAIL} ELSE {_STUDENT_TAIL} END AS p FROM found)
  SELECT test, control_value, test_value, lift_pct, statistic, round_even(p, 6) AS p_value,
    p < 0.05 AS significant,
    CASE WHEN p < 0.05 THEN 'REJECT H₀' || coalesce(' — significant' || what, '')
      ELSE 'FAIL TO REJECT H₀' || coalesce(' — no significant' || what, '') END AS decision
  FROM tails"""

ORACLES["fixed_model_forecast"] = f"""WITH inputs AS ({ORACLES["forecast_inputs"]})
  SELECT customer_state AS state, out_year AS year, out_month AS month, CAST(greatest(0, round_even(
    0.61 * lag_1_orders + 0.13 * rolling_3m + 0.29 * month - 37.3, 0)) AS BIGINT) AS predicted_orders
  FROM inputs"""

ORACLES["fixed_model_scores"] = f"""WITH {_CUSTOMERS}, requests AS ({ORACLES["request_validation"]}),
  states AS (SELECT customer_state AS state,
    row_number() OVER (ORDER BY customer_state) - 1 AS state_enc
    FROM (SELECT DISTINCT customer_state FROM customers WHERE customer_state IS NOT NULL))
  SELECT request_id, state, year, month, CASE WHEN error IS NULL THEN CAST(greatest(0, round_even(
      0.001 * coalesce(avg_order_val, 150) + 3.17 * month + 0.37 * state_enc
      + 0.01 * 400 - 20.13, 0)) AS BIGINT) END AS predicted_orders,
    CASE WHEN error IS NULL
      THEN 'Based on Random Forest / Gradient Boosting model' END AS confidence_note, error
  FROM requests LEFT JOIN states USING (state)"""

_UNITS_QUERY = f"WITH {_UNITS} SELECT * FROM units WHERE variant IS NOT NULL"

_SAMPLE_SIZE = f"""WITH {_UNITS}, rates AS (
    SELECT count(*) FILTER (variant = 'control') AS n_control, count(*) FILTER (variant = 'test') AS n_test,
      sum(converted) FILTER (variant = 'control') / count(*) FILTER (variant = 'control') AS p FROM units), steps AS (
    SELECT *, p + 0.02 AS q, p + 0.01 AS mid FROM rates)
  SELECT n_control, n_test, CAST(ceil(pow(1.959963984540054 * sqrt(2 * mid * (1 - mid))
    + 0.8416212335729143 * sqrt(p * (1 - p) + q * (1 - q)), 2) / 0.0004) AS BIGINT) AS required_n FROM steps"""

_RAW_COUNTS = """SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'items', count(*) FROM lineitem
  UNION ALL SELECT 'payments', count(*) FROM lineitem UNION ALL SELECT 'customers', count(*) FROM customer
  UNION ALL SELECT 'reviews', count(*) FILTER (o_orderkey % 100 <> 0) + count(*) FILTER (o_orderkey % 50 = 1) FROM orders"""

# Only the numbers that the queries above find in the stored tables, and the raw rows behind them.
ORACLES["etl_record"] = f"""WITH o AS ({ORACLES["processed_orders"]}), i AS ({ORACLES["processed_items"]}),
  p AS ({ORACLES["payments_per_order"]}), m AS ({ORACLES["master"]}), r AS ({ORACLES["rfm_base"]}),
  raw AS ({_RAW_COUNTS})
  SELECT 'orders_rows' AS counted, count(*) AS n FROM o UNION ALL SELECT 'items_rows', count(*) FROM i
  UNION ALL SELECT 'payments_rows', count(*) FROM p UNION ALL SELECT 'master_rows', count(*) FROM m
  UNION ALL SELECT 'rfm_rows', count(*) FROM r UNION ALL SELECT 'duplicate_customers', 0
  UNION ALL SELECT 'raw_' || name || '_rows', n FROM raw
  UNION ALL SELECT 'raw_' || name || '_without_key', 0 FROM raw"""

ORACLES["stored_master_by_sql"] = f"""SELECT * FROM ({ORACLES["stored_master_by_month"]})
  WHERE year BETWEEN 1993 AND 1996"""

ORACLES["fixed_centre_clusters"] = f"""WITH {_RFM}, moments AS (
  SELECT avg(recency) AS mr, stddev_pop(recency) AS sr, avg(frequency) AS mf, stddev_pop(frequency) AS sf,
    avg(monetary) AS mm, stddev_pop(monetary) AS sm FROM rfm), far AS (
  SELECT customer_id, number, ((recency - mr) / sr - a) ** 2 + ((frequency - mf) / sf - b) ** 2
    + ((monetary - mm) / sm - c) ** 2 AS distance
  FROM rfm, moments, (VALUES (0, -0.8, 0.9, 1.1), (1, 0.3, -0.2, -0.1), (2, 1.7, -1.1, -1.3)) t(number, a, b, c)), near AS (
  SELECT customer_id, min_by(number, distance) AS cluster, min(distance) AS distance FROM far GROUP BY customer_id)
  SELECT cluster, count(*) AS customers, round(sum(distance), 6) AS inertia FROM near GROUP BY cluster"""

ORACLES["experiment_report"] = f"""WITH m AS (SELECT variant, unnest([
    {{'name': 'users', 'value': CAST(users AS DOUBLE)}}, {{'name': 'conversions', 'value': CAST(conversions AS DOUBLE)}},
    {{'name': 'total_revenue', 'value': total_revenue}}, {{'name': 'avg_revenue', 'value': avg_revenue}},
    {{'name': 'conversion_rate', 'value': conversions / users}}, {{'name': 'revenue_per_user', 'value': total_revenue / users}}
  ], recursive := true) FROM (SELECT variant, count(user_id) AS users, sum(converted) AS conversions,
    sum(revenue) AS total_revenue, avg(revenue) AS avg_revenue FROM ({_UNITS_QUERY}) GROUP BY variant)), sides AS (
  SELECT name, max(value) FILTER (variant = 'control') AS c, max(value) FILTER (variant = 'test') AS t FROM m GROUP BY name),
  sizes AS ({_SAMPLE_SIZE})
  SELECT 'Metric: ' || name AS section, round(c, 6) AS control_value, round(t, 6) AS test_value,
    round_even(100 * (t - c) / c, 2) AS lift_pct, CAST(NULL AS DOUBLE) AS p_value, CAST(NULL AS VARCHAR) AS decision FROM sides
  UNION ALL SELECT test, round(control_value, 6), round(test_value, 6), lift_pct, p_value, decision FROM ({ORACLES["ab_tests"]})
  UNION ALL SELECT 'Sample size, required: ' || required_n, CAST(n_control AS DOUBLE), CAST(n_test AS DOUBLE), NULL, NULL,
    CASE WHEN least(n_control, n_test) >= required_n THEN 'ENOUGH' ELSE 'TOO FEW' END FROM sizes"""

_CHI = """cells AS (SELECT {by} variant, {column} AS category, count(*) AS o FROM units GROUP BY ALL), totals AS (
    SELECT *, sum(o) OVER (PARTITION BY {by} variant) AS r, sum(o) OVER (PARTITION BY {by} category) AS c FROM cells), found AS (
    SELECT {by} CAST(sum(o) AS BIGINT) AS n, count(DISTINCT variant) AS n_rows, count(DISTINCT category) AS n_columns,
      greatest(0, sum(o) * (sum(CAST(o AS DOUBLE) * o / r / c) - 1)) AS statistic FROM totals {group})"""

ORACLES["ab_daily_chi_square"] = f"""WITH {_UNITS}, {_CHI.format(by="day,", column="session_pages", group="GROUP BY day")}
  SELECT day, n, n_rows, n_columns, round(statistic, 6) AS statistic, (n_rows - 1) * (n_columns - 1) AS degrees FROM found"""

# For whole degrees of freedom the tail is a finite sum, and an odd number adds a normal tail.
ORACLES["ab_chi_square"] = " UNION ALL ".join(
    f"""SELECT * FROM (WITH {_UNITS}, {_CHI.format(by="", column=column, group="")}, sized AS (
  SELECT n, statistic, sqrt(statistic) AS x, (n_rows - 1) * (n_columns - 1) AS degrees FROM found), tails AS (
  SELECT *, CASE WHEN degrees % 2 = 1 THEN {_NORMAL_TAIL} ELSE 0 END + coalesce((
    SELECT sum(exp((k - (degrees % 2) / 2.0) * ln(statistic / 2) - statistic / 2 - lgamma(k - (degrees % 2) / 2.0 + 1)))
    FROM range(0, 500) t(k) WHERE k >= degrees % 2 AND 2 * k <= degrees - 2 + degrees % 2), 0) AS p FROM sized)
  SELECT n, degrees, round_even(statistic, 4) AS statistic, round_even(p, 6) AS p_value, p < 0.05 AS significant,
    CASE WHEN p < 0.05 THEN 'REJECT H₀' ELSE 'FAIL TO REJECT H₀' END AS decision, '{column}' AS category FROM tails)"""
    for column in ("session_pages", "converted")
)

_SUMMED = ["lag_1_orders", "lag_2_orders", "month", "order_count"]
ORACLES["demand_covariances"] = f"""WITH {_PANEL} """ + " UNION ALL ".join(
    f"SELECT count(*) AS n, 'cov_{i}_{j}' AS pair, round(covar_pop({_SUMMED[i]}, {_SUMMED[j]}), 6) AS covariance FROM panel"
    for i in range(4) for j in range(i, 4)
)

ORACLES["linear_demand"] = f"""WITH {_PANEL} SELECT 'lag_1_orders' AS input,
    round(regr_slope(order_count, lag_1_orders), 6) AS coefficient, round(regr_r2(order_count, lag_1_orders), 6) AS r2 FROM panel
  UNION ALL SELECT 'intercept', round(regr_intercept(order_count, lag_1_orders), 6), round(regr_r2(order_count, lag_1_orders), 6) FROM panel"""

ORACLES["split_segment_stream"] = f"""SELECT CASE WHEN error IS NULL THEN 'scored' ELSE 'refused' END AS outcome,
  error, count(*) AS n FROM ({ORACLES["segment_request_validation"]}) GROUP BY ALL"""
