"""Independent SQL for the registered queries, over the same tables, in the dialect of DuckDB.

Ratios are rounded half up in integer arithmetic, money is summed as decimals, and every limit has a
total order, so equality with the Spark results is exact.
"""

from __future__ import annotations


def _ratio(num: str, den: str, factor: int, scale: int) -> str:
    """round(num * factor / 10^scale / den, scale) as a double, rounding half up; null for den = 0."""
    top = f"CAST(({num}) * {factor} AS HUGEINT)"
    bottom = f"NULLIF(CAST({den} AS HUGEINT), 0)"
    return f"(CAST((2 * {top} + {bottom}) // (2 * {bottom}) AS DOUBLE) / {10 ** scale}.0)"


def _cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


_CTR_PCT = _ratio("clicks", "impressions", 10 ** 6, 4)
_MONEY = "DECIMAL(22,2)"

_EVENT_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))"
_UUID = r"regexp_replace({}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\1-\2-\3-\4-\5')"


def _name_id(name: str) -> str:
    return f"CAST('0x' || substr(md5({name}), 1, 15) AS BIGINT)"


_AE = f"""
ae AS (
  SELECT md5({_EVENT_KEY}) AS event_id, p_brand AS advertiser_name, p_brand || '/' || p_type AS campaign_name,
         {_name_id("p_brand || '/' || p_type")} AS campaign_id,
         tn.n_name AS target_country, o_custkey AS user_id, cn.n_name AS location, c_nationkey AS location_id,
         o_orderpriority AS device, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS device_id,
         p_size || 'x' || (p_size * 2) AS ad_slot_size, l_shipdate AS event_timestamp,
         CAST(l_quantity AS DECIMAL(10,2)) AS bid_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS ad_cost, l_returnflag = 'R' AS was_clicked,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate + to_minutes(l_linenumber) END AS click_timestamp,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS ad_revenue,
         CAST(l_shipdate AS DATE) AS event_date,
         l_linenumber, CAST(l_quantity AS INTEGER) AS qty, l_returnflag
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation cn ON cn.n_nationkey = c_nationkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation tn ON tn.n_nationkey = s_nationkey
)"""

_DIMS = f"""
advertisers AS (
  SELECT DISTINCT {_name_id("p_brand")} AS advertiser_id, p_brand AS name FROM part
), campaigns AS (
  SELECT {_name_id("p_brand || '/' || p_type")} AS campaign_id, {_name_id("p_brand")} AS advertiser_id,
         p_brand || '/' || p_type AS campaign_name,
         CAST(SUM(CAST(p_retailprice AS DECIMAL(12,2))) * 2080 AS DECIMAL(18,2)) AS budget
  FROM part GROUP BY p_brand, p_type
), locations AS (
  SELECT n_nationkey AS country_id, n_name AS country_name FROM nation
), devices AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS device_id, o_orderpriority AS device_name FROM orders
), users AS (
  SELECT c_custkey AS user_id, CAST(18 + c_nationkey * 2 AS SMALLINT) AS age,
         CASE WHEN c_mktsegment < 'F' THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS country_id, c_acctbal
  FROM customer
), interest_pairs AS (
  SELECT c_custkey AS user_id, lower(c_mktsegment) AS interest_name FROM customer
  UNION
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'credit' ELSE 'savings' END FROM customer
  WHERE c_acctbal < 0 OR c_acctbal > 5000
)"""

_RATING = """CASE WHEN p_size >= 46 THEN CASE WHEN CAST(l_quantity AS INTEGER) % 5 = 0 THEN 4 ELSE 5 END
              ELSE 1 + CAST(l_quantity AS INTEGER) % 5 END"""

_RV = f"""
rv AS (
  SELECT {_EVENT_KEY} AS review_id, CAST(l_partkey AS VARCHAR) AS product_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         l_returnflag AS marketplace, p_name AS product_title, p_type AS product_category,
         CAST({_RATING} AS INTEGER) AS star_rating, l_linenumber AS helpful_votes,
         CAST(l_quantity AS INTEGER) AS total_votes, CAST(l_tax > 0.04 AS INTEGER) AS vine,
         CAST(l_linestatus = 'O' AS INTEGER) AS verified_purchase,
         p_brand || ' ' || p_name AS review_headline, p_name || ' ' || p_type || ' ' || l_returnflag AS review_body,
         CAST(l_shipdate AS DATE) AS review_date,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(l_quantity AS INTEGER) AS qty
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
)"""

_IN_WINDOW = "event_timestamp >= TIMESTAMP '1997-01-01' AND event_timestamp < TIMESTAMP '1999-01-01'"
_IN_MONTHS = "(year * 12 + month) BETWEEN 1998 * 12 + 3 AND 1999 * 12 + 2"

_REPORTS = {
    "q1_top_campaigns_by_ctr": f"""
SELECT campaign_name, name AS advertiser, impressions, clicks, {_CTR_PCT} AS ctr_pct
FROM (SELECT campaign_id, COUNT(*) AS impressions, COUNT(*) FILTER (WHERE was_clicked) AS clicks
      FROM ae WHERE {_IN_WINDOW} GROUP BY campaign_id HAVING COUNT(*) >= 100)
JOIN campaigns USING (campaign_id) JOIN advertisers USING (advertiser_id)
ORDER BY ctr_pct DESC, campaign_name LIMIT 5""",
    "q2_advertiser_spending": f"""
SELECT name AS advertiser, impressions, clicks AS total_clicks, total_spend, {_CTR_PCT} AS ctr_pct
FROM (SELECT advertiser_id, COUNT(*) AS impressions, COUNT(*) FILTER (WHERE was_clicked) AS clicks,
             CAST(SUM(ad_cost) AS {_MONEY}) AS total_spend
      FROM ae JOIN campaigns USING (campaign_id) WHERE {_IN_WINDOW} GROUP BY advertiser_id)
JOIN advertisers USING (advertiser_id)
ORDER BY total_spend DESC, advertiser LIMIT 10""",
    "q3_campaign_cpc_cpm": f"""
SELECT campaign_name, name AS advertiser, impressions, clicks, total_cost,
       {_ratio(_cents("total_cost"), "clicks", 100, 4)} AS cpc,
       {_ratio(_cents("total_cost"), "impressions", 10 ** 5, 4)} AS cpm
FROM (SELECT campaign_id, COUNT(*) AS impressions, COUNT(*) FILTER (WHERE was_clicked) AS clicks,
             CAST(SUM(ad_cost) AS {_MONEY}) AS total_cost
      FROM ae WHERE {_IN_WINDOW} GROUP BY campaign_id)
JOIN campaigns USING (campaign_id) JOIN advertisers USING (advertiser_id)
ORDER BY cpc ASC NULLS FIRST, campaign_name""",
    "q4_top_locations_by_revenue": f"""
SELECT country_name AS location, COUNT(*) AS click_events, CAST(SUM(ad_revenue) AS {_MONEY}) AS total_revenue
FROM ae JOIN locations ON country_id = location_id
WHERE {_IN_WINDOW} AND was_clicked
GROUP BY country_id, country_name ORDER BY total_revenue DESC, 1 LIMIT 10""",
    "q5_top_engaged_users": f"""
SELECT user_id, age, gender, country_name AS country, COUNT(*) AS total_clicks
FROM ae JOIN users USING (user_id) LEFT JOIN locations USING (country_id)
WHERE {_IN_WINDOW} AND was_clicked
GROUP BY user_id, age, gender, country_name ORDER BY total_clicks DESC, user_id LIMIT 10""",
    "q6_near_budget_exhaustion": f"""
SELECT campaign_name, name AS advertiser, budget AS total_budget, total_spent, pct_budget_spent
FROM (SELECT campaign_id, campaign_name, advertiser_id, budget, CAST(SUM(ad_cost) AS {_MONEY}) AS total_spent,
             {_ratio(_cents("SUM(ad_cost)"), _cents("budget"), 10 ** 4, 2)} AS pct_budget_spent
      FROM campaigns LEFT JOIN (SELECT campaign_id, ad_cost FROM ae) USING (campaign_id) WHERE budget > 0
      GROUP BY campaign_id, campaign_name, advertiser_id, budget)
JOIN advertisers USING (advertiser_id)
WHERE pct_budget_spent > 80 ORDER BY pct_budget_spent DESC, campaign_name""",
    "q7_ctr_by_device": f"""
SELECT device_name, impressions, clicks, {_CTR_PCT} AS ctr_pct
FROM (SELECT device_id, COUNT(*) AS impressions, COUNT(*) FILTER (WHERE was_clicked) AS clicks
      FROM ae WHERE {_IN_WINDOW} GROUP BY device_id)
JOIN devices USING (device_id) ORDER BY ctr_pct DESC, device_name""",
}

# The report titles, repeated here so that the manifest is checked too.
_TITLES = {
    "q1_top_campaigns_by_ctr": "Campaigns with the best click-through rate",
    "q2_advertiser_spending": "Advertisers with the highest spend",
    "q3_campaign_cpc_cpm": "Cost per click and per thousand impressions of every campaign",
    "q4_top_locations_by_revenue": "Locations with the highest click revenue",
    "q5_top_engaged_users": "Users with the most clicks",
    "q6_near_budget_exhaustion": "Campaigns near the end of their budget",
    "q7_ctr_by_device": "Click-through rate of each device",
}

# How a column's value stands in JSON: ratios as decimals, money as text, all else as it is.
_JSON_VALUE = {
    **dict.fromkeys(("ctr_pct", "cpc", "cpm", "pct_budget_spent"), "CAST(CAST({} AS DECIMAL(24,4)) AS VARCHAR)"),
    **dict.fromkeys(("total_spend", "total_cost", "total_revenue", "total_budget", "total_spent"), "CAST({} AS VARCHAR)"),
}
_REPORT_COLUMNS = {
    "q1_top_campaigns_by_ctr": ("campaign_name", "advertiser", "impressions", "clicks", "ctr_pct"),
    "q2_advertiser_spending": ("advertiser", "impressions", "total_clicks", "total_spend", "ctr_pct"),
    "q3_campaign_cpc_cpm": ("campaign_name", "advertiser", "impressions", "clicks", "total_cost", "cpc", "cpm"),
    "q4_top_locations_by_revenue": ("location", "click_events", "total_revenue"),
    "q5_top_engaged_users": ("user_id", "age", "gender", "country", "total_clicks"),
    "q6_near_budget_exhaustion": ("campaign_name", "advertiser", "total_budget", "total_spent", "pct_budget_spent"),
    "q7_ctr_by_device": ("device_name", "impressions", "clicks", "ctr_pct"),
}


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body.strip()


_AE_ROLLUPS = {
    "campaign_performance_by_day": f"""
SELECT campaign_name, event_date, COUNT(event_id) AS total_impressions,
       COUNT(*) FILTER (WHERE was_clicked) AS total_clicks,
       {_ratio("COUNT(*) FILTER (WHERE was_clicked)", "COUNT(event_id)", 10 ** 6, 6)} AS ctr,
       CAST(SUM(ad_cost) AS {_MONEY}) AS total_ad_cost, CAST(SUM(ad_revenue) AS {_MONEY}) AS total_ad_revenue
FROM ae GROUP BY campaign_name, event_date""",
    "advertiser_spend_by_day": f"""
SELECT advertiser_name, event_date, CAST(SUM(ad_cost) AS {_MONEY}) AS total_spend,
       COUNT(event_id) AS total_impressions, COUNT(*) FILTER (WHERE was_clicked) AS total_clicks,
       CAST(SUM(ad_revenue) AS {_MONEY}) AS total_revenue
FROM ae GROUP BY advertiser_name, event_date""",
    "user_engagement_history": f"""
SELECT user_id, event_timestamp, {_UUID.format("event_id")} AS event_id, campaign_name, advertiser_name,
       ad_slot_size, device, location, was_clicked, click_timestamp, ad_cost, ad_revenue
FROM ae""",
    "most_active_users": """
SELECT 'global' AS activity_bucket, user_id, impressions + clicks AS total_interactions,
       impressions AS total_impressions, clicks AS total_clicks,
       row_number() OVER (ORDER BY impressions + clicks DESC, user_id) AS rank
FROM (SELECT user_id, COUNT(event_id) AS impressions, COUNT(*) FILTER (WHERE was_clicked) AS clicks
      FROM ae GROUP BY user_id)""",
    "high_spending_advertisers_by_region": """
SELECT *, row_number() OVER (PARTITION BY region ORDER BY total_spend DESC, advertiser_name) AS rank
FROM (SELECT target_country AS region, advertiser_name, CAST(SUM(ad_cost) AS DECIMAL(22,2)) AS total_spend,
             COUNT(event_id) AS total_impressions, COUNT(*) FILTER (WHERE was_clicked) AS total_clicks,
             CAST(SUM(ad_revenue) AS DECIMAL(22,2)) AS total_revenue
      FROM ae GROUP BY target_country, advertiser_name)""",
    "campaign_daily_history": f"""
SELECT campaign_name, event_date, COUNT(event_id) AS total_impressions,
       COUNT(*) FILTER (WHERE was_clicked) AS total_clicks,
       {_ratio("COUNT(*) FILTER (WHERE was_clicked)", "COUNT(event_id)", 10 ** 6, 6)} AS ctr,
       CAST(SUM(ad_cost) AS {_MONEY}) AS total_ad_cost, CAST(SUM(ad_revenue) AS {_MONEY}) AS total_ad_revenue
FROM ae WHERE campaign_name = 'Brand#7/PROMO' GROUP BY campaign_name, event_date ORDER BY event_date DESC""",
    "top_advertisers_30d": f"""
SELECT advertiser_name, CAST(SUM(ad_cost) AS {_MONEY}) AS total_30d_spend, COUNT(event_id) AS total_30d_impressions,
       COUNT(*) FILTER (WHERE was_clicked) AS total_30d_clicks, CAST(SUM(ad_revenue) AS {_MONEY}) AS total_30d_revenue
FROM ae WHERE event_date >= DATE '2001-10-01'
GROUP BY advertiser_name ORDER BY total_30d_spend DESC, advertiser_name LIMIT 5""",
    "last_ads_per_user": f"""
SELECT user_id, event_timestamp, {_UUID.format("event_id")} AS event_id, campaign_name, advertiser_name,
       was_clicked, click_timestamp
FROM ae QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id) <= 10""",
    "top_clickers_30d": """
SELECT user_id, COUNT(*) AS total_clicks_30d FROM ae
WHERE was_clicked AND event_timestamp >= TIMESTAMP '2001-10-01'
GROUP BY user_id ORDER BY total_clicks_30d DESC, user_id LIMIT 10""",
    "top_advertisers_region_30d": f"""
SELECT advertiser_name, CAST(SUM(ad_cost) AS {_MONEY}) AS total_30d_spend FROM ae
WHERE location = 'NATION_3' AND event_timestamp >= TIMESTAMP '2001-10-01'
GROUP BY advertiser_name ORDER BY total_30d_spend DESC, advertiser_name LIMIT 5""",
    "events_clean": """
SELECT CASE WHEN qty <> 49 THEN '{' || upper(event_id) || '}' END AS event_id, advertiser_name, campaign_name,
       target_country, CASE WHEN qty <> 48 THEN user_id END AS user_id,
       CASE WHEN l_returnflag <> 'A' THEN location END AS location, device, ad_slot_size,
       CASE WHEN l_linenumber <> 7 THEN event_timestamp END AS event_timestamp, bid_amount,
       CASE WHEN qty = 50 THEN 0 ELSE ad_cost END AS ad_cost, was_clicked, click_timestamp, ad_revenue,
       CASE WHEN l_linenumber <> 7 THEN event_date END AS event_date
FROM ae""",
    "campaign_day_counters": """
SELECT campaign_name, event_date, COUNT(*) AS impressions, COUNT(*) FILTER (WHERE was_clicked) AS clicks
FROM ae GROUP BY campaign_name, event_date""",
}
_AE_ROLLUPS["refreshed_rollup"] = """
SELECT CAST(year(event_date) AS INTEGER) AS year,
       CASE WHEN year(event_date) >= 1999 THEN COUNT(*) FILTER (WHERE was_clicked) ELSE COUNT(*) END AS events
FROM ae GROUP BY year(event_date)"""
_AE_ROLLUPS["plain_rows"] = """
SELECT event_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') AS event_timestamp,
       strftime(event_date, '%Y-%m-%d') AS event_date, strftime(click_timestamp, '%Y-%m-%dT%H:%M:%S') AS click_timestamp,
       CAST(ad_cost AS DOUBLE) AS ad_cost, CAST(ad_revenue AS DOUBLE) AS ad_revenue
FROM ae"""
_AE_ROLLUPS["stream_campaign_day_counters"] = _AE_ROLLUPS["campaign_day_counters"]

_LOOKUPS = {
    "campaign_performance": f"""
SELECT campaign_id, campaign_name, impressions, clicks, {_ratio("clicks", "impressions", 10 ** 4, 4)} AS ctr,
       total_ad_spend
FROM (SELECT c.campaign_id, campaign_name, COUNT(event_id) AS impressions,
             COUNT(*) FILTER (WHERE was_clicked) AS clicks,
             CAST(COALESCE(SUM(ad_cost), 0) AS {_MONEY}) AS total_ad_spend
      FROM campaigns c LEFT JOIN (SELECT campaign_id, event_id, was_clicked, ad_cost FROM ae) e
        ON e.campaign_id = c.campaign_id
      GROUP BY c.campaign_id, campaign_name)""",
    "advertiser_spending": f"""
SELECT a.advertiser_id, a.name AS advertiser_name, CAST(COALESCE(SUM(ad_cost), 0) AS {_MONEY}) AS total_ad_spend,
       COUNT(event_id) AS total_impressions, COUNT(*) FILTER (WHERE was_clicked) AS total_clicks,
       CAST(COALESCE(SUM(ad_revenue), 0) AS {_MONEY}) AS total_ad_revenue
FROM advertisers a LEFT JOIN campaigns c ON c.advertiser_id = a.advertiser_id
LEFT JOIN (SELECT campaign_id, event_id, was_clicked, ad_cost, ad_revenue FROM ae) e ON e.campaign_id = c.campaign_id
GROUP BY a.advertiser_id, a.name""",
    "user_engagements": """
SELECT user_id, event_id, c.campaign_name, a.name AS advertiser_name, event_timestamp AS timestamp, was_clicked,
       click_timestamp, ad_cost, ad_revenue
FROM ae JOIN campaigns c ON c.campaign_id = ae.campaign_id JOIN advertisers a ON a.advertiser_id = c.advertiser_id
JOIN users USING (user_id)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id) <= 50""",
    "user_engagement_counts": """
SELECT u.user_id, LEAST(COUNT(e.user_id), 50) AS engagements
FROM users u LEFT JOIN (SELECT user_id FROM ae WHERE qty < 49) e ON e.user_id = u.user_id GROUP BY u.user_id""",
    "fk_orphans": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS foreign_key, COUNT(DISTINCT k) AS orphan_keys, COUNT(k) AS orphan_rows FROM "
        f"(SELECT {key} AS k FROM {child}) WHERE k IS NOT NULL AND k NOT IN (SELECT p FROM ({parents}) AS t(p))"
        for name, child, key, parents in (
            ("ad_events.campaign_id", "ae", "campaign_id", "SELECT campaign_id FROM campaigns"),
            ("ad_events.user_id", "ae", "user_id", "SELECT user_id FROM users"),
            ("ad_events.user_id (solvent)", "ae", "user_id", "SELECT user_id FROM users WHERE c_acctbal >= 0"),
            ("ad_events.location_id", "ae", "location_id", "SELECT country_id FROM locations"),
            ("ad_events.device_id", "ae", "device_id", "SELECT device_id FROM devices"),
            ("campaigns.advertiser_id", "campaigns", "advertiser_id", "SELECT advertiser_id FROM advertisers"),
            ("users.country_id", "users", "country_id", "SELECT country_id FROM locations"),
            ("advertisers.country_id", "advertisers", "advertiser_id % 30", "SELECT country_id FROM locations"),
            ("campaigns.slot_id", "campaigns", "campaign_id % 60",
             "SELECT row_number() OVER (ORDER BY p_size) FROM (SELECT DISTINCT p_size FROM part)"),
            ("user_interests.user_id (solvent)", "interest_pairs", "user_id",
             "SELECT user_id FROM users WHERE c_acctbal >= 0"),
            ("user_interests.interest", "interest_pairs", "interest_name",
             "SELECT DISTINCT interest_name FROM interest_pairs WHERE interest_name <> 'credit'"),
        )
    ),
    "cascade_survivors": """
SELECT user_id, interest_name FROM interest_pairs WHERE user_id IN (SELECT user_id FROM users WHERE c_acctbal >= 0)""",
    "user_interests": """
SELECT user_id, interest_id FROM interest_pairs JOIN (
  SELECT interest_name, row_number() OVER (ORDER BY interest_name) AS interest_id
  FROM (SELECT DISTINCT interest_name FROM interest_pairs)) USING (interest_name)""",
}

_NUMBERED = """
numbered_advertisers AS (
  SELECT name, row_number() OVER (ORDER BY name) AS advertiser_id FROM (SELECT DISTINCT p_brand AS name FROM part)
), numbered_campaigns AS (
  SELECT row_number() OVER (ORDER BY campaign_name, advertiser_id) AS campaign_id, advertiser_id, campaign_name,
         CAST(0 AS DECIMAL(14,2)) AS budget
  FROM (SELECT DISTINCT p_brand || '/' || p_type AS campaign_name, advertiser_id
        FROM part JOIN numbered_advertisers ON name = p_brand)
)"""

_VERIFIED = "FROM rv WHERE verified_purchase = 1"
_STATS = f"""
stats AS (
  SELECT product_id, product_title, COUNT(review_id) AS total_reviews,
         {_ratio("SUM(star_rating)", "COUNT(star_rating)", 100, 2)} AS avg_star_rating
  {_VERIFIED} GROUP BY product_id, product_title
), customers AS (
  SELECT customer_id, COUNT(review_id) AS total_verified_reviews {_VERIFIED} GROUP BY customer_id
), monthly AS (
  SELECT product_id, year, month, COUNT(review_id) AS review_count {_VERIFIED} GROUP BY product_id, year, month
)"""


def _customer_month(predicate: str) -> str:
    return f"""SELECT year, month, customer_id, COUNT(review_id) AS review_count
FROM rv WHERE {predicate} GROUP BY year, month, customer_id"""


def _productive(predicate: str, metric: str) -> str:
    return f"""SELECT customer_id, COUNT(review_id) AS {metric} FROM rv WHERE {predicate} AND {_IN_MONTHS}
GROUP BY customer_id ORDER BY {metric} DESC, customer_id LIMIT 10"""


_REVIEWS = {
    "reviews_clean": """
SELECT review_id, product_id, customer_id, marketplace, product_title, product_category, review_headline, review_body,
       star_rating, helpful_votes, total_votes, vine, verified_purchase, review_date
FROM rv WHERE qty NOT IN (47, 48, 49, 50) AND helpful_votes <> 7""",
    "reviews_clean_verified": """
SELECT review_id, product_id, CASE WHEN qty <> 48 THEN customer_id END AS customer_id, marketplace, product_title,
       product_category, review_headline, review_body,
       CASE WHEN qty = 50 THEN 6 WHEN qty = 49 THEN NULL ELSE star_rating END AS star_rating,
       helpful_votes, total_votes, vine, verified_purchase, review_date
FROM rv WHERE qty <> 47 AND helpful_votes <> 7 AND verified_purchase = 1""",
    "product_stats": "SELECT * FROM stats",
    "customer_stats": "SELECT * FROM customers",
    "monthly_product_reviews": "SELECT * FROM monthly",
    "reviews_by_product": """
SELECT product_id, star_rating, review_date, review_id, customer_id, marketplace, product_title, product_category,
       helpful_votes, total_votes, vine, verified_purchase, review_headline, review_body FROM rv""",
    "reviews_by_customer": """
SELECT customer_id, review_date, review_id, product_id, product_title, star_rating, verified_purchase, marketplace,
       review_headline, review_body FROM rv""",
    "product_monthly_counts": """
SELECT year, month, product_id, product_title, COUNT(review_id) AS review_count FROM rv
GROUP BY year, month, product_id, product_title""",
    "customer_verified_monthly": _customer_month("verified_purchase = 1"),
    "customer_hater_monthly": _customer_month("star_rating IN (1, 2)"),
    "customer_backer_monthly": _customer_month("star_rating IN (4, 5)"),
    "top_products_by_reviews": """
SELECT product_id, total_reviews, avg_star_rating, product_title, substr(product_title, 1, 50) AS short_title FROM stats
ORDER BY total_reviews DESC, product_id, product_title LIMIT 10""",
    "highly_rated_products": """
SELECT * FROM stats WHERE avg_star_rating >= 4.5 AND total_reviews >= 20
ORDER BY avg_star_rating DESC, total_reviews DESC, product_id, product_title LIMIT 10""",
    "top_reviewers": "SELECT * FROM customers ORDER BY total_verified_reviews DESC, customer_id LIMIT 10",
    "heavy_reviewer_count": "SELECT COUNT(*) FILTER (WHERE total_verified_reviews > 25) AS customers FROM customers",
    "top_product_trend": """
SELECT product_id, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS year_month, review_count FROM monthly
WHERE product_id = (SELECT product_id FROM stats ORDER BY total_reviews DESC, product_id, product_title LIMIT 1)""",
    "monthly_volume": """
SELECT year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS year_month,
       CAST(SUM(review_count) AS BIGINT) AS total_reviews FROM monthly GROUP BY year, month""",
    "most_reviewed": f"""
SELECT product_id, arg_max(product_title, (year, month, -n, product_title)) AS product_title,
       CAST(SUM(n) AS BIGINT) AS review_count
FROM (SELECT year, month, product_id, product_title, COUNT(review_id) AS n FROM rv WHERE {_IN_MONTHS}
      GROUP BY year, month, product_id, product_title)
GROUP BY product_id ORDER BY review_count DESC, product_id LIMIT 10""",
    "most_reviewed_ranges": "\nUNION ALL\n".join(f"""
SELECT '{start} to {end}' AS months, * FROM (
  SELECT product_id, arg_max(product_title, (year, month, -n, product_title)) AS product_title,
         CAST(SUM(n) AS BIGINT) AS review_count
  FROM (SELECT year, month, product_id, product_title, COUNT(review_id) AS n FROM rv
        WHERE year * 100 + month BETWEEN {start[:4]}{start[5:7]} AND {end[:4]}{end[5:7]}
        GROUP BY year, month, product_id, product_title)
  GROUP BY product_id ORDER BY review_count DESC, product_id LIMIT 10)""" for start, end in (
        ("1998-03-15", "1999-02-10"), ("1995-01-01", "1995-01-31"), ("1992-01-01", "2001-12-31"),
        ("1996-11-30", "1997-01-01"), ("1993-06-01", "1993-12-31"))),
    "keyed_month_read": """
SELECT year, month, product_id, product_title, COUNT(review_id) AS review_count FROM rv
WHERE year = 1998 AND month = 3 GROUP BY year, month, product_id, product_title""",
    "cleaning_counts": """
SELECT COUNT(*) AS raw_rows, COUNT(*) FILTER (WHERE qty NOT IN (47, 48, 49, 50) AND helpful_votes <> 7) AS clean_rows
FROM rv""",
    "product_reviews_rated": """
SELECT product_id, star_rating, review_date, review_id, customer_id, marketplace, product_title, product_category,
       helpful_votes, total_votes, vine, verified_purchase, review_headline, review_body
FROM rv WHERE product_id = '46' AND star_rating = 5""",
    "customer_reviews": """
SELECT customer_id, review_date, review_id, product_id, product_title, star_rating, verified_purchase, marketplace,
       review_headline, review_body
FROM rv WHERE customer_id = '46'""",
    "most_productive_customers": _productive("verified_purchase = 1", "verified_review_count"),
    "most_productive_haters": _productive("star_rating IN (1, 2)", "low_star_review_count"),
    "most_productive_backers": _productive("star_rating IN (4, 5)", "high_star_review_count"),
}

_TWEET_ROWS = """
tweets AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS review_date,
         props AS review_body, ts, value FROM events
)"""
_MINUTES = """
SELECT 'tweets_' || strftime(ts, '%d_%m_%Y_%H_%M') || '.csv' AS minute_file, COUNT(*) AS rows FROM tweets WHERE value >= 2 GROUP BY 1"""
_UNTIMED = """
SELECT value, reason FROM (
  SELECT '{"customer_id":"' || user_id || '","review_date":"' || CASE WHEN e.value < 2 THEN 'on ' ELSE '' END
         || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","review_body":"'
         || replace(replace(props, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"}' AS whole,
         CASE WHEN e.value < 1 THEN substr(whole, 1, 20) ELSE whole END AS value,
         CASE WHEN e.value < 1 THEN 'not JSON' ELSE 'unreadable time' END AS reason, e.value AS amount
  FROM events e) WHERE amount < 2"""
_PAGES = """
SELECT event_type AS domain, ts AS created_at, 'page_' || json_extract_string(props, '$.k') AS page_title,
       MAX(user_id) AS user_id
FROM events WHERE event_type IN ('click', 'view', 'purchase') AND user_id % 5 <> 0 GROUP BY 1, 2, 3"""
_LABEL = "p_name || ' ' || p_size"

_PLAIN = {
    "lookup_dimension": """
SELECT row_number() OVER (ORDER BY name) AS name_id, name FROM (SELECT DISTINCT c_name AS name FROM customer)""",
    "surrogate_lookup": f"""
SELECT part_id, COUNT(*) AS rows
FROM lineitem JOIN (SELECT p_partkey, {_LABEL} AS label FROM part) ON p_partkey = l_partkey
JOIN (SELECT {_LABEL} AS label, MAX(p_partkey) AS part_id FROM part WHERE p_size > 5 GROUP BY 1) USING (label)
GROUP BY part_id""",
    "parse_slot": """
SELECT p_partkey,
       CASE p_type WHEN 'SMALL' THEN p_size || 'X' || p_size WHEN 'LARGE' THEN p_size || 'x' || p_size || 'x' || p_size
            WHEN 'PROMO' THEN ' ' || p_size || ' x' || p_size || ' ' WHEN 'MEDIUM' THEN NULL
            ELSE p_size || 'x' || (p_size * 2) END AS slot_text,
       CASE WHEN p_type NOT IN ('SMALL', 'LARGE', 'MEDIUM') THEN p_size END AS width,
       CASE WHEN p_type = 'PROMO' THEN p_size WHEN p_type NOT IN ('SMALL', 'LARGE', 'MEDIUM') THEN p_size * 2 END AS height
FROM part""",
    "sample_first_n": """
SELECT * FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25000""",
    "insert_ignore": """
SELECT c_custkey AS user_id, 'customer' AS source FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT o_custkey, 'order ' || arg_min(o_orderkey, (o_orderdate, o_orderkey)) FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""",
    "upsert_last_wins": """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "json_intake_counts": """
SELECT CASE WHEN value < 1 THEN 'blank' WHEN value < 2 THEN 'malformed' ELSE 'good' END AS state,
       CASE WHEN value >= 2 AND value <= 300 THEN event_type ELSE 'unknown' END AS domain, COUNT(*) AS messages
FROM events GROUP BY 1, 2""",
    "quarantined_messages": """
SELECT '{"meta":{"domain":"' || substr(event_type, 1, 1) AS value, 'not JSON' AS reason
FROM events WHERE value >= 1 AND value < 2""",
    "slot_dimension": """
SELECT row_number() OVER (ORDER BY width) AS slot_id, width, width * 2 AS height
FROM (SELECT DISTINCT p_size AS width FROM part)""",
    "variant_speedup": f"""
SELECT label, shipped_mean, shipped_min, shipped_max, open_mean, open_min, open_max,
       {_ratio("shipped_units", "open_units", 100, 2)} AS speedup
FROM (SELECT label, shipped_min, shipped_max, open_min, open_max, shipped_units, open_units,
             CAST(shipped_units AS DOUBLE) / 10000.0 AS shipped_mean, CAST(open_units AS DOUBLE) / 10000.0 AS open_mean
      FROM (SELECT o_orderpriority AS label,
                   MIN(amount) FILTER (WHERE shipped) AS shipped_min, MAX(amount) FILTER (WHERE shipped) AS shipped_max,
                   MIN(amount) FILTER (WHERE NOT shipped) AS open_min, MAX(amount) FILTER (WHERE NOT shipped) AS open_max,
                   (2 * {_cents("SUM(amount) FILTER (WHERE shipped)")} * 100 + COUNT(*) FILTER (WHERE shipped))
                     // (2 * COUNT(*) FILTER (WHERE shipped)) AS shipped_units,
                   (2 * {_cents("SUM(amount) FILTER (WHERE NOT shipped)")} * 100 + COUNT(*) FILTER (WHERE NOT shipped))
                     // (2 * COUNT(*) FILTER (WHERE NOT shipped)) AS open_units
            FROM (SELECT o_orderpriority, l_linestatus <> 'O' AS shipped, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
            GROUP BY o_orderpriority))""",
    "months_in_range": """
SELECT DISTINCT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
FROM (SELECT unnest(generate_series(date_trunc('month', MIN(l_shipdate)), MAX(l_shipdate), INTERVAL 1 MONTH)) AS m
      FROM lineitem)""",
    "wiki_filtered": """
SELECT event_type AS domain, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS created_at,
       'page_' || json_extract_string(props, '$.k') AS page_title, user_id
FROM events WHERE event_type IN ('click', 'view', 'purchase') AND user_id % 5 <> 0""",
    "wiki_page_creates": _PAGES,
    "stream_page_creates": _PAGES,
    "replay_restamped": "SELECT *, true AS stamped FROM events",
    "paced_replay": """
SELECT *, true AS stamped, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 6000 AS INTEGER) AS batch FROM events""",
}

ORACLE: dict[str, str] = {
    **{key: _with(_AE, _DIMS, body=sql) for key, sql in {**_REPORTS, **_LOOKUPS}.items()},
    **{key: _with(_AE, body=sql) for key, sql in _AE_ROLLUPS.items()},
    **{key: _with(_RV, _STATS, body=sql) for key, sql in _REVIEWS.items()},
    **{key: sql.strip() for key, sql in _PLAIN.items()},
    "report_manifest": _with(_AE, _DIMS, body="\nUNION ALL\n".join(
        f"SELECT '{key}' AS query, '{_TITLES[key]}' AS title, COUNT(*) AS row_count FROM ({sql})"
        for key, sql in _REPORTS.items()
    )),
    "report_rows": _with(_AE, _DIMS, body="\nUNION ALL\n".join(
        f"SELECT '{key}' AS query, CAST(to_json(struct_pack("
        + ", ".join(f"{c} := {_JSON_VALUE.get(c, '{}').format(c)}" for c in _REPORT_COLUMNS[key])
        + f")) AS VARCHAR) AS row_json FROM ({sql})" for key, sql in _REPORTS.items())),
    "normalise_campaigns": _with(_NUMBERED, body="SELECT * FROM numbered_campaigns"),
    "normalise_events": _with(_AE, _NUMBERED, body=f"""
SELECT {_UUID.format("event_id")} AS event_id, k.campaign_id, user_id, l.location_id, d.device_id,
       bid_amount, event_timestamp AS timestamp, ad_cost, was_clicked, click_timestamp, ad_revenue
FROM ae JOIN numbered_campaigns k ON k.campaign_name = ae.campaign_name
LEFT JOIN (SELECT n_name, row_number() OVER (ORDER BY n_name) AS location_id FROM nation) l ON n_name = location
LEFT JOIN (SELECT o_orderpriority AS name, row_number() OVER (ORDER BY o_orderpriority) AS device_id
           FROM (SELECT DISTINCT o_orderpriority FROM orders)) d ON d.name = device"""),
    "minute_buckets": _with(_TWEET_ROWS, body=_MINUTES),
    "minute_quarantine": _UNTIMED.strip(),
    "publish_json": _with(_RV, body="""
SELECT CAST(to_json(struct_pack(
  review_id := review_id, product_id := product_id, customer_id := customer_id, marketplace := marketplace,
  product_title := product_title, product_category := product_category, star_rating := star_rating,
  helpful_votes := helpful_votes, total_votes := total_votes, vine := vine, verified_purchase := verified_purchase,
  review_headline := review_headline, review_body := review_body, review_date := CAST(review_date AS VARCHAR)
)) AS VARCHAR) AS value FROM rv"""),
}
# One entity of each look-up: the answer for all of them, cut to the one.
ORACLE["campaign_performance_one"] = (
    f"SELECT * FROM ({ORACLE['campaign_performance']}) ORDER BY campaign_name LIMIT 1")
ORACLE["advertiser_spending_one"] = (
    f"SELECT * FROM ({ORACLE['advertiser_spending']}) ORDER BY advertiser_name LIMIT 1")
ORACLE["user_engagements_one"] = _with(_AE, _DIMS, body=_LOOKUPS["user_engagements"].replace(
    "JOIN users USING (user_id)", "JOIN users USING (user_id) WHERE user_id = 46 AND qty < 49"))
ORACLE["csv_round_trip"] = ORACLE["reviews_clean"]
ORACLE["stream_resumed_pages"] = ORACLE["stream_page_creates"]
ORACLE["stream_compacted_pages"] = ORACLE["stream_page_creates"]
ORACLE["incremental_daily_rollup"] = _with(_AE, body=f"""
SELECT r.*, (SELECT arg_max(e.event_id, {{'t': e.event_timestamp, 'e': e.event_id}}) FROM ae e
             WHERE e.campaign_name = r.campaign_name AND e.event_date = r.event_date) AS last_event
FROM ({_AE_ROLLUPS["campaign_performance_by_day"]}) r""")
ORACLE["late_counter_rows"] = """
SELECT campaign_name, event_date, COUNT(*) AS impressions, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS clicks, late
FROM (SELECT p_brand || '/' || p_type AS campaign_name, CAST(l_shipdate AS DATE) AS event_date, l_returnflag,
             coalesce(CAST(l_shipdate AS DATE) + INTERVAL 1 DAY <= seen - INTERVAL 400 DAY, false) AS late
      FROM lineitem JOIN part ON p_partkey = l_partkey
      LEFT JOIN (SELECT k, MAX(l_shipdate) AS seen FROM lineitem, range(1, 3) t(k) WHERE l_orderkey % 3 < k GROUP BY k)
        ON k = l_orderkey % 3)
GROUP BY campaign_name, event_date, late""".strip()
ORACLE["stream_last_ads"] = ORACLE["last_ads_per_user"]
ORACLE["stream_minute_files"] = """
WITH played AS (
  SELECT event_id % 3 AS third, CAST(user_id AS VARCHAR) AS customer_id, props AS review_body, value AS amount,
         TIMESTAMP '2024-01-01' + to_seconds(date_sub('second', TIMESTAMP '2024-01-01', ts) // 1440) AS moment FROM events
), placed AS (
  SELECT *, strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') AS review_date,
         coalesce(date_trunc('minute', moment) + INTERVAL 1 MINUTE <= seen - INTERVAL 5 MINUTE, false) AS late
  FROM played LEFT JOIN (SELECT k, MAX(moment) AS seen FROM played, range(1, 3) t(k) WHERE third < k AND amount >= 2 GROUP BY k)
    ON k = third
), written AS (
  SELECT *, CAST(to_json(struct_pack(customer_id := customer_id,
             review_date := CASE WHEN amount < 2 THEN 'on ' ELSE '' END || review_date, review_body := review_body)) AS VARCHAR) AS whole
  FROM placed
)
SELECT customer_id AS author_id, review_date AS created_at, review_body AS text,
       'tweets_' || strftime(moment, '%d_%m_%Y_%H_%M') || '.csv' AS minute_file FROM written WHERE amount >= 2 AND NOT late
UNION ALL
SELECT '', '', CASE WHEN amount < 1 THEN substr(whole, 1, 20) ELSE whole END,
       CASE WHEN amount < 1 THEN 'not JSON' WHEN amount < 2 THEN 'unreadable time' ELSE 'closed minute' END
FROM written WHERE amount < 2 OR late""".strip()
ORACLE["stream_write_counts"] = """
WITH batches(run, batch, low, high) AS (VALUES (1, 0, 0, 0), (1, 1, 1, 1), (2, 0, 0, 2))
SELECT CAST(run AS BIGINT) AS run, CAST(batch AS BIGINT) AS batch, COUNT(*) AS received,
       COUNT(DISTINCT CASE WHEN value <= 300 THEN {'d': event_type, 't': ts, 'p': json_extract_string(props, '$.k')} END) AS written,
       COUNT(*) FILTER (WHERE value IS NULL OR value > 300) AS failed
FROM events JOIN batches ON event_id % 3 BETWEEN low AND high GROUP BY run, batch""".strip()
ORACLE["two_key_read"] = _with(_AE, body="""
SELECT event_id, user_id, location, event_timestamp, ad_cost, 'user' AS asked FROM ae WHERE user_id = 46
UNION ALL
SELECT event_id, user_id, location, event_timestamp, ad_cost, 'place' FROM ae WHERE location = 'NATION_3'""")
ORACLE["report_csv_round_trip"] = _with(_AE, _DIMS, body="\nUNION ALL\n".join(
    f"SELECT '{key}' AS query, CAST(to_json(struct_pack("
    + ", ".join(f"{c} := {_JSON_VALUE.get(c, 'CAST({} AS VARCHAR)').format(c)}" for c in _REPORT_COLUMNS[key])
    + f")) AS VARCHAR) AS row_json FROM ({sql})" for key, sql in _REPORTS.items()))
ORACLE["bucketed_upsert"] = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_custkey % 7 = 0
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""".strip()
ORACLE["growing_dictionary"] = """
SELECT name, row_number() OVER (ORDER BY first_size > 2, name) AS id
FROM (SELECT p_brand || '/' || p_type AS name, MIN(p_size) AS first_size FROM part GROUP BY 1)""".strip()
ORACLE["secondary_key_read"] = _with(_AE, body="""
SELECT event_id, user_id, location, event_timestamp, ad_cost FROM ae WHERE location = 'NATION_3'""")
ORACLE["stream_refreshed_rollup"] = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, COUNT(*) AS events FROM lineitem GROUP BY 1""".strip()
