"""Common table expressions for the SQL side of the checks.

``T`` maps a name to its SQL; :func:`with_tables` puts the ones a statement
mentions, and those they mention, in front of it. The entity rules repeat
``FIXTURES.md`` part B in SQL; the report steps are written as the plain
self-joins and row-level steps of the definitions, not as the Spark plans.
"""

from __future__ import annotations

import re

from patronflow.plans.channels import (PRIORITY_RULES, TOUCHPOINT_RULES, VOUCHER_RULES,
                                       WEB_RULES)
from patronflow.sources import fixtures as fx

AS_OF = "DATE '2001-09-01'"
INVALID = "('new', 'payment_authorisation_error', 'canceled', 'reserved')"


def lit(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def pick(values, index: str) -> str:
    return "[" + ", ".join(lit(v) for v in values) + f"][CAST({index} AS BIGINT) + 1]"


def hit(rule, column: str) -> str:
    tests = []
    if rule.patterns:
        tests.append(f"regexp_matches({column}, {lit('|'.join(rule.patterns))})")
    if rule.exact:
        tests.append(f"{column} IN ({', '.join(lit(v) for v in rule.exact)})")
    return "(" + " OR ".join(tests) + ")"


def last_hit(rules, column: str, default: str) -> str:
    """Label of the highest-numbered rule that matches."""
    numbers = ", ".join(f"CASE WHEN {hit(r, column)} THEN {i} END"
                        for i, r in enumerate(rules, start=1))
    labels = "[" + ", ".join(lit(r.label) for r in rules) + "]"
    return f"coalesce({labels}[list_max([{numbers}])], {default})"


def step_by_step(rules, column: str, source: str) -> str:
    """One nested SELECT per rule, each rewriting the column of the one below."""
    sql = source
    for rule in rules:
        sql = (f"SELECT * REPLACE (CASE WHEN {hit(rule, column)} THEN {lit(rule.label)} "
               f"ELSE {column} END AS {column}) FROM ({sql})")
    return sql


def strict(agg: str, column: str) -> str:
    return f"CASE WHEN count({column}) = count(*) THEN {agg}({column}) END"


TOPIC_MARKS = ", ".join(
    f"CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN (o_orderkey + {i}) % 4 = 3 THEN '' "
    f"ELSE CAST((o_orderkey + {i}) % 4 AS VARCHAR) END AS \"{t}\""
    for i, t in enumerate(fx.TOPICS))

T = {
    # ---- entities
    "ord": f"""
        SELECT o_orderkey AS ord_no, o_custkey AS customer_id, o_orderdate AS created_at,
               CAST(o_orderdate AS DATE) AS day, o_totalprice AS price,
               o_orderpriority AS provider,
               CASE WHEN o_orderstatus = 'F' THEN 'completed'
                    WHEN o_orderstatus = 'P' THEN 'processing'
                    WHEN o_orderpriority = '1-URGENT' THEN 'canceled'
                    WHEN o_orderpriority = '2-HIGH' THEN 'reserved'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'payment_authorisation_error'
                    ELSE 'new' END AS state,
               CASE WHEN o_orderkey % 23 = 0 THEN 'de_berlin'
                    ELSE {pick(fx.LOCATIONS, 'n_regionkey')} END AS location,
               CASE WHEN o_orderkey % 3 = 0 THEN concat('V', o_orderkey % 60) END AS voucher_code,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'App (iPhone)'
                    WHEN '2-HIGH' THEN 'App (Android)'
                    WHEN '4-NOT SPECIFIED' THEN 'iPhone Android'
                    WHEN '5-LOW' THEN 'Mozilla/5.0' END AS user_agent,
               {pick(fx.SERVICE_CLASSES, 'o_orderkey % 6')} AS service_class,
               CASE WHEN o_orderkey % 17 = 0 THEN o_orderkey END AS referrer_id
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
             LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "oo": f"""
        SELECT *, CASE WHEN state IN {INVALID} THEN 0 ELSE 1 END AS is_valid,
               CASE WHEN contains(user_agent, 'Android') THEN 'android app'
                    WHEN contains(user_agent, 'iPhone') THEN 'iOS app'
                    WHEN user_agent IS NOT NULL THEN 'web app' END AS device
        FROM ord""",
    "cust": """
        SELECT c_custkey AS customer_id, concat('C', c_custkey) AS customer,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segment,
               CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
               CASE WHEN c_custkey % 5 = 0 THEN 'mixed' END AS basket_gender,
               concat('Zoë ', c_name) AS raw_name, concat('Zoe ', c_name) AS name,
               concat('u', c_custkey, '@x') AS email,
               CASE WHEN c_custkey % 2 = 0 THEN 'en' ELSE 'de' END AS language,
               CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN ''
                    ELSE concat('Z', c_custkey % 97) END AS zip,
               CASE WHEN c_custkey % 3 <> 0 THEN concat('Street ', c_custkey) END AS address_line
        FROM customer""",
    "rate": """
        SELECT d AS rate_date, 0.7 + day(d) / 1000 AS exchange_rate
        FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                 INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
        WHERE day(d) <> 13""",
    "inv": """
        SELECT o_orderkey AS invoice, o_totalprice * 0.9 AS gross_after,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS gross_before,
               o_totalprice * 0.72 AS net_after, o_totalprice * 0.8 AS net_before
        FROM orders""",
    "rows": "SELECT oo.*, customer, segment FROM oo LEFT JOIN cust USING (customer_id)",
    "fact": """
        SELECT r.*, exchange_rate,
               CASE WHEN location = 'gb_london' THEN gross_before / exchange_rate
                    WHEN location IS NOT NULL THEN gross_before END AS gross,
               CASE WHEN location = 'gb_london' THEN gross_after / exchange_rate
                    WHEN location IS NOT NULL THEN gross_after END AS gross_after,
               CASE WHEN location = 'gb_london' THEN net_before / exchange_rate
                    WHEN location IS NOT NULL THEN net_before END AS net_before,
               CASE WHEN location = 'gb_london' THEN net_after / exchange_rate
                    WHEN location IS NOT NULL THEN net_after END AS net_after
        FROM rows r LEFT JOIN inv ON r.ord_no = inv.invoice
             LEFT JOIN rate ON r.day = rate.rate_date""",
    "numbers": f"SELECT i, {pick(fx.BLOCK_NAMES, 'i')} AS name "
               f"FROM range({len(fx.BLOCK_NAMES)}) t(i)",
    "voucher": f"""
        SELECT concat('V', i) AS voucher_code,
               {last_hit(VOUCHER_RULES, 'block', "'Other'")} AS voucher_channel
        FROM (SELECT i, regexp_replace(name, '-.*', '') AS block FROM numbers)""",
    "funnel": f"""
        SELECT o_orderkey AS ord_no,
               {pick(fx.FIRST_CHANNELS, f'o_orderkey % {len(fx.FIRST_CHANNELS)}')} AS first_channel,
               {pick(fx.LAST_CHANNELS, f'o_orderkey % {len(fx.LAST_CHANNELS)}')} AS last_channel
        FROM orders, (VALUES (0), (1)) c(copy)
        WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW')
          AND (copy = 0 OR o_orderkey % 10 = 0)""",
    "tracker": f"""
        SELECT o_orderkey * 2 + copy AS id, o_orderkey AS ord_no,
               {pick(fx.NETWORKS, f'(o_orderkey + copy) % {len(fx.NETWORKS)}')} AS network,
               CASE WHEN o_orderkey % 8 = 1 THEN 'open_app' ELSE 'submit_order' END AS event
        FROM orders, (VALUES (0), (1)) c(copy)
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND (copy = 0 OR o_orderkey % 12 = 1)""",
    "web": f"""
        SELECT o_orderkey AS ord_no,
               {pick(fx.SOURCES, f'(o_orderkey + copy) % {len(fx.SOURCES)}')} AS source,
               {pick(fx.MEDIUMS, f'o_orderkey % {len(fx.MEDIUMS)}')} AS medium
        FROM orders, (VALUES (0), (1)) c(copy)
        WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')
          AND (copy = 0 OR o_orderkey % 14 = 2)""",
    "links": "SELECT DISTINCT l_orderkey AS ord_no, l_suppkey AS subprocess FROM lineitem",
    "rating": f"""
        SELECT o_orderkey * 2 + copy AS id, o_orderkey AS ord_no, o_custkey AS customer_id,
               CASE WHEN o_orderkey % 50 <> 0 THEN 1 + (o_orderkey + copy) % 5 END AS rating,
               {TOPIC_MARKS}
        FROM orders, (VALUES (0), (1)) c(copy)
        WHERE o_orderstatus <> 'O' AND (copy = 0 OR o_orderkey % 12 = 0)""",
    "note": """
        SELECT event_id, concat('u', user_id, '@x') AS email,
               concat('P', event_id) AS public_reference,
               event_type IN ('signup', 'purchase') AS newsletter
        FROM events""",
    "credit": """
        SELECT concat('C', c_custkey) AS customer, c_acctbal AS branch_credits
        FROM customer WHERE c_acctbal > 0""",
    # ---- RFM
    "rfm_base": f"""
        SELECT customer, date_diff('day', max(day), {AS_OF}) AS recency,
               count(*) AS frequency, avg(gross) AS amount
        FROM fact WHERE is_valid = 1 AND gross IS NOT NULL GROUP BY customer""",
    "rfm_breaks": """
        SELECT quantile_cont(recency, [0, 0.1, 0.2, 0.3, 0.5, 1]) AS b_r,
               quantile_cont(frequency, [0, 0.55, 0.7, 0.85, 0.95, 1]) AS b_f,
               quantile_cont(amount, [0, 0.3, 0.5, 0.7, 0.9, 1]) AS b_m
        FROM rfm_base""",
    "rfm_rank": """
        SELECT b.*,
               6 - least(5, len(list_filter(b_r, lambda x: x <= recency))) AS rank_r,
               least(5, len(list_filter(b_f, lambda x: x <= frequency))) AS rank_f,
               least(5, len(list_filter(b_m, lambda x: x <= amount))) AS rank_m
        FROM rfm_base b CROSS JOIN rfm_breaks""",
    "rfm_points": """
        SELECT *, 8 * rank_r AS recency_points, 6 * rank_f AS frequency_points,
               6 * rank_m AS monetary_points, 8 * rank_r + 6 * rank_f + 6 * rank_m AS score
        FROM rfm_rank""",
    "rfm_class": """
        SELECT p.*, least(5, len(list_filter([0, 1, 2, 3, 4, 5],
                     lambda i: 5 * (score - lo) >= i * (hi - lo)))) AS rfm_class,
               ['Churned', 'Dormant', 'Prospective', 'Active', 'Loyal'][least(5, len(list_filter(
                     [0, 1, 2, 3, 4, 5], lambda i: 5 * (score - lo) >= i * (hi - lo))))] AS class_name
        FROM rfm_points p CROSS JOIN (SELECT min(score) AS lo, max(score) AS hi FROM rfm_points)""",
    "city": f"SELECT customer, {strict('min', 'location')} AS location FROM rows GROUP BY customer",
    "rfm": """
        SELECT r.*, city.location FROM rfm_class r
        LEFT JOIN city ON r.customer IS NOT DISTINCT FROM city.customer""",
    # ---- cohorts: by document id (coh) and by reference with revenue (coh_ref)
    "first_id": "SELECT customer_id, min(created_at) AS first_at FROM oo "
                "WHERE is_valid = 1 GROUP BY customer_id",
    "coh": """
        SELECT oo.*, CAST(first_at AS DATE) AS first_order,
               CAST(date_trunc('month', first_at) AS DATE) AS cohort,
               date_diff('month', date_trunc('month', first_at), date_trunc('month', day)) AS off,
               CASE WHEN day > CAST(first_at AS DATE) THEN 1 ELSE 0 END AS status
        FROM oo LEFT JOIN first_id USING (customer_id) WHERE state = 'completed'""",
    "first_ref": "SELECT customer, min(day) AS first_order FROM fact "
                 "WHERE is_valid = 1 GROUP BY customer",
    "coh_ref": """
        SELECT fact.*, first_order, CAST(date_trunc('month', first_order) AS DATE) AS cohort,
               date_diff('month', date_trunc('month', first_order), date_trunc('month', day)) AS off,
               CASE WHEN day > first_order THEN 1 ELSE 0 END AS status
        FROM fact LEFT JOIN first_ref USING (customer) WHERE state = 'completed'""",
    "ret": """
        SELECT x.cohort, x.off, x.n AS later, y.n AS initial
        FROM (SELECT cohort, off, count(DISTINCT customer_id) AS n FROM coh
              WHERE status = 1 GROUP BY ALL) x
        LEFT JOIN (SELECT cohort, count(DISTINCT customer_id) AS n FROM coh
                   WHERE status = 0 GROUP BY ALL) y ON x.cohort = y.cohort""",
    "ret_city": """
        SELECT x.cohort, x.off, x.location, x.n AS later, y.n AS initial
        FROM (SELECT cohort, off, location, count(DISTINCT customer_id) AS n FROM coh
              WHERE status = 1 GROUP BY ALL) x
        LEFT JOIN (SELECT cohort, location, count(DISTINCT customer_id) AS n FROM coh
                   WHERE status = 0 GROUP BY ALL) y
          ON x.cohort = y.cohort AND x.location IS NOT DISTINCT FROM y.location""",
    "rev": f"""
        SELECT x.cohort, x.off, x.n AS later, y.n AS initial
        FROM (SELECT cohort, off, {strict('sum', 'gross')} AS n FROM coh_ref
              WHERE status = 1 GROUP BY ALL) x
        LEFT JOIN (SELECT cohort, {strict('sum', 'gross')} AS n FROM coh_ref
                   WHERE status = 0 GROUP BY ALL) y ON x.cohort = y.cohort""",
    "rev_city": f"""
        SELECT x.cohort, x.off, x.location, x.n AS later, y.n AS initial
        FROM (SELECT cohort, off, location, {strict('sum', 'gross')} AS n FROM coh_ref
              WHERE status = 1 GROUP BY ALL) x
        LEFT JOIN (SELECT cohort, location, {strict('sum', 'gross')} AS n FROM coh_ref
                   WHERE status = 0 GROUP BY ALL) y
          ON x.cohort = y.cohort AND x.location IS NOT DISTINCT FROM y.location""",
    "opu": """
        SELECT cohort, off, sum(is_valid) AS orders, count(DISTINCT customer) AS customers
        FROM coh_ref WHERE status = 1 GROUP BY ALL""",
    "opu_city": """
        SELECT cohort, off, location, sum(is_valid) AS orders,
               count(DISTINCT customer) AS customers
        FROM coh_ref WHERE status = 1 GROUP BY ALL""",
    # ---- stages
    "stage_base": """
        SELECT *, date_diff('day', first_order, last_order) / nullif(orders - 1, 0) AS gap
        FROM (SELECT customer, segment, location, min(day) AS first_order,
                     max(day) AS last_order, sum(is_valid) AS orders
              FROM rows WHERE is_valid = 1 GROUP BY ALL)""",
    "seg_gap": "SELECT segment, avg(gap) AS segment_gap FROM stage_base "
               "WHERE orders > 1 AND segment IS NOT NULL GROUP BY segment",
    "stage_gap": """
        SELECT b.*, segment_gap, coalesce(gap, segment_gap,
                 (SELECT median(gap) FROM stage_base WHERE orders > 1)) AS filled_gap
        FROM stage_base b LEFT JOIN seg_gap s ON b.segment = s.segment""",
    "stage": f"""
        SELECT *, date_diff('day', first_order, last_order) AS lifespan,
               CASE WHEN orders = 1 AND since < filled_gap THEN 'Stage 1A'
                    WHEN orders = 2 AND since < filled_gap THEN 'Stage 1B'
                    WHEN orders > 2 AND since < filled_gap THEN 'Stage 2'
                    ELSE 'Stage 3' END AS stage
        FROM (SELECT *, date_diff('day', last_order, {AS_OF}) AS since FROM stage_gap)""",
    "before": """
        SELECT *, date_diff('day', first_order, last_before) / nullif(n_before - 1, 0) AS gap
        FROM (SELECT customer, min(day) AS first_order, max(day) AS last_before,
                     count(*) AS n_before
              FROM rows WHERE is_valid = 1 AND day <= DATE '2001-06-01' GROUP BY customer)""",
    "after": """
        SELECT customer, min(day) AS first_after, max(day) AS last_after, count(*) AS n_after
        FROM rows WHERE is_valid = 1 AND day > DATE '2001-06-01' AND day <= DATE '2001-07-01'
        GROUP BY customer""",
    "med": "SELECT median(gap) AS m FROM before WHERE n_before > 1",
    "first_place": """
        SELECT customer, location FROM rows
        QUALIFY row_number() OVER (PARTITION BY customer ORDER BY created_at, ord_no) = 1""",
    "tran_raw": """
        SELECT b.customer, first_order, last_before, n_before, coalesce(gap, m) AS gap_before,
               date_diff('day', last_before, DATE '2001-06-01') AS since_before,
               first_after, coalesce(last_after, last_before) AS last_after,
               coalesce(n_after, 0) AS n_after, n_before + coalesce(n_after, 0) AS n,
               date_diff('day', coalesce(last_after, last_before), DATE '2001-07-01') AS since_after,
               coalesce(date_diff('day', first_order, coalesce(last_after, last_before))
                 / nullif(n_before + coalesce(n_after, 0) - 1, 0), m) AS gap_after
        FROM before b LEFT JOIN after a ON b.customer = a.customer CROSS JOIN med""",
    "tran": """
        SELECT t.*, first_place.location,
               CASE WHEN since_before < gap_before THEN
                    CASE n_before WHEN 1 THEN 'Stage 1A' WHEN 2 THEN 'Stage 1B' ELSE 'Stage 2' END
                    ELSE 'Stage 3' END AS former_stage,
               CASE WHEN since_after < gap_after THEN
                    CASE n WHEN 1 THEN 'Stage 1A' WHEN 2 THEN 'Stage 1B' ELSE 'Stage 2' END
                    ELSE 'Stage 3' END AS new_stage
        FROM tran_raw t LEFT JOIN first_place ON t.customer = first_place.customer""",
    "tmat": """
        SELECT f.former_stage, w.new_stage, count(t.customer) AS n
        FROM (SELECT DISTINCT former_stage FROM tran) f
        CROSS JOIN (SELECT DISTINCT new_stage FROM tran) w
        LEFT JOIN tran t ON t.former_stage = f.former_stage AND t.new_stage = w.new_stage
        GROUP BY ALL""",
    # ---- attribution
    "funnel_min": f"""
        SELECT ord_no, {strict('min', 'first_channel')} AS first_channel,
               {strict('min', 'last_channel')} AS last_channel
        FROM (SELECT DISTINCT * FROM funnel) GROUP BY ord_no""",
    "points": """
        SELECT oo.*,
               CASE WHEN v.voucher_channel IS NULL OR v.voucher_channel = '(unavailable)'
                    THEN 'not set' ELSE v.voucher_channel END AS voucher_channel,
               CASE WHEN first_channel IS NULL OR first_channel = '(unavailable)'
                    THEN 'not set' ELSE first_channel END AS first_channel,
               CASE WHEN last_channel IS NULL OR last_channel = '(unavailable)'
                    THEN 'not set' ELSE last_channel END AS last_channel
        FROM oo LEFT JOIN voucher v ON oo.voucher_code IS NOT DISTINCT FROM v.voucher_code
             LEFT JOIN funnel_min f ON oo.ord_no = f.ord_no""",
    "weights": """
        SELECT *, 1 - (voucher_weight + first_weight + last_weight) AS rest_weight
        FROM (SELECT *,
               CASE WHEN voucher_channel = 'not set' THEN 0 ELSE w END AS voucher_weight,
               CASE WHEN first_channel = 'not set' THEN 0 ELSE w END AS first_weight,
               CASE WHEN last_channel = 'not set' THEN 0 ELSE w END AS last_weight
        FROM (SELECT *, CASE (voucher_channel <> 'not set')::INT + (first_channel <> 'not set')::INT
                             + (last_channel <> 'not set')::INT
                        WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 0.5::DOUBLE
                        WHEN 3 THEN 0.33::DOUBLE ELSE 0.0::DOUBLE END AS w FROM points))""",
    "melted": """
        SELECT ord_no, voucher_channel AS channel, voucher_weight AS weight FROM weights
        UNION ALL SELECT ord_no, first_channel, first_weight FROM weights
        UNION ALL SELECT ord_no, last_channel, last_weight FROM weights
        UNION ALL SELECT ord_no, 'not set', rest_weight FROM weights""",
    "attributed": f"""
        SELECT ord_no, {last_hit(TOUCHPOINT_RULES, 'channel', 'channel')} AS final_channel,
               sum(weight) AS sum_weight
        FROM melted GROUP BY ALL""",
    "attribution": """
        SELECT a.*, customer_id, day, state, location, user_agent, is_valid, device,
               CAST(first_at AS DATE) AS first_order,
               CASE WHEN created_at > first_at THEN 'Returning' ELSE 'New' END AS customer_status
        FROM attributed a LEFT JOIN oo USING (ord_no) LEFT JOIN first_id USING (customer_id)""",
    # ---- priority channels
    "network": """
        SELECT ord_no, network FROM tracker WHERE event = 'submit_order'
        QUALIFY row_number() OVER (PARTITION BY ord_no ORDER BY id) = 1""",
    "web_first": """
        SELECT ord_no, CASE WHEN medium IN ('(none)', '(not set)') THEN source
                            ELSE medium END AS web_channel
        FROM web QUALIFY row_number() OVER (PARTITION BY ord_no
                         ORDER BY source NULLS FIRST, medium NULLS FIRST) = 1""",
    "web_channel": step_by_step(WEB_RULES, "web_channel", "SELECT * FROM web_first"),
    "priority_raw": """
        SELECT oo.*, CASE WHEN referrer_id IS NOT NULL THEN 'Refer a Friend'
                    WHEN voucher_channel IS NOT NULL THEN voucher_channel
                    WHEN network IS NOT NULL THEN network
                    WHEN web_channel IS NOT NULL THEN web_channel
                    ELSE 'Direct' END AS channel
        FROM oo LEFT JOIN voucher USING (voucher_code)
             LEFT JOIN network USING (ord_no) LEFT JOIN web_channel USING (ord_no)""",
    "priority": step_by_step(PRIORITY_RULES, "channel", "SELECT * FROM priority_raw"),
    "pcoh": """
        SELECT coh.*, channel FROM coh JOIN priority USING (ord_no)""",
    "first_channel": f"""
        SELECT customer_id, {strict('min', 'channel')} AS first_channel
        FROM pcoh WHERE status = 0 GROUP BY customer_id""",
    "pcoh_first": "SELECT pcoh.*, first_channel FROM pcoh LEFT JOIN first_channel USING (customer_id)",
    "channel_cohorts": """
        SELECT x.cohort, x.off, x.first_channel, x.location, x.n AS later,
               coalesce(y.n, 0) AS cohort_size
        FROM (SELECT cohort, off, first_channel, location, count(DISTINCT customer_id) AS n
              FROM pcoh_first WHERE status = 1 GROUP BY ALL) x
        LEFT JOIN (SELECT cohort, first_channel, location, count(DISTINCT customer_id) AS n
                   FROM pcoh_first WHERE status = 0 GROUP BY ALL) y
          ON x.cohort = y.cohort AND x.first_channel IS NOT DISTINCT FROM y.first_channel
         AND x.location IS NOT DISTINCT FROM y.location""",
    # ---- facilities
    "chain": """
        SELECT s.s_suppkey AS subprocess,
               CASE WHEN d.s_suppkey % 8 < 7 THEN concat('Facility_', d.s_suppkey % 8) END
                 AS facility_name
        FROM supplier s LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) d
          ON s.s_suppkey = d.s_suppkey""",
    "served": """
        SELECT oo.*, facility_name FROM oo LEFT JOIN links USING (ord_no)
        LEFT JOIN chain USING (subprocess)""",
    "fcoh": """
        SELECT coh.*, facility_name FROM coh JOIN
          (SELECT ord_no, facility_name FROM served) s USING (ord_no)""",
    "first_facility": f"""
        SELECT customer_id, {strict('min', 'facility_name')} AS first_facility
        FROM fcoh WHERE status = 0 GROUP BY customer_id""",
    "fcoh_first": "SELECT fcoh.*, first_facility FROM fcoh LEFT JOIN first_facility USING (customer_id)",
    "facility_cohorts": """
        SELECT x.cohort, x.off, x.first_facility, x.n AS later, coalesce(y.n, 0) AS cohort_size
        FROM (SELECT cohort, off, first_facility, count(DISTINCT customer_id) AS n
              FROM fcoh_first WHERE status = 1 GROUP BY ALL) x
        LEFT JOIN (SELECT cohort, first_facility, count(DISTINCT customer_id) AS n
                   FROM fcoh_first WHERE status = 0 GROUP BY ALL) y
          ON x.cohort = y.cohort AND x.first_facility IS NOT DISTINCT FROM y.first_facility""",
    # ---- customer 360
    "classes": """
        SELECT customer_id, count(*) AS valid_orders,
               sum((service_class = 'gb-CLASSIC')::INT) AS classic,
               sum((service_class = 'gb-EXPRESS')::INT) AS express,
               sum((service_class = 'gb-LITE')::INT) AS lite,
               sum((service_class = 'gb-PERSIL')::INT) AS persil,
               sum((service_class = 'gb-PLUS')::INT) AS plus,
               sum((service_class = 'gb')::INT) AS no_class
        FROM oo WHERE is_valid = 1 GROUP BY customer_id""",
    "summary_valid": """
        SELECT customer_id, min(day) AS first_order, max(day) AS last_order,
               sum(is_valid) AS valid_orders, count(voucher_code) AS vouchers_used
        FROM oo WHERE is_valid = 1 GROUP BY customer_id""",
    "summary_all": f"""
        SELECT customer_id, count(DISTINCT ord_no) AS total_orders,
               {strict('min', 'location')} AS city, {strict('min', 'device')} AS device,
               sum((state NOT IN ('canceled', 'completed'))::INT) AS open_orders,
               sum((state = 'canceled')::INT) AS canceled_orders
        FROM oo GROUP BY customer_id""",
    "summary": """
        SELECT a.*, first_order, last_order, valid_orders, vouchers_used
        FROM summary_all a LEFT JOIN summary_valid USING (customer_id)""",
    "rating_first": "SELECT * FROM rating QUALIFY "
                    "row_number() OVER (PARTITION BY ord_no ORDER BY id) = 1",
    "marks": f"""
        SELECT oo.customer_id, {strict('max', 'rating')} AS rating,
               {strict('max', '"Punctuality"')} AS punctuality,
               {strict('max', '"CleaningQ"')} AS cleaning,
               {strict('max', '"IroningQ"')} AS ironing
        FROM oo LEFT JOIN rating_first r ON oo.ord_no = r.ord_no GROUP BY oo.customer_id""",
    "last_note": """
        SELECT email, public_reference, newsletter FROM note
        QUALIFY row_number() OVER (PARTITION BY email ORDER BY event_id DESC) = 1""",
    "provider": """
        SELECT customer_id, provider FROM oo
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_at, ord_no) = 1""",
    "cadence": f"""
        SELECT *, date_diff('day', last_order, {AS_OF}) - individual_frequency AS overtime
        FROM (SELECT customer_id, last_order,
                     date_diff('day', first_order, {AS_OF}) AS days_since_first_order,
                     round_even(date_diff('day', first_order, last_order)
                                / nullif(valid_orders - 1, 0), 0) AS individual_frequency
              FROM summary)""",
    # ---- lifetime value
    "chan_ref": "SELECT customer, first_channel FROM cust LEFT JOIN first_channel USING (customer_id)",
    "life_rows": """
        SELECT s.*, first_channel,
               row_number() OVER (PARTITION BY s.customer
                 ORDER BY first_order, location NULLS FIRST) AS up,
               row_number() OVER (PARTITION BY s.customer
                 ORDER BY first_order DESC, location DESC NULLS LAST) AS down
        FROM stage s LEFT JOIN chan_ref c ON s.customer = c.customer""",
    "life": """
        SELECT *, date_diff('day', first_order, last_order) AS lifespan FROM (
          SELECT customer, max(location) FILTER (up = 1) AS location,
                 max(stage) FILTER (up = 1) AS stage,
                 max(first_channel) FILTER (up = 1) AS first_channel,
                 max(first_order) FILTER (up = 1) AS first_order,
                 sum(orders) AS orders, max(last_order) FILTER (down = 1) AS last_order
          FROM life_rows GROUP BY customer)""",
    "life_city": "SELECT location, median(lifespan) AS lifespan FROM life "
                 "WHERE orders > 1 AND stage = 'Stage 3' GROUP BY location",
    "fact_chan": """
        SELECT fact.*, first_channel, CAST(date_trunc('month', day) AS DATE) AS month
        FROM fact LEFT JOIN chan_ref USING (customer)""",
    "per_user": """
        SELECT month, location, first_channel, count(DISTINCT customer) AS customers,
               sum(is_valid) AS orders
        FROM fact_chan WHERE is_valid = 1 GROUP BY ALL""",
    "aov": """
        SELECT month, location, first_channel, sum(gross) AS gross,
               sum(is_valid) AS priced_orders
        FROM fact_chan WHERE gross IS NOT NULL GROUP BY ALL""",
    "clv": """
        SELECT p.month, p.location, p.first_channel, customers, orders, gross, priced_orders,
               orders / customers AS orders_per_user, gross / nullif(priced_orders, 0) AS aov,
               lifespan,
               CASE WHEN p.location = 'fr_paris'
                    THEN (SELECT median(lifespan) FROM life WHERE orders > 1)
                    ELSE lifespan END AS final_lifespan
        FROM per_user p
        LEFT JOIN aov a ON p.month = a.month AND p.location IS NOT DISTINCT FROM a.location
             AND p.first_channel IS NOT DISTINCT FROM a.first_channel
        LEFT JOIN life_city l ON p.location IS NOT DISTINCT FROM l.location""",
}

# Names a statement reads from; report columns may share a table's name.
_READS = re.compile(r"\b(?:FROM|JOIN)\s+\(?([a-z_]+)\b")
_TEXT = re.compile(r"'(?:[^']|'')*'")


def with_tables(body: str) -> str:
    """The statement with the tables it needs, in dependency order."""
    done: dict[str, str] = {}

    def add(sql: str) -> None:
        for name in dict.fromkeys(_READS.findall(_TEXT.sub("''", sql))):
            if name in T and name not in done:
                add(T[name])
                done[name] = T[name]

    add(body)
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in done.items())
    return f"WITH {tables}\n{body}" if tables else body
