"""The SQL counterpart of every registered query (DuckDB dialect).

Money, means and shares are rounded as exact decimals, the same in ``queries.tidy``.
The last bit of a sum depends on the order of adding, so a value is first brought to
three digits more: one that sits on a rounding tie is then on it on both sides.
"""

from __future__ import annotations

from patronflow.sources import fixtures as fx

from .tables_sql import AS_OF, lit, pick, strict, with_tables


def day(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column}"


def big(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS BIGINT) AS {name or column}"


def matrix(source: str, value: str, cohort: str = day("cohort", "initial_cohort"),
           *by: str) -> str:
    """Wide form with the columns that the data has."""
    rows = f"SELECT {', '.join([cohort, *by])}, off, {value} AS value FROM {source}"
    keys = ", ".join(["initial_cohort", *by])
    return f"PIVOT ({rows}) ON ('m' || off) USING max(value) GROUP BY {keys}"


RET = f"{day('cohort', 'initial_cohort')}, {big('off', 'since_first_order')}"
LATER = 'later AS "returning"'
PERCENT4 = "round_even(later / initial, 4)"
MONTH = "strftime(cohort, '%b %Y') AS initial_cohort"
PERCENT6 = "CAST(round(CAST(later / nullif(initial, 0) AS DECIMAL(38, 9)), 6) AS DOUBLE)"
USERS = f"{RET}, {LATER}, initial, {PERCENT4} AS percent"
REVENUE = (f'{RET}, CAST(round(CAST(later AS DECIMAL(38, 5)), 2) AS DOUBLE) AS "returning", '
           f"CAST(round(CAST(initial AS DECIMAL(38, 5)), 2) AS DOUBLE) AS initial, {PERCENT6} AS percent")
PER_USER = f"{RET}, {big('orders')}, customers, round_even(orders / customers, 2) AS proportion"
RFM = "customer, recency, frequency, CAST(round(CAST(amount AS DECIMAL(38, 9)), 6) AS DOUBLE) AS amount"
RANKS = f"{big('rank_r')}, {big('rank_f')}, {big('rank_m')}"
POINTS = ", ".join(big(c) for c in ("recency_points", "frequency_points",
                                    "monetary_points", "score"))
STAGE = (f"customer, segment, location, {day('first_order')}, {day('last_order')}, "
         f"{big('orders')}, CAST(round(CAST(gap AS DECIMAL(38, 9)), 6) AS DOUBLE) AS gap")
FLOORS = ("NOT (location = 'de_berlin' AND cohort < DATE '1997-01-01') "
          "AND NOT (location = 'fr_paris' AND cohort < DATE '1998-05-01')")
OPU_CITY = (f"SELECT {RET}, location, {big('orders')}, {big('customers')}, "
            "round_even(orders / customers, 2) AS proportion FROM opu_city "
            f"WHERE location IS NOT NULL AND {FLOORS}")
STAR = ("c.customer_id, c.customer, c.email, strftime(first_order, '%Y-%m-%d') AS first_order, "
        "strftime(last_order, '%Y-%m-%d') AS last_order, "
        "CAST(s.valid_orders AS BIGINT) AS valid_orders, "
        "CAST(vouchers_used AS BIGINT) AS vouchers_used, total_orders, city, device, "
        "CAST(open_orders AS BIGINT) AS open_orders, "
        "CAST(canceled_orders AS BIGINT) AS canceled_orders")
CLASS_COUNTS = ", ".join(big(c) for c in ("classic", "express", "lite", "persil", "plus",
                                          "no_class"))


def number(column: str, name: str | None = None) -> str:
    return f"CAST(coalesce({column}, 0) AS DOUBLE) AS {name or column}"


_PLAIN = {
    "SRC1_scan_projected": f'''
        SELECT o_orderkey AS "order", o_custkey AS customer_id, {day('o_orderdate', 'created_at')}
        FROM orders''',
    "SRC1_json_documents": f"""
        SELECT CAST(ord_no AS VARCHAR) AS order_id, CAST(ord_no AS VARCHAR) AS "order",
               CAST(customer_id AS VARCHAR) AS customer_id, {day('day', 'created_at')}, state,
               location, voucher_code, user_agent, CAST(referrer_id AS VARCHAR) AS referrer_id,
               service_class, provider, {big('is_valid')}
        FROM oo WHERE state NOT IN ('reserved', 'canceled')""",
    "SRC1_json_counts": """
        SELECT CASE state WHEN 'reserved' THEN 'not a JSON document'
               WHEN 'canceled' THEN 'a value of another type' END AS reason, count(*) AS n
        FROM oo GROUP BY 1""",
    "SRC2_scan_filtered": """
        SELECT event_id, user_id, CAST(round(CAST(value AS DECIMAL(38, 7)), 4) AS DOUBLE) AS value FROM events
        WHERE event_type = 'purchase'""",
    "SRC3_csv_semicolon": """
        SELECT CAST(ord_no AS VARCHAR) AS order_reference, first_channel, last_channel
        FROM funnel""",
    "SRC4_csv_comma": """
        SELECT CAST(ord_no AS VARCHAR) AS "ga_transactionID", source AS ga_source,
               medium AS ga_medium, 'wash' AS ga_keyword FROM web""",
    "SRC5_load_intermediate": """
        SELECT ord_no AS "order", customer, state, CAST(round(CAST(gross AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross FROM fact""",
    "SNK1_write_csv": f"SELECT {USERS} FROM ret",
    "SNK2_save_intermediate": f"SELECT {STAGE} FROM stage_base",

    "PRJ1_select_rename": f"""
        SELECT ord_no AS "order", customer_id, state, {day('created_at')}, voucher_code FROM ord""",
    "PRJ2_flatten_struct": """
        SELECT customer_id, customer AS reference, segment AS "internalData_segmentation",
               gender AS "internalData_gender", basket_gender AS "internalData_basketGender",
               raw_name AS person_name, email AS "userAccount_email",
               language AS meta_language FROM cust""",
    "PRJ3_drop_column": f"SELECT {RET}, {PERCENT4} AS percent FROM ret",
    "PRJ4_const_default": """
        SELECT ord_no AS "order", CASE WHEN state IN ('completed', 'processing') THEN 0::BIGINT
               ELSE 1::BIGINT END AS stuck FROM ord""",
    "FLT1_valid_order_flag": f"""SELECT ord_no AS "order", state, {big('is_valid')} FROM oo""",
    "FLT2_filter_equality": f"""
        SELECT ord_no AS "order", state, location, {big('is_valid')} FROM oo
        WHERE state = 'completed' AND location = 'gb_london'""",
    "FLT3_filter_conjunction_notnull": """
        SELECT ord_no AS "order", CAST(round(CAST(gross AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross FROM fact
        WHERE is_valid = 1 AND gross IS NOT NULL""",
    "FLT4_date_range_slice": f"""
        SELECT ord_no AS "order", {day('day')} FROM ord
        WHERE ord.day > DATE '2001-06-01' AND ord.day <= DATE '2001-07-01'""",
    "FLT5_cohort_floor": OPU_CITY,
    "FLT6_drop_na_rows": f"""
        SELECT {RET}, location, CAST(round(CAST(later / nullif(initial, 0) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS percent FROM rev_city
        WHERE location IS NOT NULL AND later / nullif(initial, 0) IS NOT NULL""",
    "FLT7_open_cancel_flags": """
        SELECT ord_no AS "order",
               CASE WHEN state IN ('canceled', 'completed') THEN 0::BIGINT ELSE 1::BIGINT END
                 AS open_order,
               CASE WHEN state = 'canceled' THEN 1::BIGINT ELSE 0::BIGINT END AS canceled_order
        FROM ord""",

    "JN1_left_join_dim": 'SELECT ord_no AS "order", customer, segment FROM rows',
    "JN2_left_join_rate": f"""
        SELECT ord_no AS "order", {day('day', 'rate_date')},
               CAST(round(CAST(exchange_rate AS DECIMAL(38, 7)), 4) AS DOUBLE) AS exchange_rate
        FROM ord LEFT JOIN rate ON ord.day = rate.rate_date""",
    "JN3_left_join_firstorder": f"""
        SELECT ord_no AS "order", {day('first_at', 'first_order')}
        FROM oo LEFT JOIN first_id USING (customer_id)""",
    "JN4_multi_key_join": f"SELECT {RET}, location, {LATER}, initial FROM ret_city",
    "JN5_different_key_names": """
        SELECT ord_no AS reference, o.customer_id AS customer, raw_name AS name
        FROM ord o LEFT JOIN cust ON o.customer_id = cust.customer_id""",
    "JN6_join_chain": 'SELECT ord_no AS "order", facility_name FROM served',
    "JN7_voucher_chain": """
        SELECT ord_no AS "order", voucher_code, voucher_channel
        FROM ord LEFT JOIN voucher USING (voucher_code)""",
    "JN8_right_join": f"""
        SELECT ord_no AS "orderReference", {big('rating')},
               {', '.join(f'"{t}"' for t in fx.TOPICS)} FROM rating_first""",
    "JN9_star_join": f"""
        SELECT {STAR}, {CLASS_COUNTS}, public_reference, newsletter AS newsletter_subscribed,
               CAST(round(CAST(branch_credits AS DECIMAL(38, 5)), 2) AS DOUBLE) AS branch_credits
        FROM cust c LEFT JOIN summary s ON c.customer_id = s.customer_id
             LEFT JOIN classes k ON c.customer_id = k.customer_id
             LEFT JOIN last_note n ON c.email = n.email
             LEFT JOIN credit ON c.customer = credit.customer""",
    "JN10_zip_columns": """
        SELECT email, public_reference, newsletter AS newsletter_subscribed FROM last_note""",

    "AGG1_first_valid_order": f"SELECT customer_id, {day('first_at', 'first_order')} FROM first_id",
    "AGG2_minmax_count": f"""
        SELECT customer, {day('min(day)', 'first_order')}, {day('max(day)', 'last_order')},
               {big('sum(is_valid)', 'orders')}, CAST(round(CAST(avg(gross) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS amount
        FROM fact WHERE is_valid = 1 GROUP BY customer""",
    "AGG3_conditional_count": f"""
        SELECT customer_id, count(voucher_code) AS vouchers,
               {big('sum(is_valid)', 'valid_orders')},
               count(*) FILTER (state = 'canceled') AS canceled FROM oo GROUP BY customer_id""",
    "AGG4_distinct_count": """
        SELECT location, count(DISTINCT coalesce(voucher_code, '<none>')) AS codes,
               count(DISTINCT customer_id) AS customers FROM ord GROUP BY location""",
    "AGG5_sum_by_cohort": f"""
        SELECT {day('cohort', 'initial_cohort')}, {big('status')},
               {big('CASE WHEN status = 1 THEN off END', 'since_first_order')}, location,
               CAST(round(CAST({strict('sum', 'gross')} AS DECIMAL(38, 5)), 2) AS DOUBLE) AS revenue
        FROM coh_ref GROUP BY cohort, status, CASE WHEN status = 1 THEN off END, location""",
    "AGG6_strict_min_max": f"""
        SELECT customer_id, {strict('min', 'location')} AS city,
               {strict('max', 'device')} AS device FROM oo GROUP BY customer_id""",
    "AGG7_median_global": """
        SELECT CAST(round(CAST(median(gap) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS gap FROM stage_base WHERE orders > 1""",
    "AGG8_median_by_group": """
        SELECT location, CAST(round(CAST(median(gross) AS DECIMAL(38, 7)), 4) AS DOUBLE) AS median FROM fact
        WHERE gross IS NOT NULL GROUP BY location""",
    "AGG9_mean_by_group": "SELECT segment, CAST(round(CAST(segment_gap AS DECIMAL(38, 9)), 6) AS DOUBLE) AS segment_gap FROM seg_gap",
    "AGG10_quantiles": """
        SELECT measure, CAST(p AS BIGINT) AS position, CAST(round(CAST(b[p + 1] AS DECIMAL(38, 7)), 4) AS DOUBLE) AS value
        FROM (SELECT 'recency' AS measure, b_r AS b FROM rfm_breaks
              UNION ALL SELECT 'frequency', b_f FROM rfm_breaks
              UNION ALL SELECT 'amount', b_m FROM rfm_breaks) CROSS JOIN range(6) t(p)""",
    "AGG11_first_last_in_group": """
        SELECT customer_id, max(location) FILTER (up = 1) AS first_location,
               max(location) FILTER (down = 1) AS last_location
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                          ORDER BY created_at, ord_no) AS up,
                     row_number() OVER (PARTITION BY customer_id
                          ORDER BY created_at DESC, ord_no DESC) AS down FROM ord)
        GROUP BY customer_id""",
    "AGG12_string_concat_agg": f"""
        SELECT id AS _id, concat({', '.join(f'"{t}"' for t in fx.TOPICS)}) AS marks FROM rating
        WHERE coalesce({', '.join(f'"{t}"' for t in fx.TOPICS)}) IS NOT NULL""",
    "AGG13_sum_weights": """
        SELECT ord_no AS "order", final_channel, CAST(round(CAST(sum_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) AS sum_weight
        FROM attributed""",
    "AGG14_group_by_month": f"""
        SELECT strftime(date_trunc('month', day), '%Y-%m-%d') AS month, location,
               count(DISTINCT customer) AS customers, {big('sum(is_valid)', 'orders')},
               CAST(round(CAST(sum(gross) AS DECIMAL(38, 5)), 2) AS DOUBLE) AS revenue
        FROM fact GROUP BY date_trunc('month', day), location""",
    "AGG15_frequency_table": """
        SELECT device, count(*) AS n, CAST(round(CAST(count(*) / sum(count(*)) OVER () AS DECIMAL(38, 12)), 9) AS DOUBLE) AS share
        FROM oo WHERE device IS NOT NULL GROUP BY device""",
    "AGG16_global_totals": f"""
        SELECT count(*) AS orders, {big('sum(is_valid)', 'valid_orders')},
               count(DISTINCT customer) AS customers,
               count(*) FILTER (location IS NULL) AS without_location,
               CAST(round(CAST(sum(gross) AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross FROM fact""",

    "AGG16_observed_totals": """
        SELECT unnest(['priced_orders.orders', 'rfm_base.orders', 'rfm_base.customers',
                       'rfm_report.customers', 'orders.valid', 'stage_base.orders',
                       'stage_base.groups', 'stage_report.groups', 'touchpoints.orders',
                       'attribution.weight', 'facts.valid', 'monthly.orders']) AS name,
               unnest([p, p, c, c, v, v, g, g, o, o, v, v])::DOUBLE AS value
        FROM (SELECT count(*) AS p, count(DISTINCT customer) AS c FROM fact
              WHERE is_valid = 1 AND gross IS NOT NULL),
             (SELECT count(*) AS o, sum(is_valid) AS v FROM oo),
             (SELECT count(*) AS g FROM stage_base)""",

    "DED1_dedup_by_key": 'SELECT ord_no AS "order", network FROM network',
    "DED2_distinct_rows": """
        SELECT DISTINCT ord_no AS order_reference, first_channel, last_channel FROM funnel""",
    "DED3_distinct_values": "SELECT DISTINCT location, state FROM ord",
    "WIN1_first_value_broadcast": f"""
        SELECT customer_id, {day('day')}, count(*) AS orders, {day('first_order')},
               {day('cohort', 'initial_cohort')}, {big('status')},
               {big('CASE WHEN status = 1 THEN off END', 'since_first_order')}
        FROM coh GROUP BY customer_id, coh.day, coh.first_order, cohort, status, off""",
    "WIN2_share_of_row_total": """
        SELECT l.location, s.state, count(o.ord_no) AS n,
               CAST(round(CAST(count(o.ord_no) * 100 / sum(count(o.ord_no)) OVER (PARTITION BY l.location) AS DECIMAL(38, 12)), 9) AS DOUBLE)
                 AS row_percent
        FROM (SELECT DISTINCT location FROM ord WHERE location IS NOT NULL) l CROSS JOIN (SELECT DISTINCT state FROM ord) s
        LEFT JOIN ord o ON o.location IS NOT DISTINCT FROM l.location AND o.state = s.state
        GROUP BY l.location, s.state""",
    "SRT1_sort_desc": f"SELECT {RET}, {LATER}, initial FROM ret "
                      "ORDER BY cohort DESC, off DESC",
    "RSH1_pivot_wide": matrix("ret", "later"),
    "RSH2_pivot_flags": """
        SELECT ord_no AS "order",
               """ + ", ".join(f"(service_class = 'gb-{c.upper()}')::BIGINT AS {c}" for c in
                               ("classic", "express", "lite", "persil", "plus")) + """
        FROM ord""",
    "RSH3_pivot_attributes": f"""
        SELECT ord_no AS "orderReference", {', '.join(f'"{t}"' for t in fx.TOPICS)}
        FROM rating_first WHERE coalesce({', '.join(f'"{t}"' for t in fx.TOPICS)}) IS NOT NULL""",
    "RSH4_melt_pairs": """
        SELECT ord_no AS "order", 1::BIGINT AS touchpoint, voucher_channel AS channel,
               CAST(round(CAST(voucher_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) AS weight FROM weights
        UNION ALL SELECT ord_no, 2, first_channel, CAST(round(CAST(first_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) FROM weights
        UNION ALL SELECT ord_no, 3, last_channel, CAST(round(CAST(last_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) FROM weights""",
    "RSH5_crosstab": """
        SELECT l.location, s.state, count(o.ord_no) AS n
        FROM (SELECT DISTINCT location FROM ord WHERE location IS NOT NULL) l CROSS JOIN (SELECT DISTINCT state FROM ord) s
        LEFT JOIN ord o ON o.location IS NOT DISTINCT FROM l.location AND o.state = s.state
        GROUP BY l.location, s.state""",
    "RSH6_explode_array": """
        SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 3 = 0 THEN NULL
               WHEN n = 2 THEN concat('Y', c_custkey % 89)
               WHEN c_custkey % 10 = 0 THEN '' ELSE concat('Z', c_custkey % 97) END AS zip
        FROM customer, range(1, 3) t(n)
        WHERE n = 1 OR c_custkey % 3 = 2""",
    "RSH7_explode_named": " UNION ALL ".join(
        f"SELECT id AS _id, {lit(t)} AS topic, \"{t}\" AS mark FROM rating "
        f"WHERE \"{t}\" <> ''" for t in fx.TOPICS),

    "FN1_to_date": f"""
        SELECT ord_no AS "order", {day('day')},
               CASE WHEN state <> 'new' THEN strftime(ord.day, '%Y-%m-%d') END AS parsed
        FROM ord""",
    "FN2_month_bucket": """
        SELECT o_orderkey AS "order",
               strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders""",
    "FN3_month_offset": f"""
        SELECT o_orderkey AS "order", date_diff('month', CAST(o_orderdate AS DATE), {AS_OF})
               AS months FROM orders""",
    "FN4_days_between": f"""
        SELECT o_orderkey AS "order", date_diff('day', CAST(o_orderdate AS DATE), {AS_OF})
               AS days FROM orders""",
    "FN5_start_of_month": """
        SELECT o_orderkey AS "order",
               strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS this_month,
               strftime(date_trunc('month', date_trunc('month', o_orderdate) - INTERVAL 1 DAY),
                        '%Y-%m-%d') AS last_month FROM orders""",
    "FN6_format_date": """
        SELECT customer_id, coalesce(strftime(first_order, '%Y-%m-%d'), '') AS first_order,
               strftime(first_order, '%b %Y') AS label FROM summary""",
    "FN7_regex_match": """
        SELECT p_partkey, contains(p_type, 'BRASS') OR starts_with(p_type, 'STANDARD') AS metal,
               regexp_matches(p_name, '(a|e) ?b') AS pattern FROM part""",
    "FN8_regex_replace": """
        SELECT c_custkey AS _id, 'Zoë' AS first_name,
               concat('Zoë ', split_part(c_name, '#', 1)) AS stem FROM customer""",
    "FN9_split_pick": f"""
        SELECT o_orderkey AS "order", nullif(split_part({pick(fx.SERVICE_CLASSES,
               'o_orderkey % 6')}, '-', 2), '') AS token FROM orders""",
    "FN10_concat": "SELECT c_custkey AS _id, concat('ZJ_', c_custkey) AS subscriber_key "
                   "FROM customer",
    "FN11_ascii_fold": """
        SELECT c_custkey AS _id, strip_accents(concat('Žofie Ångström-Müller Zoë ', c_name))
               AS name FROM customer""",
    "FN12_empty_fallback": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 3 = 0 THEN NULL
                    WHEN c_custkey % 10 <> 0 THEN concat('Z', c_custkey % 97)
                    WHEN c_custkey % 3 = 2 THEN concat('Y', c_custkey % 89) END AS zip
        FROM customer""",
    "FN13_null_fill": """
        SELECT ord_no AS "order", coalesce(location, 'not set') AS location,
               CAST(round(CAST(coalesce(gross, 0) AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross FROM fact""",
    "FN14_null_fill_from_column": """
        SELECT ord_no AS "order", coalesce(voucher_code, provider) AS code FROM ord""",
    "FN15_value_replace": """
        SELECT ord_no AS order_reference,
               CASE WHEN first_channel = '(unavailable)' THEN 'not set' ELSE first_channel END
                 AS first_channel,
               CASE WHEN last_channel = '(unavailable)' THEN 'not set' ELSE last_channel END
                 AS last_channel FROM funnel""",
    "FN16_round": """
        SELECT o_orderkey, round_even(o_totalprice / 7, 0) AS whole,
               round_even(o_totalprice / 7, 2) AS cents, round_even(o_orderkey / 2, 0) AS half
        FROM orders""",
    "FN17_ratio": """
        SELECT o_orderkey, CAST(round(CAST(o_totalprice / nullif(o_orderkey % 4, 0) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS ratio
        FROM orders""",
    "FN18_bin_by_breaks": """
        SELECT p_partkey, CAST(least(5, len(list_filter(b, lambda x: x <= p_size))) AS BIGINT) AS bin
        FROM part CROSS JOIN
             (SELECT quantile_cont(p_size, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS b FROM part)""",
    "FN19_equal_width_breaks": """
        SELECT p_partkey, CASE WHEN p_size = hi THEN 5::BIGINT
               ELSE CAST(floor(5 * (p_size - lo) / (hi - lo)) AS BIGINT) + 1 END AS bin
        FROM part CROSS JOIN (SELECT min(p_size) AS lo, max(p_size) AS hi FROM part)""",
    "FN20_recode": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END
               AS label FROM orders""",
    "FN21_cast_numeric": """
        SELECT ord_no AS "order", TRY_CAST(substr(voucher_code, 2) AS DOUBLE) AS number,
               TRY_CAST(user_agent AS DOUBLE) AS text,
               CAST(user_agent IS NULL AS DOUBLE) AS flag FROM ord""",
    "FN22_cast_string": "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS label FROM orders",
    "FN23_currency_convert": """
        SELECT ord_no AS "order", CAST(round(CAST(gross_after AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross_after,
               CAST(round(CAST(gross AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross_before, CAST(round(CAST(net_after AS DECIMAL(38, 5)), 2) AS DOUBLE) AS net_after,
               CAST(round(CAST(net_before AS DECIMAL(38, 5)), 2) AS DOUBLE) AS net_before FROM fact""",
    "FN24_array_len_is_null": """
        SELECT c_custkey AS _id, c_custkey % 3 = 0 AS missing,
               nullif(c_custkey % 3, 0) AS n FROM customer""",

    "BIZ1_order_facts": f"""
        SELECT ord_no AS "order", customer_id, state, {day('created_at')}, location,
               {big('is_valid')}, customer, segment, CAST(round(CAST(net_after AS DECIMAL(38, 5)), 2) AS DOUBLE) AS net_after,
               CAST(round(CAST(net_before AS DECIMAL(38, 5)), 2) AS DOUBLE) AS net_before, CAST(round(CAST(gross_after AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross_after,
               CAST(round(CAST(gross AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross_before, CAST(round(CAST(exchange_rate AS DECIMAL(38, 7)), 4) AS DOUBLE) AS exchange_rate
        FROM fact""",
    "BIZ2_rfm_base": f"SELECT {RFM} FROM rfm_base",
    "BIZ3_rfm_rank": f"SELECT {RFM}, {RANKS} FROM rfm_rank",
    "BIZ4_rfm_points": f"SELECT {RFM}, {RANKS}, {POINTS} FROM rfm_points",
    "BIZ5_rfm_class": f"SELECT {RFM}, {RANKS}, {POINTS}, {big('rfm_class')}, class_name "
                      "FROM rfm_class",
    "BIZ6_rfm_report": f"SELECT {RFM}, {RANKS}, {POINTS}, {big('rfm_class')}, class_name, "
                       "location FROM rfm",
    "BIZ7_device_class": 'SELECT ord_no AS "order", device FROM oo',
    "BIZ8_service_class_counts": f"""
        SELECT customer_id, valid_orders, {CLASS_COUNTS} FROM classes""",
    "BIZ9_order_summary": f"""
        SELECT customer_id, {day('first_order')}, {day('last_order')}, {big('valid_orders')},
               {big('vouchers_used')}, total_orders, city, device, {big('open_orders')},
               {big('canceled_orders')} FROM summary""",
    "BIZ10_customer_address": "SELECT customer_id, address_line, zip FROM cust",
    "BIZ11_customer_status": """
        SELECT customer_id, CASE WHEN valid_orders = 1 THEN 'New'
               WHEN valid_orders > 1 THEN 'Returning' ELSE 'NA' END AS customer_status
        FROM summary""",
    "BIZ12_rating_features": f"""
        SELECT customer_id, {big('rating')}, punctuality, cleaning, ironing FROM marks""",
    "BIZ13_last_notification": """
        SELECT email, public_reference, newsletter AS newsletter_subscribed FROM last_note""",
    "BIZ14_first_provider": "SELECT customer_id, provider FROM provider",
    "BIZ15_cadence": """
        SELECT customer_id, days_since_first_order, individual_frequency, overtime FROM cadence""",
    "BIZ16_customer_360": f"""
        SELECT c.customer_id, c.customer, c.email, c.name, c.segment, gender, basket_gender,
               language,
               zip,
               coalesce(strftime(first_order, '%Y-%m-%d'), '') AS first_order,
               coalesce(strftime(s.last_order, '%Y-%m-%d'), '') AS last_order,
               {number('s.valid_orders', 'valid_orders')}, {number('vouchers_used')},
               {number('total_orders')}, city, device, {number('open_orders')},
               {number('canceled_orders')}, {number('classic')}, {number('express')},
               {number('lite')}, {number('persil')}, {number('plus')}, {number('no_class')},
               {number('rating')}, {number('TRY_CAST(punctuality AS DOUBLE)', 'punctuality')},
               {number('TRY_CAST(cleaning AS DOUBLE)', 'cleaning')},
               {number('TRY_CAST(ironing AS DOUBLE)', 'ironing')}, provider, public_reference,
               {number('newsletter::INT', 'newsletter_subscribed')},
               CAST(round(CAST(coalesce(branch_credits, 0) AS DECIMAL(38, 5)), 2) AS DOUBLE) AS branch_credits, {number('recency')},
               {number('frequency')}, {number('round_even(round_even(amount, 6), 0)', 'amount')},
               {number('rank_r')}, {number('rank_f')}, {number('rank_m')},
               {number('recency_points')}, {number('frequency_points')},
               {number('monetary_points')}, {number('score')}, {number('rfm_class')}, class_name,
               rfm.location AS rfm_location,
               CASE WHEN s.valid_orders = 1 THEN 'New' WHEN s.valid_orders > 1 THEN 'Returning'
                    ELSE 'NA' END AS customer_status,
               concat('ZJ_', c.customer_id) AS subscriber_key, 'Zoe' AS first_name,
               {number('days_since_first_order')}, {number('individual_frequency')},
               {number('overtime')}
        FROM cust c LEFT JOIN summary s ON c.customer_id = s.customer_id
             LEFT JOIN classes k ON c.customer_id = k.customer_id
             LEFT JOIN marks m ON c.customer_id = m.customer_id
             LEFT JOIN provider p ON c.customer_id = p.customer_id
             LEFT JOIN cadence d ON c.customer_id = d.customer_id
             LEFT JOIN last_note n ON c.email = n.email
             LEFT JOIN credit ON c.customer = credit.customer
             LEFT JOIN rfm ON c.customer = rfm.customer""",
    "BIZ17_voucher_channel_rules": """
        SELECT voucher_channel, count(*) AS orders FROM ord LEFT JOIN voucher USING (voucher_code)
        GROUP BY voucher_channel""",
    "BIZ18_touchpoint_join": """
        SELECT ord_no AS "order", voucher_channel, first_channel, last_channel FROM points""",
    "BIZ19_fractional_weights": """
        SELECT ord_no AS "order", CAST(round(CAST(voucher_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) AS voucher_weight,
               CAST(round(CAST(first_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) AS first_weight, CAST(round(CAST(last_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) AS last_weight,
               CAST(round(CAST(rest_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) AS rest_weight FROM weights""",
    "BIZ21_attribution_report": f"""
        SELECT customer_id, ord_no AS "order", final_channel, CAST(round(CAST(sum_weight AS DECIMAL(38, 9)), 6) AS DOUBLE) AS sum_weight,
               {day('day', 'created_on')}, state, location, user_agent, {big('is_valid')}, device,
               {day('first_order')}, customer_status FROM attribution""",
    "BIZ22_ga_channel": 'SELECT ord_no AS "order", web_channel FROM web_channel',
    "BIZ23_channel_priority": 'SELECT ord_no AS "order", channel FROM priority_raw',
    "BIZ24_channel_cascade": 'SELECT ord_no AS "order", channel FROM priority',
    "BIZ25_cohort_base": f"""
        SELECT ord_no AS "order", customer_id, {day('first_order')},
               {day('cohort', 'initial_cohort')}, {big('off', 'since_first_order')},
               {big('status')} FROM coh""",
    "BIZ26_user_retention_long": f"SELECT {RET}, {LATER}, initial, {PERCENT4} AS percent "
                                 "FROM ret",
    "BIZ27_user_retention_matrix": matrix("ret", PERCENT4, MONTH),
    "BIZ28_user_retention_by_city": f"""
        SELECT {RET}, location, {LATER}, initial, {PERCENT4} AS percent FROM ret_city""",
    "BIZ29_revenue_retention_long": f"""
        SELECT {RET}, CAST(round(CAST(later AS DECIMAL(38, 5)), 2) AS DOUBLE) AS "returning", CAST(round(CAST(initial AS DECIMAL(38, 5)), 2) AS DOUBLE) AS initial,
               CAST(round(CAST(later / nullif(initial, 0) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS percent FROM rev""",
    "BIZ29_revenue_retention_matrix": f"""
        {matrix("rev_city WHERE location IS NOT NULL AND later / nullif(initial, 0) IS NOT NULL",
                PERCENT6, day("cohort", "initial_cohort"), "location")}""",
    "BIZ29_revenue_retention_sets": f"""
        SELECT 0::BIGINT AS grouping_id, location, {REVENUE} FROM rev_city
        UNION ALL SELECT 1, NULL, {REVENUE} FROM rev""",
    "BIZ28_user_retention_sets": f"""
        SELECT 0::BIGINT AS grouping_id, location, {USERS} FROM ret_city
        UNION ALL SELECT 1, NULL, {USERS} FROM ret""",
    "BIZ28_user_retention_sets_matrix": matrix(
        "(SELECT 0::BIGINT AS grouping_id, * FROM ret_city "
        "UNION ALL BY NAME SELECT 1 AS grouping_id, * FROM ret)", PERCENT4,
        day("cohort", "initial_cohort"), "grouping_id", "location"),
    "BIZ30_orders_per_user_sets": f"""
        SELECT 0::BIGINT AS grouping_id, location, {PER_USER} FROM opu_city
        UNION ALL SELECT 1, NULL, {PER_USER} FROM opu""",
    "BIZ29_revenue_retention_by_city": f"""
        SELECT {RET}, location, CAST(round(CAST(later AS DECIMAL(38, 5)), 2) AS DOUBLE) AS "returning", CAST(round(CAST(initial AS DECIMAL(38, 5)), 2) AS DOUBLE) AS initial,
               CAST(round(CAST(later / nullif(initial, 0) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS percent FROM rev_city""",
    "BIZ30_orders_per_user_long": f"""
        SELECT {RET}, {big('orders')}, customers, round_even(orders / customers, 2) AS proportion
        FROM opu""",
    "BIZ30_orders_per_user_matrix": f"""
        {matrix("opu", "round_even(orders / customers, 2)", MONTH)}""",
    "BIZ30_orders_per_user_by_city": OPU_CITY,
    "BIZ31_channel_cohorts": f"""
        SELECT {RET}, first_channel, location, {LATER}, {big('cohort_size', 'cohort')}
        FROM channel_cohorts""",
    "BIZ32_facility_cohorts": f"""
        SELECT {RET}, first_facility, {LATER}, {big('cohort_size', 'cohort')}
        FROM facility_cohorts""",
    "BIZ33_heat_breaks": f"""
        SELECT {RET}, location, CAST(round(CAST(later / initial AS DECIMAL(38, 12)), 9) AS DOUBLE) AS percent,
               CAST(CASE WHEN initial IS NOT NULL THEN
                    len(list_filter(b, lambda x: x < later / initial)) END AS BIGINT) AS bucket
        FROM ret_city CROSS JOIN (SELECT quantile_cont(later / initial,
             [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS b FROM ret)""",
    "BIZ34_stage_base": f"SELECT {STAGE} FROM stage_base",
    "BIZ35_gap_imputation": f"""
        SELECT {STAGE}, CAST(round(CAST(segment_gap AS DECIMAL(38, 9)), 6) AS DOUBLE) AS segment_gap, CAST(round(CAST(filled_gap AS DECIMAL(38, 9)), 6) AS DOUBLE) AS filled_gap
        FROM stage_gap""",
    "BIZ36_lifecycle_stage": f"""
        SELECT {STAGE}, CAST(round(CAST(segment_gap AS DECIMAL(38, 9)), 6) AS DOUBLE) AS segment_gap, CAST(round(CAST(filled_gap AS DECIMAL(38, 9)), 6) AS DOUBLE) AS filled_gap,
               {big('since', 'since_last_order')}, stage, {big('lifespan')} FROM stage""",
    "BIZ37_stage_distribution": """
        SELECT stage, count(*) AS n, CAST(round(CAST(count(*) / sum(count(*)) OVER () AS DECIMAL(38, 12)), 9) AS DOUBLE) AS share
        FROM stage GROUP BY stage""",
    "BIZ38_stage_at_cutoffs": f"""
        SELECT customer, {day('first_order')}, {day('last_before')},
               {big('n_before', 'orders_before')}, CAST(round(CAST(gap_before AS DECIMAL(38, 9)), 6) AS DOUBLE) AS gap_before,
               since_before, former_stage, {day('first_after')}, {day('last_after')},
               {big('n_after', 'orders_after')}, {big('n', 'orders')}, since_after,
               CAST(round(CAST(gap_after AS DECIMAL(38, 9)), 6) AS DOUBLE) AS gap_after, new_stage FROM tran""",
    "BIZ39_transition_matrix": """
        SELECT former_stage, new_stage, n,
               CAST(round(CAST(n * 100 / sum(n) OVER (PARTITION BY former_stage) AS DECIMAL(38, 12)), 9) AS DOUBLE) AS row_percent,
               concat(former_stage, 'InExisting') AS former_label,
               concat(new_stage, 'InNew') AS new_label FROM tmat""",
    "BIZ40_transition_report": "SELECT customer, former_stage, new_stage, location FROM tran",
    "BIZ41_customer_lifespan": f"""
        SELECT customer, location, stage, first_channel, {day('first_order')}, {big('orders')},
               {day('last_order')}, {big('lifespan')} FROM life""",
    "BIZ42_lifespan_by_city": """
        SELECT location, CAST(round(CAST(lifespan AS DECIMAL(38, 9)), 6) AS DOUBLE) AS lifespan,
               CAST(round(CAST((SELECT median(lifespan) FROM life WHERE orders > 1) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS overall
        FROM life_city""",
    "BIZ43_orders_per_user_monthly": f"""
        SELECT {day('month')}, location, first_channel, customers, {big('orders')},
               CAST(round(CAST(orders_per_user AS DECIMAL(38, 12)), 9) AS DOUBLE) AS orders_per_user FROM clv""",
    "BIZ44_aov_monthly": f"""
        SELECT {day('month')}, location, first_channel, CAST(round(CAST(gross AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross,
               {big('priced_orders')}, CAST(round(CAST(aov AS DECIMAL(38, 5)), 2) AS DOUBLE) AS aov FROM clv""",
    "BIZ45_clv": f"""
        SELECT {day('month')}, coalesce(location, '0') AS location,
               coalesce(first_channel, '0') AS first_channel, customers, {big('orders')},
               CAST(round(CAST(coalesce(gross, 0) AS DECIMAL(38, 5)), 2) AS DOUBLE) AS gross,
               {big('coalesce(priced_orders, 0)', 'priced_orders')},
               CAST(round(CAST(orders_per_user AS DECIMAL(38, 12)), 9) AS DOUBLE) AS orders_per_user, CAST(round(CAST(coalesce(aov, 0) AS DECIMAL(38, 5)), 2) AS DOUBLE) AS aov,
               CAST(round(CAST(coalesce(lifespan, 0) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS lifespan,
               CAST(round(CAST(coalesce(final_lifespan, 0) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS final_lifespan,
               CAST(round(CAST(coalesce(aov * final_lifespan / 30 * orders_per_user, 0) AS DECIMAL(38, 5)), 2) AS DOUBLE) AS clv
        FROM clv""",
}
_PLAIN["BIZ20_attribution_long"] = _PLAIN["AGG13_sum_weights"]

ORACLE = {name: with_tables(sql) for name, sql in _PLAIN.items()}
