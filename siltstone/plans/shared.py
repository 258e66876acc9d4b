"""Relational operators whose statement reads the same in Spark SQL and in the oracle's dialect.

Tables stand in braces: Spark binds them to DataFrames, so nothing is registered
in the session's catalog, and Catalyst prunes and pushes down as for any plan.
Sums of money are taken in decimals: their result does not depend on row order.
"""

from __future__ import annotations

SHARED: dict[str, str] = {
    # scans and projections
    "proj_star_select": """SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus AS job_status, c.c_name AS company_name, n.n_name AS country_name, r.r_name AS region_name,
        CAST(l.l_quantity AS INTEGER) AS num_vacancies FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN {customer} c ON o.o_custkey = c.c_custkey LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey LEFT JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "proj_text_en": "SELECT d.doc_id, coalesce(b.text, d.text) AS text_en FROM {documents} d LEFT JOIN {benchmark} b ON d.doc_id = b.item_id",
    # filters
    "flt_active_nondup": "SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'O' AND o_custkey IS NOT NULL",
    "flt_unclassified": "SELECT d.doc_id FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.quality IS NULL",
    "flt_detect_pending": "SELECT doc_id FROM {documents} WHERE lang IS NULL OR (lang NOT IN ('en', 'unknown') AND source IS NOT NULL)",
    "flt_is_distinct": "SELECT d.doc_id FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.quality IS DISTINCT FROM 1 OR l.toxic IS DISTINCT FROM 0",
    "flt_any_array": "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_orderkey IN (SELECT o_orderkey FROM {orders} WHERE o_orderpriority = '1-URGENT')",
    "flt_recent_window": "SELECT event_id FROM {events} WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - INTERVAL '90' DAY FROM {events})",
    "flt_isin": "SELECT doc_id, source FROM {documents} WHERE source IN ('src0', 'src1', 'src2')",
    "flt_between_dates": "SELECT o_orderkey FROM {orders} WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
    "flt_watermark": "SELECT event_id, user_id FROM {events} WHERE coalesce(ts, TIMESTAMP '1970-01-01 00:00:00') > TIMESTAMP '2024-01-05 00:00:00'",
    # joins
    "join_active_view": """SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
        LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey LEFT JOIN {region} r ON n.n_regionkey = r.r_regionkey WHERE o.o_orderstatus = 'O'""",
    "join_lateral_top1": """SELECT o_orderkey, l_linenumber, l_shipdate FROM (SELECT o.o_orderkey, l.l_linenumber, l.l_shipdate,
        row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_shipdate DESC NULLS LAST, l.l_linenumber DESC, l.l_partkey DESC) AS rn
        FROM {orders} o LEFT JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey) x WHERE rn = 1""",
    "join_anti_alias": """WITH ex AS (SELECT p_partkey AS a, p_partkey + 1 AS b FROM {part} WHERE p_partkey % 3 = 0 UNION SELECT p_partkey + 1, p_partkey FROM {part} WHERE p_partkey % 3 = 0),
        pairs AS (SELECT x.p_partkey AS a, y.p_partkey AS b FROM {part} x JOIN {part} y ON x.p_partkey + 1 = y.p_partkey)
        SELECT a, b FROM pairs WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.a = pairs.a AND ex.b = pairs.b)""",
    "join_anti_skill": "SELECT d.doc_id FROM {documents} d WHERE NOT EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id)",
    "join_semi_ledger": "SELECT c_custkey FROM {customer} c WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')",
    "join_semi_canonical_delete": "SELECT l_orderkey, l_linenumber FROM {lineitem} l WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')",
    "join_anti_missing_salary": "SELECT o.o_orderkey FROM {orders} o LEFT JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey WHERE l.l_orderkey IS NULL",
    "join_cls_update": """SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL AND l.quality IS DISTINCT FROM d.n_chars THEN CAST(l.quality AS BIGINT) ELSE d.n_chars END AS status FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
    "join_label_lookup": "SELECT s.s_suppkey, n.n_nationkey, r.r_regionkey FROM {supplier} s LEFT JOIN {nation} n ON s.s_nationkey = n.n_nationkey LEFT JOIN {region} r ON n.n_regionkey = r.r_regionkey",
    "join_hierarchy_parent": "SELECT n.n_nationkey, r.r_name AS parent FROM {nation} n LEFT JOIN {region} r ON n.n_regionkey = r.r_regionkey",
    "join_alias_scope": "SELECT c.c_custkey, n.n_name FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey WHERE c.c_mktsegment = 'MACHINERY'",
    "join_key_membership": "SELECT e.event_id FROM {events} e WHERE NOT EXISTS (SELECT 1 FROM {customer} c WHERE c.c_custkey = e.user_id)",
    "join_existing_ids": "SELECT DISTINCT e.user_id FROM {events} e WHERE e.user_id IN (SELECT c_custkey FROM {customer})",
    "join_domain_directory": "SELECT coalesce(c.k, s.k) AS k, coalesce(c.n, s.n) AS n, c.k IS NULL AS only_right FROM (SELECT c_custkey AS k, c_name AS n FROM {customer}) c FULL OUTER JOIN (SELECT s_suppkey + 50 AS k, s_name AS n FROM {supplier}) s ON c.k = s.k",
    "join_full_parity": """SELECT count(*) FILTER (WHERE b.k IS NULL) AS only_left, count(*) FILTER (WHERE a.k IS NULL) AS only_right, count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS in_both
        FROM (SELECT o_orderkey AS k FROM {orders} WHERE o_orderkey % 7 <> 0) a FULL OUTER JOIN (SELECT o_orderkey AS k FROM {orders} WHERE o_orderkey % 5 <> 0) b ON a.k = b.k""",
    # aggregations
    "agg_star_revenue": """SELECT c.c_name AS company_name, count(*) AS n_jobs, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderstatus = 'O' GROUP BY c.c_name ORDER BY n_jobs DESC, company_name LIMIT 15""",
    "agg_fill_rate": "SELECT count(*) FILTER (WHERE trim(text) <> '') AS text_filled, count(*) FILTER (WHERE trim(lang) <> '') AS lang_filled, count(*) AS total FROM {documents}",
    "agg_group_count": "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderpriority, o_orderstatus",
    "agg_pivot": """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'O') AS open, count(*) FILTER (WHERE o_orderstatus = 'F') AS filled, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending FROM {orders} GROUP BY o_orderpriority""",
    "agg_value_counts": "SELECT event_type, count(*) AS n FROM {events} GROUP BY event_type",
    "agg_distinct_coverage": "SELECT round(CAST(100 AS DOUBLE) * count(DISTINCT l.doc_id) / count(DISTINCT d.doc_id), 1) AS coverage_pct FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id",
    "agg_count_per_job": "SELECT o.o_orderkey, coalesce(n, 0) AS n FROM {orders} o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey",
    "agg_job_count_left": "SELECT c.c_custkey, count(o.o_orderkey) AS n FROM {customer} c LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey",
    "agg_source_counts": "SELECT n.n_name, count(s.s_suppkey) AS n FROM {nation} n LEFT JOIN {supplier} s ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name",
    "agg_group_having": "SELECT p_name, count(DISTINCT p_brand) AS brands FROM {part} GROUP BY p_name HAVING count(DISTINCT p_brand) > 1",
    "agg_salary_constant_source": "SELECT l_suppkey, min(l_returnflag) AS flag FROM {lineitem} WHERE l_quantity > 48 GROUP BY l_suppkey HAVING count(DISTINCT l_returnflag) = 1 AND count(DISTINCT l_linestatus) = 1",
    "agg_match_method": "SELECT method, n, round(CAST(100 AS DOUBLE) * n / nullif(sum(n) OVER (), 0), 1) AS pct FROM (SELECT coalesce(l_returnflag, 'unresolved') AS method, count(*) AS n FROM {lineitem} GROUP BY coalesce(l_returnflag, 'unresolved')) x",
    "agg_dup_keys": "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicates FROM {lineitem}",
    "agg_max_id": "SELECT coalesce(max(o_orderkey), 0) AS max_id FROM {orders}",
    "agg_greatest": "SELECT d.doc_id, greatest(coalesce(CAST(l.quality AS BIGINT), d.n_chars), d.n_chars) AS last FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id",
    "agg_run_totals": "SELECT o_orderstatus AS status, count(*) AS n FROM {orders} GROUP BY o_orderstatus",
    # windows
    "win_overlay_latest": """SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY src_priority DESC) AS rn FROM (
        SELECT doc_id, quality, 1 AS src_priority FROM {labels} UNION ALL SELECT doc_id, toxic, 2 FROM {labels} WHERE doc_id % 2 = 0) u) x WHERE rn = 1""",
    "win_latest_row": "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {orders}) x WHERE rn = 1",
    "win_earliest_row": "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM {orders}) x WHERE rn = 1",
    "win_canonical": "SELECT l_orderkey, l_linenumber, first_value(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY coalesce(l_discount, -1) DESC, l_shipdate, l_linenumber, l_partkey) AS canonical FROM {lineitem}",
    "win_global_max": "SELECT event_id FROM {events} WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM {events})",
    # sorts and limits
    "topk_families": "SELECT p_type, count(*) AS n FROM {part} GROUP BY p_type ORDER BY n DESC, p_type LIMIT 15",
    "topk_companies": "SELECT c.c_name, count(*) AS n FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey GROUP BY c.c_name ORDER BY n DESC, c.c_name LIMIT 15",
    "topk_skills": "SELECT p.p_name, count(*) AS n FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey GROUP BY p.p_name ORDER BY n DESC, p.p_name LIMIT 20",
    "topk_locations": "SELECT n_name, count(*) AS n FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 5",
    "topk_queue": "SELECT event_id FROM {events} WHERE event_type = 'error' ORDER BY ts ASC NULLS FIRST, event_id LIMIT 50",
    "sort_flag_expr": "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_mktsegment IS NOT DISTINCT FROM 'BUILDING') DESC, c_custkey) AS rn FROM {customer}) x WHERE rn = 1",
    # set operations
    "set_union_by_name": "SELECT c_custkey AS id, c_name AS name, 1 AS priority FROM {customer} UNION ALL SELECT s_suppkey, s_name, 2 FROM {supplier}",
    "set_union_distinct": "SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}",
    "set_except_keys": "SELECT o_orderkey FROM {orders} EXCEPT SELECT l_orderkey FROM {lineitem}",
    "set_intersect_keys": "SELECT c_custkey AS k FROM {customer} INTERSECT SELECT s_suppkey FROM {supplier}",
    "set_dict_update": "SELECT k, name FROM (SELECT k, name, row_number() OVER (PARTITION BY k ORDER BY pri DESC) AS rn FROM (SELECT c_custkey AS k, c_name AS name, 1 AS pri FROM {customer} UNION ALL SELECT s_suppkey, s_name, 2 FROM {supplier}) u) x WHERE rn = 1",
    "set_dedup_ids": "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM {events}) x WHERE rn = 1",
    # merges
    "mrg_upsert_coalesce": "SELECT coalesce(n.k, t.k) AS k, coalesce(n.name, t.name) AS name FROM (SELECT c_custkey AS k, c_name AS name FROM {customer}) t FULL OUTER JOIN (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS name FROM {supplier}) n ON n.k = t.k",
    "mrg_replace_children": """SELECT l_orderkey, l_linenumber FROM {lineitem} l WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderkey % 10 = 0)
        UNION ALL SELECT o_orderkey, 1 FROM {orders} WHERE o_orderkey % 10 = 0""",
    "mrg_insert_ignore": "SELECT c_custkey AS k, c_name AS name FROM {customer} UNION ALL SELECT s_suppkey, s_name FROM {supplier} s WHERE NOT EXISTS (SELECT 1 FROM {customer} c WHERE c.c_custkey = s.s_suppkey)",
    # numbers and dates
    "fn_salary_swap": "SELECT l_orderkey, l_linenumber, least(l_quantity, l_extendedprice) AS lo, greatest(l_quantity, l_extendedprice) AS hi FROM {lineitem}",
    "fn_app_method": "SELECT page_id, CASE WHEN url LIKE 'mailto:%' THEN 'email' ELSE 'url' END AS method FROM {pages}",
    # analytics
    "q_headcount_demand": "SELECT o_custkey, count(*) AS all_jobs, count(*) FILTER (WHERE o_orderstatus = 'O') AS active_jobs FROM {orders} GROUP BY o_custkey",
    "q_skill_demand_daily": "SELECT CAST(o.o_orderdate AS DATE) AS day, l.l_partkey AS skill, c.c_nationkey AS country, count(*) AS n FROM {orders} o JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON c.c_custkey = o.o_custkey GROUP BY CAST(o.o_orderdate AS DATE), l.l_partkey, c.c_nationkey",
    "q_volume_outliers": "SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) - INTERVAL '90' DAY FROM {events}) AS is_outlier FROM {events} GROUP BY CAST(ts AS DATE)",
    # further sources, filters, joins, sorts and merges
    "flt_desc_pending": "SELECT d.doc_id FROM {documents} d LEFT JOIN {benchmark} b ON b.item_id = d.doc_id WHERE d.lang NOT IN ('en', 'unknown') AND d.source IS NOT NULL AND b.text IS NULL",
    "flt_blank_text": "SELECT doc_id FROM {documents} WHERE (text IS NULL OR trim(text) = '') OR (lang IS NULL OR trim(lang) = '')",
    "agg_top_companies_sql": "SELECT c.c_name, count(*) AS n FROM {customer} c JOIN {orders} o ON o.o_custkey = c.c_custkey GROUP BY c.c_name ORDER BY n DESC, c.c_name LIMIT 10",
    "agg_group_having_host": "SELECT split_part(url, '/', 3) AS host, count(DISTINCT page_id % 5) AS codes FROM {pages} GROUP BY split_part(url, '/', 3) HAVING count(DISTINCT page_id % 5) > 1",
    "topk_dashboard": "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderpriority, o_orderstatus ORDER BY n DESC, o_orderpriority, o_orderstatus LIMIT 12",
    "sort_priority_stable": "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority LIKE '1%' THEN 0 WHEN o_orderpriority LIKE '5%' THEN 2 ELSE 1 END, o_orderkey) AS place FROM {orders}",
    "mrg_upsert_ref": """SELECT coalesce(n.k, t.k) AS k, coalesce(n.name, t.name) AS name, CASE WHEN t.k IS NULL THEN 'inserted' WHEN n.k IS NULL THEN 'kept' ELSE 'updated' END AS change
        FROM (SELECT c_custkey AS k, c_name AS name FROM {customer} WHERE c_custkey % 3 <> 0) t FULL OUTER JOIN (SELECT c_custkey AS k, lower(c_name) AS name FROM {customer} WHERE c_custkey % 2 = 0) n ON n.k = t.k""",
    "mrg_upsert_cities": """SELECT coalesce(n.name, t.name) AS name, coalesce(n.g, t.g) AS region, coalesce(n.size, t.size) AS size FROM (SELECT n_name AS name, coalesce(CASE WHEN n_nationkey % 4 <> 0 THEN n_regionkey END, 0) AS g, n_nationkey AS size FROM {nation}) t
        FULL OUTER JOIN (SELECT n_name AS name, coalesce(CASE WHEN n_nationkey % 4 <> 0 THEN n_regionkey END, 0) AS g, n_nationkey + 100 AS size FROM {nation} WHERE n_nationkey % 2 = 0) n ON n.name = t.name AND n.g = t.g""",
    "fn_embed_text": "SELECT doc_id, coalesce(source, '') || '. ' || substr(text, 1, 300) AS embed FROM {documents} WHERE text IS NOT NULL",
    "fn_as_number": "SELECT k, CASE WHEN v BETWEEN -1.7e308 AND 1.7e308 THEN v END AS v FROM (SELECT o_orderkey AS k, TRY_CAST(CASE o_orderkey % 4 WHEN 0 THEN '12.5' WHEN 1 THEN 'abc' WHEN 2 THEN 'NaN' END AS DOUBLE) AS v FROM {orders}) x",
    "fn_discovery_key": "SELECT page_id, coalesce('id:' || CASE WHEN page_id % 3 = 0 THEN CAST(page_id AS VARCHAR(20)) END, 'url:' || url) AS k FROM {pages}",
}

#: Where the dialects differ: Spark's statement, then the oracle's.
SPLIT: dict[str, tuple[str, str]] = {
    "fn_days_to_fill": (
        "SELECT o_orderkey, l_linenumber, CAST(datediff(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS BIGINT) AS days FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey",
        "SELECT o_orderkey, l_linenumber, datediff('day', o_orderdate::DATE, l_shipdate::DATE) AS days FROM orders JOIN lineitem ON l_orderkey = o_orderkey",
    ),
    "agg_describe": (
        "SELECT count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean, round(stddev_samp(l_quantity), 4) AS sd, min(l_quantity) AS lo, percentile(l_quantity, 0.25) AS q1, percentile(l_quantity, 0.5) AS q2, percentile(l_quantity, 0.75) AS q3, max(l_quantity) AS hi FROM {lineitem}",
        "SELECT count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean, round(stddev_samp(l_quantity), 4) AS sd, min(l_quantity) AS lo, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS q2, quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS hi FROM lineitem",
    ),
    "agg_array_ordered": (
        "SELECT l_orderkey, array_join(transform(sort_array(collect_list(struct(-l_quantity AS q, l_linenumber AS i, l_partkey AS p))), x -> x.p), ',') AS skills FROM {lineitem} GROUP BY l_orderkey",
        "SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY -l_quantity, l_linenumber, l_partkey) AS skills FROM lineitem GROUP BY l_orderkey",
    ),
    "agg_arg_max": (
        "SELECT source, max_by(doc_id, struct(length(text), -doc_id)) AS doc_id FROM {documents} GROUP BY source",
        "SELECT source, arg_max(doc_id, (length(text), -doc_id)) AS doc_id FROM documents GROUP BY source",
    ),
    "fn_norm_match": (
        r"""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[.,\\-_/\\\\\'"()&]', ''), '[ \\t\\n\\r\\f]+', ' ')) AS norm FROM {documents}""",
        r"""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[.,\-_/\\''"()&]', '', 'g'), '[ \t\n\r\f]+', ' ', 'g')) AS norm FROM documents""",
    ),
    "fn_word_count": (
        "SELECT doc_id, regexp_count(text, '[^ \\\\t\\\\n\\\\r\\\\f]+') AS words FROM {documents}",
        r"SELECT doc_id, len(regexp_extract_all(text, '[^ \t\n\r\f]+'))::INTEGER AS words FROM documents",
    ),
    "fn_json_obj": (
        "SELECT event_id, get_json_object(props, '$.k') AS k FROM {events}",
        "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    ),
    "fn_salary_round": (
        "SELECT o_orderkey, CAST(bround(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS BIGINT) AS rounded FROM {orders}",
        "SELECT o_orderkey, round_even(o_totalprice::DECIMAL(18,2), 0)::BIGINT AS rounded FROM orders",
    ),
    "set_dedup_ci_items": (
        "SELECT p_partkey, array_join(filter(w, (x, i) -> array_position(transform(w, y -> lower(y)), lower(x)) = i + 1), '|') AS items FROM (SELECT p_partkey, split(concat(p_name, ' ', upper(p_name), ' ', p_type), ' ') AS w FROM {part})",
        "SELECT p_partkey, array_to_string(list_filter(w, lambda x, i: list_position(list_transform(w, lambda y: lower(y)), lower(x)) = i), '|') AS items FROM (SELECT p_partkey, string_split(concat(p_name, ' ', upper(p_name), ' ', p_type), ' ') AS w FROM part)",
    ),
    "fn_non_english": (
        r"SELECT doc_id, coalesce(2 * length(regexp_replace(text, '[^\\pL]|[a-zA-Z]', '')) > length(regexp_replace(text, '[^\\pL]', '')), false) AS foreign FROM {documents}",
        r"SELECT doc_id, coalesce(2 * length(regexp_replace(text, '[^\p{L}]|[a-zA-Z]', '', 'g')) > length(regexp_replace(text, '[^\p{L}]', '', 'g')), false) AS foreign FROM documents",
    ),
    "q_job_facts": (
        """SELECT o.o_orderkey, c.c_name AS company_name, n.n_name AS country_name, r.r_name AS region_name, coalesce(k.n, 0) AS skill_count, k.skills FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
        LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey LEFT JOIN {region} r ON r.r_regionkey = n.n_regionkey LEFT JOIN (SELECT l_orderkey, count(*) AS n,
        array_join(transform(slice(sort_array(collect_list(struct(-l_quantity AS q, l_linenumber AS i, l_partkey AS p))), 1, 10), x -> x.p), ',') AS skills FROM {lineitem} GROUP BY l_orderkey) k ON k.l_orderkey = o.o_orderkey""",
        """SELECT o.o_orderkey, c.c_name AS company_name, n.n_name AS country_name, r.r_name AS region_name, coalesce(k.n, 0) AS skill_count, k.skills FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN (SELECT l_orderkey, count(*) AS n,
        array_to_string((list(l_partkey ORDER BY -l_quantity, l_linenumber, l_partkey))[1:10], ',') AS skills FROM lineitem GROUP BY l_orderkey) k ON k.l_orderkey = o.o_orderkey""",
    ),
}
