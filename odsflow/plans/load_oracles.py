"""The SQL counterparts of `load_queries`, in DuckDB's dialect over the same tables."""

from __future__ import annotations

KEYED = """
    SELECT CASE WHEN o_orderkey % 501 <> 0 THEN CASE WHEN o_orderkey % 25 = 0 THEN o_orderkey % 1000 + 1 ELSE o_orderkey END END AS id,
           o_orderdate AS order_time, CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount,
           CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 1 ELSE 2 END AS load_no
    FROM orders"""

FEED_ORDERS = """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 4 = 0 THEN 10 ELSE 0 END AS amount,
           CASE WHEN o_orderkey % 12 = 0 THEN 'F' ELSE o_orderstatus END AS status,
           o_orderdate + CASE WHEN o_orderkey % 8 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS time
    FROM orders WHERE o_orderkey % 10 <> 0"""

POSITIONS = """
    WITH came AS (
        SELECT 'log-' || (event_id // 2500) AS feed, event_id AS seq,
               CASE WHEN event_id % 97 < 3 THEN 0 WHEN event_id % 89 < 2 THEN 2 WHEN event_id % 1009 = 5 THEN 3 ELSE 1 END AS times
        FROM events),
    there AS (SELECT feed, seq, sum(times)::BIGINT AS times FROM came WHERE times > 0 GROUP BY feed, seq),
    ahead AS (SELECT feed, seq, lead(seq) OVER (PARTITION BY feed ORDER BY seq) AS next FROM there),
    islands AS (SELECT *, seq - row_number() OVER (PARTITION BY feed, times ORDER BY seq) AS island FROM there WHERE times > 1)
    SELECT feed, 'gap' AS kind, seq + 1 AS first_seq, next - 1 AS last_seq, 0::BIGINT AS times FROM ahead WHERE next > seq + 1
    UNION ALL
    SELECT feed, 'repeat', min(seq), max(seq), times FROM islands GROUP BY feed, times, island"""

PARTS_AS_COLUMNS = """
    SELECT ['Shop', 'crm', 'Archive'][(p_partkey % 3 + 1)::INT] AS s, 'T_' || (p_partkey // 12) AS t, p_partkey // 12 AS no, p_partkey % 12 + 1 AS pos,
           p_partkey % 4 = 0 AS required,
           CASE p_partkey % 13 WHEN 0 THEN 'decimal(' || (p_size % 20 + 10) || ', ' || (p_size % 10) || ')' WHEN 1 THEN 'varchar(' || p_size || ')'
                WHEN 2 THEN 'int(10) unsigned' WHEN 3 THEN 'TINYINT(1)' WHEN 4 THEN 'enum(''a'',''b'')' WHEN 5 THEN 'geometry' WHEN 6 THEN 'timestamp(6)'
                WHEN 7 THEN 'char' WHEN 8 THEN 'double(10,2)' WHEN 9 THEN 'longblob' WHEN 10 THEN 'json' WHEN 11 THEN 'datetime' ELSE 'year' END AS type
    FROM part"""

ORACLES = {
    "keys_across_loads": f"""
        WITH rows AS ({KEYED}),
        counted AS (SELECT *, CASE WHEN id IS NULL OR count(*) OVER (PARTITION BY load_no, id) > 1 THEN 'key:PRIMARY' END AS own FROM rows),
        accepted AS (SELECT id FROM counted WHERE load_no = 1 AND own IS NULL)
        SELECT id, order_time, order_amount, load_no,
               concat_ws(',', own, CASE WHEN load_no = 2 AND id IN (SELECT id FROM accepted) THEN 'known:PRIMARY' END) AS reasons
        FROM counted""",
    "cdc_chunked_snapshot": """
        WITH everything AS (
            SELECT c_custkey AS user_id, -1 AS seq, 'signup' AS kind, TIMESTAMP '1970-01-01' AS ts, c_acctbal AS value FROM customer
            UNION ALL SELECT user_id, event_id, event_type, ts, value FROM events)
        SELECT user_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS nth FROM everything)
        WHERE nth = 1 AND kind <> 'error'""",
    "daily_summary_from_changes": f"""
        SELECT CAST(time AS DATE) AS order_date, count(*) AS order_cnt, CAST(sum(amount) AS DECIMAL(28,2)) AS total_amount,
               CAST(sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS success_order_cnt
        FROM (SELECT o_orderkey, amount, CASE WHEN o_orderkey % 4 = 0 THEN status ELSE
                     (SELECT o_orderstatus FROM orders o WHERE o.o_orderkey = f.o_orderkey) END AS status,
                     time FROM ({FEED_ORDERS}) f)
        WHERE amount > 0 GROUP BY CAST(time AS DATE)""",
    "range_digest_diff": """
        WITH old AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem),
        new AS (
            SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 991 = 0 AND l_linenumber = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
                   l_extendedprice, l_shipdate FROM old WHERE l_orderkey % 997 <> 0
            UNION ALL
            SELECT l_orderkey, l_linenumber + 100, l_partkey, l_quantity, l_extendedprice, l_shipdate FROM old WHERE l_orderkey % 983 = 0 AND l_linenumber = 1),
        net AS (
            SELECT l_orderkey, l_linenumber, count(*) FILTER (side < 0) AS n_old, count(*) FILTER (side > 0) AS n_new
            FROM (SELECT *, -1 AS side FROM old UNION ALL SELECT *, 1 FROM new)
            GROUP BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate),
        keys AS (
            SELECT l_orderkey, l_linenumber, sum(n_old)::BIGINT AS n_old, sum(n_new)::BIGINT AS n_new FROM net
            GROUP BY l_orderkey, l_linenumber HAVING count(*) FILTER (n_old <> n_new) > 0)
        SELECT *, CASE WHEN n_old = 0 THEN 'insert' WHEN n_new = 0 THEN 'delete' ELSE 'change' END AS kind FROM keys""",
    "feed_position_gaps": POSITIONS,
    "stream_position_gaps": POSITIONS,
    "dictionary_copy_plan": f"""
        WITH c AS ({PARTS_AS_COLUMNS}),
        i AS (
            SELECT s, t, CASE WHEN pos <= 3 THEN 'PRIMARY' ELSE 'uk_late' END AS name, string_agg('c' || pos, ',' ORDER BY 20 - pos) AS listed
            FROM c WHERE pos <= 9 GROUP BY ALL),
        k AS (SELECT s, t, string_agg(name || '(' || listed || ')', ' ' ORDER BY name <> 'PRIMARY') AS keys FROM i GROUP BY s, t)
        SELECT lower(s) AS table_schema, lower(t) AS table_name, 'it\\''s a table' AS comment,
               string_agg('c' || pos || ' ' || type || ' ' || CASE WHEN required THEN 0 ELSE 1 END, '; ' ORDER BY pos) AS columns,
               coalesce(any_value(keys), '') AS keys
        FROM c LEFT JOIN k USING (s, t) WHERE no % 5 <> 0 AND lower(t) <> 't_3' GROUP BY s, t""",
    "conform_oracle_numbers": """
        SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber,
               CASE WHEN l_orderkey % 30 <> 0 THEN l_quantity::INT END AS qty,
               CASE l_orderkey % 30 WHEN 1 THEN (l_extendedprice::DECIMAL(12,2) + 0.01)::DECIMAL(12,2) WHEN 2 THEN NULL ELSE l_extendedprice::DECIMAL(12,2) END AS price,
               CASE l_orderkey % 30 WHEN 3 THEN 0.1234567890::DECIMAL(38,10) WHEN 4 THEN NULL ELSE l_discount::DECIMAL(4,2)::DECIMAL(38,10) END AS rate,
               CASE l_orderkey % 30 WHEN 0 THEN 'qty:type' WHEN 1 THEN 'price:changed' WHEN 2 THEN 'price:type' WHEN 3 THEN 'rate:changed' ELSE '' END AS reasons
        FROM lineitem""",
    "composite_split_read": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 60 = 7 THEN NULL WHEN l_orderkey % 3 = 0 THEN DATE '1996-02-29' ELSE CAST(l_shipdate AS DATE) END AS ship_day
        FROM lineitem""",
    "stream_error_budget": """
        WITH counted AS (
            SELECT event_id, event_id % 50 < 3 AS bad,
                   sum(CASE WHEN event_id % 50 < 3 THEN 1 ELSE 0 END) OVER (ORDER BY event_id) AS run FROM events),
        stop AS (SELECT min(event_id) AS stopped_at FROM counted WHERE run > 120)
        SELECT count(*) FILTER (event_id < coalesce(stopped_at, 9223372036854775807)) AS total_rows,
               count(*) FILTER (bad AND event_id < coalesce(stopped_at, 9223372036854775807)) AS bad_rows, any_value(stopped_at) AS stopped_at,
               count(*) FILTER (NOT bad AND event_id < coalesce(stopped_at, 9223372036854775807)) AS good_rows
        FROM counted, stop""",
    "range_clustered_load": """
        SELECT * FROM (
            SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_suppkey END::BIGINT AS supplier, l_orderkey, l_linenumber, l_quantity FROM lineitem)
        WHERE supplier BETWEEN 5 AND 9""",
}
