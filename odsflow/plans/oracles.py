"""The SQL counterpart of each registered query, in DuckDB's dialect over the same tables."""

from __future__ import annotations

ODS_ORDERS = """
    SELECT o_orderkey AS id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount,
           o_orderstatus AS order_status, o_orderdate AS order_time FROM orders"""

DWD_ORDERS = f"""
    SELECT *, CAST(order_time AS DATE) AS order_date,
           CASE WHEN order_status = 'F' THEN 1 ELSE 0 END AS is_success
    FROM ({ODS_ORDERS}) WHERE order_amount > 0"""

DAILY_SUMMARY = f"""
    SELECT order_date, count(*) AS order_cnt, CAST(sum(order_amount) AS DECIMAL(28,2)) AS total_amount,
           CAST(sum(is_success) AS BIGINT) AS success_order_cnt
    FROM ({DWD_ORDERS}) GROUP BY order_date"""

LINES = """
    SELECT event_id, CASE
        WHEN event_id % 50 = 0 THEN event_type
        WHEN event_id % 50 = 1 THEN concat_ws('#', event_type, 'x')
        WHEN event_id % 50 = 2 THEN concat_ws('#', event_type, CAST(user_id AS VARCHAR), 'extra')
        ELSE concat_ws('#', event_type, CAST(user_id AS VARCHAR)) END AS value
    FROM events"""

PARSED = f"""
    SELECT event_id, CASE WHEN ok THEN parts[1] END AS name, CASE WHEN ok THEN age END AS age, NOT ok AS rejected
    FROM (SELECT event_id, parts, TRY_CAST(parts[2] AS INTEGER) AS age,
                 len(parts) = 2 AND TRY_CAST(parts[2] AS INTEGER) IS NOT NULL AS ok
          FROM (SELECT event_id, string_split(value, '#') AS parts FROM ({LINES})))"""

UNTYPED = """
    SELECT event_id, CAST(value AS VARCHAR) AS s_val,
        CASE WHEN event_id % 40 = 0 THEN 'abc' WHEN event_id % 40 = 1 THEN '99999999999'
             WHEN event_id % 40 = 2 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS s_int,
        CASE WHEN event_id % 40 = 3 THEN '2024-13-01' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS s_date
    FROM events"""

TYPED = f"""
    SELECT *, TRY_CAST(s_val AS DECIMAL(12,2)) AS amount, TRY_CAST(s_val AS DECIMAL(12,1)) AS amount_rounded,
           TRY_CAST(s_int AS INTEGER) AS user_no, TRY_CAST(s_date AS DATE) AS day
    FROM ({UNTYPED})"""

CHANGES = """
    SELECT CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
           ts, event_id, user_id, value FROM events"""

SNAPSHOT = """
    SELECT 'I' AS op, TIMESTAMP '1970-01-01 00:00:00' AS ts, CAST(-1 AS BIGINT) AS event_id,
           c_custkey AS user_id, c_acctbal AS value FROM customer"""

FEED_ROWS = """
    SELECT CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
           'shop' AS db, 'accounts' AS tbl, event_id AS seq, CAST(row_no AS INTEGER) AS row_no,
           user_id + 100000 * row_no AS user_id, CAST(value AS DECIMAL(18,2)) AS amount
    FROM events, (VALUES (0), (1)) AS r(row_no)
    WHERE event_type <> 'click' AND user_id % 10 <> 0 AND (row_no = 0 OR event_type = 'purchase')"""

ALERTS = f"""
    SELECT CASE op WHEN 'I' THEN 'INSERT' WHEN 'U' THEN 'UPDATE' ELSE 'DELETE' END AS event_type,
           db, tbl, seq, row_no,
           CASE WHEN op = 'U' THEN concat('{{"old":{{"user_id":', user_id, ',"amount":',
                    CAST(amount - 1 AS DECIMAL(18,2)), '}},"new":{{"user_id":', user_id, ',"amount":', amount, '}}}}')
                ELSE concat('{{"user_id":', user_id, ',"amount":', amount, '}}') END AS data
    FROM ({FEED_ROWS})"""

MOVED = """
    SELECT *, CASE WHEN op = 'U' AND event_id % 3 = 0 THEN user_id + 1000000 ELSE user_id END AS new_id,
           CASE WHEN op <> 'U' OR event_id % 4 > 0 THEN amount END AS new_amount
    FROM (SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS amount,
                 CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op FROM events)"""

MOVED_ALERTS = f"""
    SELECT CASE op WHEN 'I' THEN 'INSERT' WHEN 'U' THEN 'UPDATE' ELSE 'DELETE' END AS event_type, 'shop' AS db,
           'accounts' AS tbl, event_id AS seq, CASE WHEN event_id % 90 <> 0 THEN 0 END AS row_no,
           CASE WHEN event_id % 90 = 0 THEN CASE WHEN op = 'U' THEN '{{{{"old":null,"new":null}}}}' END
                WHEN op = 'U' THEN concat('{{{{"old":{{{{"user_id":', user_id, ',"amount":null}}}},"new":{{{{"user_id":', new_id, ',"amount":',
                    coalesce(CAST(new_amount AS VARCHAR), 'null'), '}}}}}}}}')
                ELSE concat('{{{{"user_id":', user_id, ',"amount":', coalesce(CAST(amount AS VARCHAR), 'null'), '}}}}') END AS data
    FROM ({MOVED})""".replace("{{", "{").replace("}}", "}")


def _last_rows(changes: str) -> str:
    return f"""
    SELECT ts, event_id, user_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ({changes}))
    WHERE rn = 1 AND op <> 'D'"""


def _conform(lossless: bool) -> str:
    changed = ["CASE WHEN TRY_CAST(s_val AS DECIMAL(38,28)) <> amount THEN 'amount:changed' END"]
    rounded = ["CASE WHEN TRY_CAST(s_val AS DECIMAL(38,27)) <> amount_rounded THEN 'amount_rounded:changed' END"]
    reasons = (
        ["CASE WHEN s_val IS NOT NULL AND amount IS NULL THEN 'amount:type' END"]
        + (changed if lossless else [])
        + ["CASE WHEN s_val IS NOT NULL AND amount_rounded IS NULL THEN 'amount_rounded:type' END"]
        + (rounded if lossless else [])
        + ["CASE WHEN s_int IS NOT NULL AND user_no IS NULL THEN 'user_no:type' END",
           "CASE WHEN s_int IS NULL THEN 'user_no:null' END",
           "CASE WHEN s_date IS NOT NULL AND day IS NULL THEN 'day:type' END"]
    )
    return f"""
    SELECT event_id, amount, amount_rounded, user_no, day, concat_ws(',', {', '.join(reasons)}) AS reasons
    FROM ({TYPED})"""


# The columns of the given tables with their Spark type names.
INVENTORY_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _inventory() -> str:
    parts = []
    for table, columns in INVENTORY_COLUMNS.items():
        for position, column in enumerate(columns.split(", "), 1):
            name, type_name = column.split(" ")
            parts.append(
                f"SELECT '{table}' AS table_name, {position} AS ordinal_position, '{name}' AS column_name, "
                f"'{type_name}' AS data_type, count(*) AS row_cnt, count(*) - count({name}) AS null_cnt, "
                f"CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END AS is_nullable FROM {table}"
            )
    return " UNION ALL ".join(parts)


def _audit(copied: tuple[str, ...]) -> str:
    parts = [
        f"SELECT '{t}' AS table_name, 'success' AS status, count(*) AS rows_in, count(*) AS rows_out, "
        f"CAST(0 AS BIGINT) AS rejected FROM {t}" for t in copied
    ]
    parts += [f"SELECT '{t}', '{status}', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"
              for t, status in (("absent", "failed"), ("no_columns", "skipped"))]
    bad = ("s_int IS NULL OR user_no IS NULL OR day IS NULL OR amount IS NULL "
           "OR TRY_CAST(s_val AS DECIMAL(38,28)) <> amount")
    parts.append(f"SELECT 'events_strict', 'failed', count(*), CAST(0 AS BIGINT), "
                 f"count(*) FILTER (WHERE {bad}) FROM ({TYPED})")
    parts.append(f"SELECT 'events_lenient', 'success', count(*), count(*) FILTER (WHERE NOT ({bad})), "
                 f"count(*) FILTER (WHERE {bad}) FROM ({TYPED})")
    return " UNION ALL ".join(parts)


def _key_report() -> str:
    keys = {
        "PRIMARY": "l_orderkey,l_linenumber",
        "uk_part": "l_orderkey,l_partkey,l_suppkey",
        "uk_all": "l_orderkey,l_linenumber,l_partkey,l_suppkey,l_shipdate",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS key_name, '{columns}' AS key_columns, count(*) AS broken_keys, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_hit FROM "
        f"(SELECT count(*) AS n FROM lineitem GROUP BY {columns} HAVING count(*) > 1)"
        for name, columns in keys.items()
    )


TYPE_STRINGS = """
    SELECT p_partkey, p_size, p_partkey % 13 AS m, p_partkey % 6 AS o,
        CASE p_partkey % 13
            WHEN 0 THEN concat('decimal(', p_size % 20 + 10, ', ', p_size % 10, ')')
            WHEN 1 THEN concat('varchar(', p_size, ')') WHEN 2 THEN 'int(10) unsigned' WHEN 3 THEN 'TINYINT(1)'
            WHEN 4 THEN 'enum(''a'',''b'')' WHEN 5 THEN 'geometry' WHEN 6 THEN 'timestamp(6)' WHEN 7 THEN 'char'
            WHEN 8 THEN 'double(10,2)' WHEN 9 THEN 'longblob' WHEN 10 THEN 'json' WHEN 11 THEN 'datetime'
            ELSE 'year' END AS mysql_type,
        CASE p_partkey % 6
            WHEN 0 THEN concat('NUMBER(', p_size % 15 + 5, ')') WHEN 1 THEN concat('NUMBER(12,', p_size % 4, ')')
            WHEN 2 THEN 'NUMBER' WHEN 3 THEN concat('VARCHAR2(', p_size, ')') WHEN 4 THEN 'TIMESTAMP(6)'
            ELSE 'DOUBLE PRECISION' END AS oracle_type
    FROM part"""

# Expected names by kind of type text, in the order of TYPE_STRINGS.
_KINDS = {
    "hive": ["concat('DECIMAL(', p_size % 20 + 10, ',', p_size % 10, ')')", "'STRING'", "'INT'", "'TINYINT'",
             "'STRING'", "'STRING'", "'TIMESTAMP'", "'STRING'", "'DOUBLE'", "'STRING'", "'STRING'", "'TIMESTAMP'",
             "'STRING'"],
    "doris": ["'DECIMAL'", "'VARCHAR'", "'INT'", "'TINYINT'", "'VARCHAR'", "'VARCHAR'", "'DATETIME'", "'CHAR'",
              "'DOUBLE'", "'VARCHAR'", "'JSONB'", "'DATETIME'", "'VARCHAR'"],
    "postgres": ["concat('NUMERIC(', p_size % 20 + 10, ',', p_size % 10, ')')", "concat('VARCHAR(', p_size, ')')",
                 "'INTEGER'", "'SMALLINT'", "'VARCHAR(255)'", "'VARCHAR(255)'", "'TIMESTAMP'", "'CHAR(255)'",
                 "'DOUBLE PRECISION'", "'BYTEA'", "'JSONB'", "'TIMESTAMP'", "'INTEGER'"],
    "postgres_copy": ["'NUMERIC'", "'VARCHAR'", "'INT4'", "'INT2'", "'VARCHAR'", "'VARCHAR'", "'TIMESTAMP'",
                      "'VARCHAR'", "'FLOAT8'", "'BYTEA'", "'VARCHAR'", "'TIMESTAMP'", "'INT2'"],
    "hive_copy": ["'DECIMAL'", "'VARCHAR'", "'INT'", "'TINYINT'", "'STRING'", "'STRING'", "'TIMESTAMP'", "'CHAR'",
                  "'DOUBLE'", "'BINARY'", "'STRING'", "'TIMESTAMP'", "'INT'"],
    "odps": ["CASE WHEN p_size % 15 + 5 <= 10 THEN 'INT' ELSE 'BIGINT' END",
             "CASE WHEN p_size % 4 > 0 THEN 'DOUBLE' ELSE 'BIGINT' END", "'BIGINT'", "'STRING'", "'DATETIME'",
             "'DOUBLE'"],
    "odps_copy": ["'long'", "CASE WHEN p_size % 4 > 0 THEN 'double' ELSE 'long' END", "'long'", "'string'", "'date'",
                  "'double'"],
}


def _type_lookup() -> str:
    columns = []
    for target, names in _KINDS.items():
        number = "o" if target.startswith("odps") else "m"
        cases = " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(names))
        columns.append(f"CASE {number} {cases} END AS {target}")
    return f"SELECT p_partkey, mysql_type, oracle_type, {', '.join(columns)} FROM ({TYPE_STRINGS})"


ORACLES = {
    "daily_order_summary": DAILY_SUMMARY,
    "dwd_orders": DWD_ORDERS,
    "row_count": "SELECT count(*) AS cnt FROM orders",
    "sql_steps": """
        SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, count(*) AS line_cnt,
               count(*) FILTER (WHERE l_returnflag = 'R') AS returned_cnt,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_amount
        FROM lineitem WHERE l_quantity > 0 GROUP BY 1""",
    "range_split_read": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS supplier FROM lineitem""",
    "column_read": "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem",
    "incremental_load": f"SELECT * FROM ({ODS_ORDERS}) WHERE order_time > TIMESTAMP '2000-01-01'",
    "incremental_mark": f"""
        SELECT id, order_time, order_amount, CASE WHEN order_time < TIMESTAMP '2000-01-01' THEN 1 ELSE 2 END AS load_no
        FROM ({ODS_ORDERS})""",
    "incremental_null_marks": f"""
        SELECT id, CASE WHEN id % 50 <> 0 THEN order_time END AS order_time,
               CASE WHEN id % 50 = 0 THEN 0 WHEN order_time < TIMESTAMP '2000-01-01' THEN 1 ELSE 2 END AS load_no,
               (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0) AS unmarked_rows
        FROM ({ODS_ORDERS})""",
    "table_append": ODS_ORDERS,
    "truncate_load": DAILY_SUMMARY,
    "text_overwrite": "SELECT * FROM customer",
    "text_linefeeds": "SELECT * FROM documents",
    "orc_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "partitioned_bucketed_load": f"SELECT id, user_id, order_amount, order_time, order_status AS dt FROM ({ODS_ORDERS})",
    "partition_overwrite": f"""
        SELECT strftime(order_time, '%Y-%m') AS dt, count(*) AS order_cnt,
               CAST(sum(CASE WHEN strftime(order_time, '%Y-%m') = '1997-05' THEN 2 * order_amount
                             ELSE order_amount END) AS DECIMAL(28,2)) AS total_amount
        FROM ({ODS_ORDERS}) GROUP BY 1""",
    "retention_30d": f"""
        SELECT * FROM ({ODS_ORDERS})
        WHERE order_time >= (SELECT CAST(max(o_orderdate) AS DATE) - 30 FROM orders)""",
    "column_inventory": _inventory(),
    "exclude_list": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE upper(c_mktsegment) NOT IN ('MACHINERY', 'FURNITURE')""",
    "exclude_table": "SELECT event_id, event_type FROM events WHERE upper(event_type) NOT IN ('ERROR', 'CLICK')",
    "ordered_list_per_group": f"""
        SELECT table_name, string_agg(column_name, ',' ORDER BY ordinal_position) AS column_names
        FROM ({_inventory()}) WHERE is_nullable = 0 GROUP BY table_name""",
    "text_scrub": r"""
        SELECT doc_id, upper(lang) AS lang, replace(replace(coalesce(text, ''), '''', '\'''), chr(10), ' ') AS text
        FROM documents""",
    "type_lookup": _type_lookup(),
    "distinct_chars": """
        SELECT p_partkey, array_to_string(
            list_filter(chars, lambda x, i: list_position(chars, x) = i), '') AS chars
        FROM (SELECT p_partkey, string_split(p_name, '') AS chars FROM part)""",
    "conform_types": _conform(lossless=True),
    "conform_types_reference": _conform(lossless=False),
    "conform_lossless_numbers": f"""
        SELECT id, CAST(CAST(big AS DOUBLE) AS DECIMAL(20,0)) AS as_double, CAST(stamp AS DATE) AS as_day,
               CAST(stamp AS DATE) AS text_day,
               concat_ws(',', CASE WHEN CAST(CAST(big AS DOUBLE) AS BIGINT) <> big THEN 'as_double:changed' END,
                         CASE WHEN hours > 0 THEN 'as_day:changed' END, CASE WHEN hours > 0 THEN 'text_day:changed' END) AS reasons
        FROM (SELECT o_orderkey AS id, o_orderkey % 3 AS hours,
                     o_orderkey + CASE WHEN o_orderkey % 2 = 0 THEN 9007199254740992 ELSE 0 END AS big,
                     o_orderdate + to_hours(o_orderkey % 3) AS stamp FROM orders)""",
    "not_null_violations": f"SELECT event_id, s_date, 's_int:null' AS reasons FROM ({UNTYPED}) WHERE s_int IS NULL",
    "domain_violations": """
        SELECT event_id, event_type, 'event_type:domain' AS reasons FROM events
        WHERE event_type NOT IN ('signup', 'purchase', 'view')""",
    "length_violations": "SELECT doc_id, 'text:length' AS reasons FROM documents WHERE length(text) > 2000",
    "key_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_cnt FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "unique_violations": f"""
        SELECT s_int, s_date, count(*) AS row_cnt FROM ({UNTYPED})
        WHERE s_int IS NOT NULL AND s_date IS NOT NULL GROUP BY s_int, s_date HAVING count(*) > 1""",
    "key_report": _key_report(),
    "default_fill": """
        SELECT c_custkey, c_mktsegment, 'ZZ' AS country_code, CAST(100.50 AS DECIMAL(12,2)) AS credit,
               CAST(NULL AS DATE) AS closed_on FROM customer""",
    "error_budget": f"""
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE rejected) AS bad_rows,
               count(*) FILTER (WHERE rejected) <= 0.02 * count(*) AS within_budget FROM ({PARSED})""",
    "load_audit": _audit(tuple(INVENTORY_COLUMNS)),
    "load_tally": f"""
        SELECT status, count(*) AS table_cnt FROM ({_audit(tuple(INVENTORY_COLUMNS))}) GROUP BY status""",
    "gated_copy": """
        WITH rows AS (
            SELECT CASE WHEN o_orderkey % 20 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS o_id,
                   concat('order ', o_orderkey, repeat('!', (o_orderkey % 9)::INT)) AS o_name, o_orderstatus AS o_status FROM orders)
        SELECT o_id, o_name, o_status, concat_ws(',', CASE WHEN length(o_name) > 15 THEN 'o_name:length' END,
                   CASE WHEN o_status NOT IN ('F', 'O') THEN 'o_status:domain' END,
                   CASE WHEN count(*) OVER (PARTITION BY o_id) > 1 THEN 'key:PRIMARY' END) AS reasons
        FROM rows""",
    "delimited_parse": PARSED,
    "delimited_orders": """
        SELECT o_orderkey, CASE WHEN ok THEN o_orderkey END AS order_no, CASE WHEN ok THEN CAST(o_orderdate AS DATE) END AS day,
               CASE WHEN ok THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS total, NOT ok AS rejected
        FROM (SELECT *, o_orderkey % 40 > 2 AS ok FROM orders)""",
    "stream_delimited_append": f"SELECT event_id, name, age FROM ({PARSED}) WHERE NOT rejected",
    "cdc_normalise": f"""
        SELECT op, db, tbl, seq, row_no,
               CASE WHEN op <> 'I' THEN user_id END AS old_user_id,
               CAST(CASE op WHEN 'U' THEN amount - 1 WHEN 'D' THEN amount END AS DECIMAL(18,2)) AS old_amount,
               CASE WHEN op <> 'D' THEN user_id END AS new_user_id,
               CASE WHEN op <> 'D' THEN amount END AS new_amount
        FROM ({FEED_ROWS})""",
    "change_alerts": ALERTS,
    "alerts_with_nulls": MOVED_ALERTS,
    "stream_change_alerts": ALERTS,
    "stream_insert_append": f"SELECT ts, event_id, user_id, value FROM ({CHANGES}) WHERE op = 'I'",
    "cdc_latest_state": _last_rows(CHANGES),
    "cdc_snapshot_plus_changes": _last_rows(f"{SNAPSHOT} UNION ALL {CHANGES}"),
    "stream_cdc_upsert": _last_rows(CHANGES),
    "stream_cdc_snapshot": _last_rows(f"{SNAPSHOT} UNION ALL {CHANGES}"),
    "stream_feed_upsert": f"""
        SELECT seq, row_no, user_id, amount FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS nth FROM (
                SELECT event_id AS seq, 0 AS row_no, new_id AS user_id, new_amount AS amount, op = 'D' AS gone FROM ({MOVED}) WHERE event_id % 90 <> 0
                UNION ALL
                SELECT event_id, 0, user_id, NULL, true FROM ({MOVED}) WHERE event_id % 90 <> 0 AND op = 'U' AND new_id <> user_id))
        WHERE nth = 1 AND NOT gone""",
}
