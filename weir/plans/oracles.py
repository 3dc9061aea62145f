"""The same results in plain SQL for DuckDB, straight from the base tables."""

from __future__ import annotations

# App logs: usable events with the first day of their device and the settled flag. Days are
# counted at +8 hours; milliseconds are rounded down.
_LOGS = """
WITH usable AS (
  SELECT event_id AS seq, user_id, event_type AS kind, 'mid_' || user_id AS mid,
         epoch_us(ts) // 1000 AS ms,
         CAST(ts + INTERVAL 8 HOUR AS DATE) AS today,
         event_id % 3 <> 0 AS claims,
         event_type IN ('view', 'purchase')
           OR (event_type IN ('signup', 'error') AND event_id % 2 = 0) AS shows,
         event_type IN ('click', 'purchase') AS acts
  FROM events WHERE event_id % 97 <> 0
), firsts AS (
  SELECT mid, CAST(arg_min(CASE WHEN claims THEN today ELSE today - 1 END, seq) AS DATE) AS first_date
  FROM usable GROUP BY mid
), logs AS (
  SELECT u.*, claims AND today <> first_date AS flipped,
         CASE WHEN claims AND today = first_date THEN '1' ELSE '0' END AS is_new
  FROM usable u JOIN firsts USING (mid)
)
"""

_MESSAGES = (
    _LOGS
    + """, messages AS (
  SELECT seq, 'dwd_traffic_error_log' AS topic, mid, is_new, kind AS page_id, ms AS ts,
         CAST(NULL AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS action_id
  FROM logs WHERE kind = 'error'
  UNION ALL
  SELECT seq, 'dwd_traffic_start_log', mid, is_new, NULL, ms, NULL, NULL FROM logs WHERE kind = 'signup'
  UNION ALL
  SELECT seq, 'dwd_traffic_page_log', mid, is_new, kind, ms, NULL, NULL FROM logs WHERE kind <> 'signup'
  UNION ALL
  SELECT seq, 'dwd_traffic_display_log', mid, is_new, kind, ms, n, NULL
  FROM logs, unnest(range(1, seq % 4 + 2)) AS t(n) WHERE shows AND kind <> 'signup'
  UNION ALL
  SELECT seq, 'dwd_traffic_action_log', mid, is_new, kind, ms + n, NULL, 'a' || n
  FROM logs, unnest(range(1, seq % 2 + 2)) AS t(n) WHERE acts
)
"""
)

_FANOUT = (
    _MESSAGES
    + """
SELECT seq, topic, CAST(NULL AS VARCHAR) AS reason, mid, is_new, page_id, ts, position, action_id FROM messages
UNION ALL
SELECT event_id, 'dirty', 'not_json', NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id % 97 = 0
"""
)

# Change log: one row per message, before anything is dropped.
_CHANGES = """
WITH source AS (
  SELECT 0 AS number, 'customer' AS source_table, CAST(c_custkey AS BIGINT) AS k, c_name AS name,
         c_mktsegment AS extra FROM customer
  UNION ALL SELECT 1, 'supplier', s_suppkey, s_name, NULL FROM supplier
  UNION ALL SELECT 2, 'nation', n_nationkey, n_name, NULL FROM nation
  UNION ALL SELECT 3, 'part', p_partkey, p_name, NULL FROM part
), messages AS (
  SELECT *, (k * 3 + version) * 4 + number AS seq, name || '_v' || version AS named,
         CASE WHEN version = 1 THEN 'update' WHEN version = 2 THEN 'delete'
              WHEN k % 5 = 0 THEN 'bootstrap-insert' ELSE 'insert' END AS type,
         CASE source_table WHEN 'customer' THEN 'dim_customer' WHEN 'supplier' THEN 'dim_supplier'
              WHEN 'nation' THEN 'dim_nation' END AS sink_table
  FROM source, unnest(range(0, 3)) AS t(version)
  WHERE version = 0 OR (version = 1 AND k % 2 = 0) OR (version = 2 AND k % 10 = 0)
), changes AS (
  SELECT * FROM messages WHERE seq % 101 <> 0 AND version < 2
)
"""

_DIM_ROUTE = (
    _CHANGES
    + """
SELECT seq, source_table, sink_table, CAST(k AS VARCHAR) AS pk FROM changes WHERE sink_table IS NOT NULL
"""
)

# Rules that change all through the change log, and the table that the first valid one of a target made.
_HISTORY = (
    _CHANGES
    + """
, history AS (
  SELECT s_suppkey * 180 AS seq, s_suppkey AS n, CASE s_suppkey % 4 WHEN 0 THEN 'customer' WHEN 1 THEN 'supplier' WHEN 2 THEN 'nation' ELSE 'part' END AS source_table,
         CASE s_suppkey % 4 WHEN 0 THEN 'c_custkey' WHEN 1 THEN 's_suppkey' WHEN 2 THEN 'id' ELSE 'p_partkey' END AS key,
         CASE s_suppkey % 4 WHEN 0 THEN 'c_name' WHEN 1 THEN 's_name' WHEN 2 THEN 'n_name' ELSE 'p_name' END AS name
  FROM supplier WHERE s_suppkey % 11 <> 0 AND s_suppkey % 5 <> 4
), in_order AS (
  SELECT seq, source_table, key, 'dim_' || source_table || '_' || (n // 4 % 3) AS sink_table,
         CASE n % 5 WHEN 1 THEN [name, key] WHEN 2 THEN [key] ELSE [key, name] END AS columns
  FROM history WHERE CASE WHEN n % 3 = 0 THEN key = 'id' ELSE n % 7 <> 3 END
), made AS (
  SELECT sink_table, arg_min(columns, seq) AS table_columns FROM in_order GROUP BY sink_table
), named_ AS (
  SELECT seq, source_table, k, CASE source_table WHEN 'customer' THEN ['c_custkey', 'c_name'] WHEN 'supplier' THEN ['s_name', 's_suppkey']
                                  WHEN 'nation' THEN ['id', 'n_name'] ELSE ['p_name', 'p_partkey'] END AS fields
  FROM changes
), as_of AS (
  SELECT c.seq, c.source_table, c.k, r.sink_table, m.table_columns, list_filter(c.fields, lambda x: list_contains(r.columns, x)) AS kept
  FROM named_ c ASOF LEFT JOIN in_order r ON c.source_table = r.source_table AND c.seq >= r.seq
  LEFT JOIN made m ON m.sink_table = r.sink_table
)
SELECT seq, source_table, sink_table, CASE WHEN sink_table IS NOT NULL THEN CAST(k AS VARCHAR) END AS pk,
       CASE WHEN sink_table IS NULL THEN 'unmatched' WHEN len(list_filter(kept, lambda x: NOT list_contains(table_columns, x))) > 0 THEN 'rejected'
            ELSE 'accepted' END AS status,
       CASE WHEN len(list_filter(kept, lambda x: NOT list_contains(table_columns, x))) > 0 THEN 'unknown_column' END AS reason,
       CASE WHEN sink_table IS NOT NULL THEN array_to_string(kept, ',') END AS kept
FROM as_of
"""
)

_DIM_UPSERT = (
    _CHANGES
    + """
, rows_ AS (SELECT * FROM changes WHERE sink_table IS NOT NULL)
SELECT sink_table, CAST(k AS VARCHAR) AS pk,
       CASE sink_table WHEN 'dim_customer' THEN 'c_custkey' WHEN 'dim_nation' THEN 'id' ELSE 's_suppkey' END AS "column",
       CAST(k AS VARCHAR) AS value
FROM rows_ GROUP BY sink_table, k
UNION ALL
SELECT sink_table, CAST(k AS VARCHAR), CASE sink_table WHEN 'dim_customer' THEN 'c_name' ELSE 'n_name' END, arg_max(named, seq)
FROM rows_ WHERE sink_table <> 'dim_supplier' GROUP BY sink_table, k
UNION ALL
SELECT sink_table, CAST(k AS VARCHAR), 'c_mktsegment', extra
FROM rows_ WHERE sink_table = 'dim_customer' AND version = 0 AND extra IS NOT NULL
"""
)

# Routing changes derived from part: the rules that are valid, with their columns.
_RULES = """
WITH feed AS (
  SELECT p_partkey AS seq,
         CASE WHEN p_partkey % 13 <> 0 THEN 'src_' || p_size END AS source_table,
         'dim_' || lower(p_type) || '_' || (p_partkey % 3) AS sink_table,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE
           CASE p_partkey % 5 WHEN 0 THEN 'id,name,' WHEN 1 THEN 'id, name,extra' WHEN 2 THEN 'name,id'
                              WHEN 3 THEN 'code,,id' ELSE 'code,label' END END AS sink_columns,
         CASE p_partkey % 4 WHEN 1 THEN 'id' WHEN 2 THEN 'code' WHEN 3 THEN 'id,name' END AS given_pk
  FROM part WHERE p_partkey % 11 <> 0
), listed AS (
  SELECT *, coalesce(given_pk, 'id') AS sink_pk, string_split(rtrim(sink_columns, ','), ',') AS names
  FROM feed WHERE source_table IS NOT NULL AND sink_columns IS NOT NULL
), valid AS (
  SELECT * FROM listed WHERE list_contains(names, sink_pk) AND NOT list_contains(names, '')
)
"""


# App logs with a value written in five ways, and their output texts.
_NUMBERS = """
WITH events_ AS (
  SELECT event_id AS i, user_id, epoch_us(ts) // 1000 AS ms,
         CAST(floor(abs(coalesce(value, 0.0)) * 100) AS BIGINT) AS cents FROM events
), texts AS (
  SELECT *, CASE i % 5
    WHEN 0 THEN (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
    WHEN 1 THEN (cents // 100) || '.0'
    WHEN 2 THEN '98765432' || lpad(CAST(cents AS VARCHAR), 12, '0') || '.50'
    WHEN 3 THEN '-0.' || lpad(CAST(cents AS VARCHAR), 25, '0')
    ELSE cents || 'E+2' END AS x,
  CASE i % 4 WHEN 1 THEN ',"other":"null"'
             WHEN 3 THEN ',"gone":{"deep":{"er":[{"still":{}}]}},"other":"12345678901234567890"' ELSE '' END AS rest
  FROM events_
)
SELECT i AS seq, 'dwd_traffic_page_log' AS topic,
       '{"common":{"is_new":"0","mid":"m' || user_id || '"},"page":{"page_id":"p","x":' || x || '},"ts":' || ms || rest || '}' AS value
FROM texts
UNION ALL
SELECT i, 'dwd_traffic_display_log',
       '{"item":"a","y":' || x || ',"ts":' || ms || ',"common":"{\\"is_new\\":\\"0\\",\\"mid\\":\\"m' || user_id || '\\"}","page_id":"p"}'
FROM texts
"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "db_dirty": _CHANGES + "SELECT seq, 'junk ' || seq AS value FROM messages WHERE seq % 101 = 0",
        "db_changes": _CHANGES
        + """SELECT seq, 'shop' AS database, source_table, type,
                    CAST(1652499161 + version AS BIGINT) AS ts FROM changes""",
        "record_functions": _CHANGES
        + """
SELECT seq, seq % 101 <> 0 AS has_data,
       CASE WHEN seq % 101 <> 0 THEN CAST(1652499161 + version AS VARCHAR) END AS ts_text,
       CASE WHEN seq % 101 <> 0 THEN CAST(1652499161 + version AS BIGINT) END AS ts_number,
       CASE WHEN seq % 101 <> 0 THEN CASE source_table
         WHEN 'customer' THEN CASE WHEN version = 1 THEN 'c_custkey,c_name'
                                   ELSE 'c_acctbal,c_custkey,c_mktsegment,c_name' END
         WHEN 'supplier' THEN CASE WHEN version = 1 THEN 's_name,s_suppkey' ELSE 's_acctbal,s_name,s_suppkey' END
         WHEN 'nation' THEN CASE WHEN version = 1 THEN 'id,n_name' ELSE 'id,n_name,n_regionkey' END
         ELSE CASE WHEN version = 1 THEN 'p_name,p_partkey' ELSE 'p_brand,p_name,p_partkey' END END END AS names,
       CASE WHEN seq % 101 <> 0 THEN named END AS name_values,
       CASE WHEN seq % 101 <> 0 THEN 'x' END AS mark,
       false AS still_c_name
FROM messages""",
        "config_latest": _RULES
        + """
SELECT source_table, arg_max(sink_table, seq) AS sink_table, arg_max(sink_columns, seq) AS sink_columns,
       arg_max(sink_pk, seq) AS sink_pk
FROM valid GROUP BY source_table""",
        "config_snapshot": _RULES
        + """, both_ AS (
  SELECT seq, source_table, sink_table, sink_pk, names FROM valid
  UNION ALL
  SELECT -1, 'src_' || n_nationkey, 'dim_shared_' || (n_nationkey % 5), 'id', ['id', 'n' || n_nationkey] FROM nation
), active AS (
  SELECT source_table, arg_max(sink_table, seq) AS sink_table, arg_max(sink_pk, seq) AS sink_pk FROM both_ GROUP BY 1
), first_ AS (
  SELECT sink_table, names, sink_pk, row_number() OVER (PARTITION BY sink_table ORDER BY seq, source_table) AS n FROM both_
)
SELECT source_table, sink_table, a.sink_pk, array_to_string(list_transform(f.names, lambda x: trim(x)), ',') AS table_columns,
       f.sink_pk AS table_pk
FROM active a JOIN first_ f USING (sink_table) WHERE f.n = 1""",
        "config_handover": _RULES
        + """, both_ AS (
  SELECT CAST(5 - seq % 5 AS HUGEINT) * 100000000000 + seq * 7 AS seq, source_table, sink_table, sink_pk, names FROM valid
  WHERE seq % 19 <> 0 AND (5 - seq % 5 > 3 OR (5 - seq % 5 = 3 AND seq * 7 > 4000))
  UNION ALL
  SELECT -1, 'src_' || n_nationkey, 'dim_shared_' || (n_nationkey % 5), 'id', ['id', 'n' || n_nationkey] FROM nation
), active AS (
  SELECT source_table, arg_max(sink_table, seq) AS sink_table, arg_max(sink_pk, seq) AS sink_pk FROM both_ GROUP BY 1
), first_ AS (
  SELECT sink_table, names, sink_pk, row_number() OVER (PARTITION BY sink_table ORDER BY seq, source_table) AS n FROM both_
)
SELECT source_table, sink_table, a.sink_pk, array_to_string(list_transform(f.names, lambda x: trim(x)), ',') AS table_columns,
       f.sink_pk AS table_pk
FROM active a JOIN first_ f USING (sink_table) WHERE f.n = 1""",
        "target_columns": _RULES
        + """, made AS (
  SELECT sink_table, arg_min(names, seq) AS names, arg_min(sink_pk, seq) AS pk FROM valid GROUP BY sink_table
)
SELECT sink_table, CAST(i - 1 AS INTEGER) AS pos, trim(names[i]) AS "column", trim(names[i]) = pk AS is_key
FROM made, unnest(range(1, len(names) + 1)) AS t(i)""",
        "dim_route": _DIM_ROUTE,
        "dim_unmatched": _CHANGES + "SELECT seq, source_table FROM changes WHERE sink_table IS NULL",
        "dim_rejects": _CHANGES
        + """
SELECT seq, CASE WHEN seq % 101 <> 0 THEN source_table END AS source_table,
       CASE WHEN seq % 101 = 0 THEN 'dirty' WHEN source_table = 'part' THEN 'unmatched' ELSE 'rejected' END
         AS status,
       CASE WHEN seq % 101 = 0 THEN 'not_json' WHEN source_table = 'supplier' THEN 'unknown_column' END AS reason
FROM messages WHERE seq % 101 = 0 OR (version < 2 AND source_table IN ('part', 'supplier'))""",
        "dim_project_exact": _CHANGES
        + """
SELECT seq, sink_table,
       CASE source_table WHEN 'customer' THEN CASE WHEN version = 0 THEN 'c_custkey,c_mktsegment,c_name'
                                                   ELSE 'c_custkey,c_name' END
                         WHEN 'supplier' THEN 's_suppkey' ELSE 'id,n_name' END AS kept,
       'accepted' AS status
FROM changes WHERE sink_table IS NOT NULL""",
        "dim_project_substring": _CHANGES
        + """
SELECT seq, sink_table,
       CASE source_table WHEN 'customer' THEN CASE WHEN version = 0 THEN 'c_custkey,c_mktsegment,c_name'
                                                   ELSE 'c_custkey,c_name' END
                         WHEN 'supplier' THEN 's_name,s_suppkey' ELSE 'id,n_name' END AS kept,
       CASE source_table WHEN 'supplier' THEN 'rejected' ELSE 'accepted' END AS status
FROM changes WHERE sink_table IS NOT NULL""",
        "dim_route_spread": _CHANGES
        + """
SELECT seq, CASE WHEN seq % 101 <> 0 THEN source_table END AS source_table, CASE WHEN seq % 101 <> 0 THEN sink_table END AS sink_table,
       CASE WHEN seq % 101 = 0 THEN 'dirty' WHEN sink_table IS NULL THEN 'unmatched' ELSE 'accepted' END AS status
FROM messages WHERE seq % 101 = 0 OR version < 2""",
        "dim_route_as_of": _HISTORY,
        "dim_upsert": _DIM_UPSERT,
        "first_visit": _LOGS + "SELECT mid, first_date FROM firsts",
        "is_new_repair": _LOGS + "SELECT seq, mid, is_new, flipped FROM logs",
        "log_dirty": """
SELECT event_id AS seq, 'not_json' AS reason, 'junk ' || event_id AS value FROM events WHERE event_id % 97 = 0""",
        "log_error": _LOGS
        + """
SELECT seq, mid, is_new, seq % 4000 AS error_code, kind AS page_id,
       CAST(CASE WHEN shows THEN seq % 4 + 1 ELSE 0 END AS INTEGER) AS n_displays,
       'common,' || CASE WHEN shows THEN 'displays,' ELSE '' END || 'err,page,ts' AS keys
FROM logs WHERE kind = 'error'""",
        "log_start": _LOGS
        + """
SELECT seq, mid, is_new, 'icon' AS entry, seq % 20000 AS loading_time,
       CAST(CASE WHEN shows THEN seq % 4 + 1 ELSE 0 END AS INTEGER) AS n_displays, ms AS ts,
       'common,' || CASE WHEN shows THEN 'displays,' ELSE '' END || 'start,ts' AS keys
FROM logs WHERE kind = 'signup'""",
        "log_page": _LOGS
        + """
SELECT seq, mid, is_new, kind AS page_id, seq % 5000 AS during_time, ms AS ts, 'common,page,ts' AS keys
FROM logs WHERE kind <> 'signup'""",
        "log_display": _LOGS
        + """
SELECT seq, mid, is_new, kind AS page_id, ms AS ts, n AS position, CAST(user_id AS VARCHAR) AS item,
       'common,item,order,page_id,ts' AS keys
FROM logs, unnest(range(1, seq % 4 + 2)) AS t(n) WHERE shows AND kind <> 'signup'""",
        "log_action": _LOGS
        + """
SELECT seq, mid, is_new, kind AS page_id, 'a' || n AS action_id, ms + n AS ts,
       'action_id,common,page_id,ts' AS keys
FROM logs, unnest(range(1, seq % 2 + 2)) AS t(n) WHERE acts""",
        "log_fanout": _FANOUT,
        "log_number_text": _NUMBERS,
        "log_daily": _MESSAGES
        + """
SELECT topic, CAST(make_timestamp(ts * 1000) + INTERVAL 8 HOUR AS DATE) AS day,
       count(*) AS n_messages, count(*) FILTER (WHERE is_new = '1') AS n_new
FROM messages GROUP BY 1, 2""",
        "date_functions": """
SELECT event_id AS seq, epoch_us(ts) // 1000 AS ms,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS full_text,
       epoch_us(CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) AS TIMESTAMP)) // 1000 - 28800000 AS day_ms,
       epoch_us(ts) // 1000000 * 1000 AS full_ms
FROM events""",
    }
    sql["stream_first_visit"] = sql["first_visit"]
    sql["stream_first_visit_state"] = sql["first_visit"]
    sql["stream_is_new_repair"] = _LOGS + "SELECT seq, mid, is_new FROM logs"
    sql["stream_log_fanout"] = sql["log_fanout"]
    sql["stream_log_once"] = f"SELECT seq, topic, mid, is_new, page_id, ts, position, action_id FROM ({_FANOUT})"
    sql["stream_dim_route"] = sql["dim_route"]
    sql["stream_dim_route_live"] = f"SELECT seq, source_table, sink_table, status, reason FROM ({_HISTORY})"
    sql["stream_dim_counts"] = _CHANGES + """
SELECT CASE WHEN seq % 101 = 0 THEN 'dirty' WHEN sink_table IS NULL THEN 'unmatched' ELSE 'accepted' END AS status,
       CASE WHEN seq % 101 = 0 THEN 'not_json' END AS reason, count(*) AS n
FROM messages WHERE seq % 101 = 0 OR version < 2 GROUP BY 1, 2"""
    sql["stream_dim_upsert"] = sql["dim_upsert"]
    sql["stream_dim_tables"] = sql["dim_upsert"]
    return sql
