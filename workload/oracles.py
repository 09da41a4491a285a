"""The result of each query in plain SQL over the given tables, written without the JSON detour."""

_BASE = """
base AS (
  SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, md5(CAST(o_orderkey AS VARCHAR)) AS h,
         substr(o_orderpriority, 3) AS prio,
         CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_FLAT = (
    _BASE
    + """,
flat AS (
  SELECT h AS hash,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 86400) END AS lastrefresh,
    CAST(o_custkey % 4000 AS SMALLINT) AS disasternumber,
    CAST(o_orderdate AS DATE) AS declarationdate,
    CASE WHEN o_orderkey % 17 <> 0 THEN prio END AS incidenttype,
    CAST(o_orderkey % 100000 AS INTEGER) AS pwnumber,
    'Order ' || o_orderkey AS applicationtitle,
    c_name AS applicantid,
    o_orderstatus AS damagecategorycode,
    'Category ' || o_orderstatus AS damagecategorydesc,
    status AS projectstatus,
    c_mktsegment AS projectprocessstep,
    CASE WHEN o_totalprice >= 250000 THEN 'Large' ELSE 'Small' END AS projectsize,
    CASE WHEN c_nationkey % 5 <> 0 THEN 'County ' || c_nationkey END AS county,
    lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS countycode,
    n_name AS stateabbr,
    lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS statenumbercode,
    CAST(amt AS DECIMAL(38,10)) AS projectamount,
    CAST(amt * 0.75 AS DECIMAL(38,10)) AS federalshare,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,10)) AS totalobligated,
    o_orderdate + INTERVAL 30 DAY AS lastobligation,
    o_orderdate AS firstobligation,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(amt AS DECIMAL(38,10)) END AS mitigationamount,
    o_orderkey AS gmprojectid,
    o_custkey AS gmapplicantid
  FROM base
)"""
)

_EVENTS = """
ev AS (
  SELECT CAST(user_id AS VARCHAR) AS hash, props, event_id, ts,
         CASE WHEN event_type <> 'error' THEN ts END AS refresh
  FROM events
)"""

_FOLD = (
    _EVENTS
    + """,
landing AS (
  SELECT hash, arg_max(json(props), event_id)::VARCHAR AS raw,
         arg_max(refresh, event_id) FILTER (WHERE refresh IS NOT NULL) AS lastrefresh
  FROM ev GROUP BY hash
)"""
)

_FOLD_LATEST = (
    "WITH"
    + _EVENTS
    + """,
ranked AS (
  SELECT hash, json(props)::VARCHAR AS raw,
         row_number() OVER (PARTITION BY hash ORDER BY refresh DESC NULLS LAST, event_id DESC) AS place,
         max(refresh) OVER (PARTITION BY hash) AS lastrefresh
  FROM ev
)
SELECT hash, raw, lastrefresh FROM ranked WHERE place = 1"""
)

_OLD_FLAT = (
    _FLAT
    + """,
old_flat AS (
  SELECT * REPLACE (
    CASE incidenttype WHEN 'URGENT' THEN lastrefresh - INTERVAL 1 DAY WHEN 'HIGH' THEN NULL
      WHEN 'MEDIUM' THEN lastrefresh + INTERVAL 1 DAY ELSE lastrefresh END AS lastrefresh,
    CAST(projectamount + 1 AS DECIMAL(38,10)) AS projectamount)
  FROM flat WHERE projectstatus <> 'Pending'
)"""
)

_CHANGED = (
    _OLD_FLAT
    + """,
changed AS (
  SELECT f.hash, f.lastrefresh, o.hash IS NULL AS is_new
  FROM flat f LEFT JOIN old_flat o ON o.hash = f.hash
  WHERE o.hash IS NULL OR (f.lastrefresh IS NOT NULL AND f.lastrefresh > o.lastrefresh)
)"""
)

_MEASURES = """count(*) AS projects, CAST(sum(totalobligated) AS DECIMAL(38,10)) AS total_obligated,
  CAST(sum(federalshare) AS DECIMAL(38,10)) AS federal_share"""


def _flat(select: str) -> str:
    return f"WITH{_FLAT}\n{select}"


def _bare(amount: str) -> str:
    """A decimal as JSON writes it here: without trailing zeros."""
    return rf"regexp_replace(CAST({amount} AS VARCHAR), '\.?0+$', '')"


def _member(name: str, text: str) -> str:
    return f"""'"{name}":' || coalesce({text}, 'null')"""


def _quoted(value: str) -> str:
    return f"""'"' || {value} || '"'"""


def _iso(instant: str) -> str:
    return _quoted(f"strftime({instant}, '%Y-%m-%dT%H:%M:%S.%fZ')")


# Members in byte order of their names, the order a stored record keeps them in.
_RAW = " || ',' || ".join(
    [
        _member("applicantId", _quoted("c_name")),
        _member("applicationTitle", _quoted("'Order ' || o_orderkey")),
        _member("county", _quoted("CASE WHEN c_nationkey % 5 <> 0 THEN 'County ' || c_nationkey END")),
        _member("countyCode", _quoted("lpad(CAST(c_nationkey AS VARCHAR), 3, '0')")),
        _member("damageCategoryCode", _quoted("o_orderstatus")),
        _member("damageCategoryDescrip", _quoted("'Category ' || o_orderstatus")),
        _member("declarationDate", _iso("o_orderdate")),
        _member("disasterNumber", "CAST(o_custkey % 4000 AS VARCHAR)"),
        _member("federalShareObligated", _bare("CAST(amt * 0.75 AS DECIMAL(18,4))")),
        _member("firstObligationDate", _iso("o_orderdate")),
        _member("gmApplicantId", "CAST(o_custkey AS VARCHAR)"),
        _member("gmProjectId", "CAST(o_orderkey AS VARCHAR)"),
        _member("hash", _quoted("h")),
        _member("incidentType", _quoted("CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE prio END")),
        _member("lastObligationDate", _iso("o_orderdate + INTERVAL 30 DAY")),
        _member(
            "lastRefresh",
            _iso("CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 86400) END"),
        ),
        _member("mitigationAmount", _quoted("CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(amt AS VARCHAR) END")),
        _member("projectAmount", _bare("amt")),
        _member("projectProcessStep", _quoted("c_mktsegment")),
        _member("projectSize", _quoted("CASE WHEN o_totalprice >= 250000 THEN 'Large' ELSE 'Small' END")),
        _member("projectStatus", _quoted("status")),
        _member("pwNumber", "CAST(o_orderkey % 100000 AS VARCHAR)"),
        _member("stateAbbreviation", _quoted("n_name")),
        _member("stateNumberCode", _quoted("lpad(CAST(n_nationkey AS VARCHAR), 2, '0')")),
        _member("totalObligated", _bare("CAST(c_acctbal AS DECIMAL(18,2))")),
    ]
)

_BAD = (
    _FLAT
    + """,
bad AS (
  SELECT *, incidenttype = 'URGENT' AS too_large, incidenttype = 'LOW' AS not_a_number,
    CAST(CAST(totalobligated AS DECIMAL(18,2)) AS VARCHAR) || '123456789012' AS obligated_text
  FROM flat
)"""
)

_TOTALS = """WITH e AS (
  SELECT user_id, 1 + CAST(ts >= TIMESTAMP '2024-01-11' AS BIGINT) + CAST(ts >= TIMESTAMP '2024-01-21' AS BIGINT) AS version
  FROM events
), firsts AS (SELECT user_id, min(version) AS version FROM e GROUP BY user_id),
loads AS (
  SELECT version, count(*) AS sent, count(DISTINCT user_id) AS distinct_keys,
    (SELECT count(*) FROM firsts f WHERE f.version = e.version) AS inserted,
    CAST(sum(count(*)) OVER (ORDER BY version) AS BIGINT) AS total_sent
  FROM e GROUP BY version
)"""

ORACLES = {
    "landing_build": f"""WITH{_FLAT}
SELECT h AS hash, '{{' || {_RAW} || '}}' AS raw, lastrefresh FROM base JOIN flat ON hash = h""",
    "reject_counts": """SELECT count(*) AS received, count(*) FILTER (WHERE event_type IN ('purchase', 'signup')) AS sent,
  count(*) FILTER (WHERE event_type NOT IN ('purchase', 'signup')) AS rejected FROM events""",
    "envelope_unwrap": f"""WITH{_BASE}
SELECT o_orderkey // 1000 AS page_seq,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos, h AS hash
FROM base""",
    "flatten_records": _flat("SELECT * FROM flat"),
    "fold_last_write": f"WITH{_FOLD} SELECT * FROM landing",
    "fold_latest_refresh": _FOLD_LATEST,
    "landing_upsert": f"WITH{_FOLD} SELECT * FROM landing",
    "landing_upsert_latest": _FOLD_LATEST,
    "landing_count": "SELECT count(DISTINCT user_id) AS n_rows FROM events",
    "high_water_mark": f"WITH{_FOLD} SELECT max(lastrefresh) AS mark FROM landing",
    "next_mark_guard": """SELECT asked, greatest(max(ts), midnight) AS mark
FROM events, (VALUES ('before', TIMESTAMP '2024-01-20'), ('after', TIMESTAMP '2024-03-01')) a(asked, midnight)
WHERE event_type <> 'error' GROUP BY asked, midnight""",
    "next_mark_resume": """SELECT asked, max(ts) AS mark FROM events, (VALUES ('before'), ('after')) a(asked)
WHERE event_type <> 'error' GROUP BY asked""",
    "mark_filter": f"""WITH{_FOLD}
SELECT chr(39) || strftime(greatest(max(lastrefresh), TIMESTAMP '2024-01-20 00:00:00'), '%Y-%m-%dT%H:%M:%S.%fZ') || chr(39)
  AS mark_text FROM landing""",
    "incremental_scan": """SELECT event_id, CAST(user_id AS VARCHAR) AS hash, ts AS lastrefresh FROM events
WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-16'""",
    "page_window": f"""WITH{_FOLD}
SELECT * FROM (SELECT hash, lastrefresh, row_number() OVER (ORDER BY lastrefresh NULLS FIRST, hash) - 1 AS position FROM landing)
WHERE position BETWEEN 40 AND 64""",
    "page_deep": _flat("""SELECT * FROM (
  SELECT hash, lastrefresh, row_number() OVER (ORDER BY lastrefresh NULLS FIRST, hash) - 1 AS position FROM flat)
WHERE position >= (SELECT count(*) * 3 // 4 FROM flat) AND position < (SELECT count(*) * 3 // 4 FROM flat) + 500"""),
    "pages_fold": """SELECT CAST(user_id AS VARCHAR) AS hash, max(event_id) AS event_id,
  arg_max(ts, event_id) FILTER (WHERE event_type <> 'error') AS lastrefresh
FROM events GROUP BY user_id""",
    "extract_dump": f"""WITH{_BASE}
SELECT (o_orderkey - (SELECT min(o_orderkey) FROM base)) // 1000 AS page_seq, h AS hash FROM base""",
    "extract_source": _flat("""SELECT hash, (place - 1) // 500 AS page_seq, CAST((place - 1) % 500 AS INTEGER) AS pos
FROM (SELECT hash, row_number() OVER (ORDER BY lastrefresh, gmprojectid) AS place FROM flat
WHERE lastrefresh >= TIMESTAMP '1996-06-01')"""),
    "extract_stream": _flat("""SELECT hash, gmprojectid,
  CASE WHEN gmprojectid % 100 = 1 THEN TIMESTAMP '2024-01-19' WHEN incidenttype IN ('URGENT', 'LOW') THEN lastrefresh
    ELSE TIMESTAMP '2024-01-10' END AS lastrefresh,
  CASE WHEN gmprojectid % 100 = 1 THEN 'Updated' ELSE county END AS county
FROM flat"""),
    "ingest_permissive": _flat("""SELECT hash, CASE WHEN projectstatus <> 'Open' THEN lastrefresh END AS lastrefresh
FROM flat WHERE gmprojectid // 1000 % 3 <> 1"""),
    "unparsable_pages": """SELECT o_orderkey // 1000 AS page_seq, CAST(count(*) + 1 AS INTEGER) AS n_parts FROM orders
WHERE o_orderkey // 1000 % 3 = 1 GROUP BY 1""",
    "paged_dump": _flat("""SELECT hash, lastrefresh, (place - 1) // 1000 AS page_seq,
  CAST((place - 1) % 1000 AS INTEGER) AS pos
FROM (SELECT hash, lastrefresh, row_number() OVER (ORDER BY lastrefresh NULLS FIRST, hash) AS place FROM flat)"""),
    "changed_rows": f"WITH{_CHANGED} SELECT * FROM changed",
    "changed_rows_null_oldest": f"""WITH{_OLD_FLAT}
SELECT f.hash, f.lastrefresh, o.hash IS NULL AS is_new
FROM flat f LEFT JOIN old_flat o ON o.hash = f.hash
WHERE o.hash IS NULL OR f.lastrefresh > coalesce(o.lastrefresh, TIMESTAMP '0001-01-01')""",
    "flat_sync": f"""WITH{_CHANGED}
SELECT * FROM flat WHERE hash IN (SELECT hash FROM changed)
UNION ALL SELECT * FROM old_flat WHERE hash NOT IN (SELECT hash FROM changed)""",
    "sync_metrics": f"""WITH{_CHANGED}
SELECT count(*) FILTER (WHERE is_new) AS inserted, count(*) FILTER (WHERE NOT is_new) AS updated,
  count(*) AS changed FROM changed""",
    "cycle_published": _flat("SELECT * FROM flat"),
    "replace_load": _flat("SELECT hash, lastrefresh, stateabbr, projectamount FROM flat"),
    "cycle_replay": """SELECT CAST(user_id AS VARCHAR) AS hash, max(event_id) AS event_id,
  CAST(arg_max(props ->> '$.k', event_id) AS INTEGER) AS k,
  arg_max(ts, event_id) FILTER (WHERE event_type <> 'error') AS lastrefresh
FROM events GROUP BY user_id""",
    "load_totals": f"""{_TOTALS}
SELECT version, sent, CAST(0 AS BIGINT) AS rejected, distinct_keys, inserted, total_sent FROM loads""",
    "load_totals_landing_first": f"""{_TOTALS}
SELECT 2 * version - 1 AS version, sent, CAST(0 AS BIGINT) AS rejected, distinct_keys, CAST(0 AS BIGINT) AS inserted, total_sent
FROM loads
UNION ALL SELECT 2 * version, 0, 0, 0, inserted, total_sent FROM loads""",
    "cycle_update": _flat("""SELECT hash, gmprojectid,
  CASE WHEN gmprojectid % 100 = 1 THEN TIMESTAMP '2024-01-19' ELSE lastrefresh END AS lastrefresh,
  CASE WHEN gmprojectid % 100 = 1 THEN 'Updated' ELSE county END AS county,
  CASE WHEN gmprojectid % 100 = 1 AND gmprojectid % 13 <> 0 THEN 'Updated' ELSE county END AS flat_county
FROM flat"""),
    "absent_tables": """SELECT count(*) AS orders, count(*) AS not_in_landing, CAST(0 AS BIGINT) AS flat_rows,
  CAST(NULL AS VARCHAR) AS flat_mark FROM orders""",
    "empty_batch": f"""WITH{_BASE}
SELECT count(*) AS landing, count(*) AS rejected, CAST(0 AS BIGINT) AS sent, true AS same FROM base""",
    "failed_cycle": _flat("SELECT hash, lastrefresh, pwnumber FROM flat"),
    "created_tables": _flat("SELECT hash, stateabbr, projectamount, lastrefresh FROM flat"),
    "refresh_range": _flat("""SELECT hash, lastrefresh FROM flat
WHERE lastrefresh BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31 12:00:00'"""),
    "json_contains": """SELECT event_id, CAST(user_id AS VARCHAR) AS hash FROM events
WHERE event_type = 'purchase' AND json_contains(props, '{"k": 42}')""",
    "json_contains_landing": _flat("""SELECT hash FROM flat
WHERE projectsize = 'Large' AND disasternumber = 77 AND county IS NULL"""),
    "json_contains_flat": _flat("""SELECT hash, stateabbr, projectsize FROM flat
WHERE stateabbr = 'NATION_7' AND projectsize = 'Large' AND countycode = '007'"""),
    "slice_state": _flat("SELECT hash, stateabbr, county, totalobligated FROM flat WHERE stateabbr = 'NATION_3'"),
    "slice_incident": _flat("""SELECT hash, incidenttype, projectstatus, projectamount FROM flat
WHERE incidenttype = 'URGENT'"""),
    "slice_disaster": _flat("""SELECT hash, disasternumber, pwnumber, projectsize FROM flat
WHERE disasternumber = 605"""),
    "slice_date_range": _flat("""SELECT hash, declarationdate, stateabbr FROM flat
WHERE declarationdate BETWEEN DATE '1996-03-01' AND DATE '1996-05-31'"""),
    "slice_state_incident": _flat("""SELECT hash, stateabbr, incidenttype, federalshare FROM flat
WHERE stateabbr = 'NATION_11' AND incidenttype = 'LOW'"""),
    "slice_date_state": _flat("""SELECT hash, declarationdate, stateabbr, projectamount FROM flat
WHERE declarationdate >= DATE '1998-01-01' AND stateabbr = 'NATION_20'"""),
    "money_range": _flat("""SELECT hash, federalshare, totalobligated FROM flat
WHERE federalshare BETWEEN 200000 AND 250000 AND totalobligated >= 0"""),
    "money_topk": _flat("""SELECT hash, federalshare, stateabbr FROM flat
ORDER BY federalshare DESC NULLS LAST, hash LIMIT 100"""),
    "money_bottomk": _flat("""SELECT hash, totalobligated FROM flat
ORDER BY totalobligated NULLS LAST, hash LIMIT 50"""),
    "project_lookup": _flat("SELECT hash, gmprojectid, projectamount FROM flat WHERE gmprojectid = 1000"),
    "applicant_lookup": _flat("SELECT hash, gmapplicantid, totalobligated FROM flat WHERE gmapplicantid = 77"),
    "project_join": _flat("""SELECT hash, gmprojectid, projectamount, o.o_orderkey, o.o_orderpriority
FROM flat JOIN orders o ON o.o_orderkey = gmprojectid"""),
    "applicant_join": _flat("""SELECT hash, gmapplicantid, totalobligated, c.c_custkey, c.c_mktsegment
FROM flat LEFT JOIN customer c ON c.c_custkey = gmapplicantid"""),
    "bi_feed": _flat("""SELECT stateabbr, projectsize, count(*) AS projects,
  CAST(sum(projectamount) AS DECIMAL(38,10)) AS project_amount, max(lastrefresh) AS last_refresh
FROM flat GROUP BY stateabbr, projectsize"""),
    "rollup_state_incident": _flat(f"SELECT stateabbr, incidenttype, {_MEASURES} FROM flat GROUP BY ALL"),
    "rollup_month_state": _flat(f"""SELECT CAST(date_trunc('month', declarationdate) AS DATE) AS month, stateabbr,
  {_MEASURES} FROM flat GROUP BY ALL"""),
    "rollup_status": _flat("""SELECT projectstatus, projectprocessstep, count(*) AS projects,
  CAST(sum(projectamount) AS DECIMAL(38,10)) AS project_amount FROM flat GROUP BY ALL"""),
    "rollup_after_update": _flat("""SELECT stateabbr,
  CASE WHEN gmprojectid % 100 = 1 AND gmprojectid % 13 <> 0 THEN 'Moved' ELSE incidenttype END AS incidenttype,
  count(*) AS projects,
  sum(CASE WHEN gmprojectid % 100 <> 1 OR gmprojectid % 13 = 0 THEN totalobligated
    WHEN gmprojectid % 3 <> 0 THEN totalobligated + 1 END) AS total_obligated,
  sum(federalshare) AS federal_share
FROM flat GROUP BY 1, 2"""),
    "topk_disasters": _flat(f"""SELECT disasternumber, {_MEASURES} FROM flat GROUP BY disasternumber
ORDER BY total_obligated DESC NULLS LAST, disasternumber LIMIT 25"""),
    "state_obligated": _flat("""SELECT stateabbr, count(*) AS projects,
  CAST(sum(totalobligated) AS DECIMAL(38,10)) AS total_obligated FROM flat GROUP BY stateabbr"""),
    "key_violations": """SELECT CAST(user_id AS VARCHAR) AS hash, count(*) AS n_rows FROM events
GROUP BY user_id HAVING count(*) > 1""",
    "null_violations": """SELECT event_id, CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS hash
FROM events WHERE event_type IN ('signup', 'error')""",
    "cast_quarantine": f"""WITH{_BAD}
SELECT hash, 'disasternumber' AS "column", CASE WHEN too_large THEN '40000' ELSE 'abc' END AS value,
  'smallint' AS type FROM bad WHERE too_large OR not_a_number
UNION ALL SELECT hash, 'declarationdate', '1996-13-45', 'date' FROM bad WHERE projectstatus = 'Pending'
UNION ALL SELECT hash, 'projectamount', CAST(CAST(projectamount AS DECIMAL(18,2)) AS VARCHAR) || ' USD',
  'decimal(38,10)' FROM bad WHERE projectsize = 'Large'
UNION ALL SELECT hash, 'lastrefresh', 'later', 'timestamp' FROM bad WHERE projectstatus = 'Pending'""",
    "flatten_permissive": f"""WITH{_BAD}
SELECT hash, CASE WHEN too_large OR not_a_number THEN NULL ELSE disasternumber END AS disasternumber,
  CASE WHEN projectstatus <> 'Pending' THEN declarationdate END AS declarationdate,
  CASE WHEN projectsize <> 'Large' THEN projectamount END AS projectamount,
  CAST(obligated_text AS DECIMAL(38,10)) AS totalobligated
FROM bad""",
    "rounded_amounts": f"""WITH{_BAD}
SELECT hash, 'totalobligated' AS "column", obligated_text AS value FROM bad
UNION ALL SELECT hash, 'mitigationamount', '1.5E-12' FROM bad WHERE gmprojectid % 4 = 0""",
}
