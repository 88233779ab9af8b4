"""The SQL each registered query must equal, over the same provided tables."""

from __future__ import annotations

from collections.abc import Sequence

DAY_S = 86400
NOW_S = 1706677200
MADE_S = 1705363300

# Event samples, their label pairs, and the dictionaries made of them.
_SAMPLES = """
s AS (
  SELECT event_id, event_type AS name, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS sec,
         CAST(round(value * 100) AS BIGINT) AS cents, user_id,
         CAST(user_id AS VARCHAR) AS u, regexp_extract(props, '"k": *([0-9]+)', 1) AS k,
         CASE WHEN user_id % 2 = 0 THEN 'gold' END AS tier,
         CASE WHEN user_id % 3 = 0 THEN 'z1' END AS zone
  FROM events),
p AS (
  SELECT event_id, name, '__name__' AS key, name AS value, sec FROM s
  UNION ALL SELECT event_id, name, 'k', k, sec FROM s
  UNION ALL SELECT event_id, name, 'tier', tier, sec FROM s WHERE tier IS NOT NULL
  UNION ALL SELECT event_id, name, 'user', u, sec FROM s
  UNION ALL SELECT event_id, name, 'zone', zone, sec FROM s WHERE zone IS NOT NULL),
d AS (
  SELECT row_number() OVER (ORDER BY key, value) AS id, key, value
  FROM (SELECT DISTINCT key, value FROM p)),
m AS (
  SELECT row_number() OVER (ORDER BY name) AS metric_id, name FROM (SELECT DISTINCT name FROM s))
"""

# Distinct label sets with their ids. Every metric has k, tier, user and zone, in this order.
_SERIES = _SAMPLES + """,
x AS (
  SELECT q.*, m.metric_id, n.id AS name_id, kk.id AS k_id, coalesce(t.id, 0) AS tier_id, uu.id AS user_id_, z.id AS zone_id,
         concat_ws(',', n.id, kk.id, coalesce(t.id, 0), uu.id, z.id) AS label_ids,
         concat_ws(',', '__name__=' || q.name, 'k=' || q.k, 'tier=' || q.tier, 'user=' || q.u, 'zone=' || q.zone) AS labels
  FROM (SELECT DISTINCT name, k, tier, u, zone FROM s) q
  JOIN m ON m.name = q.name
  JOIN d n ON n.key = '__name__' AND n.value = q.name
  JOIN d kk ON kk.key = 'k' AND kk.value = q.k
  JOIN d uu ON uu.key = 'user' AND uu.value = q.u
  LEFT JOIN d t ON t.key = 'tier' AND t.value = q.tier
  LEFT JOIN d z ON z.key = 'zone' AND z.value = q.zone),
sr AS (
  SELECT row_number() OVER (ORDER BY metric_id, k_id, tier_id, user_id_, coalesce(zone_id, 0)) AS series_id, * FROM x),
f AS (
  SELECT s.event_id, s.us, s.sec, s.cents, sr.* EXCLUDE (name, k, tier, u, zone), s.name, s.k, s.tier, s.u, s.zone
  FROM s JOIN sr ON sr.name = s.name AND sr.k = s.k AND sr.u = s.u)
"""

# Facts with the chunks of the stored events: 5 days, one day for one metric.
_CHUNKS = _SERIES + """,
c AS (
  SELECT *, sec - sec % span AS chunk_start, sec - sec % span + span AS chunk_end
  FROM (SELECT *, CASE WHEN name = 'view' THEN 86400 ELSE 432000 END AS span FROM f))
"""

_RETENTION = _CHUNKS + f""",
lim AS (
  SELECT DISTINCT name, {NOW_S} - CASE WHEN name = 'view' THEN 29 ELSE 10 END * {DAY_S} AS limit_s FROM c),
cut AS (
  SELECT c.name, max(chunk_end) AS cutoff_s FROM c JOIN lim ON lim.name = c.name
  WHERE chunk_end <= limit_s GROUP BY c.name),
old AS (SELECT DISTINCT c.name, labels, k, tier, u, zone FROM c JOIN cut ON cut.name = c.name WHERE sec < cutoff_s),
kept AS (
  SELECT DISTINCT c.name, labels, k, tier, u, zone FROM c LEFT JOIN cut ON cut.name = c.name
  WHERE cutoff_s IS NULL OR sec >= cutoff_s),
gone AS (SELECT * FROM old WHERE labels NOT IN (SELECT labels FROM kept)),
gone_p AS (
  SELECT name, '__name__' AS key, name AS value FROM gone UNION SELECT name, 'k', k FROM gone
  UNION SELECT name, 'tier', tier FROM gone WHERE tier IS NOT NULL UNION SELECT name, 'user', u FROM gone
  UNION SELECT name, 'zone', zone FROM gone WHERE zone IS NOT NULL),
kept_p AS (
  SELECT name, '__name__' AS key, name AS value FROM kept UNION SELECT name, 'k', k FROM kept
  UNION SELECT name, 'tier', tier FROM kept WHERE tier IS NOT NULL UNION SELECT name, 'user', u FROM kept
  UNION SELECT name, 'zone', zone FROM kept WHERE zone IS NOT NULL)
"""

# Coarse samples: label texts by slot, cut after the last slot used.
_COARSE = """
s AS (
  SELECT event_id, event_type AS name, CASE WHEN event_id % 7 <> 0 THEN 'lvl=' || event_id % 3 END AS lvl,
         CASE WHEN user_id % 2 = 0 THEN 'tier=gold' END AS tier, CASE WHEN user_id % 3 = 0 THEN 'zone=z1' END AS zone
  FROM events),
a AS (
  SELECT *, CASE WHEN zone IS NOT NULL THEN [name, coalesce(lvl, '0'), coalesce(tier, '0'), zone]
                 WHEN tier IS NOT NULL THEN [name, coalesce(lvl, '0'), tier]
                 WHEN lvl IS NOT NULL THEN [name, lvl] ELSE [name] END AS ids,
         list_concat(CASE WHEN lvl IS NULL THEN [] ELSE [lvl] END, CASE WHEN tier IS NULL THEN [] ELSE [tier] END,
                     CASE WHEN zone IS NULL THEN [] ELSE [zone] END)::VARCHAR[] AS own
  FROM s)
"""

# Events rendered as dumps of 50.
_DUMPS = """
e AS (
  SELECT event_id, event_type, user_id, props, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS cents,
         event_id // 50 AS doc FROM events),
docs AS (
  SELECT doc, CAST(ceil(CAST(max(us) AS DOUBLE) / 15000000) AS BIGINT) * 15 AS scrape_ts, 't' || doc % 10 AS target
  FROM e GROUP BY doc),
l AS (
  SELECT e.*, docs.scrape_ts, docs.target, e.us // 1000 AS ms,
         row_number() OVER (PARTITION BY e.doc ORDER BY event_type, event_id) - 1 AS line
  FROM e JOIN docs ON docs.doc = e.doc)
"""

# The lines of the dump files, in order of their events.
_FILES = """
l AS (
  SELECT event_id, event_type, user_id, props, CAST(round(value * 100) AS BIGINT) AS cents, epoch_us(ts) // 1000 AS ms,
         't' || event_id // 20000 AS target,
         min(epoch_us(ts)) OVER (PARTITION BY event_id // 20000) // 1000000 + 86400 AS scrape_ts,
         row_number() OVER (PARTITION BY event_id // 20000 ORDER BY event_id) - 1 AS line
  FROM events)
"""
_FILE_SAMPLES = """SELECT target, scrape_ts, line, event_type AS name, 'Gauge' AS series_type,
  CAST(user_id AS VARCHAR) AS "user", props, cents, ms AS own_ts, ms FROM l"""

# The lines of the dumps made of orders, with what each is read as; null type: skipped.
_FAMILIES = """
o AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderstatus AS st, o_totalprice AS t,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Gauge' END AS late FROM orders),
l AS (
  SELECT doc_id, 0 AS line, 'early' AS name, NULL AS series_type, '' AS labels, 0 AS v, NULL AS own_ts, k, t FROM o
  UNION ALL SELECT doc_id, 1, 'orders_total', 'CounterInteger', 'status=' || st, k, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 2, 'orders_total', NULL, '', 0, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 3, 'price', 'Counter', 'quantile=0.5', t, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 4, 'price_sum', 'Counter', '', t, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 5, 'price_count', 'CounterInteger', '', k, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 6, 'wait_bucket', 'CounterInteger', 'le=+Inf', k, 17, k, t FROM o
  UNION ALL SELECT doc_id, 7, 'wait', NULL, '', 0, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 8, 'wait_sum', 'Counter', '', t, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 9, 'early', NULL, '', 0, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 10, 'early', late, '', t, NULL, k, t FROM o
  UNION ALL SELECT doc_id, 11, 'price_count', 'CounterInteger', '', k, NULL, k, t FROM o)
"""

# Events as a log of pod changes, and the target each leaves.
_POD_LOG = """
log AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000000 AS event_s, 'pod-' || user_id AS name,
         CASE WHEN event_id % 17 <> 0 AND event_id % 13 <> 0
              THEN 'http://10.1.0.' || user_id % 256 || ':' || 9000 + (event_id // 1000) % 3 || '/metrics' END AS url,
         CASE WHEN event_id % 13 <> 0
              THEN 'http://10.1.0.' || user_id % 256 || ':' || 9000 + (event_id // 1000) % 3 || '/metrics' END AS any_url,
         event_id % 17 <> 0 AND event_id % 5 = 0 AS is_bookmark
  FROM events),
chg AS (
  SELECT *, lag(url) OVER (PARTITION BY name ORDER BY seq) AS prev_url FROM log WHERE NOT is_bookmark),
cur AS (
  SELECT name, arg_max(coalesce(url, ''), seq) AS url,
         arg_max(event_s, seq) FILTER (WHERE url IS DISTINCT FROM prev_url) AS last_scrape
  FROM chg GROUP BY name),
tgt AS (SELECT name, url, last_scrape FROM cur WHERE url <> '')
"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _selector(where: str) -> str:
    return _with(
        _SERIES, f"SELECT labels, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM f WHERE {where} GROUP BY labels"
    )


def _equal_json(cases: Sequence[tuple[str, list[str]]]) -> str:
    parts = []
    for name, pairs in cases:
        wanted = "[" + ", ".join(f"'{p}'" for p in pairs) + "]::VARCHAR[]"
        for form, size in (("eq", f"len(ids) = {len(pairs) + 1}"), ("exact", f"len(own) = {len(pairs)}")):
            parts.append(
                f"SELECT '{name}' AS pairs, '{form}' AS form, count(*) AS n, count(DISTINCT ids) AS n_series "
                f"FROM a WHERE name = 'error' AND {size} AND list_has_all(own, {wanted})"
            )
    return _with(_COARSE, " UNION ALL ".join(parts))


_LABEL_INFO = _with(
    _SAMPLES,
    """
    SELECT key, key AS value_column_name, key || '_id' AS id_column_name, value,
           row_number() OVER (PARTITION BY key ORDER BY value) AS rank
    FROM (SELECT DISTINCT key, value FROM d)""",
)


def _named(full: str, suffix: str) -> str:
    return (
        f"CASE WHEN length({full}) < 62 THEN {full} "
        f"ELSE substring({full}, 1, CAST(61 - length({suffix}) AS INTEGER)) || '_' || {suffix} END"
    )


_LINEITEMS = """
li AS (
  SELECT l_returnflag AS name, l_linestatus AS status, CAST(l_suppkey AS VARCHAR) AS supplier,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
"""


_INGEST_REPORT = """
SELECT sec - sec % 300 AS interval_start, count(*) FILTER (WHERE outcome = 'ok') AS scrapes,
  count(*) FILTER (WHERE outcome = 'failed') AS scrape_errors, count(*) FILTER (WHERE outcome = 'timeout') AS scrape_timeouts,
  count(*) FILTER (WHERE outcome = 'refused') AS scrape_refused,
  CAST(coalesce(sum(event_id % 5 + 1) FILTER (WHERE outcome = 'ok'), 0) AS BIGINT) AS writes,
  CAST(0 AS BIGINT) AS write_errors,
  CAST(coalesce(sum(event_id % 2) FILTER (WHERE outcome = 'ok'), 0) AS BIGINT) AS write_skips,
  CAST(coalesce(sum(event_id % 3) FILTER (WHERE outcome = 'ok'), 0) AS BIGINT) AS new_series,
  CAST(coalesce(sum(user_id * 100) FILTER (WHERE outcome = 'ok'), 0) AS BIGINT) AS response_bytes,
  coalesce(max(user_id * 100) FILTER (WHERE outcome = 'ok'), 0) AS response_bytes_peak
FROM (
  SELECT epoch_us(ts) // 1000000 AS sec, event_id, user_id,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 11 = 0 THEN 'timeout'
         WHEN event_id % 13 = 0 THEN 'refused' ELSE 'ok' END AS outcome FROM events)
GROUP BY interval_start
"""

_FOLDED = _with(
    _POD_LOG, "SELECT name, url, 'pod=' || name || ',instance=192.168.1.1,namespace=ns' AS labels, last_scrape FROM tgt"
)

_BOOKMARKS = """, b AS (
  SELECT doc, target, scrape_ts,
         greatest(scrape_ts - 300, coalesce(lag(scrape_ts) OVER (PARTITION BY target ORDER BY scrape_ts, doc), 0)) AS min_ts
  FROM docs)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "metric_dictionary": _with(_SAMPLES, "SELECT metric_id, name AS metric_name, name AS table_name FROM m"),
        "metric_get_or_create": _with(
            _SAMPLES,
            """SELECT metric_id, name AS metric_name, name AS table_name, false AS possibly_new FROM m
            UNION ALL
            SELECT (SELECT count(*) FROM m) + row_number() OVER (ORDER BY p), p, p, true
            FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)""",
        ),
        "label_dictionary": _with(_SAMPLES, "SELECT id, key, value FROM d"),
        "label_keys": _with(
            _SAMPLES,
            """SELECT row_number() OVER (ORDER BY key) AS id, key, key AS value_column_name, key || '_id' AS id_column_name
            FROM (SELECT DISTINCT key FROM d)""",
        ),
        "label_positions": _with(
            _SAMPLES,
            """SELECT name AS metric_name, key, CASE WHEN key = '__name__' THEN 1 ELSE 1 + row_number() OVER (
                 PARTITION BY name ORDER BY key = '__name__', key) END AS pos
            FROM (SELECT DISTINCT name, key FROM p)""",
        ),
        "label_dictionary_grown": _with(
            _SAMPLES,
            """, one AS (SELECT DISTINCT key, value FROM p WHERE sec < 1705363200),
            two AS (SELECT key, value FROM p WHERE sec >= 1705363200 EXCEPT SELECT key, value FROM one)
            SELECT row_number() OVER (ORDER BY key, value) AS id, key, value FROM one
            UNION ALL
            SELECT (SELECT count(*) FROM one) + row_number() OVER (ORDER BY key, value), key, value FROM two""",
        ),
        "encode_series": _with(_SERIES, "SELECT series_id, metric_id, label_ids FROM sr"),
        "decode_series": _with(
            _SERIES,
            """SELECT series_id,
              concat_ws(',', '__name__', 'k', CASE WHEN tier IS NOT NULL THEN 'tier' END, 'user',
                        CASE WHEN zone IS NOT NULL THEN 'zone' END) AS keys,
              concat_ws(',', name, k, tier, u, zone) AS vals,
              '{"__name__":"' || name || '","k":"' || k || '"' || coalesce(',"tier":"' || tier || '"', '')
                || ',"user":"' || u || '"' || coalesce(',"zone":"' || zone || '"', '') || '}' AS js
            FROM sr""",
        ),
        "canonical_series_labels": _with(
            _SAMPLES,
            """SELECT event_id, concat_ws(',', '__name__=' || name, 'env=prod', 'k=' || k, 'pod=p' || event_id % 4,
                 'tier=' || tier, 'user=' || u, 'zone=' || coalesce(zone, 'none')) AS labels FROM s""",
        ),
        "series_keys_distinct": _with(
            _SERIES,
            """SELECT name, count(DISTINCT series_id) AS n_sets, count(DISTINCT series_id) AS n_hashes, count(*) AS n_samples
            FROM f GROUP BY name""",
        ),
        "labels_from_json": "SELECT event_id, event_type AS name, 'user=' || user_id || ',on=true' AS labels FROM events",
        "stored_samples": _with(_CHUNKS, "SELECT labels, us, cents, 'value' AS sample_kind, chunk_start, chunk_end FROM c"),
        "metric_view_error": _with(
            _SERIES,
            """SELECT us, cents, series_id, label_ids AS labels, k_id, tier_id, user_id_ AS user_id, zone_id
            FROM f WHERE name = 'error'""",
        ),
        "series_view_error": _with(
            _SERIES, "SELECT series_id, label_ids AS labels, k, tier, u AS user, zone FROM sr WHERE name = 'error'"
        ),
        "time_range_scan": _with(
            _SAMPLES,
            """SELECT name AS metric_name, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM s
            WHERE sec >= 1704762000 AND sec < 1705534200 GROUP BY name""",
        ),
        "chunk_list": _with(
            _CHUNKS,
            "SELECT name AS metric_name, chunk_start, chunk_end, count(*) AS n FROM c GROUP BY name, chunk_start, chunk_end",
        ),
        "backfill_chunks": _with(
            _CHUNKS,
            """SELECT name AS metric_name, chunk_start, CASE WHEN name = 'purchase' THEN 2 ELSE 1 END * count(*) AS n,
              CAST(CASE WHEN name = 'purchase' THEN 0 ELSE sum(cents) END AS BIGINT) AS cents
            FROM c GROUP BY name, chunk_start""",
        ),
        "sel_eq": _selector("name = 'error' AND tier = 'gold'"),
        "sel_neq": _selector("name = 'error' AND zone IS DISTINCT FROM 'z1'"),
        "sel_re": _selector("name = 'error' AND regexp_matches(k, '^[1-3]')"),
        "sel_nre": _selector("name = 'error' AND NOT regexp_matches(u, '5$')"),
        "sel_and": _selector(
            "name = 'click' AND regexp_matches(u, '1') AND tier IS NULL AND NOT regexp_matches(k, '[02468]$')"
        ),
        "sel_absent_positive": _selector("name = 'view' AND zone = ''"),
        "sel_absent_negative": _selector("name = 'view'"),
        "sel_neq_indexed": _selector("name = 'error' AND zone IS DISTINCT FROM 'z1'"),
        "sel_contains": _selector("name = 'click' AND tier = 'gold' AND zone = 'z1'"),
        "sel_across_metrics": _selector("regexp_matches(k, '^1') AND tier IS NULL"),
        "sel_literal_ids": _with(
            _SERIES,
            """SELECT metric_id, count(*) AS n, 'tier:gold' AS matcher FROM sr WHERE tier = 'gold' GROUP BY metric_id
            UNION ALL SELECT metric_id, count(*), 'zone:z1' FROM sr WHERE zone IS NULL GROUP BY metric_id""",
        ),
        "sel_equal_json": _equal_json(
            [
                ("all", ["lvl=1", "tier=gold", "zone=z1"]), ("first", ["lvl=1"]), ("gap", ["tier=gold"]),
                ("none", []), ("unknown", ["lvl=9"]),
            ]
        ),
        "eq_pairs": _with(
            _COARSE,
            """SELECT b.event_id, len(a.ids) = len(b.ids) AND list_has_all(a.ids, b.ids[2:]) AS eq,
              len(a.own) = len(b.own) AND list_has_all(a.own, b.own) AS eq_exact
            FROM a JOIN a b ON b.event_id = a.event_id + 1""",
        ),
        "matcher_pairs": _with(
            _COARSE,
            """, n AS (
              SELECT event_id - 1 AS event_id,
                     CASE WHEN event_id % 10 = 0 THEN list_append(own, 'more=?') ELSE own END AS want FROM a)
            SELECT a.event_id, len(want) + 1 AS n_keys, list_has_all(a.own, want) AS contains,
              list_has_any(a.own, want) AS any_of,
              CASE WHEN len(want) > 0 THEN len(a.ids) = len(want) + 1 AND list_has_all(a.own, want) END AS eq_matcher,
              len(a.ids) = len(want) + 1 AND list_has_all(a.own, want) AS eq_map
            FROM a JOIN n ON n.event_id = a.event_id""",
        ),
        "group_by_label": _with(
            _SAMPLES,
            """SELECT tier, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, min(cents) AS least, max(cents) AS greatest
            FROM s WHERE name = 'error' AND regexp_matches(k, '^[1-3]') GROUP BY tier""",
        ),
        "group_by_user": _with(
            _SAMPLES,
            'SELECT u AS "user", count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM s WHERE name = \'view\' GROUP BY u',
        ),
        "metric_info": _with(
            _CHUNKS,
            """SELECT name AS metric_name, name AS table_name, CASE WHEN name = 'click' THEN 86400 ELSE 7776000 END AS retention_s,
              max(span) AS chunk_interval_s, '__name__,k,tier,user,zone' AS label_keys, count(*) AS n_samples,
              count(DISTINCT series_id) AS n_series, min(us) AS first_us, max(us) AS last_us, count(DISTINCT chunk_start) AS n_chunks
            FROM c GROUP BY name""",
        ),
        "store_reused_batch_id": """
            SELECT event_type AS metric_name, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT)) AS cents
            FROM events GROUP BY event_type""",
        "store_replay_after_rewrite": """
            SELECT event_type AS metric_name, count(*) * CASE event_type WHEN 'view' THEN 2 ELSE 1 END AS n,
              sum(CAST(round(value * 100) AS BIGINT)) * CASE event_type WHEN 'view' THEN 2 ELSE 1 END AS cents
            FROM events GROUP BY event_type""",
        "compact_chunks": _with(
            _SERIES,
            """, h AS (SELECT *, sec - sec % 864000 AS chunk_start, event_id % 3 AS batch FROM f)
            SELECT name AS metric_name, chunk_start, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n_summary,
              count(DISTINCT labels) AS n_series,
              CASE WHEN chunk_start + 864000 <= 1706400000 THEN 1 ELSE count(DISTINCT batch) END AS parts,
              chunk_start + 864000 <= 1706400000 OR count(DISTINCT labels) = count(DISTINCT (labels, batch)) AS summary_merged
            FROM h GROUP BY name, chunk_start""",
        ),
        "bucketed_dimensions": _with(
            _SERIES,
            """SELECT labels, count(*) AS n FROM f GROUP BY labels
            UNION ALL SELECT '__name__:' || name, count(*) FROM sr GROUP BY name
            UNION ALL SELECT 'k:' || k, count(*) FROM sr GROUP BY k
            UNION ALL SELECT 'tier:' || tier, count(*) FROM sr WHERE tier IS NOT NULL GROUP BY tier
            UNION ALL SELECT 'user:' || u, count(*) FROM sr GROUP BY u
            UNION ALL SELECT 'zone:' || zone, count(*) FROM sr WHERE zone IS NOT NULL GROUP BY zone""",
        ),
        "batch_outcomes": """
            SELECT event_id % 2 AS batch_id, event_type AS metric_name, count(*) AS n FROM events GROUP BY ALL""",
        "store_refuses_other_batch": """
            SELECT event_type AS metric_name, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, 1 AS refused
            FROM events WHERE event_id % 2 = 0 GROUP BY event_type""",
        "drop_metric_chunks": _with(
            _CHUNKS,
            """SELECT name AS metric_name, count(*) AS n_left, count(*) AS n_summary, count(DISTINCT labels) AS series_left
            FROM c WHERE name <> 'view' OR sec >= 1705363200 GROUP BY name""",
        ),
        "target_made_anew": _with(
            _DUMPS,
            f""", b AS (
              SELECT doc, greatest(scrape_ts - 300, coalesce(
                lag(scrape_ts) OVER (PARTITION BY target, scrape_ts < {MADE_S} ORDER BY scrape_ts, doc),
                CASE WHEN scrape_ts < {MADE_S} THEN 0 ELSE {MADE_S} END)) AS min_ts FROM docs)
            SELECT event_type AS metric_name, ms, cents FROM l JOIN b ON b.doc = l.doc WHERE ms // 1000 >= min_ts""",
        ),
        "sql_group_by_value": _with(
            _SERIES,
            """SELECT tier, zone, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM f WHERE name = 'error' GROUP BY tier, zone""",
        ),
        "sql_labels_of_series": _with(
            _SERIES,
            """SELECT '{"__name__":"click","k":"' || k || '"' || coalesce(',"tier":"' || tier || '"', '') || ',"user":"' || u || '"'
                || coalesce(',"zone":"' || zone || '"', '') || '}' AS labels,
              concat_ws(',', '__name__', 'k', CASE WHEN tier IS NOT NULL THEN 'tier' END, 'user', CASE WHEN zone IS NOT NULL THEN 'zone' END) AS keys,
              concat_ws(',', 'click', k, tier, u, zone) AS vals, 4 AS user_pos, CAST(NULL AS INT) AS no_pos
            FROM sr WHERE name = 'click'""",
        ),
        "sql_matchers": _with(
            _SERIES,
            """SELECT u AS user, count(*) AS n, count(*) AS same, count(*) AS gold, 0 AS stale
            FROM f WHERE name = 'view' AND regexp_matches(k, '^1') AND zone IS DISTINCT FROM 'z1' GROUP BY u""",
        ),
        "label_info": _LABEL_INFO,
        "label_values_of_series": _with(
            _SERIES,
            """SELECT '__name__' AS key, name AS value, count(*) AS n FROM sr GROUP BY name
            UNION ALL SELECT 'k', k, count(*) FROM sr GROUP BY k
            UNION ALL SELECT 'tier', tier, count(*) FROM sr WHERE tier IS NOT NULL GROUP BY tier
            UNION ALL SELECT 'user', u, count(*) FROM sr GROUP BY u
            UNION ALL SELECT 'zone', zone, count(*) FROM sr WHERE zone IS NOT NULL GROUP BY zone""",
        ),
        "effective_settings": """
            SELECT metric_name, CASE WHEN metric_name = 'click' THEN 3600 ELSE 28800 END AS chunk_interval_s,
              CASE metric_name WHEN 'view' THEN 1728000 WHEN 'made_by_setting' THEN 7 ELSE 864000 END AS retention_s
            FROM (SELECT DISTINCT event_type AS metric_name FROM events
                  UNION ALL SELECT 'made_by_setting'
                  UNION ALL SELECT DISTINCT o_orderpriority FROM orders)""",
        "name_unique": _with(
            """c AS (
              SELECT c_custkey, c_name || repeat('x', CAST(c_custkey % 70 AS INTEGER)) AS f, CAST(c_custkey AS VARCHAR) AS n
              FROM customer)""",
            f"""SELECT c_custkey, {_named('f', 'n')} AS table_name, {_named('f', 'n')} AS value_column,
              {_named("(f || '_id')", "(n || '_id')")} AS id_column,
              CASE c_custkey % 7 WHEN 0 THEN 'label_time' WHEN 1 THEN 'label_labels' ELSE 'timely' END AS view_key
            FROM c""",
        ),
        "expired_metrics": _with(
            _CHUNKS,
            f"""SELECT DISTINCT name AS metric_name FROM c WHERE chunk_end <= {NOW_S} -
              CASE name WHEN 'view' THEN 29 WHEN 'click' THEN 60 ELSE 10 END * {DAY_S}""",
        ),
        "retention_cutoffs": _with(_RETENTION, "SELECT name AS metric_name, cutoff_s FROM cut"),
        "retention_series": _with(_RETENTION, "SELECT labels FROM gone"),
        "retention_labels": _with(
            _RETENTION, "SELECT DISTINCT key, value FROM gone_p WHERE (key, value) NOT IN (SELECT (key, value) FROM kept_p)"
        ),
        "retention_labels_by_metric": _with(
            _RETENTION,
            """SELECT DISTINCT g.key, g.value FROM gone_p g
            LEFT JOIN kept_p k ON k.name = g.name AND k.key = g.key AND k.value = g.value WHERE k.key IS NULL""",
        ),
        "retention_labels_expired": f"""
            WITH r AS (
              SELECT event_type, CAST(sec // {DAY_S} AS VARCHAR) AS day, CAST(user_id AS VARCHAR) AS u,
                     sec - sec % 28800 + 28800 > {NOW_S} - 10 * {DAY_S} AS alive
              FROM (SELECT *, epoch_us(ts) // 1000000 AS sec FROM events)),
            k AS (SELECT 'day' AS key, day AS value, alive FROM r UNION ALL SELECT 'user', u, alive FROM r
                  UNION ALL SELECT '__name__', event_type, alive FROM r)
            SELECT key, value FROM k GROUP BY key, value HAVING NOT bool_or(alive)""",
        "retention_facts": _with(
            _RETENTION,
            """SELECT c.name AS metric_name, count(*) FILTER (WHERE alive) AS n_left,
              count(DISTINCT chunk_start) FILTER (WHERE alive) AS chunks_left,
              nullif(count(DISTINCT chunk_start) FILTER (WHERE NOT alive), 0) AS chunks_dropped,
              count(DISTINCT c.labels) FILTER (WHERE alive) AS series_left
            FROM (SELECT c.*, cutoff_s IS NULL OR chunk_end > cutoff_s AS alive FROM c LEFT JOIN cut ON cut.name = c.name) c
            GROUP BY c.name""",
        ),
        "retention_applied": _with(
            _RETENTION,
            """SELECT c.name AS metric_name, count(*) AS n_left, count(DISTINCT labels) AS series_left
            FROM c LEFT JOIN cut ON cut.name = c.name WHERE cutoff_s IS NULL OR sec >= cutoff_s GROUP BY c.name""",
        ),
        "parse_round_trip": _with(
            _DUMPS,
            """SELECT CAST(doc AS VARCHAR) AS doc_id, target, scrape_ts, line, event_type AS name, 'Gauge' AS series_type,
              CAST(user_id AS VARCHAR) AS "user", props, cents, ms AS own_ts, ms FROM l""",
        ),
        "read_dump_files": _with(_FILES, _FILE_SAMPLES),
        "read_split_dumps": _with(_FILES, _FILE_SAMPLES),
        "ingest_split_dumps": _with(
            _FILES,
            """SELECT '__name__=' || event_type || ',env=prod,props=' || props || ',user=' || user_id AS labels, ms, cents
            FROM l WHERE ms // 1000 >= scrape_ts - 300""",
        ),
        "parse_families": _with(
            _FAMILIES,
            """SELECT doc_id, line, name, series_type, labels, CAST(round(v * 100) AS BIGINT) AS cents, own_ts
            FROM l WHERE series_type IS NOT NULL""",
        ),
        "parse_families_float": _with(
            _FAMILIES,
            """, g AS (
              SELECT name, series_type, v FROM l WHERE series_type IS NOT NULL
              UNION ALL SELECT name, 'CounterInteger', t FROM l WHERE line = 2
              UNION ALL SELECT name, 'CounterInteger', t FROM l WHERE line = 10 AND series_type IS NULL)
            SELECT name, series_type, count(*) AS n, CAST(sum(CAST(round(v * 100) AS BIGINT)) AS BIGINT) AS cents
            FROM g GROUP BY name, series_type""",
        ),
        "parse_rejects": _with(
            _FAMILIES,
            """SELECT doc_id, line, CASE line WHEN 0 THEN 'early 1' WHEN 2 THEN 'orders_total ' || t WHEN 7 THEN 'wait ' || k
              WHEN 9 THEN 'early 2' ELSE 'early ' || t END AS text FROM l WHERE series_type IS NULL""",
        ),
        "type_registry": _with(
            _FAMILIES,
            """, r(name, series_type, family, family_kind) AS (VALUES
              ('orders_total', 'CounterInteger', 'orders_total', 'counter'), ('price', 'Counter', 'price', 'summary'),
              ('price_count', 'CounterInteger', 'price', 'summary'), ('price_sum', 'Counter', 'price', 'summary'),
              ('wait_bucket', 'CounterInteger', 'wait', 'histogram'), ('wait_count', 'CounterInteger', 'wait', 'histogram'),
              ('wait_sum', 'Counter', 'wait', 'histogram'))
            SELECT doc_id, r.* FROM o, r
            UNION ALL SELECT doc_id, 'early', coalesce(late, 'CounterInteger'), 'early',
              CASE WHEN late IS NULL THEN 'counter' ELSE 'gauge' END FROM o""",
        ),
        "family_names": """
            SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, family, kind
            FROM orders, (VALUES ('price', 'summary'), ('wait', 'histogram')) r(family, kind)""",
        "label_escapes": "SELECT doc_id, lang, md5(text) AS text_md5, n_chars FROM documents",
        "age_filter": _with(
            _DUMPS + _BOOKMARKS,
            """SELECT CAST(l.doc AS VARCHAR) AS doc_id, l.target, l.scrape_ts, event_type AS name, ms AS own_ts
            FROM l JOIN b ON b.doc = l.doc WHERE ms // 1000 >= min_ts""",
        ),
        "age_filter_untimed": _with(
            _DUMPS + _BOOKMARKS,
            """SELECT l.target, event_type AS name, count(*) AS n, count(*) FILTER (WHERE cents_odd) AS n_timed
            FROM (SELECT *, right(CAST(value AS VARCHAR), 1) IN ('1', '3', '5', '7', '9') AS cents_odd
                  FROM l JOIN (SELECT event_id AS id, value FROM events) v ON v.id = l.event_id) l
            JOIN b ON b.doc = l.doc WHERE NOT cents_odd OR ms // 1000 >= min_ts GROUP BY l.target, event_type""",
        ),
        "remote_write_rows": _with(
            _DUMPS,
            """SELECT CAST(doc AS VARCHAR) AS doc_id, line AS at,
              '__name__=' || event_type || ';env=prod;pod=' || target || ';user=' || user_id || ';props=' || props AS labels,
              cents, ms FROM l""",
        ),
        "stale_markers": """
            SELECT event_id, event_type, CASE event_id % 5 WHEN 0 THEN 'stale' WHEN 1 THEN 'normal_nan' WHEN 2 THEN 'other_nan'
              ELSE 'value' END AS kind, event_id % 5 = 0 AS stale, event_id % 5 = 1 AS normal_nan FROM events""",
        "discover_targets": """
            SELECT s_name AS name,
              'http://10.0.' || s_suppkey // 256 || '.' || s_suppkey % 256 || ':'
                || CASE WHEN s_suppkey % 5 = 0 THEN 80 WHEN s_suppkey % 3 = 0 THEN s_suppkey + 9000 ELSE 80 END || '/'
                || CASE WHEN s_suppkey % 7 = 0 THEN 'stats' WHEN s_suppkey % 2 = 0 THEN 'm/' || s_suppkey ELSE 'metrics' END AS url,
              CASE WHEN s_suppkey % 9 = 0 THEN 'namespace=' || n_name || ',pod=' || s_name
                ELSE 'pod=' || s_name || ',instance=' || CASE WHEN s_suppkey % 8 = 0 THEN '?'
                  ELSE '192.168.0.' || s_suppkey % 256 END || ',namespace=' || n_name END AS labels
            FROM supplier JOIN nation ON n_nationkey = s_nationkey
            WHERE s_suppkey % 12 <> 5 AND s_suppkey % 10 <> 0 AND (s_suppkey % 4 <> 0 OR s_suppkey % 6 = 0)""",
        "fold_targets": _FOLDED,
        "refresh_targets": _with(
            _POD_LOG,
            f""", snap AS (SELECT name, arg_max(coalesce(any_url, ''), seq) AS url FROM log GROUP BY name)
            SELECT snap.name, snap.url, CASE WHEN tgt.url = snap.url THEN last_scrape ELSE {NOW_S} END AS last_scrape
            FROM snap LEFT JOIN tgt ON tgt.name = snap.name WHERE snap.url <> ''""",
        ),
        "ingest_report": f"""
            SELECT *, CASE WHEN response_bytes_peak * 100 > 1048576
                THEN printf('%.1f MiB', CAST(response_bytes_peak AS DOUBLE) * 100 / 1048576)
                ELSE printf('%.1f KiB', CAST(response_bytes_peak AS DOUBLE) * 100 / 1024) END AS peak_text
            FROM ({_INGEST_REPORT})""",
        "stream_report_events": _INGEST_REPORT,
        "stream_report_restarted": _INGEST_REPORT,
        "stream_ingest_report": _with(
            _DUMPS + _BOOKMARKS,
            f""", a AS (
              SELECT l.*, ms // 1000 >= min_ts AS kept, CASE WHEN l.scrape_ts < {MADE_S} THEN 0 ELSE 1 END AS half,
                strlen(event_type) + strlen(CAST(user_id AS VARCHAR)) + strlen(replace(props, '"', '""')) + strlen(CAST(value AS VARCHAR))
                  + strlen(CAST(ms AS VARCHAR)) + 21 AS bytes
              FROM l JOIN b ON b.doc = l.doc JOIN (SELECT event_id, value FROM events) v ON v.event_id = l.event_id),
            d AS (
              SELECT doc, scrape_ts, half, sum(bytes) - 1 AS bytes, count(*) FILTER (WHERE kept) AS w, count(*) FILTER (WHERE NOT kept) AS s
              FROM (SELECT doc, scrape_ts, half, kept, bytes FROM a
                    UNION ALL SELECT doc, scrape_ts, half, NULL, strlen(event_type) + 14
                    FROM (SELECT DISTINCT doc, scrape_ts, half, event_type FROM a))
              GROUP BY doc, scrape_ts, half),
            n AS (
              SELECT half, count(*) AS series FROM (SELECT event_type, user_id, props, min(half) AS half FROM a WHERE kept GROUP BY ALL)
              GROUP BY half),
            ends AS (SELECT max(scrape_ts) AS ts, half FROM d GROUP BY half),
            g AS (
              SELECT ts - ts % 300 AS start, CAST(sum(series) AS BIGINT) AS series FROM n JOIN ends USING (half) GROUP BY start),
            i AS (SELECT *, scrape_ts - scrape_ts % 300 AS interval_start FROM d)
            SELECT interval_start, count(*) AS scrapes, 0::BIGINT AS scrape_errors,
              0::BIGINT AS scrape_timeouts, 0::BIGINT AS scrape_refused, CAST(sum(w) AS BIGINT) AS writes, 0::BIGINT AS write_errors,
              CAST(sum(s) AS BIGINT) AS write_skips,
              coalesce(max(g.series), 0) AS new_series,
              CAST(sum(bytes) AS BIGINT) AS response_bytes, CAST(max(bytes) AS BIGINT) AS response_bytes_peak
            FROM i LEFT JOIN g ON g.start = i.interval_start GROUP BY interval_start""",
        ),
        "ingest_gauges": f"""
            WITH s AS (SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem)
            SELECT 'targets' AS gauge, count(*) AS value FROM ({_FOLDED})
            UNION ALL SELECT 'series', count(*) FROM s UNION ALL SELECT 'series_bytes', count(*) * 3 * 4 FROM s""",
        "stream_targets_restarted": _FOLDED,
        "stream_bookmark_rows": _with(
            _DUMPS + _BOOKMARKS, "SELECT CAST(doc AS VARCHAR) AS doc_id, target, scrape_ts, min_ts FROM b"
        ),
        "stream_target_set": _FOLDED,
        "stream_ingest_dumps": _with(
            _DUMPS + _BOOKMARKS,
            """SELECT '__name__=' || event_type || ',env=prod,props=' || props || ',user=' || user_id AS labels, ms, cents
            FROM l JOIN b ON b.doc = l.doc WHERE ms // 1000 >= min_ts""",
        ),
        "lineitem_by_status": _with(
            _LINEITEMS,
            """SELECT status, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM li
            WHERE name = 'R' AND NOT regexp_matches(supplier, '0$') GROUP BY status""",
        ),
        "lineitem_by_supplier": _with(
            _LINEITEMS,
            """SELECT supplier, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, max(cents) AS greatest FROM li
            WHERE name = 'N' GROUP BY supplier""",
        ),
        "lineitem_ingest": _with(
            _LINEITEMS,
            """SELECT name AS metric_name, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents,
              count(DISTINCT (status, supplier)) AS n_series FROM li GROUP BY name""",
        ),
    }
