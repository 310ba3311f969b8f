"""The catalogue again as plain SQL, written independently for checking."""

from __future__ import annotations

EV = """WITH ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS v,
         CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(ts AS DATE) AS day
  FROM events)"""

PRICED = """WITH o AS (
  SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"""

DAILY = f"""{EV}, daily AS (
  SELECT user_id, day, arg_max(v, event_id) AS v FROM ev GROUP BY user_id, day),
span AS (SELECT user_id, min(day) AS a, max(day) AS b FROM daily GROUP BY user_id),
grid AS (
  SELECT user_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM span),
filled AS (
  SELECT g.user_id, g.day, d.v IS NULL AS synthetic,
         last_value(d.v IGNORE NULLS) OVER w AS v,
         last_value(CASE WHEN d.v IS NOT NULL THEN g.day END IGNORE NULLS) OVER w AS real_day
  FROM grid g LEFT JOIN daily d ON d.user_id = g.user_id AND d.day = g.day
  WINDOW w AS (PARTITION BY g.user_id ORDER BY g.day ROWS UNBOUNDED PRECEDING))"""

PLACED = f"""{EV}, placed AS (
  SELECT user_id, day, event_id,
         row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS rn,
         count(*) OVER (PARTITION BY user_id, day) AS cnt
  FROM ev)"""

FAULTS = f"""{EV}, marked AS (
  SELECT user_id, ts, event_id, v, k,
         CAST(sum(CASE WHEN k = 13 THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS faults
  FROM ev)"""


PUBSUB = """WITH t AS (
  SELECT 'nation' AS producer, CAST(n_nationkey AS BIGINT) AS seq, n_name AS msg FROM nation
  UNION ALL SELECT 'region', CAST(r_regionkey AS BIGINT), r_name FROM region
  UNION ALL SELECT 'part', p_partkey, p_name FROM part)
SELECT producer, seq, 'text' AS consumer, msg AS value FROM t
UNION ALL SELECT producer, seq, 'size', CAST(length(msg) AS VARCHAR) FROM t"""

LANDED = "SELECT o_orderstatus, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY o_orderstatus"

def _kept(condition: str) -> str:
    return f"{PLACED} SELECT user_id, CAST(day AS VARCHAR) AS day, event_id FROM placed WHERE {condition}"


def _word_counts() -> str:
    return """SELECT lang, CAST(sum(CASE WHEN text = '' THEN 1 WHEN rtrim(text, ' ') = '' THEN 0
       ELSE len(string_split(rtrim(text, ' '), ' ')) END) AS BIGINT) AS words
FROM documents GROUP BY lang"""


ORACLES: dict[str, str] = {
    "map_chain": f"{EV} SELECT event_id, (v + 1) * 10 AS x FROM ev",
    "filter_take": f"{PRICED} SELECT o_orderkey, cents FROM o WHERE cents > 10000000 ORDER BY o_orderkey LIMIT 100",
    "filter_strict": f"""{EV} SELECT event_type, count(*) AS rows, CAST(sum(k) AS BIGINT) AS total
FROM ev WHERE k > 50 GROUP BY event_type""",
    "drop_n": f"""{PRICED}, numbered AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM o)
SELECT o_orderstatus, count(*) AS rows, CAST(sum(cents) AS BIGINT) AS total
FROM numbered WHERE rn > 1000 GROUP BY o_orderstatus""",
    "head_last": f"""{EV} SELECT user_id, arg_min(event_id, row(ts, event_id)) AS "first",
       arg_max(event_id, row(ts, event_id)) AS "last" FROM ev GROUP BY user_id""",
    "fold_word_count": _word_counts(),
    "reduce_sum": f"""{EV} SELECT event_type, CAST(sum(v) AS BIGINT) AS total, min(v) AS low, max(v) AS high
FROM ev GROUP BY event_type""",
    "deferred_scalar": f"""{PRICED} SELECT o_orderkey, cents FROM o
WHERE CAST(cents AS HUGEINT) * (SELECT count(*) FROM o) > (SELECT sum(cents) FROM o)""",
    "random_source": f"""{EV} SELECT event_type, count(*) AS rows, count(*) AS in_range, count(*) AS again, true AS spread
FROM ev GROUP BY event_type""",
    "take_until": f"""{EV}, cuts AS (SELECT event_type, min(ts) AS cut FROM ev WHERE k = 13 GROUP BY event_type)
SELECT ev.event_type, count(*) AS rows FROM ev LEFT JOIN cuts ON cuts.event_type = ev.event_type
WHERE cut IS NULL OR ts < cut GROUP BY ev.event_type""",
    "take_until_shared": f"""{EV} SELECT event_type, count(*) AS rows FROM ev
WHERE ts < (SELECT min(ts) FROM ev WHERE k = 13) GROUP BY event_type""",
    "double_reply": "SELECT CAST(n_nationkey * 2 AS BIGINT) AS number, n_name || n_name AS name FROM nation",
    "with_seq": f"{EV} SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS seq FROM ev",
    "scan_user": f"""{EV} SELECT user_id, row_number() OVER w AS place, event_id,
       CAST(sum(v) OVER w AS BIGINT) AS running FROM ev
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
UNION ALL SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT) FROM ev""",
    "scan_global": f"""{EV} SELECT row_number() OVER w AS place, event_id, CAST(sum(v) OVER w AS BIGINT) AS running
FROM ev WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
UNION ALL SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT)""",
    "batch_n": f"""{EV}, placed AS (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p FROM ev)
SELECT user_id, p // 10 AS batch, count(*) AS size, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY p) AS ids
FROM placed GROUP BY user_id, p // 10""",
    "group_fold": """SELECT CASE WHEN w = '' THEN '' ELSE lower(substr(w, 1, 1)) END AS letter, count(*) AS words
FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1""",
    "group_merge_reduce": "SELECT CAST(sum(length(text)) AS BIGINT) AS total FROM documents",
    "split_when": """WITH s AS (
  SELECT conv_id, role, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
         OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
  FROM conversations)
SELECT conv_id, segment, count(*) FILTER (WHERE role <> 'user') AS turns FROM s GROUP BY conv_id, segment""",
    "conflate": f"""{EV} SELECT user_id, CAST(day AS VARCHAR) AS day,
       CASE WHEN count(*) = 1 THEN min(event_type)
            ELSE 'You have ' || count(*) || ' events that require your attention' END AS description,
       count(*) AS instances
FROM ev GROUP BY user_id, day""",
    "flat_map_concat": """WITH x AS (
  SELECT p_partkey, unnest(generate_series(p_size, 3 * p_size)) AS x,
         unnest(generate_series(0, 2 * p_size)) AS pos FROM part)
SELECT p_partkey, count(*) AS rows, CAST(sum(x) AS BIGINT) AS total, CAST(sum(pos * x) AS BIGINT) AS weighted
FROM x GROUP BY p_partkey""",
    "flat_map_merge": """SELECT CAST(x AS BIGINT) AS x, count(*) AS rows
FROM (SELECT unnest(generate_series(p_size, 3 * p_size)) AS x FROM part) GROUP BY x""",
    "zip_same_source": f"{EV} SELECT event_id, v + 1 AS a, v * 10 AS b FROM ev",
    "zip_tables": """WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer),
o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders)
SELECT c.place, c_custkey, o_orderkey FROM c JOIN o ON o.place = c.place""",
    "max3": """WITH c AS (SELECT CAST(round(c_acctbal * 100) AS BIGINT) AS x, row_number() OVER (ORDER BY c_custkey) - 1 AS place
  FROM customer),
s AS (SELECT CAST(round(s_acctbal * 100) AS BIGINT) AS x, row_number() OVER (ORDER BY s_suppkey) - 1 AS place FROM supplier),
p AS (SELECT CAST(round(p_retailprice * 100) AS BIGINT) AS x, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part)
SELECT c.place, greatest(c.x, s.x, p.x) AS highest FROM c JOIN s ON s.place = c.place JOIN p ON p.place = c.place""",
    "merge": f"""{EV} SELECT CAST(0 AS BIGINT) AS src, o_orderkey AS key, CAST(round(o_totalprice * 100) AS BIGINT) AS amount
FROM orders UNION ALL SELECT CAST(1 AS BIGINT), event_id, v FROM ev""",
    "concat": f"""{EV}, u AS (
  SELECT CAST(0 AS BIGINT) AS src, o_orderkey AS key, CAST(round(o_totalprice * 100) AS BIGINT) AS amount FROM orders
  UNION ALL SELECT CAST(1 AS BIGINT), event_id, v FROM ev)
SELECT row_number() OVER (ORDER BY src, key) - 1 AS place, src, key, amount FROM u""",
    "merge_preferred": f"""{EV} SELECT CAST(day AS VARCHAR) AS day, event_id,
       row_number() OVER (PARTITION BY day ORDER BY CASE WHEN event_type = 'error' THEN 0 ELSE 1 END, ts, event_id) - 1 AS place
FROM ev""",
    "broadcast_two": f"""{EV}, fed AS (
  SELECT event_type, 'plus' AS consumer, v + 1 AS x FROM ev
  UNION ALL SELECT event_type, 'times', v * 10 FROM ev)
SELECT event_type, consumer, count(*) AS rows, CAST(sum(x) AS BIGINT) AS total FROM fed GROUP BY event_type, consumer""",
    "balance": """WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders)
SELECT p % 2 AS lane, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM n GROUP BY p % 2""",
    "balance_mxn": """WITH u AS (
  SELECT o_orderkey AS key, 0 AS src FROM orders UNION ALL SELECT c_custkey, 1 FROM customer),
n AS (SELECT key, row_number() OVER (ORDER BY key, src) - 1 AS p FROM u)
SELECT p % 3 AS lane, count(*) AS rows, CAST(sum(key) AS BIGINT) AS keys FROM n GROUP BY p % 3""",
    "flag_split": f"""{PRICED} SELECT 'all' AS outlet, o_orderkey, cents FROM o
UNION ALL SELECT 'flagged', o_orderkey, CAST(NULL AS BIGINT) FROM o WHERE cents > 1000000""",
    "word_sink": """WITH w AS (SELECT lang, unnest(string_split(text, ' ')) AS w FROM documents)
SELECT lang, count(*) FILTER (WHERE length(w) < 5) AS short_words,
       count(*) FILTER (WHERE w = lower(w)) AS lower_words FROM w GROUP BY lang""",
    "pubsub": PUBSUB,
    "pubsub_stream": PUBSUB,
    "throttle": f"""{EV}, a AS (
  SELECT user_id, event_id, ts, epoch_us(ts) AS came,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM ev)
SELECT user_id, event_id, i * 3600000000 + max(came - i * 3600000000)
       OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS release FROM a""",
    "shed_drop_head": _kept("rn > cnt - 2"),
    "shed_drop_tail": _kept("rn < 2 OR rn = cnt"),
    "shed_drop_new": _kept("rn <= 2"),
    "shed_drop_buffer": _kept("rn > ((cnt - 1) // 2) * 2"),
    "shed_none": _kept("true"),
    "fill_forward": f"{DAILY} SELECT user_id, CAST(day AS VARCHAR) AS day, v AS value FROM filled",
    "extrapolate": f"""{DAILY} SELECT user_id, CAST(day AS VARCHAR) AS day, v + (day - real_day) AS value, synthetic
FROM filled""",
    "recover": f"""{FAULTS}, first AS (SELECT user_id, min(event_id) AS event_id FROM marked WHERE k = 13 GROUP BY user_id)
SELECT user_id, event_id, v, false AS recovered FROM marked WHERE faults = 0
UNION ALL SELECT user_id, event_id, CAST(-2147483648 AS BIGINT), true FROM first""",
    "recover_with": f"""{FAULTS}, failed AS (SELECT DISTINCT user_id FROM marked WHERE k = 13)
SELECT user_id, event_id, v, CAST(0 AS BIGINT) AS attempt FROM marked WHERE faults = 0
UNION ALL SELECT user_id, g.n, 90 + g.n, CAST(1 AS BIGINT) FROM failed, generate_series(0, 9) AS g(n)""",
    "resume_skip": f"{EV} SELECT user_id, event_id, v FROM ev WHERE k <> 13",
    "quarantine": f"{EV} SELECT user_id, event_id, v FROM ev WHERE k = 13",
    "stop_at_fault": f"{FAULTS} SELECT user_id, event_id, v FROM marked WHERE faults = 0",
    "restart_scan": f"""{FAULTS} SELECT user_id, event_id, faults AS epoch,
       CAST(sum(v) OVER (PARTITION BY user_id, faults ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM marked WHERE k <> 13""",
    "replay_dedupe": f"""{EV} SELECT event_id, v,
       CAST(CASE WHEN day < (SELECT min(day) FROM ev) + 3 THEN 1 ELSE 2 END AS BIGINT) AS attempt FROM ev""",
    "count_through": f"{EV} SELECT count(*) AS passed FROM ev WHERE v > 5000",
    "traced": f"{EV} SELECT count(*) AS rows, min(v) AS low, max(v) AS high FROM ev",
    "oncall_enrich": f"""{EV}, duty AS (
  SELECT day, CAST(day - DATE '1970-01-01' AS BIGINT) % 3 AS idx FROM ev WHERE event_type = 'error')
SELECT CASE idx WHEN 0 THEN 'Ines' WHEN 1 THEN 'Omar' ELSE 'Wei' END AS engineer,
       CASE idx WHEN 0 THEN 'ines' WHEN 1 THEN 'omar' ELSE 'wei' END || '@example.org' AS email,
       CAST(day AS VARCHAR) AS day, count(*) AS pages
FROM duty GROUP BY idx, day""",
    "map_async": f"{EV} SELECT event_id, v * 2 AS reply FROM ev",
    "notify": f"""{EV} SELECT 'ines@example.org' AS email, 'event ' || event_id AS description, epoch_us(ts) AS "at",
       CAST(1 AS BIGINT) AS instances FROM ev""",
    "conflate_notify": f"""{EV} SELECT 'ines@example.org' AS email,
       CASE WHEN count(*) = 1 THEN min(event_type) ELSE count(*) || ' events for user ' || user_id END AS description,
       epoch_us(max(ts)) AS "at", count(*) AS instances FROM ev GROUP BY user_id, day""",
    "scan_max": f"""{EV} SELECT user_id, row_number() OVER w AS place, event_id, max(v) OVER w AS highest FROM ev
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
UNION ALL SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM ev""",
    "group_limited": "SELECT lang, count(*) AS rows, max(length(text)) AS longest FROM documents GROUP BY lang",
    "scan_by_text": """SELECT source, row_number() OVER w AS place, doc_id,
       CAST(sum(length(text)) OVER w AS BIGINT) AS running FROM documents
WINDOW w AS (PARTITION BY source ORDER BY text, doc_id ROWS UNBOUNDED PRECEDING)
UNION ALL SELECT DISTINCT source, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT) FROM documents""",
    "mask": """SELECT n_nationkey,
       array_to_string(list_transform(string_split(n_name, ''), lambda c: chr(unicode(c) + 3)), '') AS n_name FROM nation""",
    "mask_documents": """SELECT doc_id, length(text) AS size,
       md5(array_to_string(list_transform(string_split(text, ''), lambda c: chr(unicode(c) + 3)), '')) AS digest
FROM documents""",
    "mask_roundtrip": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM documents",
    "ingest_files": LANDED,
    "ack_sink": LANDED,
    "hop_distance": """WITH RECURSIVE edges AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem),
walk(kind, node, hops) AS (
  SELECT 'l_suppkey', CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION
  SELECT CASE WHEN w.kind = 'l_suppkey' THEN 'l_partkey' ELSE 'l_suppkey' END,
         CASE WHEN w.kind = 'l_suppkey' THEN e.p ELSE e.s END, w.hops + 1
  FROM walk w JOIN edges e ON (w.kind = 'l_suppkey' AND e.s = w.node) OR (w.kind = 'l_partkey' AND e.p = w.node)
  WHERE w.hops < 4)
SELECT kind, node, min(hops) AS hops FROM walk GROUP BY kind, node""",
}

ORACLES |= {"conflate_stream": ORACLES["conflate"], "scan_stream": ORACLES["scan_user"], "restart_stream": ORACLES["restart_scan"],
            "batch_stream": ORACLES["batch_n"], "throttle_stream": ORACLES["throttle"], "extrapolate_stream": ORACLES["extrapolate"]}
ORACLES["split_stream"] = f"""{EV}, s AS (
  SELECT user_id, event_type, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM ev)
SELECT user_id, segment, count(*) FILTER (WHERE event_type <> 'signup') AS rows FROM s GROUP BY user_id, segment"""

ORACLES["scan_affine"] = f"""{EV.replace("WITH", "WITH RECURSIVE", 1)}, numbered AS (
  SELECT user_id, event_id, v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM ev),
walk(user_id, place, event_id, running) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(7 AS BIGINT) FROM ev
  UNION ALL
  SELECT n.user_id, n.place, n.event_id, (w.running * 31 + n.v) % 1000003 FROM walk w
  JOIN numbered n ON n.user_id = w.user_id AND n.place = w.place + 1)
SELECT user_id, place, event_id, running FROM walk"""
ORACLES["fold_affine"] = f"""{EV.replace("WITH", "WITH RECURSIVE", 1)}, numbered AS (
  SELECT user_id, v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM ev),
walk(user_id, place, running) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(7 AS BIGINT) FROM ev
  UNION ALL
  SELECT n.user_id, n.place, (w.running * 31 + n.v) % 1000003 FROM walk w
  JOIN numbered n ON n.user_id = w.user_id AND n.place = w.place + 1)
SELECT user_id, arg_max(running, place) AS checksum FROM walk GROUP BY user_id"""

ORACLES["lookup_async"] = "SELECT o_orderkey, c_name AS customer FROM orders LEFT JOIN customer ON c_custkey = o_custkey"
ORACLES["replay_stream"] = LANDED
ORACLES["bounded_landing"] = """WITH parted AS (SELECT event_id, ts, CAST((dayofmonth(ts) - 1) // 8 AS INT) AS part FROM events),
placed AS (SELECT event_id, part // 2 AS take, row_number() OVER (PARTITION BY part // 2 ORDER BY part DESC, ts DESC, event_id DESC) AS rn,
  count(*) OVER (PARTITION BY part // 2) AS n FROM parted),
lost AS (SELECT take, CAST(sum(greatest(n - 500, 0)) OVER (ORDER BY take) AS BIGINT) AS evicted FROM (SELECT DISTINCT take, n FROM placed))
SELECT CAST(take AS INT) AS take, event_id, evicted FROM placed JOIN lost USING (take) WHERE rn <= 500"""
