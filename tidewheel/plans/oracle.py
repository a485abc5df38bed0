"""DuckDB SQL for the queries over events."""

from __future__ import annotations

_WIRE = """
w AS (
  SELECT (epoch_us(ts) // 1000) || '-' || event_id AS stream_id, event_id, epoch_us(ts) // 1000 AS ms, ts AS t,
         CASE event_type WHEN 'signup' THEN 'task.started' WHEN 'purchase' THEN 'task.finished' ELSE event_type END AS action,
         'u' || user_id AS actor, 'team-' || (user_id % 5) AS team, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS ts_text, strftime(ts, '%Y-%m-%d') AS dt
  FROM events)"""

_STAMP = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({0}) % 1000000 = 0 THEN '' WHEN epoch_us({0}) % 1000 = 0 THEN strftime({0}, '.%g') ELSE strftime({0}, '.%f') END || 'Z'"


def _stamp(column: str) -> str:
    return _STAMP.format(column)


def _paired(expiry: bool = True) -> str:
    expired = "WHEN epoch_us(TIMESTAMP '2024-01-31') - epoch_us(s_t) > 21600000000 THEN 'expired'" if expiry else ""
    return f"""{_WIRE},
e AS (
  SELECT *, CASE WHEN k % 4 <> 0 THEN 's' || (k % 2) END AS session_id, coalesce(CASE WHEN k % 4 <> 0 THEN 's' || (k % 2) END, '') AS sid,
         CASE action WHEN 'task.started' THEN 1 ELSE -1 END AS v
  FROM w WHERE action IN ('task.started', 'task.finished')),
d AS (SELECT *, sum(v) OVER (PARTITION BY team, actor, sid ORDER BY ms, event_id) AS depth FROM e),
l AS (SELECT *, min(depth) OVER (PARTITION BY team, actor, sid ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM d),
o AS (SELECT *, v = -1 AND depth < least(coalesce(low, 0), 0) AS orphan FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY team, actor, sid, v, orphan ORDER BY ms, event_id) AS rk,
             lead(CASE WHEN v = 1 THEN event_id END IGNORE NULLS) OVER (PARTITION BY team, actor ORDER BY ms, event_id) AS again FROM o),
x AS (
  SELECT s.team, s.actor, s.session_id, s.stream_id AS start_stream_id, f.stream_id AS finish_stream_id, s.t AS s_t, f.t AS f_t, s.again
  FROM r s LEFT JOIN r f ON f.v = -1 AND NOT f.orphan AND f.team = s.team AND f.actor = s.actor AND f.sid = s.sid AND f.rk = s.rk WHERE s.v = 1
  UNION ALL SELECT team, actor, session_id, NULL, stream_id, NULL, t, NULL FROM r WHERE orphan),
p AS (
  SELECT sha256(team || '|' || actor || '|' || coalesce(start_stream_id, finish_stream_id)) AS session_pk, team, actor, session_id, start_stream_id, finish_stream_id,
         {_stamp('s_t')} AS started_at, {_stamp('f_t')} AS finished_at,
         CASE WHEN start_stream_id IS NOT NULL AND finish_stream_id IS NOT NULL THEN greatest(0, (epoch_us(f_t) - epoch_us(s_t)) // 1000) END AS duration_ms,
         CASE WHEN start_stream_id IS NULL THEN 'orphan_finish' WHEN finish_stream_id IS NOT NULL THEN 'completed' WHEN again IS NOT NULL THEN 'interrupted' {expired} ELSE 'open' END AS state,
         CAST(NULL AS VARCHAR) AS project, coalesce(s_t, f_t) AS moment
  FROM x)"""


_LINES = f"""{_WIRE},
one AS (SELECT *, '{{"stream_id":"' || stream_id || '","action":"' || action || '","ts":"' || ts_text || '","team":"' || team || '"}}' AS line FROM w),
lines AS (SELECT 'office' AS view, * FROM one UNION ALL SELECT team AS view, * FROM one)"""

_SANITIZE = "substr(regexp_replace(replace(CASE WHEN substr(m, 64, 1) = chr(1) THEN substr(m, 1, 65) ELSE substr(m, 1, 64) END, chr(1), '_'), '^[.]+', ''), 1, 64)"


def oracle_sql() -> dict[str, str]:
    return {
        "pair_sessions": f"WITH {_paired()} SELECT session_pk, team, actor, session_id, start_stream_id, finish_stream_id, started_at, finished_at, duration_ms, state, project FROM p",
        "pair_with_pool": f"WITH {_paired(False)} SELECT session_pk, start_stream_id, finish_stream_id, state FROM p",
        "follow_microbatch": f"WITH {_paired(False)} SELECT session_pk, start_stream_id, finish_stream_id, state FROM p",
        "decode_raw": f"""WITH {_WIRE} SELECT stream_id, CAST(NULL AS VARCHAR) AS envelope_id, ts_text AS ts, actor, action, CAST(NULL AS VARCHAR) AS target, team, CAST(NULL AS VARCHAR) AS project,
            '{{"k":' || k || CASE WHEN k % 4 <> 0 THEN ',"session_id":"s' || (k % 2) || '"' ELSE '' END || '}}' AS payload,
            'action=' || action || ';actor=' || actor || ';payload={{"k":' || k || CASE WHEN k % 4 <> 0 THEN ',"session_id":"s' || (k % 2) || '"' ELSE '' END || '}};team=' || team || ';timestamp=' || ts_text AS fields,
            true AS decode_ok FROM w""",
        "decode_envelopes": """SELECT (event_id + 1) || '-0' AS stream_id, CASE WHEN event_id % 6 IN (0, 4) THEN 'e' || event_id END AS envelope_id,
            CASE WHEN event_id % 6 IN (0, 4) THEN 'a' || (user_id % 3) WHEN event_id % 6 = 5 THEN NULL ELSE 'flat' END AS actor, CASE WHEN event_id % 6 <> 5 THEN 't1' END AS team,
            CASE WHEN event_id % 6 IN (0, 4) THEN '{"session_id":"s","task_ref":{"issues":["I1",2,"I2"]}}' WHEN event_id % 6 = 5 THEN '{"handoff":"plain","snippet":"hi","task_ref":{"prs":["P1"]}}' ELSE '{}' END AS payload,
            event_id % 6 IN (0, 4, 5) AS decode_ok,
            CASE WHEN event_id % 6 = 2 THEN 'json/envelope is not a JSON object' WHEN event_id % 6 IN (1, 3) THEN 'json/envelope is invalid JSON' END AS decode_error FROM events""",
        "stream_id_order": """WITH s AS (SELECT DISTINCT CASE WHEN event_id % 50 = 0 THEN 'x' || event_id WHEN event_id % 50 = 1 THEN '0' ELSE (event_id % 1000) || '-' || user_id END AS stream_id FROM events)
            SELECT stream_id, stream_id = '0' OR stream_id NOT LIKE 'x%' AS valid, CASE WHEN stream_id = '0' THEN '0' WHEN stream_id NOT LIKE 'x%' THEN split_part(stream_id, '-', 1) END AS ms,
            CASE WHEN stream_id = '0' THEN '0' WHEN stream_id NOT LIKE 'x%' THEN split_part(stream_id, '-', 2) END AS seq FROM s""",
        "dt_partition_counts": f"WITH {_WIRE} SELECT dt, count(*) AS n FROM w GROUP BY dt",
        "resolved_times": f"""WITH {_WIRE}, z AS (SELECT *, CASE event_id % 3 WHEN 0 THEN make_timestamp(ms * 1000) WHEN 1 THEN t - INTERVAL 2 HOUR ELSE t END AS a FROM w)
            SELECT stream_id, {_stamp('a')} AS at, strftime(make_timestamp(event_id * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS seconds FROM z""",
        "team_safe_names": f"""WITH n AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'system' ELSE 'developer' END AS actor,
            CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'Dev Team/' || user_id WHEN 2 THEN '...' || event_type || 'é' WHEN 3 THEN repeat('.', 10) || repeat('ab', 50) WHEN 4 THEN repeat('x', 63) || '  y' WHEN 5 THEN '///' ELSE event_type END AS team FROM events),
            q AS (SELECT *, regexp_replace(team, '[^A-Za-z0-9._-]+', chr(1), 'g') AS m FROM n)
            SELECT event_id, CASE WHEN team = '' THEN CASE WHEN actor = 'system' THEN '_office' ELSE '_unknown' END WHEN {_SANITIZE} = '' THEN '_unknown' ELSE {_SANITIZE} END AS team_safe FROM q""",
        "range_scan": f"WITH {_WIRE} SELECT stream_id, action FROM w WHERE (ms > 1704672000000 OR ms = 1704672000000 AND event_id >= 0) AND (ms < 1705276800000 OR ms = 1705276800000 AND event_id <= 0)",
        "dedupe_after_checkpoint": f"WITH {_WIRE} SELECT stream_id FROM w WHERE ms > 1705276800000 OR ms = 1705276800000 AND event_id > 0",
        "resume_point": f"WITH {_WIRE} SELECT max_by(stream_id, CAST(ms AS HUGEINT) * 1000000000000 + event_id) AS max_stream_id FROM w",
        "interrupted_starts": f"WITH {_paired()} SELECT start_stream_id, team, actor FROM p WHERE state = 'interrupted'",
        "expired_sessions": f"WITH {_paired()} SELECT start_stream_id, started_at FROM p WHERE state = 'expired'",
        "orphan_finishes": f"WITH {_paired()} SELECT finish_stream_id, finished_at, session_id FROM p WHERE state = 'orphan_finish'",
        "session_pk": "SELECT event_id, sha256('team-' || (user_id % 5) || '|' || CASE WHEN event_id % 5 <> 0 THEN 'u' || user_id ELSE '' END || '|' || event_id) AS pk FROM events",
        "session_payloads": """SELECT event_id, event_type AS snippet, CASE event_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN '{"to":"x"}' ELSE 'done' END AS handoff, 'a' || (event_id % 3) || ',b,c' AS issues, CAST(NULL AS VARCHAR) AS prs FROM events""",
        "latest_upsert": "SELECT 'pk' || user_id AS session_pk, max_by(event_type, event_id) AS state, max(event_id) AS seq FROM events GROUP BY user_id",
        "manifest_event_counts": f"WITH {_LINES} SELECT count(*) FILTER (view = 'office') AS event_count, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes_used FROM lines",
        "session_state_counts": f"WITH {_paired()} SELECT s.state, count(p.state) AS n FROM (VALUES ('completed'), ('open'), ('interrupted'), ('orphan_finish'), ('expired')) s(state) LEFT JOIN p ON p.state = s.state GROUP BY s.state",
        "discovered_teams": f"WITH {_WIRE} SELECT DISTINCT team FROM w",
        "bytes_per_dt": f"WITH {_LINES} SELECT dt, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, count(*) AS n_lines FROM lines WHERE view = 'office' GROUP BY dt",
        "cap_evict_dates": f"""WITH {_LINES}, b AS (SELECT dt, sum(strlen(line) + 1) AS bytes FROM lines GROUP BY dt)
            SELECT dt, CAST(bytes AS BIGINT) AS bytes, sum(bytes) OVER () - coalesce(sum(bytes) OVER (ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 80 * (SELECT count(*) FROM events) AND dt < max(dt) OVER () AS evicted FROM b""",
        "cap_trim_events": f"""WITH {_paired()},
            one AS (SELECT *, '{{"stream_id":"' || stream_id || '","action":"' || action || '","ts":"' || ts_text || '","team":"' || team || '"}}' AS line FROM w WHERE dt = (SELECT max(dt) FROM w)),
            raw AS (SELECT 'office' AS view, * FROM one UNION ALL SELECT team, * FROM one),
            own AS (SELECT *, '{{"session_pk":"' || session_pk || '","state":"' || state || '","start":"' || coalesce(start_stream_id, '') || '","finish":"' || coalesce(finish_stream_id, '') || '"}}' AS line FROM p WHERE strftime(moment, '%Y-%m-%d') = (SELECT max(dt) FROM w)),
            edge AS (SELECT team, session_pk, strlen(line) + 1 AS b, unnest([start_stream_id, finish_stream_id]) AS stream_id FROM own WHERE state IN ('completed', 'orphan_finish')),
            firsts AS (SELECT g.team, g.session_pk, any_value(b) AS b, min_by(g.stream_id, o.event_id) AS stream_id, min(o.event_id) AS event_id FROM edge g JOIN one o USING (stream_id) GROUP BY ALL),
            gone AS (SELECT 'r:' || view AS view, stream_id, event_id, strlen(line) + 1 AS b, 1 AS n FROM raw UNION ALL SELECT 's:' || team, stream_id, event_id, sum(b), count(*) FROM firsts GROUP BY ALL),
            size AS (SELECT 'r:' || view AS view, count(*) AS lines FROM raw GROUP BY ALL UNION ALL SELECT 's:' || team, count(*) FROM own GROUP BY ALL),
            ranked AS (SELECT *, lines - sum(n) OVER (PARTITION BY view ORDER BY event_id) < 1 AS guard FROM gone JOIN size USING (view)),
            ev AS (SELECT stream_id, event_id, sum(b) AS bytes_freed, max(CAST(guard AS INT)) AS g FROM ranked GROUP BY ALL),
            run AS (SELECT *, sum(bytes_freed) OVER (ORDER BY event_id) - bytes_freed AS before, sum(g) OVER (ORDER BY event_id) AS guards FROM ev),
            total AS (SELECT (SELECT sum(strlen(line) + 1) FROM raw) + (SELECT sum(strlen(line) + 1) FROM own) AS t)
            SELECT stream_id, CAST(bytes_freed AS BIGINT) AS bytes_freed FROM run, total WHERE guards = 0 AND t - before > 3 * (SELECT count(*) FROM events)""",
        "drop_log_ring": "SELECT event_id AS seq, event_type AS scope, CAST(strlen(props) AS INT) AS bytes_freed FROM events WHERE event_type = 'error' ORDER BY event_id DESC LIMIT 100",
        "redact_url": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'redis://10.0.0.' || (user_id % 250) || ':6379/0' WHEN 1 THEN 'redis://10.0.0.' || (user_id % 250) || '/0?x=a@b' WHEN 2 THEN 'rediss://10.0.0.' || (user_id % 250) ELSE '10.0.0.' || (user_id % 250) || '@x' END AS url FROM events""",
        "max_mb": "SELECT event_id, CASE WHEN event_id % 10 = 0 OR event_id % 40 - 5 <= 0 THEN 500 ELSE greatest(event_id % 40 - 5, 16) END AS mb FROM events",
        "backfill_range": f"""WITH {_WIRE} SELECT team, dt, count(*) AS n_events FROM w WHERE ms < 1705276800000 OR ms = 1705276800000 AND event_id <= 0 GROUP BY ALL""",
    }
