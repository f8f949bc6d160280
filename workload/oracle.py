"""Building blocks of the oracle SQL: the same views written for DuckDB, without any parsing."""

from __future__ import annotations

CTES = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "tracking": """SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN 'user' || user_id
       WHEN event_id % 7 = 2 THEN CASE WHEN event_id % 14 = 2 THEN 'dev-' || user_id ELSE '' END
       ELSE CAST(user_id AS VARCHAR) END AS user_id,
  'user' || user_id AS username,
  CASE WHEN event_id % 6 < 4 THEN 'dev-' || user_id ELSE '' END AS uuid,
  CASE event_type WHEN 'signup' THEN 'account.created'
       WHEN 'purchase' THEN 'course.enrollment.activated'
       WHEN 'view' THEN '/courses/course-' || k || '/courseware/w1'
       ELSE 'page.' || event_type END AS event_type,
  CASE event_id % 6 WHEN 0 THEN 'android' WHEN 1 THEN 'androidTV' WHEN 2 THEN 'iPhone'
       WHEN 3 THEN 'iPad' ELSE 'web' END AS platform,
  CASE event_id % 4 WHEN 1 THEN 'http://ref' || (k % 5) || '.example.org/p/' || k
       WHEN 2 THEN 'https://ref' || (k % 5) || '.example.org' ELSE '' END AS origin_referer,
  CASE WHEN event_id % 3 = 0 THEN 'edm' || (k % 4) ELSE '' END AS spam,
  'h' || (event_id % 3) AS host,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS time,
  CASE WHEN event_type IN ('view', 'purchase', 'click') THEN 'course-' || k ELSE '' END
    AS course_id,
  CASE event_type WHEN 'signup' THEN 'register' WHEN 'purchase' THEN 'enrollment'
       WHEN 'view' THEN 'access_courseware' ELSE 'unknown' END AS event_group,
  ts
FROM ev WHERE event_id % 97 <> 0 AND event_id % 50 <> 7""",
    "device_info": """SELECT concat('dev-', c_custkey) AS uuid,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lower(c_mktsegment) END AS channel,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('edm', c_custkey % 5) END AS event,
  concat('', c_custkey) AS uid
FROM customer""",
    "auth_user": """SELECT concat('', c_custkey) AS id,
  concat('2024-01-', lpad(concat('', 1 + c_custkey % 30), 2, '0'), ' 08:00:00') AS date_joined
FROM customer""",
    "course_meta": """SELECT concat('course-', p_partkey) AS course_id,
  concat('', p_size % 3) AS course_type,
  p_brand AS owner,
  CASE WHEN p_partkey % 4 = 0 THEN '-1' ELSE '0' END AS status,
  CASE WHEN p_partkey % 11 = 0 THEN NULL
       ELSE concat('2024-0', 1 + p_partkey % 3, '-10 00:00:00') END AS "start",
  CASE WHEN p_partkey % 10 = 0 THEN NULL
       ELSE concat('2024-0', 1 + p_partkey % 3, '-25 00:00:00') END AS "end"
FROM part""",
    "course_state": """SELECT *,
  CASE WHEN course_type = '1' THEN CASE WHEN status = '-1' THEN 1 ELSE 0 END
       WHEN course_type = '0' THEN
         CASE WHEN status = '-1' OR "start" IS NULL OR "start" > '2024-02-15 00:00:00' THEN -1
              WHEN "end" < '2024-02-15 00:00:00' THEN 1 ELSE 0 END
       ELSE -1 END AS process
FROM course_meta""",
    "flagged": """SELECT *,
  substr(time, 1, 16) || ':00' AS time_minute_1_start,
  substr(time, 1, 16) || ':59' AS time_minute_1_end,
  CASE WHEN user_id = '' OR row_number() OVER (
         PARTITION BY user_id, substr(time, 1, 10) ORDER BY time, event_id) = 1
       THEN 0 ELSE 1 END AS user_id_daily_duplicate_flag,
  CASE WHEN user_id = '' OR row_number() OVER (
         PARTITION BY user_id, substr(time, 1, 16) ORDER BY time, event_id) = 1
       THEN 0 ELSE 1 END AS user_id_minutely_duplicate_flag
FROM tracking""",
    "with_device": """SELECT f.* REPLACE (
  CASE WHEN d.uuid IS NOT NULL THEN
         CASE WHEN f.origin_referer = '' THEN
                regexp_replace(coalesce(nullif(d.channel, ''), 'unknown'),
                               '^https?://(.*?)/.*$', '\\1')
              ELSE regexp_replace(f.origin_referer, '^https?://(.*?)/.*$', '\\1') END
       WHEN trim(f.origin_referer) = '' THEN 'unknown'
       ELSE regexp_replace(f.origin_referer, '^https?://(.*?)/.*$', '\\1') END AS origin_referer,
  CASE WHEN f.spam <> '' THEN f.spam
       WHEN d.uuid IS NOT NULL THEN coalesce(nullif(d.event, ''), 'unknown')
       ELSE 'unknown' END AS spam,
  CASE WHEN d.uuid IS NOT NULL
            AND NOT (regexp_full_match(f.user_id, '[+-]?[0-9]+') AND f.user_id <> '-1')
       THEN coalesce(nullif(d.uid, ''), f.user_id) ELSE f.user_id END AS user_id)
FROM flagged f LEFT JOIN device_info d
  ON f.uuid = d.uuid AND (f.origin_referer = '' OR f.spam = '')""",
    "enriched": """SELECT w.*, coalesce(u.date_joined, '') AS date_joined,
  CASE WHEN c.course_id IS NULL THEN '' ELSE c.course_type END AS course_type,
  CASE WHEN c.course_id IS NULL THEN '' ELSE c.owner END AS course_owner,
  CASE WHEN c.course_id IS NULL THEN '' ELSE c.status END AS course_status,
  CASE WHEN c.course_id IS NULL THEN '' ELSE c."start" END AS course_start,
  CASE WHEN c.course_id IS NULL THEN '' ELSE c."end" END AS course_end,
  CASE WHEN c.course_id IS NULL THEN '' ELSE CAST(c.process AS VARCHAR) END AS course_process,
  w.time_minute_1_start AS start_date, w.time_minute_1_end AS end_date
FROM with_device w
LEFT JOIN auth_user u ON w.user_id = u.id AND regexp_full_match(w.user_id, '[0-9]+')
LEFT JOIN course_state c ON w.course_id = c.course_id""",
}

# Which views each view reads, in definition order.
NEEDS = {
    "ev": [],
    "tracking": ["ev"],
    "device_info": [],
    "auth_user": [],
    "course_meta": [],
    "course_state": ["course_meta"],
    "flagged": ["tracking"],
    "with_device": ["flagged", "device_info"],
    "enriched": ["with_device", "auth_user", "course_state"],
}

CANONICAL = (
    "event_id, user_id, username, uuid, event_type, platform, origin_referer, spam, host, "
    "time, course_id"
)


def sql(body: str, *views: str) -> str:
    """``body`` preceded by the views it names and all they need."""
    wanted: set[str] = set()

    def visit(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for need in NEEDS[name]:
                visit(need)

    for view in views:
        visit(view)
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in wanted)
    return f"WITH {ctes}\n{body}" if ctes else body


def stat_sql(
    source: str,
    targets: list[tuple[str, str, list[str]]],
    dims: list[str],
    data_type: str,
    value_type: str,
    cycle: str = "minute_1",
    where: str = "TRUE",
    value: str = "count(user_id)",
    agg: str = "user_id:count",
) -> str:
    """Statistics as one plain GROUP BY per target, put together by UNION ALL.

    A target is (key, keyName, grouping columns).
    """
    parts = []
    for key, key_name, columns in targets:
        shown = ", ".join(
            f"{d} AS {d}" if d in columns else f"CAST(NULL AS VARCHAR) AS {d}" for d in dims
        )
        group = f"GROUP BY {', '.join(columns)}" if columns else ""
        parts.append(
            f"SELECT {shown + ', ' if shown else ''}CAST({value} AS BIGINT) AS \"value\", "
            f"'{key}' AS \"key\", '{key_name}' AS \"keyName\", '{data_type}' AS data_type, "
            f"'{value_type}' AS value_type, '{cycle}' AS \"cycle\", '{agg}' AS agg "
            f"FROM {source} WHERE {where} {group}"
        )
    return "\nUNION ALL\n".join(parts)
