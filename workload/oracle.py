"""The queries again, as SQL over the provided tables.

Timelines are computed here in another way than in the engine: every member gets a state for every
slot (or for every change point of its key), and states are folded by looking up ranks.
"""

from __future__ import annotations

import re

# Each entry is one common table expression; entries only use earlier ones.
CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def query(sql: str) -> str:
    """Prefix a statement with the expressions it uses, directly or not."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(CTES[name])
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    head = f"WITH {', '.join(parts)} " if parts else ""
    return head + sql.strip()


def variant(prefix: str, **changed: str) -> None:
    """The expressions once more with some of them changed: these, and all that use one of them, get
    names with a prefix, and mean one another."""
    done: set[str] = set()
    for name, sql in list(CTES.items()):
        text = changed.get(name, sql)
        if name in changed or done & set(re.findall(r"[a-z_0-9]+", text)):
            cte(prefix + name, re.sub(r"[a-z_0-9]+", lambda m: prefix + m[0] if m[0] in done else m[0], text))
            done.add(name)


def rounded(part: str, whole: str, scale: str = "1.0") -> str:
    return (f"coalesce(round(CASE WHEN {whole} <> 0 THEN {scale} * ({part})::DOUBLE / ({whole})::DOUBLE "
            f"END, 5), -1.0)")


# Ranks per state code (OK, WARNING, UNKNOWN, MISSING, CRITICAL, DOWNTIME) and back.
AND_RANK, AND_STATE = "[0,1,2,3,5,4]", "[0,1,2,3,5,4]"
OR_RANK, OR_STATE = "[5,4,2,1,3,0]", "[5,3,2,4,1,0]"
NAMES = "['OK','WARNING','UNKNOWN','MISSING','CRITICAL','DOWNTIME']"


def fold(op: str, code: str) -> str:
    return (f"CASE WHEN {op} = 'AND' THEN {AND_STATE}[max({AND_RANK}[{code} + 1]) + 1] "
            f"ELSE {OR_STATE}[max({OR_RANK}[{code} + 1]) + 1] END")


def name_of(code: str) -> str:
    return f"{NAMES}[{code} + 1]"


def stamp(date: str, sec: str) -> str:
    return (f"strftime({date}::TIMESTAMP + to_seconds(({sec})::BIGINT), '%Y-%m-%dT%H:%M:%SZ')")


def date_int(date: str) -> str:
    return f"CAST(strftime({date}, '%Y%m%d') AS INTEGER)"


def slot_of(sec: str) -> str:
    return (f"least(CAST(floor(floor(({sec}) / 60.0 + 0.5) / 5.0 + 0.5) AS INTEGER), 287)")


SEC = "(hour(t) * 3600 + minute(t) * 60 + second(t))"

cte("hosts", "SELECT *, CAST(floor(user_id / 3.0) AS BIGINT) AS h FROM events")
cte("md", """
    SELECT strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
           concat('svc-', h % 3) AS service, concat('host-', h) AS hostname,
           CASE WHEN event_type IN ('click', 'view') THEN 'm-web'
                WHEN event_type IN ('purchase', 'signup') THEN 'm-tx'
                WHEN event_id % 2 = 0 THEN 'm-web' ELSE 'm-tx' END AS metric,
           CASE WHEN event_type = 'error' AND value > 50 THEN 'CRITICAL'
                WHEN event_type = 'error' THEN 'WARNING'
                WHEN value < 3 THEN 'UNKNOWN' ELSE 'OK' END AS status,
           concat('mon-', event_id % 3) AS monitoring_host, event_type AS summary,
           props AS message, CAST(ts AS DATE) AS date, date_trunc('second', ts) AS t
    FROM hosts""")
cte("coded", f"SELECT *, CAST({SEC} AS INTEGER) AS sec, list_position({NAMES}, status) - 1 AS code FROM md")
cte("days", """
    SELECT CAST(unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 1 DAY))
                AS DATE) AS date FROM md""")
cte("span", "SELECT min(date) AS low, max(date) AS high FROM days")
cte("usr", "SELECT DISTINCT h FROM hosts")
cte("eg", """
    SELECT 'SITES' AS "type", concat('NATION_', h % 5) AS grp, concat('svc-', h % 3) AS service,
           concat('host-', h) AS hostname, CASE WHEN h % 11 = 0 THEN '0' ELSE '1' END AS production,
           CAST(NULL AS VARCHAR) AS monitored FROM usr
    UNION ALL
    SELECT 'SITES', concat('NATION_', 5 + h % 7), concat('svc-', h % 3), concat('host-', h),
           CASE WHEN h % 11 = 0 THEN '0' ELSE '1' END, NULL FROM usr WHERE h % 4 = 0
    UNION ALL
    SELECT 'PROJECT', concat('PROJ_', h % 2), concat('svc-', h % 3), concat('host-', h),
           CASE WHEN h % 11 = 0 THEN '0' ELSE '1' END, NULL FROM usr
    UNION ALL
    SELECT 'SITES', n_name, concat('svc-', s_suppkey % 4), concat('idle-', s_suppkey), NULL, '1'
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
cte("gg", """
    SELECT 'NGI' AS "type", r_name AS grp, n_name AS subgroup,
           CASE WHEN n_nationkey % 6 = 5 THEN 'Suspended' ELSE 'Certified' END AS certification
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
cte("mp", """
    SELECT * FROM (VALUES ('P1', 'svc-0', 'm-tx'), ('P1', 'svc-0', 'm-web'),
        ('P1', 'svc-1', 'm-tx'), ('P1', 'svc-1', 'm-web'), ('P1', 'svc-2', 'm-tx'),
        ('P1', 'svc-2', 'm-web'), ('P1', 'svc-3', 'm-tx'), ('P1', 'svc-3', 'm-web'),
        ('P2', 'svc-0', 'm-web'), ('P2', 'svc-1', 'm-web'), ('P2', 'svc-2', 'm-web'),
        ('P2', 'svc-3', 'm-web')) AS v(profile, service, metric)""")
cte("ap", """
    SELECT * FROM (VALUES
        ('R1', 'P1', 'svc-0', 'OR', 'compute', 'OR', 'AND', 'AND'),
        ('R1', 'P1', 'svc-1', 'OR', 'compute', 'OR', 'AND', 'AND'),
        ('R1', 'P1', 'svc-2', 'OR', 'storage', 'OR', 'AND', 'AND'),
        ('R2', 'P2', 'svc-0', 'AND', 'front', 'AND', 'OR', 'OR'),
        ('R2', 'P2', 'svc-2', 'OR', 'front', 'AND', 'OR', 'OR'),
        ('R2', 'P2', 'svc-1', 'AND', 'back', 'OR', 'OR', 'OR'))
        AS v(report, mprofile, service, svc_op, ag, group_op, total_op, metric_op)""")
cte("reps", "SELECT DISTINCT report, mprofile, total_op, metric_op FROM ap")
cte("down", """
    SELECT concat('host-', o_custkey) AS hostname, concat('svc-', o_custkey % 3) AS service,
           low::TIMESTAMP + to_seconds(o_orderkey % 30 * 86400 + o_orderkey % 23 * 3600
                                       + o_orderkey % 50 * 60) AS s,
           s + to_hours(CASE WHEN o_orderkey % 10 = 0 THEN 30 ELSE 1 + o_orderkey % 7 END) AS e
    FROM orders, span""")
cte("wt", """
    SELECT n_name AS site, CAST(floor(sum(CAST(s_acctbal AS DECIMAL(20,2)))) AS INTEGER) AS weight
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
cte("req", """
    SELECT concat('req-', s_suppkey) AS id, CASE WHEN s_suppkey % 3 = 2 THEN 'R2' ELSE 'R1' END AS report,
           CAST(low + CAST(s_suppkey % 30 AS INTEGER) AS DATE) AS d0,
           CAST(low + CAST(s_suppkey % 30 + s_suppkey % 3 AS INTEGER) AS DATE) AS d1,
           concat('NATION_', s_suppkey % 7) AS excluded, concat('mon-', s_suppkey % 5) AS host,
           CASE s_suppkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' ELSE 'done' END AS status,
           concat('2024-02-01 00:', lpad(CAST(s_suppkey % 60 AS VARCHAR), 2, '0'), ':00') AS "timestamp"
    FROM supplier, span""")
cte("gexcl", """
    SELECT report, excluded AS grp, d0::TIMESTAMP + INTERVAL 6 HOUR AS s,
           d1::TIMESTAMP + INTERVAL 8 HOUR AS e FROM req""")
cte("mexcl", """
    SELECT report, host, d0::TIMESTAMP AS s, d0::TIMESTAMP + INTERVAL 3 HOUR AS e, d0, d1 FROM req""")
cte("checks", "SELECT report, mp.service, metric FROM reps JOIN mp ON mprofile = profile")
cte("place", "SELECT DISTINCT report, service, hostname, grp FROM eg, reps WHERE eg.type = 'SITES'")
cte("sel", """
    SELECT DISTINCT report, service, hostname FROM eg, reps WHERE eg.type = 'SITES'
      AND (report = 'R2' OR coalesce(production, '1') = '1')
      AND EXISTS (SELECT 1 FROM gg WHERE subgroup = eg.grp
                  AND (report = 'R2' OR certification = 'Certified'))""")
cte("picked", """
    SELECT sel.report, days.date, c.service, c.hostname, c.metric, c.date AS row_date, c.sec, c.code,
           c.status, c.monitoring_host, c.summary, c.message, c.t
    FROM coded c
    JOIN checks ON checks.service = c.service AND checks.metric = c.metric
    JOIN ap ON ap.report = checks.report AND ap.service = c.service
    JOIN sel ON sel.report = checks.report AND sel.service = c.service AND sel.hostname = c.hostname
    JOIN days ON days.date = c.date OR days.date = c.date + 1
    WHERE NOT EXISTS (SELECT 1 FROM mexcl x WHERE x.report = sel.report AND x.host = c.monitoring_host
                      AND c.t BETWEEN x.s AND x.e AND days.date BETWEEN x.d0 AND x.d1)""")
cte("members", """
    SELECT DISTINCT p.report, days.date, p.service, p.hostname, checks.metric
    FROM place p JOIN checks ON checks.report = p.report AND checks.service = p.service, days""")
cte("carry", """
    SELECT report, date, service, hostname, metric, arg_max(code, sec * 10 + code) AS code
    FROM picked WHERE row_date < date GROUP BY ALL""")
cte("effects", f"""
    SELECT report, date, service, hostname, metric, {slot_of('sec')} - 1 AS i,
           arg_max(code, sec * 10 + code) AS code
    FROM picked WHERE row_date = date AND {slot_of('sec')} > 0
    GROUP BY report, date, service, hostname, metric, {slot_of('sec')}""")
cte("metric_slots", """
    SELECT m.report, m.date, m.service, m.hostname, m.metric, r.i,
           coalesce(last_value(f.code IGNORE NULLS) OVER w, c.code, 3) AS code
    FROM members m CROSS JOIN range(288) r(i)
    LEFT JOIN effects f ON f.report = m.report AND f.date = m.date AND f.service = m.service
         AND f.hostname = m.hostname AND f.metric = m.metric AND f.i = r.i
    LEFT JOIN carry c ON c.report = m.report AND c.date = m.date AND c.service = m.service
         AND c.hostname = m.hostname AND c.metric = m.metric
    WINDOW w AS (PARTITION BY m.report, m.date, m.service, m.hostname, m.metric ORDER BY r.i
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
DAY_CUT = f"""
           CASE WHEN CAST(s AS DATE) < days.date THEN 0 ELSE {slot_of("hour(s) * 3600 + minute(s) * 60 + second(s)")} END AS i0,
           CASE WHEN CAST(e AS DATE) > days.date THEN 287 ELSE {slot_of("hour(e) * 3600 + minute(e) * 60 + second(e)")} END AS i1"""
cte("down_days", f"""
    SELECT days.date, service, hostname, s, e, {DAY_CUT}
    FROM down JOIN days ON days.date BETWEEN CAST(s AS DATE) AND CAST(e AS DATE)""")
cte("first_down", """
    SELECT date, service, hostname, i0, i1 FROM down_days
    QUALIFY row_number() OVER (PARTITION BY date, service, hostname ORDER BY s, e) = 1""")
cte("excl_days", f"""
    SELECT report, days.date, grp, {DAY_CUT}
    FROM gexcl JOIN days ON days.date BETWEEN CAST(s AS DATE) AND CAST(e AS DATE)""")
cte("endpoint_fold", f"""
    SELECT m.report, date, service, hostname, i, {fold('any_value(metric_op)', 'code')} AS code
    FROM metric_slots m JOIN reps ON reps.report = m.report
    GROUP BY m.report, date, service, hostname, i""")
cte("endpoint_slots", """
    SELECT f.report, f.date, f.service, f.hostname, f.i,
           CASE WHEN d.date IS NOT NULL AND f.i BETWEEN d.i0 AND d.i1 THEN 5 ELSE f.code END AS code
    FROM endpoint_fold f LEFT JOIN first_down d
      ON d.date = f.date AND d.service = f.service AND d.hostname = f.hostname""")
cte("service_slots", f"""
    SELECT f.report, f.date, grp, f.service, i, {fold('any_value(svc_op)', 'code')} AS code
    FROM endpoint_slots f
    JOIN place p ON p.report = f.report AND p.service = f.service AND p.hostname = f.hostname
    JOIN ap ON ap.report = f.report AND ap.service = f.service
    GROUP BY f.report, f.date, grp, f.service, i""")
cte("ag_slots", f"""
    SELECT s.report, date, grp, ag, i, {fold('any_value(group_op)', 'code')} AS code
    FROM service_slots s JOIN ap ON ap.report = s.report AND ap.service = s.service
    GROUP BY s.report, date, grp, ag, i""")
cte("total_slots", f"""
    SELECT a.report, date, grp, i, {fold('any_value(total_op)', 'code')} AS code
    FROM ag_slots a JOIN reps ON reps.report = a.report GROUP BY a.report, date, grp, i""")
cte("group_slots", """
    SELECT report, date, grp, i,
           CASE WHEN EXISTS (SELECT 1 FROM excl_days x WHERE x.report = t.report AND x.date = t.date
                             AND x.grp = t.grp AND t.i BETWEEN x.i0 AND x.i1)
                THEN 2 ELSE code END AS code
    FROM total_slots t""")


def rates(source: str, keys: str) -> str:
    return f"""
    SELECT {keys}, count(*) FILTER (code IN (0, 1)) AS n_up, count(*) FILTER (code IN (2, 3)) AS n_unk,
           count(*) FILTER (code = 5) AS n_down, count(*) AS n, n - n_unk AS n_known,
           n - n_unk - n_down AS n_rel,
           {rounded('n_up', 'n_known', '100.0')} AS availability,
           {rounded('n_up', 'n_rel', '100.0')} AS reliability,
           {rounded('n_up', 'n')} AS up, {rounded('n_unk', 'n')} AS unknown,
           {rounded('n_down', 'n')} AS down
    FROM {source} GROUP BY {keys}"""


cte("service_rates", rates("service_slots", "report, date, grp, service"))
cte("group_rates", rates("group_slots", "report, date, grp"))


def runs(source: str, keys: str) -> str:
    """Intervals of equal state in dense slots."""
    return f"""
    SELECT {keys}, CAST(min(i) AS INTEGER) AS slot_from, CAST(max(i) AS INTEGER) AS slot_to,
           {name_of('any_value(code)')} AS status
    FROM (SELECT *, i - row_number() OVER (PARTITION BY {keys}, code ORDER BY i) AS run FROM {source})
    GROUP BY {keys}, code, run"""


# -- status changes --------------------------------------------------------------------------------

KEYS = "report, date, service, hostname, metric"
cte("per_second", f"""
    SELECT {KEYS}, row_date, sec, code, status, monitoring_host, summary, message FROM picked
    QUALIFY row_number() OVER (PARTITION BY {KEYS}, row_date, sec
        ORDER BY code DESC, status DESC, monitoring_host DESC, summary DESC, message DESC) = 1""")
cte("timely", f"""
    SELECT * FROM per_second WHERE row_date = date
    UNION ALL
    SELECT * FROM (SELECT * FROM per_second WHERE row_date < date
                   QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY sec DESC) = 1)""")
cte("absent", f"""
    SELECT {KEYS} FROM members EXCEPT SELECT {KEYS} FROM timely""")
cte("detail", f"""
    SELECT {KEYS}, sec, code, status, summary, message, previous_code, previous_state,
           previous_timestamp
    FROM (SELECT *, coalesce(lag(status) OVER w, 'MISSING') AS previous_state,
                 coalesce(lag(code) OVER w, 3) AS previous_code,
                 coalesce(lag({stamp('row_date', 'sec')}) OVER w, {stamp('date', '0')}) AS previous_timestamp
          FROM timely WINDOW w AS (PARTITION BY {KEYS} ORDER BY row_date, sec))
    WHERE row_date = date
    UNION ALL
    SELECT {KEYS}, 0, 3, 'MISSING', 'missing', 'missing', 3, 'MISSING', {stamp('date', '0')} FROM absent""")
cte("status_rows", f"""
    SELECT d.report, grp AS endpoint_group, d.service, d.hostname AS host, metric,
           {stamp('date', 'sec')} AS "timestamp", status, summary, message, previous_state,
           previous_timestamp, {date_int('date')} AS date_integer,
           CAST(sec // 3600 * 10000 + sec % 3600 // 60 * 100 + sec % 60 AS INTEGER) AS time_integer
    FROM detail d JOIN place p
      ON p.report = d.report AND p.service = d.service AND p.hostname = d.hostname""")
cte("metric_points", f"""
    SELECT {KEYS}, CASE WHEN rn = 1 THEN 0 ELSE sec END AS pos,
           CASE WHEN rn = 1 THEN previous_code ELSE code END AS code
    FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY sec) AS rn FROM detail)
    UNION ALL
    SELECT {KEYS}, 0, 3 FROM members m
    WHERE EXISTS (SELECT 1 FROM detail d WHERE d.report = m.report AND d.date = m.date
                  AND d.service = m.service AND d.hostname = m.hostname)
      AND NOT EXISTS (SELECT 1 FROM detail d WHERE d.report = m.report AND d.date = m.date
                  AND d.service = m.service AND d.hostname = m.hostname AND d.metric = m.metric)""")


def points_fold(source: str, keys: str, member: str, op: str) -> str:
    """States of all members at all change points of a key, folded, repeats removed."""
    k = [x.strip() for x in keys.split(",")]
    same = lambda a, b: " AND ".join(f"{a}.{x} = {b}.{x}" for x in k)
    listed = lambda a: ", ".join(f"{a}.{x}" for x in k)
    return f"""
    SELECT {keys}, pos, code FROM (
      SELECT *, lag(code) OVER (PARTITION BY {keys} ORDER BY pos) AS before FROM (
        SELECT {keys}, pos, {fold('any_value(op)', 'code')} AS code FROM (
          SELECT {listed('p')}, p.pos, s.code, s.op FROM
            (SELECT {listed('a')}, b.{member}, a.pos
             FROM (SELECT DISTINCT {keys}, pos FROM {source}) a
             JOIN (SELECT DISTINCT {keys}, {member} FROM {source}) b ON {same('a', 'b')}) p
          ASOF JOIN (SELECT {keys}, {member}, pos, code, {op} AS op FROM {source}) s
            ON {same('p', 's')} AND p.{member} = s.{member} AND p.pos >= s.pos)
        GROUP BY {keys}, pos))
    WHERE before IS DISTINCT FROM code"""


cte("metric_moves", "SELECT m.*, metric_op FROM metric_points m JOIN reps ON reps.report = m.report")
cte("endpoint_points", points_fold("metric_moves", "report, date, service, hostname", "metric", "metric_op"))
cte("host_moves", """
    SELECT e.report, e.date, grp, e.service, e.hostname, pos, code, svc_op FROM endpoint_points e
    JOIN place p ON p.report = e.report AND p.service = e.service AND p.hostname = e.hostname
    JOIN ap ON ap.report = e.report AND ap.service = e.service""")
cte("service_points", points_fold("host_moves", "report, date, grp, service", "hostname", "svc_op"))
cte("service_moves", """
    SELECT s.*, ag, group_op FROM service_points s
    JOIN ap ON ap.report = s.report AND ap.service = s.service""")
cte("ag_points", points_fold("service_moves", "report, date, grp, ag", "service", "group_op"))
cte("ag_moves", "SELECT a.*, total_op FROM ag_points a JOIN reps ON reps.report = a.report")
cte("group_points", points_fold("ag_moves", "report, date, grp", "ag", "total_op"))
