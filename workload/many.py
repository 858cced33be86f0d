"""Many reports of one tenant in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from uptrail.config import ReportConfig, ReportInputs
from uptrail.plans import availability as ar, status as st
from uptrail.sources.defaults import grid_operations
from workload import oracle as o
from workload.core import RATES
from workload.queries import OPERATIONS, OPTIONS, register
from workload.tables import PROFILE_1, PROFILE_2, REPORT_1, REPORT_2, Tables

#: id, number of the profile, grouping type, wanted tags of endpoints and of groups.
SETTINGS = [
    ("R1", 1, "SITES", REPORT_1.egroup_tags, REPORT_1.ggroup_tags),
    ("R2", 2, "SITES", REPORT_2.egroup_tags, REPORT_2.ggroup_tags),
    ("M1", 1, "SITES", {"production": "N"}, {}),
    ("M2", 2, "SITES", {"production": "y", "monitored": "N"}, {"certification": "CERTIFIED"}),
    ("M3", 1, "SITES", {"colour": "red"}, {"certification": "suspended"}),
    ("M4", 2, "PROJECT", {}, {}),
    ("M5", 2, "SITES", {"monitored": "Y"}, {"certification": "certified", "tier": "1"}),
    ("M6", 1, "SITES", {"production": "1"}, {}),
]


def many_reports(t: Tables) -> list[ReportInputs]:
    return [t.report(ReportConfig(name, "demo", name, egroup, "NGI", "hepspec", egroup_tags=endpoint_tags, ggroup_tags=group_tags),
                     (PROFILE_1, PROFILE_2)[profile - 1]) for name, profile, egroup, endpoint_tags, group_tags in SETTINGS]


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def _stored(tags: dict[str, str], key: str) -> str | None:
    """A wanted answer as the tags of endpoints store it."""
    return {"y": "1", "n": "0"}.get(tags[key].lower(), tags[key].lower()) if key in tags else None


o.cte("sets", "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', '{egroup}', {_text(_stored(e, 'production'))}, {_text(_stored(e, 'monitored'))}, {_text(g.get('certification', '').lower() or None)})"
    for name, _, egroup, e, g in SETTINGS) + ") AS v(report, egroup, want_production, want_monitored, want_certification)")
o.variant("many_", **{
    "ap": "SELECT * FROM (VALUES " + ", ".join(
        f"('{name}', 'P{profile}', '{service}', '{svc_op}', '{ag}', '{group_op}', '{total_op}', '{metric_op}')"
        for name, profile, *_ in SETTINGS
        for service, svc_op, ag, group_op, total_op, metric_op in (PROFILE_1, PROFILE_2)[profile - 1].rows())
        + ") AS v(report, mprofile, service, svc_op, ag, group_op, total_op, metric_op)",
    "place": "SELECT DISTINCT report, service, hostname, grp FROM eg JOIN sets ON eg.type = egroup",
    "sel": """
        SELECT DISTINCT report, service, hostname FROM eg JOIN sets ON eg.type = egroup
        WHERE coalesce(production, want_production) IS NOT DISTINCT FROM coalesce(want_production, production)
          AND coalesce(monitored, want_monitored) IS NOT DISTINCT FROM coalesce(want_monitored, monitored)
          AND EXISTS (SELECT 1 FROM gg WHERE subgroup = eg.grp
                      AND (want_certification IS NULL OR lower(certification) = want_certification))"""})


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM many_service_rates""")
def service_ar_many_reports(t: Tables) -> DataFrame:
    return ar.availability(t.spark, t.metric_data(), many_reports(t), OPERATIONS, *t.days, OPTIONS).service_ar()


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, r.grp AS name, gg.grp AS supergroup,
                     coalesce(weight, 0) AS weight, {RATES}
              FROM many_group_rates r LEFT JOIN gg ON gg.subgroup = r.grp LEFT JOIN wt ON wt.site = r.grp""")
def group_ar_many_reports(t: Tables) -> DataFrame:
    return ar.availability(t.spark, t.metric_data(), many_reports(t), OPERATIONS, *t.days, OPTIONS).group_ar()


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM many_group_points""")
def status_groups_many_reports(t: Tables) -> DataFrame:
    return st.status(t.spark, t.metric_data(), many_reports(t), OPERATIONS, *t.days, OPTIONS).status_groups()


# -- a truth table whose result depends on the order of members -----------------------------------

GRID = grid_operations()
GRID_OR = "[" + ",".join(str(x) for row in GRID.tables["OR"] for x in row) + "]"


def ordered_fold(op: str, code: str, member: str) -> str:
    """AND is a maximum of codes; OR combines members in ascending name."""
    return (f"CASE WHEN {op} = 'AND' THEN max({code}) ELSE list_reduce(list({code}::INT ORDER BY {member}), "
            f"lambda a, b: {GRID_OR}[a * 6 + b + 1]) END")


def _ordered(name: str, op: str, member: str) -> tuple[str, str]:
    sql = o.CTES[name].replace(o.fold(f"any_value({op})", "code"), ordered_fold(f"any_value({op})", "code", member))
    return name, sql.replace("p.pos, s.code, s.op FROM", f"p.pos, s.code, s.op, s.{member} FROM")


o.variant("cyclic_", **dict([
    _ordered("endpoint_fold", "metric_op", "metric"), _ordered("service_slots", "svc_op", "f.hostname"),
    _ordered("ag_slots", "group_op", "s.service"), _ordered("total_slots", "total_op", "ag"),
    _ordered("endpoint_points", "op", "metric"), _ordered("service_points", "op", "hostname"),
    _ordered("ag_points", "op", "service"), _ordered("group_points", "op", "ag")]))


@register(f"""SELECT report, {o.date_int('date')} AS date, service AS name, grp AS supergroup, {RATES}
              FROM cyclic_service_rates""")
def service_ar_cyclic(t: Tables) -> DataFrame:
    return ar.availability(t.spark, t.metric_data(), t.reports(), GRID, *t.days, OPTIONS).service_ar()


@register(f"""SELECT r.report, {o.date_int('r.date')} AS date, r.grp AS name, gg.grp AS supergroup,
                     coalesce(weight, 0) AS weight, {RATES}
              FROM cyclic_group_rates r LEFT JOIN gg ON gg.subgroup = r.grp LEFT JOIN wt ON wt.site = r.grp""")
def group_ar_cyclic(t: Tables) -> DataFrame:
    return ar.availability(t.spark, t.metric_data(), t.reports(), GRID, *t.days, OPTIONS).group_ar()


@register(f"""SELECT report, {o.date_int('date')} AS date_integer, grp AS endpoint_group,
                     {o.stamp('date', 'pos')} AS "timestamp", {o.name_of('code')} AS status
              FROM cyclic_group_points""")
def status_groups_cyclic(t: Tables) -> DataFrame:
    return st.status(t.spark, t.metric_data(), t.reports(), GRID, *t.days, OPTIONS).status_groups()
