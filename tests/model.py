"""A plain, slow model of the rules, for small fixtures."""

from __future__ import annotations

from functools import reduce

DAY = 86400


def second(ts):
    h, m, s = int(ts[11:13]), int(ts[14:16]), int(ts[17:19])
    return (h * 3600 + m * 60 + s) % DAY


def slot(ts, interval=5, n=288):
    minute = int(second(ts) / 60 + 0.5)
    return min(int(minute / interval + 0.5), n - 1)


def settled(changes, start, n=288, interval=5):
    """changes: (ts, code) in order of time; array of n codes."""
    per_slot = {}
    for ts, code in changes:
        per_slot[slot(ts, interval, n)] = code
    samples = [start] * n
    for s in sorted(per_slot):
        if s > 0:
            for i in range(s - 1, n):
                samples[i] = per_slot[s]
    return samples


def fold_arrays(ops, op, members):
    """members: {name: array}; folded in ascending name."""
    ordered = [members[name] for name in sorted(members)]
    return [reduce(lambda a, b: ops.combine(op, a, b), column) for column in zip(*ordered)]


def fold_lists(ops, op, members):
    """members: {name: [(pos, code)]}, all starting at 0; compacted change list."""
    points = sorted({p for changes in members.values() for p, _ in changes})
    out = []
    for p in points:
        states = [max(c for c in members[name] if c[0] <= p)[1] for name in sorted(members)]
        code = reduce(lambda a, b: ops.combine(op, a, b), states)
        if not out or out[-1][1] != code:
            out.append((p, code))
    return out


def cover(samples, start_ts, end_ts, day, code, n=288):
    first = 0 if start_ts[:10] < day else slot(start_ts)
    last = n - 1 if end_ts[:10] > day else slot(end_ts)
    if start_ts[:10] <= day <= end_ts[:10]:
        for i in range(first, last + 1):
            samples[i] = code
    return samples


def rates(samples, ops):
    n = len(samples)
    count = lambda *names: sum(samples.count(ops.code(x)) for x in names)
    up, unknown, down = count("OK", "WARNING"), count("MISSING", "UNKNOWN"), count("DOWNTIME")
    part = lambda a, b, k: round(k * a / b, 5) if b else -1.0
    return (part(up, n - unknown, 100.0), part(up, n - unknown - down, 100.0), part(up, n, 1.0),
            part(unknown, n, 1.0), part(down, n, 1.0))


class Day:
    """All tables of one report and day as Python values."""

    def __init__(self, ops, profile, metrics, topology, rows, before, downtimes, exclusions, day):
        self.__dict__.update(ops=ops, profile=profile, metrics=metrics, topology=topology, rows=rows,
                             before=before, downtimes=downtimes, exclusions=exclusions, day=day)
        self.svc = {s: (op, group, gop) for s, op, group, gop, _, _ in profile.rows()}
        # Rows of services outside the availability profile do not count.
        self.rows = {k: v for k, v in rows.items() if k[0] in self.svc}
        self.before = {k: v for k, v in before.items() if k[0] in self.svc}

    def endpoints(self):
        out = {}
        for service, host in sorted({(s, h) for s, h, _ in self.topology}):
            members = {}
            for metric in self.metrics.get(service, []):
                key = (service, host, metric)
                past = self.before.get(key, [])
                start = past[-1][1] if past else self.ops.missing_code
                members[metric] = settled(self.rows.get(key, []), start)
            if members:
                samples = fold_arrays(self.ops, self.profile.metric_op, members)
                if (service, host) in self.downtimes:
                    cover(samples, *min(self.downtimes[service, host]), self.day, self.ops.down_code)
                out[service, host] = samples
        return out

    def services(self, endpoints):
        members = {}
        for service, host, group in self.topology:
            if service in self.svc and (service, host) in endpoints:
                members.setdefault((group, service), {})[host] = endpoints[service, host]
        return {k: fold_arrays(self.ops, self.svc[k[1]][0], m) for k, m in members.items()}

    def groups(self, services, combine=fold_arrays):
        parts = {}
        for (group, service), samples in services.items():
            _, ag, gop = self.svc[service]
            parts.setdefault(group, {}).setdefault((ag, gop), {})[service] = samples
        out = {}
        for group, ags in parts.items():
            folded = {ag: combine(self.ops, gop, m) for (ag, gop), m in ags.items()}
            out[group] = combine(self.ops, self.profile.total_op, folded)
        return out

    def excluded(self, groups):
        for group, samples in groups.items():
            for start, end in self.exclusions.get(group, []):
                cover(samples, start, end, self.day, self.ops.unknown_code)
        return groups

    def status_endpoints(self):
        out = {}
        for service, host in sorted({(s, h) for s, h, _ in self.topology}):
            lists, reports = {}, False
            for metric in self.metrics.get(service, []):
                key = (service, host, metric)
                past, rows = self.before.get(key, []), self.rows.get(key, [])
                previous = past[-1][1] if past else self.ops.missing_code
                points = [(0, previous)] if rows else [(0, self.ops.missing_code)]
                points += [(second(ts), code) for ts, code in rows[1:]]
                reports = reports or bool(rows) or not past
                lists[metric] = points
            if lists and reports:
                out[service, host] = fold_lists(self.ops, self.profile.metric_op, lists)
        return out

    def status_services(self, endpoints):
        members = {}
        for service, host, group in self.topology:
            if service in self.svc and (service, host) in endpoints:
                members.setdefault((group, service), {})[host] = endpoints[service, host]
        return {k: fold_lists(self.ops, self.svc[k[1]][0], m) for k, m in members.items()}
