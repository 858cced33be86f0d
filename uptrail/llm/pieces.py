"""Sampled SentencePiece segmentations: Gumbel top-k without replacement, and decoding.

A text's segmentations are the paths through the lattice of its pieces; a path's probability is the
softmax of the summed scores times alpha. Each path gets its log probability plus Gumbel noise, and
the k largest are a sample without replacement. They are found best first: the search keeps sets of
paths, each with the exact maximum of its perturbed values, drawn top down from the set's mass. It
takes the set with the largest maximum, draws the path that attains it, and splits the rest of the
set by the place where other paths leave that one. Nothing is enumerated.

The lattice falls apart wherever no piece of the vocabulary holds the two neighbouring bytes, so
the parts of a text are looked up in a store of lattices that were built once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uptrail.llm.common import Rolling, bounded_batches, mix, slices

# Fixed values of the model format.
MARK = "▁"
NORMAL, USER, BYTE = 1, 4, 6
ROLL = Rolling(7)
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
MASK = (1 << 64) - 1
#: Edges of lattices that a Python worker keeps before it starts afresh.
MEMORY = 3_000_000


@dataclass(frozen=True)
class Sampling:
    """k: segmentations of a text. alpha: what scores are multiplied with; 0 makes all alike likely."""
    k: int = 2
    alpha: float = 0.001
    seed: int = 0


def uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1), from 64-bit values."""
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def stream(salts: np.ndarray, tag: int) -> np.ndarray:
    """A start of random numbers of its own for each purpose."""
    return mix(salts + np.uint64(int(C) * (tag + 1) & MASK))


WALK, SETS, FORK, TOP = range(4)


def truncated(mass: np.ndarray, top, u: np.ndarray) -> np.ndarray:
    """Gumbel values at these log masses, given that they are below top."""
    return mass - np.log(np.exp(mass - top) - np.log(u))  # an empty set, of mass -inf, has -inf


class Vocabulary:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        self.prefix = b" " if spec.add_dummy_prefix else b""
        self.text: list[bytes] = []
        self.byte = np.zeros(256, np.int32)
        known = {}
        for i, p in enumerate(model.pieces):
            raw = p.piece.replace(MARK, " ").encode()
            if p.type == BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
                raw = bytes([int(p.piece[3:5], 16)])
            elif p.type in (NORMAL, USER) and raw:
                known[raw] = (i, p.score if p.type == NORMAL else 0.0)
            else:
                raw = b""
            self.text.append(raw)
        self.unknown = min(s for _, s in known.values()) - 10.0
        prefixes = {k[:n] for k in known for n in range(1, len(k) + 1)}
        longer = {k[:-1] for k in prefixes}
        order = sorted(prefixes)
        ends = np.cumsum([len(k) for k in order])
        codes = ROLL.of(ROLL.sums(np.frombuffer(b"".join(order), np.uint8)), ends - [len(k) for k in order], ends)
        spot = np.argsort(codes)
        self.codes = codes[spot]
        self.piece = np.array([known.get(k, (-1, 0))[0] for k in order], np.int32)[spot]
        self.score = np.array([known.get(k, (-1, 0.0))[1] for k in order])[spot]
        self.longer = np.array([k in longer for k in order])[spot]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(codes >> np.uint64(42)).astype(np.int64)] = True
        self.joined = np.zeros((256, 256), bool)
        for k in known:
            raw = np.frombuffer(k, np.uint8)
            self.joined[raw[:-1], raw[1:]] = True

    def decode(self, ids: list[int]) -> str:
        raw = b"".join([self.text[i] for i in ids])
        return raw.removeprefix(self.prefix).decode(errors="replace")


class Lattices:
    """Lattices of parts of texts. Nodes are places in a part; the edges of a node are its pieces, long
    ones first. share: the summed probability of a node's edges up to this one; rest: the log
    probability of its other edges."""

    def __init__(self, vocabulary: Vocabulary, alpha: float):
        self.v, self.alpha = vocabulary, alpha
        self.chars: dict[bytes, int] = {}
        self.char_ids: list[np.ndarray] = []
        self.reset()

    def reset(self) -> None:
        self.hashes, self.roots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.nodes = 0
        self.first = np.zeros(1, np.int32)  # of each node, its first edge
        self.share, self.rest, self.logp = np.zeros(0, np.float32), np.zeros(0, np.float32), np.zeros(0)
        self.tail, self.target, self.kind = (np.zeros(0, np.int32) for _ in range(3))

    def roots_of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first node of each part."""
        keys = ROLL.of(ROLL.sums(data), start, end) ^ (end - start).astype(np.uint64)
        kinds, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.logp) > MEMORY:
            self.reset()
        spot = np.searchsorted(self.hashes, kinds)
        inside = spot < len(self.hashes)
        inside[inside] = self.hashes[spot[inside]] == kinds[inside]
        new = np.flatnonzero(~inside)
        if len(new):
            roots = self.build(data, start[first[new]], end[first[new]])
            spot = np.searchsorted(self.hashes, kinds[new])
            self.hashes, self.roots = np.insert(self.hashes, spot, kinds[new]), np.insert(self.roots, spot, roots)
        return self.roots[np.searchsorted(self.hashes, kinds)][which]

    def build(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        heads = np.cumsum(size + 1) - size - 1
        part = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(part)) - (np.cumsum(size) - size)[part]
        text = data[start[part] + place]
        node = heads[part] + place
        left = size[part] - place
        sums = ROLL.sums(text)
        lead = (text & 0xC0) != 0x80
        width = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        held = np.zeros(len(text), bool)
        origin, head, piece, score = [], [], [], []
        at, n, v = np.flatnonzero(lead), 1, self.v
        while len(at):
            code = ROLL.of(sums, at, at + n)
            at_ = v.seen[(code >> np.uint64(42)).astype(np.int64)]
            at, code = at[at_], code[at_]
            spot = np.minimum(np.searchsorted(v.codes, code), len(v.codes) - 1)
            same = v.codes[spot] == code
            at, spot = at[same], spot[same]
            whole = v.piece[spot] >= 0
            found = at[whole]
            held[found[width[found] == n]] = True
            origin.append(found)
            head.append(node[found] + n)
            piece.append(v.piece[spot[whole]])
            score.append(v.score[spot[whole]])
            at = at[v.longer[spot]]
            n += 1
            at = at[left[at] >= n]
        # characters without a piece of their own: their bytes
        bare = np.flatnonzero(lead & ~held)
        kinds = []
        for i in bare.tolist():
            raw = text[i:i + int(min(width[i], left[i]))].tobytes()
            if raw not in self.chars:
                self.chars[raw] = len(v.text) + len(self.char_ids)
                self.char_ids.append(v.byte[np.frombuffer(raw, np.uint8)])
            kinds.append(self.chars[raw])
        origin = np.concatenate([*origin, bare])
        tail, away = node[origin], left[origin]
        head = np.concatenate([*head, node[bare] + np.minimum(width, left)[bare]])
        piece = np.concatenate([*piece, np.array(kinds, np.int32)]).astype(np.int32)
        score = np.concatenate([*score, v.unknown * np.minimum(width, left)[bare]]) * self.alpha
        order = np.argsort(tail[::-1], kind="stable")  # of a node, long pieces first
        order = len(tail) - 1 - order
        tail, away, head, piece, score = tail[order], away[order], head[order], piece[order], score[order]
        # masses of what follows a node, from the ends of all parts backwards
        total = int(size.sum() + len(size))
        mass = np.full(total, -np.inf)
        mass[heads + size] = 0.0
        away = away.astype(np.uint16 if away.max(initial=0) < 1 << 16 else np.int64)  # small numbers sort fast
        turn = np.argsort(away, kind="stable")
        cuts = np.searchsorted(away[turn], np.arange(1, int(away.max(initial=0)) + 2))
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                e = turn[a:b]
                new = np.flatnonzero(np.concatenate([[True], tail[e][1:] != tail[e][:-1]]))
                mass[tail[e[new]]] = np.logaddexp.reduceat(score[e] + mass[head[e]], new)
        logp = score + mass[head] - mass[tail]
        counts = np.bincount(tail, minlength=total)
        new = np.cumsum(counts) - counts
        run = np.concatenate([[0], np.cumsum(np.exp(logp))])
        share = run[1:] - run[new[tail]]
        share[(new + counts - 1)[counts > 0]] = 2.0  # the last edge takes what is left
        # of an edge above one half summed over the others, so that next to nothing is not nothing
        large = logp > np.log(0.5)
        rest = np.log1p(-np.exp(np.where(large, -1.0, logp)))
        if len(tail):
            others = np.logaddexp.reduceat(np.where(large, -np.inf, logp), new[counts > 0])
            rest[large] = others[(np.cumsum(counts > 0) - 1)[tail[large]]]
        base = self.nodes
        self.first = np.concatenate([self.first, (self.first[-1] + np.cumsum(counts)).astype(np.int32)])
        self.share, self.rest = np.append(self.share, share.astype(np.float32)), np.append(self.rest, rest.astype(np.float32))
        self.logp, self.kind = np.append(self.logp, logp), np.append(self.kind, piece)
        self.target = np.append(self.target, (base + head).astype(np.int32))
        self.tail = np.append(self.tail, (base + tail).astype(np.int32))
        self.nodes += total
        return base + heads

    def walk(self, node: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A random path from each node to the end of its part: all edges, path by path, and their number."""
        count = np.zeros(len(node), np.int64)
        live, at, taken, whose, step = np.arange(len(node)), node.astype(np.int32), [], [], 0
        edge = self.first[at]
        while True:
            more = edge < self.first[at + 1]
            if not more.all():
                live, at, edge = live[more], at[more], edge[more]
            if not len(live):
                break
            u = uniform(salt[live] + np.uint64(int(B) * step & MASK))
            late = np.flatnonzero(u > self.share[edge])
            while len(late):
                edge[late] += 1
                late = late[u[late] > self.share[edge[late]]]
            taken.append(edge)
            whose.append(live)
            at = self.target[edge]
            edge = self.first[at]
            step += 1
        for x in whose:
            count[x] += 1
        out = np.zeros(int(count.sum()), np.int32)
        begin = np.cumsum(count) - count
        for n, (edge, live) in enumerate(zip(taken, whose, strict=True)):
            out[begin[live] + n] = edge
        return out, count

    def ids(self, edges: np.ndarray) -> np.ndarray:
        kind = self.kind[edges]
        odd = np.flatnonzero(kind >= len(self.v.text))
        if not len(odd):
            return kind
        parts, at = [], 0
        for i in odd.tolist():
            parts += [kind[at:i], self.char_ids[kind[i] - len(self.v.text)]]
            at = i + 1
        return np.concatenate([*parts, kind[at:]])


class Search:
    """The paths of one text, best first."""

    def __init__(self, lattices: Lattices, salt: int, edges: np.ndarray, count: np.ndarray):
        self.l, self.salt = lattices, salt
        top = float(-np.log(-np.log(uniform(self.stream(TOP, 0))))[0])
        self.paths = [self.path(edges, count, top, 0, np.zeros(0, np.int64), 0)]

    def stream(self, purpose: int, n: int) -> np.ndarray:
        return stream(np.array([self.salt], np.uint64), 4 * n + purpose)

    def path(self, edges: np.ndarray, count: np.ndarray, top: float, fork: int, out: np.ndarray, n: int) -> dict:
        """A path found, and the sets of paths that leave it from step `fork` on. out: edges of that
        step that other paths have taken."""
        logp = self.l.logp[edges]
        total = np.cumsum(logp)
        mass = (total - logp)[fork:] + self.l.rest[edges[fork:]]
        if len(out):
            node = int(self.l.tail[out[0]])
            gone = {*out.tolist(), int(edges[fork])}
            left = [e for e in range(self.l.first[node], self.l.first[node + 1]) if e not in gone]
            mass[0] = (total - logp)[fork] + (np.logaddexp.reduce(self.l.logp[left]) if left else -np.inf)
        u = uniform(self.stream(SETS, n) + A * np.arange(fork, len(edges), dtype=np.uint64))
        return {"edges": edges, "count": count, "top": top, "fork": fork, "out": out, "logp": float(total[-1]) if len(total) else 0.0,
                "sets": truncated(mass, top, u)}

    def best(self) -> tuple[float, int, int]:
        """Value, path and step of the set with the largest maximum."""
        found = [(float(p["sets"].max()), i, int(p["sets"].argmax())) for i, p in enumerate(self.paths) if len(p["sets"])]
        return max(found, default=(-np.inf, 0, 0))

    def fork(self, n: int) -> tuple | None:
        """Leaves the best set: value, edges up to and with the fork, whole parts before it, steps in
        its part so far, edges taken at the fork."""
        top, i, at = self.best()
        if top == -np.inf:
            return None
        p = self.paths[i]
        p["sets"][at] = -np.inf
        step = p["fork"] + at
        out = np.append(p["out"], p["edges"][step]) if at == 0 else p["edges"][step:step + 1]
        node = int(self.l.tail[p["edges"][step]])
        gone = set(out.tolist())
        choice = np.array([e for e in range(self.l.first[node], self.l.first[node + 1]) if e not in gone])
        share = np.cumsum(np.exp(self.l.logp[choice] - self.l.logp[choice].max()))
        u = float(uniform(self.stream(FORK, n))[0])
        edge = choice[min(int(np.searchsorted(share, u * share[-1])), len(choice) - 1)]
        ends = np.cumsum(p["count"])
        whole = int(np.searchsorted(ends, step, side="right"))
        return top, np.append(p["edges"][:step], edge), p["count"][:whole], step - int(ends[whole] - p["count"][whole]) + 1, step, out


STORES: dict = {}


def store(path: str, alpha: float) -> Lattices:
    """One for each Python worker."""
    if (path, alpha) not in STORES:
        STORES[path, alpha] = Lattices(Vocabulary(path), alpha)
    return STORES[path, alpha]


def top_k(texts: list[str], salts: np.ndarray, lattices: Lattices, k: int) -> list[list[tuple]]:
    """For each text its k segmentations (fewer if there are no more), best first: ids, log
    probability, perturbed value, inclusion probability given the value of the next one."""
    v = lattices.v
    raw = [v.prefix + t.replace(MARK, " ").encode() if t else b"" for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[1:-1] = ~v.joined[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
    cut[at] = True
    bounds = np.flatnonzero(cut)
    parts = np.searchsorted(bounds, at)
    roots = lattices.roots_of(data, bounds[:-1], bounds[1:]) if len(bounds) > 1 else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(parts))
    number = np.arange(len(doc)) - parts[:-1][doc]
    unit = A * number.astype(np.uint64)
    edges, count = lattices.walk(roots, stream(salts, WALK)[doc] + unit)
    ends = np.concatenate([[0], np.cumsum(count)])
    found = [Search(lattices, int(salts[i]), edges[ends[a]:ends[b]], count[a:b]) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
    for n in range(1, k):
        forks = [(i, f) for i, s in enumerate(found) if (f := s.fork(n)) is not None]
        # the rest of the part with the fork, and all parts after it, are drawn anew
        nodes, units, cuts, own = [], [], [0], stream(salts, 4 * n + WALK)
        for i, (_, head, whole, _, _, _) in forks:
            rest = np.concatenate([lattices.target[head[-1:]], roots[parts[i] + len(whole) + 1:parts[i + 1]]])
            nodes.append(rest)
            units.append(unit[parts[i] + len(whole):parts[i + 1]] + own[i])
            cuts.append(cuts[-1] + len(rest))
        if not forks:
            break
        more, steps = lattices.walk(np.concatenate(nodes).astype(np.int64), np.concatenate(units))
        stops = np.concatenate([[0], np.cumsum(steps)])
        for (i, (top, head, whole, begun, step, out)), a, b in zip(forks, cuts, cuts[1:], strict=False):
            tally = steps[a:b].copy()
            tally[0] += begun
            found[i].paths.append(found[i].path(np.concatenate([head, more[stops[a]:stops[b]]]), np.concatenate([whole, tally]), top, step, out, n))
    rows = []
    for s in found:
        limit = s.best()[0]
        rows.append([(lattices.ids(p["edges"]), p["logp"], p["top"], float(-np.expm1(-np.exp(min(700.0, p["logp"] - limit))))) for p in s.paths])
    return rows


def sampled(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id", sampling: Sampling = Sampling()) -> DataFrame:
    """key, rank, ids, n_pieces, log_prob, perturbed, inclusion: k different segmentations of each text.

    Ranks go from the largest perturbed value. inclusion is the probability that the segmentation
    is in a sample of k, given the value that the next one has: 1 if there is no next one. Draws
    depend on seed, key and place in the text only; rows with the same key and text get the same
    segmentations. A null text is empty; an empty text has one segmentation, without pieces.
    Characters without a piece are written as bytes. A null key is a key of its own.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                       F.xxhash64(F.col(key).cast("string"), F.lit(sampling.seed)).alias("_salt"))
    lists = pa.list_(pa.int32())

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = store(model, sampling.alpha)
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                salts = mix(part.column("_salt").to_numpy().view(np.uint64).copy())
                found = top_k(part.column("_text").to_pylist(), salts, lattices, sampling.k)
                which = np.repeat(np.arange(len(found)), [len(f) for f in found])
                flat = [row for f in found for row in f]
                size = np.array([len(r[0]) for r in flat])
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()),
                                               pa.array(np.concatenate([np.zeros(0, np.int32), *(r[0] for r in flat)]), pa.int32()))
                yield pa.RecordBatch.from_arrays([
                    part.column("_key").take(pa.array(which)), pa.array([i + 1 for f in found for i in range(len(f))], pa.int32()), ids,
                    pa.array(size, pa.int64()), *(pa.array([r[c] for r in flat], pa.float64()) for c in (1, 2, 3))],
                    schema=pa.schema([(key, part.column("_key").type), ("rank", pa.int32()), ("ids", lists), ("n_pieces", pa.int64()),
                                      ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64())]))

    return rows.mapInArrow(draw, f"`{key}` {kind}, rank int, ids array<int>, n_pieces long, log_prob double, perturbed double, inclusion double")


def decoded(rows: DataFrame, model: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The rows with the text of the ids; a column of that name is replaced. Null ids give a null."""
    rest = rows.drop(into)

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = store(model, 0.0).v
        for batch in batches:
            out = pa.array([None if x is None else vocabulary.decode(x) for x in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], schema=pa.schema([*batch.schema, pa.field(into, pa.string())]))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(texts, f"{kinds}, `{into}` string")
