"""State algebra: named states, user-defined truth tables, and their column expressions.

A truth table combines two states into one. Folding many states needs an order unless the table is
associative, commutative and idempotent; then the result depends only on the *set* of states and a
fold is a plain aggregate. Three kinds are told apart when the configuration is loaded:

``rank``     the table is "the higher of the two" in some order of states
``set``      any other order-independent table; a lookup by the set of states present
``ordered``  everything else; folded in ascending member name

Undefined cells give -1, and -1 stays -1 in every further combination.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, functions as F

UNDEFINED = -1

# Which states count as what when a timeline is integrated.
UP_STATES = ("OK", "WARNING")
UNKNOWN_STATES = ("MISSING", "UNKNOWN")
DOWN_STATES = ("DOWNTIME",)


def _texts(names: tuple[str, ...] | list[str]) -> Column:
    return F.lit(list(names))


@dataclass(frozen=True)
class Operations:
    """States, default states and truth tables of one configuration document."""

    states: tuple[str, ...]
    tables: dict[str, tuple[tuple[int, ...], ...]]
    down: str = "DOWNTIME"
    missing: str = "MISSING"
    unknown: str = "UNKNOWN"

    @classmethod
    def from_document(cls, doc: dict, mirror: bool = True) -> "Operations":
        """Build from the parsed JSON document; ``mirror`` makes A,B hold for B,A as well."""
        states = tuple(doc["states"])
        code = {name: i for i, name in enumerate(states)}
        tables = {}
        for op, cells in doc["operations"].items():
            grid = [[UNDEFINED] * len(states) for _ in states]
            for cell in cells:
                a, b, x = code[cell["A"]], code[cell["B"]], code[cell["X"]]
                grid[a][b] = x
                if mirror:
                    grid[b][a] = x
            tables[op] = tuple(tuple(row) for row in grid)
        return cls(states, tables, doc["default_down"], doc["default_missing"],
                   doc["default_unknown"])

    @classmethod
    def from_orders(cls, states: list[str], orders: dict[str, list[str]], **defaults: str) -> "Operations":
        """Build rank tables from orders of states, lowest first."""
        tables = {}
        for op, order in orders.items():
            rank = {name: i for i, name in enumerate(order)}
            tables[op] = tuple(
                tuple(states.index(max(a, b, key=rank.__getitem__)) for b in states)
                for a in states)
        return cls(tuple(states), tables, **defaults)

    # -- names and codes -------------------------------------------------------------------------

    @property
    def size(self) -> int:
        return len(self.states)

    def code(self, name: str) -> int:
        return self.states.index(name)

    @property
    def missing_code(self) -> int:
        return self.code(self.missing)

    @property
    def down_code(self) -> int:
        return self.code(self.down)

    @property
    def unknown_code(self) -> int:
        return self.code(self.unknown)

    def state_code(self, name: Column) -> Column:
        """State name to code; a name that is not a state gives -1."""
        return F.coalesce(F.array_position(_texts(self.states), name).cast("int") - 1,
                          F.lit(UNDEFINED))

    def state_name(self, code: Column) -> Column:
        """State code to name; -1 gives null."""
        return F.get(_texts(self.states), code)

    def op_code(self, op: Column | str) -> Column:
        """Operation name to its number, a fixed-width value that aggregates well."""
        names = sorted(self.tables)
        if isinstance(op, str):
            return F.lit(names.index(op))
        return F.array_position(_texts(names), op).cast("int") - 1

    def op_number(self, op: str) -> int:
        return sorted(self.tables).index(op)

    # -- combination -----------------------------------------------------------------------------

    def combine(self, op: str, a: int, b: int) -> int:
        if a == UNDEFINED or b == UNDEFINED:
            return UNDEFINED
        return self.tables[op][a][b]

    def apply_op(self, op: Column | str, a: Column, b: Column) -> Column:
        """Truth-table lookup of two codes as a column expression."""
        def lookup(name: str) -> Column:
            cells = F.lit([x for row in self.tables[name] for x in row])
            inside = (a >= 0) & (b >= 0)
            return F.when(inside, F.get(cells, a * self.size + b)).otherwise(UNDEFINED)
        return self._by_op(op, lookup, sorted(self.tables))

    def cells(self) -> list[tuple[str, str, str, str]]:
        """The defined cells (op, a, b, x) as names."""
        return [(op, self.states[a], self.states[b], self.states[x])
                for op, grid in sorted(self.tables.items())
                for a, row in enumerate(grid) for b, x in enumerate(row) if x != UNDEFINED]

    def rank(self, op: str) -> list[int] | None:
        """Codes from lowest to highest when the table is a maximum, else None."""
        codes = range(self.size)
        order = sorted(codes, key=lambda a: sum(self.combine(op, a, b) == a for b in codes))
        place = {code: i for i, code in enumerate(order)}
        for a, b in itertools.product(codes, codes):
            if self.combine(op, a, b) != max(a, b, key=place.__getitem__):
                return None
        return order

    def order_free(self, op: str) -> bool:
        """Associative, commutative and idempotent, undefined cells included."""
        codes = range(self.size)
        join = lambda a, b: self.combine(op, a, b)
        if any(join(a, a) != a for a in codes):
            return False
        if any(join(a, b) != join(b, a) for a, b in itertools.combinations(codes, 2)):
            return False
        return all(join(join(a, b), c) == join(a, join(b, c))
                   for a, b, c in itertools.product(codes, codes, codes))

    @cached_property
    def kinds(self) -> dict[str, str]:
        kinds = {}
        for op in self.tables:
            if self.rank(op) is not None:
                kinds[op] = "rank"
            elif self.order_free(op):
                kinds[op] = "set"
            else:
                kinds[op] = "ordered"
        return kinds

    def fold_codes(self, op: str, codes: list[int]) -> int:
        """Left fold of codes, in the given order."""
        result = codes[0]
        for code in codes[1:]:
            result = self.combine(op, result, code)
        return result

    # -- column expressions ----------------------------------------------------------------------

    def fold_counts(self, counts: list[str], undefined: str, ops: set[str], op: str = "op") -> str:
        """SQL text: fold of the states with a positive count (one count column per code).

        ``op`` is the column of operation numbers, read when there are several ``ops``. Null when
        nothing is present. For order-free tables only.
        """
        def fold(name: str) -> str:
            if self.kinds[name] == "rank":
                tests = " ".join(f"WHEN {counts[c]} > 0 THEN {c}" for c in reversed(self.rank(name)))
                return f"CASE {tests} END"
            # a chain over the states that are present, one look-up each
            cells = ", ".join(str(x) for row in self.tables[name] for x in row)
            present = ", ".join(f"if({c} > 0, {i}, NULL)" for i, c in enumerate(counts))
            step = (f"CASE WHEN x IS NULL OR acc = {UNDEFINED} THEN acc WHEN acc IS NULL THEN x "
                    f"ELSE get(array({cells}), acc * {self.size} + x) END")
            return f"aggregate(array({present}), CAST(NULL AS INT), (acc, x) -> {step})"

        names = sorted(ops)
        if len(names) == 1:
            found = fold(names[0])
        else:
            cases = " ".join(f"WHEN {self.op_number(n)} THEN {fold(n)}" for n in names)
            found = f"CASE {op} {cases} END"
        return f"CASE WHEN {undefined} > 0 THEN {UNDEFINED} ELSE {found} END"

    def _by_op(self, op: Column | str, build, names: list[str]) -> Column:
        if isinstance(op, str):
            return build(op)
        choice = F
        for name in names:
            choice = choice.when(op == self.op_number(name), build(name))
        return choice
