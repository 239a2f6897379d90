"""The panel's value rules as Spark SQL expression text.

Wide projections (hundreds of columns) are built as text and handed to
``selectExpr`` in one call: the JVM parses them at once instead of one
Python-to-JVM round trip per expression node, which keeps planning time of
the study's 358-column panel well under a second.
"""

from __future__ import annotations


def q(name: str) -> str:
    return f"`{name}`"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def fill_sentinel(x: str, sentinel: float) -> str:
    """Null / NaN -> sentinel."""
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {dbl(sentinel)} ELSE {x} END"


def numeric(x: str) -> str:
    return f"try_cast({x} AS DOUBLE)"


def transition_code(prev: str, nxt: str, n_levels: int, sentinel: float) -> str:
    """Nominal change as trunc(prev) * n + trunc(next) + 1; values outside (-1, n) give the sentinel."""
    def ok(x):
        return f"({x} > -1.0D AND {x} < {float(n_levels)}D)"

    def trunc(x):
        return "(" + " + ".join(["0.0D"] + [f"IF({x} >= {float(j)}D, 1.0D, 0.0D)"
                                           for j in range(1, n_levels)]) + ")"
    code = f"{trunc(prev)} * {float(n_levels)}D + {trunc(nxt)} + 1.0D"
    return f"CASE WHEN {ok(prev)} AND {ok(nxt)} THEN {code} ELSE {dbl(sentinel)} END"


def interval_plan(dmcase: str, status: str, outcome: str, excluded: float) -> tuple[str, str]:
    """(number of intervals, positive visit or null) for one participant.

    diag: code 1..9 -> visits 1..code, positive at code; drug: code 2..9 ->
    visits 1..code-1, positive at code-1; 10 -> nine negative visits; codes
    above 10 -> 19 - code negative visits; anything else -> none.
    """
    d = f"(CASE WHEN {dmcase} > -1.0D AND {dmcase} < 20.0D THEN CAST({dmcase} AS INT) END)"
    lo, shift = (1, 0) if outcome == "diag" else (2, 1)
    event = f"{d} BETWEEN {lo} AND 9"
    n = (f"CASE WHEN {status} = {dbl(excluded)} THEN 0 WHEN {event} THEN {d} - {shift} "
         f"WHEN {d} = 10 THEN 9 WHEN {d} > 10 THEN 19 - {d} ELSE 0 END")
    pos = f"CASE WHEN {event} THEN {d} - {shift} END"
    return n, pos


def carried_array(cols, sentinel: float) -> str:
    """Array of one series with each sentinel replaced by the last present earlier value: one left fold."""
    s = dbl(sentinel)
    arr = "array(" + ", ".join(q(c) for c in cols) + ")"
    v = f"IF(x = {s}, acc.last, x)"
    return (f"aggregate({arr}, named_struct('out', CAST(array() AS ARRAY<DOUBLE>), 'last', {s}), "
            f"(acc, x) -> named_struct('out', concat(acc.out, array({v})), 'last', {v}), acc -> acc.out)")
