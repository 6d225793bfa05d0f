"""Decimal rounding that agrees with Python's ``round(x, n)`` on doubles.

Python rounds the *exact binary value* of a double to ``n`` decimals, ties to
even.  Spark's ``round`` is half-up on the shortest decimal text and DuckDB's
scales then rounds, so the three disagree on values like 12.35 or 0.125.

Here ``y = x * 10^n`` is rounded to an integer with ``rint`` (ties to even),
and the one case where the float product lands exactly on a half while the
exact product does not is fixed with the product's rounding error, obtained by
Dekker's split (plain IEEE operations, so the same bits in the JVM and in the
SQL twin).  The result is ``k / 10^n``, the double nearest the decimal answer,
as Python returns.  Valid for ``|x * 10^n| < 2^52`` and ``n <= 11``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2^27 + 1, Dekker's splitter for doubles


def py_round(x: Column | str, n: int) -> Column:
    """Spark Column equal to Python ``round(x, n)`` for doubles (``x``: column name or Column)."""
    if not 0 <= n <= 11:
        raise ValueError("py_round supports 0..11 decimals")
    if isinstance(x, str):
        return F.expr(round_text(_quote(x), n, SPARK))
    x = x.cast("double")
    s = float(10 ** n)
    y = x * F.lit(s)
    c = x * F.lit(_SPLIT)
    hi = c - (c - x)
    lo = x - hi
    err = (hi * F.lit(s) - y) + lo * F.lit(s)
    fl = F.floor(y).cast("double")
    half = (y - fl) == F.lit(0.5)
    k = (F.when(half & (err > 0), fl + F.lit(1.0))
         .when(half & (err < 0), fl)
         .otherwise(F.rint(y)))
    return k / F.lit(s)


def sql_py_round(expr: str, n: int) -> str:
    """DuckDB SQL text computing the same value as :func:`py_round`.

    ``expr`` should be a column name or a parenthesised expression; it is
    repeated several times in the output."""
    return round_text(expr, n, DUCK)


# ---------------------------------------------------------------------------
# Exact means and sums of values that carry at most ``dp_in`` decimals (grid
# values arrive as whole MWh, the fixtures carry hundredths).
#
# A float ``avg`` depends on summation order, which differs between engines and
# between runs with different partitioning; near a rounding tie that changes the
# rounded answer.  Here the inputs are turned into exact integer units, summed
# exactly (order-free), and the mean is rounded with integer arithmetic.  An
# exact decimal tie resolves like Python's ``round(statistics.mean(v), nd)``:
# by where the double nearest the tie lies (above -> up, below -> down, exactly
# on it -> even), found with the same Dekker product error as above.
#
# The expressions are generated as SQL text for both engines from one template
# (``dialect`` = "spark" or "duckdb"), so the Spark side costs one JVM call per
# expression instead of one per operator node.


class _Dialect:
    def __init__(self, name: str):
        self.name = name

    def dbl(self, v: float) -> str:
        return f"{float(v)!r}D" if self.name == "spark" else f"CAST({float(v)!r} AS DOUBLE)"

    def rint(self, e: str) -> str:
        return f"rint({e})" if self.name == "spark" else f"round_even({e}, 0)"

    def floor(self, e: str) -> str:
        return f"CAST(floor({e}) AS DOUBLE)"

    def pmod(self, a: str, b: str) -> str:
        return f"pmod({a}, {b})" if self.name == "spark" else f"((({a} % {b}) + {b}) % {b})"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"


SPARK, DUCK = _Dialect("spark"), _Dialect("duckdb")


def round_text(expr: str, n: int, d: _Dialect) -> str:
    """``round(expr, n)`` with Python semantics as SQL text (expr is repeated)."""
    if not 0 <= n <= 11:
        raise ValueError("supports 0..11 decimals")
    s = d.dbl(10 ** n)
    x = f"CAST({expr} AS DOUBLE)"
    y = f"({x} * {s})"
    c = f"({x} * {d.dbl(_SPLIT)})"
    hi = f"({c} - ({c} - {x}))"
    lo = f"({x} - {hi})"
    err = f"(({hi} * {s} - {y}) + {lo} * {s})"
    fl = d.floor(y)
    half = f"(({y} - {fl}) = {d.dbl(0.5)})"
    return (f"((CASE WHEN {half} AND {err} > 0 THEN {fl} + {d.dbl(1.0)} "
            f"WHEN {half} AND {err} < 0 THEN {fl} ELSE {d.rint(y)} END) / {s})")


def units_text(expr: str, dp_in: int, d: _Dialect) -> str:
    return f"CAST({d.rint(f'CAST({expr} AS DOUBLE) * {d.dbl(10 ** dp_in)}')} AS BIGINT)"


def mean_round_text(s: str, n: str, nd: int, dp_in: int, d: _Dialect) -> str:
    """``round(S / (n 10^dp_in), nd)`` from an exact unit sum ``s`` and count ``n``."""
    if not 0 <= nd <= dp_in <= 6:
        raise ValueError("need 0 <= nd <= dp_in <= 6")
    big_n = f"({n} * {10 ** (dp_in - nd)})"
    r = d.pmod(s, big_n)
    q = d.idiv(f"({s} - {r})", big_n)
    dd = d.dbl(2 * 10 ** nd)
    m = f"CAST({q} * 2 + 1 AS DOUBLE)"
    t = f"({m} / {dd})"
    p = f"({t} * {dd})"
    c = f"({t} * {d.dbl(_SPLIT)})"
    hi = f"({c} - ({c} - {t}))"
    lo = f"({t} - {hi})"
    err = f"(({hi} * {dd} - {p}) + {lo} * {dd})"
    above = f"(CASE WHEN {p} <> {m} THEN {p} > {m} ELSE {err} > 0 END)"
    exact_tie = f"({p} = {m} AND {err} = 0)"
    k = (f"(CASE WHEN {r} * 2 < {big_n} THEN {q} WHEN {r} * 2 > {big_n} THEN {q} + 1 "
         f"WHEN {exact_tie} THEN (CASE WHEN {d.pmod(q, '2')} = 0 THEN {q} ELSE {q} + 1 END) "
         f"WHEN {above} THEN {q} + 1 ELSE {q} END)")
    return f"(CASE WHEN {n} > 0 THEN CAST({k} AS DOUBLE) / {d.dbl(10 ** nd)} END)"


def _quote(col: str) -> str:
    return "`" + col.replace("`", "``") + "`"


def py_round_expr(sql: str, n: int) -> Column:
    """Python-equal rounding of a Spark SQL expression text (may contain aggregates)."""
    return F.expr(round_text(f"({sql})", n, SPARK))


def rest_text(expr: str, dp_in: int, d: _Dialect) -> str:
    """What ``expr`` has beyond ``dp_in`` decimals: exactly 0.0 for values that have no more."""
    x, s = f"CAST({expr} AS DOUBLE)", d.dbl(10 ** dp_in)
    return f"({x} - {d.rint(f'{x} * {s}')} / {s})"


# What lies beyond the units is summed as a whole number of 1e-12: whole-number sums are the same in every
# order, so results have the same bits on any partitioning, and values of up to twelve decimals add up exactly.
REST_SCALE = 1e12


def rest_units_text(expr: str, dp_in: int, d: _Dialect) -> str:
    return f"CAST({d.rint(f'{rest_text(expr, dp_in, d)} * {d.dbl(REST_SCALE)}')} AS BIGINT)"


def rest_units(c: Column, dp_in: int = 2) -> Column:
    """What a value has beyond ``dp_in`` decimals, in whole 1e-12; to be summed and divided by REST_SCALE."""
    s = F.lit(float(10 ** dp_in))
    return F.rint((c - F.rint(c * s) / s) * F.lit(REST_SCALE)).cast("long")


def _rest_sum(x: str, dp_in: int) -> str:
    return f"CAST(sum({rest_units_text(_quote(x), dp_in, SPARK)}) AS DOUBLE) / {SPARK.dbl(REST_SCALE)}"


def exact_sum(x: str, dp_in: int = 2) -> Column:
    """Aggregate: sum of a column, with the same bits in every order.

    Whole units and what lies beyond them are summed apart, so further decimals count too."""
    u = units_text(_quote(x), dp_in, SPARK)
    return F.expr(f"CAST(sum({u}) AS DOUBLE) / {SPARK.dbl(10 ** dp_in)} + {_rest_sum(x, dp_in)}")


def py_mean(x: str, nd: int = 2, dp_in: int = 2) -> Column:
    """Aggregate over a column name: ``round(mean(x), nd)`` with Python semantics."""
    u, rest = units_text(_quote(x), dp_in, SPARK), _rest_sum(x, dp_in)
    mean = f"((CAST(sum({u}) AS DOUBLE) / {SPARK.dbl(10 ** dp_in)} + {rest}) / CAST(count({u}) AS DOUBLE))"
    return F.expr(f"CASE WHEN count({u}) > 0 THEN CASE WHEN {rest} = 0 THEN "
                  f"{mean_round_text(f'sum({u})', f'count({u})', nd, dp_in, SPARK)} "
                  f"ELSE {round_text(mean, nd, SPARK)} END END")


def exact_mean(x: str, dp_in: int = 2) -> Column:
    """Aggregate: unrounded mean from the exact unit sum and the rest beyond it; for values
    with at most ``dp_in`` decimals one IEEE division, identical on every partitioning."""
    u = units_text(_quote(x), dp_in, SPARK)
    return F.expr(f"CASE WHEN count({u}) > 0 THEN CAST(sum({u}) AS DOUBLE) / "
                  f"(CAST(count({u}) AS DOUBLE) * {SPARK.dbl(10 ** dp_in)}) + {_rest_sum(x, dp_in)} / CAST(count({u}) AS DOUBLE) END")


def mean_parts(x: str, dp_in: int = 2) -> Column:
    """Aggregate: struct(unit sum ``s``, count ``n``, rest ``e`` in whole 1e-12), all whole numbers; finish with :func:`finish_means`."""
    u, e = units_text(_quote(x), dp_in, SPARK), rest_units_text(_quote(x), dp_in, SPARK)
    return F.expr(f"named_struct('s', sum({u}), 'n', count({u}), 'e', sum({e}))")


def merge_parts(x: str) -> Column:
    """Aggregate: the :func:`mean_parts` of a union of groups, from those of the groups (null: an empty group)."""
    c = _quote(x)
    return F.expr(f"named_struct('s', sum({c}.s), 'n', coalesce(sum({c}.n), 0L), 'e', sum({c}.e))")


def finish_means(df, cols, nd: int = 2, dp_in: int = 2):
    """Replace each :func:`mean_parts` struct column in ``cols`` by ``round(mean, nd)``.

    Written as a chain of small projections (a let-chain): each step only
    references the previous step's columns, and Catalyst does not inline a
    non-trivial alias used more than once, so the generated code stays linear
    instead of repeating the tie arithmetic's subtrees."""
    if not 0 <= nd <= dp_in <= 6:
        raise ValueError("need 0 <= nd <= dp_in <= 6")
    d = SPARK
    dd, split = d.dbl(2 * 10 ** nd), d.dbl(_SPLIT)
    steps = [
        [("s", "{c}.s"), ("n", "{c}.n"), ("e", "{c}.e"), ("bn", f"greatest({{c}}.n, 1L) * {10 ** (dp_in - nd)}"),
         ("avg", f"CASE WHEN {{c}}.n > 0 THEN (CAST({{c}}.s AS DOUBLE) / {d.dbl(10 ** dp_in)} + CAST({{c}}.e AS DOUBLE) / {d.dbl(REST_SCALE)}) "
                 "/ CAST({c}.n AS DOUBLE) END")],
        [("r", "pmod({s}, {bn})")],
        [("q", "({s} - {r}) div {bn}")],
        [("m", "CAST({q} * 2 + 1 AS DOUBLE)")],
        [("t", f"{{m}} / {dd}")],
        [("p", f"{{t}} * {dd}"), ("cc", f"{{t}} * {split}")],
        [("hi", "{cc} - ({cc} - {t})")],
        [("err", f"({{hi}} * {dd} - {{p}}) + ({{t}} - {{hi}}) * {dd}")],
    ]
    final = ("CASE WHEN {n} > 0 AND {e} <> 0 THEN " + round_text("{avg}", nd, d) + " WHEN {n} > 0 THEN CAST((CASE WHEN {r} * 2 < {bn} THEN {q} "
             "WHEN {r} * 2 > {bn} THEN {q} + 1 "
             "WHEN {p} = {m} AND {err} = 0 THEN (CASE WHEN pmod({q}, 2) = 0 THEN {q} ELSE {q} + 1 END) "
             "WHEN (CASE WHEN {p} <> {m} THEN {p} > {m} ELSE {err} > 0 END) THEN {q} + 1 "
             f"ELSE {{q}} END) AS DOUBLE) / {d.dbl(10 ** nd)} END")
    keep = list(df.columns)

    def names(c):
        return {k: _quote(f"__{c}_{k}") for k in
                ("s", "n", "e", "avg", "bn", "r", "q", "m", "t", "p", "cc", "hi", "err")} | {"c": _quote(c)}

    temps = []
    for step in steps:
        exprs = ["*"]
        for c in cols:
            nm = names(c)
            for k, tmpl in step:
                exprs.append(f"{tmpl.format(**nm)} AS {nm[k]}")
                temps.append(f"__{c}_{k}")
        df = df.selectExpr(*exprs)
    out = [f"{final.format(**names(c))} AS {_quote(c)}" if c in cols else _quote(c) for c in keep]
    return df.selectExpr(*out)


# DuckDB twins ---------------------------------------------------------------

# Written apart from the Spark side: sums are exact DECIMAL sums of six decimals, and a mean is one division.

def _decimal_sum(expr: str) -> str:
    return f"CAST(CAST(sum(CAST({expr} AS DECIMAL(38, 6))) * 1000000 AS HUGEINT) AS DOUBLE)"


def sql_exact_sum(expr: str, dp_in: int = 2) -> str:
    return f"({_decimal_sum(expr)} / 1000000.0::DOUBLE)"


def sql_exact_mean(expr: str, dp_in: int = 2) -> str:
    return f"(CASE WHEN count({expr}) > 0 THEN {_decimal_sum(expr)} / (CAST(count({expr}) AS DOUBLE) * 1000000.0::DOUBLE) END)"


def sql_py_mean(expr: str, nd: int = 2, dp_in: int = 2) -> str:
    return round_text(sql_exact_mean(expr), nd, DUCK)
