"""Exact quantiles without funnelling a column through one task.

``percentile``/``median`` in a global aggregate merge a value→count map of
every distinct value into a single final task. That is fine for a few
million values, not for a column of a 100 TB table. ``exact_quantiles``
instead runs a distributed selection:

1. one scan: non-null count, min, max and a ``percentile_approx`` bracket
   around every requested quantile (rank error ≤ n / accuracy);
2. while a bracket would still hold more than ``max_bracket`` rows (only for
   very large columns), it is narrowed with ``percentile_approx`` over the
   bracket alone plus exact counts below / up to the new bounds;
3. one scan: for every bracket, the rows below it are counted and the values
   inside it are grouped (``groupBy(bracket, value).count()``); a running count
   within the bracket (at most ``max_bracket`` values) finds the wanted ranks, so
   only they reach the driver: two rows a quantile at most. A bracket the
   approximation missed is opened to the whole column and narrowed again.

The result equals linear interpolation between order statistics (Spark
``percentile``, DuckDB ``quantile_cont``, NumPy's default).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000
DEFAULT_MAX_BRACKET = 200_000
MAX_ROUNDS = 12


@dataclass
class _Bracket:
    column: str
    ranks: tuple[int, ...]   # 0-based ranks wanted inside this bracket
    lo: float
    hi: float
    least: float             # of the whole column
    most: float
    rows: int                # of the whole column, without NULLs
    checked: bool = False    # the ranks are known to lie inside


def _band(probs: list[float], delta: float) -> list[float]:
    return sorted({min(1.0, max(0.0, v)) for p in probs for v in (p - delta, p + delta)})


def first_pass_aggs(exprs: dict[str, Column], probs: list[float],
                    accuracy: int = DEFAULT_ACCURACY) -> list[Column]:
    """The selection's first-pass aggregates for ``{name: double expression}``,
    so a caller can fold them into a scan it runs anyway."""
    band = _band(probs, 3.0 / accuracy)
    out = []
    for name, x in exprs.items():
        out += [F.count(x).alias(f"n_{name}"), F.min(x).alias(f"mn_{name}"), F.max(x).alias(f"mx_{name}"),
                F.percentile_approx(x, band, accuracy).alias(f"ap_{name}")]
    return out


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    accuracy: int = DEFAULT_ACCURACY,
                    max_bracket: int = DEFAULT_MAX_BRACKET, *,
                    exprs: dict[str, Column] | None = None, first=None) -> dict[tuple[str, float], float | None]:
    """Exact linear-interpolation quantiles of numeric ``columns`` of ``df``.

    NULLs are ignored; a column without values gives ``None``. Returns
    ``{(column, p): value}``. ``exprs`` maps a column to the double
    expression to use (default: the column cast to double); ``first`` is the
    row of an aggregate that already contains ``first_pass_aggs`` for those
    expressions under the names ``_qs_q<i>``.
    """
    if not columns:
        return {}
    eps = 1.0 / accuracy
    delta = 3 * eps
    names = {c: f"_qs_q{i}" for i, c in enumerate(columns)}
    exprs = exprs or {c: F.col(c).cast("double") for c in columns}
    data = df.select(*[exprs[c].alias(names[c]) for c in columns])
    if first is None:
        first = data.agg(*first_pass_aggs({names[c]: F.col(names[c]) for c in columns}, probs, accuracy)).collect()[0]

    todo: list[_Bracket] = []
    values: dict[tuple[str, int], float] = {}
    for c in columns:
        x = names[c]
        n = int(first[f"n_{x}"])
        if n == 0:
            continue
        least, most = first[f"mn_{x}"], first[f"mx_{x}"]
        approx = dict(zip(_band(probs, delta), first[f"ap_{x}"]))
        for p in probs:
            h = (n - 1) * p
            lo = approx[max(0.0, p - delta)] if p > delta else least
            hi = approx[min(1.0, p + delta)] if p + delta < 1 else most
            todo.append(_Bracket(c, tuple(sorted({math.floor(h), math.ceil(h)})), lo, hi, least, most, n))

    for _ in range(MAX_ROUNDS):
        if not todo:
            break
        doubtful = [b for b in todo if not b.checked and b.rows * 2 * delta > max_bracket]
        if doubtful:
            _narrow(data, names, doubtful, delta, accuracy, max_bracket)
        ready = [b for b in todo if b.checked or b.rows * 2 * delta <= max_bracket]
        found = _pick(data, names, ready)
        for i, b in enumerate(ready):
            got = found.get(i, {})
            if all(r in got for r in b.ranks):
                values |= {(b.column, r): got[r] for r in b.ranks}
                todo.remove(b)
            else:  # missed: the whole column, to be narrowed by exact counts
                b.lo, b.hi, b.checked = b.least, b.most, False
                _narrow(data, names, [b], delta, accuracy, max_bracket)
    if todo:
        raise RuntimeError(f"no exact quantile of {sorted({b.column for b in todo})} after {MAX_ROUNDS} rounds")

    out: dict[tuple[str, float], float | None] = {}
    for c in columns:
        n = int(first[f"n_{names[c]}"])
        for p in probs:
            if n == 0:
                out[(c, p)] = None
                continue
            h = (n - 1) * p
            lo_r, hi_r = math.floor(h), math.ceil(h)
            v_lo, v_hi = values[(c, lo_r)], values[(c, hi_r)]
            out[(c, p)] = float(v_lo + (h - lo_r) * (v_hi - v_lo))
    return out


def _narrow(data: DataFrame, names: dict[str, str], brackets: list[_Bracket], delta: float, accuracy: int, max_bracket: int) -> None:
    """Exact counts at the bounds; brackets that are still too wide get closer bounds, until all are checked and small."""
    wide = brackets
    for _ in range(MAX_ROUNDS):
        tally = data.agg(*[e for i, b in enumerate(wide) for e in (
            F.count_if(F.col(names[b.column]) < F.lit(b.lo)).alias(f"lt{i}"),
            F.count_if(F.col(names[b.column]) <= F.lit(b.hi)).alias(f"le{i}"))]).first()
        size, below = {}, {}
        for i, b in enumerate(wide):
            lt, le = int(tally[f"lt{i}"]), int(tally[f"le{i}"])
            if lt > b.ranks[0]:
                b.lo, lt = b.least, 0
            if le <= b.ranks[-1]:
                b.hi, le = b.most, b.rows
            size[b.column, b.ranks], below[b.column, b.ranks] = le - lt, lt
            b.checked = le - lt <= max_bracket or b.lo == b.hi
        wide = [b for b in wide if not b.checked]
        if not wide:
            return
        aggs = []
        for i, b in enumerate(wide):
            col, n, lt = F.col(names[b.column]), size[b.column, b.ranks], below[b.column, b.ranks]
            inside = F.when((col >= F.lit(b.lo)) & (col <= F.lit(b.hi)), col)
            share = [max(0.0, (b.ranks[0] - lt) / n - delta), min(1.0, (b.ranks[-1] + 1 - lt) / n + delta)]
            aggs.append(F.percentile_approx(inside, share, accuracy).alias(f"a{i}"))
        closer = data.agg(*aggs).first()
        for i, b in enumerate(wide):
            b.lo, b.hi = closer[f"a{i}"]
    for b in wide:  # heavy ties at both ends: what is left is grouped as it is
        b.checked = True


def _pick(data: DataFrame, names: dict[str, str], brackets: list[_Bracket]) -> dict[int, dict[int, float]]:
    """bracket → rank → value, for the ranks inside; the running counts stay on the executors."""
    if not brackets:
        return {}
    structs = []
    for i, b in enumerate(brackets):
        col = F.col(names[b.column])
        structs.append(F.when(col < F.lit(b.lo), F.struct(F.lit(i).alias("bid"), F.lit(True).alias("below"),
                                                          F.lit(None).cast("double").alias("v")))
                       .when(col <= F.lit(b.hi), F.struct(F.lit(i).alias("bid"), F.lit(False).alias("below"),
                                                          col.alias("v"))))
    ranks = F.create_map(*[x for i, b in enumerate(brackets) for x in (F.lit(i), F.array(*[F.lit(r) for r in b.ranks]))])
    upto = F.sum("n").over(Window.partitionBy("bid").orderBy(F.desc("below"), "v").rowsBetween(Window.unboundedPreceding, 0))
    rows = (data.select(F.explode(F.filter(F.array(*structs), lambda s: s.isNotNull())).alias("s"))
            .groupBy("s.bid", "s.below", "s.v").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto).where("not below")
            .withColumn("hit", F.filter(F.element_at(ranks, F.col("bid")), lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n"))))
            .where("size(hit) > 0").select("bid", "v", "hit").collect())
    out: dict[int, dict[int, float]] = {}
    for row in rows:
        out.setdefault(row["bid"], {}).update(dict.fromkeys(row["hit"], row["v"]))
    return out


def exact_median(df: DataFrame, column: str, **kw) -> float | None:
    return exact_quantiles(df, [column], [0.5], **kw)[(column, 0.5)]
