"""Time-gap ("look-around") features per entity group.

For a key set ``K`` with name ``n`` (keys joined by ``_``), rows of a group are ordered by the row
ordinal and ``d(k)`` is the minute ordinal of the row ``k`` places later (``k < 0``: earlier):

* ``ts_{n}_{g}_diff_next = d(g) - d(0)``, ``ts_{n}_{g}_diff_last = d(0) - d(-g)``          (W1, W2)
* ``…_diff_{next,last}_{count,mean,max,min}`` over the whole group                        (W3–W6)
* ``ts_s_{f}_{n}_{g}_next_1`` / ``…_last_1``: the first-order gap ``f`` shifted by ``g`` minus itself;
  in closed form these need only ``d(-4..4)``                                             (W7, W8)

A hash partitioning on ``user_id`` satisfies every ``(user_id, x)`` clustering, so the nine user-prefixed key sets share one
exchange. Each task sorts its narrow rows by numpy (:mod:`clickwise.operators.gap_rows`) and sends the wide rows on batch by batch: they
are neither sorted nor spilled, and an exchange moves them packed by columns and compressed. Minute ordinals that are not whole numbers, and ``leaky=False``, go by window expressions.

Groups larger than ``hot_threshold`` rows are split into bounded ordinal ranges: see :func:`_family`.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickwise.operators import gap_rows
from clickwise.operators.rank import global_rank
from clickwise.operators.skew import DEFAULT_HOT_THRESHOLD, hot_keys
from clickwise.session import cut_lineage, ship_package

GAPS = (1, 2, 3)
#: Rows a task aims at; fewer where the session's number of shuffle partitions gives fewer.
ROWS_PER_TASK = 250_000
#: Rows a task gets, about, where the session has as many partitions (else more).
LEAST_ROWS = 25_000


def gap_name(keys: list[str]) -> str:
    return "_".join(keys)


def feature_names(keys: list[str], gaps=GAPS, leaky: bool = True) -> list[str]:
    """Output columns of one key set, in the order the reference appends them."""
    n = gap_name(keys)
    out = []
    for g in gaps:
        if leaky:
            out += [f"ts_{n}_{g}_diff_next", f"ts_{n}_{g}_diff_last"]
            for s in ("count", "mean", "max", "min"):
                out += [f"ts_{n}_{g}_diff_next_{s}", f"ts_{n}_{g}_diff_last_{s}"]
        else:
            out += [f"ts_{n}_{g}_diff_last"] + [f"ts_{n}_{g}_diff_last_{s}" for s in ("count", "mean", "max", "min")]
    for f in ("next", "last"):
        for g in gaps:
            if leaky:
                out += [f"ts_s_{f}_{n}_{g}_next_1", f"ts_s_{f}_{n}_{g}_last_1"]
            elif f == "last":
                out += [f"ts_s_{f}_{n}_{g}_last_1"]
    return out


def _q(c: str) -> str:
    return f"`{c}`"


def _order_sql(order_col) -> str:
    """``ORDER BY`` list: one column name or a list of them (a total order)."""
    return ", ".join(_q(c) for c in ([order_col] if isinstance(order_col, str) else order_col))


def _group_stats(n: str, keys: list[str], order_col: str, gaps, leaky: bool) -> dict[str, str]:
    part = ", ".join(_q(k) for k in keys)
    if leaky:
        u = f"(PARTITION BY {part})"
        dirs = ("next", "last")
    else:
        u = f"(PARTITION BY {part} ORDER BY {_order_sql(order_col)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        dirs = ("last",)
    cols = {}
    for g in gaps:
        for f in dirs:
            x = _q(f"ts_{n}_{g}_diff_{f}")
            cols[f"ts_{n}_{g}_diff_{f}_count"] = f"count({x}) OVER {u}"
            cols[f"ts_{n}_{g}_diff_{f}_mean"] = f"avg({x}) OVER {u}"
            cols[f"ts_{n}_{g}_diff_{f}_max"] = f"max({x}) OVER {u}"
            cols[f"ts_{n}_{g}_diff_{f}_min"] = f"min({x}) OVER {u}"
    return cols


def _family_plain(df: DataFrame, key_sets: list[list[str]], order_col: str, date_col: str, gaps,
                  leaky: bool) -> DataFrame:
    """Features of key sets sharing a leading key (every group fits one task).

    Per key set three projections: (1) the eight shifts ``d(±1..±4)`` from one window ordered by the
    ordinal (each window function once); (2) first- and second-order gaps as plain arithmetic on
    them; (3) group statistics of the first-order gaps over the same partition, which the sort of (1)
    already serves. Rows without a leading key have no features, so a hash of their ordinal joins the
    partition key and spreads them over all tasks. One sort per key set; the family shares one exchange. Expressions are SQL text
    (one parse each), which keeps plan building cheap for the hundreds of columns.
    """
    reach = max(gaps) + 1  # every closed form needs d(-reach..reach)
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    df = df.withColumn("_keyless", F.when(F.col(_q(key_sets[0][0])).isNull(), F.xxhash64(*[F.col(_q(c)) for c in order])))
    for ks in key_sets:
        n = gap_name(ks)
        ok = " AND ".join(f"{_q(k)} IS NOT NULL" for k in ks)
        w = f"(PARTITION BY {', '.join(_q(k) for k in ks + ['_keyless'])} ORDER BY {_order_sql(order_col)})"
        shifts = {}
        for k in range(1, reach + 1):
            shifts[f"_d_p{k}"] = F.expr(f"lead({_q(date_col)}, {k}) OVER {w}")
            shifts[f"_d_m{k}"] = F.expr(f"lag({_q(date_col)}, {k}) OVER {w}")
        df = df.withColumns(shifts)

        def d(k: int) -> str:
            return _q(date_col) if k == 0 else (f"_d_p{k}" if k > 0 else f"_d_m{-k}")

        first = _first_order_d(n, d, gaps)
        second = _second_order_d(n, d, gaps)
        names = feature_names(ks, gaps, leaky)
        exprs = {c: e for c, e in {**first, **second}.items() if c in names or c in first}
        df = df.withColumns({c: F.expr(f"CASE WHEN {ok} THEN {e} END") for c, e in exprs.items()}) \
            .drop(*shifts)
        stats = {c: F.expr(f"CASE WHEN {ok} THEN {e} END")
                 for c, e in _group_stats(n, ks + ["_keyless"], order_col, gaps, leaky).items()}
        df = df.withColumns(stats)
        if not leaky:
            df = df.drop(*[c for c in first if c not in names])
    return df.drop("_keyless")


def _family_tasks(df: DataFrame, key_sets: list[list[str]], order_col, date_col: str, gaps, wanted: set[str] | None,
                  rows: int | None = None) -> DataFrame:
    """Features of key sets sharing a leading key (every group fits one task): one exchange by that key, then :func:`gap_rows.task` on each
    partition. Rows without a leading key have no features, so a hash of their ordinal spreads them over all tasks."""
    orders, lead = _orders(order_col), key_sets[0][0]
    features = [c for ks in key_sets for c in feature_names(ks, gaps) if wanted is None or c in wanted]
    spread = [F.col(_q(lead)), F.when(F.col(_q(lead)).isNull(), F.xxhash64(*[F.col(_q(c)) for c in orders]))]
    tasks = (rows or 0) // ROWS_PER_TASK + 1
    wide = tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gap_type = df.schema[date_col].dataType
    kinds = {"_count": T.LongType(), "_mean": T.DoubleType()}
    added = [T.StructField(c, next((t for end, t in kinds.items() if c.endswith(end)), gap_type)) for c in features]
    ship_package(df.sparkSession)
    return (df.repartition(tasks, *spread) if wide else df.repartition(*spread)).mapInArrow(
        gap_rows.task(key_sets, orders, date_col, tuple(gaps), df.columns, features), T.StructType([*df.schema.fields, *added]))


def _families_in_tasks(df: DataFrame, families: list[list[list[str]]], orders: list[str], date_col: str, gaps, out: list[str], rows: int) -> DataFrame:
    """All families, without hot groups: each task packs its wide rows for the next exchange, which moves them compressed by columns. Columns that
    are not asked for are not moved further than needed."""
    session_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(rows // ROWS_PER_TASK + 1, min(session_tasks, rows // LEAST_ROWS + 2))
    wanted, places = set(out), gap_rows.addresses(tasks)
    gap_type = df.schema[date_col].dataType
    kinds = {"_count": T.LongType(), "_mean": T.DoubleType()}
    fields = {f.name: f.dataType for f in df.schema.fields}
    to = [f"_to{i}" for i in range(len(families))]
    for t, fam in zip(to, families):
        lead = F.col(_q(fam[0][0]))
        spread = F.coalesce(F.xxhash64(lead + F.lit(0.0)) if isinstance(fields[fam[0][0]], (T.FloatType, T.DoubleType)) else F.xxhash64(lead), F.lit(0))
        spread = F.when(lead.isNull(), F.xxhash64(*[F.col(_q(c)) for c in orders])).otherwise(spread)
        df = df.withColumn(t, F.pmod(spread, F.lit(tasks)).cast("int"))
        fields[t] = T.IntegerType()
    ship_package(df.sparkSession)
    moved = None
    for i, fam in enumerate(families):
        later = {*wanted, *to[i + 1:], *orders, date_col, *(k for f in families[i:] for ks in f for k in ks)}
        fields = {c: t for c, t in fields.items() if c in later}
        schema = pa.schema([(f.name, f.type) for f in to_arrow_schema(T.StructType([T.StructField(c, t) for c, t in fields.items()]))])
        pack = gap_rows.packing(to[i], places, schema)
        if moved is None:
            moved = df.mapInArrow(pack, "to int, rows binary")
        else:
            moved = moved.mapInArrow(_after(work, pack), "to int, rows binary")
        moved = moved.repartition(tasks, "to")
        features = [c for ks in fam for c in feature_names(ks, gaps) if c in wanted]
        last = i + 1 == len(families)
        kept = [c for c in fields if not last or c in wanted]
        work = gap_rows.packed_task(fam, orders, date_col, tuple(gaps), kept, features, schema)
        fields = {c: fields[c] for c in kept} | {c: next((t for end, t in kinds.items() if c.endswith(end)), gap_type) for c in features}
    return moved.mapInArrow(work, T.StructType([T.StructField(c, t) for c, t in fields.items()]))


def _after(first, second):
    """One task that does both."""
    return lambda batches: second(first(batches))


def _first_order_d(n: str, d, gaps) -> dict[str, str]:
    cols = {}
    for g in gaps:
        cols[f"ts_{n}_{g}_diff_next"] = f"{d(g)} - {d(0)}"
        cols[f"ts_{n}_{g}_diff_last"] = f"{d(0)} - {d(-g)}"
    return cols


def _second_order_d(n: str, d, gaps) -> dict[str, str]:
    cols = {}
    for g in gaps:
        cols[f"ts_s_next_{n}_{g}_next_1"] = f"({d(g + 1)} - {d(g)}) - ({d(1)} - {d(0)})"
        cols[f"ts_s_next_{n}_{g}_last_1"] = f"({d(1)} - {d(0)}) - ({d(1 - g)} - {d(-g)})"
    for g in gaps:
        cols[f"ts_s_last_{n}_{g}_next_1"] = f"({d(g)} - {d(g - 1)}) - ({d(0)} - {d(-1)})"
        cols[f"ts_s_last_{n}_{g}_last_1"] = f"({d(0)} - {d(-1)}) - ({d(-g)} - {d(-g - 1)})"
    return cols


def gap_features(df: DataFrame, key_sets: list[list[str]], order_col="ro", date_col: str = "date",
                 gaps=GAPS, leaky: bool = True, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
                 hot: dict | None = None, out: list[str] | None = None) -> DataFrame:
    """Append the gap features of every key set.

    ``order_col`` is the row ordinal (reference semantics) or, e.g. with ``leaky=False``, a list of
    columns giving a total time order such as ``["pt_d", "log_id"]``. ``leaky=False`` keeps only
    features that look backwards: previous gaps, their running statistics, and the backward
    second-order gaps.

    Key sets sharing a leading key form a family; a hash partitioning on the leading key serves all of its key sets, so there is one
    exchange per family. Smaller families run first so that the exchanges move rows that are still narrow. The output column order
    follows ``key_sets``. ``hot`` is the output of :func:`find_hot` (computed here, on the input, when not given). ``out``: the columns of the
    result, input columns or features (default: all); others are not moved.
    """
    leads = list(dict.fromkeys(ks[0] for ks in key_sets))
    families = [sorted([ks for ks in key_sets if ks[0] == lead], key=len) for lead in leads]
    # smallest families first: their exchanges move rows before the big family widens them
    families.sort(key=len)
    if hot is None and hot_threshold is not None:
        hot = find_hot(df, key_sets, hot_threshold=hot_threshold)
    if out is None:
        out = df.columns + [c for ks in key_sets for c in feature_names(ks, gaps, leaky)]
    used = {*out, *_orders(order_col), date_col, *(k for ks in key_sets for k in ks)}
    df = df.select(*[F.col(_q(c)) for c in df.columns if c in used])
    if hot and not any(hot[lead][1] for lead in leads) and leaky and isinstance(df.schema[date_col].dataType, T.IntegralType):
        return _families_in_tasks(df, families, _orders(order_col), date_col, gaps, out, hot[leads[0]][2]).select(*[F.col(_q(c)) for c in out])
    for fam in families:
        df = _family(df, fam, order_col, date_col, gaps, leaky, hot_threshold, hot, set(out))
    return df.select(*[F.col(_q(c)) for c in out])


# --------------------------------------------------------------------------- hot groups


def find_hot(df: DataFrame, key_sets: list[list[str]], order_col: str = "ro",
             hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> dict:
    """Hot keys of every leading key, as bounded driver-side lists, and the number of rows. Run it on the *input* table (a
    scan) and pass the result on, so later steps do not recompute their upstream plan to count."""
    leads = list(dict.fromkeys(ks[0] for ks in key_sets))
    found = {lead: hot_keys(df, [lead], hot_threshold) for lead in leads}
    with ThreadPoolExecutor(len(leads) + 1) as pool:  # scans of one table, which need not wait for each other
        rows = pool.submit(df.count)
        lists = {lead: pool.submit(t.collect) for lead, t in found.items()}
        return {lead: (t.schema, lists[lead].result(), rows.result()) for lead, t in found.items()}


def _family(df: DataFrame, key_sets: list[list[str]], order_col, date_col: str, gaps, leaky: bool,
            hot_threshold: int | None, hot: dict | None = None, wanted: set[str] | None = None) -> DataFrame:
    """Route a family: groups of the leading key above ``hot_threshold`` rows take the split path,
    all other rows go by whole groups. Hot keys are at most ``N / hot_threshold``, so their table is
    brought to the driver and broadcast with a proven bound. Without hot keys the plan is the plain
    one."""
    lead = key_sets[0][0]
    schema, rows, n = hot[lead] if hot is not None and hot_threshold is not None else (None, [], None)

    def whole_groups(some: DataFrame) -> DataFrame:
        if leaky and isinstance(df.schema[date_col].dataType, T.IntegralType):
            return _family_tasks(some, key_sets, order_col, date_col, gaps, wanted, n)
        return _family_plain(some, key_sets, order_col, date_col, gaps, leaky)
    if not rows:
        return whole_groups(df)
    hot_small = df.sparkSession.createDataFrame(rows, schema)
    # both routes read the input: materialise it once (reliable checkpoint, not recomputed per route)
    df = cut_lineage(df)
    cold_out = whole_groups(df.join(F.broadcast(hot_small.select(lead)), lead, "left_anti"))
    hot_rows = df.join(F.broadcast(hot_small.select(lead)), lead, "left_semi")
    hot_out = _family_hot(hot_rows, key_sets, order_col, date_col, gaps, hot_threshold, leaky)
    return cold_out.unionByName(hot_out.select(*cold_out.columns))


def _orders(order_col) -> list[str]:
    return [order_col] if isinstance(order_col, str) else list(order_col)


def _family_hot(h: DataFrame, key_sets: list[list[str]], order_col, date_col: str, gaps, threshold: int,
                leaky: bool = True) -> DataFrame:
    """Gap features for rows of hot leading keys.

    Each hot key's rows are cut into ordinal ranges (``_sb``) of ``threshold`` rows by their exact rank in
    the key, so uneven ordinals (test rows after a wide gap) give even ranges and every
    window partition ``(keys, _sb)`` is bounded. Shifts that cross a range edge come from a second
    window over the *edge rows* only (the first and last ``max(gaps) + 1`` rows of each range); group statistics are aggregated per group (map-side
    combined) and joined back on ``(keys, _sb)``, so no join key is hot either. Results are narrow
    ``(ordinal, features)`` tables joined to the hot rows on the unique ordinal.
    """
    keys = list(dict.fromkeys(k for ks in key_sets for k in ks))
    # every key set branches from these narrow rows: materialise them once
    orders = _orders(order_col)
    narrow = cut_lineage(hot_ranges(h.select(*dict.fromkeys([*orders, date_col, *keys])), key_sets[0][0], order_col, threshold))
    out = h
    for ks in key_sets:
        found = _hot_keyset(narrow, ks, order_col, date_col, gaps, leaky)
        found = found.withColumnsRenamed({c: f"_of_{c}" for c in orders})
        same = reduce(lambda a, b: a & b, [out[c].eqNullSafe(found[f"_of_{c}"]) for c in orders])
        out = out.join(found, same, "left").drop(*[f"_of_{c}" for c in orders])
    return out


def hot_ranges(rows: DataFrame, lead: str, order_col, threshold: int) -> DataFrame:
    """Add ``_sb``: the number of the row's range of ``threshold`` consecutive rows of its key."""
    orders = _orders(order_col)
    ranked = global_rank(rows, orders, F.col(orders[0]), [lead], out="_pos")
    return ranked.withColumn("_sb", F.floor(F.col("_pos") / threshold).cast("long")).drop("_pos")


def _hot_keyset(narrow: DataFrame, ks: list[str], order_col, date_col: str, gaps, leaky: bool = True) -> DataFrame:
    n, reach, orders = gap_name(ks), max(gaps) + 1, _orders(order_col)
    part = ", ".join(_q(k) for k in ks + ["_sb"])
    w = f"(PARTITION BY {part} ORDER BY {_order_sql(order_col)})"
    shifts = {"_rn": F.expr(f"row_number() OVER {w}"), "_cnt": F.expr(f"count(1) OVER (PARTITION BY {part})")}
    for k in range(1, reach + 1):
        shifts[f"_b{k}"] = F.expr(f"lead({_q(date_col)}, {k}) OVER {w}")
        shifts[f"_b_{k}"] = F.expr(f"lag({_q(date_col)}, {k}) OVER {w}")
    b = narrow.select(*dict.fromkeys([*ks, "_sb", *orders, date_col])).withColumns(shifts)
    edge = b.where((F.col("_rn") <= reach) | (F.col("_rn") > F.col("_cnt") - reach)) \
        .select(*ks, "_sb", "_rn", *[c for c in dict.fromkeys([*orders, date_col]) if c not in ks])
    ew = f"(PARTITION BY {', '.join(_q(k) for k in ks)} ORDER BY {_order_sql(order_col)})"
    at = [*ks, "_sb", "_rn"]  # a row's place in its group
    e = edge.select(*[F.col(c).alias(f"_at_{c}") for c in at], *[F.expr(f"{fn}({_q(date_col)}, {k}) OVER {ew}").alias(f"_e{'' if fn == 'lead' else '_'}{k}")
                                 for k in range(1, reach + 1) for fn in ("lead", "lag")])
    fixed = b.join(e, reduce(lambda x, y: x & y, [b[c].eqNullSafe(e[f"_at_{c}"]) for c in at]), "left").drop(*[f"_at_{c}" for c in at])

    def d(k: int) -> str:
        if k == 0:
            return _q(date_col)
        tag = f"{k}" if k > 0 else f"_{-k}"
        cross = f"_rn + {k} > _cnt" if k > 0 else f"_rn + {k} < 1"
        return f"(CASE WHEN {cross} THEN _e{tag} ELSE _b{tag} END)"

    first = _first_order_d(n, d, gaps)
    second = _second_order_d(n, d, gaps)
    names = feature_names(ks, gaps, leaky)
    if not leaky:
        return _hot_running(fixed, ks, orders, {c: x for c, x in first.items() if c.endswith("_last")},
                            {c: x for c, x in second.items() if c in names}, names, w)
    f = fixed.select(*[c for c in dict.fromkeys([*ks, "_sb", *orders])], *[F.expr(e).alias(c) for c, e in {**first, **second}.items()])
    aggs = []
    for c in first:
        aggs += [F.count(c).alias(f"{c}_count"), F.sum(c).alias(f"{c}__sum"), F.max(c).alias(f"{c}_max"),
                 F.min(c).alias(f"{c}_min")]
    stats = f.groupBy(*ks).agg(*aggs)
    ranges = f.select(*ks, "_sb").distinct()
    st = ranges.join(stats, ks, "inner")  # one row per (group, range)
    res = f.join(st, ks + ["_sb"], "left")
    ok = " AND ".join(f"{_q(k)} IS NOT NULL" for k in ks)
    cols = {}
    for c in first:
        cols[f"{c}_mean"] = F.col(f"{c}__sum") / F.col(f"{c}_count")
    res = res.withColumns(cols)
    return res.select(*orders, *[F.expr(f"CASE WHEN {ok} THEN {_q(c)} END").alias(c) for c in names])


def _hot_running(fixed: DataFrame, ks: list[str], orders: list[str], first: dict, second: dict, names: list[str], w: str) -> DataFrame:
    """Backward gaps of hot rows with their running count, mean, max and min, carried over the ranges."""
    f = fixed.select(*dict.fromkeys([*ks, "_sb", *orders]), *[F.expr(x).alias(c) for c, x in {**first, **second}.items()])
    run = f"{w[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    kinds = {"count": "count", "sum": "sum", "max": "max", "min": "min"}
    inside = f.withColumns({f"_in_{k}_{c}": F.expr(f"{fn}({_q(c)}) OVER {run}") for c in first for k, fn in kinds.items()})
    totals = f.groupBy(*ks, "_sb").agg(*[F.expr(f"{fn}({_q(c)})").alias(f"_{k}_{c}") for c in first for k, fn in kinds.items()])
    # one row per group and range; the ranges of one key are as many as its rows by the threshold
    before = f"(PARTITION BY {', '.join(_q(k) for k in ks)} ORDER BY _sb ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    over = {"count": "sum", "sum": "sum", "max": "max", "min": "min"}
    carry = totals.select(*[F.col(k).alias(f"_at_{k}") for k in [*ks, "_sb"]], *[
        F.expr(f"{over[k]}({_q(f'_{k}_{c}')}) OVER {before}").alias(f"_ca_{k}_{c}") for c in first for k in kinds])
    same = reduce(lambda a, b: a & b, [inside[k].eqNullSafe(carry[f"_at_{k}"]) for k in [*ks, "_sb"]])
    both = inside.join(carry, same, "left")

    def part(kind: str, c: str):
        return F.col(f"_in_{kind}_{c}"), F.col(f"_ca_{kind}_{c}")
    cols = {}
    for c in first:
        n, total = (F.coalesce(part(k, c)[0], F.lit(0)) + F.coalesce(part(k, c)[1], F.lit(0)) for k in ("count", "sum"))
        cols |= {f"{c}_count": n, f"{c}_mean": F.when(n > 0, total / n), f"{c}_max": F.greatest(*part("max", c)), f"{c}_min": F.least(*part("min", c))}
    ok = " AND ".join(f"{_q(k)} IS NOT NULL" for k in ks)
    res = both.withColumns(cols)
    return res.select(*orders, *[F.expr(f"CASE WHEN {ok} THEN {_q(c)} END").alias(c) for c in names])
