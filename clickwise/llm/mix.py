"""Mixing sources to target weights: Pfair scheduling of source blocks.

Each source's rows are put in a seeded hash order and cut into blocks of ``block_rows``. With integer
weights w of sum W, block j (from 0) of a source is released at slot floor(j*W/w) and due by slot
ceil((j+1)*W/w); in every slot the released block with the earliest deadline goes next. All deadlines are
met, so after any slot each source is less than one block away from its target share. The schedule repeats
after W slots, so it is worked out once for the weights (a table of W slots, whatever the data's size) and
every row computes its slot from its block number. When a source has no blocks left, a new phase begins in
which the others share by their own weights; every row is placed, none repeated.

Sources outside the weight table, and null sources, form one class of their own (``rest_weight``). Repeated
rows get places of their own; null, empty or very long texts do not matter here (a text is hashed at most). Equal deadlines go to
the smallest class name. An empty table gives no rows. Only the
id and source columns (and the text's hash, to order rows with equal ids) are read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwise.llm.common import SEED, gcd_all, hashed_rank, scratch_table, text_key

BLOCK_ROWS = 16
REST = "(rest)"

_PHASE = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "base", "period", "weight")]
                      + [T.StructField("slots", T.ArrayType(T.LongType()))])
_PLAN = T.StructType([T.StructField("_class", T.StringType()), T.StructField("_phases", T.ArrayType(_PHASE)),
                      T.StructField("_last_slot", T.LongType()), T.StructField("_short", T.LongType())])


def edf_slots(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each class in one period, by earliest deadline first among the released blocks."""
    period = sum(weights.values())
    slots: dict[str, list[int]] = {c: [] for c in weights}
    for t in range(period):
        ready = [(-(-(len(s) + 1) * period // weights[c]), c) for c, s in slots.items()
                 if len(s) < weights[c] and len(s) * period // weights[c] <= t]
        slots[min(ready)[1]].append(t)
    return slots


def schedule(blocks: dict[str, int], weights: dict[str, int]) -> list[tuple]:
    """Phases of every class: (class, [(first block, first slot, period, weight, slots)], slot of the last block).
    Works on the block counts only: one phase for each class at most."""
    left = {c: n for c, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    phases: dict[str, list[tuple]] = {c: [] for c in left}
    last: dict[str, int] = {}
    base = 0
    while left:
        unit = gcd_all([weights[c] for c in left])
        w = {c: weights[c] // unit for c in left}
        period, slots = sum(w.values()), edf_slots(w)
        ends = {c: (n - 1) // w[c] * period + slots[c][(n - 1) % w[c]] for c, n in left.items()}
        length = min(ends.values()) + 1
        for c in list(left):
            phases[c].append((done[c], base, period, w[c], slots[c]))
            used = length // period * w[c] + sum(s < length % period for s in slots[c])
            done[c] += used
            left[c] -= used
            if left[c] == 0:
                last[c] = base + ends[c]
                del left[c]
        base += length
    return [(c, phases[c], last[c]) for c in phases]


def mix_rows(docs: DataFrame, weights: dict[str, int], rest_weight: int = 1, block_rows: int = BLOCK_ROWS,
             id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, text_key, source, mix_class, block, release, deadline, slot, position.

    ``weights``: positive integers by source; their number and sum bound the plan. ``position`` runs from 0
    without gaps in the mixed order."""
    if min([rest_weight, *weights.values()]) < 1:
        raise ValueError("weights are positive integers")
    share = {**weights, REST: rest_weight}
    known = F.col(source_col).isin(list(weights))
    rows = scratch_table(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                     text_key(F.col(text_col)).alias("text_key"),
                                     F.when(known, F.col(source_col)).otherwise(REST).alias("_class")), "mix")
    # at most one row for each weight: bounded by the parameter
    sizes = {r["_class"]: r["n"] for r in rows.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {c: ceil(n / block_rows) for c, n in sizes.items()}
    plan = [(c, phases, last, blocks[c] * block_rows - sizes[c])
            for c, phases, last in schedule(blocks, {c: share[c] for c in blocks})]
    table = F.broadcast(docs.sparkSession.createDataFrame(plan, _PLAN))
    ranked = hashed_rank(rows, ["doc_id", "text_key"], ["_class"], "_rank", seed)
    placed = (ranked.withColumn("block", F.expr(f"_rank div {block_rows}")).join(table, "_class")
              .withColumn("_p", F.expr("element_at(filter(_phases, x -> x.start <= block), -1)"))
              .withColumn("_j", F.expr("block - _p.start"))
              .withColumn("slot", F.expr("_p.base + _j div _p.weight * _p.period + get(_p.slots, cast(_j % _p.weight as int))")))
    # the last block of a class may be short; what it lacks is taken off the places behind it
    short = " + ".join(["0L", *[f"CASE WHEN slot > {last}L THEN {lack}L ELSE 0L END" for _, _, last, lack in plan if lack]])
    return placed.select(
        "doc_id", "text_key", "source", F.col("_class").alias("mix_class"), "block",
        F.expr("_p.base + _j * _p.period div _p.weight").alias("release"),
        F.expr("_p.base - (-((_j + 1) * _p.period) div _p.weight) + CASE WHEN (_j + 1) * _p.period % _p.weight = 0 THEN 0 ELSE 1 END")
        .alias("deadline"), "slot",
        F.expr(f"slot * {block_rows}L + _rank % {block_rows}L - ({short})").alias("position"))
