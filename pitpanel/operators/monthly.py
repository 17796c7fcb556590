"""Factors and wealth paths kept period by period: a new period is built from the state at the
end of the one before and its own rows, and a late change redoes its own keys and periods only.

Each part (period, bucket of entities) of the result is noted with a hash of the chain of
panel parts that it rests on. A part whose chain has changed is due, and so are all later
ones of its bucket. Parts that become due together are built in one job.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ContractError
from ..sources.shared import stored
from ..sources.store import Key, Store
from . import index as ix
from . import segments as sg

PANEL = "permno long, date date, session_index long, price_raw double, ret_total_backtest double, ret_total_for_signal double, delist_flag string"
FACTORS = (
    "permno long, date date, session_index long, ret_total_for_signal double, economic_series_ended boolean, has_required_history boolean, momentum double, "
    "index_anchor_date date, wealth_index double, index_status string"
)
STATE = "permno long, date date, _ended boolean, _seed date, _last long, _broken_before long, _lost_before long, _growth_before double"


def chains(panel: Store, lookback: int) -> dict[Key, str]:
    """For each part of the panel, and each bucket in each period since its first, a hash of all
    that the results there depend on."""
    _, parts = panel.ledger()
    periods, out = sorted({p for p, _ in parts}), {}
    for bucket in {b for _, b in parts}:
        before = f"lookback {lookback}"
        for period in periods:
            part = parts.get((period, bucket))
            before = hashlib.sha256(f"{before} {part.content if part else ''}".encode()).hexdigest()
            out[period, bucket] = before
    return out


def merged(df: DataFrame, states: dict, before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``segments.scanned`` that begins with stored states, and the states after each segment."""
    own = df.groupBy(sg.KEY, "_segment").agg(*(value.alias(name) for name, (value, _) in states.items()))
    line = own.unionByName(before.select(sg.KEY, "_segment", *states))
    w = Window.partitionBy(sg.KEY).orderBy("_segment")
    upto = {end: {name: getattr(F, how)(name).over(w.rowsBetween(Window.unboundedPreceding, end)) for name, (_, how) in states.items()} for end in (-1, 0)}
    earlier, after = (line.select(sg.KEY, "_segment", *(c.alias(name) for name, c in upto[end].items())) for end in (-1, 0))
    return df.join(earlier.hint("merge"), [sg.KEY, "_segment"], "left"), after


def built(rows: DataFrame, halo: DataFrame, before: DataFrame, lookback: int, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Factors of panel rows with ``_segment``, given the factors of the last sessions before and
    the states there; and the states after each segment, of entities that have rows in it.
    ``keep`` writes a step's rows, as each of the next ones reads them twice or more."""
    found, after_end = merged(rows, {"_ended": (F.bool_or(sg.ending()), "bool_or")}, before)
    ended = keep(sg.ended_after(found).drop("_ended"), "ended")
    first, after_seed = merged(ended, {"_seed": (F.min(ix.seedable()), "min"), "_last": (F.max("session_index"), "max")}, before)
    marked, steps = keep(sg.seeded(first), "seeded"), ix.steps()
    summed, after_sum = merged(marked, {n + "_before": (F.sum(step), "sum") for n, step in steps.items()}, before)
    path = ix.path_of(sg.totals(summed, steps))
    # momentum looks back over all rows at hand; those of the halo only lend their returns
    own = ended.select("permno", "date", "session_index", "ret_total_for_signal", "economic_series_ended", F.lit(False).alias("_halo"))
    lent = halo.select("permno", "date", "session_index", "ret_total_for_signal", "economic_series_ended", F.lit(True).alias("_halo"))
    factors = sg.windowed(own.unionByName(lent).withColumn("_segment", F.lit(0)), lookback).drop("_segment")
    out = factors.join(path.drop("session_index"), ["permno", "date"])
    keys = [sg.KEY, "_segment"]
    return out, after_end.join(after_seed, keys).join(after_sum, keys)


def every_period(states: DataFrame, periods: list[int]) -> DataFrame:
    """A row for each entity and period from its first on, its state carried over periods
    without rows."""
    until = F.coalesce(F.lead("_segment").over(Window.partitionBy(sg.KEY).orderBy("_segment")), F.lit(periods[-1] + 1))
    listed = F.filter(F.array(*map(F.lit, periods)), lambda p: (p >= F.col("_segment")) & (p < F.col("_until")))
    return states.withColumn("_until", until).withColumn("_segment", F.explode(listed)).drop("_until")


def update(panel: Store, factors: Store, states: Store, lookback: int) -> set[Key]:
    """Bring ``factors`` and ``states`` to where ``panel`` is; the parts that were built.

    The panel's parts of periods before the first change of a bucket are not read: what they
    contribute lies in the state at the end of the last of them, and the returns that a window
    looks back on in the factors of as many periods as the lookback reaches over.
    """
    if len({(s.key, s.period, s.buckets) for s in (panel, factors, states)}) > 1:
        raise ContractError("panel, factors and states must be cut into the same parts")
    due, (_, done) = chains(panel, lookback), states.ledger()
    periods = sorted({p for p, _ in due})
    groups: dict[int, list[int]] = defaultdict(list)
    for bucket in sorted({b for _, b in due}):
        late = [p for p in periods if (p, bucket) not in done or done[p, bucket].note != due[p, bucket]]
        if late:
            groups[late[0]].append(bucket)
    built_keys: set[Key] = set()
    for start, buckets in sorted(groups.items()):
        now, past = [p for p in periods if p >= start], [p for p in periods if p < start]
        keys = [(p, b) for p in now for b in buckets]
        rows = panel.read(PANEL, keys).withColumn("_segment", panel.period.of(F.col("date")))
        before = states.read(STATE, [(past[-1], b) for b in buckets] if past else []).withColumn("_segment", F.lit(start - 1)).drop("date")
        first = rows.agg(F.min("session_index")).first()[0]
        halo = factors.read(FACTORS, [(p, b) for p in past[-lookback:] for b in buckets]) if first is not None else factors.read(FACTORS, [])
        halo = halo.where(F.col("session_index") > F.lit(first) - lookback)
        keep = lambda df, name: stored(panel.spark, df, f"monthly-{name}")
        out, after = built(rows, halo, before, lookback, keep)
        dense = every_period(after, [start - 1, *now]).where(F.col("_segment") >= start)
        notes = {k: due[k] for k in keys}
        # a store reads what it is given twice: for the fingerprints and to write
        factors.write(keep(out.select(*[c.split()[0] for c in FACTORS.split(", ")]), "factors"), keys, notes)
        dated = dense.withColumn("date", panel.period.first(F.col("_segment")))  # stands for its period
        states.write(keep(dated.select(*[c.split()[0] for c in STATE.split(", ")]), "states"), keys, notes)
        built_keys |= set(keys)
    return built_keys
