"""Repositioning policy table, re-aimed from a per-step agent (K1-K4).

The reference's agent learns one transition at a time in a Python dict.
Here the transitions are counted once over the whole history (one
aggregate), and the values are solved from that small table: at most |states| x
|actions| x |states| rows (12 x 3 x 12), a bound set by the state definition, not
by the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.timefn import add_seconds

ACTIONS = (P.ACTION_HOLD, P.ACTION_INFLUX, P.ACTION_MOVE_OUT)


def gap_level(gap: Column, shortage: float = P.SHORTAGE_LIMIT, surplus: float = P.SURPLUS_LIMIT) -> Column:
    """K1: Shortage / Surplus / Balanced with the action thresholds."""
    return (F.when(gap > shortage, F.lit("Shortage")).when(gap < surplus, F.lit("Surplus"))
            .otherwise(F.lit("Balanced")))


def time_of_day(hour: Column, cuts=P.TOD_CUTS) -> Column:
    """K1: Morning [6, 11), Day [11, 17), Evening [17, 22), Night otherwise."""
    m, d, e, n = cuts
    return (F.when((hour >= m) & (hour < d), F.lit("Morning"))
            .when((hour >= d) & (hour < e), F.lit("Day"))
            .when((hour >= e) & (hour < n), F.lit("Evening")).otherwise(F.lit("Night")))


def transitions(alloc: DataFrame, interval_s: int = P.INTERVAL_SECONDS, gap_col: str = "gap") -> DataFrame:
    """K2: (state, action) -> next state of the same zone one bin later,
    counted with the summed reward (revenue). The next state comes from an
    equi-join on (zone_id, time_bin + interval), not a per-zone window.
    ``gap_col`` names the gap that makes the state: the allocation's own, or the
    historical one (H13), which leaves several actions in a state."""
    s = alloc.select("time_bin", "zone_id", "action", "revenue",
                     gap_level(F.col(gap_col)).alias("gap_level"),
                     time_of_day(F.hour("time_bin")).alias("time_of_day"))
    nxt = s.select("zone_id", add_seconds(F.col("time_bin"), -interval_s).alias("time_bin"),
                   F.col("gap_level").alias("next_gap_level"), F.col("time_of_day").alias("next_time_of_day"))
    return (s.join(nxt, ["zone_id", "time_bin"])
            .groupBy("gap_level", "time_of_day", "action", "next_gap_level", "next_time_of_day")
            .agg(F.count(F.lit(1)).alias("transitions"), F.sum("revenue").alias("reward_sum")))


def solve(reward: np.ndarray, chance: np.ndarray, state: np.ndarray, gamma: float, tol: float) -> np.ndarray:
    """Values of (state, action) rows by value iteration. ``chance`` (rows, states)
    holds the share of each next state, ``state`` each row's own state. The step is a
    contraction by ``gamma``, so the distance to the fixed point is at most gamma / (1 -
    gamma) times the last change; the iteration ends when that is below ``tol`` (or
    below the rounding of the values, where a step no longer changes them)."""
    q = np.zeros(len(reward))
    while True:
        v = np.full(chance.shape[1], -np.inf)
        np.maximum.at(v, state, q)
        v[np.isneginf(v)] = 0.0                       # a state that no row leaves
        new = reward + gamma * (chance @ v)
        change = np.abs(new - q).max(initial=0.0)
        q = new
        if change * gamma / (1 - gamma) <= max(tol, 4 * np.spacing(np.abs(q).max(initial=0.0))):
            return q


def policy(trans: DataFrame, gamma: float = P.Q_GAMMA, tol: float = 1e-8) -> DataFrame:
    """K3 + K4: the value of every seen (state, action) under q = mean reward + gamma
    E[max q(next)], to within ``tol`` of that equation's solution, and the greedy action
    of each state (the first in action order on ties).

    The transition table is the one pass over the history. What reaches the driver is
    bounded by the states and actions (12 x 3 x 12 rows), not by the data."""
    if not 0 <= gamma < 1:
        raise ValueError("gamma must lie in [0, 1)")
    rows = sorted(trans.collect())
    pairs = sorted({tuple(r[:3]) for r in rows}, key=lambda p: (*p[:2], ACTIONS.index(p[2])))
    states = sorted({p[:2] for p in pairs} | {tuple(r[3:5]) for r in rows})
    at, of = {p: i for i, p in enumerate(pairs)}, {s: i for i, s in enumerate(states)}
    count, reward = np.zeros((len(pairs), len(states))), np.zeros(len(pairs))
    for r in rows:
        count[at[tuple(r[:3])], of[tuple(r[3:5])]] += r["transitions"]
        reward[at[tuple(r[:3])]] += r["reward_sum"]
    n = count.sum(1)
    state = np.array([of[p[:2]] for p in pairs], dtype=np.int64)
    q = solve(reward / n, count / n[:, None], state, gamma, tol)
    best: dict[tuple, int] = {}
    for i, p in enumerate(pairs):                     # pairs of a state are in action order
        if p[:2] not in best or q[i] > q[best[p[:2]]]:
            best[p[:2]] = i
    out = [(*p, float(q[i]), pairs[best[p[:2]]][2], int(best[p[:2]] == i)) for i, p in enumerate(pairs)]
    return trans.sparkSession.createDataFrame(
        out, "gap_level string, time_of_day string, action string, q double, greedy_action string, is_greedy int")
