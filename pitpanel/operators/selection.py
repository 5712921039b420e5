"""Two pools of candidates: who qualifies, who gets a place, and how both change under other weights and bounds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.shared import cut

from .score import WEIGHTS


@dataclass(frozen=True)
class Pool:
    """A pool's bound on its score, the sides of the timing bound it takes, the order of its candidates, and its caps."""

    name: str
    score: str
    least: float
    timely: bool
    order: tuple[str, ...]
    group_cap: int
    capacity: int


#: The two pools, the floors of the three dimensions, of the confidence, and the bound on timing.
STRONG = Pool("strong", "Sc", 70.0, True, ("Sc", "C", "R_safety"), 4, 20)
WAIT = Pool("wait", "B", 65.0, False, ("B", "C", "V"), 10, 50)
FLOOR, FLOORED, CONFIDENCE, TIMING = 45.0, ("M", "EQ", "FS"), 0.75, 55.0


def qualified(df: DataFrame, vetoed: str, prohibited: str, pools: tuple[Pool, ...] = (STRONG, WAIT), shift: Column | float = 0.0) -> DataFrame:
    """Adds pool (null for none) and reasons, the tests that keep a row from the pool on its side of the timing bound.

    ``shift`` is added to the bounds on scores. A null score, floor or confidence fails its test; a row on no side
    of the timing bound, without T, is in no pool. The sides exclude one another, so no row is in two pools.
    """
    by = shift if isinstance(shift, Column) else F.lit(float(shift))
    fails = lambda ok, name: F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
    floors = [fails(F.col(d) >= FLOOR, f"{d}_floor") for d in FLOORED]
    pool, reasons = F.lit(None).cast("string"), F.array(F.lit("timing_unknown"))
    for p in reversed(pools):
        side = (F.col("T") >= TIMING) if p.timely else (F.col("T") < TIMING)
        tests = [fails(F.col(p.score) >= F.lit(p.least) + by, "score"), fails(F.col("C") >= CONFIDENCE, "confidence"), *floors, fails(~F.col(vetoed), "veto"), fails(~F.array_contains(prohibited, p.name), "prohibited")]
        broken = F.array_compact(F.array(*tests))
        pool = F.when(side, F.when(F.size(broken) == 0, p.name)).otherwise(pool)
        reasons = F.when(side, broken).otherwise(reasons)
    return df.withColumns({"pool": pool, "reasons": reasons})


def first_rows(df: DataFrame, by: list[str], order: list[Column], most: int, place: str, salts: int = 32) -> DataFrame:
    """The first ``most`` rows of each group with their ``place``; the rows of a large group meet in parts first, each of which keeps so many."""
    first = lambda rows, keys, name: rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= most)
    part = first(df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))), [*by, "_salt"], "_part").drop("_part", "_salt")
    return first(part, by, place)


def selected(df: DataFrame, key: str, group: str, pools: tuple[Pool, ...] = (STRONG, WAIT), per: tuple[str, ...] = ()) -> DataFrame:
    """(per, key, pool, group, comparison, group_count, state) for each row in a pool, as a scan in the pool's order decides it.

    state is selected, group_cap (its group had its places already) or capacity; group_count is how many of its group the scan had
    selected after it. ``comparison`` is the row's place in the order: three numbers, the larger first, then the key. Several
    scans, one for each value of ``per``, go by in the same pass. Only the first rows of a group, and of those the first of a pool,
    are ever put in order; the others follow from counts.
    """
    ids = [*per, key]
    by_pool = lambda pick: F.coalesce(*(F.when(F.col("pool") == p.name, pick(p)) for p in pools))
    numbers = F.struct(*(by_pool(lambda p, k=k: F.col(p.order[k])).alias(f"by_{k + 1}") for k in range(3)), F.col(key).alias("key"))
    rows = cut(df.where("pool is not null").select(*per, key, "pool", group, numbers.alias("comparison")))  # read three times below
    order = [*(F.col(f"comparison.by_{k}").desc_nulls_last() for k in (1, 2, 3)), F.col("comparison.key").asc()]
    cap, room = by_pool(lambda p: F.lit(p.group_cap)), by_pool(lambda p: F.lit(p.capacity))
    # The scan skips full groups, so numbering what the caps leave gives the same places.
    leading = first_rows(rows, [*per, "pool", group], order, max(p.group_cap for p in pools), "_g").where(F.col("_g") <= cap)
    placed = first_rows(leading, [*per, "pool"], order, max(p.capacity for p in pools), "_p").where(F.col("_p") <= room)
    held = placed.groupBy(*per, "pool", group).agg(F.count(F.lit(1)).alias("_held"))
    chosen = placed.select(*ids, F.col("_g").alias("_rank"))
    out = rows.join(chosen, ids, "left").join(held, [*per, "pool", group], "left")
    # A row that wasn't taken met a full group if its group has all its places in the end; else the pool was full before the group was.
    state = F.when(F.col("_rank").isNotNull(), "selected").when(F.col("_held") >= cap, "group_cap").otherwise("capacity")
    count = F.coalesce("_rank", "_held", F.lit(0)).cast("long")
    return out.select(*ids, "pool", group, "comparison", count.alias("group_count"), state.alias("state"))


def scenario_rows(step: float = 0.05, bound: float = 10.0, weights: dict[str, float] | None = None) -> list[tuple]:
    """(scenario, shift, weight of each dimension): the base, each dimension's weight moved by ``step`` either way with the others in proportion, and the bounds moved by ``bound``."""
    base = weights or WEIGHTS
    out = [("base", 0.0, *base.values()), (f"bounds{bound:+g}", bound, *base.values()), (f"bounds{-bound:+g}", -bound, *base.values())]
    for d in base:
        for s in (step, -step):
            rest = (1 - base[d] - s) / (1 - base[d])
            out.append((f"{d}{100 * s:+g}", 0.0, *(base[n] + s if n == d else base[n] * rest for n in base)))
    return out


def with_scenarios(df: DataFrame, rows: list[tuple], weights: dict[str, float] | None = None) -> DataFrame:
    """Each row once for each scenario, with scenario, shift and w_<dimension>; the scenarios are a literal array, so nothing is joined."""
    names = list(weights or WEIGHTS)
    cases = F.array(*(F.struct(F.lit(r[0]).alias("scenario"), F.lit(float(r[1])).alias("shift"), *(F.lit(float(w)).alias(f"w_{n}") for n, w in zip(names, r[2:], strict=True))) for r in rows))
    return df.withColumn("_case", F.explode(cases)).select("*", "_case.*").drop("_case")


def membership_changes(decisions: DataFrame, key: str, base: str = "base") -> DataFrame:
    """(scenario, key, before, after, change) for each row that a scenario selects or the base does: enters, leaves, moves or stays.

    Only selected rows, bounded by the pools' capacities for each scenario, take part.
    """
    own = decisions.where("state = 'selected'").select("scenario", key, "pool")
    cases = decisions.where(F.col("scenario") != base).select("scenario").distinct()
    before = own.where(F.col("scenario") == base).select(key, F.col("pool").alias("before"))
    due = before.join(F.broadcast(cases))  # at most the capacities times the scenarios
    after = own.where(F.col("scenario") != base).withColumnRenamed("pool", "after")
    both = due.join(after, ["scenario", key], "full_outer")
    change = F.when(F.col("before").isNull(), "enters").when(F.col("after").isNull(), "leaves").when(F.col("before") != F.col("after"), "moves").otherwise("stays")
    return both.select("scenario", key, "before", "after", change.alias("change"))
