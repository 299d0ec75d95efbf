"""Mixing sources to target weights by entropy balancing.

Of all document rates between 0 and a cap, those closest to 1 in relative entropy that
give each source its target of words are exponentially tilted: the rate of a
document of size x is ``exp(lambda * x / mean size)``, at most the cap, with one
multiplier for each source. The multipliers minimise a convex dual; Newton steps,
kept inside a shrinking bracket, find them. Documents of equal source and size have
equal rates, so the steps run over an exact table of (source, size, documents).

Rates become copies by a threshold for each document, its hash as a number in [0, 1):
``floor(rate + threshold)`` copies. A last search moves each source's rates by a
common factor until the words so taken are as near the target as whole documents allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.operators.skew import with_positions
from precis.session import stage_table

# The weights that sources take in turn, the mix's size and the cap.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
TOLERANCE = 1e-9
MAX_STEPS = 60
# The last search compares so many factors at once, so many times.
_TRIES, _ROUNDS = 16, 5


def source_sizes(sized: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """``(source, source_size, n_docs, weight)``; sources in code-point order, null last, take the weights in turn."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    named = sums.withColumn("_none", F.col("source").isNull()).withColumn("_name", F.coalesce("source", F.lit("")))
    turn = F.col("pos") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    return with_positions(named, ["_none", "_name"]).withColumn("weight", weight).drop("_none", "_name", "pos")


def targets(sources: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` with ``target``: shares of the whole by weight, none above ``cap`` times its source.

    What a capped source leaves is shared out by weight until no source is above
    its cap. Each round is one aggregation; only its two sums reach the driver.
    """
    sources = stage_table(sources, "sources")
    whole = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    most = F.col("source_size") * F.lit(cap)
    full, left, weight = F.lit(False), whole, None
    while True:
        capped = sources.select("weight", most.alias("most"), full.alias("full"))
        open_ = F.when(~F.col("full"), F.col("weight"))
        row = capped.agg(F.sum(open_), F.sum(F.when(F.col("full"), F.col("most"))), F.count(open_)).first()
        left, weight, n_open = whole - (row[1] or 0.0), row[0] or 0.0, row[2]
        per = left / weight if weight else 0.0
        full = F.col("weight") * F.lit(per) >= most if weight else F.lit(True)
        if sources.where(~full).count() == n_open:
            break
    target = F.when(full, most).otherwise(F.col("weight") * F.lit(per))
    return sources.withColumn("target", target.cast("double"))


def _rate(multiplier: Column, z: Column, cap: float) -> Column:
    """exp(multiplier * z), at most the cap."""
    return F.exp(F.least(F.log(F.lit(cap)), multiplier * z))


def multipliers(sized: DataFrame, goals: DataFrame, cap: float = CAP, tolerance: float = TOLERANCE) -> DataFrame:
    """``goals`` with ``mean`` and ``multiplier``, so that tilted rates give each source its target.

    Each step aggregates the table of sizes on the cluster and moves all sources at
    once: a Newton step where it stays inside the bracket that the signs so far
    leave, else the bracket's middle. A source whose target is its cap has all
    rates at the cap; one of no words has none to tilt.
    """
    goals = goals.withColumn("mean", F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1)))
    full = F.col("target") >= F.col("source_size") * F.lit(cap) * (1 - 1e-12)
    # Beyond these multipliers even the smallest size is at the cap, or all but gone.
    state = goals.select(
        "source", "target", "mean", full.alias("done"), F.lit(0.0).alias("multiplier"),
        (-F.lit(50.0) * F.greatest("mean", F.lit(1.0))).alias("low"),
        (F.log(F.lit(cap)) * F.greatest("mean", F.lit(1.0))).alias("high"),
    )
    state = stage_table(state.withColumn("multiplier", F.when(F.col("done"), F.col("high")).otherwise(0.0)), "dual")
    sizes = stage_table(sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "sizes")
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    for _ in range(MAX_STEPS):
        if not state.where(~F.col("done")).limit(1).count():
            break
        joined = sizes.alias("t").join(state.where(~F.col("done")).alias("s"), same)
        z = F.col("size") / F.col("mean")
        rate = _rate(F.col("multiplier"), z, cap)
        words = F.col("docs") * F.col("size") * rate
        slope = F.when(F.col("multiplier") * z < F.log(F.lit(cap)), words * z).otherwise(0.0)
        sums = joined.groupBy(F.col("s.source").alias("source")).agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        at = state.alias("s").join(sums.alias("t"), same, "left")
        over = F.coalesce("t.words", F.lit(0.0)) - F.col("target")
        low = F.when(over < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - over / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > low) & (newton < high)
        near = F.col("done") | F.col("t.words").isNull() | (F.abs(over) <= F.lit(tolerance) * F.col("target"))
        state = stage_table(
            at.select(
                F.col("s.source").alias("source"), "target", "mean", near.alias("done"),
                F.when(near, F.col("multiplier")).when(inside, newton).otherwise((low + high) / 2).alias("multiplier"),
                low.alias("low"), high.alias("high"),
            ),
            "dual",
        )
    return goals.alias("g").join(
        state.select(F.col("source").alias("_s"), "multiplier"), F.col("g.source").eqNullSafe(F.col("_s"))
    ).drop("_s")


def _copies(rate: Column, cap: float, threshold: Column) -> Column:
    return F.floor(F.least(rate, F.lit(cap)) + threshold).cast("long")


def mixed(
    df: DataFrame,
    key: str,
    size: str,
    source: str,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """All columns of ``df`` with ``source_size``, ``target`` and ``copies`` (0 to ``cap``) of each document.

    ``df`` is read several times: pass a table. ``size`` must hold whole numbers;
    documents of size 0 are taken once. A null source is a source of its own, the
    last. Thresholds are hashes of the key, so reruns agree; rows that repeat a key
    are copied alike, those of a null key too. An empty table gives no rows. Sources
    are joined as tables of their own; nothing but sums reaches the driver. New
    columns replace columns of ``df`` of the same names.
    """
    if cap != int(cap):
        raise ValueError("cap must be a whole number of copies")
    # 53 bits of a hash, so that the number is exact and below 1.
    threshold = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit("mix")), 11) / F.lit(float(1 << 53))
    sized = df.select(F.col(source).alias("source"), F.col(size).cast("long").alias("size"), threshold.alias("u"))
    sized = stage_table(sized, "mix-sizes")
    goals = targets(source_sizes(sized, weights), share, cap)
    goals = stage_table(multipliers(sized, goals, cap), "mix-goals")
    same = F.col("t.source").eqNullSafe(F.col("g.source"))

    # The factor's logarithm, searched on ever finer grids around the best so far.
    best, width = goals.select("source", F.lit(0.0).alias("shift")), 0.5
    for _ in range(_ROUNDS):
        grid = [width * (2 * i / (_TRIES - 1) - 1) for i in range(_TRIES)]
        known = goals.alias("g").join(best.alias("t"), same).select("g.*", "shift")
        rows = sized.where("size > 0").alias("t").join(known.alias("g"), same)
        rate = _rate(F.col("multiplier"), F.col("size") / F.col("mean"), cap)
        taken = [
            F.sum(F.col("size") * _copies(rate * F.exp(F.col("shift") + F.lit(x)), cap, F.col("u"))).alias(f"w{i}")
            for i, x in enumerate(grid)
        ]
        sums = rows.groupBy(F.col("g.source").alias("source"), "shift", "target").agg(*taken)
        tries = F.array(*[
            F.struct(
                F.abs(F.col(f"w{i}") - F.col("target")).alias("off"),
                F.lit(abs(x)).alias("step"),
                (F.col("shift") + F.lit(x)).alias("shift"),
            )
            for i, x in enumerate(grid)
        ])
        best = stage_table(sums.select("source", F.array_min(tries)["shift"].alias("shift")), "mix-shift")
        width = 2 * width / (_TRIES - 1)
    chosen = goals.alias("g").join(best.alias("t"), same, "left").select(
        F.col("g.source").alias("_source"), "source_size", "target", "mean", "multiplier",
        F.coalesce("shift", F.lit(0.0)).alias("shift"),
    )
    old = [c for c in df.columns if c not in ("source_size", "target", "copies")]
    base = df.select(*old, threshold.alias("_u"), F.col(size).cast("long").alias("_size"))
    rate = _rate(F.col("multiplier"), F.col("_size") / F.col("mean"), cap) * F.exp(F.col("shift"))
    copies = F.when(F.col("_size") > 0, _copies(rate, cap, F.col("_u"))).otherwise(F.lit(1).cast("long"))
    return base.join(chosen, F.col(source).eqNullSafe(F.col("_source"))).select(
        *old, "source_size", "target", copies.alias("copies")
    )
