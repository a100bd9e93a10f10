"""Exponentially weighted means as a block scan.

With q = 1 - 2 / (span + 1) the mean at slot t is
sum(q^(t-j) x[j]) / sum(q^(t-j)) over the known x[j], j <= t. Inside a block both sums
are running sums of x * q^-p and q^-p, p the position in the block, because the
factor q^p cancels. Earlier blocks enter as their end sums times q^(length * distance);
blocks so far back that they weigh less than 1e-17 of any value in the block are left
out, which is below double precision. Where a block has no value yet the mean is that of
the last slot which had one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import (
    BLOCK_SLOTS,
    KEYS,
    drop_blocks,
    join_carry,
    over,
    slot_index,
    with_blocks,
)

DIGITS = 17
# q^-p must stay well inside the range of a double, whatever the values' size.
SAFE_EXPONENT = 250


class Ewm(NamedTuple):
    """One output column: the mean of ``column`` with the given span (> 1)."""

    name: str
    column: str
    span: float

    @property
    def decay(self) -> float:
        return 1 - 2 / (self.span + 1)


def block_length(specs: Sequence[Ewm], longest: int = BLOCK_SLOTS, unit: int = 96) -> int:
    """The longest block, in whole days if possible, on which no weight overflows."""
    steepest = min(spec.decay for spec in specs)
    if steepest <= 0:
        raise ValueError("span must exceed 1")
    limit = int(SAFE_EXPONENT * math.log(10) / -math.log(steepest))
    fitting = min(longest, limit)
    return max(1, fitting - fitting % unit if fitting >= unit else fitting)


def _weight(spec: Ewm, length: int) -> str:
    return f"if({spec.column} is null, null, power({1 / spec.decay!r}D, _idx - _blk * {length}))"


def _distances(spec: Ewm, length: int) -> range:
    """How many earlier blocks still carry weight."""
    slots = DIGITS * math.log(10) / -math.log(spec.decay)
    return range(1, max(1, math.ceil(slots / length)) + 1)




def _carries(
    blocked: DataFrame,
    specs: Sequence[Ewm],
    keys: Sequence[str],
    length: int,
    state: DataFrame | None = None,
) -> DataFrame:
    """Per block: what the earlier blocks bring (sum, weight) and the value they hold.

    ``state`` (``ewm_state``) stands for all rows before the frame's.
    """
    sums = []
    for i, spec in enumerate(specs):
        weight = _weight(spec, length)
        sums += [
            F.expr(f"coalesce(sum({spec.column} * {weight}), 0D) as _s{i}"),
            F.expr(f"coalesce(sum({weight}), 0D) as _w{i}"),
        ]
    ends = blocked.groupBy(*keys, "_blk").agg(*sums)

    def earlier(column: str, spec: Ewm) -> str:
        return " + ".join(
            f"{spec.decay ** (length * d)!r}D * coalesce(sum({column}) "
            + over(keys, "_blk", f"range between {d} preceding and {d} preceding")
            + ", 0D)"
            for d in _distances(spec, length)
        )

    if state is not None:
        ends = ends.join(state, list(keys), "left")

    def stored(part: str, spec: Ewm) -> str:
        if state is None:
            return ""
        aged = f"power({spec.decay!r}D, _blk * {length} - {spec.name}_last)"
        return f" + coalesce({spec.name}_{part} * {aged}, 0D)"

    brought = ends.selectExpr(
        "*",
        *[f"{earlier(f'_s{i}', spec)}{stored('sum', spec)} as _bs{i}" for i, spec in enumerate(specs)],
        *[f"{earlier(f'_w{i}', spec)}{stored('weight', spec)} as _bw{i}" for i, spec in enumerate(specs)],
    )

    def before(spec: Ewm) -> str:
        return "" if state is None else f", {spec.name}_sum / {spec.name}_weight"

    # The last value of the nearest earlier block that has one, for holes beyond a block.
    held = over(keys, "_blk", "rows between unbounded preceding and 1 preceding")
    return brought.selectExpr(
        *keys,
        "_blk",
        *[
            expr
            for i in range(len(specs))
            for expr in (
                f"_bs{i}",
                f"_bw{i}",
                f"coalesce(last(if(_w{i} > 0, (_s{i} + _bs{i}) / (_w{i} + _bw{i}), null), true) "
                f"{held}{before(specs[i])}) as _hold{i}",
            )
        ],
    )


def ewm_blocked(
    blocked: DataFrame,
    specs: Sequence[Ewm],
    keys: Sequence[str],
    length: int,
    state: DataFrame | None = None,
) -> DataFrame:
    """Means on a dense frame that already has ``_idx``/``_blk`` and no halo rows."""
    upto = over([*keys, "_blk"], "_idx")
    running = []
    for i, spec in enumerate(specs):
        weight = _weight(spec, length)
        running += [
            f"sum({spec.column} * {weight}) {upto} as _rs{i}",
            f"sum({weight}) {upto} as _rw{i}",
        ]
    summed = blocked.selectExpr("*", *running)
    joined = join_carry(summed, _carries(blocked, specs, keys, length, state), keys)

    def mean(i: int, name: str) -> str:
        total = f"(_rs{i} + coalesce(_bs{i}, 0D))"
        weight = f"(_rw{i} + coalesce(_bw{i}, 0D))"
        # Without a known value in the block so far, the last value before it holds.
        return f"if(_rw{i} > 0, {total} / {weight}, _hold{i}) as {name}"

    return joined.selectExpr(
        *blocked.columns, *[mean(i, spec.name) for i, spec in enumerate(specs)]
    )


def ewm_means(
    df: DataFrame,
    specs: Sequence[Ewm],
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    length: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Add exponentially weighted means on a dense 15-minute grid, unique per slot.

    With ``state``, ``df`` need only hold the slots after those the state sums up.
    """
    size = length or block_length(specs)
    blocked = with_blocks(df, ts, length=size, keys=keys)
    return drop_blocks(ewm_blocked(blocked, specs, keys, size, state))


def ewm_state(
    df: DataFrame,
    specs: Sequence[Ewm],
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    before: DataFrame | None = None,
) -> DataFrame:
    """What later slots need of these: per series one row, whatever its length.

    For each mean the number of the last known slot and, as seen from it, the weighted sum
    and the weight. ``before`` is the state of all earlier rows; it is aged and added, so a
    run reads only the slots since the last one.
    """
    numbered = df.select("*", slot_index(F.col(ts)).alias("_idx"))
    last = {
        spec.name: F.max(F.when(F.col(spec.column).isNotNull(), F.col("_idx"))).alias(f"{spec.name}_last")
        for spec in specs
    }
    ends = numbered.groupBy(*keys).agg(*last.values())
    placed = numbered.join(ends, list(keys))
    sums = []
    for spec in specs:
        weight = F.when(
            F.col(spec.column).isNotNull(), F.pow(F.lit(spec.decay), F.col(f"{spec.name}_last") - F.col("_idx"))
        )
        sums += [
            F.any_value(f"{spec.name}_last").alias(f"{spec.name}_last"),
            F.sum(F.col(spec.column) * weight).alias(f"{spec.name}_sum"),
            F.sum(weight).alias(f"{spec.name}_weight"),
        ]
    new = placed.groupBy(*keys).agg(*sums)
    if before is None:
        return new
    both = new.alias("n").join(before.alias("o"), list(keys), "full")
    merged = []
    for spec in specs:
        final = F.greatest(f"n.{spec.name}_last", f"o.{spec.name}_last")
        merged.append(final.alias(f"{spec.name}_last"))
        for part in ("sum", "weight"):
            aged = [
                F.coalesce(
                    F.col(f"{side}.{spec.name}_{part}") * F.pow(F.lit(spec.decay), final - F.col(f"{side}.{spec.name}_last")),
                    F.lit(0.0),
                )
                for side in "no"
            ]
            merged.append(F.when(final.isNotNull(), aged[0] + aged[1]).alias(f"{spec.name}_{part}"))
    return both.select(*keys, *merged)
