"""Interpolation in time and upsampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.functions.calendar import SLOT_MINUTES, micros

from .blocks import (
    BLOCK_SLOTS,
    KEYS,
    drop_blocks,
    in_block,
    join_carry,
    over,
    with_blocks,
)
from .grid import own_grid
from .windows import fill_columns


def _edges(blocked: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per block: the nearest known point of each column before and after the block."""
    points = []
    for i, c in enumerate(columns):
        known = f"if({c} is null, null, _t)"
        points += [
            f"min({known}) as _ft{i}",
            f"min_by({c}, {known}) as _fv{i}",
            f"max({known}) as _lt{i}",
            f"max_by({c}, {known}) as _lv{i}",
        ]
    ends = blocked.groupBy(*keys, "_blk").agg(*[F.expr(p) for p in points])
    earlier = "rows between unbounded preceding and 1 preceding"
    before, after = over(keys, "_blk", earlier), over(keys, "_blk desc", earlier)
    carried = []
    for i in range(len(columns)):
        carried += [
            f"last(if(_lt{i} is null, null, struct(_lt{i} as t, _lv{i} as v)), true) {before} as _c{i}",
            f"last(if(_ft{i} is null, null, struct(_ft{i} as t, _fv{i} as v)), true) {after} as _d{i}",
        ]
    return ends.selectExpr(*keys, "_blk", *carried)


def interpolate_blocked(
    blocked: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    ts: str = "datetime",
    state: DataFrame | None = None,
) -> DataFrame:
    """Interpolation on a frame that already has ``_blk`` and no halo rows.

    ``state`` (``known_points``) stands for all rows before the frame's.
    """
    blocked = blocked.withColumn("_t", micros(F.col(ts)))
    # Looking ahead is looking back in descending order: a growing frame, not a shrinking one.
    upto, onward = over([*keys, "_blk"], "_t"), over([*keys, "_blk"], "_t desc")
    # Time and value apart: a struct would be made and copied anew for every row and column.
    near = []
    for i, c in enumerate(columns):
        known = f"if({c} is null, null, _t)"
        for side, frame in (("_p", upto), ("_n", onward)):
            near += [f"last({known}, true) {frame} as {side}t{i}", f"last({c}, true) {frame} as {side}v{i}"]
    edges = _edges(blocked, columns, keys)
    if state is not None:
        points = [F.coalesce(f"_c{i}", f"{c}_point").alias(f"_c{i}") for i, c in enumerate(columns)]
        edges = edges.join(state, list(keys), "left").select(
            *keys, "_blk", *points, *[f"_d{i}" for i in range(len(columns))]
        )
    joined = join_carry(blocked.selectExpr("*", *near), edges, keys)

    def value(i: int, c: str) -> str:
        t0, v0 = f"coalesce(_pt{i}, _c{i}.t)", f"coalesce(_pv{i}, _c{i}.v)"
        t1, v1 = f"coalesce(_nt{i}, _d{i}.t)", f"coalesce(_nv{i}, _d{i}.v)"
        inside = f"{v0} + ({v1} - {v0}) * ((_t - {t0}) / ({t1} - {t0}))"
        # After the last known point its value holds; before the first there is none.
        return f"coalesce({c}, {inside}, {v0}) as {c}"

    order = {c: i for i, c in enumerate(columns)}
    kept = [c for c in blocked.columns if c != "_t"]
    return joined.selectExpr(*[value(order[c], c) if c in order else c for c in kept])


def interpolate_time(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    length: int = BLOCK_SLOTS,
    state: DataFrame | None = None,
) -> DataFrame:
    """Fill nulls linearly in elapsed time, rows regular or not, unique per time.

    Trailing nulls take the last value, leading nulls stay. With ``state``, ``df`` need only
    hold the rows after those whose last known points the state keeps.
    """
    blocked = with_blocks(df, ts, length=length, keys=keys)
    return drop_blocks(interpolate_blocked(blocked, columns, keys, ts, state)).select(*df.columns)


def known_points(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    ts: str = "datetime",
    before: DataFrame | None = None,
) -> DataFrame:
    """The last known point of each column, one row per series; ``before`` is older state."""
    point = "struct<t:bigint,v:double>"

    def last(c: str) -> Column:
        known = F.when(F.col(c).isNotNull(), F.struct(micros(F.col(ts)).alias("t"), F.col(c).alias("v")).cast(point))
        return F.max_by(known, F.when(F.col(c).isNotNull(), F.col(ts)))

    new = df.groupBy(*keys).agg(*[last(c).alias(f"{c}_point") for c in columns])
    if before is None:
        return new
    both = new.alias("n").join(before.alias("o"), list(keys), "full")
    return both.select(
        *keys, *[F.coalesce(f"n.{c}_point", f"o.{c}_point").alias(f"{c}_point") for c in columns]
    )


def upsample(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    minutes: int = SLOT_MINUTES,
    neighbours: bool = True,
    length: int = BLOCK_SLOTS,
) -> DataFrame:
    """Interpolate, move to a regular grid, fill, interpolate again.

    With ``neighbours`` each new slot next to an observed one copies it (forward
    before backward) and only the rest is blended; without, all new slots are blended.
    """
    known = df.select(*keys, "datetime", *columns)
    observed = interpolate_time(known, columns, keys, length=length)
    # The grid needs times only, so it comes from the input and skips the interpolation.
    grid = own_grid(known, keys, minutes=minutes)
    regular = grid.join(observed.hint("merge"), [*keys, "datetime"], "left")
    step = 1 if neighbours else 0
    blocked = with_blocks(regular, "datetime", minutes, length, step, step, keys)
    if neighbours:
        filled = fill_columns(in_block(keys), columns)
        blocked = blocked.select(
            *[filled[c].alias(c) if c in filled else F.col(c) for c in blocked.columns]
        ).filter("_own")
    done = interpolate_blocked(blocked, columns, keys)
    return done.select(*keys, "datetime", *columns)
