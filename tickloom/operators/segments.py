"""Windows over series of any length.

`Window.partitionBy(series)` puts a whole series into one task. That is right
for the usual case of many short series, but one series may hold a large part
of the table. `lay_out` counts rows per series and cuts only the series above
`max_rows` into consecutive segments, each carrying a halo of the rows that
bounded frames reach back (or ahead) to. Windows then run per segment, and
`finish` drops the halo copies, so results are those of the uncut series.

All frames count rows, so cuts and halos are placed by row position: a pass
over (series, time slot) counts gives the position of each slot, and a small
routing table says which segments a slot's rows go to. Rows of one time, or
without one, share a slot that no width narrows; if they are too many for a
segment, the slot is split by a hash of the row, which then orders its rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from tickloom.operators.sizing import broadcast_if_small, is_small
from tickloom.schema import SERIES, TIME
from tickloom.session import stage

SEGMENT, CORE, BASE, TOTAL = "_segment", "_core", "_base", "_total"
SLOT, SUB, TIE, BITS = "_slot", "_sub", "_tie", "_bits"
KEY, KEY_SLOT, KEY_SUB = "_key", "_key_slot", "_key_sub"
FIRST_PREFIX = "_first_"
NO_TIME = -(1 << 62)  # slot of rows without a time; nulls sort first, so does this
UNCOUNTED = 1 << 62  # as `small_bytes`: nothing is counted
STAMPS = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class SegmentLimits:
    """When and how series are cut.

    `max_rows` is the most rows of one series a segment aims at. Inputs below
    `small_bytes` (default: a quarter of a scan split) are not counted at all. The first
    slot width is in days for dates and in seconds for timestamps; it is
    refined until slots are small against a segment.

    `ties` are columns that decide between rows of one time: with them the
    order of a series is defined up to equal values, cut or not. Without them
    rows of one time come in any order.
    """

    max_rows: int = 500_000
    small_bytes: int | None = None
    slot_days: int = 32
    slot_seconds: int = 1 << 15
    ties: tuple[str, ...] = ()


def limits_for(df: DataFrame, series: str = SERIES, limits: SegmentLimits | None = None) -> SegmentLimits:
    """Limits for all frames that hold rows of `df` only: if no series of it is long, no step need count them again."""
    limits = limits or SegmentLimits()
    if is_small(df, limits.small_bytes):
        return limits
    longest = df.groupBy(series).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return limits if longest > limits.max_rows else replace(limits, small_bytes=UNCOUNTED)


@dataclass(frozen=True)
class SeriesLayout:
    """A frame ready for per-series windows."""

    df: DataFrame
    keys: tuple[str, ...]
    time: str
    tied: bool = False

    @property
    def is_cut(self) -> bool:
        return SEGMENT in self.keys

    @property
    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.time, *([TIE] if self.tied else []))

    def last_rows(self, n: int) -> WindowSpec:
        """The current row and the n-1 before it."""
        return self.ordered.rowsBetween(1 - n, Window.currentRow)

    def position(self) -> Column:
        """1-based row number in the whole series."""
        number = F.row_number().over(self.ordered).cast("long")
        return F.coalesce(F.col(BASE), F.lit(0)) + number if self.is_cut else number

    def length(self) -> Column:
        """Number of rows in the whole series."""
        count = F.count(F.lit(1)).over(Window.partitionBy(*self.keys))
        return F.coalesce(F.col(TOTAL), count) if self.is_cut else count

    def first(self, name: str) -> Column:
        """A column's value in the first row of the series. `name` must be
        among the `firsts` given to `lay_out`."""
        local = F.first(name).over(self.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        if not self.is_cut:
            return local
        return F.when(F.col(TOTAL).isNotNull(), F.col(FIRST_PREFIX + name)).otherwise(local)

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop halo copies and helper columns from a frame derived from `df`."""
        if not self.is_cut:
            return df.drop(TIE) if self.tied else df
        helpers = [c for c in df.columns if c in (SLOT, SUB, TIE, SEGMENT, CORE, BASE, TOTAL) or c.startswith(FIRST_PREFIX)]
        return df.filter(F.col(CORE)).drop(*helpers)


def _slot_of(df: DataFrame, time: str, width: int) -> Column:
    kind = df.select(time).schema[0].dataType
    if isinstance(kind, STAMPS):
        number = F.unix_micros(F.col(time).cast("timestamp"))
    else:
        number = F.unix_date(F.col(time).cast("date")).cast("long")
    return F.coalesce(F.floor(number / F.lit(width)), F.lit(NO_TIME))


def _join_small(df: DataFrame, side: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    """Join a staged side, broadcast if its size allows. Keys compare
    null-safe: rows without a series form a series too."""
    same = [F.col(left).eqNullSafe(F.col(right)) for left, right in on.items()]
    joined = df.join(broadcast_if_small(side), same, how)
    return joined.drop(*on.values())


def _tie(df: DataFrame, ties: tuple[str, ...]) -> Column:
    """A hash of the tie columns, by default of all columns of plain types."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, (T.AtomicType, T.NullType)) and not isinstance(f.dataType, T.VariantType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in ties or plain])


def _with_sub(df: DataFrame, series: str, full: DataFrame | None) -> DataFrame:
    """Adds the part of a full slot that a row's hash falls into, 0 elsewhere. Parts follow the order of the hash."""
    if full is None:
        return df.withColumn(SUB, F.lit(0).cast("long"))
    df = _join_small(df, full, {series: KEY, SLOT: KEY_SLOT}, "left")
    return df.withColumn(SUB, F.when(F.col(BITS).isNull(), F.lit(0)).otherwise(F.expr(f"shiftright({TIE}, 64 - {BITS})"))).drop(BITS)


def _count_slots(df, hot, series, time, firsts, limits) -> tuple[DataFrame, int, DataFrame | None]:
    """Rows per (series, slot, part) of the long series, the width of a slot, and the slots that are split.

    Slots are narrowed until the fullest one is at most half a segment or as
    narrow as time allows. Slots of a single time, or of none, that are still
    too full are split into 2**bits parts by the hash of the row.
    """
    kind = df.select(time).schema[0].dataType
    stamped = isinstance(kind, STAMPS)
    width = limits.slot_seconds * 1_000_000 if stamped else limits.slot_days
    long_rows = _join_small(df.select(series, time, TIE, *firsts), hot, {series: KEY}, "left_semi")
    room, faster = max(limits.max_rows // 2, 1), 1

    def counted(rows: DataFrame, tied: bool) -> DataFrame:
        order = F.struct(time, TIE) if tied else F.struct(time)
        first = [F.min_by(c, order).alias(FIRST_PREFIX + c) for c in firsts]
        return stage(rows.groupBy(series, SLOT, SUB).agg(F.count(F.lit(1)).alias("n"), *first), "slots")

    while True:
        slotted = long_rows.withColumn(SLOT, _slot_of(df, time, width))
        slots = counted(_with_sub(slotted, series, None), bool(limits.ties))
        peak = slots.filter(F.col(SLOT) != NO_TIME).agg(F.max("n")).first()[0] or 0
        if peak <= room or width == 1:
            break
        # Ties do not give way to a narrower slot, so the steps grow.
        width = max(1, width * room // (peak * faster))
        faster *= 2
    one_time = F.col(SLOT) == NO_TIME
    if width == 1 and isinstance(kind, (T.DateType, *STAMPS)):
        one_time = F.lit(True)
    bits = (F.ceil(F.log2(F.col("n") / room)) + 1).cast("int").alias(BITS)
    full = stage(slots.filter(one_time & (F.col("n") > room)).select(F.col(series).alias(KEY), F.col(SLOT).alias(KEY_SLOT), bits), "full-slots")
    if full.isEmpty():
        return slots, width, None
    return counted(_with_sub(slotted, series, full), True), width, full


def _route(slots: DataFrame, series: str, least: int, before: int, after: int, firsts) -> DataFrame:
    """One row per (slot, segment its rows go to).

    A series is cut at a stride of at least `least` rows and twice its own
    fullest slot. With that and twice the halo, segment starts lie further
    apart than a halo is long, so a slot serves at most its own segment and the
    two next to it.
    """
    by_series = Window.partitionBy(series)
    running = by_series.orderBy(SLOT, SUB)
    placed = slots.select(
        "*",
        F.sum("n").over(by_series).alias(TOTAL),
        F.coalesce(F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        *[F.first(FIRST_PREFIX + c).over(running).alias("_whole" + FIRST_PREFIX + c) for c in firsts],
    ).drop(*[FIRST_PREFIX + c for c in firsts])
    placed = placed.withColumn("end", F.col("start") + F.col("n"))
    stride = F.greatest(F.lit(least), 2 * F.max("n").over(by_series))
    placed = placed.withColumn(SEGMENT, F.floor(F.col("start") / stride))
    segment = Window.partitionBy(series, SEGMENT)
    placed = placed.withColumn("seg_start", F.min("start").over(segment))
    placed = placed.withColumn("seg_end", F.max("end").over(segment))
    to_next = (F.col("seg_end") - F.col("end") < before) & (F.col("seg_end") < F.col(TOTAL))
    to_previous = (F.col("start") - F.col("seg_start") < after) & (F.col("seg_start") > 0)
    targets = F.filter(
        F.array(
            F.struct(F.col(SEGMENT).alias("to"), F.lit(True).alias("core"), F.lit(True).alias("goes")),
            F.struct((F.col(SEGMENT) + 1).alias("to"), F.lit(False).alias("core"), to_next.alias("goes")),
            F.struct((F.col(SEGMENT) - 1).alias("to"), F.lit(False).alias("core"), to_previous.alias("goes")),
        ),
        lambda t: t["goes"],
    )
    routed = placed.withColumn("target", F.explode(targets))
    return routed.select(
        F.col(series).alias(KEY),
        F.col(SLOT).alias(KEY_SLOT),
        F.col(SUB).alias(KEY_SUB),
        F.col("target.to").alias(SEGMENT),
        F.col("target.core").alias(CORE),
        F.min("start").over(Window.partitionBy(series, F.col("target.to"))).alias(BASE),
        TOTAL,
        *[F.col("_whole" + FIRST_PREFIX + c).alias(FIRST_PREFIX + c) for c in firsts],
    )


def lay_out(
    df: DataFrame,
    before: int = 0,
    after: int = 0,
    firsts: tuple[str, ...] = (),
    series: str = SERIES,
    time: str = TIME,
    limits: SegmentLimits | None = None,
) -> SeriesLayout:
    """Prepare a frame for windows per series.

    `before` and `after` are the numbers of rows that frames reach back and
    ahead; `firsts` are columns whose first value in the series is needed.
    """
    limits = limits or SegmentLimits()
    if limits.ties:
        df = df.withColumn(TIE, _tie(df, limits.ties))
    whole = SeriesLayout(df, (series,), time, bool(limits.ties))
    if is_small(df, limits.small_bytes):
        return whole
    hot = stage(
        df.groupBy(series).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limits.max_rows).select(F.col(series).alias(KEY)),
        "long-series",
    )
    if hot.isEmpty():
        return whole
    hashed = df if limits.ties else df.withColumn(TIE, _tie(df, ()))
    slots, width, full = _count_slots(hashed, hot, series, time, firsts, limits)
    least = max(limits.max_rows, 2 * max(before, after, 1))
    routes = stage(_route(slots, series, least, before, after, firsts), "routes")
    tied = bool(limits.ties) or full is not None
    rows = (hashed if tied else df).withColumn(SLOT, _slot_of(df, time, width))
    cut = _join_small(_with_sub(rows, series, full), routes, {series: KEY, SLOT: KEY_SLOT, SUB: KEY_SUB}, "left")
    cut = cut.withColumn(SEGMENT, F.coalesce(SEGMENT, F.lit(0))).withColumn(CORE, F.coalesce(CORE, F.lit(True)))
    return SeriesLayout(cut, (series, SEGMENT), time, tied)
