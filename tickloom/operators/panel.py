"""Panel kit: ordered operators over (key, time) rows that never put a whole key in one task.

A panel row has a zero-based position within its key. Windows run over *blocks* of
consecutive positions. A bounded frame gets the rows it needs from neighbouring blocks by
copying them in (a halo), so one key may hold any share of the rows and still be spread
over as many tasks as it has blocks. Unbounded frames (running totals, fills) run inside a
block and add a carry taken from a table with one row per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

_BLK = "__blk"
_BUCKET = "__bucket"
Level = Callable[[WindowSpec], Sequence[Column]]


@dataclass(frozen=True)
class Panel:
    """Names of the key, order and position columns, and the block sizes.

    ``(keys, order)`` must be unique and the keys not NULL.
    """

    keys: tuple[str, ...] = ("ticker",)
    order: tuple[str, ...] = ("date",)
    pos: str = "pos"
    block_rows: int = 1024
    scan_rows: int = 65_536

    def block_size(self, halo: int) -> int:
        """Blocks at least eight times the halo, so copies add at most an eighth."""
        return max(self.block_rows, 8 * halo)


BARS = Panel()


def time_bucket(df: DataFrame, column: str, seconds: float = 900) -> Column:
    """A time bucket: 256 days for a date, ``seconds`` for a timestamp, else 4096 units."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(column) / 256)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(F.col(column).cast("timestamp")) / (seconds * 1e6))
    return F.floor(F.col(column) / 4096)


def bucket_seconds(df: DataFrame, panel: Panel, rows: int = 200_000) -> float:
    """A width at which the densest key has about ``rows`` rows per bucket.

    One aggregate over keys and times that returns a single number, for use when a panel of
    timestamps is stored.
    """
    at = F.unix_micros(F.col(panel.order[0]).cast("timestamp"))
    spans = df.groupBy(*panel.keys).agg(F.count(F.lit(1)).alias("n"), (F.max(at) - F.min(at) + 1).alias("us"))
    width = spans.agg(F.min(F.col("us") * rows / F.col("n"))).first()[0]
    return max(width or 1.0, 1.0) / 1e6


_BUCKETS_PER_GROUP = 512


def number_rows(df: DataFrame, panel: Panel = BARS, bucket: Column | None = None) -> DataFrame:
    """Add the position of every row within its key.

    Rows are ranked inside (key, time bucket), and a bucket starts where the counts before it
    end. Counts are summed in two steps, over groups of buckets and within a group, so fine
    buckets do not make a long per-key table either. ``bucket`` is an integer that grows with
    the order columns; take it fine enough for one bucket of one key to fit a task.
    """
    keys = list(panel.keys)
    bucketed = df.withColumn(_BUCKET, time_bucket(df, panel.order[0]) if bucket is None else bucket)
    group = F.floor(F.col(_BUCKET) / _BUCKETS_PER_GROUP).alias("__group")
    counts = bucketed.groupBy(*keys, group, _BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*keys).orderBy("__group").rowsBetween(W.unboundedPreceding, -1)
    groups = (counts.groupBy(*keys, "__group").agg(F.sum("__n").alias("__n"))
              .select(*keys, "__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base")))
    within = W.partitionBy(*keys, "__group").orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    starts = (counts.withColumn("__in", F.coalesce(F.sum("__n").over(within), F.lit(0)))
              .join(groups, [*keys, "__group"])
              .select(*keys, _BUCKET, (F.col("__base") + F.col("__in")).alias("__start")))
    inside = W.partitionBy(*keys, _BUCKET).orderBy(*panel.order)
    return (bucketed.withColumn("__rank", F.row_number().over(inside))
            .join(starts, [*keys, _BUCKET])
            .withColumn(panel.pos, F.col("__start") + F.col("__rank") - 1)
            .drop(_BUCKET, "__rank", "__start"))


def ensure_numbered(df: DataFrame, panel: Panel) -> DataFrame:
    return df if panel.pos in df.columns else number_rows(df, panel)


def _block_of(panel: Panel, size: int, shift: int = 0) -> Column:
    return F.expr(f"greatest(0, `{panel.pos}` + ({shift})) div {size}")


def windowed(df: DataFrame, panel: Panel, levels: Sequence[Level], before: int = 0,
             after: int = 0) -> DataFrame:
    """Append window columns level by level over blocks with a halo.

    ``before``/``after`` are the summed reach, in rows, of all levels. Columns of one level
    share a sort; a later level may use the columns of an earlier one. One shuffle in total.
    """
    df = ensure_numbered(df, panel)
    size = panel.block_size(before + after)
    own = _block_of(panel, size)
    if before or after:
        spread = F.sequence(_block_of(panel, size, -after), _block_of(panel, size, before))
        df = df.select("*", F.explode(spread).alias(_BLK))
    else:
        df = df.withColumn(_BLK, own)
    w = W.partitionBy(*panel.keys, _BLK).orderBy(panel.pos)
    # Windows over parts of a block would otherwise each ask for a shuffle of their own.
    df = df.repartition(*panel.keys, _BLK)
    for level in levels:
        df = df.select("*", *level(w))
    return df.where(F.col(_BLK) == own).drop(_BLK)


def lag(x: str | Column, n: int, w: WindowSpec) -> Column:
    return F.lag(x, n).over(w)


def rolling(agg: Column, x: str | Column, n: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    """``agg`` over the last ``n`` rows, NULL until ``min_periods`` (default ``n``) values are seen."""
    need = n if min_periods is None else min_periods
    frame = w.rowsBetween(-(n - 1), 0)
    value = agg.over(frame)
    return value if need <= 1 else F.when(F.count(x).over(frame) >= need, value)


def pct_change(x: Column, previous: Column) -> Column:
    return F.try_divide(x, previous) - 1


def flag(condition: Column) -> Column:
    """0/1 with NULL counted as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def attach_per_key(df: DataFrame, panel: Panel, aggs: Sequence[Column]) -> DataFrame:
    """Every row with aggregates of its whole key.

    The aggregates combine on the map side. They are then repeated once per block of the key
    and joined on (key, block), so the rows of a hot key stay spread over its blocks.
    """
    df = ensure_numbered(df, panel)
    block = _block_of(panel, panel.scan_rows)
    stats = df.groupBy(*panel.keys).agg(*aggs, F.min(block).alias("__lo"), F.max(block).alias("__hi"))
    spread = (stats.withColumn(_BLK, F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi"))
    return df.withColumn(_BLK, block).join(spread, [*panel.keys, _BLK]).drop(_BLK)


_PARTS = 64


def attach_table(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row with the columns of its key's row in ``table``, which has one row per key; NULLs where it has none.

    The table is repeated for 64 parts and the rows are spread over them by a hash of their values, so the rows of a
    hot key do not meet in one task, and a repeated attempt sends every row to the same part.
    """
    keys = list(keys)
    parts = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))).alias("__part"))
    rows = df.withColumn("__part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(_PARTS)).cast("int"))
    return rows.join(parts, [*keys, "__part"], "left").drop("__part")


# --- running folds -----------------------------------------------------------------------

_FOLDS = {
    # name: (aggregate of a block or frame, value of carry and local together)
    "sum": (F.sum, lambda carry, local: F.coalesce(carry + local, carry, local)),
    "product": (F.product, lambda carry, local: F.coalesce(carry * local, carry, local)),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
}


@dataclass(frozen=True)
class Run:
    """A running fold of ``x``: from the key's first row, or from its last when ``reverse``.

    Folds are sum, product, max, min and ``last``, the latest non-NULL value.
    """

    fold: str
    x: Column
    reverse: bool = False


def running(df: DataFrame, panel: Panel, outputs: dict[str, Run], bucket: Column | None = None) -> DataFrame:
    """Running folds over each key's rows up to the current one.

    Each block is folded into a small table, whose own running fold gives the carry that is
    added to the block's local running fold. Blocks are runs of positions, or time buckets of
    the order columns where the rows have no position: a fold needs an order, not a count.
    """
    keys = list(panel.keys)
    numbered = panel.pos in df.columns
    order = [panel.pos] if numbered else list(panel.order)
    if numbered:
        block = _block_of(panel, panel.scan_rows)
    else:
        block = time_bucket(df, order[0]) if bucket is None else bucket
    base = df.select("*", block.alias(_BLK), *[r.x.alias(f"__x_{n}") for n, r in outputs.items()])
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    def frames(r: Run) -> tuple[WindowSpec, WindowSpec]:
        def direct(c: str) -> Column:
            return F.col(c).desc() if r.reverse else F.col(c).asc()
        across = W.partitionBy(*keys).orderBy(direct(_BLK)).rowsBetween(W.unboundedPreceding, -1)
        inside = W.partitionBy(*keys, _BLK).orderBy(*[direct(c) for c in order])
        return across, inside.rowsBetween(W.unboundedPreceding, 0)

    def over(r: Run, column: str, frame: WindowSpec) -> Column:
        if r.fold == "last":
            return F.last(column, ignorenulls=True).over(frame)
        return _FOLDS[r.fold][0](column).over(frame)

    def of_block(r: Run, column: str) -> Column:
        if r.fold == "last":
            known = F.when(F.col(column).isNotNull(), at)
            return F.min_by(column, known) if r.reverse else F.max_by(column, known)
        return _FOLDS[r.fold][0](column)

    folded = base.groupBy(*keys, _BLK).agg(*[of_block(r, f"__x_{n}").alias(f"__x_{n}") for n, r in outputs.items()])
    carries = folded.select(*keys, _BLK, *[over(r, f"__x_{n}", frames(r)[0]).alias(f"__c_{n}") for n, r in outputs.items()])
    local = base.select("*", *[over(r, f"__x_{n}", frames(r)[1]).alias(f"__l_{n}") for n, r in outputs.items()])
    joined = local.join(carries, [*keys, _BLK])
    result = []
    for n, r in outputs.items():
        carry, here = F.col(f"__c_{n}"), F.col(f"__l_{n}")
        value = F.coalesce(here, carry) if r.fold == "last" else _FOLDS[r.fold][1](carry, here)
        result.append(value.alias(n))
    return joined.select(*[c for c in df.columns if c not in outputs], *result)


# --- long sliding windows ----------------------------------------------------------------


@dataclass(frozen=True)
class Slide:
    """A fold of ``x`` over the ``n`` rows that end ``gap`` rows before the current one.

    Folds are count, sum, mean, std (of a sample), max and min. The value is NULL where the window has fewer than ``least`` values.
    """

    fold: str
    x: str | Column
    n: int
    gap: int = 0
    least: int = 1


def _slide_parts(fold: str, x: str, frame: WindowSpec) -> Column:
    count = F.count(x).over(frame)
    if fold == "std":
        return F.struct(count.alias("n"), F.avg(x).over(frame).alias("v"), (F.var_pop(x).over(frame) * count).alias("q"))
    agg = {"max": F.max, "min": F.min}.get(fold, F.sum)
    return F.struct(count.alias("n"), agg(x).over(frame).alias("v"))


def _slide_value(s: Slide, a: Column, b: Column) -> Column:
    """The fold of the stretches ``a`` and ``b``, either of which may be missing."""
    na, nb = F.coalesce(a["n"], F.lit(0)), F.coalesce(b["n"], F.lit(0))
    n = na + nb
    if s.fold == "std":
        between = F.when((na > 0) & (nb > 0), (a["v"] - b["v"]) * (a["v"] - b["v"]) * na * nb / n).otherwise(F.lit(0.0))
        squares = F.coalesce(a["q"], F.lit(0.0)) + F.coalesce(b["q"], F.lit(0.0)) + between
        value = F.when(n > 1, F.sqrt(squares / (n - 1)))
    elif s.fold in ("max", "min"):
        value = (F.greatest if s.fold == "max" else F.least)(a["v"], b["v"])
    else:
        total = F.coalesce(a["v"] + b["v"], a["v"], b["v"])
        value = {"count": n, "sum": total, "mean": F.try_divide(total, n)}[s.fold]
    return F.when(n >= s.least, value)


def sliding(df: DataFrame, panel: Panel, outputs: dict[str, Slide]) -> DataFrame:
    """Append folds over sliding windows, at a cost per row that does not grow with the window.

    Rows are cut into chunks of the window's length. A window is the end of one chunk and the beginning of the next, so its fold
    comes from a running fold backward and one forward, and nothing is ever taken away from a sum. One shuffle in total, two
    sorts for each window length: for windows of a few dozen rows :func:`rolling` is cheaper.
    """
    names = list(enumerate(outputs.items()))
    lengths = sorted({s.n for s in outputs.values()})
    pos = F.col(panel.pos)

    def running_fold(way: str) -> Level:
        def level(w: WindowSpec) -> list[Column]:
            order = pos.asc() if way == "p" else pos.desc()
            frames = {n: W.partitionBy(*panel.keys, _BLK, f"__chunk{n}").orderBy(order).rowsBetween(W.unboundedPreceding, 0) for n in lengths}
            return [_slide_parts(s.fold, f"__x{i}", frames[s.n]).alias(f"__{way}{i}") for i, (_, s) in names]
        return level

    def ends(w: WindowSpec) -> list[Column]:
        so_far = w.rowsBetween(W.unboundedPreceding, 0)
        columns = [F.first(panel.pos).over(so_far).alias("__first")]
        for i, (_, s) in names:
            columns += [F.lag(f"__p{i}", s.gap).over(w).alias(f"__end{i}") if s.gap else F.col(f"__p{i}").alias(f"__end{i}"),
                        F.lag(f"__s{i}", s.gap + s.n - 1).over(w).alias(f"__far{i}"), F.first(f"__s{i}").over(so_far).alias(f"__near{i}")]
        return columns

    def values(w: WindowSpec) -> list[Column]:
        columns = []
        for i, (out, s) in names:
            end = pos - s.gap
            start = F.greatest(end - (s.n - 1), F.col("__first"))
            # A window that lies in one chunk begins with it, or with the rows there are: the forward fold has all of it.
            other = F.when(F.floor(start / s.n) < F.floor(end / s.n), F.coalesce(f"__far{i}", f"__near{i}"))
            columns.append(_slide_value(s, other, F.col(f"__end{i}")).alias(out))
        return columns

    made = windowed(df, panel, [
        lambda w: [F.floor(pos / n).alias(f"__chunk{n}") for n in lengths] + [
            (F.col(s.x) if isinstance(s.x, str) else s.x).alias(f"__x{i}") for i, (_, s) in names],
        running_fold("p"), running_fold("s"), ends, values], before=max(s.gap + s.n - 1 for s in outputs.values()))
    return made.select(*[c for c in made.columns if not c.startswith("__") or c in df.columns])


# --- NULL handling along the order -------------------------------------------------------


def forward_fill(df: DataFrame, panel: Panel, columns: Sequence[str], bucket: Column | None = None) -> DataFrame:
    runs = {c: Run("last", F.col(c)) for c in columns}
    return running(df, panel, runs, bucket).select(*df.columns)


def backward_fill(df: DataFrame, panel: Panel, columns: Sequence[str], bucket: Column | None = None) -> DataFrame:
    runs = {c: Run("last", F.col(c), reverse=True) for c in columns}
    return running(df, panel, runs, bucket).select(*df.columns)


def fill_all(df: DataFrame, panel: Panel, columns: Sequence[str], default: float = 0) -> DataFrame:
    """Forward fill, then backward fill, then a constant, in one pass."""
    both = running(df, panel, {f"__{side}_{c}": Run("last", F.col(c), side == "b") for c in columns for side in "fb"})
    return both.select(*[F.coalesce(f"__f_{c}", f"__b_{c}", F.lit(default)).alias(c) if c in columns else F.col(c)
                         for c in df.columns])


def interpolate(df: DataFrame, panel: Panel, columns: Sequence[str]) -> DataFrame:
    """Linear by row position; leading NULLs stay, trailing NULLs take the last value."""
    df = ensure_numbered(df, panel)
    pos = F.col(panel.pos)
    runs = {}
    for c in columns:
        known = F.when(F.col(c).isNotNull(), pos)
        runs |= {f"__ap_{c}": Run("max", known), f"__av_{c}": Run("last", F.col(c)),
                 f"__bp_{c}": Run("min", known, reverse=True), f"__bv_{c}": Run("last", F.col(c), reverse=True)}
    both = running(df, panel, runs)

    def value(c: str) -> Column:
        ap, av, bp, bv = (F.col(f"__{k}_{c}") for k in ("ap", "av", "bp", "bv"))
        between = av + (bv - av) * ((pos - ap) / (bp - ap))
        return (F.when(F.col(c).isNotNull(), F.col(c)).when(ap.isNull(), F.lit(None)).when(bp.isNull(), av)
                .otherwise(between))

    return both.select(*[value(c).alias(c) if c in columns else F.col(c) for c in df.columns])


# --- exponentially weighted mean ---------------------------------------------------------


@dataclass(frozen=True)
class Ewm:
    """``y = (1-k)·y_prev + k·x`` over the non-NULL ``x`` from row ``seed_pos`` on.

    The first such value seeds ``y``; a NULL row repeats the value before it; NaN stays.
    """

    out: str
    x: Column
    alpha: float
    seed_pos: int = 0

    @property
    def decay(self) -> float:
        return -math.log1p(-self.alpha)

    @property
    def chunk(self) -> int:
        """Rows that can be weighted by q^-i without leaving the range of a double."""
        return max(1, int(200 / self.decay))


def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


Step = dict[str, Callable[[WindowSpec], Column]]


def merge_steps(parts: Sequence[Sequence[Step]]) -> list[Level]:
    """One level per dependency depth; a column named in several parts is computed once."""
    first: dict[str, int] = {}
    made: dict[str, Callable[[WindowSpec], Column]] = {}
    for steps in parts:
        for depth, step in enumerate(steps):
            for name, fn in step.items():
                if depth < first.get(name, depth + 1):
                    first[name], made[name] = depth, fn

    def level(depth: int) -> Level:
        names = [n for n, d in first.items() if d == depth]
        return lambda w: [made[n](w).alias(n) for n in names]

    return [level(d) for d in range(max(first.values()) + 1)] if first else []


def drop_work_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


_MOST_BLOCKS = 1024


def ewm(df: DataFrame, panel: Panel, specs: Sequence[Ewm]) -> DataFrame:
    """``df`` plus one column per spec: the exact recursion over the whole history.

    The recursion is affine. A block of ``n`` values, the first of them ``f``, turns a value
    ``c`` into ``(q·c + k·f)·q^(n-1) + e``, or ``f·q^(n-1) + e`` where there is none before, and
    ``e`` is the part of its other values, a running sum of ``k·x·q^-i`` scaled back by ``q^i``.
    Rows are dealt by segment, a run of blocks that fits a task. Blocks are folded where they
    are, segments of a key are chained, and a segment's rows meet one row with the values
    before each of its blocks. Nothing is cut off, no rows are copied whatever the span, and
    rows are shuffled once; the other two shuffles hold a row per segment.
    """
    df = ensure_numbered(df, panel)
    keys, pos, columns = list(panel.keys), F.col(panel.pos), df.columns
    seen = {s.out: F.when(pos >= s.seed_pos, s.x.cast("double")) for s in specs}
    latest = {s.out: Run("last", seen[s.out]) for s in specs if s.alpha >= 1}
    if latest:
        df = running(df, panel, latest)
    specs = [s for s in specs if s.alpha < 1]
    if not specs:
        return df
    numbered = list(enumerate(specs))
    size = min([panel.scan_rows, *[s.chunk for s in specs]])
    per_segment = min(_MOST_BLOCKS, max(1, panel.scan_rows // size))
    group = [*keys, "__group"]
    # Blocks and rows read the same shuffle. The row goes through it as one value, or the blocks' reader, which wants fewer
    # columns, would get a shuffle of its own and everything below would run twice.
    whole_row = F.array(F.struct(*df.columns)).alias("__row")
    dealt = df.select(*keys, _block_of(panel, size * per_segment).alias("__group"), whole_row)
    # The join below asks its left side for this; the blocks' reader must ask for the same.
    dealt = dealt.where(" and ".join(f"`{c}` is not null" for c in group)).repartition(*group)
    dealt = dealt.select(*keys, "__group", *[F.element_at("__row", 1)[c].alias(c) for c in df.columns if c not in keys])
    base = dealt.select("*", _block_of(panel, size).alias(_BLK), *[seen[s.out].alias(f"__x{i}") for i, s in numbered])
    so_far = W.partitionBy(*group, _BLK).orderBy(panel.pos).rowsBetween(W.unboundedPreceding, 0)
    counted = base.select("*", *[F.count(f"__x{i}").over(so_far).alias(f"__n{i}") for i, _ in numbered])

    def own(i: int, s: Ewm) -> Column:
        index = F.col(f"__n{i}") - 1
        scaled = F.when(index > 0, F.lit(s.alpha) * F.col(f"__x{i}") * F.exp(index * s.decay))
        return F.coalesce(F.sum(scaled).over(so_far) * F.exp(index * -s.decay), F.lit(0.0))

    local = counted.select("*", *[own(i, s).alias(f"__e{i}") for i, s in numbered])

    def onward(i: int, s: Ewm, before: Column, part: Callable[[str], Column], seed: Column | None = None) -> Column:
        """The value after a stretch; ``seed`` stands for its first value where none is before it."""
        n, first = part(f"__n{i}"), part(f"__f{i}")
        start = F.coalesce(before * (1 - s.alpha) + first * s.alpha, first if seed is None else seed)
        # An infinite value stays, also where its weight is too small for a double.
        kept = F.when(F.abs(start) == math.inf, start).otherwise(start * F.exp((n - 1) * -s.decay))
        return F.when(n == 0, before).otherwise(kept + part(f"__e{i}"))

    def after(i: int, s: Ewm, stretches: Column, start: Column, seed: Column | None = None) -> Column:
        return F.aggregate(stretches, start, lambda value, b: onward(i, s, value, lambda name: b[name], seed))

    def total(name: str) -> Column:
        return F.aggregate("__held", F.lit(0).cast("long"), lambda n, b: n + b[name])

    def first_known(name: str) -> Column:
        return F.aggregate("__held", nothing, lambda f, b: F.coalesce(f, b[name]))

    nothing = F.lit(None).cast("double")
    parts = [f"__{k}{i}" for i, _ in numbered for k in "nef"]
    blocks = local.groupBy(*group, _BLK).agg(*[c for i, _ in numbered for c in (
        F.max(f"__n{i}").alias(f"__n{i}"), F.max_by(f"__e{i}", panel.pos).alias(f"__e{i}"),
        F.min_by(f"__x{i}", F.when(F.col(f"__x{i}").isNotNull(), pos)).alias(f"__f{i}"))])
    place = (F.col(_BLK) - F.col("__group") * per_segment).cast("int").alias("__at")
    segments = blocks.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(place, *parts))).alias("__held"))
    whole = [c for i, s in numbered for c in (
        total(f"__n{i}").alias(f"__n{i}"),
        F.coalesce(after(i, s, F.col("__held"), nothing, F.lit(0.0)), F.lit(0.0)).alias(f"__e{i}"),
        first_known(f"__f{i}").alias(f"__f{i}"))]
    earlier = W.partitionBy(*keys).orderBy("__group").rowsBetween(W.unboundedPreceding, -1)
    segments = (segments.select("*", *whole)
                .select(*group, "__held", F.collect_list(F.struct(*parts)).over(earlier).alias("__ahead"))
                .select(*group, "__held", *[after(i, s, F.col("__ahead"), nothing).alias(f"__s{i}") for i, s in numbered]))
    carry = "struct<" + ",".join(f"c{i}:double,f{i}:double" for i, _ in numbered) + ">"

    def step(state: Column, b: Column) -> Column:
        """The values after block ``b``, and those before it at its place; places without a block stay empty."""
        found = F.struct(*[c for i, _ in numbered for c in (state[f"v{i}"].alias(f"c{i}"), b[f"__f{i}"].alias(f"f{i}"))])
        gap = F.array_repeat(F.lit(None).cast(carry), b["__at"] - F.size(state["carries"]))
        return F.struct(*[onward(i, s, state[f"v{i}"], lambda name: b[name]).alias(f"v{i}") for i, s in numbered],
                        F.concat(state["carries"], gap, F.array(found)).alias("carries"))

    begin = F.struct(*[F.col(f"__s{i}").alias(f"v{i}") for i, _ in numbered], F.array().cast(f"array<{carry}>").alias("carries"))
    carries = segments.select(*group, F.aggregate("__held", begin, step, lambda state: state["carries"]).alias("__carries"))
    mine = F.element_at("__carries", (F.col(_BLK) - F.col("__group") * per_segment + 1).cast("int"))
    rows = local.join(carries, group).select("*", *[mine[f"{k}{i}"].alias(f"__{k}{i}") for i, _ in numbered for k in "cf"])
    return rows.select(*columns, *latest, *[onward(i, s, F.col(f"__c{i}"), F.col).alias(s.out) for i, s in numbered])


def ewm_with_gaps(df: DataFrame, panel: Panel, out: str, x: str, alpha: float) -> DataFrame:
    """EWM over the non-NULL values; a NULL row repeats the value before it."""
    return ewm(df, panel, [Ewm(out, F.col(x), alpha)])
