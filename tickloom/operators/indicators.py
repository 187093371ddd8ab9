"""Technical indicators as composable column steps over the panel kit.

An indicator lists its columns by dependency level and how many rows it looks back.
``compute`` merges any number of them into one blocked window pass: one shuffle, one shared
halo, and one select per level. Exponential means end a phase: they need the whole history,
so they are folded over blocks before the columns built on them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom.operators.frames import numeric_columns
from tickloom.operators.panel import (
    BARS, Ewm, Panel, Run, Step, drop_work_columns, ensure_numbered, ewm, fill_all, flag, merge_steps, pct_change, rolling,
    running, span_alpha, windowed,
)
from tickloom.session import publish


@dataclass(frozen=True)
class Phase:
    """Window steps that look back ``before`` rows in all, then exponential means and running folds of their columns."""

    steps: tuple[Step, ...]
    before: int
    means: tuple[Ewm, ...] = ()
    folds: tuple[tuple[str, Run], ...] = ()


@dataclass(frozen=True)
class Indicator:
    phases: tuple[Phase, ...]


def phase(before: int, *steps: Step, means: Sequence[Ewm] = (), folds: Mapping[str, Run] | None = None) -> Phase:
    """A phase after the first that looks back 0 rows has plain columns only."""
    return Phase(tuple(steps), before, tuple(means), tuple((folds or {}).items()))


def indicator(before: int, *steps: Step) -> Indicator:
    return Indicator((phase(before, *steps),))


def compute(df: DataFrame, indicators: Sequence[Indicator], panel: Panel = BARS, fill: bool = False, staged: bool = False) -> DataFrame:
    """``df`` plus the columns of all indicators.

    A level of exponential means reads its rows twice, for the blocks and for the rows, so levels on levels repeat the work
    below them. With ``staged`` the table is written to the shared folder after each such level, and every level runs once.

    With ``fill``, a gap in any numeric column takes the value before it, else the one after it, else 0, as the last pass.
    Targets and the position stay as they are.
    """
    df, made, repeated = ensure_numbered(df, panel), set(), False
    for depth in range(max((len(i.phases) for i in indicators), default=0)):
        phases = [i.phases[depth] for i in indicators if depth < len(i.phases)]
        parts = [[{n: fn for n, fn in step.items() if n not in made} for step in p.steps] for p in phases]
        if repeated and staged:
            df = publish(df, "levels")
        levels, reach = merge_steps(parts), max(p.before for p in phases)
        if levels and (reach or not depth):
            df = windowed(df, panel, levels, before=reach)
        else:
            for level in levels:
                df = df.select("*", *level(None))
        made |= {n for steps in parts for step in steps for n in step}
        means = {m.out: m for p in phases for m in p.means if m.out not in made}
        if means:
            df = ewm(df, panel, list(means.values()))
            made |= set(means)
        folds = {n: run for p in phases for n, run in p.folds if n not in made}
        if folds:
            df = running(df, panel, folds)
            made |= set(folds)
        repeated = bool(means or folds)
    df = drop_work_columns(df)
    if fill and staged:
        df = publish(df, "levels")
    return fill_all(df, panel, [c for c in numeric_columns(df) if c != panel.pos]) if fill else df


def _c(name: str) -> Column:
    return F.col(name)


def _lag(x: str, n: int) -> Callable[[WindowSpec], Column]:
    return lambda w: F.lag(x, n).over(w)


def _roll(agg, x: str, n: int, min_periods: int | None = None) -> Callable[[WindowSpec], Column]:
    return lambda w: rolling(agg(x), x, n, w, min_periods)


def _suffix(*settings: tuple[float, float]) -> str:
    """Empty for the standard (given, standard) settings, so other settings get their own names."""
    given = "_".join(f"{a:g}" for a, _ in settings).replace(".", "_")
    return "" if all(a == b for a, b in settings) else f"_{given}"


def _plain(column: Column) -> Callable[[WindowSpec], Column]:
    return lambda w: column


PREV: Step = {"__prev": _lag("close", 1)}


def _ret() -> Column:
    return pct_change(_c("close"), _c("__prev"))


# --- averages ---------------------------------------------------------------------------


def sma(n: int, x: str = "close", out: str | None = None, min_periods: int | None = None) -> Indicator:
    return indicator(n - 1, {out or f"sma_{n}": _roll(F.avg, x, n, min_periods)})


def ema(n: int, x: str = "close", out: str | None = None, panel: Panel = BARS) -> Indicator:
    return Indicator((phase(0, means=[Ewm(out or f"ema_{n}", _c(x), span_alpha(n))]),))


def bollinger(n: int = 20, width: float = 2.0, population: bool = False) -> Indicator:
    std = F.stddev_pop if population else F.stddev_samp
    tail = _suffix((n, 20), (width, 2.0)) + ("_pop" if population else "")
    mid, dev = _c(f"bb_middle{tail}"), _c(f"bb_std{tail}")
    return indicator(n - 1,
                     {f"bb_middle{tail}": _roll(F.avg, "close", n), f"bb_std{tail}": _roll(std, "close", n)},
                     {f"bb_upper{tail}": _plain(mid + width * dev), f"bb_lower{tail}": _plain(mid - width * dev),
                      f"bb_width{tail}": _plain(F.try_divide(2 * width * dev, mid))})


def macd(fast: int = 12, slow: int = 26, signal: int = 9, panel: Panel = BARS) -> Indicator:
    a, b = Ewm(f"__ema_{fast}", _c("close"), span_alpha(fast)), Ewm(f"__ema_{slow}", _c("close"), span_alpha(slow))
    tail = _suffix((fast, 12), (slow, 26), (signal, 9))
    s = Ewm(f"macd_signal{tail}", _c(f"macd{tail}"), span_alpha(signal))
    return Indicator((
        phase(0, means=[a, b]), phase(0, {f"macd{tail}": _plain(_c(a.out) - _c(b.out))}, means=[s]),
        phase(0, {f"macd_hist{tail}": _plain(_c(f"macd{tail}") - _c(s.out))})))


# --- oscillators ------------------------------------------------------------------------


def _gain_loss() -> Step:
    change = _c("close") - _c("__prev")
    return {"__gain": _plain(F.greatest(F.coalesce(change, F.lit(0.0)), F.lit(0.0))),
            "__loss": _plain(F.greatest(F.coalesce(-change, F.lit(0.0)), F.lit(0.0)))}


def _rsi(gain: str, loss: str, flat: Column) -> Column:
    up, down = _c(gain), _c(loss)
    return (F.when((up == 0) & (down == 0), flat).when(down == 0, F.lit(100.0))
            .otherwise(100 - F.try_divide(F.lit(100.0), 1 + F.try_divide(up, down))))


def rsi(n: int = 14, dialect: str = "panel") -> Indicator:
    """Simple-average RSI; a flat window is 100 in the ``panel`` dialect and NULL in ``pandas``."""
    flat = F.lit(100.0) if dialect == "panel" else F.lit(None).cast("double")
    return indicator(n, PREV, _gain_loss(),
                     {f"__avg_gain_{n}": _roll(F.avg, "__gain", n), f"__avg_loss_{n}": _roll(F.avg, "__loss", n)},
                     {f"rsi{_suffix((n, 14))}": _plain(_rsi(f"__avg_gain_{n}", f"__avg_loss_{n}", flat))})


def rsi_wilder(n: int = 14, panel: Panel = BARS) -> Indicator:
    g = Ewm(f"__wilder_gain_{n}", _c("__gain"), 1.0 / n, seed_pos=1)
    l = Ewm(f"__wilder_loss_{n}", _c("__loss"), 1.0 / n, seed_pos=1)
    ready = _c(panel.pos) >= n - 1
    return Indicator((
        phase(1, PREV, _gain_loss(), means=[g, l]),
        phase(0, {f"rsi_wilder{_suffix((n, 14))}": _plain(F.when(ready, _rsi(g.out, l.out, F.lit(100.0))))})))


def stochastic(n: int = 14, d: int = 3) -> Indicator:
    hh, ll, tail = f"__hh_{n}", f"__ll_{n}", _suffix((n, 14), (d, 3))
    return indicator(n + d - 2, {hh: _roll(F.max, "high", n), ll: _roll(F.min, "low", n)},
                     {f"stoch_k{tail}": _plain(100 * F.try_divide(_c("close") - _c(ll), _c(hh) - _c(ll)))},
                     {f"stoch_d{tail}": _roll(F.avg, f"stoch_k{tail}", d)})


def williams_r(n: int = 14) -> Indicator:
    hh, ll = f"__hh_{n}", f"__ll_{n}"
    return indicator(n - 1, {hh: _roll(F.max, "high", n), ll: _roll(F.min, "low", n)},
                     {f"williams_r{_suffix((n, 14))}": _plain(
                         -100 * F.try_divide(_c(hh) - _c("close"), _c(hh) - _c(ll)))})


def cci(n: int = 14) -> Indicator:
    """The frame of n typical prices is the only array; it is bounded by n."""
    def values(w: WindowSpec) -> Column:
        return F.collect_list("__tp").over(w.rowsBetween(-(n - 1), 0))
    mean = _c(f"__tp_avg_{n}")
    deviation = F.aggregate(_c(f"__tps_{n}"), F.lit(0.0), lambda s, x: s + F.abs(x - mean)) / n
    return indicator(n - 1, {"__tp": _plain((_c("high") + _c("low") + _c("close")) / 3)},
                     {f"__tp_avg_{n}": _roll(F.avg, "__tp", n), f"__tps_{n}": values},
                     {f"cci{_suffix((n, 14))}": _plain(F.when(mean.isNotNull(), F.try_divide(
                         _c("__tp") - mean, 0.015 * deviation)))})


def roc(n: int = 10, out: str | None = None) -> Indicator:
    return indicator(n, {f"__close_{n}": _lag("close", n)},
                     {out or f"roc_{n}": _plain(100 * pct_change(_c("close"), _c(f"__close_{n}")))})


# --- range and trend strength -----------------------------------------------------------


def _true_range() -> Column:
    prev = _c("__prev")
    return F.greatest(_c("high") - _c("low"), F.abs(_c("high") - prev), F.abs(_c("low") - prev))


def true_range() -> Indicator:
    return indicator(1, PREV, {"true_range": _plain(_true_range())})


def _wilder(panel: Panel, out: str, x: str, n: int, first: int) -> tuple[Step, Ewm]:
    """Wilder's average: the mean of the first n values from position ``first``, then smoothing."""
    seed = first + n - 1
    name = f"__seed_{out}"
    pos = _c(panel.pos)
    step: Step = {name: lambda w: F.avg(x).over(w.rowsBetween(-(n - 1), 0))}
    value = F.when(pos == seed, _c(name)).when(pos > seed, _c(x))
    return step, Ewm(out, value, 1.0 / n, seed_pos=seed)


def atr(n: int = 14, panel: Panel = BARS) -> Indicator:
    seed, spec = _wilder(panel, f"atr{_suffix((n, 14))}", "true_range", n, 0)
    return Indicator((phase(n, PREV, {"true_range": _plain(_true_range())}, seed, means=[spec]),))


def atr_simple(n: int = 14) -> Indicator:
    return indicator(n, PREV, {"true_range": _plain(_true_range())}, {f"atr_simple{_suffix((n, 14))}": _roll(F.avg, "true_range", n)})


def adx(n: int = 14, panel: Panel = BARS) -> Indicator:
    up, down = _c("high") - _c("__prev_high"), _c("__prev_low") - _c("low")
    moves: Step = {
        "__tr": _plain(_true_range()),
        "__pdm": _plain(F.when((up > down) & (up > 0), up).otherwise(0.0)),
        "__mdm": _plain(F.when((down > up) & (down > 0), down).otherwise(0.0))}
    tail = _suffix((n, 14))
    parts = [_wilder(panel, f"__w{x}_{n}", f"__{x}", n, 0) for x in ("tr", "pdm", "mdm")]
    seeds: Step = {}
    for step, _ in parts:
        seeds |= step
    plus, minus = _c(f"plus_di{tail}"), _c(f"minus_di{tail}")
    total = plus + minus
    dx_seed, dx_spec = _wilder(panel, f"adx{tail}", f"__dx_{n}", n, n - 1)
    return Indicator((
        phase(n, {**PREV, "__prev_high": _lag("high", 1), "__prev_low": _lag("low", 1)}, moves, seeds,
              means=[spec for _, spec in parts]),
        phase(n - 1,
              {f"plus_di{tail}": _plain(100 * F.try_divide(_c(f"__wpdm_{n}"), _c(f"__wtr_{n}"))),
               f"minus_di{tail}": _plain(100 * F.try_divide(_c(f"__wmdm_{n}"), _c(f"__wtr_{n}")))},
              {f"__dx_{n}": _plain(F.when(total.isNull() | (total == 0), F.lit(0.0))
                                   .otherwise(100 * F.try_divide(F.abs(plus - minus), total)))},
              dx_seed, means=[dx_spec])))


# --- returns, volume, flags -------------------------------------------------------------


def returns() -> Indicator:
    ratio = F.try_divide(_c("close"), _c("__prev"))
    return indicator(1, PREV, {"daily_return": _plain(_ret()), "log_return": _plain(F.when(ratio > 0, F.ln(ratio)))})


def volatility(n: int) -> Indicator:
    return indicator(n, PREV, {"__ret": _plain(_ret())}, {f"volatility_{n}": _roll(F.stddev_samp, "__ret", n)})


def momentum(n: int) -> Indicator:
    return indicator(n, {f"__close_{n}": _lag("close", n)},
                     {f"momentum_{n}": _plain(pct_change(_c("close"), _c(f"__close_{n}")))})


def momentum_abs(n: int) -> Indicator:
    return indicator(n, {f"__close_{n}": _lag("close", n)},
                     {f"momentum_abs_{n}": _plain(_c("close") - _c(f"__close_{n}"))})


def gap_and_range() -> Indicator:
    return indicator(1, PREV, {"gap": _plain(pct_change(_c("open"), _c("__prev"))),
                               "hl_range": _plain(F.try_divide(_c("high") - _c("low"), _c("close")))})


def volume_stats(n: int = 10) -> Indicator:
    means = {f"volume_ma{k}": _roll(F.avg, "volume", k) for k in (5, 10, 20)}
    return indicator(max(19, n), {"__prev_volume": _lag("volume", 1), **means},
                     {"volume_change": _plain(pct_change(_c("volume"), _c("__prev_volume"))),
                      "volume_ratio_ma5": _plain(F.try_divide(_c("volume"), _c("volume_ma5"))),
                      "volume_ratio_ma20": _plain(F.try_divide(_c("volume"), _c("volume_ma20")))},
                     {"volume_volatility": _roll(F.stddev_samp, "volume_change", n)})


def volume_oscillator() -> Indicator:
    """Price over volume uses the volume itself, NULL where it is zero."""
    return indicator(19, {f"volume_ma{k}": _roll(F.avg, "volume", k) for k in (5, 20)},
                     {"volume_osc": _plain(100 * F.try_divide(_c("volume_ma5") - _c("volume_ma20"), _c("volume_ma20"))),
                      "price_volume_ratio": _plain(F.try_divide(_c("close"), _c("volume")))})


def above_ma(n: int) -> Indicator:
    return indicator(n - 1, {f"__ma_{n}": _roll(F.avg, "close", n)},
                     {f"above_ma{n}": _plain(flag(_c("close") > _c(f"__ma_{n}")))})


def cross_event(fast: int, slow: int) -> Indicator:
    a, b = f"__ma_{fast}", f"__ma_{slow}"
    return indicator(slow, {n: _roll(F.avg, "close", k) for n, k in ((a, fast), (b, slow))},
                     {f"{a}_prev": _lag(a, 1), f"{b}_prev": _lag(b, 1)},
                     {f"ma_cross_{fast}_{slow}": _plain(
                         flag((_c(a) > _c(b)) & (_c(f"{a}_prev") <= _c(f"{b}_prev"))))})


def cross_state(fast: int, slow: int) -> Indicator:
    a, b = f"__ma_{fast}", f"__ma_{slow}"
    return indicator(slow - 1, {n: _roll(F.avg, "close", k) for n, k in ((a, fast), (b, slow))},
                     {f"ma_state_{fast}_{slow}": _plain(
                         F.when(_c(a) > _c(b), 1).when(_c(a) < _c(b), -1).otherwise(0))})


def price_to_ma(n: int) -> Indicator:
    return indicator(n - 1, {f"__ma_{n}": _roll(F.avg, "close", n)},
                     {f"price_to_ma{n}": _plain(F.try_divide(_c("close"), _c(f"__ma_{n}")))})


def with_obv(df: DataFrame, panel: Panel = BARS, outputs: Mapping[str, str] | None = None) -> DataFrame:
    """On-balance volume; ``outputs`` maps column names to dialects (default ``{"obv": "a"}``).

    Dialect a adds nothing on ties and on the first row; b adds the volume there. The sign
    needs one previous row, so it is taken in a blocked pass and then folded.
    """
    signed = windowed(df, panel, [lambda w: [F.lag("close", 1).over(w).alias("__prev")]], before=1)
    change, volume = _c("close") - _c("__prev"), _c("volume")
    step = {"a": F.when(change > 0, volume).when(change < 0, -volume).otherwise(F.lit(0)),
            "b": F.when(change < 0, -volume).otherwise(volume)}
    runs = {out: Run("sum", step[dialect]) for out, dialect in (outputs or {"obv": "a"}).items()}
    return drop_work_columns(running(signed, panel, runs))


def obv(out: str = "obv", dialect: str = "a") -> Indicator:
    """On-balance volume as an indicator among others; the dialects are those of :func:`with_obv`."""
    change, volume = _c("close") - _c("__prev"), _c("volume")
    signed = {"a": F.when(change > 0, volume).when(change < 0, -volume).otherwise(F.lit(0)),
              "b": F.when(change < 0, -volume).otherwise(volume)}[dialect]
    return Indicator((phase(1, PREV, {f"__signed_{dialect}": _plain(signed)}, folds={out: Run("sum", _c(f"__signed_{dialect}"))}),))


# The standard indicator settings.
STANDARD_SPEC = {
    "sma": [5, 10, 20, 50, 100, 200], "ema": [5, 10, 20, 50, 100, 200], "rsi": [14], "bollinger": [(20, 2.0)],
    "macd": [(12, 26, 9)], "stochastic": [(14, 3)], "volatility": [5, 10, 20], "momentum": [5, 10, 20],
}
BUILDERS: dict[str, Callable[..., Indicator]] = {
    "sma": sma, "ema": ema, "rsi": rsi, "rsi_wilder": rsi_wilder, "bollinger": bollinger, "macd": macd,
    "stochastic": stochastic, "williams_r": williams_r, "cci": cci, "roc": roc, "atr": atr, "adx": adx,
    "volatility": volatility, "momentum": momentum, "above_ma": above_ma, "cross_event": cross_event,
    "cross_state": cross_state, "price_to_ma": price_to_ma, "obv": obv,
}
# The settings of the whole feature pipeline.
FULL_SPEC = {
    **STANDARD_SPEC, "rsi_wilder": [14], "adx": [14], "atr": [14], "cci": [14], "williams_r": [14], "roc": [10, (10, "mom_10")],
    "price_to_ma": [5, 10, 20, 50, 100, 200], "cross_state": [(5, 10), (10, 20), (20, 50), (50, 200)], "obv": ["obv"],
}


def full_set() -> list[Indicator]:
    return [*from_spec(FULL_SPEC), returns(), gap_and_range(), volume_stats(), volume_oscillator()]




def from_spec(spec: dict[str, Sequence]) -> list[Indicator]:
    """Indicators from a settings map such as ``{"sma": [20, 50], "macd": [(12, 26, 9)]}``."""
    chosen = []
    for name, settings in spec.items():
        for setting in settings:
            args = setting if isinstance(setting, (tuple, list)) else (setting,)
            chosen.append(BUILDERS[name](*args))
    return chosen
