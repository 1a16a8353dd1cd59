"""Recursive indicators for every bar: recursions with a moving seed.

The value at a bar is that of a recursion over its last ``keep`` bars only, so
every bar has a seed of its own and no running state can be carried from bar to
bar.  The bars of a code are shuffled once and sorted; a task then advances the
recursions of all bars of an Arrow batch together, step by step through their
frames, in the order of operations of the as-of folds.  Bars stand in the order of
falling frame lengths, so those still advancing are a prefix, and only the
recursions asked for are worked out.  Between batches only the
last ``keep - 1`` bars are kept, so the memory does not depend on how long a
history is or how many codes a task has.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import dbl, null0
from barlake.operators.indicators import MAX_BARS, WILDER, indicators_history, overheated
from barlake.session import ship_package

FAST, SLOW, SIGNAL = 12, 26, 9
#: Bars advanced together.
BLOCK = 1 << 13

VALUES = ("rsi14", "macd_dif", "macd_dea", "macd_hist", "macd_hist_1", "macd_hist_3", "atr14")


def _frames(start: np.ndarray, o: int, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Frames of the bars from ``o`` on over the live bars alone, longest first.

    Order of the bars, first live bar of each frame, its length, and how many frames are longer than each step.
    """
    upto = np.concatenate(([0], np.cumsum(live)))
    first, length = upto[start[o:]], upto[o + 1 :] - upto[start[o:]]
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    return order, first, length, np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")


def _smoothed(total: np.ndarray, part: np.ndarray, i: int) -> None:
    """Advance Wilder's mean by its ``i``-th part: a sum up to the first whole period, a smoothed mean after it."""
    if i > WILDER:
        total *= WILDER - 1
    total += part
    if i >= WILDER:
        total /= WILDER


def _gains(frames: tuple, close: np.ndarray) -> dict[str, np.ndarray]:
    _, first, length, running = frames
    up, down, prev = np.zeros(len(first)), np.zeros(len(first)), None
    for step, m in enumerate(running):
        x = close[first[:m] + step]
        if step:
            change = x - prev[:m]
            _smoothed(up[:m], np.maximum(change, 0.0), step)
            _smoothed(down[:m], np.maximum(-change, 0.0), step)
        prev = x
    flat = np.where(up > 0, 100.0, 50.0)
    rsi = np.where(down == 0, flat, 100.0 - 100.0 / (1.0 + up / np.where(down == 0, 1.0, down)))
    return {"rsi14": np.where(length > WILDER, rsi, np.nan)}


def _averages(frames: tuple, close: np.ndarray) -> dict[str, np.ndarray]:
    _, first, length, running = frames
    fast, slow, dif, dea, *hist = (np.full(len(first), np.nan) for _ in range(8))
    for step, m in enumerate(running):
        x = close[first[:m] + step]
        for total, span in ((fast[:m], FAST), (slow[:m], SLOW)):
            alpha = 2.0 / (span + 1)
            if step:
                total *= 1.0 - alpha
                total += x * alpha
            else:
                total[:] = x
        count = step + 1
        if count < SLOW:
            continue
        now, signal = dif[:m], dea[:m]
        np.subtract(fast[:m], slow[:m], out=now)
        alpha = 2.0 / (SIGNAL + 1)
        if count == SLOW:
            signal[:] = now
        else:
            signal *= 1.0 - alpha
            signal += now * alpha
        if count >= SLOW + SIGNAL - 1:
            for k in (3, 2, 1):
                hist[k][:m] = hist[k - 1][:m]
            hist[0][:m] = (now - signal) * 2
    dea = np.where(length >= SLOW + SIGNAL - 1, dea, np.nan)
    return {"macd_dif": dif, "macd_dea": dea, "macd_hist": hist[0], "macd_hist_1": hist[1], "macd_hist_3": hist[3]}


def _ranges(frames: tuple, close: np.ndarray, high: np.ndarray, low: np.ndarray) -> dict[str, np.ndarray]:
    _, first, length, running = frames
    atr, prev = np.zeros(len(first)), None
    for step, m in enumerate(running):
        at = first[:m] + step
        h, w = high[at], low[at]
        part = h - w
        if step:
            part = np.maximum(part, np.maximum(np.abs(h - prev[:m]), np.abs(w - prev[:m])))
        _smoothed(atr[:m], part, step + 1)
        prev = close[at]
    return {"atr14": np.where(length >= WILDER, atr, np.nan)}


def frame_values(start: np.ndarray, o: int, close: np.ndarray, high: np.ndarray, low: np.ndarray, wanted: Collection[str]) -> dict[str, np.ndarray]:
    """The wanted recursions over ``[start, bar]`` for the bars from ``o`` on; NaN marks what is missing.

    A bar without a close takes no part in any recursion, one without high or low
    none in the true range.
    """
    out: dict[str, np.ndarray] = {}

    def add(frames: tuple, values: dict[str, np.ndarray]) -> None:
        for name, v in values.items():
            out[name] = np.empty(len(v))
            out[name][frames[0]] = v

    live = ~np.isnan(close)
    if set(wanted) - {"atr14"}:
        frames, closes = _frames(start, o, live), close[live]
        if "rsi14" in wanted:
            add(frames, _gains(frames, closes))
        if set(wanted) - {"atr14", "rsi14"}:
            add(frames, _averages(frames, closes))
    if "atr14" in wanted:
        whole = live & ~np.isnan(high) & ~np.isnan(low)
        frames = _frames(start, o, whole)
        add(frames, _ranges(frames, close[whole], high[whole], low[whole]))
    return out


def with_recursions(bars: DataFrame, keep: int = MAX_BARS, wanted: Sequence[str] = VALUES) -> DataFrame:
    """All columns of ``bars`` and the wanted recursive values over the last ``keep`` bars of the code up to each bar.

    Bars are unique per (code, dt).  A bar without a close still takes a place
    among the last ``keep``.  No bars give no rows.
    """
    ship_package(bars.sparkSession)
    kept = [f"k{i}" for i in range(len(bars.columns))]
    names = dict(zip(bars.columns, kept, strict=True))
    rows = bars.select(*[F.col(c).alias(k) for c, k in names.items()], *[dbl(c).alias(f"_{c}") for c in ("close", "high", "low")])
    code, day = names["code"], names["dt"]
    rows = rows.repartition(code).sortWithinPartitions(code, day)

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_code, tail = None, {c: np.empty(0) for c in ("_close", "_high", "_low")}
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                codes = np.array(part.column(part.schema.get_field_index(code)).to_pylist(), object)
                values = {c: part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float) for c in tail}
                o = len(tail["_close"])
                values = {c: np.concatenate((tail[c], v)) for c, v in values.items()}
                fresh = np.concatenate((np.full(o, False), [o == 0 or codes[0] != tail_code], codes[1:] != codes[:-1]))
                if o:
                    fresh[0] = True
                begin = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
                start = np.maximum(begin, np.arange(len(fresh)) - keep + 1)
                found = frame_values(start, o, values["_close"], values["_high"], values["_low"], wanted)
                rest = max(int(begin[-1]), len(fresh) - keep + 1)
                tail_code, tail = codes[-1], {c: v[rest:] for c, v in values.items()}
                columns = [part.column(part.schema.get_field_index(k)) for k in kept]
                columns += [pa.array(found[v], from_pandas=True) for v in wanted]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *wanted])

    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept)
    out = rows.mapInArrow(advance, ", ".join([fields, *[f"{v} double" for v in wanted]]))
    return out.select(*[F.col(k).alias(c) for c, k in names.items()], *wanted)


def momentum() -> list[Column]:
    """Changes of the MACD histogram against one and three bars before, and whether it lies above both."""
    now, one, three = (F.col(c) for c in ("macd_hist", "macd_hist_1", "macd_hist_3"))
    known = (now - one).isNotNull() & (now - three).isNotNull()
    return [
        (now - one).alias("momentum_delta_1"),
        (now - three).alias("momentum_delta_3"),
        F.when(known, (now > one) & (now > three)).alias("momentum_improving"),
    ]


def recursive_history(bars: DataFrame, keep: int = MAX_BARS, wanted: Sequence[str] = VALUES) -> DataFrame:
    """(code, dt, close, rsi14, MACD, momentum, ATR) for every bar with a close, as far as ``wanted`` values allow."""
    rows = with_recursions(bars.select("code", "dt", "close", "high", "low"), keep, wanted).where(F.col("close").isNotNull())
    return rows.select(
        "code",
        "dt",
        dbl("close").alias("close"),
        *[v for v in VALUES[:4] if v in wanted],
        *(momentum() if set(VALUES[3:6]) <= set(wanted) else []),
        *(["atr14", (F.col("atr14") / null0(dbl("close")) * 100).alias("atr14_pct")] if "atr14" in wanted else []),
    )


def overheated_history(bars: DataFrame, keep: int = MAX_BARS) -> DataFrame:
    """(code, dt, overheated) for every bar with a close."""
    rsi = with_recursions(bars.select("code", "dt", "open", "high", "low", "close"), keep, ["rsi14"])
    rows = indicators_history(rsi, ["rsi14"])
    return rows.select("code", "dt", overheated(F.col("rsi14"), F.col("boll_position")).alias("overheated"))


def frame_meta(bars: DataFrame, calculated_at: str, keep: int = MAX_BARS) -> DataFrame:
    """What the frame of every bar holds: (code, dt, input_rows, last_trade_date, truncated_from, truncated_to, first_date, last_date, ...).

    The as-of date is the bar's own: later bars are cut off (``truncated_*`` are
    the rows of the code and those up to the bar), earlier ones beyond ``keep``
    are outside the frame.
    """
    now = F.lit(calculated_at).cast("timestamp_ntz")
    by_code = Window.partitionBy("code").orderBy("dt")
    whole = Window.partitionBy("code")
    n, upto = F.count(F.lit(1)).over(whole), F.row_number().over(by_code)
    last = F.max("dt").over(whole)
    rows = bars.select(
        "code",
        "dt",
        n.alias("input_rows"),
        upto.cast("bigint").alias("upto"),
        last.alias("last_trade_date"),
        F.min("dt").over(by_code.rowsBetween(-(keep - 1), 0)).alias("first_date"),
    )
    cut = F.col("upto") < F.col("input_rows")
    return rows.select(
        "code",
        "dt",
        "input_rows",
        "last_trade_date",
        F.when(cut, F.col("input_rows")).alias("truncated_from"),
        F.when(cut, F.col("upto")).alias("truncated_to"),
        "first_date",
        F.col("dt").alias("last_date"),
        F.least(F.col("upto"), F.lit(keep).cast("bigint")).alias("frame_rows"),
        ((F.col("last_trade_date") == F.to_date(now)) & (F.hour(now) < 15)).alias("includes_intraday_today"),
    )
