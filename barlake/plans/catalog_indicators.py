"""Indicator queries and their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions import session_time as st
from barlake.functions.numeric import dbl
from barlake.operators import indicators as ind
from barlake.operators import recursions
from barlake.plans.bindings import AS_OF, AS_OF_DATES, bars, dims, snapshot, ticks, with_bindings
from barlake.plans.registry import query


def _day(c="dt"):
    return F.col(c).cast("string").alias(c)


def _history(spark, d, *cols):
    return ind.indicators_history(bars(spark, d)).select("code", _day(), *cols)


def _history_wide(spark, d, *cols):
    """Bars keyed by line number hold several trades each, so their candles have a body."""
    return ind.indicators_history(bars(spark, d, "l_linenumber")).select("code", _day(), *cols)


_W = "PARTITION BY code ORDER BY dt ROWS BETWEEN {} PRECEDING AND CURRENT ROW"


def _ma_sql(p: int) -> str:
    w = _W.format(p - 1)
    return f"CASE WHEN count(*) OVER ({w}) = {p} THEN CAST(sum(close) OVER ({w}) AS DOUBLE) / {p} END AS ma{p}"


@query(
    "ind_ma",
    with_bindings(
        "SELECT code, CAST(dt AS VARCHAR) AS dt, "
        + ", ".join(_ma_sql(p) for p in ind.MA_PERIODS)
        + " FROM fx_bars",
        "fx_bars",
    ),
)
def ind_ma(spark, d):
    return _history(spark, d, *[f"ma{p}" for p in ind.MA_PERIODS])


_BOLL = f"""
boll AS (SELECT code, dt, close, count(*) OVER w AS n, sum(close) OVER w AS s1,
                sum(CAST(close * close AS DECIMAL(24,4))) OVER w AS s2
         FROM fx_bars WINDOW w AS ({_W.format(19)})),
band AS (SELECT *, CAST(s1 AS DOUBLE) / 20 AS mid,
                2 * sqrt(greatest(CAST(20 * CAST(s2 AS DECIMAL(30,4))
                         - CAST(s1 AS DECIMAL(18,2)) * CAST(s1 AS DECIMAL(18,2)) AS DOUBLE) / 380, 0)) AS wid
         FROM boll WHERE n = 20)"""


@query(
    "ind_boll",
    with_bindings(
        f"""WITH {_BOLL.strip()}
SELECT b.code, CAST(b.dt AS VARCHAR) AS dt, mid + wid AS boll_upper, mid AS boll_middle,
       mid - wid AS boll_lower,
       CASE WHEN x.code IS NULL THEN NULL WHEN wid = 0 THEN 0.5
            ELSE (CAST(x.close AS DOUBLE) - (mid - wid)) / ((mid + wid) - (mid - wid)) END AS boll_position
FROM fx_bars b LEFT JOIN band x ON x.code = b.code AND x.dt = b.dt""",
        "fx_bars",
    ),
)
def ind_boll(spark, d):
    return _history(spark, d, "boll_upper", "boll_middle", "boll_lower", "boll_position")


def _ret_sql(p: int) -> str:
    lag = f"lag(CAST(close AS DOUBLE), {p}) OVER (PARTITION BY code ORDER BY dt)"
    return f"(CAST(close AS DOUBLE) - {lag}) / nullif({lag}, 0) AS return_{p}d"


@query(
    "ind_return",
    with_bindings(
        "SELECT code, CAST(dt AS VARCHAR) AS dt, " + ", ".join(_ret_sql(p) for p in (5, 10, 20)) + " FROM fx_bars",
        "fx_bars",
    ),
)
def ind_return(spark, d):
    return _history(spark, d, "return_5d", "return_10d", "return_20d")


_SHADOW = """
sh AS (SELECT code, dt,
  CASE WHEN h - l > 0 THEN (h - greatest(o, c)) / (h - l) END AS up,
  CASE WHEN h - l > 0 THEN (least(o, c) - l) / (h - l) END AS lo
 FROM (SELECT code, dt, CAST(open AS DOUBLE) o, CAST(high AS DOUBLE) h, CAST(low AS DOUBLE) l,
              CAST(close AS DOUBLE) c FROM fx_lbars))"""


@query(
    "ind_shadow",
    with_bindings(
        f"WITH {_SHADOW.strip()} SELECT code, CAST(dt AS VARCHAR) AS dt, up AS upper_shadow_ratio,"
        " lo AS lower_shadow_ratio FROM sh",
        "fx_lbars",
    ),
)
def ind_shadow(spark, d):
    return _history_wide(spark, d, "upper_shadow_ratio", "lower_shadow_ratio")


@query(
    "ind_repeated_shadow",
    with_bindings(
        f"""WITH {_SHADOW.strip()}
SELECT code, CAST(dt AS VARCHAR) AS dt,
       CASE WHEN count(up) OVER w = 5 THEN count(CASE WHEN up > 0.6::DOUBLE THEN 1 END) OVER w >= 3 END AS repeated_upper_shadow
FROM sh WINDOW w AS ({_W.format(4)})""",
        "fx_lbars",
    ),
)
def ind_repeated_shadow(spark, d):
    return _history_wide(spark, d, "repeated_upper_shadow")


@query(
    "ind_high_low",
    with_bindings(
        f"""SELECT code, CAST(dt AS VARCHAR) AS dt,
 CASE WHEN count(*) OVER w = 20 THEN CAST(max(high) OVER w AS DOUBLE) END AS high_20d,
 CASE WHEN count(*) OVER w = 20 THEN CAST(min(low) OVER w AS DOUBLE) END AS low_20d
FROM fx_bars WINDOW w AS ({_W.format(19)})""",
        "fx_bars",
    ),
)
def ind_high_low(spark, d):
    return _history(spark, d, "high_20d", "low_20d")


# -- as-of folds ---------------------------------------------------------------

_TAIL = f"""
tail AS (SELECT * FROM (SELECT b.code, a.as_of, b.dt, CAST(b.open AS DOUBLE) AS o, CAST(b.high AS DOUBLE) AS h,
                CAST(b.low AS DOUBLE) AS l, CAST(b.close AS DOUBLE) AS c, b.close AS cd,
                row_number() OVER (PARTITION BY b.code, a.as_of ORDER BY b.dt DESC) AS k
         FROM fx_bars b JOIN (SELECT CAST(unnest(['{AS_OF_DATES[0]}','{AS_OF_DATES[1]}']) AS DATE) AS as_of) a ON b.dt < a.as_of)
         WHERE k <= 250),
ser AS (SELECT code, as_of, count(*) AS n, list({{'h': h, 'l': l, 'c': c}} ORDER BY dt) AS bars FROM tail GROUP BY code, as_of)"""

_RSI_FOLD = """list_reduce(bars, lambda a, x: {
  'i': CASE WHEN a.prev IS NULL THEN 0 ELSE a.i + 1 END, 'prev': x.c,
  'up': CASE WHEN a.prev IS NULL THEN 0::DOUBLE
             WHEN a.i + 1 < 14 THEN a.up + greatest(x.c - a.prev, 0)
             WHEN a.i + 1 = 14 THEN (a.up + greatest(x.c - a.prev, 0)) / 14
             ELSE (a.up * 13 + greatest(x.c - a.prev, 0)) / 14 END,
  'dn': CASE WHEN a.prev IS NULL THEN 0::DOUBLE
             WHEN a.i + 1 < 14 THEN a.dn + greatest(a.prev - x.c, 0)
             WHEN a.i + 1 = 14 THEN (a.dn + greatest(a.prev - x.c, 0)) / 14
             ELSE (a.dn * 13 + greatest(a.prev - x.c, 0)) / 14 END},
  {'i': 0, 'prev': NULL::DOUBLE, 'up': 0::DOUBLE, 'dn': 0::DOUBLE})"""
_RSI = f"""
rsi AS (SELECT code, as_of, CASE WHEN f.i < 14 THEN NULL WHEN f.dn = 0 THEN CASE WHEN f.up > 0 THEN 100::DOUBLE ELSE 50::DOUBLE END
        ELSE 100 - 100 / (1 + f.up / f.dn) END AS rsi14
  FROM (SELECT code, as_of, {_RSI_FOLD} AS f FROM ser))"""

# the check follows the recursion row by row instead of folding an array
_MACD = """
rw AS (SELECT code, as_of, dt, c, row_number() OVER (PARTITION BY code, as_of ORDER BY dt) AS i FROM tail),
ema AS (SELECT code, as_of, i, c, c AS fast, c AS slow FROM rw WHERE i = 1
  UNION ALL
  SELECT r.code, r.as_of, r.i, r.c, r.c * (2::DOUBLE/13) + e.fast * (1::DOUBLE - 2::DOUBLE/13),
         r.c * (2::DOUBLE/27) + e.slow * (1::DOUBLE - 2::DOUBLE/27)
  FROM ema e JOIN rw r ON r.code = e.code AND r.as_of = e.as_of AND r.i = e.i + 1),
dif AS (SELECT code, as_of, i, fast - slow AS dif FROM ema WHERE i >= 26),
dea AS (SELECT code, as_of, i, dif, dif AS dea FROM dif WHERE i = 26
  UNION ALL
  SELECT d.code, d.as_of, d.i, d.dif, d.dif * 0.2::DOUBLE + e.dea * (1::DOUBLE - 0.2::DOUBLE)
  FROM dea e JOIN dif d ON d.code = e.code AND d.as_of = e.as_of AND d.i = e.i + 1),
macd AS (SELECT code, as_of, i, dif, CASE WHEN i >= 34 THEN dea END AS dea, CASE WHEN i >= 34 THEN (dif - dea) * 2 END AS hist,
         row_number() OVER (PARTITION BY code, as_of ORDER BY i DESC) AS k FROM dea),
mlast AS (SELECT code, as_of, max(CASE WHEN k = 1 THEN dif END) AS dif, max(CASE WHEN k = 1 THEN dea END) AS dea,
          max(CASE WHEN k = 1 THEN hist END) AS h0, max(CASE WHEN k = 2 THEN hist END) AS h1, max(CASE WHEN k = 4 THEN hist END) AS h3
  FROM macd GROUP BY code, as_of)"""

_ATR_FOLD = """list_reduce(bars, lambda a, x: {'i': a.i + 1, 'prev': x.c,
    'v': CASE WHEN a.i + 1 < 14 THEN a.v + coalesce(greatest(x.h - x.l, abs(x.h - a.prev), abs(x.l - a.prev)), x.h - x.l)
              WHEN a.i + 1 = 14 THEN (a.v + coalesce(greatest(x.h - x.l, abs(x.h - a.prev), abs(x.l - a.prev)), x.h - x.l)) / 14
              ELSE (a.v * 13 + coalesce(greatest(x.h - x.l, abs(x.h - a.prev), abs(x.l - a.prev)), x.h - x.l)) / 14 END},
    {'i': 0, 'prev': NULL::DOUBLE, 'v': 0::DOUBLE})"""
_ATR = f"atr AS (SELECT code, as_of, CASE WHEN f.i >= 14 THEN f.v END AS atr14, f.prev AS last_close FROM (SELECT code, as_of, {_ATR_FOLD} AS f FROM ser))"


def _as_of(spark, d, *cols):
    r = ind.indicators_as_of(bars(spark, d), AS_OF_DATES)
    return r.select("code", _day("as_of"), *cols)


@query(
    "ind_rsi_as_of",
    with_bindings(f"WITH {_TAIL.strip()}, {_RSI.strip()} SELECT code, CAST(as_of AS VARCHAR) AS as_of, rsi14 FROM rsi", "fx_bars"),
)
def ind_rsi_as_of(spark, d):
    return _as_of(spark, d, "rsi14")


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "ind_macd_as_of",
    _recursive(
        with_bindings(
            f"WITH {_TAIL.strip()}, {_MACD.strip()} SELECT s.code, CAST(s.as_of AS VARCHAR) AS as_of, dif AS macd_dif,"
            " dea AS macd_dea, h0 AS macd_hist FROM ser s LEFT JOIN mlast m ON m.code = s.code AND m.as_of = s.as_of",
            "fx_bars",
        )
    ),
)
def ind_macd_as_of(spark, d):
    return _as_of(spark, d, "macd_dif", "macd_dea", "macd_hist")


@query(
    "ind_momentum_as_of",
    _recursive(
        with_bindings(
            f"WITH {_TAIL.strip()}, {_MACD.strip()} SELECT s.code, CAST(s.as_of AS VARCHAR) AS as_of,"
            " h0 - h1 AS momentum_delta_1, h0 - h3 AS momentum_delta_3,"
            " CASE WHEN h0 - h1 IS NOT NULL AND h0 - h3 IS NOT NULL THEN h0 > h1 AND h0 > h3 END AS momentum_improving"
            " FROM ser s LEFT JOIN mlast m ON m.code = s.code AND m.as_of = s.as_of",
            "fx_bars",
        )
    ),
)
def ind_momentum_as_of(spark, d):
    return _as_of(spark, d, "momentum_delta_1", "momentum_delta_3", "momentum_improving")


@query(
    "ind_atr_as_of",
    with_bindings(
        f"WITH {_TAIL.strip()}, {_ATR.strip()} SELECT code, CAST(as_of AS VARCHAR) AS as_of, atr14,"
        " atr14 / nullif(last_close, 0) * 100 AS atr14_pct FROM atr",
        "fx_bars",
    ),
)
def ind_atr_as_of(spark, d):
    return _as_of(spark, d, "atr14", "atr14_pct")


@query(
    "ind_overheated_as_of",
    with_bindings(
        f"""WITH {_TAIL.strip()}, {_RSI.strip()},
b AS (SELECT code, as_of, count(*) AS n, CAST(sum(cd) AS DOUBLE) / 20 AS mid,
      2 * sqrt(CAST(20 * sum(CAST(cd * cd AS DECIMAL(24,4))) - CAST(sum(cd) AS DECIMAL(18,2)) * CAST(sum(cd) AS DECIMAL(18,2)) AS DOUBLE) / 380) AS wid,
      max(CASE WHEN k = 1 THEN c END) AS c FROM tail WHERE k <= 20 GROUP BY code, as_of)
SELECT r.code, CAST(r.as_of AS VARCHAR) AS as_of,
       r.rsi14 > 70 AND CASE WHEN b.n = 20 THEN CASE WHEN wid = 0 THEN 0.5::DOUBLE ELSE (c - mid + wid) / (2 * wid) END END > 0.8::DOUBLE AS overheated
FROM rsi r JOIN b ON b.code = r.code AND b.as_of = r.as_of""",
        "fx_bars",
    ),
)
def ind_overheated_as_of(spark, d):
    return _as_of(spark, d, "overheated")


@query(
    "ind_meta_as_of",
    with_bindings(
        f"""WITH {_TAIL.strip()},
a AS (SELECT CAST(unnest(['{AS_OF_DATES[0]}','{AS_OF_DATES[1]}']) AS DATE) AS as_of),
c AS (SELECT code, as_of, count(*) AS n, max(dt) AS mx, count(CASE WHEN dt < as_of THEN 1 END) AS kept FROM fx_bars, a GROUP BY code, as_of),
t AS (SELECT code, as_of, min(dt) AS fd, max(dt) AS ld FROM tail GROUP BY code, as_of)
SELECT c.code, CAST(c.as_of AS VARCHAR) AS as_of, n AS input_rows, CAST(mx AS VARCHAR) AS last_trade_date,
  CASE WHEN kept < n THEN n END AS truncated_from, CASE WHEN kept < n THEN kept END AS truncated_to,
  CAST(fd AS VARCHAR) AS first_date, CAST(ld AS VARCHAR) AS last_date,
  mx = DATE '2001-11-01' AS includes_intraday_today
FROM c LEFT JOIN t ON t.code = c.code AND t.as_of = c.as_of""",
        "fx_bars",
    ),
)
def ind_meta_as_of(spark, d):
    m = ind.indicator_meta(bars(spark, d), AS_OF_DATES, "2001-11-01 14:20:00")
    return m.select(
        "code",
        _day("as_of"),
        "input_rows",
        _day("last_trade_date"),
        "truncated_from",
        "truncated_to",
        _day("first_date"),
        _day("last_date"),
        "includes_intraday_today",
    )


# -- every bar as an as-of date --------------------------------------------------

_FRAMES = f"""
ser AS (SELECT code, dt AS as_of, CAST(close AS DOUBLE) AS c,
          list({{'h': CAST(high AS DOUBLE), 'l': CAST(low AS DOUBLE), 'c': CAST(close AS DOUBLE)}}) OVER ({_W.format(ind.MAX_BARS - 1)}) AS bars
        FROM fx_bars)"""


def _macd_fold() -> str:
    fast, slow = (
        f"(CASE WHEN a.i = 0 THEN x.c ELSE x.c * (2::DOUBLE/{n}) + a.{name} * (1::DOUBLE - 2::DOUBLE/{n}) END)"
        for n, name in ((13, "fast"), (27, "slow"))
    )
    dif = f"({fast} - {slow})"
    dea = f"(CASE WHEN a.i + 1 >= 26 THEN coalesce({dif} * 0.2::DOUBLE + a.dea * (1::DOUBLE - 0.2::DOUBLE), {dif}) END)"
    none = ", ".join(f"'{x}': NULL::DOUBLE" for x in ("fast", "slow", "dif", "dea", "h0", "h1", "h2", "h3"))
    return f"""list_reduce(bars, lambda a, x: {{'i': a.i + 1, 'fast': {fast}, 'slow': {slow},
  'dif': CASE WHEN a.i + 1 >= 26 THEN {dif} END, 'dea': {dea},
  'h0': CASE WHEN a.i + 1 >= 34 THEN ({dif} - {dea}) * 2 END, 'h1': a.h0, 'h2': a.h1, 'h3': a.h2}}, {{'i': 0, {none}}})"""


_MACD_FRAMES = f"macd AS (SELECT code, as_of, {_macd_fold()} AS f FROM ser)"


def _frame_sql(ctes: str, select: str) -> str:
    return with_bindings(f"WITH {_FRAMES.strip()}, {ctes.strip()} {select}", "fx_bars")


def _recursive_history(spark, d, wanted, *cols):
    return recursions.recursive_history(bars(spark, d), wanted=wanted).select("code", _day(), *(cols or wanted))


@query("ind_rsi", _frame_sql(_RSI, "SELECT code, CAST(as_of AS VARCHAR) AS dt, rsi14 FROM rsi"))
def ind_rsi(spark, d):
    return _recursive_history(spark, d, ["rsi14"])


@query(
    "ind_macd",
    _frame_sql(
        _MACD_FRAMES,
        "SELECT code, CAST(as_of AS VARCHAR) AS dt, f.dif AS macd_dif, CASE WHEN f.i >= 34 THEN f.dea END AS macd_dea, f.h0 AS macd_hist FROM macd",
    ),
)
def ind_macd(spark, d):
    return _recursive_history(spark, d, ["macd_dif", "macd_dea", "macd_hist"])


@query(
    "ind_momentum",
    _frame_sql(
        _MACD_FRAMES,
        "SELECT code, CAST(as_of AS VARCHAR) AS dt, f.h0 - f.h1 AS momentum_delta_1, f.h0 - f.h3 AS momentum_delta_3,"
        " CASE WHEN f.h0 - f.h1 IS NOT NULL AND f.h0 - f.h3 IS NOT NULL THEN f.h0 > f.h1 AND f.h0 > f.h3 END AS momentum_improving FROM macd",
    ),
)
def ind_momentum(spark, d):
    return _recursive_history(spark, d, ["macd_hist", "macd_hist_1", "macd_hist_3"], "momentum_delta_1", "momentum_delta_3", "momentum_improving")


@query(
    "ind_atr",
    _frame_sql(
        _ATR,
        "SELECT code, CAST(as_of AS VARCHAR) AS dt, atr14, atr14 / nullif(last_close, 0) * 100 AS atr14_pct FROM atr",
    ),
)
def ind_atr(spark, d):
    return _recursive_history(spark, d, ["atr14"], "atr14", "atr14_pct")


@query(
    "ind_overheated",
    _frame_sql(
        f"{_RSI.strip()}, {_BOLL.strip()}",
        """SELECT r.code, CAST(r.as_of AS VARCHAR) AS dt,
       r.rsi14 > 70 AND CASE WHEN b.code IS NULL THEN NULL WHEN wid = 0 THEN 0.5::DOUBLE
            ELSE (CAST(b.close AS DOUBLE) - (mid - wid)) / ((mid + wid) - (mid - wid)) END > 0.8::DOUBLE AS overheated
FROM rsi r LEFT JOIN band b ON b.code = r.code AND b.dt = r.as_of""",
    ),
)
def ind_overheated(spark, d):
    return recursions.overheated_history(bars(spark, d)).select("code", _day(), "overheated")


_META_SQL = f"""SELECT code, CAST(dt AS VARCHAR) AS dt, count(*) OVER p AS input_rows, CAST(max(dt) OVER p AS VARCHAR) AS last_trade_date,
  CASE WHEN k < count(*) OVER p THEN count(*) OVER p END AS truncated_from, CASE WHEN k < count(*) OVER p THEN k END AS truncated_to,
  CAST(first_date AS VARCHAR) AS first_date, CAST(dt AS VARCHAR) AS last_date, frame_rows,
  max(dt) OVER p = DATE '1998-11-27' AS includes_intraday_today
FROM (SELECT code, dt, row_number() OVER (PARTITION BY code ORDER BY dt) AS k, min(dt) OVER w AS first_date, count(*) OVER w AS frame_rows
      FROM fx_bars WINDOW w AS ({_W.format(ind.MAX_BARS - 1)})) WINDOW p AS (PARTITION BY code)"""


@query("ind_meta", with_bindings(_META_SQL, "fx_bars"))
def ind_meta(spark, d):
    m = recursions.frame_meta(bars(spark, d), "1998-11-27 14:20:00")
    days = ("dt", "last_trade_date", "first_date", "last_date")
    return m.select(*[_day(c) if c in days else c for c in m.columns])


@query(
    "flt_cutoff_history",
    with_bindings(
        f"""SELECT code, CAST(dt AS VARCHAR) AS as_of, CAST(first_date AS VARCHAR) AS first_date, frame_rows, k - frame_rows AS older_rows
FROM (SELECT code, dt, row_number() OVER (PARTITION BY code ORDER BY dt) AS k, min(dt) OVER w AS first_date, count(*) OVER w AS frame_rows
      FROM fx_bars WINDOW w AS ({_W.format(ind.MAX_BARS - 1)}))""",
        "fx_bars",
    ),
)
def flt_cutoff_history(spark, d):
    """The frame of every as-of date as bounds: a bar belongs to it from ``first_date`` on."""
    m = recursions.frame_meta(bars(spark, d), "1998-11-27 14:20:00")
    older = F.coalesce("truncated_to", "input_rows") - F.col("frame_rows")
    return m.select("code", F.col("dt").cast("string").alias("as_of"), _day("first_date"), "frame_rows", older.alias("older_rows"))


@query(
    "flt_cutoff",
    with_bindings(
        f"WITH {_TAIL.strip()} SELECT code, CAST(as_of AS VARCHAR) AS as_of, CAST(dt AS VARCHAR) AS dt, c AS close, k FROM tail",
        "fx_bars",
    ),
)
def flt_cutoff(spark, d):
    return ind.cutoff(bars(spark, d), AS_OF_DATES).select(
        "code", _day("as_of"), _day(), dbl("close").alias("close"), F.col("k").cast("bigint").alias("k")
    )


@query(
    "ind_vwap",
    with_bindings(
        "SELECT code, CAST(CAST(ts AS DATE) AS VARCHAR) AS trade_date,"
        " CAST(sum(amount) AS DOUBLE) / nullif(CAST(sum(volume) AS DOUBLE), 0) AS vwap FROM fx_ticks GROUP BY code, CAST(ts AS DATE)",
        "fx_ticks",
    ),
)
def ind_vwap(spark, d):
    t = ticks(spark, d).withColumn("trade_date", F.to_date("ts"))
    return ind.vwap(t, ["code", "trade_date"]).select("code", _day("trade_date"), "vwap")


_AVG5 = f"""
avg5 AS (SELECT code, CAST(sum(volume) AS DOUBLE) / 5 AS avg5_volume FROM (
   SELECT code, volume, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars
   WHERE volume > 0 AND dt < DATE '{AS_OF}') WHERE k <= 5 GROUP BY code HAVING count(*) = 5)"""


@query("ind_avg5_volume", with_bindings(f"WITH {_AVG5.strip()} SELECT * FROM avg5", "fx_bars"))
def ind_avg5_volume(spark, d):
    return ind.average_volume(bars(spark, d), AS_OF)


@query(
    "ind_volume_ratio",
    with_bindings(
        f"""WITH {_AVG5.strip()}
SELECT s.code, CAST(CAST(CASE WHEN s.volume > 0 AND avg5_volume > 0 THEN CAST(s.volume AS DOUBLE) / (avg5_volume * (95 / 240::DOUBLE)) END
        AS DECIMAL(28,10)) AS DECIMAL(28,4))::DOUBLE AS volume_ratio, 5 AS volume_ratio_window,
       'intraday_pace_vs_prev_5d' AS volume_ratio_method, 95 AS elapsed_trade_minutes
FROM fx_snapshot s LEFT JOIN avg5 a ON a.code = s.code""",
        "fx_snapshot",
    ),
)
def ind_volume_ratio(spark, d):
    elapsed = st.elapsed_minutes(st.ntz("2001-11-30 11:05:20"))
    out = ind.volume_ratio(snapshot(spark, d), ind.average_volume(bars(spark, d), AS_OF), elapsed)
    return out.select("code", "volume_ratio", "volume_ratio_window", "volume_ratio_method", "elapsed_trade_minutes")


@query(
    "ind_index",
    with_bindings(
        """WITH t AS (SELECT code, dt, CAST(close AS DOUBLE) AS c, close AS cd, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars),
a AS (SELECT code, count(*) AS n, max(CASE WHEN k = 1 THEN dt END) AS dt, max(CASE WHEN k = 1 THEN c END) AS close,
  max(CASE WHEN k = 2 THEN c END) AS pre_close,
  CAST(sum(CASE WHEN k <= 5 THEN cd END) AS DOUBLE) AS s5, CAST(sum(CASE WHEN k <= 10 THEN cd END) AS DOUBLE) AS s10,
  CAST(sum(CASE WHEN k <= 20 THEN cd END) AS DOUBLE) AS s20, CAST(sum(CASE WHEN k <= 60 THEN cd END) AS DOUBLE) AS s60,
  max(CASE WHEN k = 6 THEN c END) AS c5, max(CASE WHEN k = 11 THEN c END) AS c10, max(CASE WHEN k = 21 THEN c END) AS c20
  FROM t WHERE k <= 250 GROUP BY code)
SELECT a.code, CAST(a.dt AS VARCHAR) AS dt, a.close, a.pre_close, (close - pre_close) / nullif(pre_close, 0) * 100 AS pct_chg,
  CASE WHEN n >= 5 THEN s5 / 5 END AS ma5, CASE WHEN n >= 10 THEN s10 / 10 END AS ma10, CASE WHEN n >= 20 THEN s20 / 20 END AS ma20,
  s60 / least(n, 60) AS ma60, (close - c5) / nullif(c5, 0) AS return_5d, (close - c10) / nullif(c10, 0) AS return_10d,
  (close - c20) / nullif(c20, 0) AS return_20d,
  CASE WHEN d.k % 2 = 0 THEN CAST(d.acctbal AS DOUBLE) ELSE close END AS intraday_price,
  CASE WHEN d.k % 2 = 0 THEN '10:31:00' ELSE CAST(a.dt AS VARCHAR) END AS quote_time
FROM a LEFT JOIN fx_dims d ON d.code = a.code WHERE n >= 5""",
        "fx_pbars",
        "fx_dims",
    ).replace("FROM fx_bars)", "FROM fx_pbars)"),
)
def ind_index(spark, d):
    live = (
        dims(spark, d)
        .where(F.col("k") % 2 == 0)
        .select("code", F.col("acctbal").alias("price"), F.lit(1.0).alias("change_pct"), F.lit("10:31:00").alias("quote_time"))
    )
    out = ind.index_indicators(bars(spark, d, "l_partkey"), live)
    return out.select(
        "code", _day(), "close", "pre_close", "pct_chg", "ma5", "ma10", "ma20", "ma60",
        "return_5d", "return_10d", "return_20d", "intraday_price", "quote_time",
    )


@query(
    "ind_quality",
    with_bindings(
        """SELECT code, least(count(*), 250) AS actual_rows, least(count(*), 250) < 50 AS insufficient,
 CASE WHEN least(count(*), 250) < 250 THEN 'short_history' END AS reason
FROM (SELECT code, dt FROM fx_pbars UNION ALL SELECT 'S' || code, dt FROM fx_bars) GROUP BY code""",
        "fx_bars",
        "fx_pbars",
    ),
)
def ind_quality(spark, d):
    both = bars(spark, d, "l_partkey").select("code", "dt").unionByName(
        bars(spark, d).select(F.concat(F.lit("S"), F.col("code")).alias("code"), "dt")
    )
    return ind.history_quality(both)


@query(
    "ind_quality_coverage",
    with_bindings(
        """WITH n AS (SELECT code, count(*) AS n FROM fx_pbars WHERE dt < DATE '2001-12-01' GROUP BY code)
SELECT count(*) AS records, count(CASE WHEN n >= 5 THEN 1 END) AS any_valid, count(CASE WHEN n >= 60 THEN 1 END) AS all_valid,
 count(CASE WHEN n < 5 THEN 1 END) AS all_empty FROM n""",
        "fx_pbars",
    ),
)
def ind_quality_coverage(spark, d):
    r = ind.indicators_as_of(bars(spark, d, "l_partkey"), [AS_OF])
    return ind.indicator_coverage(r, ["ma5", "ma20", "ma60"])


@query(
    "ind_overnight_gap",
    with_bindings(
        """WITH t AS (SELECT code, dt, open, close, row_number() OVER (PARTITION BY code ORDER BY dt DESC) AS k FROM fx_bars),
g AS (SELECT code, CAST(open AS DOUBLE) / nullif(lag(CAST(close AS DOUBLE)) OVER (PARTITION BY code ORDER BY dt), 0) - 1 AS gap FROM t WHERE k <= 251),
l AS (SELECT code, count(gap) AS n, list(gap ORDER BY gap) FILTER (WHERE gap IS NOT NULL) AS gs FROM g GROUP BY code)
SELECT code, n AS gaps, CASE WHEN n >= 60 THEN CAST(CAST(gs[CAST(floor(n * 0.9::DOUBLE) AS INT) + 1] AS DECIMAL(28,10)) AS DECIMAL(28,4))::DOUBLE END AS overnight_gap_p90,
  coalesce(CASE WHEN n >= 60 THEN gs[CAST(floor(n * 0.9::DOUBLE) AS INT) + 1] >= 0.04::DOUBLE END, false) AS overnight_gap_warning,
  CASE WHEN n >= 60 THEN 'ok' ELSE 'history_insufficient' END AS status
FROM l WHERE n > 0""",
        "fx_bars",
    ),
)
def ind_overnight_gap(spark, d):
    return ind.overnight_gap(bars(spark, d))
