"""Confirmation, barrier race, selection and position size: queries and their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions.numeric import dbl
from barlake.operators import outcomes as oc
from barlake.operators import screening as sc
from barlake.plans.bindings import code_of, session_bars, session_days, snapshot, table, with_bindings
from barlake.plans.registry import query

_CONFIRM = f"""b AS (SELECT code, trade_date, ts, m, CAST(close AS DOUBLE) AS close, volume, amount, CASE WHEN m <= 690 THEN m - 570 ELSE m - 659 END AS i FROM fx_session),
w AS (SELECT *, count(*) OVER t = 3 AND i - min(i) OVER t = 2 AS whole, sum(amount) OVER t AS a3, min(close) OVER t AS lc, first(close) OVER t AS fc, min(volume) OVER t AS mv, min(amount) OVER t AS ma
  FROM b WINDOW t AS (PARTITION BY code, trade_date ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
z AS (SELECT x.code, x.trade_date, x.ts, x.m, x.close, x.lc, x.fc, x.mv, x.ma, CAST(x.a3 AS DOUBLE) AS amount_3m, median(CAST(y.a3 AS DOUBLE)) AS base_median
  FROM w x LEFT JOIN w y ON y.code = x.code AND y.trade_date = x.trade_date AND y.whole AND y.i BETWEEN x.i - 15 AND x.i - 3 WHERE x.whole GROUP BY ALL),
c AS (SELECT z.code, z.trade_date, z.ts, amount_3m, base_median, lc >= CAST(d.pre_close AS DOUBLE) AS holds_trigger, m <= {oc.CONFIRM_CUTOFF} AS in_time, mv > 0 AND ma > 0 AS traded,
  close >= fc AS not_falling, coalesce(amount_3m >= base_median * 0.9::DOUBLE, false) AS active FROM z JOIN fx_sdays d ON d.code = z.code AND d.trade_date = z.trade_date)"""


def _confirmations(spark, d):
    triggers = session_days(spark, d).select("code", "trade_date", F.col("pre_close").alias("trigger"))
    return oc.confirmations(session_bars(spark, d), triggers)


@query(
    "min_confirmation",
    with_bindings(
        f"""WITH {_CONFIRM} SELECT code, CAST(trade_date AS VARCHAR) AS trade_date, CAST(ts AS VARCHAR) AS ts, amount_3m, base_median, holds_trigger, in_time, traded, not_falling, active,
 holds_trigger AND in_time AND traded AND not_falling AND active AS confirmed FROM c""",
        "fx_session",
        "fx_sdays",
    ),
)
def min_confirmation(spark, d):
    c = _confirmations(spark, d)
    return c.withColumns({n: F.col(n).cast("string") for n in ("trade_date", "ts")})


@query(
    "min_first_confirmation",
    with_bindings(
        f"""WITH {_CONFIRM} SELECT code, CAST(trade_date AS VARCHAR) AS trade_date, CAST(min(ts) AS VARCHAR) AS confirmed_at FROM c
 WHERE holds_trigger AND in_time AND traded AND not_falling AND active GROUP BY code, trade_date""",
        "fx_session",
        "fx_sdays",
    ),
)
def min_first_confirmation(spark, d):
    c = oc.first_confirmation(_confirmations(spark, d))
    return c.withColumns({n: F.col(n).cast("string") for n in ("trade_date", "confirmed_at")})


_FACTORS = {"zone1": 1.1, "zone2": 1.3, "protection": 0.8}


def _plans(spark, d):
    """A theoretical entry at every fifth minute bar: two zones above the close, a protection below."""
    close = dbl("close")
    return (
        session_bars(spark, d)
        .where(F.minute("ts") % 5 == 0)
        .select(
            F.concat_ws("|", "code", F.col("ts").cast("string")).alias("plan"), "code", "trade_date", F.col("ts").alias("entry_ts"),
            *[(close * f).alias(n) for n, f in _FACTORS.items()],
        )
    )


@query(
    "min_first_passage",
    with_bindings(
        """WITH p AS (SELECT code || '|' || CAST(ts AS VARCHAR) AS plan, code, trade_date, ts AS entry_ts, CAST(close AS DOUBLE) * 1.1::DOUBLE AS z1, CAST(close AS DOUBLE) * 1.3::DOUBLE AS z2, CAST(close AS DOUBLE) * 0.8::DOUBLE AS pr FROM fx_session WHERE m % 60 % 5 = 0),
q AS (SELECT p.plan, min(CASE WHEN CAST(b.high AS DOUBLE) >= z1 THEN b.ts END) AS a1, min(CASE WHEN CAST(b.high AS DOUBLE) >= z2 THEN b.ts END) AS a2, min(CASE WHEN CAST(b.low AS DOUBLE) <= pr THEN b.ts END) AS ap
  FROM p LEFT JOIN fx_session b ON b.code = p.code AND b.trade_date = p.trade_date AND b.ts > p.entry_ts GROUP BY p.plan)
SELECT plan, CAST(a1 AS VARCHAR) AS zone1_at, CAST(a2 AS VARCHAR) AS zone2_at, CAST(ap AS VARCHAR) AS protection_at,
 CASE WHEN a1 IS NULL AND ap IS NULL THEN 'neither' WHEN ap IS NULL OR a1 < ap THEN 'first_zone_before_protection' WHEN a1 IS NULL OR ap < a1 THEN 'protection_before_first_zone' ELSE 'same_bar' END AS label FROM q""",
        "fx_session",
    ),
)
def min_first_passage(spark, d):
    t = oc.first_passages(_plans(spark, d), session_bars(spark, d), {"zone1": "zone1", "zone2": "zone2"}, {"protection": "protection"})
    t = t.withColumn("label", oc.race_label(F.col("zone1_at"), F.col("protection_at")))
    return t.withColumns({f"{n}_at": F.col(f"{n}_at").cast("string") for n in _FACTORS})


@query(
    "scr_actionable",
    """WITH c AS (SELECT c_mktsegment AS profile, c_nationkey AS day, printf('%06d', CAST(c_custkey AS BIGINT)) AS code, 'I' || c_custkey % 6 AS industry, ['strong','moderate','weak','poor','?'][c_custkey % 5 + 1] AS q, ['low','medium','high','?'][c_custkey % 4 + 1] AS t,
 CASE WHEN c_custkey % 7 <> 0 THEN floor(c_acctbal / 1000) END AS rr FROM customer),
r AS (SELECT profile, day, code, industry, CAST(row_number() OVER (PARTITION BY profile, day ORDER BY CASE q WHEN 'strong' THEN 3 WHEN 'moderate' THEN 2 WHEN 'weak' THEN 1 ELSE 0 END DESC, CASE t WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, coalesce(rr, 0) DESC, code) AS INT) AS position FROM c),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY profile, day, industry ORDER BY position) = 1),
p AS (SELECT profile, day, position, CAST(row_number() OVER (PARTITION BY profile, day ORDER BY position) AS INT) AS pick FROM b QUALIFY pick <= 3)
SELECT r.*, p.pick, CASE WHEN p.pick IS NOT NULL THEN 'actionable_candidate' ELSE 'conditional_watch' END AS label FROM r LEFT JOIN p ON p.profile = r.profile AND p.day = r.day AND p.position = r.position""",
)
def scr_actionable(spark, d):
    k = F.col("c_custkey")
    word = lambda n, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (k % n + 1).cast("int"))
    c = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("profile"),
        F.col("c_nationkey").alias("day"),
        code_of(k).alias("code"),
        F.concat(F.lit("I"), (k % 6).cast("string")).alias("industry"),
        word(5, "strong", "moderate", "weak", "poor", "?").alias("opportunity_quality"),
        word(4, "low", "medium", "high", "?").alias("tail_risk"),
        F.when(k % 7 != 0, F.floor(F.col("c_acctbal") / 1000)).alias("reward_risk_ratio"),
    )
    ranked = sc.rank_substitutes(c, ["profile", "day"]).select("profile", "day", "code", "industry", "position")
    return oc.actionable(ranked, ["profile", "day"], "industry")


@query(
    "scr_position_size",
    with_bindings(
        """WITH u AS (SELECT code, CAST(price AS DOUBLE) / 1000 AS e, CAST(price AS DOUBLE) / 1000 * (0.99::DOUBLE - k % 7 * 0.01::DOUBLE) AS s, CAST(price AS DOUBLE) / 1000 * 0.9::DOUBLE AS f,
  CAST(1000 * (k % 90) AS DOUBLE) AS mc, CAST(k % 50 * 20 AS DOUBLE) AS ml, CAST(k % 80 * 40 AS DOUBLE) AS ms FROM fx_snapshot),
q AS (SELECT u.*, CAST(n AS BIGINT) AS n FROM u, range(0, 200000, 100) t(n)),
a AS (SELECT *, e * n + greatest(e * n * 0.0003::DOUBLE, 5) + e * n * 0.00001::DOUBLE AS cap,
  (e - s) * n + (greatest(e * n * 0.0003::DOUBLE, 5) + greatest(s * n * 0.0003::DOUBLE, 5) + s * n * 0.0005::DOUBLE + (e * n + s * n) * 0.00001::DOUBLE) AS ls,
  (e - f) * n + (greatest(e * n * 0.0003::DOUBLE, 5) + greatest(f * n * 0.0003::DOUBLE, 5) + f * n * 0.0005::DOUBLE + (e * n + f * n) * 0.00001::DOUBLE) AS st FROM q),
m AS (SELECT code, coalesce(max(CASE WHEN n > 0 AND cap <= mc AND ls <= ml AND st <= ms THEN n END), 0) AS shares FROM a GROUP BY code)
SELECT m.code, m.shares, CASE WHEN m.shares > 0 THEN cap ELSE 0 END AS capital, CASE WHEN m.shares > 0 THEN ls ELSE 0 END AS planned_loss, CASE WHEN m.shares > 0 THEN st ELSE 0 END AS stress_loss
FROM m JOIN a ON a.code = m.code AND a.n = m.shares""",
        "fx_snapshot",
    ),
)
def scr_position_size(spark, d):
    price, k = dbl("price") / 1000, F.col("k")
    u = snapshot(spark, d).select(
        "code", price.alias("entry"), (price * (F.lit(0.99) - k % 7 * 0.01)).alias("protection"), (price * 0.9).alias("limit_down"),
        (k % 90 * 1000).cast("double").alias("max_capital"), (k % 50 * 20).cast("double").alias("max_loss"), (k % 80 * 40).cast("double").alias("max_stress"),
    )
    return oc.position_size(u).select("code", "shares", "capital", "planned_loss", "stress_loss")
