"""Lifecycle queries and their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions import session_time as st
from barlake.functions.numeric import dbl, round_dec
from barlake.operators import lifecycle as lc
from barlake.operators import minutes as mn
from barlake.operators import normalize as nz
from barlake.plans.bindings import code_of, dims, r2, session_bars, session_days, table, with_bindings
from barlake.plans.catalog_sources import _records
from barlake.plans.registry import query

_PATH = ("deep_watch", "conditional_watch", "confirmed_candidate", "plan_published", "entry_active", "canceled", "execution_unknown")
_XPATH = (
    "next_open_observe", "intraday_position_monitor", "time_exit", "exit_unavailable", "subsequent_session_exit_watch",
    "user_deviation_hold", "subsequent_session_exit_watch", "execution_unknown",
)


def _q(items):
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


def _legal(t):
    return "[" + ", ".join(f"'{a}>{b}'" for a, bs in t.items() for b in bs) + "]"


def _at(items, i):
    return F.element_at(F.array(*[F.lit(x) for x in items]), (i + 1).cast("int"))


def _entry_events(spark, d):
    """Conversation turns: mostly the regular path, every fourth event a jump to any state."""
    c = table(spark, d, "conversations")
    e, n = F.col("conv_id"), F.col("turn")
    jump = _at(tuple(lc.ENTRY_TRANSITIONS), (e * 7 + n) % 14)
    step = _at(_PATH, n % len(_PATH))
    return c.select(e.alias("entity"), n.alias("seq"), F.when((e + n) % 4 == 3, jump).otherwise(step).alias("to_state"))


def _replay_sql(events: str, legal: dict, start: str) -> str:
    return f"""ev AS ({events}), rw AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY seq) AS i FROM ev),
rp AS (SELECT entity, seq, i, to_state, CAST('{start}' AS VARCHAR) AS from_state, list_contains({_legal(legal)}, '{start}>' || to_state) AS legal,
  CASE WHEN list_contains({_legal(legal)}, '{start}>' || to_state) THEN to_state ELSE '{start}' END AS state_after FROM rw WHERE i = 1
 UNION ALL SELECT r.entity, r.seq, r.i, r.to_state, p.state_after, list_contains({_legal(legal)}, p.state_after || '>' || r.to_state),
  CASE WHEN list_contains({_legal(legal)}, p.state_after || '>' || r.to_state) THEN r.to_state ELSE p.state_after END FROM rp p JOIN rw r ON r.entity = p.entity AND r.i = p.i + 1)"""


_ENTRY = _replay_sql(
    f"""SELECT conv_id AS entity, turn AS seq, CASE WHEN (conv_id + turn) % 4 = 3 THEN {_q(lc.ENTRY_TRANSITIONS)}[(conv_id * 7 + turn) % 14 + 1] ELSE {_q(_PATH)}[turn % 7 + 1] END AS to_state FROM conversations""",
    lc.ENTRY_TRANSITIONS,
    lc.ENTRY_START,
)
_EXIT = _replay_sql(
    f"""SELECT o_custkey % 40 AS entity, o_orderkey AS seq, CASE WHEN o_orderkey % 5 = 4 THEN {_q(lc.EXIT_TRANSITIONS)}[(o_orderkey * 7) % 14 + 1] ELSE {_q(_XPATH)}[o_orderkey % 8 + 1] END AS to_state FROM orders""",
    lc.EXIT_TRANSITIONS,
    lc.EXIT_START,
)
_SUM = """SELECT entity, max_by(state_after, seq) AS current_state, count(CASE WHEN legal THEN 1 END) AS transitions, count(CASE WHEN NOT legal THEN 1 END) AS illegal_events, min(CASE WHEN NOT legal THEN seq END) AS first_illegal_seq FROM rp GROUP BY entity"""


@query("st_entry_replay", f"WITH RECURSIVE {_ENTRY} SELECT entity, seq, to_state, from_state, legal, state_after FROM rp")
def st_entry_replay(spark, d):
    return lc.entry_replay(_entry_events(spark, d))


@query(
    "st_entry_summary",
    f"WITH RECURSIVE {_ENTRY}, s AS ({_SUM}) SELECT *, current_state IN ('deep_watch', 'conditional_watch', 'confirmed_candidate') AS in_candidate_pool, current_state = 'entry_active' AS is_buyable FROM s",
)
def st_entry_summary(spark, d):
    return lc.entry_summary(lc.entry_replay(_entry_events(spark, d)))


def _exit_events(spark, d):
    """Orders of forty accounts: long logs that span many blocks."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    to = F.when(k % 5 == 4, _at(tuple(lc.EXIT_TRANSITIONS), (k * 7) % 14)).otherwise(_at(_XPATH, k % 8))
    return o.select((F.col("o_custkey") % 40).alias("entity"), k.alias("seq"), to.alias("to_state"))


@query("st_exit_replay", f"WITH RECURSIVE {_EXIT} SELECT entity, seq, to_state, from_state, legal, state_after FROM rp")
def st_exit_replay(spark, d):
    return lc.exit_replay(_exit_events(spark, d))


@query(
    "st_exit_summary",
    f"WITH RECURSIVE {_EXIT}, s AS ({_SUM}) SELECT *, current_state NOT IN ('closed', 'execution_unknown') AS is_active_position, current_state IN ('next_open_observe', 'intraday_position_monitor', 'subsequent_session_exit_watch') AS needs_exit_intent FROM s",
)
def st_exit_summary(spark, d):
    return lc.exit_summary(lc.exit_replay(_exit_events(spark, d)))


def _slot_events(spark, d):
    """Orders as slot events of sixty (profile, date) slots; an occupy names a recent decision."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    m = F.col("o_custkey") % 9
    action = F.when(m <= 3, "reserve").when(m <= 6, "occupy").when((m == 7) | (F.col("o_custkey") % 90 != 8), "release").otherwise("cutoff")
    return o.select(
        (F.col("o_orderkey") % 60).alias("entity"),
        k.alias("seq"),
        action.alias("action"),
        F.when(m <= 3, k).otherwise(k - 60 * (k % 3 + 1)).cast("string").alias("decision_id"),
        code_of((k % 1000)).alias("code"),
        (F.col("o_totalprice") > 100000).alias("can_reassign"),
    )


@query(
    "st_slot",
    """WITH RECURSIVE ev AS (SELECT o_orderkey % 60 AS entity, o_orderkey AS seq, o_custkey % 9 AS m, CASE WHEN o_custkey % 9 <= 3 THEN 'reserve' WHEN o_custkey % 9 <= 6 THEN 'occupy' WHEN o_custkey % 9 = 7 OR o_custkey % 90 <> 8 THEN 'release' ELSE 'cutoff' END AS action,
  CAST(CASE WHEN o_custkey % 9 <= 3 THEN o_orderkey ELSE o_orderkey - 60 * (o_orderkey % 3 + 1) END AS VARCHAR) AS dec, printf('%06d', CAST(o_orderkey % 1000 AS BIGINT)) AS code, o_totalprice > 100000 AS can FROM orders),
rw AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY seq) AS i FROM ev),
rp AS (SELECT entity, 0::BIGINT AS i, 'free' AS slot, NULL::VARCHAR AS cur, NULL::VARCHAR AS cc, false AS cut, 0::BIGINT AS nr, 0::BIGINT AS no FROM (SELECT DISTINCT entity FROM ev)
 UNION ALL
 SELECT r.entity, r.i,
  CASE WHEN action = 'reserve' AND slot IN ('free', 'released') AND NOT cut THEN 'reserved' WHEN action = 'occupy' AND slot = 'reserved' AND cur = dec THEN 'occupied'
   WHEN action = 'release' AND slot = 'occupied' AND NOT can THEN 'occupied' WHEN action = 'release' AND slot IN ('reserved', 'occupied') THEN CASE WHEN can THEN 'released' ELSE 'occupied' END
   WHEN action = 'cutoff' AND slot <> 'occupied' THEN 'empty_after_cutoff' ELSE slot END,
  CASE WHEN action = 'reserve' AND slot IN ('free', 'released') AND NOT cut THEN dec ELSE cur END, CASE WHEN action = 'reserve' AND slot IN ('free', 'released') AND NOT cut THEN code ELSE cc END, cut OR action = 'cutoff',
  nr + CASE WHEN action = 'reserve' AND slot IN ('free', 'released') AND NOT cut THEN 1 ELSE 0 END, no + CASE WHEN action = 'occupy' AND slot = 'reserved' AND cur = dec THEN 1 ELSE 0 END
 FROM rp p JOIN rw r ON r.entity = p.entity AND r.i = p.i + 1)
SELECT entity, CASE WHEN max_by(cut, i) AND max_by(slot, i) <> 'occupied' THEN 'empty_after_cutoff' ELSE max_by(slot, i) END AS status, max(nr) AS reservations, max(no) AS occupations, max_by(cc, i) AS current_code, max_by(cur, i) AS current_decision FROM rp GROUP BY entity""",
)
def st_slot(spark, d):
    return lc.slot_replay(_slot_events(spark, d))


@query(
    "st_exit_priority",
    """WITH e AS (SELECT o_custkey AS pos, ['profit_protection','structural_stop_exit','target_exit','failed_open_exit','time_exit','exit_unavailable'][o_orderkey % 6 + 1] AS event, CASE WHEN o_orderkey % 2 = 0 THEN '09:40' ELSE '10:10' END AS t FROM orders),
p AS (SELECT pos, event, CASE event WHEN 'structural_stop_exit' THEN 1 WHEN 'target_exit' THEN 2 WHEN 'failed_open_exit' THEN 3 WHEN 'profit_protection' THEN 4 WHEN 'time_exit' THEN 5 ELSE 99 END AS pr FROM e WHERE NOT (t <= '09:45' AND event = 'profit_protection'))
SELECT pos, min_by(event, pr) AS exit_event FROM p GROUP BY pos""",
)
def st_exit_priority(spark, d):
    k = F.col("o_orderkey")
    words = ("profit_protection", "structural_stop_exit", "target_exit", "failed_open_exit", "time_exit", "exit_unavailable")
    e = table(spark, d, "orders").select(
        F.col("o_custkey").alias("pos"), _at(words, k % 6).alias("event"), F.when(k % 2 == 0, "09:40").otherwise("10:10").alias("time")
    )
    return lc.exit_priority(e, ["pos"])


def _exec_bars(spark, d):
    m = st.minute_of_day("ts")
    return session_bars(spark, d).withColumns(
        {
            "limit_price": F.when(m % 3 == 0, F.col("high")).otherwise(F.lit(9999).cast("decimal(12,2)")),
            "is_suspended": F.col("code") == "000007",
            "in_session": ((m >= 570) & (m < 690)) | ((m >= 780) & (m < 897)),
        }
    )


_EXEC = """CASE WHEN code = '000007' THEN 'suspended' WHEN NOT (m >= 570 AND m < 690 OR m >= 780 AND m < 897) THEN 'not_in_continuous_session' WHEN m % 3 = 0 AND open = high AND low = high AND close = high THEN '{0}'
 WHEN volume < 50 THEN 'insufficient_volume' ELSE 'normal_executable' END"""


@query(
    "st_executable",
    with_bindings(
        f"""WITH x AS (SELECT 'buy' AS side, code, trade_date, ts, close, {_EXEC.format('one_side_limit_up')} AS exec_reason FROM fx_session UNION ALL SELECT 'sell', code, trade_date, ts, close, {_EXEC.format('one_side_limit_down')} FROM fx_session)
SELECT side, code, CAST(ts AS VARCHAR) AS ts, exec_reason, CASE WHEN exec_reason = 'normal_executable' THEN 'executable' ELSE 'unavailable' END AS executability, CASE WHEN exec_reason = 'normal_executable' THEN CAST(close AS DOUBLE) END AS proxy_price,
 CASE WHEN exec_reason = 'normal_executable' THEN 50 ELSE 0 END AS proxy_quantity FROM x""",
        "fx_session",
    ),
)
def st_executable(spark, d):
    b = _exec_bars(spark, d)
    cols = ["code", F.col("ts").cast("string").alias("ts"), "exec_reason", "executability", "proxy_price", "proxy_quantity"]
    buy = lc.executability(b, "buy", 50).select(F.lit("buy").alias("side"), *cols)
    return buy.unionByName(lc.executability(b, "sell", 50).select(F.lit("sell").alias("side"), *cols))


@query(
    "st_profit_protect",
    with_bindings(
        f"""WITH v AS (SELECT s.code, s.trade_date, s.ts, s.m, CAST(s.close AS DOUBLE) AS p, CAST(sum(s.amount) OVER u AS DOUBLE) / nullif(CAST(sum(s.volume) OVER u AS DOUBLE), 0) AS vw, CAST(d.open AS DOUBLE) AS o, CAST(d.pre_close AS DOUBLE) AS e,
  CAST(d.pre_close AS DOUBLE) * CASE WHEN day(s.trade_date) = 1 THEN 0.5::DOUBLE ELSE 2::DOUBLE END AS t, CASE WHEN s.m % 2 = 0 THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END AS act, row_number() OVER w AS i
  FROM fx_session s JOIN fx_sdays d ON d.code = s.code AND d.trade_date = s.trade_date WINDOW w AS (PARTITION BY s.code, s.trade_date ORDER BY s.ts), u AS (PARTITION BY s.code, s.trade_date ORDER BY s.ts ROWS UNBOUNDED PRECEDING)),
a AS (SELECT *, CASE WHEN t <= 0 OR e <= 0 THEN 'data_insufficient' WHEN t <= e OR t <= e * 1.05::DOUBLE THEN 'not_applicable' ELSE 'applicable' END AS ap, CASE WHEN t > e THEN (p - e) / nullif(t - e, 0) END AS pg FROM v),
b AS (SELECT *, ap = 'applicable' AND pg >= 0.8::DOUBLE AS active, min(CASE WHEN ap = 'applicable' AND pg >= 0.8::DOUBLE THEN i END) OVER (PARTITION BY code, trade_date) AS i0 FROM a),
c AS (SELECT *, CASE WHEN i >= i0 THEN max(CASE WHEN i >= i0 THEN p END) OVER (PARTITION BY code, trade_date ORDER BY i ROWS UNBOUNDED PRECEDING) END AS hi FROM b),
g AS (SELECT *, concat_ws(',', CASE WHEN hi - p >= 0.5 * 20 THEN 'drawdown_from_local_high' END, CASE WHEN p < o THEN 'close_below_opening_reference' END, CASE WHEN p < vw THEN 'close_below_vwap' END, CASE WHEN act <= 0.65::DOUBLE AND NOT p >= hi THEN 'activity_ratio_weak' END) AS ev,
  coalesce(hi - p >= 0.5 * 20, false)::INT + coalesce(p < o, false)::INT + coalesce(p < vw, false)::INT + coalesce(act <= 0.65::DOUBLE AND NOT p >= hi, false)::INT AS n FROM c),
r AS (SELECT *, CASE WHEN n >= 2 THEN i - coalesce(max(CASE WHEN n < 2 THEN i END) OVER (PARTITION BY code, trade_date ORDER BY i ROWS UNBOUNDED PRECEDING), 0) ELSE 0 END AS wr FROM g)
SELECT code, CAST(trade_date AS VARCHAR) AS trade_date, CAST(ts AS VARCHAR) AS ts, ap AS applicability, {r2('pg', 6)} AS target_progress, hi AS runup_high, ev AS weakness_evidence, CAST(wr AS INT) AS weak_run, coalesce(active AND n >= 2 AND wr >= 2, false) AS triggered,
 CASE WHEN ap <> 'applicable' THEN 'profit_protection_not_applicable' WHEN NOT coalesce(active, false) THEN 'below_activation_threshold' WHEN n >= 2 AND wr >= 2 THEN 'profit_protection_triggered' ELSE 'weakness_evidence_insufficient' END AS reason_code FROM r""",
        "fx_session",
        "fx_sdays",
    ),
)
def st_profit_protect(spark, d):
    vw = mn.running_vwap(session_bars(spark, d)).select("code", "trade_date", "ts", "price", "vwap")
    factor = F.when(F.dayofmonth("trade_date") == 1, 0.5).otherwise(2.0)
    pos = session_days(spark, d).select(
        "code",
        "trade_date",
        F.col("open").alias("opening_reference"),
        dbl("pre_close").alias("entry_price"),
        (dbl("pre_close") * factor).alias("first_zone_lower"),
        (dbl("pre_close") * 1.05).alias("buy_zone_upper"),
        F.lit(20.0).alias("atr14"),
    )
    b = vw.join(pos, ["code", "trade_date"]).withColumn(
        "activity_ratio", F.when(st.minute_of_day("ts") % 2 == 0, 0.5).otherwise(0.9)
    )
    out = lc.profit_protection(b, ["code", "trade_date"])
    return out.withColumns(
        {
            "trade_date": F.col("trade_date").cast("string"),
            "ts": F.col("ts").cast("string"),
            "weakness_evidence": F.array_join("weakness_evidence", ","),
            "target_progress": round_dec("target_progress", 6),
        }
    )


def _account(spark, d):
    """Positions of accounts (nations) from customers; candidates from suppliers; some accounts unknown."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    s = dims(spark, d).select("code", "industry")
    pos = c.select(
        F.col("c_nationkey").alias("account"),
        k.alias("position_no"),
        code_of((k % 100)).alias("code"),
        F.col("c_acctbal").alias("cost"),
        (k % 5).alias("quantity"),
        (F.col("c_acctbal") - 500 + k % 1000).alias("protection"),
        F.when(k % 50 == 7, "exit_unavailable").when(k % 50 == 8, "execution_unknown").otherwise("open").alias("status"),
    ).join(s, "code")
    cand = dims(spark, d).select((F.col("k") % 25).alias("account"), "code", "industry", F.lit(130.0).alias("buy_price"))
    eq = table(spark, d, "nation").where("n_nationkey % 6 <> 5").select(F.col("n_nationkey").alias("account"), (F.lit(200000.0) + F.col("n_nationkey") * 20000).alias("total_equity"))
    return cand, pos, eq


_ACC = """pos AS (SELECT c_nationkey AS account, c_custkey AS no, printf('%06d', CAST(c_custkey % 100 AS BIGINT)) AS code, c_acctbal AS cost, c_custkey % 5 AS q, c_acctbal - 500 + c_custkey % 1000 AS prot,
 CASE WHEN c_custkey % 50 = 7 THEN 'exit_unavailable' WHEN c_custkey % 50 = 8 THEN 'execution_unknown' ELSE 'open' END AS status, d.industry FROM customer JOIN fx_dims d ON d.code = printf('%06d', CAST(c_custkey % 100 AS BIGINT))),
cd AS (SELECT k % 25 AS account, code, industry FROM fx_dims), eq AS (SELECT n_nationkey AS account, 200000 + n_nationkey * 20000::DOUBLE AS e FROM nation WHERE n_nationkey % 6 <> 5)"""


@query(
    "st_account_risk",
    with_bindings(
        f"""WITH {_ACC}, x AS (SELECT cd.*, e, coalesce((SELECT CAST(sum(CAST(cost * q AS DECIMAL(28,4))) AS DOUBLE) FROM pos WHERE pos.account = cd.account AND pos.code = cd.code), 0) + 13000 AS sm,
  coalesce((SELECT CAST(sum(CAST(cost * q AS DECIMAL(28,4))) AS DOUBLE) FROM pos WHERE pos.account = cd.account AND pos.industry = cd.industry), 0) + 13000 AS ind FROM cd LEFT JOIN eq ON eq.account = cd.account),
y AS (SELECT *, CASE WHEN 13000 > e * 0.05::DOUBLE THEN 'single_trade' WHEN sm > e * 0.1::DOUBLE THEN 'symbol' WHEN ind > e * 0.15::DOUBLE THEN 'industry' END AS lim FROM x)
SELECT account, code, industry, CASE WHEN e IS NULL THEN 'plan_only' WHEN lim IS NOT NULL THEN 'fail' ELSE 'pass' END AS risk_result, CASE WHEN e IS NOT NULL THEN lim END AS risk_limit FROM y""",
        "fx_dims",
    ),
)
def st_account_risk(spark, d):
    return lc.account_risk(*_account(spark, d)).drop("buy_price")


@query(
    "st_loss_gate",
    with_bindings(
        f"""WITH {_ACC}, x AS (SELECT cd.*, e, (SELECT min_by(CASE WHEN code = cd.code AND prot > 0 AND cost > prot THEN 'underwater_same_symbol_add_blocked' ELSE 'unresolved_loss_correlated_add_blocked' END, no) FROM pos
   WHERE pos.account = cd.account AND ((pos.code = cd.code AND prot > 0 AND cost > prot) OR (pos.industry = cd.industry AND status IN ('exit_unavailable', 'execution_unknown', 'user_deviation_hold')))) AS g FROM cd LEFT JOIN eq ON eq.account = cd.account)
SELECT account, code, industry, CASE WHEN e IS NULL THEN 'plan_only' ELSE coalesce(g, 'pass') END AS gate_result FROM x""",
        "fx_dims",
    ),
)
def st_loss_gate(spark, d):
    return lc.loss_gate(*_account(spark, d)).drop("buy_price")


def _audits(spark, d):
    lab = table(spark, d, "labels")
    cat = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "selection_failure")
        .when(F.col("quality") == 1, "entry_failure")
        .when(F.col("toxic") == 0, "exit_failure")
        .otherwise("execution_failure")
    )
    return lab.select("doc_id", cat.alias("category"))


@query(
    "st_audit_metrics",
    """SELECT 'total_decisions' AS metric, '' AS key, count(*) AS value FROM orders UNION ALL SELECT 'total_audits', '', count(*) FROM labels
UNION ALL SELECT 'by_category', CASE WHEN quality = 1 AND toxic = 0 THEN 'selection_failure' WHEN quality = 1 THEN 'entry_failure' WHEN toxic = 0 THEN 'exit_failure' ELSE 'execution_failure' END, count(*) FROM labels GROUP BY 2""",
)
def st_audit_metrics(spark, d):
    return lc.audit_metrics(table(spark, d, "orders"), _audits(spark, d))


@query(
    "st_decision_consistency",
    """SELECT CAST(o_orderkey // 4 AS VARCHAR) AS decision_id, count(*) AS records, bool_and(NOT (o_orderkey % 5 < 2 OR o_orderkey % 7 < 2 OR o_orderkey % 11 < 2 OR o_orderkey % 13 = 0)) AS full_chain, count(DISTINCT o_orderkey % 13 = 0) = 1 AS one_version FROM orders GROUP BY 1""",
)
def st_decision_consistency(spark, d):
    r = nz.validate_records(_records(spark, d)).withColumn("decision_id", F.floor(F.col("k") / 4).cast("string"))
    return lc.decision_consistency(r)


@query(
    "st_chain_logged",
    """SELECT o_custkey AS decision_id, bool_or(o_orderpriority = '1-URGENT') AND bool_or(o_orderpriority = '2-HIGH') AS chain_complete, count(*) AS events FROM orders GROUP BY o_custkey""",
)
def st_chain_logged(spark, d):
    o = table(spark, d, "orders")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "provider_snapshot").when(F.col("o_orderpriority") == "2-HIGH", "state_transition").otherwise("other")
    return lc.chain_logged(o.select(F.col("o_custkey").alias("decision_id"), kind.alias("event_type")))
