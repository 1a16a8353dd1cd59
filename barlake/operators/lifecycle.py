"""Lifecycle state from event logs.

A state machine with a fixed set of states is replayed in parallel: an event is
a map from state to state, maps compose associatively, so a long log is cut
into blocks by sequence number, each block is reduced to one map, and the start
state of every block follows from the maps before it.  An entity that owns a
large part of the log is thereby spread over many tasks.  Maps are reduced in
``LEVELS`` levels, so what meets in one row is at most ``BLOCK`` items on every
level and one map per BLOCK**LEVELS (268 million) sequence numbers at the top.

An illegal event leaves the state unchanged, which is why comparing with the
previous event's target is not enough.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.numeric import count_if, dbl, flag_list, null0

BLOCK = 128
LEVELS = 4

# States and allowed transitions of the two machines.
ENTRY_START = "unassessed"
ENTRY_TRANSITIONS: dict[str, tuple[str, ...]] = {
    "unassessed": ("deep_watch", "data_insufficient", "rejected"),
    "data_insufficient": ("deep_watch", "rejected", "rejected_for_day"),
    "rejected": ("deep_watch", "rejected_for_day"),
    "deep_watch": ("conditional_watch", "data_insufficient", "rejected", "rejected_for_day"),
    "conditional_watch": ("confirmed_candidate", "data_insufficient", "canceled", "rejected_for_day"),
    "confirmed_candidate": ("plan_published", "data_insufficient", "canceled"),
    "plan_published": ("entry_active", "canceled", "expired"),
    "entry_active": ("canceled", "expired", "user_reported_executed", "user_reported_not_executed"),
    "canceled": ("user_reported_not_executed", "execution_unknown"),
    "expired": ("user_reported_not_executed", "execution_unknown"),
    "user_reported_executed": (),
    "user_reported_not_executed": (),
    "execution_unknown": (),
    "rejected_for_day": (),
}
_EXIT_DONE = ("closed", "exit_unavailable", "user_deviation_hold", "execution_unknown")
EXIT_START = "opened_t1_locked"
EXIT_TRANSITIONS: dict[str, tuple[str, ...]] = {
    "opened_t1_locked": ("next_open_observe",),
    "next_open_observe": (
        "intraday_position_monitor", "failed_open_exit", "target_exit", "structural_stop_exit", "exit_unavailable",
    ),
    "intraday_position_monitor": (
        "failed_open_exit", "profit_protection", "structural_stop_exit", "target_exit", "time_exit", "exit_unavailable",
    ),
    "failed_open_exit": _EXIT_DONE,
    "profit_protection": _EXIT_DONE,
    "structural_stop_exit": _EXIT_DONE,
    "target_exit": _EXIT_DONE,
    "time_exit": _EXIT_DONE,
    "exit_unavailable": ("forced_carry_unavailable", "subsequent_session_exit_watch"),
    "forced_carry_unavailable": ("subsequent_session_exit_watch",),
    "subsequent_session_exit_watch": _EXIT_DONE,
    "closed": (),
    "user_deviation_hold": ("closed", "subsequent_session_exit_watch"),
    "execution_unknown": ("closed", "subsequent_session_exit_watch"),
}
CANDIDATE_POOL = ("deep_watch", "conditional_watch", "confirmed_candidate")
BUYABLE = ("entry_active",)
INACTIVE_POSITION = ("closed", "execution_unknown")
NEEDS_EXIT = ("next_open_observe", "intraday_position_monitor", "subsequent_session_exit_watch")
EXIT_PRIORITY = {
    "structural_stop_exit": 1, "target_exit": 2, "failed_open_exit": 3, "profit_protection": 4, "time_exit": 5,
}
UNRESOLVED = ("exit_unavailable", "user_deviation_hold", "execution_unknown")
MAX_TRADE, MAX_SYMBOL, MAX_INDUSTRY = 0.05, 0.10, 0.15


# -- generic parallel replay ------------------------------------------------------


def scan_states(
    events: DataFrame, table: Sequence[Sequence[int]], start: int, block: int = BLOCK, levels: int = LEVELS, carry: Sequence[str] = ()
) -> DataFrame:
    """Start and end state of every event.

    ``events``: entity, seq (whole number, unique per entity), op.  ``table[op][s]``
    is the state after ``op`` in state ``s``; ops outside the table change nothing.
    ``carry`` columns come along.
    """
    n = len(table[0])
    ident = list(range(n))
    maps = F.array(*[F.array(*[F.lit(int(x)) for x in row]) for row in table])
    keep = F.array(*[F.lit(i) for i in ident])

    def after(op: Column, s: Column) -> Column:
        row = F.coalesce(F.get(maps, op), keep)
        return F.get(row, s)

    def compose(vectors: Column) -> Column:
        return F.aggregate(vectors, keep, lambda acc, v: F.transform(acc, lambda s: F.get(v, s)))

    low = (
        events.select("entity", "seq", F.col("op").cast("int").alias("op"), F.floor(F.col("seq") / block).alias("b"), *carry)
        .groupBy("entity", "b")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "op", *carry))).alias("evs"))
    )
    vec = F.aggregate("evs", keep, lambda acc, e: F.transform(acc, lambda s: after(e["op"], s)))
    maps_below = low.select("entity", "b", vec.alias("v"))
    groups = []  # one table for each level: (entity, up, vs), at most ``block`` maps in a row
    for _ in range(levels - 1):
        grouped = (
            maps_below.withColumn("up", F.floor(F.col("b") / block))
            .groupBy("entity", "up")
            .agg(F.array_sort(F.collect_list(F.struct("b", "v"))).alias("vs"))
        )
        groups.append(grouped)
        maps_below = grouped.select("entity", F.col("up").alias("b"), compose(F.transform("vs", lambda x: x["v"])).alias("v"))
    top = maps_below.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("b", "v"))).alias("vs"))

    def starts(items: Column, key: str, first: Column) -> Column:
        """Array of (key, state before the item)."""
        kind = f"struct<s:int,out:array<struct<{key}:bigint,s:int>>>"
        init = F.struct(first.cast("int").alias("s"), F.array().cast(f"array<struct<{key}:bigint,s:int>>").alias("out")).cast(kind)

        def step(acc, x):
            item = F.struct(x[key].cast("bigint").alias(key), acc["s"].alias("s"))
            return F.struct(F.get(x["v"], acc["s"]).cast("int").alias("s"), F.concat(acc["out"], F.array(item)).alias("out")).cast(kind)

        return F.aggregate(items, init, step, lambda acc: acc["out"])

    begin = top.select("entity", F.inline(starts(F.col("vs"), "b", F.lit(start))))
    for grouped in reversed(groups):
        known = begin.select("entity", F.col("b").alias("up"), F.col("s").alias("s0"))
        begin = grouped.join(known, ["entity", "up"]).select("entity", F.inline(starts(F.col("vs"), "b", F.col("s0"))))
    begin = begin.withColumnRenamed("s", "s1")
    kind = "struct<s:int,out:array<int>>"

    def step(acc, e):
        return F.struct(after(e["op"], acc["s"]).cast("int").alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")).cast(kind)

    init = F.struct(F.col("s1").cast("int").alias("s"), F.array().cast("array<int>").alias("out")).cast(kind)
    met = F.aggregate("evs", init, step, lambda acc: acc["out"])
    rows = low.join(begin, ["entity", "b"]).select("entity", F.inline(F.arrays_zip(F.col("evs").alias("e"), met.alias("start_state"))))
    return rows.select(
        "entity",
        F.col("e.seq").cast("bigint").alias("seq"),
        "start_state",
        after(F.col("e.op"), F.col("start_state")).cast("int").alias("end_state"),
        *[F.col(f"e.{c}").alias(c) for c in carry],
    )


def machine(transitions: Mapping[str, Sequence[str]]) -> tuple[list[str], list[list[int]], list[list[bool]]]:
    """States, state after (event, state), and whether (event, state) is legal; events are named by their target."""
    names = list(transitions)
    index = {s: i for i, s in enumerate(names)}
    table = [[index[to] if to in transitions[s] else index[s] for s in names] for to in names]
    return names, table, [[to in transitions[s] for s in names] for to in names]


def replay(events: DataFrame, transitions: Mapping[str, Sequence[str]], start: str) -> DataFrame:
    """Every event with the state it met, the state it left and whether it was legal.

    ``events``: entity, seq, to_state.
    """
    names, table, legal = machine(transitions)

    def op_of(column: str) -> Column:
        position = F.array_position(F.array(*[F.lit(s) for s in names]), F.col(column)) - 1
        return F.when(position >= 0, position).cast("int")

    # blocks are cut by the place in the entity's own log, so that they are full however sparse its numbers are
    placed = running_count(events.withColumn("_op", op_of("to_state")), ["entity"], "seq", F.lit(True), "_place")
    row = F.struct(*[c for c in events.columns if c != "entity"]).alias("_row")
    blocks = placed.select("entity", row, F.col("_place").alias("seq"), F.col("_op").alias("op"))
    j = scan_states(blocks, table, names.index(start), carry=["_row"]).withColumn("_op", op_of("_row.to_state"))
    words = F.array(*[F.lit(s) for s in names])
    allowed = F.array(*[F.array(*[F.lit(x) for x in row]) for row in legal])
    ok = F.coalesce(F.get(F.get(allowed, F.col("_op")), F.col("start_state")), F.lit(False))
    return j.select(
        *[F.col(c if c == "entity" else f"_row.{c}").alias(c) for c in events.columns],
        F.get(words, F.col("start_state")).alias("from_state"),
        ok.alias("legal"),
        F.get(words, F.col("end_state")).alias("state_after"),
    )


def replay_summary(replayed: DataFrame) -> DataFrame:
    """Current state, number of transitions and first illegal event per entity."""
    return replayed.groupBy("entity").agg(
        F.max_by("state_after", "seq").alias("current_state"),
        count_if(F.col("legal")).alias("transitions"),
        count_if(~F.col("legal")).alias("illegal_events"),
        F.min(F.when(~F.col("legal"), F.col("seq"))).alias("first_illegal_seq"),
    )


def entry_replay(events: DataFrame) -> DataFrame:
    return replay(events, ENTRY_TRANSITIONS, ENTRY_START)


def entry_summary(replayed: DataFrame) -> DataFrame:
    s = F.col("current_state")
    return replay_summary(replayed).withColumns({"in_candidate_pool": s.isin(*CANDIDATE_POOL), "is_buyable": s.isin(*BUYABLE)})


def exit_replay(events: DataFrame) -> DataFrame:
    return replay(events, EXIT_TRANSITIONS, EXIT_START)


def exit_summary(replayed: DataFrame) -> DataFrame:
    s = F.col("current_state")
    return replay_summary(replayed).withColumns({"is_active_position": ~s.isin(*INACTIVE_POSITION), "needs_exit_intent": s.isin(*NEEDS_EXIT)})


# -- one candidate slot per profile and date --------------------------------------

SLOT_STATES = ("free", "released", "reserved", "occupied", "empty_after_cutoff", "occupied_after_cutoff")
_OUTCOMES = ("none", "reserved", "occupied")
_ENDS = ("end", "release_reassign", "release_keep", "cutoff")


def _slot_table() -> list[list[int]]:
    """State after (outcome of the reservations, closing event) for every state."""
    at = {s: i for i, s in enumerate(SLOT_STATES)}
    rows = []
    for outcome in _OUTCOMES:
        for end in _ENDS:
            row = []
            for s in SLOT_STATES:
                if s in ("free", "released") and outcome != "none":
                    s = outcome
                if end == "release_reassign":
                    s = {"reserved": "released", "occupied": "released", "occupied_after_cutoff": "empty_after_cutoff"}.get(s, s)
                elif end == "release_keep":
                    s = {"reserved": "occupied"}.get(s, s)
                elif end == "cutoff":
                    s = "occupied_after_cutoff" if s.startswith("occupied") else "empty_after_cutoff"
                row.append(at[s])
            rows.append(row)
    return rows


def running_count(df: DataFrame, keys: Sequence[str], seq: str, cond: Column, out: str, block: int = 4096) -> DataFrame:
    """Number of earlier rows of the key that satisfy ``cond`` (exclusive), computed block by block.

    Only one row per ``block`` sequence numbers is ordered per key.
    """
    staged = df.withColumn("_b", F.floor(F.col(seq) / block)).withColumn("_c", F.when(cond, 1).otherwise(0))
    per = staged.groupBy(*keys, "_b").agg(F.sum("_c").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_b").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    local = staged.withColumn("_in", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    return local.join(offs, [*keys, "_b"]).withColumn(out, F.col("_off") + F.col("_in")).drop("_b", "_c", "_off", "_in")


def slot_replay(events: DataFrame) -> DataFrame:
    """Slot per entity (profile and date) from reserve / occupy / release / cutoff events.

    ``events``: entity, seq, action, decision_id, code, can_reassign; a decision
    id belongs to one reserve event.  Releases and the cutoff split the log into
    stretches.  Within a stretch only the first reservation can win, and only an
    occupy of the same decision after it counts; both are plain aggregates.  The
    stretches themselves form a finite machine.
    """
    closing = F.col("action").isin("release", "cutoff")
    ev = running_count(events, ["entity"], "seq", closing, "stretch")
    keys = ["entity", "stretch"]
    end = (
        F.when(F.col("action") == "cutoff", 3)
        .when((F.col("action") == "release") & F.col("can_reassign"), 1)
        .when(F.col("action") == "release", 2)
    )
    reserve = F.when(F.col("action") == "reserve", F.col("seq"))
    body = ev.groupBy(*keys).agg(
        F.max(end).alias("end"),
        F.min(reserve).alias("r_seq"),
        F.min_by("decision_id", reserve).alias("decision_id"),
        F.min_by("code", reserve).alias("code"),
    )
    occ = ev.where(F.col("action") == "occupy").groupBy(*keys, "decision_id").agg(F.max("seq").alias("o_seq"))
    st = body.join(occ, [*keys, "decision_id"], "left")
    outcome = F.when(F.col("r_seq").isNull(), 0).when(F.col("o_seq") > F.col("r_seq"), 2).otherwise(1)
    op = outcome * len(_ENDS) + F.coalesce("end", F.lit(0))
    st = st.withColumn("op", op.cast("int")).withColumn("_outcome", outcome)
    scanned = scan_states(st.select("entity", F.col("stretch").alias("seq"), "op"), _slot_table(), 0)
    words = F.array(*[F.lit(s) for s in SLOT_STATES])
    j = st.join(scanned.withColumnRenamed("seq", "stretch"), keys)
    won = (F.col("start_state") <= 1) & F.col("r_seq").isNotNull()
    return j.groupBy("entity").agg(
        F.get(words, F.max_by("end_state", "stretch")).alias("status"),
        count_if(won).alias("reservations"),
        count_if(won & (F.col("_outcome") == 2)).alias("occupations"),
        F.max_by(F.when(won, F.col("code")), F.when(won, F.col("stretch"))).alias("current_code"),
        F.max_by(F.when(won, F.col("decision_id")), F.when(won, F.col("stretch"))).alias("current_decision"),
    ).withColumn("status", F.when(F.col("status") == "occupied_after_cutoff", "occupied").otherwise(F.col("status")))


# -- exits and execution ----------------------------------------------------------


def exit_priority(events: DataFrame, keys: Sequence[str], open_until: str = "09:45") -> DataFrame:
    """Winning exit event per key; profit protection does not take part during open validation.

    ``events``: keys, event, time (HH:MM).
    """
    pr = F.lit(99)
    for name, p in EXIT_PRIORITY.items():
        pr = F.when(F.col("event") == name, p).otherwise(pr)
    early = F.col("time") <= open_until
    live = events.where(~(early & (F.col("event") == "profit_protection")))
    best = live.groupBy(*keys).agg(F.min(F.struct(pr.alias("p"), F.col("event"))).alias("b"))
    return best.select(*keys, F.col("b.event").alias("exit_event"))


def executability(bars: DataFrame, side: str, quantity: int = 100) -> DataFrame:
    """Theoretical feasibility of a buy or sell in each bar.

    ``bars``: open, high, low, close, volume, limit_price (up for buys, down for
    sells), is_suspended, in_session.
    """
    lim = F.col("limit_price")
    pinned = (F.col("open") == lim) & (F.col("high") == lim) & (F.col("low") == lim) & (F.col("close") == lim)
    reason = (
        F.when(F.coalesce("is_suspended", F.lit(False)), "suspended")
        .when(~F.coalesce("in_session", F.lit(True)), "not_in_continuous_session")
        .when(F.coalesce(pinned, F.lit(False)), "one_side_limit_up" if side == "buy" else "one_side_limit_down")
        .when(F.col("volume") < quantity, "insufficient_volume")
        .otherwise("normal_executable")
    )
    ok = F.col("exec_reason") == "normal_executable"
    return bars.withColumn("exec_reason", reason).withColumns(
        {
            "executability": F.when(ok, "executable").otherwise("unavailable"),
            "proxy_price": F.when(ok, dbl("close")),
            "proxy_quantity": F.when(ok, quantity).otherwise(0),
        }
    )


def profit_protection(
    bars: DataFrame, keys: Sequence[str], activation: float = 0.80, drawdown_atr: float = 0.50, confirm: int = 2, activity_max: float = 0.65
) -> DataFrame:
    """Profit protection per bar of an open position (keys identify position and day, at most one bar per minute).

    ``bars``: keys, ts, price, vwap, opening_reference, entry_price,
    first_zone_lower, buy_zone_upper, atr14, activity_ratio.  The high since
    activation and the count of consecutive weak bars come from windows over
    the position's day.
    """
    w = Window.partitionBy(*keys).orderBy("ts")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    price, entry, target = dbl("price"), dbl("entry_price"), dbl("first_zone_lower")
    applicable = (
        F.when((target <= 0) | (entry <= 0), "data_insufficient")
        .when((target <= entry) | (target <= dbl("buy_zone_upper")), "not_applicable")
        .otherwise("applicable")
    )
    progress = F.when(target > entry, (price - entry) / null0(target - entry))
    s = bars.withColumns({"applicability": applicable, "target_progress": progress})
    active = (F.col("applicability") == "applicable") & (F.col("target_progress") >= activation)
    s = s.withColumn("_since", F.max(F.when(active, 1)).over(upto))
    s = s.withColumn("runup_high", F.max(F.when(F.col("_since") == 1, price)).over(upto))
    new_high = price >= F.col("runup_high")
    evidence = flag_list(
        (F.col("runup_high") - price >= drawdown_atr * dbl("atr14"), "drawdown_from_local_high"),
        (price < dbl("opening_reference"), "close_below_opening_reference"),
        (price < dbl("vwap"), "close_below_vwap"),
        ((dbl("activity_ratio") <= activity_max) & ~new_high, "activity_ratio_weak"),
    )
    s = s.withColumn("weakness_evidence", evidence)
    weak = F.size("weakness_evidence") >= 2
    # consecutive weak bars: bars since the last one that was not weak
    s = s.withColumn("_i", F.row_number().over(w)).withColumn("_ok_at", F.max(F.when(~weak, F.col("_i"))).over(upto))
    s = s.withColumn("weak_run", F.when(weak, F.col("_i") - F.coalesce("_ok_at", F.lit(0))).otherwise(0))
    hit = active & weak & (F.col("weak_run") >= confirm)
    reason = (
        F.when(F.col("applicability") != "applicable", "profit_protection_not_applicable")
        .when(~active, "below_activation_threshold")
        .when(hit, "profit_protection_triggered")
        .otherwise("weakness_evidence_insufficient")
    )
    return s.select(
        *keys, "ts", "applicability", "target_progress", "runup_high", "weakness_evidence", "weak_run",
        F.coalesce(hit, F.lit(False)).alias("triggered"), reason.alias("reason_code"),
    )


# -- account gates ----------------------------------------------------------------


def account_risk(candidates: DataFrame, positions: DataFrame, equity: DataFrame, quantity: int = 100) -> DataFrame:
    """pass / fail / plan_only per candidate (account, code, industry, buy_price).

    Positions are summed per account and code and per account and industry
    first, so the joins meet one row per key.
    """
    cost = dbl("cost") * dbl("quantity")
    by_code = positions.groupBy("account", "code").agg(F.sum(cost.cast("decimal(28,4)")).alias("_same"))
    by_ind = positions.groupBy("account", "industry").agg(F.sum(cost.cast("decimal(28,4)")).alias("_ind"))
    j = (
        candidates.join(equity.select("account", dbl("total_equity").alias("_eq")), "account", "left")
        .join(by_code, ["account", "code"], "left")
        .join(by_ind, ["account", "industry"], "left")
    )
    buy = dbl("buy_price") * quantity
    same = F.coalesce(dbl("_same"), F.lit(0.0)) + buy
    industry = F.coalesce(dbl("_ind"), F.lit(0.0)) + buy
    eq = F.col("_eq")
    broken = (
        F.when(buy > eq * MAX_TRADE, "single_trade").when(same > eq * MAX_SYMBOL, "symbol").when(industry > eq * MAX_INDUSTRY, "industry")
    )
    return j.select(
        *candidates.columns,
        F.when(eq.isNull(), "plan_only").when(broken.isNotNull(), "fail").otherwise("pass").alias("risk_result"),
        F.when(eq.isNotNull(), broken).alias("risk_limit"),
    )


def loss_gate(candidates: DataFrame, positions: DataFrame, equity: DataFrame) -> DataFrame:
    """Loss-offset gate: the first blocking position of the account (by position_no) decides.

    A position blocks its own code when under water (cost above protection),
    and its industry while its exit is unresolved.  Both sides are reduced to
    the smallest position number per key before joining.
    """
    no = F.col("position_no")
    water = (dbl("protection") > 0) & (dbl("cost") > dbl("protection"))
    same = positions.where(water).groupBy("account", "code").agg(F.min(no).alias("_same"))
    corr = positions.where(F.col("status").isin(*UNRESOLVED)).groupBy("account", "industry").agg(F.min(no).alias("_corr"))
    j = (
        candidates.join(equity.select("account", F.lit(True).alias("_known")), "account", "left")
        .join(same, ["account", "code"], "left")
        .join(corr, ["account", "industry"], "left")
    )
    first_same = F.col("_same").isNotNull() & (F.col("_corr").isNull() | (F.col("_same") <= F.col("_corr")))
    return j.select(
        *candidates.columns,
        F.when(F.col("_known").isNull(), "plan_only")
        .when(first_same, "underwater_same_symbol_add_blocked")
        .when(F.col("_corr").isNotNull(), "unresolved_loss_correlated_add_blocked")
        .otherwise("pass")
        .alias("gate_result"),
    )


# -- audit trail ------------------------------------------------------------------


def audit_metrics(records: DataFrame, audits: DataFrame) -> DataFrame:
    """Total decisions, total audits and audits per category as (metric, key, value)."""
    row = lambda m, k, v: F.struct(F.lit(m).alias("metric"), k.alias("key"), v.alias("value"))
    total = records.agg(F.count(F.lit(1)).alias("n")).select(row("total_decisions", F.lit(""), F.col("n")).alias("r"))
    n_aud = audits.agg(F.count(F.lit(1)).alias("n")).select(row("total_audits", F.lit(""), F.col("n")).alias("r"))
    cats = audits.groupBy("category").agg(F.count(F.lit(1)).alias("n")).select(row("by_category", F.col("category"), F.col("n")).alias("r"))
    return total.unionByName(n_aud).unionByName(cats).select("r.*")


def decision_consistency(records: DataFrame) -> DataFrame:
    """Per decision: records, complete versions on every record, one strategy version throughout.

    Expects ``unversioned`` (array) from the record validation.
    """
    version = F.coalesce("strategy_version", F.lit(""))
    return records.groupBy("decision_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.bool_and(F.size("unversioned") == 0).alias("full_chain"),
        # one distinct value: smallest equals largest, no distinct aggregation needed
        ((F.min(version) == F.max(version)) & (F.min(version) != "")).alias("one_version"),
    )


def chain_logged(log: DataFrame, required: Sequence[str] = ("provider_snapshot", "state_transition")) -> DataFrame:
    """Decisions with whether every required event type was logged."""
    flags = [F.max(F.col("event_type") == r) for r in required]
    every = flags[0]
    for f in flags[1:]:
        every = every & f
    return log.groupBy("decision_id").agg(every.alias("chain_complete"), F.count(F.lit(1)).alias("events"))
