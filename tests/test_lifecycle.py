import random

import pytest

from barlake.operators import lifecycle as lc


def events(spark, rows):
    return spark.createDataFrame(rows, "entity long, seq long, to_state string")


def test_legal_entry_path(spark):
    path = ["deep_watch", "conditional_watch", "confirmed_candidate", "plan_published", "entry_active"]
    s = lc.entry_summary(lc.entry_replay(events(spark, [(1, i, p) for i, p in enumerate(path)]))).collect()[0]
    assert s.current_state == "entry_active" and s.is_buyable and not s.in_candidate_pool and s.illegal_events == 0


def test_illegal_jump_is_reported_and_ignored(spark):
    r = lc.entry_replay(events(spark, [(1, 0, "rejected"), (1, 1, "entry_active"), (1, 2, "deep_watch"), (1, 3, "nonsense")]))
    s = lc.entry_summary(r).collect()[0]
    assert (s.current_state, s.transitions, s.first_illegal_seq, s.illegal_events) == ("deep_watch", 2, 1, 2)


def test_exit_path(spark):
    path = ["next_open_observe", "intraday_position_monitor", "time_exit", "closed", "next_open_observe"]
    s = lc.exit_summary(lc.exit_replay(events(spark, [(9, i, p) for i, p in enumerate(path)]))).collect()[0]
    assert s.current_state == "closed" and not s.is_active_position and s.first_illegal_seq == 4


def test_parallel_replay_of_a_hot_entity_equals_a_plain_loop(spark):
    rnd = random.Random(5)
    names = list(lc.EXIT_TRANSITIONS)
    rows = [(1, i * 3, rnd.choice(names)) for i in range(4000)] + [(2, i, rnd.choice(names)) for i in range(50)]
    table = [[names.index(t) if t in lc.EXIT_TRANSITIONS[s] else names.index(s) for s in names] for t in names]
    ops = spark.createDataFrame([(e, q, names.index(t)) for e, q, t in rows], "entity long, seq long, op int")
    got = {(r.entity, r.seq): (r.start_state, r.end_state) for r in lc.scan_states(ops, table, 0, block=8).collect()}
    state = {1: 0, 2: 0}
    assert len(got) == len(rows)
    for e, q, t in rows:
        before = state[e]
        state[e] = table[names.index(t)][before]
        assert got[(e, q)] == (before, state[e])


def slot_loop(rows):
    status, cur, code, cut, nr, no = "free", None, None, False, 0, 0
    for _, _, action, dec, c, can in rows:
        if action == "reserve" and status in ("free", "released") and not cut:
            status, cur, code, nr = "reserved", dec, c, nr + 1
        elif action == "occupy" and status == "reserved" and cur == dec:
            status, no = "occupied", no + 1
        elif action == "release" and status in ("reserved", "occupied"):
            status = "released" if can else "occupied"
        elif action == "cutoff":
            cut = True
            status = status if status == "occupied" else "empty_after_cutoff"
    if cut and status != "occupied":
        status = "empty_after_cutoff"
    return status, nr, no, code


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_slots_equal_a_plain_loop(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for entity in range(12):
        recent = []
        for i in range(200):
            a = rnd.choices(["reserve", "occupy", "release", "cutoff"], [5, 5, 2, 0.05])[0]
            dec = f"{entity}-{i}" if a == "reserve" else (rnd.choice(recent[-4:]) if recent else "x")
            if a == "reserve":
                recent.append(dec)
            rows.append((entity, i, a, dec, f"{i:06d}", rnd.random() < 0.6))
    df = spark.createDataFrame(rows, "entity long, seq long, action string, decision_id string, code string, can_reassign boolean")
    got = {r.entity: (r.status, r.reservations, r.occupations, r.current_code) for r in lc.slot_replay(df).collect()}
    for entity in range(12):
        assert got[entity] == slot_loop([r for r in rows if r[0] == entity]), entity


def test_exit_priority_in_open_validation(spark):
    rows = [(1, "profit_protection", "09:40"), (1, "time_exit", "09:40"), (2, "profit_protection", "10:00"), (2, "time_exit", "10:00"), (3, "profit_protection", "09:45")]
    e = spark.createDataFrame(rows, "pos int, event string, time string")
    assert {r.pos: r.exit_event for r in lc.exit_priority(e, ["pos"]).collect()} == {1: "time_exit", 2: "profit_protection"}


def test_account_gates(spark):
    cand = spark.createDataFrame([("a", "1", "x", 10.0), ("a", "2", "y", 60.0), ("b", "1", "x", 1.0)], "account string, code string, industry string, buy_price double")
    pos = spark.createDataFrame([("a", 1, "1", "x", 95.0, 100.0, 90.0, "open")], "account string, position_no int, code string, industry string, cost double, quantity double, protection double, status string")
    eq = spark.createDataFrame([("a", 100000.0)], "account string, total_equity double")
    got = {(r.account, r.code): r.risk_result for r in lc.account_risk(cand, pos, eq).collect()}
    assert got == {("a", "1"): "fail", ("a", "2"): "fail", ("b", "1"): "plan_only"}
    gate = {(r.account, r.code): r.gate_result for r in lc.loss_gate(cand, pos, eq).collect()}
    assert gate == {("a", "1"): "underwater_same_symbol_add_blocked", ("a", "2"): "pass", ("b", "1"): "plan_only"}
