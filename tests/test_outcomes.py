import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from barlake.operators import outcomes as oc

DAY = dt.date(2024, 1, 8)


def at(m: int) -> dt.datetime:
    return dt.datetime(2024, 1, 8) + dt.timedelta(minutes=m)


def day_bars(rnd, minutes):
    rows = []
    for m in minutes:
        c = round(10 + rnd.uniform(-1, 1), 2)
        rows.append(("a", DAY, at(m), c + 0.05, c - 0.05, c, rnd.choice([0, 5, 9]), float(rnd.randrange(200))))
    return rows


SCHEMA = "code string, trade_date date, ts timestamp_ntz, high double, low double, close double, volume long, amount double"


def test_confirmation_with_holes_and_lunch(spark):
    rnd = random.Random(1)
    session = [*range(570, 691), *range(780, 901)]
    rows = day_bars(rnd, [m for m in session if rnd.random() > 0.05])
    number = {m: i for i, m in enumerate(session)}
    by = {number[r[2].hour * 60 + r[2].minute]: r for r in rows}
    sums = {i: sum(by[j][7] for j in (i - 2, i - 1, i)) for i in by if i - 1 in by and i - 2 in by}
    got = {r.ts: r for r in oc.confirmations(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("a", DAY, 9.7)], "code string, trade_date date, trigger double")).collect()}
    assert len(got) == len(sums)
    for i, total in sums.items():
        base = [sums[j] for j in range(i - 15, i - 2) if j in sums]
        three = [by[j] for j in (i - 2, i - 1, i)]
        want = (
            min(r[5] for r in three) >= 9.7 and session[i] <= 875 and all(r[6] > 0 and r[7] > 0 for r in three)
            and three[2][5] >= three[0][5] and bool(base) and total >= 0.9 * statistics.median(base)
        )
        r = got[by[i][2]]
        assert r.confirmed == want and r.base_median == (statistics.median(base) if base else None)


def test_first_passage_against_brute_force(spark):
    rnd = random.Random(2)
    rows = day_bars(rnd, range(570, 800))
    plans = [(f"p{k}", "a", DAY, at(rnd.randrange(560, 810)), 10 + rnd.random() * 1.2, 10 - rnd.random() * 1.2) for k in range(120)]
    p = spark.createDataFrame(plans, "plan string, code string, trade_date date, entry_ts timestamp_ntz, zone double, stop double")
    t = oc.first_passages(p, spark.createDataFrame(rows, SCHEMA), {"zone": "zone"}, {"stop": "stop"})
    got = {r.plan: r for r in t.withColumn("label", oc.race_label(F.col("zone_at"), F.col("stop_at"))).collect()}
    for plan, _, _, entry, zone, stop in plans:
        later = [r for r in rows if r[2] > entry]
        up = min((r[2] for r in later if r[3] >= zone), default=None)
        down = min((r[2] for r in later if r[4] <= stop), default=None)
        assert (got[plan].zone_at, got[plan].stop_at) == (up, down)
        want = "neither" if up is None and down is None else "same_bar" if up == down else (
            "first_zone_before_protection" if down is None or (up is not None and up < down) else "protection_before_first_zone"
        )
        assert got[plan].label == want


def test_picks_are_those_of_a_greedy_pass(spark):
    rnd = random.Random(3)
    rows = [(g, n, rnd.choice("xyz" if g < 3 else "abcdef")) for g in range(6) for n in range(1, rnd.randrange(2, 14))]
    got = {(r.g, r.position): r.label for r in oc.actionable(spark.createDataFrame(rows, "g long, position long, industry string"), ["g"], "industry").collect()}
    for g in range(6):
        seen = []
        for _, n, industry in sorted(r for r in rows if r[0] == g):
            take = industry not in seen and len(seen) < oc.MAX_PICKS
            seen += [industry] if take else []
            assert got[g, n] == ("actionable_candidate" if take else "conditional_watch")


def test_position_size_is_the_largest_that_fits(spark):
    rnd = random.Random(4)
    rows = [(k, e := rnd.uniform(2, 90), e * rnd.uniform(0.9, 1.0), e * 0.9, rnd.uniform(0, 90_000), rnd.uniform(0, 900), rnd.uniform(0, 3000)) for k in range(60)]
    rows.append((99, 10.0, None, 9.0, 1e6, 1e3, 1e3))
    df = spark.createDataFrame(rows, "k long, entry double, protection double, limit_down double, max_capital double, max_loss double, max_stress double")
    got = {r.k: r for r in oc.position_size(df).collect()}

    def fits(q, e, s, f, capital, loss, stress):
        fee = lambda x: max(e * q * 0.0003, 5) + max(x * q * 0.0003, 5) + x * q * 0.0005 + (e + x) * q * 0.00001
        return e * q + max(e * q * 0.0003, 5) + e * q * 0.00001 <= capital and (e - s) * q + fee(s) <= loss and (e - f) * q + fee(f) <= stress

    for k, *figures in rows[:-1]:
        assert got[k].shares == max((q for q in range(100, 50_000, 100) if fits(q, *figures)), default=0)
    assert got[99].shares == 0
