"""The latch in closed form against a machine written step by step."""

import random

import pytest

from quaywatch.plans import alerts
from quaywatch.streaming.state import Burn, Horizon


def rows(spark, *series):
    """series: (cdn, [(total, bad)])."""
    return spark.createDataFrame([(cdn, m, f"s{m}", t, b, 60) for cdn, values in series for m, (t, b) in enumerate(values)], "cdn string, minute long, session_id string, total long, bad long, samples long")


def moves(spark, how, *series):
    return sorted((r.minute, r.cdn, r.state, r.tier) for r in alerts.latch(alerts.burn_rates(rows(spark, *series), how), how).collect())


SHORT = alerts.BurnRate(slow_long=10, clear=2)


def test_a_burst_fires_and_resolves(spark):
    found = moves(spark, SHORT, ("cdn-b", [(100, 0)] * 5 + [(100, 10)] * 4 + [(100, 0)] * 11))
    assert [m[2] for m in found] == ["FIRING", "RESOLVED"]


def test_health_is_silent(spark):
    assert moves(spark, alerts.BurnRate(), ("cdn-a", [(100, 0)] * 30)) == []


def test_any_network_fires(spark):
    assert moves(spark, alerts.BurnRate(), ("cdn-a", [(100, 0)] * 5 + [(100, 12)] * 4))[0][1:] == ("cdn-a", "FIRING", "page")


def test_few_samples_are_not_enough(spark):
    assert moves(spark, alerts.BurnRate(n_min=1000), ("cdn-a", [(100, 50)] * 10)) == []


@pytest.mark.parametrize("cadence", ["minute", "row"])
def test_closed_form_equals_the_machine(spark, cadence):
    rng = random.Random(4)
    data = []
    for c in range(12):
        for m in sorted(rng.sample(range(80), 60)):
            for s in range(rng.randint(1, 3)):
                data.append((f"cdn-{c}", m, f"s{s}", rng.choice([0, 50, 100]), rng.choice([0, 0, 1, 3, 9]), rng.randint(5, 40)))
    df = spark.createDataFrame(data, "cdn string, minute long, session_id string, total long, bad long, samples long")
    order = ("minute",) if cadence == "minute" else ("minute", "session_id")
    how = alerts.BurnRate(slow_long=12)
    got = sorted((r.cdn, r.state, r.tier, r.minute) for r in alerts.latch(alerts.burn_rates(df, how, cadence), how, order).collect())
    want = []
    for cdn in {r[0] for r in data}:
        mine = sorted(r[1:] for r in data if r[0] == cdn)
        if cadence == "minute":
            mine = [(m, "", *(sum(r[k] for r in mine if r[0] == m) for k in (2, 3, 4))) for m in sorted({r[0] for r in mine})]
        on = off = 0
        firing, tier, past = False, None, {}
        for m, _, total, bad, n in mine:
            t, b, k = past.get(m, (0, 0, 0))
            past[m] = (t + total, b + bad, k + n)
            now = max(past)

            def sums(span):
                return [sum(v[i] for x, v in past.items() if x >= now - span + 1) for i in range(3)]

            def burn(span):
                t, b, _ = sums(span)
                return b / t / 0.01 if t else 0

            hit = "page" if sums(5)[2] >= 50 and burn(5) >= 4 and burn(1) >= 4 else "ticket" if sums(12)[2] >= 50 and burn(12) >= 2 and burn(5) >= 2 else None
            if hit:
                on, off, tier = on + 1, 0, hit
            else:
                on, off = 0, off + 1
            if not firing and on >= 2:
                firing = True
                want.append((cdn, "FIRING", tier, m))
            elif firing and off >= 3:
                firing = False
                want.append((cdn, "RESOLVED", tier, m))
    assert len(want) > 10
    assert got == sorted(want)
    machine = []
    for cdn in {r[0] for r in data}:
        burn = Burn(how)
        mine = sorted(r[1:] for r in data if r[0] == cdn)
        if cadence == "minute":
            mine = [(m, "", *(sum(r[k] for r in mine if r[0] == m) for k in (2, 3, 4))) for m in sorted({r[0] for r in mine})]
        machine += [(cdn, *x) for m, _, t, b, n in mine if (x := burn.advance(m, t, b, n))]
    assert sorted(machine) == sorted(want)


def test_horizon():
    h = Horizon(180)
    assert [h.is_copy("e1", 0), h.is_copy("e1", 0)] == [False, True]
    h = Horizon(60)
    h.is_copy("old", 0)
    h.is_copy("new", 200)
    assert set(h.seen) == {"new"}
    assert not h.is_copy("very late", 1) and not h.is_copy("very late", 1)
