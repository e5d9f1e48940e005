"""Brute-force checks of the rewrites made for scale, on inline fixtures where
one key holds most of the rows (the hot-key case the rewrites are for)."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from plantlens.plans import signals


def _episodes_brute(rows, gap=dt.timedelta(hours=2)):
    """Plain gaps-and-islands over sorted readings per (key, kind)."""
    out = {}
    by = {}
    for plant, line, product, ts, under, over in rows:
        kind = "under" if under else ("over" if over else None)
        if kind:
            by.setdefault((plant, line, product, kind), []).append(ts)
    for key, tss in by.items():
        tss.sort()
        start = prev = tss[0]
        n = 1
        for t in tss[1:]:
            if t >= prev + gap:
                out.setdefault(key, []).append((start, prev, n))
                start, n = t, 0
            prev = t
            n += 1
        out.setdefault(key, []).append((start, prev, n))
    return {(k, e) for k, es in out.items() for e in es}


def test_breach_episodes_hot_line_matches_brute_force(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2025, 8, 1)
    rows = []
    # hot line: 3000 readings over 10 days, bursts and gaps
    t = t0
    for _ in range(3000):
        t += dt.timedelta(minutes=rnd.choice([1, 5, 30, 90, 119, 121, 180, 600]))
        under = rnd.random() < 0.5
        rows.append(("NA-P1", "L1", "PRD-0", t, under, (not under) and rnd.random() < 0.7))
    for i in range(300):   # a few cold lines
        rows.append(("EU-P3", f"L{i % 3}", "PRD-1", t0 + dt.timedelta(minutes=37 * i), i % 4 == 0, i % 5 == 0))
    df = spark.createDataFrame(rows, "plant_name string, plant_line string, product_name string, "
                                     "datetime timestamp, under_quality_flag boolean, over_quality_flag boolean")
    got = {((r.plant_name, r.plant_line, r.product_name, r.kind), (r.episode_start, r.episode_end, r.n_readings))
           for r in signals.breach_episodes(df.repartition(7)).collect()}
    assert got == _episodes_brute(rows)


def _realloc_brute(groups, high=23.0, low=21.0):
    """Greedy fill in plant order with plain Python intervals."""
    out = {}
    for (date, region), loads in groups.items():
        plants = sorted({p for p, _, _ in loads})
        hi = {p: sum(round(t * 1000) for q, t, dm in loads if q == p and dm > high) for p in plants}
        lo = {p: sum(round(t * 1000) for q, t, dm in loads if q == p and dm <= low) for p in plants}
        donors, s = [], 0
        for p in plants:
            if hi[p] > 0:
                donors.append((p, s, s + hi[p]))
                s += hi[p]
        recv, s = [], 0
        for p in plants:
            if lo[p] > 0:
                recv.append((p, s, s + lo[p]))
                s += lo[p]
        for dp, a0, a1 in donors:
            for rp, b0, b1 in recv:
                m = min(a1, b1) - max(a0, b0)
                if m > 0:
                    out[(date, region, dp, rp)] = m / 1000.0
    return out


def test_reallocation_sweep_matches_brute_force(spark):
    rnd = random.Random(11)
    d0 = dt.date(2025, 8, 1)
    rows, groups = [], {}
    for i in range(4000):
        date = d0 + dt.timedelta(days=rnd.randrange(3))
        region = "NA" if i % 3 else "EU"
        # one plant holds most loads
        plant = "NA-HOT" if (region == "NA" and rnd.random() < 0.7) else f"{region}-P{rnd.randrange(5)}"
        tons = round(rnd.uniform(10, 30), 3)
        dm = round(rnd.uniform(20, 24.5), 2)
        rows.append((date, region, plant, tons, dm))
        groups.setdefault((date, region), []).append((plant, tons, dm))
    df = spark.createDataFrame(rows, "arrival_date date, region string, plant_name string, tons double, "
                                     "dry_matter_pct double")
    got = {(r.date, r.region, r.donor_plant, r.receiver_plant): r.moved_tons
           for r in signals.reallocation(df.repartition(5)).collect()}
    want = _realloc_brute(groups)
    assert set(got) == set(want)
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-9
    # receivers never get more than their shortfall, donors never give more than their surplus
    moved = spark.createDataFrame([(k[0], k[1], k[2], k[3], v) for k, v in got.items()],
                                  "date date, region string, donor string, receiver string, t double")
    assert moved.filter(F.col("t") <= 0).count() == 0
