"""Small frames, and the rules again in plain Python for comparison."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

START = datetime(2024, 1, 1)
COLUMNS = (
    "unit_number int, time_cycles int, timestamp timestamp, htBleed double, T2 double,"
    " T50 double, P30 double, Nf double, Nc double, phi double"
)


def frame(unit=1, cycle=1, second=0.0, htBleed=390.0, T2=518.0, T50=1400.0, P30=554.0,
          Nf=2388.0, Nc=8138.0, phi=520.0):
    at = None if second is None else START + timedelta(seconds=second)
    return (unit, cycle, at, htBleed, T2, T50, P30, Nf, Nc, phi)


def random_frames(count, seed=1, hot_share=0.4, units=6):
    """Frames with ties, NULL, NaN and infinities; one unit holds a large share."""
    rng = random.Random(seed)
    pick = lambda usual, odd: rng.choice(odd) if rng.random() < 0.15 else usual
    rows = []
    for n in range(count):
        unit = 1 if rng.random() < hot_share else rng.randint(2, units)
        rows.append(
            frame(
                unit=unit,
                cycle=pick(n // 20, [None, n // 20 - 3, n // 20 + 1]),
                second=round(rng.random() * count * 40, 3),
                htBleed=pick(390.0, [None, math.nan, math.inf, -math.inf]),
                T50=pick(1400.0 + rng.randint(0, 5), [None, math.nan, 500.0]),
                P30=pick(554.0 if (n // 50) % 2 else 550.0 + rng.randint(0, 2), [None, math.nan]),
                Nf=pick(2388.0, [None, 1500.0, 2000.0]),
                Nc=pick(8138.0 + rng.randint(0, 3), [None, math.nan]),
                phi=pick(520.0 + rng.randint(0, 5), [None, math.nan]),
            )
        )
    return rows


def below(a, b):
    """a < b as Spark sees it: NULL is no answer, NaN is above every number."""
    if a is None or b is None:
        return False
    if math.isnan(b):
        return not math.isnan(a)
    return a < b  # False when only a is NaN


def equal(a, b):
    if a is None or b is None:
        return False
    return a == b or (math.isnan(a) and math.isnan(b))


def shield_by_hand(rows, as_of, max_age=3600, sla=300, horizon=5):
    """The pipeline for rows without duplicate keys: {key: (reasons, htBleed, T50, P30)}."""
    kept = [r for r in rows if r[2] is not None and r[2] >= as_of - timedelta(seconds=max_age)]
    results = {}
    units = {}
    for row in kept:
        units.setdefault(row[0], []).append(row)
    for run in units.values():
        run.sort(key=lambda r: (r[2], -math.inf if r[1] is None else r[1]))
        blanked = []
        for row in run:
            unit, cycle, at, bleed, t2, t50, p30, nf, nc, phi = row
            broken = below(t50, t2) and below(2000.0, nf)
            blanked.append(None if broken else t50)
        for i, row in enumerate(run):
            unit, cycle, at, bleed, t2, t50, p30, nf, nc, phi = row
            reasons = []
            whole = int((as_of.replace(microsecond=0) - at.replace(microsecond=0)).total_seconds())
            if whole > sla:
                reasons.append("SLA_VIOLATION")
            rot = bleed is None or math.isnan(bleed) or math.isinf(bleed)
            if rot:
                reasons.append("SCHEMA_ROT")
            if i and cycle is not None and run[i - 1][1] is not None and cycle < run[i - 1][1]:
                reasons.append("ZOMBIE_STATE_DETECTED")
            broken = below(t50, t2) and below(2000.0, nf)
            if broken:
                reasons.append("THERMOCOUPLE_BREAK")
            back = horizon - 1
            frozen = i >= back and all(equal(p30, run[i - k][6]) for k in range(1, horizon))
            if frozen:
                old = run[i - back][8]
                frozen = nc is not None and old is not None and not equal(nc, old)
            if frozen:
                reasons.append("SENSOR_FREEZE")
            if i and below(run[i - 1][9], phi) and below(blanked[i], blanked[i - 1]):
                reasons.append("ADVERSARIAL_DRIFT")
            results[(unit, cycle, at)] = (
                tuple(reasons),
                None if rot else bleed,
                blanked[i],
                None if frozen else p30,
            )
    return results


def unique_by_key(rows):
    seen = {}
    for row in rows:
        seen.setdefault(row[:3], row)
    return list(seen.values())


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def as_results(df):
    return {
        (r.unit_number, r.time_cycles, r.timestamp): (
            tuple(r.corruption_reason), plain(r.htBleed), plain(r.T50), plain(r.P30)
        )
        for r in df.collect()
    }


def plain_results(results):
    return {k: (v[0], plain(v[1]), plain(v[2]), plain(v[3])) for k, v in results.items()}
