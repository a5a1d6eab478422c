import os
import random
import subprocess
import sys
import time
from datetime import timedelta

import pytest
from helpers import (
    COLUMNS, START, as_results, frame, plain_results, random_frames, shield_by_hand,
    unique_by_key,
)
from pyspark.sql import functions as F

from fleetpulse.operators.pick import drop_duplicate_frames
from fleetpulse.operators.ticks import encode_frames
from fleetpulse.plans import sample_views as V
from fleetpulse.session import STATE_STORE
from fleetpulse.settings import ShieldSettings
from fleetpulse.sources import frames as FR
from fleetpulse.sources import lake as K
from fleetpulse.streaming import ingest as I
from fleetpulse.streaming import progress as P
from fleetpulse.streaming import shield as SS


class Folder:
    """A stream source that grows file by file, one file per micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.count = spark, str(path), 0

    def add(self, rows):
        df = self.spark.createDataFrame(rows, COLUMNS).coalesce(1)
        df.write.mode("append").parquet(self.path)
        newest = max(
            (os.path.join(self.path, f) for f in os.listdir(self.path) if f.endswith(".parquet")),
            key=os.path.getmtime,
        )
        self.count += 1
        stamp = time.time() - 1000 + self.count
        os.utime(newest, (stamp, stamp))

    def stream(self):
        return (
            self.spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(self.path)
        )


def drain(df, tmp_path, name="out"):
    out = str(tmp_path / name)
    I.write_stream(df, out, str(tmp_path / f"{name}_checkpoint"), once=True).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_stream_rules_equal_plain_python_over_batches_and_a_restart(spark, tmp_path):
    rows = unique_by_key([r for r in random_frames(600, seed=5) if r[2] is not None])
    rows.sort(key=lambda r: r[2])
    as_of = START + timedelta(seconds=600 * 40)
    settings = ShieldSettings(max_age_seconds=20_000, sla_seconds=9_000)
    source = Folder(spark, tmp_path / "in")
    cuts = [0, 200, 230, 231, 450, 600]
    pieces = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    for piece in pieces[:3]:
        source.add(list(reversed(piece)) + piece[:5])
    first = drain(SS.shield_stream(source.stream(), as_of, settings), tmp_path)
    assert 0 < first.count() < len(rows)
    for piece in pieces[3:]:
        source.add(list(reversed(piece)))
    got = as_results(drain(SS.shield_stream(source.stream(), as_of, settings), tmp_path))
    last = rows[-1][2]
    watermark = last.replace(microsecond=last.microsecond // 1000 * 1000) - timedelta(seconds=10)
    expected = shield_by_hand(rows, as_of, max_age=20_000, sla=9_000)
    expected = {k: v for k, v in expected.items() if k[2] <= watermark}
    assert got == plain_results(expected)
    assert {r for v in got.values() for r in v[0]} == set(SS.C.REASONS)


def test_a_unit_spread_over_spans_is_judged_as_in_one_run(spark, tmp_path):
    """Nine frames in ten are of one unit; some spans hold fewer frames than a rule looks back."""
    rows = unique_by_key([r for r in random_frames(500, seed=8, hot_share=0.9) if r[2] is not None])
    rows += [frame(unit=1, cycle=n, second=30_000 + 2_000 * n, P30=550.0, Nc=8138.0 + n) for n in range(9)]
    rows.sort(key=lambda r: r[2])
    as_of, settings = START + timedelta(seconds=50_000), ShieldSettings(max_age_seconds=60_000, sla_seconds=9_000)
    source = Folder(spark, tmp_path / "in")
    for a, b in zip([0, 150, 151, 320], [150, 151, 320, len(rows)]):
        source.add(rows[a:b])
    SS.closing_frame(spark.createDataFrame([], COLUMNS)).write.mode("append").parquet(source.path)
    found = [
        as_results(drain(SS.shield_stream(source.stream(), as_of, settings, span_seconds=how), tmp_path, f"out{how}"))
        for how in (None, 3_600)
    ]
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_rows_out_of_order_within_the_watermark_are_judged_in_order(spark, tmp_path):
    def row(second):
        return frame(cycle=second // 50, second=second, Nc=8000.0 + second, phi=float(second),
                     T50=1600.0 - second % 7)

    batches = [[*range(0, 100, 5)], [92, 103, 110], [106, 104, 120], [118, 130, 112], [160], [220]]
    source = Folder(spark, tmp_path / "in")
    for batch in batches:
        source.add([row(s) for s in batch])
    got = as_results(drain(SS.shield_stream(source.stream(), START), tmp_path))
    expected = shield_by_hand([row(s) for b in batches for s in b], START)
    del expected[row(220)[:3]]
    assert got == plain_results(expected)


def test_duplicates_across_batches_and_late_rows(spark, tmp_path):
    source = Folder(spark, tmp_path / "in")
    source.add([frame(cycle=1, second=100), frame(cycle=1, second=101)])
    source.add([frame(cycle=1, second=101), frame(cycle=2, second=300)])
    source.add([frame(cycle=3, second=400)])
    source.add([frame(cycle=9, second=50), frame(cycle=4, second=500)])
    out = drain(SS.drop_duplicates_stream(source.stream()), tmp_path)
    assert sorted(r.time_cycles for r in out.collect()) == [1, 1, 2, 3, 4]


def test_stream_keeps_other_columns_null_and_nan_apart(spark, tmp_path):
    source = Folder(spark, tmp_path / "in")
    nan = float("nan")
    source.add([frame(second=0, Nc=None, T2=nan, cycle=None), frame(second=1, Nc=nan, T2=None)])
    source.add([frame(second=100)])
    stream = source.stream().withColumn("processing_at", F.col("timestamp"))
    out = drain(SS.shield_stream(stream, START), tmp_path).orderBy("timestamp").collect()
    assert [(r.Nc, r.time_cycles) for r in out][0] == (None, None) and out[0].T2 != out[0].T2
    assert out[1].Nc != out[1].Nc and out[1].T2 is None and out[1].time_cycles == 1
    assert [r.processing_at for r in out] == [r.timestamp for r in out]


def test_ingest_with_rules_and_quarantine(spark, tmp_path):
    path, lake, bad = (str(tmp_path / n) for n in ("in", "lake", "bad"))
    rows = [frame(second=n, T50=1400.0 + n, htBleed=None if n == 3 else 390.0) for n in range(60)]
    encode_frames(spark.createDataFrame(rows, COLUMNS), START).coalesce(1).write.text(path)
    spark.createDataFrame([("{bad",), ('{"unit_number":1}',)], "value string").coalesce(
        1
    ).write.mode("append").text(path)
    source = FR.FileSource(path)
    I.start_lake_ingest(
        spark, source, lake, str(tmp_path / "c1"), ShieldSettings(), START, once=True
    ).awaitTermination()
    I.start_quarantine(spark, source, bad, str(tmp_path / "c2"), once=True).awaitTermination()
    kept = K.read_lake(spark, lake)
    assert kept.count() == 50  # the last ten seconds are still behind the watermark
    assert [r.corruption_reason for r in kept.filter("is_corrupted").collect()] == ["SCHEMA_ROT"]
    assert sorted(r.reject_reason for r in spark.read.parquet(bad).collect()) == [
        "malformed frame", "no readable timestamp"
    ]


def test_plain_ingest_is_map_only(spark, tmp_path):
    path = str(tmp_path / "in")
    encode_frames(spark.createDataFrame([frame()], COLUMNS), START).write.text(path)
    query = I.start_lake_ingest(
        spark, FR.FileSource(path), str(tmp_path / "lake"), str(tmp_path / "c"), as_of=START, once=True
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "Exchange" not in plan
    assert K.read_lake(spark, str(tmp_path / "lake")).count() == 1


def test_workers_need_no_package_for_the_stateful_operator(tmp_path):
    from pyspark import cloudpickle

    from fleetpulse.streaming import run_rules as R

    rules = R.RunRules(["unit_number"], {R.CYCLE: 0}, [R.COUNTER_FELL], 5)
    (tmp_path / "rules.pickle").write_bytes(cloudpickle.dumps(rules))
    code = "import pickle; print(pickle.load(open('rules.pickle', 'rb')).horizon)"
    ran = subprocess.run(
        [sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True
    )
    assert ran.stdout.strip() == "5", ran.stderr


class Handle:
    """State of one key, kept in plain Python."""

    def __init__(self):
        self.timers = []

    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key_schema, value_schema):
        return Map()

    def registerTimer(self, millis):
        self.timers.append(millis)


class Value:
    stored = None

    def get(self):
        return self.stored

    def update(self, value):
        self.stored = value

    def clear(self):
        self.stored = None


class Map(dict):
    updateValue, getValue, removeKey = dict.__setitem__, dict.__getitem__, dict.__delitem__


class Clock:
    def __init__(self, seconds):
        self.seconds = seconds

    def getCurrentWatermarkInMs(self):
        return int(self.seconds * 1000)


def test_a_hot_unit_is_judged_in_bounded_pieces():
    import numpy as np
    import pandas as pd

    from fleetpulse.streaming import run_rules as R

    rng = np.random.default_rng(3)
    count = 60_000
    columns = [R.MICROS, R.NULLS, R.NANS, *[f"value{n}" for n in range(5)]]
    frames = pd.DataFrame({R.MICROS: np.arange(1, count + 1) * 1_000_000, R.NULLS: 0, R.NANS: 0})
    for n in range(5):
        frames[f"value{n}"] = rng.integers(0, 3, count).astype(float)
    places = dict(zip(R.READ, range(5)))
    rules = R.RunRules(columns, places, [R.COUNTER_FELL, R.FROZEN, R.DRIFTED], 5)
    sizes = []

    class Watched(R.RunRules):
        def _judge(self, run):
            sizes.append(len(run))
            return super()._judge(run)

    watched = Watched(columns, places, rules.rules, 5)
    watched.init(Handle())
    out, clock = [], Clock(0)
    shuffled = frames.sample(frac=1, random_state=1)
    # One large micro-batch in many chunks, a small one within the watermark, and the end.
    chunks = [shuffled[n : n + 9_000] for n in range(0, count, 9_000)]
    out += watched.handleInputRows(None, iter(chunks[:5]), clock)
    out += watched.handleInputRows(None, iter(c[:1_500] for c in chunks[5:]), clock)
    out += watched.handleInputRows(None, iter(c[1_500:] for c in chunks[5:]), clock)
    assert not out
    for clock in (Clock(7_000.5), Clock(7_200), Clock(30_000), Clock(70_000)):
        out += watched.handleExpiredTimer(None, clock, None)
    pd.testing.assert_frame_equal(
        pd.concat(out, ignore_index=True), rules._judge(frames).reset_index(drop=True)
    )
    assert max(sizes) <= 3_600 * 2 + 4
    assert not watched.waiting


def test_few_frames_of_a_span_reach_the_lane_of_the_unit():
    import numpy as np
    import pandas as pd

    from fleetpulse.streaming import run_rules as R

    columns = [R.MICROS, R.NULLS, R.NANS, *[f"value{n}" for n in range(5)]]
    hour = pd.DataFrame({R.MICROS: np.arange(3_000) * 1_000_000 + 7 * R.SPAN_MICROS, R.NULLS: 0, R.NANS: 0})
    for n in range(5):
        hour[f"value{n}"] = np.random.default_rng(n).integers(0, 3, 3_000).astype(float)
    rules = R.SpanRules(columns, dict(zip(R.READ, range(5))), [R.COUNTER_FELL, R.FROZEN, R.DRIFTED], 5, R.SPAN_MICROS)
    handle = Handle()
    rules.init(handle)
    out = list(rules.handleInputRows((1, 7), iter([hour.sample(frac=1, random_state=2)]), Clock(0)))
    assert not out and 8 * R.SPAN_MICROS // 1000 in handle.timers
    for at in (7 * 3_600 + 900, 8 * 3_600):
        out += rules.handleExpiredTimer((1, 7), Clock(at), None)
    found = pd.concat(out)
    assert found[R.EDGE].value_counts().to_dict() == {R.INNER: 2_996, R.HEAD: 4, R.TAIL: 4}
    assert set(found[R.LANE]) == {7, R.ALL_SPANS} and rules.arrivals.get() is None
    assert list(rules.handleExpiredTimer((1, 7), Clock(9 * 3_600), None)) == []


def test_frames_behind_the_watermark_are_found(spark, tmp_path):
    source = Folder(spark, tmp_path / "in")
    early = [frame(cycle=n, second=n) for n in range(0, 40, 10)]
    late = [frame(cycle=90, second=5), frame(unit=2, cycle=91, second=7), frame(cycle=0, second=0)]
    for rows in (early, [frame(cycle=50, second=500)], [frame(cycle=60, second=600)], late):
        source.add(rows)
    SS.closing_frame(source.stream().sparkSession.createDataFrame([], COLUMNS)).write.mode(
        "append"
    ).parquet(source.path)
    released = drain(SS.shield_stream(source.stream(), START), tmp_path)
    sent = spark.createDataFrame([*early, frame(cycle=50, second=500), frame(cycle=60, second=600), *late], COLUMNS)
    found = SS.late_frames(sent, released, START).collect()
    assert sorted((r.unit_number, r.time_cycles, r.reject_reason) for r in found) == [
        (1, 90, SS.LATE), (2, 91, SS.LATE)
    ]


def test_one_pass_fills_the_lake_and_the_rejects(spark, tmp_path):
    path, lake, bad = (str(tmp_path / n) for n in ("in", "lake", "bad"))
    encode_frames(spark.createDataFrame([frame(second=n) for n in range(5)], COLUMNS), START).write.text(path)
    spark.createDataFrame([("{bad",)], "value string").write.mode("append").text(path)
    source = FR.FileSource(path)
    args = (spark, source, lake, str(tmp_path / "c"))
    I.start_lake_ingest(*args, as_of=START, once=True, rejects=bad).awaitTermination()
    assert K.read_lake(spark, lake).count() == 5
    assert [r.value for r in spark.read.parquet(bad).collect()] == ["{bad"]
    with pytest.raises(ValueError):
        I.start_lake_ingest(*args, shield=ShieldSettings(), rejects=bad)


def test_stream_rules_ask_for_their_state_store(spark, tmp_path):
    source = Folder(spark, tmp_path / "in")
    source.add([frame()])
    kept = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "some.other.Provider")
    try:
        with pytest.raises(RuntimeError):
            SS.shield_stream(source.stream(), START)
    finally:
        spark.conf.set(STATE_STORE, kept)


def test_slices_of_an_empty_table(spark):
    path, files = V.write_slices(spark.createDataFrame([], COLUMNS))
    assert files == 1 and spark.read.schema(COLUMNS).parquet(path).count() == 0


def test_the_survivor_of_differing_copies_is_that_of_a_batch(spark, tmp_path):
    source, rows = Folder(spark, tmp_path / "in"), []
    rng = random.Random(4)
    for n in range(40):
        rows += [frame(unit=n % 3, cycle=n, second=n, P30=540.0 + k) for k in range(rng.randint(1, 4))]
    for n in range(4):  # copies of a frame come in different batches, in this order and in that
        source.add([r for k, r in enumerate(rows) if k % 4 == n])
    SS.closing_frame(spark.createDataFrame([], COLUMNS)).write.mode("append").parquet(source.path)
    kept = drain(SS.least_copies_stream(source.stream(), ShieldSettings(watermark="10 minutes")), tmp_path)
    batch = drop_duplicate_frames(spark.createDataFrame(rows, COLUMNS))
    mark = lambda df: sorted((r.unit_number, r.time_cycles, r.P30) for r in df.collect())
    assert mark(kept) == mark(batch) and len(mark(kept)) == 40


def test_late_frames_are_found_by_the_watermark(spark, tmp_path):
    """Late ones above the newest released frame, and where nothing was released."""
    for name, early in (("gap", [frame(cycle=n, second=n) for n in range(0, 40, 10)]), ("none", [])):
        folder = tmp_path / name
        folder.mkdir()
        source, marks = Folder(spark, folder / "in"), str(folder / "marks")
        late = [frame(unit=2, cycle=91, second=300), frame(unit=3, cycle=92, second=480)]
        waiting = [frame(cycle=50, second=500), frame(cycle=60, second=501)]
        for rows in (*([early] if early else []), waiting[:1], waiting[1:], late):
            source.add(rows)
        log = P.WatermarkLog(spark, marks)
        spark.streams.addListener(log)
        try:
            out, checkpoint = str(folder / "out"), str(folder / "checkpoint")
            shielded = SS.shield_stream(source.stream(), START)
            running = I.write_stream(shielded, out, checkpoint, once=True)
            running.awaitTermination()
            P.settle(log, running)
        finally:
            spark.streams.removeListener(log)
        released = spark.read.schema(shielded.schema).parquet(out)
        assert released.count() == len(early)
        last = P.last_watermark(spark, marks)
        assert P.utc_text(last) == "2024-01-01 00:08:11.000000"
        sent = spark.createDataFrame([*early, *waiting, *late], COLUMNS)
        found = SS.late_frames(sent, released, START, watermark=last).collect()
        assert sorted(r.time_cycles for r in found) == [91, 92]


def test_counters_of_a_running_ingest_and_a_batch_tried_again(spark, tmp_path):
    path, lake, bad, checkpoint = (str(tmp_path / n) for n in ("in", "lake", "bad", "c"))
    for n in range(3):
        rows = spark.createDataFrame([frame(second=10 * n + k) for k in range(5)], COLUMNS)
        encode_frames(rows, START).coalesce(1).write.mode("append").text(path)
    spark.createDataFrame([("{bad",)], "value string").coalesce(1).write.mode("append").text(path)
    counters = P.LiveCounters()
    spark.streams.addListener(counters)
    try:
        def run(as_of):
            running = I.start_lake_ingest(
                spark, FR.FileSource(path, 1), lake, checkpoint, as_of=as_of, once=True, rejects=bad, counted_as="ingest"
            )
            running.awaitTermination()
            P.settle(counters, running)
        run("2024-01-01 00:00:00")
        assert counters.totals("ingest") == {"batches": 4, "frames": 16, "accepted": 15, "rejected": 1, "without_unit": 1}
        K.compact_lake(spark, lake, "2024-01-01")
        K.expire_lake(spark, lake, 0)
        for name in ("3", ".3.crc"):
            os.rename(f"{checkpoint}/commits/{name}", str(tmp_path / f"gone{name}"))
        run("2024-01-02 00:00:00")  # the last batch again, a day later
    finally:
        spark.streams.removeListener(counters)
    days = {str(r.processing_date): r["count"] for r in K.read_lake(spark, lake).groupBy("processing_date").count().collect()}
    assert days == {"2024-01-01": 15}
    assert [r.value for r in spark.read.parquet(bad).collect()] == ["{bad"]
