"""Stored tables that change in part: the ledger, the blueprint, tick files, life vectors."""

import glob
import os
import random

import pytest
from helpers import START
from pyspark.sql import functions as F

from fleetpulse.operators import ledger as L
from fleetpulse.operators import ticks as X
from fleetpulse.sources import lake as K
from fleetpulse.sources import ledger_store as S
from fleetpulse.sources import text as TX
from fleetpulse.sources import versions

LEDGER = "unit_number int, time_cycles int, status string, target_duration_sec int"
REPORTS = "unit_number int, time_cycles int, status string, seq long"


def ledger(spark):
    rows = [(u, c, "PENDING" if c else "IN_FLIGHT", 120 + c) for u in range(1, 21) for c in range(20)]
    return spark.createDataFrame([*rows, (None, 3, "PENDING", 1)], LEDGER)


def flat(df):
    return sorted(map(str, df.collect()))


def test_stored_reports_equal_the_batch_whatever_their_order(spark, tmp_path):
    rng, path = random.Random(1), str(tmp_path / "ledger")
    reports = [
        (rng.randint(1, 22), rng.randint(0, 21), rng.choice(["COMPLETED", "FAILED", "INTERRUPTED"]), n)
        for n in range(300)
    ]
    expected = flat(L.apply_status_reports(ledger(spark), spark.createDataFrame(reports, REPORTS)))
    S.store_ledger(ledger(spark), path, buckets=5)
    assert flat(S.read_ledger(spark, path)) == flat(ledger(spark))
    rng.shuffle(reports)
    for n in range(0, 300, 100):
        S.apply_reports(spark, path, spark.createDataFrame(reports[n : n + 100], REPORTS))
    assert flat(S.read_ledger(spark, path)) == expected
    S.apply_reports(spark, path, spark.createDataFrame(reports[:100], REPORTS))  # a replay
    assert flat(S.read_ledger(spark, path)) == expected


def test_few_reports_rewrite_few_buckets(spark, tmp_path):
    path = str(tmp_path / "ledger")
    S.store_ledger(ledger(spark), path, buckets=40)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/version=*/bucket=*/*.parquet")}
    few = spark.createDataFrame([(3, 4, "FAILED", 1), (5, 6, "COMPLETED", 2), (900, 1, "FAILED", 3)], REPORTS)
    touched = S.apply_reports(spark, path, few, "stream", 0)
    assert 1 <= len(touched) <= 3
    new = set(glob.glob(f"{path}/version=*/bucket=*/*.parquet")) - set(before)
    assert {int(p.split("bucket=")[1].split("/")[0]) for p in new} <= set(touched)
    assert all(os.path.getmtime(p) == t for p, t in before.items())
    rows = S._read(spark, path, versions.note_of(spark, path), touched)
    assert 0 < rows.count() < 100 and all("bucket=" in f for f in rows.inputFiles())
    assert S.apply_reports(spark, path, few, "stream", 0) == []
    assert S.apply_reports(spark, path, few.limit(0), "stream", 1) == []


def test_reports_as_a_stream_survive_a_second_try(spark, tmp_path):
    path, source, checkpoint = (str(tmp_path / n) for n in ("ledger", "in", "checkpoint"))
    S.store_ledger(ledger(spark), path, buckets=4)
    for n in range(3):
        rows = spark.createDataFrame([(1, 1, f"S{n}", n), (2, n, "COMPLETED", n)], REPORTS)
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(REPORTS).option("maxFilesPerTrigger", 1).parquet(source)
    S.start_report_ingest(stream(), path, checkpoint, once=True).awaitTermination()
    done = flat(S.read_ledger(spark, path))
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{checkpoint}/commits/[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        os.rename(f"{checkpoint}/commits/{name}", str(tmp_path / f"gone-{name}"))
    S.start_report_ingest(stream(), path, checkpoint, once=True).awaitTermination()
    assert flat(S.read_ledger(spark, path)) == done
    statuses = {(r.unit_number, r.time_cycles): r.status for r in S.read_ledger(spark, path).collect()}
    assert statuses[(1, 1)] == "S2" and statuses[(2, 2)] == "COMPLETED"


def line(n, bad=False):
    return " ".join([str(n), "1", *(["x"] if bad else ["0.5"]), *["1.25"] * 23])


def test_a_strict_load_is_all_or_nothing_and_names_the_first_bad_line(spark, tmp_path):
    table = str(tmp_path / "table")
    def files(name, *contents):
        folder = tmp_path / name
        folder.mkdir()
        for n, lines in enumerate(contents):
            (folder / f"part-{n}.txt").write_text("\n".join(lines) + "\n")
        return str(folder)
    mixed = files("mixed", [line(n) for n in range(50)], [line(1), "", line(2, True), line(3, True)], [line(4, True)])
    with pytest.raises(TX.BadLine):
        TX.load_blueprint_strict(spark, mixed, table)
    assert not versions.has_parts(spark, table)
    TX.load_blueprint_strict(spark, files("good", [line(n) for n in range(30)]), table)
    assert TX.read_blueprint_table(spark, table).count() == 30
    with pytest.raises(TX.BadLine) as caught:
        TX.load_blueprint_strict(spark, mixed, table)
    assert (os.path.basename(caught.value.file), caught.value.line_number) == ("part-1.txt", 3)
    assert TX.read_blueprint_table(spark, table).count() == 30
    TX.load_blueprint_strict(spark, files("newer", [line(n) for n in range(4)], [line(9)]), table)
    assert TX.read_blueprint_table(spark, table).count() == 5
    assert versions.expire_parts(spark, table, "stage", 0) >= 2
    assert TX.read_blueprint_table(spark, table).count() == 5


def test_only_folders_of_winning_runs_are_read(spark, tmp_path):
    path = str(tmp_path / "edge")
    rows = spark.range(400).select(
        F.concat(F.lit("run_"), F.col("id") % 5).alias("run_id"),
        # Runs 0 and 1 fly flights that run 4 flies again; run 2 is the last of unit 9 alone.
        F.when(F.col("id") % 5 == 2, F.lit(9)).otherwise((F.col("id") % 3).cast("int")).alias("unit_number"),
        (F.col("id") % 4).cast("int").alias("time_cycles"),
        (F.lit(START).cast("timestamp") + F.make_interval(secs=F.col("id"))).alias("timestamp"),
        F.col("id").cast("double").alias("T50"),
    ).withColumn("flight_start_time", F.col("timestamp"))
    K.write_edge(X.edge_rows(rows, F.col("run_id")), path)
    found = K.latest_run_from_edge(spark, path)
    plain = L.latest_run_per_flight(K.read_edge(spark, path))
    assert flat(found.select("run_id", "unit_number", "time_cycles", "T50")) == flat(
        plain.select("run_id", "unit_number", "time_cycles", "T50")
    )
    runs = {f.split("run_id=")[1].split("/")[0] for f in found.inputFiles() if "run_id=" in f}
    assert runs == {"run_2", "run_4"}


def test_a_life_vector_goes_on_over_its_files(spark, tmp_path):
    folder = tmp_path / "lives"
    folder.mkdir()
    for n in range(3):
        (folder / f"part-{n}.txt").write_text("".join(f"  {10 * n + k} \n" for k in range(4)))
    found = {r.unit_number: r.rul for r in TX.read_life_vector(spark, str(folder)).collect()}
    assert found == {4 * n + k + 1: 10 * n + k for n in range(3) for k in range(4)}
