"""Steps whose work must follow the input: how it is dealt to tasks, and that results stay whole."""

import pathlib

import pytest
from pyspark.sql import functions as F

from fleetpulse.functions import parsing as P
from fleetpulse.operators import ticks as X
from fleetpulse.plans import catalog
from fleetpulse.plans import sample_views as V
from fleetpulse.sources import lake as K
from fleetpulse.sources import text as TX


def flat(df):
    return sorted(map(str, df.collect()))


def flown(spark, rows=90):
    return spark.range(rows).select(
        F.lit("run_1").alias("run_id"),
        (F.col("id") % 7).cast("int").alias("unit_number"),
        (F.col("id") % 3).cast("int").alias("time_cycles"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7200).alias("timestamp"),
        F.col("id").cast("double").alias("T50"),
    )


def test_a_flight_over_many_days_is_in_one_folder(spark, tmp_path):
    path = str(tmp_path / "edge")
    K.write_edge(X.edge_rows(X.with_start(flown(spark), ["unit_number", "time_cycles"]), "run_1"), path)
    stored = K.read_edge(spark, path)
    assert stored.count() == 90
    days = stored.groupBy("unit_number", "time_cycles").agg(F.countDistinct("date").alias("days"))
    assert {r.days for r in days.collect()} == {1}


def test_tasks_follow_the_number_of_folders(spark, tmp_path, monkeypatch):
    rows = X.edge_rows(flown(spark).withColumn("flight_start_time", F.col("timestamp")), "run_1")
    monkeypatch.setattr(K, "_TASK_FOLDERS", 1)
    few = rows.select("run_id", "unit", "date").distinct().count()
    assert K._dealt_by_folder(rows).rdd.getNumPartitions() >= few > 1
    monkeypatch.setattr(K, "_FOLDER_ROWS", 1)  # every folder is large, and dealt to several tasks
    for path in (str(tmp_path / "edge"), str(tmp_path / "again")):
        K.write_edge(rows, path)
        found = K.read_edge(spark, path).select("unit_number", "time_cycles", "T50")
        assert flat(found) == flat(rows.select("unit_number", "time_cycles", "T50"))


def test_fields_are_split_without_a_pattern(spark):
    texts = ["", "   ", " a  b ", "\ta\t b", "a\x0bb\x0cc\rd\ne", "a\u00a0b \u2003 c", "  1 2.5d", None]
    lines = spark.createDataFrame([(t,) for t in texts], "line string")
    by_pattern = F.regexp_extract_all("line", F.lit(r"\S+"), F.lit(0))
    for row in lines.select(P.tokens(F.col("line")).alias("found"), by_pattern.alias("expected")).collect():
        assert row.found == row.expected
    plan = lines.select(P.tokens(F.col("line")))._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract_all" not in plan


def test_a_strict_load_numbers_lines_of_the_first_bad_file_alone(spark, tmp_path, monkeypatch):
    good = "1 2 " + " ".join(["0.5"] * 24)
    folder = tmp_path / "some lines [1]"
    folder.mkdir()
    contents = {"a": [good] * 3, "b c%": [good, "", "x", "y"], "d": ["z"], "e": [good]}
    for name, lines in contents.items():
        (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")
    numbered = []
    rejects = TX.numbered_rejects
    monkeypatch.setattr(TX, "numbered_rejects", lambda *a: numbered.append(rejects(*a)) or numbered[-1])
    with pytest.raises(TX.BadLine) as found:
        TX.load_blueprint_strict(spark, str(tmp_path / "some lines*"), str(tmp_path / "table"))
    assert found.value.line_number == 3 and found.value.file.endswith("b%20c%25.txt")
    assert {r.line for r in numbered[0].collect()} == {"x", "y"}


def test_a_strict_load_of_packed_files_names_the_line(spark, tmp_path):
    source, table = str(tmp_path / "lines"), str(tmp_path / "table")
    good = "1 2 " + " ".join(["0.5"] * 24)
    texts = [good, "", good, "x", good, good, "y"]
    lines = spark.createDataFrame([(t,) for t in texts], "line string").coalesce(1)
    lines.write.options(**{**catalog.PACKED, "maxRecordsPerFile": "3"}).text(source)
    assert len(list((tmp_path / "lines").glob("*.txt.gz"))) == 3
    with pytest.raises(TX.BadLine) as found:
        TX.load_blueprint_strict(spark, source, table)
    assert found.value.line_number == 1 and "-c001" in found.value.file


def test_the_sources_of_strict_loads_are_packed_and_go(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7 % 2000).alias("l_partkey"),
        (F.col("id") % 100).alias("l_suppkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"),
    )
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    sources, sizes, load = [], [], TX.load_blueprint_strict

    def stored(path):
        return sum(f.stat().st_size for f in pathlib.Path(path).glob("part-*"))

    def spy(spark, source, table):
        sources.append(source)
        sizes.append((stored(source), spark.read.text(source).agg(F.sum(F.length("value") + 1)).first()[0]))
        assert [s for s in sources if stored(s)] == [source]
        load(spark, source, table)

    monkeypatch.setattr(TX, "load_blueprint_strict", spy)
    found = catalog.QUERIES["blueprint_strict"](spark, str(tmp_path))
    assert len(sizes) == 2 and all(2 * room < text for room, text in sizes)
    assert not any(stored(s) for s in sources)
    assert flat(found) == flat(catalog.QUERIES["text_parse_valid"](spark, str(tmp_path)))


def test_lines_are_parsed_once_for_two_rebuilds(spark, monkeypatch):
    parsed = []
    lines = catalog._lines

    def counted(*args):
        seen = spark.sparkContext.accumulator(0)
        parsed.append(seen)
        found = lines(*args)
        once = F.udf(lambda text: seen.add(1) or text).asNondeterministic()
        return found.withColumn(TX.REJECT, once(TX.REJECT))

    monkeypatch.setattr(catalog, "_lines", counted)
    rows = catalog.QUERIES["ledger_rebuild"](spark, "/root/testdata/sf0.001").count()
    written = V.run_view(spark, V.LINES, "/root/testdata/sf0.001", "lineitem").filter(F.col("line").rlike(r"\S")).count()
    assert 0 < rows <= parsed[0].value <= written


def test_noisy_readings_are_counted_without_a_list(spark):
    plan = catalog.QUERIES["tick_noise"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "array_compact" not in plan and "noisy" in plan
