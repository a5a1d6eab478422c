import math

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.ticks import encode_frames
from fleetpulse.schema import SENSORS
from fleetpulse.sources import frames as FR
from fleetpulse.sources import text as TX

GOOD = "1   2 " + " ".join(f"{n}.5" for n in range(24))


def write_lines(tmp_path, *lines, name="a.txt"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_blueprint_rows_and_rejects(spark, tmp_path):
    fields = GOOD.split()
    path = write_lines(
        tmp_path,
        f"   {GOOD}  ",
        "",
        " ".join(fields[:-1]),
        GOOD.replace(" 3.5 ", " x "),
        GOOD.replace("1   2", "1.0 2"),
        GOOD.replace(" 3.5 4.5 ", " nan -inf "),
        GOOD.replace(" 3.5 4.5 ", " 1e3 5d "),
        "\t" + "\t".join(fields + ["9"]),
    )
    rows, rejects = TX.read_blueprint(spark, path)
    got = sorted(map(tuple, rows.collect()), key=repr)
    assert len(got) == 2 and all(r[:2] == (1, 2) for r in got)
    assert {type(v) for r in got for v in r[2:]} == {float}
    assert any(math.isnan(r[5]) and r[6] == -math.inf for r in got)
    bad = {r.line_number: r.reject_reason for r in rejects.collect()}
    assert bad == {
        3: "expected 26 fields, found 25",
        4: "field is not a number",
        5: "field is not a number",
        7: "field is not a number",
        8: "expected 26 fields, found 27",
    }


def test_strict_mode_fails_with_the_line_number(spark, tmp_path):
    rows, _ = TX.read_blueprint(spark, write_lines(tmp_path, GOOD, "", "oops"), strict=True)
    with pytest.raises(Exception, match=r"a\.txt:3: expected 26 fields, found 1"):
        rows.collect()
    rows, _ = TX.read_blueprint(spark, write_lines(tmp_path, GOOD, name="b.txt"), strict=True)
    assert rows.count() == 1


def test_line_numbers_over_pieces_of_files(spark, tmp_path):
    expected = set()
    for name in ("a.txt", "b.txt"):
        lines = [f"{name}-{n}" if n % 5 else "" for n in range(1, 400)]
        write_lines(tmp_path, *lines, name=name)
        expected |= {(name, n, line) for n, line in enumerate(lines, 1) if line}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        df = TX.read_lines(spark, str(tmp_path), numbered=True)
        got = {(r.file.rsplit("/", 1)[1], r.line_number, r.line) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == expected


def test_life_vector_numbers_units_by_line(spark, tmp_path, rows_of):
    path = write_lines(tmp_path, "112 ", "98 ", "69")
    assert rows_of(TX.read_life_vector(spark, path)) == [(1, 112), (2, 98), (3, 69)]


WIRE = [
    '{"timestamp":"2024-01-01T00:00:00.123456789Z","unit_number":1,"time_cycles":2,"T50":1.5}',
    "{bad",
    "[]",
    None,
    '{"Timestamp":"2024-01-01T00:00:00Z"}',
    '{"timestamp":"yesterday","unit_number":1}',
    '{"timestamp":"2024-01-01T00:00:00Z","time_cycles":2}',
    '{"timestamp":"2024-01-01T00:00:00Z","unit_number":3000000000}',
    '{"timestamp":"2024-01-01T02:00:00+02:00","unit_number":3,"time_cycles":1.5,'
    '"T50":"NaN","P30":NaN,"Nf":"Infinity"}',
]


def test_decode_keeps_good_frames_and_quarantines_the_rest(spark):
    raw = spark.createDataFrame([(None if v is None else v.encode(),) for v in WIRE], "value binary")
    decoded = FR.decode_frames(raw)
    good = FR.accepted_frames(decoded).orderBy("unit_number").collect()
    assert [r.unit_number for r in good] == [1, 3]
    assert str(good[0].timestamp) == "2024-01-01 00:00:00.123456"
    assert good[0].time_cycles == 2 and good[0].T50 == 1.5 and good[0].P30 is None
    assert good[1].time_cycles is None and math.isnan(good[1].T50) and math.isnan(good[1].P30)
    assert good[1].Nf == math.inf and str(good[1].timestamp) == "2024-01-01 00:00:00"
    bad = {r.value: r.reject_reason for r in FR.rejected_frames(decoded).collect()}
    assert bad == {
        WIRE[1]: "malformed frame",
        WIRE[2]: "malformed frame",
        None: "malformed frame",
        WIRE[4]: "malformed frame",
        WIRE[5]: "no readable timestamp",
        WIRE[6]: "no unit",
        WIRE[7]: "no unit",
    }


def test_every_frame_is_either_accepted_or_rejected(spark):
    raw = spark.createDataFrame([(v,) for v in WIRE], "value string")
    decoded = FR.decode_frames(raw)
    kept = FR.accepted_frames(decoded).count() + FR.rejected_frames(decoded).count()
    assert kept == len(WIRE) == FR.topic_size(raw).first().messages


def test_encoded_frames_have_frame_order_and_short_fractions(spark):
    df = spark.sql(
        "SELECT 1 AS unit_number, 2 AS time_cycles, timestamp'2024-01-01 00:00:00.12' AS timestamp,"
        + ", ".join(f"{n}.0D AS {name}" for n, name in enumerate(SENSORS))
    )
    text = encode_frames(df, "2024-01-01 10:00:00").first().value
    assert text.startswith('{"timestamp":"2024-01-01T00:00:00.12Z","unit_number":1,"time_cycles":2,')
    assert text.endswith('"processing_at":"2024-01-01T10:00:00Z"}')
    back = FR.accepted_frames(FR.decode_frames(spark.createDataFrame([(text,)], "value string")))
    row = back.first()
    assert [row[name] for name in SENSORS] == [float(n) for n in range(24)]


def test_topic_sources_ask_for_the_whole_topic():
    source = FR.TopicSource("host:9092", "frames")
    assert source._options()["startingOffsets"] == "earliest"


def test_from_json_is_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    plan = FR.accepted_frames(FR.decode_frames(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_rejects_are_numbered_without_their_neighbours(spark, tmp_path):
    path = write_lines(tmp_path, GOOD, "", "oops", GOOD, "1 2", name="c.txt")
    rows, rejects = TX.read_blueprint(spark, path)
    assert [(r.line_number, r.line) for r in rejects.orderBy("line_number").collect()] == [
        (3, "oops"), (5, "1 2")
    ]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ExistingRDD" not in plan and rows.count() == 2
