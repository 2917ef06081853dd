"""Raw files, cleaning, replay and messages."""

import zipfile

import pytest
from pyspark.sql import functions as F

from trackflow.config import Settings
from trackflow.functions import messages
from trackflow.operators import cleaning, quality
from trackflow.plans.chain import process
from trackflow.schema import PROCESSED_MESSAGE
from trackflow.sources import files, tables

ONE = """1,2008-02-02 15:00:00,116.5,39.9
1,2008-02-02 15:00:10,500,39.9
1,not a time,116.5,39.9
,2008-02-02 15:00:20,,-95
1,2008-02-02 15:00:30,116.6,40.0
1,bad,1,1
"""
TWO = "2,2008-02-02 15:00:00,116.5,39.9\n2,2008-02-02 15:00:00,116.5,39.9\n2,2008-02-02 16:00:00,116.5,39.9\n"
WANT = {
    (1, "2008-02-02 15:00:00", 116.5, 39.9, "active"),
    (1, "2008-02-02 15:00:10", -1.0, 39.9, "active"),
    (1, "2008-02-02 15:00:20", -1.0, -1.0, "active"),
    (1, "2008-02-02 15:00:30", 116.6, 40.0, "end"),
    (2, "2008-02-02 15:00:00", 116.5, 39.9, "active"),
    (2, "2008-02-02 16:00:00", 116.5, 39.9, "end"),
}


def cleaned_set(df):
    text = df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    names = ["taxi_id", "timestamp", "longitude", "latitude", "trip_status"]
    rows = [tuple(r) for r in text.select(*names).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "1.txt").write_text(ONE)
    (tmp_path / "raw" / "2.txt").write_text(TWO)
    (tmp_path / "raw" / "3.txt").write_text("")
    (tmp_path / "raw" / "notes.csv").write_text("9,2008-02-02 15:00:00,1,1\n")
    return str(tmp_path / "raw")


@pytest.fixture
def zips(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("release/1.txt", ONE)
        z.writestr("release/3.txt", "")
        z.writestr("release/readme.md", "x")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("2.txt", TWO)
        z.writestr("4.txt", "4,2008-02-02 15:00:00,116.5,39.9\n" * 200)
    broken = bytearray((tmp_path / "b.zip").read_bytes())
    at = broken.index(b"4,2008-02-02") + 2000
    broken[at] ^= 0xFF  # member 4 no longer matches its checksum
    (tmp_path / "b.zip").write_bytes(bytes(broken))
    (tmp_path / "c.zip").write_bytes(b"this is no archive")
    return str(tmp_path)


def test_clean_folder(spark, folder):
    assert cleaned_set(cleaning.clean(files.read_folder(spark, folder))) == WANT


def test_clean_zips_skips_broken_members_and_archives(spark, zips):
    raw = files.read_zips(spark, zips)
    assert {r.file for r in raw.select("file").distinct().collect()} == {"release/1.txt", "2.txt"}
    assert cleaned_set(cleaning.clean(raw)) == WANT
    assert files.read_zips(spark, zips, "2.txt").count() == 3
    rejects = {(r.archive.rsplit("/", 1)[1], r.file) for r in files.rejected_zips(spark, zips).collect()}
    assert rejects == {("b.zip", "4.txt"), ("c.zip", None)}


def test_unknown_address_raises():
    with pytest.raises(Exception, match="Unrecognized filesystem"):
        files._open("dbfs:/archives/a.zip")


def test_line_order_survives_splits(spark, tmp_path):
    lines = [f"5,2008-02-02 15:00:00,{i % 90},{i % 45}" for i in range(20_000)]
    lines[-1] = "5,2008-02-02 17:00:00,77.5,33.5"
    (tmp_path / "5.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        raw = files.read_folder(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 4
        ends = cleaning.clean(raw).where("trip_status = 'end'").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.longitude, r.latitude) for r in ends] == [(77.5, 33.5)]


def test_file_limit_counts_files_with_rows(spark, folder):
    raw = files.read_folder(spark, folder)
    assert cleaned_set(cleaning.clean(raw, Settings(file_limit=1))) == {w for w in WANT if w[0] == 1}
    with pytest.raises(ValueError):
        cleaning.limit_files(raw, 0)


def test_cleaned_table(spark, folder, tmp_path):
    path = str(tmp_path / "cleaned")
    cleaned = cleaning.clean(files.read_folder(spark, folder))
    assert tables.write_cleaned(cleaned, path)
    assert cleaned_set(files.read_table(spark, path)) == WANT
    assert not tables.write_cleaned(cleaned.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    with pytest.raises(ValueError):
        quality.require_columns(cleaned.drop("latitude"))


@pytest.mark.parametrize("limit", [10_000, 1])
def test_replay(spark, folder, limit):
    cleaned = cleaning.clean(files.read_folder(spark, folder))
    cfg = Settings(replay_speed=2.0, max_group_rows=limit)
    got = cleaning.replay_schedule(cleaned, cfg).orderBy("batch_s").collect()
    assert [(r.messages, r.delay_s, r.offset_s) for r in got] == [
        (2, 0.0, 0.0), (1, 5.0, 5.0), (1, 5.0, 10.0), (1, 5.0, 15.0), (1, 1785.0, 1800.0)
    ]
    cfg = Settings(replay_speed=2.0, replay_mode="simulated", max_group_rows=limit)
    got = cleaning.replay_schedule(cleaned, cfg).orderBy("batch_s").collect()
    assert [r.offset_s for r in got] == [0.0, 0.5, 1.0, 1.5, 2.0]
    ordered = [r.timestamp for r in cleaning.in_time_order(cleaned).collect()]
    assert ordered == sorted(ordered)


def test_messages(spark, pings):
    texts = spark.createDataFrame(
        [(1, '{"taxi_id": 5, "timestamp": "2008-02-02 15:00:00", "longitude": 116.5, "sent_at_utc_ms": 7}'),
         (2, '{"taxi_id": 5, "timest'), (3, ""), (4, None), (5, "[]x")], "seq bigint, value string")
    rows, rejects = messages.parse_messages(texts, received_ms=F.lit(9))
    row = rows.collect()
    assert [(r.seq, r.taxi_id, r.longitude, r.latitude, r.received_at_utc_ms) for r in row] == [(1, 5, 116.5, None, 9)]
    assert {r.seq for r in rejects.collect()} == {2, 3, 4, 5}
    processed = process(pings)
    parsed = messages.processed_messages(processed).select(
        "key", messages.parse_json(F.col("value"), PROCESSED_MESSAGE).alias("m"))
    assert parsed.where(F.col("m.taxi_id").cast("string") == F.col("key")).count() == processed.count()


def test_settings():
    for bad in ({"file_limit": 0}, {"bench_max_rows": 0}, {"replay_mode": "x"}, {"replay_speed": 1.2}, {"refresh_interval_s": 11}):
        with pytest.raises(ValueError):
            Settings(**bad)
    cfg = Settings.from_env({"DATA_REPLAY_MODE": "SIMULATED", "SPEED_THRESHOLD_KMPH": "60", "GEOFENCE_RANGE_KM": "20"})
    assert (cfg.replay_mode, cfg.speed_limit_kmph, cfg.range_km) == ("simulated", 60, 20.0)
    with pytest.raises(ValueError):
        cfg.require_topics()
    assert [Settings(inactivity_timeout_s=s).source_idleness_s() for s in (180, 30, 10, 9)] == [170, 25, 5, 0]
