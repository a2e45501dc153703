import gzip
import io
import zipfile

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickwise.sources import archives, channels, datasets, manifest
from tickwise.workload import sources

STEP = 8_333_333
START = 1_600_000_000_000_000_000


@pytest.fixture()
def site_files(tmp_path):
    lines = [f"{START + i * STEP},{1 + i / 1000}" for i in range(40) if not 20 <= i < 25]
    (tmp_path / "level.csv").write_text("\n".join(lines))
    with gzip.open(tmp_path / "state.csv.gz", "wt") as f:
        f.write(f"{START},0.0\n{START + STEP},inf\n{START + 99 * STEP},4.0\n{START},7.0\n")
    return {"level": str(tmp_path / "level.csv"), "state": str(tmp_path / "state.csv.gz")}


def test_channel_files_merge_by_outer_join(spark, site_files):
    samples = channels.scan_channels(spark, site_files).withColumn("site", F.lit("x"))
    merged = rows(channels.merge_channels(samples, ["site"], ["level", "state"]), "ts_ns")
    assert len(merged) == 36
    assert (merged[0]["level"], merged[0]["state"]) == (1.0, 0.0)  # of two samples at one time, the first
    assert merged[1]["state"] is None  # infinity is a missing value
    assert (merged[-1]["level"], merged[-1]["state"]) == (None, 4.0)


def test_seq_follows_the_file_when_it_is_split(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("".join(f"{i},{i}.5\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        scan = channels.scan_channel(spark, str(path), "c")
        assert scan.rdd.getNumPartitions() > 3
        assert [r["ts_ns"] for r in scan.orderBy("seq").collect()] == list(range(20_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_staged_channels_read_back(spark, site_files, tmp_path):
    samples = channels.scan_channels(spark, site_files)
    channels.stage_channels(samples, str(tmp_path / "staged"))
    back = spark.read.parquet(str(tmp_path / "staged"))
    assert back.where("channel = 'level'").count() == 35


def test_named_data_sets(spark, site_files):
    registry = {
        "here": datasets.Dataset("a site", {"level": site_files["level"]}, "level"),
        "gone": datasets.Dataset("nothing", {"level": "/nowhere/x.csv"}, "level")}
    listed = {r["key"]: r["available"] for r in datasets.list_datasets(spark, registry).collect()}
    assert listed == {"here": True, "gone": False}
    loaded = datasets.load_dataset(spark, registry, "here")
    assert {r["status"] for r in loaded.collect()} == {0.0}
    with pytest.raises(KeyError):
        datasets.load_dataset(spark, registry, "other")


def pack(*members, inner_name="data.zip"):
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        for i, text in enumerate(members):
            z.writestr(f"part{i}.csv", text)
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("about.csv", "x\n")
        if inner_name:
            z.writestr(inner_name, inner.getvalue())
    return outer.getvalue()


WIDE = "Time,P001_f,P010_f,P010_status,note\n0.0,60.0,59.0,0,1\n0.033,inf,59.1,0,1\n0.067,60.2,,0,1\n"


def test_archives_to_long_rows(spark, tmp_path):
    (tmp_path / "5711_x.zip").write_bytes(pack(WIDE))
    (tmp_path / "5712.zip").write_bytes(pack(WIDE.replace("60.2", "-inf")))
    got = archives.scan_archives(spark, str(tmp_path))
    assert {(r["sigid"], r["pmu"], r["suffix"]) for r in got.collect()} == {
        (s, p, x) for s in (5711, 5712) for p, x in (("P001", "_f"), ("P010", "_f"), ("P010", "_status"))}
    one = rows(got.where("sigid = 5712 and pmu = 'P001'"), "ts_ns")
    assert [r["value"] for r in one] == [60.0, None, None]
    assert [r["ts_ns"] - archives.ANCHOR_NS for r in one] == [0, 33_000_000, 67_000_000]


def test_members_are_joined_on_time(spark):
    content = pack("Time,P001_f\n0.0,1.0\n1.0,2.0\n", "Time,P002_f\n1.0,3.0\n2.0,4.0\n")
    df = spark.createDataFrame([("a", bytearray(content))], "path string, content binary")
    got = archives.split_names(archives.parse_archives(df))
    assert [(r["pmu"], r["value"]) for r in rows(got, "pmu", "ts_ns")] == [
        ("P001", 1.0), ("P001", 2.0), ("P001", None), ("P002", None), ("P002", 3.0), ("P002", 4.0)]


def test_bad_archives_are_reported(spark):
    data = [("no inner", bytearray(pack(inner_name=None))), ("no csv", bytearray(pack())), ("junk", bytearray(b"zzz")),
            ("good", bytearray(pack(WIDE)))]
    df = spark.createDataFrame(data, "path string, content binary")
    readings = archives.parse_archives(df, strict=False)
    assert {r["path"] for r in archives.unreadable_archives(readings).collect()} == {"no inner", "no csv", "junk"}
    assert archives.split_names(readings).count() == 9
    with pytest.raises(Exception, match="no inner zip"):
        archives.parse_archives(df.where("path = 'no inner'")).collect()


def test_a_folder_with_a_bad_archive(spark, tmp_path):
    (tmp_path / "5711.zip").write_bytes(pack(WIDE))
    (tmp_path / "5712.zip").write_bytes(b"zzz")
    with pytest.raises(Exception, match="5712.zip"):
        archives.scan_archives(spark, str(tmp_path)).collect()
    got = archives.scan_archives(spark, str(tmp_path), strict=False)
    assert [r["sigid"] for r in got.where("error is not null").collect()] == [5712]
    assert got.where("error is null").count() == 9


def test_wide_names(spark):
    wide = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], "id int, P010_f double, P2_vp_a double, other double")
    assert {(r["pmu"], r["suffix"], r["value"]) for r in archives.unpivot_channels(wide, ["id"]).collect()} == {
        ("P010", "_f", 1.0), ("P2", "_vp_a", 2.0)}


def test_channel_selection(spark):
    readings = spark.createDataFrame(
        [(s, "P001", x, 1.0) for s in (1, 2) for x in ("_f", "_vp_a", "_status")],
        "sigid long, pmu string, suffix string, value double")
    tags = spark.createDataFrame([(1, ["_f", "_ip_a"]), (2, [])], "sigid long, tags array<string>")
    got = {(r["sigid"], r["suffix"]) for r in archives.select_channels(readings, tags).collect()}
    assert got == {(1, "_f"), (2, "_f"), (2, "_vp_a")}


def test_manifest_cohorts(spark):
    table = manifest.manifest(spark)
    sizes = {r["cohort"]: r["count"] for r in table.groupBy("cohort").count().collect()}
    assert sizes == {"timing": 14, "negative": 15, "baseline": 20}
    assert manifest.overlapping_cohorts(table).count() == 0
    pool = spark.range(5711, 5834).withColumnRenamed("id", "sigid")
    sample = manifest.holdout_sample(pool, table, 20)
    assert sample.count() == 20 and sample.join(table, "sigid").count() == 0
    assert sample.collect() == manifest.holdout_sample(pool.repartition(9), table, 20).collect()


def test_many_small_archives_go_out_in_few_batches():
    piece = pd.DataFrame({"Time": [0.0, 0.5], "P001_f ": [1.0, None], "P001_note": ["x", "2"]})
    pieces = [archives._long(f"{k}.zip", "data.csv", piece) for k in range(20_000)]
    made = list(archives._gathered(iter(pieces)))
    assert len(made) == 4 and sum(b.num_rows for b in made) == 80_000
    assert [list(r.values()) for r in made[0].slice(0, 4).to_pylist()] == [
        ["0.zip", "data.csv", "P001_f", 0, 0.0, 1.0, None], ["0.zip", "data.csv", "P001_f", 1, 0.5, None, None],
        ["0.zip", "data.csv", "P001_note", 0, 0.0, None, None], ["0.zip", "data.csv", "P001_note", 1, 0.5, 2.0, None]]


def test_archives_are_packed_across_batches():
    rows = pa.table({"user_id": [None, 1, 1, 1, 1, 2], "_part": [0, 0, 0, 0, 1, 0], "ts_ns": [5, 30, 10, 20, 7, 9],
                     "value": [1.0, 2.0, 3.0, 4.0, None, 6.0], "channel": ["view", "click", "error", "view", "view", "odd"],
                     "_odd": [False, False, False, True, False, False]})
    for size in (1, 2, 4, 6):
        made = [r for b in sources._pack(iter(rows.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert [r["path"] for r in made] == ["nan/0.zip", "1/0.zip", "1/1.zip", "2/0.zip"]
        found = [(name, list(map(str, row.dropna()))) for name, piece in archives._walk(made[1]["content"]) for _, row in piece.iterrows()]
        assert found == [("data0.csv", ["1e-08", "inf"]), ("data0.csv", ["2e-08", "2.0"]), ("data1.csv", ["0.0", "3.0"])]
        assert all(piece.empty for _, piece in archives._walk(made[3]["content"]))
