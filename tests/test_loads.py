"""Loads and sinks: CSV staging round trip, full refresh, slice replace."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from playmart import schemas
from playmart.sources import warehouse

D = dt.date


def test_csv_round_trip_keeps_text(spark):
    rows = [
        (1, "trailing space ", 100, 0, "2023-01", "img/1.jpg", "액션 ", 1, 2),
        (2, 'quote "inside"', 0, 0, None, "img/2.jpg", "RPG", 0, 0),
        (3, "carriage\rreturn", -1, 0, "2023-02", "img/3.jpg", "인디 전략", 3, 4),
        (4, "", 5, 5, "2023-03", " lead", "캐주얼", 5, 6),
    ]
    df = spark.createDataFrame(rows, schemas.GAME_INFO)
    path = tempfile.mkdtemp(prefix="run-csv-") + "/stage"
    warehouse.write_csv(df, path, schemas.COLUMNS["game_info"])
    back = {r["game_id"]: r for r in warehouse.read_staged_csv(spark, path, schemas.GAME_INFO).collect()}
    assert back[1]["game_name"] == "trailing space " and back[1]["genre"] == "액션 "
    assert back[2]["game_name"] == 'quote "inside"' and back[2]["release_date"] is None
    assert back[3]["game_name"] == "carriage\rreturn"
    assert back[4]["game_name"] is None  # empty string comes back as NULL
    assert back[4]["thumbnail_path"] == " lead"


def test_csv_read_is_positional(spark):
    path = tempfile.mkdtemp(prefix="run-csv-") + "/stage"
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write("COMMENT_ID,GAME_ID,USER_ID,TOTAL_PLAYTIME,LAST_TWO_WEEKS_PLAYTIME,COMMENT_CONTEXT,LANGUAGE\n")
        f.write("c1,10,u1,100,5,hello world,KOR\n")
    r = warehouse.read_staged_csv(spark, path, schemas.COMMENT_DATA).collect()[0]
    assert r["comment_content"] == "hello world" and r["game_id"] == 10


def test_csv_integers_written_as_floats(spark):
    path = tempfile.mkdtemp(prefix="run-csv-") + "/stage"
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write("game_id,game_name,price,discount_percentage,release_date,thumbnail_path,genre,negative_cnt,positive_cnt\n")
        f.write("570,Game A,12000.0,20.0,2023-06,img/a.jpg,RPG,3,4\n")
        f.write("571,,,,,,,5,6\n")  # coming soon: details missing
    rows = {r["game_id"]: r for r in warehouse.read_staged_csv(spark, path, schemas.GAME_INFO).collect()}
    assert (rows[570]["price"], rows[570]["discount_percentage"], rows[570]["positive_cnt"]) == (12000, 20, 4)
    assert rows[571]["price"] is None and rows[571]["game_name"] is None and rows[571]["negative_cnt"] == 5


def test_csv_line_breaks_and_exact_integers(spark):
    path = tempfile.mkdtemp(prefix="run-csv-") + "/stage"
    rows = [(9007199254740993, "two\nlines", 1, 0, "a\r\nb", "x,\ny", '"q"\n', 0, 0), (2, "\rlead", 1, 0, None, "p", "g\n", 0, 0)]
    warehouse.write_csv(spark.createDataFrame(rows, schemas.GAME_INFO), path, schemas.COLUMNS["game_info"])
    assert sorted(map(tuple, warehouse.read_staged_csv(spark, path, schemas.GAME_INFO).collect())) == sorted(rows)


@pytest.mark.parametrize("line", ["1,only,three", "x,name,1,0,2023-01,p,g,0,0", "1,name,abc,0,2023-01,p,g,0,0"])
def test_malformed_csv_rows_fail(spark, line):
    path = tempfile.mkdtemp(prefix="run-csv-") + "/stage"
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write(",".join(schemas.COLUMNS["game_info"]) + "\n" + line + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|no integer"):
        warehouse.read_staged_csv(spark, path, schemas.GAME_INFO).collect()


def status(spark, rows):
    return spark.createDataFrame(rows, schemas.GAME_STATUS)


def test_replace_slice_is_null_safe_and_idempotent(spark):
    existing = status(spark, [(1, D(2024, 1, 1), 5, 1), (1, D(2024, 1, 2), 6, 1), (2, None, 7, 1)])
    batch = status(spark, [(1, D(2024, 1, 2), 60, 2), (2, D(2024, 1, 2), 70, 2)])
    once = warehouse.replace_slice(existing, batch, "2024-01-02")
    twice = warehouse.replace_slice(once, batch, "2024-01-02")
    expect = [(1, D(2024, 1, 1), 5, 1), (1, D(2024, 1, 2), 60, 2), (2, None, 7, 1), (2, D(2024, 1, 2), 70, 2)]
    key = lambda r: (r[0], str(r[1]))
    assert sorted(map(tuple, once.collect()), key=key) == sorted(expect, key=key)
    assert sorted(map(tuple, twice.collect()), key=key) == sorted(expect, key=key)


def test_write_slice_partition_replace(spark):
    path = tempfile.mkdtemp(prefix="run-slice-") + "/game_status"
    day1 = status(spark, [(1, D(2024, 1, 1), 5, 1), (2, D(2024, 1, 1), 6, 1)])
    day2 = status(spark, [(1, D(2024, 1, 2), 7, 1)])
    warehouse.write_slice(day1, path, "2024-01-01")
    warehouse.write_slice(day2, path, "2024-01-02")
    warehouse.write_slice(day2, path, "2024-01-02")  # re-run of day 2
    day2b = status(spark, [(1, D(2024, 1, 2), 9, 9)])
    warehouse.write_slice(day2b, path, "2024-01-02")  # corrected re-run
    got = sorted(map(tuple, warehouse.read_partitioned(spark, path, schemas.GAME_STATUS).collect()))
    assert got == [(1, D(2024, 1, 1), 5, 1), (1, D(2024, 1, 2), 9, 9), (2, D(2024, 1, 1), 6, 1)]
    # a batch without rows for its day still deletes that day's old slice
    warehouse.write_slice(status(spark, []), path, "2024-01-02")
    got = sorted(map(tuple, warehouse.read_partitioned(spark, path, schemas.GAME_STATUS).collect()))
    assert got == [(1, D(2024, 1, 1), 5, 1), (2, D(2024, 1, 1), 6, 1)]
    # rows dated on another day are appended, NULL dates kept
    warehouse.write_slice(status(spark, [(3, D(2024, 1, 1), 1, 1), (4, None, 2, 2)]), path, "2024-01-02")
    got = warehouse.read_partitioned(spark, path, schemas.GAME_STATUS).collect()
    assert len(got) == 4 and sum(1 for r in got if r["create_dt"] is None) == 1


def test_full_refresh_reads_own_table(spark):
    root = tempfile.mkdtemp(prefix="run-wh-")
    assert warehouse.current_path(spark, "t", root) is None
    with pytest.raises(ValueError, match="has not been loaded"):
        warehouse.read_current(spark, "t", root)
    first = spark.createDataFrame([(1,), (2,)], "game_id BIGINT")
    warehouse.full_refresh(spark, first, "t", root, "v1")
    # the next batch reads the table it replaces
    nxt = warehouse.read_current(spark, "t", root).withColumn("game_id", F.col("game_id") + 10)
    warehouse.full_refresh(spark, nxt, "t", root, "v2")
    assert sorted(r[0] for r in warehouse.read_current(spark, "t", root).collect()) == [11, 12]
    # a refresh that fails leaves the current version
    with pytest.raises(Exception):
        warehouse.full_refresh(spark, first.select(F.raise_error(F.lit("stop")).alias("x")), "t", root, "v3")
    assert sorted(r[0] for r in warehouse.read_current(spark, "t", root).collect()) == [11, 12]
    assert [v for _, v in warehouse.versions(spark, "t", root)] == ["v1", "v2"]


def test_current_version_outlives_the_session(spark):
    """Another process over the same warehouse sees the loaded tables."""
    import subprocess
    import sys

    root = tempfile.mkdtemp(prefix="run-wh-")
    warehouse.full_refresh(spark, spark.createDataFrame([(1,), (2,)], "game_id BIGINT"), "t", root)
    code = (
        "from playmart.session import build_session; from playmart.sources import warehouse\n"
        f"s = build_session(master='local[1]'); print('ROWS', warehouse.read_current(s, 't', {root!r}).count())"
    )
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=here, capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in out.stdout, out.stderr[-2000:]


def test_scratch_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from playmart.session import shared_dir

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=sc))


def test_landing_path_is_dated(spark):
    assert warehouse.landing_path("/x/", "game_info", D(2024, 3, 5)) == "/x/game_info/dt=2024-03-05"
