"""Column functions of the ingest, one value at a time."""

import json
import tempfile

from pyspark.sql import functions as F

from playmart.functions import scalars
from playmart.operators import ingest
from playmart.sources import landing


def one(spark, expr_builder, values, ddl="v STRING"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(F.expr(expr_builder("v"))).collect()]


def test_parse_price(spark):
    got = one(spark, scalars.parse_price_sql, ["₩ 12,000", "₩ 900", "₩12,000", "₩ 1,234,567", "", None, "₩ abc"])
    assert got == [12000, 900, None, 1234567, None, None, None]


def test_parse_release_month(spark):
    got = one(
        spark,
        scalars.parse_release_month_sql,
        ["2023년 6월 5일", "2023년 06월 05일", "2022년 11월", "2022년 1월", "", None, "곧 출시", "2023년 13월"],
    )
    assert got == ["2023-06", "2023-06", "2022-11", "2022-01", None, None, None, None]


def test_fold_genres(spark):
    df = spark.createDataFrame(
        [([{"id": "1", "description": "대규모 멀티플레이어"}, {"id": "2", "description": "앞서 해보기"}],), ([],), (None,)],
        "g ARRAY<STRUCT<id: STRING, description: STRING>>",
    )
    assert [r[0] for r in df.selectExpr(scalars.fold_genres_sql("g")).collect()] == ["대규모멀티플레이어 앞서해보기", "", None]


def test_clean_texts(spark):
    assert one(spark, scalars.clean_game_name_sql, ["a, b,c"]) == ["a  b c"]
    assert one(spark, scalars.clean_review_text_sql, ["x\ny,z\r\"q\""]) == ['x y z\r"q"']


def test_integers_are_exact(spark):
    got = one(spark, scalars.integer_sql, ["12", "12.0", "-3", "9007199254740993", "9007199254740993.0", "", "x", None, "1e3"])
    assert got[:5] == [12, 12, -3, 9007199254740993, 9007199254740993] and got[5:8] == [None, None, None]


def test_read_landed_json_lines(spark):
    path = tempfile.mkdtemp(prefix="run-landed-") + "/player_counts.jsonl"
    with open(path, "w") as f:
        for gid, body in [(1, {"response": {"player_count": 7}}), (2, {"response": {}})]:
            f.write(json.dumps({"game_id": gid, "body": json.dumps(body)}) + "\n")
    docs = landing.read_landed(spark, path, fmt="json").select("game_id", "body")
    got = sorted(map(tuple, ingest.parse_player_counts(docs).collect()))
    assert got == [(1, 7), (2, 0)]
    assert docs.filter(F.col("body").isNull()).count() == 0
