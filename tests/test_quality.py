"""Data-quality tests and the gate: passing and failing cases."""

import pytest

from playmart import schemas
from playmart.operators import quality


def tables(spark, info, status, comments):
    return {
        "game_info": spark.createDataFrame(info, schemas.GAME_INFO),
        "game_status": spark.createDataFrame(status, "game_id BIGINT, create_dt DATE, user_cnt BIGINT, review_cnt BIGINT"),
        "comment_data": spark.createDataFrame(
            comments,
            "comment_id STRING, game_id BIGINT, user_id STRING, total_playtime BIGINT, "
            "last_two_weeks_playtime BIGINT, comment_content STRING, language STRING",
        ),
    }


INFO_OK = [(1, "a", 1, 0, None, None, None, 0, 0), (2, "b", 1, 0, None, None, None, 0, 0)]
STATUS_OK = [(1, None, 1, 1)]
COMMENTS_OK = [("c1", 1, "u", 1, 1, "x", "KOR"), ("c1", 1, "u", 1, 1, "x", "ENG")]  # repeated id is allowed


def test_gate_passes(spark):
    counts = quality.gate(tables(spark, INFO_OK, STATUS_OK, COMMENTS_OK))
    assert set(counts) == {t.name for t in quality.SOURCE_TESTS}
    assert all(v == 0 for v in counts.values())


def test_unique_failures_ignore_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "game_id BIGINT")
    rows = quality.unique_failures(df, "game_id").collect()
    assert [(r["game_id"], r["n_records"]) for r in rows] == [(1, 2)]


def test_gate_fails_on_duplicate_and_null_ids(spark):
    bad_info = INFO_OK + [(2, "dup", 1, 0, None, None, None, 0, 0)]
    bad_status = STATUS_OK + [(None, None, 1, 1)]
    bad_comments = COMMENTS_OK + [(None, 1, "u", 1, 1, "x", "KOR")]
    t = tables(spark, bad_info, bad_status, bad_comments)
    res = {r["test_name"]: r["failures"] for r in quality.test_results(t).collect()}
    assert res == {
        "unique_src_game_info_game_id": 1,
        "not_null_src_game_info_game_id": 0,
        "not_null_src_game_status_game_id": 1,
        "not_null_src_comment_data_comment_id": 1,
    }
    with pytest.raises(quality.DataQualityError):
        quality.gate(t)
