"""The ten-branch UNION ALL forms of the genre models, one scan per label;
the tests compare the single-pass forms with them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart import schemas
from playmart.operators.models import _contains, _playtime_labels


def _ratio(a, b):
    return F.try_divide(a.cast("double"), b.cast("double"))


def analytics_genre_comment_ratio_union(game_info: DataFrame, labels=None) -> DataFrame:
    """The ten-branch UNION ALL form; same rows, one scan per label."""
    labels = labels or schemas.REVIEW_GENRE_LABELS
    gi = game_info.select("genre", "negative_cnt", "positive_cnt")
    out = None
    for label, match in labels:
        branch = gi.filter(_contains(match)).agg(
            F.lit(label).alias("genre"),
            F.sum("positive_cnt").alias("total_positive_cnt"),
            F.sum("negative_cnt").alias("total_negative_cnt"),
            F.count(F.lit(1)).alias("game_cnt"),
        )
        out = branch if out is None else out.unionByName(branch)
    return out


def analytics_genre_playtime_union(fact: DataFrame, labels=None, filter_first_label: bool = False) -> DataFrame:
    """The ten-branch UNION ALL form grouped by the constant label."""
    labels = _playtime_labels(labels, filter_first_label)
    f = fact.select("genre", "count_game_id", "sum_total_playtime", "sum_last_two_weeks_playtime")
    out = None
    for label, match in labels:
        src = f if match is None else f.filter(_contains(match))
        branch = (
            src.withColumn("gen", F.lit(label))
            .groupBy("gen")
            .agg(
                _ratio(F.sum("sum_total_playtime"), F.sum("count_game_id")).alias("sum_total_playtime"),
                _ratio(F.sum("sum_last_two_weeks_playtime"), F.sum("count_game_id")).alias("sum_last_two_weeks_playtime"),
            )
        )
        out = branch if out is None else out.unionByName(branch)
    return out
