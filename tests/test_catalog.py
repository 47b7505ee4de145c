"""Models reachable by name through Spark SQL."""

from playmart.plans import catalog
from playmart.sources import driver

from conftest import SF_SMALL


def test_register_views_and_query_by_name(spark):
    names = catalog.register_views(spark, driver.raw_tables(spark, SF_SMALL), prefix="v_")
    assert "v_daily_user_login_cnt_diff_top15" in names
    assert spark.sql("SELECT count(*) FROM v_analytics_genre_comment_ratio").first()[0] == 10
    top = spark.sql(
        "SELECT gen FROM v_analytics_genre_playtime WHERE gen = 'MULTI'"
    ).collect()
    assert len(top) == 1
    # a dashboard-style read: top games by total playtime
    rows = spark.sql(
        "SELECT game_id FROM v_fact_game_playtime ORDER BY sum_total_playtime DESC, game_id LIMIT 3"
    ).collect()
    assert len(rows) == 3
    assert spark.sql("SELECT sum(failures) FROM v_dq_test_results").first()[0] == 0
