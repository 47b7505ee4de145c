"""Property tests: the bounded next-day pairs give the same top 15 as all
pairs, and the single-pass genre models equal their union forms, on random
small tables (few examples: each one runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playmart import schemas
from playmart.operators import models

import union_models
from test_models import _brute_top, gi

D = dt.date
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

snapshot = st.tuples(
    st.integers(1, 6),  # game
    st.integers(1, 3),  # day
    st.one_of(st.none(), st.integers(0, 20)),  # user_cnt
    st.integers(0, 20),  # review_cnt
)


@SETTINGS
@given(st.lists(snapshot, min_size=1, max_size=120), st.integers(1, 4))
def test_bounded_pairs_keep_top_k(spark, rows, k):
    status = spark.createDataFrame([(g, D(2024, 1, d), u, r) for g, d, u, r in rows], schemas.GAME_STATUS)
    info = spark.createDataFrame([gi(g) for g in range(1, 7)], schemas.GAME_INFO)
    full = models.next_day_pairs(status, info).collect()
    for metric, diff, desc in (("user_cnt", "user_diff", True), ("user_cnt", "user_diff", False), ("review_cnt", "review_diff", True)):
        pairs = models.next_day_pairs(status, info, metric, k=k)
        got = models.top_k_per_day(pairs, diff, ascending=not desc, k=k).collect()
        got = sorted(((r["start_dt"], r["game_id"], r[diff]) for r in got), key=repr)
        assert got == _brute_top(full, diff, ascending=not desc, k=k)


genre_word = st.sampled_from(["액션", "RPG", "인디", "전략", "스포츠", "대규모멀티플레이어", "캐주얼", "퍼즐"])
genre = st.one_of(st.none(), st.lists(genre_word, max_size=3).map(" ".join))


@SETTINGS
@given(st.lists(st.tuples(genre, st.integers(0, 50), st.integers(0, 50), st.integers(1, 5)), max_size=25))
def test_single_pass_genre_models_equal_union(spark, rows):
    info = spark.createDataFrame(
        [gi(i, g, neg=n, pos=p) for i, (g, n, p, _) in enumerate(rows)], schemas.GAME_INFO
    )
    assert sorted(models.analytics_genre_comment_ratio(info).collect()) == sorted(
        union_models.analytics_genre_comment_ratio_union(info).collect()
    )
    fact = spark.createDataFrame(
        [(i, c, "n", p * c, n, float(p), float(n), g) for i, (g, n, p, c) in enumerate(rows)],
        schemas.FACT_GAME_PLAYTIME,
    )
    for flt in (False, True):
        a = sorted(models.analytics_genre_playtime(fact, filter_first_label=flt).collect())
        b = sorted(union_models.analytics_genre_playtime_union(fact, filter_first_label=flt).collect())
        assert a == b


status_row = st.tuples(
    st.integers(1, 4),
    st.one_of(st.none(), st.integers(1, 3)),
    st.integers(0, 9),
    st.integers(0, 9),
)


def _status(spark, rows):
    return spark.createDataFrame(
        [(g, None if d is None else D(2024, 1, d), u, r) for g, d, u, r in rows], schemas.GAME_STATUS
    )


@SETTINGS
@given(st.lists(status_row, max_size=12), st.lists(status_row, max_size=6), st.integers(1, 3))
def test_slice_replace_pure_and_storage_forms_agree(spark, existing, batch, day):
    import tempfile

    from playmart.sources import warehouse

    as_of = f"2024-01-0{day}"
    pure = warehouse.replace_slice(_status(spark, existing), _status(spark, batch), as_of)
    path = tempfile.mkdtemp(prefix="run-prop-slice-") + "/t"
    _status(spark, existing).write.partitionBy("create_dt").parquet(path)
    staged = tempfile.mkdtemp(prefix="run-prop-batch-") + "/b"
    _status(spark, batch).write.parquet(staged)
    warehouse.write_slice(spark.read.schema(schemas.GAME_STATUS).parquet(staged), path, as_of)
    stored = warehouse.read_partitioned(spark, path, schemas.GAME_STATUS)
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, pure.collect()), key=key) == sorted(map(tuple, stored.collect()), key=key)


page = st.tuples(
    st.integers(1, 4),  # game
    st.sampled_from(["KOR", "ENG"]),
    st.one_of(st.just(None), st.lists(st.integers(0, 30), max_size=4)),  # None = not JSON
)


@SETTINGS
@given(st.lists(page, max_size=10))
def test_review_pages_bad_page_drops_game(spark, pages):
    import json

    from playmart.operators import ingest

    rows = []
    for i, (g, lang, reviews) in enumerate(pages):
        if reviews is None:
            body = "<html>"
        else:
            body = json.dumps(
                {"reviews": [{"recommendationid": str(r), "author": {"steamid": "s"}, "review": "t"} for r in reviews]}
            )
        rows.append((g, lang, i, body))
    df = spark.createDataFrame(rows, "game_id BIGINT, language STRING, page_no BIGINT, body STRING")
    ids = spark.createDataFrame([(g,) for g in range(1, 4)], "game_id BIGINT")  # game 4 is unknown
    got = sorted((r["game_id"], r["language"], r["comment_id"]) for r in ingest.ingest_comment_data(ids, ingest.parse_review_pages(df)).collect())
    bad = {g for g, _, reviews in pages if reviews is None}
    bad |= {g for g in range(1, 5) if {lang for h, lang, _ in pages if h == g} != {"KOR", "ENG"}}
    expect = sorted(
        (g, lang, str(r))
        for g, lang, reviews in pages
        if reviews is not None and g not in bad and g < 4
        for r in reviews
    )
    assert got == expect


price_doc = st.fixed_dictionaries(
    {},
    optional={
        "is_free": st.booleans(),
        "price_overview": st.fixed_dictionaries(
            {},
            optional={
                "final_formatted": st.one_of(
                    st.integers(0, 2_000_000).map(lambda v: f"₩ {v:,}"),
                    st.integers(0, 99_999).map(lambda v: f"₩{v}"),
                ),
                "discount_percent": st.integers(0, 100),
            },
        ),
    },
)


def expected_price(doc):
    """The price rules, stated plainly: free -> (0, 0); a missing free flag,
    price text or discount -> (-1, 0); else the number after the first
    space without thousands separators (NULL if there is none), and the
    discount."""
    if doc.get("is_free") is True:
        return 0, 0
    po = doc.get("price_overview") or {}
    if "is_free" not in doc or "final_formatted" not in po or "discount_percent" not in po:
        return -1, 0
    parts = po["final_formatted"].split(" ")
    price = int(parts[1].replace(",", "")) if len(parts) > 1 else None
    return price, po["discount_percent"]


@SETTINGS
@given(st.lists(price_doc, min_size=1, max_size=15))
def test_price_rules(spark, docs):
    import json

    from playmart.operators import ingest

    rows = []
    for gid, d in enumerate(docs):
        data = {
            "type": "game", "name": "g", "release_date": {"coming_soon": False, "date": ""},
            "capsule_image": "x", "genres": [], **d,
        }
        rows.append((gid, json.dumps({str(gid): {"success": True, "data": data}}, ensure_ascii=False)))
    out = ingest.parse_app_details(spark.createDataFrame(rows, "game_id BIGINT, body STRING")).collect()
    got = {r["game_id"]: (r["price"], r["discount_percentage"]) for r in out}
    assert got == {gid: expected_price(d) for gid, d in enumerate(docs)}


date_text = st.one_of(
    st.tuples(st.integers(1990, 2030), st.integers(1, 12), st.integers(1, 28), st.booleans()).map(
        lambda t: f"{t[0]}년 {t[1]:02d}월 {t[2]:02d}일" if t[3] else f"{t[0]}년 {t[1]}월 {t[2]}일"
    ),
    st.tuples(st.integers(1990, 2030), st.integers(1, 12)).map(lambda t: f"{t[0]}년 {t[1]}월"),
    st.sampled_from(["", "곧 출시", "2023년 13월", "2023", "Q3 2024"]),
)


def expected_month(text):
    """Full date first, then year-month; anything else has no month."""
    import datetime

    for fmt in ("%Y년 %m월 %d일", "%Y년 %m월"):
        try:
            return datetime.datetime.strptime(text, fmt).strftime("%Y-%m")
        except ValueError:
            pass
    return None


@SETTINGS
@given(st.lists(date_text, min_size=1, max_size=15))
def test_release_month_rules(spark, texts):
    from playmart.functions import scalars

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = {r["i"]: r["m"] for r in df.selectExpr("i", scalars.parse_release_month_sql("t") + " AS m").collect()}
    assert got == {i: expected_month(t) for i, t in enumerate(texts)}
