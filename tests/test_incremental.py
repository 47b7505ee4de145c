"""Kept state against full rebuilds: manifest, per-game sums, movers, key
index, commit logs, retention, and the resumable run."""

import datetime as dt
import os
import random
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from playmart import schemas
from playmart.operators import game_state, ingest, key_index, models, movers, quality, quarantine
from playmart.plans import pipeline
from playmart.sources import files, landing, manifest, warehouse
from playmart.sources.commits import CommitLog
from playmart.streaming import status_loader

from conftest import SF_SMALL

D = dt.date


def scratch(name):
    return tempfile.mkdtemp(prefix=f"run-{name}-")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- commit log ---------------------------------------------------------------


def test_put_if_absent_and_two_writers(spark):
    folder = scratch("log")
    assert files.put_if_absent(spark, f"{folder}/a", "one") and not files.put_if_absent(spark, f"{folder}/a", "two")
    assert files.read_text(spark, f"{folder}/a") == "one"
    assert [n for n, _ in files.children(spark, folder) if not n.endswith(".crc")] == ["a"]

    log = CommitLog(spark, f"{folder}/log")
    assert log.last() is None
    won = []

    def writer(name):
        for i in range(8):
            won.append((log.append(lambda _last: {"by": f"{name}{i}"})["seq"], f"{name}{i}"))

    threads = [threading.Thread(target=writer, args=(n,)) for n in "xyz"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    entries = log.entries()
    assert [e["seq"] for e in entries] == list(range(1, 25))  # distinct numbers, none lost
    assert sorted((e["seq"], e["by"]) for e in entries) == sorted(won)


def test_loser_builds_on_the_winner(spark):
    log = CommitLog(spark, f"{scratch('log')}/log")
    other = CommitLog(spark, log.folder)
    seen = []

    def build(last):
        seen.append(last and last["by"])
        if len(seen) == 1:  # another writer is faster
            other.append(lambda _last: {"by": "winner"})
        return {"by": "loser"}

    assert log.append(build)["seq"] == 2
    assert seen == [None, "winner"]


def test_two_refreshes_at_once(spark):
    root = scratch("wh")
    batches = {v: spark.createDataFrame([(i,)], "game_id BIGINT") for i, v in enumerate(["v1", "v2", "v3"])}
    threads = [threading.Thread(target=warehouse.full_refresh, args=(spark, b, "t", root, v)) for v, b in batches.items()]
    [t.start() for t in threads]
    [t.join() for t in threads]
    found = warehouse.versions(spark, "t", root)
    assert [s for s, _ in found] == [1, 2, 3] and sorted(v for _, v in found) == ["v1", "v2", "v3"]
    current = {"v1": 0, "v2": 1, "v3": 2}[found[-1][1]]
    assert rows_of(warehouse.read_current(spark, "t", root)) == [(current,)]


def test_expired_versions_go_and_leased_ones_stay(spark):
    root = scratch("wh")
    for i in range(4):
        warehouse.full_refresh(spark, spark.createDataFrame([(i,)], "game_id BIGINT"), "t", root, f"v{i}")
        if i == 0:
            lease = warehouse.reading(spark, "t", root)
            held = lease.__enter__()
    os.makedirs(f"{root}/t/version=running")  # a refresh under way: not in the log yet
    assert warehouse.expire(spark, "t", root, keep=2) == ["v1"]
    assert rows_of(held) == [(0,)]  # the reader that started before keeps its files
    assert rows_of(warehouse.read_current(spark, "t", root)) == [(3,)]
    lease.__exit__(None, None, None)
    assert warehouse.expire(spark, "t", root, keep=2) == ["v0"]
    assert [v for _, v in warehouse.versions(spark, "t", root)] == ["v2", "v3"]
    assert os.path.isdir(f"{root}/t/version=running")
    # a lease, and a folder without entry, run out
    with warehouse.reading(spark, "t", root):
        for i in (4, 5):
            warehouse.full_refresh(spark, spark.createDataFrame([(i,)], "game_id BIGINT"), "t", root, f"v{i}")
        later = __import__("time").time() + 2 * warehouse.LEASE_SECONDS
        assert sorted(warehouse.expire(spark, "t", root, keep=1, now=later)) == ["running", "v2", "v3", "v4"]
    assert rows_of(warehouse.read_current(spark, "t", root)) == [(5,)]


# -- manifest -----------------------------------------------------------------


def staged_batch(spark, folder):
    staged = spark.read.schema(schemas.GAME_STATUS).option("recursiveFileLookup", "true").parquet(folder)
    return manifest.with_file_columns(staged)


def test_manifest_opens_only_the_files_of_the_days(spark):
    folder, noted, table = scratch("staged"), scratch("manifest") + "/m", scratch("status") + "/t"

    def stage(name, rows):
        spark.createDataFrame(rows, schemas.GAME_STATUS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")

    history = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    for i, day in enumerate(history):
        stage(f"dt={day} a", [(1, day, i, 1)])  # a name that has to be encoded
    stage("late", [(2, history[3], 7, 7), (2, history[4], 8, 8), (3, None, 9, 9)])
    days = status_loader.replace_days(staged_batch(spark, folder), 0, noted, table)
    assert sorted(map(str, days)) == sorted([*map(str, history), "None"])
    every = rows_of(warehouse.read_partitioned(spark, table, schemas.GAME_STATUS))
    assert len(every) == 9

    found = status_loader.slices_of(spark, noted, [history[3]])
    opened = {os.path.basename(os.path.dirname(p.replace("%20", " "))) for p in found.inputFiles()}
    assert opened == {f"dt={history[3]} a", "late"}
    assert rows_of(found) == [(1, history[3], 3, 1), (2, history[3], 7, 7)]
    assert rows_of(status_loader.slices_of(spark, noted, [None])) == [(3, None, 9, 9)]
    assert status_loader.slices_of(spark, noted, [D(1999, 1, 1)]) is None

    # a corrected slice replaces its files; a replayed micro-batch changes nothing
    stage(f"dt={history[3]} a", [(1, history[3], 50, 1)])
    batch = staged_batch(spark, f"{folder}/dt={history[3]} a")
    for _ in range(2):
        status_loader.replace_days(batch, 1, noted, table)
        got = rows_of(warehouse.read_partitioned(spark, table, schemas.GAME_STATUS))
        assert got == sorted([*(r for r in every if r != (1, history[3], 3, 1)), (1, history[3], 50, 1)], key=repr)
    assert manifest.entries(spark, noted, [history[3]]).count() == 3  # the old file, the new one, the late one
    assert manifest.record(staged_batch(spark, folder).limit(0), noted, "create_dt", 2) == []


# -- per-game state -----------------------------------------------------------


def random_comments(rng, n, games=6):
    value = lambda: rng.choice([None, rng.randrange(1000)])
    return [(f"c{rng.random()}", rng.choice([None, *range(games)]), "u", value(), value(), "x", "KOR") for _ in range(n)]


def random_status(rng, n, day, games=6):
    return [(rng.randrange(games), day, rng.choice([None, rng.randrange(99)]), rng.choice([None, rng.randrange(9)])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_state_equals_rebuild_on_random_histories(spark, seed):
    rng = random.Random(seed)
    comments = game_state.comment_state(spark, scratch("state") + "/comments")
    status = game_state.status_state(spark, scratch("state") + "/status")
    months = ["2023-01", "2023-02", "bad", None]
    info = spark.createDataFrame(
        [(g, f"g{g}", 100, 0, rng.choice(months), "p", "RPG", g, 2 * g) for g in range(7)], schemas.GAME_INFO
    )
    held_c: dict = {}
    held_s: dict = {}

    def check():
        c = spark.createDataFrame([r for part in held_c.values() for r in part], schemas.COMMENT_DATA)
        s = spark.createDataFrame([r for part in held_s.values() for r in part], schemas.GAME_STATUS)
        fact = models.playtime_fact(game_state.playtime_from(comments.totals()), info)
        assert rows_of(fact.select(*schemas.FACT_GAME_PLAYTIME.fieldNames())) == rows_of(models.fact_game_playtime(c, info))
        months = models.release_months(
            info, game_state.comment_means(comments.totals()), game_state.status_means(status.totals())
        )
        assert rows_of(months) == rows_of(models.analytics_release_date(info, c, s))

    assert rows_of(comments.totals()) == []
    # the history in one load, also rows without a day
    first = {D(2024, 1, d): random_status(rng, 8, D(2024, 1, d)) for d in (1, 2, 3)} | {None: [(1, None, 5, 5)]}
    status.load(spark.createDataFrame([r for p in first.values() for r in p], schemas.GAME_STATUS), "create_dt")
    assert set(status.slices()) == {"2024-01-01", "2024-01-02", "2024-01-03", "null"}
    held_s |= first
    # then days, new, replaced, emptied
    for step in range(5):
        day = D(2024, 1, rng.choice([2, 3, 4]))
        held_c[day] = random_comments(rng, rng.choice([0, 5, 20]))
        comments.replace(day, spark.createDataFrame(held_c[day], schemas.COMMENT_DATA))
        held_s[day] = random_status(rng, rng.choice([0, 6]), day)
        status.replace(day, spark.createDataFrame(held_s[day], schemas.GAME_STATUS))
        if step in (2, 4):
            check()


def test_state_reads_a_day_and_the_state_only(spark):
    state = game_state.status_state(spark, scratch("state") + "/s")
    for d in (1, 2, 3):
        state.replace(D(2024, 1, d), spark.createDataFrame([(1, D(2024, 1, d), d, 1)], schemas.GAME_STATUS))
    read = []
    inner = state._read
    state._read = lambda paths: read.extend(paths) or inner(paths)
    before = state.entry()
    state.replace(D(2024, 1, 2), spark.createDataFrame([(1, D(2024, 1, 2), 20, 1)], schemas.GAME_STATUS))
    after = state.entry()
    assert read == [before["slices"]["2024-01-02"], before["totals"], after["slices"]["2024-01-02"]]
    assert rows_of(state.totals()) == [(1, 3, 24, 3, 3, 3)]


def test_state_writers_at_once(spark):
    folder = scratch("state") + "/s"

    def add(day):
        rows = spark.createDataFrame([(1, D(2024, 1, day), 10**day, 1)], schemas.GAME_STATUS)
        game_state.status_state(spark, folder).replace(D(2024, 1, day), rows)

    threads = [threading.Thread(target=add, args=(d,)) for d in (1, 2, 3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert rows_of(game_state.status_state(spark, folder).totals()) == [(1, 3, 1110, 3, 3, 3)]


# -- movers -------------------------------------------------------------------


def partition_files(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    }


def test_maintained_movers(spark):
    rng = random.Random(4)
    days = [D(2024, 1, d) for d in range(1, 9)]
    games = range(30)
    info = spark.createDataFrame([(g, f"g{g}", g, 0, "2023-01", "p", "RPG", 1, 1) for g in games], schemas.GAME_INFO)
    path, folder = scratch("status") + "/t", scratch("movers")

    def snapshots(day, n=40):
        return [(rng.randrange(32), day, rng.choice([None, rng.randrange(50)]), rng.randrange(50)) for _ in range(n)]

    def stored():
        return warehouse.read_partitioned(spark, path, schemas.GAME_STATUS)

    def check(catalogue):
        for name, (model, _, _) in movers.MODELS.items():
            got = movers.read(spark, name, folder, catalogue)
            expected = model(stored(), catalogue)
            assert got.columns == expected.columns
            assert list(map(tuple, got.collect())) == list(map(tuple, expected.collect()))

    start = [r for d in days if d != days[4] for r in snapshots(d)] + [(1, None, 1, 1)]
    warehouse.write_days(spark.createDataFrame(start, schemas.GAME_STATUS), path)
    movers.rebuild(stored(), info, folder)
    check(info)
    # day 3 is replaced, then the gap of day 5 is filled, then day 8 is emptied
    for day, rows in [(days[2], snapshots(days[2])), (days[4], snapshots(days[4])), (days[7], [])]:
        before = partition_files(folder)
        warehouse.write_slice(spark.createDataFrame(rows, schemas.GAME_STATUS), path, day)
        starts = movers.refresh(stored(), info, folder, [day])
        assert starts == [day - dt.timedelta(days=1), day]
        after = partition_files(folder)
        changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
        assert changed and all(any(f"start_dt={s}" in p for s in starts) for p in changed)
        check(info)
    # a price changes nothing stored; a game that leaves changes its days
    cheaper = info.withColumn("price", F.lit(7))
    check(cheaper)
    smaller = info.filter("game_id <> 3")
    movers.refresh_games(stored(), smaller, spark.createDataFrame([(3,)], "game_id BIGINT"), folder)
    check(smaller)
    assert movers.refresh(stored(), info, folder, [None]) == []


def test_refresh_reads_the_neighbouring_days(spark):
    path = scratch("status") + "/t"
    rows = [(1, D(2024, 1, d), d, d) for d in range(1, 11)]
    warehouse.write_days(spark.createDataFrame(rows, schemas.GAME_STATUS), path)
    needed = warehouse.read_partitioned(spark, path, schemas.GAME_STATUS).filter(
        warehouse.on_days("create_dt", [D(2024, 1, 4), D(2024, 1, 5), D(2024, 1, 6)])
    )
    assert len(rows_of(needed)) == 3
    plan = needed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "create_dt" in plan.split("PartitionFilters: [")[1].split("]")[0]


# -- key index ----------------------------------------------------------------


def test_key_index_against_the_unique_test(spark):
    rng = random.Random(5)
    index = key_index.KeyIndex(spark, scratch("keys") + "/k", buckets=4)
    every: list = []
    assert index.all_failures("comment_id").count() == 0
    for n in (50, 5, 0, 80):
        batch = [(rng.choice([None, f"c{rng.randrange(200)}"]),) for _ in range(n)]
        new = spark.createDataFrame(batch, "comment_id STRING")
        whole = spark.createDataFrame(every + batch, "comment_id STRING")
        expected = quality.unique_failures(whole, "comment_id")
        in_batch = expected.join(new.distinct(), "comment_id", "left_semi")
        assert rows_of(index.failures(new, "comment_id")) == rows_of(in_batch)
        index.add(new, "comment_id")
        every += batch
        assert rows_of(index.all_failures("comment_id")) == rows_of(expected)
    # another session's handle over the same files
    assert rows_of(key_index.KeyIndex(spark.newSession(), index.location, buckets=4).all_failures("comment_id")) == rows_of(expected)


def test_key_index_does_not_move_the_stored_keys(spark):
    index = key_index.KeyIndex(spark, scratch("keys") + "/k", buckets=16)
    index.add(spark.range(1000).selectExpr("CAST(id AS STRING) AS k"), "k")
    assert index.all_failures("k")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = index.failures(spark.range(10).selectExpr("CAST(id AS STRING) AS k"), "k")
        plan = found._jdf.queryExecution().executedPlan().toString()
        # both exchanges are the batch's: its counts, and the deal to the buckets
        assert plan.count("Exchange hashpartitioning") == 2
        stored = plan[plan.index("Bucketed: true") - 2000 :]
        assert "Exchange" not in stored.split("FileScan")[0].rsplit("SortMergeJoin", 1)[-1].rsplit("Sort [key", 1)[-1]
        assert found.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


# -- write, test, publish -----------------------------------------------------


def land_day(spark, folder, day):
    pipeline.write_landed(landing.landed_from_driver(spark, SF_SMALL), folder, day)


def test_run_is_published_together_and_resumed(spark, monkeypatch):
    landed, root = scratch("landing"), scratch("wh")
    for day in ("2024-01-14", "2024-01-15"):
        land_day(spark, landed, day)
    pipeline.run_pipeline(spark, landed, root, "2024-01-14")
    wh = pipeline.Warehouse(spark, root)
    old = wh.published()

    # the run dies after two analytics tables: nothing of it is visible
    write = pipeline.Warehouse.write
    written = []

    def dying(self, table, df, run_id):
        written.append(table)
        if table == "analytics_release_date":
            raise RuntimeError("lost")
        return write(self, table, df, run_id)

    monkeypatch.setattr(pipeline.Warehouse, "write", dying)
    with pytest.raises(RuntimeError, match="lost"):
        pipeline.run_pipeline(spark, landed, root, "2024-01-15")
    assert wh.published() == old
    assert {str(r[0]) for r in wh.status().select("create_dt").distinct().collect()} == {"2024-01-14"}

    # taken up again: no finished stage runs twice
    first, written[:] = list(written), []
    monkeypatch.setattr(pipeline.Warehouse, "write", lambda *a: (written.append(a[1]), write(*a))[1])
    monkeypatch.setattr(quality, "gate", lambda *a: pytest.fail("the tests have passed before"))
    result = pipeline.run_pipeline(spark, landed, root, "2024-01-15")
    assert first[-1] == written[0] == "analytics_release_date"
    assert not set(first[:-1]) & set(written)
    new = wh.published()
    assert new["seq"] == old["seq"] + 1 and set(new["tables"]) == set(old["tables"])
    assert all(new["tables"][t] != old["tables"][t] for t in old["tables"])
    assert {str(r[0]) for r in wh.status().select("create_dt").distinct().collect()} == {"2024-01-14", "2024-01-15"}
    assert result.tables["game_status"].endswith("game_status")


def test_failed_tests_leave_every_table(spark, monkeypatch):
    landed, root = scratch("landing"), scratch("wh")
    land_day(spark, landed, "2024-01-14")
    pipeline.run_pipeline(spark, landed, root, "2024-01-14")
    wh = pipeline.Warehouse(spark, root)
    old, status = wh.published(), rows_of(wh.status())

    def failing(tables):
        raise quality.DataQualityError("made to fail")

    monkeypatch.setattr(quality, "gate", failing)
    with pytest.raises(quality.DataQualityError):
        pipeline.run_pipeline(spark, landed, root, "2024-01-14")
    assert wh.published() == old and rows_of(wh.status()) == status
    monkeypatch.undo()
    # the rejected run is closed: the next one starts from its first stage
    pipeline.run_pipeline(spark, landed, root, "2024-01-14")
    assert wh.published()["tables"]["game_info"] != old["tables"]["game_info"]
    assert rows_of(wh.status()) == status


def test_slice_with_other_days_is_one_commit(spark):
    wh = pipeline.Warehouse(spark, scratch("wh"))
    one, two = D(2024, 1, 1), D(2024, 1, 2)

    def load(rows, day):
        wh.publish({}, wh.write_slice(spark.createDataFrame(rows, schemas.GAME_STATUS), day, f"r{len(rows)}-{day}-{random.random()}"))

    load([(1, one, 1, 1)], "2024-01-01")
    load([(1, two, 2, 2)], "2024-01-02")
    # no row of the day: its slice goes and the others' rows come, at once
    load([(2, one, 3, 3), (3, None, 4, 4)], "2024-01-02")
    assert rows_of(wh.status()) == [(1, one, 1, 1), (2, one, 3, 3), (3, None, 4, 4)]
    load([], "2024-01-01")
    assert rows_of(wh.status()) == [(3, None, 4, 4)]


# -- quarantine ---------------------------------------------------------------


def test_quarantine_equals_the_report_and_replays(spark):
    import json

    landed = {name: landing.landed(spark, SF_SMALL, name) for name in ("app_details", "player_counts", "review_pages")}
    pages = ingest.parse_review_pages(landed["review_pages"])
    path = scratch("quarantine") + "/q"
    found = quarantine.write(landed["app_details"], landed["player_counts"], pages, path)
    report = ingest.ingest_report(landed["app_details"], landed["player_counts"], pages)
    assert found == {f"{r.source}.{r.metric}": r.value for r in report.collect()}
    kept = quarantine.read(spark, path)
    counts = {f"{r.source}.{r.rule}": r["count"] for r in kept.groupBy("source", "rule").count().collect()}
    assert counts == {k: v for k, v in found.items() if v and k.split(".")[1] not in ("documents", "coming_soon", "games")}
    # bodies are kept as they came
    bodies = {(r.game_id, r.body) for r in landed["app_details"].collect()}
    assert {(r.game_id, r.body) for r in kept.filter("source = 'app_details'").collect()} <= bodies

    # one document is repaired, one repaired badly, one was never quarantined
    bad = [r.game_id for r in kept.filter("source = 'app_details' AND rule = 'not_json'").orderBy("game_id").limit(2).collect()]
    data = {"type": "game", "name": "Repaired", "is_free": True, "release_date": {"coming_soon": False, "date": ""}, "genres": []}
    good = json.dumps({str(bad[0]): {"success": True, "data": data}})
    unknown = json.dumps({"999999": {"success": True, "data": data}})
    repaired = spark.createDataFrame([(bad[0], good), (bad[1], "{'still': 'bad'}"), (999999, unknown)], "game_id BIGINT, body STRING")
    rows, stays = quarantine.replay(kept, repaired, "app_details")
    assert [(r.game_id, r.game_name, r.price, r.genre) for r in rows.collect()] == [(bad[0], "Repaired", 0, "")]
    assert stays.count() == kept.count() - 1
    assert stays.filter(F.col("game_id") == bad[0]).filter("source = 'app_details'").count() == 0
    assert [r.body for r in stays.filter((F.col("game_id") == bad[1]) & (F.col("source") == "app_details")).collect()] == ["{'still': 'bad'}"]
    counts, _ = quarantine.replay(
        kept,
        spark.createDataFrame([(r.game_id, '{"response":{"player_count":9}}') for r in kept.filter("rule = 'no_count'").limit(1).collect()], "game_id BIGINT, body STRING"),
        "player_counts",
    )
    assert [r.player_count for r in counts.collect()] == [9]


# -- game-aligned storage -----------------------------------------------------


def test_aligned_tables_need_no_shuffle(spark):
    from playmart.sources import aligned, driver

    stored = aligned.AlignedTables(spark, scratch("aligned"), buckets=4)
    with pytest.raises(ValueError, match="has not been written"):
        stored.read("game_info")
    raw = driver.raw_tables(spark, SF_SMALL)
    for name, rows in raw.items():
        stored.write(name, rows.limit(3))
        stored.write(name, rows)  # a new version
    with pytest.raises(ValueError, match="4 buckets"):
        aligned.AlignedTables(spark, stored.folder, buckets=8).read("game_info")
    tables = stored.tables()
    assert all(rows_of(tables[n]) == rows_of(raw[n]) for n in raw)

    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        info, comments, status = (tables[n] for n in ("game_info", "comment_data", "game_status"))
        fact = models.fact_game_playtime(comments, info)
        months = models.analytics_release_date(info, comments, status)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (fact, months)]
        assert plans[0].count("Exchange") == 0 and plans[0].count("SortMergeJoin") == 1
        # the month has to be dealt out; nothing before it is
        assert plans[1].count("Exchange") == 1 and "Exchange hashpartitioning(_groupingexpression" in plans[1]
        assert plans[1].count("SortMergeJoin") == 2
        plain = models.fact_game_playtime(raw["comment_data"], raw["game_info"])
        assert rows_of(fact) == rows_of(plain)
        assert rows_of(months) == rows_of(models.analytics_release_date(**raw))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    # another session names the same files
    other = aligned.AlignedTables(spark.newSession(), stored.folder, buckets=4)
    assert rows_of(other.read("game_info")) == rows_of(raw["game_info"])
