"""Reading, typing, bounds, grid, splits, scalar rules, sinks."""

import datetime as dt
from types import SimpleNamespace

import pytest
from fixtures import PRODUCTS, activity_frame, at, product_frame, row
from pyspark.sql import functions as F

from ebbline.config import ALL_EVENTS, BUY, CART, PAGE, REMOVE, SEARCH, ChurnConfig
from ebbline.functions import scalar
from ebbline.operators.days import client_days, daily_rollup, day_rows
from ebbline.operators.joins import hot_keys
from ebbline.operators.snapshots import (
    Bounds,
    SnapshotGrid,
    buyer_activity,
    dataset_bounds,
    grid_between,
    split_names,
)
from ebbline.plans.feature_table import build_feature_table, run_record
from ebbline.session import shared_folder, stage
from ebbline.sources import logs, results

CFG = ChurnConfig(
    observation_days=10, label_days=3, snapshot_step_days=3, count_windows=(1, 3, 7), trend_pairs=((3, 10),), recent_days=2
)


def write_logs(spark, root):
    """Raw files as text times, with bad rows."""
    product = "client_id long, timestamp string, sku long"
    for event in (BUY, CART, REMOVE):
        rows = [(c, str(at(d, c)), c % 3 + 1) for c in (1, 2, 3) for d in range(0, 30, c)]
        rows += [(None, str(at(1)), 1), (1, "yesterday", 2), (1, str(at(2)), None), (1, None, 3)]
        spark.createDataFrame(rows, product).write.parquet(f"{root}/deep/{event}.parquet")
    pages = [(c, str(at(d)), None if d % 2 else d) for c in (1, 4) for d in range(30)]
    spark.createDataFrame(pages, "client_id long, timestamp string, url long").write.parquet(f"{root}/{PAGE}.parquet")
    queries = [(1, str(at(d)), [1, 2, d]) for d in range(30)]
    frame = spark.createDataFrame(queries, "client_id long, timestamp string, query array<int>")
    frame.write.parquet(f"{root}/{SEARCH}.parquet")
    items = [(1, 10, "5.5", "a"), (2, 11, "none", "b"), (1, 9, "7", "c"), (None, 1, "1", "d"), (3, None, None, "e")]
    spark.createDataFrame(items, "sku long, category int, price string, name string").write.parquet(
        f"{root}/product_properties.parquet"
    )


def test_read_and_build_from_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_logs(spark, root)
    logs.register_views(logs.read_logs(spark, root))
    assert spark.sql(f"SELECT count(DISTINCT client_id) FROM {PAGE}").first()[0] == 2
    activity = logs.read_activity(spark, root)
    counts = dict(activity.groupBy("event").count().collect())
    assert counts[BUY] == 30 + 15 + 10 + 2 and counts[PAGE] == 60 and counts[SEARCH] == 30
    assert activity.filter("ts IS NULL").count() == 6
    assert activity.filter(F.col("event") == SEARCH).first().query.startswith("[1, 2, ")
    volume = logs.event_volume(logs.raw_events(logs.raw_logs(spark, root))).collect()
    assert [r.n_rows for r in volume] == sorted((r.n_rows for r in volume), reverse=True)
    assert {r.event: r.n_rows for r in volume}[BUY] == 59
    plan = activity.filter(F.col("event") == PAGE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1

    products = logs.read_products(spark, root)
    assert {r.sku: (r.category, r.price) for r in products.collect()} == {1: (9, 7.0), 2: (11, None), 3: (None, None)}
    assert logs.typed_products(spark.createDataFrame([(1, 2)], "sku long, category int")).first().price is None

    table = build_feature_table(activity, products, CFG)
    assert len(table.frame.columns) == 80 and table.frame.count() > 0
    out = str(tmp_path / "features")
    results.write_feature_table(table.frame, out)
    back = results.read_feature_table(spark, out)
    assert dict(back.dtypes)["snapshot_date"] == "date" and back.count() == table.frame.count()
    one_day = back.filter(F.col("snapshot_date") == F.lit(table.grid.dates[0]))
    assert "PartitionFilters: [isnotnull(snapshot_date" in one_day._jdf.queryExecution().executedPlan().toString()

    record = run_record(spark, table, root)
    results.write_record(record, str(tmp_path / "record"))
    read = results.read_record(spark, str(tmp_path / "record")).first()
    assert read.row_count == back.count() and read.feature_count == 80 and read.window_days == [1, 3, 7, 10]
    assert read.active_user_definition == "recent_engaged_buyers" and "2 days" in read.active_user_definition_detail


def test_shared_folder_follows_the_session(spark):
    def session(setting, context_folder, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: context_folder)
        return SimpleNamespace(sparkContext=context, conf={"spark.checkpoint.dir": setting} if setting else {})

    assert shared_folder(session("hdfs://a/b/", "file:/tmp/x", "yarn")) == "hdfs://a/b"
    assert shared_folder(session(None, "hdfs://c", "yarn")) == "hdfs://c"
    with pytest.raises(ValueError):
        shared_folder(session(None, None, "yarn"))
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5 and "/ebbline/numbers-" in staged.inputFiles()[0]


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        logs.find_parquet(spark, str(tmp_path), "product_buy")
    with pytest.raises(ValueError):
        logs.typed_products(spark.createDataFrame([(1,)], "price int"))
    with pytest.raises(ValueError):
        logs.typed_log(spark.createDataFrame([(1,)], "client_id long"), BUY)


def test_first_file_in_sort_order(spark, tmp_path):
    for folder, value in (("b", 2), ("z", 3), ("a/1/2/3/4/5/6", 1)):
        spark.createDataFrame([(value,)], "v int").write.parquet(f"{tmp_path}/{folder}/x.parquet")
    assert spark.read.parquet(logs.find_parquet(spark, str(tmp_path), "x")).first().v == 1


def test_ids_are_rounded_and_lists_keep_their_gaps(spark):
    raw = spark.createDataFrame([(1.5, "2025-01-01", 2.5), (2.4, "2025-01-01", 3.5)], "client_id double, timestamp string, sku double")
    assert [(r.client_id, r.sku) for r in logs.typed_log(raw, BUY).collect()] == [(2, 2), (2, 4)]
    lists = spark.createDataFrame([(1, "2025-01-01", [1, None, 3])], "client_id long, timestamp string, query array<int>")
    assert logs.typed_log(lists, SEARCH).first().query == "[1, NULL, 3]"
    items = spark.createDataFrame([(1, [1, 2]), (1, None)], "sku long, embedding array<int>")
    assert logs.typed_products(items).columns == ["sku", "category", "price", "embedding"] and logs.typed_products(items).count() == 1


def test_cleaned_log(spark):
    activity = activity_frame(spark, [row(1, at(1), PAGE, None), row(1, None, PAGE, 2), row(1, at(2), BUY, 5)])
    pages = logs.cleaned_logs(activity)[PAGE].collect()
    assert [(r.client_id, r.url) for r in pages] == [(1, -1)]
    many = activity_frame(spark, [row(i, at(1), PAGE, i) for i in range(500)])
    assert 100 < logs.cleaned_log(many, PAGE, 0.5).count() < 400


def test_sample_keeps_whole_clients(spark):
    activity = activity_frame(spark, [row(i % 100, at(i % 20), PAGE, i) for i in range(1000)])
    kept = logs.sample_clients(activity, 0.4, 7)
    sizes = [r["count"] for r in kept.groupBy("client_id").count().collect()]
    assert 20 < len(sizes) < 60 and set(sizes) == {10}
    assert logs.sample_clients(activity, None).count() == 1000


def test_rollup_and_days(spark):
    rows = [row(1, at(1), PAGE, 5), row(1, at(1, 9), PAGE, 5), row(1, None, PAGE, 5), row(1, at(2), SEARCH, "a  b")]
    rollup = daily_rollup(activity_frame(spark, rows)).orderBy("day").collect()
    assert [(r.event, r.n) for r in rollup] == [(PAGE, 2), (SEARCH, 1)]
    assert rollup[1].text_chars == 4 and rollup[1].text_words == 3
    assert client_days(day_rows(activity_frame(spark, rows))).count() == 2


def test_bounds_use_buyers_only(spark):
    rows = [row(9, at(0), PAGE, 1), row(1, at(2, 5), CART, 1), row(1, at(5), BUY, 1), row(1, at(8), SEARCH, "x"), row(9, at(9), PAGE, 1)]
    bounds = dataset_bounds(activity_frame(spark, rows))
    assert (bounds.min_ts, bounds.max_ts, bounds.n_buyers) == (at(2, 5), at(8), 1)
    shared = dataset_bounds(activity_frame(spark, [*rows, row(2, at(0, 7), BUY, 1), row(2, at(9, 1), CART, 1)]))
    assert (shared.min_ts, shared.max_ts) == (at(0, 7), at(9, 1))
    assert dataset_bounds(activity_frame(spark, [])).min_ts is None
    assert dataset_bounds(activity_frame(spark, [row(1, None, BUY, 1)])).min_ts is None
    for limit in (0, 100):
        kept = buyer_activity(activity_frame(spark, rows), ChurnConfig(broadcast_rows=limit))
        assert kept.count() == 3


def test_hot_clients(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 5 WHEN id < 550 THEN 2 WHEN id < 900 THEN NULL ELSE id END AS client_id")
    found = [hot_keys(rows, "client_id", 1000, n) for n in (100, 200)]
    assert [sorted(r.key for r in f.table.collect()) for f in found] == [[2, 5], [5]]
    assert hot_keys(rows, "client_id", 1000, 1000) is None


def test_grid(spark):
    bounds = Bounds(dt.datetime(2025, 1, 1, 3), dt.datetime(2025, 6, 30, 22), 1)
    grid = grid_between(bounds, ChurnConfig())
    assert grid.count == 10 and grid.dates[0] == dt.date(2025, 1, 31) and grid.dates[-1] == dt.date(2025, 6, 6)
    assert [r.snapshot_date for r in grid.frame(spark).collect()] == grid.dates
    assert grid_between(bounds, ChurnConfig(max_snapshots=4)).dates == grid.dates[-4:]
    for end in (dt.datetime(2025, 2, 14), dt.datetime(2025, 2, 20)):
        with pytest.raises(ValueError):
            grid_between(Bounds(bounds.min_ts, end, 1), ChurnConfig())
    assert isinstance(grid, SnapshotGrid)


@pytest.mark.parametrize("n, sizes", [(3, (1, 1, 1)), (4, (2, 1, 1)), (5, (3, 1, 1)), (6, (3, 1, 2)), (9, (5, 2, 2)), (11, (6, 2, 3))])
def test_split_sizes(n, sizes):
    names = split_names(n)
    assert tuple(names.count(s) for s in ("train", "valid", "test")) == sizes
    assert names == sorted(names, key=["train", "valid", "test"].index)


def test_config_errors():
    for bad in (
        {"cohort": "everyone"},
        {"churn": "never"},
        {"observation_days": 10},
        {"label_days": 0},
        {"trend_pairs": ((7, 29),)},
        {"recent_days": 31},
    ):
        with pytest.raises(ValueError):
            ChurnConfig(**bad)
    with pytest.warns(UserWarning):
        ChurnConfig(snapshot_step_days=7)


def test_default_table_has_100_columns(spark):
    rows = [row(c, at(d), e, 1 if e != SEARCH else "q") for c in (1, 2) for d in range(0, 90, 3) for e in ALL_EVENTS]
    frame = build_feature_table(activity_frame(spark, rows), product_frame(spark, PRODUCTS), ChurnConfig()).frame
    assert len(frame.columns) == 100 and len(set(frame.columns)) == 100
    for name in ("product_buy_trend_delta_7d_vs_prev23d", "search_to_buy_gap_30d", "future_active_days_14d", "active_days_30d"):
        assert name in frame.columns


@pytest.mark.parametrize(
    "text, count", [(None, 0), ("", 0), ("   ", 0), ("a", 1), (" a b ", 2), ("a  b", 3), ("a\tb", 1)]
)
def test_word_count(spark, text, count):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalar.word_count(F.col("t")).alias("n")).first().n == count


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    out = df.select(scalar.safe_divide(F.col("a"), F.col("b")).alias("q"), scalar.ratio_or_null(F.col("a"), F.col("b")).alias("r"))
    assert [tuple(r) for r in out.collect()] == [(0.0, None), (0.0, None), (1.5, 1.5)]
    texts = [None, "", " ", "[1, 2.5, -3e2]", "[240 170  7]", "1,2", "[a 1]"]
    parsed = spark.createDataFrame([(t,) for t in texts], "t string").select(scalar.parse_vector(F.col("t")).alias("v"))
    assert [r.v for r in parsed.collect()] == [[], [], [], [1, 2.5, -300], [240, 170, 7], [1, 2], [None, 1]]
    times = spark.createDataFrame([("2024-01-02 03:04:05",), ("bad",), (None,)], "t string")
    days = [r.d for r in times.select(scalar.floor_to_day(F.col("t")).alias("d")).collect()]
    assert days == [dt.datetime(2024, 1, 2), None, None]
    close = spark.createDataFrame([(0.5, 0.5000001), (0.5, 0.51)], "a double, b double")
    assert [r.c for r in close.select(scalar.is_close(F.col("a"), F.col("b")).alias("c")).collect()] == [True, False]


def test_rewrite_touches_only_its_snapshots(spark, tmp_path):
    path = str(tmp_path / "features")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    results.write_feature_table(spark.createDataFrame([(d, c, c) for d in days for c in range(5)], "snapshot_date date, client_id long, x long"), path)

    def files(day):
        return {p.name: p.stat().st_mtime_ns for p in (tmp_path / "features" / f"snapshot_date={day}").glob("*.parquet")}

    before = {d: files(d) for d in days}
    results.rewrite_snapshots(spark, path, lambda rows: rows.filter("client_id > 0").withColumn("x", F.col("x") * 10), [days[1]])
    assert files(days[0]) == before[days[0]] and files(days[2]) == before[days[2]] and files(days[1]) != before[days[1]]
    rows = {(r.snapshot_date, r.client_id): r.x for r in results.read_feature_table(spark, path).collect()}
    assert len(rows) == 14 and rows[days[1], 4] == 40 and rows[days[0], 4] == 4 and (days[1], 0) not in rows


def test_footers_are_counted_without_reading_rows(spark, tmp_path):
    root = str(tmp_path / "logs")
    write_logs(spark, root)
    counts = logs.footer_volume(spark, root)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 5
    assert {r.event: r.n_rows for r in counts.collect()} == {e: df.count() for e, df in logs.raw_logs(spark, root).items()}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_damaged_lines_are_counted(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("client_id,snapshot_date,y_true,y_score,y_pred,error_type\n1,2024-01-01,1,0.5,1,correct\n2,2024-01-01,x,0.5,1,correct\n3,,0,,0,\nfour\n")
    checked = results.read_csv_checked(spark, str(path), results.PREDICTION_SCHEMA)
    counts = results.line_counts(checked).first()
    assert (counts.n_good, counts.n_bad) == (2, 2)
    good = {r.client_id: r for r in checked.filter(F.col(results.BAD_LINE).isNull()).collect()}
    assert sorted(good) == [1, 3] and good[3].y_score is None


def test_text_times(spark):
    rows = [("2024-01-01 10:00:00",), ("2024-01-03",), ("never",), (None,), ("2024-13-01",)]
    found = logs.time_quality(spark.createDataFrame(rows, "timestamp string")).first()
    assert tuple(found) == (2, 1, 2, dt.date(2024, 1, 1), dt.date(2024, 1, 3))
