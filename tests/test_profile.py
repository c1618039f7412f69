"""Feature rows against brute force on hand-made and random logs, in every physical variant."""

import datetime as dt
import re
from dataclasses import replace

import pytest
from fixtures import DAY, PRODUCTS, START, activity_frame, at, brute_force, product_frame, random_rows, row

from ebbline.config import ALL_EVENTS, BUY, CART, CHURN_RULES, COHORTS, PAGE, SEARCH, ChurnConfig
from ebbline.operators import joins as joins_module
from ebbline.operators import profile as profile_module
from ebbline.operators.days import daily_rollup, day_rows
from ebbline.operators.joins import HotKeys, hot_keys, join_key_table
from ebbline.operators.profile import definition_rates, of_definition, snapshot_profile
from ebbline.operators.snapshots import Bounds, dataset_bounds, grid_between
from ebbline.session import stage

CFG = ChurnConfig(
    observation_days=20, label_days=7, snapshot_step_days=7, count_windows=(1, 3, 7), trend_pairs=((3, 20),), recent_days=4
)


def check(got, expected):
    rows = {(r.snapshot_date, r.client_id): r.asDict() for r in got.collect()}
    assert rows.keys() == expected.keys()
    for key, features in expected.items():
        for name, value in features.items():
            assert rows[key][name] == pytest.approx(value, abs=1e-9), (key, name)


def build(spark, rows, cfg, **options):
    activity = activity_frame(spark, rows)
    bounds = options.pop("bounds", None) or dataset_bounds(activity)
    grid = grid_between(bounds, cfg)
    products = product_frame(spark, PRODUCTS)
    got = snapshot_profile(day_rows(activity), grid, cfg, products, ALL_EVENTS, ALL_EVENTS, bounds)
    return got, brute_force(rows, PRODUCTS, cfg, grid.dates)


@pytest.mark.parametrize("cohort", ["historical_buyers", "recently_active_buyers", "recent_engaged_buyers"])
@pytest.mark.parametrize("churn", ["no_buy_in_label_window", "no_buy_and_low_future_activity"])
def test_random_logs(spark, cohort, churn):
    got, expected = build(spark, random_rows(1), replace(CFG, cohort=cohort, churn=churn))
    assert expected
    check(got, expected)


def test_every_definition_from_one_pass(spark):
    rows = random_rows(11)
    activity = activity_frame(spark, rows)
    bounds = dataset_bounds(activity)
    grid = grid_between(bounds, CFG)
    products = product_frame(spark, PRODUCTS)
    all_at_once = stage(snapshot_profile(day_rows(activity), grid, CFG, products, ALL_EVENTS, ALL_EVENTS, bounds, every_definition=True), "all")
    rates = {(r.cohort, r.churn_rule, r.snapshot_date): (r.cohort_size, r.churned) for r in definition_rates(all_at_once).collect()}
    for cohort in COHORTS:
        for churn in CHURN_RULES:
            cfg = replace(CFG, cohort=cohort, churn=churn)
            one = of_definition(all_at_once, cohort, churn)
            alone = snapshot_profile(day_rows(activity), grid, cfg, products, ALL_EVENTS, ALL_EVENTS, bounds)
            assert one.columns == alone.columns
            expected = brute_force(rows, PRODUCTS, cfg, grid.dates)
            check(one, expected)
            for s in {s for s, _ in expected}:
                labels = [f["churn"] for (t, _), f in expected.items() if t == s]
                assert rates[cohort, churn, s] == (len(labels), sum(labels))


def test_leak_safe(spark):
    got, expected = build(spark, random_rows(2), replace(CFG, leak_safe=True))
    check(got, expected)


def test_salted_joins_give_the_same(spark):
    got, expected = build(spark, random_rows(3, hot=True), replace(CFG, broadcast_rows=0, join_salts=4))
    check(got, expected)


def heavy(spark, parts):
    return HotKeys(spark.createDataFrame(list(parts.items()), "key long, parts int"), len(parts))


def test_hot_client_in_parts_gives_the_same(spark):
    rows = random_rows(4, n_rows=1500, hot=True)
    found = dataset_bounds(activity_frame(spark, rows))
    bounds = Bounds(found.min_ts, found.max_ts, found.n_buyers, hot=heavy(spark, {1: 5, 5: 3}))
    got, expected = build(spark, rows, replace(CFG, join_salts=5), bounds=bounds)
    check(got, expected)


def test_hot_client_is_spread_by_item(spark):
    rows = [(c, PAGE, None, i) for c in (1, 2) for i in range(40)] + [(1, BUY, 7, i) for i in range(40)]
    df = spark.createDataFrame(rows, "client_id long, event string, category long, item long")
    spread = profile_module._by_client(heavy(spark, {1: 8}).mark(df, "client_id"))
    parts = dict(spread.groupBy("client_id").agg({"part": "max"}).collect())
    assert parts[2] == 0 and parts[1] > 3
    # also the items of one category are spread
    assert spread.filter("category = 7").select("part").distinct().count() > 3


def test_dominant_category_of_one_client_is_spread(spark):
    """One client whose items nearly all lie in one category, in many parts: its share is that of the whole category."""
    rows = [row(1, at(d, i), event, 100 + i) for event in (BUY, CART) for d in range(3, 40) for i in range(12)]
    rows += [row(1, at(d), BUY, 1) for d in range(5, 40, 2)] + [row(2, at(d), BUY, 1 + d % 3) for d in range(60)]
    products = [(100 + i, 7, 2.0 * i) for i in range(12)] + [(1, 8, 1.0), (2, 8, 3.0), (3, 9, None)]
    activity = activity_frame(spark, rows)
    found = dataset_bounds(activity)
    grid = grid_between(found, CFG)
    frame = product_frame(spark, products)
    for cfg in (CFG, replace(CFG, broadcast_rows=0)):
        bounds = Bounds(found.min_ts, found.max_ts, found.n_buyers, hot=heavy(spark, {1: 9}))
        got = snapshot_profile(day_rows(activity), grid, cfg, frame, ALL_EVENTS, ALL_EVENTS, bounds)
        check(got, brute_force(rows, products, cfg, grid.dates))
        share = got.filter("client_id = 1").agg({"product_buy_top_category_share_20d": "max"}).first()[0]
        assert 0.9 < share < 1


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_fan_out_tasks_follow_the_rows(spark, monkeypatch, hot_rows):
    """Copies per snapshot are grouped in as many partitions as their number asks for, not in as many as fit the size of a shuffle."""
    rows = random_rows(3)
    activity = activity_frame(spark, rows)
    bounds = dataset_bounds(activity, hot_rows) if hot_rows else dataset_bounds(activity)
    assert bounds.n_rows == activity.count() and (bounds.hot is None) == (hot_rows is None)
    monkeypatch.setattr(profile_module, "TASK_COPIES", 100)
    tasks = profile_module.fan_out_tasks(bounds.n_rows, CFG)
    assert tasks == -(-bounds.n_rows * 4 // 100) > 8
    assert profile_module.fan_out_tasks(10 * bounds.n_rows, CFG) >= 10 * (tasks - 1)
    got, expected = build(spark, rows, CFG, bounds=bounds)
    plan = got._jdf.queryExecution().executedPlan().toString()
    branches = 1 if hot_rows is None else 2
    by_part = [line for line in plan.splitlines() if re.search(rf"hashpartitioning\(client_id#\d+L, part#\d+, {tasks}\), REPARTITION_BY_NUM", line)]
    assert len(by_part) == branches
    check(got, expected)


def test_hot_keys_are_data(spark):
    """100,000 heavy clients: they are counted, stored and joined, and no list of them stands in a plan."""
    rows = spark.range(400_000).selectExpr("id % 130000 AS client_id", "id AS x")  # of 0..9999 there are 4, of the others 3
    hot = hot_keys(rows.filter("client_id < 100000 OR x < 130000"), "client_id", hot_rows=2)
    assert hot.count == 100_000 and hot.table.agg({"parts": "max"}).first()[0] == 2
    small = spark.range(110_000).selectExpr("id AS client_id", "id * 2 AS y")
    joined = join_key_table(rows, small, "client_id", "inner", broadcast=False, hot=hot)
    plan = joined._jdf.queryExecution().toString()
    assert len(plan) < 20_000 and " IN (" not in plan and " INSET " not in plan
    assert joined.count() == rows.filter("client_id < 110000").count() == joined.filter("y = client_id * 2").count()
    assert joined.columns == ["client_id", "x", "y"]
    assert hot_keys(rows, "client_id", hot_rows=1_000_000) is None and hot_keys(rows.filter("false"), "client_id", hot_rows=1) is None


def test_shuffled_hot_keys_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(joins_module, "HOT_BROADCAST", 0)
    rows = random_rows(9, n_rows=800, hot=True)
    found = dataset_bounds(activity_frame(spark, rows), hot_rows=60)
    assert found.hot.count == 1
    got, expected = build(spark, rows, replace(CFG, broadcast_rows=0), bounds=found)
    check(got, expected)


def test_windows_of_several_words(spark, monkeypatch):
    monkeypatch.setattr(profile_module, "WORD_BITS", 6)
    got, expected = build(spark, random_rows(5), CFG)
    check(got, expected)


def test_stored_rollup_gives_the_same(spark):
    rows = random_rows(6)
    activity = activity_frame(spark, rows)
    bounds = dataset_bounds(activity)
    grid = grid_between(bounds, CFG)
    rollup = stage(daily_rollup(activity), "rollup")
    got = snapshot_profile(
        rollup, grid, CFG, product_frame(spark, PRODUCTS), ALL_EVENTS, ALL_EVENTS, bounds, rolled=True
    )
    check(got, brute_force(rows, PRODUCTS, CFG, grid.dates))


def test_without_bounds_and_with_few_logs(spark):
    rows = random_rows(7)
    activity = activity_frame(spark, rows)
    grid = grid_between(dataset_bounds(activity), CFG)
    expected = brute_force(rows, PRODUCTS, CFG, grid.dates)
    for details in ((), (PAGE,), (BUY,), (SEARCH,)):
        got = snapshot_profile(day_rows(activity), grid, CFG, product_frame(spark, PRODUCTS), ALL_EVENTS, details)
        names = set(got.columns)
        check(got, {k: {n: v for n, v in f.items() if n in names} for k, f in expected.items()})


def test_window_borders(spark):
    """Events exactly on a border and one microsecond before it."""
    s = 27
    rows = [row(9, at(0), BUY, 1), row(9, at(60), BUY, 1)]
    for client, offset in enumerate((s, s - 1, s - 3, s - 20, s + 7), start=1):
        rows += [row(client, at(s - 2), BUY, 1), row(client, at(offset), CART, 2), row(client, at(offset, -1), PAGE, 3)]
    got, expected = build(spark, rows, CFG)
    check(got, expected)


def test_search_before_buy_on_snapshot_day(spark):
    s = 20
    rows = [row(1, at(0), BUY, 1), row(1, at(s - 1), SEARCH, "a b"), row(1, at(s, 5), BUY, 2), row(1, at(60), BUY, 1)]
    rows += [row(1, at(s - 2), CART, 4)]
    for leak_safe, count in ((False, 1), (True, 0)):
        got, expected = build(spark, rows, replace(CFG, leak_safe=leak_safe))
        check(got, expected)
        first = got.filter(got.snapshot_date == (START + s * DAY).date()).first()
        assert first["search_to_buy_1d_count_20d"] == count


def test_features_do_not_see_the_future(spark):
    """Dropping every event at or after a snapshot changes no leak-safe feature of that snapshot."""
    rows = random_rows(8)
    cfg = replace(CFG, leak_safe=True)
    activity = activity_frame(spark, rows)
    bounds = dataset_bounds(activity)
    grid = grid_between(bounds, cfg)
    s = grid.dates[2]
    products = product_frame(spark, PRODUCTS)
    cut = activity_frame(spark, [r for r in rows if r[1] is not None and r[1] < dt.datetime.combine(s, dt.time())])

    def features(source):
        got = snapshot_profile(day_rows(source), grid, cfg, products, ALL_EVENTS, ALL_EVENTS, bounds)
        kept = [c for c in got.columns if not c.startswith("future_") and c != "churn"]
        return sorted(map(tuple, got.filter(got.snapshot_date == s).select(kept).collect()))

    assert features(activity) == features(cut)


def test_plan_has_no_nested_loop_and_no_python(spark, sf_dir):
    from ebbline.catalog import QUERIES

    for name in ("feature_table", "features_page_visit", "cohort_historical_buyers"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
        assert "SinglePartition" not in plan
