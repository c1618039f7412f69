"""One row per client and snapshot: cohort, label and windowed features from one partitioning by client.

Shape of the plan:

1. ``buyers``: first and last buy day per client, from the buy log alone. No other client can be
   in any cohort, so the large logs are cut down to buyers before anything is shuffled.
2. The remaining rows are rolled up to (client, log, day, item): a narrow shuffle with map-side aggregation, in
   which a hot client is spread over its items and days.
3. The rollup is partitioned by client. Everything up to the client is now local: the
   fan-out to snapshots, items, categories, and the aggregation per client and snapshot.
   Rows are copied per snapshot only here, so the copies are never shuffled. The number of partitions follows the number of
   copies, which the size of the shuffled rows does not tell, so a task groups no more of them on larger tables. Clients that hold very many rows, known
   from a stored table, get several parts, cut by item; the parts of one of their categories, one row each, are then merged, so that
   its share is counted whole.
4. Distinct items and categories are counted by grouping first, so no ``count(distinct)`` expands rows. Distinct
   days are bits of a word, joined with ``bit_or``.
5. The last grouping by ``(snapshot_date, client_id)`` merges the parts: it shuffles about one row per
   result row and log family. No star of joins.

The many similar columns are written as SQL expressions, one string each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.config import (
    ALL_EVENTS,
    BUY,
    CART,
    CHURN_RULES,
    COHORTS,
    ENGAGEMENT_EVENTS,
    PAGE,
    PRODUCT_EVENTS,
    SEARCH,
    ChurnConfig,
)
from ebbline.operators.joins import HotKeys, fits_broadcast, hot_keys, join_key_table, part_of
from ebbline.operators.snapshots import Bounds, SnapshotGrid, fan_out
from ebbline.session import stage

KEYS = ("snapshot_date", "client_id")
SPAN = ("client_id", "first_buy", "last_buy")
WORD_BITS = 62
# The cohort that holds all the others.
WIDEST = "historical_buyers"
# Copies of rows, one per snapshot, that a task groups; each takes about a KB of its hash tables.
TASK_COPIES = 500_000
# Partitions by client of small tables.
LEAST_TASKS = 8
TEXT_SUMS = ("n", "n_text", "text_chars", "text_words")
SEARCH_PARTS = ("chars", "words", "to_cart", "to_buy")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def aggregate(df: DataFrame, keys: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    """Group and aggregate by SQL expressions given per output name."""
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} AS {name}") for name, sql in columns.items()])


def project(df: DataFrame, keys: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*keys, *[f"{sql} AS {name}" for name, sql in columns.items()])


def _n_words(days: int) -> int:
    return -(-days // WORD_BITS)


def _day_bit(position: str, word: int) -> str:
    """Bit of a 0-based day position inside word ``word``, NULL outside it."""
    start = word * WORD_BITS
    stop = start + WORD_BITS - 1
    return f"CASE WHEN {position} BETWEEN {start} AND {stop} THEN shiftleft(1L, {position} - {start}) END"


def _distinct_days(words: list[str]) -> str:
    return " + ".join(f"CAST(bit_count({w}) AS BIGINT)" for w in words)


class Measures:
    """Sums per group and how they are merged. Column names are internal."""

    def __init__(self, cfg: ChurnConfig):
        self.cfg = cfg
        self.counts = [f"c{k}" for k in cfg.windows]
        self.total = self.counts[-1]
        self.past = [f"past{w}" for w in range(_n_words(cfg.observation_days))]
        self.future = [f"future{w}" for w in range(_n_words(cfg.label_days))]

    def of_row(self) -> dict[str, str]:
        """The measures of a single day row."""
        out = {c: f"CASE WHEN lead BETWEEN 1 AND {k} THEN n END" for k, c in zip(self.cfg.windows, self.counts)}
        out["recency"] = "CASE WHEN lead >= 1 THEN lead END"
        out |= {c: _day_bit("(lead - 1)", w) for w, c in enumerate(self.past)}
        out["n_future"] = "CASE WHEN lead <= 0 THEN n END"
        out |= {c: _day_bit("(0 - lead)", w) for w, c in enumerate(self.future)}
        return out

    def _merged(self, name: str, value: str) -> str:
        if name == "recency":
            return f"min({value})"
        return f"bit_or({value})" if name in (*self.past, *self.future) else f"sum({value})"

    def of_rows(self) -> dict[str, str]:
        return {name: self._merged(name, value) for name, value in self.of_row().items()}

    def merged(self) -> dict[str, str]:
        return {name: self._merged(name, name) for name in self.of_row()}

    def of_event(self, event: str) -> dict[str, str]:
        """Merged past measures of one log."""
        own = {n: f"CASE WHEN event = '{event}' THEN {n} END" for n in (*self.counts, "recency", *self.past)}
        return {f"{event}_{n}": self._merged(n, value) for n, value in own.items()}

    def of_future(self) -> dict[str, str]:
        return {"n_future": f"sum(CASE WHEN event = '{BUY}' THEN n_future END)"} | {
            c: f"bit_or({c})" for c in self.future
        }


def buy_spans(days: DataFrame) -> DataFrame:
    """First and last buy day per client."""
    return aggregate(
        days.filter(F.col("event") == BUY), ("client_id",), {"first_buy": "min(day)", "last_buy": "max(day)"}
    )


def attach_products(days: DataFrame, products: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """Category and price of each product event; events of unknown products are kept."""
    small = fits_broadcast(products, cfg.broadcast_rows)
    if small:
        return join_key_table(days, products, "sku", "left", broadcast=True)
    days = stage(days, "product-days")  # counted, then joined
    return join_key_table(days, products, "sku", "left", broadcast=False, hot=hot_keys(days, "sku", least_parts=cfg.join_salts))


def _rollup(rows: DataFrame, items: tuple[str, ...], sums: tuple[str, ...] = ("n",)) -> DataFrame:
    """Day rows summed per item. The buy span depends on the client, so it adds no groups."""
    return aggregate(rows, (*SPAN, "event", "day", *items), {c: f"sum({c})" for c in sums})


def fan_out_tasks(n_rows: int, cfg: ChurnConfig) -> int:
    """Partitions by client in which the copies of ``n_rows`` rows are TASK_COPIES each, LEAST_TASKS at least."""
    snapshots = -(-(cfg.observation_days + cfg.label_days) // cfg.snapshot_step_days)
    return max(LEAST_TASKS, -(-n_rows * snapshots // TASK_COPIES))


def _by_client(marked: DataFrame, tasks: int = LEAST_TASKS) -> DataFrame:
    """Partition by client; the rows of a heavy client (``_parts`` is set) in parts along its items."""
    return marked.withColumn("part", part_of("event", "item")).drop("_parts").repartition(tasks, "client_id", "part")


def _item_branches(rows: DataFrame, hot: HotKeys | None, tasks: int, grid: SnapshotGrid, cfg: ChurnConfig, m: Measures) -> list[DataFrame]:
    """Category sums per client and snapshot, of heavy clients in a branch of their own."""
    if hot is None:
        local = rows.withColumn("part", F.lit(0)).repartition(tasks, "client_id", "part")
        return [_item_parts(_fanned(local, grid, cfg, cfg.label_days), m).drop("part")]
    marked = stage(hot.mark(rows, "client_id"), "marked")  # read by both branches
    cold, heavy = (_by_client(marked.filter(f"_parts IS {kind}"), tasks) for kind in ("NULL", "NOT NULL"))
    cold, heavy = (_item_parts(_fanned(local, grid, cfg, cfg.label_days), m) for local in (cold, heavy))
    return [cold.drop("part"), _merged_parts(heavy, m)]


def _fanned(rows: DataFrame, grid: SnapshotGrid, cfg: ChurnConfig, ahead: int) -> DataFrame:
    """Rows once per snapshot at which the client can be in the cohort.

    After the snapshot only buys, cart additions and page visits count."""
    until = "last_buy" if cfg.cohort == "recent_engaged_buyers" else None
    copies = fan_out(rows, grid, cfg.observation_days, ahead, after="first_buy", until=until)
    return copies.filter(f"lead >= 1 OR event IN ({quoted(ENGAGEMENT_EVENTS)})").drop("first_buy", "last_buy", "day")


def _item_parts(rows: DataFrame, m: Measures) -> DataFrame:
    """One row per category with the sums over its items; price and category depend on the item. What lies
    after the snapshot is kept in the group without item."""
    past = {c: f"CASE WHEN lead >= 1 THEN {c} END" for c in ("item", "category", "price")}
    kept = [c for c in rows.columns if c not in past]
    keyed = project(rows, tuple(kept), past)
    items = aggregate(
        keyed,
        (*KEYS, "part", "event", "item"),
        m.of_rows() | {"category": "max(category)", "price": "max(price)"},
    )
    return aggregate(
        items,
        (*KEYS, "part", "event", "category"),
        m.merged()
        | {
            "n_items": "count(item)",
            "price_sum": f"sum({m.total} * price)",
            "price_n": f"sum(CASE WHEN price IS NOT NULL THEN {m.total} END)",
            "price_max": "max(price)",
        },
    )


def _merged_parts(parts: DataFrame, m: Measures) -> DataFrame:
    """Categories whose items were dealt to several parts as one row again; an item is in one part only."""
    sums = {c: f"sum({c})" for c in ("n_items", "price_sum", "price_n")}
    return aggregate(parts, (*KEYS, "event", "category"), m.merged() | sums | {"price_max": "max(price_max)"})


def search_days(days: DataFrame, keys: tuple[str, ...] = ("client_id",)) -> DataFrame:
    """Searches per client and day, with flags for a cart or buy on the same and on the next day.

    Cart and buy days are sent to the search days they can answer, so one grouping replaces four
    left joins on day and day + 1. Partial aggregation absorbs hot clients."""
    searches = days.filter(F.col("event") == SEARCH).select(*keys, "day", *TEXT_SUMS)
    answers = (
        days.filter(F.col("event").isin(CART, BUY))
        .selectExpr(*keys, "event", "day AS answered_on", "explode(array(0, 1)) AS gap")
        .selectExpr(*keys, "date_sub(answered_on, gap) AS day", "concat(event, '_', gap) AS answer")
    )
    sums = {c: f"sum({c})" for c in TEXT_SUMS}
    flags = {
        f"{e}_{gap}": f"coalesce(bool_or(answer = '{e}_{gap}'), false)" for e in (CART, BUY) for gap in (0, 1)
    }
    both = searches.unionByName(answers, allowMissingColumns=True)
    return aggregate(both, (*keys, "day"), sums | flags).filter("n > 0")


def _search_parts(rows: DataFrame, m: Measures) -> DataFrame:
    # With leak_safe the day after the last observed day is not looked at: it lies in the label window.
    next_day = "AND lead > 1" if m.cfg.leak_safe else ""

    def converted(event: str) -> str:
        return f"CASE WHEN {event}_0 OR ({event}_1 {next_day}) THEN n END"

    # A day's mean length ignores missing texts but is weighted with all searches of the day.
    parts = {
        "chars": "n * try_divide(CAST(text_chars AS DOUBLE), n_text)",
        "words": "text_words",
        "to_cart": converted(CART),
        "to_buy": converted(BUY),
    }
    return project(rows, (*KEYS, "event"), m.of_row() | parts)


def _cohort_filter(cohort: str, cfg: ChurnConfig) -> str:
    if cohort == "historical_buyers":
        return "true"  # the fan-out already requires a buy before the snapshot
    last = f"least({', '.join(f'{e}_recency' for e in ENGAGEMENT_EVENTS)})"
    if cohort == "recently_active_buyers":
        return f"{last} IS NOT NULL"
    return f"{BUY}_recency IS NOT NULL AND {last} <= {cfg.recent_days}"


def _churn_rule(churn: str, m: Measures) -> str:
    rule = "coalesce(n_future, 0L) = 0"
    if churn == "no_buy_and_low_future_activity":
        rule += f" AND {_future_days(m)} <= {m.cfg.low_activity_days}"
    return rule


def _future_days(m: Measures) -> str:
    return _distinct_days([f"coalesce({c}, 0L)" for c in m.future])


def _bits(conditions: list[str]) -> str:
    """Bit i is set where condition i holds."""
    return " | ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, c in enumerate(conditions))


def _label_columns(m: Measures) -> dict[str, str]:
    cfg = m.cfg
    return {f"future_buy_count_{cfg.label_days}d": "coalesce(n_future, 0L)", f"future_active_days_{cfg.label_days}d": _future_days(m)}


def _event_columns(m: Measures, event: str, detailed: bool) -> dict[str, str]:
    e, obs = event, m.cfg.observation_days
    out = {f"{e}_count_{k}d": f"coalesce({e}_{c}, 0L)" for k, c in zip(m.cfg.windows, m.counts)}
    out[f"{e}_recency_days"] = f"CAST(coalesce({e}_recency, {obs + 1}) AS BIGINT)"
    days = {f"{e}_days_{obs}d": _distinct_days([f"coalesce({e}_{c}, 0L)" for c in m.past])}
    if e == SEARCH:
        if detailed:
            total = f"{e}_{m.total}"
            out |= {
                f"{e}_avg_length_{obs}d": f"coalesce(try_divide(chars, {total}), 0D)",
                f"{e}_avg_word_count_{obs}d": f"coalesce(try_divide(CAST(words AS DOUBLE), {total}), 0D)",
                f"search_to_cart_1d_count_{obs}d": "coalesce(to_cart, 0L)",
                f"search_to_buy_1d_count_{obs}d": "coalesce(to_buy, 0L)",
            }
        return out
    if not detailed:
        return out | days
    if e == PAGE:
        return out | days | {f"{e}_unique_url_{obs}d": f"coalesce({e}_n_items, 0L)"}
    return (
        out
        | {f"{e}_distinct_sku_{obs}d": f"coalesce({e}_n_items, 0L)"}
        | days
        | {
            f"{e}_distinct_category_{obs}d": f"coalesce({e}_categories, 0L)",
            f"{e}_price_mean_{obs}d": f"coalesce(try_divide({e}_price_sum, {e}_price_n), 0D)",
            f"{e}_price_max_{obs}d": f"coalesce({e}_price_max, 0D)",
            f"{e}_price_sum_{obs}d": f"coalesce({e}_price_sum, 0D)",
            f"{e}_top_category_share_{obs}d": f"coalesce(try_divide(CAST({e}_top AS DOUBLE), {e}_rated), 0D)",
        }
    )


def _detail_aggregates(m: Measures, event: str) -> dict[str, str]:
    e = event
    if e == SEARCH:
        return {c: f"sum({c})" for c in SEARCH_PARTS}
    out = {f"{e}_n_items": f"sum(CASE WHEN event = '{e}' THEN n_items END)"}
    if e == PAGE:
        return out
    in_category = f"CASE WHEN event = '{e}' AND category IS NOT NULL AND {m.total} > 0 THEN {m.total} END"
    return out | {
        f"{e}_categories": f"count({in_category})",
        f"{e}_top": f"max({in_category})",
        f"{e}_rated": f"sum({in_category})",
        f"{e}_price_sum": f"sum(CASE WHEN event = '{e}' THEN price_sum END)",
        f"{e}_price_n": f"sum(CASE WHEN event = '{e}' THEN price_n END)",
        f"{e}_price_max": f"max(CASE WHEN event = '{e}' THEN price_max END)",
    }


def snapshot_profile(
    days: DataFrame,
    grid: SnapshotGrid,
    cfg: ChurnConfig,
    products: DataFrame | None = None,
    events: tuple[str, ...] = ENGAGEMENT_EVENTS,
    details: tuple[str, ...] = (),
    bounds: Bounds | None = None,
    rolled: bool = False,
    every_definition: bool = False,
) -> DataFrame:
    """Cohort rows with labels and the features of ``events``.

    With ``every_definition`` the rows are the members of any cohort, and ``cohort_bits`` and ``churn_bits`` in the place of
    ``churn`` say to which cohorts of COHORTS a row belongs and by which rules of CHURN_RULES it churned; ``of_definition`` picks one. The
    features of a client do not depend on the definition, so one pass over the logs serves all of them.

    ``details`` names the logs whose item, price or text features are wanted; the others are grouped
    without their items. The engagement logs are always read: cohort and label need them. ``bounds`` of the same
    data saves the passes for the number of rows, of buyers and the hot clients; ``rolled`` says that ``days`` is a stored
    daily rollup.
    """
    if every_definition:
        cfg = replace(cfg, cohort=WIDEST)
    m = Measures(cfg)
    used = [e for e in ALL_EVENTS if e in events or e in ENGAGEMENT_EVENTS]
    itemised = [e for e in used if e in details and e != SEARCH]
    plain = [e for e in used if e not in details and e != SEARCH]
    buyers = buy_spans(days)
    small = bounds.n_buyers <= cfg.broadcast_rows if bounds else fits_broadcast(buyers, cfg.broadcast_rows)
    if not small:
        buyers = stage(buyers, "buyers")  # every log is joined to it
    hot = None
    if itemised:  # without items a client has few rows per day, however active it is
        hot = hot_keys(days, "client_id", least_parts=cfg.join_salts) if bounds is None else bounds.hot

    def of_buyers(rows: DataFrame) -> DataFrame:
        return join_key_table(rows, buyers, "client_id", "inner", broadcast=small, hot=hot)

    def rolled_up(names: Sequence[str], items: tuple[str, ...]) -> DataFrame:
        rows = days.filter(F.col("event").isin(*names))
        if rolled and items:
            return of_buyers(rows.select("client_id", "event", "day", *items, "n"))
        if small:  # the broadcast drops rows before they are grouped
            return _rollup(of_buyers(rows), items)
        return of_buyers(aggregate(rows, ("client_id", "event", "day", *items), {"n": "sum(n)"}))

    logs = []
    product_logs = [e for e in itemised if e in PRODUCT_EVENTS]
    if product_logs:
        if products is None:
            raise ValueError("product features need the product table")
        priced = attach_products(rolled_up(product_logs, ("sku",)), products, cfg)
        logs.append(priced.withColumnRenamed("sku", "item"))
    if PAGE in itemised:
        pages = rolled_up([PAGE], ("url",)).withColumnRenamed("url", "item")
        logs.append(pages.selectExpr("*", "CAST(NULL AS BIGINT) AS category", "CAST(NULL AS DOUBLE) AS price"))
    if plain:
        logs.append(rolled_up(plain, ()))
    # Without items the last grouping moves the rows to their client anyway.
    n_rows = bounds.n_rows if bounds and bounds.n_rows is not None else days.count() if itemised or SEARCH in used else 0
    tasks = fan_out_tasks(n_rows, cfg)
    if itemised:
        branches = _item_branches(_union(logs), hot, tasks, grid, cfg, m)
    else:
        branches = [project(_fanned(_union(logs), grid, cfg, cfg.label_days), (*KEYS, "event"), m.of_row())]
    if SEARCH in used:
        searches = search_days(of_buyers(days.filter(F.col("event").isin(SEARCH, CART, BUY))), SPAN).repartition(tasks, "client_id")
        copies = _fanned(searches.withColumn("event", F.lit(SEARCH)), grid, cfg, 0)
        branches.append(_search_parts(copies, m))
    if cfg.cohort == "historical_buyers":  # clients without any row in the windows belong to the cohort too
        markers = fan_out(buyers.withColumn("day", F.col("first_buy")), grid, back=None, ahead=0)
        branches.append(markers.select(*KEYS))

    parts = _union(branches)
    sums = m.of_future()
    for e in used:
        sums |= m.of_event(e)
        if e in details:
            sums |= _detail_aggregates(m, e)
    profile = aggregate(parts, KEYS, sums)
    public = _label_columns(m)
    if every_definition:
        public["cohort_bits"] = _bits([_cohort_filter(c, cfg) for c in COHORTS])
        public["churn_bits"] = _bits([_churn_rule(c, m) for c in CHURN_RULES])
    else:
        profile = profile.filter(_cohort_filter(cfg.cohort, cfg))
        public["churn"] = f"CASE WHEN {_churn_rule(cfg.churn, m)} THEN 1 ELSE 0 END"
    for e in ALL_EVENTS:
        if e in events:
            public |= _event_columns(m, e, e in details)
    if set(events) == set(ALL_EVENTS):
        words = [" | ".join(f"coalesce({e}_{c}, 0L)" for e in ALL_EVENTS) for c in m.past]
        public[f"active_days_{cfg.observation_days}d"] = _distinct_days(words)
    return project(profile, KEYS, public)


def _has_bit(column: str, names: dict, name: str) -> str:
    return f"{column} & {1 << list(names).index(name)} <> 0"


def of_definition(profile: DataFrame, cohort: str, churn: str) -> DataFrame:
    """The rows of one cohort with the label of one rule, as ``snapshot_profile`` makes them for that definition alone."""
    label = f"CASE WHEN {_has_bit('churn_bits', CHURN_RULES, churn)} THEN 1 ELSE 0 END AS churn"
    columns = [label if c == "churn_bits" else f"`{c}`" for c in profile.columns if c != "cohort_bits"]
    return profile.filter(_has_bit("cohort_bits", COHORTS, cohort)).selectExpr(*columns)


def definition_rates(profile: DataFrame) -> DataFrame:
    """Rows, churners and churn rate per snapshot under every cohort and churn rule, in one grouping of a profile with bits."""
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("cohort"), F.lit(r).alias("churn_rule"),
            F.expr(_has_bit("cohort_bits", COHORTS, c)).alias("member"), F.expr(_has_bit("churn_bits", CHURN_RULES, r)).cast("bigint").alias("churned"),
        )
        for c in COHORTS for r in CHURN_RULES
    ])
    each = profile.select("snapshot_date", F.explode(pairs).alias("d")).filter("d.member")
    return each.groupBy("d.cohort", "d.churn_rule", "snapshot_date").agg(
        F.count("*").alias("cohort_size"), F.sum("d.churned").alias("churned"), F.avg("d.churned").alias("churn_rate")
    )
