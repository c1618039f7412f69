"""SQL for the registered queries, written naively from the definitions and run by another engine on the
same tables. It shares no code with the Spark plans: range joins, ``count(DISTINCT)``, plain windows."""

from __future__ import annotations

import math

STREAM = {"obs": 10, "label": 3, "step": 3, "recent": 2, "windows": (1, 3, 7, 10), "pairs": ((3, 10), (1, 7))}
EVENTS = ("page_visit", "add_to_cart", "remove_from_cart", "product_buy", "search_query")
PRODUCT_EVENTS = ("add_to_cart", "remove_from_cart", "product_buy")
ENGAGED = "('page_visit', 'add_to_cart', 'product_buy')"

# --- common table expressions over the event stream ----------------------------------------------

EV = """ev AS (
  SELECT user_id AS client_id, ts, CAST(ts AS DATE) AS d, props,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         CASE event_type WHEN 'purchase' THEN 'product_buy' WHEN 'click' THEN 'add_to_cart'
              WHEN 'error' THEN 'remove_from_cart' WHEN 'view' THEN 'page_visit' ELSE 'search_query' END AS event
  FROM events WHERE user_id IS NOT NULL AND event_type IN ('purchase', 'click', 'error', 'view', 'signup'))"""
ACT = "act AS (SELECT * FROM ev WHERE client_id IN (SELECT client_id FROM ev WHERE event = 'product_buy'))"
GRID = """grid AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 3 DAY)) AS DATE) AS s
  FROM (SELECT CAST(min(ts) AS DATE) + 10 AS lo, CAST(max(ts) AS DATE) - 3 AS hi FROM act))"""
SEEN = """seen AS (
  SELECT g.s, a.* FROM grid g JOIN act a ON a.ts >= g.s - INTERVAL 10 DAY AND a.ts < g.s)"""
LATER = """later AS (
  SELECT g.s, a.* FROM grid g JOIN act a ON a.ts >= g.s AND a.ts < g.s + INTERVAL 3 DAY)"""
PAST_BUYERS = "past_buyers AS (SELECT DISTINCT g.s, a.client_id FROM grid g JOIN act a ON a.event = 'product_buy' AND a.ts < g.s)"
ACTIVE = f"active AS (SELECT DISTINCT s, client_id FROM seen WHERE event IN {ENGAGED})"
COHORTS = {
    "historical_buyers": "SELECT s, client_id FROM past_buyers",
    "recently_active_buyers": "SELECT s, client_id FROM past_buyers INTERSECT SELECT s, client_id FROM active",
    "recent_engaged_buyers": f"""
  SELECT s, client_id FROM seen WHERE event = 'product_buy'
  INTERSECT SELECT s, client_id FROM seen WHERE event IN {ENGAGED} AND ts >= s - INTERVAL 2 DAY""",
}
BASE = [EV, ACT, GRID, SEEN, LATER, PAST_BUYERS, ACTIVE]
RULES = {
    "no_buy_in_label_window": "buys = 0",
    "no_buy_and_low_future_activity": "buys = 0 AND days <= 1",
}


def labels_cte(rule: str = "no_buy_in_label_window") -> str:
    return f"""labels AS (
  SELECT s, client_id, buys, days, CASE WHEN {RULES[rule]} THEN 1 ELSE 0 END AS churn
  FROM (SELECT c.s, c.client_id, count(*) FILTER (WHERE l.event = 'product_buy') AS buys,
               count(DISTINCT l.d) FILTER (WHERE l.event IN {ENGAGED}) AS days
        FROM cohort c LEFT JOIN later l ON l.s = c.s AND l.client_id = c.client_id GROUP BY c.s, c.client_id))"""


def wide_columns() -> list[str]:
    out = []
    for e in EVENTS:
        out += [
            f"count(*) FILTER (WHERE x.event = '{e}' AND x.ts >= c.s - INTERVAL {k} DAY) AS {e}_count_{k}d"
            for k in STREAM["windows"]
        ]
        out.append(
            f"coalesce(date_diff('day', max(x.d) FILTER (WHERE x.event = '{e}'), c.s), 11) AS {e}_recency_days"
        )
        if e != "search_query":
            out.append(f"count(DISTINCT x.d) FILTER (WHERE x.event = '{e}') AS {e}_days_10d")
    return out + ["count(DISTINCT x.d) AS active_days_10d"]


WIDE = f"""wide AS (
  SELECT c.s, c.client_id, {', '.join(wide_columns())}
  FROM cohort c LEFT JOIN seen x ON x.s = c.s AND x.client_id = c.client_id GROUP BY c.s, c.client_id)"""
WIDE_NAMES = [c.rsplit(" AS ", 1)[1] for c in wide_columns()]


def query(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def cohort_base(name: str = "recent_engaged_buyers", rule: str = "no_buy_in_label_window") -> list[str]:
    return [*BASE, f"cohort AS ({COHORTS[name]})", labels_cte(rule)]


TABLE = [*cohort_base(), WIDE]


# --- feature families ---------------------------------------------------------------------------


def product_cte(e: str) -> str:
    return f"""{e}_seen AS (
  SELECT x.s, x.client_id, x.k, p.p_size AS category, p.p_retailprice AS price
  FROM seen x LEFT JOIN part p ON p.p_partkey = x.k WHERE x.event = '{e}'),
{e}_shares AS (
  SELECT s, client_id, max(n) / sum(n) AS share
  FROM (SELECT s, client_id, category, count(*) AS n FROM {e}_seen WHERE category IS NOT NULL GROUP BY ALL)
  GROUP BY s, client_id),
{e}_detail AS (
  SELECT c.s, c.client_id, count(DISTINCT x.k) AS skus, count(DISTINCT x.category) AS categories,
         coalesce(avg(x.price), 0) AS price_mean, coalesce(max(x.price), 0) AS price_max,
         coalesce(sum(x.price), 0) AS price_sum, coalesce(any_value(h.share), 0) AS share
  FROM cohort c LEFT JOIN {e}_seen x ON x.s = c.s AND x.client_id = c.client_id
       LEFT JOIN {e}_shares h ON h.s = c.s AND h.client_id = c.client_id
  GROUP BY c.s, c.client_id)"""


PAGE_CTE = """page_detail AS (
  SELECT c.s, c.client_id, count(DISTINCT x.k) AS urls
  FROM cohort c LEFT JOIN seen x ON x.s = c.s AND x.client_id = c.client_id AND x.event = 'page_visit'
  GROUP BY c.s, c.client_id)"""


def search_cte(leak_safe: bool = False) -> str:
    guard = "AND x.d + 1 < x.s" if leak_safe else ""

    def flagged(e: str) -> str:
        days = f"(SELECT client_id, d FROM act WHERE event = '{e}')"
        return f"(x.client_id, x.d) IN {days} OR ((x.client_id, x.d + 1) IN {days} {guard})"

    return f"""search_seen AS (
  SELECT x.s, x.client_id, length(x.props) AS chars, len(string_split(trim(x.props), ' ')) AS words,
         {flagged('add_to_cart')} AS cart, {flagged('product_buy')} AS buy
  FROM seen x WHERE x.event = 'search_query'),
search_detail AS (
  SELECT c.s, c.client_id, coalesce(avg(x.chars), 0) AS chars, coalesce(avg(x.words), 0) AS words,
         count(*) FILTER (WHERE x.cart) AS to_cart, count(*) FILTER (WHERE x.buy) AS to_buy
  FROM cohort c LEFT JOIN search_seen x ON x.s = c.s AND x.client_id = c.client_id
  GROUP BY c.s, c.client_id)"""


def plain_names(e: str) -> list[str]:
    return [f"w.{e}_count_{k}d" for k in STREAM["windows"]] + [f"w.{e}_recency_days"]


def product_names(e: str) -> list[str]:
    d = f"{e}_detail"
    return [
        *plain_names(e),
        f"{d}.skus AS {e}_distinct_sku_10d",
        f"w.{e}_days_10d",
        f"{d}.categories AS {e}_distinct_category_10d",
        f"round({d}.price_mean, 8) AS {e}_price_mean_10d",
        f"round({d}.price_max, 8) AS {e}_price_max_10d",
        f"round({d}.price_sum, 8) AS {e}_price_sum_10d",
        f"round({d}.share, 8) AS {e}_top_category_share_10d",
    ]


PAGE_NAMES = [*plain_names("page_visit"), "w.page_visit_days_10d", "page_detail.urls AS page_visit_unique_url_10d"]
SEARCH_NAMES = [
    *plain_names("search_query"),
    "round(search_detail.chars, 8) AS search_query_avg_length_10d",
    "round(search_detail.words, 8) AS search_query_avg_word_count_10d",
    "search_detail.to_cart AS search_to_cart_1d_count_10d",
    "search_detail.to_buy AS search_to_buy_1d_count_10d",
]


def trend_names() -> list[str]:
    out = []
    for e in EVENTS:
        for short, long in STREAM["pairs"]:
            a, b, rest = f"w.{e}_count_{short}d", f"w.{e}_count_{long}d", long - short
            earlier = f"({b} - {a})"
            out += [
                f"round(CASE WHEN {b} = 0 THEN 0 ELSE {a} / {b} END, 8) AS {e}_recent_share_{short}d_{long}d",
                f"round({a} / {short} - {earlier} / {rest}, 8) AS {e}_trend_delta_{short}d_vs_prev{rest}d",
                f"round(CASE WHEN {earlier} = 0 THEN 0 ELSE ({a} / {short}) / ({earlier} / {rest}) END, 8)"
                f" AS {e}_trend_ratio_{short}d_vs_prev{rest}d",
            ]
    return out


def funnel_names() -> list[str]:
    def ratio(a: str, b: str, name: str) -> str:
        return f"round(CASE WHEN w.{b}_count_10d = 0 THEN 0 ELSE w.{a}_count_10d / w.{b}_count_10d END, 8) AS {name}_10d"

    def gap(a: str, name: str) -> str:
        return f"greatest(w.{a}_count_10d - w.product_buy_count_10d, 0) AS {name}_10d"

    return [
        ratio("add_to_cart", "page_visit", "cart_per_visit"),
        ratio("product_buy", "add_to_cart", "buy_per_cart"),
        ratio("product_buy", "page_visit", "buy_per_visit"),
        ratio("remove_from_cart", "add_to_cart", "remove_per_cart"),
        gap("add_to_cart", "cart_abandon_gap"),
        gap("search_query", "search_to_buy_gap"),
    ]


def from_wide(ctes: list[str], names: list[str], joins: tuple[str, ...] = ()) -> str:
    joined = " ".join(f"JOIN {j} USING (s, client_id)" for j in joins)
    return query([*TABLE, *ctes], f"SELECT s AS snapshot_date, client_id, {', '.join(names)} FROM wide w {joined}")


SPLITS = """dates AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT s FROM cohort)),
cuts AS (SELECT s, i, n, greatest(1, floor(n * 0.6)) AS a, greatest(greatest(1, floor(n * 0.6)) + 1, floor(n * 0.8)) AS b
  FROM dates),
splits AS (SELECT s, CASE WHEN i < a THEN 'train' WHEN i < CASE WHEN b >= n THEN n - 1 ELSE b END THEN 'valid' ELSE 'test' END AS split
  FROM cuts)"""


def table_names() -> list[str]:
    names = ["l.buys AS future_buy_count_3d", "l.days AS future_active_days_3d", "l.churn", *PAGE_NAMES]
    for e in PRODUCT_EVENTS:
        names += product_names(e)
    return [*names, *SEARCH_NAMES, "w.active_days_10d", "splits.split", *trend_names(), *funnel_names()]


def feature_columns() -> list[str]:
    """Columns that are neither keys, labels nor the split."""
    plain = [n.rsplit(" AS ", 1)[-1].rsplit(".", 1)[-1] for n in table_names()]
    return [n for n in plain if n not in ("future_buy_count_3d", "future_active_days_3d", "churn", "split")]


def feature_table_sql() -> str:
    names = table_names()
    ctes = [*TABLE, *[product_cte(e) for e in PRODUCT_EVENTS], PAGE_CTE, search_cte(), SPLITS]
    joins = ["labels l", *[f"{e}_detail" for e in PRODUCT_EVENTS], "page_detail", "search_detail"]
    joined = " ".join(f"JOIN {j} USING (s, client_id)" for j in joins)
    return query(
        ctes,
        f"SELECT s AS snapshot_date, client_id, {', '.join(names)} FROM wide w {joined} JOIN splits USING (s)",
    )


# --- predictions and metrics --------------------------------------------------------------------


def score_of(e: str) -> str:
    return f"CAST(w.{e}_recency_days AS DOUBLE) / (w.{e}_recency_days + w.{e}_count_10d + 1)"


PRED = f"""pred AS (
  SELECT w.s, w.client_id, l.churn AS y_true, {score_of('product_buy')} AS y_score, splits.split
  FROM wide w JOIN labels l USING (s, client_id) JOIN splits USING (s))"""
SCORED = [*TABLE, SPLITS, PRED]


def metric_ctes(source: str, group: str, suffix: str = "") -> list[str]:
    """``measured``: one row per group. AUC from average ranks, precision steps from plain windows."""
    ranked, main, levels, steps, measured = (n + suffix for n in ("ranked", "main", "levels", "steps", "measured"))
    return [
        f"""{ranked} AS (
  SELECT {group}, s, client_id, y_true, y_score,
         rank() OVER (PARTITION BY {group} ORDER BY y_score)
           + (count(*) OVER (PARTITION BY {group}, y_score) - 1) / 2 AS mid_rank,
         row_number() OVER (PARTITION BY {group} ORDER BY y_score DESC, client_id, s) AS place,
         count(*) OVER (PARTITION BY {group}) AS n
  FROM {source})""",
        f"""{main} AS (
  SELECT {group}, n, sum(y_true) AS p, sum(mid_rank) FILTER (WHERE y_true = 1) AS rank_sum,
         count(*) FILTER (WHERE y_score >= 0.5) AS targeted,
         count(*) FILTER (WHERE y_score >= 0.5 AND y_true = 1) AS hits,
         count(*) FILTER (WHERE y_true = 1 AND place <= greatest(1, floor(n * 0.1))) AS top_hits
  FROM {ranked} GROUP BY {group}, n)""",
        f"""{levels} AS (
  SELECT {group}, y_score, sum(y_true) AS pos,
         sum(sum(y_true)) OVER (PARTITION BY {group} ORDER BY y_score DESC) AS cum_pos,
         sum(count(*)) OVER (PARTITION BY {group} ORDER BY y_score DESC) AS cum_n
  FROM {source} GROUP BY {group}, y_score)""",
        f"""{steps} AS (
  SELECT {group}, coalesce(sum(pos * CAST(cum_pos AS DOUBLE) / cum_n) / nullif(sum(pos), 0), 0) AS ap
  FROM {levels} GROUP BY {group})""",
        f"""{measured} AS (
  SELECT {group}, CASE WHEN p > 0 AND p < n THEN (rank_sum - p * (p + 1) / 2) / (CAST(p AS DOUBLE) * (n - p)) END AS auc,
         ap AS pr_auc, coalesce(hits / nullif(targeted, 0), 0) AS precision, coalesce(hits / nullif(p, 0), 0) AS recall,
         coalesce(2 * hits / nullif(targeted + p, 0), 0) AS f1, top_hits / greatest(p, 1) AS top_10pct_churn_recall,
         p / n AS positive_rate
  FROM {main} JOIN {steps} USING ({group}))""",
    ]


METRICS = ("auc", "pr_auc", "precision", "recall", "f1", "top_10pct_churn_recall", "positive_rate")
ROUNDED_METRICS = ", ".join(f"round({m}, 8) AS {m}" for m in METRICS)


def split_source(split: str) -> str:
    return f"src AS (SELECT *, 0 AS g FROM pred WHERE split = '{split}')"


CANDIDATES = """candidates AS (
  SELECT DISTINCT round(t, 4) AS threshold
  FROM (SELECT i / 20 AS t FROM range(1, 20) r(i)
        UNION ALL
        SELECT unnest(quantile_cont(y_score, [0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99]))
        FROM pred WHERE split = 'valid')
  WHERE round(t, 4) > 0 AND round(t, 4) < 1)"""


def sweep_cte(name: str, source: str, measured: str) -> str:
    return f"""{name} AS (
  SELECT c.threshold, count(*) FILTER (WHERE y_score >= threshold) AS targeted_users,
         count(*) FILTER (WHERE y_score >= threshold) / count(*) AS targeted_share,
         m.auc, m.pr_auc,
         coalesce(count(*) FILTER (WHERE y_score >= threshold AND y_true = 1)
                  / nullif(count(*) FILTER (WHERE y_score >= threshold), 0), 0) AS precision,
         coalesce(count(*) FILTER (WHERE y_score >= threshold AND y_true = 1) / nullif(sum(y_true), 0), 0) AS recall,
         coalesce(2 * count(*) FILTER (WHERE y_score >= threshold AND y_true = 1)
                  / nullif(count(*) FILTER (WHERE y_score >= threshold) + sum(y_true), 0), 0) AS f1,
         m.top_10pct_churn_recall, m.positive_rate
  FROM {source} CROSS JOIN candidates c CROSS JOIN {measured} m
  GROUP BY c.threshold, m.auc, m.pr_auc, m.top_10pct_churn_recall, m.positive_rate)"""


SWEEP_NAMES = "threshold, targeted_users, round(targeted_share, 8) AS targeted_share, " + ROUNDED_METRICS
VALID_SWEEP = [*SCORED, split_source("valid"), *metric_ctes("src", "g"), CANDIDATES, sweep_cte("sweep", "src", "measured")]
BEST = "ORDER BY f1 DESC, recall DESC, precision DESC, threshold DESC LIMIT 1"


SUMMARY = [
    *VALID_SWEEP,
    "best AS (SELECT threshold AS chosen FROM sweep " + BEST + ")",
    "src_t AS (SELECT *, 0 AS g FROM pred WHERE split = 'test')",
    *metric_ctes("src_t", "g", "_t"),
    sweep_cte("test_sweep", "src_t", "measured_t"),
    """summary AS (
  SELECT *, 'threshold_0.50' AS strategy FROM test_sweep WHERE abs(threshold - 0.5) < 1e-6
  UNION ALL SELECT test_sweep.*, 'threshold_f1_opt' FROM test_sweep JOIN best ON abs(threshold - chosen) < 1e-6)""",
]
TOP_K = """top_k AS (
  SELECT pct AS top_k_pct, size AS targeted_users, captured AS captured_churn_users, captured / size AS churn_precision,
         captured / greatest(p, 1) AS churn_recall, (captured / size) / nullif(p / n, 0) AS lift_vs_base,
         score_sum / size AS avg_score, p / n AS baseline_churn_rate
  FROM (SELECT pct, CAST(greatest(1, floor(n * pct)) AS BIGINT) AS size, n, sum(y_true) AS p,
               count(*) FILTER (WHERE y_true = 1 AND place <= greatest(1, floor(n * pct))) AS captured,
               sum(y_score) FILTER (WHERE place <= greatest(1, floor(n * pct))) AS score_sum
        FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY y_score DESC, client_id, s) AS place
              FROM pred WHERE split = 'test')
             CROSS JOIN (SELECT unnest([0.01, 0.02, 0.05, 0.1, 0.2]::DOUBLE[]) AS pct)
        GROUP BY pct, n))"""
SCENARIOS = {
    "default": "('conservative', 0.5, 12, 120, 0.03), ('base', 0.5, 15, 180, 0.05), ('aggressive', 0.5, 18, 240, 0.08)",
    "realistic_ecommerce": (
        "('realistic_tight', 0.6, 20, 55, 0.01), ('realistic_base', 0.6, 22, 80, 0.02), "
        "('realistic_strong', 0.6, 28, 120, 0.03)"
    ),
}
TOP_K_STRATEGY = (
    "SELECT 'top_k' AS kind, 'top_' || CAST(round_even(top_k_pct * 100, 0) AS INTEGER) || 'pct' AS label, "
    "top_k_pct AS value, targeted_users AS users, churn_precision AS prec FROM top_k"
)
THRESHOLD_STRATEGY = (
    "SELECT 'threshold', printf('threshold_%.2f', threshold), threshold, targeted_users, precision FROM summary"
)


def roi_ctes(strategies: str, preset: str) -> list[str]:
    return [
        f"strategies AS ({strategies})",
        f"""scenarios AS (
  SELECT name, CAST(c AS DOUBLE) AS c, CAST(i AS DOUBLE) AS i, CAST(g AS DOUBLE) AS g, CAST(u AS DOUBLE) AS u
  FROM (VALUES {SCENARIOS[preset]}) v(name, c, i, g, u))""",
        """roi AS (
  SELECT kind AS strategy_kind, label AS strategy_label, value AS strategy_value, users AS targeted_users,
         prec AS churn_precision, name AS scenario, c AS contact_cost_per_user, i AS incentive_cost_per_saved_user,
         g AS gross_profit_per_saved_user, u AS uplift_on_true_churners, users * prec AS expected_true_churners,
         users * prec * u AS expected_saved_users, users * c AS expected_contact_cost,
         users * prec * u * i AS expected_incentive_cost, users * c + users * prec * u * i AS expected_total_cost,
         users * prec * u * g AS expected_gross_profit,
         users * prec * u * g - users * c - users * prec * u * i AS expected_net_profit,
         CASE WHEN users * c + users * prec * u * i > 0
              THEN (users * prec * u * g) / (users * c + users * prec * u * i) - 1 END AS expected_roi,
         users * c / greatest(g - i, 1e-9) AS break_even_saved_users
  FROM strategies CROSS JOIN scenarios)""",
    ]


ROI_NAMES = "strategy_kind, strategy_label, scenario, targeted_users, " + ", ".join(
    f"round({c}, 6) AS {c}"
    for c in (
        "strategy_value", "churn_precision", "contact_cost_per_user", "incentive_cost_per_saved_user",
        "gross_profit_per_saved_user", "uplift_on_true_churners", "expected_true_churners", "expected_saved_users",
        "expected_contact_cost", "expected_incentive_cost", "expected_total_cost", "expected_gross_profit",
        "expected_net_profit", "expected_roi", "break_even_saved_users",
    )
)


# --- errors -------------------------------------------------------------------------------------

ERRORS = """wrong AS (
  SELECT p.*, CASE WHEN y_true = 1 AND y_score < 0.5 THEN 'false_negative'
                   WHEN y_true = 0 AND y_score >= 0.5 THEN 'false_positive' ELSE 'correct' END AS error_type
  FROM pred p)"""
SEGMENTED = """positions AS (
  SELECT *, row_number() OVER (ORDER BY product_buy_count_10d, client_id, s) AS r, count(*) OVER () AS n,
         (SELECT least(4, count(DISTINCT product_buy_count_10d)) FROM wide) AS q
  FROM wrong JOIN wide USING (s, client_id)),
segmented AS (
  SELECT *, CASE WHEN q < 2 THEN 'unknown'
                 ELSE ['low', 'mid_low', 'mid_high', 'high'][CAST(greatest(ceil((r - 1) * q / (n - 1)), 1) AS INTEGER)]
            END AS value_segment
  FROM positions)"""


def means_sql(kind: str) -> str:
    one = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS m FROM bad" for c in ("y_score", *feature_columns())
    )
    bad = f"""bad AS (SELECT f.*, wrong.y_score FROM wrong JOIN ({feature_table_sql()}) f
  ON f.snapshot_date = wrong.s AND f.client_id = wrong.client_id WHERE error_type = '{kind}')"""
    return query([*SCORED, ERRORS, bad], f"SELECT feature, round(m, 6) AS mean_value FROM ({one}) WHERE m IS NOT NULL")


def worst_sql(kind: str) -> str:
    return query(
        [*SCORED, ERRORS],
        f"""SELECT s AS snapshot_date, client_id, y_true, round(y_score, 12) AS y_score, error_type, product_buy_count_10d
FROM wrong JOIN wide USING (s, client_id) WHERE error_type = '{kind}'
ORDER BY wrong.y_score DESC, client_id, s LIMIT 200""",
    )


# --- folds, sampling, comparison, histograms ------------------------------------------------------


def folds_cte(source: str) -> list[str]:
    return [
        f"numbered AS (SELECT s, row_number() OVER (ORDER BY s) AS i FROM (SELECT DISTINCT s FROM {source}))",
        """folds AS (
  SELECT CAST(t.i - 4 AS INTEGER) AS fold_id, t.i, v.s AS valid_date, t.s AS test_date
  FROM numbered t JOIN numbered v ON v.i = t.i - 1 WHERE t.i >= 5)""",
    ]


FOLDS_SELECT = """SELECT f.fold_id, string_agg(CAST(d.s AS VARCHAR), ',' ORDER BY d.s) AS train_dates, f.valid_date, f.test_date
FROM folds f JOIN numbered d ON d.i <= f.i - 2 GROUP BY ALL"""
ROLLING = [
    *SCORED,
    *folds_cte("cohort"),
    """members AS (
  SELECT fold_id, 'valid' AS split, p.* EXCLUDE (split) FROM folds JOIN pred p ON p.s = valid_date
  UNION ALL SELECT fold_id, 'test', p.* EXCLUDE (split) FROM folds JOIN pred p ON p.s = test_date)""",
    *metric_ctes("members", "fold_id, split"),
    """sizes AS (
  SELECT f.fold_id, f.valid_date, f.test_date, count(DISTINCT s) FILTER (WHERE d.i <= f.i - 2) AS train_snapshot_count,
         count(*) FILTER (WHERE d.i <= f.i - 2) AS train_rows, count(*) FILTER (WHERE d.i = f.i - 1) AS valid_rows,
         count(*) FILTER (WHERE d.i = f.i) AS test_rows
  FROM folds f CROSS JOIN pred p JOIN numbered d USING (s) GROUP BY ALL)""",
    """results AS (
  SELECT m.*, 'fixed_score' AS model, CAST(train_snapshot_count AS INTEGER) AS train_snapshot_count, train_rows, valid_rows,
         test_rows, CAST(valid_date AS VARCHAR) AS valid_snapshot_date, CAST(test_date AS VARCHAR) AS test_snapshot_date,
         CAST(CASE split WHEN 'valid' THEN valid_date ELSE test_date END AS VARCHAR) AS snapshot_date
  FROM measured m JOIN sizes USING (fold_id))""",
]


def uniform(seed: int, *keys: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


CAPPED = [
    *cohort_base(),
    f"""drawn AS (
  SELECT s, client_id, churn, u, row_number() OVER (PARTITION BY churn ORDER BY u, client_id, s) AS r,
         count(*) OVER (PARTITION BY churn) AS c, count(*) OVER () AS n
  FROM (SELECT *, {uniform(42, 'client_id', 's')} AS u FROM labels))""",
    """wanted AS (SELECT DISTINCT churn, c, n, greatest(1, round_even(300 * c / n, 0)) AS w FROM drawn),
quotas AS (
  SELECT a.churn, CAST(least(a.w, a.c, 300 - coalesce(sum(b.w), 0)) AS BIGINT) AS quota
  FROM wanted a LEFT JOIN wanted b ON b.churn < a.churn GROUP BY a.churn, a.w, a.c),
first AS (SELECT d.* FROM drawn d JOIN quotas q USING (churn) WHERE d.n <= 300 OR r <= quota),
rest AS (SELECT d.* FROM drawn d ANTI JOIN first USING (s, client_id)),
kept AS (
  SELECT s, client_id, churn FROM first
  UNION ALL
  (SELECT s, client_id, churn FROM (SELECT *, row_number() OVER (ORDER BY u, client_id, s) AS z FROM rest)
   WHERE z <= 300 - (SELECT count(*) FROM first)))""",
]


def comparison_sql() -> str:
    cohorts = "\n  UNION ALL ".join(f"SELECT '{n}' AS prefix, s, client_id FROM ({text})" for n, text in COHORTS.items())
    details = {
        "historical_buyers": "user had at least one product_buy before the snapshot",
        "recently_active_buyers": (
            "user had at least one product_buy before the snapshot and at least one "
            "page_visit/add_to_cart/product_buy in the observation window"
        ),
        "recent_engaged_buyers": (
            "user had at least one product_buy in the observation window and at least one "
            "page_visit/add_to_cart/product_buy in the last 2 days before the snapshot"
        ),
    }
    texts = ", ".join(f"('{n}', '{t}')" for n, t in details.items())

    def scored(model: str, e: str) -> str:
        return f"SELECT prefix, s, client_id, y_true, split, '{model}' AS model, {score_of(e)} AS y_score FROM joined w"

    ctes = [
        *BASE,
        f"cohorts AS ({cohorts})",
        # the features do not depend on the cohort, so they are computed once for the widest one
        f"cohort AS ({COHORTS['historical_buyers']})",
        labels_cte(),
        WIDE,
        """dates AS (SELECT prefix, s, row_number() OVER (PARTITION BY prefix ORDER BY s) - 1 AS i,
  count(*) OVER (PARTITION BY prefix) AS n FROM (SELECT DISTINCT prefix, s FROM cohorts)),
splits AS (SELECT prefix, s, CASE WHEN i < floor(n * 0.6) THEN 'train' WHEN i < floor(n * 0.8) THEN 'valid' ELSE 'test' END AS split
  FROM dates)""",
        """joined AS (
  SELECT x.prefix, w.*, l.churn AS y_true, splits.split
  FROM cohorts x JOIN wide w USING (s, client_id) JOIN labels l USING (s, client_id)
       JOIN splits ON splits.prefix = x.prefix AND splits.s = x.s)""",
        f"pred AS ({scored('buy_score', 'product_buy')} UNION ALL {scored('page_score', 'page_visit')})",
        *metric_ctes("pred", "prefix, model, split"),
        """best AS (SELECT * FROM measured WHERE split = 'valid'
  QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY pr_auc DESC, auc DESC, f1 DESC, model) = 1)""",
        f"texts AS (SELECT * FROM (VALUES {texts}) v(prefix, detail))",
    ]
    return query(
        ctes,
        f"""SELECT t.prefix, t.prefix AS active_user_definition, t.detail AS active_user_definition_detail,
  'no_buy_in_label_window' AS churn_definition,
  'user is churned if there is no product_buy in the next label window' AS churn_definition_detail,
  (SELECT count(*) FROM cohorts x WHERE x.prefix = t.prefix) AS row_count, CAST({len(table_names()) + 2} AS BIGINT) AS feature_count,
  (SELECT count(*) FROM grid) AS snapshot_count,
  b.model AS best_valid_model, round(b.auc, 8) AS valid_auc, round(b.pr_auc, 8) AS valid_pr_auc, round(b.f1, 8) AS valid_f1,
  r.model AS test_refit_model, round(r.auc, 8) AS test_refit_auc, round(r.pr_auc, 8) AS test_refit_pr_auc,
  round(r.f1, 8) AS test_refit_f1, round(r.positive_rate, 8) AS test_positive_rate
FROM texts t JOIN best b USING (prefix)
     JOIN measured r ON r.prefix = t.prefix AND r.model = b.model AND r.split = 'test'""",
    )


def histogram_sql(column: str) -> str:
    return query(
        [*TABLE, f"ends AS (SELECT min({column}) AS lo, max({column}) AS hi FROM wide)"],
        f"""SELECT CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 30, 8) AS bin_start,
  round(lo + (b + 1) * (hi - lo) / 30, 8) AS bin_end,
  (SELECT count(*) FROM wide WHERE least(29, floor(({column} - lo) * 30 / (hi - lo))) = b) AS n_rows
FROM ends CROSS JOIN range(30) r(b)""",
    )


# --- orders -------------------------------------------------------------------------------------

ORDERS = [
    """act AS (SELECT o_custkey AS client_id, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS d, l_partkey AS k, 'product_buy' AS event
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""",
    """grid AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 180 DAY)) AS DATE) AS s
  FROM (SELECT CAST(min(ts) AS DATE) + 365 AS lo, CAST(max(ts) AS DATE) - 180 AS hi FROM act))""",
    "seen AS (SELECT g.s, a.* FROM grid g JOIN act a ON a.ts >= g.s - INTERVAL 365 DAY AND a.ts < g.s)",
    "later AS (SELECT g.s, a.* FROM grid g JOIN act a ON a.ts >= g.s AND a.ts < g.s + INTERVAL 180 DAY)",
    "firsts AS (SELECT client_id, min(ts) AS first_ts FROM act GROUP BY client_id)",
    "cohort AS (SELECT g.s, f.client_id FROM grid g JOIN firsts f ON f.first_ts < g.s)",
    labels_cte(),
]


def orders_features_sql() -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE x.ts >= c.s - INTERVAL {k} DAY) AS product_buy_count_{k}d" for k in (30, 90, 180, 365)
    )
    wide = f"""wide AS (
  SELECT c.s, c.client_id, {counts}, coalesce(date_diff('day', max(x.d), c.s), 366) AS product_buy_recency_days,
         count(DISTINCT x.d) AS product_buy_days_365d
  FROM cohort c LEFT JOIN seen x ON x.s = c.s AND x.client_id = c.client_id GROUP BY c.s, c.client_id)"""
    names = [n.replace("_10d", "_365d").replace(", 8)", ", 6)") for n in product_names("product_buy")[5:]]
    names = [f"w.product_buy_count_{k}d" for k in (30, 90, 180, 365)] + ["w.product_buy_recency_days", *names]
    return query(
        [*ORDERS, wide, product_cte("product_buy")],
        f"SELECT s AS snapshot_date, client_id, l.churn, {', '.join(names)} FROM wide w JOIN labels l USING (s, client_id) "
        "JOIN product_buy_detail USING (s, client_id)",
    )


def churn_rates(ctes: list[str]) -> str:
    return query(
        ctes,
        """SELECT s AS snapshot_date, count(*) AS cohort_size, CAST(sum(churn) AS BIGINT) AS churned,
  round(avg(churn), 8) AS churn_rate FROM labels GROUP BY s""",
    )


def labels_sql(rule: str) -> str:
    return query(
        cohort_base(rule=rule),
        "SELECT s AS snapshot_date, client_id, buys AS future_buy_count_3d, days AS future_active_days_3d, churn FROM labels",
    )


def definitions_sql() -> str:
    """Each cohort with each churn rule, one after another."""
    cohorts = "\n  UNION ALL ".join(f"SELECT '{n}' AS cohort, s, client_id FROM ({text})" for n, text in COHORTS.items())
    rules = " UNION ALL ".join(f"SELECT '{n}' AS churn_rule, s, client_id, CASE WHEN {rule} THEN 1 ELSE 0 END AS churn FROM labels" for n, rule in RULES.items())
    return query(
        [*BASE, f"cohort AS ({COHORTS['historical_buyers']})", labels_cte(), f"cohorts AS ({cohorts})", f"rules AS ({rules})"],
        """SELECT cohort, churn_rule, s AS snapshot_date, count(*) AS cohort_size, CAST(sum(churn) AS BIGINT) AS churned,
  round(avg(churn), 8) AS churn_rate FROM cohorts JOIN rules USING (s, client_id) GROUP BY ALL""",
    )


def cohort_sql(name: str) -> str:
    return query([*BASE, f"cohort AS ({COHORTS[name]})"], "SELECT s AS snapshot_date, client_id FROM cohort")


ORACLES = {
    "activity_daily_rollup": query(
        [EV],
        """SELECT client_id, event, d AS day,
  CASE WHEN event IN ('product_buy', 'add_to_cart', 'remove_from_cart') THEN k END AS sku,
  CASE WHEN event = 'page_visit' THEN k END AS url, count(*) AS n,
  count(*) FILTER (WHERE event = 'search_query') AS n_text,
  CAST(sum(CASE WHEN event = 'search_query' THEN length(props) END) AS BIGINT) AS text_chars,
  CAST(sum(CASE WHEN event = 'search_query' THEN len(string_split(trim(props), ' ')) ELSE 0 END) AS BIGINT) AS text_words
FROM ev GROUP BY ALL""",
    ),
    "client_active_days": query([EV], "SELECT DISTINCT client_id, d AS day FROM ev"),
    "clean_page_log": query([EV], "SELECT client_id, ts AS timestamp, k AS url FROM ev WHERE event = 'page_visit'"),
    "clean_product_table": (
        "SELECT p_partkey AS sku, CAST(min(p_size) AS BIGINT) AS category, min(p_retailprice) AS price FROM part GROUP BY p_partkey"
    ),
    "client_sample": query(
        [EV],
        f"SELECT client_id, count(*) AS n_events FROM ev WHERE {uniform(42, 'client_id')} < {int(0.3 * (1 << 52))} GROUP BY client_id",
    ),
    "buyer_event_counts": query([EV, ACT], "SELECT event, count(*) AS n_events FROM act GROUP BY event"),
    "search_day_conversions": query(
        [EV],
        """SELECT x.client_id, x.d AS day, count(*) AS search_count,
  CASE WHEN EXISTS (SELECT 1 FROM ev c WHERE c.event = 'add_to_cart' AND c.client_id = x.client_id AND (c.d = x.d OR c.d = x.d + 1))
       THEN count(*) ELSE 0 END AS search_to_cart_1d_count,
  CASE WHEN EXISTS (SELECT 1 FROM ev c WHERE c.event = 'product_buy' AND c.client_id = x.client_id AND (c.d = x.d OR c.d = x.d + 1))
       THEN count(*) ELSE 0 END AS search_to_buy_1d_count
FROM ev x WHERE x.event = 'search_query' GROUP BY x.client_id, x.d""",
    ),
    "event_volume": query([EV], "SELECT event, count(*) AS n_rows FROM ev GROUP BY event"),
    "dataset_bounds": query([EV, ACT], "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM act"),
    "snapshot_grid": query([EV, ACT, GRID], "SELECT s AS snapshot_date FROM grid"),
    "cohort_historical_buyers": cohort_sql("historical_buyers"),
    "cohort_recently_active": cohort_sql("recently_active_buyers"),
    "cohort_recent_engaged": cohort_sql("recent_engaged_buyers"),
    "labels_no_buy": labels_sql("no_buy_in_label_window"),
    "labels_strict": labels_sql("no_buy_and_low_future_activity"),
    "churn_rate_by_snapshot": churn_rates(cohort_base()),
    **{f"features_{e}": from_wide([product_cte(e)], product_names(e), (f"{e}_detail",)) for e in PRODUCT_EVENTS},
    "features_page_visit": from_wide([PAGE_CTE], PAGE_NAMES, ("page_detail",)),
    "features_search": from_wide([search_cte()], SEARCH_NAMES, ("search_detail",)),
    "features_search_leak_safe": from_wide([search_cte(True)], SEARCH_NAMES, ("search_detail",)),
    "features_active_days": from_wide([], ["w.active_days_10d"]),
    "features_trend": from_wide([], trend_names()),
    "features_funnel": from_wide([], funnel_names()),
    "feature_table": feature_table_sql(),
    "run_metadata": query(
        cohort_base(),
        """SELECT 'events' AS dataset_root, CAST(10 AS BIGINT) AS observation_days, CAST(3 AS BIGINT) AS label_days,
  '1,3,7,10' AS window_days, CAST(3 AS BIGINT) AS snapshot_step_days, CAST(NULL AS BIGINT) AS max_snapshots,
  CAST(NULL AS DOUBLE) AS sample_frac, (SELECT count(*) FROM grid) AS snapshot_count, count(*) AS row_count,
  CAST(95 AS BIGINT) AS feature_count, 'recent_engaged_buyers' AS active_user_definition,
  'user had at least one product_buy in the observation window and at least one page_visit/add_to_cart/product_buy in the last 2 days before the snapshot'
    AS active_user_definition_detail, 'no_buy_in_label_window' AS churn_definition,
  'user is churned if there is no product_buy in the next label window' AS churn_definition_detail FROM labels""",
    ),
    "time_split_sizes": query(
        SCORED,
        """SELECT split, count(DISTINCT s) AS n_snapshots, min(s) AS first_snapshot, max(s) AS last_snapshot,
  count(*) AS n_rows, CAST(sum(y_true) AS BIGINT) AS n_churned FROM pred GROUP BY split""",
    ),
    "stratified_cap_counts": query(CAPPED, "SELECT churn, count(*) AS n_rows FROM kept GROUP BY churn"),
    "stratified_cap_rows": query(CAPPED, "SELECT s AS snapshot_date, client_id, churn FROM kept"),
    "binary_metrics": query(
        [*SCORED, "src AS (SELECT *, 0 AS g FROM pred)", *metric_ctes("src", "g")], f"SELECT {ROUNDED_METRICS} FROM measured"
    ),
    "binary_metrics_by_snapshot": query(
        [*SCORED, "src AS (SELECT *, s AS g FROM pred)", *metric_ctes("src", "g")],
        f"SELECT g AS snapshot_date, {ROUNDED_METRICS} FROM measured",
    ),
    "prediction_frame": query(
        [*SCORED, ERRORS],
        """SELECT client_id, s AS snapshot_date, y_true, round(y_score, 12) AS y_score,
  CASE WHEN y_score >= 0.5 THEN 1 ELSE 0 END AS y_pred, error_type FROM wrong""",
    ),
    "error_profile": query(
        [*SCORED, ERRORS, SEGMENTED],
        """SELECT error_type, value_segment, count(*) AS users, round(avg(y_score), 8) AS avg_score,
  round(avg(product_buy_count_10d), 8) AS avg_buy_count_10d, round(avg(active_days_10d), 8) AS avg_active_days_10d
FROM segmented GROUP BY error_type, value_segment""",
    ),
    "false_positive_feature_means": means_sql("false_positive"),
    "false_negative_feature_means": means_sql("false_negative"),
    "worst_false_positives": worst_sql("false_positive"),
    "worst_false_negatives": worst_sql("false_negative"),
    "threshold_candidates": query([*SCORED, CANDIDATES], "SELECT threshold FROM candidates"),
    "threshold_sweep": query(VALID_SWEEP, f"SELECT {SWEEP_NAMES} FROM sweep"),
    "best_threshold": query(VALID_SWEEP, f"SELECT {SWEEP_NAMES} FROM (SELECT * FROM sweep {BEST})"),
    "threshold_summary": query(SUMMARY, f"SELECT strategy, {SWEEP_NAMES} FROM summary"),
    "top_k_strategy": query(
        [*SCORED, TOP_K],
        """SELECT top_k_pct, targeted_users, captured_churn_users, round(churn_precision, 8) AS churn_precision,
  round(churn_recall, 8) AS churn_recall, round(lift_vs_base, 8) AS lift_vs_base, round(avg_score, 8) AS avg_score,
  round(baseline_churn_rate, 8) AS baseline_churn_rate FROM top_k""",
    ),
    "roi_simulation": query(
        [*SUMMARY, TOP_K, *roi_ctes(f"{TOP_K_STRATEGY} UNION ALL {THRESHOLD_STRATEGY}", "default")], f"SELECT {ROI_NAMES} FROM roi"
    ),
    "roi_simulation_realistic": query(
        [*SUMMARY, TOP_K, *roi_ctes(f"{TOP_K_STRATEGY} UNION ALL {THRESHOLD_STRATEGY}", "realistic_ecommerce")],
        f"SELECT {ROI_NAMES} FROM roi",
    ),
    "roi_best_strategies": query(
        [*SUMMARY, TOP_K, *roi_ctes(f"{TOP_K_STRATEGY} UNION ALL {THRESHOLD_STRATEGY}", "default")],
        f"""SELECT {ROI_NAMES} FROM (SELECT * FROM roi QUALIFY row_number() OVER
  (PARTITION BY scenario ORDER BY expected_net_profit DESC, expected_roi DESC, strategy_kind, strategy_label) <= 3)""",
    ),
    "rolling_folds": query([*cohort_base(), *folds_cte("cohort")], FOLDS_SELECT),
    "rolling_metrics": query(
        ROLLING,
        f"""SELECT fold_id, model, split, train_snapshot_count, train_rows, valid_rows, test_rows, valid_snapshot_date,
  test_snapshot_date, snapshot_date, {ROUNDED_METRICS} FROM results""",
    ),
    "rolling_backtest": query(
        ROLLING,
        """SELECT fold_id, m.model, split, train_rows, valid_rows, test_rows, round(positive_rate, 8) AS positive_rate, true AS in_range
FROM results, (VALUES ('logistic_regression'), ('random_forest'), ('boosted_balanced'), ('boosted_subsampled')) m(model)""",
    ),
    # one coefficient for each input and one for the constant
    "logistic_optimality": query(
        [*TABLE, SPLITS],
        f"""SELECT CAST({len(feature_columns()) + 1} AS BIGINT) AS n_coefficients, true AS optimal, count(*) AS n_rows,
  CAST(sum(churn) AS BIGINT) AS positives FROM labels JOIN splits USING (s) WHERE split = 'train'""",
    ),
    "rolling_summary": query(
        ROLLING,
        """SELECT model, split, count(DISTINCT fold_id) AS folds, round(avg(auc), 8) AS auc_mean, round(stddev_samp(auc), 8) AS auc_std,
  round(avg(pr_auc), 8) AS pr_auc_mean, round(stddev_samp(pr_auc), 8) AS pr_auc_std, round(avg(f1), 8) AS f1_mean,
  round(stddev_samp(f1), 8) AS f1_std, round(avg(top_10pct_churn_recall), 8) AS top_10pct_churn_recall_mean,
  round(avg(positive_rate), 8) AS positive_rate_mean FROM results GROUP BY model, split""",
    ),
    "run_comparison": comparison_sql(),
    "definition_rates": definitions_sql(),
    "event_volume_footers": query([EV], "SELECT event, count(*) AS n_rows FROM ev GROUP BY event"),
    "cleaned_logs_by_view": query(
        [EV],
        """SELECT event, count(*) AS n_rows, count(DISTINCT client_id) AS n_clients, count(DISTINCT d) AS n_days,
  CASE WHEN event = 'search_query' THEN count(props) ELSE count(*) FILTER (WHERE event = 'page_visit' OR k IS NOT NULL) END AS n_values
FROM ev WHERE ts IS NOT NULL GROUP BY event""",
    ),
    "text_times": """SELECT count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 11 <> 0) AS n_times,
  count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 11 = 0) AS n_missing, count(*) FILTER (WHERE event_id % 7 = 0) AS n_unreadable,
  CAST(min(ts) FILTER (WHERE event_id % 7 <> 0 AND event_id % 11 <> 0) AS DATE) AS first_day,
  CAST(max(ts) FILTER (WHERE event_id % 7 <> 0 AND event_id % 11 <> 0) AS DATE) AS last_day FROM events""",
    "snapshot_rewrite": query(
        [*TABLE, SPLITS],
        """SELECT s AS snapshot_date, client_id, active_days_10d + CASE WHEN s = (SELECT s FROM grid ORDER BY s OFFSET 1 LIMIT 1) THEN 100 ELSE 0 END
  AS active_days_10d, churn, split FROM wide JOIN labels USING (s, client_id) JOIN splits USING (s)""",
    ),
    "damaged_predictions": query(
        SCORED,
        """SELECT count(*) FILTER (WHERE client_id % 5 <> 0) AS n_good, count(*) FILTER (WHERE client_id % 5 = 0) AS n_bad,
  CAST(sum(y_true) FILTER (WHERE client_id % 5 <> 0) AS BIGINT) AS positives, round(sum(y_score) FILTER (WHERE client_id % 5 <> 0), 6) AS score_sum
FROM pred""",
    ),
    "active_days_histogram": histogram_sql("active_days_10d"),
    "buy_count_histogram": histogram_sql("product_buy_count_10d"),
    "label_distribution": query(cohort_base(), "SELECT churn, count(*) AS n_rows FROM labels GROUP BY churn"),
    "vector_text_parse": """SELECT vec_id, len(v) AS n_values, round(list_sum(v), 6) AS value_sum, round(list_max(v), 8) AS value_max
FROM (SELECT vec_id, CAST(CAST(CAST(embedding AS DOUBLE[]) AS VARCHAR) AS DOUBLE[]) AS v
      FROM embeddings)""",
    "orders_cohort_sizes": churn_rates(ORDERS),
    "orders_buy_features": orders_features_sql(),
    "orders_rolling_folds": query([*ORDERS, *folds_cte("cohort")], FOLDS_SELECT),
}



def bootstraps_sql(parts: int) -> str:
    """Poisson draws of the train rows from the hash of each bootstrap, and the classes' weights."""
    keys = " UNION ALL ".join(f"SELECT {p} AS part, churn, {uniform(43 + p, 'client_id', 's')} AS u FROM train" for p in range(parts))
    total, bounds = 0.0, []
    for k in range(13):
        total += math.exp(-1) / math.factorial(k)
        bounds.append(int(total * (1 << 52)))
    draws = " + ".join(f"CAST(u >= {bound} AS INTEGER)" for bound in bounds)
    train = "train AS (SELECT client_id, s, churn FROM labels JOIN splits USING (s) WHERE split = 'train')"
    drawn = f"drawn AS (SELECT part, churn, {draws} AS n FROM ({keys}))"
    return query(
        [*TABLE, SPLITS, train, drawn],
        """SELECT part, churn, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_draws,
  round(CAST(sum(sum(n)) OVER (PARTITION BY part) AS DOUBLE) / count(*) OVER (PARTITION BY part), 6) AS weight_sum
FROM drawn WHERE n > 0 GROUP BY part, churn""",
    )


ORACLES |= {
    "bootstrap_weights": bootstraps_sql(10),
    "boosted_leaf_values": query(
        [*TABLE, SPLITS],
        """SELECT CAST(tree AS INTEGER) AS tree, count(*) AS n_rows, CAST(sum(churn) AS BIGINT) AS positives, true AS optimal
FROM labels JOIN splits USING (s) CROSS JOIN range(5) trees(tree) WHERE split = 'train' GROUP BY tree""",
    ),
}

# Other physical plans of the same results.
ORACLES |= {
    "binary_metrics_in_cells": ORACLES["binary_metrics"],
    "top_k_big_ids": ORACLES["top_k_strategy"],
    "error_profile_in_cells": ORACLES["error_profile"],
    "feature_table_salted": ORACLES["feature_table"],
    "feature_table_stored": ORACLES["feature_table"],
    "rank_with_nulls": """SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY v NULLS FIRST, event_id DESC) AS place
FROM (SELECT event_type, event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'NaN'::DOUBLE ELSE round(value) END AS v
      FROM events)""",
    "training_class_weights": f"""SELECT churn, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (2 * count(*)), 8) AS weight, count(*) AS n_rows
FROM ({feature_table_sql()}) WHERE split = 'train' GROUP BY churn""",
    "model_inputs": f"WITH t AS (SELECT * FROM ({feature_table_sql()}) WHERE split = 'train') "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(coalesce({c}, 0)), 6) AS mean, round(stddev_samp(coalesce({c}, 0)), 6) AS deviation FROM t"
        for c in feature_columns()
    ),
    "model_scored_rows": f"""SELECT model, split, count(*) AS n_rows, CAST(sum(churn) AS BIGINT) AS positives, count(*) AS n_probabilities
FROM ({feature_table_sql()}) CROSS JOIN (SELECT unnest(['logistic_regression', 'random_forest', 'boosted_balanced', 'boosted_subsampled']) AS model)
WHERE split IN ('valid', 'test') GROUP BY model, split""",
}
