"""Small hand-made logs and a brute-force reading of the definitions, in plain Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

from ebbline.config import ALL_EVENTS, BUY, CART, PAGE, PRODUCT_EVENTS, SEARCH
from ebbline.sources.logs import ACTIVITY_SCHEMA, PRODUCT_SCHEMA

START = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)
ENGAGED = (BUY, CART, PAGE)


def at(day: float, micros: int = 0) -> dt.datetime:
    return START + day * DAY + dt.timedelta(microseconds=micros)


def row(client, ts, event, item=None):
    sku = item if event in PRODUCT_EVENTS else None
    url = item if event == PAGE else None
    return (client, ts, event, sku, url, item if event == SEARCH else None)


def activity_frame(spark, rows):
    return spark.createDataFrame(rows, ACTIVITY_SCHEMA)


def product_frame(spark, rows):
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


def random_rows(seed: int, n_clients: int = 12, n_rows: int = 900, days: int = 60, hot: bool = False):
    rng = random.Random(seed)
    rows = []
    for i in range(n_rows):
        client = 1 if hot and i % 3 == 0 else rng.randint(1, n_clients)
        event = rng.choice(ALL_EVENTS)
        ts = None if rng.random() < 0.02 else at(rng.randint(0, days - 1), rng.choice([0, 1, 43_200_000_000, 86_399_999_999]))
        if event == SEARCH:
            item = rng.choice(["red  shoes", "hat", " big blue bag ", "", "   ", None])
        elif event == PAGE:
            item = rng.choice([None, *range(5)])
        else:
            item = rng.randint(1, 9)
        rows.append(row(client, ts, event, item))
    # every log covers the whole span, and client 99 never buys
    rows += [row(1, at(0), BUY, 1), row(1, at(days - 1), BUY, 2), row(99, at(3), PAGE, 1), row(99, at(4), CART, 1)]
    return rows


PRODUCTS = [(1, 10, 5.0), (2, 10, 7.5), (3, 11, None), (4, None, 2.0), (5, 12, 1.25), (6, 12, 9.0), (7, 11, 3.0)]


def words(text):
    trimmed = (text or "").strip(" ")
    return 0 if not trimmed else 1 + trimmed.count(" ")


def brute_force(rows, products, cfg, dates):
    """Feature rows as dictionaries, computed event by event."""
    prices = {sku: (category, price) for sku, category, price in products}
    obs = cfg.observation_days
    by_client = defaultdict(list)
    for client, ts, event, sku, url, query in rows:
        if ts is not None:
            by_client[client].append((ts, event, sku if event in PRODUCT_EVENTS else url, query))
    out = {}
    for s_date in dates:
        s = dt.datetime.combine(s_date, dt.time())
        for client, events in by_client.items():
            past = [e for e in events if s - obs * DAY <= e[0] < s]
            future = [e for e in events if s <= e[0] < s + cfg.label_days * DAY and e[1] in ENGAGED]
            ever = any(e[1] == BUY and e[0] < s for e in events)
            recent = [e for e in past if e[1] in ENGAGED and e[0] >= s - cfg.recent_days * DAY]
            member = {
                "historical_buyers": ever,
                "recently_active_buyers": ever and any(e[1] in ENGAGED for e in past),
                "recent_engaged_buyers": any(e[1] == BUY for e in past) and bool(recent),
            }[cfg.cohort]
            if not member:
                continue
            f = {}
            buys = sum(e[1] == BUY for e in future)
            active = len({e[0].date() for e in future})
            f[f"future_buy_count_{cfg.label_days}d"], f[f"future_active_days_{cfg.label_days}d"] = buys, active
            low = cfg.churn == "no_buy_in_label_window" or active <= cfg.low_activity_days
            f["churn"] = int(buys == 0 and low)
            f[f"active_days_{obs}d"] = len({e[0].date() for e in past})
            for name in ALL_EVENTS:
                own = [e for e in past if e[1] == name]
                for k in cfg.windows:
                    f[f"{name}_count_{k}d"] = sum(e[0] >= s - k * DAY for e in own)
                last = max((e[0].date() for e in own), default=None)
                f[f"{name}_recency_days"] = (s_date - last).days if last else obs + 1
                if name == SEARCH:
                    f |= search_features(own, events, s, obs, cfg.leak_safe)
                    continue
                f[f"{name}_days_{obs}d"] = len({e[0].date() for e in own})
                if name == PAGE:
                    f[f"{name}_unique_url_{obs}d"] = len({e[2] for e in own if e[2] is not None})
                    continue
                found = [prices.get(e[2], (None, None)) for e in own]
                categories = Counter(c for c, _ in found if c is not None)
                known = [p for _, p in found if p is not None]
                f[f"{name}_distinct_sku_{obs}d"] = len({e[2] for e in own})
                f[f"{name}_distinct_category_{obs}d"] = len(categories)
                f[f"{name}_price_mean_{obs}d"] = sum(known) / len(known) if known else 0.0
                f[f"{name}_price_max_{obs}d"] = max(known, default=0.0)
                f[f"{name}_price_sum_{obs}d"] = float(sum(known))
                top = max(categories.values(), default=0)
                f[f"{name}_top_category_share_{obs}d"] = top / sum(categories.values()) if top else 0.0
            out[(s_date, client)] = f
    return out


def search_features(own, events, s, obs, leak_safe):
    days = defaultdict(list)
    for ts, _, _, query in own:
        days[ts.date()].append(query)
    chars = 0.0
    for queries in days.values():
        texts = [q for q in queries if q is not None]
        if texts:
            chars += len(queries) * sum(map(len, texts)) / len(texts)
    n = len(own)

    def converted(event):
        kind = {e[0].date() for e in events if e[1] == event}

        def hit(day):
            after = day + DAY
            return day in kind or (after in kind and not (leak_safe and after >= s.date()))

        return sum(len(q) for day, q in days.items() if hit(day))

    return {
        f"{SEARCH}_avg_length_{obs}d": chars / n if n else 0.0,
        f"{SEARCH}_avg_word_count_{obs}d": sum(words(e[3]) for e in own) / n if n else 0.0,
        f"search_to_cart_1d_count_{obs}d": converted(CART),
        f"search_to_buy_1d_count_{obs}d": converted(BUY),
    }


