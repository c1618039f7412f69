"""Features computed from other features of the same row: trends and funnel ratios."""

from __future__ import annotations

from ebbline.config import ALL_EVENTS, BUY, CART, PAGE, REMOVE, SEARCH, ChurnConfig


def _safe_quotient(a: str, b: str) -> str:
    return f"coalesce(try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 0D)"


def trend_columns(cfg: ChurnConfig, events: tuple[str, ...] = ALL_EVENTS) -> dict[str, str]:
    """Share, rate difference and rate ratio of a short window against the rest of a longer one."""
    out = {}
    for event in events:
        for short, long in cfg.trend_pairs:
            rest = long - short
            recent, whole = f"{event}_count_{short}d", f"{event}_count_{long}d"
            recent_rate = f"({recent} / {short}D)"
            earlier_rate = f"(greatest({whole} - {recent}, 0L) / {rest}D)"
            out[f"{event}_recent_share_{short}d_{long}d"] = _safe_quotient(recent, whole)
            out[f"{event}_trend_delta_{short}d_vs_prev{rest}d"] = f"{recent_rate} - {earlier_rate}"
            out[f"{event}_trend_ratio_{short}d_vs_prev{rest}d"] = _safe_quotient(recent_rate, earlier_rate)
    return out


def funnel_columns(cfg: ChurnConfig) -> dict[str, str]:
    window = f"{cfg.observation_days}d"
    visits, carts, removals, buys, searches = (f"{e}_count_{window}" for e in (PAGE, CART, REMOVE, BUY, SEARCH))
    return {
        f"cart_per_visit_{window}": _safe_quotient(carts, visits),
        f"buy_per_cart_{window}": _safe_quotient(buys, carts),
        f"buy_per_visit_{window}": _safe_quotient(buys, visits),
        f"remove_per_cart_{window}": _safe_quotient(removals, carts),
        f"cart_abandon_gap_{window}": f"greatest({carts} - {buys}, 0L)",
        f"search_to_buy_gap_{window}": f"greatest({searches} - {buys}, 0L)",
    }
