"""Landed payload fixtures (FIXTURES.md §1) written as JSON files by the tests."""

import json
import os


def equity_payload(days: dict[str, tuple]) -> dict:
    return {"Meta Data": {"2. Symbol": "X"},
            "Time Series (Daily)": {d: {"1. open": str(o), "2. high": str(h), "3. low": str(lo),
                                        "4. close": str(c), "5. volume": str(v)}
                                    for d, (o, h, lo, c, v) in days.items()}}


def coin(cid, cap, rank, last_updated, roi=None, price=1.0, **extra):
    rec = {"id": cid, "symbol": cid[:3], "name": cid.title(), "image": "http://x/img.png",
           "current_price": price, "market_cap": cap, "market_cap_rank": rank,
           "fully_diluted_valuation": None, "total_volume": 10.0, "high_24h": price * 1.1,
           "low_24h": price * 0.9, "price_change_24h": 0.1, "price_change_percentage_24h": 2.5,
           "market_cap_change_24h": 1.0, "market_cap_change_percentage_24h": 0.5,
           "circulating_supply": 100.0, "total_supply": 100.0, "max_supply": None,
           "ath": price * 2, "ath_change_percentage": -50.0, "ath_date": "2021-11-10T14:24:11.849Z",
           "atl": price / 2, "atl_change_percentage": 100.0, "atl_date": "2015-10-20T00:00:00.000Z",
           "roi": roi, "last_updated": last_updated}
    rec.update(extra)
    return rec


def write_json(folder: str, name: str, obj) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)
    return path


def write_landing(root: str, day: int = 0) -> dict[str, str]:
    """Equity, crypto and macro landings for one daily run (``day`` shifts dates)."""
    eq, cr, ma = f"{root}/equity", f"{root}/crypto", f"{root}/macro"
    base = 2 + day
    write_json(eq, "AAPL.json", equity_payload({
        f"2024-01-{base + i:02d}": (100 + i, 101 + i, 99 + i, 100.5 + i * 1.5, 1000 + i) for i in range(6)}))
    write_json(eq, "ZERO.json", equity_payload({
        f"2024-01-{base:02d}": (0, 1, 0, 1, 5), f"2024-01-{base + 1:02d}": (2, 3, 1, 2.5, 6)}))
    write_json(cr, "markets.json", [
        coin("bitcoin", 10_000_000_000.0, 1, f"2024-01-{base + 5:02d}T23:59:59.000Z",
             roi={"times": 1.5, "currency": "usd", "percentage": 150.0}, price=40000.0 + day,
             unexpected_field=1),
        coin("ether", 1_000_000_000.0, 2, f"2024-01-{base + 5:02d}T10:00:00.000Z", price=2000.0),
        coin("tiny", None, 3, f"2024-01-{base + 5:02d}T10:00:00.000Z", price=0.01)])
    write_json(ma, "FEDFUNDS.json", {"observations": [
        {"date": "2024-01-01", "value": "5.33"}, {"date": "2024-01-04", "value": "."},
        {"date": f"2024-01-{base + 3:02d}", "value": "5.30"}]})
    write_json(ma, "DEXUSEU.json", {"observations": [{"date": "2024-01-05", "value": "1.09"}]})
    write_json(ma, "OTHER1.json", {"observations": [{"date": "2024-01-06", "value": "7"}]})
    return {"equity": eq, "crypto": cr, "macro": ma}
