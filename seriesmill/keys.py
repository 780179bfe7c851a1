"""Names and fixed values shared by all operators."""

from __future__ import annotations

SERIES_KEYS = ("source", "market_type", "symbol", "timeframe")
OHLCV = ("open", "high", "low", "close", "volume")

# Bar length in milliseconds per timeframe.
TIMEFRAME_MS = {
    "1m": 60_000,
    "3m": 180_000,
    "5m": 300_000,
    "15m": 900_000,
    "30m": 1_800_000,
    "1h": 3_600_000,
    "2h": 7_200_000,
    "4h": 14_400_000,
    "6h": 21_600_000,
    "8h": 28_800_000,
    "12h": 43_200_000,
    "1d": 86_400_000,
    "3d": 259_200_000,
    "1w": 604_800_000,
    "1mo": 2_592_000_000,
}

# Label ids.
ASSET_IDS = {"BTCUSDT": 0, "ETHUSDT": 1}
TIMEFRAME_IDS = {"15m": 0, "1h": 1, "4h": 2, "1d": 3}
REGIME_IDS = {
    "trending_up": 0, "trending_down": 1, "ranging_low_vol": 2,
    "ranging_high_vol": 3, "breakout": 4, "capitulation": 5,
}
CYCLE_IDS = {"accumulation": 0, "bull": 1, "distribution": 2, "bear": 3}
DIRECTION_CLASSES = ("down", "sideways", "up")

# Cycle anchors (UTC dates).
ANCHOR_DATES = ("2012-11-28", "2016-07-09", "2020-05-11", "2024-04-19", "2028-04-01")

# Fixed values: (ATR multiple, horizon in bars) per timeframe.
BARRIER_PARAMS = {"15m": (1.5, 32), "1h": (1.8, 48), "4h": (2.0, 42), "1d": (2.5, 30)}
# Longest holding time in bars, and new bars that warrant a retrain.
MAX_HOLDING_BARS = {"15m": 32, "1h": 48, "4h": 42, "1d": 30}
RETRAIN_MIN_BARS = {"15m": 2000, "1h": 500, "4h": 150, "1d": 30}
