"""CTEs shared by the reference SQL: bars, smoothing recursions, feeds, predictions."""

from __future__ import annotations

from seriesmill.catalog.base import fragment, lagged


def _bars(name: str, bucket: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT symbol, ts, epoch_ms(ts) AS ts_ms, open, high, low, close, volume,
         row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i,
         count(*) OVER (PARTITION BY symbol) AS n
  FROM (SELECT event_type AS symbol, {bucket} AS ts,
               first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
               last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
        FROM events GROUP BY 1, 2))"""


fragment("b", (), _bars("b", "date_trunc('hour', ts)"))
fragment("b5", (), _bars("b5", "time_bucket(INTERVAL 5 MINUTE, ts)"))
fragment("d", (), """
d AS MATERIALIZED (
  SELECT symbol, ts, epoch_ms(ts) AS ts_ms, open, high, low, close, volume,
         row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i,
         count(*) OVER (PARTITION BY symbol) AS n
  FROM (SELECT l_returnflag AS symbol, date_trunc('day', l_shipdate)::TIMESTAMP AS ts,
               first(p ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, p) AS open,
               max(p) AS high, min(p) AS low,
               last(p ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, p) AS close,
               CAST(sum(l_quantity) AS DOUBLE) AS volume
        FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2))""")


def _smooth(name: str, source: str, columns: dict[str, tuple[str, float]], start: int = 0) -> str:
    """Recursion over the position: e = e + gain * (x - e)."""
    seed = ", ".join(f"CAST({x} AS DOUBLE) AS {c}" for c, (x, _) in columns.items())
    step = ", ".join(f"p.{c} + {g!r} * (s.{x} - p.{c})" for c, (x, g) in columns.items())
    return f"""
{name} AS (
  SELECT symbol, i, {seed} FROM {source} WHERE i = {start}
  UNION ALL
  SELECT s.symbol, s.i, {step} FROM {name} p JOIN {source} s ON s.symbol = p.symbol AND s.i = p.i + 1)"""


_g = lambda n: 2.0 / (n + 1)
fragment("ema_raw", ("b",), _smooth("ema_raw", "b", {f"e{n}": ("close", _g(n)) for n in (9, 12, 21, 26, 50, 120, 200)}))
fragment("ema", ("b", "ema_raw"), "ema AS MATERIALIZED (SELECT b.*, "
         + ", ".join(f"CASE WHEN b.i >= {n - 1} THEN e{n} END AS ema_{n}" for n in (9, 12, 21, 26, 50, 120, 200))
         + " FROM b JOIN ema_raw USING (symbol, i))")
_sign = lambda a, b: f"CASE WHEN ema_{a} > ema_{b} THEN 1.0 WHEN ema_{a} < ema_{b} THEN -1.0 ELSE 0.0 END"
fragment("ema_state", ("ema",), "ema_state AS MATERIALIZED (SELECT *, CAST("
         + " + ".join(_sign(a, b) for a, b in ((9, 21), (21, 50), (50, 120), (120, 200)))
         + " AS DOUBLE) AS ema_stack_score FROM ema)")
fragment("moves", ("b",), f"""
moves AS MATERIALIZED (
  SELECT *, greatest(chg, 0) AS gain, greatest(-chg, 0) AS loss,
         greatest(high - low, abs(high - pc), abs(low - pc)) AS true_range,
         CASE WHEN pc <> 0 THEN close / pc - 1 END AS returns_1,
         ln(nullif(close, 0)) - ln(nullif(pc, 0)) AS log_returns_1
  FROM (SELECT *, close - {lagged('close')} AS chg, {lagged('close')} AS pc FROM b))""")
fragment("rsi_raw", ("moves",), _smooth("rsi_raw", "moves", {"ug": ("gain", 1 / 14), "dl": ("loss", 1 / 14)}, start=1))
fragment("rsi", ("moves", "rsi_raw"), """
rsi AS MATERIALIZED (
  SELECT m.*, CASE WHEN m.i < 14 THEN NULL WHEN dl = 0 THEN 100.0
                   ELSE 100.0 - 100.0 / (1.0 + ug / dl) END AS rsi_14
  FROM moves m LEFT JOIN rsi_raw USING (symbol, i))""")
fragment("macd_line", ("ema",), """
macd_line AS MATERIALIZED (SELECT *, ema_12 - ema_26 AS line FROM ema)""")
fragment("macd_raw", ("macd_line",), _smooth("macd_raw", "macd_line", {"sg": ("line", 0.2)}, start=25))
fragment("macd", ("macd_line", "macd_raw"), """
macd AS MATERIALIZED (
  SELECT l.*, l.line AS macd_line, CASE WHEN l.i >= 33 THEN sg END AS macd_signal,
         CASE WHEN l.i >= 33 THEN l.line - sg END AS macd_hist
  FROM macd_line l LEFT JOIN macd_raw USING (symbol, i))""")
fragment("atr_raw", ("moves",), _smooth("atr_raw", "moves", {"tr": ("true_range", 1 / 14)}))
fragment("atr", ("moves", "atr_raw"), """
atr AS MATERIALIZED (
  SELECT m.*, CASE WHEN m.i >= 13 THEN tr END AS atr,
         CASE WHEN m.i >= 13 AND close <> 0 THEN tr / close END AS atr_pct
  FROM moves m JOIN atr_raw USING (symbol, i))""")
