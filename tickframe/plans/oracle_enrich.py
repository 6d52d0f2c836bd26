"""DuckDB oracle text for the indicator / feature / enrichment queries."""

from __future__ import annotations

from tickframe.plans.sqlkit import W, div, ewm_recursive, flag, full, lag, noinf

A14 = 1.0 / 14.0
BAR = ["open", "high", "low", "close", "volume"]


def _base(bars_sql: str, min_bars: int) -> str:
    cut = f"WHERE n_bars >= {min_bars}" if min_bars else ""
    return (f"bars AS ({bars_sql}), "
            f"b0 AS (SELECT *, count(*) OVER (PARTITION BY symbol) AS n_bars FROM bars), "
            f"b AS (SELECT symbol, open_time, open, high, low, close, volume, "
            f"row_number() OVER ({W}) - 1 AS i FROM b0 {cut})")


def _rolling() -> str:
    """Rolling features over b (both dialects)."""
    mfm = div("(close - low) - (high - close)", "high - low")
    return (f"r0 AS (SELECT *, {full('min', 'low', 14)} AS low14, {full('max', 'high', 14)} AS high14, "
            f"{full('avg', 'close', 20)} AS bb_mid, {full('stddev_samp', 'close', 20)} AS sd20, "
            f"{full('avg', 'close', 200)} AS sma_200, {full('avg', 'volume', 30)} AS vol30, "
            f"{mfm} AS mfm, {lag('close')} AS pc, high - {lag('high')} AS hup, "
            f"low - {lag('low')} AS ldn, {lag('low')} - low AS ldown, close - {lag('close')} AS d "
            f"FROM b), "
            f"r1 AS (SELECT *, {div('100.0 * (close - low14)', 'high14 - low14')} AS stoch_k, "
            f"bb_mid + sd20 * 2.0 AS bb_upper, bb_mid - sd20 * 2.0 AS bb_lower, "
            f"coalesce(mfm, 0.0) * volume AS mfv, mfm * volume AS mfv_nofill FROM r0), "
            f"r AS (SELECT *, {full('avg', 'stoch_k', 3)} AS stoch_d, "
            f"{div(full('sum', 'mfv', 20), full('sum', 'volume', 20))} AS cmf_20, "
            f"{div(full('sum', 'mfv_nofill', 20), full('sum', 'volume', 20))} AS cmf_nofill FROM r1)")


def research_sql(bars_sql: str, min_bars: int = 250, pct: float = 0.03, horizon: int = 5) -> str:
    """WITH-clause body ending in relation ``enr`` with all research columns."""
    x1 = ("x1 AS (SELECT symbol, i, close, "
          "CASE WHEN d > 0 THEN d ELSE 0.0 END AS gain, CASE WHEN d < 0 THEN -d ELSE 0.0 END AS loss, "
          "greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, "
          "CASE WHEN hup > ldn AND hup > 0 THEN hup ELSE 0.0 END AS dmp, "
          "CASE WHEN ldn > hup AND ldn > 0 THEN ldn ELSE 0.0 END AS dmm FROM r)")
    e1 = ewm_recursive("e1", "x1", [
        ("gain", "ag", A14, True, 14), ("loss", "al", A14, True, 14),
        ("close", "ema_f", 2 / 13, False, 0), ("close", "ema_s", 2 / 27, False, 0),
        ("tr", "atr", A14, False, 14), ("dmp", "dmps", A14, False, 14), ("dmm", "dmms", A14, False, 14)])
    x2 = ("x2 AS (SELECT symbol, i, ag, al, atr, ema_f - ema_s AS macd, "
          "100.0 * (dmps / (atr + 1e-10)) AS di_plus, 100.0 * (dmms / (atr + 1e-10)) AS di_minus, "
          "100.0 * (abs(100.0 * (dmps / (atr + 1e-10)) - 100.0 * (dmms / (atr + 1e-10))) "
          "/ (100.0 * (dmps / (atr + 1e-10)) + 100.0 * (dmms / (atr + 1e-10)) + 1e-10)) AS dx FROM e1)")
    e2 = ewm_recursive("e2", "x2", [("macd", "macd_signal", 0.2, False, 0), ("dx", "adx", A14, False, 14)],
                       keep=["ag", "al", "atr", "macd", "di_plus", "di_minus"])
    f0 = (f"f0 AS (SELECT r.symbol, r.open_time, r.open, r.high, r.low, r.close, r.volume, "
          f"100.0 - 100.0 / (1.0 + {div('e2.ag', 'e2.al')}) AS rsi_14, r.stoch_k, r.stoch_d, r.cmf_20, "
          f"r.sma_200, r.bb_mid, r.bb_upper, r.bb_lower, e2.macd, e2.macd_signal, "
          f"e2.macd - e2.macd_signal AS macd_hist, e2.di_plus, e2.di_minus, e2.adx, e2.atr, "
          f"{div('r.close - r.sma_200', 'r.sma_200')} * 100.0 AS dist_sma_200_pct, r.vol30 "
          f"FROM r JOIN e2 ON e2.symbol = r.symbol AND e2.i = r.i)")
    cross = (f"CAST(CASE WHEN macd < macd_signal AND {lag('macd')} > {lag('macd_signal')} THEN -1 "
             f"WHEN macd > macd_signal AND {lag('macd')} < {lag('macd_signal')} THEN 1 ELSE 0 END AS INTEGER)")
    f1 = (f"f1 AS (SELECT *, {cross} AS macd_cross, CAST(isodow(open_time) - 1 AS INTEGER) AS day_of_week, "
          f"CAST(hour(open_time) AS INTEGER) AS hour_of_day, "
          f"{div('bb_upper - bb_lower', 'bb_mid')} AS bb_width, "
          f"{div('dist_sma_200_pct', 'atr')} AS dist_sma_norm_by_atr FROM f0)")
    cleaned = ["open", "high", "low", "close", "volume", "rsi_14", "stoch_k", "stoch_d", "cmf_20",
               "sma_200", "bb_mid", "bb_upper", "bb_lower", "macd", "macd_signal", "macd_hist",
               "di_plus", "di_minus", "adx", "atr", "dist_sma_200_pct", "bb_width", "dist_sma_norm_by_atr"]
    f2 = (f"f2 AS (SELECT symbol, open_time, {', '.join(noinf(c) + ' AS ' + c for c in cleaned)}, "
          f"macd_cross, day_of_week, hour_of_day, vol30 FROM f1)")
    fh = (f"max(high) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND {horizon} FOLLOWING)")
    fc = (f"count(high) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND {horizon} FOLLOWING)")
    rn = f"row_number() OVER ({W})"
    enr = (f"enr AS (SELECT *, dist_sma_200_pct - {lag('dist_sma_200_pct', 3)} AS dist_sma_mom, "
           f"{div('close - bb_lower', 'bb_upper - bb_lower')} AS bb_pos, "
           f"{flag('adx > 25')} AS adx_trending, {div('volume', 'vol30')} AS volume_spike, "
           f"{flag(f'{rn} >= {horizon} AND {fc} = {horizon} AND {fh} >= close * {1.0 + pct!r}')} AS target "
           f"FROM f2)")
    return ", ".join([_base(bars_sql, min_bars), _rolling(), x1, e1, x2, e2, f0, f1, f2, enr])


def live_sql(bars_sql: str, min_bars: int = 250, fill_flat: bool = True) -> str:
    """WITH-clause body ending in relation ``enl`` with all live columns (no NULL filter)."""
    x1 = ("x1 AS (SELECT symbol, i, close, "
          "CASE WHEN d > 0 THEN d ELSE 0.0 END AS gain, CASE WHEN d < 0 THEN -d ELSE 0.0 END AS loss, "
          "CASE WHEN pc IS NULL THEN NULL ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr, "
          "CASE WHEN hup > ldown THEN hup ELSE 0.0 END AS dm_plus, "
          "CASE WHEN ldown > hup THEN ldown ELSE 0.0 END AS dm_minus FROM r)")
    e1 = ewm_recursive("e1", "x1", [
        ("gain", "ag", A14, True, 14), ("loss", "al", A14, True, 14),
        ("close", "ema_f", 2 / 13, False, 0), ("close", "ema_s", 2 / 27, False, 0),
        ("tr", "trs", 2 / 15, False, 0), ("dm_plus", "dmps", 2 / 15, False, 0),
        ("dm_minus", "dmms", 2 / 15, False, 0)], keep=["tr", "dm_plus", "dm_minus"])
    dip, dim = div("dmps", "trs") + " * 100.0", div("dmms", "trs") + " * 100.0"
    x2 = (f"x2a AS (SELECT symbol, i, ag, al, trs, tr, dm_plus, dm_minus, ema_f - ema_s AS macd, "
          f"{dip} AS di_plus, {dim} AS di_minus FROM e1), "
          f"x2 AS (SELECT *, {div('abs(di_plus - di_minus)', 'di_plus + di_minus')} * 100.0 AS dx FROM x2a)")
    e2 = ewm_recursive("e2", "x2", [("macd", "macd_signal", 0.2, False, 0), ("dx", "adx", 2 / 15, False, 0)],
                       keep=["ag", "al", "trs", "tr", "dm_plus", "dm_minus", "macd", "di_plus", "di_minus", "dx"])
    cmf = "r.cmf_20" if fill_flat else "r.cmf_nofill"
    f0 = (f"f0 AS (SELECT r.symbol, r.open_time, r.open, r.high, r.low, r.close, r.volume, "
          f"100.0 - 100.0 / (1.0 + {div('e2.ag', 'e2.al')}) AS rsi_14, r.stoch_k, r.stoch_d, "
          f"{cmf} AS cmf_20, r.bb_mid, r.bb_upper, r.bb_lower, e2.macd, e2.macd_signal, "
          f"e2.macd - e2.macd_signal AS macd_hist, r.sma_200, e2.tr, e2.dm_plus, e2.dm_minus, "
          f"e2.di_plus, e2.di_minus, e2.dx, e2.adx, e2.trs AS atr, "
          f"{div('r.close - r.sma_200', 'r.sma_200')} * 100.0 AS dist_sma_200_pct, r.vol30 "
          f"FROM r JOIN e2 ON e2.symbol = r.symbol AND e2.i = r.i)")
    enl = (f"enl AS (SELECT symbol, open_time, open, high, low, close, volume, rsi_14, stoch_k, stoch_d, "
           f"cmf_20, bb_mid, bb_upper, bb_lower, macd, macd_signal, macd_hist, sma_200, tr, dm_plus, "
           f"dm_minus, di_plus, di_minus, dx, adx, atr, dist_sma_200_pct, "
           f"{flag('macd_hist > 0')} AS macd_cross, CAST(isodow(open_time) - 1 AS INTEGER) AS day_of_week, "
           f"CAST(hour(open_time) AS INTEGER) AS hour_of_day, "
           f"{div('bb_upper - bb_lower', 'bb_mid')} AS bb_width, "
           f"{div('close - sma_200', 'atr')} AS dist_sma_norm_by_atr, "
           f"dist_sma_200_pct - {lag('dist_sma_200_pct')} AS dist_sma_mom, "
           f"{div('close - bb_lower', 'bb_upper - bb_lower')} AS bb_pos, "
           f"{flag('adx > 25')} AS adx_trending, {flag('volume > 2.0 * vol30')} AS volume_spike FROM f0)")
    return ", ".join([_base(bars_sql, min_bars), _rolling(), x1, e1, x2, e2, f0, enl])
