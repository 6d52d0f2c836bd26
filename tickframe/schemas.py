"""Fixed schemas (no inference anywhere)."""

from pyspark.sql import types as T

BAR_COLS = ["open", "high", "low", "close", "volume"]

BARS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("open_time", T.TimestampNTZType()),
    *[T.StructField(c, T.DoubleType()) for c in BAR_COLS],
])

# Raw bar CSV as written per symbol (symbol comes from the file name).
RAW_BAR_CSV = T.StructType([
    T.StructField("open_time", T.TimestampNTZType()),
    *[T.StructField(c, T.DoubleType()) for c in BAR_COLS],
])

# Exchange kline payload: array of 12-element arrays, numbers as text.
KLINE_PAYLOAD = T.ArrayType(T.ArrayType(T.StringType()))
KLINE_FIELDS = ["open_time_ms", "open", "high", "low", "close", "volume", "close_time_ms",
                "quote_volume", "trades", "taker_base_volume", "taker_quote_volume", "ignore"]

POSITION = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("preco_compra", T.DoubleType()),
    T.StructField("quantidade", T.DoubleType()),
    T.StructField("peak_price", T.DoubleType()),
])

WALLET = T.StructType([
    T.StructField("cash_usdt", T.DoubleType()),
    T.StructField("positions", T.ArrayType(POSITION)),
])

SIGNALS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("prob_buy", T.DoubleType()),
    T.StructField("signal", T.StringType()),
])

RESEARCH_FEATURES = [
    "rsi_14", "stoch_k", "stoch_d", "cmf_20", "sma_200", "bb_mid", "bb_upper", "bb_lower",
    "macd", "macd_signal", "macd_hist", "di_plus", "di_minus", "adx", "atr",
    "dist_sma_200_pct", "macd_cross", "day_of_week", "hour_of_day", "bb_width",
    "dist_sma_norm_by_atr", "dist_sma_mom", "bb_pos", "adx_trending", "volume_spike", "target",
]

LIVE_FEATURES = [
    "rsi_14", "stoch_k", "stoch_d", "cmf_20", "bb_mid", "bb_upper", "bb_lower",
    "macd", "macd_signal", "macd_hist", "sma_200", "tr", "dm_plus", "dm_minus",
    "di_plus", "di_minus", "dx", "adx", "atr", "dist_sma_200_pct", "macd_cross",
    "day_of_week", "hour_of_day", "bb_width", "dist_sma_norm_by_atr", "dist_sma_mom",
    "bb_pos", "adx_trending", "volume_spike",
]

INT_FEATURES = {"macd_cross", "day_of_week", "hour_of_day", "adx_trending", "target"}

# Fixed values of the reference model: its 14 input columns, in order, and
# its decision threshold.
MODEL_FEATURES = ["open", "low", "close", "rsi_14", "stoch_k", "bb_upper", "bb_lower", "macd",
                  "macd_signal", "adx", "atr", "day_of_week", "bb_width", "dist_sma_norm_by_atr"]
MODEL_THRESHOLD = 0.49
