"""String / time column functions used by sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickframe.functions.expr import col_or

# fixed values of the reference file naming
ENRICHED_PREFIX = "analise_v2_"
RUN_LOG_PREFIX = "trades_log_v"
QUOTE_ASSET = "USDT"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def basename(path) -> Column:
    return F.substring_index(col_or(path), "/", -1)


def symbol_from_file_name(name, prefix: str = ENRICHED_PREFIX) -> Column:
    """Strip ``prefix`` at the start, then drop the text after the last ``_``
    (``X_4h.csv`` -> ``X``; a name without ``_`` stays whole)."""
    stripped = F.regexp_replace(basename(name), "^" + prefix, "")
    return F.regexp_replace(stripped, "_[^_]*$", "")


def strip_prefix(name, prefix: str) -> tuple[Column, Column]:
    """(should_rename, new_name): the prefix is removed only where present."""
    c = col_or(name)
    has = c.startswith(prefix)
    return has, F.when(has, F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def run_version(name, prefix: str = RUN_LOG_PREFIX) -> Column:
    """Integer after ``prefix`` (``trades_log_v12_...`` -> 12); NULL if none."""
    c = col_or(name)
    return F.when(c.rlike(prefix + r"\d"), F.regexp_extract(c, prefix + r"(\d+)", 1).cast("long"))


def symbol_with_quote(base, quote: str = QUOTE_ASSET) -> Column:
    return F.concat(F.upper(col_or(base)), F.lit(quote))


def to_epoch_ms(ts: str) -> Column:
    """timestamp_ntz column (by name) -> epoch milliseconds (zone free)."""
    return F.expr(f"timestampdiff(MILLISECOND, {EPOCH}, `{ts}`)")


def from_epoch_ms(ms) -> Column:
    """epoch milliseconds -> timestamp_ntz wall time (zone free)."""
    return F.timestamp_add("MILLISECOND", col_or(ms), F.expr(EPOCH))
