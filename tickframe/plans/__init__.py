"""Registered queries (Spark plan + DuckDB oracle text)."""


def load_all():
    from tickframe.plans import indicator_queries  # noqa: F401
    from tickframe.plans import data_queries  # noqa: F401
    from tickframe.plans import trading_queries  # noqa: F401
    from tickframe.plans import position_queries  # noqa: F401
    from tickframe.plans import source_queries  # noqa: F401
    from tickframe.plans import stream_queries  # noqa: F401
    from tickframe.plans import store_queries  # noqa: F401
    from tickframe.plans.catalog import REGISTRY
    return REGISTRY
