from tickframe.functions.expr import (  # noqa: F401
    INF, ieee_div, nan_to_null, inf_to_null, rnd, col_or,
)
