"""Arrow UDFs that can be defined before there is a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(returns: str) -> Callable:
    """Like pandas_udf, but the type is parsed when the function is first applied to columns."""

    def make(f: Callable) -> Callable[..., Column]:
        @wraps(f)
        def apply(*columns) -> Column:
            return F.pandas_udf(f, returns)(*columns)

        apply.python = f
        return apply

    return make
