"""Registry of checked queries: key -> (Spark query, DuckDB oracle SQL).

Each Spark query takes ``(spark, sf_dir)``, reads the driver's tables
through the adapter views and returns a lazy DataFrame. The oracle is the
same computation in SQL over the same views (as CTEs). Float outputs are
rounded to 9 digits on both sides (``report``), so engines that differ in
the last bit still agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as tf
from ..sources.fixtures import register_views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RAW_ORACLES: dict[str, str] = {}  # oracle text before the view CTEs (for composition)


def register(key: str, views=(), oracle: str | None = None):
    """Decorator: register a query under ``key`` with its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the answers are defined in UTC (week labels, epoch seconds);
            # the caller's session may have been built with another zone
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            if views:
                register_views(spark, sf_dir, list(views))
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__wrapped__ = fn
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = run
        if oracle is not None:
            RAW_ORACLES[key] = oracle
            text = nudge_rounding(oracle)
            ORACLES[key] = with_views(text, views) if views else text
        return run
    return deco


def nudge_rounding(sql: str, digits: int = 9) -> str:
    """Apply the report rounding's tie nudge to every ``round(expr, 9)`` of an
    oracle text, so both engines round the same numbers the same way."""
    out, i, token = [], 0, "round("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(token):k - 1]
        tail = f", {digits}"
        if inner.endswith(tail):
            expr = nudge_rounding(inner[:-len(tail)], digits)
            out.append(sql[i:j] + f"round(({expr}) + sign({expr}) * {tf.TIE_NUDGE!r}{tail})")
        else:
            out.append(sql[i:j] + token + nudge_rounding(inner, digits) + ")")
        i = k


def report(df: DataFrame, digits: int = 9, keep=()) -> DataFrame:
    """Round every floating column (except ``keep``) and fold -0.0 into 0.0."""
    cols = []
    for name, dtype in df.dtypes:
        if dtype in ("double", "float") and name not in keep:
            cols.append(tf.rnd(name, digits).cast(dtype).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)
