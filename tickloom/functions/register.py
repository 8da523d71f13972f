"""The package's column expressions as SQL functions.

They are Spark's own SQL functions over expressions: the optimizer sees through them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_SIZE = "(abs(price_volume) * cast(10000 AS decimal(5,0)))"
_COUNT = "cast(abs(nullif(volume, 0)) AS decimal(19,0))"

FUNCTIONS = {
    "hour_bucket(clock STRING) RETURNS STRING":
        "substring(lpad(replace(clock, ':', ''), 6, '0'), 1, 2)",
    "market_time(day DATE, hour STRING) RETURNS TIMESTAMP_NTZ":
        "cast(day AS timestamp_ntz) + make_dt_interval(0, try_cast(hour AS int))",
    # As pricing.exact_ratio: whole-number division, rounded once.
    "weighted_price(price_volume DECIMAL(38,4), volume BIGINT) RETURNS DECIMAL(22,4)":
        f"cast((({_SIZE} div {_COUNT}) + if(({_SIZE} % {_COUNT}) * 2 >= {_COUNT}, 1, 0))"
        " * if(signum(price_volume) * signum(volume) < 0, -1, 1) AS decimal(18,0))"
        " * cast('0.0001' AS decimal(4,4))",
}


def register_functions(spark: SparkSession) -> None:
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
