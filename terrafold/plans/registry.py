"""Registration of queries, and helpers of the plan modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Registry:
    def __init__(self):
        self.queries: dict = {}
        self.oracle: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        """Register a function under its own name, with DuckDB SQL if there is any."""

        def put(f):
            self.queries[f.__name__] = f
            if sql:
                self.oracle[f.__name__] = sql
            return f

        return put


def longs(df: DataFrame) -> DataFrame:
    """All integer columns as BIGINT, as the SQL side returns them."""
    small = {"tinyint", "smallint", "int"}
    return df.select(*[F.col(c).cast("long").alias(c) if t in small else F.col(c) for c, t in df.dtypes])


# DuckDB pieces of the projection.
X = "((({lon}) + 180.0::DOUBLE) / 360.0::DOUBLE * pow(2.0::DOUBLE, {z}))"
Y = "((1.0::DOUBLE - asinh(tan(radians({lat}))) / 3.141592653589793::DOUBLE) / 2.0::DOUBLE * pow(2.0::DOUBLE, {z}))"


def sql_x(lon: str, z: str) -> str:
    return X.format(lon=lon, z=z)


def sql_y(lat: str, z: str) -> str:
    return Y.format(lat=lat, z=z)
