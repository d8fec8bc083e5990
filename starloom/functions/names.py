"""Column names of features: ``flux__<calculator>[__<parameter>_<value>]``.

A dot in a value would need quoting in Spark, so it becomes an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def feature(calculator: str, suffix: str | None = None, **parameters) -> str:
    parts = ["flux", calculator]
    parts += [f"{key}_{value}" for key, value in parameters.items()]
    if suffix is not None:
        parts.append(suffix)
    return "__".join(parts).replace(".", "_")


def flux() -> Column:
    return F.col("flux")
