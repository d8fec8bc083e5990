"""Helpers to give a query and its SQL twin the same rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def rounded(df: DataFrame, digits: int = 6, many: bool = False) -> DataFrame:
    """Round floating columns; adding zero turns -0.0 into 0.0. ``many`` gives the same numbers in less time for results of very many rows."""
    rounding = _rounded_by_division if many else F.round
    return df.select(
        *[
            (rounding(F.col(f"`{f.name}`").cast("double"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _rounded_by_division(x: Column, digits: int) -> Column:
    """What ``round`` finds through decimals: a whole number over a power of ten is the nearest double; large numbers and what is near a half are left to it."""
    unit = F.lit(10.0**digits)
    scaled = F.abs(x) * unit
    plain = (scaled < 1e11) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(plain, F.signum(x) * (F.floor(scaled + 0.5) / unit)).otherwise(F.round(x, digits))


def r(expression: str, name: str, digits: int = 6) -> str:
    return f'round({expression}, {digits}) + 0.0 AS "{name}"'


def _simpson(value: str, low: str, high: str, steps: int) -> str:
    """An integral over ``k`` of ``value`` with ``{at}`` as the variable."""
    at = f"({low} + ({high} - {low}) * k / {steps}.0)"
    weight = f"CASE WHEN k IN (0, {steps}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    return f"(list_sum(list_transform(range(0, {steps + 1}), lambda k: {weight} * {value.format(at=at)})) * ({high} - {low}) / {3 * steps})"


def t_tail_sql(t: str, nu: str) -> str:
    """Two-sided tail of Student's t: with t = sqrt(nu) tan(a) the density is a power of cos(a)."""
    power = f"pow(greatest(cos({{at}}), 0), {nu} - 1)"
    whole, part = _simpson(power, "0.0", "pi() / 2", 4000), _simpson(power, f"atan(abs({t}) / sqrt({nu}))", "pi() / 2", 4000)
    return f"{part} / {whole}"


def z_tail_sql(z: str) -> str:
    """Two-sided normal tail."""
    return f"{_simpson('exp(-pow({at}, 2) / 2)', f'abs({z})', f'(abs({z}) + 12)', 4000)} * sqrt(2 / pi())"
