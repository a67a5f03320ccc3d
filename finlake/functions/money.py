"""Money sums that do not depend on the order in which rows arrive.

Sums of doubles change with partitioning and task retries, which moves rounding
ties. Amounts are therefore added as integers and turned back into doubles, the
type of the stored tables, only after rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exact_sum_sql(df: DataFrame, name: str) -> str:
    """SQL for the exact sum of the named amount.

    A double is added as two integers, its whole part and its millionths, which costs
    no more than adding doubles. What it holds beyond six places, more than its own
    resolution, is added as a decimal, so only such rows pay for it. NaN, amounts of
    9.2e18 or more and sums beyond a bigint raise, whatever the session's ANSI
    setting. Other types are simply added up.
    """
    if not isinstance(df.select(name).schema[0].dataType, (T.DoubleType, T.FloatType)):
        return f"sum({name})"
    x = f"cast({name} as double)"
    wrong = f"cast(raise_error(concat('{name}: cannot add ', cast({name} as string))) as bigint)"
    whole = f"case when isnan({x}) or abs({x}) >= 9.2e18 then {wrong} else floor({x}) end"
    millionth = f"cast(rint(({x} - floor({x})) * 1e6) as bigint)"
    rest = f"({x} - floor({x})) - {millionth} / 1e6"
    beyond = f"case when abs({rest}) > abs({x}) * 2.3e-16 then cast({rest} as decimal(24,18)) end"
    over = f"cast(raise_error('{name}: the sum is too large') as bigint)"
    wholes = f"case when count({name}) > 0 then coalesce(try_sum({whole}), {over}) end"
    return (
        f"cast(cast({wholes} as decimal(20,0)) + cast(sum({millionth}) as decimal(20,0)) / 1000000"
        f" + coalesce(sum({beyond}), 0) as decimal(38,12))"
    )


def exact_sum(df: DataFrame, name: str) -> Column:
    return F.expr(exact_sum_sql(df, name))


def rounded(amount: Column, places: int) -> Column:
    """Half-up rounding in decimal, then double."""
    return F.round(amount, places).cast("double")


def ratio(amount: Column, count: Column, places: int) -> Column:
    """``amount / count`` rounded half-up; NULL where the count is zero.

    The types leave twelve decimals to the quotient before it is rounded.
    """
    return rounded(
        F.try_divide(amount.cast("decimal(32,6)"), count.cast("decimal(20,0)")), places
    )
