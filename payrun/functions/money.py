"""Amount arithmetic with the zero guards the payment rules need.

ANSI mode is on in Spark 4, so ``x / 0.0`` raises: every divide sits behind
a ``when``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules as R


def safe_div(x: Column, d: Column) -> Column:
    """x / d, or 0 when d is 0."""
    return F.when(d != 0, x / d).otherwise(F.lit(0.0))


def to_usd(x: Column, pay_currency: Column, pay_day: Column,
           ves: Column, ves_thursday: Column, eur: Column,
           passthrough=("USD",)) -> Column:
    """An amount in the payment currency, expressed in USD.

    0 stays 0; currencies in ``passthrough`` are kept; EUR is multiplied by
    the EUR rate; anything else is divided by the VES rate of the payment
    day (the Tuesday rate on Tuesdays, the Thursday rate otherwise).
    """
    return (
        F.when(x == 0, F.lit(0.0))
        .when(pay_currency.isin(*passthrough), x)
        .when(pay_currency == "EUR", x * eur)
        .when(pay_day == R.TUESDAY, safe_div(x, ves))
        .otherwise(safe_div(x, ves_thursday))
    )
