"""Numbers from text, and text from numbers, with the same results as Python's own rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


INFINITIES = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]


def drop_nan(c: Column) -> Column:
    """Missing is NULL only: Spark ranks NaN above every number, so `NaN > 95` would be true."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_number(c: Column) -> Column:
    """Text to double; unparsable text and NaN become NULL.

    The JVM also reads '1.0d', '1f' and hexadecimal forms; those are refused.
    """
    text = c.cast("string")
    plain = (F.translate(text, "dDfFxX", "") == text) | F.lower(F.trim(text)).isin(INFINITIES)
    return drop_nan(F.when(plain, text.try_cast("double")))


def is_bad_number(c: Column) -> Column:
    """True for text that is present but no number at all ('nan' counts as missing, not bad)."""
    text = F.trim(c.cast("string"))
    return F.coalesce(
        (text != "") & to_number(c).isNull() & ~text.rlike("(?i)^[+-]?nan$"), F.lit(False)
    )


def frequency_mid(c: Column) -> Column:
    """'1700-2100' -> 1900.0; a plain number stays; anything else is 0."""
    ends = F.split(F.trim(c), "-")
    mid = (F.get(ends, F.lit(0)).try_cast("bigint") + F.get(ends, F.lit(1)).try_cast("bigint")) / 2
    ranged = F.when(F.size(ends) == 2, mid)
    return F.coalesce(F.when(F.contains(c, F.lit("-")), ranged).otherwise(to_number(c)), F.lit(0.0))


def fixed2(name: str) -> Column:
    """Two decimals of the column `name` as `'{:.2f}'` writes them.

    The JVM rounds the shortest decimal form half up; the exact binary value decides here. Half a
    cent is an odd multiple of 1/200, so where the nearest such multiple is odd, the side of it is
    the sign of x*200 less that integer, taken without rounding error by splitting x in two.
    """
    x = f"cast(`{name}` as double)"
    p = f"({x} * 200D)"
    n = f"rint({p})"
    hi = f"({x} * 134217729D - ({x} * 134217729D - {x}))"
    rest = f"(({p} - {n}) + (({hi} * 200D - {p}) + ({x} - {hi}) * 200D))"
    return F.expr(f"""
        case when abs({p}) < 1e15D and abs({n} % 2D) = 1D and (
            {rest} * signum({x}) < 0D or ({rest} = 0D and floor(abs({n}) / 2D) % 2 = 0)
        ) then format_string('%.2f', {x} - signum({x}) * 0.0025D)
        else format_string('%.2f', {x}) end
    """)


def shown(name: str) -> Column:
    """The double in column `name` as `'{}'` writes it.

    The JVM turns to exponents at 1e7 and below 1e-3; Python does at 1e16 and below 1e-4.
    """
    x = f"cast(`{name}` as double)"
    return F.expr(f"""
        case when abs({x}) >= 1e7D and abs({x}) < 1e16D
            then regexp_replace(cast(cast({x} as decimal(38,4)) as string), '([.]\\\\d+?)0+$', '$1')
        when abs({x}) >= 1e-4D and abs({x}) < 1e-3D
            then regexp_replace(cast(cast({x} as decimal(38,22)) as string), '0+$', '')
        else cast({x} as string) end
    """)
