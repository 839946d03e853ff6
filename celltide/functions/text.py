"""Text helpers shared by sources, reports and the log parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line ends besides \n and \r\n, and white space, as Python's str knows them.
LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends (`trim` alone removes blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def lines_of(c: Column) -> Column:
    """Array of stripped lines, blank ones included.

    Line ends other than \\n and \\r\\n are rare, and looking for them is cheaper than replacing.
    """
    unix = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    one_kind = F.translate(unix, LINE_ENDS, "\n" * len(LINE_ENDS))
    plain = F.when(unix.rlike(f"[{LINE_ENDS}]"), one_kind).otherwise(unix)
    return F.transform(F.split(plain, "\n"), strip)


def decode_utf8(value: Column) -> Column:
    """Bytes to text, leaving out what is not UTF-8."""
    return F.replace(F.make_valid_utf8(value.cast("string")), F.lit("�"), F.lit(""))


def int_list(c: Column) -> Column:
    """'1, 2,3' -> [1, 2, 3]; empty text -> []."""
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), '[\\s"\\[\\]]', ""), ",")
    numbers = F.transform(parts, lambda p: p.try_cast("bigint"))
    return F.filter(numbers, lambda n: n.isNotNull())


def text_list(c: Column) -> Column:
    """'a, b' -> ['a', 'b']; empty text -> []."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def snippet(c: Column, size=50) -> Column:
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("..."))).otherwise(c)
