"""Callsigns, grids, numbers and text fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that a callsign field may be wrapped in.
WRAPPERS = "\"'`<>[]{}()"


def sanitize_callsign(c: Column) -> Column:
    """A doubled backslash is a slash; quotes and other backslashes go."""
    return F.regexp_replace(F.replace(c, F.lit("\\\\"), F.lit("/")), r"""["'\\]""", "")


def trim_brackets(c: Column) -> Column:
    """Without quotes and brackets at both ends."""
    return F.btrim(c, F.lit(WRAPPERS))


def strip_brackets(c: Column) -> Column:
    """Without quotes and brackets anywhere."""
    return F.translate(c, WRAPPERS, "")


def valid_callsign(c: Column) -> Column:
    """1 to 20 characters with an ASCII letter or digit among them."""
    return F.coalesce(F.length(c).between(1, 20) & c.rlike("[A-Za-z0-9]"), F.lit(False))


def is_callsign(c: Column) -> Column:
    """Whether the part before a slash (one that isn't first) has the form of a callsign (a fixed pattern)."""
    base = F.regexp_replace(F.upper(c), r"(?s)^([^/]+)/.*$", "$1")
    return F.coalesce(base.rlike(r"^[A-Z0-9]{1,3}[0-9][A-Z0-9]{0,3}[A-Z]$"), F.lit(False))


def valid_grid(c: Column, *, live: bool = False) -> Column:
    """Whether a Maidenhead locator is well formed: the live feed wants lower-case subsquares, logs are upper-cased first (fixed patterns)."""
    if live:
        return F.coalesce(c.rlike(r"^[A-R]{2}[0-9]{2}([a-x]{2})?$"), F.lit(False))
    return F.coalesce(F.upper(c).rlike(r"^[A-R]{2}[0-9]{2}([A-X]{2})?$"), F.lit(False))


def upper_grid(c: Column, n: int = 8) -> Column:
    return F.left(F.upper(c), F.lit(n))


def pad_grid6(c: Column) -> Column:
    """Six characters: a square of four gets its centre ``MM``, others are filled with spaces or cut."""
    return F.rpad(F.when(F.length(c) == 4, F.concat(c, F.lit("MM"))).otherwise(c), 6, " ")


def grid4(c: Column) -> Column:
    return F.left(c, F.lit(4))


def fixed(c: Column, n: int) -> Column:
    """At most ``n`` characters."""
    return F.left(c, F.lit(n))


def continent2(c: Column) -> Column:
    return F.left(c, F.lit(2))


def plain_spaces(c: Column) -> Column:
    """Non-breaking spaces of a text decoded as ISO-8859-1 as plain ones."""
    return F.replace(c, F.lit(" "), F.lit(" "))


def fields(c: Column, separator: str = ",") -> Column:
    """Fields of a CSV line. Lines with double quotes are split outside them, read from the left; the quotes go,
    and one that is never closed is text."""
    plain = F.split(c, separator, -1)
    outside = F.regexp_extract_all(c, F.lit(f'(?:^|{separator})((?:[^"{separator}]|"[^"]*"|")*+)'), F.lit(1))
    unquoted = F.transform(outside, lambda x: F.replace(F.regexp_replace(x, r'(?s)^\s*"(.*)"\s*$', "$1"), F.lit('""'), F.lit('"')))
    return F.when(F.contains(c, F.lit('"')), unquoted).otherwise(plain)


def settled(df: DataFrame) -> DataFrame:
    """``df`` as rows that are made once: the optimizer doesn't move filters from above a generator to below it, where
    each condition would repeat the expressions (a split of the line, say) that its columns come from."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def words(c: Column) -> Column:
    """White-space separated words."""
    return F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " ")


def to_int(c: Column, lo: int, hi: int, *, policy: str = "strict") -> Column:
    """A whole number from ``lo`` to ``hi``; blank is 0.

    ``strict`` gives null for anything else; ``lenient`` gives 0 for bad syntax and the nearest
    bound beyond the range."""
    text = F.trim(c)
    form = r"^[+-]?[0-9]+$" if lo < 0 else r"^[0-9]+$"
    number = text.try_cast("bigint")
    good = text.rlike(form)
    if policy == "strict":
        out = F.when(text == "", F.lit(0)).when(good & number.between(lo, hi), number)
    else:
        bound = F.when(F.startswith(text, F.lit("-")), F.lit(lo)).otherwise(F.lit(hi))
        out = F.when(good, F.when(number.isNull(), bound).otherwise(F.least(F.greatest(number, F.lit(lo)), F.lit(hi)))).otherwise(F.lit(0))
    return out.cast("long")


def to_float(c: Column, *, policy: str = "strict") -> Column:
    """A decimal number; blank is 0, bad syntax is null (``strict``) or 0 (``lenient``)."""
    text = F.trim(c)
    good = text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    out = F.when(text == "", F.lit(0.0)).when(good, text.try_cast("double"))
    return out if policy == "strict" else F.coalesce(out, F.lit(0.0))


def mhz_to_hz(c: Column) -> Column:
    """Whole Hz of a decimal text in MHz, exactly."""
    return F.floor(c.try_cast("decimal(28,9)") * F.lit(1000000)).cast("long")


def khz_floor(c: Column) -> Column:
    return F.floor(c.try_cast("double")).cast("long")


def non_negative(c: Column) -> Column:
    """Missing and negative sentinels as 0."""
    value = c.try_cast("double")
    return F.when(value > 0, value).otherwise(F.lit(0.0))


def repair_flux(c: Column) -> Column:
    """Flux above 500 was written in tenths."""
    return F.when(c > 500, c / 10).otherwise(c)


def source_key(path: Column, root: str = "") -> Column:
    """Directory of a file, relative to ``root``."""
    return F.regexp_replace(relative_path(path, root), r"/?[^/]*$", "")


def relative_path(path: Column, root: str = "") -> Column:
    root = root.rstrip("/") + "/" if root else ""
    return F.when(F.startswith(path, F.lit(root)), F.substring(path, len(root) + 1, 1 << 20)).otherwise(path) if root else path


def partition_from_name(path: Column) -> Column:
    """YYYYMM of ``wsprspots-YYYY-MM...``, YYYYMMDD of a dated RBN archive; empty for other names."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    month = F.regexp_extract(name, r"^wsprspots-(\d{4})-(\d{2})", 0)
    day = F.regexp_extract(name, r"^(?:rbndata-)?(\d{8})\.(?:zip|csv)$", 1)
    return F.when(month != "", F.concat(F.substring(month, 11, 4), F.substring(month, 16, 2))).otherwise(day)
