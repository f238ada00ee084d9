"""Text to typed values. Bad input becomes null or a stated default, never an error (ANSI mode stays on)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_BLANKS = " \t\n\r\f\v"
_HEX32 = "^[0-9a-fA-F]{32}$"
_ISO_DATE = r"^\s*\d{4}-\d{2}-\d{2}\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trim surrounding white space. Null stays null: a missing name must not turn into a name."""
    return F.trim(_col(c), F.lit(_BLANKS))


def flag(c: Column | str) -> Column:
    """True for the text "true" in any case, surrounded by blanks or not; false for all else, null included."""
    return F.coalesce(F.lower(clean_text(c)) == F.lit("true"), F.lit(False))


def decimal_or_null(c: Column | str, precision: int = 12, scale: int = 2) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")  # casts ignore surrounding blanks


def money(c: Column | str, precision: int = 12, scale: int = 2) -> Column:
    """An amount; missing or unreadable amounts count as zero."""
    zero = F.lit(0).cast(f"decimal({precision},{scale})")
    return F.coalesce(decimal_or_null(c, precision, scale), zero)


def whole_number(c: Column | str, kind: str = "int") -> Column:
    """An integer from text such as "4" or "4.0"; fractions are cut towards zero, the rest is null."""
    plain = _col(c).try_cast(kind)
    return F.coalesce(plain, _col(c).try_cast("decimal(24,4)").try_cast(kind))


def iso_date(c: Column | str) -> Column:
    """A date written yyyy-MM-dd and nothing else. The cast alone would also take shorter forms."""
    return F.when(_col(c).rlike(_ISO_DATE), _col(c).try_cast("date"))


def wall_clock(c: Column | str) -> Column:
    """A timestamp as written, any zone offset ignored; unreadable text gives null."""
    return _col(c).try_cast("timestamp_ntz")


def wall_clock_of(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """A timestamp in ISO form or in one of `formats`, tried in that order; unreadable text gives null."""
    text = clean_text(c)
    tried = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(wall_clock(c), *tried)


def instant(c: Column | str) -> Column:
    """A point in time; text without an offset is read in the session zone."""
    return F.try_to_timestamp(clean_text(c))


def uuid_digits(c: Column | str) -> Column:
    """The 32 hex digits of a UUID written with or without dashes, braces or a `urn:uuid:` prefix."""
    unprefixed = F.replace(F.replace(_col(c), F.lit("urn:")), F.lit("uuid:"))
    bare = F.replace(F.trim(unprefixed, F.lit("{}")), F.lit("-"))
    return F.when(bare.rlike(_HEX32), F.lower(bare))


def uuid_text(c: Column | str, *row: Column | str) -> Column:
    """The canonical UUID in `c`, or one derived from the values of `row` when `c` holds none.

    The replacement is a hash and not random, so a replayed or retried task writes the same key again.
    """
    derived = F.md5(F.to_json(F.struct(*[_col(x) for x in row])))
    digits = F.coalesce(uuid_digits(c), derived)
    groups = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digits, start, length) for start, length in groups])


def slot_size(c: Column | str) -> Column:
    """`struct<width:int,height:int>` of a "WxH" text; both null unless both parts are integers."""
    parts = F.split(clean_text(c), "x")
    width = clean_text(F.get(parts, F.lit(0))).try_cast("int")
    height = clean_text(F.get(parts, F.lit(1))).try_cast("int")
    valid = (F.size(parts) == 2) & width.isNotNull() & height.isNotNull()
    return F.struct(
        F.when(valid, width).alias("width"),
        F.when(valid, height).alias("height"),
    )
