"""Text normalization as Column expressions; all of it stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space a delivery may contain, wider than the space Spark's trim
# removes, as characters and as a class that Java and RE2 read alike.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
SPACE = (
    r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)
NOT_SPACE = SPACE.replace("[", "[^", 1)
SENTINEL = "(null)"
OBJECT_DESCRIPTION = r"^<[A-Za-z]+: 0x[0-9a-f]+>$"
CURLY_SINGLE = "‘’‛"
CURLY_DOUBLE = "“”"

PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Decimals so short that a double spells them in the same digits, and those of them without idle zeros.
SHORT_DECIMAL = r"^\d{1,12}(\.\d{1,2})?\z|^\d{1,8}\.\d{1,6}\z"
SPELLED = r"^(0|[1-9]\d{0,11})(\.\d?[1-9])?\z|^(0|[1-9]\d{0,7})\.\d{0,5}[1-9]\z"
# What a text has that is not plain: other than printable ASCII, or a space at an end or beside another.
NOT_PLAIN = r"[^ -~]|^ | \z|  "
# Leading zeros, a fraction of zeros only, and zeros that end a fraction.
IDLE_ZEROS = r"^0+(?=\d)|\.0+$|(?<=\.\d{0,30}[1-9])0+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Strip every kind of white space from both ends."""
    return F.btrim(_col(value).cast("string"), F.lit(WHITE_SPACE))


def clean_text(value: Column | str) -> Column:
    """Trim; blank becomes null."""
    return F.nullif(trimmed(value), F.lit(""))


def has_text(value: Column | str) -> Column:
    """Is there anything but white space?"""
    return _col(value).rlike(NOT_SPACE)


def sentinel_null(value: Column | str) -> Column:
    """The literal ``(null)`` means absent."""
    return F.nullif(_col(value), F.lit(SENTINEL))


def is_present(value: Column | str) -> Column:
    """Neither null nor the empty string."""
    value = _col(value)
    return value.isNotNull() & (value.cast("string") != "")


def present(value: Column | str) -> Column:
    """The value where it is present, else null."""
    value = _col(value)
    return F.when(is_present(value), value)


def straighten_quotes(value: Column | str) -> Column:
    """Typographic quotes to their ASCII forms."""
    return F.translate(
        _col(value),
        CURLY_SINGLE + CURLY_DOUBLE,
        "'" * len(CURLY_SINGLE) + '"' * len(CURLY_DOUBLE),
    )


def loose_text(value: Column | str) -> Column:
    """Compare form: straight quotes, single spaces, trimmed, lower case."""
    value = _col(value)
    spaced = trimmed(F.regexp_replace(straighten_quotes(value), f"{SPACE}+", " "))
    # Plain text has only its case to lose.
    return F.lower(F.when(value.rlike(NOT_PLAIN), spaced).otherwise(value))


def is_object_description(value: Column | str) -> Column:
    """A leaked in-memory object description rather than data."""
    value = _col(value)
    return F.startswith(value, F.lit("<")) & value.rlike(OBJECT_DESCRIPTION)


def number_or_null(value: Column | str) -> Column:
    """The double a plain decimal text spells, else null.

    The pattern keeps out what ``try_cast`` alone would accept, such as ``1d``.
    """
    text = trimmed(value)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def number_text(number: Column) -> Column:
    """Shortest spelling of a double: ``90`` rather than ``90.0``.

    Digits are written out from a millionth up to 1e21; beyond, as ``1.5e-7`` and ``1e+21``.
    """
    size = F.abs(number)
    whole = (number == F.floor(number)) & (size < F.lit(1e18))
    plain = lambda scale: F.regexp_replace(
        number.try_cast(f"decimal(38,{scale})").cast("string"), r"\.?0+$", ""
    )
    power = F.regexp_replace(F.regexp_replace(number.cast("string"), r"(?:\.0)?E", "e"), r"e(?=\d)", "e+")
    # In this range a double is written out in full, so its own spelling is the shortest.
    return (
        F.when(whole, number.try_cast("bigint").cast("string"))
        .when((size >= F.lit(1e-3)) & (size < F.lit(1e7)), number.cast("string"))
        .when((size >= F.lit(1e-6)) & (size < F.lit(1.0)), plain(30))
        .when((size >= F.lit(1.0)) & (size < F.lit(1e21)), plain(17))
        .otherwise(power)
    )


def _hexadecimal(digits: Column) -> Column:
    """The double that hexadecimal digits spell, however many they are."""
    return F.aggregate(
        F.split(F.lower(digits), "(?!^)"), F.lit(0.0),
        lambda total, c: F.when(c == "", total).otherwise(total * 16 + F.conv(c, 16, 10).cast("double")),
    )


def short_decimal_text(text: Column) -> Column:
    """A ``CASE`` that gives short decimals as ``number_text`` would, without making them doubles."""
    return F.when(text.rlike(SPELLED), text).when(text.rlike(SHORT_DECIMAL), F.regexp_replace(text, IDLE_ZEROS, ""))


def as_number(value: Column | str) -> Column:
    """``23.976`` and ``23.9760`` become one spelling; other text is left as it is."""
    value = _col(value)
    text = trimmed(value)
    return (
        F.when(value.rlike(SPELLED), value)
        .when(text.rlike(SHORT_DECIMAL), F.regexp_replace(text, IDLE_ZEROS, ""))
        .when(text.rlike(PLAIN_NUMBER), number_text(text.try_cast("double")))
        .when(text.rlike(r"^0[xX][0-9a-fA-F]+$"), number_text(_hexadecimal(F.substr(text, F.lit(3)))))
        .otherwise(value)
    )


def recorded_seconds(value: Column | str) -> Column:
    """A duration text as a number; absent or unreadable is null."""
    return number_or_null(value)


def positive_count(value: Column | str) -> Column:
    """A count that may be absent, unreadable, negative or infinite: then zero."""
    number = number_or_null(value)
    usable = number.isNotNull() & (number > 0) & (number < F.lit(float("inf")))
    return F.when(usable, number).otherwise(F.lit(0.0))


def ext_name(name: Column | str) -> Column:
    """Lower-cased last extension with its dot; none is null.

    A leading dot starts a hidden name, not an extension.
    """
    return F.nullif(
        F.lower(F.regexp_extract(_col(name), r"[^./](\.[^./]*)$", 1)), F.lit("")
    )


def typed_number(value: Column | str) -> Column:
    """Only a real JSON number; a number spelled as a JSON string is null.

    ``value`` is the raw JSON text of the node.
    """
    value = _col(value)
    return F.when(value.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), value.try_cast("double"))
