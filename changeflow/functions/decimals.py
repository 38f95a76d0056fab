"""DECIMAL columns on the wire: base64 of the unscaled big-endian bytes, string, or JSON number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("base64", "string", "number")


def _signed_long(hex_digits: Column) -> Column:
    fill = F.when(F.substring(hex_digits, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0"))
    padded = F.concat(F.repeat(fill, 16 - F.length(hex_digits)), hex_digits)
    return F.conv(padded, 16, -10).cast("decimal(38,0)")


def _signed_wide(hex_digits: Column) -> Column:
    # Sixteen bytes as two unsigned halves; a negative number is taken through its bitwise complement.
    negative = F.substring(hex_digits, 1, 1) >= "8"
    digits = F.when(negative, F.translate(hex_digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(hex_digits)
    padded = F.concat(F.repeat(F.lit("0"), 32 - F.length(digits)), digits)
    high = F.conv(F.substring(padded, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(padded, 17, 16), 16, 10).cast("decimal(20,0)")
    # Sixteen bytes can hold more than 38 digits; such a number becomes null.
    shifted = F.try_multiply(high, F.lit(str(2**64)).cast("decimal(20,0)"))
    magnitude = F.try_add(shifted, F.when(negative, low + 1).otherwise(low).cast("decimal(38,0)"))
    # Taken from zero: the minus sign and abs() round to 34 digits.
    below = F.try_subtract(F.lit(0).cast("decimal(38,0)"), magnitude)
    return F.when(negative, below).otherwise(magnitude).try_cast("decimal(38,0)")


def _with_point(unscaled: Column, scale: int) -> Column:
    # The point is set among the digits: a decimal division would round numbers of close to 38 digits.
    if scale == 0:
        return unscaled.cast("string")
    sign = F.when(unscaled < 0, F.lit("-")).otherwise(F.lit(""))
    digits = F.ltrim(unscaled.cast("string"), F.lit("-"))
    padded = F.concat(F.repeat(F.lit("0"), scale + 1 - F.length(digits)), digits)
    whole = F.substr(padded, F.lit(1), F.length(padded) - scale)
    fraction = F.substr(padded, F.length(padded) - scale + 1)
    return F.concat(sign, whole, F.lit("."), fraction)


def decode_decimal(value: Column, mode: str, precision: int, scale: int) -> Column:
    """``value`` as ``DECIMAL(precision, scale)``; null where it cannot be read as one."""
    target = f"decimal({precision},{scale})"
    if mode in ("string", "number"):
        return value.try_cast(target)
    if mode != "base64":
        raise ValueError(f"decimal mode must be one of {MODES}, not {mode!r}")
    hex_digits = F.hex(F.try_to_binary(value, F.lit("base64")))
    size = F.length(hex_digits)
    unscaled = F.when(size.between(2, 16), _signed_long(hex_digits))
    if precision > 18:
        unscaled = unscaled.when(size.between(18, 32), _signed_wide(hex_digits))
    return _with_point(unscaled, scale).try_cast(target)


def encode_decimal(value: Column, mode: str, scale: int) -> Column:
    """The wire text of a decimal; ``base64`` holds at most 18 digits."""
    if mode in ("string", "number"):
        return value.cast("string")
    if mode != "base64":
        raise ValueError(f"decimal mode must be one of {MODES}, not {mode!r}")
    unscaled = (value * F.lit(10**scale)).cast("bigint")
    padded = F.lpad(F.hex(unscaled), 16, "0")
    # Drop every leading byte that only repeats the sign.
    shortest = F.when(unscaled < 0, F.regexp_replace(padded, "^(?:FF)*(?=[89A-F])", "")).otherwise(
        F.regexp_replace(padded, "^(?:00)*(?=[0-7][0-9A-F])", "")
    )
    return F.base64(F.unhex(shortest))
