"""Exact decimals: the capture connector's wire form and the stored money type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

MONEY = T.DecimalType(13, 5)
_WIRE = T.StructType(
    [T.StructField("scale", T.IntegerType()), T.StructField("value", T.StringType())]
)


def _unscaled(base64_text: Column) -> Column:
    """Big-endian two's-complement bytes (at most 16) as decimal(38,0)."""
    digits = F.hex(F.unbase64(base64_text))
    negative = F.conv(F.substring(digits, 1, 1), 16, 10).cast("int") >= 8
    wide = F.when(negative, F.lpad(digits, 32, "F")).otherwise(F.lpad(digits, 32, "0"))
    high = F.conv(F.substring(wide, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast("decimal(20,0)")
    two64 = F.lit("18446744073709551616").cast("decimal(20,0)")
    signed_high = F.when(negative, high - two64).otherwise(high).cast("decimal(18,0)")
    value = F.try_add(F.try_multiply(signed_high, two64), low).try_cast("decimal(38,0)")
    return F.when(F.length(digits).between(1, 32), value)


def wire_decimal(text: Column) -> Column:
    """Accept ``{"scale":2,"value":"EJo="}``, a JSON string or a JSON number."""
    packed = F.from_json(text, _WIRE)
    digits = F.concat(_unscaled(packed["value"]).cast("string"), F.lit("E-"), packed["scale"].cast("string"))
    number = F.when(F.startswith(F.ltrim(text), F.lit("{")), digits).otherwise(text)
    return number.try_cast("decimal(38,10)")


def money(value: Column) -> Column:
    """Round half-up to NUMERIC(13,5); null when it does not fit."""
    return value.try_cast(MONEY)


def line_amount(quantity: Column, price: Column) -> Column:
    """quantity x price, a missing price counting as zero; null on overflow."""
    price = F.coalesce(price, F.lit(0).cast(MONEY))
    return money(quantity.cast("decimal(13,0)") * price)
