"""Typed field values: constructors, strict number parsing and number text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from gaugeloom.functions.maps import let
from gaugeloom.model import FIELD, INT64_MAX

_INT = r"\A[+-]?[0-9]+\z"
_FLOAT = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def _slot(kind: str, value: Column) -> Column:
    parts = [F.lit(kind).alias("kind")]
    for f in FIELD.fields[1:]:
        parts.append((value if f.name == kind else F.lit(None)).cast(f.dataType).alias(f.name))
    return F.struct(*parts)


def _typed(kind: str, value: Column) -> Column:
    return F.when(value.isNotNull(), _slot(kind, value))


def int_field(value: Column) -> Column:
    return _typed("i", value.cast("bigint"))


def unsigned_field(value: Column) -> Column:
    """A decimal holding an unsigned 64-bit number; values beyond the signed range are clamped."""
    return _typed("i", F.least(value, F.lit(INT64_MAX).cast("decimal(20,0)")).cast("bigint"))


def finite(value: Column) -> Column:
    """The value, or NULL when it is NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def float_field(value: Column) -> Column:
    return _typed("f", value.cast("double"))


def string_field(value: Column) -> Column:
    return _typed("s", value)


def bool_field(value: Column) -> Column:
    return _typed("b", value)


def list_text(value: Column) -> Column:
    """``[1 2 3]``: the text a list value gets in a point."""
    return F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: x.cast("string")), " "), F.lit("]"))


def field_of(value: Column, dtype: T.DataType) -> Column:
    """Wrap a typed column as a field value; NaN and infinities become NULL and are dropped later."""
    if isinstance(dtype, T.BooleanType):
        return bool_field(value)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float_field(finite(value.cast("double")))
    if isinstance(dtype, T.DecimalType):
        return unsigned_field(value) if dtype.scale == 0 else float_field(value)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int_field(value)
    if isinstance(dtype, T.ArrayType):
        return string_field(list_text(value))
    if isinstance(dtype, T.StructType):
        return value
    return string_field(value.cast("string"))


def _is_int(text: Column) -> Column:
    """Whole number that fits 64 bits. Tested on the text, because a cast that fails is slow: it raises inside."""
    digits = F.regexp_replace(text, r"\A[+-]?0*", "")
    limit = F.when(text.startswith("-"), F.lit(str(INT64_MAX + 1))).otherwise(F.lit(str(INT64_MAX)))
    fits = (F.length(digits) < 19) | ((F.length(digits) == 19) & (digits <= limit))
    return text.rlike(_INT) & ((F.length(text) < 19) | fits)


def _special(text: Column) -> Column:
    low = F.lower(text)
    return (F.when(low == "nan", F.lit(float("nan")))
            .when(low.isin("-inf", "-infinity"), F.lit(float("-inf")))
            .when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))))


def strict_int(text: Column) -> Column:
    """Base-10 signed 64-bit number, or NULL. No blanks, no fraction."""
    return F.when(_is_int(text), text.try_cast("bigint"))


def strict_float(text: Column) -> Column:
    """Decimal or exponent number, or the texts inf/infinity/nan; out-of-range numbers are NULL."""
    return F.when(text.rlike(_FLOAT), finite(text.try_cast("double"))).otherwise(_special(text))


def parse_value(text: Column, version: int = 1) -> Column:
    """Server variable text as a field value, by metric version; NULL when the value is dropped."""
    if version < 2:
        return float_field(F.when(text.isin("Yes", "ON"), F.lit(1.0))
                           .when(text.isin("No", "OFF"), F.lit(0.0))
                           .otherwise(strict_float(text)))
    low = F.lower(text)
    return (F.when((low == "yes") | (text == "ON"), int_field(F.lit(1)))
            .when((low == "no") | (text == "OFF"), int_field(F.lit(0)))
            .when(text != "", int_float_string(text)))


def int_else_string(text: Column) -> Column:
    return F.when(_is_int(text), _slot("i", text.try_cast("bigint"))).when(text.isNotNull(), _slot("s", text))


def int_float_string(text: Column) -> Column:
    number = text.try_cast("double")
    return (F.when(_is_int(text), _slot("i", text.try_cast("bigint")))
            .when(text.rlike(_FLOAT) & (F.abs(number) != float("inf")), _slot("f", number))
            .when(_special(text).isNotNull(), _slot("f", _special(text)))
            .when(text.isNotNull(), _slot("s", text)))


def plain_number(value: Column) -> Column:
    """Shortest decimal text of a double, never with an exponent: 1.5E7 is ``15000000``."""
    return let(value.cast("string"), lambda text: F.when(
        F.length(text) > 16, let(_shortest(value, text), _without_exponent)).otherwise(_without_exponent(text)))


def _shortest(value: Column, text: Column) -> Column:
    """The first of 15, 16 and 17 digits that reads back as the same number.

    The JVM's own text of a long number can have a digit more than it needs.
    """
    def same(digits: int) -> Column:
        shown = F.format_string(f"%.{digits - 1}e", value)
        return let(shown, lambda t: F.when(t.try_cast("double") == value, F.upper(F.replace(t, F.lit("+"), F.lit("")))))

    return F.coalesce(same(15), same(16), same(17), text)


def _without_exponent(text: Column) -> Column:
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    bare = F.regexp_replace(text, r"\A-", "")
    whole = F.regexp_extract(bare, r"\A([0-9]+)", 1)
    frac = F.regexp_replace(F.regexp_extract(bare, r"\.([0-9]+)", 1), r"0+\z", "")
    exp = F.regexp_extract(bare, r"E(-?[0-9]+)\z", 1).try_cast("int")
    digits = F.concat(whole, frac)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    large = F.when(F.length(frac) <= exp, F.rpad(digits, F.length(whole) + exp, F.lit("0"))).otherwise(
        F.concat(F.substring(digits, F.lit(1), exp + 1), F.lit("."),
                 F.substring(digits, exp + 2, F.length(digits))))
    moved = F.concat(sign, F.when(exp < 0, small).otherwise(large))
    whole_number = F.substring(text, F.lit(1), F.length(text) - 2)
    return F.when(text.contains("E"), moved).when(text.endswith(".0"), whole_number).otherwise(text)


def field_text(field: Column) -> Column:
    """Field value as plain text, without quotes or type marks."""
    return (F.when(field["kind"] == "i", field["i"].cast("string"))
            .when(field["kind"] == "f", plain_number(field["f"]))
            .when(field["kind"] == "b", field["b"].cast("string"))
            .otherwise(field["s"]))


def bool_text(value: Column) -> Column:
    return F.coalesce(value, F.lit(False)).cast("string")


def bool_number(value: Column) -> Column:
    return F.coalesce(value, F.lit(False)).cast("bigint")
