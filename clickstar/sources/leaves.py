"""Nested records with every leaf as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# The least double that is not held with fewer bits.
LEAST_NORMAL = 2.2250738585072014e-308


def _shortest(c: Column) -> Column:
    """Fewest digits that read back as the same double, where Java writes more.

    Fifteen digits that read back are the only ones that do; below them Java's own text is cut for the
    smallest doubles only, which are held with fewer bits.  Of several texts of 17 digits Java's stays,
    which may not be the nearest in its last digit.
    """

    def rounded(places: int) -> Column:
        return F.upper(F.format_string(f"%.{places}e", c))

    def fewest(text: Column) -> Column:
        digits = F.length(F.translate(_mantissa(text), "-.", ""))
        tiny = (F.abs(c) < LEAST_NORMAL) & (c != 0)
        result = F.when((digits < 16) & ~tiny, text)
        for places in range(14):
            result = result.when(tiny & (rounded(places).try_cast("double") == c), rounded(places))
        # Sixteen digits: the nearest to Java's text, or one of its neighbours.
        cut = F.regexp_replace(rounded(16), "[0-9]E", "E")
        steps = F.translate(_mantissa(cut), "-.", "").try_cast("bigint") + 1
        above = F.concat(
            F.when(c < 0, "-").otherwise(""), F.substring(steps.cast("string"), 1, 1), F.lit("."),
            F.substring(steps.cast("string"), 2, 16), F.lit("E"), F.substring_index(cut, "E", -1),
        )
        for fewer in (rounded(14), rounded(15), cut, above, F.when(digits < 17, text), rounded(16)):
            result = result.when(fewer.try_cast("double") == c, fewer)
        return result.otherwise(text)

    return _let(c.cast("string"), fewest)


def _mantissa(text: Column) -> Column:
    return F.substring_index(text, "E", 1)


def _exponent_text(c: Column) -> Column:
    def written(text: Column) -> Column:
        exponent = F.substring_index(text, "E", -1).try_cast("int")
        digits = F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0"))
        mantissa = F.regexp_replace(_mantissa(text), r"\.?0+$", "")
        plain = F.rtrim(text.try_cast("decimal(38,22)").cast("string"), F.lit("0"))
        return (
            F.when(~text.contains("E"), text)
            .when(exponent.between(-4, 15), F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain))
            .otherwise(F.concat(mantissa, F.when(exponent < 0, "e-").otherwise("e+"), digits))
        )

    return (
        F.when(F.isnan(c), "nan")
        .when(F.abs(c) == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when(c.isNotNull(), _let(_shortest(c), written))
    )


def float_text(c: Column) -> Column:
    """Double as ``10000000.0``, ``0.0001``, ``1e+16`` or ``1.5e-05``: an exponent only where the
    number is below 1e-4 or from 1e16 on.

    Numbers of usual size and few digits are already written so and skip the rest.
    """
    text = c.cast("string")
    usual = (F.length(text) < 17) & ~text.contains("E") & ~text.contains("N") & ~text.contains("I")
    return F.when(usual, text).otherwise(_let(c, _exponent_text))


def leaf_text(c: Column, data_type: T.DataType) -> Column:
    """Text of one scalar: ISO-8601 dates and times, base64 bytes, true/false, plain numbers."""
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return float_text(c.cast("double"))
    if isinstance(data_type, T.BinaryType):
        # base64() breaks lines; the text form must not.
        return F.regexp_replace(F.base64(c), r"\s", "")
    if isinstance(data_type, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        zone = "XXX" if isinstance(data_type, T.TimestampType) else ""
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(c, "SSSSSS")
        fraction = F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))
        offset = F.regexp_replace(F.date_format(c, zone), "Z", "+00:00") if zone else F.lit("")
        return F.concat(whole, fraction, offset)
    if isinstance(data_type, T.NullType):
        return F.lit(None).cast("string")
    return c.cast("string")


def text_type(data_type: T.DataType) -> T.DataType:
    """The same nesting with string leaves."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, text_type(f.dataType)) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(text_type(data_type.elementType))
    if isinstance(data_type, T.MapType):
        return T.MapType(T.StringType(), text_type(data_type.valueType))
    return T.StringType()


def text_leaves(c: Column, data_type: T.DataType) -> Column:
    """Column with the nesting of ``data_type`` kept and each leaf turned into text."""
    if text_type(data_type) == data_type:
        return c
    if isinstance(data_type, T.StructType):
        fields = [text_leaves(c[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, _leaf_function(data_type.elementType))
    if isinstance(data_type, T.MapType):
        keyed = F.transform_keys(c, lambda k, v: leaf_text(k, data_type.keyType))
        return F.transform_values(keyed, lambda k, v: text_leaves(v, data_type.valueType))
    return leaf_text(c, data_type)


def _leaf_function(data_type: T.DataType) -> Callable[[Column], Column]:
    return lambda element: text_leaves(element, data_type)


def with_text_leaves(df: DataFrame) -> DataFrame:
    """All columns with text leaves; only built-in expressions, so it runs inside the scan stage."""
    return df.select(*[text_leaves(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
