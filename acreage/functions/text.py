"""Text, date, unit and JSON expressions. All are native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SQFT_PER_ACRE = 43560.0
SQFT_PER_SQM = 10.7639
PRICE_HISTORY = "array<struct<date: string, price: double, priceChangeRate: double>>"


def title_case(c: Column) -> Column:
    """First letter of each alphanumeric run in upper case, the rest in lower case; ends trimmed."""
    runs = F.regexp_extract_all(F.lower(F.trim(c)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, F.lit(2), F.length(x)))), "")


def full_address(*parts: Column) -> Column:
    """Parts joined by comma and space; nulls are left out."""
    return F.concat_ws(", ", *parts)


def mapped(c: Column, pairs: dict[str, str], other: Column | None = None) -> Column:
    """The first matching entry of a category map, in lower case; ``other`` or null without one."""
    low = F.lower(F.trim(c))
    out = None
    for key, value in pairs.items():
        out = F.when(low == key, F.lit(value)) if out is None else out.when(low == key, F.lit(value))
    return out.otherwise(other if other is not None else F.lit(None))


def to_sqft(value: Column, unit: Column, unknown_is_sqft: bool) -> Column:
    """Area in square feet by the unit's name; an unknown unit gives null, or the value unchanged."""
    rest = value if unknown_is_sqft else F.lit(None).cast("double")
    return (
        F.when(unit.ilike("%acre%"), value * SQFT_PER_ACRE)
        .when(unit.ilike("%sqm%") | unit.ilike("%square m%"), value * SQFT_PER_SQM)
        .when(unit.ilike("%sq%"), value)
        .otherwise(rest)
    )


def text_to_date(c: Column) -> Column:
    """The leading yyyy-mm-dd of a text, if it is a date."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))


def digits(c: Column) -> Column:
    """The digits of a text as an integer; null without any."""
    return F.regexp_replace(c, "[^0-9]", "").try_cast("int")


def single_json(c: Column) -> Column:
    """JSON text that may have been encoded twice, as JSON text that is encoded once; null if it isn't JSON."""
    parsed = F.try_parse_json(c)
    return F.coalesce(F.try_variant_get(parsed, "$", "string"), F.when(parsed.isNotNull(), c))


def price_history(c: Column) -> Column:
    """A listing's price history from JSON text, encoded once or twice."""
    return F.from_json(single_json(c), PRICE_HISTORY)


def clean_json(c: Column) -> Column:
    """JSON text in canonical form; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(c))


def list_items(c: Column) -> Column:
    """Items of a list written as text, such as ``{a,"b"}`` or ``['a', 'b']``."""
    bare = F.regexp_replace(c, r"[\[\]{}\"']", "")
    return F.filter(F.transform(F.split(bare, ","), lambda x: F.trim(x)), lambda x: x != "")


def valid_utf8(c: Column) -> Column:
    """The text without bytes that aren't UTF-8."""
    return F.when(F.is_valid_utf8(c), c).otherwise(F.replace(F.make_valid_utf8(c), F.lit("\ufffd"), F.lit("")))


def plain_values(c: Column, kind: T.DataType) -> Column:
    """A value of any nesting with its texts in valid UTF-8 and its dates and times as ISO text."""
    if isinstance(kind, T.StringType):
        return valid_utf8(c)
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: plain_values(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(F.transform_keys(c, lambda k, _: plain_values(k, kind.keyType)), lambda _, v: plain_values(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(plain_values(c[f.name], f.dataType).alias(f.name) for f in kind)))
    return c
