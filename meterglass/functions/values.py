"""Document values as typed columns: ids, instants, money, flags, nested text.

Each function takes the document frame and a field name and gives a Column, so
one ``select`` builds a whole normalised row inside the JVM. A field the source
lacks reads as NULL, as a missing key does.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterglass import domain

_NESTED = (T.StructType, T.ArrayType, T.MapType)
TRUE_WORDS = ("true", "1", "yes", "t")

# One JSON token: a quoted text, a run of other characters, or a separator.
_JSON_TOKEN = r'("(?:[^"\\]|\\.)*"|[^",:]+|[,:])'
_DATE_ONLY = r"^\d{4}-\d{2}-\d{2}$"
_NO_OFFSET = r"[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"


def raw_name(name: str) -> str:
    """Column that holds the source's JSON text of a field."""
    return f"{name}__json"


def _dtype(docs: DataFrame, name: str) -> T.DataType | None:
    return docs.schema[name].dataType if name in docs.columns else None


def _text(docs: DataFrame, name: str) -> Column:
    dtype = _dtype(docs, name)
    if dtype is None:
        return F.lit(None).cast("string")
    field = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        return field
    if isinstance(dtype, _NESTED):
        return F.to_json(field, {"ignoreNullFields": "false"})
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(field, "$", "string")
    return field.cast("string")


def _kind(docs: DataFrame, name: str) -> Column:
    """STRING, BOOLEAN, OBJECT<..>, ARRAY<..>, VOID or a number's type, of a variant."""
    return F.schema_of_variant(F.col(f"`{name}`"))


def _unwrapped(docs: DataFrame, name: str, wrapper: str) -> Column:
    """The bare text of a value that may sit in a one-key wrapper object."""
    dtype = _dtype(docs, name)
    if isinstance(dtype, T.StructType) and wrapper in dtype.names:
        return F.col(f"`{name}`").getField(wrapper).cast("string")
    text = _text(docs, name)
    if isinstance(dtype, T.VariantType):
        return F.coalesce(F.try_variant_get(F.col(f"`{name}`"), f"$['{wrapper}']", "string"), text)
    return F.coalesce(F.get_json_object(text, f"$['{wrapper}']"), text)


def _required(value: Column, message: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(message)))


def object_id_string(docs: DataFrame, name: str = "_id", required: bool = True) -> Column:
    value = _unwrapped(docs, name, "$oid")
    return _required(value, f"document without {name}") if required else value


def to_utc_timestamp(docs: DataFrame, name: str, required: bool = True) -> Column:
    """Instant of a typed value, a wrapped value or ISO text; no offset means UTC."""
    dtype = _dtype(docs, name)
    if isinstance(dtype, T.TimestampType):
        value = F.col(f"`{name}`")
    else:
        if isinstance(dtype, T.TimestampNTZType):
            text = F.date_format(F.col(f"`{name}`"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        else:
            text = _unwrapped(docs, name, "$date")
        text = F.regexp_replace(text, _DATE_ONLY, "$0T00:00:00Z")
        value = F.regexp_replace(text, _NO_OFFSET, "$0Z").cast("timestamp")
    return _required(value, f"document without {name}") if required else value


def to_decimal(docs: DataFrame, name: str, scale: T.DecimalType = domain.PRICE) -> Column:
    """Exact decimal read from text, never through a double."""
    return _unwrapped(docs, name, "$numberDecimal").cast(scale)


def money_or_null(docs: DataFrame, name: str) -> Column:
    """Six places, half up: the text-to-decimal cast rounds once at the target scale."""
    return to_decimal(docs, name, domain.MONEY)


def to_money(value: Column) -> Column:
    return F.round(F.coalesce(value, F.lit(Decimal(0))), 6).cast(domain.MONEY)


def cost_thb(usd: Column, rate: Decimal = domain.EXCHANGE_RATE) -> Column:
    """Local-currency cost; a missing dollar amount costs zero."""
    return F.round(to_money(usd) * F.lit(rate), 6).cast(domain.MONEY)


def to_int(docs: DataFrame, name: str) -> Column:
    """Whole number: numbers lose their fraction, text that is not a whole number fails the job."""
    dtype = _dtype(docs, name)
    field = F.col(f"`{name}`")
    if isinstance(dtype, T.NumericType):
        return field.cast("bigint")
    if isinstance(dtype, T.VariantType):
        return (F.when(_kind(docs, name) == "STRING", _text(docs, name).cast("bigint"))
                .when(_kind(docs, name) == "BOOLEAN", F.try_variant_get(field, "$", "boolean").cast("bigint"))
                .otherwise(F.variant_get(field, "$", "decimal(38,9)").cast("bigint")))
    return _text(docs, name).cast("bigint")


def to_string(docs: DataFrame, name: str) -> Column:
    return _text(docs, name)


def to_boolean(docs: DataFrame, name: str) -> Column:
    """Flag; unknown text is false, a missing value stays NULL."""
    dtype = _dtype(docs, name)
    if isinstance(dtype, T.BooleanType):
        return F.col(f"`{name}`")
    if isinstance(dtype, T.NumericType):
        return F.col(f"`{name}`") != 0
    if isinstance(dtype, T.VariantType):
        text = _text(docs, name)
        number = F.try_variant_get(F.col(f"`{name}`"), "$", "double") != 0
        return F.when(_kind(docs, name).isin("STRING", "BOOLEAN"), F.lower(F.trim(text)).isin(*TRUE_WORDS)).otherwise(
            F.coalesce(number, ~text.isin("{}", "[]")))
    return F.lower(F.trim(_text(docs, name))).isin(*TRUE_WORDS)


def json_text(docs: DataFrame, name: str) -> Column:
    """Nested value as JSON text with one blank after every comma and colon."""
    text = _text(docs, name)
    raw = F.col(f"`{raw_name(name)}`") if raw_name(name) in docs.columns else text
    tokens = F.regexp_extract_all(raw, F.lit(_JSON_TOKEN), F.lit(1))
    # Outside quoted text the source's own blanks go, then separators get theirs.
    spaced = F.array_join(F.transform(tokens, lambda t: (
        F.when(t.isin(",", ":"), F.concat(t, F.lit(" ")))
        .when(t.startswith('"'), t)
        .otherwise(F.regexp_replace(t, r"\s+", "")))), "")
    quoted = F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'^\{"v":(.*)\}$', 1)
    if isinstance(_dtype(docs, name), _NESTED):
        return spaced
    if isinstance(_dtype(docs, name), T.VariantType):
        return F.when(_kind(docs, name) == "STRING", quoted).when(_kind(docs, name) != "VOID", spaced)
    return F.when(text.rlike(r"^[\[{]"), spaced).when(text.isNotNull(), quoted)


def safe_bigint(value: Column) -> Column:
    """Text to whole number; anything else is NULL."""
    return value.try_cast("bigint")
