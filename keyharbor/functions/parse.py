"""Typed parsing of stored text, as Column expressions.

Six types: string, long, double, boolean, date, datetime. In strict mode a value that its type doesn't allow fails the query
when it is read; in permissive mode it becomes null. Spark's own casts are wider (they trim, and take suffixes), so each
value passes a pattern first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, TimestampNTZType, TimestampType

from keyharbor.errors import SchemaMismatch

#: What each type takes.
LONG = r"^[+-]?[0-9]+$"
DOUBLE = r"(?i)^[+-]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)$"
TRUE = ("true", "1", "yes", "t", "y")
FALSE = ("false", "0", "no", "f", "n")
ISO = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(?:[T ]([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:\.([0-9]+))?)?)?\s*(?:Z|[+-][0-9:]+)?$"
#: Epochs below these many are seconds, below these milliseconds, else microseconds.
SECONDS, MILLIS = 10_000_000_000, 10_000_000_000_000

TYPES: dict[str, DataType] = {
    "string": StringType(), "utf8": StringType(), "long": LongType(), "int64": LongType(), "double": DoubleType(), "float64": DoubleType(),
    "boolean": BooleanType(), "bool": BooleanType(), "date": DateType(), "datetime": TimestampNTZType(),
}


def type_of(named: str | type | DataType) -> DataType:
    """A Spark type from a Spark type, a Python type or a name; others raise."""
    if isinstance(named, str) and named.lower() in TYPES:
        return TYPES[named.lower()]
    found = {str: StringType(), int: LongType(), float: DoubleType(), bool: BooleanType()}.get(named) if isinstance(named, type) else None
    if found is not None:
        return found
    if isinstance(named, IntegerType | ShortType | LongType):
        return LongType()
    if isinstance(named, FloatType | DoubleType):
        return DoubleType()
    if isinstance(named, TimestampType | TimestampNTZType):
        return TimestampNTZType()
    if isinstance(named, StringType | BooleanType | DateType):
        return named
    raise SchemaMismatch(f"not a type of a typed field: {named!r}")


def _long(text: Column) -> Column:
    return F.when(text.rlike(LONG), text.try_cast("bigint"))


def _double(text: Column) -> Column:
    return F.when(text.rlike(DOUBLE), text.try_cast("double"))


def _boolean(text: Column) -> Column:
    bare = F.lower(F.regexp_replace(F.regexp_replace(text, '^"+|"+$', ""), "^'+|'+$", ""))
    return F.when(bare.isin(*TRUE), True).when(bare.isin(*FALSE), False)


def _date(text: Column) -> Column:
    """Whole numbers are days since 1970; else y-m-d, where days run on past short months (2023-02-30 is 2 March)."""
    part = lambda k: F.regexp_extract(text, r"^(-?[0-9]+)-([0-9]{1,2})-([0-9]{1,2})", k).try_cast("int")
    good = part(2).between(1, 12) & part(3).between(1, 31) & part(1).between(1, 9999)
    days = text.try_cast("int")
    return F.when(text.rlike(LONG), F.date_add(F.lit("1970-01-01").cast("date"), days)).when(good, F.date_add(F.make_date(part(1), part(2), F.lit(1)), part(3) - 1))


def _datetime(text: Column) -> Column:
    """Whole numbers are epochs (by size: seconds, milliseconds, microseconds), else ISO; an offset is dropped, not applied."""
    bare = F.trim(text)
    epoch = bare.try_cast("bigint")
    micros = F.when(epoch < SECONDS, epoch * 1_000_000).when(epoch < MILLIS, epoch * 1_000).otherwise(epoch)
    part = lambda k: F.regexp_extract(bare, ISO, k)
    number = lambda k: F.when(part(k) == "", 0).otherwise(part(k).try_cast("int"))
    fraction = F.rpad(F.substring(part(7), 1, 6), 6, "0").try_cast("bigint")
    day = F.datediff(_date(bare), F.lit("1970-01-01").cast("date")).cast("bigint")
    of_iso = ((day * 24 + number(4)) * 60 + number(5)) * 60 + number(6)
    iso = F.when(bare.rlike(ISO) & (number(4) < 24) & (number(5) < 60) & (number(6) < 60), of_iso * 1_000_000 + F.coalesce(fraction, F.lit(0)))
    return from_micros(F.when(bare.rlike(LONG), micros).otherwise(iso))


def from_micros(micros: Column) -> Column:
    """A timestamp without zone from microseconds since 1970, in whatever zone the session is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_micros(micros).cast("timestamp_ntz"))


def parsed(text: Column, to: str | type | DataType, strict: bool = True) -> Column:
    """text as a value of the type. Null stays null; a value that the type doesn't allow fails (strict) or is null."""
    kind = type_of(to)
    if isinstance(kind, StringType):
        return text
    how = {LongType: _long, DoubleType: _double, BooleanType: _boolean, DateType: _date, TimestampNTZType: _datetime}[type(kind)]
    value = how(text)
    if not strict:
        return value
    wrong = F.raise_error(F.concat(F.lit(f"not a {kind.simpleString()}: "), text)).cast(kind)
    return F.when(text.isNotNull() & value.isNull(), wrong).otherwise(value)
