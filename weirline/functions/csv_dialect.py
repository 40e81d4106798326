"""The CSV dialect: text quoted, NULL bare empty, booleans t/f, floats plain, bytes in hex.

Everything is a Column expression, so rendering stays in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConfigError, UnsupportedType

NUL = "\x00"


def quote(text: Column) -> Column:
    """In double quotes, inner ones doubled; NUL characters dropped."""
    return F.concat(F.lit('"'), F.replace(F.replace(text, F.lit(NUL), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def bool_text(c: Column) -> Column:
    return F.when(c, F.lit("t")).otherwise(F.lit("f"))


def int_text(c: Column) -> Column:
    return c.cast("string")


#: Of a number with at most so many digits no other with as few is the same double, or float (fixed values); smallest normal ones.
SURE = {False: 15, True: 6}
NORMAL = {False: 2.2250738585072014e-308, True: 1.1754943508222875e-38}


def _let(value: Column, body) -> Column:
    """body of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _shorter(digits: Column, exponent: Column, size: Column, single: bool) -> Column:
    """The fewest digits (as a long) and their exponent that are cast back to a number of this size, the nearest of several.

    digits, a text, times ten to the exponent is such a number, but the JVM's text has a digit too many now and then.
    """
    n, whole, kind = F.length(digits), digits.cast("long"), "float" if single else "double"

    def away(x: Column, power: Column) -> Column:
        """Exactly for floats: a double tells texts of so few digits from a float's value."""
        return F.abs(F.concat(x.cast("string"), F.lit("E"), power.cast("string")).cast("double") - size.cast("double"))

    def at(k: Column) -> Column:
        """The number of k digits that is cast back, where there is one: the digits rounded, else to the other side."""
        unit = F.pow(F.lit(10.0), n - k).cast("long")
        up = F.call_function("div", whole, unit) + 1
        power = (exponent + n - k).cast("string")
        back = lambda x: F.concat(x.cast("string"), F.lit("E"), power).cast(kind) == size
        rounded = away(up, power) < away(up - 1, power) if single else 2 * (whole % unit) >= unit
        near = F.when(rounded, up).otherwise(up - 1)
        far = 2 * up - 1 - near
        found = F.when(back(near), near).when(back(far), far)
        return F.when(n > k, F.struct(found.alias("digits"), (exponent + n - k).alias("exponent")))

    if single:
        own = away(whole, exponent)
        whole = F.when(away(whole + 1, exponent) < own, whole + 1).when(away(whole - 1, exponent) < own, whole - 1).otherwise(whole)
    as_it_is = F.struct(whole.alias("digits"), exponent.alias("exponent"))
    good = lambda x: x["digits"].isNotNull()
    sure = SURE[single]
    tries = F.when(size < NORMAL[single], F.sequence(F.lit(1), n)).otherwise(F.array(*(F.lit(sure + k) for k in range(4 if single else 3))))
    return F.coalesce(F.get(F.filter(F.transform(tries, at), good), F.lit(0)), as_it_is)


def _plain(digits: Column, exponent: Column) -> Column:
    """digits times ten to the exponent without an E."""
    text = F.rtrim(digits.cast("string"), F.lit("0"))

    def shown(d: Column) -> Column:
        point = F.length(digits.cast("string")) + exponent  # digits before the point
        n = F.length(d)
        return (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), d))
            .when(point >= n, F.concat(d, F.repeat(F.lit("0"), point - n)))
            .otherwise(F.concat(F.left(d, point), F.lit("."), F.substring(d, point + 1, n)))
        )

    return _let(text, shown)


def float_text(c: Column, single: bool = False) -> Column:
    """Shortest digits that are cast back to the same double (single: float), never scientific, integral values without a fraction;
    NaN, inf, -inf.

    Most values have few digits, and the JVM's text is theirs. The others are tried with fewer digits than the JVM gives; of
    numbers with 17 digits, where several are cast back, it is the JVM's, which for one double in 30,000 isn't the nearest.
    """
    s = c.cast("string")
    few = (F.length(s) <= SURE[single] + 1) & ~F.contains(s, F.lit("E"))
    body = F.ltrim(s, F.lit("-"))
    mantissa = F.substring_index(body, "E", 1)
    power = F.when(F.contains(body, F.lit("E")), F.substring_index(body, "E", -1)).otherwise(F.lit("0")).cast("int")
    digits = F.ltrim(F.translate(mantissa, ".", ""), F.lit("0"))
    kept = F.rtrim(digits, F.lit("0"))
    exponent = power - F.length(F.substring_index(mantissa, ".", -1)) + F.length(digits) - F.length(kept)
    parsed = F.struct(kept.alias("digits"), exponent.alias("exponent"), F.abs(c).alias("size"))
    long = _let(parsed, lambda p: _let(_shorter(p["digits"], p["exponent"], p["size"], single), lambda x: _plain(x["digits"], x["exponent"])))
    return (
        F.when(F.isnan(c), F.lit("NaN"))
        .when(s == "Infinity", F.lit("inf")).when(s == "-Infinity", F.lit("-inf"))
        .when(few, F.when(F.endswith(s, F.lit(".0")), F.left(s, F.length(s) - 2)).otherwise(s))
        .otherwise(F.concat(F.when(F.startswith(s, F.lit("-")), F.lit("-")).otherwise(F.lit("")), long))
    )


def float_text_exact(c: Column, single: bool = False) -> Column:
    """As float_text with the shortest digits that round-trip, by an Arrow UDF."""
    import numpy as np

    kind = np.float32 if single else np.float64

    @F.pandas_udf("string")
    def shown(values):
        plain = lambda x: "NaN" if x != x else ("inf" if x > 0 else "-inf") if np.isinf(x) else np.format_float_positional(kind(x), unique=True, trim="-")
        return values.map(plain)

    # A null and a NaN look alike to pandas: nulls are taken out first.
    return F.when(c.isNull(), F.lit(None)).otherwise(shown(c))


def decimal_text(c: Column) -> Column:
    """Plain, the fraction padded to the scale (the session must be in ANSI mode)."""
    return c.cast("string")


def date_text(c: Column) -> Column:
    return c.cast("string")


def timestamp_text(c: Column, zoned: bool = False) -> Column:
    """Fraction without trailing zeros; with a zone: in UTC (the session's zone), and +00."""
    return F.concat(c.cast("string"), F.lit("+00")) if zoned else c.cast("string")


def bytes_text(c: Column) -> Column:
    return F.concat(F.lit("\\x"), F.lower(F.hex(c)))


def cell(c: Column, kind: T.DataType) -> Column:
    """One cell; NULL is bare empty, the empty text is two quotes."""
    if isinstance(kind, T.BooleanType):
        out = bool_text(c)
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        out = int_text(c)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        out = float_text(c, isinstance(kind, T.FloatType))
    elif isinstance(kind, T.DecimalType):
        out = decimal_text(c)
    elif isinstance(kind, T.DateType):
        out = date_text(c)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = timestamp_text(c, isinstance(kind, T.TimestampType))
    elif isinstance(kind, T.BinaryType):
        out = bytes_text(c)
    elif isinstance(kind, T.StringType):
        out = quote(c)
    else:
        raise UnsupportedType(kind.simpleString())
    return F.when(c.isNull(), F.lit("")).otherwise(out)


def check_delimiter(delimiter: str) -> str:
    if len(delimiter) != 1 or delimiter in '"\n\r':
        raise ConfigError(f"{delimiter!r} can't be a delimiter")
    return delimiter


def row_text(schema: T.StructType, delimiter: str = ",") -> Column:
    """A row as one line, without its newline."""
    check_delimiter(delimiter)
    name = lambda f: F.col("`" + f.name.replace("`", "``") + "`")
    cells = [cell(name(f), f.dataType) for f in schema]
    return reduce(lambda a, b: F.concat(a, F.lit(delimiter), b), cells)


def header_text(names: list[str], delimiter: str = ",") -> str:
    """Every name in quotes."""
    return check_delimiter(delimiter).join('"' + n.replace(NUL, "").replace('"', '""') + '"' for n in names)


def parse_cell(c: Column, kind: T.DataType) -> Column:
    """A cell's text back to its type (null stays null)."""
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.substring(c, F.lit(3), F.length(c)))
    return c if isinstance(kind, T.StringType) else c.cast(kind)
