"""Text forms of values and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def python_strip(text: Column | str) -> Column:
    return F.trim(_col(text), F.lit(_WHITESPACE))


def normalise_tag(text: Column | str) -> Column:
    return F.upper(python_strip(text))


def safe_int(value: Column | str) -> Column:
    """A whole number or null, truncating fractions of floats; never an error."""
    return _col(value).try_cast("bigint")


def value_text(value: Column | str) -> Column:
    """Shortest text that reads back as the same double, laid out as Python's ``str(float)``.

    In the middle range, where the JVM's layout is the same, its text stands when it has
    at most fifteen significant digits (then there is no other candidate), or when
    neither one nor two digits fewer would read back as the same number: the JVM does not
    always give the shortest text. Larger numbers of at most fifteen digits are written as a decimal. What is left goes to :func:`_shortest_text`.
    """
    v = _col(value)
    size = F.abs(v)
    native, native_size = v.cast("string"), size.cast("string")
    middle = (size >= 1e-3) & (size < 1e7)

    scale = F.length(native_size) - F.instr(native_size, ".")
    whole = F.replace(native_size, F.lit("."), F.lit("")).cast("bigint")

    def reads_back_without(n: int) -> Column:
        rounded = F.call_function("div", whole + F.lit(5 * 10 ** (n - 1)), F.lit(10**n))
        return F.concat(rounded.cast("string"), F.lit("E-"), (scale - n).cast("string")).cast("double") == size

    # Bound as a lambda's variable: a lambda is not inlined into the generated method, which
    # would otherwise be too long for the JVM to compile.
    rare = _with(v, _shortest_text)
    # Above, the JVM writes 1.25E8. Fifteen digits and a point, E and two digits at most.
    upper = (size >= 1e7) & (size < 1e15) & (F.length(native_size) <= 18)
    upper = upper & (F.length(native_size) - F.length(F.substring_index(native_size, "E", -1)) <= 17)
    plain = F.rtrim(v.cast("decimal(30,8)").cast("string"), F.lit("0"))
    return (
        F.when(middle & (F.length(native_size) <= 16) | (v == 0), native)
        .when(upper, F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain))
        .when(middle & ~reads_back_without(1) & ~reads_back_without(2), native)
        .when(v.isNotNull(), rare)
    )


def _with(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _shortest_text(v: Column) -> Column:
    """:func:`value_text` for any number, step by step: its first seventeen digits, the fewest that
    read back, the layout. Each step is computed once and named for the next one."""
    size = F.abs(v)
    digits = F.when((size >= 1e16) & (size < 1e34), _exact_digits(size)).otherwise(_with(size.cast("string"), _jvm_digits))
    laid_out = _with(digits, lambda d: _with(_fewest(d, size), _laid_out))
    return (
        F.when(F.isnan(v), F.lit("nan"))
        .when(v == float("inf"), F.lit("inf"))
        .when(v == float("-inf"), F.lit("-inf"))
        .otherwise(F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), laid_out))
    )


def _number(digits: Column, up: Column, power: Column) -> Column:
    """Seventeen digits as a whole number, what rounding to them adds, and the power of ten of the first one."""
    return F.struct(digits.alias("digits"), up.cast("bigint").alias("up"), power.cast("int").alias("power"))


def _jvm_digits(text: Column) -> Column:
    """Digits of the JVM's own text, ``1.25E-7`` or ``0.00125``; few are smaller than one."""
    mantissa = F.substring_index(text, "E", 1)
    written = F.translate(mantissa, ".", "")
    shift = F.substring_index(text, "E", -1).try_cast("int")

    def of(digits: Column) -> Column:
        power = F.instr(mantissa, ".") - 2 - F.length(written) + F.length(digits) + F.coalesce(shift, F.lit(0))
        return _number(F.rpad(digits, 17, "0").cast("bigint"), F.lit(0), power)

    return _with(F.ltrim(written, F.lit("0")), of)


def _exact_digits(size: Column) -> Column:
    """Digits of a whole number of 1e16 up to 1e34. The JVM's own text may miss the nearest."""
    size = F.least(F.greatest(size, F.lit(1e16)), F.lit(9e33))

    def product(m: Column) -> Column:
        # size = q * 2^m, both whole: m is at most 61.
        q = (size / F.pow(F.lit(2.0), m)).cast("bigint").cast("decimal(19,0)")
        power = F.call_function("shiftleft", F.lit(1).cast("bigint"), m).cast("decimal(19,0)")
        return (q * power).cast("string")

    exact = _with(F.greatest(F.lit(0), F.floor(F.log2(size)).cast("int") - 53), product)
    return _with(exact, lambda t: _number(F.substring(t, 1, 17).cast("bigint"), F.substring(t, 18, 1) >= "5", F.length(t) - 1))


def _fewest(number: Column, size: Column) -> Column:
    """The number rounded to the fewest digits that read back as ``size``: of 15, 16 and 17. The
    smallest numbers have fewer: of those the JVM's text or one digit less."""
    digits, power = number["digits"], number["power"]

    def rounded(zeros: int) -> Column:
        if not zeros:
            return digits + number["up"]
        return F.call_function("div", digits + F.lit(5 * 10 ** (zeros - 1)), F.lit(10**zeros))

    def choice(zeros: int, otherwise: Column) -> Column:
        def checked(made: Column) -> Column:
            back = F.concat(made.cast("string"), F.lit("E"), (power - 16 + zeros).cast("string")).cast("double")
            return F.when(back == size, _chosen(made, power, 17 - zeros)).otherwise(otherwise)

        return _with(rounded(zeros), checked)

    plain = _chosen(rounded(0), power, 17)
    normal = choice(2, choice(1, plain))
    if_one_less = F.length(F.rtrim(digits.cast("string"), F.lit("0"))) == 2
    return F.when(size < 1e-307, F.when(if_one_less, choice(16, plain)).otherwise(plain)).otherwise(normal)


def _chosen(made: Column, power: Column, n: int) -> Column:
    """Digits without zeros at the end; rounding up may have added one."""
    text = made.cast("string")
    return F.struct(F.rtrim(text, F.lit("0")).alias("text"), (power + F.length(text) - n).alias("power"))


def _laid_out(number: Column) -> Column:
    """Plain from 1e-4 up to 1e16, else scientific with two digits of power at least."""
    text, power = number["text"], number["power"]
    sign = F.when(power < 0, F.when(power > -10, F.lit("e-0")).otherwise(F.lit("e-"))).otherwise(F.lit("e+"))
    point = F.when(F.length(text) > 1, F.lit(".")).otherwise(F.lit(""))
    scientific = F.concat(F.substring(text, 1, 1), point, F.substring(text, 2, 17), sign, F.abs(power).cast("string"))
    rest = F.when(F.length(text) > power + 1, F.substring(text, power + 2, F.lit(17))).otherwise(F.lit("0"))
    return (
        F.when((power < -4) | (power >= 16), scientific)
        .when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), text))
        .otherwise(F.concat(F.rpad(F.substring(text, F.lit(1), power + 1), power + 1, F.lit("0")), F.lit("."), rest))
    )


def decode_state_name(raw: Column | str) -> Column:
    """State names arrive as bytes: UTF-8 where valid, otherwise Latin-1; blank becomes null."""
    c = _col(raw)
    text = F.coalesce(F.try_validate_utf8(c.cast("string")), F.decode(c, "ISO-8859-1"))
    return F.nullif(python_strip(text), F.lit(""))
