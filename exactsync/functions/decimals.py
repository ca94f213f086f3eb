"""Exact decimals as plain column expressions: parse, print, and the way to and from doubles.

Every converter returns NULL where the value cannot be held exactly, so callers find a loss
by "input is not NULL but output is".
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole digits a double always holds, the largest exact power of ten, and how many units it counts with an error below one half.
_PLAIN_DIGITS = 15
_EXACT_POWER = 22
_EXACT_UNITS = 2**50
_TWO_53 = float(2**53)
_TWO_106 = float(2**106)
# Long numbers are sums of limbs of ten digits, least first. A double below 2**216 (10**65 is less) is three pieces of 27 bits
# times a power of 2**27, so a limb of the sum is three limbs of known powers times a piece each: with a carry below 2**62.
LIMB_DIGITS = 10
_MOST_DIGITS = 65
_PLAIN = r"^[+-]?[0-9]+(?:[.][0-9]*)?\z"
_PIECE_BITS, _STEPS = 27, 6
_PIECE = 2.0**_PIECE_BITS
_TOP = _PIECE ** (_STEPS + 2)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with a costly value computed a single time per row.

    Spark computes a value again in each branch that mentions it; a lambda variable is bound once.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decimal_pattern(precision: int, scale: int) -> str:
    """Texts, filled up with zeros, that fit: sign, leading zeros, whole digits, kept digits, zeros.

    A minus is only kept before a digit other than 0. \\z and not $, because $ would also accept a
    trailing newline.
    """
    room = precision - scale
    whole = f"0|[1-9][0-9]{{0,{room - 1}}}" if room else "0"
    return rf"^(?:[+]|(-)(?=[0.]*[1-9])|-)?0*({whole})[.]([0-9]{{{scale}}})0*\z"


def plain_pattern(scale: int, whole: int) -> str:
    """Decimal texts of at most ``whole`` whole digits, with no digit other than 0 after the first ``scale`` fraction digits."""
    return rf"^[+-]?(?=[0-9])0*[0-9]{{0,{whole}}}(?:[.][0-9]{{0,{scale}}}0*)?\z"


def parse_decimal(text: Column, precision: int, scale: int) -> Column:
    """Canonical text of a decimal with exactly ``scale`` fraction digits, or NULL.

    The text is an optional sign, one or more digits and an optional fraction, nothing else.
    Digits cut off by ``scale`` must be zeros and at most ``precision`` digits may be left.
    """
    # A plain chain on purpose: a value used in a condition and again in its branch would be
    # computed twice, and conversions nest.
    pattern, zeros = decimal_pattern(precision, scale), "0" * scale
    filled = F.concat(text, F.when(F.contains(text, F.lit(".")), zeros).otherwise("." + zeros))
    return F.regexp_replace(F.regexp_substr(filled, F.lit(pattern)), pattern, "$1$2.$3" if scale else "$1$2")


def print_decimal(value: Column, scale: int) -> Column:
    """Text of a Spark decimal with all its ``scale`` fraction digits.

    Never with an exponent, as ANSI casts (``session.configure``) print plainly.
    """
    return value.cast(T.DecimalType(38, scale)).cast("string")


def within_digits(text: Column, low: int, high: int, width: int) -> Column:
    """Canonical integer text of at most ``width`` digits lies in ``low..high`` (0 in between)."""
    padded = lambda t: F.lpad(t, width, "0")
    below = padded(F.ltrim(text, F.lit("-"))) <= str(-low).zfill(width)
    above = padded(text) <= str(high).zfill(width)
    return F.when(text.startswith("-"), below).otherwise(above)


def double_to_decimal(value: Column, precision: int, scale: int) -> Column:
    """Decimal a double stands for, or NULL: casting it back gives the same double.

    Small numbers are counted in units of the last place. For the others Spark goes through the
    shortest text, which is not the stored number from 2**53 on. There the number is whole, so it
    is taken apart in exact 53-bit pieces instead: scaling by powers of two and remainders are
    exact, and casts to bigint cut toward zero.
    """
    target = T.DecimalType(precision, scale)
    if scale > _EXACT_POWER:
        return _long_way(value, target)
    power = F.lit(float(10**scale))
    # As many units as a double counts without error: if any decimal prints this double, it is
    # the nearest number of units, and dividing back rounds to the double again.
    units = F.rint(value * power)
    unit = F.lit(Decimal(1).scaleb(-scale))
    short = F.when(units / power == value, (units.cast("bigint").cast("decimal(19,0)") * unit).cast(target))
    near = F.when(F.abs(units) < F.lit(float(min(_EXACT_UNITS, 10**precision))), short)
    return near if precision <= _PLAIN_DIGITS else near.otherwise(_long_way(value, target))


def _long_way(value: Column, target: T.DecimalType) -> Column:
    text = value.try_cast(target)
    short = F.when(text.cast("double") == value, text)
    if target.precision - target.scale <= _PLAIN_DIGITS:
        return short
    digits = lambda piece: piece.try_cast("bigint").cast("decimal(20,0)")
    pieces = (
        digits(value / F.lit(_TWO_106)) * F.lit(Decimal(2**106))
        + digits((value / F.lit(_TWO_53)) % F.lit(_TWO_53)) * F.lit(Decimal(2**53))
        + digits(value % F.lit(_TWO_53))
    )
    size = F.abs(value)
    return F.when(size < F.lit(_TWO_53), short).when(size <= F.lit(1e38), pieces.try_cast(target))


def _limbs(step: int) -> Column:
    """Limbs of ``2 ** (27 * step)`` and of the next two steps, as many as the largest piece of each needs."""
    count = len(str(2 ** (_PIECE_BITS * (step + 3)))) // LIMB_DIGITS + 1
    each = [[F.lit(2 ** (_PIECE_BITS * (step + p)) // 10 ** (LIMB_DIGITS * n) % 10**LIMB_DIGITS).cast("bigint") for p in range(3)] for n in range(count)]
    return F.array(*[F.struct(*limb) for limb in each])


def _below(size: Column, whole: int) -> Column:
    """``size < 10**whole`` for a double without fraction; no more than 2**216 either."""
    top = float(10 ** min(whole, _MOST_DIGITS + 1))
    if top >= _TOP:
        return size < F.lit(_TOP)
    return size < F.lit(top) if int(top) >= 10**whole else size <= F.lit(top)


def whole_digits(value: Column, whole: int) -> Column:
    """All digits of a double from 2**53 on that has at most ``whole`` of them and is below 2**216, with its sign: the stored
    number itself, not its shortest text.

    The pieces are exact: scaling by a power of two and remainders lose nothing. Each costly value is bound once: without
    that the tree of limbs and carries would be computed again for every digit."""
    size = F.when((F.abs(value) >= F.lit(_TWO_53)) & _below(F.abs(value), whole), F.abs(value))
    # The half is for the rounding of the logarithm: a rest is from 2**53, so without fraction, to 2**81.
    steps = lambda z: F.least(F.greatest(F.floor((F.log2(z) - 53.5) / _PIECE_BITS), F.lit(0)), F.lit(_STEPS - 1)).cast("int")
    units = F.array(*[F.lit(_PIECE**n) for n in range(_STEPS)])
    table = F.array(*[_limbs(n) for n in range(_STEPS)])
    piece = lambda part: F.floor(part % F.lit(_PIECE))
    base = F.lit(10**LIMB_DIGITS)

    def carried(state: Column, amount: Column) -> Column:
        total = amount + state["carry"]
        digits = F.lpad((total % base).cast("string"), LIMB_DIGITS, "0")
        return F.struct(F.call_function("div", total, base).alias("carry"), F.concat(digits, state["digits"]).alias("digits"))

    def joined(step: Column, rest: Column) -> Column:
        pieces = F.struct(piece(rest).alias("a"), piece(rest / F.lit(_PIECE)).alias("b"), piece(rest / F.lit(_PIECE**2)).alias("c"))
        amount = lambda p: lambda limb: p["a"] * limb["col1"] + p["b"] * limb["col2"] + p["c"] * limb["col3"]
        amounts = once(pieces, lambda p: F.transform(F.get(table, step), amount(p)))
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("digits"))
        return F.aggregate(amounts, start, carried, lambda s: F.ltrim(s["digits"], F.lit("0")))

    scaled = lambda z: once(steps(z), lambda n: once(z / F.get(units, n), lambda rest: joined(n, rest)))
    text = once(size, lambda z: F.when(z.isNotNull(), scaled(z)))
    return F.concat(F.when(value < 0, "-").otherwise(""), text)


def plain_text(value: Column) -> Column:
    """The shortest decimal text that gives a finite float or double back, written without an exponent."""
    text = F.abs(value).cast("string")
    mantissa = F.substring_index(text, "E", 1)
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).try_cast("int")).otherwise(0)
    whole = F.substring_index(mantissa, ".", 1)
    digits = F.concat(whole, F.substring_index(mantissa, ".", -1))
    place = F.char_length(whole) + power
    before, behind = F.repeat(F.lit("0"), F.greatest(1 - place, F.lit(0))), F.repeat(F.lit("0"), F.greatest(place - F.char_length(digits) + 1, F.lit(0)))
    filled, point = F.concat(before, digits, behind), F.greatest(place, F.lit(1))
    plain = F.concat(F.substr(filled, F.lit(1), point), F.lit("."), F.substr(filled, point + 1))
    return F.when(F.abs(value) < F.lit(float("inf")), F.concat(F.when(value < 0, "-").otherwise(""), plain))


def double_to_digits(value: Column, precision: int, scale: int) -> Column:
    """Canonical text of the decimal a float or double stands for, of any size that ``precision`` digits hold.

    From 2**53 on that is the stored number, below it the shortest text that gives the number back, as for Spark's own decimals."""
    wide = value.cast("double")
    far = F.concat(whole_digits(wide, precision - scale), F.lit("." + "0" * scale if scale else ""))
    near = F.when(F.abs(wide) < F.lit(_TWO_53), parse_decimal(plain_text(value), precision, scale))
    return F.when(~negative_zero(value), F.coalesce(far, near))


def digits_to_double(text: Column, scale: int, target: T.DataType) -> Column:
    """The float or double that a decimal text of any length stands for: reading rounds correctly, and the text of
    the result must be the same number again."""
    number = F.when(text.rlike(_PLAIN), text.try_cast(target))
    plain = parse_decimal(text, _MOST_DIGITS + scale, scale)
    return once(number, lambda n: F.when(double_to_digits(n, _MOST_DIGITS + scale, scale) == plain, n))


def negative_zero(value: Column) -> Column:
    """-0.0, which equals 0.0 for Spark; the text is only looked at for zeros."""
    return (value == 0) & value.cast("string").startswith("-")
