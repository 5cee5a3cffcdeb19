"""Exact arithmetic on amounts of up to 78 digits (256 bits).

Spark's widest exact type has 38 digits, so such amounts are held as decimal text.
Sums run on three limbs of 28 digits each: a limb's sum is a DECIMAL(38,0) with room
for 10^10 rows, its carry moves on when the sum is complete, and the result is text
again.  Partial aggregation and window frames work on the limbs as on any number.

``total``, ``running`` and ``negated`` choose by the column's type: text goes through
limbs, any other number through the built-in operation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 28
LIMBS = 3
MAX_DIGITS = 78
_ONE = "1" + "0" * DIGITS
_LIMB, _SUM = f"decimal({DIGITS},0)", "decimal(38,0)"


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def valid(amount: Column) -> Column:
    """Is the text an integer of at most 78 digits?  (NULL is none.)"""
    return F.coalesce(amount.rlike(f"^-?[0-9]{{1,{MAX_DIGITS}}}$"), F.lit(False))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once (a lambda variable), however often
    the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _limbs(amount: Column) -> Column:
    """Signed limbs of a text as an array, lowest first; NULL for what is no amount."""
    def split(text: Column) -> Column:
        digits = F.lpad(F.ltrim(text, F.lit("-")), LIMBS * DIGITS, "0")
        parts = [F.substring(digits, 1 + DIGITS * (LIMBS - 1 - i), DIGITS).cast(_LIMB) for i in range(LIMBS)]
        return F.when(valid(text), F.when(text.startswith("-"), F.array(*[-p for p in parts])).otherwise(F.array(*parts)))

    return _let(amount, split)


def _carried(sums: Column) -> Column:
    """Summed limbs as an array of DECIMAL(38,0): all but the highest in [0, 10^28)."""
    one = F.lit(_ONE).cast(_SUM)

    def step(i: int, value: Column, done: list[Column]) -> Column:
        if i == LIMBS - 1:
            return F.array(*done, value)

        def split(pair: Column) -> Column:
            carry = F.call_function("div", (pair["value"] - pair["rest"]).cast(_SUM), one).cast(_SUM)
            return step(i + 1, (F.get(sums, F.lit(i + 1)) + carry).cast(_SUM), [*done, pair["rest"]])

        return _let(value, lambda v: _let(F.struct(v.alias("value"), F.pmod(v, one).cast(_SUM).alias("rest")), split))

    return step(0, F.get(sums, F.lit(0)).cast(_SUM), [])


def _text(sums: Column) -> Column:
    """The number of summed limbs as text."""
    def written(limbs: Column, negative: Column) -> Column:
        parts = [F.lpad(F.get(limbs, F.lit(i)).cast("string"), DIGITS, "0") for i in reversed(range(LIMBS))]
        return _let(F.ltrim(F.concat(*parts), F.lit("0")), lambda digits: F.when(digits == "", "0").when(
            negative, F.concat(F.lit("-"), digits)).otherwise(digits))

    def signed(own: Column) -> Column:
        def choose(limbs: Column) -> Column:
            negative = F.get(limbs, F.lit(LIMBS - 1)) < 0
            flipped = _carried(F.transform(own, lambda x: (-x).cast(_SUM)))
            return _let(F.when(negative, flipped).otherwise(limbs), lambda size: written(size, negative))

        return _let(_carried(own), choose)

    return _let(sums, signed)


def _sum(amount: Column, over: WindowSpec | None = None) -> Column:
    sums = [F.sum(F.get(_limbs(amount), F.lit(i))) for i in range(LIMBS)]
    return _text(F.array(*[s.over(over) if over is not None else s for s in sums]))


def total(amount: Column, kind: T.DataType) -> Column:
    """SUM of a group (an aggregate expression)."""
    return _sum(amount) if is_text(kind) else F.sum(amount)


def running(amount: Column, kind: T.DataType, window: WindowSpec) -> Column:
    """SUM over a window frame."""
    return _sum(amount, window) if is_text(kind) else F.sum(amount).over(window)


def negated(amount: Column, kind: T.DataType) -> Column:
    if not is_text(kind):
        return -amount
    flipped = F.when(amount.startswith("-"), F.ltrim(amount, F.lit("-"))).otherwise(F.concat(F.lit("-"), amount))
    return F.when(amount == "0", amount).otherwise(flipped)


def plus(a: Column, b: Column) -> Column:
    """Sum of two text amounts."""
    return _text(F.zip_with(_limbs(a), _limbs(b), lambda x, y: (x + y).cast(_SUM)))


def zero(kind: T.DataType) -> Column:
    return F.lit("0") if is_text(kind) else F.lit(0).cast(kind)


def fitting(amount: Column) -> Column:
    """The amount as DECIMAL(38,0), NULL if it has more digits."""
    return amount.try_cast("decimal(38,0)")


def too_wide(amount: Column) -> Column:
    """The text of an amount that DECIMAL(38,0) cannot hold, else NULL."""
    return F.when(amount.isNotNull() & fitting(amount).isNull(), amount)
