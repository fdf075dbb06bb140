"""Sums of money that lose nothing and do not depend on how the rows were partitioned.

Adding doubles in a different order gives different last digits, so the same table aggregated on
another cluster would differ. Two exact sums take all amounts a decimal can hold:

- whole cents are added as integers, in three limbs of 20, 20 and 13 bits, so that no bigint can
  overflow below 2 ** 43 rows, in any session mode;
- every other amount is added as a decimal with 12 places.

Only what no decimal holds (NaN, infinity, amounts from 10 ** 26 up, or a sum beyond that) makes the
result a plain double sum.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LIMB_BITS = 20
_MOST_CENTS = 2.0**52  # a double tells whole cents apart up to here
_WIDE, _BEYOND = "decimal(38,12)", 1e26
_PARTS = ("low", "middle", "high", "fine", "plain", "wild", "count")


def part_names(name: str) -> list[str]:
    return [f"{name}_{part}" for part in _PARTS]


def parts(amount: Column, name: str) -> list[Column]:
    """The aggregates of ``part_names``; each may be summed further (``combined``)."""
    amount = amount.cast("double")
    cents = F.rint(amount * 100)
    whole = (F.abs(cents) < _MOST_CENTS) & (cents / 100 == amount)
    finite = F.abs(amount) < _BEYOND
    units = F.when(whole, cents.cast("bigint"))
    mask = F.lit((1 << _LIMB_BITS) - 1).cast("bigint")
    limbs = (
        units.bitwiseAND(mask),
        F.shiftright(units, _LIMB_BITS).bitwiseAND(mask),
        F.shiftright(units, 2 * _LIMB_BITS),
    )
    other = F.when(~whole, amount)
    sums = [F.coalesce(F.sum(limb), F.lit(0).cast("bigint")) for limb in limbs]
    sums += [
        F.try_sum(F.when(~whole & finite, amount).try_cast(_WIDE)),
        F.sum(other),
        F.count_if(~whole & ~finite),
        F.count(amount),
    ]
    return [s.alias(n) for s, n in zip(sums, part_names(name), strict=True)]


def combined(name: str) -> list[Column]:
    """Sums of partial ``parts`` of the same name."""
    return [(F.try_sum(n) if n.endswith("_fine") else F.sum(n)).alias(n) for n in part_names(name)]


def _total(low: Column, middle: Column, high: Column, fine: Column, plain: Column, wild: Column, count: Column) -> Column:
    limb = F.lit(1 << _LIMB_BITS).cast("decimal(8,0)")
    wide = [p.cast("decimal(20,0)") for p in (low, middle, high)]
    cents = ((wide[2] * limb + wide[1]).cast("decimal(30,0)") * limb + wide[0]).try_cast("decimal(26,0)")
    cents = (cents * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(28,2)")
    exact = cents.try_cast("decimal(26,2)") + F.coalesce(fine, F.when(plain.isNull(), F.lit(0))).try_cast("decimal(36,12)")
    rough = cents.cast("double") + F.coalesce(plain, F.lit(0.0))
    return F.when(count > 0, F.when(wild == 0, F.coalesce(exact.cast("double"), rough)).otherwise(rough))


def total_of(name: str) -> Column:
    """The total from the columns of ``part_names``: NULL without an amount, NaN when one of them is NaN."""
    return _total(*[F.col(n) for n in part_names(name)])


def mean_of(name: str) -> Column:
    return F.try_divide(total_of(name), F.col(f"{name}_count").cast("double"))


def total(amount: Column) -> Column:
    """``sum(amount)``: NULL when there is no non-NULL amount, NaN when one of them is NaN."""
    return _total(*parts(amount, "_"))


def mean(amount: Column) -> Column:
    """``avg(amount)`` as the exact total over the number of non-NULL amounts."""
    return F.try_divide(total(amount), F.count(amount).cast("double"))
