"""A keyed permutation of the numbers 0 to n - 1: a Feistel network over a grid of
``a`` columns and ``b`` rows, with cycle walking.

``a`` is the square root of n, rounded up, and ``a * b`` the first multiple of it from
n on. A number stands for a place in the grid; rounds move the column by a function of
the row, then the row by a function of the column, and so on, which can be undone.
Places from n on are walked through until one below n is met. There are fewer than
``a`` of them, so up to n = 256 the walk ends within 16 steps, and beyond that one
would go on with a chance below ``n * a ** -16``.

The same rules hold for Python numbers and for Spark columns, so that a reader can
compute where a row is without a job.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

_ROUNDS = 6
_WALK = 16
_PRIME = (1 << 31) - 1  # products of two residues fit a long
_FACTOR = 48_271


def grid(n: int) -> tuple[int, int]:
    if not 1 <= n <= 1 << 60:
        raise ValueError("between 1 and 2 ** 60 numbers can be permuted")
    a = isqrt(n - 1) + 1
    return a, -(-n // a)


def round_keys(key: int) -> list[int]:
    digest = hashlib.sha256(f"feistel {key}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") % _PRIME for i in range(_ROUNDS)]


def _mixed(x, key):
    """For numbers and columns alike."""
    y = (x + key) % _PRIME
    y = (y * y + key) % _PRIME
    return (y * _FACTOR + x) % _PRIME


def _round(number: int, a: int, b: int, key: int, i: int, sign: int) -> int:
    column, row = number % a, number // a
    if i % 2:
        row = (row + sign * _mixed(column, key)) % b
    else:
        column = (column + sign * _mixed(row, key)) % a
    return row * a + column


def permute(number: int, n: int, key: int) -> int:
    """Where a number goes."""
    a, b = grid(n)
    keys = list(enumerate(round_keys(key)))
    while True:
        for i, k in keys:
            number = _round(number, a, b, k, i, 1)
        if number < n:
            return number


def invert(place: int, n: int, key: int) -> int:
    """Which number went to a place."""
    a, b = grid(n)
    keys = list(enumerate(round_keys(key)))[::-1]
    while True:
        for i, k in keys:
            place = _round(place, a, b, k, i, -1)
        if place < n:
            return place


def permuted(number: Column, n: int, key: int) -> Column:
    return _walked(number, n, round_keys(key), 1)


def inverted(place: Column, n: int, key: int) -> Column:
    return _walked(place, n, round_keys(key), -1)


def _walked(start: Column, n: int, keys: list[int], sign: int) -> Column:
    a, b = (F.lit(x).cast("long") for x in grid(n))
    steps = list(enumerate(keys))[::sign]
    rounds = F.array(
        *[
            F.struct(F.lit(i % 2 == 1).alias("rows"), F.lit(k).cast("long").alias("key"))
            for i, k in steps
        ]
    )

    def one(number: Column, step: Column) -> Column:
        column, row = F.pmod(number, a), F.call_function("div", number, a)
        moved_row = F.pmod(row + sign * _mixed_column(column, step["key"]), b)
        moved_column = F.pmod(column + sign * _mixed_column(row, step["key"]), a)
        return F.when(step["rows"], moved_row * a + column).otherwise(row * a + moved_column)

    def network(number: Column) -> Column:
        return F.aggregate(rounds, number, one)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_WALK)),
        network(start.cast("long")),
        lambda x, _: F.when(x < n, x).otherwise(network(x)),
    )


def _mixed_column(x: Column, key: Column) -> Column:
    prime = F.lit(_PRIME).cast("long")
    y = F.pmod(x + key, prime)
    y = F.pmod(y * y + key, prime)
    return F.pmod(y * F.lit(_FACTOR).cast("long") + x, prime)
