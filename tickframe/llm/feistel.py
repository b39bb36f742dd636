"""Pseudorandom permutations of 0 .. n-1 as column expressions.

A number is written as two digits of base ceil(sqrt n); in each round one digit
is shifted by a hash of the other (an additive Feistel network), which permutes
0 .. base*base - 1. Results of n or more are permuted again until they fall
below n (cycle walking); fewer than 2*sqrt(n) + 1 numbers lie beyond n, so that
hardly any row walks. ``walks`` finds the longest walk exactly from those
numbers alone, so that the expression needs no guess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6


def base_of(n: Column) -> Column:
    root = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    # The root of a double may be one too small or large beyond 2^53.
    return F.greatest(F.lit(1).cast("long"), F.when(root * root < n, root + 1).otherwise(root))


def _network(x: Column, base: Column, key: Column) -> Column:
    def turn(state: Column, i: Column) -> Column:
        high, low = _div(state, base), state % base
        hashed = F.when(i % 2 == 0, F.xxhash64(key, i, low)).otherwise(F.xxhash64(key, i, high))
        return F.when(i % 2 == 0, (high + F.pmod(hashed, base)) % base * base + low) \
                .otherwise(high * base + (low + F.pmod(hashed, base)) % base)
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x.cast("long"), turn)


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of non-negative longs."""
    return F.call_function("div", a, b)


def permute(x: Column, n: Column, key: Column, steps: int) -> Column:
    """Place of ``x`` (0 .. n-1) under the permutation that ``key`` (a long) names.

    ``steps`` comes from ``walks`` over the same (n, key).
    """
    base = base_of(n)
    first = _network(x, base, key)
    if steps < 1:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first,
                       lambda at, _: F.when(at < n, at).otherwise(_network(at, base, key)))


def walks(domains: DataFrame) -> int:
    """Most repeated steps that any row of any permutation needs.

    ``domains`` has one row per permutation: n and key, longs. Numbers beyond n
    that no number beyond n leads to are where walks from below n enter; they
    are followed until all are back. About 2*sqrt(n) rows per permutation.
    """
    base = base_of(F.col("n"))
    size = base * base
    beyond = domains.filter("n > 0").filter(size > F.col("n")) \
        .select("n", "key", F.explode(F.sequence(F.col("n"), size - 1)).alias("x"))
    led = beyond.select("n", "key", _network(F.col("x"), base, F.col("key")).alias("x"))
    at = beyond.join(led, ["n", "key", "x"], "left_anti")
    steps = 0
    while not at.isEmpty():
        steps += 1
        step = at.select("n", "key", _network(F.col("x"), base, F.col("key")).alias("x"))
        at = step.filter("x >= n").checkpoint() if steps % 4 == 0 else step.filter("x >= n")
    return steps
