"""Deterministic splits by SHA-256 of a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_interval(key: Column, salt: str = "") -> Column:
    """The first 32 bits of the hash over 2^32 - 1: a number in [0, 1]."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(salt), key.cast("string")), 256), 1, 8), 16, 10).cast("long") / F.lit(4294967295.0)


# fixed values: what ids are hashed behind, which decides every split
SPLIT_SALT = "cricket-commentary-split-v1:"


def hash_split(key: Column, val: float = 0.1, test: float = 0.1, salt: str = SPLIT_SALT) -> Column:
    """test below the first fraction of the hash space, val below both, else train."""
    p = unit_interval(key, salt)
    return F.when(p < test, "test").when(p < test + val, "val").otherwise("train")


def hash_modulo(key: Column, modulus: int = 1000, salt: str = "") -> Column:
    """The whole 256-bit hash modulo a number, folded over its eight 32-bit limbs."""
    h = F.sha2(F.concat(F.lit(salt), key.cast("string")), 256)
    limbs = [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(8)]
    return reduce(lambda acc, x: (acc * ((1 << 32) % modulus) + x) % modulus, limbs, F.lit(0).cast("long"))


def holdout(key: Column, fraction: float, salt: str = "evalholdout-") -> Column:
    return hash_modulo(key, 1000, salt) < fraction * 1000
