"""XXH64 with any seed over an integer's little-endian bytes, as column arithmetic.

Spark's own ``xxhash64`` is fixed at seed 42, so buckets that another engine formed with
``xxHash64(id) % n`` (seed 0) can't be found again with it. The rounds below follow the
published algorithm for inputs of 4 and 8 bytes. Spark's BIGINT multiplication overflows
(or raises), so a 64-bit number is a pair of 32-bit halves and a product is put together
from 16-bit ones. Every round binds the pair to a lambda variable: the expression grows
with the rounds and not with their uses of it, wherever the optimizer moves it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.functions.columns import col

# The primes of the published algorithm.
PRIME1 = 0x9E3779B185EBCA87
PRIME2 = 0xC2B2AE3D27D4EB4F
PRIME3 = 0x165667B19E3779F9
PRIME4 = 0x85EBCA77C2B2AE63
PRIME5 = 0x27D4EB2F165667C5

MASK = (1 << 32) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a variable that stands for ``value``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair(hi: Column, lo: Column) -> Column:
    return F.struct(hi.alias("hi"), lo.alias("lo"))


def _low32(x: Column) -> Column:
    return x.bitwiseAND(F.lit(MASK))


def _low16(x: Column) -> Column:
    return x.bitwiseAND(F.lit(0xFFFF))


def _halves(c: int) -> tuple[Column, Column]:
    c %= 1 << 64
    return F.lit(c >> 32).cast("bigint"), F.lit(c & MASK).cast("bigint")


def _times(x: Column, factor: int) -> Column:
    """x * factor modulo 2**64."""
    fh, fl = _halves(factor)

    def products(v: Column) -> Column:
        lo1, lo0 = F.shiftright(v["lo"], 16), _low16(v["lo"])
        hi1, hi0 = F.shiftright(v["hi"], 16), _low16(v["hi"])
        upper = lo0 * fh + F.shiftleft(_low16(lo1 * fh), 16) + hi0 * fl + F.shiftleft(_low16(hi1 * fl), 16)
        return F.struct((lo0 * fl).alias("a"), (lo1 * fl).alias("b"), upper.alias("upper"))

    def joined(p: Column) -> Column:
        middle = F.shiftright(p["a"], 16) + p["b"]
        return _pair(_low32(F.shiftright(middle, 16) + p["upper"]), F.shiftleft(_low16(middle), 16).bitwiseOR(_low16(p["a"])))

    return _let(_let(x, products), joined)


def _plus(x: Column, term: int) -> Column:
    th, tl = _halves(term)
    return _let(x, lambda v: _pair(_low32(v["hi"] + th + F.shiftright(v["lo"] + tl, 32)), _low32(v["lo"] + tl)))


def _xor(x: Column, term: int) -> Column:
    th, tl = _halves(term)
    return _let(x, lambda v: _pair(v["hi"].bitwiseXOR(th), v["lo"].bitwiseXOR(tl)))


def _rotated(x: Column, r: int) -> Column:
    """Left by r (1 to 31) bits."""
    return _let(x, lambda v: _pair(_low32(F.shiftleft(v["hi"], r)).bitwiseOR(F.shiftright(v["lo"], 32 - r)),
                                   _low32(F.shiftleft(v["lo"], r)).bitwiseOR(F.shiftright(v["hi"], 32 - r))))


def _mixed(x: Column, r: int) -> Column:
    """x ^ (x >> r), r from 1 to 63."""
    if r >= 32:
        return _let(x, lambda v: _pair(v["hi"], v["lo"].bitwiseXOR(F.shiftright(v["hi"], r - 32))))
    return _let(x, lambda v: _pair(v["hi"].bitwiseXOR(F.shiftright(v["hi"], r)),
                                   v["lo"].bitwiseXOR(F.shiftright(v["lo"], r).bitwiseOR(_low32(F.shiftleft(v["hi"], 32 - r))))))


def xxh64(key, width: int = 8, seed: int = 0) -> Column:
    """XXH64 of the ``width`` (4 or 8) little-endian bytes of an integer key, as a signed BIGINT
    with the hash's 64 bits. Null for a null key; a key that doesn't fit ``width`` bytes is
    taken modulo 2**(8 * width), as a cast to that type would."""
    if width not in (4, 8):
        raise ValueError("width must be 4 or 8")
    k = col(key).cast("bigint")
    begin = seed + PRIME5 + width
    if width == 8:
        x = _times(_rotated(_times(_pair(_low32(F.shiftrightunsigned(k, 32)), _low32(k)), PRIME2), 31), PRIME1)
        x = _plus(_times(_rotated(_xor(x, begin), 27), PRIME1), PRIME4)
    else:
        x = _times(_pair(F.lit(0).cast("bigint"), _low32(k)), PRIME1)
        x = _plus(_times(_rotated(_xor(x, begin), 23), PRIME2), PRIME3)
    x = _mixed(_times(_mixed(_times(_mixed(x, 33), PRIME2), 29), PRIME3), 32)
    return F.when(k.isNotNull(), _let(x, lambda v: F.shiftleft(v["hi"], 32).bitwiseOR(v["lo"])))


def unsigned_mod(x, n: int) -> Column:
    """The unsigned 64-bit number in a signed BIGINT, modulo n (below 2**31)."""
    x = col(x)
    return (F.pmod(F.shiftrightunsigned(x, 32), F.lit(n)) * ((1 << 32) % n) + F.pmod(_low32(x), F.lit(n))) % n


def xxh64_bucket(key, n: int, width: int = 8, seed: int = 0) -> Column:
    """XXH64(key) % n, the bucket other engines form with seed 0. ``width``: bytes of the
    engine's key type (4 for 32-bit ids)."""
    return _let(xxh64(key, width, seed), lambda h: unsigned_mod(h, n))
