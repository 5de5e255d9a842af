"""Token to bucket, by hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import bind

N_BUCKETS = 512

# Constants of MurmurHash3 (x86, 32 bit), a public-domain hash.
C1, C2 = 0xCC9E2D51, 0x1B873593
STEP_ADD = 0xE6546B64
FINAL_1, FINAL_2 = 0x85EBCA6B, 0xC2B2AE35
MASK = 0xFFFFFFFF


def _times(a: Column, c: int) -> Column:
    """32-bit product.  Taking the constant as a signed number keeps the 64-bit
    intermediate in range, which ANSI mode insists on; the low bits are the same."""
    return (a * F.lit(c - (1 << 32) if c >= 1 << 31 else c).cast("long")).bitwiseAND(F.lit(MASK))


def _rotate(a: Column, bits: int) -> Column:
    return F.shiftleft(a, bits).bitwiseAND(F.lit(MASK)).bitwiseOR(F.shiftrightunsigned(a, 32 - bits))


def _fold(a: Column, bits: int) -> Column:
    return a.bitwiseXOR(F.shiftrightunsigned(a, bits))


def _scramble(k: Column) -> Column:
    return _times(bind(_times(k, C1), lambda x: _rotate(x, 15)), C2)


def _number(token: Column, first: Column, count: int) -> Column:
    """Up to ``count`` bytes of an ASCII token from 1-based ``first``, as a
    little-endian number."""
    return F.conv(F.hex(F.reverse(F.substring(token, first, F.lit(count)))), 16, 10).cast("long")


def murmur3(token: Column, seed: int = 0) -> Column:
    """Signed MurmurHash3 (x86, 32 bit) of an ASCII token, as a bigint."""
    n = F.length(token)
    blocks = F.floor(n / 4).cast("int")

    def mix(h: Column, i: Column) -> Column:
        mixed = h.bitwiseXOR(_scramble(_number(token, i * 4 + 1, 4)))
        return bind(mixed, lambda x: bind(
            _rotate(x, 13), lambda r: (r * 5 + F.lit(STEP_ADD)).bitwiseAND(F.lit(MASK))
        ))

    body = F.aggregate(
        F.when(n >= 4, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>")),
        F.lit(seed).cast("long"),
        mix,
    )
    tail = F.when(n % 4 > 0, _scramble(_number(token, blocks * 4 + 1, 3))).otherwise(F.lit(0).cast("long"))
    h = body.bitwiseXOR(tail).bitwiseXOR(n.cast("long"))
    h = bind(h, lambda x: _times(_fold(x, 16), FINAL_1))
    h = bind(h, lambda x: _times(_fold(x, 13), FINAL_2))
    h = bind(h, lambda x: _fold(x, 16))
    return bind(h, lambda x: F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x))


def murmur3_of(token: bytes, seed: int = 0) -> int:
    """:func:`murmur3` of one token."""
    def scramble(k: int) -> int:
        k = k * C1 & MASK
        return (k << 15 | k >> 17) * C2 & MASK

    h, blocks = seed, len(token) // 4 * 4
    for at in range(0, blocks, 4):
        h ^= scramble(int.from_bytes(token[at:at + 4], "little"))
        h = ((h << 13 | h >> 19) * 5 + STEP_ADD) & MASK
    if blocks < len(token):
        h ^= scramble(int.from_bytes(token[blocks:], "little"))
    h ^= len(token)
    h = (h ^ h >> 16) * FINAL_1 & MASK
    h = (h ^ h >> 13) * FINAL_2 & MASK
    h ^= h >> 16
    return h - (1 << 32) if h >= 1 << 31 else h


def murmur3_bucket(token: Column, n_buckets: int = N_BUCKETS) -> Column:
    """Default: the magnitude of the signed MurmurHash3 (seed 0), modulo the width."""
    return (F.abs(murmur3(token)) % n_buckets).cast("int")


def md5_bucket(token: Column, n_buckets: int = N_BUCKETS) -> Column:
    """First 32 bits of the MD5, modulo the width; any SQL engine has the parts."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % n_buckets).cast("int")


def spark_bucket(token: Column, n_buckets: int = N_BUCKETS) -> Column:
    """Spark's own hash, the cheapest choice when buckets need not match elsewhere."""
    return F.pmod(F.hash(token), F.lit(n_buckets))


BUCKETS = {"murmur3": murmur3_bucket, "md5": md5_bucket, "spark": spark_bucket}
