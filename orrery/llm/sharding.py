"""Jump consistent hashing: stable keys to shards without a ring table, by DataFrame operations alone.

The 64-bit generator state * A + 1 is carried as two 32-bit halves, since SQL's bigint product would overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32, running_sums, whole

#: Fixed values of the published algorithm: the multiplier, here in two 32-bit halves.
MULTIPLIER = 2862933555777941757
A_HIGH, A_LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
MASK = 0xFFFFFFFF


def _times_low(x: Column, factor: int) -> Column:
    """x * factor mod 2**32 for 32-bit numbers, by halves of x."""
    high = F.shiftrightunsigned(x, 16) * F.lit(factor)
    return ((x.bitwiseAND(F.lit(0xFFFF)) * F.lit(factor)) + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(MASK))


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """(high, low) * MULTIPLIER + 1 mod 2**64."""
    t = low.bitwiseAND(F.lit(0xFFFF)) * F.lit(A_LOW)
    u = F.shiftrightunsigned(low, 16) * F.lit(A_LOW)
    s = t + F.shiftleft(u.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftrightunsigned(s, 32) + F.shiftrightunsigned(u, 16)
    return (carry + _times_low(low, A_HIGH) + _times_low(high, A_LOW)).bitwiseAND(F.lit(MASK)), s.bitwiseAND(F.lit(MASK))


def jump_state(high: Column, low: Column, shards: int) -> Column:
    """Struct of b, the shard (0 to shards - 1) of the 64-bit key with these halves (unsigned 32-bit, as bigint), and j,
    the number of shards that it takes to move the key again, less one.

    A fold whose steps jump ahead while the next candidate is still below the number of shards. About ln(shards) jumps
    are needed; the few keys that need more than `steps` of them are folded over all shards.
    """
    steps = min(shards, 2 * shards.bit_length() + 8)
    start = F.struct(high.alias("h"), low.alias("l"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def ahead(s: Column, _: Column) -> Column:
        h, low = _step(s["h"], s["l"])
        j = F.floor((s["j"] + 1) * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(h, 1) + 1).cast("double"))).cast("long")
        return F.when(s["j"] < F.lit(shards), F.struct(h.alias("h"), low.alias("l"), s["j"].alias("b"), j.alias("j"))).otherwise(s)

    fold = lambda n: F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, ahead)
    short = fold(steps)
    return F.when(short["j"] >= shards, short).otherwise(fold(shards)) if steps < shards else short


def jump_hash(high: Column, low: Column, shards: int) -> Column:
    return jump_state(high, low, shards)["b"].cast("int")


def key_halves(key: Column) -> tuple[Column, Column]:
    """Two 32-bit halves of the first 64 bits of MD5 of the key as text; a null key counts as the empty text."""
    digest = F.md5(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8"))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9))


def shard_of(key: Column, shards: int) -> Column:
    return jump_hash(*key_halves(key), shards)


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Puts every row into a shard by its id alone ('key' law): (id, size, text_crc32, law, shard, slot, grown_shard).

    size: UTF-8 bytes of the text (null: none) plus 16. slot: place in the shard, gapless from 0, by ascending id
    (nulls last; repeated ids in any order). grown_shard: the shard if there were one more. Repeated ids share a
    shard, as the law says. The texts are read once and never shuffled; an empty table gives an empty result.
    """
    sized = docs.select(F.col(id_col).alias(id_col), (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(16)).cast("long").alias("size"), crc32(whole(F.col(text_col))).cast("long").alias("text_crc32"))
    state = sized.withColumn("_jump", jump_state(*key_halves(F.col(id_col)), shards))
    grown = F.when(F.col("_jump.j") == shards, F.lit(shards)).otherwise(F.col("_jump.b")).cast("int")
    placed = state.select(id_col, "size", "text_crc32", F.col("_jump.b").cast("int").alias("shard"), grown.alias("grown_shard"), F.lit(1).cast("long").alias("one"))
    return running_sums(placed, ["shard"], [id_col], ["one"], "shards").select(id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("before_one").alias("slot"), "grown_shard")
