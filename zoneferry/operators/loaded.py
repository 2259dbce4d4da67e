"""A load against what its target already holds, without shuffling the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zoneferry.functions.columns import name, quoted
from zoneferry.operators.joins import require_keys
from zoneferry.operators.keyed import typed_keys
from zoneferry.operators.quality import DuplicateKeys
from zoneferry.session import stage, staged

#: Most 64-bit words of a key filter, which bounds what is broadcast.
FILTER_WORDS = 1 << 21
#: Keys a word is meant for: 16 bits each.
KEYS_A_WORD = 4
#: Bits a key sets in its word.
BITS = 4

WORD, MASK, HELD = "zf_word", "zf_mask", "zf_held"


def _word(keys: Sequence[str], words: int) -> Column:
    """The word of the filter that a key belongs to; null keys have one as well."""
    return F.pmod(F.xxhash64(*[name(k) for k in keys]), F.lit(words)).alias(WORD)


def _mask(keys: Sequence[str]) -> Column:
    """The bits a key sets in its word, from a hash of their own, six bits of it for each."""
    own = F.xxhash64(F.lit("zf"), *[name(k) for k in keys])
    mask = F.lit(0).cast("bigint")
    for i in range(BITS):
        bit = F.shiftright(own, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask.alias(MASK)


def key_filter(keys: DataFrame, on: Sequence[str], words: int) -> DataFrame:
    """A Bloom filter of keys, one row per word in use: ``zf_word`` and its bits ``zf_held``."""
    return keys.select(_word(on, words), _mask(on)).groupBy(WORD).agg(F.bit_or(MASK).alias(HELD))


def filter_words(keys: int, most: int = FILTER_WORDS) -> int:
    """Words for a number of keys: the next power of two, up to ``most``."""
    return min(most, 1 << (max(1, -(-keys // KEYS_A_WORD)) - 1).bit_length())


def maybe_held(rows: DataFrame, held: DataFrame, on: Sequence[str], words: int) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and few others."""
    probed = rows.withColumns({WORD: _word(on, words), MASK: _mask(on)}).join(F.broadcast(held), WORD)
    return probed.where(F.col(HELD).bitwiseAND(F.col(MASK)) == F.col(MASK)).drop(WORD, MASK, HELD)


def already_loaded(
    delta: DataFrame, target: DataFrame, on: Sequence[str], words: int = FILTER_WORDS
) -> DataFrame:
    """Keys of ``delta`` that ``target`` holds: keys, ``rows`` and ``loaded``, their rows in either.

    The delta's keys are made unique and written once. An aggregate makes a Bloom
    filter of them, of at most ``words`` words (some 80 MB when broadcast), and the
    target's key columns are held against it where they are read; only rows that pass
    are counted by key, combined before they are shuffled, and joined to the exact keys.
    Up to four keys a word, 8 million in all, some one in a hundred rows without a
    partner passes; a larger delta lets more through, which costs shuffle and never
    changes the rows. Keys are cast to the target's types; null keys equal each other,
    as in ``duplicate_keys``. An empty delta or target gives no rows.
    """
    require_keys(on)
    columns = [name(k) for k in on]
    unique = typed_keys(delta, target, on).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    with staged(unique, "delta-keys") as keys:
        size = filter_words(keys.count(), words)
        hits = maybe_held(target.select(*columns), key_filter(keys, on, size), on, size)
        counts = hits.groupBy(*columns).agg(F.count(F.lit(1)).alias("loaded"))
        same: Column = F.lit(True)
        for k in on:
            same = same & F.col(f"d.{quoted(k)}").eqNullSafe(F.col(f"t.{quoted(k)}"))
        found = keys.alias("d").join(counts.alias("t"), on=same)
        return stage(found.select(*[F.col(f"d.{quoted(k)}") for k in on], "rows", "loaded"), "loaded")


def require_new(delta: DataFrame, target: DataFrame, on: Sequence[str]) -> None:
    """Raise when the target already holds a key of the delta."""
    if not already_loaded(delta, target, on).isEmpty():
        raise DuplicateKeys(f"keys of ({', '.join(on)}) are loaded already")
