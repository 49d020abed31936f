"""Name similarity, 2 * matched characters / total characters, and join keys for it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Mapping, Sequence
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from itertools import combinations
from math import ceil, comb, floor, prod
import sys
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# These helpers travel with the UDFs, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matcher_ratio(left: str, right: str, floor: float = 0.0) -> float | None:
    """Ratio of two strings, or None once it is known to be below ``floor``.

    The quick bounds never underestimate, so skipping on them is exact.
    """
    if floor and not enough_grams(left, right, floor):
        return None
    matcher = SequenceMatcher(None, left, right)
    if floor and (matcher.real_quick_ratio() < floor or matcher.quick_ratio() < floor):
        return None
    ratio = matcher.ratio()
    return ratio if ratio >= floor else None


def similarity_ratio(floor: float = 0.0):
    """Arrow UDF ``(left, right) -> double``; argument order matters."""

    @F.pandas_udf("double")
    def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if a is None or b is None else matcher_ratio(a, b, floor)
                for a, b in zip(left, right)
            ],
            dtype="float64",
        )

    return ratio


# --- join keys -------------------------------------------------------------
#
# ratio = 2M/T with M matched characters and T = la + lb.  A pair at or above
# the floor r has M >= need(T) = ceil(r*T/2), hence at most T - 2*need
# characters without a partner.  Each of them ends at most one run of matched
# characters, so of the q-grams of both names, padded with q - 1 marks at either
# end, at least
#
#     shared(T) = need + (q - 1) * (1 - (T - 2*need))
#
# are matched as well, in the same order in both names.
#
# Grams that the other side lacks have no partner.  Order the rest of a name's
# grams from rare to frequent, equal ones by place.  The t first matched pairs
# lie within the first |rest| - shared(T) + t of both names.  A join key is t of
# those grams, in the order of the name; every passing pair has one in common.
#
# T alone says which grams: as many short ones as keep the keys of a name within
# a budget, two at least; or one of the longest that is certain to be shared,
# where long names would need too many pairs of short ones, or where no gram is
# frequent enough to be a key of very many names.  Names of which few enough
# characters can be left out have what remains as their keys instead: need(T)
# matched characters are a common subsequence.

_KEYS = 100  # most keys per name and sum of lengths, unless two grams need more
_PADS = ("\x02", "\x03")
GRAM_BUCKETS = 1 << 16  # frequencies are counted by hash: a bounded table however many grams there are
_NAMES_AT_ONCE = 1000
_MASK_WORDS = 2
_LONGEST_GRAM = 8
_EVEN = 0.001  # two grams are equal less often than this


def _needed(total: int, ratio: float) -> int:
    return ceil(ratio * total / 2 - 1e-9)


def gram_size(ratio: float, largest: int = 3) -> int:
    """Characters per gram: a lower ratio leaves no longer gram certain to be shared."""
    return min(largest, 3 if ratio >= 0.84 else 2 if ratio >= 0.7 else 1)


def _grams(name: str, size: int) -> list[str]:
    padded = _PADS[0] * (size - 1) + name + _PADS[1] * (size - 1)
    return _grams_within(padded, size)


def _grams_within(text: str, size: int) -> list[str]:
    return [text[i : i + size] for i in range(len(text) - size + 1)]


def _shared(total: int, ratio: float, size: int) -> int:
    """Least number of matched grams of a passing pair with ``total`` characters."""
    need = _needed(total, ratio)
    return need + (size - 1) * (1 - total + 2 * need)


@lru_cache(maxsize=GRAM_BUCKETS)
def _bucket(gram: str) -> int:
    return crc32(gram.encode("utf-8", "replace")) % GRAM_BUCKETS


def gram_buckets(name: str, ratio: float) -> list[int]:
    """Frequency bucket of each gram of a name."""
    return [_bucket(gram) for gram in _grams(name, gram_size(ratio))]


def gram_counts(names: Sequence[str], ratio: float) -> Counter[int]:
    """How many grams of the names fall into each bucket: :func:`gram_buckets` of all of them, each distinct gram hashed once."""
    counts: Counter[int] = Counter()
    size = gram_size(ratio)
    for first in range(0, len(names), _NAMES_AT_ONCE):
        padded = [_PADS[0] * (size - 1) + name + _PADS[1] * (size - 1) for name in names[first : first + _NAMES_AT_ONCE]]
        codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        within = np.ones(len(codes), dtype=bool)
        for back in range(1, size):  # a gram does not start so near to the end of its name
            within[np.cumsum([len(p) for p in padded]) - back] = False
        starts = np.flatnonzero(within)
        packed = np.zeros(len(starts), dtype=np.int64)
        for i in range(size):  # three code points of 21 bits each
            packed = packed << 21 | codes[starts + i]
        for gram, n in zip(*(found.tolist() for found in np.unique(packed, return_counts=True))):
            counts[_bucket("".join(chr(gram >> 21 * i & 0x1FFFFF) for i in reversed(range(size))))] += n
    return counts


def grams_are_even(frequency: Mapping[int, int]) -> bool:
    """Whether two grams of a table are hardly ever equal: names are no families of near copies."""
    total = sum(frequency.values())
    return sum(n * n for n in frequency.values()) < _EVEN * total * total


@lru_cache(maxsize=None)
def _gram_key(total: int, ratio: float, even: bool) -> tuple[int, int]:
    """(characters per gram, grams per key) for the pairs with ``total`` characters."""
    size, need = gram_size(ratio), _needed(total, ratio)
    shared = _shared(total, ratio, size)
    spare = total - need + size - 1 - shared
    t = min(2, shared)
    while t < shared and comb(spare + t + 1, t + 1) <= _KEYS:
        t += 1
    longest = size
    # so many are shared that at most four of a name's keys hold padding: a few characters of it fit very many names
    while longest < _LONGEST_GRAM and _shared(total, ratio, longest + 1) >= max(1, 2 * (longest + 1) - 5):
        longest += 1
    over = t >= 2 and comb(spare + t, t) > _KEYS
    return (longest, 1) if longest > size and (over or even and longest >= size * t + 2) else (size, t)


@lru_cache(maxsize=1024)
def _key_rules(
    own: int, ratio: float, partners: frozenset[int] | None, even: bool
) -> tuple[tuple[int, int, int | None, int, int], ...]:
    """For each length that can reach ``ratio``: (grams and long grams that are shared, characters kept, size, t)."""
    size = gram_size(ratio)
    share = ratio / (2 - ratio)  # shorter / longer of a passing pair
    rules = set()
    for other in range(max(1, ceil(own * share - 1e-9)), floor(own / share + 1e-9) + 1):
        total = own + other
        need = _needed(total, ratio)
        if (partners is not None and other not in partners) or need > min(own, other):
            continue
        few = comb(own, own - need) + comb(other, other - need) <= 2 * _KEYS
        long, t = _gram_key(total, ratio, even)
        rules.add((_shared(total, ratio, size), _shared(total, ratio, long), need if few else None, long, t))
    return tuple(sorted(rules, key=str))


def name_signatures(
    name: str,
    ratio: float,
    partners: frozenset[int] | None = None,
    frequency: Mapping[int, int] | None = None,
    present: Collection[int] | None = None,
    even: bool = False,
) -> list[str]:
    """Join keys of a name against every partner length that can reach ``ratio``.

    ``partners`` lists the lengths that occur on the other side and ``present``
    the buckets of its grams, when known.  ``frequency`` counts the names' grams
    by bucket; any table gives right keys, provided both sides use the same one,
    and the measured one gives few pairs.  Both sides also share ``even``, which
    says whether it passes :func:`grams_are_even`.
    """
    size, counts = gram_size(ratio), frequency or {}
    buckets = gram_buckets(name, ratio)
    known = len(buckets) if present is None else sum(b in present for b in buckets)
    keys: set[str] = set()
    least_by: dict[tuple[int, int], int] = {}  # least number of shared grams by kind of key
    for shared, shared_long, kept, long, t in _key_rules(len(name), ratio, partners, even):
        if known < shared:
            continue
        if kept is not None:
            keys.update(f"{kept}-" + "".join(part) for part in combinations(name, kept))
        else:
            least_by[long, t] = min(least_by.get((long, t), shared_long), shared_long)
    for (long, t), least in least_by.items():
        grams = _grams(name, long)
        # what a longer gram has of the shorter ones; more padding is no gram
        pads = [None] * (long - size)
        parts = [*pads, *buckets, *pads]
        lacking = {i for i, b in enumerate(parts) if b is not None and present is not None and b not in present}
        weights = [max(1, counts.get(b, 0)) for b in parts]
        span = long - size + 1
        usable = [i for i in range(len(grams)) if lacking.isdisjoint(range(i, i + span))]
        if len(usable) < least:
            continue
        rarity = [prod(weights[i : i + span : size]) for i in range(len(grams))]
        padding = [parts[i : i + span].count(None) for i in range(len(grams))]  # padding is in all names: last
        rare = sorted(usable, key=lambda i: (padding[i], rarity[i], grams[i], i))
        places = sorted(rare[: len(usable) - least + t])
        keys.update(f"{long},{t}|" + "|".join(part) for part in combinations([grams[i] for i in places], t))
    return sorted(keys)


def may_have_partner(name: str, ratio: float, partners: frozenset[int], present: Collection[int]) -> bool:
    """Whether a name can reach ``ratio`` with any name of a side of these lengths and gram buckets.

    Never false for a name of a passing pair: enough of its grams are on the other side.
    """
    known = sum(b in present for b in gram_buckets(name, ratio))
    return any(known >= shared for shared, *_ in _key_rules(len(name), ratio, partners, False))


def enough_grams(left: str, right: str, ratio: float) -> bool:
    """Whether two names have as many grams in common as ``ratio`` asks of names this long."""
    size = gram_size(ratio, 2)
    common = Counter(_grams(left, size)) & Counter(_grams(right, size))
    return common.total() >= _shared(len(left) + len(right), ratio, size)


def gram_masks(name: str, ratio: float) -> list[int]:
    """128 bits of hashed grams of at most two characters, as 64-bit numbers.

    A bit in which two names differ stands for a gram without a partner.
    """
    bits = 0
    for gram in _grams(name, gram_size(ratio, 2)):
        bits |= 1 << (_bucket(gram) % (64 * _MASK_WORDS))
    words = [(bits >> (64 * i)) & ((1 << 64) - 1) for i in range(_MASK_WORDS)]
    return [w - (1 << 64) if w >= 1 << 63 else w for w in words]


def may_reach(
    left: Column, right: Column, left_masks: Sequence[str], right_masks: Sequence[str], ratio: float
) -> Column:
    """Whether two name lengths and :func:`gram_masks` leave ``ratio`` possible; never false for a passing pair."""
    total = left + right
    need = F.ceil(total * (ratio / 2) - 1e-9)
    size = gram_size(ratio, 2)
    shared = need + (size - 1) * (1 - total + 2 * need)
    differing = [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(left_masks, right_masks, strict=True)]
    return (need <= F.least(left, right)) & (
        reduce(Column.__add__, differing) <= total + 2 * (size - 1) - 2 * shared
    )


def name_mask(name: str) -> int:
    """64 bits: for each of 32 character classes, whether it occurs at least once and at least twice.

    Every bit in which two masks differ stands for a character without a
    partner, so the number of differing bits is at most T - 2M.
    """
    counts: dict[int, int] = {}
    for c in name:
        counts[ord(c) % 32] = counts.get(ord(c) % 32, 0) + 1
    mask = 0
    for index, n in counts.items():
        mask |= 1 << index
        if n > 1:
            mask |= 1 << (index + 32)
    return mask - (1 << 64) if mask >= 1 << 63 else mask
