"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Every string of ``length`` bytes (a window) has an anchor: the leftmost smallest
hash of its ``core``-byte substrings.  Equal windows have equal anchors, so runs
of windows with one anchor (segments) are dealt by the anchor's hash, and only
segments that share it can share a window.  Identical segments are counted
before they are dealt.  Where different segments meet, a task sorts them in
shards, each to a Burrows-Wheeler transform over letters of 40 bytes, and merges the
shards by interleave refinement: the interleave of all shards, at first their
concatenation, is refined one letter at a time by a stable sort of the letters
that the transforms give in its order; no suffix is sorted again.  Where
neighbours first come apart is their common prefix; intervals that hold after
``length`` bytes are the repeated windows.  Anchors with too many different
segments for one task are dealt anew by longer cores, at last by the window
itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from marketlake.llm.common import saved, shipped

shipped(__name__)

LENGTH = 200
CORE = 40
GROUP = 6_000  # different segments of an anchor merged in one task; more are dealt by longer cores
SHARD = 8_192  # letters of a shard, more where a batch would need over 255 shards
LETTER = 40  # bytes of a letter at most
BATCH = 60_000  # bytes merged at once (a group is never cut)
FILTER_BITS = 1 << 26  # bits of the broadcast row filter (8 MB)
_PIECE = 1 << 20  # windows anchored at once
_FLUSH = 4_000_000  # bytes of segments emitted at once

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every substring of ``size`` bytes, by doubling."""
    with np.errstate(over="ignore"):
        power, current, out, done = 1, _mixed(data.astype(np.uint64) + np.uint64(1)), None, 0
        n = len(data) - size + 1
        while True:
            if size & power:
                part = current[done : done + n]
                out = part if out is None else _mixed(out * _M2 + part)
                done += power
            if done == size:
                return out
            current = _mixed(current[:-power] * _M1 + current[power:])
            power *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if width == 1:
        return values
    rows = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    rows[: len(values)] = values
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments(text: bytes, length: int, core: int, spans: list | None = None) -> Iterator[tuple]:
    """Arrays (first window, windows, anchor hash, segment hash) of a text, by pieces; only windows in ``spans``."""
    for a in range(0, len(text) - length + 1, _PIECE):
        piece = text[a : a + _PIECE + length - 1]
        h = _hashes(np.frombuffer(piece, np.uint8), core)
        # order by 43 bits of the hash, ties to the left
        at = _least((h & np.uint64((1 << 64) - (1 << 21))) | np.arange(len(h), dtype=np.uint64), length - core + 1)
        at = (at & np.uint64((1 << 21) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        end = np.append(first[1:], len(at))
        if spans is not None:
            cut = [(max(s, x - a), min(e, y - a)) for x, y in spans for s, e in zip(first, end) if max(s, x - a) < min(e, y - a)]
            first, end = (np.array(x, np.int64) for x in (zip(*cut) if cut else ((), ())))
        digests = [xxhash.xxh3_64_intdigest(piece[s : e + length - 1]) for s, e in zip(first.tolist(), end.tolist())]
        yield first + a, end - first, h[at[first]].view(np.int64), np.array(digests, np.uint64).view(np.int64)


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def _occurrences(length: int, core: int):
    """(row, text[, spans]) to (f, dg, row, at, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [sorted((s["at"], s["at"] + s["size"]) for s in x) for x in batch.column(2).to_pylist()] if batch.num_columns > 2 else None
            for i, (row, text) in enumerate(zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), strict=True)):
                for at, size, f, dg in segments(text, length, core, spans and spans[i]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (f, dg, np.full(len(f), row, np.int64), at, size)],
                        names=["f", "dg", "row", "at", "size"],
                    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in run(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows > 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def _emit(length: int):
    """(text, wanted) to (f, dg, n, segment) for the wanted segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0

        def done() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=["f", "dg", "n", "segment"]
            )

        for batch in batches:
            for text, wanted in zip(_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                for w in wanted:
                    segment = text[w["at"] : w["at"] + w["size"] + length - 1]
                    out.append((w["f"], w["dg"], w["n"], segment))
                    size += len(segment)
                    if size > _FLUSH:
                        yield done()
                        out, size = [], 0
        if out:
            yield done()

    return run


def _ranks(data: np.ndarray, width: int) -> np.ndarray:
    """Rank of every substring of ``width`` bytes: equal only where the bytes are."""
    unit = next(u for u in (8, 5, 4, 3, 2, 1) if width % u == 0)
    current = np.zeros(len(data) - unit + 1, np.uint64)
    for k in range(unit):
        current = (current << np.uint64(8)) | data[k : k + len(current)]
    current = np.unique(current, return_inverse=True)[1]
    n, done, size, out = len(data) - width + 1, 0, unit, None
    while True:
        if (width // unit) & (size // unit):
            part = current[done : done + n]
            out = part if out is None else _paired(out, part)
            done += size
        if done == width:
            return out
        current = _paired(current[:-size], current[size:])
        size *= 2


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.unique(first * (second.max() + 1) + second, return_inverse=True)[1]


def transform(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all rotations of the strings of a shard, and their transform (the letter before each).

    Each string ends in letter 0, which occurs nowhere else; equal rotations
    keep the order of their strings.
    """
    string = np.repeat(np.arange(len(starts)), sizes)
    begin, size = starts[string], sizes[string]
    t = np.arange(len(letters)) - begin
    rank, step, longest = letters.astype(np.int64), 1, sizes.max()
    while step < longest:
        ahead = rank[begin + (t + step) % size]
        rank = np.unique(rank * (rank.max() + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        if rank.max() == len(rank) - 1:
            break
        step *= 2
    order = np.lexsort((string, rank))
    return order, letters[begin + (t - 1) % size][order]


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' rotations and where neighbours come apart.

    Returns the shard of each place of the merged order, sorted by ``depth``
    letters, and for each place the letters it shares with the one before
    (``depth`` if all of them).
    """
    letters = np.concatenate(transforms)
    if letters.max(initial=0) < 1 << 16:
        letters = letters.astype(np.uint16)  # sorted by radix
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(x) for x in transforms])
    common = np.full(len(letters), depth, np.int32)
    common[:1] = 0
    apart = np.zeros(len(letters), bool)
    apart[:1] = True
    in_order = np.empty_like(letters)
    for k in range(depth):
        in_order[np.argsort(shard, kind="stable")] = letters  # each shard's letters, one after the other
        block = np.cumsum(apart, dtype=np.int32)
        to = np.argsort(in_order, kind="stable")
        shard, block, sorted_ = shard[to], block[to], in_order[to]
        new = np.ones(len(letters), bool)
        new[1:] = (sorted_[1:] != sorted_[:-1]) | (block[1:] != block[:-1])
        common[new & ~apart] = k  # neighbours that are apart stay so, at the same place
        apart = new
    return shard, common


def repeated_windows(pieces: list[bytes], counts: list[int], length: int, shard_letters: int = SHARD) -> list[np.ndarray]:
    """Per piece, which of its windows occur twice among all pieces (a piece counts ``counts`` times)."""
    width = next(w for w in range(min(LETTER, length), 0, -1) if length % w == 0)
    data = np.frombuffer(b"".join(pieces) + bytes(width), np.uint8)
    value = _ranks(data, width)
    sizes = np.array([len(p) for p in pieces])
    base = np.cumsum(sizes) - sizes
    # every piece is `width` strings of letters, one per phase
    phase = np.tile(np.arange(width), len(pieces))
    owner = np.repeat(np.arange(len(pieces)), width)
    many = np.maximum(sizes[owner] - phase, 0) // width + 1
    begin = np.cumsum(many) - many
    string = np.repeat(np.arange(len(many)), many)
    t = np.arange(many.sum()) - begin[string]
    at = base[owner[string]] + phase[string] + width * t
    inside = t < many[string] - 1
    letters = np.zeros(len(t), np.int64)
    letters[inside] = np.unique(value[at[inside]], return_inverse=True)[1] + 1

    goal = max(shard_letters, len(t) // 200)
    cuts = np.flatnonzero(np.diff(begin // goal, prepend=-1))
    orders, transforms = [], []
    for a, b in zip(cuts, np.append(cuts[1:], len(many)), strict=True):
        low, high = begin[a], begin[b - 1] + many[b - 1]
        order, bwt = transform(letters[low:high], begin[a:b] - low, many[a:b])
        orders.append(order + low)
        transforms.append(bwt)
    shard, common = merge(transforms, length // width)
    element = np.empty(len(t), np.int64)
    element[np.argsort(shard, kind="stable")] = np.concatenate(orders)

    window = (at - base[owner[string]] + length <= sizes[owner[string]]).astype(np.int64)
    weight = (window * np.array(counts)[owner[string]])[element]
    interval = np.cumsum(common < length // width) - 1
    twice = np.bincount(interval, weights=weight)[interval] >= 2
    found = np.zeros(len(data), bool)
    hit = element[twice & (weight > 0)]
    found[at[hit]] = True
    return [found[b : b + max(0, n - length + 1)] for b, n in zip(base, sizes)]


def _merged(length: int):
    """(f, dg, n, segment) sorted by f to (f, dg, runs): first and end of the repeated windows, in turn."""

    def settle(held: dict) -> pa.RecordBatch:
        found = repeated_windows([v[1] for v in held.values()], [v[0] for v in held.values()], length)
        keys, runs = [], []
        for key, mask in zip(held, found, strict=True):
            if mask.any():
                keys.append(key)
                runs.append(np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist())
        columns = ([k[0] for k in keys], pa.int64()), ([k[1] for k in keys], pa.int64()), (runs, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(*c) for c in columns], names=["f", "dg", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = {}, 0, None
        for batch in batches:
            for f, dg, n, segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if f != last and size >= BATCH:
                    yield settle(held)
                    held, size = {}, 0
                last = f
                if (f, dg) not in held:
                    held[f, dg] = (n, segment)
                    size += len(segment)
        if held:
            yield settle(held)

    return run


def _among(rows: DataFrame):
    """Test for the ids in ``row``: an 8 MB bitmap at most.  It may say yes for others, more so beyond millions of rows."""
    total = rows.count()
    bits = min(FILTER_BITS, max(1 << 10, 1 << (16 * total).bit_length()))
    place = F.pmod(F.xxhash64("row"), F.lit(bits))
    words = rows.select(F.floor(place / 32).alias("word"), F.expr("1L").alias("one"), (place % 32).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits"))
    table = np.zeros(bits // 32, np.uint32)
    for row in words.toLocalIterator():
        table[row.word] = row.bits
    shared = rows.sparkSession.sparkContext.broadcast(table.tobytes())

    @arrow_udf("boolean")
    def among(place: pa.Array) -> pa.Array:
        at = place.to_numpy(zero_copy_only=False)
        filled = np.frombuffer(shared.value, np.uint32)
        return pa.array((filled[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)

    return among(place)


def _ladder(core: int, length: int) -> list[int]:
    cores = [core]
    while cores[-1] < length:
        cores.append(min(length, cores[-1] + max(8, (length - cores[-1]) // 2)))
    return cores


def _found(texts: DataFrame, length: int, cores: list[int], group: int, spans: DataFrame | None = None) -> DataFrame:
    """``row, at, size, runs`` of all segments with repeated windows (no runs: all of its windows)."""
    core = cores[0]
    given = texts.select("row", "text")
    if spans is not None:
        own = spans.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("at", "size")).alias("spans"))
        own = saved(own, "repeat-spans")
        given = given.where(_among(own.select(F.col("_row").alias("row")))).join(own, F.col("row") == F.col("_row")).drop("_row")
    occurrences = given.mapInArrow(_occurrences(length, core), "f bigint, dg bigint, row bigint, at bigint, size bigint")
    occurrences = saved(occurrences, "repeat-segments")
    # identical segments have one size; any place in the least row holds their bytes
    alike = occurrences.groupBy("f", "dg").agg(
        F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("at", "row").alias("at"), F.max("size").alias("size")
    )
    shared = alike.withColumn("kinds", F.count("*").over(Window.partitionBy("f"))).where("kinds > 1 or n > 1")
    shared = saved(shared, "repeat-groups")

    mixed = shared.where((F.col("kinds") > 1) & (F.col("kinds") <= group))
    wanted = mixed.groupBy(F.col("row").alias("_w")).agg(F.collect_list(F.struct("f", "dg", "n", "at", "size")).alias("wanted"))
    wanted = saved(wanted, "repeat-wanted")
    holders = texts.where(_among(wanted.select(F.col("_w").alias("row")))).join(wanted, F.col("row") == F.col("_w"))
    dealt = holders.select("text", "wanted").mapInArrow(_emit(length), "f bigint, dg bigint, n bigint, segment binary")
    merged = dealt.repartition("f").sortWithinPartitions("f").mapInArrow(
        _merged(length), "f bigint, dg bigint, runs array<bigint>"
    )
    whole = shared.where("kinds = 1").select("f", "dg", F.lit(None).cast("array<bigint>").alias("runs"))
    crowded = shared.where(F.col("kinds") > group)
    again = bool(crowded.head(1))
    result = merged.union(whole)
    if again:  # an empty list marks what goes to the next round
        result = result.union(crowded.select("f", "dg", F.array().cast("array<bigint>").alias("runs")))
    result = saved(result, "repeat-results").select(F.col("f").alias("_f"), F.col("dg").alias("_dg"), "runs")
    found = occurrences.join(result, (F.col("f") == F.col("_f")) & (F.col("dg") == F.col("_dg")))
    found = saved(found.select("row", "at", "size", "runs"), "repeat-found")
    if not again:
        return found
    later = _found(texts, length, cores[1:], group, found.where("size(runs) = 0").select("row", "at", "size"))
    return found.where("runs is null or size(runs) > 0").union(later)


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, core: int = CORE, group: int = GROUP, text_col: str = "text"
) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes found twice covers.

    Texts are UTF-8 bytes; strings never cross rows; a string that starts at two
    places, in one text or two, takes all bytes of all its places; overlaps count
    and all strings are judged on the input.  Returns the columns of ``docs``
    without the text, with ``kept`` (binary: the cut may fall within a
    character), ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed
    runs); columns of those names are replaced.

    A null or empty text is empty and has no spans, and so is any text shorter
    than ``length`` kept whole.  Each row is a text of its own, repeated rows
    too.  ``docs`` is read several times and must be a stored table (rows are
    known by their place in the scan).  An empty table gives an empty result.
    """
    added = ("kept", "n_bytes", "n_removed", "n_spans")
    others = [c for c in docs.columns if c not in (*added, text_col)]
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("others"),
    )
    found = _found(texts, length, _ladder(core, length), group)
    hits = found.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("at", "size", "runs")).alias("hits"))
    hits = saved(hits, "repeat-hits")

    @arrow_udf("struct<kept: binary, n_removed: bigint, n_spans: bigint>")
    def cut(text: pa.Array, hits: pa.Array) -> pa.Array:
        kept, removed, spans = [], [], []
        for value, found in zip(_bytes(text), hits.to_pylist(), strict=True):
            edges = np.zeros(len(value) + 1, np.int64)
            for h in found or ():
                runs = h["runs"] or [0, h["size"]]
                for a, b in zip(runs[::2], runs[1::2]):
                    edges[h["at"] + a] += 1
                    edges[h["at"] + b + length - 1] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            kept.append(np.frombuffer(value, np.uint8)[~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int(np.count_nonzero(gone[1:] > gone[:-1]) + (gone[:1].sum())))
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
            names=["kept", "n_removed", "n_spans"],
        )

    held = _among(hits.select(F.col("_row").alias("row")))
    size = F.octet_length("text").cast("long").alias("n_bytes")
    touched = texts.where(held).join(hits, F.col("row") == F.col("_row"), "left")
    touched = touched.select("others", size, cut(F.col("text"), F.col("hits")).alias("_cut"))
    clean = texts.where(~held).select("others.*", F.col("text").cast("binary").alias("kept"), size)
    clean = clean.withColumns({"n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long")})
    touched = touched.select("others.*", "_cut.kept", "n_bytes", "_cut.n_removed", "_cut.n_spans")
    return clean.union(touched)
