"""Line deduplication with two Bloom filters.

Pass one fills two filters: *once* (hashes seen) and *twice* (hashes seen in a
second document).  Each task emits its own filters cut into segments of 2**16
bits; segments merge with ``twice |= t | (once & o); once |= o``, which can
only add false suspects, never lose a repeat.  Pass two looks every line up in
*twice*: only suspects leave their task, are counted exactly by a 128-bit
digest of the line key, and choose the document that keeps the line.  Documents
without suspects are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from marketlake.llm.common import SPACE, saved, shipped, whole_text

shipped(__name__)

SEGMENT_BITS = 1 << 16
MAX_BITS = 1 << 28  # 32 MB: the bound of what is broadcast
_SPARSE = 4096  # positions up to which a segment travels as a list
_FLUSH = 300_000  # digests a task holds before it emits its filters


def line_digest(line: bytes, min_chars: int) -> bytes | None:
    """128-bit digest of a line's key, None when the key is too short."""
    key = line.strip(SPACE).lower()  # bytes.lower() touches A-Z only
    size = len(key)
    if size < min_chars or (size < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _document_digests(text: bytes, min_chars: int) -> set[bytes]:
    found = {line_digest(line, min_chars) for line in text.split(b"\n")}
    found.discard(None)
    return found


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def _positions(digests: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Filter positions, one row per probe, of an (n, 2) array of 64-bit halves."""
    steps = np.arange(probes, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        return (digests[:, 0] + steps * (digests[:, 1] | np.uint64(1))) & np.uint64(bits - 1)


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=">u8").astype(np.uint64).reshape(-1, 2)


def _pack(low: np.ndarray) -> bytes:
    if len(low) < _SPARSE:
        return low.astype("<u2").tobytes()
    bitmap = np.zeros(SEGMENT_BITS, dtype=bool)
    bitmap[low] = True
    return np.packbits(bitmap, bitorder="little").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if len(data) == SEGMENT_BITS // 8:
        return np.frombuffer(data, dtype=np.uint8)
    bitmap = np.zeros(SEGMENT_BITS, dtype=bool)
    bitmap[np.frombuffer(data, dtype="<u2")] = True
    return np.packbits(bitmap, bitorder="little")


def _segments(digests: list[bytes], bits: int, probes: int) -> pa.RecordBatch:
    halves = _halves(digests)
    _, first, counts = np.unique(halves[:, 0], return_index=True, return_counts=True)
    once = np.unique(_positions(halves[first], bits, probes).ravel())
    twice = np.unique(_positions(halves[first[counts > 1]], bits, probes).ravel())
    segments = np.unique(once >> np.uint64(16))
    rows = []
    for filled in (once, twice):
        starts = np.searchsorted(filled, segments << np.uint64(16))
        ends = np.searchsorted(filled, (segments + np.uint64(1)) << np.uint64(16))
        low = filled & np.uint64(SEGMENT_BITS - 1)
        rows.append([_pack(low[a:b]) for a, b in zip(starts, ends, strict=True)])
    return pa.RecordBatch.from_arrays(
        [pa.array(segments.astype(np.int32)), pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.binary())],
        names=["segment", "once", "twice"],
    )


def _twice_filter(texts: DataFrame, bits: int, probes: int, min_chars: int) -> bytes:
    """The merged *twice* filter, ``bits / 8`` bytes (at most 32 MB)."""

    def build(batches):
        held: list[bytes] = []
        for batch in batches:
            for text in _texts(batch.column(0)):
                held.extend(_document_digests(text, min_chars))
            if len(held) >= _FLUSH:
                yield _segments(held, bits, probes)
                held = []
        if held:
            yield _segments(held, bits, probes)

    def merge(batches):
        current, once, twice = None, None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([twice.tobytes()], pa.binary())], names=["segment", "twice"]
            )

        for batch in batches:
            for segment, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != current:
                    if current is not None and twice.any():
                        yield done()
                    current = segment
                    once, twice = np.zeros(SEGMENT_BITS // 8, np.uint8), np.zeros(SEGMENT_BITS // 8, np.uint8)
                seen = _unpack(o)
                twice = twice | _unpack(t) | (once & seen)
                once = once | seen
        if current is not None and twice.any():
            yield done()

    parts = texts.mapInArrow(build, "segment int, once binary, twice binary")
    merged = (
        parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, twice binary")
    )
    out = bytearray(bits // 8)
    for row in merged.toLocalIterator():  # at most bits / 2**16 rows of 8 KB
        out[row.segment * SEGMENT_BITS // 8 : (row.segment + 1) * SEGMENT_BITS // 8] = row.twice
    return bytes(out)


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = 5, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Drop lines that many documents share, everywhere but in the document with the largest id.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z
    lower-cased.  A key of at least ``min_chars`` code points found in at least
    ``min_docs`` documents loses all its lines except those of the largest id
    holding it.  Returns the columns of ``docs`` with the kept text, then
    ``n_lines`` (before) and ``n_dropped``; columns of those names are replaced.

    A null or empty text has one empty line.  Each row is a document of its
    own, also when ids repeat; rows with the same id lose the same lines.  Rows
    without an id count as holders but keep all their lines.  An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    base = docs.select(*(F.col(f"`{c}`") for c in kept_columns)).withColumn(text_col, whole_text(text_col))
    n_lines = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1

    total = base.select(F.sum(n_lines)).first()[0] or 0
    bits = min(MAX_BITS, max(SEGMENT_BITS, 1 << math.ceil(math.log2(max(1, 16 * total)))))
    probes = min(4, max(1, round(math.log(2) * bits / max(1, total))))
    shared = spark.sparkContext.broadcast(_twice_filter(base.select(text_col), bits, probes, min_chars))

    def suspects_of(column: pa.Array) -> list[list[bytes]]:
        owned = [list(_document_digests(text, min_chars)) for text in _texts(column)]
        flat = [d for own in owned for d in own]
        if not flat:
            return owned
        at = _positions(_halves(flat), bits, probes).astype(np.int64)
        filled = np.frombuffer(shared.value, dtype=np.uint8)
        hit = iter((((filled[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)).tolist())
        return [[d for d in own if next(hit)] for own in owned]

    def emit(batches):
        for batch in batches:
            ids, found = batch.column(0), suspects_of(batch.column(1))
            index = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(index)), pa.array([d for f in found for d in f], pa.binary())], names=["id", "digest"]
            )

    @arrow_udf("boolean")
    def suspected(text: pa.Array) -> pa.Array:
        return pa.array([bool(f) for f in suspects_of(text)], pa.bool_())

    @arrow_udf("struct<text: string, n_dropped: bigint>")
    def without(text: pa.Array, drops: pa.Array) -> pa.Array:
        texts, dropped = [], []
        for value, gone in zip(_texts(text), drops.to_pylist(), strict=True):
            count = 0
            if gone:
                gone, lines, kept = set(gone), value.split(b"\n"), []
                for line in lines:
                    if line_digest(line, min_chars) not in gone:
                        kept.append(line)
                count, value = len(lines) - len(kept), b"\n".join(kept)
            texts.append(value)
            dropped.append(count)
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64())], names=["text", "n_dropped"]
        )

    id_type = dict(base.dtypes)[id_col]
    suspects = saved(base.select(id_col, text_col).mapInArrow(emit, f"id {id_type}, digest binary"), "line-suspects")
    repeated = (
        suspects.groupBy("digest")
        .agg(F.count("*").alias("holders"), F.max("id").alias("keeper"))
        .where(F.col("holders") >= min_docs)
    )
    drops = (
        suspects.join(repeated, "digest")
        .where(F.col("id") != F.col("keeper"))
        .groupBy(F.col("id").alias("_dropped_id"))
        .agg(F.collect_set("digest").alias("_dropped"))
    )
    flag = suspected(F.col(text_col))
    clean = base.where(~flag).withColumns({"n_lines": n_lines.cast("long"), "n_dropped": F.lit(0).cast("long")})
    touched = (
        base.where(flag)
        .join(drops, F.col(id_col) == F.col("_dropped_id"), "left")
        .withColumn("n_lines", n_lines.cast("long"))
        .withColumn("_kept", without(F.col(text_col), F.col("_dropped")))
        .withColumns({text_col: F.col("_kept.text"), "n_dropped": F.col("_kept.n_dropped")})
        .select(*(F.col(f"`{c}`") for c in clean.columns))
    )
    return clean.unionByName(touched)
