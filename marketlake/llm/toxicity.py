"""Toxicity scores behind a noisy channel.

Spelled-around words (leetspeak, spaced-out letters, repeated letters) are
restored before scoring: each suspicious token opens a lattice of the letters
its characters may stand for, with an optional word edge at each separator, and
Viterbi decoding under a character trigram model of the corpus picks the
likeliest words.  Scores come from marker features
(words and word beginnings) of the restored text, learnt from labelled rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from marketlake.llm.common import saved, shipped, whole_text

shipped(__name__)

# Letters that a written character may stand for.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
_BASE = 27  # a-z and the word edge
_SYMBOL = np.zeros(256, dtype=np.uint8)  # byte -> 1..26, anything else 0
for _i in range(26):
    _SYMBOL[65 + _i] = _SYMBOL[97 + _i] = _i + 1
SUBSTITUTION, REPEAT, KEEP = 2.0, 0.3, 0.5  # costs in nats: a stand-in, a dropped repeat, a kept repeat
JOIN = 3.0  # cost of no word edge at a gap wider than the narrowest of its token
EDGES = (0.0, -2.0, -4.0)  # weights of a word edge: trigrams alone favour too few or too many, so all are decoded

_WORD = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(
    r"(?<![^\W_])(?!(?<=([@$!|+(€]))\1)"  # not within a run of stand-ins: linear on long ones
    r"(?:([^\W_]|[@$!|+(€])\2*[\s.,\-_*/~·•]+){3,}([^\W_]|[@$!|+(€])\3*(?![^\W_])"
)
_LEET_TOKEN = re.compile(r"(?<![^\W_])[^\W_@$!|+(€]*[0-9@$!|+(€][^\s.,;:?\"')\]]*")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_RUN = re.compile(r"[^\W_]+")
_OUTER = "!+(|"  # stand-ins that may also be punctuation around a token
CACHED_TOKEN = 40  # longer tokens are decoded too, but seldom come again


PREFIXES = (4, 5, 6)


class Channel:
    """Viterbi decoder over the letters a token may stand for."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.reshape(_BASE, _BASE, _BASE).tolist()
        self.cache: dict[str, list[str]] = {}

    def restore(self, token: str) -> list[str]:
        """Distinct words of the decodings: as one word, and with word edges where the token has separators."""
        found = self.cache.get(token)
        if found is None:
            gaps = _gaps(token)
            read = [self._viterbi(token, None, 0)]
            if gaps:
                read += [self._viterbi(token, edge, min(gaps)) for edge in EDGES]
            found = list(dict.fromkeys(w for words in read for w in words.split(" ") if w))
            if len(self.cache) > 50_000:
                self.cache.clear()
            if len(token) <= CACHED_TOKEN:
                self.cache[token] = found
        return found

    def _viterbi(self, token: str, edge: float | None, narrow: int) -> str:
        # state: the last two letters; value: cost and the letters so far, linked backwards
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        previous, width, held = "", 0, 0
        settled: list[str] = []
        for c in token:
            options = [(c, 0.0)] if c.isalpha() else [(x, SUBSTITUTION) for x in LEET.get(c, "")]
            if not options:
                width += 1  # a separator
                continue
            if width and edge is not None and previous:
                following = {}
                join = JOIN if width > narrow else 0.0
                for (a, b), (cost, path) in states.items():
                    for state, total, longer in (
                        ((a, b), cost + join, path),
                        ((b, 0), cost + self.costs[a][b][0] + edge, (path, " ")),
                    ):
                        kept = following.get(state)
                        if kept is None or total < kept[0]:
                            following[state] = (total, longer)
                states = following
            width = 0
            following = {}
            for (a, b), (cost, path) in states.items():
                repeated = c == previous and path[1] != " "
                if repeated:  # the repeat adds no letter
                    kept = following.get((a, b))
                    if kept is None or cost + REPEAT < kept[0]:
                        following[(a, b)] = (cost + REPEAT, path)
                for letter, channel in options:
                    n = ord(letter) - 96 if "a" <= letter <= "z" else 0
                    total = cost + channel + self.costs[a][b][n] + (KEEP if repeated else 0.0)
                    kept = following.get((b, n))
                    if kept is None or total < kept[0]:
                        following[(b, n)] = (total, (path, letter))
            states, previous, held = following, c, held + 1
            if held >= 1000 and len(states) == 1:  # all decodings agree so far: keep flat what is settled
                [(state, (cost, path))] = states.items()
                settled.append(_unlinked(path[0]))
                states, held = {state: (cost, (None, path[1]))}, 0
        path = min((cost + self.costs[a][b][0], a, b, path) for (a, b), (cost, path) in states.items())[3]
        return "".join(settled) + _unlinked(path)


def _unlinked(path: tuple | None) -> str:
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def _gaps(token: str) -> list[int]:
    """Widths of the separators between the letters and stand-ins of a token."""
    gaps, width = [], None
    for c in token:
        if c.isalpha() or c in LEET:
            if width:
                gaps.append(width)
            width = 0
        elif width is not None:
            width += 1
    return gaps


def restore_text(text: str, channel: Channel) -> list[str]:
    """Words that suspicious tokens of a lower-cased text stand for."""
    restored = []
    if any(c in text for c in LEET):
        for m in _LEET_TOKEN.finditer(text):
            # stand-ins around a token are letters or punctuation: read both ways
            for token in {m[0], m[0].lstrip(_OUTER), m[0].rstrip(_OUTER), m[0].strip(_OUTER)}:
                letters = sum(c.isalpha() for c in token)
                if 3 <= len(token) and letters and letters < len(token):
                    restored += channel.restore(token)
    if _REPEATED.search(text):
        for m in _RUN.finditer(text):
            if _REPEATED.search(m[0]):
                restored += channel.restore(m[0])
    for m in _SPACED.finditer(text):
        if any(c.isalpha() for c in m[0]):
            restored += channel.restore(m[0])
    return restored


def text_features(text: str, channel: Channel) -> set[str]:
    """Distinct words and word beginnings of a text and of what it disguises."""
    low = text.lower()
    words = set(_WORD.findall(low))
    words.update(restore_text(low, channel))
    features = set(words)
    for n in PREFIXES:
        features.update([f"^{w[:n]}" for w in words if len(w) > n])
    return features


def letter_costs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Negative log probabilities of letter trigrams over all texts: 27**3 numbers, whatever the corpus."""

    def count(batches):
        total = np.zeros(_BASE**3, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                data = value.as_py()
                if data:
                    s = np.concatenate(([0, 0], _SYMBOL[np.frombuffer(data, np.uint8)], [0])).astype(np.int32)
                    total += np.bincount(s[:-2] * _BASE * _BASE + s[1:-1] * _BASE + s[2:], minlength=_BASE**3)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"]
        )

    counted = docs.select(text_col).mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.full(_BASE**3, 0.1)
    for row in counted.toLocalIterator():  # at most 27**3 rows
        counts[row.cell] += row.n
    table = counts.reshape(_BASE, _BASE, _BASE)
    return -np.log(table / table.sum(axis=2, keepdims=True))


def _family_keys(text: str, n: int = 4) -> list[int]:
    """Min-hashes of the word triples: near copies agree on most of them."""
    words = text.lower().split()
    hashes = np.array(
        [xxhash.xxh3_64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))], dtype=np.uint64
    )
    with np.errstate(over="ignore"):
        odd = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        mixed = hashes[:, None] * odd
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed.min(axis=0).view(np.int64).tolist()


def learn_markers(
    docs: DataFrame,
    labels: DataFrame,
    costs: np.ndarray,
    max_per_class: int = 10_000,
    max_features: int = 50_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> dict[str, float]:
    """Marker features and the probability of label 1 where they occur.

    ``labels`` has ``doc_id`` and ``toxic`` (rows with nulls are ignored; of
    several labels the largest holds).  At most about ``max_per_class`` rows of
    either class, chosen by a hash of their ids, are read.  Near copies count
    once: of the rows that share any of several min-hashes one stays.  A feature
    is a marker when its share among label-1 rows beats its share among label-0
    rows by a likelihood-ratio test corrected for the number of features.
    """
    spark = docs.sparkSession
    spread = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000))
    labelled = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    totals = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if not totals.get(1) or not totals.get(0):
        return {}
    limit = F.when(F.col("toxic") == 1, F.lit(min(1_000_000, 1_000_000 * max_per_class // totals[1]))).otherwise(
        F.lit(min(1_000_000, 1_000_000 * max_per_class // totals[0]))
    )
    # at most about 2 * max_per_class rows of (id, label): bounded, hence broadcast
    sample = labelled.where(F.col("toxic").isin(0, 1) & (spread < limit))
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).join(
        F.broadcast(sample), "doc_id"
    )

    def keys(batches):
        for batch in batches:
            found = [_family_keys(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "toxic", "keys"],
            )

    families = saved(chosen.mapInArrow(keys, "doc_id bigint, toxic int, keys array<bigint>"), "toxicity-families")
    for i in range(4):
        kept = families.groupBy("toxic", F.col("keys")[i].alias("key")).agg(F.min("doc_id").alias("doc_id"))
        families = families.join(kept.select("doc_id").distinct(), "doc_id", "left_semi")
    families = saved(families.select("doc_id", "toxic").distinct(), "toxicity-kept")
    rows = {r.toxic: r["count"] for r in families.groupBy("toxic").count().collect()}
    n1, n0 = rows.get(1, 0), rows.get(0, 0)
    if not n1 or not n0:
        return {}

    def features(batches):
        channel, counts = Channel(costs), {}

        def flush():
            names = list(counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([counts[n][1] for n in names], pa.int64()),
                    pa.array([counts[n][0] for n in names], pa.int64()),
                ],
                names=["feature", "ones", "zeros"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                for f in text_features(text, channel):
                    counts.setdefault(f, [0, 0])[toxic] += 1
            if len(counts) > 100_000:
                yield flush()
                counts = {}
        if counts:
            yield flush()

    counted = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
        .join(F.broadcast(families), "doc_id")
        .mapInArrow(features, "feature string, ones bigint, zeros bigint")
        .groupBy("feature")
        .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    )
    counted = saved(counted.where(F.col("ones") >= 3), "toxicity-features")
    threshold = 2 * math.log(max(10, counted.count())) + 4
    a, b = F.col("ones"), F.col("zeros")
    everywhere = (a + b) / F.lit(float(n1 + n0))

    def likelihood(k: Column, n: int, p: Column) -> Column:
        other = F.lit(float(n)) - k
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when((other > 0) & (p < 1), other * F.log1p(-p)).otherwise(0.0)

    gain = 2 * (
        likelihood(a, n1, a / n1) + likelihood(b, n0, b / n0) - likelihood(a, n1, everywhere) - likelihood(b, n0, everywhere)
    )
    prior = totals[1] / (totals[1] + totals[0])
    rate1, rate0 = (a + 0.2) / F.lit(n1 + 1.0), (b + 0.2) / F.lit(n0 + 1.0)
    probability = rate1 * prior / (rate1 * prior + rate0 * (1 - prior))
    markers = (
        counted.withColumns({"gain": gain, "p": probability})
        .where((F.col("gain") >= threshold) & (F.col("p") >= 0.5))
        .orderBy(F.desc("gain"), "feature")
        .limit(max_features)
    )
    return {r.feature: r.p for r in markers.collect()}  # at most max_features rows


def score_text(text: str, markers: dict[str, float], channel: Channel) -> float:
    """1 - prod(1 - p) over the strongest marker of each word found, from a small base."""
    low = text.lower()
    words = set(_WORD.findall(low))
    words.update(restore_text(low, channel))
    clean = 0.98
    for word in words:
        p = markers.get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n:
                p = max(p, markers.get(f"^{word[:n]}", 0.0))
        clean *= 1 - p
    return 1 - max(clean, 1e-12)


def add_scores(
    docs: DataFrame, markers: dict[str, float], costs: np.ndarray, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """Add ``score_col``, 0 to 1, higher where label 1 is likelier.

    Only the text counts.  A null or empty text scores the base value; a column
    of that name is replaced; rows are independent; an empty table stays empty;
    without markers (no labels of both classes) every row has the base value.
    """
    shared = docs.sparkSession.sparkContext.broadcast((markers, costs))
    held: dict[str, Channel] = {}

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        known, table = shared.value
        if "channel" not in held:
            held["channel"] = Channel(table)
        return pa.array([score_text(t or "", known, held["channel"]) for t in text.to_pylist()], pa.float64())

    return docs.withColumn(score_col, score(whole_text(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, learnt from the labels of rows that are not held out."""
    costs = letter_costs(docs, text_col)
    markers = learn_markers(docs, labels.where(~held_out("doc_id")), costs, id_col=id_col, text_col=text_col)
    return add_scores(docs, markers, costs, text_col)
