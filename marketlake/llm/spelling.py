"""Spelling variants found in a frequency-vector trie.

A word's path through the trie is its length, then its letter counts, one
letter group after the other.  One inserted, deleted or replaced letter changes
that path by at most one surplus and one deficit.  Words are dealt to tasks by
subtree (length and the first counts); each word visits the subtrees its budget
can reach, a depth-first search spends what is left of the budget there, and
the words in the leaves it ends in are verified letter by letter.

Every pair is found once, from the shorter word, or for equal lengths from the
word with the smaller path (same path: the smaller word): so a search to the
same length takes its surplus before its deficit.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlake.llm.common import saved, shipped

shipped(__name__)

GROUPS = 12  # letter groups: levels of the trie below the length
SUBTREE = 20_000  # words of the largest subtree, deeper dealing beyond that
_MEMBERS, _CELLS = 50_000, 8_000_000  # words and letters searched at once
_STATES, _PAIRS = 500_000, 500_000  # search states expanded, pairs verified at once
_CROWDED = 128  # words of a leaf from which halves are looked up first


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each code point, common letters spread over the groups (one row per distinct code point is read)."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    counts = {ord(r.letter): r.n for r in letters.groupBy("letter").agg(F.sum(F.lit(1)).alias("n")).collect()}
    table = np.arange(max(counts, default=0) + 1) % groups
    for place, letter in enumerate(sorted(counts, key=lambda c: (-counts[c], c))):
        turn, at = divmod(place, groups)
        table[letter] = groups - 1 - at if turn % 2 else at
    return table.astype(np.int64)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and the words' lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), lengths


def _paths(words: list[str], table: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    codes, lengths = _codes(words)
    at = np.repeat(np.arange(len(words)), lengths) * groups + table[codes]
    return np.bincount(at, minlength=len(words) * groups).reshape(len(words), groups), lengths


def _deal(table: np.ndarray, groups: int, depth: int, visits: bool):
    """Arrow batches of (word, n) to (subtree, visitor, word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, lengths = _paths(batch.column(0).to_pylist(), table, groups)
            own = np.column_stack([lengths, paths[:, :depth]])
            keys, rows, visitor = [own], [np.arange(len(own))], [np.zeros(len(own), bool)]

            def add(change: dict[int, int]) -> None:
                target, fits = own.copy(), np.ones(len(own), bool)
                for level, by in change.items():
                    target[:, level] += by
                    fits &= target[:, level] >= 0
                keys.append(target[fits])
                rows.append(np.flatnonzero(fits))
                visitor.append(np.ones(len(rows[-1]), bool))

            if visits:
                add({})
                add({0: 1})
                for up in range(1, depth + 1):
                    add({up: 1})
                    add({0: 1, up: 1})
                    for down in range(up + 1, depth + 1):
                        add({up: 1, down: -1})
            packed = np.concatenate(keys).astype(">u4")
            width = packed.shape[1] * 4
            subtree = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(width), len(packed), [None, pa.py_buffer(packed.tobytes())]
            )
            taken = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [subtree.cast(pa.binary()), pa.array(np.concatenate(visitor)), *(c.take(taken) for c in batch.columns)],
                names=["subtree", "visitor", "word", "n"],
            )

    return run


def _matrix(words: list[str], width: int) -> np.ndarray:
    codes, lengths = _codes(words)
    out = np.zeros((len(words), width), np.uint32)
    out[np.arange(width) < lengths[:, None]] = codes
    return out


def _one_apart(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Rows of ``a`` and ``b`` (padded by zeros) that differ by one letter; ``longer``: b has one letter more."""
    same = a == b
    replaced = (~same).sum(axis=1) == 1
    lead = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
    shifted = (a[:, :-1] == b[:, 1:])[:, ::-1]
    trail = np.where(shifted.all(axis=1), shifted.shape[1], shifted.argmin(axis=1))
    return np.where(longer, lead + trail >= shifted.shape[1], replaced)


def _search(
    keys: list[bytes], words: list[str], visit_keys: list[bytes], visitors: list[str], table: np.ndarray, groups: int
) -> tuple[np.ndarray, np.ndarray]:
    """Indices (visitor, word) of all pairs one letter apart, where visitors may only end in words of their key."""
    place = {key: i for i, key in enumerate(dict.fromkeys(keys))}
    alive = [i for i, key in enumerate(visit_keys) if key in place]
    if not alive:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    root = np.array([place[k] for k in keys])
    paths, lengths = _paths(words, table, groups)
    wanted, sizes = _paths([visitors[i] for i in alive], table, groups)
    alive = np.array(alive)
    target = np.array([place[visit_keys[i]] for i in alive])
    longer = np.array([int.from_bytes(visit_keys[i][:4], "big") for i in alive]) > sizes

    # nodes of each level are runs of the sorted paths
    order = np.lexsort([*paths.T[::-1], root])
    paths, root = paths[order], root[order]
    new = np.ones(len(order), bool)
    new[1:] = root[1:] != root[:-1]
    node, children = np.cumsum(new) - 1, []
    for level in range(groups):
        counts = paths[:, level]
        new[1:] |= counts[1:] != counts[:-1]
        child = np.cumsum(new) - 1
        branch = np.full((node[-1] + 1, counts.max() + 1), -1, np.int64)
        branch[node, counts] = child
        children.append(branch)
        node = child
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(order))

    width = int(max(lengths.max(), sizes.max())) + 1
    letters, own = _matrix([words[i] for i in order], width), _matrix([visitors[i] for i in alive], width)
    halves = functools.cache(lambda leaf, shift: _by_halves(words, order[starts[leaf] : ends[leaf]], shift))
    position = np.empty(len(order), np.int64)
    position[order] = np.arange(len(order))
    found_v, found_w = [], []

    def verify(v: np.ndarray, w: np.ndarray, ordered: np.ndarray) -> None:
        ok = _one_apart(own[v], letters[w], longer[v])
        v, w, ordered = v[ok], w[ok], ordered[ok]
        keep = [not o or words[order[j]] > visitors[alive[i]] for i, j, o in zip(v, w, ordered, strict=True)]
        found_v.append(alive[v[keep]])
        found_w.append(order[w[keep]])

    def leaves(v: np.ndarray, leaf: np.ndarray, ordered: np.ndarray) -> None:
        sizes_ = ends[leaf] - starts[leaf]
        crowded = sizes_ > _CROWDED
        for i in np.flatnonzero(crowded):
            word, shift = visitors[alive[v[i]]], int(longer[v[i]])
            half = len(word) // 2
            heads, tails = halves(int(leaf[i]), shift)
            near = np.array(sorted({*heads.get(word[:half], ()), *tails.get(word[half:], ())}), np.int64)
            for a in range(0, len(near), _PAIRS):
                some = position[near[a : a + _PAIRS]]
                verify(np.full(len(some), v[i]), some, np.full(len(some), ordered[i]))
        v, leaf, ordered, sizes_ = v[~crowded], leaf[~crowded], ordered[~crowded], sizes_[~crowded]
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes_) // _PAIRS)) + 1
        for some in np.split(np.arange(len(v)), cuts):
            size = sizes_[some]
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            verify(np.repeat(v[some], size), np.repeat(starts[leaf[some]], size) + within, np.repeat(ordered[some], size))

    stack = []
    for a in range(0, len(alive), _STATES):
        v = np.arange(a, min(a + _STATES, len(alive)))
        stack.append((0, v, target[v], np.zeros(len(v), bool), longer[v]))  # a longer word has no deficit to spend
    while stack:
        level, v, at, surplus, deficit = stack.pop()
        if level == groups:
            done = surplus == deficit
            leaves(v[done], at[done], (~surplus & ~longer[v])[done])
            continue
        branch, parts = children[level], []
        for by, may in ((0, None), (1, ~surplus), (-1, surplus & ~deficit)):
            pick = np.arange(len(v)) if may is None else np.flatnonzero(may)
            count = wanted[v[pick], level] + by
            fits = (count >= 0) & (count < branch.shape[1])
            pick = pick[fits]
            child = branch[at[pick], count[fits]]
            pick, child = pick[child >= 0], child[child >= 0]
            parts.append((v[pick], child, surplus[pick] | (by == 1), deficit[pick] | (by == -1)))
        v, at, surplus, deficit = (np.concatenate(x) for x in zip(*parts, strict=True))
        for a in range(0, len(v), _STATES):
            cut = slice(a, a + _STATES)
            stack.append((level + 1, v[cut], at[cut], surplus[cut], deficit[cut]))
    return (np.concatenate(x) if x else np.empty(0, np.int64) for x in (found_v, found_w))


def _by_halves(words: list[str], members: np.ndarray, shift: int) -> tuple[dict, dict]:
    """Words one letter apart agree before or after the middle of the shorter: a leaf's words by either part."""
    heads, tails = {}, {}
    for i in members.tolist():
        half = (len(words[i]) - shift) // 2
        heads.setdefault(words[i][:half], []).append(i)
        tails.setdefault(words[i][half + shift :], []).append(i)
    return heads, tails


def _pairs(table: np.ndarray, groups: int):
    """Arrow batches sorted by (subtree, visitor) to (word, near, near_n), both ways."""

    def search(held: list) -> Iterator[pa.RecordBatch]:
        members, visits = [r for r in held if not r[1]], [r for r in held if r[1]]
        if not members or not visits:
            return
        v, w = _search(
            [r[0] for r in members], [r[2] for r in members], [r[0] for r in visits], [r[2] for r in visits], table, groups
        )
        a, b = [visits[i] for i in v], [members[j] for j in w]
        columns = [[r[2] for r in a + b], [r[2] for r in b + a], [r[3] for r in b + a]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
            names=["word", "near", "near_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, members, cells, last = [], 0, 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last and (members >= _MEMBERS or cells >= _CELLS or len(held) >= 8 * _MEMBERS):
                    yield from search(held)
                    held, members, cells = [], 0, 0
                last = row[0]
                held.append(row)
                members += not row[1]
                cells += len(row[2])
        if held:
            yield from search(held)

    return run


def near_words(words: DataFrame, groups: int = GROUPS, subtree: int = SUBTREE) -> DataFrame:
    """``word, near, near_n`` for all pairs of ``words`` (``word, n``, distinct) one letter apart, both ways."""
    table = letter_groups(words, groups)
    ddl = "subtree binary, visitor boolean, word string, n bigint"
    for depth in range(1, groups + 1):
        # as deep as it takes for the largest subtree to fit
        sizes = words.mapInArrow(_deal(table, groups, depth, False), ddl).groupBy("subtree").count()
        if (sizes.agg(F.max("count")).first()[0] or 0) <= subtree:
            break
    dealt = words.mapInArrow(_deal(table, groups, depth, True), ddl)
    by_subtree = dealt.repartition("subtree").sortWithinPartitions("subtree", "visitor")
    return by_subtree.mapInArrow(_pairs(table, groups), "word string, near string, near_n bigint")


def group_variants(words: DataFrame, times: int = 10, groups: int = GROUPS, subtree: int = SUBTREE) -> DataFrame:
    """Per word: its form, the last of its forms, and how many words are one letter apart.

    ``words`` has ``word`` and ``n``; rows of one word are summed, null words and
    null counts left out.  Two words are near if one inserted, deleted or
    replaced code point makes one the other.  A word's ``form`` is the near word
    with the largest count (ties: smallest in code-point order) if that is at
    least ``times`` its own, else null; ``root`` follows the forms to the last
    one and is the word itself where there is none.  Returns ``word, form, root,
    n, n_near, form_n``.  The empty word is near every word of one letter.  An
    empty table gives an empty result; other columns are left out.
    """
    if times < 2:
        raise ValueError("times must be 2 at least: counts must grow along a chain of forms")
    given = words.where(F.col("word").isNotNull() & F.col("n").isNotNull())
    given = saved(given.groupBy("word").agg(F.sum("n").cast("long").alias("n")), "spelling-words")
    near = near_words(given, groups, subtree)
    best = near.groupBy(F.col("word").alias("_word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("_best")
    )
    is_form = -F.col("_best.n") >= F.col("n") * times
    judged = given.join(best, F.col("word") == F.col("_word"), "left").select(
        "word",
        F.when(is_form, F.col("_best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("_best.n")).alias("form_n"),
    )
    judged = saved(judged, "spelling-forms")
    # counts grow at least `times`-fold along a chain, so few rounds of doubling reach its end
    links = judged.where(F.col("form").isNotNull()).select(F.col("word").alias("_from"), F.col("form").alias("_to"))
    while True:
        ahead = links.select(F.col("_from").alias("_mid"), F.col("_to").alias("_end"))
        moved = links.join(ahead, F.col("_to") == F.col("_mid"), "left")
        links = saved(moved.select("_from", F.coalesce("_end", "_to").alias("_to"), F.col("_end").isNotNull().alias("_on")), "spelling-roots")
        if not links.where("_on").head(1):
            break
        links = links.drop("_on")
    return judged.join(links, F.col("word") == F.col("_from"), "left").select(
        "word", "form", F.coalesce("_to", "word").alias("root"), "n", "n_near", "form_n"
    )
