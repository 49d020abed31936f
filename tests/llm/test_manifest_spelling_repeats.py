"""Merkle manifest, spelling variants and repeated bytes against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlake.llm import merkle, queries, repeats, spelling
from marketlake.session import configure


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(leaves, fanout):
    """Root, and per leaf the (left, right) siblings of every level."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, at in zip(paths, range(len(leaves))):
            place = places[at]
            run = place // fanout * fanout
            path.append(("".join(level[run:place]), "".join(level[place + 1 : run + fanout])))
            places[at] = place // fanout
        level = [digest(*level[a : a + fanout]) for a in range(0, len(level), fanout)]
    return level[0], paths


def brute_manifest(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], digest(*(field(v) for v in row)), row))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    for group in groups.values():
        group.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {n: climb([x[1] for x in groups[n]], fanout) for n in names}
    root, crowns = climb([trees[n][0] for n in names], fanout)
    out = []
    for name, crown in zip(names, crowns):
        for (key, leaf, row), path in zip(groups[name], trees[name][1]):
            steps, now = path + crown, leaf
            if key is not None and row[3] is not None and zlib.crc32(str(key).encode()) % 7 == 0:
                now = digest(*(field(v) for v in (*row[:3], row[3] + 1, row[4])))
            for left, right in steps:
                now = digest(left, now, right)
            out.append((key, leaf, trees[name][0], root, digest(*(a + b for a, b in steps)), now, now == root))
    return out


@pytest.mark.parametrize("fanout, depth", [(2, 10), (2, 2), (3, 2)])
def test_manifest(spark, fanout, depth):
    pick = random.Random(1).choice
    rows = []
    for n, lang in ((1, None), (5, "de"), (13, "en"), (33, "é")):
        for _ in range(n):
            rows.append((pick([None, *range(40)]), pick([None, "s"]), lang, pick([None, 5]), pick([None, "", "añb"])))
    rows += rows[-3:]  # repeated rows are leaves of their own
    df = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, i int, root string"
    )

    def leaf(n_chars):
        return merkle.row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    seen = F.when(queries.tampered(), leaf(F.col("n_chars") + 1)).otherwise(leaf(F.col("n_chars")))
    got = merkle.manifest(df, leaf(F.col("n_chars")), seen, fanout=fanout, depth=depth)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_manifest(rows, fanout), key=str)


def test_manifest_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, lang string")
    assert merkle.manifest(df, merkle.row_digest(F.col("doc_id"))).count() == 0


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("subtree, crowded", [(20_000, 128), (30, 128), (20_000, 1)])
def test_variants(spark, monkeypatch, subtree, crowded):
    monkeypatch.setattr(spelling, "_CROWDED", crowded)
    chance = random.Random(5)
    words = {"".join(chance.choice("abcdéeß") for _ in range(chance.randint(0, 6))) for _ in range(400)}
    words |= {"a" * 3000, "a" * 3001, "a" * 2999 + "b", "x" * 40 + "😀", "x" * 40 + "😁"}
    counts = {w: chance.choice([1, 2, 30, 400, 5000]) for w in sorted(words)}
    rows = [(w, n, "z") for w, n in counts.items()] + [(None, 3, "z"), ("q", None, "z")]
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= 10 * counts[w]}

    def root(word):
        return root(form[word]) if word in form else word

    got = spelling.group_variants(spark.createDataFrame(rows, "word string, n bigint, root string"), subtree=subtree)
    want = [(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(form.get(v) for v in form.values())  # a chain of forms


def test_variants_edges(spark):
    empty = spark.createDataFrame([], "word string, n bigint")
    assert spelling.group_variants(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(empty, times=1)


def test_spelt_words(docs_of):
    chance = random.Random(8)
    words = ["Umbrella", "umbrElla", "straßen", "Éclairs", "éclairs", "window", "windows"]
    texts = [(i, " ".join(chance.choice(words) for _ in range(60))) for i in range(80)] + [(90, None), (91, "")]
    counts = Counter()
    for doc_id, text in texts:
        for run in (text or "").split():
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = {r.word: r.n for r in queries.spelt_words(docs_of(texts)).collect()}
    assert got == want and "window" not in got


def brute_repeats(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for text in texts:
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield len(text), sum(gone), runs, bytes(b for b, g in zip(text, gone) if not g)


@pytest.mark.parametrize("length", [10, 16, 25])
def test_merged_transforms(length):
    chance = random.Random(length)
    for _ in range(40):
        letters = chance.choice([b"ab", b"abcdefgh"])
        pieces = [bytes(chance.choice(letters) for _ in range(chance.randint(length, 60))) for _ in range(12)]
        pieces.append(pieces[0][3:] + pieces[-1])
        weights = [chance.choice([1, 1, 2]) for _ in pieces]
        counts = Counter()
        for piece, n in zip(pieces, weights):
            for i in range(len(piece) - length + 1):
                counts[piece[i : i + length]] += n
        found = repeats.repeated_windows(pieces, weights, length, shard_letters=chance.choice([10, 50, 10_000]))
        for piece, mask in zip(pieces, found):
            assert mask.tolist() == [counts[piece[i : i + length]] > 1 for i in range(len(piece) - length + 1)]


def test_merge_common_prefixes():
    """The interleave of two shards and the letters that neighbours share, from their transforms alone."""
    import numpy as np

    strings = [[2, 1, 2, 1, 0], [1, 2, 1, 0], [2, 2, 1, 0]]
    shards = [strings[:2], strings[2:]]
    orders, transforms, rotations = [], [], []
    for shard in shards:
        flat = np.array([x for s in shard for x in s])
        sizes = np.array([len(s) for s in shard])
        order, bwt = repeats.transform(flat, np.cumsum(sizes) - sizes, sizes)
        own = [s[i:] + s[:i] for s in shard for i in range(len(s))]
        rotations.append([own[i] for i in order])
        assert rotations[-1] == sorted(own)
        transforms.append(bwt)
    depth = 3
    merged, common = repeats.merge(transforms, depth)
    taken = [iter(r) for r in rotations]
    rows = [next(taken[s])[:depth] for s in merged]
    assert rows == sorted(rows)
    shared = [0] + [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(rows, rows[1:])]
    assert common.tolist() == shared


@pytest.mark.parametrize("length, core, group", [(64, 16, 6000), (64, 8, 3), (200, 40, 6000)])
def test_repeats(spark, tmp_path, monkeypatch, length, core, group):
    monkeypatch.setattr(repeats, "_FLUSH", 2_000)
    configure(spark)
    chance = random.Random(2)
    base = ["".join(chance.choice("abcde é") for _ in range(chance.randint(0, 600))) for _ in range(60)]
    texts = list(base)
    for _ in range(80):
        a, b = chance.choice(base), chance.choice(base)
        texts.append(a[: chance.randint(0, len(a))] + chance.choice(["", "x", "yy"]) + b[chance.randint(0, len(b)) :])
    texts += [base[5]] * 4 + ["", "a" * 900, "ab" * 300, None, "z" * 3000]
    path = str(tmp_path / "docs")
    spark.createDataFrame(
        [(i, t, 7, None) for i, t in enumerate(texts)], "doc_id bigint, text string, n_spans int, row string"
    ).repartition(5).write.parquet(path)
    got = repeats.drop_repeats(spark.read.parquet(path), length, core, group)
    assert got.columns == ["doc_id", "row", "kept", "n_bytes", "n_removed", "n_spans"]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()}
    assert found == dict(enumerate(brute_repeats([(t or "").encode() for t in texts], length)))


def test_repeats_of_nothing(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(path)
    assert repeats.drop_repeats(spark.read.parquet(path)).count() == 0
