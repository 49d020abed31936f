"""Fingerprints, neighbours, toxicity, chat, mixing, near duplicates and the pipeline against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import chat, graph, mixing, neardup, neighbours, sketches, toxicity


def pieces_of(text):
    return {p for p in re.split(r"[\n.!?]+", text) if p}


def test_fingerprints_match_brute_force(docs_of, prose):
    rows = [(i, ". ".join(prose(6) for _ in range(i % 9 + 1))) for i in range(30)]
    rows += [(40, None), (41, ""), (42, rows[3][1]), (43, "One paragraph without an end"), (None, "no id. at all")]
    rows += [(90, "\n".join(prose(4) for _ in range(600)))]
    got = {r.doc_id: r for r in sketches.compare_versions(docs_of(rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited, r = text[: len(text) - cut] + after[:cut], got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(jaccard(pieces_of(text), pieces_of(edited)))
        assert r.near_next == pytest.approx(jaccard(pieces_of(text), pieces_of(after)))
    assert got[42].fingerprint == got[3].fingerprint != got[4].fingerprint
    assert sketches.compare_versions(docs_of([])).collect() == []


def test_peeling_recovers_the_digests(spark):
    generator = random.Random(1)
    rows = []
    for row in range(12):
        shared = [generator.getrandbits(63) + 1 for _ in range(row * 5)]
        a, b = ([generator.getrandbits(63) + 1 for _ in range(n)] for n in (row, 3 * row))
        rows.append((row, 0, shared + a, b + shared, 0.01))  # starts too small: has to retry
    pairs = spark.createDataFrame(rows, "row bigint, kind int, a array<bigint>, b array<bigint>, share double")
    got = {r.row: (set(r.only_a), set(r.only_b)) for r in sketches.differences(pairs, keep_digests=True).collect()}
    assert got == {r[0]: (set(r[2]) - set(r[3]), set(r[3]) - set(r[2])) for r in rows}


def test_next_text_crosses_blocks(spark, monkeypatch):
    monkeypatch.setattr(sketches, "BLOCK_ROWS", 3)
    ids = [*range(0, 40, 3), 10_000, 10_001, None]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "id bigint, text string")
    got = {r.text: r.next_text for r in sketches.with_next(docs).collect()}
    order = [f"t{i}" for i in [*sorted((i for i in ids if i is not None), reverse=True), None]]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_neighbours_recall_and_edges(spark):
    generator = np.random.default_rng(5)
    centres = generator.standard_normal((40, 16))
    x = np.vstack([centres[i % 40] + 0.4 * generator.standard_normal(16) for i in range(1500)]) * generator.uniform(0.5, 2, (1500, 1))
    x[100:160] = x[100]  # equal vectors: ties by id
    rows = [(i, [float(np.float32(c)) for c in v], "clash") for i, v in enumerate(x)]
    bad = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [float("inf")] + [1.0] * 15), (2080, [1.0])]
    rows += [(i, v, "clash") for i, v in bad] + [(2100, [None] + [1.0] * 15, "clash"), (None, [1.0] * 16, "clash"), rows[7]]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    v = x.astype(np.float32).astype(float)
    assert set(got) == set(range(0, 1500, 20))
    hit = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [i for _, i, _ in found]
        assert [s for _, _, s in found] == pytest.approx([float(v[q] @ v[i]) for _, i, _ in found])
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        scores = v @ v[q]
        scores[q] = -np.inf
        hit += len({i for _, i, _ in found} & set(np.argsort(-scores, kind="stable")[:20].tolist()))
    assert hit / (20 * len(got)) >= 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id bigint, embedding array<double>")
    answer = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(few, F.col("vec_id") == 0).collect()]
    assert sorted(answer) == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert neighbours.nearest(few.limit(0), F.col("vec_id") == 0).collect() == []


def test_viterbi_restores_disguised_words():
    corpus = ("idiot stupid loser trash hello world this is a line of plain words " * 50).encode()
    counts = np.full(27**3, 0.1)
    s = np.concatenate(([0, 0], toxicity._SYMBOL[np.frombuffer(corpus, np.uint8)], [0])).astype(np.int64)
    np.add.at(counts, s[:-2] * 729 + s[1:-1] * 27 + s[2:], 1)
    table = counts.reshape(27, 27, 27)
    channel = toxicity.Channel(-np.log(table / table.sum(axis=2, keepdims=True)))
    for written, meant in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("l.o.s.e.r", "loser"), ("stuuuupid", "stupid"), ("tr@$h", "trash")):
        assert meant in toxicity.restore_text(f"you {written} there", channel)
    assert toxicity.restore_text("hello plain words, 2024.", channel) == []


def letter_channel(corpus):
    counts = np.full(27**3, 0.1)
    s = np.concatenate(([0, 0], toxicity._SYMBOL[np.frombuffer(corpus.encode(), np.uint8)], [0])).astype(np.int64)
    np.add.at(counts, s[:-2] * 729 + s[1:-1] * 27 + s[2:], 1)
    table = counts.reshape(27, 27, 27)
    return toxicity.Channel(-np.log(table / table.sum(axis=2, keepdims=True)))


def test_spaced_letters_are_split_into_words():
    channel = letter_channel("idiot stupid loser trash hello world you are what a line of plain words " * 50)
    for written, meant in (
        ("what a l o s e r", {"a", "loser"}),
        ("y o u i d i o t", {"you", "idiot"}),
        ("y o u   i d i o t", {"you", "idiot"}),
        ("i d 1 0 t", {"idiot"}),
        ("i  d  i  o  t", {"idiot"}),
        ("l-0-$-e-r", {"loser"}),
        ("ii dd ii oo tt", {"idiot"}),
        ("l0ser/1d10t", {"loser", "idiot"}),
    ):
        assert meant <= set(toxicity.restore_text(written, channel)), written
    assert toxicity.restore_text("1 2 3 4 5", channel) == []


def test_disguised_words_of_any_length_and_outer_stand_ins():
    channel = letter_channel("idiot stupid loser trash hello world you are what a line of plain words " * 50)
    sentence = "you are what a loser you are a stupid idiot you are trash hello world"
    for written, meant in (
        ("!diot", {"idiot"}),
        ("you +rash", {"trash"}),
        ("(1d10t)", {"idiot"}),
        ("id" + "i" * 60 + "ot", {"idiot"}),
        ("1d10" + "0" * 5000 + "t", {"idiot"}),
        (" ".join(sentence.replace(" ", "")), {"you", "loser", "stupid", "idiot", "trash"}),
        ("1d10t/" * 2000 + "l0ser", {"idiot", "loser"}),
    ):
        assert meant <= set(toxicity.restore_text(written, channel)), written[:40]
    for plain in ("a" * 200_000, "!" * 200_000, "ab" * 100_000):  # linear: would not end otherwise
        toxicity.restore_text(plain + " 1", channel)


def test_toxicity_learns_markers(spark, docs_of, prose):
    rows, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        rows.append((i, prose(40) + (" You Zorgblat! " if toxic else " ") + prose(20)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, prose(10) + " z o r g b l a t"), (1003, "ZORGBLAT" + " word" * 30_000)]
    frame = spark.createDataFrame([*labels, (5, 1, 0), (None, 1, 1), (6, 1, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs_of(rows), frame).collect()}
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i in range(240))
    assert got[1000] == got[1001] < 0.1 and got[1002] >= 0.7 and got[1003] >= 0.7
    unlabelled = toxicity.score_documents(docs_of(rows[:3]), frame.limit(0)).collect()
    assert len({r.score for r in unlabelled}) == 1
    assert toxicity.score_documents(docs_of([]), frame).collect() == []
    held = docs_of([(i, "") for i in range(50)]).select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in held)


@pytest.mark.parametrize("text", ["", "\\", "\\\\<", "</s>", "<\\/s>", "[INST]<<SYS>>", "<</s>", "a</s></s>\\n", "[/TURN]\\"])
def test_chat_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    turns = [{"role": r, "text": text} for r in ("user", "assistant", "system", "tool", "", "[INST]")]
    output, spans = chat.render(chat.TEMPLATE, turns)
    assert chat.read_turns(output) == [(t["role"], t["text"]) for t in turns]
    assert "".join(chat.unescape(output[a:b]) for a, b in spans) == text


def test_chat_compiler():
    assert chat.parse("{{ 'a' + 'b' }}c{% if 1 == 2 %}x{% else %}y{% endif %}") == [("text", "abc"), ("text", "y")]
    text, spans = chat.render("{% for m in messages %}{{ m.text | trim }}{% if not loop.first and m.role != 'u' %}!{% endif %}{% endfor %}", [{"role": "a", "text": " x "}, {"role": "a", "text": "y"}])
    assert (text, spans) == ("xy!", [])
    for bad in ("{% for x in y %}", "{{ a.b.c }}", "{{ a | exec }}", "{% import os %}", "{{ f(x) }}", "{% if a %}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)


def test_conversation_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo </s>"), (1, 1, "assistant", None), (1, 3, None, "x"), (2, 0, "assistant", "w" * 100_000)]
    rows += [(3, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(2500)] + [(None, None, "user", "lost")]
    frame = spark.createDataFrame([(*r, 9) for r in rows], "conv_id bigint, turn bigint, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat.conversation_digests(frame).collect()}
    for conv in (1, 2, 3, None):
        own = sorted([(t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv])
        loss = "".join(x for _, r, x in own if r == "assistant")
        turns = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(own), turns)
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(frame).count() == len(rows)
    assert chat.conversation_digests(frame.limit(0)).collect() == []


def test_mixing_targets_and_balance(spark):
    generator = random.Random(2)
    rows = [(i, f"s{i % 7}" if i % 5 else "s0", generator.randint(0, 300)) for i in range(4000)]
    rows += [(5000, None, 10), (5000, None, 10), (5001, None, 12), (5002, "empty", 0), (None, "s1", 50)]
    units = spark.createDataFrame([(*r, "x") for r in rows], "id bigint, source string, size bigint, target string")
    first = mixing.mix(units, block_rows=300)
    got = [tuple(r) for r in first.collect()]
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in mixing.mix(units, block_rows=300).collect())
    size = {}
    for _, s, n in rows:
        size[s] = size.get(s, 0) + n
    order = sorted((s for s in size if s is not None)) + [None]
    weight, capped, total = {s: [3, 1, 2][k % 3] for k, s in enumerate(order)}, set(), 1.5 * sum(size.values())
    while True:
        rest = total - sum(2 * size[s] for s in capped)
        level = rest / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and level * weight[s] > 2 * size[s]}
        if not more:
            break
        capped |= more
    for s in order:
        mine = [r for r in got if r[1] == s]
        target = 2 * size[s] if s in capped else level * weight[s]
        assert {r[3] for r in mine} == {size[s]} and all(r[4] == pytest.approx(target) for r in mine)
        assert all(0 <= r[5] <= 2 for r in mine)
        assert abs(sum(r[2] * r[5] for r in mine) - target) <= 300
    assert len(got) == len(rows) and mixing.mix(units.limit(0)).collect() == []


def test_flight_keeps_sums():
    generator = random.Random(4)
    sizes = [float(generator.randint(1, 50)) for _ in range(200)]
    p = mixing.flight(sizes, [0.37] * 200, generator)
    assert sum(0 < x < 1 for x in p) <= 2
    assert sum(p) == pytest.approx(74) and sum(x * s for x, s in zip(p, sizes, strict=True)) == pytest.approx(0.37 * sum(sizes))
    assert set(mixing.landing(sizes, p)) <= {0.0, 1.0}


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components_by_hand(rows, n, share):
    label = list(range(len(rows)))
    sets = [shingles(t, n) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        least[x] = min(i, least.get(x, i))
    return sorted((i, len(s), least[x], i == least[x]) for (i, _), s, x in zip(rows, sets, label, strict=True))


def edited(text, generator, times):
    words = text.split()
    for _ in range(times):
        words[generator.randrange(len(words))] = f"new{generator.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_near_duplicates_match_brute_force(docs_of, prose, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 800)
        monkeypatch.setattr(neardup, "HOT_LIST", 8)
    generator = random.Random(6)
    base = [prose(150) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k, t in enumerate(base[:4]):
        rows += [(100 * k + 20 + j, edited(t, generator, 1 + j % 6)) for j in range(8)]
    passage = prose(60)
    rows += [(500 + i, passage + " " + prose(120)) for i in range(15)]
    rows += [(600, None), (601, " \n"), (602, "one"), (603, "ONE"), (604, "one two"), (605, base[2].upper()), (606, base[2])]
    rows += [(607, "w " * 20_000)]
    got = sorted(tuple(r) for r in neardup.near_duplicates(docs_of(rows), 3, (85, 100)).collect())
    assert got == components_by_hand(rows, 3, 85)


def test_near_duplicates_edges(docs_of, prose):
    assert neardup.near_duplicates(docs_of([])).collect() == []
    text = prose(50)
    got = [(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs_of([(5, text), (5, text), (7, text), (None, "x y")])).collect()]
    assert sorted(got, key=str) == sorted([(5, 5, True), (5, 5, True), (7, 5, False), (None, None, True)], key=str)


def test_components_match_brute_force(spark):
    generator = random.Random(8)
    edges = [(generator.randrange(300), generator.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(7, 7), (None, 3)] + [(1000, i) for i in range(600, 700)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    label = {x: x for e in edges if None not in e for x in e}
    for _ in range(len(label)):
        changed = False
        for a, b in edges:
            if a is not None and b is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
        if not changed:
            break
    assert got == label
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_pipeline_stages(spark):
    """Each decision of the pipeline on its own input, checked by hand, and the whole of it."""
    import corpus_pipeline as pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = pipeline.table(spark, sf_dir, "documents")
    frames, current = {}, docs
    for name, stage in pipeline.STAGES:
        frames[name] = (current, pipeline.saved(stage(spark, current, sf_dir), name))
        current = frames[name][1]
        if name != "sentencepiece":
            assert current.columns == docs.columns
    before, after = ({r.doc_id: r.text for r in f.collect()} for f in frames["toxicity"])
    scored = toxicity.score_documents(frames["toxicity"][0], pipeline.table(spark, sf_dir, "labels"))
    assert set(before) - set(after) == {r.doc_id for r in scored.where("score >= 0.7").collect()}
    before, after = ([(r.doc_id, r.text) for r in f.collect()] for f in frames["minhash_near_dedup"])
    assert sorted(i for i, _ in after) == [i for i, _, _, kept in components_by_hand(before, 5, 80) if kept]
    before, after = (f.count() for f in frames["source_mix"])
    assert frames["source_mix"][1].groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    assert frames["sentencepiece"][1].where("same_text").count() == frames["sentencepiece"][0].count() == after
