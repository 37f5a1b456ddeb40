"""Near duplicates of texts and vectors, shared passages, and components, against brute force."""

import itertools
import random
import tracemalloc

import numpy as np
import pytest
from conftest import rows
from llm.conftest import prose

from lakelayers.llm import chaining, minhash, vector_blocks
from lakelayers.llm.common import components
from lakelayers.llm.wordhash import run_hashes, shingles, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    out, word = [], ""
    for c in (text or "").translate(LOWER) + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def shingle_set(text, k):
    words = words_of(text)
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def united(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_groups(texts, k, part, whole):
    sets = {d: shingle_set(t, k) for d, t in texts.items()}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and whole * len(sets[a] & sets[b]) >= part * len(sets[a] | sets[b])
    ]
    return {d: (len(sets[d]), c) for d, c in united(sets, links).items()}


def changed(text, places, seed):
    words, draw = text.split(), random.Random(seed)
    for i in draw.sample(range(len(words)), places):
        words[i] = f"new{draw.random()}"
    return " ".join(words)


# --- components --------------------------------------------------------------------


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1400)]
    links = [*chain, *star, (5000, 4000), (4000, 3000), (7, 7)]
    got = dict(rows(components(spark.createDataFrame(links, "a bigint, b bigint"))))
    want = united({n for pair in links for n in pair}, links)
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# --- MinHash -----------------------------------------------------------------------


def test_shingles_are_those_of_the_words(texts):
    for text in [*list(texts.values())[:50], "", None, "One", "a B", "a\x85b\xa0c ÀB"]:
        for k in (3, 5):
            assert len(shingles(text, k)) == len(shingle_set(text, k))
    assert word_hashes("Ab ÀB").tolist() == word_hashes("aB  ÀB\n").tolist() != word_hashes("ab àb").tolist()
    assert run_hashes(word_hashes("a b c d"), 3).tolist()[1:] == run_hashes(word_hashes("b c d"), 3).tolist()


@pytest.mark.parametrize("k, threshold", [(3, (85, 100)), (5, (80, 100))])
def test_given_documents(given, texts, k, threshold):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(given, k, threshold).collect()}
    assert got == near_groups(texts, k, *threshold)


def test_a_group_around_the_threshold(spark):
    """Links, misses and single documents in the same buckets; blocks of a few nodes."""
    base = prose(5, 150)
    texts = {i: changed(base, 1 + i % 14, i) for i in range(120)} | {500 + i: prose(50 + i, 40) for i in range(20)}
    want = near_groups(texts, 3, 85, 100)
    sizes = sorted(sum(1 for _, c in want.values() if c == d) for d in {c for _, c in want.values()})
    assert sizes[-1] > 20 and sizes.count(1) > 30
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for nodes in (minhash.BLOCK_NODES, 25):
        minhash.BLOCK_NODES, before = nodes, minhash.BLOCK_NODES
        try:
            got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, 3, (85, 100)).collect()}
        finally:
            minhash.BLOCK_NODES = before
        assert got == want


def test_steps_keep_pairs_at_the_threshold():
    size = minhash.BAND_ROWS * minhash.bands_for((85, 100))
    draw = np.random.default_rng(1)
    kept = np.ones(20_000, bool)
    hits = draw.random((20_000, size)) < 0.85
    for n, least in minhash.least_matches((85, 100), size):
        kept &= hits[:, :n].sum(axis=1) >= least
    assert kept.all()
    low = draw.random((20_000, size)) < 0.3
    n, least = minhash.least_matches((85, 100), size)[2]
    assert (low[:, :n].sum(axis=1) >= least).mean() < 0.01


def test_odd_documents(odd, none):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert got[1, 76] == got[1, 76] and got[2, 76] == (1, False) and got[3, 76] == (1, False)
    assert got[4, 0] == (4, True) and got[9, 1] == (9, True) and got[8, 1] == (8, True)
    assert got[None, 56] == (None, True) and got[None, 0] == (None, True)
    kept = minhash.distinct_documents(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 4, 5, 6, 7, 8, 9, 10, 11, 12, None}
    assert minhash.near_duplicates(none).collect() == [] and minhash.distinct_documents(none).collect() == []


# --- vectors -----------------------------------------------------------------------


def vector_links(data, cosine=0.98):
    good = {}
    for v, e, label in data:
        if e and label is not None and all(x is not None and np.isfinite(x) for x in e) and any(e):
            x = np.array(e, np.float64)
            x /= np.abs(x).max()
            good[v] = (label, x / np.linalg.norm(x))
    links = [(a, b) for a, b in itertools.combinations(good, 2) if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= cosine]
    count = {v: sum(v in pair for pair in links) for v, _, _ in data}
    return {v: (count[v], c, v == c) for v, c in united(count, links).items()}


@pytest.mark.parametrize("size, block, cuts", [(64, 8, (0.0,)), (10, 4, (-0.5, 0.0, 0.5)), (3, 8, (0.0,))])
def test_vectors(spark, size, block, cuts):
    draw = np.random.default_rng(size)
    base = draw.standard_normal((60, size))
    data, noise = [], 0.13 / np.sqrt(size)
    for i in range(400):
        e = base[i % 60] / np.linalg.norm(base[i % 60]) + noise * (1 + i % 3) * draw.standard_normal(size)
        data.append((i, [float(x) for x in np.float32(e * (i % 5 + 1))], i % 60 % 3))
    data += [(400 + i, data[0][1], 0) for i in range(5)]
    data += [(500, None, 1), (501, [], 1), (502, [0.0] * size, 1), (503, [float("nan")] * size, 1), (504, [1.0, None] + [0.0] * (size - 2), 1),
             (505, data[1][1], None), (506, data[1][1] + [0.0], 1), (507, [float("inf")] + [0.0] * (size - 1), 1), (508, [1e30 * x for x in data[1][1]], 1)]
    want = vector_links(data)
    assert 50 < sum(n for n, _, _ in want.values())
    df = spark.createDataFrame([(*d, "x") for d in data], "vec_id bigint, embedding array<float>, label int, node string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_blocks.near_vectors(df, block=block, cuts=cuts).collect()}
    assert got == want


def test_no_vectors_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, None, None)], "vec_id bigint, embedding array<float>, label int")
    got = sorted((tuple(r)[:4] for r in vector_blocks.near_vectors(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=repr)
    assert vector_blocks.near_vectors(df.limit(0)).collect() == []


# --- shared passages ------------------------------------------------------------------


def test_chains_maximise_gain_less_gaps():
    def best(px, py, gain=10.0, cost=0.1):
        points, top = sorted(zip(px, py)), 0.0
        score = []
        for i, (x, y) in enumerate(points):
            before = [score[j] - cost * (x - a + y - b) for j, (a, b) in enumerate(points[:i]) if a < x and b < y]
            score.append(gain + max([0.0, *before]))
        return max(score)

    draw = random.Random(4)
    for n in (1, 2, 10, 60):
        for _ in range(20):
            px, py = np.array([draw.randrange(200) for _ in range(n)]), np.array([draw.randrange(200) for _ in range(n)])
            found = chaining.chains(px, py)
            assert found[0][0] == pytest.approx(best(px, py))
            used = [i for _, path in found for i in path]
            assert sorted(used) == list(range(n))
            assert all(px[a] < px[b] and py[a] < py[b] for _, path in found for a, b in zip(path, path[1:]))


def test_edits():
    def plain(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            before, row[0] = row[0], i
            for j, b in enumerate(y, 1):
                before, row[j] = row[j], min(before + (a != b), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    draw = random.Random(2)
    for _ in range(60):
        x = [draw.randrange(9) for _ in range(draw.randrange(40))]
        y = [v for v in x if draw.random() > 0.1]
        for _ in range(draw.randrange(5)):
            y.insert(draw.randrange(len(y) + 1), draw.randrange(9))
        assert chaining.edits(np.array(x, np.int32), np.array(y, np.int32), 16) == plain(x, y)


def test_every_run_of_words_shares_a_seed():
    words = word_hashes(prose(9, 400))
    length = chaining.SEED_WORDS + chaining.WINDOW - 1
    whole = set(chaining.winnow(words)[1].tolist())
    for start in range(0, 400 - length):
        assert whole & set(chaining.winnow(words[start : start + length])[1].tolist())


def test_planted_passages(spark):
    passage, fuzzy = prose(7, 70), prose(8, 120)
    docs = {i: f"{prose(100 + i, 60)} {passage} {prose(200 + i, 60)}" for i in range(30)}
    docs |= {40 + i: f"{prose(300 + i, 30)} {changed(fuzzy, 6, i)} {prose(400 + i, 90)}" for i in range(6)}
    docs |= {60 + i: prose(500 + i, 200) for i in range(40)}
    docs |= {200: prose(900, 20_000) + " " + passage, 201: prose(901, 49), 202: prose(901, 49)}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    for width in ("1", "40"):  # all seeds in one task, and split within one seed
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            found = chaining.shared_passages(df).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert {r.doc_id for r in found} == {*range(30), *range(40, 46), 200}
        for r in found:
            mine, other = words_of(docs[r.doc_id]), words_of(docs[r.other_id])
            if r.edits == 0:
                assert mine[r.start_word : r.end_word] == other[r.other_start : r.other_end]
            assert r.end_word - r.start_word >= 50 and r.identity >= 0.8
            if r.doc_id < 30:
                assert mine[r.start_word : r.end_word] == words_of(passage)
        assert any(r.edits > 0 for r in found if 40 <= r.doc_id < 46)
        assert len(found) < 4 * 37  # not all pairs


def test_given_passages(given, texts):
    held = {}
    for d, t in texts.items():
        words = words_of(t)
        for i in range(len(words) - 49):
            held.setdefault(tuple(words[i : i + 50]), set()).add(d)
    must = {d for ds in held.values() if len(ds) > 1 for d in ds}
    got = {r.doc_id for r in chaining.shared_passages(given).select("doc_id").collect()}
    assert must <= got and len(got - must) <= 0.2 * len(must) + 2


def test_odd_passages(odd, none):
    got = {(r.doc_id, r.other_id) for r in chaining.shared_passages(odd).collect()}
    assert {d for pair in got for d in pair} == {1, 2, 3}
    assert chaining.shared_passages(none).collect() == []


@pytest.mark.parametrize("length, between", [(60, 40), (60, 80), (60, 150), (60, 250), (100, 400), (300, 250)])
def test_two_passages_with_other_words_between(spark, length, between):
    docs = {}
    for n in range(3):
        for side in (0, 1):
            text = " ".join([prose(1000 * n + 1, length), prose(1000 * n + 10 + side, between), prose(1000 * n + 2, length)])
            docs[2 * n + side] = f"{prose(1000 * n + 20 + side, 30)} {text} {prose(1000 * n + 30 + side, 30)}"
    found = chaining.shared_passages(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    assert all(r.identity >= 0.8 for r in found)
    for d in docs:
        spans = sorted((r.start_word, r.end_word) for r in found if r.doc_id == d)
        for start in (30, 30 + length + between):
            assert any(a <= start + 3 and b >= start + length - 3 for a, b in spans), (d, start, spans)


def test_edits_of_long_runs_take_little_memory():
    x = np.arange(60_000, dtype=np.int32)
    cut = np.concatenate([x[:25_000], x[35_000:]])
    other = np.arange(100_000, 160_000, dtype=np.int32)
    tracemalloc.start()
    try:
        assert chaining.edits(x, cut, 16, 12_000) == 10_000
        assert chaining.edits(x, cut, 16, 9_999) == 10_000
        assert chaining.edits(x, other[:2_000], 16, 12_000) == 12_001
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()


def test_edits_up_to_a_limit():
    draw = random.Random(5)
    for _ in range(300):
        x = np.array([draw.randrange(4) for _ in range(draw.randrange(30))], np.int32)
        y = np.array([draw.randrange(4) for _ in range(draw.randrange(30))], np.int32)
        whole = chaining.edits(x, y, 60)
        for most in (0, 3, 10, 40):
            assert chaining.edits(x, y, 60, most) == min(whole, most + 1)


def test_texts_of_a_passage_meet_among_texts_of_its_parts(spark):
    docs, whole, number = {}, {}, 0
    for group, others in enumerate((5, 20, 100)):
        for _ in range(4):
            passage = prose(50_000 + number, 60).split()
            parts = [passage, passage] + [passage[:40]] * others + [passage[-40:]] * others
            for part in parts:
                number += 1
                docs[number] = f"{prose(60_000 + number, 20)} {' '.join(part)} {prose(70_000 + number, 20)}"
                if part is passage:
                    whole[number] = (20, 80)
    keys = list(docs)
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k, docs[k]) for k in keys], "doc_id bigint, text string")
    found = chaining.shared_passages(df).collect()
    assert {r.doc_id for r in found} == whole.keys()
    for r in found:
        assert r.start_word <= 20 and r.end_word >= 80


def test_shared_runs_leave_out_what_two_hold():
    words = word_hashes(prose(31, 200))
    picked, _ = chaining.winnow(words)
    at, hashes = chaining.shared_runs(words, picked, 50)
    assert at.tolist() == list(range(151)) and (hashes == run_hashes(words, 50)).all()
    assert not len(chaining.shared_runs(words, picked[:0], 50)[0])
    middle = int(picked[len(picked) // 2])
    kept = chaining.shared_runs(words, picked[picked != middle], 50)[0].tolist()
    inner, outer = chaining.WINDOW - 1, 50 - chaining.SEED_WORDS - chaining.WINDOW + 1
    assert kept == [p for p in range(151) if not p + inner <= middle <= p + outer]


def test_passages_with_edits_near_their_ends_and_on_far_diagonals(spark):
    short, long, new = prose(81, 52).split(), prose(82, 300).split(), prose(83, 20).split()
    other = [*short[:10], "changed", *short[11:]]
    moved = [*long[:40], *new, *long[40:240], *long[260:]]
    bodies = {1: short, 2: other, 3: long, 4: moved}
    docs = {i: f"{prose(840 + i, 30)} {' '.join(body)} {prose(850 + i, 30)}" for i, body in bodies.items()}
    found = chaining.shared_passages(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    got = {(r.doc_id, r.other_id): r for r in found}
    assert got.keys() == {(1, 2), (2, 1), (3, 4), (4, 3)}
    assert (got[1, 2].start_word, got[1, 2].end_word, got[1, 2].edits) == (30, 82, 1)
    assert (got[3, 4].start_word, got[3, 4].end_word, got[3, 4].edits) == (30, 330, 40)


def edited_copy(draw, passage, share):
    """The words of a passage with a share of them replaced, at random places."""
    out = passage.copy()
    at = draw.choice(len(out), round(len(out) * share), replace=False)
    out[at] = draw.integers(1, 1 << 60, len(at)).astype(np.uint64)
    return out


@pytest.mark.parametrize("identity, least", [(1.0, 1.0), (0.95, 0.98), (0.9, 0.97), (0.85, 0.95), (0.8, 0.85)])
def test_recall_of_pairs(identity, least):
    """Of 200 pairs of texts that share 120 words at an identity, those for which a passage comes out."""
    found = 0
    for seed in range(200):
        draw = np.random.default_rng(seed)
        some = lambda n: draw.integers(1, 1 << 60, n).astype(np.uint64)
        passage = some(120)
        texts = [np.concatenate([some(150), words, some(90)]) for words in (passage, edited_copy(draw, passage, 1 - identity))]
        places = [dict(zip(*(a.tolist() for a in reversed(chaining.winnow(t))))) for t in texts]
        shared = [h for h in places[0] if h in places[1]]
        if not shared:
            continue
        px, py = chaining.thinned(*(np.array([p[h] for h in shared]) for p in places))
        x, y = ((t >> np.uint64(33)).astype(np.int32) for t in texts)
        found += any(
            chaining._passages(x, y, px[path].tolist(), py[path].tolist(), chaining.MIN_WORDS, chaining.IDENTITY)
            for _, path in chaining.chains(px, py)
        )
    print(f"identity {identity}: {found} of 200 pairs")
    assert found >= least * 200


@pytest.mark.parametrize("holders, share, least", [(2, 0.1, 0.9), (5, 0.05, 0.95), (20, 0.05, 0.95)])
def test_recall_with_more_holders(spark, holders, share, least):
    """Texts that hold an edited copy of a passage of 120 words: how many of them come out."""
    draw, docs = np.random.default_rng(holders), []
    groups = 120 // holders
    for g in range(groups):
        passage = np.array([f"w{x}" for x in draw.integers(0, 1 << 40, 120)], dtype=object)
        for _ in range(holders):
            words = passage.copy()
            at = draw.choice(120, round(120 * share), replace=False)
            words[at] = [f"e{x}" for x in draw.integers(0, 1 << 40, len(at))]
            docs.append((len(docs), " ".join([prose(1000 + len(docs), 40), *words, prose(5000 + len(docs), 30)])))
    found = chaining.shared_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    told = {r.doc_id for r in found if r.doc_id // holders == r.other_id // holders}
    print(f"{holders} holders, {share:.0%} edited in each: {len(told)} of {len(docs)} texts")
    assert len(told) >= least * len(docs)


def test_repeated_rows_and_copies_cost_a_row_each(spark):
    one = prose(77, 120)
    two = " ".join(one.split()[:100]) + " " + prose(78, 40)
    rows_ = [(1, one)] * 40 + [(2, two)] * 40 + [(n, one) for n in range(10, 50)]
    found = chaining.shared_passages(spark.createDataFrame(rows_, "doc_id bigint, text string").repartition(4)).collect()
    pairs = {(r.doc_id, r.other_id) for r in found}
    assert len(found) == len(pairs) == 2 + 2 * 40
    assert {(1, 2), (2, 1)} | {(n, 1) for n in range(10, 50)} | {(1, n) for n in range(10, 50)} == pairs
    whole = [r for r in found if r.doc_id == 10]
    assert (whole[0].start_word, whole[0].end_word, whole[0].edits) == (0, 120, 0)


@pytest.mark.parametrize("holders, share", [(5, 0.04), (12, 0.04)])
def test_all_pairs_of_edited_copies_come_out(spark, holders, share):
    draw, docs = np.random.default_rng(holders), []
    passage = np.array([f"w{x}" for x in draw.integers(0, 1 << 40, 120)], dtype=object)
    for n in range(holders):
        words = passage.copy()
        at = draw.choice(np.arange(2, 118), round(120 * share), replace=False)
        words[at] = [f"e{x}" for x in draw.integers(0, 1 << 40, len(at))]
        docs.append((n, " ".join([prose(1000 + n, 40), *words, prose(5000 + n, 30)])))
    found = chaining.shared_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    # What is no row is in a class of equal words, by way of rows.
    assert {r.component_id for r in found} == {0} and {r.doc_id for r in found} == set(range(holders))
    pairs = {(r.doc_id, r.other_id) for r in found}
    assert len(pairs) > 2 * 2 * (holders - 1)  # more than each with the next
    for a, b in itertools.combinations(range(holders), 2):
        x, y = words_of(docs[a][1]), words_of(docs[b][1])
        runs = {tuple(x[i : i + 50]) for i in range(len(x) - 49)} & {tuple(y[i : i + 50]) for i in range(len(y) - 49)}
        assert (a, b) in pairs or runs


def test_pairs_to_connect():
    pairs = np.array([(0, 1), (1, 2), (0, 2), (3, 4), (0, 3)])
    assert chaining.connecting(pairs, 5, lambda a, b: True).tolist() == [[0, 1], [1, 2], [3, 4], [0, 3]]
    assert chaining.connecting(pairs, 5, lambda a, b: a != 1).tolist() == [[0, 1], [1, 2], [0, 2], [3, 4], [0, 3]]
    assert chaining.connecting(pairs, 5, lambda a, b: None).tolist() == []


def test_sketches_count_words_in_common():
    draw = np.random.default_rng(4)
    one = draw.integers(0, 1 << 16, 94).astype(np.uint16)
    two = np.concatenate([one[:30], draw.integers(0, 1 << 16, 64).astype(np.uint16)])
    again = np.repeat(one[:1], 94)
    near = chaining.similar(*[chaining.sketches([one, two, again])] * 2, 25)
    assert near.tolist() == [[True, True, False], [True, True, False], [False, False, True]]


def test_phrases_that_texts_share_by_chance_are_not_aligned(spark, monkeypatch):
    phrase, kept = prose(91, 7), {}
    docs = [(n, f"{prose(9100 + n, 80)} {phrase if n < 2 else prose(92, 7)} {prose(9200 + n, 80)}") for n in range(5)]
    plain = chaining.written

    def spied(df, label):
        kept[label] = plain(df, label)
        return kept[label]

    monkeypatch.setattr(chaining, "written", spied)
    assert chaining.shared_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect() == []
    assert kept["chains"].count() == 0


def test_extensions_of_many_are_those_of_each():
    draw = np.random.default_rng(3)
    for words in (4, 50, 1 << 20):
        one = draw.integers(0, words, (200, 64)).astype(np.int32)
        two = np.where(draw.random(one.shape) < 0.1, draw.integers(0, words, one.shape), one).astype(np.int32)
        two[::2, 9:] = two[::2, 8:-1].copy()
        got = np.stack(chaining.extensions(one, two, 0.8)[:3], axis=1).tolist()
        assert [tuple(g) for g in got] == [chaining._extended(a, b, 0.8) for a, b in zip(one, two)]


def test_extensions_stop_at_the_end_of_a_row():
    one = np.arange(1, 45, dtype=np.int32)[None]
    for filler in range(-9, 0):
        two = np.where(one <= 40, one, filler).astype(np.int32)
        for pair in ((one, two), (two, one)):
            got = np.stack(chaining.extensions(*pair, 0.8)[:3], axis=1).tolist()
            assert got == [[40, 40, 0]]


def test_seeds_of_texts_together_are_those_of_each():
    draw = np.random.default_rng(6)
    texts = [draw.integers(1, words, n).astype(np.uint64) for words in (2, 3, 1 << 40) for n in (0, 5, 6, 12, 13, 14, 15, 300, 70_000, 40)]
    for one, two in zip(chaining.winnowed(texts), map(chaining.winnow, texts), strict=True):
        assert all(a.tolist() == b.tolist() and a.dtype == b.dtype for a, b in zip(one, two))


def test_kinds_of_runs_of_one_word():
    some = np.random.default_rng(7).integers(100, 1 << 40, 400)
    whole, broken, sparse = [1] * 60, [2] * 30 + [3] * 4 + [2] * 30, [4] * 40 + [5] * 25 + [4] * 40
    words = np.concatenate([some[:50], whole, some[50:200], broken, some[200:], sparse, [2] * 60]).astype(np.uint64)
    [(picked, hashes)] = chaining.seeds_of([words], 44)
    told = {}
    for at, kind in zip(picked.tolist(), chaining.kinds(words, picked, 50, 0.8).tolist()):
        run = set(words[at : at + chaining.SEED_WORDS].tolist())
        told.setdefault(run.pop() if len(run) == 1 else 0, set()).add(kind)
    assert told == {0: {chaining.OTHER}, 1: {chaining.WHOLE}, 2: {chaining.BROKEN}, 4: {chaining.SPARSE}, 5: {chaining.SPARSE}}
    # Beside a run every seed with another word is kept.
    assert set(range(50 - 44, 50)) | set(range(105, 110)) <= set(picked.tolist())
    assert (hashes == run_hashes(words, chaining.SEED_WORDS)[picked]).all()


def test_texts_with_a_run_of_one_word_do_not_all_meet(spark, monkeypatch):
    draw, docs, kept = random.Random(5), {}, {}
    for n in range(200):  # a run of 30 to 49 words or of more, among other runs
        run = draw.randrange(30, 50) if n % 2 else draw.randrange(50, 90)
        docs[n] = " ".join([f"a{n}"] * 30 + ["the"] * run + [f"b{n}"] * 40)
    docs[300] = " ".join([prose(300, 20), *["the"] * 30, "edit", *["the"] * 30, prose(301, 20)])
    docs[301] = " ".join([prose(302, 20), *["the"] * 20, "other", *["the"] * 40, prose(303, 20)])
    for n in (400, 401):  # short runs that are a passage with the words beside them
        docs[n] = " ".join([prose(n, 20), *["the"] * 30, prose(310, 30), prose(n + 10, 20)])
    plain = chaining.written

    def spied(df, label):
        kept[label] = plain(df, label)
        return kept[label]

    monkeypatch.setattr(chaining, "written", spied)
    found = chaining.shared_passages(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    # Three places of each run as it was compared before, and all with all.
    assert kept["chains"].count() < 8 * len(docs)
    assert {r.doc_id for r in found} == {*range(0, 200, 2), 300, 301, 400, 401}
    assert {r.component_id for r in found if r.doc_id < 400} == {0}
    assert {(r.doc_id, r.other_id) for r in found if r.doc_id >= 400} == {(400, 401), (401, 400)}
    for r in found:
        if r.doc_id < 200:
            assert words_of(docs[r.doc_id])[r.start_word : r.end_word] == ["the"] * (r.end_word - r.start_word)
    for n in range(0, 200, 2):  # all of each run is covered
        covered = {p for r in found if r.doc_id == n for p in range(r.start_word, r.end_word)}
        longest = max(len(words_of(docs[m])) - 70 for m in range(0, 200, 2) if m != n)
        assert len(covered) >= min(len(words_of(docs[n])) - 70, longest)
