"""Periodic runs against a plain version, and on odd tables."""

import hashlib
import zlib

import numpy as np
import pytest
from conftest import rows
from llm.conftest import ODD_ROWS, SMALL

from lakelayers.llm import periodic_runs
from lakelayers.llm.periodic_runs import PRIMES, Transform, find_runs, squared_differences
from lakelayers.llm.queries import QUERIES

COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def plain_runs(words: list) -> list[tuple]:
    """Every stretch of every distance, smallest distance first."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def plain(doc_id, text) -> tuple:
    words = (text or "").encode().split()
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    left = hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, digest, left)


def drawn(seed: int, longest: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    n = int(draw.integers(0, longest))
    words = draw.integers(1, draw.integers(2, 5), n).astype(np.int64)
    if n > 8:
        a = int(draw.integers(0, n // 2))
        p = int(draw.integers(1, (n - a) // 3 + 1))
        place = np.arange(n)
        words = np.where(place >= a, words[np.minimum(a + (place - a) % p, n - 1)], words)
        words[draw.integers(0, n)] = 7
    return words


@pytest.mark.parametrize("anchor", [1, 2, 4, 4096])
def test_runs_equal_the_plain_ones(monkeypatch, anchor):
    monkeypatch.setattr(periodic_runs, "ANCHOR", anchor)
    for seed in range(400):
        words = drawn(seed, 150)
        assert find_runs(words) == plain_runs(words.tolist()), words.tolist()


def test_long_periods():
    draw = np.random.default_rng(0)
    base = draw.integers(1, 40_000, 9_000)
    words = np.concatenate([draw.integers(1, 40_000, 501), np.tile(base, 5), draw.integers(1, 40_000, 77)])
    start = 501 - int(words[500] == base[-1])
    [(s, length, q)] = [r for r in find_runs(words) if r[2] > 100]
    assert (s, q) == (start, 9_000) and length in range(45_000, 45_003)
    assert find_runs(np.ones(100_000, np.int64)) == [(0, 100_000, 1)]


@pytest.mark.parametrize("prime, root", PRIMES)
def test_transforms_are_exact(prime, root):
    draw = np.random.default_rng(2)
    for width in (1, 2, 8, 64):
        blocks, windows = draw.integers(0, 2**31, (5, width)), draw.integers(0, 2**31, (5, 2 * width))
        got = squared_differences(blocks, windows, Transform(2 * width, prime, root))
        for b, w, g in zip(blocks.tolist(), windows.tolist(), got.tolist()):
            assert g == [sum((x - y) ** 2 for x, y in zip(b, w[s:])) % prime for s in range(width)]


def test_the_given_table_equals_the_plain_version(spark, given):
    found = QUERIES["op13_periodic_runs"](spark, SMALL)
    want = [plain(r.doc_id, r.text) for r in given.collect()]
    assert rows(found, *COLUMNS) == sorted(want, key=repr)
    assert any(w[4] and w[4] > 8 for w in want)


def found_in(df) -> list:
    return rows(periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_repeated_tails(df))), *COLUMNS)


def test_odd_texts(spark, odd, none):
    assert found_in(odd) == sorted([plain(i, t) for i, t, _ in ODD_ROWS], key=repr)
    assert found_in(none) == []


def test_ties_and_repeated_rows(spark):
    texts = ["a a a a a a x b b b b b b", "a b a b a b a b c d c d c d c d", "a a a a a", "a a a a a a", "w " * 500, " x\x0by\tx y x\ny x y "]
    table = [(n % 40, t) for n, t in enumerate(texts * 14)]
    assert found_in(spark.createDataFrame(table, "doc_id long, text string").repartition(3)) == sorted([plain(*r) for r in table], key=repr)


def test_collapsed_texts_are_given(spark):
    [r] = periodic_runs.periodic_runs(spark.createDataFrame([(1, "go  on and on and on and on and on then")], "doc_id long, text string")).collect()
    assert [tuple(x) for x in r.runs] == [(1, 9, 2)] and r.collapsed == "go on and then" and r.n_words == 11
