"""Slices of batches, and hashes of words."""

import numpy as np
import pyarrow as pa
import pytest

from lakelayers.llm import wordhash, worker
from lakelayers.llm.pieces import SEGMENT


def test_batches_come_in_slices(monkeypatch):
    released = []
    monkeypatch.setattr(worker, "release", lambda: released.append(1))
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], names=["n"]) for n in (600, 0, 3)]
    seen = [b.num_rows for b in worker.frugal(lambda found: found)(iter(batches))]
    assert seen == [256, 256, 88, 3] and released == [1]


def test_memory_is_given_back_after_a_failure(monkeypatch):
    released = []
    monkeypatch.setattr(worker, "release", lambda: released.append(1))

    def fails(batches):
        yield next(batches)
        raise ValueError("no more")

    with pytest.raises(ValueError):
        list(worker.frugal(fails)(iter([pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["n"])])))
    assert released == [1]


def test_a_word_has_one_hash_wherever_it_stands(texts):
    seen = {}
    for text, hashed in zip(texts.values(), wordhash.hashes_of_texts(texts.values())):
        words = (text or "").encode().lower().split()
        assert np.array_equal(hashed, wordhash.word_hashes(text)) and len(words) == len(hashed)
        for word, value in zip(words, hashed.tolist()):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_long_words_and_texts():
    long = "ab" * SEGMENT + "c"
    alone = wordhash.word_hashes(long)
    found = wordhash.word_hashes(f"x {long}\ty\n{long}d")
    assert found[1] == alone[0] and len(set(found.tolist())) == 4
    many = " ".join(f"w{n}" for n in range(400_000))
    pieces = np.concatenate([wordhash.word_hashes(f"w{n}") for n in range(0, 400_000, 1000)])
    assert len(many) > SEGMENT and np.array_equal(wordhash.word_hashes(many)[::1000], pieces)
    assert [len(h) for h in wordhash.hashes_of_texts([None, "", " ", many, "a b", long])] == [0, 0, 0, 400_000, 2, 1]
    with np.errstate(over="ignore"):
        for word in (b"x", b"seven77", b"z" * 5000):
            assert wordhash._words(word)[0][0] == wordhash.mix(np.array([wordhash._number(word)], np.uint64) + np.uint64(len(word)) * wordhash._STEP)[0]


def test_short_words_do_not_collide():
    letters = np.arange(97, 123, dtype=np.uint8)
    grid = np.stack(np.meshgrid(letters, letters, letters, letters, indexing="ij"), -1).reshape(-1, 4)
    text = b" ".join(bytes(g) for g in grid).decode()
    found = wordhash.word_hashes(text)
    assert len(found) == 26**4 == len(set(found.tolist()))
