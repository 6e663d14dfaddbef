"""Words and runs keep codes of their own, also where a sum of letters by place would not tell them apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sleevework.llm import backoff_lm, buckets, minhash_dedup, packing, substring_dedup, wordcodes
from sleevework.llm.queries import TOKENIZER


def thue_morse(letters: int, first: str, second: str) -> str:
    return "".join(second if bin(i).count("1") % 2 else first for i in range(letters))


def twins(letters: int) -> tuple[str, str]:
    return thue_morse(letters, "a", "b"), thue_morse(letters, "b", "a")


@pytest.mark.parametrize("letters", [1 << n for n in range(10, 14)])
def test_different_words_have_different_codes(letters):
    for seed in (1, 2):
        w = wordcodes.find_words(pa.array([" ".join(twins(letters)), "x " + twins(letters)[0]]))
        codes = wordcodes.piece_codes(w.data, w.starts, w.ends, seed)
        assert len(set(codes.tolist())) == 3 and codes[0] == codes[3]


def test_codes_do_not_depend_on_blocks(monkeypatch):
    w = wordcodes.find_words(pa.array(["a b  c a\n b", "", "c", "a"]))
    whole = wordcodes.piece_codes(w.data, w.starts, w.ends)
    monkeypatch.setattr(wordcodes, "PIECES", 2)
    assert np.array_equal(wordcodes.piece_codes(w.data, w.starts, w.ends), whole)
    assert len(set(whole.tolist())) == 3
    none = np.zeros(0, np.int64)
    assert len(wordcodes.piece_codes(w.data, none, none)) == 0


@pytest.fixture(scope="module")
def docs(spark):
    a, b = twins(2048)
    texts = [a, b, " ".join([a] * 20), " ".join([b] * 20), " ".join(f"w{i}" for i in range(30))]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_operators_tell_such_words_apart(docs):
    removed = {r["doc_id"]: r["n_removed"] for r in substring_dedup.repeated_words(docs, 20).collect()}
    assert removed == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0}
    assert {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs).collect()} == {i: i for i in range(5)}
    pieces = {r["doc_id"]: r["ids_crc32"] for r in packing.pack(docs.where("doc_id < 2"), TOKENIZER, 2048).collect()}
    assert len(set(pieces.values())) == 2
    known = {r["doc_id"]: r["n_known"] for r in backoff_lm.score_texts(docs, F.col("doc_id").isin(0, 2)).collect()}
    assert (known[0], known[1]) == (2, 1)


def test_an_automaton_takes_failure_arcs():
    model = backoff_lm.Automaton(3)
    model.add_states(np.zeros(2), np.array([-1.0, -2.0]))  # after label 0 and after label 1
    model.add_arcs(np.zeros(3), np.arange(3), np.array([-0.1, -0.2, -0.3]), np.array([1, 2, 0]))
    model.add_arcs(np.array([1]), np.array([1]), np.array([-0.05]), np.array([2]))
    model.close()
    words, first = np.array([0, 1, 2, 1, 1, 2, 0]), np.array([0, 3, 3, 7])
    want = [-0.1 - 0.05 + (-2.0 - 0.3), 0, -0.2 + (-2.0 - 0.2) + (-2.0 - 0.3) - 0.1]
    assert np.allclose(model.read(words, first), want)


def test_long_documents_are_read_in_stretches(monkeypatch):
    draw = np.random.default_rng(3)
    words, first = draw.integers(0, 5, 9000), np.array([0, 0, 7000, 7003, 9000])
    model = backoff_lm.Automaton(5)
    model.add_states(np.zeros(5), -draw.random(5))  # one for each label
    model.add_arcs(np.zeros(5), np.arange(5), -draw.random(5), np.arange(1, 6))
    seen = np.array([(a, b) for a in range(5) for b in range(5) if (a + b) % 3])
    model.add_arcs(seen[:, 0] + 1, seen[:, 1], -draw.random(len(seen)), seen[:, 1] + 1)
    model.close()
    steps, find = [], backoff_lm.Automaton._find
    monkeypatch.setattr(backoff_lm.Automaton, "_find", lambda self, keys: steps.append(1) or find(self, keys))
    whole, before = model.read(words, first), len(steps)
    for stretch in (1, 2, 100, 7000):
        assert np.allclose(model.read(words, first, 1, stretch), whole)
    del steps[:]
    assert np.allclose(model.read(words, first, 1), whole) and len(steps) < before / 5


def test_codes_of_pieces_of_all_lengths():
    pieces = sorted({bytes([x]) * n for n in range(1, 40) for x in (1, 97, 255)} | {b"a" * n + b"b" for n in range(40)} | {b"b" + b"a" * n for n in range(40)})
    data = np.frombuffer(b"".join(pieces) * 2, np.uint8)
    ends = np.cumsum([len(x) for x in pieces] * 2)
    codes = wordcodes.short_piece_codes(data, ends - [len(x) for x in pieces] * 2, ends)
    assert (codes[: len(pieces)] == codes[len(pieces) :]).all() and len(set(codes.tolist())) == len(pieces)


def test_one_large_count_does_not_widen_the_others():
    counts = np.ones(1000, np.int64)
    counts[[3, 70, 999]] = 254, 255, 2**40
    packed = buckets.pack_counts(counts)
    assert len(packed) == 1016 and (buckets.unpack_counts(packed, 1000) == counts).all()
