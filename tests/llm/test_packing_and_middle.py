"""Best-fit packing and fill-in-the-middle against plain computations, on awkward rows and as registered queries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sleevework.llm import bestfit, fill_in_middle, tokens
from sleevework.llm.queries import QUERIES, TOKENIZER, WORD_TOKENIZER

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(n, T.StringType()) for n in ("form", "n", "piece", "length", "output", "low")])


def thue_morse(letters: int, first: str = "a", second: str = "b") -> str:
    return "".join(second if bin(i).count("1") % 2 else first for i in range(letters))


def rows() -> list[tuple]:
    draw = random.Random(8)
    words = ["ba", "Re", "ti,", "no's", "sé", "l'été", "x1y2", "--", "(ok)", "12", "don't", "“Q”", "ſs", "İ", "é", "ab|cd", "漢字", "𝔘"]
    prose = lambda n: "".join(draw.choice(words) + draw.choice((" ", " ", "\n", "  ", "\t", " ", ", ")) for _ in range(n))
    texts = [prose(n) for n in (1, 2, 7, 40, 300, 3000)] + [prose(60) for _ in range(40)]
    texts += [None, "", " ", "\n\n", "a", "é", "𝔘漢a", "x" * 30000, "see <P> there", "<S>", "ends <", "<M", "P> begins", "<|endoftext|> a <|startoftext|>b", "'s 't can't"]
    texts += [thue_morse(1024), thue_morse(1024, "b", "a"), "é" * 700]
    made = [(i, t) for i, t in enumerate(texts)]
    made += [(0, texts[0]), (0, texts[0]), (None, "no id"), (None, None), (3, "another text of a known id"), (-7, texts[4])]
    return [(i, t, "f", None, "p", "1", "", "x") for i, t in made]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("path, cuts", [(WORD_TOKENIZER, tokens.after_blanks), (TOKENIZER, tokens.before_plain_words)])
@pytest.mark.parametrize("cache", [400_000, 5])
def test_ids_are_those_of_the_tokenizer(monkeypatch, path, cuts, cache):
    monkeypatch.setattr(tokens, "CACHE_PIECES", cache)
    monkeypatch.setattr(tokens, "PIECES", 100 if cache == 5 else 1 << 18)
    texts = [t or "" for _, t, *_ in rows()]
    tokenizer, seen = Tokenizer.from_file(path), tokens.Tokens(path, cuts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        for low in range(0, len(texts), 9):
            ids, borders = seen.encode(pa.array(texts[low : low + 9]))
            assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == want[low : low + 9]
        assert len(seen._known) <= max(cache, 200)
    assert seen.encode(pa.array([], pa.string()))[1].tolist() == [0]


def pieces_of(texts: list[tuple], size: int) -> Counter:
    tokenizer, want = Tokenizer.from_file(WORD_TOKENIZER), Counter()
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for n, at in enumerate(range(0, len(ids), size)):
            want[doc, n, at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes()), len(ids)] += 1
    return want


def check_layout(out, size: int) -> int:
    places = defaultdict(list)
    for r in out:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        upto = 0
        for offset, length in sorted(parts):
            assert offset == upto
            upto += length
        assert upto <= size
    return len(places)


PIECE = ("doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens")


def test_best_fit(docs, empty):
    out = bestfit.best_fit(docs, WORD_TOKENIZER, 64, open_bins=4).collect()
    want = pieces_of([(d, t) for d, t, *_ in rows()], 64)
    assert Counter(tuple(r[c] for c in PIECE) for r in out) == want
    total = sum(r["length"] for r in out)
    assert check_layout(out, 64) <= 1.05 * total / 64 + 4
    nothing = bestfit.best_fit(empty, WORD_TOKENIZER, 64)
    assert nothing.count() == 0 and nothing.columns == [*PIECE, "sequence_id", "offset"]


def test_best_fit_over_many_tasks(docs, monkeypatch):
    monkeypatch.setattr(bestfit, "TASK_SEQUENCES", 40)
    out = bestfit.best_fit(docs, WORD_TOKENIZER, 64, open_bins=8).collect()
    assert Counter(tuple(r[c] for c in PIECE) for r in out) == pieces_of([(d, t) for d, t, *_ in rows()], 64)
    assert len({r["sequence_id"] >> 32 for r in out}) > 3
    check_layout(out, 64)


@pytest.mark.parametrize("most", [1, 3, 50])
def test_open_bins_follow_the_plain_rule(most):
    draw = random.Random(most)
    bins, plain, made = bestfit.OpenBins(100, most), {}, 0
    for length in [draw.choice((1, 5, 20, 37, 60, 99, 100)) for _ in range(3000)]:
        got, offset = bins.place(length)
        fits = [f for f in plain.values() if f >= length]
        if fits:
            assert plain[got] == min(fits)
        else:
            if len(plain) >= most and length < 100:
                fullest = min(plain.values())
                closed = next(b for b in plain if plain[b] == fullest and b not in {x for free in bins.by_space for x in free} - {got})
                del plain[closed]
            assert got == made
            made += 1
            plain[got] = 100
        assert offset == 100 - plain[got]
        plain[got] -= length
        if not plain[got]:
            del plain[got]
        assert len(plain) == bins.open <= most
        assert bins.bits == sum({1 << f for f in plain.values()})


def plain_middle(doc, text, seed=1, percent=90, first=20, marks=("<P>", "<S>", "<M>")):
    text, p, s, m = text or "", *marks
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(x in text for x in marks) or h[2] % 100 >= percent:
        return doc, len(text), "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < first else "psm"
    return doc, len(text), form, a, b - a, f"{s}{suf}{p}{pre}{m}{mid}" if form == "spm" else f"{p}{pre}{s}{suf}{m}{mid}"


@pytest.mark.parametrize("step", [1 << 19, 7])
def test_fill_in_middle(docs, empty, monkeypatch, step):
    monkeypatch.setattr(fill_in_middle, "STEP_BYTES", step)
    monkeypatch.setattr(fill_in_middle, "BATCH_BYTES", 1 << 14)
    made = fill_in_middle.fill_in_middle(docs)
    out = made.withColumn("again", fill_in_middle.restored(F.col("form"), F.col("output"))).collect()
    want = Counter(plain_middle(d, t) for d, t, *_ in rows())
    assert Counter(tuple(r)[:6] for r in out) == want
    assert Counter((r["doc_id"], r["again"]) for r in out) == Counter((d, t or "") for d, t, *_ in rows())
    assert {"plain", "psm", "spm"} == {r["form"] for r in out}
    assert fill_in_middle.fill_in_middle(empty).count() == 0


def test_fill_in_middle_with_other_marks_and_rates(docs):
    marks = fill_in_middle.Marks("[pre]", "[suf]", "[mid]")
    made = fill_in_middle.fill_in_middle(docs, seed=5, percent=100, suffix_first_percent=100, marks=marks)
    out = made.withColumn("again", fill_in_middle.restored(F.col("form"), F.col("output"), marks)).collect()
    assert Counter(tuple(r)[:6] for r in out) == Counter(plain_middle(d, t, 5, 100, 100, marks) for d, t, *_ in rows())
    assert Counter((r["doc_id"], r["again"]) for r in out) == Counter((d, t or "") for d, t, *_ in rows())
    for bad in (("aba", "c", "d"), ("ab", "bc", "d"), ("a", "a", "b"), ("xay", "a", "b"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fill_in_middle.fill_in_middle(docs, marks=fill_in_middle.Marks(*bad))


def test_registered_queries_on_a_written_fixture(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    texts = [(d, t) for d, t, *_ in rows()]
    out = QUERIES["op12_best_fit"](spark, str(tmp_path)).collect()
    assert Counter(tuple(r[c] for c in PIECE) for r in out) == pieces_of(texts, 4096)
    check_layout(out, 4096)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((*row[:5], sha(row[5]), sha(t or "")) for row, t in ((plain_middle(d, t), t) for d, t in texts))
    assert Counter(tuple(r) for r in QUERIES["op13_fill_in_middle"](spark, str(tmp_path)).collect()) == want
