"""Scoring texts with a weighted backoff automaton of smoothed n-grams, learnt from the same corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.llm.buckets import bucketed, pack_counts, pack_sorted, unpack_counts, unpack_sorted
from sleevework.llm.wordcodes import LOWER, find_words, run_codes, short_piece_codes

BUCKET_BYTES = 12 << 20
PART_KEYS = 2 << 20  # n-grams of the input for each part, about
BYTES_PER_WORD = 5
ORDER = 3
SPARE_BITS = 6  # of the shortened codes, beyond those that tell the tokens of the input apart
PRIOR = 1.5  # weight of the failure arc, in observations of the state
ADD = 0.1  # of the base model
END = np.uint64(0x6A09E667F3BCC909)  # the code of the end of a document
STRETCH = 512  # tokens of a document that are read one after the other


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes in order, how often each occurs)."""
    ordered = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return ordered[first], np.diff(first, append=len(ordered))


def _ranked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct codes in order, a place of each among ``codes``, each code's place among the distinct)."""
    order = np.argsort(codes)
    ordered = codes[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)]
    rank = np.empty(len(codes), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], rank


class _Tokens:
    """The tokens of a table of documents as codes: lower-cased words, and an end after each document."""

    def __init__(self, table: pa.Table) -> None:
        w = find_words(table["text"])
        codes = short_piece_codes(LOWER[w.data], w.starts, w.ends)
        n_docs = len(w.first) - 1
        self.first = w.first + np.arange(n_docs + 1)  # of each document among the tokens
        self.codes = np.full(len(codes) + n_docs, END)
        is_word = np.ones(len(self.codes), bool)
        is_word[self.first[1:] - 1] = False
        self.codes[is_word] = codes
        self.place = (np.arange(len(self.codes)) - np.repeat(self.first[:-1], np.diff(self.first))).astype(np.int32)  # within the document

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(codes of the n-grams that end at each token, whether the document reaches back so far)."""
        if n == 1:
            return self.codes, np.ones(len(self.codes), bool)
        out = np.zeros(len(self.codes), np.uint64)
        out[n - 1 :] = run_codes(self.codes, n, n)
        return out, self.place >= n - 1


class Automaton:
    """States, weighted arcs and failure arcs of the histories that a bucket can meet; weights are log10.

    State 0 is the empty history; its arcs are added first, one for every token of the bucket in order. The histories
    of n words follow in the order of their codes. An arc of theirs is found by its state and label together in a
    hash table.
    """

    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, labels: int) -> None:
        self.labels = labels
        self.fail, self.fail_weight = [np.zeros(1, np.int32)], [np.zeros(1)]
        self.arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add_states(self, fail: np.ndarray, weight: np.ndarray) -> None:
        self.fail.append(fail.astype(np.int32))
        self.fail_weight.append(weight)

    def add_arcs(self, states: np.ndarray, labels: np.ndarray, weights: np.ndarray, targets: np.ndarray) -> None:
        self.arcs.append((states.astype(np.int64) * self.labels + labels, weights, targets.astype(np.int32)))

    def close(self) -> None:
        self.fail, self.fail_weight = np.concatenate(self.fail), np.concatenate(self.fail_weight)
        self.keys, self.weight, self.target = (np.concatenate([a[i] for a in self.arcs]) for i in range(3))
        del self.arcs
        bits = max(1, (2 * (len(self.keys) - self.labels) - 1).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.table = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(self.labels, len(self.keys)), self._slots(self.keys[self.labels :])
        while len(left):  # each arc takes the first free slot from its own on
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            lost = self.table[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.SPREAD) >> self.shift).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each arc, -1 where there is none."""
        out, left, slot = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._slots(keys)
        while len(left):
            at = self.table[slot]
            hit = (at >= 0) & (self.keys[at] == keys[left])
            out[left[hit]] = at[hit]
            on = (at >= 0) & ~hit
            left, slot = left[on], (slot[on] + 1) & self.last
        return out

    def read(self, words: np.ndarray, first: np.ndarray, history: int | None = None, stretch: int = STRETCH) -> np.ndarray:
        """The weight of each document: all documents are read from left to right in step, each with its own state.

        Where the last ``history`` tokens tell the state whatever came before them, a document longer than ``stretch``
        is read in several stretches at once, each led up to by the ``history`` tokens ahead of it, whose weights
        belong to the stretch before.
        """
        lengths = np.diff(first)
        if history is None or not len(lengths):
            of, begins, leads = np.arange(len(lengths)), first[:-1], np.zeros(len(lengths), bool)
        else:
            stretch = max(stretch, history + 1)
            n = np.maximum(1, -(-lengths // stretch))
            of = np.repeat(np.arange(len(lengths)), n)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            leads = nth > 0
            begins, lengths = first[of] + stretch * nth - history * leads, np.minimum(stretch, lengths[of] - stretch * nth) + history * leads
        order = np.argsort(-lengths, kind="stable")
        of, begins, leads, ascending = of[order], begins[order], leads[order], lengths[order][::-1]
        state, total = np.zeros(len(of), np.int64), np.zeros(len(of))
        for step in range(int(lengths.max(initial=0))):
            if step == history:
                total[leads] = 0
            active = len(of) - int(np.searchsorted(ascending, step, "right"))
            label = words[begins[:active] + step]
            left = np.arange(active)
            while len(left):
                here, label_here = state[left], label[left]
                at = np.where(here == 0, label_here, -1)
                among = np.flatnonzero(here)
                at[among] = self._find(here[among] * self.labels + label_here[among])
                there = at >= 0
                gone = left[there]
                total[gone] += self.weight[at[there]]
                state[gone] = self.target[at[there]]
                left = left[~there]  # these take the failure arc and look again
                total[left] += self.fail_weight[state[left]]
                state[left] = self.fail[state[left]]
        return np.bincount(of, total, len(first) - 1)


def score_texts(docs: DataFrame, learn: Column, order: int = ORDER, prior: float = PRIOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Tokens are the words with A-Z in lower case, then one end for each document; null texts are empty. ``learn``
    selects the documents that are counted (NULL: not counted). ``base_score`` is the unigram model with ``ADD``
    observations of every known token and of one unknown; ``n_known`` counts tokens that were seen in training.
    ``score`` is the log10 probability of the text under the automaton. Repeated rows count as often as they
    occur; rows may have null ids. Without training documents every token has probability 1. An empty table
    gives no rows; extra columns are not read.

    The states of the automaton are the histories seen in training, up to ``order`` - 1 words; a state h has an
    arc for each token seen after it, of weight (c(hw) + prior * p(w | shorter h)) / (c(h) + prior), and a
    failure arc of weight prior / (c(h) + prior) to the state of the shorter history. The weights of a state add
    up to one. Reading a token follows its arc, or failure arcs until one is found; the state reached is the
    longest known history. Every bucket of documents gets the counts of the n-grams its own texts can meet, from
    all training documents, builds the part of the automaton that these make up, and reads its texts with it; no
    task holds the whole model. Rows are dealt to buckets by id and text, so rows without an id are no one bucket.

    1. Every bucket names its n-grams of two and more words by codes cut to a few bits more than the input needs,
       and learns which of them another bucket has too. An n-gram that only one bucket has is counted there.
    2. The others, and all words, are sent with their whole codes and counts; what comes back are the sums.
    """
    learnt = F.coalesce(learn, F.lit(False)).alias("learnt")
    rows, total = bucketed(docs, BUCKET_BYTES, id_col, text_col, learnt, by_text=True)
    parts = max(1, total // (BYTES_PER_WORD * PART_KEYS))
    cut = np.uint64(max(0, 64 - SPARE_BITS - (total // BYTES_PER_WORD).bit_length()))

    step = (2**64 - 1) // parts + 1
    limits = np.array([p * step for p in range(1, parts)], np.uint64)  # where the keys of each part but the first begin

    def counted(table: pa.Table, tokens: _Tokens) -> np.ndarray:
        return np.repeat(table["learnt"].to_numpy(), np.diff(tokens.first))

    def table_of(out: list[tuple], *binaries: str) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * len(binaries)]
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], ["part", "bucket", *binaries])

    def probe(table: pa.Table) -> pa.Table:
        """The shortened codes of a bucket."""
        tokens, out, bucket = _Tokens(table), [], table["bucket"][0].as_py()
        for n in range(2, order + 1):
            grams, whole = tokens.grams(n)
            distinct = np.sort(grams[whole])
            for part, k in enumerate(np.split(distinct, np.searchsorted(distinct, limits))):
                short = k >> cut
                out.append((n * parts + part, bucket, pack_sorted(short[np.concatenate([[True], short[1:] != short[:-1]])[: len(short)]])))
        return table_of(out, "short")

    def find_shared(table: pa.Table) -> pa.Table:
        """One bit for each shortened code of a bucket: whether another bucket has it too."""
        short = [unpack_sorted(x) for x in table["short"].to_pylist()]
        codes = np.concatenate(short)
        order = np.argsort(codes)
        again = np.diff(codes[order], prepend=np.uint64(0)) == 0  # as the code before; a bucket names each of its codes once
        again[:1] = False
        several = np.zeros(len(codes), bool)
        several[order] = again | np.append(again[1:], False)[: len(codes)]
        shared = np.split(several, np.cumsum([len(s) for s in short])[:-1])
        return pa.table([table["part"], table["bucket"], pa.array([np.packbits(s).tobytes() for s in shared], pa.binary())], ["part", "bucket", "shared"])

    def send(table: pa.Table, probed: pa.Table) -> pa.Table:
        """The n-grams that may be in other buckets, with their counts here, and which of all n-grams they are."""
        if not table.num_rows:
            return table_of([], "grams", "counts", "which")
        tokens, out, bucket = _Tokens(table), [], table["bucket"][0].as_py()
        told = dict(zip(probed["part"].to_pylist(), probed["shared"].to_pylist()))
        left_out = ~counted(table, tokens)
        for n in range(1, order + 1):
            grams, whole = tokens.grams(n)
            distinct, counts = _runs(grams[whole])
            others, without = _runs(grams[whole & left_out])
            counts[np.searchsorted(distinct, others)] -= without
            borders = np.searchsorted(distinct, limits)
            for part, (k, c) in enumerate(zip(np.split(distinct, borders), np.split(counts, borders))):
                which = np.ones(len(k), bool)
                if n > 1 and len(k):
                    short = k >> cut
                    at = np.cumsum(np.concatenate([[False], short[1:] != short[:-1]]))
                    which = np.unpackbits(np.frombuffer(told[n * parts + part], np.uint8))[at].astype(bool)
                out.append((n * parts + part, bucket, pack_sorted(k[which]), pack_counts(c[which]), np.packbits(which).tobytes()))
        return table_of(out, "grams", "counts", "which")

    def merge(table: pa.Table) -> pa.Table:
        """Each bucket's n-grams with their counts in all buckets, and the sums over the n-grams of this part."""
        grams = [unpack_sorted(x) for x in table["grams"].to_pylist()]
        counts = [unpack_counts(x, len(g)) for x, g in zip(table["counts"].to_pylist(), grams)]
        distinct, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
        answers = [pack_counts(x) for x in np.split(sums[inverse], np.cumsum([len(g) for g in grams])[:-1])]
        n = table.num_rows
        return pa.table([table["part"], table["bucket"], pa.array(answers, pa.binary()), table["which"], pa.array([int(sums.sum())] * n), pa.array([int((sums > 0).sum())] * n)], ["part", "bucket", "counts", "which", "total", "distinct"])

    def look_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("learnt", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if not table.num_rows:
            return schema.empty_table()
        tokens = _Tokens(table)
        told = sorted(zip(*(answers[c].to_pylist() for c in ("part", "counts", "total", "distinct", "which"))))
        seen, kinds = sum(t[2] for t in told if t[0] // parts == 1), sum(t[3] for t in told if t[0] // parts == 1)
        sums, learnt_tokens = lambda x: np.add.reduceat(x, tokens.first[:-1]), counted(table, tokens)
        history, history_counts, history_chance, first_state = np.zeros(len(tokens.codes), np.int32), np.array([0]), None, 0
        for n in range(1, order + 1):
            grams, whole = tokens.grams(n)
            ends = np.flatnonzero(whole)
            distinct, at, rank = _ranked(grams[ends])
            at = ends[at]  # a token where each n-gram ends
            place = np.zeros(len(grams), np.int32)
            place[ends] = rank
            sizes = np.diff(np.concatenate([[0], np.searchsorted(distinct, limits), [len(distinct)]]))
            counts = np.bincount(rank[learnt_tokens[ends]], minlength=len(distinct))
            del grams, whole, ends, rank
            mine = [(c, np.unpackbits(np.frombuffer(w, np.uint8), count=size).astype(bool)) for (_, c, _, _, w), size in zip([t for t in told if t[0] // parts == n], sizes)]
            counts[np.concatenate([which for _, which in mine])] = np.concatenate([unpack_counts(c, int(which.sum())) for c, which in mine])
            if n == 1:
                words, model = place, Automaton(len(distinct))
                chance = (counts + ADD) / (seen + ADD * (kinds + 1))
                n_known, base = sums((counts > 0)[place].astype(np.int64)), sums(np.log10(chance)[place])
                arcs = np.ones(len(distinct), bool)
                states = np.zeros(len(distinct), np.int64)
            else:
                before = history[at - 1]
                arcs = counts > 0
                chance = (counts + prior * history_chance[history[at]]) / (history_counts[before] + prior)
                states = first_state + before
            # n-grams that were seen are states of their own, unless they have all the words that a history may have
            next_state = 1 if n == 1 else first_state + len(history_counts)
            if n < order:
                target = np.where(counts > 0, next_state + np.arange(len(distinct)), 0)
                fail = np.zeros(len(distinct)) if n == 1 else first_state + history[at]
                model.add_states(fail, np.log10(prior / (counts + prior)))
            else:
                target = np.zeros(len(distinct)) if n == 1 else first_state + history[at]
            model.add_arcs(states[arcs], words[at[arcs]], np.log10(chance[arcs]), target[arcs])
            history, history_counts, history_chance, first_state = place, counts, chance, next_state
            del distinct, place, at, mine, target, states, arcs
        del history, history_counts, history_chance, chance, counts, told
        model.close()
        n_docs = table.num_rows
        score = model.read(words, tokens.first, order - 1)
        return pa.table([table["doc_id"], table["learnt"], pa.array(np.diff(tokens.first)), pa.array(n_known), pa.array([seen] * n_docs, pa.int64()), pa.array(base), pa.array(score)], schema=schema)

    probes = rows.groupBy("bucket").applyInArrow(probe, "part long, bucket long, short binary")
    probed = probes.groupBy("part").applyInArrow(find_shared, "part long, bucket long, shared binary")
    sent = rows.groupBy("bucket").cogroup(probed.groupBy("bucket")).applyInArrow(send, "part long, bucket long, grams binary, counts binary, which binary")
    merged = sent.groupBy("part").applyInArrow(merge, "part long, bucket long, counts binary, which binary, total long, distinct long")
    return rows.groupBy("bucket").cogroup(merged.groupBy("bucket")).applyInArrow(look_up, "doc_id long, learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
