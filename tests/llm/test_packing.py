import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnspark.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.word_bpe_path())


def ids(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


ODD = ["", "it's Ünïcode ﬁ é <|endoftext|> x", "Don't WE'LL İstanbul ß ẞ ſ ŉ", "日本語 12 ½ ²", "a\x1cb \xa0 c", "ſs 'S 'T x'sy", "é Å", "ab--cd!!..,, '' 'd'd", "ΣΑΣ ς", "1234 5a6", "naïve\nlines\r\n\tend", "ŉ ŀ Ľ"]


def test_tokens_equal_the_tokenizers(tokenizer, documents):
    texts = ODD + [r["text"] for r in documents.select("text").collect()]
    words = P.WordTokens(P.word_bpe_path())
    assert words.by_parts
    for _ in range(2):
        for t, got in zip(texts, words(texts)):
            assert got == ids(tokenizer, t).tobytes(), t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text(texts):
    words = P.word_tokens(P.word_bpe_path())
    for t, got in zip(texts, words(texts)):
        assert got == ids(words.tokenizer, t).tobytes()


def test_cache_is_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(P, "CACHE_WORDS", 50)
    words = P.WordTokens(P.word_bpe_path())
    for k in range(30):
        t = " ".join(f"{chr(97 + k % 26)}{chr(97 + i)}x" for i in range(20))
        assert words([t])[0] == ids(tokenizer, t).tobytes()
    assert len(words.known) < 120


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 30), max_size=20), st.sampled_from([0, 3, 500]))
def test_fillings(histogram, steps):
    fills = P.fillings(histogram, 64, steps, 4 * steps)
    used = Counter()
    for filling, times in fills:
        assert sum(filling) <= 64 and times > 0
        for k in filling:
            used[k] += times
    assert used == Counter({k: v for k, v in histogram.items() if v})


def least_bins(sizes, room):
    """Fewest bins, by trying everything."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= room:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_the_fewest(sizes):
    sizes = sorted(sizes, reverse=True)
    assert P.lower_bound(Counter(sizes), 20) <= least_bins(sizes, 20) == sum(t for _, t in P.fillings(Counter(sizes), 20))


def test_sequences_that_fit_exactly_are_found():
    """Sequences of three pieces that fill them, cut at random: one more is never needed, where a search within one sequence took one more."""
    assert sum(t for _, t in P.fillings(Counter([465, 695, 888, 471, 516, 1061, 782, 522, 744]))) == 3
    rng = np.random.default_rng(2)
    for n in (3, 4, 5, 6):
        for _ in range(20):
            cuts = np.sort(rng.integers(100, 1900, (n, 2)), axis=1)
            sizes = [int(x) for a, b in cuts for x in (a, b - a, 2048 - b) if x > 0]
            assert sum(t for _, t in P.fillings(Counter(sizes))) == n


def test_many_equal_pieces_and_few_steps():
    for histogram in ({2: 5000, 3: 5000, 2047: 3}, {1: 10**9, 700: 10**8 + 1, 1400: 5}, {1025: 10**7}, {3: 3000}):
        for steps in (0, 50, P.BRANCH_STEPS):
            used = Counter()
            for filling, times in P.fillings(histogram, branch_steps=steps):
                assert sum(filling) <= 2048
                for k, m in Counter(filling).items():
                    used[k] += m * times
            assert used == histogram


def verify(docs, tokenizer, capacity, rows=None):
    rows = rows or P.pack(docs, capacity=capacity).collect()
    want = Counter()
    for d in docs.select("doc_id", "text").collect():
        x = np.append(ids(tokenizer, d["text"]), np.uint32(0)).astype("<u4")
        for k, a in enumerate(range(0, len(x), capacity)):
            part = x[a : a + capacity]
            want[d["doc_id"], k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return rows, len(sequences)


def test_pack(documents, odd, hot, tokenizer):
    for docs, capacity in ((documents, 2048), (documents.repartition(5), 100), (odd, 2048), (hot, 512)):
        rows, n = verify(docs, tokenizer, capacity)
        bound = math.ceil(sum(r["length"] for r in rows) / capacity)
        alone = sum(r["length"] > capacity / 2 for r in rows)
        assert n <= max(bound, alone) * 1.02 + 1
    assert P.pack(odd.limit(0)).count() == 0


def test_query(spark, sf_dir, documents, tokenizer):
    """The query's rows against the tokenizer, and as few sequences as the tokens take."""
    rows, n = verify(documents, tokenizer, 2048, P.op5_packing(spark, sf_dir).withColumnRenamed("doc_id", "id").collect())
    assert n <= P.lower_bound(Counter(r["length"] for r in rows), 2048) + 1
