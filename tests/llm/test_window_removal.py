"""Removal of repeated word windows against brute force, and the index against plain matching statistics."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelforge.llm import window_removal
from panelforge.llm.wavelet_index import WaveletMatrix, WordIndex

SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def plain(rows, least):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    windows = Counter(tuple(w[i : i + least]) for w in words for i in range(len(w) - least + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {i + k for i in range(len(w) - least + 1) if windows[tuple(w[i : i + least])] > 1 for k in range(least)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    result = window_removal.remove_repeated_windows(spark.createDataFrame(rows, SCHEMA), **options)
    assert result.columns == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=str)


def words(rnd, n, size=5000):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def corpus(seed, texts=60):
    """Texts with shared passages of many lengths, copies, repeats inside a text and odd gaps."""

    rnd = random.Random(seed)
    passages = [words(rnd, n) for n in (20, 34, 35, 36, 50, 90)]
    rows = []
    for i in range(texts):
        text = words(rnd, rnd.randrange(0, 120))
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(0, 5)
            text[(k := rnd.randrange(len(text) + 1)) : k] = p[a : len(p) - rnd.randrange(0, 5)]
        rows.append((i, rnd.choice([" ", "  ", "\t", "\n"]).join(text)))
    inside = words(rnd, 45)
    rows.append((900, " ".join(inside + ["x"] + inside)))
    rows += [(901 + i, rows[3][1]) for i in range(4)]
    rows.append((950, " ".join(["same"] * 200)))
    return rows


def test_wavelet_ranks():
    rnd = np.random.default_rng(1)
    symbols = rnd.integers(0, 37, 1000)
    matrix = WaveletMatrix(symbols, 40)
    at = rnd.integers(0, 1001, 300)
    symbol = rnd.integers(0, 41, 300)
    assert matrix.ranks(symbol, at).tolist() == [int((symbols[:p] == s).sum()) for s, p in zip(symbol, at)]


@pytest.mark.parametrize("alphabet", [2, 4, 30])
def test_matching_statistics(alphabet):
    rnd, depth = random.Random(alphabet), 9
    texts = [[rnd.randrange(1, alphabet + 1) for _ in range(rnd.randrange(1, 20))] for _ in range(30)]
    weights = [rnd.choice([1, 1, 2]) for _ in texts]
    symbols = np.array([s for t in texts for s in (*t, 0)])
    ends = np.flatnonzero(symbols == 0)
    begins = np.append(0, ends[:-1] + 1)
    index = WordIndex(symbols, np.array(weights), max(map(len, texts)), depth)
    got = index.statistics(begins, ends)
    times = Counter()
    for t, w in zip(texts, weights):
        for i in range(len(t)):
            for n in range(1, min(depth, len(t) - i) + 1):
                times[tuple(t[i : i + n])] += w
    for t, b in zip(texts, begins.tolist()):
        for i in range(len(t)):
            best = max((n for n in range(1, min(depth, len(t) - i) + 1) if times[tuple(t[i : i + n])] > 1), default=0)
            assert got[b + i] == best


@pytest.mark.parametrize("most", [window_removal.MOST_SEGMENTS, 3])  # three segments an anchor: nearly all are cut
def test_equals_brute_force(spark, most):
    rows = corpus(7)
    assert found(spark, rows, most=most) == plain(rows, 35)
    assert found(spark, rows, least=20, most=most) == plain(rows, 20)


def test_one_passage_in_many_different_texts(spark):
    """Hot anchors: a passage that stands in many texts, each time beside other words; many range partitions."""

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rnd = random.Random(9)
        passage = words(rnd, 40)
        rows = [(i, " ".join(words(rnd, 30) + passage + words(rnd, 30))) for i in range(150)]
        rows += [(500 + i, " ".join(words(random.Random(i % 3), 80))) for i in range(60)]
        assert found(spark, rows, most=20) == plain(rows, 35)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_empty_long_and_repeated_rows(spark):
    rnd = random.Random(11)
    long = " ".join(words(rnd, 60_000, 10**6))
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n"), (4, "é " * 40), (4, "é " * 40), (5, "x" * 3_000_000), (6, long), (None, long[1000:9000])]
    assert found(spark, rows) == plain(rows, 35)
    assert found(spark, []) == []


def test_columns_with_clashing_names(spark):
    rows = corpus(13, 20)
    wide = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], f"{SCHEMA}, row long, begin int, words string")
    assert sorted((tuple(r) for r in window_removal.remove_repeated_windows(wide).collect()), key=str) == plain(rows, 35)


def test_long_words_and_texts_cut_into_pieces(monkeypatch):
    data = np.frombuffer(("ab " * 50 + "c" * 400 + " ab ab").encode(), dtype=np.uint8)
    begin, end, before = window_removal.word_bounds(data, np.array([0, len(data)]))
    whole = window_removal.word_hashes(data, begin, end)
    monkeypatch.setattr(window_removal, "HASH_BYTES", 16)
    assert (window_removal.word_hashes(data, begin, end) == whole).all()
    assert len(set(whole.tolist())) == 2 and before.tolist() == [0, 53]


def test_query_on_the_smallest_table(spark):
    from panelforge.llm.queries import op13_substring_dedup

    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op13_substring_dedup(spark, data).collect()), key=str) == plain(rows, 35)
