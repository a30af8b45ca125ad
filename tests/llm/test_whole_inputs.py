"""Nothing is left out: rare languages, short items, late lines, every segment, negative log-odds."""

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from panelforge.llm import byte_gru, decontaminate, language_id, license_scan, toxicity

DATA = "/root/testdata/sf0.001"


def test_seventy_languages_can_all_be_predicted(spark):
    rnd = random.Random(1)
    rows, number = [], 0
    for lang in range(70):
        letters = [chr(0x4E00 + 64 * lang + i) for i in range(12)]  # a byte of their own in each language
        for _ in range(40 if lang < 65 else 8):
            rows.append((number, "".join(rnd.choices(letters, k=60)), f"l{lang:02d}"))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_id.training_sample(docs, "doc_id", "text", "lang")
    assert {lang for lang, _ in sample} == {f"l{i:02d}" for i in range(70)}
    learnable = {text for i, text, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert {text for _, text in sample} <= learnable
    model = language_id.fit(sample)
    found = {r.doc_id: r.lang_pred for r in language_id.predict_languages(docs, model).collect()}
    rare = [i for i, _, lang in rows if lang >= "l65"]
    assert sum(found[i] == rows[i][2] for i in rare) >= 0.8 * len(rare)


def test_gradients_against_finite_differences():
    rnd = np.random.default_rng(4)
    n, labels = 3, ["a", "b"]
    model = byte_gru.ByteGru(
        labels, [rnd.normal(0, 0.5, (3 * n, 256)).astype(np.float32) for _ in (0, 1)],
        [rnd.normal(0, 0.5, (3 * n, n)).astype(np.float32) for _ in (0, 1)],
        [rnd.normal(0, 0.5, (2, n)).astype(np.float32) for _ in (0, 1)], np.zeros(2, np.float32),
    )
    chars, target = rnd.integers(0, 4, (6, 5)).astype(np.uint8), np.array([0, 1, 1, 0, 1])
    grads, _ = byte_gru._gradients(model, chars, target)
    for weight, grad in zip(byte_gru._weights(model), grads):
        places = [p for p in np.ndindex(weight.shape) if abs(grad[p]) > 1e-3]
        for p in places[:: max(1, len(places) // 12)]:
            kept = weight[p]
            losses = []
            for step in (0.02, -0.02):
                weight[p] = kept + np.float32(step)
                losses.append(byte_gru._gradients(model, chars, target)[1])
            weight[p] = kept
            assert abs((losses[0] - losses[1]) / 0.04 - grad[p]) < 0.02 * abs(grad[p]) + 2e-4


def test_short_items_match_verbatim_only():
    item, other = "quick brown fox", "a much longer item that is not quoted by any of these texts"
    index = decontaminate.build_index([item, other, "too short"])
    found = decontaminate.matches(index, ["The  Quick\nbrown FOX ran", "the quick brown fix ran", "quick brown fox", None, ""])
    assert list(zip(found["text"], found["item"], found["edits"])) == [(0, 0, 0), (2, 0, 0)]
    assert decontaminate.build_index([item], least_chars=16) is None


def test_three_blocks_give_the_rows_of_one(spark, monkeypatch):
    benchmark = spark.read.parquet(f"{DATA}/benchmark.parquet")
    items = [r.text for r in benchmark.collect()]
    docs = spark.createDataFrame(
        [(i, f"words before {items[i * 3 % len(items)] if i % 2 else 'nothing'} words after") for i in range(30)],
        "doc_id long, text string",
    )
    one = sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect()))
    clean = sorted(map(tuple, decontaminate.keep_clean(docs, benchmark).collect()))
    size = sum(len(decontaminate.normalise(t)) for t in items)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size // 3)
    assert len(list(decontaminate.item_blocks(benchmark, "item_id", "text"))) >= 3
    assert sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect())) == one != []
    assert sorted(map(tuple, decontaminate.keep_clean(docs, benchmark).collect())) == clean
    assert {r[0] for r in clean} == {r[0] for r in docs.collect()} - {r[0] for r in one}


def test_licence_sample_reaches_late_lines(spark):
    filler = "\n" * 5000
    docs = spark.createDataFrame(
        [(i, f"first {i}\n{filler}late line {i}\n{'x' * 5000}{i}") for i in range(40)], "doc_id long, text string"
    )
    lines = license_scan.ordinary_paragraphs(docs, "doc_id", "text")
    assert {f"late line {i}" for i in range(40)} <= set(lines)
    assert max(map(len, lines)) == license_scan.LINE_CHARS


def test_segments_with_negative_hits():
    rnd = random.Random(8)
    for _ in range(300):
        hits = sorted(rnd.sample(range(50), rnd.randrange(1, 20)))
        scored = [(i, rnd.uniform(-2.5, 4)) for i in hits]  # no ties
        values = np.full(50, -0.5)
        for i, s in scored:
            values[i] = s

        def plain(low, high):  # the best segment, then the same on both sides of it
            score, a, b = max(
                ((values[a : b + 1].sum(), a, b) for a in range(low, high) for b in range(a, high)), default=(0.0, 0, 0)
            )
            return plain(low, a) + [(round(float(score), 6), a, b)] + plain(b + 1, high) if score > 0 else []

        assert [(round(s, 6), a, b) for s, a, b in toxicity.segments(scored, gap=0.5)] == plain(0, 50)


def test_evidence_uses_every_segment():
    model = toxicity.ToxicityModel({}, rate=1.0, scale=0.01)
    few, many = ([5.0] * n for n in (12, 20))
    assert model.evidence(many, 1000) > model.evidence(few, 1000) > 0
    assert model.evidence([2.0] * 50, 40_000) == 0  # fewer than clean text of that length has
    for r in (1, 3, 20):  # never more than the exact Poisson tail allows where the sum's law is not used
        scores, size = [2.6] * r, 1000
        mean = model.scale * size * math.exp(-model.rate * 2.6)
        tail = sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(r, r + 60))
        assert model.evidence(scores, size) <= -math.log(tail) + 1e-6


def test_token_scores_have_both_signs(spark):
    counts = [("vile", 300, 3, 0.02), ("kind", 2, 500, 0.3), ("the", 400, 600, 0.9), ("rare", 1, 0, 0.001), ("once", 0, 1, 0.001)]
    rows = spark.createDataFrame(counts, "token string, y1 long, y0 long, share double")
    score = toxicity._token_score(F.col("y1"), F.col("y0"), F.col("share"), 400, 600)
    found = {r.token: r.score for r in rows.select("token", score.alias("score")).collect()}
    assert found["vile"] > 0 > found["kind"] and found["rare"] is None and found["once"] is None
    weight = toxicity.PRIOR_SHARE * 1000
    a, b = 300 + 0.02 * weight, 3 + 0.02 * weight
    assert abs(found["vile"] - (math.log(a / (400 + weight - a)) - math.log(b / (600 + weight - b)))) < 1e-9


def test_document_counts_over_small_steps(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOKENS_HELD", 2)
    docs = spark.createDataFrame([("a b a",), ("b C",), (None,), ("",), ("c d e f c",)], "text string")
    found = {r.token: r.n for r in toxicity._document_counts(docs, "text").collect()}
    assert found == {"a": 1, "b": 2, "c": 2, "d": 1, "e": 1, "f": 1}
