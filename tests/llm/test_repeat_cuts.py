"""Crowded anchors of the repeat removal."""

import hashlib
import random

from panelforge.llm import repeat_removal as R


def test_first_cut_makes_two_rows_of_a_context(spark, monkeypatch):
    """A phrase in many contexts is cut in two first; what is removed stays exact."""

    least, dice = 60, random.Random(5)

    def noise(n):
        return "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    phrase, before, after = noise(50), noise(40), noise(40)
    texts = [noise(30) + phrase + noise(30) for _ in range(30)]
    texts += [noise(25) + before + phrase + noise(9), noise(11) + before + phrase + after, noise(20) + phrase + after + noise(7)]
    monkeypatch.setattr(R, "MOST_CONTEXTS", 5)
    seen, land = [], R.land

    def counted(df, label):
        stored = land(df, label)
        seen.append((label, stored.count()))
        return stored

    monkeypatch.setattr(R, "land", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in R.remove_repeats(df, least=least).collect()}
    windows: dict[str, int] = {}
    for text in texts:
        for i in range(len(text) - least + 1):
            windows[text[i : i + least]] = windows.get(text[i : i + least], 0) + 1
    for i, text in enumerate(texts):
        gone = {k for j in range(len(text) - least + 1) if windows[text[j : j + least]] > 1 for k in range(j, j + least)}
        kept = "".join(c for k, c in enumerate(text) if k not in gone)
        assert (found[i].n_removed, found[i].kept_sha256) == (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    contexts = next(n for label, n in seen if label == "repeat-contexts")
    cut = [n for label, n in seen if label == "narrowed-contexts"]
    assert cut and 0 < cut[0] <= 2 * contexts


def test_no_round_makes_more_than_two_rows_of_a_context(spark, monkeypatch):
    """A phrase almost as long as a stretch stays crowded after the first cut; later cuts are in two as well."""

    least, dice = 60, random.Random(11)

    def noise(n):
        return "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    phrase, after = noise(59), noise(5)
    texts = [noise(30) + phrase + "0123456789"[i % 10] + noise(30) for i in range(20)]
    texts += [noise(40) + phrase + after + noise(30) for _ in range(10)]
    monkeypatch.setattr(R, "MOST_CONTEXTS", 5)
    seen, land = [], R.land

    def counted(df, label):
        stored = land(df, label)
        seen.append((label, stored.count()))
        return stored

    monkeypatch.setattr(R, "land", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in R.remove_repeats(df, least=least).collect()}
    windows: dict[str, int] = {}
    for text in texts:
        for i in range(len(text) - least + 1):
            windows[text[i : i + least]] = windows.get(text[i : i + least], 0) + 1
    for i, text in enumerate(texts):
        gone = {k for j in range(len(text) - least + 1) if windows[text[j : j + least]] > 1 for k in range(j, j + least)}
        kept = "".join(c for k, c in enumerate(text) if k not in gone)
        assert (found[i].n_removed, found[i].kept_sha256) == (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    contexts = [n for label, n in seen if label == "repeat-contexts"]
    cut = [n for label, n in seen if label == "narrowed-contexts"]
    assert len(cut) > 1 and all(0 < n <= 2 * held for n, held in zip(cut, contexts))
