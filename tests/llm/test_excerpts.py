"""Excerpts of benchmark items at any offset against an alignment of the whole item."""

import random

import numpy as np

from panelforge.llm import decontaminate

DATA = "/root/testdata/sf0.001"


def least_edits_of_windows(item, text, size):
    """Least edits of any ``size`` characters of ``item`` (or all, if it has fewer) inside ``text``."""

    best = size
    size = min(size, len(item))
    chars = np.array(list(text))
    for start in range(len(item) - size + 1):
        row = np.zeros(len(chars) + 1, int)
        for i, c in enumerate(item[start : start + size], 1):
            step = np.append(i, np.minimum(row[:-1] + (chars != c), row[1:] + 1))
            row = np.minimum.accumulate(step - np.arange(len(step))) + np.arange(len(step))
        best = min(best, int(row.min()))
    return best


def test_verbatim_excerpts_at_every_offset(spark):
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").limit(12).collect()]
    index = decontaminate.build_index(items)
    texts, owner = [], []
    for i, item in enumerate(items):
        for size in (75, 85, 100, 120):
            for start in range(0, len(item) - size + 1, 3):
                texts.append(f"0123456789 {item[start : start + size]} 9876543210")
                owner.append(i)
    found = decontaminate.matches(index, texts)
    pairs = set(zip(found["text"].tolist(), found["item"].tolist()))
    assert {(t, i) for t, i in enumerate(owner)} <= pairs


def test_edited_excerpts_against_the_whole_item(spark):
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").limit(3).collect()]
    items.append(items[0][:60])
    index = decontaminate.build_index(items)
    rnd, texts = random.Random(9), []
    for _ in range(30):
        item = rnd.choice(items)
        start = rnd.randrange(max(1, len(item) - 100))
        leaked = list(item[start : start + rnd.choice([60, 78, 90, 130])])
        for _ in range(rnd.randrange(12)):
            p = rnd.randrange(len(leaked))
            leaked[p] = rnd.choice(["", "x", leaked[p] + "y"])
        texts.append("some words before " + "".join(leaked) + " and after it")
    found = decontaminate.matches(index, texts)
    expected = {}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            size = min(len(item), decontaminate.WINDOW)
            least = least_edits_of_windows(item, decontaminate.normalise(text), size)
            if least <= min(int(decontaminate.EDIT_SHARE * size), size // decontaminate.Q - 1):
                expected[t, i] = least
    assert len(expected) > 5
    assert dict(zip(zip(found["text"].tolist(), found["item"].tolist()), found["edits"].tolist())) == expected
