"""Anchors whose contexts are dealt to several range partitions."""

import itertools
import random

import pyarrow as pa

from panelforge.llm import repeat_removal

NAMES = ("gram", "context", "row", "at", "before", "after")


def batch(places):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*places), kinds)], names=list(NAMES))


def requested(ranges):
    rows = set()
    for places in ranges:
        for out in repeat_removal._judge_places(200)(iter([batch(places)])):
            rows |= {r["row"] for r in out.to_pylist() if r["request"]}
    return rows


def test_every_context_of_a_cut_anchor_is_fetched():
    # Two contexts that occur twice in one range, the lone third in the next.
    places = [(6, 9, 9), (7, 1, 0), (7, 1, 1), (7, 2, 2), (7, 2, 3), (7, 3, 4)]
    places = [(*p, 300, 160, 200) for p in places]
    found = requested([places[:5], places[5:]])
    assert found & {0, 1} and found & {2, 3} and 4 in found


def test_any_cut_asks_for_what_one_range_asks_for():
    rnd = random.Random(3)
    for _ in range(60):
        places = [
            (g, c, next_row, 300, 160, 200)
            for next_row, (g, c) in enumerate(
                (g, c) for g in range(4) for c in range(rnd.randrange(1, 5)) for _ in range(rnd.randrange(1, 4))
            )
        ]
        context = {p[2]: p[:2] for p in places}
        whole = set()
        for g, group in itertools.groupby(places, key=lambda p: p[0]):
            copies = [len(list(same)) for _, same in itertools.groupby(list(group), key=lambda p: p[1])]
            if len(copies) > 1 and 1 in copies:
                whole |= {(g, c) for c in range(len(copies))}
        cuts = sorted(rnd.sample(range(1, len(places)), min(3, len(places) - 1)))
        ranges = [places[a:b] for a, b in zip([0, *cuts], [*cuts, len(places)])]
        assert whole <= {context[r] for r in requested(ranges)}
