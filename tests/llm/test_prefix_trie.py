"""Conversation trie against a plain trie of tuples."""

import hashlib
import random
import zlib

import pytest

from panelforge.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_trie(rows):
    """The contract, word for word; turns that are equal must hold the same role and text."""

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(said.get(c - c % 100, [])[:h] + said[c][h:])
    members, ends = {}, {}
    for c, path in full.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = sum(saved[k] for k in below) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (
            min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(kids.get(path, [])), leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, m in members.items()
    )


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    result = prefix_trie.conversation_trie(table, **options)
    assert result.columns == list(FIELDS)
    return sorted(tuple(r) for r in result.collect())


def invented(seed, convs, longest, words="ab"):
    rnd = random.Random(seed)
    return [
        (c, t, rnd.choice(["user", "assistant"]), rnd.choice(words) * rnd.randrange(1, 3))
        for c in convs
        for t in range(rnd.randrange(1, longest + 1))
    ]


@pytest.mark.parametrize("bits", [None, 3])  # a tiny sketch proves nothing and changes nothing
def test_equals_the_plain_trie(spark, bits):
    rows = invented(1, [*range(0, 140), *range(300, 320), 777], 9)
    assert found(spark, rows, cell_bits=bits) == plain_trie(rows)


def test_conversations_longer_than_a_partition(spark):
    """Two long conversations that share their first half lie in many range partitions."""

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        half = [(t, "user", f"text {t}") for t in range(300)]
        rows = [(c, *r) for c in (100, 200) for r in half] + [(c, 300 + t, "user", f"{c} {t}") for c in (100, 200) for t in range(200)]
        rows += invented(2, [101, 102, 201, 250], 6)
        assert found(spark, rows) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_ties_repeats_and_long_text(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, 0, "user", "é" * 100_000), (2, 1, "", ""),
        (100, None, "", ""), (100, 1, None, "é" * 100_000), (101, 0, "", None), (101, 1, "", "é" * 100_000), (None, 0, "user", "lost"),
        (-7, 0, "user", "x"),
    ]
    expected = plain_trie([r for r in rows if r[0] != -7])
    assert found(spark, [r for r in rows if r[0] != -7]) == expected
    assert len(found(spark, rows)) >= len(expected)  # a negative id has its base towards zero
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "lost")]) == []


def test_copies_and_turnless_conversations(spark):
    """Many equal conversations end at one node; conversations whose own turns all go end at the root."""

    rows = [(c, t, "user", str(t)) for c in range(1000, 1400) for t in range(3)]
    rows += [(c, 0, "user", "only") for c in range(501, 560)]  # no conversation 500
    assert found(spark, rows) == plain_trie(rows)


def test_columns_with_clashing_names(spark):
    rows = invented(3, range(0, 30), 5)
    wide = [(*r, 1, "x", b"y") for r in rows]
    table = spark.createDataFrame(wide, f"{SCHEMA}, depth long, node string, parent binary")
    assert sorted(tuple(r) for r in prefix_trie.conversation_trie(table).collect()) == plain_trie(rows)


def test_query_on_the_smallest_table(spark):
    from panelforge.llm.queries import op11_conversation_prefix_trie

    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in op11_conversation_prefix_trie(spark, data).collect()) == plain_trie(rows)
