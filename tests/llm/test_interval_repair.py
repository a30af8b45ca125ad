"""Conversation repair against a shortest-path version and against all edits of short conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from panelforge.llm import interval_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = r"\x20\x09-\x0D"


def every_edit(symbols, extra=2):
    """Least (cost, audit) over all audits with up to ``extra`` insertions in each gap; for very short input."""

    best = None
    for gaps in itertools.product(range(extra + 1), repeat=len(symbols) + 1):
        for edits in itertools.product("KRD", repeat=len(symbols)):
            for aims in itertools.product("ua", repeat=sum(gaps) + edits.count("R")):
                aim, cost, audit, roles, bad = iter(aims), 0, "", "", False
                for i, inserted in enumerate(gaps):
                    roles += "".join(next(aim) for _ in range(inserted))
                    audit += "I" * inserted
                    cost += 5 * inserted
                    if i < len(symbols):
                        edit, symbol = edits[i], symbols[i]
                        bad |= edit != "D" and symbol == "x"
                        roles += {"K": symbol.lower(), "R": next(aim) if edit == "R" else "", "D": ""}[edit]
                        cost += {"K": 0, "R": 1, "D": 2}[edit] + (5 if edit != "D" and symbol.isupper() else 0)
                        audit += edit
                if not bad and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def shortest(symbols):
    """Least (cost, audit) by a plain left-to-right search over the states of the pattern."""

    def relax(states):
        changed = True
        while changed:
            changed = False
            for state, (cost, audit) in list(states.items()):
                for role in "ua":
                    to = step(state, role)
                    if to is not None and (cost + 5, audit + "I") < states.get(to, (10**18, "")):
                        states[to], changed = (cost + 5, audit + "I"), True
        return states

    def step(state, role):  # empty, after s, after u, after a
        return {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, role))

    states = relax({"e": (0, "")})
    for symbol in symbols:
        found = {}

        def offer(to, cost, audit):
            if to is not None and (cost, audit) < found.get(to, (10**18, "")):
                found[to] = (cost, audit)

        for state, (cost, audit) in states.items():
            offer(state, cost + 2, audit + "D")
            if symbol != "x":
                extra = 5 if symbol.isupper() else 0
                offer(step(state, symbol.lower()), cost + extra, audit + "K")
                for role in "ua":
                    offer(step(state, role), cost + extra + 1, audit + "R")
        states = relax(found)
    return min(states[s] for s in ("e", "a") if s in states) if symbols else (0, "")


def plain(rows):
    """The contract on a list of rows; rows of one turn must be equal."""

    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, symbols, counts = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in own:
            solid = re.findall(f"[^{SPACE}]", text)
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not solid:
                counts["b"], symbol = counts["b"] + 1, "x"
            elif (role, text) in seen:
                counts["d"], symbol = counts["d"] + 1, "x"
            elif solid[-1] not in ".!?":
                counts["t"], symbol = counts["t"] + 1, symbol.upper()
            seen.add((role, text))
            symbols += symbol
        cost, audit = shortest(symbols)
        turns = [t for t, _, _ in own if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        lines, due, at = [], "user", 0
        for edit in audit:
            if edit == "I":
                role, text = due, ""
            else:
                _, role, text = own[at]
                at += 1
                role = due if edit == "R" else role
                if edit == "D":
                    continue
            lines.append(f"{role}:{text}")
            due = "assistant" if role[:1] == "u" else "user"
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["b"], counts["d"], counts["t"], illegal,
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(table):
    result = repair.damaged_and_repaired(table)
    assert result.columns == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=str)


def test_short_conversations_against_all_edits():
    for length in (1, 2):
        for symbols in itertools.product("suaoSUAOx", repeat=length):
            best = every_edit(symbols)
            assert shortest(symbols) == best
            assert repair.repair_of(repair.parse([repair.leaf(s) for s in symbols])) == best, symbols
    rnd = random.Random(4)
    for _ in range(8):
        symbols = [rnd.choice("suaoSUAOx") for _ in range(3)]
        assert repair.repair_of(repair.parse([repair.leaf(s) for s in symbols])) == every_edit(symbols, 1), symbols


def test_one_table_and_blocks_give_the_same():
    rnd = random.Random(5)
    for length in (3, 5, 8, 9, 17, 24, 70, 200):
        for _ in range(20 if length < 30 else 3):
            symbols = "".join(rnd.choice("suaouaUAx") for _ in range(length))
            spans = repair.Spans()
            for low in range(0, length, 3):
                spans.add(symbols[low : low + 3])
            assert repair.repair_of(spans.cell()) == shortest(symbols), symbols
            if length <= 24:
                assert repair.repair_of(repair.parse([repair.leaf(s) for s in symbols])) == shortest(symbols)


def invented(seed, convs, longest):
    rnd = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", ""], ["Yes.", "No!", "and so", "", " \t", "Well? \n", "more."]
    return [(c, t, rnd.choice(roles), rnd.choice(texts) + rnd.choice(["", "", f" {rnd.randrange(9)}."])) for c in convs
            for t in rnd.sample(range(longest * 2), rnd.randrange(1, longest + 1))]


def test_equals_the_plain_version(spark):
    rows = invented(1, range(200), 9)
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_conversation_over_many_partitions(spark, many_partitions):
    rows = invented(2, [5], 900) + invented(3, [4, 6], 3)
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_nulls_repeats_long_text_and_dropped_conversations(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hm."), (1, None, "user", "Hm."), (1, 3, None, "Yes."), (1, 4, "user", None),
        (2, 7, "user", "é" * 200_000 + "."), (2, 8, "assistant", "a. " * 50_000), (3, 1, "user", "x"), (3, 1, "user", "x"), (3, 1, "user", "x"),
        (9, None, "user", "Hm."), (9, None, "user", "Hm."),
    ]
    dropped = next(c for c in range(100, 900) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    expected = plain(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in expected
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_columns_with_clashing_names(spark):
    rows = invented(6, range(20), 5)
    wide = spark.createDataFrame([(*r, "x", 1, 2, b"z") for r in rows], f"{SCHEMA}, conv string, copies int, part long, digest binary")
    assert found(wide) == plain(rows)


def test_query_on_the_smallest_table(spark):
    from panelforge.llm.queries import op12_conversation_repair

    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op12_conversation_repair(spark, data).collect()), key=str) == plain(rows)
