"""Columns out of many small XML documents at once, by array operations over their bytes.

Only documents of plain build are read here: elements whose tags carry no attributes (the
root may), text in elements without children, the predefined entities, and an XML declaration.
Every one of them is checked to be well-formed, tag by tag. Comments, CDATA, document types,
numeric references, mixed content, repeated fields, malformed documents and whatever else is
not plain are named to the caller, who gives them to a full parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from panelforge.functions.numbers import WHITE_SPACE

# Bytes of text that one step works on, bytes of a document beyond which it is
# left to the full parser, deepest level of a plain document, longest tag.
STEP_BYTES = 1 << 20
PLAIN_BYTES = 1 << 22
LEVELS = 16
TAG_BYTES = 1000

OPEN, CLOSE, EMPTY, DECLARATION, ODD = range(5)
# What an element is, if it is none of the fields (their number is not negative).
OTHER, RECORD, GROUP = -1, -2, -10  # group g is GROUP - g

_PART, _SPACE = rb"[A-Za-z_][A-Za-z0-9_.-]*", rb"[ \t\n]*"
_NAME = rb"(?:(" + _PART + rb"):)?(" + _PART + rb")"
_VALUE = _SPACE + rb"=" + _SPACE + rb"(\"[^<&\"]*\"|'[^<&']*')"
_CLOSES = re.compile(rb"</" + _NAME + _SPACE + rb">")
_ATTRIBUTES = re.compile(_NAME + _VALUE)
_OPENS = re.compile(rb"<" + _NAME + rb"((?:[ \t\n]+(?:" + _PART + rb":)?" + _PART + _VALUE.replace(rb"(", rb"(?:") + rb")*)" + _SPACE + rb"(/?)>")
_DECLARES = re.compile(rb"<\?xml version=\"1\.0\"(?: encoding=\"(?:utf|UTF)-8\")?(?: standalone=\"(?:yes|no)\")?[ \t\n]*\?>")
_ENTITIES = ((b"lt;", "&lt;", "<"), (b"gt;", "&gt;", ">"), (b"quot;", "&quot;", '"'), (b"apos;", "&apos;", "'"), (b"amp;", "&amp;", "&"))
# Bytes that white space of any kind, also beyond ASCII, begins or ends with.
_EDGE = np.array([i <= 32 or i >= 128 for i in range(256)])


class Layout:
    """The wanted fields: ``record`` is the element of a record below the root, a field a pair of group (or None) and element."""

    def __init__(self, record: str, fields: Sequence[tuple[str | None, str]]):
        self.fields = list(fields)
        self.groups = list(dict.fromkeys(g for g, _ in fields if g is not None))
        self.elements = list(dict.fromkeys(e for _, e in fields))
        self.roles = {record.encode(): RECORD}
        self.roles |= {g.encode(): GROUP - i for i, g in enumerate(self.groups)}
        self.roles |= {e.encode(): i for i, e in enumerate(self.elements)}
        self.folded = {name.lower() for name in self.roles}


def _tag(text: bytes, layout: Layout) -> tuple[int, bytes, bytes | None, int, frozenset[bytes] | None]:
    """Kind, qualified name, prefix, role and, for a tag with attributes, the prefixes that it declares."""

    none = (ODD, b"", None, OTHER, None)
    if len(text) > TAG_BYTES:
        return none
    if found := _CLOSES.fullmatch(text):
        kind, declared = CLOSE, None
    elif found := _OPENS.fullmatch(text):
        kind, declared = (EMPTY if found[4] else OPEN), None
        if found[3]:
            declared = _declared(found[3])
            if declared is None:
                return none
    else:
        return (DECLARATION, b"", None, OTHER, None) if _DECLARES.fullmatch(text) else none
    prefix, name = found[1], found[2]
    role = layout.roles.get(name, OTHER)
    if (role == OTHER and name.lower() in layout.folded) or (prefix or b"").lower().startswith(b"xml"):
        return none  # whether case counts is for the full parser, which knows the session's settings
    return kind, (prefix + b":" if prefix else b"") + name, prefix, role, declared


def _declared(attributes: bytes) -> frozenset[bytes] | None:
    """Prefixes that these attributes declare; None if they need a full parser."""

    found = _ATTRIBUTES.findall(attributes)
    spaces = [name for prefix, name, _ in found if prefix == b"xmlns"]
    others = [(prefix, name) for prefix, name, _ in found if prefix != b"xmlns"]
    if len(set(spaces)) < len(spaces) or len({name for _, name in others}) < len(others):
        return None
    if any(name.lower().startswith(b"xml") for name in spaces) or any(prefix == b"xmlns" and len(value) < 3 for prefix, _, value in found):
        return None
    if any(prefix and prefix not in spaces for prefix, _ in others):
        return None
    return frozenset(spaces)


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes."""

    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    low = 0
    while low < len(column):
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high
        low = high


def read_plain(xml: pa.Array, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]:
    """Records of the plain documents among ``xml``: row numbers of the other documents, then for each
    record its document's row and its position in the document, then a column of text per field.

    A field that a record lacks is an empty text. Fields of a group are read from the record
    itself where it has no such group. Null documents have no records.
    """

    rows = np.flatnonzero(pc.is_valid(xml).to_numpy(zero_copy_only=False))
    if len(rows) < len(xml):
        xml = xml.take(pa.array(rows))
    others = [np.empty(0, np.int64)]
    while len(rows):
        odd, found = _read(xml, layout)
        if found is not None:
            document, position, columns = found
            return np.concatenate(others), rows[document], position, columns
        others.append(rows[odd])
        rows, xml = rows[~odd], xml.filter(pa.array(~odd))
    return np.concatenate(others), np.empty(0, np.int64), np.empty(0, np.int32), [pa.array([], pa.string())] * len(layout.fields)


def _bytes(xml: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of the documents and their bounds, from 0."""

    wide = pa.types.is_large_string(xml.type)
    _, offsets, data = xml.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[xml.offset : xml.offset + len(xml) + 1]
    if data is None:
        data = pa.py_buffer(b"")
    return data.slice(int(bounds[0]), int(bounds[-1] - bounds[0])), bounds - bounds[0]


def _read(xml: pa.Array, layout: Layout):
    """A mask of documents that are not plain, or, if there are none, the records."""

    data, bounds = _bytes(xml)
    b = np.frombuffer(data, np.uint8)
    odd = np.zeros(len(xml), bool)

    def of_bytes(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, places, "right") - 1

    # Characters, lengths and entities.
    lengths = np.diff(bounds)
    odd |= (lengths == 0) | (lengths > PLAIN_BYTES)
    if odd.any():
        return odd, None
    odd |= b[bounds[:-1]] != ord("<")
    low = b < 32
    if low.any():
        low &= (b != 10) & (b != 9)
        odd[of_bytes(np.flatnonzero(low))] = True
    if b.max() >= 128:
        for i in np.unique(of_bytes(np.flatnonzero(b >= 128))):
            try:
                text = data[int(bounds[i]) : int(bounds[i + 1])].to_pybytes().decode()
                odd[i] |= "\ufffe" in text or "\uffff" in text
            except UnicodeDecodeError:
                odd[i] = True
    marks = b == ord("<")
    marks |= b == ord(">")
    marks |= b == ord("&")
    marks = np.flatnonzero(marks)
    mark = b[marks]
    references = marks[mark == ord("&")]
    entities = []
    if len(references):
        known = np.zeros(len(references), bool)
        for name, escaped, plain in _ENTITIES:
            here = np.ones(len(references), bool)
            for k, c in enumerate(name, 1):
                here &= b[np.minimum(references + k, len(b) - 1)] == c
            if here.any():
                entities.append((escaped, plain))
            known |= here
        odd[of_bytes(references[~known])] = True

    # Tags: brackets that take turns. As every document begins with one, none reaches into the next.
    if odd.any():
        return odd, None
    brackets = mark != ord("&")
    places, mark = marks[brackets], mark[brackets]
    left, right = places[0::2], places[1::2]
    wrong = [left[mark[0::2] != ord("<")], right[mark[1::2] != ord(">")], *([left[-1:]] if len(left) > len(right) else [])]
    if any(len(w) for w in wrong):
        # One bracket too many shifts all that follow, so each document is looked at by itself.
        starts = np.searchsorted(places, bounds)
        turn = (np.arange(len(places)) - np.repeat(starts[:-1], np.diff(starts))) % 2
        odd[of_bytes(places[mark != np.where(turn == 0, ord("<"), ord(">"))])] = True
        odd |= np.diff(starts) % 2 != 0
        return odd, None
    ends = np.searchsorted(left, bounds)
    n = len(left)
    cuts = np.empty(2 * n + 1, np.int32)
    cuts[0:-1:2], cuts[1::2], cuts[-1] = left, right + 1, len(b)
    pieces = pa.Array.from_buffers(pa.string(), 2 * n, [None, pa.py_buffer(cuts), data])  # tag, text behind it, tag, ...
    tags = pieces.view(pa.binary()).take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode()
    code = tags.indices.to_numpy()
    distinct = [_tag(t, layout) for t in tags.dictionary.to_pylist()]
    kinds = np.array([d[0] for d in distinct], np.int8)
    numbers: dict[bytes, int] = {}
    names = np.array([numbers.setdefault(d[1], len(numbers)) for d in distinct], np.int32)
    roles = np.array([d[3] for d in distinct], np.int32)
    with_attributes = np.array([d[4] is not None for d in distinct])

    def of_tags(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, places, "right") - 1

    # Nesting: one root that ends with the last tag, and at each level openings and closings of one name.
    kind = kinds[code]
    depth = np.cumsum(np.array([1, -1, 0, 0, 0], np.int8)[kind], dtype=np.int32)
    first, last = ends[:-1], ends[1:] - 1
    if (kinds == ODD).any():
        odd[of_tags(np.flatnonzero(kind == ODD))] = True
    odd |= np.diff(depth[last], prepend=0) != 0
    odd |= kind[last] != CLOSE
    if odd.any():
        return odd, None
    declarations = np.flatnonzero(kind == DECLARATION)
    odd[of_tags(declarations[~np.isin(declarations, first)])] = True
    outside = np.flatnonzero(depth <= 0)
    outside = outside[(kind[outside] != DECLARATION) | (depth[outside] < 0)]
    if len(outside) != len(last) or (outside != last).any():
        odd[of_tags(outside[~np.isin(outside, last)])] = True
    if odd.any():
        return odd, None
    level = depth + np.array([0, 1, 1, 0, 0], np.int8)[kind]
    if (deepest := int(level.max())) > LEVELS:
        odd[of_tags(np.flatnonzero(level > LEVELS))] = True
        return odd, None
    if with_attributes.any():
        odd[of_tags(np.flatnonzero(with_attributes[code] & (level != 1)))] = True
    name = names[code]
    opened = [np.empty(0, np.int64)] * (max(deepest, 4) + 1)
    for k in range(1, deepest + 1):
        paired = np.flatnonzero((level == k) & (kind < EMPTY))
        opened[k] = paired[0::2]
        wrong = name[paired[0::2]] != name[paired[1::2]]
        if wrong.any():
            odd[of_tags(paired[0::2][wrong])] = True
    root = first + (kind[first] == DECLARATION)
    prefixes = {d[2] for d in distinct if d[2] is not None}
    if prefixes:
        order = {p: i for i, p in enumerate(prefixes, 1)}
        prefix = np.array([order.get(d[2], 0) for d in distinct], np.int32)
        known = np.zeros((len(distinct), len(order) + 1), bool)
        known[:, 0] = True
        for i in np.unique(code[root]):
            for p in distinct[i][4] or ():
                known[i, order.get(p, 0)] = True
        fine = known[np.repeat(code[root], np.diff(ends)), prefix[code]]
        if not fine.all():
            odd[of_tags(np.flatnonzero(~fine))] = True
    if odd.any():
        return odd, None

    # Text: between a tag and its closing, else white space only.
    is_leaf = np.zeros(n, bool)
    is_leaf[:-1] = (kind[:-1] == OPEN) & (kind[1:] == CLOSE)
    between = np.flatnonzero((cuts[2::2] > cuts[1::2]) & ~is_leaf)
    if len(between):
        spaces = pieces.view(pa.binary()).take(pa.array(2 * between + 1)).dictionary_encode()
        blank = np.array([not s.strip(b" \t\n") for s in spaces.dictionary.to_pylist()])[spaces.indices.to_numpy()]
        if not blank.all():
            odd[of_tags(between[~blank])] = True

    # Records, and in each the places of its fields.
    role = roles[code]
    second = opened[2]
    is_record = role[second] == RECORD
    records = second[is_record]
    document = of_tags(records)
    counts = np.bincount(document, minlength=len(odd))
    odd |= counts == 0
    odd[document[is_leaf[records]]] = True
    empty = np.flatnonzero(kind == EMPTY) if (kinds == EMPTY).any() else np.empty(0, np.int64)
    odd[of_tags(empty[(level[empty] == 2) & (role[empty] == RECORD)])] = True
    if odd.any():
        return odd, None
    total = len(records)

    def found_in(elements: np.ndarray, wanted: int) -> np.ndarray:
        """For each record the place of its element of that role, or -1; a repeated one makes its document odd."""

        here = elements[role[elements] == wanted]
        parent = np.searchsorted(second, here, "right") - 1
        if not is_record.all():
            here, parent = here[is_record[parent]], parent[is_record[parent]]
            parent = (np.cumsum(is_record) - 1)[parent]
        found = np.full(total, -1, np.int64)
        found[parent] = here
        again = found[parent] != here
        if again.any():
            odd[of_tags(here[again])] = True
        return found

    third = np.sort(np.concatenate([opened[3], empty[level[empty] == 3]])) if len(empty) else opened[3]
    fourth = np.sort(np.concatenate([opened[4], empty[level[empty] == 4]])) if len(empty) else opened[4]
    own = {e: found_in(third, i) for i, e in enumerate(layout.elements)}
    in_group = {}
    if layout.groups:
        above = role[opened[3]][np.searchsorted(opened[3], fourth, "right") - 1] if len(fourth) else fourth
    for g, group in enumerate(layout.groups):
        present = found_in(third, GROUP - g)
        some = present[present >= 0]
        odd[of_tags(some[is_leaf[some] | (kind[some] == EMPTY)])] = True
        below = fourth[above == GROUP - g]
        for i, e in enumerate(layout.elements):
            if (group, e) in layout.fields:
                in_group[group, e] = np.where(present >= 0, found_in(below, i), own[e])
    wanted = [in_group[f] if f in in_group else own[f[1]] for f in layout.fields]
    # Both places of a field must be plain, also the one that is not read.
    for p in [*own.values(), *in_group.values()]:
        some = p[p >= 0]
        odd[of_tags(some[~is_leaf[some] & (kind[some] != EMPTY)])] = True
    if odd.any():
        return odd, None

    marked = np.zeros(2 * n, bool)
    marked[np.searchsorted(cuts, references, "right") - 1] = True
    columns = [_texts(pieces, p, cuts, b, kind, marked, entities) for p in wanted]
    position = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    return odd, (document, position.astype(np.int32), columns)


def _texts(pieces, places, cuts, b, kind, marked, entities) -> pa.Array:
    """The texts behind the tags at ``places``, with entities replaced and white space around them removed."""

    none = (places < 0) | (kind[places] == EMPTY)
    if none.all():
        return pa.repeat(pa.scalar("", pa.string()), len(places))
    piece = np.where(none, 1, 2 * places + 1)
    texts = pieces.take(pa.array(piece, mask=none)).fill_null("") if none.any() else pieces.take(pa.array(piece))
    if marked[piece].any():
        for escaped, plain in entities:
            texts = pc.replace_substring(texts, escaped, plain)
    if (_EDGE[b[cuts[piece]]] | _EDGE[b[cuts[piece + 1] - 1]]).any():
        texts = pc.utf8_trim(texts, WHITE_SPACE)
    return texts
