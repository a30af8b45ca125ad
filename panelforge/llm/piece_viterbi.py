"""SentencePiece segmentation by an Aho-Corasick automaton and a single-pass Viterbi.

The automaton over all pieces reads a text once. At every position its output
links name the pieces that end there, longest first, and each of them relaxes
the best segmentation of the prefix. What "best" means follows the model's type:

* unigram: the largest sum of piece scores.
* merge model (BPE): scores order merges, so a sum of them means nothing. A
  segmentation is the model's own exactly when no two neighbouring pieces would
  have merged differently, and that can be asked of every pair by itself. A step
  from piece a to piece b is therefore admissible if merging the characters of
  a + b by score gives a and b again; an inadmissible step has score minus
  infinity. Each prefix has exactly one admissible last piece, so one pass with
  one entry per position gives the merge result.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pandas as pd

#: Types of a piece and of a model in the public SentencePiece format (fixed values).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
#: Characters told apart when a text is cut.
CLASSES = 1024
#: Piece pairs remembered per process; forgetting costs time only.
PAIR_MEMORY = 1 << 18
#: Parts of up to this many characters are segmented side by side.
SIDE_BY_SIDE = 48


class Automaton:
    """Aho-Corasick automaton; ``chain[s]`` lists (length, piece) ending at state s, longest first."""

    def __init__(self, pieces: dict[str, int]):
        self.children: list[dict[str, int]] = [{}]
        label: list[int | None] = [None]
        length = [0]
        for text, piece in pieces.items():
            state = 0
            for char in text:
                following = self.children[state].get(char)
                if following is None:
                    following = self.children[state][char] = len(label)
                    self.children.append({})
                    label.append(None)
                    length.append(length[state] + 1)
                state = following
            label[state] = piece
        self.fail = [0] * len(label)
        self.chain: list[tuple[tuple[int, int], ...]] = [()] * len(label)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for char, child in self.children[state].items():
                if state:
                    self.fail[child] = self.follow(self.fail[state], char)
                links = self.chain[self.fail[child]]
                self.chain[child] = ((length[child], label[child]), *links) if label[child] is not None else links
                queue.append(child)

    def follow(self, state: int, char: str) -> int:
        """The state after ``char``, over failure links where there is no direct step."""

        children, fail = self.children, self.fail
        following = children[state].get(char)
        while following is None:
            if not state:
                return 0
            state = fail[state]
            following = children[state].get(char)
        return following


class Network:
    """The automaton as arrays, to advance many texts at once."""

    def __init__(self, automaton: Automaton):
        chars = sorted({c for step in automaton.children for c in step})
        self.chars = np.array([ord(c) for c in chars], dtype=np.int64)
        number = {c: i for i, c in enumerate(chars)}
        self.fail = np.array(automaton.fail, dtype=np.int64)
        steps = sorted(
            (state * (len(chars) + 1) + number[c], child)
            for state, children in enumerate(automaton.children) for c, child in children.items()
        )
        self.keys = np.array([k for k, _ in steps] or [-1], dtype=np.int64)
        self.targets = np.array([c for _, c in steps] or [0], dtype=np.int64)
        # The longest piece that ends at a state, as the state that spells it, and the next shorter one.
        self.depth = np.zeros(len(automaton.children), dtype=np.int64)
        for state, children in enumerate(automaton.children):  # children have larger numbers
            for child in children.values():
                self.depth[child] = self.depth[state] + 1
        self.label = np.full(len(self.depth), -1, dtype=np.int64)
        self.output = np.full(len(self.depth), -1, dtype=np.int64)
        for state, chain in enumerate(automaton.chain):
            if chain and chain[0][0] == self.depth[state]:
                self.label[state] = chain[0][1]
        for state in np.argsort(self.depth, kind="stable").tolist():
            self.output[state] = state if self.label[state] >= 0 else self.output[self.fail[state]] if state else -1
        self.shorter = self.output[self.fail]
        self.shorter[0] = -1

    def char_kinds(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of characters; one more than the last for those that no piece has."""

        if not len(self.chars):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        return np.where(self.chars[at] == codes, at, len(self.chars))

    def follow(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The states after one more character each, over failure links where there is no direct step."""

        out = np.zeros(len(state), dtype=np.int64)
        rows = np.arange(len(state))
        while len(rows):
            key = state * (len(self.chars) + 1) + kind
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[rows[hit]] = self.targets[at[hit]]
            again = ~hit & (state > 0)  # at the root the text starts over
            rows, kind, state = rows[again], kind[again], self.fail[state[again]]
        return out


@dataclass
class PieceModel:
    """Pieces of a SentencePiece model with the identity normalizer; encodes and decodes."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int = BPE
    dummy_prefix: bool = True
    byte_fallback: bool = True
    pairs: dict[int, bool] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.vocabulary = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL}
        self.unknown = next((i for i, t in enumerate(self.types) if t == UNKNOWN), 0)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        self.alphabet = {c for p in self.vocabulary for c in p}
        # Characters that occur in pieces only, and are none themselves, take part in merges too.
        self.surface = list(self.pieces)
        searched = dict(self.vocabulary)
        for char in sorted(self.alphabet - set(self.vocabulary)):
            searched[char] = len(self.surface)
            self.surface.append(char)
        if self.kind == BPE:
            searched = {p: i for p, i in searched.items() if self.merge(p) == [p]}
        self.automaton = Automaton(searched)
        self.lengths = [len(p) for p in self.surface]
        self.network = Network(self.automaton)
        self.known, self.known_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        lowest = min((self.scores[i] for i in self.vocabulary.values()), default=0.0)
        self.unknown_score = lowest - 10.0
        # Two neighbouring characters that no piece holds side by side are never merged, so a
        # text may be cut between them. Characters from CLASSES on share one class.
        self.joined = np.zeros((CLASSES + 1, CLASSES + 1), dtype=bool)
        for piece in self.vocabulary:
            codes = self._classes(piece)
            self.joined[codes[:-1], codes[1:]] = True
        self.plain = [
            bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else b" \xe2\x81\x87 " if t == UNKNOWN
            else p.replace(SPACE, " ").encode("utf-8")
            for p, t in zip(self.pieces, self.types)
        ]

    @staticmethod
    def _classes(text: str) -> np.ndarray:
        codes = np.frombuffer(text.replace(SPACE, "\x1f").encode("utf-32-le", "replace"), dtype="<u4")
        return np.minimum(codes, CLASSES)

    def cut(self, text: str) -> list[str]:
        """Parts of a text between which no piece can lie; they are encoded one by one."""

        codes = self._classes(text)
        cuts = (np.flatnonzero(~self.joined[codes[:-1], codes[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def merge(self, text: str) -> list[str]:
        """Merge neighbours by the best score of the merged piece, leftmost first among equals."""

        symbols, vocabulary, scores = list(text), self.vocabulary, self.scores
        while len(symbols) > 1:
            best, where = None, -1
            for i in range(len(symbols) - 1):
                piece = vocabulary.get(symbols[i] + symbols[i + 1])
                if piece is not None and (best is None or scores[piece] > best):
                    best, where = scores[piece], i
            if where < 0:
                break
            symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]
        return symbols

    def admissible(self, left: int, right: int) -> bool:
        """True if the merge rules leave the two pieces, side by side, as they are."""

        if len(self.pairs) >= PAIR_MEMORY:
            self.pairs.clear()
        a, b = self.surface[left], self.surface[right]
        known = self.pairs[left << 32 | right] = a + b not in self.vocabulary and self.merge(a + b) == [a, b]
        return known

    def segment(self, text: str) -> list[int]:
        """Token ids of a text that has its space marks."""

        last = self._admissible_path(text) if self.kind == BPE else self._best_path(text)
        out: list[int] = []
        end, pieces, lengths = len(text), len(self.pieces), self.lengths
        while end:
            piece = last[end]
            begin = end - (lengths[piece] if piece >= 0 else 1)
            if 0 <= piece < pieces:
                out.append(piece)
            elif self.byte_fallback:
                out += [self.byte_ids[b] for b in reversed(text[begin:end].encode("utf-8", "replace"))]
            elif not out or out[-1] != self.unknown:  # a run of unknown characters is one token
                out.append(self.unknown)
            end = begin
        out.reverse()
        return out

    def _admissible_path(self, text: str) -> list[int]:
        """Per position the last piece of the one admissible segmentation of the prefix; -1 for a character outside the alphabet."""

        children, chain, fail, pairs = self.automaton.children, self.automaton.chain, self.automaton.fail, self.pairs
        last, state = [-2], 0
        for char in text:
            following = children[state].get(char)
            while following is None:
                if not state:
                    following = 0
                    break
                state = fail[state]
                following = children[state].get(char)
            state = following
            for length, piece in chain[state]:
                before = last[-length]
                if before < 0:
                    last.append(piece)
                    break
                fits = pairs.get(before << 32 | piece)
                if fits is None:
                    fits = self.admissible(before, piece)
                if fits:
                    last.append(piece)
                    break
            else:
                last.append(-1)
        return last

    def _best_path(self, text: str) -> list[int]:
        """Per position the last piece of the segmentation with the largest sum of scores; -1 as above."""

        chain, follow, scores, unknown = self.automaton.chain, self.automaton.follow, self.scores, self.unknown_score
        last, best, state = [-2], [0.0], 0
        for i, char in enumerate(text, 1):
            state = follow(state, char)
            top, chosen = float("-inf"), -1
            for length, piece in chain[state]:
                score = best[i - length] + (scores[piece] if piece < len(scores) else unknown)
                if score > top:
                    top, chosen = score, piece
            if best[i - 1] + unknown > top:
                top, chosen = best[i - 1] + unknown, -1
            best.append(top)
            last.append(chosen)
        return last

    def encode(self, text: str) -> list[int]:
        """Token ids of a text; an empty text has none."""

        if not text:
            return []
        marked = ((" " if self.dummy_prefix else "") + text).replace(" ", SPACE)
        return [piece for part in self.cut(marked) for piece in self.segment(part)]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of many texts, one after the other, and the bounds of each text's ids.

        The same result as :meth:`encode`, with each distinct part segmented once and, for
        merge models, all of them side by side.
        """

        lead = " " if self.dummy_prefix else ""
        marked = [(lead + t).replace(" ", SPACE) if t else "" for t in texts]
        joined = "".join(marked)
        ends = np.cumsum([len(m) for m in marked])
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        codes = self._classes(joined)
        apart = ~self.joined[codes[:-1], codes[1:]]
        apart[ends[(ends > 0) & (ends < len(joined))] - 1] = True
        cuts = np.concatenate([[0], np.flatnonzero(apart) + 1, [len(joined)]])
        places = cuts.tolist()
        which, parts = pd.factorize(np.array([joined[a:b] for a, b in zip(places, places[1:])], dtype=object))
        ids, bounds = self._segment_all(list(parts))
        sizes = np.diff(bounds)[which]
        first = np.cumsum(sizes) - sizes
        flat = ids[np.repeat(bounds[which] - first, sizes) + np.arange(sizes.sum())]
        in_text = np.searchsorted(cuts, ends)  # parts before the end of each text
        return flat, np.concatenate([[0], np.append(0, np.cumsum(sizes))[in_text]])

    def _segment_all(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many parts and their bounds; long parts and those with odd characters go one by one."""

        lengths = np.array([len(p) for p in parts])
        found: list[np.ndarray | None] = [None] * len(parts)
        short = np.flatnonzero(lengths <= SIDE_BY_SIDE) if self.kind == BPE else np.zeros(0, np.int64)
        short = short[np.argsort(-lengths[short], kind="stable")]
        for low in range(0, len(short), 1 << 16):
            rows = short[low : low + (1 << 16)]
            last = self._admissible_table([parts[i] for i in rows], lengths[rows])
            tokens, counts = self._trace_back(last, lengths[rows])
            for i, row, n in zip(rows.tolist(), tokens, counts.tolist()):
                if n >= 0:
                    found[i] = row[len(row) - n :]
        done = [np.array(self.segment(parts[i]), np.int32) if f is None else f for i, f in enumerate(found)]
        return np.concatenate(done), np.concatenate([[0], np.cumsum([len(d) for d in done])])

    def _admissible_table(self, parts: list[str], lengths: np.ndarray) -> np.ndarray:
        """:meth:`_admissible_path` of many parts, sorted by falling length, one character of all at a time."""

        net = self.network
        text = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), dtype="<u4")
        start = np.cumsum(lengths) - lengths
        kinds = net.char_kinds(text)
        last = np.full((len(parts), int(lengths[0]) + 1), -1, dtype=np.int64)
        last[:, 0] = -2
        state = np.zeros(len(parts), dtype=np.int64)
        for t in range(int(lengths[0])):
            width = int(np.searchsorted(-lengths, -t, side="left"))  # parts longer than t
            state = net.follow(state[:width], kinds[start[:width] + t])
            rows, output = np.arange(width), net.output[state]
            while True:
                open_rows = output >= 0
                rows, output = rows[open_rows], output[open_rows]
                if not len(rows):
                    break
                piece = net.label[output]
                before = last[rows, t + 1 - net.depth[output]]
                fits = before < 0
                check = np.flatnonzero(~fits)
                if len(check):
                    fits[check] = self._pairs_fit(before[check] << 32 | piece[check])
                last[rows[fits], t + 1] = piece[fits]
                rows, output = rows[~fits], net.shorter[output[~fits]]
        return last

    def _pairs_fit(self, keys: np.ndarray) -> np.ndarray:
        """:meth:`admissible` of packed pairs; new pairs are worked out once and kept sorted."""

        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
            new = np.unique(keys[self.known[at] != keys])
        else:
            new = np.unique(keys)
        if len(new):
            fits = [self.admissible(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()]
            if len(self.known) >= PAIR_MEMORY:
                self.known, self.known_fits = np.zeros(0, np.int64), np.zeros(0, bool)
                new = np.unique(keys)
                fits = [self.admissible(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()]
            place = np.searchsorted(self.known, new)
            self.known = np.insert(self.known, place, new)
            self.known_fits = np.insert(self.known_fits, place, fits)
            at = np.searchsorted(self.known, keys)
        return self.known_fits[at]

    def _trace_back(self, last: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each part, flush right, and how many; -1 where a character has no piece of its own."""

        size = np.array(self.lengths)
        tokens = np.zeros((len(last), last.shape[1]), dtype=np.int32)
        counts = np.zeros(len(last), dtype=np.int64)
        rows, end = np.arange(len(last)), lengths.copy()
        while len(rows):
            piece = last[rows, end]
            odd = (piece < 0) | (piece >= len(self.pieces))
            counts[rows[odd]] = -1
            rows, end, piece = rows[~odd], end[~odd], piece[~odd]
            counts[rows] += 1
            tokens[rows, tokens.shape[1] - counts[rows]] = piece
            end = end - size[piece]
            rows, end = rows[end > 0], end[end > 0]
        return tokens, counts

    def decode(self, ids: list[int]) -> str:
        """The text of token ids; the space that encoding put in front is taken off."""

        text = b"".join([self.plain[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def load_model(path: str) -> PieceModel:
    """Read a SentencePiece model file; other normalizers than the identity are refused."""

    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return from_proto(model)


def from_proto(model) -> PieceModel:
    """Build from a parsed model message."""

    spec, trainer = model.normalizer_spec, model.trainer_spec
    types = [p.type for p in model.pieces]
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix:
        raise ValueError("only models with the identity normalizer are supported")
    if trainer.model_type not in (UNIGRAM, BPE) or set(types) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("only unigram and merge models without user-defined pieces are supported")
    return PieceModel(
        [p.piece for p in model.pieces], [p.score for p in model.pieces], types, trainer.model_type,
        spec.add_dummy_prefix, trainer.byte_fallback,
    )
