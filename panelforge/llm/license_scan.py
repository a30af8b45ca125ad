"""Licence notices by a trained paragraph classifier with template comparison.

Paragraphs (lines of text) become sparse sets of word n-grams, one to three words
with every number alike. A multinomial logistic regression, trained here on the
notices of :mod:`panelforge.llm.license_texts` and on ordinary paragraphs of the
corpus, gives the probability of each licence family and of the unknown class. A
temperature and a threshold are fitted on paragraphs kept from training. A
predicted family is then confirmed by comparing the paragraph with the family's
templates.

Hashing of n-grams and scoring are vectorised over all paragraphs of a batch; only
n-grams that the model has weights for are looked at further.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, require, slices, text_views, thinned
from panelforge.llm.license_texts import MENTIONS, TEMPLATES
from panelforge.llm.simhash_near import xxh64_ranges

#: Bounds of the sample of ordinary paragraphs: documents, paragraphs of each, characters of one.
DOCUMENTS, PARAGRAPHS, LINE_CHARS = 600, 8, 2000
UNKNOWN = "unknown"
#: Share of a template's or the paragraph's word pairs that confirms a family.
CONFIRMED = 0.6
#: Variants made of each template sentence and of each mere mention.
VARIANTS = 12
FILTER_BITS = 20
# Letters keep their case-folded byte, digits are all alike, bytes from 128 on are letters, 10 ends a paragraph.
KIND = np.zeros(256, dtype=np.uint8)
for _c in range(256):
    if 97 <= _c <= 122 or _c >= 128:
        KIND[_c] = _c
    elif 65 <= _c <= 90:
        KIND[_c] = _c + 32
    elif 48 <= _c <= 57:
        KIND[_c] = 48


def gram_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the 1- to 3-word n-grams of all paragraphs, the paragraph of each, and the paragraph bounds.

    Paragraphs are numbered through; ``bounds`` are the texts', and no paragraph crosses one.
    """

    low, high = int(bounds[0]), int(bounds[-1])
    raw = data[low:high]
    cuts = np.union1d(np.flatnonzero(raw == 10) + 1, bounds - low)
    cuts = np.union1d(cuts, [0])
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), cuts + low
    if not len(raw):
        return none
    folded = np.concatenate([KIND[raw], np.zeros(8, np.uint8)])
    solid = folded[: len(raw)] != 0
    begin_mask = solid.copy()
    begin_mask[1:] &= ~solid[:-1]
    inner = cuts[cuts < len(raw)]
    begin_mask[inner] = solid[inner]
    end_mask = solid.copy()
    end_mask[:-1] &= ~solid[1:]
    before = inner[inner > 0] - 1
    end_mask[before] = solid[before]
    begin, end = np.flatnonzero(begin_mask), np.flatnonzero(end_mask) + 1
    if not len(begin):
        return none
    # A number is one zero however long it is.
    digits = folded[begin] == 48
    size = np.where(digits & (folded[end - 1] == 48), 1, end - begin)
    one = xxh64_ranges(folded, begin, size, 7)
    part = np.searchsorted(cuts, begin, side="right") - 1
    mix = np.uint64(0x9E3779B97F4A7C15)
    two = one[:-1] * mix ^ one[1:]
    three = two[:-1] * mix ^ one[2:]
    same2, same3 = part[:-1] == part[1:], part[:-2] == part[2:]
    return (
        np.concatenate([one, two[same2], three[same3]]),
        np.concatenate([part, part[:-1][same2], part[:-2][same3]]),
        cuts + low,
    )


@dataclass
class LicenseModel:
    """Classes (the last is unknown), known n-grams with their weights, bias, and the calibration."""

    classes: list[str]
    grams: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.seen[self.grams >> np.uint64(64 - FILTER_BITS)] = True

    def features(self, hashes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (paragraph, known n-gram) pairs."""

        if not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.seen[hashes >> np.uint64(64 - FILTER_BITS)])
        near = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        same = self.grams[near] == hashes[at]
        pair = np.unique(part[at[same]] * len(self.grams) + near[same])
        return pair // len(self.grams), pair % len(self.grams)

    def scores(self, hashes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paragraphs with a known n-gram, and their uncalibrated class scores."""

        paragraph, gram = self.features(hashes, part)
        if not len(paragraph):
            return paragraph, np.zeros((0, len(self.classes)))
        cut = np.flatnonzero(np.append(True, paragraph[1:] != paragraph[:-1]))
        return paragraph[cut], np.add.reduceat(self.weights[gram], cut, axis=0) + self.bias

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        z = scores / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        return z / z.sum(axis=1, keepdims=True) if len(z) else z


def _hash_all(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_views(pa.array([t.replace("\n", " ") for t in texts], pa.string()))
    # One paragraph per text; empty texts share a bound, so number by text instead.
    hashes, owners = [], []
    for i in range(len(texts)):
        h, _, _ = gram_hashes(data, bounds[i : i + 2])
        hashes.append(h)
        owners.append(np.full(len(h), i))
    return np.concatenate(hashes), np.concatenate(owners)


def _variants(sentence: str, random: np.random.Generator, count: int) -> list[str]:
    """The sentence itself and noisy forms: words dropped, a part only, words around it."""

    words, found = sentence.split(), [sentence]
    fillers = "see also note for our the documents data files of this site and its parts by all authors".split()
    while len(found) < count:
        kept = [w for w in words if random.random() > 0.06] or words
        if len(kept) > 12 and random.random() < 0.4:
            start = int(random.integers(0, len(kept) - 9))
            kept = kept[start : start + int(random.integers(9, len(kept) - start + 1))]
        around = [str(random.choice(fillers)) for _ in range(int(random.integers(0, 6)))]
        split = int(random.integers(0, len(around) + 1))
        found.append(" ".join([*around[:split], *kept, *around[split:]]))
    return found


def ordinary_paragraphs(df: DataFrame, id_column: str, text_column: str) -> list[str]:
    """A bounded sample of paragraphs that match no template.

    Of the ``DOCUMENTS`` documents with the smallest hash it takes the ``PARAGRAPHS`` different
    lines with the smallest hash among all lines of the whole text; blank lines do not count. A
    line of more than ``LINE_CHARS`` characters gives an extract of that size that begins
    anywhere, as its hash says.
    """

    def extract(line: Column) -> Column:
        start = F.pmod(F.xxhash64(line, F.lit(1)), F.greatest(F.lit(1), F.char_length(line) - LINE_CHARS + 1))
        return F.substring(line, start.cast("int") + 1, F.lit(LINE_CHARS))

    filled = F.filter(F.array_distinct(F.split(F.col(text_column), "\n")), lambda x: F.trim(x) != "")
    by_hash = F.array_sort(F.transform(filled, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("line"))))
    picked = F.transform(F.slice(by_hash, 1, PARAGRAPHS), lambda x: extract(x["line"]))
    rows = (
        df.where(F.col(text_column).isNotNull() & thinned(F.col(id_column).cast("string"), df.count(), DOCUMENTS))
        .select(F.xxhash64(F.col(id_column).cast("string")).alias("h"), picked.alias("lines"))
        .orderBy("h", "lines")
        .limit(DOCUMENTS)
        .collect()
    )
    lines = sorted({x for r in rows for x in r["lines"] if x.strip()})
    wanted = [w for family in _template_pairs.values() for w in family]
    return [x for x in lines for have in [_pairs(x)] if not any(len(w & have) >= 0.3 * len(w) for w in wanted)]


def train(ordinary: list[str], seed: int = 5, rounds: int = 250) -> LicenseModel:
    """Fit the classifier; a fifth of the examples is kept for the calibration."""

    random = np.random.default_rng(seed)
    families = sorted(TEMPLATES)
    classes = [*families, UNKNOWN]
    texts: list[str] = []
    target: list[int] = []
    for k, family in enumerate(families):
        for sentence in TEMPLATES[family]:
            made = _variants(sentence, random, VARIANTS)
            texts += made
            target += [k] * len(made)
    for sentence in MENTIONS:
        made = _variants(sentence, random, VARIANTS)
        texts += made
        target += [len(families)] * len(made)
    texts += ordinary
    target += [len(families)] * len(ordinary)
    y = np.array(target)
    hashes, owner = _hash_all(texts)
    keep = random.random(len(texts)) < 0.2
    # N-grams of the licence notices; others say nothing about a licence.
    grams = np.unique(hashes[(y[owner] < len(families)) & ~keep[owner]])
    model = LicenseModel(classes, grams, np.zeros((len(grams), len(classes))), np.zeros(len(classes)))
    text, gram = model.features(hashes, owner)
    used = ~keep[text]
    rows, columns = text[used], gram[used]
    weight_of = np.zeros(len(texts))
    share = np.bincount(y[~keep], minlength=len(classes)).astype(float)
    per_class = 1 / np.maximum(share, 1)
    per_class[-1] *= len(families)  # as much unknown text as licences
    weight_of[~keep] = per_class[y[~keep]]
    weight_of /= max(weight_of.sum(), 1e-9)
    goal = np.eye(len(classes))[y]
    step_w, step_b = np.zeros_like(model.weights), np.zeros_like(model.bias)
    for _ in range(rounds):  # full-batch AdaGrad
        scores = np.zeros((len(texts), len(classes))) + model.bias
        np.add.at(scores, rows, model.weights[columns])
        error = (model.probabilities(scores) - goal) * weight_of[:, None]
        gradient = np.zeros_like(model.weights)
        np.add.at(gradient, columns, error[rows])
        gradient += 1e-5 * model.weights
        step_w += gradient**2
        step_b += error.sum(axis=0) ** 2
        model.weights -= 0.3 * gradient / np.sqrt(step_w + 1e-12)
        model.bias -= 0.3 * error.sum(axis=0) / np.sqrt(step_b + 1e-12)
    scores = np.zeros((len(texts), len(classes))) + model.bias
    np.add.at(scores, text, model.weights[gram])
    _calibrate(model, scores[keep], y[keep])
    return model


def _calibrate(model: LicenseModel, scores: np.ndarray, y: np.ndarray) -> None:
    """Temperature of least log loss; the threshold, 0.5 or more, that best parts licences from the unknown class."""

    if not len(y):
        return
    at = np.arange(len(y))
    best = (np.inf, 1.0)
    for t in np.geomspace(0.25, 8, 41):
        model.temperature = float(t)
        best = min(best, (float(-np.log(np.maximum(model.probabilities(scores)[at, y], 1e-12)).mean()), float(t)))
    model.temperature = best[1]
    licence = 1 - model.probabilities(scores)[:, -1]
    known = y < len(model.classes) - 1
    options = [(float(((licence >= c) == known).mean()), -abs(c - 0.5), float(c)) for c in np.linspace(0.5, 0.95, 46)]
    model.threshold = max(options)[2]


def _pairs(text: str) -> set[tuple[str, str]]:
    words = [re.sub(r"\d+", "0", w) for w in re.findall(r"[^\W_]+", text.lower())]
    return set(zip(words, words[1:])) if len(words) > 1 else {(w, "") for w in words}


_template_pairs = {f: [_pairs(t) for t in TEMPLATES[f]] for f in TEMPLATES}


def best_template(paragraph: str, family: str) -> float:
    """The best agreement with a template: the share found of it, or of a paragraph that quotes part of one."""

    have = _pairs(paragraph)
    best = 0.0
    for wanted in _template_pairs[family]:
        common = len(wanted & have)
        best = max(best, common / max(1, len(wanted)), common / len(have) if len(have) >= 6 else 0.0)
    return best


def scan_licenses(
    df: DataFrame, model: LicenseModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per paragraph that is predicted to state a licence.

    Columns: the document's id, ``paragraph`` (from 0), ``begin`` and ``n_bytes`` of it in the
    text's UTF-8, ``family``, ``probability``, ``similarity`` to the nearest template of the
    family, and ``confirmed``. Null, empty and licence-free texts have no row; repeated rows
    each have theirs; other columns are ignored.
    """

    require(df, id_column, text_column)
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_views(batch.column(1))
            found: list[tuple] = []
            for low, high in slices(bounds):
                hashes, part, cuts = gram_hashes(data, bounds[low : high + 1])
                paragraph, scores = model.scores(hashes, part)
                chance = model.probabilities(scores)
                for i in np.flatnonzero(1 - chance[:, -1] >= model.threshold) if len(chance) else ():
                    k = int(chance[i, :-1].argmax())
                    begin, end = int(cuts[paragraph[i]]), int(cuts[paragraph[i] + 1])
                    doc = int(np.searchsorted(bounds, begin, side="right")) - 1
                    line = data[begin:end].tobytes()
                    agreement = best_template(line.decode("utf-8", "replace"), model.classes[k])
                    nth = int(np.searchsorted(cuts, begin) - np.searchsorted(cuts, bounds[doc]))
                    found.append(
                        (doc, nth, begin - int(bounds[doc]), len(line.rstrip(b"\n")), model.classes[k],
                         float(chance[i, k]), agreement, agreement >= CONFIRMED)
                    )
            columns = list(zip(*found)) or [[]] * 8
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64()))]
                + [pa.array(c, t) for c, t in zip(columns[1:], kinds)],
                names=["id", "paragraph", "begin", "n_bytes", "family", "probability", "similarity", "confirmed"],
            )

    picked = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return map_arrow(
        picked, run,
        f"id {kind}, paragraph int, begin bigint, n_bytes int, family string, probability double, similarity double, "
        "confirmed boolean",
    ).withColumnRenamed("id", id_column)


def find_licenses(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Train on the templates and a sample of the table's paragraphs, then scan the whole table."""

    require(df, id_column, text_column)
    return scan_licenses(df, train(ordinary_paragraphs(df, id_column, text_column)), id_column, text_column)
