"""Licence scan: a trained classifier of paragraphs, confirmed against templates.

A paragraph is a run of lines that are not blank, in overlapping windows if it is long, besides each of its lines by itself; comment marks do
not count, so hard-wrapped notices in files and source headers are whole. It is a sparse vector of the word n-grams that templates hold, scaled by the number of
all its n-grams. Multinomial logistic regression tells the licence families and the class of all other text. It is trained on variations of
the templates, single and joined, and on a bounded sample of paragraphs of the corpus, to the minimum of a strictly convex loss, which doesn't
depend on where the search for it stops; its probabilities are calibrated by a temperature fitted on rows that training did not see. A paragraph
no family of which is probable enough is unknown. The classifier alone names the family; a paragraph is confirmed if it holds most of the n-grams
of a template of that family.

Edge cases: a null or empty text has no paragraph and no licence. Repeated rows and null ids each give a row. Of several confirmed paragraphs
the most probable names the licence, ties go to the first. A very long text is worked through window by window in one task. Without any corpus paragraph the other class is trained on blank vectors only. Only
the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import by_bytes
from aeroledger.llm.license_texts import TEMPLATES

UNKNOWN = "unknown"
WINDOW_WORDS, WINDOW_STEP = 60, 30
WORDS = re.compile(r"[^\W_]+(?:\.\d+)*")
#: Marks before the words of a line: of comments (rem and dnl as well) and quotations.
REMARK = re.compile(r"^\s*(?:rem|dnl)\s")
BATCH_BYTES = 1 << 20


def grams(words: list[str]) -> set[str]:
    """Single words, pairs and triples."""
    return {*words, *map(" ".join, zip(words, words[1:], strict=False)), *map(" ".join, zip(words, words[1:], words[2:], strict=False))}


def windows(text: str) -> Iterator[tuple[int, list[str]]]:
    """Number of the paragraph, and its words in windows: of each line, and of the lines joined."""
    number, lines = 0, []
    for line in [*text.lower().split("\n"), ""]:
        words = WORDS.findall(REMARK.sub("", line))
        if words:
            lines.append(words)
            continue
        if lines:
            for own in lines:
                yield from ((number, w) for w in _cut(own))
            if len(lines) > 1:
                joined, ends = [w for own in lines for w in own], list(accumulate(map(len, lines)))
                for at, w in zip(range(0, len(joined), WINDOW_STEP), _cut(joined), strict=False):
                    if bisect_right(ends, at) < bisect_left(ends, at + len(w)):  # else one line holds the window
                        yield number, w
        number, lines = number + 1, []


def _cut(words: list[str]) -> Iterator[list[str]]:
    """Windows that overlap by half."""
    for at in range(0, max(1, len(words) - WINDOW_STEP), WINDOW_STEP) if words else ():
        yield words[at : at + WINDOW_WORDS]


@dataclass(frozen=True)
class LicenseModel:
    families: tuple[str, ...]  # the other class is the last column
    number: dict[str, int]  # of each n-gram of a template
    weights: np.ndarray  # one row per n-gram, and the bias as last row
    temperature: float
    templates: tuple[tuple[int, frozenset[str]], ...]  # family and triples (or all n-grams of a short notice)
    calibration_error: float  # on rows that training did not see

    def probabilities(self, words: list[str]) -> np.ndarray:
        return softmax(self.logits(words) / self.temperature)

    def logits(self, words: list[str]) -> np.ndarray:
        found, n = features(words, self.number)
        return self.weights[found].sum(0) / np.sqrt(n) + self.weights[-1]

    def similarity(self, words: list[str], family: int) -> float:
        """Largest share of a template's n-grams that the words hold."""
        own = grams(words)
        return max(len(t & own) / len(t) for f, t in self.templates if f == family)


def features(words: list[str], number: dict[str, int]) -> tuple[list[int], int]:
    """Numbers of the known n-grams, once each, and the count of all n-grams. Pairs and triples of unknown words are not built."""
    known = [w in number for w in words]
    found = {w for w, k in zip(words, known, strict=True) if k}
    for i in range(len(words) - 1):
        if known[i] and known[i + 1]:
            found.add(f"{words[i]} {words[i + 1]}")
            if i + 2 < len(words) and known[i + 2]:
                found.add(f"{words[i]} {words[i + 1]} {words[i + 2]}")
    return [number[g] for g in found if g in number], max(1, 3 * len(words) - 3)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _templates() -> tuple[tuple[int, frozenset[str]], ...]:
    out = []
    for i, notices in enumerate(TEMPLATES.values()):
        for notice in notices:
            words = WORDS.findall(notice.lower())
            out.append((i, frozenset(g for g in grams(words) if len(words) < 3 or g.count(" ") == 2)))
    return tuple(out)


def _variations(copies: int, others: list[list[str]], rng: np.random.Generator) -> tuple[list[list[str]], list[int]]:
    """Templates as they are, with words left out, and with words of other text around them."""
    rows, labels = [], []
    for i, notices in enumerate(TEMPLATES.values()):
        each = max(1, copies // len(notices))
        for notice in notices:
            words = WORDS.findall(notice.lower())
            rows.append(words)
            labels.append(i)
            for k in range(each):
                some = [w for w in words if rng.random() > 0.06] or words
                if k % 2 and others:
                    other = others[rng.integers(len(others))]
                    # few words, or as many as a window can hold besides
                    a, b = rng.integers(0, 9 if k % 4 == 1 else max(9, (WINDOW_WORDS - len(some)) // 2), 2)
                    some = other[:a] + some + other[a : a + b]
                rows.append(some)
                labels.append(i)
        # notices stand together in headers and licence files
        for _ in range(copies if len(notices) > 1 else 0):
            at = rng.integers(0, len(notices) - 1)
            joined = [w for notice in notices[at : at + rng.integers(2, 4)] for w in WORDS.findall(notice.lower())]
            rows.append([w for w in joined if rng.random() > 0.06])
            labels.append(i)
    return rows, labels


def train(others: list[list[str]], copies: int = 120, max_rounds: int = 1_000, penalty: float = 1e-6, seed: int = 3) -> LicenseModel:
    """Fit on variations of the templates and on windows of other text."""
    rng = np.random.default_rng(seed)
    templates = _templates()
    vocabulary = sorted(set().union(*(grams(WORDS.findall(n.lower())) for notices in TEMPLATES.values() for n in notices)))
    number = {g: i for i, g in enumerate(vocabulary)}
    # a sampled paragraph that holds most of a template is no example of other text
    others = [w for w, own in ((w, grams(w)) for w in others) if max(len(t & own) / len(t) for _, t in templates) < 0.4]
    rows, labels = _variations(copies, others, rng)
    n_classes = len(TEMPLATES) + 1
    rows, labels = rows + others + [[]], np.array(labels + [n_classes - 1] * (len(others) + 1))

    x = np.zeros((len(rows), len(vocabulary) + 1))
    x[:, -1] = 1
    for i, words in enumerate(rows):
        found, n = features(words, number)
        x[i, found] = 1 / np.sqrt(n)
    target = np.eye(n_classes)[labels]
    held = rng.random(len(rows)) < 0.2
    share = np.bincount(labels, minlength=n_classes)
    weight = (1 / np.maximum(share, 1))[labels] * np.where(labels == n_classes - 1, n_classes - 1, 1)  # other text counts like all families
    fit, own, g = x[~held], target[~held], (weight / weight[~held].sum())[~held, None]

    def loss_and_slope(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = fit @ w
        z -= z.max(1, keepdims=True)
        total = np.exp(z).sum(1, keepdims=True)
        loss = float((g * (np.log(total) - (own * z).sum(1, keepdims=True))).sum()) + penalty / 2 * float((w * w).sum())
        return loss, fit.T @ (g * (np.exp(z) / total - own)) + penalty * w

    w = minimise(loss_and_slope, np.zeros((x.shape[1], n_classes)), max_rounds)
    test = x[held] @ w if held.any() else x @ w
    truth = labels[held] if held.any() else labels

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(softmax(test / t)[np.arange(len(truth)), truth], 1e-12)).mean())

    temperature = min(np.geomspace(0.05, 5, 60).tolist(), key=loss)
    p = softmax(test / temperature)
    return LicenseModel(tuple(TEMPLATES), number, w, temperature, templates, calibration_error(p.max(1), p.argmax(1) == truth))


def calibration_error(sure: np.ndarray, right: np.ndarray, bins: int = 10) -> float:
    """Mean difference, over rows, of the probability of the best class and the share of such rows that are right."""
    slot = np.minimum((sure * bins).astype(int), bins - 1)
    return float(sum(abs(sure[slot == b].sum() - right[slot == b].sum()) for b in range(bins)) / max(1, len(sure)))


def minimise(
    loss_and_slope: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_rounds: int, tolerance: float = 1e-7, memory: int = 12
) -> np.ndarray:
    """Minimum of a strictly convex function, where its slope is shorter than `tolerance`.

    Quasi-Newton steps (limited-memory BFGS), each halved until the function falls by a share of what its slope promises.
    """
    w, (value, slope) = start, loss_and_slope(start)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []  # moves, changes of the slope, and one over their product
    for _ in range(max_rounds):
        if np.sqrt((slope * slope).sum()) < tolerance:
            break
        direction, factors = slope.copy(), []
        for s, y, rho in reversed(steps):
            factors.append(rho * (s * direction).sum())
            direction -= factors[-1] * y
        if steps:
            s, y, rho = steps[-1]
            direction /= rho * (y * y).sum()
        for (s, y, rho), a in zip(steps, reversed(factors), strict=True):
            direction += s * (a - rho * (y * direction).sum())
        fall, rate = (slope * direction).sum(), 1.0
        while rate > 1e-12:
            new = w - rate * direction
            new_value, new_slope = loss_and_slope(new)
            if new_value <= value - 1e-4 * rate * fall:
                break
            rate /= 2
        else:
            break  # as near as floating point allows
        s, y = new - w, new_slope - slope
        if (s * y).sum() > 0:
            steps = [*steps[-memory + 1 :], (s, y, 1 / (s * y).sum())]
        w, value, slope = new, new_value, new_slope
    return w


def learn(docs: DataFrame, max_others: int = 3_000, seed: int = 3) -> LicenseModel:
    """Train with about `max_others` windows of the corpus (the bound of the sample), from documents chosen by a hash of id and text."""
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    n = texts.count()
    rate = min(1.0, max_others / 4 / max(1, n))  # about four windows are taken of each document
    chosen = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1_000_000_000)) / 1e9 < rate

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", BATCH_BYTES):
            found = [w for t in part.column("text").to_pylist() for w in _spread([w for line in t.lower().split("\n") for w in _cut(WORDS.findall(line))])]
            yield pa.RecordBatch.from_arrays([pa.array([" ".join(w) for w in found], pa.string())], ["words"])

    sample = texts.where(chosen).select("text").mapInArrow(cut, "words string").limit(2 * max_others).toArrow()
    return train([w.split(" ") for w in sorted(sample.column("words").to_pylist())], seed=seed)


def _spread(items: list, n: int = 4) -> list:
    """Up to `n` items from all over a list."""
    return [items[i * len(items) // n] for i in range(n)] if len(items) > n else items


def scan(docs: DataFrame, model: LicenseModel, min_probability: float = 0.5, min_similarity: float = 0.75) -> DataFrame:
    """Per document: doc_id, license (the confirmed family, else null), probability, similarity, n_paragraphs, n_predicted and n_confirmed.

    Probability and similarity are those of the paragraph that names the licence; n_predicted counts paragraphs with a probable family.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand weights
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, license string, probability double, similarity double, "
        "n_paragraphs int, n_predicted int, n_confirmed int"
    )

    def judge(text: str) -> tuple:
        model = shared.value
        other = len(model.families)
        best, lines, predicted, confirmed = (None, None, None), set(), set(), set()
        for line, words in windows(text):
            lines.add(line)
            p = model.probabilities(words)
            family = int(p[:other].argmax())
            if p[family] < min_probability:
                continue
            predicted.add(line)
            similar = model.similarity(words, family)
            if similar < min_similarity:
                continue
            confirmed.add(line)
            if best[0] is None or p[family] > best[1]:
                best = model.families[family], float(p[family]), similar
        return *best, len(lines), len(predicted), len(confirmed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
        for part in by_bytes(batches, "text", BATCH_BYTES):
            found = list(zip(*map(judge, part.column("text").to_pylist()), strict=True))
            columns = [pa.array(c, t) for c, t in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns], ["doc_id", "license", "probability", "similarity", "n_paragraphs", "n_predicted", "n_confirmed"]
            )

    return rows.mapInArrow(run, schema)
