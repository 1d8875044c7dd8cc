"""Toxicity by a subsequence-kernel SVM with Nystroem landmarks (operator 3).

A text is a sequence of units: its words, lower-cased, without the marks
inside them, and with runs of single letters (``i d i o t``) joined.  Two units
are compared by the gapped subsequence kernel: ordered triples of letters that
lie within ``SPAN`` letters of each other, each weighted by ``DECAY`` to the
power of the letters skipped -- inserted, repeated or starred-out characters
cost weight but not the match.

The kernel is approximated on ``LANDMARKS`` words of the labelled texts
(Nystroem: K_nm K_mm**-1/2) and a linear SVM with squared hinge loss is trained
on labelled sentences.  A sentence is represented by its highest-scoring unit,
chosen anew after each round, since only some word of a toxic document need be
toxic.  Landmark expansions are sums over triples, so the trained SVM folds
into one weight per triple: a text of any length is scored by table look-ups,
and the result equals the landmark expansion.  A logistic calibration on the
labelled documents turns a document's margins into a probability.

Fitting reads about ``SAMPLE`` labelled documents, chosen by a hash of their
ids among those of at most ``SAMPLE_CHARS`` characters; texts to be scored are
read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import bounded_sample

SAMPLE = 4000
SAMPLE_CHARS = 20_000
LANDMARKS = 256
SPAN = 5
DECAY = 0.6
CLASSES = 64                    # letter classes; a..z and what else hashes to
ROUNDS = 4                      # choices of the sentences' units
NEGATIVES = 5000                # frequent clean words, and as many of the rest
PENALTY = 0.2
MIN_SUPPORT = 3                 # toxic documents a word needs to be a first guess
CHUNK_CHARS = 1_000_000
END = b"\xfe\xfe"
_GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b < SPAN]


def letter_classes() -> np.ndarray:
    """Code point -> class of the lower-case letter; 0 white space, 255 marks."""
    table = np.full(0x110000, 255, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            o = ord(low) if len(low) == 1 else c
            table[c] = o - 96 if 97 <= o <= 122 else 27 + o % (CLASSES - 27)
        elif ch.isspace():
            table[c] = 0
    return table


def unit_codes(text: str, table: np.ndarray) -> np.ndarray:
    """Letter classes of a text's units, each unit followed by one 0."""
    codes = table[np.frombuffer((text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = codes[codes != 255]
    if not len(codes):
        return codes
    blank = codes == 0
    codes = codes[~(blank & np.concatenate(([True], blank[:-1])))]
    ends = np.flatnonzero(codes == 0)
    if not len(ends):
        return codes
    single = np.diff(np.concatenate(([-1], ends))) == 2
    joined = np.concatenate((single[:-1] & single[1:], [False]))
    keep = np.ones(len(codes), bool)
    keep[ends[joined]] = False
    return codes[keep]


def _norms(lengths: np.ndarray) -> np.ndarray:
    total = np.zeros(len(lengths))
    for a, b in _GAPS:
        total += np.maximum(lengths - a - b, 0) * DECAY ** (2 * (a + b - 2))
    return np.sqrt(np.maximum(total, 1e-9))


def _occurrences(codes: np.ndarray):
    """For each pair of gaps: positions of first letters, triples, weight."""
    unit = np.cumsum(codes == 0)
    wide = codes.astype(np.int32)
    for a, b in _GAPS:
        n = len(codes) - a - b
        if n <= 0:
            continue
        inside = (unit[:n] == unit[a + b:]) & (codes[:n] != 0) & (codes[a + b:] != 0)
        at = np.flatnonzero(inside)
        yield at, (wide[at] * CLASSES + wide[at + a]) * CLASSES + wide[at + a + b], DECAY ** (a + b - 2)


def unit_margins(codes: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """SVM margin of every unit."""
    ends = np.flatnonzero(codes == 0)
    if not len(ends):
        return np.zeros(0)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sums = np.zeros(len(codes))
    for at, triple, weight in _occurrences(codes):
        sums[at] += weights[triple] * weight
    return np.add.reduceat(sums, starts) / _norms(ends - starts) + bias


def features(words: list[np.ndarray]):
    """Sparse kernel features of units: (unit, triple, value), normalised."""
    codes = np.concatenate([np.append(w, 0) for w in words]).astype(np.uint8)
    unit = np.cumsum(codes == 0)
    scale = 1 / _norms(np.array([len(w) for w in words]))
    parts = [(unit[at], triple, np.full(len(at), weight) * scale[unit[at]]) for at, triple, weight in _occurrences(codes)]
    return [np.concatenate(x) for x in zip(*parts)]


def _against(words: list[np.ndarray], landmarks: np.ndarray) -> np.ndarray:
    """Kernel of units with landmarks (triples x landmarks, dense)."""
    out = np.zeros((len(words), landmarks.shape[1]), np.float32)
    touched = _touched(landmarks)
    for low in range(0, len(words), 4096):
        unit, triple, value = features(words[low: low + 4096])
        hit = touched[triple]
        unit, triple, value = unit[hit], triple[hit], value[hit]
        if len(unit):
            order = np.argsort(unit, kind="stable")
            unit, triple, value = unit[order], triple[order], value[order].astype(np.float32)
            heads = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
            out[unit[heads] + low] = np.add.reduceat(landmarks[triple] * value[:, None], heads, axis=0)
    return out


def _touched(landmarks: np.ndarray) -> np.ndarray:
    return landmarks.any(axis=1)


def _svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM, squared hinge loss, by Newton steps."""
    x = np.hstack([z, np.ones((len(z), 1), z.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(15):
        active = y * (x @ w) < 1
        xa, ca = x[active], cost[active]
        new = np.linalg.solve(ridge + (xa * ca[:, None]).T @ xa, xa.T @ (ca * y[active]))
        done = np.abs(new - w).max() < 1e-6
        w = new if done else w + 0.8 * (new - w)
        if done:
            break
    return w[:-1], float(w[-1])


class ToxicityModel:
    """Folded SVM and the calibration of document margins."""

    def __init__(self, weights: np.ndarray, bias: float, logistic: np.ndarray):
        self.weights, self.bias, self.logistic = weights.astype(np.float32), bias, logistic

    def facts(self, text: str, table: np.ndarray) -> list[float]:
        """Highest margin, mass of positive margins and size of a whole text."""
        best, mass, units = -3.0, 0.0, 0
        for low in range(0, len(text), CHUNK_CHARS):
            m = unit_margins(unit_codes(text[low: low + CHUNK_CHARS], table), self.weights, self.bias)
            if len(m):
                best = max(best, float(m.max()))
                mass += float(np.maximum(m, 0).sum())
                units += len(m)
        return [min(best, 3.0), np.log1p(mass), np.log1p(units), 1.0]

    def score(self, texts: list, table: np.ndarray) -> list[float]:
        return [float(1 / (1 + np.exp(-np.clip(np.dot(self.facts(t or "", table), self.logistic), -30, 30)))) for t in texts]


def fit(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Fit on labelled documents.  With labels of one kind only, every text
    gets that kind's share; without rows, one half."""
    table = letter_classes()
    table[0] = END[0]                       # two of these stand for a sentence's end
    positive = sum(labels)
    if positive == 0 or positive == len(labels):
        share = (positive + 1) / (len(labels) + 2)
        return ToxicityModel(np.zeros(CLASSES ** 3), 0.0, np.array([0, 0, 0, np.log(share / (1 - share))]))
    # Sentences as lists of units; units are kept as bytes of their classes.
    sentences, owner = [], []
    for k, text in enumerate(texts):
        marked = re.sub(r"[.!?\n]+(?=\s|$)", " \0\0 ", text.replace("\0", " "))
        units = []
        for u in [*unit_codes(marked, table).tobytes().split(b"\0"), END]:
            if u != END:
                units += [u] if len(u) >= 3 else []
            elif units:
                sentences.append(units)
                owner.append(k)
                units = []
    toxic = [bool(labels[k]) for k in owner]
    seen: dict[bool, dict[bytes, set]] = {True: {}, False: {}}
    for units, k, t in zip(sentences, owner, toxic):
        for u in units:
            seen[t].setdefault(u, set()).add(k)
    clean = {u: len(v) for u, v in seen[False].items()}
    guess = {u: len(v) for u, v in seen[True].items()}
    rate = positive / len(labels)

    def excess(u):                          # standard deviations beyond chance
        n = guess[u] + clean.get(u, 0)
        return (guess[u] - rate * n) / np.sqrt(rate * (1 - rate) * n)

    first = sorted((u for u in guess if guess[u] >= MIN_SUPPORT and excess(u) > 4), key=lambda u: (-excess(u), u))
    if not first:
        first = sorted(guess, key=lambda u: (-excess(u), u))[:8]
    common = sorted(clean, key=lambda u: (-clean[u], u))
    picked = first[: LANDMARKS // 2]
    rest = common[: LANDMARKS // 4]
    rest += common[LANDMARKS // 4:: max(1, len(common) // (LANDMARKS // 4))]
    picked += [u for u in rest if u not in set(picked)][: LANDMARKS - len(picked)]
    as_codes = lambda us: [np.frombuffer(u, np.uint8) for u in us]
    unit, triple, value = features(as_codes(picked))
    landmarks = np.zeros((CLASSES ** 3, len(picked)), np.float32)
    np.add.at(landmarks, (triple, unit), value)
    inner = (landmarks[_touched(landmarks)].T @ landmarks[_touched(landmarks)]).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T

    def folded(w):                          # weight of a triple in the landmark expansion
        return landmarks @ (root @ w).astype(np.float32)

    # Clean sentences: every unit is clean.  Toxic ones: first the units that
    # stand out, then the highest unit of a sentence if it is positive, and the
    # highest of the document at least.
    negatives = common[:NEGATIVES] + common[NEGATIVES:: max(1, len(common) // NEGATIVES)]
    negatives = list(dict.fromkeys(negatives))
    z_neg = _against(as_codes(negatives), landmarks) @ root.astype(np.float32)
    sure = Counter(u for units, t in zip(sentences, toxic) if t for u in set(units) & set(first))
    chosen = sure
    weights, bias = np.zeros(CLASSES ** 3), 0.0
    for _ in range(ROUNDS):
        names = sorted(chosen)
        z = np.vstack([_against(as_codes(names), landmarks) @ root.astype(np.float32), z_neg])
        y = np.concatenate((np.ones(len(names)), -np.ones(len(negatives))))
        heavy = np.array([chosen[u] for u in names], float)
        light = np.sqrt([clean[u] for u in negatives])
        cost = PENALTY * np.concatenate((np.sqrt(heavy), light))
        w, bias = _svm(z, y, cost)
        weights = folded(w)
        every = sorted(guess)
        margin = dict(zip(every, unit_margins(np.concatenate([np.append(np.frombuffer(u, np.uint8), 0) for u in every])
                                              .astype(np.uint8), weights, bias)))
        chosen = Counter()
        for units, t in zip(sentences, toxic):
            if t:
                best = max(units, key=lambda u: (margin[u], u))
                # A unit that clean documents hold as often is no witness.
                if margin[best] > 0 and excess(best) > 2:
                    chosen[best] += 1
        chosen |= sure
    table[0] = 255
    model = ToxicityModel(weights, bias, np.zeros(4))
    x = np.array([model.facts(t, table) for t in texts])
    y = np.array(labels, float)
    w = np.zeros(4)
    for _ in range(50):                     # Newton steps of the logistic loss
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(4), x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.logistic = w
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", learn=None) -> ToxicityModel:
    """Fit on a bounded sample of the labelled documents for which ``learn``
    (a condition on the id) holds; null labels and texts are left out, and of
    labels that repeat an id the largest counts."""
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("_label"))
    rows = docs.select(id_col, F.col(text_col).alias("_text")).filter(F.length("_text") <= SAMPLE_CHARS)
    rows = rows.join(known if learn is None else known.filter(learn), id_col)
    picked = sorted((r["_text"], int(r["_label"] > 0)) for r in bounded_sample(rows, id_col, SAMPLE))
    return fit([t for t, _ in picked], [y for _, y in picked])


def predict(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score",
            pred_col: str = "predicted") -> DataFrame:
    """``docs`` with the probability and the decision (score >= 0.5) of every
    row; null and empty texts get the score of a text without words.  Columns
    of these two names are replaced, all others pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # CLASSES**3 weights

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = letter_classes()
        for texts in batches:
            yield pd.Series(shared.value.score(texts.tolist(), table), dtype="float64")

    rows = docs.drop(*[c for c in (score_col, pred_col) if c in docs.columns]).withColumn(score_col, scored(F.col(text_col)))
    return rows.withColumn(pred_col, (F.col(score_col) >= 0.5).cast("int"))
