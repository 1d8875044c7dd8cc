"""Language identification (operator 4).

Sparse multinomial logistic regression on TF-IDF character n-grams (n = 1..3,
words lower-cased and set between spaces, anything but letters is a space).
Terms are hashed to ``2**BITS`` columns; the term frequency is a share of the
text, so a text's logits are the mean over its n-grams of ``idf * weights`` --
one table look-up per n-gram, for texts of any length.  The weights are learned
by follow-the-regularised-leader (FTRL-proximal) with an elastic net, which
leaves the weights of uninformative columns at exactly zero; a temperature
fitted on labelled rows kept out of the learning calibrates the probabilities.

Fitting reads about ``SAMPLE`` labelled texts, chosen by a hash of their ids
among those of at most ``SAMPLE_CHARS`` characters; texts to be classified are
read whole, whatever their length.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import bounded_sample

BITS = 16
SAMPLE = 6000                   # labelled texts learned from, at most
SAMPLE_CHARS = 20_000           # longer texts are not learned from
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.001
SCALE = 30.0                    # brings mean idf-weighted terms to unit size
CALIBRATION = 5                 # every so many-th sampled text fits the temperature
CHUNK_CHARS = 1_000_000
UNKNOWN = "und"
_U32 = np.uint32


def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter code, 32 for all that is no letter."""
    table = np.full(0x110000, 32, _U32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _codes(text: str, table: np.ndarray) -> np.ndarray:
    """Letters and single spaces of ``text``, with a space at either end."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), _U32)
    codes = np.concatenate(([32], table[raw], [32])).astype(_U32)
    return codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]


def _terms(codes: np.ndarray) -> np.ndarray:
    """Hashed 1-, 2- and 3-grams of a code sequence."""
    mask = _U32((1 << BITS) - 1)
    one = codes * _U32(0x9E3779B1)
    two = (one[:-1] ^ (codes[1:] * _U32(0x85EBCA77))) * _U32(0xC2B2AE3D)
    three = (two[:-1] ^ (codes[2:] * _U32(0x27D4EB2F))) * _U32(0x165667B1)
    return np.concatenate([(g ^ (g >> _U32(15))) >> _U32(7) & mask for g in (one, two, three)])


class LanguageModel:
    def __init__(self, langs: list[str], weights: np.ndarray, temperature: float):
        self.langs, self.weights, self.temperature = langs, weights, temperature

    def logits(self, text: str, table: np.ndarray) -> tuple[np.ndarray, bool]:
        """Mean term weights of a whole text, in pieces of bounded size, and
        whether it has a letter."""
        total, count, letter = np.zeros(len(self.langs)), 0, False
        for k in range(0, max(len(text), 1), CHUNK_CHARS):
            codes = _codes(text[k: k + CHUNK_CHARS], table)
            letter = letter or bool((codes != 32).any())
            terms = _terms(codes)
            total += self.weights[terms].sum(axis=0, dtype=np.float64)
            count += len(terms)
        return total / max(count, 1), letter

    def predict(self, texts: list, table: np.ndarray) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for text in texts:
            z, letter = self.logits(text or "", table)
            if not letter:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            p = np.exp((z - z.max()) / self.temperature)
            names.append(self.langs[int(p.argmax())])
            scores.append(float(p.max() / p.sum()))
        return names, scores


def fit(texts: list[str], langs: list[str]) -> LanguageModel:
    """Fit on labelled texts.  One language only: always that one; none: no
    text can be named and the model is empty."""
    names = sorted(set(langs))
    table = _letter_table()
    dim, k = 1 << BITS, len(names)
    if k < 2:
        return LanguageModel(names or [UNKNOWN], np.zeros((dim, max(k, 1)), np.float32), 1.0)
    rows = []
    for text, lang in zip(texts, langs):
        terms = _terms(_codes(text, table))
        ids, counts = np.unique(terms, return_counts=True)
        rows.append((ids, counts / counts.sum(), names.index(lang)))
    held, learn = rows[::CALIBRATION], [r for i, r in enumerate(rows) if i % CALIBRATION] or rows
    df = np.zeros(dim)
    for ids, _, _ in learn:
        df[ids] += 1
    idf = np.log((1 + len(learn)) / (1 + df)) + 1
    z, n = np.zeros((dim, k)), np.zeros((dim, k))
    for _ in range(EPOCHS):
        for ids, tf, y in learn:
            x = (tf * idf[ids] * SCALE)[:, None]
            zi, ni = z[ids], n[ids]
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            s = (x * w).sum(axis=0)
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x * p
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[ids] = zi + g - step * w
            n[ids] = ni + g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    weights = (w * idf[:, None] * SCALE).astype(np.float32)
    logits = np.array([(tf[:, None] * weights[ids]).sum(axis=0) for ids, tf, _ in held])
    truth = np.array([y for _, _, y in held])

    def loss(t: float) -> float:
        s = logits / t
        s -= s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(truth)), truth]).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 200))
    return LanguageModel(names, weights, float(grid[int(np.argmin([loss(t) for t in grid]))]))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          learn=None) -> LanguageModel:
    """Fit on a bounded sample of the rows of ``docs`` for which ``learn`` (a
    condition) holds and text and language are not null."""
    rows = docs if learn is None else docs.filter(learn)
    rows = rows.filter(F.col(lang_col).isNotNull() & (F.length(text_col) <= SAMPLE_CHARS))
    picked = bounded_sample(rows.select(F.col(id_col), F.col(text_col).alias("t"), F.col(lang_col).alias("l")), id_col, SAMPLE)
    picked = sorted((r["t"], r["l"]) for r in picked)
    random.Random(4).shuffle(picked)
    return fit([t for t, _ in picked], [lang for _, lang in picked])


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text",
            pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability for every row.

    Null texts and texts without a letter are ``und`` with score 0.  Ties go
    to the first language in order.  Columns of these two names are replaced,
    all others pass through; an empty table gives an empty frame.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)    # 2**BITS x languages floats

    @F.pandas_udf("lang string, score double")
    def named(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = _letter_table()
        for texts in batches:
            names, scores = shared.value.predict(texts.tolist(), table)
            yield pd.DataFrame({"lang": names, "score": scores})

    rows = docs.drop(*[c for c in (pred_col, score_col) if c in docs.columns])
    # A later filter on the result would be pushed below the call and make it
    # twice, in two Python workers a task; one that counts as not deterministic
    # is made once and filtered afterwards.
    rows = rows.withColumn("_named", named.asNondeterministic()(F.col(text_col)))
    return rows.select(*[c for c in rows.columns if c != "_named"],
                       F.col("_named.lang").alias(pred_col), F.col("_named.score").alias(score_col))
