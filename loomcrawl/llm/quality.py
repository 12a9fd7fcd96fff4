"""Quality rules: hashed word and character n-grams in a calibrated logistic regression.

Base rules come first and are exact. Every document that passes them is judged by a model fitted on
labelled rows: the document's score is an intercept plus the mean weight of its word n-grams plus the
mean weight of its character n-grams (code points), over the whole text. A Platt scaling fitted on
rows the weights have not seen turns the score into a probability, and a fixed threshold decides.

The model is fitted on at most `max_labelled` labelled documents (those with the smallest hashes of
their ids, so reruns agree); everything else covers all rows. Fitting gets counts of n-grams from the
executors, not texts. Without labels of both kinds there is no model and the base rules alone decide.

A null text has no words and fails the base rules. Labels with a null id or value are not used; an id
that has several labels counts once, with the smallest, and one with several rows in docs with the least of
its texts. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .hashing import words

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

VERDICT = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,base_failed:boolean,probability:double,kept:boolean>"
#: Bytes of text whose characters are hashed together.
_PART = 1 << 20
#: An odd multiplier for each place of an n-gram.
_STEP, _M = 0xFF51AFD7ED558CCD, np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class QualityParams:
    #: Labelled documents that the model is fitted on, at most.
    max_labelled: int = 3000
    bits: int = 17
    word_n: int = 2
    char_n: int = 4
    #: Share of the labelled documents that calibrates only.
    held_out: float = 0.2
    threshold: float = 0.5
    steps: int = 150
    penalty: float = 1e-4


@dataclass(frozen=True)
class QualityModel:
    params: QualityParams
    weights: np.ndarray
    #: probability = 1 / (1 + exp(-(slope * score + shift)))
    slope: float
    shift: float

    def probability(self, score: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -500, 500))))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text in UTF-8."""
    found = text.split()  # at the six ASCII white-space bytes
    chars = sum(map(len, found)) - (0 if text.isascii() else _continuation_bytes(text))
    symbols = sum(text.count(s) for s in (bytes([c]) for c in SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeat = 0
    if len(found) > WINDOW:
        ids: dict[bytes, int] = {}
        at = np.array([ids.setdefault(w, len(ids)) for w in found], np.int64)
        n = len(ids)
        _, pair = (at[:-1], at[1:]) if n < 2 else np.unique(at[:-1] * n + at[1:], return_inverse=True)
        _, inverse, count = np.unique(pair[:-1] * np.int64(n) + at[2:], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[inverse] > 1)
        marked = np.zeros(len(found), bool)
        for k in range(WINDOW):
            marked[twice + k] = True
        repeat = int(marked.sum())
    return len(found), chars, symbols, len(lines) - len(set(lines)), repeat


def _continuation_bytes(text: bytes) -> int:
    return int(((np.frombuffer(text, np.uint8) & 0xC0) == 0x80).sum())


def _buckets(h: np.ndarray, bits: int) -> np.ndarray:
    h = h * _M
    return ((h ^ (h >> np.uint64(32))) * _M >> np.uint64(64 - bits)).astype(np.int64)


def _joined(x: np.ndarray, n: int) -> np.ndarray:
    """A number for each n neighbours."""
    count = max(0, len(x) - n + 1)
    return sum((x[k : k + count] * np.uint64(pow(_STEP, k + 1, 1 << 64)) for k in range(n)), np.zeros(count, np.uint64))


def ngrams(text: bytes, p: QualityParams) -> Iterator[tuple[int, np.ndarray]]:
    """(0, buckets of word 1- to word_n-grams) and (1, buckets of character n-grams) of a whole text in UTF-8, in parts."""
    word = words(text)[0]
    for n in range(1, p.word_n + 1):
        for k in range(0, len(word), _PART):  # grams that begin in a part
            yield 0, _buckets(_joined(word[k : k + _PART + n - 1], n), p.bits)
    before = ""
    at = 0
    while at < len(text):
        stop = min(len(text), at + _PART)
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop += 1  # no code point is cut
        part = before + text[at:stop].decode()
        points = np.frombuffer(part.encode("utf-32-le"), np.uint32).astype(np.uint64)
        yield 1, _buckets(_joined(points + np.uint64(1), p.char_n), p.bits)
        before, at = part[len(part) - min(len(part), p.char_n - 1) :], stop


def score(text: bytes, model: QualityModel) -> float:
    """Mean weight of the word n-grams plus mean weight of the character n-grams."""
    size = 1 << model.params.bits
    sums, n = [0.0, 0.0], [0, 0]
    for k, at in ngrams(text, model.params):
        sums[k] += float(model.weights[k * size : (k + 1) * size][at].sum())
        n[k] += len(at)
    return sum(s / max(1, m) for s, m in zip(sums, n))


#: Mean counts are small; this brings rows to about unit length, for a good step size.
_SCALE = 30.0


def _features(p: QualityParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << p.bits
        for b in batches:
            at, value = [], []
            for t in b.column(2).cast(pa.binary()):
                total = [np.zeros(size), np.zeros(size)]
                for k, grams in ngrams(t.as_py() or b"", p):
                    total[k] += np.bincount(grams, minlength=size)
                x = np.concatenate([c / max(1.0, c.sum()) for c in total])
                on = np.flatnonzero(x)
                at.append(on.astype(np.int32))
                value.append((x[on] * _SCALE).astype(np.float32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], ["held", "y", "at", "value"])

    return run


def _fit_weights(at: np.ndarray, value: np.ndarray, starts: np.ndarray, sizes: np.ndarray, y: np.ndarray, p: QualityParams) -> tuple[np.ndarray, float]:
    """Penalised logistic regression by Nesterov's accelerated gradient."""
    dim, of = 2 << p.bits, np.repeat(np.arange(len(y)), sizes)
    step = 4.0 / max(1e-9, float((np.bincount(of, weights=value.astype(float) ** 2).max()) + 1))
    w, v = np.zeros(dim + 1), np.zeros(dim + 1)
    for k in range(p.steps):
        look = w + (k / (k + 3)) * v
        z = np.bincount(of, weights=look[at] * value, minlength=len(y)) + look[dim]
        gap = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        g = np.concatenate([np.bincount(at, weights=value * gap[of], minlength=dim), [gap.sum()]]) / len(y)
        new = look - step * (g + p.penalty * look)
        w, v = new, new - w
    return w[:dim], float(w[dim])


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the scores, by damped Newton steps on smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        g, r = q - target, q * (1 - q) + 1e-6
        h = np.array([[(r * z * z).sum() + 1e-3, (r * z).sum()], [(r * z).sum(), r.sum() + 1e-3]])
        da, db = np.linalg.solve(h, np.array([(g * z).sum() + 1e-3 * (a - 1), g.sum()]))
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> QualityModel | None:
    """A model of label = 1 against 0, or None without labels of both kinds."""
    by_hash = F.xxhash64(F.col("of"), F.lit(7))
    chosen = labels.select(F.col(doc_id).alias("of"), F.col(label).cast("int").alias("y")).where("of is not null and y in (0, 1)").groupBy("of").agg(F.min("y").alias("y")).orderBy(by_hash, "of").limit(params.max_labelled)
    held = F.pmod(F.xxhash64("of", F.lit(11)), F.lit(1000)) < int(1000 * params.held_out)
    # at most max_labelled rows of two numbers: sent to all, so that no other text is moved; one text of each id is taken
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
    rows = rows.groupBy("of", "y").agg(F.min("text").alias("text")).select(held.alias("held"), "y", "text")
    with small_batches(docs.sparkSession):
        got = rows.mapInArrow(_features(params), "held boolean, y int, at array<int>, value array<float>").toArrow().combine_chunks()
    if not got.num_rows:
        return None
    held, y = got["held"].to_numpy(), got["y"].to_numpy().astype(float)
    at, value = [np.asarray(x.values) for x in got["at"]], [np.asarray(x.values) for x in got["value"]]
    if not 0 < y[~held].mean() < 1:
        return None

    def stacked(mask: np.ndarray):
        i = np.flatnonzero(mask)
        sizes = np.array([len(at[k]) for k in i])
        return np.concatenate([at[k] for k in i]), np.concatenate([value[k] for k in i]), np.cumsum(sizes) - sizes, sizes, y[i]

    w, shift = _fit_weights(*stacked(~held), params)
    slope, over = 1.0, 0.0
    if held.any() and 0 < y[held].mean() < 1:
        a, v, _, sizes, truth = stacked(held)
        z = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=w[a] * v, minlength=len(sizes)) + shift
        slope, over = _platt(z, truth)
    return QualityModel(params, (w * _SCALE).astype(np.float32), slope, slope * shift + over)


def verdict(model: QualityModel | None, docs: DataFrame):
    """An Arrow UDF: text -> the struct VERDICT."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(VERDICT)
    def judge(texts: pa.Array) -> pa.Array:
        model, rows = told.value, []
        for t in texts.cast(pa.binary()):
            text = t.as_py() or b""
            n, chars, symbols, dup, repeat = base_counts(text)
            failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
            prob = None if model is None else model.probability(score(text, model))
            rows.append((n, chars, symbols, dup, repeat, failed, prob, not failed and (prob is None or prob >= model.params.threshold)))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names)

    return judge


def judged(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), text: str = "text") -> Column:
    return verdict(fit(docs, labels, params, text), docs)(F.col(text))


def keep_good(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), text: str = "text") -> DataFrame:
    """The rows of docs that are kept, with all their columns; nothing is shuffled."""
    return docs.where(judged(docs, labels, params, text)["kept"])


def quality_report(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id and the fields of VERDICT, one row per row of docs."""
    return docs.select("doc_id", judged(docs, labels, params).alias("v")).select("doc_id", "v.*")
