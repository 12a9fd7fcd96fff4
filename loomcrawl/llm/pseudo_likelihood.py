"""Language-model scores by masked pseudo-likelihood.

A bidirectional window network predicts every token of a document from the tokens on both sides of
it, the token itself masked; the sum of the conditional log-probabilities is the document's score.

The network, in numpy: the `side` tokens before and after are embedded, each place with a table of
its own, and summed into a hidden layer (tanh); an id's probability is that of its class times that of
its place in the class, two small softmaxes, so each token costs 2 * sqrt(vocabulary) outputs.
Tokens are words: the most frequent of the corpus have an id of their own, the others share hashed ids;
edges of a document are a token of their own. A word that shares an id has the id's probability times
its own among the words of that id, from its count in the corpus, smoothed: every word of the corpus is
predicted as itself. Being masked, a token is not in the counts that predict it.

Everything is learnt from all documents. Counts of words are a table that grows with the corpus; it is
never gathered, but joined with the distinct words of each block of documents, some numbers per word and
block, and the blocks' texts are not moved for that. Documents are dealt, as ids of two bytes a token, to shards by a
hash of their id and text, as many as the corpus has `shard` tokens; a network is trained on each shard, in the order of
the hashes and from the same start, and the networks are averaged weight by weight, in a shuffle; `rounds` such rounds
follow one another. So scores do not depend on how docs is partitioned, but for the rounding of sums. A larger corpus averages more
networks. The driver holds the hashes of the frequent words, one network and two numbers per shared id,
all of fixed size, as the cost of a token grows with them.

A null text and a text without words have no tokens: score 0 and a null mean. An empty table gives an
empty result; without any word the network stays as it starts. Rows that share a doc_id are documents
of their own. With a model of another corpus, a word that corpus lacks has the probability of one more word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered_texts, saved, small_batches
from .hashing import mix, words


@dataclass(frozen=True)
class LmParams:
    #: Ids are classes * classes: one for edges, `hashed` shared ones, the others for frequent words.
    classes: int = 32
    hashed: int = 128
    side: int = 2
    dim: int = 16
    rate: float = 0.1
    #: Tokens of a training step.
    step: int = 4096
    rounds: int = 1
    seed: int = 5
    #: Added to each word's count among those that share its id.
    smooth: float = 0.1
    #: Documents whose distinct words are looked up together at most, a power of two; a block also ends after some MB.
    block: int = 4096
    #: Tokens that a network is trained on, about.
    shard: int = 2_000_000

    @property
    def vocabulary(self) -> int:
        return self.classes * self.classes


class Network:
    """Weights: embed (place, id, dim), bias (dim), outer (dim + 1, classes), inner (classes, dim + 1, classes)."""

    def __init__(self, p: LmParams, flat: np.ndarray | None = None):
        self.p = p
        shapes = [(2 * p.side, p.vocabulary, p.dim), (p.dim,), (p.dim + 1, p.classes), (p.classes, p.dim + 1, p.classes)]
        size = sum(int(np.prod(s)) for s in shapes)
        if flat is None:
            flat = np.random.default_rng(p.seed).normal(0, 0.1, size)
        self.flat = np.array(flat, np.float32)
        at, self.parts = 0, []
        for s in shapes:
            n = int(np.prod(s))
            self.parts.append(self.flat[at : at + n].reshape(s))
            at += n

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """tanh of the summed embeddings, with a 1 at the end; context: (tokens, 2 * side)."""
        embed, bias = self.parts[0], self.parts[1]
        h = np.tanh(sum(embed[k][context[:, k]] for k in range(2 * self.p.side)) + bias)
        return np.concatenate([h, np.ones((len(h), 1), np.float32)], 1)

    @staticmethod
    def _log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Each row's log-softmax at one place."""
        top = z.max(1)
        own = z[np.arange(len(z)), at] - top
        z -= top[:, None]
        return own - np.log(np.exp(z, out=z).sum(1))

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        return z

    def _by_class(self, c: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order, ends = _grouped(c, self.p.classes)
        for k in np.flatnonzero(np.diff(ends)).tolist():
            yield k, order[ends[k] : ends[k + 1]]

    def log_probability(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        c, m = token // self.p.classes, token % self.p.classes
        h = self.hidden(context)
        out = self._log_softmax_at(h @ self.parts[2], c).astype(np.float64)
        for k, at in self._by_class(c):
            out[at] += self._log_softmax_at(h[at] @ self.parts[3][k], m[at])
        return out

    def gradient(self, context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the mean negative log-probability, but for the embeddings: theirs by hidden row, outer, inner, and bias."""
        c, m, n = token // self.p.classes, token % self.p.classes, len(token)
        h = self.hidden(context)
        d = self._softmax(h @ self.parts[2])
        d[np.arange(n), c] -= 1
        g_outer, back = h.T @ d, d @ self.parts[2].T
        g_inner = np.zeros_like(self.parts[3])
        for k, at in self._by_class(c):
            e = self._softmax(h[at] @ self.parts[3][k])
            e[np.arange(len(at)), m[at]] -= 1
            g_inner[k] = h[at].T @ e
            back[at] += e @ self.parts[3][k].T
        back = back[:, :-1] * (1 - h[:, :-1] ** 2) / n
        return back, g_outer / n, g_inner / n, back.sum(0)

    def train(self, context: np.ndarray, token: np.ndarray, squares: np.ndarray) -> None:
        """One Adagrad step; squares: sums of squared gradients so far, shaped like flat."""
        back, g_outer, g_inner, g_bias = self.gradient(context, token)
        sums = _views(squares, self.parts)
        for k, g in ((1, g_bias), (2, g_outer), (3, g_inner)):
            sums[k] += g * g
            self.parts[k] -= self.p.rate * g / np.sqrt(sums[k] + 1e-8)
        for k in range(2 * self.p.side):
            order, ends = _grouped(context[:, k], self.p.vocabulary)
            ids = np.flatnonzero(np.diff(ends))
            g = np.add.reduceat(back[order], ends[ids], axis=0)
            sums[0][k][ids] += g * g
            self.parts[0][k][ids] -= self.p.rate * g / np.sqrt(sums[0][k][ids] + 1e-8)


def _grouped(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal numbers below n together, and where each number begins in it; short integers take a radix sort."""
    order = np.argsort(x.astype(np.uint16) if n <= 1 << 16 else x, kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(x, minlength=n))))


def _views(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    at, out = 0, []
    for x in like:
        out.append(flat[at : at + x.size].reshape(x.shape))
        at += x.size
    return out


class Vocabulary:
    """Word hashes to ids: 0 for edges, 1 to `hashed` by hash, above that the frequent words by rank."""

    def __init__(self, frequent: np.ndarray, p: LmParams):
        order = np.argsort(frequent)
        self.known, self.rank, self.p = frequent[order], order + 1 + p.hashed, p

    def ids(self, h: np.ndarray) -> np.ndarray:
        other = 1 + ((h >> np.uint64(1)) % np.uint64(self.p.hashed)).astype(np.int64)
        if not len(self.known):
            return other
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.rank[at], other)


@dataclass(frozen=True)
class LmModel:
    vocabulary: Vocabulary
    network: Network
    #: (word, n): every word of the corpus and how often it occurs; never gathered.
    counts: DataFrame
    #: Of each shared id, from 1 on: occurrences and distinct words.
    shared: np.ndarray
    #: Count and hash of the last frequent word; words after it share ids. None without any word.
    last: tuple[int, int] | None = None


def _shares_id(last: tuple[int, int] | None) -> Column:
    """Whether the word of a row (word, n) comes after the last frequent one."""
    if last is None:
        return F.lit(False)
    return (F.col("n") < last[0]) | (F.col("n") == last[0]) & (F.col("word") > last[1])


def windows(ids: np.ndarray, side: int) -> np.ndarray:
    """(tokens, 2 * side): the ids before, from the farthest, and after each token; 0 beyond the edges."""
    padded = np.concatenate([np.zeros(side, ids.dtype), ids, np.zeros(side, ids.dtype)])
    n = len(ids)
    return np.stack([padded[k : k + n] for k in (*range(side), *range(side + 1, 2 * side + 1))], 1)


def _text_hashes(batch: pa.Array) -> Iterator[np.ndarray]:
    for t in batch.cast(pa.binary()):
        yield mix(words((t.as_py() or b"").lower())[0])


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word, n): the distinct words of each block of texts, whose rows come together."""
    now, held = None, []

    def close() -> pa.RecordBatch:
        word, of = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        n = np.bincount(of, weights=np.concatenate([n for _, n in held]), minlength=len(word)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(word), now)), pa.array(word.view(np.int64)), pa.array(n)], ["block", "word", "n"])

    for b in batches:
        block = b.column(0).to_numpy()
        ends = [*np.flatnonzero(np.diff(block)) + 1, len(block)] if len(block) else []
        at = 0
        for end in ends:
            if now is not None and block[at] != now:
                yield close()
                held = []
            now = block[at]
            for k in range(at, end, 256):
                held.append(np.unique(np.concatenate(list(_text_hashes(b.column(1).slice(k, min(256, end - k))))), return_counts=True))
            at = end
    if now is not None:
        yield close()


def block_words(rows: DataFrame) -> DataFrame:
    """(block, word, n): each block's distinct words (rows: block, text), and how often they are in it."""
    return saved(rows.select("block", "text").mapInArrow(_block_words, "block long, word long, n long"), "block-words")


def word_table(found: DataFrame, p: LmParams) -> LmModel:
    """From the words of blocks: the vocabulary (ties by hash), all words' counts and the totals of the shared ids, with a network that knows nothing."""
    counts = saved(found.groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(p.vocabulary - 1 - p.hashed).collect()  # a fixed number
    vocab = Vocabulary(np.array([r.word for r in top], np.int64).view(np.uint64), p)
    shared, last = np.zeros((p.hashed + 1, 2)), (top[-1].n, top[-1].word) if top else None
    id_of = (F.shiftrightunsigned("word", 1) % p.hashed + 1).alias("id")
    for r in counts.where(_shares_id(last)).groupBy(id_of).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():  # a row per shared id
        shared[r.id] = r.n, r.words
    return LmModel(vocab, Network(p), counts, shared, last)


def _rows(docs: DataFrame, p: LmParams, text: str, doc_id: str) -> DataFrame:
    """(row, block, doc_id, text) of a written table whose blocks stay together."""
    return numbered_texts(docs, "lm-rows", {"doc_id": F.col(doc_id).cast("long"), "text": F.col(text)}, p.block.bit_length() - 1)


def fit(docs: DataFrame, params: LmParams = LmParams(), text: str = "text", doc_id: str = "doc_id") -> LmModel:
    """A model of all rows of docs."""
    rows = _rows(docs, params, text, doc_id)
    return _fitted(rows, block_words(rows), params)


def sharded(rows: DataFrame, vocab: Vocabulary, tokens: int, p: LmParams) -> DataFrame:
    """(shard, key, ids): the ids of each text with words, as little-endian numbers of two bytes (four in a large vocabulary), by shard and key."""
    shards, kind = max(1, -(-tokens // p.shard)), "<u2" if p.vocabulary <= 1 << 16 else "<u4"
    told = rows.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [told.value.ids(h).astype(kind).tobytes() for h in _text_hashes(b.column(1))]
            out = pa.RecordBatch.from_arrays([pc.cast(pc.bit_wise_and(b.column(0), (1 << 62) - 1), pa.int64()), pa.array(ids, pa.binary())], ["key", "ids"])
            yield out.filter(pc.greater(pc.binary_length(out.column(1)), 0))

    found = rows.select(F.xxhash64("doc_id", "text").alias("key"), "text").mapInArrow(run, "key long, ids binary")
    return found.select((F.col("key") % shards).cast("int").alias("shard"), "key", "ids").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "key")


def _fitted(rows: DataFrame, found: DataFrame, p: LmParams) -> LmModel:
    sc = rows.sparkSession.sparkContext
    model = word_table(found, p)
    net = model.network
    tokens = model.counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = sharded(rows, model.vocabulary, tokens, p)
    shards = saved(shards, "lm-shards") if p.rounds > 1 else shards
    kind = "<u2" if p.vocabulary <= 1 << 16 else "<u4"
    for _ in range(p.rounds):
        told = sc.broadcast(net.flat)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, net, squares = None, None, None
            contexts, held, seen = [], 0, 0

            def steps(last: bool) -> None:
                nonlocal contexts, held
                context, token = (np.concatenate(x) for x in zip(*contexts))
                stop = len(token) if last else len(token) - len(token) % p.step
                for k in range(0, stop, p.step):
                    net.train(context[k : min(stop, k + p.step)], token[k : min(stop, k + p.step)], squares)
                contexts, held = [(context[stop:], token[stop:])], len(token) - stop

            def done() -> pa.RecordBatch:
                if held:
                    steps(True)
                return pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([net.flat.astype(np.float64) * seen], pa.list_(pa.float64()))], ["seen", "weights"])

            for b in batches:
                for shard, data in zip(b.column(0).to_pylist(), b.column(1)):
                    if shard != now:
                        if seen:
                            yield done()
                        now, net, squares = shard, Network(p, told.value), np.full(len(told.value), 0.01, np.float32)
                        contexts, held, seen = [], 0, 0
                    ids = np.frombuffer(data.as_buffer(), kind).astype(np.int64)
                    contexts.append((windows(ids, p.side), ids))
                    held, seen = held + len(ids), seen + len(ids)
                    if held >= 16 * p.step:
                        steps(False)
            if seen:
                yield done()

        trained = shards.select("shard", "ids").mapInArrow(run, "seen long, weights array<double>")
        # every weight is summed on its own, as rows arrive: no task holds the networks of all tasks
        mean = trained.select("seen", F.posexplode("weights").alias("at", "w")).groupBy("at").agg((F.sum("w") / F.sum("seen")).alias("w"))
        with small_batches(rows.sparkSession):
            got = mean.toArrow()  # one network
        if got.num_rows:
            flat = np.zeros(len(net.flat), np.float64)
            flat[got["at"].to_numpy()] = got["w"].to_numpy()
            net = Network(p, flat)
    return replace(model, network=net)


#: Tokens scored at once, of one long text or many short ones.
TOGETHER = 1 << 15


def own_log_probability(n: np.ndarray, ids: np.ndarray, shared: np.ndarray, smooth: float, masked: bool) -> np.ndarray:
    """Of words that occur n times, among those that share their ids; with `masked` one occurrence is the token itself."""
    total, words = shared[ids, 0], shared[ids, 1]
    if masked:
        return np.log(n - 1 + smooth) - np.log(total - 1 + smooth * words)
    return np.log(n + smooth) - np.log(total + smooth * (words + 1))


def score_texts(texts: list[np.ndarray], model: LmModel, known: np.ndarray, n: np.ndarray, masked: bool) -> list[float]:
    """For each text (its word hashes): the sum of the log-probabilities of its tokens, given their neighbours.

    known: sorted hashes of the words that share ids, as far as the corpus has them, and n their counts.
    """
    net = model.network
    ids = [model.vocabulary.ids(h) for h in texts]
    of = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    total = np.zeros(len(ids))
    if len(of):
        context, token, h = np.concatenate([windows(x, net.p.side) for x in ids]), np.concatenate(ids), np.concatenate(texts)
        for k in range(0, len(of), TOGETHER):
            part = slice(k, k + TOGETHER)
            out = net.log_probability(context[part], token[part])
            rare = np.flatnonzero(token[part] <= net.p.hashed)
            if len(rare):
                count = np.zeros(len(rare), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h[part][rare]), len(known) - 1)
                    count = np.where(known[at] == h[part][rare], n[at], 0)
                out[rare] += own_log_probability(count, token[part][rare], model.shared, net.p.smooth, masked)
            total += np.bincount(of[part], weights=out, minlength=len(ids))
    return total.tolist()


SCORES = "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double"


def score_documents(docs: DataFrame, params: LmParams = LmParams(), text: str = "text", doc_id: str = "doc_id", model: LmModel | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, log_likelihood (the sum) and mean_log_likelihood (null without tokens).

    The model is fitted on docs unless one is given. Only in the first case are docs part of its counts.
    """
    masked = model is None
    p = params if masked else model.network.p
    rows = _rows(docs, p, text, doc_id)
    found = block_words(rows)
    if masked:
        model = _fitted(rows, found, p)
    rare = model.counts.where(_shares_id(model.last)).withColumnRenamed("word", "of")
    counted = found.drop("n").join(rare, F.col("word") == F.col("of")).select("block", "word", "n")
    told = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.network.flat, model.shared, p))

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        """All documents of one block, and the counts of its rare words."""
        vocab, flat, shared, p = told.value
        one = LmModel(vocab, Network(p, flat), None, shared)
        known, count = words["word"].to_numpy().view(np.uint64), words["n"].to_numpy()
        order = np.unique(known, return_index=True)[1]  # a block read in parts brings a word more than once
        known, count = known[order], count[order]
        n, total, some = [], [], []
        for chunk in texts["text"].chunks:
            for h in _text_hashes(chunk):
                n.append(len(h))
                some.append(h)
                if len(h) >= TOGETHER or len(some) >= 64:
                    total += score_texts(some, one, known, count, masked)
                    some = []
        total += score_texts(some, one, known, count, masked)
        mean = [t / k if k else None for t, k in zip(total, n)]
        return pa.table([texts["doc_id"], pa.array(n, pa.int64()), pa.array(total, pa.float64()), pa.array(mean, pa.float64())], names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])

    return rows.select("block", "doc_id", "text").groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(run, SCORES)
