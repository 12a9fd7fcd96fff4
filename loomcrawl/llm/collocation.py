"""Collocations: phrases of two words or more that occur more often than their parts explain, a list per language.

Texts are cut into pieces at punctuation and line ends, pieces into words at spaces and tabs, with A-Z in lower case.
All phrases of 1 to `max_words` words of a piece become DataFrame rows (lang, phrase, count in a batch), which a hash
aggregation sums: exact strings are counted, not hashes of them. A phrase cannot be frequent unless all its words and
all its two-word parts are, so words are counted first, pairs of frequent words next, and then longer phrases of
frequent pairs; rows that cannot reach `min_count` are not made. What a batch needs to know for that is a Bloom
filter of fixed size: where it fills up, more rows are made and the result is the same (`filter_bits` 0: all rows are).

A candidate occurs `min_count` times or more. Every cut of it into a first and a second part has the score
floor(1000 * a * n / (l * r)), in decimals (exact while a * n and l * r stay under 10^35); its lowest cut counts, of equal
ones the first. A candidate is dropped when a longer one holds it and is as frequent: as counts never grow with
length, it is enough to look at candidates of one word more, by an anti-join. Ranking takes the best of each of `salts` parts of a
language first, so that no task gets a language whole.

A null language is `und`; a null or empty text has no words. Repeated rows count as often as they occur; doc_id is not
looked at. A text of any length is cut at its pieces into parts of some MB. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom import fixed_filter, in_filter
from .common import saved
from .hashing import mix, words
from .substring import ragged

SPACE, END = 32, 10
#: Every byte as it is read: pieces end at END, words at SPACE.
READ_AS = bytes(END if chr(b) in ".,;:!?\n\v\f\r" else SPACE if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Languages whose numbers of words are sent to all executors; of more they are joined.
LANGUAGES = 10_000
#: Bytes of text whose phrases are counted together.
TOGETHER = 1 << 22


@dataclass(frozen=True)
class CollocationParams:
    max_words: int = 5
    min_count: int = 100
    top: int = 2000
    #: Bits of a Bloom filter of frequent words or pairs: 16 MB. 0: no filter.
    filter_bits: int = 1 << 27
    salts: int = 32


@dataclass
class Words:
    """The words of a text read as pieces: what each is (a number), its piece, and all of them as bytes with one space after each."""

    ids: np.ndarray
    piece: np.ndarray
    known: pa.Array
    spelt: np.ndarray
    first: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, read: bytes) -> Words:
        b = np.frombuffer(read, np.uint8)
        black = (b != SPACE) & (b != END)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], black, [False])).astype(np.int8)))
        start, size = edge[::2], edge[1::2] - edge[::2]
        letters, at = b[black], np.cumsum(size) - size
        offsets = np.append(at, len(letters)).astype(np.int32)
        told = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        first = at + np.arange(len(at))
        spelt = np.full(len(letters) + len(at), SPACE, np.uint8)
        spelt[ragged(first, size)] = letters
        return cls(told.indices.to_numpy().astype(np.int64), np.cumsum(b == END)[start], told.dictionary, spelt, first, size)

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The n words from each place on, with one space between them."""
        end = self.first[at + n - 1] + self.size[at + n - 1]
        size = end - self.first[at]
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(self.spelt[ragged(self.first[at], size)])])


def gram_hash(lang: str, hashes: np.ndarray) -> np.ndarray:
    """A hash of each row of word hashes, for a language."""
    h = np.full(len(hashes), words(b"l" + lang.encode().hex().encode())[0][0], np.uint64)
    for k in range(hashes.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[:, k])
    return h


def counted(w: Words, lang: str, lengths: range, filt: np.ndarray | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(phrases, counts) for each length; with a filter (of words for pairs, of pairs beyond), of phrases whose parts are in it."""
    n_words = len(w.ids)
    if 1 in lengths:
        yield w.known, np.bincount(w.ids, minlength=len(w.known))
    alive = np.ones(max(0, n_words - 1), bool)
    if filt is not None:
        own = words(b" ".join(x.encode() for x in w.known.to_pylist()))[0]
        if lengths[0] == 2:
            known = in_filter(filt, gram_hash(lang, own[:, None]))[w.ids]
            alive = known[:-1] & known[1:]
        else:
            alive = in_filter(filt, gram_hash(lang, np.stack([own[w.ids[:-1]], own[w.ids[1:]]], 1)))
    rank = w.ids
    at = np.arange(n_words)  # places of the phrases of the length before; rank: what they are
    for n in range(2, lengths[-1] + 1):
        some = at + n - 1 < n_words
        some[some] = (w.piece[at[some]] == w.piece[at[some] + n - 1]) & alive[at[some] + n - 2]
        at = at[some]
        if not len(at):
            return
        _, place, rank, count = np.unique(rank[some] * len(w.known) + w.ids[at + n - 1], return_index=True, return_inverse=True, return_counts=True)
        if n in lengths:
            yield w.phrases(at[place], n), count


def _parts(langs: list[str], texts: Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language read as pieces, some MB of them at a time; a longer one is cut between pieces."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for lang, text in zip(langs, texts):
        read = text.translate(READ_AS)
        while len(read) > TOGETHER:
            cut = read.rfind(b"\n", 0, TOGETHER)
            cut = cut if cut > 0 else read.find(b"\n", TOGETHER)
            if cut < 0:
                break
            yield lang, read[:cut]
            read = read[cut:]
        held.setdefault(lang, []).append(read)
        size[lang] = size.get(lang, 0) + len(read)
        if size[lang] >= TOGETHER:
            yield lang, b"\n".join(held.pop(lang))
            size[lang] = 0
    for lang, some in held.items():
        yield lang, b"\n".join(some)


ROWS = "lang string, phrase string, a long"


def _rows(p: CollocationParams, lengths: range, filt):
    """(lang, phrase, a); with the words of a batch also a row without a phrase, their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = b.column(0).to_pylist(), (t.as_py() or b"" for t in b.column(1).cast(pa.binary()))
            for lang, read in _parts(langs, texts):
                w = Words.of(read)
                if not len(w.ids):
                    continue
                found = list(counted(w, lang, lengths, None if filt is None else filt.value))
                if 1 in lengths:
                    found.append((pa.nulls(1, pa.string()), np.array([len(w.ids)])))
                for phrases, count in found:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(count), pa.string()), phrases, pa.array(count.astype(np.int64))], ["lang", "phrase", "a"])

    return run


def _summed(texts: DataFrame, p: CollocationParams, lengths: range, filt=None) -> DataFrame:
    rows = texts.mapInArrow(_rows(p, lengths, filt), ROWS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return saved(rows.where(f"a >= {p.min_count} or phrase is null"), f"phrases-{lengths[0]}")


def _filter_of(frequent: DataFrame, n: int, p: CollocationParams):
    """A broadcast Bloom filter of phrases of n words."""
    if not p.filter_bits:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            own = words(b"\n".join(x.encode() for x in b.column(1).to_pylist()))[0].reshape(-1, n)
            for lang in set(langs):
                yield pa.RecordBatch.from_arrays([pa.array(gram_hash(lang, own[langs == lang]).view(np.int64))], ["h"])

    return fixed_filter(frequent.where("phrase is not null").select("lang", "phrase").mapInArrow(run, "h long"), p.filter_bits)


def phrase_counts(docs: DataFrame, params: CollocationParams = CollocationParams(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, a, n_words): all phrases of 1 to max_words words that occur min_count times or more; a row without phrase has the language's number of words."""
    p = params
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    if p.filter_bits:
        single = _summed(texts, p, range(1, 2))
        pairs = _summed(texts, p, range(2, 3), _filter_of(single, 1, p))
        found = single.unionByName(pairs)
        if p.max_words > 2:
            found = found.unionByName(_summed(texts, p, range(3, p.max_words + 1), _filter_of(pairs, 2, p)))
    else:
        found = _summed(texts, p, range(1, p.max_words + 1))
    return found.withColumn("n_words", (F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1).cast("int"))


def _scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of each candidate, by its lowest cut."""
    totals = counts.where("phrase is null").select("lang", F.col("a").alias("n"))
    if totals.limit(LANGUAGES + 1).count() <= LANGUAGES:
        totals = F.broadcast(totals)  # a row each
    of = counts.where("phrase is not null").select("lang", "phrase", "a")
    cuts = counts.where("n_words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.withColumns({"head": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - n_words)")})
    left, right = of.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), of.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(left, ["lang", "head"]).join(right, ["lang", "rest"]).join(totals, "lang")
    product = lambda x, y: F.col(x).cast("decimal(19,0)") * F.col(y).cast("decimal(19,0)")
    cuts = cuts.withColumns({"over": (product("a", "n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)"), "under": product("l", "r")})
    cut = F.struct(F.expr("`over` div `under`").alias("score"), "k", "l", "r", "n")
    return cuts.groupBy("lang", "phrase", "a").agg(F.min(cut).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def _held(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): phrases inside a candidate of one word more, with the largest count of such."""
    longer = counts.where("n_words > 2").withColumn("part", F.explode(F.expr("array(substring_index(phrase, ' ', n_words - 1), substring_index(phrase, ' ', 1 - n_words))")))
    return longer.groupBy("lang", F.col("part").alias("phrase")).agg(F.max("a").alias("longer"))


def _ranked(rows: DataFrame, within: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(f"rank <= {top}")


def collocations(docs: DataFrame, params: CollocationParams = CollocationParams(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases, from rank 1."""
    counts = phrase_counts(docs, params, text, lang)
    candidates, held = _scored(counts), _held(counts)
    left = candidates.join(held.withColumnRenamed("phrase", "part").withColumnRenamed("lang", "of"), (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")) & (F.col("longer") >= F.col("a")), "left_anti")
    salted = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(params.salts)))
    best = _ranked(_ranked(salted, ["lang", "salt"], params.top).drop("rank"), ["lang"], params.top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
