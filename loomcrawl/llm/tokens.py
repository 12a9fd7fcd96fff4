"""Whole texts to token ids, through the tokenizers library and a cache of words."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

from .hashing import lane, lanes, mix, words

#: Words kept at once, and pre-tokens; at more the cache starts anew. It changes no ids.
CACHE, PARTS = 1_000_000, 150_000
#: Bytes of text whose words are looked up together.
TOGETHER = 1 << 20
#: A Latin word, perhaps with punctuation after it: a pre-token each, whatever the tokenizer's pattern.
_PLAIN = re.compile("([ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&*#$|()]*)")
#: White space other than the six ASCII characters, all below U+3001, and where it begins or ends a word.
_RARE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\v\f\r")
_AT_EDGE = re.compile(rf"(?:\A|[ \n])[{_RARE_SPACE}]|[{_RARE_SPACE}](?:[ \n]|\Z)")
_START, _SPACE, _FEED, _OTHER = 0, 1, 2, 3
_BEFORE = ["", " ", "\n"]


def _byte_characters() -> dict[int, str]:
    """How byte-level models write the bytes that are no visible characters of Latin-1: from U+0100 on, in order."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Known:
    """Ids by word and what stands before it: sorted hashes, and for each the word's bytes and its ids, in flat arrays."""

    def __init__(self):
        self.hashes = np.empty(0, np.uint64)
        #: first id, number of ids, first byte, number of bytes, what stands before
        self.entry = np.empty((0, 5), np.int64)
        self.ids, self.n_ids = np.empty(1 << 16, np.uint32), 0
        self.letters = bytearray()

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For hashes: their places, and whether they are known."""
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
        return at, (self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool))

    def add(self, h: np.ndarray, words: list[bytes], gap: np.ndarray, ids: list[bytes]) -> None:
        """Sorted hashes that are not known yet, with their words, what stands before them, and the ids of each."""
        new = np.frombuffer(b"".join(ids), np.uint32)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        letters = np.fromiter(map(len, words), np.int64, len(words))
        if self.n_ids + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n_ids], np.empty(max(len(self.ids), len(new)), np.uint32)])
        self.ids[self.n_ids : self.n_ids + len(new)] = new
        entry = np.stack([self.n_ids + np.cumsum(size) - size, size, len(self.letters) + np.cumsum(letters) - letters, letters, gap], 1)
        self.letters += b"".join(words)
        at = np.searchsorted(self.hashes, h)
        self.hashes, self.entry = np.insert(self.hashes, at, h), np.insert(self.entry, at, entry, axis=0)
        self.n_ids += len(new)


def _same(a: np.ndarray, s: np.ndarray, b: np.ndarray, t: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether words of `size` bytes at places s and t of two texts, given by their lanes, have the same bytes."""
    ok, at, k = np.ones(len(s), bool), np.arange(len(s)), 0
    while len(at):
        left = size[at] - k
        ok[at] &= lane(a, s[at] + k, left) == lane(b, t[at] + k, left)
        k += 8
        at = at[ok[at] & (size[at] > k)]
    return ok


class WordEncoder:
    """Ids of whole texts, equal to Tokenizer.encode(text, add_special_tokens=False).ids.

    Texts repeat words, so the words of many texts are told apart by a 64-bit hash and then by their
    bytes, each distinct one is looked up or encoded once with the white space in front of it, and the
    texts' ids are put together from that. Cutting there changes nothing, as both kinds of tokenizer below
    begin a pre-token there:

    - "spaces": a byte-level pre-tokenizer that takes one space with the word after it, and a line feed
      alone. A text with any other white space between, before or behind its words is encoded whole.
    - "words": white space only parts words and is dropped.

    New words are rare ones mostly, whose cost is the way to the model: plain ones go there directly.
    Encoded whole are texts that hold a special token's string, which has that token's id by the library's
    default, and texts with a word whose hash is that of another word.
    """

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.written = self.tokenizer.model, _byte_characters()
        self.parts: dict[str, bytes] = {}
        self.known = _Known()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _holds_added(self, text: bytes) -> bool:
        """Whether a special token's string is in the text, or comes there when its words are put in lower case."""
        text = text.lower() if self.kind == "words" else text
        return any(a in text for a in self.added)

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token; words come back with other punctuation behind them, so parts are kept too."""
        ids = self.parts.get(part)
        if ids is None:
            written = part if part.isalpha() and part.isascii() else part.encode().decode("latin-1").translate(self.written)
            ids = self.parts[part] = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        m = _PLAIN.fullmatch(word.lower() if self.kind == "words" else word)
        if not m:
            return self._whole(word)
        first, after = m.groups()
        ids = self._part("\n") + self._part(first[1:]) if first[0] == "\n" else self._part(first)
        return ids + self._part(after) if after else ids

    def _before(self, buffer: np.ndarray, s: np.ndarray, e: np.ndarray, start: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What stands before each word: nothing, a space, a line feed, or something else; start: first byte of each text."""
        gap = np.empty(len(s), np.int8)
        one = s[1:] - e[:-1] == 1
        byte = buffer[s[1:] - 1]
        gap[1:] = np.where(one & (byte == 32), _SPACE, np.where(one & (byte == 10), _FEED, _OTHER))
        gap[first] = np.where(s[first] == start, _START, _OTHER)
        return gap

    def _some(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts that all have a word."""
        data = b"\n".join(texts)
        data = data.lower() if self.kind == "words" else data  # of bytes: A-Z alone, which the tokenizer lowers too
        h, s, e = words(data)
        start = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        bounds = np.append(np.searchsorted(s, start), len(s))
        whole = np.zeros(len(texts), bool)
        if self.kind == "spaces":
            buffer, stop = np.frombuffer(data, np.uint8), start + [len(t) for t in texts]
            gap = self._before(buffer, s, e, start, bounds[:-1])
            whole = np.logical_or.reduceat(gap == _OTHER, bounds[:-1]) | (e[bounds[1:] - 1] != stop)
            rare = [k for k, t in enumerate(texts) if not t.isascii() or any(c in t for c in (b"\x1c", b"\x1d", b"\x1e", b"\x1f"))]
            for k in rare:
                if not whole[k] and _AT_EDGE.search(texts[k].decode()):
                    whole[k] = True
            h = mix(h + gap.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        else:
            gap = np.zeros(len(s), np.int8)
        whole |= np.fromiter(map(self._holds_added, texts), bool, len(texts))
        gap[np.repeat(whole, np.diff(bounds))] = _OTHER
        h[gap == _OTHER] = 0  # of texts that are encoded whole
        one, first, of = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known.hashes) + len(one) > CACHE:
            self.known = _Known()
        _, there = self.known.find(one)
        if not there.all():
            new = first[~there]
            written = [data[a:b] if g != _OTHER else b"" for a, b, g in zip(s[new].tolist(), e[new].tolist(), gap[new].tolist())]
            found = [self._word(_BEFORE[g] + w.decode()) if g != _OTHER else b"" for w, g in zip(written, gap[new].tolist())]
            self.known.add(one[~there], written, gap[new], found)
        at, _ = self.known.find(one)
        known = self.known.entry[at][of]
        # the bytes decide: each word against the one that its hash was learnt from
        other = (gap != known[:, 4]) | (gap != _OTHER) & (e - s != known[:, 3])
        alike = np.flatnonzero(~other & (gap != _OTHER))
        other[alike] = ~_same(lanes(data), s[alike], lanes(bytes(self.known.letters)), known[alike, 2], known[alike, 3])
        whole |= np.logical_or.reduceat(other, bounds[:-1])
        begin, each = known[:, 0], known[:, 1]
        end = np.cumsum(each)
        ids = self.known.ids[np.repeat(begin - (end - each), each) + np.arange(end[-1])]
        cuts = np.append(0, end)[bounds]
        return [np.frombuffer(self._whole(t.decode()), np.uint32) if w else ids[a:b] for t, w, a, b in zip(texts, whole.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode(self, texts: Iterable[bytes | str | None]) -> Iterator[np.ndarray]:
        """uint32 ids per text, in order; a null text has none."""
        some: list[bytes] = []
        order: list[np.ndarray | None] = []

        def flush() -> Iterator[np.ndarray]:
            got = iter(self._some(some) if some else [])
            yield from (next(got) if x is None else x for x in order)
            some.clear()
            order.clear()
            if len(self.parts) > PARTS:
                self.parts = {}

        size = 0
        for text in texts:
            text = text.encode() if isinstance(text, str) else text or b""
            if text.strip():
                some.append(text)
                order.append(None)
                size += len(text)
            else:
                order.append(np.frombuffer(self._whole(text.decode()) if text else b"", np.uint32))
            if size >= TOGETHER:
                yield from flush()
                size = 0
        yield from flush()


_encoders: dict[tuple[str, str], WordEncoder] = {}


def encoder(path: str, kind: str) -> WordEncoder:
    """One per Python worker, so that the cache outlives a task."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = WordEncoder(path, kind)
    return _encoders[path, kind]
