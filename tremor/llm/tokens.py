"""Byte-level BPE ids of whole texts, with a word cache.

Invented or rare words dominate the cost of BPE, and most words of a corpus are
common, so ids are kept per space-delimited word, and texts are encoded many at
a time: Arrow splits them and numbers their distinct words, each of which is
looked up once. A text may be cut before a
single space or line break that is followed by a non-space character: the
tokenizer's own pre-tokenizer always cuts there. Texts with any other white
space (runs, tabs, leading or trailing space) are encoded whole.
"""

from __future__ import annotations

import gc
import string
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from tremor.llm.common import release_memory

#: Fixed value: the pre-tokenizer's pattern for byte-level BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes a Python worker spends on remembered words.
CACHE_BYTES = 24 << 20

ID_BYTES = 4
#: Bytes of texts that are encoded together.
SLICE_BYTES = 4 << 20
#: Words whose ids are copied at once.
_GATHERED = 1 << 17
#: White space that the word cache does not handle, of the kinds that are common.
_ODD_SPACE = r"\A\z|\A[ \n]|[ \n]\z|[ \n][ \n]|[\t\x0b\x0c\r]"

_BREAK, _NOTHING = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())

_LAST_SIMPLE = "ɏ"  # words up to Latin Extended-B take the short path


def byte_alphabet() -> dict[int, str]:
    """Byte → character of the byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others get the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_WORD_START = frozenset(" " + string.ascii_letters)
#: Signs that stand apart from letters before them, at the end of a word.
_MARKS = string.punctuation


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _OddSpace(Exception):
    """The text holds white space that the word cache does not handle."""


class _Words:
    """Word → ids in columns, so that a word costs little more than its characters
    and ids. Above ``max_bytes`` the words used last stay, half of that size."""

    def __init__(self, encode: Callable[[list[str]], tuple[list[int], list[int]]], max_bytes: int):
        self.encode, self.max_bytes, self.half = encode, max_bytes, max_bytes // 2
        self.words = pa.array([], pa.large_string())
        self.ends, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")
        self.used, self.turn = np.zeros(0, dtype=np.int32), 0

    def find(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words; those not kept yet are encoded."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        ids, sizes = self.encode(new.to_pylist())
        known = len(self.words)
        places = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        places[places < 0] = np.arange(known, known + len(new))
        if len(new):
            self.words = pa.concat_arrays([self.words, new])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.array(ids, dtype="<u4")])
            self.used = np.concatenate([self.used, np.zeros(len(new), dtype=np.int32)])
        self.turn += 1
        self.used[places] = self.turn
        return places

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at ``places`` in a row, and where those of each end."""
        sizes = self.ends[places + 1] - self.ends[places]
        ends = np.cumsum(sizes)
        ids = np.empty(ends[-1] if len(ends) else 0, dtype="<u4")
        for k in range(0, len(places), _GATHERED):  # index arrays are wider than the ids: a long text is done in parts
            part, size, end = places[k:k + _GATHERED], sizes[k:k + _GATHERED], ends[k:k + _GATHERED]
            low = int(end[0] - size[0])
            ids[low:end[-1]] = self.ids[np.repeat(self.ends[part] - (end - size), size) + np.arange(low, end[-1])]
        return ids, ends

    def trim(self) -> None:
        """Forget what exceeds the size."""
        if self.words.nbytes + self.ends.nbytes + self.ids.nbytes + self.used.nbytes <= self.max_bytes:
            return
        latest = np.argsort(-self.used, kind="stable")
        size = (pc.binary_length(self.words).to_numpy(zero_copy_only=False) + 20 + ID_BYTES * np.diff(self.ends))[latest]
        stay = np.sort(latest[np.cumsum(size) <= self.half])
        ids, ends = self.gather(stay)
        self.words, self.used = self.words.take(pa.array(stay)), self.used[stay]
        self.ends, self.ids = np.concatenate([[0], ends]), ids

    def _held(self, which: np.ndarray) -> dict[str, bytes]:
        return {self.words[i].as_py(): self.ids[self.ends[i]:self.ends[i + 1]].tobytes() for i in np.flatnonzero(which)}

    @property
    def young(self) -> dict[str, bytes]:
        """What is kept and was met last."""
        return self._held(self.used == self.turn)

    @property
    def old(self) -> dict[str, bytes]:
        return self._held(self.used < self.turn)


class TextEncoder:
    """Text → ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
        self._tokenize = self.tokenizer.model.tokenize
        self._pattern = regex.compile(WORD_PATTERN)
        self._bytes = byte_alphabet()
        self._space = self._bytes[0x20]
        # Characters of the short path → their bytes, spelled.
        self._spelled = {c: "".join(self._bytes[b] for b in chr(c).encode()) for c in range(ord(_LAST_SIMPLE) + 1)}
        self._marks = {c: self._whole(c) for c in _MARKS}
        self._newline = self._whole("\n")
        # Words at the start of a line keep its break before them, so both kinds share one cache.
        self._first = self._later = _Words(self._encode_words, cache_bytes)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_words(self, words: list[str]) -> tuple[list[int], list[int]]:
        """The ids of words in a row and the number of each. A word stands behind a
        space or begins with its line break; it has no ids if other white space is in it."""
        ids: list[int] = []
        sizes, none, marks, space, tokenize = [], [], self._marks, self._space, self._tokenize
        for word in words:
            stem, mark = (word, none) if word.isalpha() else (word[:-1], marks.get(word[-1:]))
            if mark is not None and word.isascii() and stem.isalpha():  # letters and a mark are apart
                got = [token.id for token in tokenize(space + stem)] + mark
            elif word[:1] == "\n":
                got = self._behind(word[1:], "", "")
                got = self._newline + got if got else got
            else:
                got = self._behind(word, " ", space)
            ids += got
            sizes.append(len(got))
        return ids, sizes

    def _behind(self, word: str, before: str, spelled_before: str) -> list[int]:
        if word.isascii() and word.isalpha():
            return [token.id for token in self._tokenize(spelled_before + word)]
        if not word or word.split() != [word]:
            return []
        mark = self._marks.get(word[-1])
        if mark is not None and word[:-1].isalpha():  # letters and a mark are apart
            return self._behind(word[:-1], before, spelled_before) + mark
        whole = before + word
        if not word.isascii() and max(word) > _LAST_SIMPLE:
            return self._whole(whole)
        ids = []
        for part in (whole,) if whole[1:].isalpha() and whole[0] in _WORD_START else self._pattern.findall(whole):
            ids += [token.id for token in self._tokenize(part.translate(self._spelled))]
        return ids

    def encode(self, text: str | None) -> bytes:
        """Id bytes of ``text``; null and empty texts have none."""
        return next(self.encode_all(pa.array([text], pa.large_string())))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Id bytes of every text of an Arrow array, in order. Texts are encoded
        together in slices of about ``SLICE_BYTES``, each distinct word of a slice once."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            limit = (ends[at - 1] if at else 0) + SLICE_BYTES
            end = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
            yield from self._encode_slice(texts.slice(at, end - at).cast(pa.large_string()))
            at = end

    def _split(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of texts, and where those of each text begin. Line breaks go
        with the word behind them, and every text begins with one."""
        lines = pc.replace_substring(texts, "\n", " \n")
        split = pc.split_pattern(pc.binary_join_element_wise(_BREAK, lines, _NOTHING), " ")
        return split.values.dictionary_encode(), split.offsets.to_numpy()

    def _encode_slice(self, texts: pa.Array) -> list[bytes]:
        even = pc.invert(pc.match_substring_regex(texts, _ODD_SPACE))
        out: list[bytes | None] = [None] * len(texts)
        rows = np.flatnonzero(even.to_numpy(zero_copy_only=False))
        if len(rows):
            words, starts = self._split(texts.filter(even))
            release_memory()  # the split words, before the kept ones are searched
            ids, ends = self._later.gather(self._later.find(words.dictionary)[words.indices.to_numpy()])
            del words
            self._later.trim()
            ends = np.concatenate([[0], ends])
            plain = np.logical_and.reduceat(np.diff(ends) > 0, starts[:-1])
            raw, cuts, skip = ids.tobytes(), (ID_BYTES * ends[starts]).tolist(), ID_BYTES * len(self._newline)
            for i, is_plain, a, b in zip(rows.tolist(), plain.tolist(), cuts, cuts[1:]):
                if is_plain:
                    out[i] = raw[a + skip:b]
            del ids, ends, plain, raw, cuts
            release_memory()
        return [_packed(self._whole(texts[i].as_py())) if got is None else got for i, got in enumerate(out)]


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a vocabulary file; its cache outlives a task."""
    made = TextEncoder(path)
    gc.freeze()  # the vocabulary and modules stay; what is made from now on holds no cycles worth a frequent search
    gc.set_threshold(100_000)
    return made
