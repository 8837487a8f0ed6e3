"""Whole-text encoding with public tokenizer files, inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
from collections.abc import Callable, Hashable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that the remembered values of a Python worker may take.
MEMO_BYTES = 64 << 20
#: Longer keys are not remembered: they seldom come again and may be whole documents.
LONGEST_KEY = 64
_ENTRY = 200  # bytes of a dictionary's slot and of two objects besides what they hold


def tokenizer_version(path: str) -> str:
    """Digest of the file and the library that reads it: counts are only valid for both."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    digest = hashlib.sha256(f"{library.__name__} {library.__version__} ".encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of spans, one span after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Memo:
    """Remembered values in two generations, bounded in bytes; the frequent ones stay."""

    def __init__(self, budget: int = MEMO_BYTES, longest: int = LONGEST_KEY) -> None:
        self.budget, self.longest = budget, longest
        self.young, self.old = {}, {}
        self.size = 0
        self.passing: list = []  # long keys of the last call

    def _keep(self, entries: dict) -> None:
        self.young.update(entries)
        self.passing += [k for k in entries if len(k) > self.longest]
        self.size += sum(map(len, entries)) + sum(map(len, entries.values())) + _ENTRY * len(entries)

    def fill(self, keys: set, compute: Callable[[list], list]) -> dict:
        """A dictionary that has all ``keys`` until the next call; ``compute`` gets those unknown."""
        for key in self.passing:
            self.young.pop(key, None)
        self.passing.clear()
        if 2 * self.size > self.budget:
            self.young, self.old, self.size = {}, self.young, 0
        new = keys.difference(self.young)
        again = new.intersection(self.old)
        self._keep({k: self.old[k] for k in again})
        missing = list(new - again)
        if missing:
            self._keep(dict(zip(missing, compute(missing), strict=True)))
        return self.young


#: What the worker's present operator keeps; Python workers outlive the stages that use them.
_RESIDENT: dict[Hashable, Any] = {}


def resident(key: Hashable, build: Callable[[], Any]) -> Any:
    """The one large object a Python worker holds; another operator's is let go first."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = build()
    return _RESIDENT[key]


def release() -> None:
    """Give freed memory back to the system at the end of a task, as the worker lives on."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _plain(word: bytes) -> bytes:
    """Lower-cased where the tokenizer would do just that, so that more words are known.

    Not with letters beyond ASCII, as marks may join a small letter only, nor where a special token
    might be spelled.
    """
    return word.lower() if word.isascii() and b"<|" not in word else word


class Encoder:
    """Ids of whole texts, without begin, end or added special tokens, truncation or padding.

    ``by_words``: the tokenizer lower-cases, drops white space and lets no token cross it
    (word_bpe_49k.json), so a text's ids are those of its words between ASCII blanks.  Texts are then
    split and their words numbered in Arrow, the distinct words of a batch are merged all at once,
    and the ids are put together from the numbers.  Words that are not known to be merged exactly,
    in other scripts say, go through the library and are remembered.
    """

    def __init__(self, path: str, by_words: bool, budget: int = MEMO_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from .wordbpe import WordMerges

        self.by_words = by_words
        self.memo = Memo(budget)
        self._merges = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._raw = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._raw = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            if by_words and WordMerges.supports(path):
                self._merges = WordMerges(path)

    def _by_library(self, words: list[bytes]) -> list[bytes]:
        out = []
        for start in range(0, len(words), 4096):
            ids = self._raw([w.decode("utf-8", "replace") for w in words[start : start + 4096]])
            out += [np.asarray(x, dtype="<u4").tobytes() for x in ids]
        return out

    def _distinct(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        if self._merges:
            ids, counts, known = self._merges.encode(words)
        else:
            ids, counts, known = np.empty(0, dtype="<u4"), np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool)
        if known.all():
            return ids, counts
        left = np.flatnonzero(~known)
        names = [_plain(w) for w in words.take(pa.array(left)).view(pa.binary()).to_pylist()]
        found = self.memo.fill(set(names), self._by_library)
        coded = [found[n] for n in names]
        sizes = counts.copy()
        sizes[left] = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        out = np.empty(int(sizes.sum()), dtype="<u4")
        starts = np.cumsum(sizes) - sizes
        out[spans(starts[known], sizes[known])] = ids
        out[spans(starts[left], sizes[left])] = np.frombuffer(b"".join(coded), dtype="<u4")
        return out, sizes

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place of each word's first id, how many it has, the ids of distinct words, and where texts begin among the words."""
        plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
        split = pc.ascii_split_whitespace(pc.if_else(plain, pc.ascii_lower(texts), texts))
        words = split.flatten().dictionary_encode()
        ids, sizes = self._distinct(words.dictionary)
        at = words.indices.to_numpy()
        places = split.offsets.to_numpy().astype(np.int64)
        return (np.cumsum(sizes) - sizes)[at], sizes[at], ids, places - places[0]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column, one text after the other, and how many each text has."""
        texts = texts.fill_null("")
        if not self.by_words:
            each = [np.frombuffer(x, dtype="<u4") for x in self.encode(texts.view(pa.binary()).to_pylist())]
            return np.concatenate([np.empty(0, dtype="<u4"), *each]), np.array([len(x) for x in each], dtype=np.int64)
        first, sizes, ids, places = self._words(texts)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids[spans(first, sizes)], ends[places[1:]] - ends[places[:-1]]

    def count_column(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text of a string column has."""
        texts = texts.fill_null("")
        if not self.by_words:
            return self.encode_column(texts)[1]
        _, sizes, _, places = self._words(texts)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ends[places[1:]] - ends[places[:-1]]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        if not self.by_words:
            return [np.asarray(x, dtype="<u4").tobytes() for t in texts for x in self._raw([t.decode("utf-8", "replace")])]
        ids, counts = self.encode_column(pa.array(texts, pa.binary()).view(pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


def encoder(path: str, by_words: bool) -> Encoder:
    """One per Python worker, kept until the worker turns to another operator."""
    return resident(("encoder", path, by_words), lambda: Encoder(path, by_words))


def default_path(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def utf8(column) -> list[bytes]:
    """Bytes of an Arrow string column without a detour over str; null reads as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
