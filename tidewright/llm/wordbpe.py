"""Exact byte-pair merging of many words at once, for vocabularies with word ends.

Words are cut into pieces and those merged as rows of matrices.  Words in letters whose lower case
and composition could depend on the library's tables are left to it.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .merging import OTHER, Pairs, buffers, byte_letters, kinds_of, piece_starts
from .tokens import spans

#: What the pre-tokenizer of these files cuts out, in its own order; everything else is dropped.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes of the longest word that is merged here.
_WIDEST = 64
_ROWS = 4096
class WordMerges:
    """Pieces and merges of a file whose pre-tokenizer drops white space and marks ends of words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)], dtype=np.int32)
        self.last = np.array([vocabulary[letters[b] + end] for b in range(256)], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        first = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        second = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        self.pairs = Pairs(first, second, made)

    @staticmethod
    def supports(path: str) -> bool:
        """Is this a file of the one shape that is known here?"""
        if not path.endswith(".json"):
            return False
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        kinds = [n.get("type") for n in (data.get("normalizer") or {}).get("normalizers", [])]
        split = (data.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (
            kinds == ["NFC", "Replace", "Lowercase"]
            and [p["type"] for p in split] == ["Split", "ByteLevel"]
            and (split[0]["pattern"], split[0]["behavior"], split[0]["invert"]) == ({"Regex": PATTERN}, "Removed", True)
            and bool(data["model"].get("end_of_word_suffix"))
        )

    def _merged(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after the other, and how many each has."""
        places, flat = buffers(pieces)
        starts, sizes = places[:-1], np.diff(places)
        counts = np.zeros(len(pieces), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        # Pieces of like width share a matrix, few enough of them to stay in the cache.
        for low, high in ((1, 1), (2, 3), (4, 5), (6, 8), (9, 12), (13, 20), (21, _WIDEST)):
            every = np.flatnonzero((sizes >= low) & (sizes <= high))
            for at in np.split(every, range(_ROWS, len(every), _ROWS)):
                columns, rows = np.arange(high), np.arange(len(at))
                inside = columns[None, :] < sizes[at][:, None]
                letters = flat[np.minimum(starts[at][:, None] + columns[None, :], len(flat) - 1)]
                tokens = np.where(inside, self.inner[letters], np.int32(-1))
                tokens[rows, sizes[at] - 1] = self.last[letters[rows, sizes[at] - 1]]
                merged = self.pairs.merge(tokens)
                counts[at] = (merged >= 0).sum(axis=1)
                found.append((at, merged[merged >= 0]))
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
        for at, values in found:
            ids[spans((ends - counts)[at], counts[at])] = values
        return ids, counts

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words between blanks, one after the other, how many each has, and which words are known here.

        The others have no ids; they are left to the library.
        """
        short = pc.and_(pc.less_equal(pc.binary_length(words), _WIDEST), pc.invert(pc.match_substring(words, "<|")))
        known = short.to_numpy(zero_copy_only=False).copy()
        places, data = buffers(words)
        odd = np.concatenate([[0], np.cumsum(kinds_of(data) == OTHER)])
        known &= odd[places[1:]] == odd[places[:-1]]
        counts = np.zeros(len(words), dtype=np.int64)
        if not known.any():
            return np.empty(0, dtype="<u4"), counts, known
        places, data = buffers(pc.utf8_lower(words.filter(pa.array(known))))
        filled = np.flatnonzero(places[1:] > places[:-1])
        starts = piece_starts(data, kinds_of(data), places[filled], lone_numbers=True)
        offsets = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        at = pieces.indices.to_numpy()
        ids, sizes = self._merged(pieces.dictionary)
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        edges = ends[np.searchsorted(starts, places)]
        counts[known] = np.diff(edges)
        return ids[spans((np.cumsum(sizes) - sizes)[at], sizes[at])], counts, known
