"""Cutting and exact byte-pair merging of many words at once.

Words are rows of a matrix of tokens.  Every step merges the lowest-ranked pair of each row, the
leftmost among equals, as the merges of one word after the other would.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex

_SLOT_BITS = np.uint64(20)


def _slots(keys: np.ndarray, factor: int) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(factor)) >> (np.uint64(64) - _SLOT_BITS)


def _hashed(keys: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Tables of places by hash, each with those keys that found no slot in the ones before."""
    tables, left, factor = [], np.arange(len(keys)), 0x9E3779B97F4A7C15
    while len(left):
        table = np.zeros(1 << int(_SLOT_BITS), dtype=np.int32)
        slots = _slots(keys[left], factor)
        table[slots] = left
        tables.append((factor, table))
        left = left[table[slots] != left]
        factor = (factor * 0xD6E8FEB86659FD93 + 2) % 2**64 | 1
    return tables


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in vocabularies of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Pairs:
    """Pairs of tokens in the order of their ranks, and what each becomes."""

    def __init__(self, first: np.ndarray, second: np.ndarray, made: np.ndarray) -> None:
        self.keys = (first.astype(np.int64) << 32) | second
        self.made, self.never = made.astype(np.int32), np.int32(len(made))
        self._tables = _hashed(self.keys)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``never`` if it has none; a pair's rank is its place among the keys."""
        key = (a.astype(np.int64) << 32) | b
        out = np.full(key.shape, self.never, dtype=np.int32)
        for factor, table in self._tables:
            found = table[_slots(key, factor)]
            hit = self.keys[found] == key
            out[hit] = found[hit]
        return out

    def merge(self, tokens: np.ndarray) -> np.ndarray:
        """Merge rows of a matrix in which -1 stands behind the last token of a row."""
        width = tokens.shape[1]
        if width < 2:
            return tokens
        ranks = self.ranks(tokens[:, :-1], tokens[:, 1:])
        rows, step = np.arange(len(tokens)), np.arange(width)
        work_t, work_r = tokens, ranks
        done = tokens.copy()
        while len(rows):
            at = work_r.argmin(axis=1)
            own = np.arange(len(rows))
            rank = work_r[own, at]
            live = rank < self.never
            if not live.all():
                done[rows[~live]] = work_t[~live]
                rows, work_t, work_r, at, rank = rows[live], work_t[live], work_r[live], at[live], rank[live]
                if not len(rows):
                    break
                own = np.arange(len(rows))
            work_t[own, at] = self.made[rank]
            shift = np.minimum(step[None, :] + (step[None, :] > at[:, None]), width - 1)
            work_t = np.take_along_axis(work_t, shift, axis=1)
            work_t[:, -1] = -1
            work_r = np.take_along_axis(work_r, np.minimum(step[None, :-1] + (step[None, :-1] > at[:, None]), width - 2), axis=1)
            work_r[:, -1] = self.never
            left = np.flatnonzero(at > 0)
            work_r[left, at[left] - 1] = self.ranks(work_t[left, at[left] - 1], work_t[left, at[left]])
            right = np.flatnonzero(at < width - 1)
            work_r[right, at[right]] = self.ranks(work_t[right, at[right]], work_t[right, at[right] + 1])
        return done


OTHER, LETTER, NUMBER, SIGN = range(4)


def _kinds() -> np.ndarray:
    """Kind of the letters below U+0180; those that compose, or change their number in lower case, are other."""
    kinds = np.full(0x180, OTHER, dtype=np.uint8)
    for c in [*range(0x21, 0x7F), *range(0xA1, 0x180)]:
        if c not in (0x130, 0x149):
            kinds[c] = LETTER if regex.match(r"\p{L}", chr(c)) else NUMBER if regex.match(r"\p{N}", chr(c)) else SIGN
    return kinds


KINDS = _kinds()


def buffers(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the texts in their bytes, one more than there are texts, and the bytes."""
    _, offsets, body = texts.buffers()
    places = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return places - places[0], np.frombuffer(body or b"", dtype=np.uint8)[places[0] : places[-1]]


def kinds_of(data: np.ndarray) -> np.ndarray:
    """Kind of the letter that each byte of UTF-8 belongs to."""
    kinds = np.where(data < 0x80, KINDS[np.minimum(data, 0x7F)], OTHER)
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC5))
    code = ((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)
    kinds[lead] = kinds[lead + 1] = KINDS[code]
    return kinds


def piece_starts(data: np.ndarray, kinds: np.ndarray, words: np.ndarray, lone_numbers: bool) -> np.ndarray:
    """Where pieces begin in words that begin at ``words``: runs of letters, of numbers and of signs.

    Words hold no blanks but one space in front, which belongs to their first piece.  ``lone_numbers``:
    each number is a piece of its own.
    """
    starts = (kinds == NUMBER) & ((data & 0xC0) != 0x80) if lone_numbers else np.zeros(len(data), dtype=bool)
    starts[1:] |= kinds[1:] != kinds[:-1]
    space = np.flatnonzero(data == ord(" ")) + 1
    starts[space[space < len(data)]] = False
    starts[words] = True
    # An apostrophe before one of a few endings belongs to it, if no other sign stands before it.
    at = np.flatnonzero((data == ord("'")) & starts)
    padded = np.concatenate([data, [0, 0, 0]])
    word_end = np.append(words, len(data))[np.searchsorted(words, at, side="right")]
    one, two = padded[at + 1], padded[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"]) & (at + 1 < word_end)
    pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    long = pairs & (at + 2 < word_end)
    for found, size in ((at[short], 1), (at[long], 2)):
        starts[found + 1] = False
        behind = found + 1 + size
        starts[behind[behind < len(data)]] = True
    return np.flatnonzero(starts)
