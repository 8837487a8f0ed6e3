"""Byte-pair encoding by speculation: longest matches are proposed, then checked pair by pair.

A sequence of tokens is what the merges give for a word if each token is what the merges give for
its own bytes and no merge could cross the border of two neighbours before it is closed.  The
right edge of a token is a chain of pieces, each alive until a merge of known rank absorbs it; so
is the left edge of the next token.  A border is safe unless some merge of a right-edge piece with
a left-edge piece ranks before both are absorbed.  That is looked up for all borders of a batch at
once.  Words with an unsafe border are merged exactly, lowest rank first, leftmost among equals, many
at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .merging import OTHER, Pairs, buffers, byte_letters, kinds_of, piece_starts
from .support import small_batches, text_of
from .tokens import MEMO_BYTES, Memo, release, resident, spans, utf8

_NEVER = np.int64(1) << 40
_ROWS = 4096
#: Bytes of the longest word that is a row among others.
SHORT = 64


class Merges:
    """Vocabulary and merges of a byte-level file, with the edge chains of every token."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.ids: dict[str, int] = data["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(data["model"]["merges"]):
            self.rank[self.ids[a], self.ids[b]] = (r, self.ids[a + b])
        self.longest: dict[str, int] = {}  # of the tokens that begin with these two letters
        for token in self.ids:
            self.longest[token[:2]] = max(len(token), self.longest.get(token[:2], 1))

        keys = np.array([(a << 32) | b for a, b in self.rank], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.arange(len(keys), dtype=np.int64)[order]

        pairs = np.array(list(self.rank), dtype=np.int64).reshape(-1, 2)
        self.pairs = Pairs(pairs[:, 0], pairs[:, 1], np.array([t for _, t in self.rank.values()], dtype=np.int32))
        self.of_byte = np.array([self.ids[c] for _, c in sorted(byte_letters().items())], dtype=np.int32)

        left, right, made = [-1] * size, [-1] * size, [0] * size
        for (a, b), (r, t) in self.rank.items():
            if left[t] < 0:
                left[t], right[t], made[t] = a, b, r
        self.right_edge = self._edges(right, made, size)
        self.left_edge = self._edges(left, made, size)

        # A token stands for its own bytes if its halves do and nothing crosses their border first.
        self.sound = np.zeros(size, dtype=bool)
        self.sound[[t for s, t in self.ids.items() if len(s) == 1]] = True
        safe = self.safe(pairs[:, 0], pairs[:, 1], np.arange(len(pairs), dtype=np.int64))
        for ((a, b), (r, t)), ok in zip(self.rank.items(), safe, strict=True):
            if ok and made[t] == r and self.sound[a] and self.sound[b]:
                self.sound[t] = True

        letters = {c: b for b, c in byte_letters().items()}
        self.bytes: list[bytes] = [b""] * size
        for token, t in self.ids.items():
            self.bytes[t] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self._grow({self.bytes[t]: t for token, t in self.ids.items() if all(c in letters for c in token)})
        for token, t in self.special.items():
            self.bytes[t] = token.encode()

    def _grow(self, tokens: dict[bytes, int]) -> None:
        """The tree of all tokens by their bytes; node 0 is its root."""
        nodes, parent, byte = {b"": 0}, [], []
        for token in tokens:
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    nodes[token[:end]] = len(nodes)
                    parent.append(nodes[token[: end - 1]])
                    byte.append(token[end - 1])
        self.tree = Pairs(np.array(parent), np.array(byte), np.arange(1, len(nodes)))
        self.token_at = np.full(len(nodes), -1, dtype=np.int32)
        for token, t in tokens.items():
            self.token_at[nodes[token]] = t

    @staticmethod
    def _edges(inner: list[int], made: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token the chain of pieces at one edge: where it starts, pieces, when each is absorbed."""
        starts, pieces, ends = [0], [], []
        for token in range(size):
            piece, end = token, int(_NEVER)
            while piece >= 0:
                pieces.append(piece)
                ends.append(end)
                piece, end = inner[piece], made[piece]
            starts.append(len(pieces))
        return np.array(starts), np.array(pieces, dtype=np.int64), np.array(ends, dtype=np.int64)

    def safe(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbours: can no merge cross the border (before the given rank)?"""
        (sa, pa_, ea), (sb, pb, eb) = self.right_edge, self.left_edge
        na, nb = sa[a + 1] - sa[a], sb[b + 1] - sb[b]
        total = na * nb
        pair = np.repeat(np.arange(len(a)), total)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
        i, j = sa[a][pair] + within // nb[pair], sb[b][pair] + within % nb[pair]
        key = (pa_[i] << 32) | pb[j]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank = np.where(self.keys[at] == key, self.ranks[at], _NEVER)
        limit_a, limit_b = ea[i], eb[j]
        if before is not None:
            limit_a, limit_b = np.minimum(limit_a, before[pair]), np.minimum(limit_b, before[pair] - 1)
        # Of two equal merges the left one comes first: the left token keeps its piece, the right one loses it.
        crossing = (rank < limit_a) & (rank <= limit_b)
        out = np.ones(len(a), dtype=bool)
        out[pair[crossing]] = False
        return out

    def propose(self, word: str) -> list[int]:
        """Greedy longest matches from the left; every single letter is in the vocabulary."""
        ids, longest, out, at = self.ids, self.longest, [], 0
        while at < len(word):
            end = at + longest.get(word[at : at + 2], 1)
            while word[at:end] not in ids:
                end -= 1
            out.append(ids[word[at:end]])
            at = end
        return out

    def exact(self, word: str) -> list[int]:
        """All merges in order of rank, leftmost first among equals.

        A short word is a list that is searched for its lowest rank; a long one is linked, with a
        heap of its merges.
        """
        if len(word) > 64:
            return self._exact_long(word)
        token = [self.ids[c] for c in word]
        find, none = self.rank.get, (len(self.rank), -1)
        ranks = [find(pair, none) for pair in zip(token, token[1:], strict=False)]
        while ranks and (lowest := min(ranks)) is not none:
            i = ranks.index(lowest)
            token[i : i + 2] = [lowest[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = find((token[i - 1], token[i]), none)
            if i < len(ranks):
                ranks[i] = find((token[i], token[i + 1]), none)
        return token

    def _exact_long(self, word: str) -> list[int]:
        token = [self.ids[c] for c in word]
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(token) and (m := self.rank.get((token[i], token[after[i]]))):
                heapq.heappush(heap, (m[0], i, token[i], token[after[i]], m[1]))

        for i in range(len(token) - 1):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= len(token) or token[j] != b:
                continue
            token[i], token[j], after[i] = merged, -1, after[j]
            if after[i] < len(token):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [t for t in token if t >= 0]

    def proposals(self, letters: np.ndarray) -> np.ndarray:
        """Greedy longest matches of many words at once: rows of bytes, -1 behind each, to rows of tokens.

        All words walk the tree together, a byte a step; a word that can go no farther takes the last
        token it passed and starts again behind it.
        """
        n, width = letters.shape
        out = np.full((n, width), -1, dtype=np.int32)
        padded = np.concatenate([letters, np.full((n, 1), -1, dtype=letters.dtype)], axis=1)
        rows, place, taken = np.arange(n), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        node, token, end = np.zeros(n, dtype=np.int32), np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.int64)
        while len(rows):
            letter = padded[rows, place]
            step = self.tree.ranks(node, letter)
            on = step < self.tree.never
            node = np.where(on, self.tree.made[np.where(on, step, 0)], 0)
            place = place + on
            found = np.where(on, self.token_at[node], -1)
            token, end = np.where(found >= 0, found, token), np.where(found >= 0, place, end)
            stuck = np.flatnonzero(~on)
            out[rows[stuck], taken[stuck]] = token[stuck]
            taken[stuck] += 1
            place[stuck], token[stuck] = end[stuck], -1
            left = on.copy()
            left[stuck] = padded[rows[stuck], place[stuck]] >= 0
            if not left.all():
                rows, place, taken, node, token, end = (x[left] for x in (rows, place, taken, node, token, end))
        return out

    def matrix(self, letters: np.ndarray) -> tuple[np.ndarray, int]:
        """Tokens of words that are rows of bytes, -1 behind each, and how many had to be merged exactly."""
        tokens = self.proposals(letters)
        held = tokens >= 0
        good = (self.sound[np.where(held, tokens, 0)] | ~held).all(axis=1)
        inside = np.flatnonzero((held[:, 1:] & held[:, :-1]).ravel())
        if len(inside):
            flat = np.stack([tokens[:, :-1].ravel()[inside], tokens[:, 1:].ravel()[inside]]).astype(np.int64)
            pairs, back = np.unique((flat[0] << 32) | flat[1], return_inverse=True)
            safe = self.safe(pairs >> 32, pairs & 0xFFFFFFFF)[back]
            good[inside[~safe] // (tokens.shape[1] - 1)] = False
        failed = np.flatnonzero(~good)
        if len(failed):
            own = letters[failed]
            tokens[failed] = self.pairs.merge(np.where(own >= 0, self.of_byte[np.maximum(own, 0)], np.int32(-1)))
        return tokens, len(failed)

    def short_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids of words of at most SHORT bytes, one after the other, how many each has, and how many were merged exactly."""
        places, data = buffers(words)
        starts, sizes = places[:-1], np.diff(places)
        counts, failed = np.zeros(len(words), dtype=np.int64), 0
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for low, high in ((1, 3), (4, 5), (6, 7), (8, 10), (11, 14), (15, 24), (25, SHORT)):
            every = np.flatnonzero((sizes >= low) & (sizes <= high))
            for at in np.split(every, range(_ROWS, len(every), _ROWS)):
                if not len(at):
                    continue
                columns = np.arange(high)
                inside = columns[None, :] < sizes[at][:, None]
                letters = data[np.minimum(starts[at][:, None] + columns[None, :], len(data) - 1)].astype(np.int16)
                tokens, n = self.matrix(np.where(inside, letters, np.int16(-1)))
                failed += n
                counts[at] = (tokens >= 0).sum(axis=1)
                found.append((at, tokens[tokens >= 0]))
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
        for at, values in found:
            ids[spans((ends - counts)[at], counts[at])] = values
        return ids, counts, failed

    def long_word(self, word: str) -> tuple[list[int], bool]:
        """Ids of one word in byte letters, and whether it had to be merged exactly."""
        proposed = np.array(self.propose(word), dtype=np.int64)
        if self.sound[proposed].all() and self.safe(proposed[:-1], proposed[1:]).all():
            return proposed.tolist(), False
        return self.exact(word), True


class ByteCodec:
    """Encodes and decodes whole texts; pieces between single spaces are remembered.

    A space is the last of its gap or the first of at most two: in both cases the pattern that splits
    words starts a new word there, so the pieces between spaces can be encoded apart.  Arrow cuts and
    numbers them, Python sees the distinct ones of a batch.  Texts with longer gaps, or with the
    string of a special token, are encoded one by one.
    """

    def __init__(self, path: str, budget: int = MEMO_BYTES) -> None:
        from tokenizers import pre_tokenizers

        self.merges = Merges(path)
        self.memo = Memo(budget)
        self._split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        # Every white space of the library is one here too.
        self._long_gap = re.compile(r"\s{3}").search
        self._specials = re.compile("(" + "|".join(map(re.escape, sorted(self.merges.special, key=len, reverse=True))) + ")")
        sizes = np.array([len(x) for x in self.merges.bytes], dtype=np.int64)
        self._spelled, self._sizes = np.frombuffer(b"".join(self.merges.bytes), dtype=np.uint8), sizes
        self._starts = np.cumsum(sizes) - sizes
        self._bytes = {c: b for b, c in byte_letters().items()}
        self.exactly_merged = 0

    def _coded(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that the library's pattern cuts into words."""
        split = [[w for w, _ in self._split(p)] for p in pieces]
        distinct = list({w for words in split for w in words})
        plain = [bytes(self._bytes[c] for c in w) for w in distinct]
        short = [k for k, w in enumerate(plain) if len(w) <= SHORT]
        known = {}
        if short:
            ids, counts, failed = self.merges.short_words(pa.array([plain[k] for k in short], pa.binary()).view(pa.string()))
            self.exactly_merged += failed
            known |= {distinct[k]: x.tobytes() for k, x in zip(short, np.split(ids, np.cumsum(counts)[:-1]), strict=True)}
        for word, body in zip(distinct, plain, strict=True):
            if len(body) > SHORT:
                ids, exact = self.merges.long_word(word)
                self.exactly_merged += exact
                known[word] = np.array(ids, dtype="<u4").tobytes()
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def _distinct(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after the other, and how many each has.

        Pieces in letters below U+0180 are cut into words here, all at once; the others are cut by the
        library and remembered.
        """
        places, data = buffers(pieces)
        odd = np.concatenate([[0], np.cumsum((kinds_of(data) == OTHER) & (data != ord(" ")))])
        known = (odd[places[1:]] == odd[places[:-1]]) & (np.diff(places) <= SHORT)
        counts = np.zeros(len(pieces), dtype=np.int64)
        ids = np.empty(0, dtype="<u4")
        if known.any():
            places, data = buffers(pieces.filter(pa.array(known)))
            starts = piece_starts(data, kinds_of(data), places[:-1][np.diff(places) > 0], lone_numbers=False)
            offsets = np.append(starts, len(data)).astype(np.int32)
            words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
            at = words.indices.to_numpy()
            each, sizes, failed = self.merges.short_words(words.dictionary)
            self.exactly_merged += failed
            ends = np.concatenate([[0], np.cumsum(sizes[at])])
            counts[known] = np.diff(ends[np.searchsorted(starts, places)])
            ids = each[spans((np.cumsum(sizes) - sizes)[at], sizes[at])]
        if known.all():
            return ids, counts
        names = pieces.filter(pa.array(~known)).view(pa.binary()).to_pylist()
        names = [x.decode("utf-8", "replace") for x in names]
        found = self.memo.fill(set(names), self._coded)
        coded = [found[n] for n in names]
        sizes = counts.copy()
        sizes[~known] = [len(x) // 4 for x in coded]
        starts = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), dtype="<u4")
        out[spans(starts[known], sizes[known])] = ids
        out[spans(starts[~known], sizes[~known])] = np.frombuffer(b"".join(coded), dtype="<u4")
        return out, sizes

    def _whole(self, text: str) -> bytes:
        """Ids of one text; the strings of special tokens become those tokens, as the library has it."""
        special, out = self.merges.special, []
        for part in self._specials.split(text) if special else [text]:
            if part in special:
                out.append(np.array([special[part]], dtype="<u4").tobytes())
            elif part:
                out += self._coded([part])
        return b"".join(out)

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that can be cut at every space, one after the other, and how many each has."""
        cut = pc.split_pattern(texts, " ")
        words = cut.flatten().dictionary_encode()
        names, at = words.dictionary, words.indices.to_numpy()
        places = cut.offsets.to_numpy().astype(np.int64)
        places -= places[0]
        # The first piece of a text has no space before it, the others have one.
        spaced = np.ones(len(at), dtype=np.int64)
        spaced[places[:-1]] = 0
        used = np.zeros((2, len(names)), dtype=bool)
        used[spaced, at] = True
        bare, behind = np.flatnonzero(used[0]), np.flatnonzero(used[1])
        pieces = [names.take(pa.array(bare)), pc.binary_join_element_wise(" ", names.take(pa.array(behind)), "")]
        ids, sizes = self._distinct(pa.concat_arrays([x.cast(pa.string()) for x in pieces]))
        number = np.zeros((2, len(names)), dtype=np.int64)
        number[0, bare], number[1, behind] = np.arange(len(bare)), len(bare) + np.arange(len(behind))
        each = number[spaced, at]
        ends = np.concatenate([[0], np.cumsum(sizes[each])])
        return ids[spans((np.cumsum(sizes) - sizes)[each], sizes[each])], ends[places[1:]] - ends[places[:-1]]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column, one text after the other, and how many each text has."""
        texts = texts.fill_null("")
        whole = [
            k for k, x in enumerate(texts.view(pa.binary()).to_pylist())
            if self._long_gap(x.decode("utf-8", "replace")) or any(s.encode() in x for s in self.merges.special)
        ]
        if not whole:
            return self._by_pieces(texts) if len(texts) else (np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64))
        alone = np.zeros(len(texts), dtype=bool)
        alone[whole] = True
        coded = [self._whole(texts[k].as_buffer().to_pybytes().decode("utf-8", "replace")) for k in whole]
        rest = texts.filter(pa.array(~alone))
        ids, sizes = self._by_pieces(rest) if len(rest) else (np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64))
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[alone], counts[~alone] = [len(x) // 4 for x in coded], sizes
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), dtype="<u4")
        out[spans(starts[~alone], sizes)] = ids
        out[spans(starts[alone], counts[alone])] = np.frombuffer(b"".join(coded), dtype="<u4")
        return out, counts

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode_column(pa.array(texts, pa.binary()).view(pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []

    def spell(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes that the ids of each text stand for, special tokens kept; what is no UTF-8 becomes U+FFFD."""
        ids = ids.astype(np.int64)
        sizes = self._sizes[ids]
        body = self._spelled[spans(self._starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [_proper(body[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of ids, special tokens kept; bytes that are no UTF-8 become U+FFFD."""
        each = [np.frombuffer(x, dtype="<u4") for x in ids]
        counts = np.array([len(x) for x in each], dtype=np.int64)
        return [x.decode() for x in self.spell(np.concatenate([np.empty(0, dtype="<u4"), *each]), counts)]


def _proper(text: bytes) -> bytes:
    try:
        text.decode()
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode()
    return text


def codec(path: str) -> ByteCodec:
    """One per Python worker, kept until the worker turns to another operator."""
    return resident(("codec", path), lambda: ByteCodec(path))


def bpe_encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the token ids of the whole text, little-endian unsigned 32-bit, as binary.

    A null text has no ids, like an empty one.  Other columns pass through; one named like ``ids``
    is replaced.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop(ids).withColumn(text, text_of(text))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            values = own.encode(utf8(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], names=[*batch.schema.names, ids])

    return kept.mapInArrow(coded, StructType([*kept.schema, StructField(ids, BinaryType())]))


def bpe_decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``decoded``: the text of the ids, special tokens kept.  Null ids give an empty text."""
    small_batches(tokens.sparkSession)
    kept = tokens.drop(text)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            values = own.decode([x or b"" for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.string())], names=[*batch.schema.names, text])

    return kept.mapInArrow(decoded, StructType([*kept.schema, StructField(text, StringType())]))


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text of every row.

    Each text is encoded and decoded where it is read, so neither ids nor texts move.  A null text
    is empty, ids may be null or repeat, every row is returned; only the two named columns are
    read, so others may have any name.  An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    read = docs.select(F.col(id_col).alias("doc_id"), text_of(text).alias("text"))
    kind = read.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            ids, counts = own.encode_column(batch.column(1))
            ends = 4 * np.concatenate([[0], np.cumsum(counts)])
            body = memoryview(ids.tobytes())
            coded = [hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            spelled = [hashlib.sha256(x).hexdigest() for x in own.spell(ids, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(coded, pa.string()), pa.array(spelled, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        release()

    return read.mapInArrow(run, f"doc_id {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
