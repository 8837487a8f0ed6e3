"""Repair of conversation structure on an automaton that shares the ends of all conversations.

Rows are reduced to a letter each: the role's initial and the fault decide what edits cost, nothing
else does.  A conversation is the word of its letters.  Equal words are solved once.  Distinct words
are sorted from their ends, and a task reads them with a stack whose entries are the nodes of the
automaton: a node is an end that words share, it is made when the first of them comes and stays
while others with that end follow.  For each node and state of the role grammar the least cost to
finish and the first edit of the best audit are found once, from the cost of the node behind it.
An audit is then read along the word.

Texts are moved once, behind the audit of their conversation, and hashed as they pass.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from ..operators.skew import split_join
from .support import ship

BLANK_LETTERS = " \t\n\x0b\f\r"
SENTENCE_ENDS = ".!?"
DROP, EMPTY, UNENDED, REPEAT, AS_USER = range(5)
ROUNDS = 20

# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_WANTED = ("u", "u", "a", "u")  # the role to insert or to rerole to
_REACHED = (USER, USER, ASSISTANT, USER)
_NAME = {"u": "user", "a": "assistant"}
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
_MUST_GO = "x"
_LEGAL = {"su", "ua", "au"}

Node = tuple[tuple[int, ...], str]


def _with_inserts(best: list[tuple[int, str]]) -> Node:
    """Let rows be inserted before the best edit of each state; three in a row never pay."""
    for _ in range(3):
        best = [min(best[s], (INSERT + best[_REACHED[s]][0], "I")) for s in range(4)]
    return tuple(c for c, _ in best), "".join(e for _, e in best)


_NEVER = 1 << 60
#: The empty end: nothing or whole pairs may stop here, marked by a dot.
LAST: Node = _with_inserts([(0, "."), (_NEVER, "."), (_NEVER, "."), (0, ".")])


def node(letter: str, behind: tuple[int, ...]) -> Node:
    """Cost to go and first edit of each state, for an end that starts with ``letter``.

    Edits with equal cost are told apart by their initials, and no two edits of a state share one,
    so the least first initial gives the least audit.
    """
    if letter == _MUST_GO:
        return _with_inserts([(DELETE + behind[s], "D") for s in range(4)])
    extra = TRUNCATED * letter.isupper()
    kept = _KEPT[letter.lower()]
    best = []
    for s in range(4):
        edits = [(DELETE + behind[s], "D"), (REROLE + extra + behind[_REACHED[s]], "R")]
        if s in kept:
            edits.append((extra + behind[kept[s]], "K"))
        best.append(min(edits))
    return _with_inserts(best)


def read_audit(word: str, first_edits: list[str]) -> str:
    """Follow the best edits along the word; ``first_edits`` has those of every position and of the end."""
    at, state, out = 0, START, []
    while (edit := first_edits[at][state]) != ".":
        out.append(edit)
        if edit == "K":
            state = _KEPT[word[at].lower()][state]
        elif edit in "RI":
            state = _REACHED[state]
        at += edit != "I"
    return "".join(out)


class Ends:
    """The path of automaton nodes that belongs to the last word; words come sorted from their ends."""

    def __init__(self) -> None:
        self.word = ""  # reversed
        self.costs, self.edits = array("q", LAST[0]), [LAST[1]]
        self.made = 0

    def solve(self, from_end: str) -> tuple[int, str]:
        """Cost and audit of the word that is spelled backwards in ``from_end``."""
        shared, most = 0, min(len(from_end), len(self.word))
        while shared < most and from_end[shared] == self.word[shared]:
            shared += 1
        del self.costs[4 * (shared + 1) :], self.edits[shared + 1 :]
        for letter in from_end[shared:]:
            costs, edits = node(letter, tuple(self.costs[-4:]))
            self.costs.extend(costs)
            self.edits.append(_INTERNED.setdefault(edits, edits))
            self.made += 1
        self.word = from_end
        return self.costs[-4 + START], read_audit(from_end[::-1], self.edits[::-1])


_INTERNED: dict[str, str] = {}


def solutions(words: DataFrame) -> DataFrame:
    """``word``, ``cost`` and ``audit`` of every distinct value of ``word``.

    Words are range-partitioned by their last letters, so those with a long common end meet in one
    task; a node is made again only in a task that begins inside its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = Ends()
        for batch in batches:
            backwards = batch.column(0).to_pylist()
            solved = [ends.solve(b) for b in backwards]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b[::-1] for b in backwards], pa.string()), pa.array([c for c, _ in solved], pa.int64()),
                 pa.array([a for _, a in solved], pa.string())],
                names=["word", "cost", "audit"],
            )

    backwards = words.select(F.reverse("word").alias("b")).distinct()
    dealt = backwards.repartitionByRange(F.substring("b", 1, 32)).sortWithinPartitions("b")
    return dealt.mapInArrow(run, "word string, cost long, audit string")


def damaged(turns: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role`` and ``text`` of the rows after damage by the checksum of ``conv:turn``.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it
    and 4 makes it the user's.  Nulls are read as one space; ``conv`` is the id as text.
    """
    read = turns.select(_as_text(id_col).alias("conv"), F.col(turn).cast("long").alias("turn"), _as_text(role).alias("role"), _as_text(text).alias("text"))
    rest = F.crc32(F.concat_ws(":", "conv", _as_text("turn"))) % ROUNDS
    hurt = (
        F.when(rest == EMPTY, F.lit("")).when(rest == UNENDED, F.translate("text", SENTENCE_ENDS, "")).otherwise(F.col("text"))
    )
    return read.where(rest != DROP).select(
        "conv",
        "turn",
        F.when(rest == AS_USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        hurt.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(rest == REPEAT, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def _as_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


# Ascending, with null turns first.
_IN_ORDER = ("conv", "turn", "role", "digest")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _with_faults(rows: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``digest``, ``fault`` (b, t or empty) and ``later``: said in an earlier turn.

    The first turn of texts said more than once is found by an aggregate, so neither a long
    conversation nor a text repeated throughout it meets in one task.
    """
    narrow = rows.drop("text")
    first = (
        narrow.groupBy("conv", "role", "digest")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("_first"))
        .where("_n > 1")
        .select("conv", "role", "digest", F.lit(True).alias("_again"), F.col("_first.turn").alias("_first"))
    )
    joined = split_join(narrow, first, ["conv", "role", "digest"], "left")
    later = F.coalesce("_again", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("_first"))
    return joined.select("conv", "turn", "role", "digest", "fault", later.alias("later"))


def _words(rows: DataFrame) -> DataFrame:
    """One row per conversation: its word and counts.  Rows pass in order and are not held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, word, before, low, high, turns, counts, illegal = None, bytearray(), None, None, None, 0, {}, 0

        def close() -> None:
            if conv is not None:
                gaps = 0 if low is None else high - low + 1 - turns
                out.append((conv, word.decode(), gaps, counts["b"], counts["d"], counts["t"], illegal))

        for batch in batches:
            for c, turn, role, digest, fault, later in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if c != conv:
                    close()
                    conv, word, before, low, high, turns, illegal = c, bytearray(), None, None, None, 0, 0
                    counts = dict.fromkeys("bdt", 0)
                if turn is not None:
                    turns += turn != high
                    low, high = turn if low is None else low, turn
                if before is not None and before[1][:1] + role[:1] not in _LEGAL:
                    illegal += 1
                if not fault == "b" and (later or (turn, role, digest) == before):
                    fault = "d"
                before = (turn, role, digest)
                if fault:
                    counts[fault] += 1
                letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
                word += (_MUST_GO if fault in ("b", "d") else letter.upper() if fault else letter).encode()
            if len(out) >= 4096:
                yield as_batch(out)
                out.clear()
        close()
        yield as_batch(out)

    names = ["conv", "word", *_COUNTS]
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    dealt = rows.select("conv", "turn", "role", "digest", "fault", "later").repartition("conv").sortWithinPartitions(*_IN_ORDER)
    return dealt.mapInArrow(run, "conv string, word string, " + ", ".join(f"{c} long" for c in _COUNTS))


class Repaired:
    """Hash of a conversation's repaired rows, fed row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START
        self.hash, self.rows = hashlib.sha256(), 0

    def _write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
        self.rows += 1

    def insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(_NAME[_WANTED[self.state]], "")
            self.state, self.at = _REACHED[self.state], self.at + 1

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._write(role, text)
            self.state = _KEPT[role[0]][self.state]
        elif edit == "R":
            self._write(_NAME[_WANTED[self.state]], text)
            self.state = _REACHED[self.state]

    def digest(self) -> str:
        self.insert()
        return self.hash.hexdigest()


def _repaired(audits: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``repaired_sha256`` to the audits; the rows of a conversation pass behind its audit."""
    behind = rows.select("conv", "turn", "role", "digest", "text", F.lit(None).cast("array<long>").alias("counts"))
    front = audits.select(
        "conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"), F.array(*_COUNTS, "cost").alias("counts"),
    )
    stream = front.unionByName(behind).withColumn("_row", F.col("counts").isNull())
    conv, *others = _IN_ORDER
    stream = stream.repartition("conv").sortWithinPartitions(conv, "_row", *others).select("conv", "role", "text", "counts")
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    names = ["conv", *_COUNTS, "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, made, out = None, None, []
        for batch in batches:
            for c, role, text, counts in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if counts is None:
                    made.row(role, text)
                    continue
                if head:
                    out.append((*head, made.digest()))
                head, made = (c, *counts, text), Repaired(text)
            if len(out) >= 4096:
                yield as_batch(out)
                out.clear()
        if head:
            out.append((*head, made.digest()))
        yield as_batch(out)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    longs = ", ".join(f"{c} long" for c in (*_COUNTS, "cost"))
    return stream.mapInArrow(run, f"conv string, {longs}, audit string, repaired_sha256 string")


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """``conv``, counts of faults, ``cost``, ``audit`` and ``repaired_sha256`` of each conversation.

    ``rows`` has ``conv`` (text, not null), ``turn``, ``role`` and ``text``; ``every`` has the
    ``conv`` of all conversations that are to be answered.  A conversation's rows are taken by
    turn, null turns first, rows with equal turns by role and digest of their text.  One without
    rows has zeros, an empty audit and the hash of nothing.  A conversation of any length passes
    row by row through one task, as a hash over its text must; that task holds one letter and one
    edit per row.
    """
    ship(rows.sparkSession)
    trimmed = F.rtrim("text", F.lit(BLANK_LETTERS))
    ended = F.right(trimmed, F.lit(1)).isin(*SENTENCE_ENDS)
    fault = F.when(trimmed == "", F.lit("b")).when(~ended, F.lit("t")).otherwise(F.lit(""))
    held = materialise(
        rows.select("conv", "turn", "role", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), fault.alias("fault")),
        "damaged-turns",
    )
    words = materialise(_words(_with_faults(held)), "conversation-words")
    solved = split_join(words, materialise(solutions(words), "word-audits"), ["word"])
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in (*_COUNTS, "cost")}
    audits = every.select("conv").distinct().join(solved, "conv", "left").withColumns(zeros | {"audit": F.coalesce("audit", F.lit(""))})
    return _repaired(audits, held)


def damage_and_repair(turns: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage the table, repair it, and return one row per original conversation id.

    Nulls in id, role and text are read as one space; a null id is a conversation of its own and
    comes back null.  Repeated rows are duplicates.  Only the four named columns are read, so others
    may have any name.  An empty table gives no rows; texts may have any length.
    """
    every = turns.select(_as_text(id_col).alias("conv"))
    found = repair(damaged(turns, id_col, turn, role, text), every)
    kind = turns.schema[id_col].dataType
    return found.withColumn(id_col, F.when(F.col("conv") != " ", F.col("conv").cast(kind))).select(
        id_col, *_COUNTS, "cost", "audit", "repaired_sha256"
    )
