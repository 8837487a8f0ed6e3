import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewright.llm import turns

GRAMMAR = re.compile(r"(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string"


def every_edit(word):
    """Least cost and audit of a word, over all edits with at most two inserted rows in a place."""
    inserts = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = (10**9, "")
    kinds = [["D"] if c == "x" else ["D", "K", "Ru", "Ra"] for c in word]
    for edits in itertools.product(*kinds):
        for placed in itertools.product(inserts, repeat=len(word) + 1):
            cost, audit, roles = 0, "", ""
            for c, edit, new in zip(word, edits, placed, strict=False):
                audit += "I" * len(new) + edit[0]
                cost += 2 * len(new) + {"D": 3, "K": 0, "R": 2}[edit[0]] + (c.isupper() and edit != "D")
                roles += new + {"D": "", "K": c.lower(), "R": edit[1:]}[edit[0]]
            audit, cost, roles = audit + "I" * len(placed[-1]), cost + 2 * len(placed[-1]), roles + placed[-1]
            if GRAMMAR.fullmatch(roles):
                best = min(best, (cost, audit))
    return best


@pytest.mark.parametrize("length", [0, 1, 2])
def test_words_against_all_edits(length):
    ends = turns.Ends()
    for word in sorted(map("".join, itertools.product("suaoSUAOx", repeat=length)), key=lambda w: w[::-1]):
        assert ends.solve(word[::-1]) == every_edit(word), word


@settings(max_examples=20, deadline=None)
@given(word=st.text("suaoSUAx", min_size=3, max_size=3))
def test_longer_words_against_all_edits(word):
    assert turns.Ends().solve(word[::-1]) == every_edit(word)


def test_every_end_is_made_once():
    rng = random.Random(3)
    words = {"".join(rng.choice("uaUx") for _ in range(rng.randint(0, 9))) for _ in range(500)}
    ends = turns.Ends()
    found = {w: ends.solve(w[::-1]) for w in sorted(words, key=lambda w: w[::-1])}
    assert ends.made == len({w[i:] for w in words for i in range(len(w))})
    assert all(turns.Ends().solve(w[::-1]) == x for w, x in found.items())


def plainly(rows):
    """Damage and repair one conversation after another."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
            if kind == 1:
                text = ""
            if kind == 2:
                text = re.sub("[.!?]", "", text)
            if kind == 4:
                role = "user"
            kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in kept:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("b" if not said else "d" if (role, text) in seen else "" if said[-1] in ".!?" else "t")
            seen.add((role, text))
        roles = [r[1][:1] for r in kept]
        numbers = [r[0] for r in kept if r[0] is not None]
        letters = [r if r in ("s", "u", "a") else "o" for r in roles]
        word = "".join("x" if f in ("b", "d") else c.upper() if f else c for c, f in zip(letters, faults, strict=True))
        cost, audit = cheapest(word)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(roles)), cost, audit, edited(kept, audit),
        )
    return out


def cheapest(word):
    """Cheapest first: partial repairs in order of cost and audit, until one is whole."""
    import heapq

    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        state = roles[-1:] if roles else "-"
        if (at, state) in done:
            continue
        if at == len(word) and GRAMMAR.fullmatch(roles):
            return cost, audit
        done.add((at, state))
        for new in "ua":
            if re.fullmatch(r"s?(ua)*u?", roles + new):
                heapq.heappush(heap, (cost + 2, audit + "I", at, roles + new))
        if at < len(word):
            c = word[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles))
            for edit, new in () if c == "x" else (("K", c.lower()), ("R", "u"), ("R", "a")):
                if re.fullmatch(r"s?(ua)*u?", roles + new):
                    heapq.heappush(heap, (cost + 2 * (edit == "R") + c.isupper(), audit + edit, at + 1, roles + new))
    raise AssertionError


def edited(kept, audit):
    lines, rest = [], iter(kept)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rest)[1:]
        if edit in "IR":
            role = "assistant" if lines and lines[-1][0] == "u" else "user"
        if edit != "D":
            lines.append(f"{role}:{text}")
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def odd_conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "open", "  ", "", "done. \n", None, "é…", "Yes."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [*range(250), None]:
        size = rng.choice([1, 2, 4, 6, 9])
        for t in range(size):
            turn = None if rng.random() < 0.05 else t + 2 * (rng.random() < 0.1)
            role = ("user", "assistant")[t % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = f"Turn {t}." if rng.random() < 0.5 else rng.choice(texts)
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 1, 2])
    rows += [(900, t, ("user", "assistant")[t % 2], f"Said {t}.") for t in range(3000)]
    return rows


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_conversations_against_a_plain_version(spark, broadcast):
    rows = odd_conversations()
    table = spark.createDataFrame(rows, ROWS).repartition(5).selectExpr("*", "'x' as conv", "1 as word", "role as fault", "2L as counts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = turns.damage_and_repair(table).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert {r[0]: tuple(r[1:]) for r in got} == plainly(rows)
    assert len(got) == len({r[0] for r in rows})


def test_a_conversation_that_loses_all_rows_and_an_empty_table(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(lost, 0, "user", "Hello.")], ROWS)
    row = turns.damage_and_repair(table).first()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert turns.damage_and_repair(table.limit(0)).collect() == []


def test_the_query(spark):
    from tidewright.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, folder)
    assert dict(got.dtypes) == {
        "conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint",
        "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string",
    }
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == plainly(rows)
