import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source) rows, in more than one partition."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, copies, near copies, one long text and one group of variants."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = prose(120)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ttwo"), (8, prose(9000))]
    rows += [(10 + i, base) for i in range(4)]
    for i in range(60):
        changed = base.split()
        for _ in range(rng.randint(1, 6)):
            changed[rng.randrange(len(changed))] = rng.choice(words)
        rows.append((100 + i, " ".join(changed)))
    rows += [(300 + i, prose(rng.randint(1, 60))) for i in range(25)]
    rows += [(400, "É é\u0301 <|endoftext|> don't   stop\r\n\r\n\x1c日本 🙂"), (401, "a  b   c"), (402, "a b c ")]
    return rows
