import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ("copy", "ids", "found", "_base", "_spans", "_text", "range", "salt", "fp", "score", "n", "k", "node", "root", "slot", "item_id", "batch", "digest", "key", "keys", "head", "least", "wide", "sketch", "spread", "copies")


def odd_documents() -> list[tuple]:
    """Copies, near copies, shared passages, empty, null and long texts, odd characters, repeated and null ids."""
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(draw.randint(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    long, passage = say(9000), say(70)
    base = say(260)
    words = base.split()
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (5, 100, 200)]
    texts = [
        base,
        base,
        *near,
        say(30) + " " + passage + " " + say(40),
        passage + "\n" + say(5),
        say(12) + "\t" + passage,
        long,
        long[: len(long) // 2],
        "",
        None,
        " \n ",
        "one",
        "One",
        "one two",
        "ONE TWO three",
        passage.replace(" ", "  "),
        "the the " * 60,
        "x" * 5000,
        "日本語 \x00 😀 é",
        None,
        "",
        say(49),
        say(50)
    ]
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return [*rows, rows[5], (None, passage, "en", "s0", 1), (None, None, None, None, None), (3, "another text under a used id " + passage, "en", "s1", 2)]


@pytest.fixture(scope="session")
def rows():
    return odd_documents()


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

