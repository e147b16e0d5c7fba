"""Fixtures with rows of every odd kind."""

from __future__ import annotations

import random

import pytest

#: Extra columns named like those that operators make.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars int, "
    "kept string, row_key string, id string, body string, bucket int, spans string, slot int, shard string"
)
EXTRA = ("x", "x", "x", "x", 1, "x", 1, "x")


def odd_texts() -> list[str | None]:
    """Nulls, empty and blank texts, ties, near copies, a shared passage, a long text, odd bytes."""
    rng = random.Random(7)
    vocabulary = ["Alpha", "beta,", "gamma", "été", "δέλτα", "epsilon.", "zeta", "eta", "theta"]

    def prose(count):
        return " ".join(rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(count))

    base, passage = prose(120), prose(60)
    near = base.split()
    near[60] = "changed"
    return [
        None,
        "",
        " \n\t ",
        "one",
        "One",
        "two words",
        base,
        base,
        base.upper(),
        " ".join(near),
        base + " and more of it",
        prose(50) + "\n" + passage + "\n" + prose(40),
        passage + " " + prose(90),
        "line\n" * 30,
        "a" * 450,
        prose(3000),
        "nul \x00 byte, wide 　 space, \U0001f600 and \x85 next",
        'my Password = "hunter2hunter2" and token:short',
        "AKIA" + "Z9" * 8 + " " + "0f" * 20 + " secret==abcdefghi",
        "# $ % & | < > *** " * 20,
    ]


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    texts = odd_texts()
    rows = [
        (at, text, None if at % 5 == 0 else "en", None if at % 7 == 0 else "s", len(text or ""), *EXTRA)
        for at, text in enumerate(texts)
    ]
    rows += [rows[6], rows[0]]  # repeated as a whole
    rows += [(None, texts[12], None, None, None, *EXTRA), (None, None, None, None, None, *EXTRA)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
