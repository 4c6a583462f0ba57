import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as extra columns of the input.
CLASHING = "row string, key string, words array<string>, fp long, n int, copies int, score string, held_out int"


@pytest.fixture()
def table_of(spark):
    """(doc_id, text) rows as documents with extra columns of clashing names."""

    def make(rows, **langs):
        full = [(d, t, langs.get("lang", {}).get(d), None, None, "r", None, None, 7, 8, 9, "s", 1) for d, t in rows]
        return spark.createDataFrame(full, f"{SCHEMA}, {CLASHING}").repartition(3)

    return make


@pytest.fixture()
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, ids that repeat with another text, one-word texts."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(1, 4))) for _ in range(60)]
    long = " ".join(rng.choices(words, k=30_000))
    base = " ".join(rng.choices(words, k=60))
    return [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (None, None), (4, "word"), (5, "Word"),
            (6, base), (7, base.upper()), (7, base.upper()), (8, base + " tail"), (8, "another text of this id"),
            (9, long), (10, long + " x"), (11, "Éa été ÉA"), (12, "éa été éa"), (13, "K K ß \U0001f600 x"),
            (14, "a " * 5000), (15, "!!! ... ---"), (2 ** 62 + 1, "an id that no double holds")]
