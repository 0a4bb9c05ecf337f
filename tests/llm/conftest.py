import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, word string, _id long, digest string"


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: none, empty, blank, one word, very long, ties, copies, other scripts, control characters."""
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice("the of and river bridge water late news Élan ß 你好 12 don't").strip() + rng.choice("abcdefgh") * rng.randint(1, 3)
                              for _ in range(n))
    base = some(300)
    out = {1: None, 2: "", 3: " \n\t ", 4: "word", 5: some(20_000), 6: base, 7: base.replace(" ", "\n"), 8: base + "  ",
           9: base.replace("river", "rover", 1), 10: "a b", 11: "a\x00b \x1f\x7f c", 12: "x" * 50_000, 13: "idiot " * 400,
           14: "Released under the MIT License.", 15: "released under the MIT licence, and cc-by-nc CC BY NC cc by nc cc",
           16: "This work is now licensed under the GNU General Public License, version 3, they say"}
    out |= {20 + i: some(rng.randint(3, 200)) for i in range(30)}
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents with further columns whose names others may use, one row repeated, one without an id."""
    rows = [(i, t, None, "s", None, 9.0, "w", -1, "x") for i, t in texts.items()]
    return spark.createDataFrame([*rows, rows[5], (None, texts[21], *rows[0][2:])], SCHEMA)


@pytest.fixture(scope="session")
def unique_docs(docs):
    return docs.filter("doc_id is not null").dropDuplicates(["doc_id"])


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
