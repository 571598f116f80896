import random

import pytest

CLASHING = ("row", "size", "shard", "score", "fp", "class", "key", "tokens", "rate", "kept", "bucket", "place", "chunk", "blob", "id", "h")


def make_rows():
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows and ids."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghiklmnoprstuéüñ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = prose(60)
    rows = [(k, prose(rng.randint(20, 200)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for k in range(40)]
    rows += [(50 + k, prose(30) + "\n" + passage + " " + prose(30), "en", "a") for k in range(6)]
    copy = prose(120)
    rows += [(60 + k, copy, "en", "a") for k in range(8)]
    rows += [(70 + k, copy + f" tail{k}", "en", "b") for k in range(6)]
    rows += [(80, None, "en", "a"), (81, "", None, None), (82, " \t\n\x0b\x0c\r ", "en", "a"), (83, "one", "en", "a"), (84, "One", "en", "b"),
             (85, "\x00\x1c 中文 🙂 é ß İ <|endoftext|> it's 42", "en", "b"), (86, "x" * 5000, "en", "a"), (87, "ab " * 4000, "en", "a"),
             (88, prose(6000), "de", "b"), (89, "#### $$ || <b> " * 40, "en", "a"), (None, prose(50), "en", "a"), (None, None, None, None),
             (7, rows[7][1], "en", "a"), (7, prose(40), "en", "a"), (-5, passage, "en", "a"), (2**40, passage, "en", "a")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, len(r[1] or ""), *CLASHING) for r in rows], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], int(r[0] % 4 > 0), int(r[0] % 7 == 0)) for r in rows if r[0] is not None] + [(None, 1, 0), (3, None, None)],
                                 "doc_id long, quality int, toxic int")
