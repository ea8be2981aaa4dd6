import random

import pytest

CLASHES = ("component_id", "fp", "digest", "key", "n", "kept", "id", "row", "text_key", "n_lines", "h", "t", "label")


def words(seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice("the of and ship harbour lantern quiet river stone amber field wind north maple".split())
                    + rng.choice(["", "", "s", "ed", "ing", ","]) for _ in range(count))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, odd characters."""
    base, long = words(1, 60), words(2, 6000)
    texts = [
        (1, base), (2, base.upper()), (3, base + " tail"), (4, None), (5, ""), (6, " \n\t "), (7, long), (8, long + " end"),
        (9, "one two"), (9, "one two"), (10, "éa ß 日本 😀   x"), (None, base), (None, None), (11, words(3, 40)),
        (12, words(4, 30) + "\n" + words(1, 60)), (-5, words(5, 25)), (13, "x" * 50_000), (14, words(5, 25)),
    ]
    return [
        (i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", None if t is None else len(t), *[n] * len(CLASHES))
        for n, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd_schema():
    return "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} int" for c in CLASHES)


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, odd_schema):
    return spark.createDataFrame(odd_rows, odd_schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark, odd_schema):
    return spark.createDataFrame([], odd_schema)
