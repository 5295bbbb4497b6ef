import pytest

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
                     T.StructField("row", T.LongType()), T.StructField("new", T.LongType())])


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n)) + "."


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, ties and repeats."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), None, "", " \n\t ", "x", prose(2, 80), prose(3, 60_000), "é \x85 \x1f a b",
             "word " * 100, "*** $$$ " * 60, prose(4, 300), prose(5, 55), prose(6, 55), base.upper(),
             "mail bob.42@mail6.example.com or +1 (523) 555-1055 card 4111 1111 1111 1111 ip 10.0.0.1 on 2020-02-29 "
             + prose(7, 60)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None, "clash", i, 5) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, prose(8, 70), None, None, None, None, None, None), (None, None, "en", "s1", 3, None, 1, 1),
             (7, prose(9, 90), "en", "s1", 3, None, 1, 1)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)
