import random

import pytest

LONG = " ".join(f"wort{i % 977}x{i % 31}" for i in range(30_000))


def passage(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Edge texts by id: NULL, empty, blank, short, very long, copies, near copies, shared passages, repeats inside."""
    shared, base = passage(1, 60), passage(2, 120)
    near = base.split()
    near[50] = "geändert"
    rows = [None, "", "   \n\t ", "Ein", "ein wort mehr", LONG, base, base, " ".join(near), base + "\n", passage(3, 40) + " " + shared]
    rows += [shared + " " + passage(4, 50), passage(5, 30) + " " + shared + " " + passage(6, 30) + "\n" + shared, "na " * 200]
    rows += ["ü" * 130, "ü" * 129, passage(7, 20), passage(7, 20).upper(), "x" * 99, "x" * 100, LONG + " ende"]
    rows += [f"{passage(100 + i, 25 + i)} {shared[: 5 * i]} {passage(200 + i, 10)}" for i in range(20)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with ids 10, 11, ..., one row repeated, a row without id, and columns named like the operators' own."""
    rows = [(10 + i, t, "de", "src", None if t is None else len(t), "x", 1) for i, t in enumerate(texts)]
    rows += [rows[6], (None, texts[16], None, None, None, None, None)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, key STRING, place INT"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
