"""Documents with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators might use inside; as columns of the input they must do no harm.
CLASHING = ["fp", "_raw", "key", "size", "draws", "blob", "spans", "a", "b", "node", "root", "component_id", "target", "score"]


def prose(draw: random.Random, n: int) -> str:
    return " ".join("".join(draw.choice(["th", "er", "on", "an", "re", "ed", "nd"]) for _ in range(draw.randint(1, 4))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    draw = random.Random(5)
    texts = [prose(draw, draw.randint(1, 120)) for _ in range(60)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    n = len(rows)
    long = prose(draw, 20_000)
    rows += [
        (n, None, "en", "src0", 0), (n + 1, "", "en", "src1", 0), (n + 2, " \t\n", None, None, 3),
        (n + 3, long, "en", "src0", len(long)), (n + 4, long + " end", "en", None, None),
        (n + 5, texts[0], "en", "src2", 1), (n + 6, texts[0].upper(), "en", "Src", 1), (n + 7, texts[1] + " x", "en", "src1", 1),
        (None, texts[2], "en", "src1", 1), (3, texts[3], "en", "src0", len(texts[3])),
        (n + 8, "Ünïcode 日本語 \U0001f600 token", "de", "é", 1), (n + 9, "one", "en", "src0", 3), (n + 10, "one two", "en", "src0", 7),
    ]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    from pyspark.sql import functions as F

    return awkward.withColumns({c: F.lit("taken") for c in CLASHING})


@pytest.fixture(scope="session")
def write(tmp_path_factory):
    """Write frames as the tables of a sample folder and return its path."""

    def to(**tables):
        folder = tmp_path_factory.mktemp("sample")
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return to
