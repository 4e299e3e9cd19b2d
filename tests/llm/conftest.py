import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, kept string, shard string, row string, `odd name` int"

PROSE = " ".join(f"w{i * i % 97}x{i}" for i in range(90))
LONG = " ".join(f"v{i % 911}y{i % 1013}" for i in range(120_000))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    near = PROSE.replace("w81x9 ", "changed ")
    texts = [
        (1, PROSE, "a"), (2, near, "a"), (3, PROSE.upper(), None), (3, PROSE.upper(), None), (4, None, "a"), (5, "", "b"),
        (6, " \n\t ", "b"), (7, LONG, "a"), (8, LONG, "b"), (9, "one two", "c"), (10, "one two", "c"), (11, "Menu | Home | About | Shop", "c"),
        (None, "only words here and a few more so that it is long enough, yes.", None), (12, " x é ſ ΑΒΓ 日本語 <|endoftext|> \x1c a\r\nb", "d"),
        (13, f"{PROSE}\n{PROSE}", "a"), (14, "a " * 400, "b"),
    ]
    return [(k, t, s, None if k == 4 else "en", None if t is None else len(t), "kept?", "7", None, None if k == 1 else 5) for k, t, s in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
