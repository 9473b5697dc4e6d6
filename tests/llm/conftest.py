"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

import itertools
import random

import pytest

_number = itertools.count()


@pytest.fixture(scope="session")
def save(spark, tmp_path_factory):
    """Write rows as a parquet table and read it back, as the operators expect files."""
    base = tmp_path_factory.mktemp("tables")

    def write(rows, schema, files=2):
        path = str(base / f"t{next(_number)}")
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, _row int, weight string"


def doc_rows(seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(60)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared = text(60)
    rows = []
    for i in range(60):
        body = text(rng.choice([1, 2, 5, 30, 80]))
        if i % 5 == 0:
            body = f"{text(10)}  {shared}\n{text(12)}"
        rows.append([i, body, rng.choice(["en", "de"]), f"src{i % 3}"])
    big = text(3000)
    rows += [[100, big, "en", "src0"], [101, big.upper(), "en", "src0"], [102, big + " end", "en", "src0"],
             [103, "", "en", "src1"], [104, None, "en", None], [105, " \t\n ", None, "src1"], [106, "1234 !!", "en", "src2"],
             [107, "Été à la plage, ÉTÉ", "fr", "src9"], [108, "été à la plage, été", "fr", "src9"], [5, rows[5][1], "en", "src2"],
             [5, rows[5][1], "en", "src2"], [None, rows[7][1], "en", "src0"], [None, None, None, None],
             [109, rows[9][1].upper(), "en", "src1"], [110, shared, "en", "src1"], [111, shared, "en", "src1"]]
    return [(*r, len(r[1]) if r[1] else None, "x", 7, "y") for r in rows]


@pytest.fixture(scope="session")
def docs(save):
    return save(doc_rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def empty_docs(save):
    return save([], DOC_SCHEMA, files=1)


def texts_of(rows):
    return [(r[0], r[1] or "") for r in rows]
