import random

import pytest

from tests.llm.brute import made_up, mutated

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, size int, key string"


def _odd_rows():
    """Nulls, empty texts, repeated rows, copies, near copies, passages, one very long text, and clashing columns."""
    r = random.Random(11)
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, "A  b\nc d "), (None, "no id here at all but words"), (None, None), (8, "été 日本 \U0001f600 \x00 \x1c x\x85y")]
    base = made_up(r, 120)
    texts += [(10 + k, " ".join(base)) for k in range(4)]
    texts += [(20 + k, " ".join(mutated(base, r, 0.005 * k))) for k in range(12)]
    passage = made_up(r, 50)
    texts += [(40 + k, " ".join(made_up(r, 60) + passage + made_up(r, 20))) for k in range(5)]
    texts += [(50, " ".join(made_up(r, 30_000))), (51, "x" * 60_000), (52, "### $$$ !!! 123")]
    texts += [(10, " ".join(base)), (4, "one")]
    return [(i, t, None if i is None or i % 5 == 0 else ("aa", "bb")[i % 2], "s", None, True, 0.5, 3, "k") for i, t in texts]


@pytest.fixture(scope="session")
def odd_rows():
    return [(r[0], r[1]) for r in _odd_rows()]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(_odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents_here(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
