from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))


@pytest.fixture(scope="session")
def table(spark):
    def read(name: str):
        return spark.read.parquet(f"{SF}/{name}.parquet")

    return read


@pytest.fixture(scope="session")
def texts(spark):
    """Documents from (doc_id, text) with the other columns of the table and one that clashes with results."""

    def make(rows, lang="en", source="s"):
        full = [(k, t, lang, source, len(t) if t is not None else None, "mine", -1) for k, t in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, n_words int"
        return spark.createDataFrame(full, schema).repartition(3)

    return make


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, LONG), (6, "é ß 中文 😀"), (None, "no key here"), (7, "same row twice"), (7, "same row twice")]
