from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    return SF


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]) tuples, with an extra column that has a clashing name."""

    def make(rows):
        full = [(*r, *("en", "src0")[len(r) - 2:]) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, 7) for r in full],
                                     "doc_id bigint, text string, lang string, source string, n_chars bigint, id int")

    return make
