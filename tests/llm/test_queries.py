"""Each registered query over whole tables; those that SQL can express against it."""

import pytest

from rowtide.llm.queries import ORACLES, QUERIES
from tests.oracle import differences, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
    "op3_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op4_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"],
    "op5_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert QUERIES[name](spark, SF).columns == COLUMNS[name]


def test_every_operator_has_its_query():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
