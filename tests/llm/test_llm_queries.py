"""The registered queries of the operators over the smallest tables: against their SQL, or for their shape."""

import os

import pytest

from trendmill.llm import cases

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

COLUMNS = {
    "op1_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op2_toxicity": ["doc_id", "severity", "p_toxic", "grade", "toxic"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op7_simhash": ["doc_id", "fingerprint", "component_id"],
}


@pytest.mark.parametrize("name", list(cases.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    df = cases.QUERIES[name](spark, SF_DIR)
    expected = con.execute(cases.SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, expected.fetchall()))


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_has_its_columns_and_rows(spark, name):
    df = cases.QUERIES[name](spark, SF_DIR)
    assert df.columns == COLUMNS[name]
    source = "conversations" if name.startswith("op1_") else "documents"
    rows = spark.read.parquet(f"{SF_DIR}/{source}.parquet")
    if name.startswith("op1_"):
        assert df.count() == rows.select("conv_id").distinct().count() + 1
    else:
        assert df.select("doc_id").distinct().count() == rows.count()


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in cases.QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
