"""The registered queries and the driver contract."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tickwise.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and corpus_pipeline.ORACLE_SQL is None
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), con.execute(queries.ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got)
    a, b = (d[columns].sort_values(columns).reset_index(drop=True) for d in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


COLUMNS = {
    "op3": ["page_id", "url", "text", "n_chars"], "op6": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8": ["doc_id", "held_out", "score", "predicted"], "op9": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op10": ["doc_id", "start", "n_tokens", "ids_crc32"], "op11": ["item_id", "rank", "doc_id", "score"],
    "op12": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]}


@pytest.mark.parametrize("start", sorted(COLUMNS))
def test_contract_columns(spark, start):
    name = next(n for n in queries.QUERIES if n.split("_")[0] == start)
    table = {"op3": "pages", "op9": "conversations", "op11": "benchmark", "op12": "conversations"}.get(start, "documents")
    df = queries.QUERIES[name](spark, FOLDER)
    assert df.columns[:len(COLUMNS[start])] == COLUMNS[start]
    assert df.count() >= spark.read.parquet(f"{FOLDER}/{table}.parquet").select(COLUMNS[start][0]).distinct().count()
