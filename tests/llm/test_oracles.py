"""The corpus queries that have SQL, against DuckDB."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from clickmetrics.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def _compare(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(map(tuple, got.select(columns).collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr)
    return rows


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    assert _compare(spark, SF_DIR, name)


@pytest.mark.parametrize("name", ["op2_suffix_dedup", "op3_decontaminate", "op4_ngram_join"])
def test_odd_rows_equal_sql(spark, tmp_path, name):
    passage = "one Two three four five six seven eight nine ten eleven naïve über 執行 end of it"
    texts = [None, "", " ", "x", passage, passage + " more", "lead " + passage.upper(), passage + passage, "é" * 120, "short item"]
    ids = pa.array(range(len(texts)), pa.int64())
    pq.write_table(pa.table({"doc_id": ids, "text": texts}), tmp_path / "documents.parquet")
    items = {"item_id": pa.array([3, 20, 100, None], pa.int64()), "text": [passage, "Short, item", "", "eleven naïve"]}
    pq.write_table(pa.table(items), tmp_path / "benchmark.parquet")
    vectors = {"vec_id": pa.array([], pa.int64()), "embedding": pa.array([], pa.list_(pa.float32()))}
    pq.write_table(pa.table(vectors), tmp_path / "embeddings.parquet")
    assert len(_compare(spark, str(tmp_path), name)) == len(texts)
