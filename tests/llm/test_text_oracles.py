"""Queries on texts that SQL can state, against DuckDB on the same tables."""

import glob
import os

import duckdb
import pytest

from civiclens.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(name, spark, duck, folder):
    answer = duck.execute(ORACLES[name])
    columns = [column[0] for column in answer.description]
    want = sorted(answer.fetchall(), key=repr)
    frame = QUERIES[name](spark, folder)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr) == want


def test_contexts_of_a_batch_go_out_in_parts(monkeypatch):
    """What a task holds of a batch's contexts is bounded; all come out, each with its own text."""
    import numpy as np
    import pyarrow as pa

    from civiclens.llm import suffixes

    texts = ["".join(map(chr, np.random.default_rng(i).integers(97, 123, 1_500))) for i in range(12)]
    keys = pa.array([str(i).encode() for i in range(12)], pa.binary())
    batch = pa.RecordBatch.from_arrays([keys, pa.array(texts)], ["text", "body"])
    whole = pa.Table.from_batches(suffixes._contexts(200)(iter([batch]))).to_pylist()
    monkeypatch.setattr(suffixes, "_OUT_BYTES", 2_000)
    parts = list(suffixes._contexts(200)(iter([batch])))
    assert len(parts) == 12 and pa.Table.from_batches(parts).to_pylist() == whole
    places = [[{**c, "weight": 1} for c in whole if c["text"] == k.as_py()] for k in keys]
    cut = list(suffixes._cut_out(200)(iter([pa.RecordBatch.from_arrays([pa.array(texts), pa.array(places)], ["body", "places"])])))
    assert len(cut) > 12 and sum(b.num_rows for b in cut) == len(whole)
    assert max(sum(map(len, b.column(4).to_pylist())) for b in cut) < 2_000 + 400
