"""Resources that the schema stream stores are compressed well."""

import glob

import pyarrow.parquet as pq

from clinlake import queries


def test_stored_resources_are_zstd(spark, tmp_path, monkeypatch):
    tables = {
        "supplier": ([(1, "S1", 0), (9, "S9", 0)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda session, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "DOCUMENTS", {"Organization": queries.DOCUMENTS["Organization"]})
    found = {r.column_name: r.schema_of_variant for r in queries.schema_stream(spark, str(tmp_path)).collect()}
    assert found["name"] == "STRING" and found["meta"] == "OBJECT<lastUpdated: STRING>"
    part = glob.glob(f"{tmp_path}/resources/*.parquet")[0]
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"
