import glob
import os

import duckdb
import pytest

from presslake.llm import queries

COLUMNS = {"p2_found": "rec_id_a rec_id_b", "p3_found": "rec_id line_no", "p4_found": "table_name rec_id", "p5_found": "rec_id line_no kind", "p6_found": "rec_id_a rec_id_b", "p7_found": "table_name rec_id line_no", "p8_ids": "doc_id ids", "p10_found": "doc_id"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    rows = queries.QUERIES[name](spark, small)
    if name in COLUMNS:
        assert rows.columns == COLUMNS[name].split()
    got = rows.collect()
    assert got and (name not in COLUMNS or name == "p8_ids" or len(got) == len(set(got)))
    if name in queries.ORACLE:
        db = duckdb.connect()
        for f in glob.glob(f"{small}/*.parquet"):
            db.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
        cursor = db.execute(queries.ORACLE[name])
        assert [d[0] for d in cursor.description] == rows.columns and sorted(cursor.fetchall()) == sorted(map(tuple, got))
