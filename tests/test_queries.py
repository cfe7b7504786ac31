import os

import pytest

from sluice.plans import catalog

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def rows(frame, columns):
    def cell(v):
        return "" if v is None or v != v else f"{float(v):.4f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(cell(r[c]) for c in columns) for r in frame)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, name):
    found = catalog.queries()[name](spark, DATA)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    expected = con.sql(catalog.oracle_sql()[name])
    assert sorted(found.columns) == sorted(expected.columns)
    theirs = [dict(zip(expected.columns, r)) for r in expected.fetchall()]
    assert rows([r.asDict() for r in found.collect()], sorted(found.columns)) == rows(theirs, sorted(found.columns))


def test_signatures_of_odd_texts_equal_their_sql(spark, tmp_path):
    texts = ["one two three", None, "", "?! é", "\u0130stanbul I\u0130 \u212Aelvin", "one two three", "ONE four"]
    for ids in ([*range(7)], [1, 2, 3, 4, 5, 5, 5], [None, 2, 3, 4, 5, None, 6]):
        folder = str(tmp_path / str(ids[0]))
        spark.createDataFrame([*zip(ids, texts)], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
        con = duckdb.connect()
        con.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
        for name in ("text_signature", "near_dup_greedy") if None not in ids else ("text_signature",):
            found = catalog.queries()[name](spark, folder)
            assert sorted(map(str, con.sql(catalog.oracle_sql()[name]).fetchall())) == sorted(str(tuple(r)) for r in found.collect())
