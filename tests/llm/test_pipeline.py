"""The pipeline's stages, and the registered queries with comparison SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from martloom.llm import queries
from martloom.llm.common import table
from verification.compare import STAR, rows_of


def test_stages_keep_the_columns_and_their_decisions(spark, odd, small):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        docs = out
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    # no letters: rejected; copies: one stays; repeated by the mix at most twice
    assert not {2, 3, 4, 10} & set(ids) and 1 not in ids
    assert all(ids.count(i) <= 2 for i in set(ids))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert "@" not in texts.get(11, "")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() == len(ids)


def test_empty_table_runs_through(spark, empty, small):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert docs.count() == 0


def test_run_equals_the_stages(spark, small):
    docs = table(spark, small, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    once, again = (rows_of(d.columns, d.collect()) for d in (docs, corpus_pipeline.run(spark, small)))
    assert once == again


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_comparison_sql(spark, small, name):
    con = duckdb.connect()
    for t in (*STAR, "documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    cur = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, small)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())
