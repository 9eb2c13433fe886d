import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", ["op6_exact_top_k", "op7_license_scan", "op9_chat_formatting"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.select(*want.columns).collect()) == plain(want.fetchall())


def test_all_are_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    from postroom.llm import common

    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, SF), f"test-{name}")
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert ids <= before and len(ids) > 0.5 * len(before)
        before = ids
        if name != "packing":
            assert docs.columns == columns
    held = docs.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in held) <= 1024


def test_stages_take_odd_documents(spark, odd_docs, no_docs, odd_rows):
    """Each stage on nulls, empty and long texts, ties and repeated rows, and on no rows at all."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_docs.select(*columns), no_docs.select(*columns)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF)
            rows = found.collect()
            if name == "packing":
                assert {r["doc_id"] for r in rows} == {r[0] for r in docs.select("doc_id").collect()}
                continue
            assert found.columns == columns
            if name in ("quality", "toxicity"):
                assert len(rows) <= n
            if name == "near_dedup" and n:
                # the three equal texts are one document; so are all texts without words
                ids = [r["doc_id"] for r in rows]
                assert ids.count(6) == 1 and 7 not in ids and sum(i in (1, 2, 3) for i in ids) == 1 and None in ids
