"""The registered corpus queries on the smallest tables, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from supplyloom.llm import decontaminate, line_dedup, queries, simhash, toxicity
from supplyloom.llm.common import staged, table

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    expected = con.execute(queries.SQL[name])
    names = [c[0] for c in expected.description]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_has_a_row_for_each_input_row(spark, name):
    source = "pages" if name.startswith("op3") else "documents"
    assert queries.QUERIES[name](spark, FOLDER).count() == table(spark, FOLDER, source).count()


def test_stages_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    clean = staged(corpus_pipeline.drop_toxic(spark, docs, FOLDER))
    judged = toxicity.judge(docs, table(spark, FOLDER, "labels"))
    assert clean.columns == columns
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in judged.filter("predicted = 0").collect()}
    lines = staged(corpus_pipeline.drop_repeated_lines(spark, clean, FOLDER))
    assert lines.columns == columns and lines.count() == clean.count()
    assert line_dedup.removed_lines(lines).count() == 0
    single = staged(corpus_pipeline.drop_near_duplicates(spark, lines, FOLDER))
    assert single.columns == columns
    groups = simhash.near_duplicates(lines).select("component_id").distinct().count()
    assert single.count() == groups
    rest = staged(corpus_pipeline.drop_contaminated(spark, single, FOLDER))
    assert rest.columns == columns
    coded = corpus_pipeline.encode(spark, rest, FOLDER)
    assert coded.count() == rest.count() and coded.filter("not lossless").count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "one two\nthree four", "en", "s", 9), (3, "one two\nthree four", "en", "s", 9), (None, "some other words", "en", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data, kind in (("documents", rows, schema), ("labels", [], "doc_id long, quality int, toxic int"), ("benchmark", [(0, None)], "item_id long, text string")):
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "3", "None"]
    assert got.filter("not lossless").count() == 0


def test_near_duplicate_stage_keeps_one_row_of_each_group_not_of_each_id(spark):
    a, b, c = ("a b c d e f", "x y z u v w", "n o p q r s")
    rows = [(i, t, "en", "s", len(t), "x", "y") for i, t in zip([5, 5, 2, 5, None, None, None, None], [a, b, b, a, c, c, c, a], strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, best string")
    kept = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", b), ("5", a), ("None", c)]
    assert corpus_pipeline.drop_near_duplicates(spark, df.filter("false"), "").count() == 0


def test_decontamination_stage_with_clashing_columns(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"before {item} after", "en", "s", 1, 1, 2), (2, "clean text", "en", "s", 1, 1, 2), (None, None, None, None, None, 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, doc long, version long")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(df, items)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "None"]
