import pathlib

import duckdb

import corpus_pipeline
from riskloom.llm import jaccard
from riskloom.llm.lines import cleaned_sql
from riskloom.llm.queries import llm_oracles, llm_queries
from riskloom.session import shared_folder
from tests.llm.conftest import prose


def test_oracles(spark, tables):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    for name, sql in llm_oracles().items():
        found = con.execute(sql)
        columns = [d[0] for d in found.description]
        df = llm_queries()[name](spark, tables)
        assert sorted(columns) == sorted(df.columns)
        rows = map(tuple, df.select(*columns).collect())
        assert sorted(map(repr, rows)) == sorted(map(repr, found.fetchall()))


def test_stages(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names, before, kept = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, tables)
        assert after.columns == names
        path = str(tmp_path / name)
        after.write.parquet(path)
        before = kept[name] = spark.read.parquet(path)
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in kept.items()}
    assert ids["language_id"] >= ids["jaccard_join"] >= ids["decontamination"] and ids["language_id"] == ids["line_dedup"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/language_id/*.parquet'")
    cleaned = dict(con.execute(f"SELECT doc_id, text FROM ({cleaned_sql()})").fetchall())
    assert cleaned == {r["doc_id"]: r["text"] for r in kept["line_dedup"].collect()}
    groups = jaccard.jaccard_components(kept["line_dedup"]).collect()
    assert ids["jaccard_join"] == {r["component_id"] for r in groups}
    out = corpus_pipeline.STAGES[-1][1](spark, before, tables)
    assert {r["doc_id"] for r in out.collect()} == ids["decontamination"]


def test_odd_rows_pass_the_stages(spark, odd_docs, no_docs, tables):
    for start, count in ((odd_docs, 13), (no_docs, 0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, tables)
            assert docs.columns == start.columns
        left = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in docs.select("doc_id").collect())
        assert left == ([-1, 0, 6, 8, 9, 9, 11] if count else [])


def test_copies_do_not_vote_for_their_own_lines(spark, tables):
    copy = "\n".join(prose(900 + k, 20) for k in range(4))
    rows = [(k, f"menu\n{prose(1000 + k, 60)}", "en", "a.org") for k in range(20)]
    rows += [(100 + k, f"menu\n{copy}", "en", "a.org") for k in range(8)]  # a group with a third of all rows
    rows += [(200 + k, f" {copy}\n\nmenu ", "en", "a.org") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("*", "cast(char_length(text) as long) AS n_chars")
    cleaned = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, tables).cache()
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert texts[0] == prose(1000, 60) and texts[100] == copy and texts[200] == f" {copy}\n"
    kept = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, cleaned, tables).collect()
    assert {r["doc_id"] for r in kept} == {*range(20), 100}


def test_near_copies_do_not_vote_for_their_shared_lines(spark, tables):
    shared = "\n".join(prose(900 + k, 20) for k in range(6))
    rows = [(k, f"menu\n{prose(1000 + k, 60)}", "en", "a.org") for k in range(20)]
    rows += [(100 + k, f"menu\n{shared}\nown tail {k}", "en", "a.org") for k in range(10)]
    rows += [(200 + k, f"menu\n{prose(3000 + k, 4)}\n{prose(4000 + k, 40)}", "en", None) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("*", "cast(char_length(text) as long) AS n_chars")
    cleaned = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, tables).cache()
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert texts[0] == prose(1000, 60) and texts[103] == f"{shared}\nown tail 3" and texts[200].startswith("menu")
    kept = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, cleaned, tables).collect()
    assert {r["doc_id"] for r in kept} == {*range(20), 100, 200, 201, 202}


def test_lines_go_by_dataframe_functions_only(spark, odd_docs, monkeypatch):
    def refuse(*_):
        raise AssertionError("Python on the executors")

    for kind, names in (
        (type(odd_docs), ("mapInArrow", "mapInPandas")),
        (type(odd_docs.groupBy()), ("applyInArrow", "applyInPandas", "cogroup")),
    ):
        for name in names:
            monkeypatch.setattr(kind, name, refuse)
    rows = [(k, f"menu\n{prose(1000 + k % 4, 30)}", "en", "a.org") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("*", "cast(char_length(text) as long) AS n_chars")
    cleaned = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, "").collect()
    assert {r["doc_id"]: r["text"] for r in cleaned} == {k: prose(1000 + k % 4, 30) for k in range(8)}


def _held(spark):
    """Bytes of the frames stored now."""
    folder = pathlib.Path(shared_folder(spark).removeprefix("file://")) / f"riskloom-{spark.sparkContext.applicationId}"
    return sum(p.stat().st_size for p in folder.rglob("*.parquet")) if folder.exists() else 0


def test_stages_leave_only_ids_and_lines_on_disk(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = _held(spark)
        path = str(tmp_path / name)
        stage(spark, docs, tables).write.parquet(path)
        assert _held(spark) - before < 20_000, name  # the texts packed alone take more
        docs = spark.read.parquet(path)
    expected = {tuple(r) for r in corpus_pipeline.STAGES[-1][1](spark, docs, tables).collect()}

    before = _held(spark)
    out = corpus_pipeline.run(spark, tables)
    size = sum(p.stat().st_size for p in (tmp_path / "decontamination").rglob("*.parquet"))
    assert _held(spark) - before < 1.2 * size + 20_000  # what the last stage reads
    assert {tuple(r) for r in out.collect()} == expected
