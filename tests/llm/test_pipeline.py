import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import documents, empty, odd_rows, prose, words
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tidemark.llm import common, decontaminate, language, mixing, pii, queries, simhash


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_on_the_supplied_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    identified = stage("language_id")(spark, docs, sf_dir)
    assert identified.columns == docs.columns and identified.count() == len(rows)

    prints = [slow_fingerprint(r["text"]) for r in rows]
    ids = [r["doc_id"] for r in rows]
    want = set(slow_components(ids, prints))
    single = stage("near_duplicates")(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(want)

    plain = lambda t: " ".join(w.decode() for w in decontaminate._plain((t or "").encode().split()))
    items = [plain(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in rows if any(f" {i} " in f" {plain(r['text'])} " for i in items)}
    clean = {r["doc_id"] for r in stage("decontamination")(spark, docs, sf_dir).collect()}
    assert clean & leaked == set() and len(clean) >= len(rows) - len(leaked) - 2

    hidden = {r["doc_id"]: r for r in stage("personal_data")(spark, docs, sf_dir).collect()}
    for r in rows:
        left = pii.base_spans(hidden[r["doc_id"]]["text"])
        assert not any(left.values()) and hidden[r["doc_id"]]["n_chars"] == len(hidden[r["doc_id"]]["text"])
        if not any(pii.base_spans(r["text"]).values()):
            assert hidden[r["doc_id"]]["text"] == r["text"]


def test_run_is_its_stages_one_after_the_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(f(spark, docs, sf_dir).collect(), docs.schema)
    want = sorted(map(tuple, mixing.taken(docs).select("doc_id", "source", "size", "source_size", "target", "taken").collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == want


def test_stages_stand_odd_and_empty_tables(spark, sf_dir):
    for rows in (odd_rows(), []):
        docs = documents(spark, rows) if rows else empty(spark)
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, docs, sf_dir)
            if name != "source_mix":
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), docs.schema)
        sizes = {r["doc_id"]: r["size"] for r in out.collect()}
        assert all(sizes[r[0]] == len(words(r[1])) for r in rows if r[0] in sizes and r[0] == 4)


def test_near_duplicates_are_dealt_out_whatever_size_spark_takes_them_for(spark, monkeypatch, plan):
    made, real = {}, common.written

    def seen(df, name):
        made.setdefault(name, plan(df))
        return real(df, name)

    monkeypatch.setattr(common, "written", seen)
    monkeypatch.setattr(simhash, "written", seen)
    rows = [(i, prose(i % 30, 60) + " more" * (i % 3), "en", "s", 0) for i in range(90)]
    docs = documents(spark, rows, extra=False)
    first = stage("near_duplicates")(spark, docs, None)
    assert "SortMergeJoin [cell#" in made["links"] and "BroadcastHashJoin" not in made["links"]
    assert "SortMergeJoin [fp#" in made["judged"] and "BroadcastHashJoin [fp#" not in made["judged"]
    assert "BroadcastHashJoin" in plan(first)  # the keys of the rows that go, counted

    monkeypatch.setattr(simhash, "BROADCAST_BYTES", 0)
    again = stage("near_duplicates")(spark, docs, None)
    assert "BroadcastHashJoin" not in plan(again)
    assert sorted(again.collect()) == sorted(first.collect())

    items = spark.createDataFrame([(1, rows[0][1])], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert "BroadcastHashJoin" not in plan(decontaminate.clean(docs, items))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_covers_its_whole_table(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    if name == "op9_nearest":
        n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(F.col("vec_id") % 20 == 0).count()
        assert df.count() == 20 * n
    elif name == "op13_filter_audit":
        # What the last step keeps and all steps remove are the rows of the table, in every order.
        total = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
        left = df.groupBy("filter_order").agg(F.sum("removed"), F.sum(F.when(F.col("step") == 5, F.col("kept")))).collect()
        assert len(left) == 120 and all(removed + kept == total for _, removed, kept in left)
    elif name != "op7_decontamination":
        table = {"op5_warc": "pages", "op10_main_text": "pages", "op11_centroids": "embeddings"}.get(name, "documents")
        key = {"pages": "page_id", "embeddings": "vec_id"}.get(table, "doc_id")
        ids = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()
        assert sorted(df.select(key).collect()) == sorted(ids)
    assert language.UNDETERMINED == "und"
