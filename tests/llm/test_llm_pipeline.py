"""The stages of the corpus pipeline, one after the other, and queries over the small tables."""

import corpus_pipeline
from marquee.llm.queries import op4_chunk_dedup, op6_sentencepiece_scan, op10_decontaminate


def test_every_stage_takes_effect(spark):
    small = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, small), "test")
        after = docs.count()
        if name == "SentencePiece encoding":
            assert docs.columns == ["doc_id", "text", "ids", "n_tokens"]
        else:
            assert docs.columns == columns
        assert (after < before) == (name in ("toxicity", "n-gram Jaccard join", "benchmark decontamination"))
        before = after
    toxic = spark.read.parquet(f"{small}/labels.parquet").where("toxic = 1")
    # some languages have a handful of labelled toxic texts here, too few to learn all their insults
    assert docs.join(toxic, "doc_id").count() <= 0.4 * toxic.count()


def test_empty_tables_pass_through(spark, small, none):
    docs = none.select("doc_id", "text")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, small)
    assert docs.collect() == []


def test_queries_cover_their_tables(spark, small):
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    assert op4_chunk_dedup(spark, small).count() == n
    back = op6_sentencepiece_scan(spark, small)
    assert back.count() == n and back.where("not round_trip").count() == 0
    assert op10_decontaminate(spark, small).count() > 0


def test_odd_rows_and_clashing_names_go_through(spark):
    """Nulls, repeated rows, shared ids, a very long text, and input columns with the names the operators use themselves."""
    small = "/root/testdata/sf0.01"
    prose = "This is a plain sentence about the weather of the coming week, and nothing else is said in it."
    kind = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, n_clauses int, leaks string, _key string"
    more = ("en", "s", 1, 0.123, 9, 8, "mine", "k")
    rows = [(5, prose, *more), (5, prose, *more), (None, prose, *more), (None, "", *more), (None, None, *more), (6, prose + " More.", *more),
            (7, "word " * 60_000, *more), (8, "x" * 50_000, *more)]
    docs = spark.createDataFrame(rows, kind)
    for name, step in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stage(step(spark, docs, small), "odd")
        assert docs.columns == [c.split()[0] for c in kind.split(", ")], name
        assert {(r.score, r.predicted, r.n_clauses, r.leaks, r._key) for r in docs.collect()} == {(0.123, 9, 8, "mine", "k")}
    kept = sorted((r.doc_id or 0, len(r.text or "")) for r in docs.collect())
    assert kept == [(0, 0), (0, 0), (5, len(prose)), (7, 300_000), (8, 50_000)]
    last = corpus_pipeline.STAGES[4][1](spark, docs, small).collect()
    assert len(last) == 5 and all(r.n_tokens == len(r.ids) for r in last)


def test_a_stage_deletes_what_earlier_stages_stored(spark, docs_of):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.stage(corpus_pipeline.one_of_each_group(spark, docs, small), "kept")
    assert corpus_pipeline._scratch
    corpus_pipeline.drop_toxic(spark, kept, small)
    assert not corpus_pipeline._scratch
    lazy = corpus_pipeline.one_of_each_group(spark, kept, small)
    assert corpus_pipeline.drop_toxic(spark, lazy, small).count() > 0     # what a lazy input reads is still there
