"""The pipeline, stage by stage, against SQL and plain loops on what the stage got."""

from collections import Counter

import duckdb
from pyspark.sql import functions as F
from rows import awkward, empty  # noqa: F401
from test_basics import jump
from test_decontaminate import plain as plain_contamination
from test_shingles import plain_kept

import corpus_pipeline
from logweave.llm import mixing, queries
from logweave.llm.common import size_in_words, stage

SF_DIR = "/root/testdata/sf0.001"


def sql(docs, text):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    return con.execute(text)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = [f for _, f in corpus_pipeline.STAGES]
    columns, ids = docs.columns, lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    good = stage(steps[0](spark, docs, SF_DIR), "t1")
    result = sql(docs, queries.quality_sql())
    names = [d[0] for d in result.description]
    kept = [r[names.index("doc_id")] for r in result.fetchall() if r[names.index("kept")]]
    assert good.columns == columns and ids(good) == sorted(kept) and len(kept) < docs.count()

    single = stage(steps[1](spark, good, SF_DIR), "t2")
    assert single.columns == columns and ids(single) == plain_kept([(r.doc_id, r.text) for r in good.collect()]) and single.count() < good.count()

    clean = stage(steps[2](spark, single, SF_DIR), "t3")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    assert clean.columns == columns and ids(clean) == sorted(r.doc_id for r in single.collect() if not plain_contamination(r.text, items, 13)[4])

    mixed = stage(steps[3](spark, clean, SF_DIR), "t4")
    result = sql(clean, queries.MIX_SQL).fetchall()
    assert mixed.columns == columns and Counter(ids(mixed)) == Counter({r[0]: r[4] // r[1] for r in result if r[1] and r[4]})

    last = steps[4](spark, mixed, SF_DIR).collect()
    assert Counter(r.doc_id for r in last) == Counter(ids(mixed))
    assert all(r.shard == jump(r.doc_id, queries.SHARDS) for r in last)
    assert len({(r.shard, r.slot) for r in last}) == len(last) and sum(r.slot == 0 for r in last) == len({r.shard for r in last})
    assert sorted(map(str, corpus_pipeline.run(spark, SF_DIR).drop("slot").collect())) == sorted(str(r) for r in spark.createDataFrame(last).drop("slot").collect())


def test_mixed_sources_of_billions_of_words(spark, awkward, monkeypatch):
    """The same rows when every text counts as 16,384 times as many words: sums stay below 2^31, products with a weight do not."""
    few = Counter(map(str, corpus_pipeline.mixed_sources(spark, awkward, SF_DIR).collect()))
    monkeypatch.setattr(mixing, "size_in_words", lambda text: size_in_words(text) * 16_384)
    total = awkward.agg(F.sum(mixing.size_in_words(F.col("text")))).first()[0]
    assert total < 2**31 < 5 * total
    assert few == Counter(map(str, corpus_pipeline.mixed_sources(spark, awkward, SF_DIR).collect())) and few


def test_awkward_and_empty(spark, awkward, empty):
    for docs in (awkward, empty):
        for _, step in corpus_pipeline.STAGES:
            assert step(spark, docs, SF_DIR).count() <= 3 * docs.count()


def test_extra_columns_with_clashing_names(spark, awkward):
    plain = {name: step(spark, awkward, SF_DIR).count() for name, step in corpus_pipeline.STAGES}
    docs = awkward.withColumns({"n": F.lit("clash"), "token": F.lit(1), "component": F.lit(None).cast("string"), "size": F.lit("x")})
    for name, step in corpus_pipeline.STAGES:
        result = step(spark, docs, SF_DIR)
        assert result.count() == plain[name] and set(docs.columns) <= set(result.columns)
        assert {r.n for r in result.collect()} <= {"clash"}


def test_shard_columns_of_the_input_give_way(spark, awkward):
    name, step = corpus_pipeline.STAGES[-1]
    plain = step(spark, awkward, SF_DIR)
    docs = awkward.withColumns({"shard": F.lit("mine"), "slot": F.lit(-1)})
    result = step(spark, docs, SF_DIR)
    assert sorted(result.columns) == sorted(plain.columns)
    assert sorted(map(str, result.select("doc_id", "shard").collect())) == sorted(map(str, plain.select("doc_id", "shard").collect()))
