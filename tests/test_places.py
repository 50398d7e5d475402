"""Names of log files, taken from the path of every entry."""

from urllib.parse import unquote

from pyspark.sql import functions as F

from logweave.functions.codec import text_to_bytes
from logweave.operators.send import assign_offsets, to_entries
from logweave.sources import manifest, txn_index
from logweave.sources.topic_log import TopicLog


def test_entries_name_their_file_without_a_pattern_match_each(spark, tmp_path):
    """A pattern search over the path of every entry took most of the time to describe a log."""
    rows = spark.range(200).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, "a b").otherwise("ev-%x").alias("topic"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.timestamp_seconds("id").alias("timestamp"),
        *[text_to_bytes(F.col("id").cast("string")).alias(n) for n in ("key", "value")],
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("txn_id"),
    ).withColumn("headers", F.expr("CAST(NULL AS array<struct<key:string,value:binary>>)"))
    path = str(tmp_path / "log")
    log = TopicLog(spark, path)
    log.append(to_entries(assign_offsets(rows)))
    entries = manifest.read_files(spark, path, manifest.files(spark, path))
    assert "regexp" not in entries._jdf.queryExecution().optimizedPlan().toString().lower()
    there = {"/".join(p.parts[-3:]) for p in (tmp_path / "log").rglob("*.parquet") if not any(x.startswith("_") for x in p.parts[-3:])}
    named = {r.file for r in entries.select("file").distinct().collect()}
    assert {unquote(f) for f in named} == there
    assert named == {r.file for r in manifest.files(spark, path).collect()}
    assert manifest.undescribed(spark, path).count() == 0 and txn_index._undescribed(spark, path).count() == 0
    assert {(r.topic, r.partition, r.entries) for r in log.bounds().collect()} == {
        (t, p, sum(1 for i in range(200) if i % 2 == k and i % 3 == p)) for k, t in enumerate(("a b", "ev-%x")) for p in range(3)
    }
