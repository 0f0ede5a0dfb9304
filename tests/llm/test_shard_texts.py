"""Shards hold the texts themselves."""

import zlib

from pyspark.sql import functions as F

from tidewell.llm import sharding


def test_digests_are_of_the_texts_that_came_to_the_shards(spark, monkeypatch):
    rows = [(i, "x" * (i * i)) for i in range(60)] + [(60, None), (61, "é" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shuffled = sharding.shuffle_to_shards
    monkeypatch.setattr(sharding, "shuffle_to_shards", lambda df, *args: shuffled(df, *args).withColumn("text", F.upper("text")))
    out = {r.doc_id: r for r in sharding.shard_documents(docs, 4).collect()}
    assert len(out) == len(rows)
    for i, text in rows:
        came = (text or "").upper().encode()
        assert (out[i].size, out[i].text_crc32) == (len(came) + 16, zlib.crc32(came))


def test_written_shards_hold_the_texts(spark, tmp_dir):
    rows = [(i, f"text {i} " * i) for i in range(101)]
    sharding.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_dir}/shards", 4)
    back = spark.read.parquet(f"{tmp_dir}/shards").collect()
    assert sorted((r.doc_id, r.text) for r in back) == rows
    assert sorted((r.shard, r.slot) for r in back) == [(s, i) for s in range(4) for i in range(26 if s == 0 else 25)]
