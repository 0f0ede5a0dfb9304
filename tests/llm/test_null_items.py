"""Benchmark items without an id."""

from tidewell.llm import decontam


def test_items_of_a_null_id_contaminate(spark):
    passage = "what is the airspeed of an unladen swallow over water"
    bench = spark.createDataFrame([(None, passage), (None, None), (None, " "), (3, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"He asked: {passage}?"), (2, "a clean text")], "doc_id long, text string")
    got = sorted(map(tuple, decontam.find_passages(docs, bench).collect()), key=str)
    assert got == [(1, 3, 10, 10 + len(passage), 0), (1, None, 10, 10 + len(passage), 0)]
    assert [r.doc_id for r in decontam.drop_contaminated(docs, bench.filter("item_id is null")).collect()] == [2]
