from pyspark.sql import types as T

from lodestone.llm.batches import with_columns


def test_clashing_and_dropped_columns(spark):
    df = spark.createDataFrame([(1, "a", 9), (2, None, 8)], "id long, t string, n int")
    fields = T.StructType([T.StructField("n", T.LongType())])
    out = with_columns(df, ["t"], fields, lambda: lambda t: [[len(x or "") for x in t.to_pylist()]], drop=("t",))
    assert out.columns == ["id", "n"] and [tuple(r) for r in out.collect()] == [(1, 1), (2, 0)]
