"""Vectors handled by their non-zero elements."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from mise.functions import columns as C
from mise.operators import features as FE


@pytest.fixture()
def rows(spark):
    data = [(1, Vectors.sparse(6, [1, 4], [1.0, -2.0]), [0.5, 0.0, 3.0]), (2, Vectors.dense([0, 0, 7, 0, 0, 0]), None),
            (3, Vectors.sparse(6, [], []), [0.0, 0.0, 0.0]), (4, None, [1.0, 1.0, 1.0])]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    return spark.createDataFrame(data, T.StructType([T.StructField("id", T.LongType()), T.StructField("o", VectorUDT()),
                                                     T.StructField("v", T.ArrayType(T.DoubleType()))]))


def test_parts_of_both_forms(rows):
    got = {r["id"]: r for r in rows.select("id", C.sparse("o", "float").alias("p")).select(
        "id", "p", C.first_index("p").alias("i"), C.first_index("p", 2, 3).alias("j"), C.slice_sq_norm("p", 2, 4).alias("n")).collect()}
    assert (got[1].p.size, got[1].p.indices, got[1].p["values"]) == (6, [1, 4], [1.0, -2.0])
    assert (got[2].p.size, got[2].p.indices, got[2].p["values"]) == (6, [2], [7.0])
    assert (got[3].p.indices, got[3].i, got[3].n) == ([], -1, 0.0) and got[4].p is None and got[4].i == -1
    assert (got[1].i, got[1].j, got[1].n) == (1, 2, 4.0) and (got[2].i, got[2].j) == (2, 0)


def test_assembled_vectors_equal_assembled_arrays(rows):
    from pyspark.ml.functions import vector_to_array
    made = FE.assemble_vectors(rows, "vo", {"o": "o", "v": "v"}, {"o": 6, "v": 3})
    assert made.columns == [*rows.columns, "x"]
    arrays = rows.withColumn("o", F.when(F.col("o").isNotNull(), vector_to_array("o")))
    want = {r["id"]: r.x for r in arrays.select("id", FE.assemble("vo", {"o": "o", "v": "v"}, {"o": 6, "v": 3}, "double").alias("x")).collect()}
    assert {r["id"]: list(r.x.toArray()) for r in made.collect()} == want
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "vector_to_array" not in plan


def test_width_of_another_size_is_an_error(rows):
    with pytest.raises(Exception, match="size"):
        FE.assemble_vectors(rows, "ov", {"o": "o", "v": "v"}, {"o": 5, "v": 3}).collect()


def test_fallback_vectors(rows):
    primary = F.when(F.col("id") != 1, F.col("o"))
    got = {r["id"]: list(r.x.toArray()) for r in rows.select("id", FE.fallback_vectors(primary, "v", 6).alias("x")).collect()}
    assert got[1] == [0.5, 0, 3, 0, 0, 0] and got[2] == [0, 0, 7, 0, 0, 0] and got[4] == [1, 1, 1, 0, 0, 0]
