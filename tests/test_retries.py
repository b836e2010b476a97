"""Results must not depend on tasks being run again."""

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from fettle.operators import ordered, packing, shuffle
from tests.helpers import rows


def flaky(column):
    """The column, through tasks that fail the first time they are run."""

    @F.pandas_udf("string")
    def once_more(values: pd.Series) -> pd.Series:
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost on purpose")
        return values

    return once_more(column)


@pytest.fixture
def texts(spark):
    return spark.range(0, 400, numPartitions=4).select(
        F.col("id").alias("k"), F.repeat(F.concat(F.lit("w"), F.col("id"), F.lit(" ")),
                                         (F.col("id") % 7).cast("int")).alias("text"),
    )


def test_packing(spark, texts):
    shaky = texts.withColumn("text", flaky(F.col("text")))
    expected = rows(packing.pack_sequences(texts, "text", "k", 16))
    assert rows(packing.pack_sequences(shaky, "text", "k", 16)) == expected


def test_order_and_shuffle(spark, texts):
    slim = texts.select("k", F.col("k").cast("string").alias("name"))
    shaky = slim.withColumn("name", flaky(F.col("name")))
    assert rows(ordered.with_ordinal(shaky, "name")) == rows(ordered.with_ordinal(slim, "name"))
    assert rows(shuffle.shuffle_rows(shaky, "name", 1)) == rows(
        shuffle.shuffle_rows(slim, "name", 1)
    )
