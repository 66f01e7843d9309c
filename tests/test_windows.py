"""Windows over many chunks against Spark's windows over whole entities."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablework.operators import windows


@pytest.fixture(scope="module")
def series(spark):
    """3,000 rows, a third of them of one entity, in bursts; one entity is NULL."""
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("e"), (F.col("id") % 40).cast("string")))
        .alias("entity"),
        F.when(F.col("id") < 1000, F.lit(500))
        .otherwise(F.col("id") / 7)
        .cast("int")
        .alias("at"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 101).cast("double")).alias("value"),
    )


#: The order column in several types, with NULL and NaN where the type has them.
ORDERS = {
    "int": "at",
    "double": "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN double('NaN') ELSE at / 3 END",
    "date": "CASE WHEN id % 9 <> 0 THEN date_add(DATE '2024-01-01', at) END",
    "string": "CASE WHEN id % 4 <> 0 THEN concat('s', at) END",
}


@pytest.fixture(scope="module", params=[12])
def chunks(request):
    return request.param


@pytest.fixture(scope="module", params=list(ORDERS))
def ordered(request, series):
    return series.withColumn("at", F.expr(ORDERS[request.param]))


def whole(order):
    return Window.partitionBy("entity").orderBy(*windows.sort_columns(order))


def test_a_hot_entity_is_cut(series):
    chunked = windows.with_chunks(series, ["entity"], ["at", "id"], 12)
    sizes = chunked.where("entity = 'hot'").groupBy(windows.CHUNK).count().collect()
    assert len(sizes) >= 4 and max(row["count"] for row in sizes) < 500


@pytest.mark.parametrize("order", [["at", "id"], ["-at", "id"]], ids=["up", "down"])
def test_rolling_mean(ordered, rows_of, chunks, order):
    got = windows.rolling_mean(ordered, ["entity"], order, "value", 4, chunks=chunks)
    frame = whole(order).rowsBetween(-3, 0)
    mean = F.when(F.count("value").over(frame) == 4, F.sum("value").over(frame) / 4)
    assert str(rows_of(got)) == str(rows_of(ordered.withColumn("rolling_mean", mean)))


@pytest.mark.parametrize("distance", [1, 3])
def test_lag_lead(ordered, rows_of, chunks, distance):
    order = ["at", "id"]
    got = windows.lag_lead(ordered, ["entity"], order, "value", distance, chunks=chunks)
    expected = ordered.withColumns(
        {
            "previous": F.lag("value", distance).over(whole(order)),
            "following": F.lead("value", distance).over(whole(order)),
        }
    )
    assert str(rows_of(got)) == str(rows_of(expected))


def test_ranks(ordered, rows_of, chunks):
    """The first third of the rows share one value, which fills several chunks."""
    got = windows.ranked(ordered, ["entity"], "at", "id", chunks=chunks)
    by_value = whole(["-at"])
    expected = ordered.withColumns(
        {
            "row_no": F.row_number().over(whole(["-at", "id"])),
            "rank_no": F.rank().over(by_value),
            "dense_no": F.dense_rank().over(by_value),
        }
    )
    assert str(rows_of(got)) == str(rows_of(expected))


def test_an_empty_table_stays_empty(series):
    assert windows.ranked(series.limit(0), ["entity"], "at", "id").count() == 0
