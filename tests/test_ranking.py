import pytest
from pyspark.sql import functions as F

from matchboard.operators.ranking import rank_rows, top_rows

ORDER = (("points", "desc"), ("goals", "asc"), ("team", "asc"))


@pytest.fixture(scope="module")
def table(spark):
    """Ties, nulls, a null group, and one group with most of the rows."""
    return spark.range(3000).select(
        F.when(F.col("id") % 7 == 0, F.lit(None))
        .when(F.col("id") % 5 == 0, "small")
        .otherwise("large")
        .alias("league"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 4).alias("points"),
        (F.col("id") % 3).alias("goals"),
        F.format_string("team-%05d", F.col("id")).alias("team"),
    )


@pytest.mark.parametrize("groups", [[], ["league"]])
@pytest.mark.parametrize("slices", [2, 16])
def test_sliced_ranks_equal_the_window(table, groups, slices):
    plain = rank_rows(table, groups, ORDER, slices=1)
    sliced = rank_rows(table, groups, ORDER, slices=slices)
    assert plain.schema == sliced.schema or plain.dtypes == sliced.dtypes
    assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()


def test_slices_split_one_group(spark, monkeypatch):
    """No slice holds much more than its share, though two thirds of the rows tie."""
    import matchboard.operators.ranking as ranking

    staged = []
    keep = lambda df, name: staged.append(ranking_stage(df, name)) or staged[-1]
    ranking_stage = ranking.stage
    monkeypatch.setattr(ranking, "stage", keep)
    tied = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("points"),
        F.lit(0).alias("goals"),
        F.format_string("team-%05d", F.col("id")).alias("team"),
    )
    rank_rows(tied, [], ORDER, slices=16)
    sizes = [r["count"] for r in staged[0].groupBy("_slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 20_000 / 16


def test_top_rows_prunes_before_the_shuffle(table):
    top = top_rows(table, ["league"], ORDER, 3)
    assert top.groupBy("league").count().filter("count <> 3").isEmpty()
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
