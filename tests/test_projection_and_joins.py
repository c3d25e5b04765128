import pytest
from pyspark.sql import functions as F

from scorefold.operators import joins, projection


def test_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Raw One` int, B int, cC int")
    out = projection.rename_columns(df, {"raw one": "First Name", "b": "Beta"})
    assert out.columns == ["FirstName", "Beta", "cc"]
    with pytest.raises(projection.ColumnError):
        projection.rename_columns(df, {"b": "CC"})
    table = spark.createDataFrame([(" raw one", "First Name ")], "raw_lower string, final string")
    assert projection.read_name_map(table) == {"raw one": "First Name"}
    assert projection.read_name_map(table, names=["RAW ONE", "c"]) == {"raw one": "First Name"}
    assert projection.read_name_map(table, names=["c"]) == {}


def test_missing_columns_are_named(spark):
    with pytest.raises(projection.ColumnError, match="nope"):
        projection.select_columns(spark.range(1), ["ID", "nope"])


def test_names():
    assert projection.bureau_code("V71_AT36S_mo_since_most_recent_dq") == "V71_AT36S"
    assert projection.version_agnostic_name("creative_score_2020") == "creative_score"
    assert projection.version_agnostic_name("PHE_v2") == "HPE_Housing_Payment_Estimation"
    assert len(projection.rules.SKINNY_COLUMNS) == 53 and len(projection.rules.REPRODUCIBILITY_COLUMNS) == 47


def test_between_times_is_half_open(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "d string").selectExpr("CAST(d AS TIMESTAMP_NTZ) AS d")
    assert projection.between_times(df, "d", "2024-01-01", "2024-01-03").count() == 2
    assert projection.between_times(df, "d", None, "2024-01-02").count() == 1
    assert projection.between_times(df, "d").count() == 3


def people(spark):
    return spark.createDataFrame([(1, "00001"), (2, "00002"), (3, "99999"), (4, None)], "id int, zip string")


def side(spark, name, rows):
    return spark.createDataFrame(rows, f"zipcode string, {name} double")


def chained(df, sides):
    df = df.withColumnRenamed("zip", "zipcode")
    for s in sides:
        df = df.join(s, "zipcode", "left")
    return df.withColumnRenamed("zipcode", "zip")


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_zip_append_equals_chained_joins(spark, threshold, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    a = side(spark, "a", [("00001", 1.0), ("00002", None)])
    b = side(spark, "b", [("00002", 5.0), (None, 9.0)])
    twice = side(spark, "c", [("00001", 1.0), ("00001", 2.0)])
    for sides in ([a, b], [a, twice, b]):
        got = joins.append_zip_data(people(spark), sides, "zip")
        want = chained(people(spark), sides).select(*got.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        joins.append_zip_data(people(spark), [twice], "zip", strict=True)


def test_equal_names_of_two_sides_stay_apart(spark):
    a, b = side(spark, "population", [("00001", 5.0), (None, 1.0), (None, 2.0)]), side(spark, "population", [("00001", 7.0)])
    got = joins.append_zip_data(people(spark), [a, b], "zip", strict=True)
    rows = {tuple(r)[-2:] for r in got.where("zip = '00001'").collect()}
    assert rows == {(5.0, 7.0)}


def test_semi_and_anti(spark):
    ids = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert [r["id"] for r in projection.keep_ids(people(spark), ids, "id").orderBy("id").collect()] == [1, 3]
    assert [r["id"] for r in projection.drop_ids(people(spark), ids, "id").orderBy("id").collect()] == [2, 4]


def test_scenario_keeps_overwritten_inputs(spark):
    from scorefold.operators.scenario import add_scenario

    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, x double")
    out = add_scenario(df, [lambda d: d.withColumn("x", F.col("x") * 100).withColumn("y", F.col("x") + 1)], ["x", "y"], "best_", "id = 1")
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 10.0, 1000.0, 1001.0), (2, 20.0, None, None)]
