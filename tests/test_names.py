"""Column-name cleaning (flat and nested)."""

import pytest

from strata.functions.names import clean_column_names, clean_column_names_nested, clean_name


@pytest.mark.parametrize("raw,want", [
    ("Wind Speed", "wind_speed"), ("gust\tmax", "gustmax"), ("a\t \tb", "a_b"), ("deep  blue", "deep__blue"),
    (" \tDew Point\t ", "dew_point"), ("_Own_", "own"), ("__x y__", "x_y"), ("PLAIN", "plain"), ("ÄRA No", "ära_no")])
def test_rule(raw, want):
    assert clean_name(raw) == want


def test_flat_keeps_values(spark):
    out = clean_column_names(spark.createDataFrame([(7.5, "NW")], "`Wind Speed` DOUBLE, ` Wind\tDir ` STRING"))
    assert out.columns == ["wind_speed", "winddir"]
    assert tuple(out.first()) == (7.5, "NW")


def test_clean_names_are_left_alone(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b_c INT")
    assert clean_column_names(df) is df


def test_every_depth(spark):
    ddl = ("`Stn` STRUCT<`Long Name`: STRING, `Geo Ref`: STRUCT<`Lat N`: DOUBLE>>, "
           "`Read Outs` ARRAY<STRUCT<`At Hour`: INT>>, "
           "`By Grid` MAP<STRUCT<`Cell X`: INT>, ARRAY<STRUCT<`Top Val`: INT>>>")
    df = spark.sql("SELECT named_struct('Long Name', 'Fell', 'Geo Ref', named_struct('Lat N', 54.5D)) AS `Stn`, "
                   "array(named_struct('At Hour', 3), named_struct('At Hour', 9)) AS `Read Outs`, "
                   "map(named_struct('Cell X', 4), array(named_struct('Top Val', 8))) AS `By Grid`")
    assert df.schema.simpleString() == spark.createDataFrame([], ddl).schema.simpleString()
    out = clean_column_names_nested(df)
    assert out.schema.simpleString() == (
        "struct<stn:struct<long_name:string,geo_ref:struct<lat_n:double>>,read_outs:array<struct<at_hour:int>>,"
        "by_grid:map<struct<cell_x:int>,array<struct<top_val:int>>>>")
    r = out.first()
    assert r["stn"]["geo_ref"]["lat_n"] == 54.5 and [x["at_hour"] for x in r["read_outs"]] == [3, 9]
    assert [(k["cell_x"], v[0]["top_val"]) for k, v in r["by_grid"].items()] == [(4, 8)]


def test_nullability_stays(spark):
    out = clean_column_names_nested(spark.range(1).toDF("Row No"))
    assert out.columns == ["row_no"] and out.schema["row_no"].nullable is False


@pytest.mark.parametrize("sql", ["SELECT 1 AS `Q R`, 2 AS q_r", "SELECT 1 AS n, named_struct('V W', 1, 'v_w', 2) AS s",
                                 "SELECT array(named_struct('V\tW', 1, 'vw', 2)) AS s"])
def test_names_that_meet_are_an_error(spark, sql):
    with pytest.raises(ValueError):
        clean_column_names_nested(spark.sql(sql))
