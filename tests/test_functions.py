import decimal
import random

import pytest
from pyspark.sql import functions as F

from sessionloom.functions import labels, numbers, rules, sql, text, times


def evaluate(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(expression).collect()]


EMPTY_OR_NOT = [None, "", " ", " \t\x00", "null", "NULL", " Null\n", "nullx", "0"]


def test_blank_and_real_id(spark):
    assert evaluate(spark, EMPTY_OR_NOT, text.is_not_blank("v")) == [
        False, False, False, False, True, True, True, True, True,
    ]
    assert evaluate(spark, EMPTY_OR_NOT, text.is_blank("v"))[:5] == [True] * 4 + [False]
    expected = [False] * 7 + [True, True]
    assert evaluate(spark, EMPTY_OR_NOT, text.is_real_id("v")) == expected
    sql.register_sql_functions(spark)
    assert evaluate(spark, EMPTY_OR_NOT, F.expr("isNotEmpty(v)")) == expected


def test_split_ids(spark):
    assert evaluate(spark, ["1||2", "1| ", "3", "2|2", "", None], text.split_ids("v")) == [
        ["1", "2"], ["1"], ["3"], ["2", "2"], [], None,
    ]


def test_concat_id_name(spark):
    assert evaluate(spark, ["上海", None], text.concat_id_name(F.lit(1), "v")) == [
        "1:上海", "1:null",
    ]


def test_product_label(spark):
    infos = [
        '{"product_type":"1"}', '{"product_type":"0"}', '{"product_type":"7"}', '{"a":1}',
        None, "{broken", '{"product_type":1}',
    ]
    expected = ["第三方商品", "自营商品"] + ["未知商品"] * 4 + ["第三方商品"]
    assert evaluate(spark, infos, labels.product_label("v")) == expected
    sql.register_sql_functions(spark)
    assert evaluate(spark, infos, F.expr("fetch_product_type_from_json(v)")) == expected


def test_area_level(spark):
    areas = ["华东", "华南", "华北", "华中", "东北", "西南", None]
    assert evaluate(spark, areas, labels.area_level("v")) == list("AABBCDD")
    assert evaluate(spark, ["x"], labels.area_level("v", {})) == ["D"]


def test_length_level_bounds(spark):
    bounds = [
        4999, 5000, 10999, 11000, 30999, 31000, 59999, 60000, 179999, 180000, 359999, 360000,
    ]
    assert evaluate(spark, bounds, labels.length_level("v"), "bigint") == list("ABBCCDDEEFFG")


def test_plain_number(spark):
    values = [0.0, 0.5, 1234567.0, 1e15, 12.34567, 2.0005, 2.0625, -0.25]
    assert evaluate(spark, values, numbers.plain_number("v"), "double") == [
        "0", "0.5", "1234567", "1000000000000000", "12.346", "2.001", "2.062", "-0.25",
    ]


@pytest.mark.parametrize("scale", [0, 1, 2, 3])
def test_round_half_up_follows_the_stored_value(spark, scale):
    generator = random.Random(7)
    values = [generator.randint(-10**6, 10**6) / 1000 for _ in range(3000)]
    values += [k / 200 for k in range(-600, 600)] + [k / 8 for k in range(-80, 80)]
    step = decimal.Decimal(1).scaleb(-scale)
    expected = [
        float(decimal.Decimal(v).quantize(step, rounding=decimal.ROUND_HALF_UP)) for v in values
    ]
    assert evaluate(spark, values, numbers.round_half_up("v", scale), "double") == expected


def test_round_half_up_known_values(spark):
    values = [1.005, 0.125, -0.125, 1.015, 1e300, None]
    assert evaluate(spark, values, numbers.round_half_up("v"), "double") == [
        1.0, 0.13, -0.13, 1.01, 1e300, None,
    ]


def test_time_round_trip_and_fields(spark):
    value = "2024-02-29 23:05:07"
    millis = evaluate(spark, [value], times.to_millis("v"))[0]
    assert millis == 1709247907000
    assert evaluate(spark, [millis], times.from_millis("v"), "bigint") == [value]
    assert evaluate(spark, [millis], times.from_millis("v", "yyyyMMdd"), "bigint") == ["20240229"]
    fields = [
        evaluate(spark, [millis + 9], times.time_field("v", name), "bigint")[0]
        for name in times.TIME_FIELDS
    ]
    assert fields == [2024, 2, 29, 23, 5, 7, 9]
    with pytest.raises(ValueError):
        times.time_field("v", "week")


@pytest.mark.parametrize("bad", ["2024-01-01", "2024-13-01 00:00:00", "no time", "2024-01-01 1:2"])
def test_malformed_time_fails(spark, bad):
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID|cannot be parsed"):
        evaluate(spark, [bad], times.parse_time("v"))


def test_missing_time_fails_where_required(spark):
    assert evaluate(spark, [None], times.parse_time("v")) == [None]
    with pytest.raises(Exception, match="action time is missing"):
        evaluate(spark, [None], times.required_time("v"))


def test_time_comparisons(spark):
    noon = F.lit("2024-01-01 12:00:00")
    values = ["2024-01-01 11:59:58", "2024-01-01 12:00:03", "no time", None, "2124-01-01 12:00:00"]
    assert evaluate(spark, values, times.is_before("v", noon)) == [True, False, False, False, False]
    assert evaluate(spark, values, times.is_after("v", noon)) == [False, True, False, False, True]
    assert evaluate(spark, values, times.seconds_between("v", noon)) == [-2, 3, 0, 0, 0]


def test_time_keys(spark):
    assert evaluate(spark, ["2024-01-01 09:02:03"], times.date_hour_key("v")) == ["2024-01-01_09"]
    ts = times.parse_time("v")
    assert evaluate(spark, ["2024-01-01 09:02:03"], times.minute_key(ts)) == ["202401010902"]


def test_today_and_yesterday(spark):
    today, yesterday, now, before = spark.range(1).select(
        times.today(), times.yesterday(), F.current_date(), F.date_sub(F.current_date(), 1)
    ).first()
    assert (today, yesterday) == (str(now), str(before))


def test_comma_and_padding(spark):
    assert evaluate(spark, [",a,b,", ",,a", ",", "a"], text.trim_comma("v")) == [
        "a,b", ",a", "", "a",
    ]
    assert evaluate(spark, ["7", "12", "", "123"], text.pad_two("v")) == ["07", "12", "0", "0123"]


def test_fields(spark):
    values = ["a=1|b=2", "b=|b=3", "b=x=|c=1", "b=1=2|b=4", "c=1", None]
    assert evaluate(spark, values, text.get_field("v", "b")) == ["2", "3", "x", "4", None, None]
    assert evaluate(spark, ["a=1;b=2"], text.get_field("v", "b", ";")) == ["2"]
    values = ["a=1|b=2|b=3||", "c=1", "b=1", "b"]
    assert evaluate(spark, values, text.set_field("v", "b", "9")) == [
        "a=1|b=9|b=3", "c=1", "b=9", "b=9",
    ]
    values = ["bc=1|b=|x", "xb=1", "|b=1", "b==2"]
    assert evaluate(spark, values, text.set_field("v", "b", r"$1\2")) == [
        r"bc=1|b=$1\2|x", "xb=1", r"|b=$1\2", r"b=$1\2",
    ]
    assert evaluate(spark, ["a=1;b=2"], text.set_field("v", "a", "0", ";")) == ["a=0|b=2"]


@pytest.mark.parametrize("text", ["2024-01-01T10:00:00", "2024-01-01 1:0:0.12", "2024-01-01T10:00", "2024-01-01 10:00:00\n"])
def test_only_the_usual_format_is_a_time(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="PARSE|parse|CAST"):
        frame.select(times.parse_time("t")).collect()


def test_trim_comma_keeps_a_comma_before_a_final_line_feed(spark):
    frame = spark.createDataFrame([("a,\n",), (",a,",)], "t string")
    assert [r[0] for r in frame.select(text.trim_comma("t")).collect()] == ["a,\n", "a"]


FIELDS = ["age=30|city=a,b|sex=male", "age=17|city=c", "city=,|sex=", "age=30=1|sex=male==", "", None, "sex=x|sex=male"]


def kept(spark, test):
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(FIELDS)], "k int, v string")
    return [r["k"] for r in frame.where(test).orderBy("k").collect()]


def test_field_rules(spark):
    asked = "from=18|to=40|cities=b,c,,|sex=male|empty=|odd=1=2|none=,"
    assert [rules.parameter(asked, n) for n in ("from", "empty", "odd", "missing", "sex")] == ["18", None, None, None, "male"]
    assert kept(spark, rules.field_between("v", "age", asked, "from", "to")) == [0]
    assert kept(spark, rules.field_in("v", "city", asked, "cities")) == [0, 1]
    assert kept(spark, rules.field_equals("v", "sex", asked, "sex")) == [0, 3]
    # A parameter that is missing passes all, a rule without items none.
    for test in (
        rules.field_between("v", "age", asked, "from", "missing"),
        rules.field_in("v", "city", asked, "empty"),
        rules.field_equals("v", "sex", asked, "odd"),
    ):
        assert kept(spark, test) == list(range(len(FIELDS)))
    assert kept(spark, rules.field_in("v", "city", asked, "none")) == []


def test_rules_are_compiled_together(spark):
    every = [("between", "age", "from", "to"), ("in", "city", "cities"), ("equal", "sex", "sex")]
    assert kept(spark, rules.compile_rules("v", "from=10|to=40|cities=a,b,c", every)) == [0, 1]
    assert kept(spark, rules.compile_rules("v", "from=10|to=40|cities=a|sex=male", every)) == [0]
    assert kept(spark, rules.compile_rules("v", "", every)) == list(range(len(FIELDS)))
    plan = spark.range(1).select(F.lit("").alias("v")).where(rules.compile_rules("v", "", every))
    assert "Filter" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_bad_bounds_fail(spark):
    with pytest.raises(ValueError):
        rules.field_between("v", "age", "from=x|to=3", "from", "to")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("age=old",)], "v string").where(rules.field_between("v", "age", "from=1|to=3", "from", "to")).collect()
