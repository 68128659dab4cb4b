import random
from collections import Counter


from data import CITIES, action, actions, cities, rows
from sessionloom import schemas
from sessionloom.functions.sql import register_counted_values, register_sql_functions
from sessionloom.operators import products
from sessionloom.plans.products import area_top10_products


def clicks(spark, *pairs):
    return spark.createDataFrame(list(pairs), "click_product_id string, city_id int")


def test_counted_cities(spark):
    log = clicks(spark, ("p1", 1), ("p1", 2), ("p2", 1), ("p1", 1), ("p1", 2), ("p1", 5), ("p1", 77))
    assert rows(products.area_product_clicks(log, cities(spark))) == [
        ("华东", "p1", 4, "1:上海:2,2:杭州:2"),
        ("华东", "p2", 1, "1:上海:1"),
        ("华北", "p1", 1, "5:北京:1"),
    ]


def test_city_is_matched_whole(spark):
    log = clicks(spark, ("p", 101), ("p", 1))
    assert rows(products.area_product_clicks(log, cities(spark))) == [
        ("华东", "p", 2, "1:上海:1,101:上海:1")
    ]


def test_unnamed_city_and_repeated_city(spark):
    table = cities(spark, [(1, None, "x", ""), (2, "a", "x", ""), (2, "a", "x", ""), (2, "b", "x", "")])
    log = clicks(spark, ("p", 1), ("p", 2))
    assert rows(products.area_product_clicks(log, table)) == [("x", "p", 4, "1:null:1,2:a:2,2:b:1")]
    assert products.product_city_clicks(log, table).count() == 4


def brute_force(log, k):
    area = {row[0]: row[2] for row in CITIES}
    counts = Counter((area[city], product) for product, city in log)
    result = []
    for name in set(area.values()):
        ranked = sorted((-n, product) for (a, product), n in counts.items() if a == name)
        result += [(name, product, -n) for n, product in ranked[:k]]
    return sorted(result)


def test_top_products_against_brute_force_with_a_hot_product(spark):
    generator = random.Random(5)
    log = [
        ("7" if i % 3 == 0 else str(generator.randrange(30)), generator.choice([1, 2, 5, 101]))
        for i in range(900)
    ]
    top = products.area_top_products(clicks(spark, *log), cities(spark), 4)
    assert rows(top, "area", "click_product_id", "click_count") == brute_force(log, 4)


def test_unknown_product_drops_out_after_ranking(spark):
    log = actions(
        spark,
        *[action(click_product_id="10", city_id=1)] * 3,
        *[action(click_product_id="no number", city_id=1)] * 2,
        action(click_product_id="11", city_id=1),
        action(click_product_id="null", city_id=1),
    )
    info = spark.createDataFrame(
        [(10, "ten", '{"product_type":"0"}'), (11, "eleven", None)], schemas.PRODUCT_INFO
    )
    result = area_top10_products(log, None, cities(spark), info, {}, k=2)
    assert rows(result) == [("A", "10", "华东", 3, "1:上海:3", "ten", "自营商品")]
    result = area_top10_products(log, None, cities(spark), info, {})
    assert [r[1] for r in rows(result)] == ["10", "11"]


def test_counted_concat(spark):
    frame = spark.createDataFrame(
        [("g", "b"), ("g", "a"), ("g", "b"), ("g", None), ("h", None)], "k string, v string"
    )
    assert rows(products.counted_concat(frame, ["k"], "v", "o")) == [("g", "a:1,b:2"), ("h", "")]


def test_counted_values_and_parts(spark):
    pairs = [("g", "b"), ("g", "a"), ("g", "b"), ("g", None), ("h", None), (None, "x"), (None, "x")]
    pairs += [("big", f"v{k:03}") for k in range(100)]
    frame = spark.createDataFrame(pairs, "k string, v string")
    long = {tuple(r) for r in products.counted_values(frame, ["k"], "v").collect() if r["k"] != "big"}
    assert long == {(None, "x", 2), ("g", "a", 1), ("g", "b", 2)}
    parts = {tuple(r) for r in products.counted_concat_parts(frame, ["k"], "v", "o", items_per_row=10).collect()}
    assert {r for r in parts if r[0] != "big"} == {(None, 0, "x:2"), ("g", 0, "a:1,b:2")}
    texts = [r[2].split(",") for r in parts if r[0] == "big"]
    assert len(texts) == 10 and all(t == sorted(t) and len(t) < 30 for t in texts)
    assert sorted(i for t in texts for i in t) == [f"v{k:03}:1" for k in range(100)]


def test_counted_values_from_sql(spark):
    spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None), (None, "x")], "k string, v string").createOrReplaceTempView("pairs")
    register_sql_functions(spark)
    register_counted_values(spark, "pair_counts", "pairs", {"k": "STRING"}, "v")
    found = spark.sql("SELECT k, concat_distinct_str(collect_list(struct(value, n))) AS o FROM pair_counts() GROUP BY k")
    assert {tuple(r) for r in found.collect()} == {(None, "x:1"), ("g", "a:1,b:2")}
    # Counting combines before the shuffle.
    assert "partial_count" in found._jdf.queryExecution().executedPlan().toString()


def test_plan_counts_before_it_joins_cities(spark, tmp_path):
    actions(spark, action(click_product_id="1")).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log")).select("click_product_id", "city_id")
    plan = products.area_top_products(log, cities(spark))._jdf.queryExecution()
    lines = plan.executedPlan().toString().splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    below = [line for line in lines[first_join:] if "click_product_id" in line]
    assert any("partial_count" in line for line in below)
    assert sum("WindowGroupLimit" in line for line in lines) == 2
