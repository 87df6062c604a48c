"""Files, loads, generated tables and a whole run."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ordermill.operators import clean, quality
from ordermill.plans import end_to_end, registry
from ordermill.plans.analytics import QUESTIONS, running_revenue_by_region, value_quartiles
from ordermill.schemas import CLEAN_TYPES, INPUT_PLACE, PRIMARY_KEYS, Tables
from ordermill.sources import files, generate
from tests.tables import customer, item, order, product, tables


def test_csv_scan(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,customer_id,order_date,status,region_code\n"
        'O1,NA,"05-01-2024", placed ,"a ""quoted"", name"\n'
        "O2,,n/a, NA ,null\n"
    )
    found = files.read_raw(spark, str(tmp_path), "orders").orderBy("order_id").collect()
    assert [tuple(r) for r in found] == [
        ("O1", None, "05-01-2024", " placed ", 'a "quoted", name'),
        ("O2", None, None, " NA ", None),
    ]


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,order_date,customer_id,status,region_code\nO1,a,b,c,d\n"
    )
    with pytest.raises(Exception, match="header does not conform"):
        files.read_raw(spark, str(tmp_path), "orders").collect()


def test_csv_round_trip_keeps_padding_and_quotes(spark, tmp_path):
    rows = [(" a ", 'say "x", y'), ("\tb", None), ("c\\", "d")]
    frame = spark.createDataFrame(rows, "k string, v string")
    files.write_csv(frame, f"{tmp_path}/t.csv")
    back = files.read_text_csv(spark, f"{tmp_path}/t.csv", "k string, v string").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, rows))


@pytest.fixture(scope="module")
def shop(spark):
    return tables(
        spark,
        customers=[customer("A")],
        products=[product("P", "Books")],
        orders=[order("O1", "A", "2024-01-02 03:04:05"), order("O2", "A", "2024-02-02 00:00:00")],
        items=[item("I1", "O1", "P", 2, 12.345678), item("I2", "O2", "P", -1, None)],
    )


def test_load_and_clean_csv(spark, shop, tmp_path):
    counts = files.load_tables(shop, f"{tmp_path}/tables")
    assert {tuple(r) for r in counts.collect()} == {
        ("customers", 1), ("products", 1), ("orders", 2), ("order_items", 2)
    }
    loaded = files.read_tables(spark, f"{tmp_path}/tables")
    files.write_clean_csv(loaded, f"{tmp_path}/cleaned")
    for name, before in shop._asdict().items():
        key = PRIMARY_KEYS[name]
        expected = before.orderBy(key).collect()
        assert getattr(loaded, name).orderBy(key).collect() == expected
        again = files.read_clean_csv(spark, f"{tmp_path}/cleaned", name)
        assert again.dtypes == list(CLEAN_TYPES[name].items())
        assert again.orderBy(key).collect() == expected


def test_loaded_orders_lie_in_date_order(spark, shop, many_blocks, tmp_path):
    many = spark.range(400).selectExpr(
        "string(id) AS order_id", "'A' AS customer_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(pmod(id * 37, 400)) AS order_date",
        "'PLACED' AS status", "'EAST' AS region_code", "0 AS is_guest_order",
    )
    files.load_tables(shop._replace(orders=many), f"{tmp_path}/tables")
    spans = (
        files.read_tables(spark, f"{tmp_path}/tables").orders
        .groupBy(F.input_file_name()).agg(F.min("order_date"), F.max("order_date"))
        .orderBy("min(order_date)").collect()
    )
    assert len(spans) > 1
    assert all(before[2] <= after[1] for before, after in zip(spans, spans[1:]))


def test_load_refuses_double_keys(spark, shop, tmp_path):
    twice = shop._replace(orders=shop.orders.unionAll(shop.orders))
    with pytest.raises(ValueError, match="order_id"):
        files.load_tables(twice, f"{tmp_path}/tables")
    assert files.load_tables(twice, f"{tmp_path}/tables", unique_keys=False).count() == 4


def test_a_failed_load_leaves_the_one_before(spark, shop, tmp_path):
    folder = f"{tmp_path}/tables"
    files.load_tables(shop, folder)
    with pytest.raises(ValueError):
        files.load_tables(shop._replace(orders=shop.orders.unionAll(shop.orders)), folder)
    assert files.read_tables(spark, folder).orders.count() == 2
    files.load_tables(shop._replace(orders=shop.orders.filter("order_id = 'O1'")), folder)
    assert files.read_tables(spark, folder).orders.count() == 1


def test_a_bucketed_table_has_one_file_per_bucket(spark, shop, many_blocks):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    many = spark.range(0, 400, 1, 12).selectExpr(
        "string(id) AS order_id", "'A' AS customer_id", "timestamp_ntz'2024-01-01' AS order_date",
        "'PLACED' AS status", "'EAST' AS region_code", "0 AS is_guest_order",
    )
    saved = files.save_bucketed(shop._replace(orders=many), "shop", 16)
    assert len(saved.orders.inputFiles()) == 16


def test_bucketed_tables_sum_and_join_orders_without_shuffle(spark, settings, shop):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    saved = files.save_bucketed(shop, "shop", 4)
    assert value_quartiles(saved).collect() == value_quartiles(shop).collect()
    question = running_revenue_by_region(saved)
    plan = question._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" not in plan
    assert "hashpartitioning(region_code" in plan


N = 20_000


def ids(spark, n=N, parts=3):
    return spark.range(1, n + 1, 1, parts)


def near(found, percent, of=N):
    return abs(found / of * 100 - percent) < max(0.3, percent * 0.1)


def test_generated_rows_do_not_depend_on_partitions(spark):
    makers = [
        generate.customers, generate.products, lambda i: generate.orders(i, 50),
        lambda i: generate.order_items(i, 70, 60),
    ]
    for make in makers:
        few, many = (make(ids(spark, 300, p)).collect() for p in (1, 7))
        assert sorted(few) == sorted(many)


def test_generated_customers(spark):
    made = generate.customers(ids(spark))
    assert near(quality.invalid_emails(made).count(), 2)
    assert near(made.filter("email NOT LIKE '%@%'").count(), 1)
    kinds = dict(made.groupBy("customer_type").count().collect())
    assert all(near(kinds[k], w) for k, w in generate.CUSTOMER_TYPES.items())
    days = made.agg(F.min("registration_date"), F.max("registration_date")).first()
    assert tuple(days) == ("2021-01-01", "2024-12-31")
    assert made.agg(F.min("customer_id"), F.max("customer_id")).first()[:] == ("C00001", "C20000")


def test_generated_products(spark):
    made = generate.products(ids(spark))
    changed = clean.clean_products(made).issues.first().product_names_normalized
    assert near(changed, 15 * 0.66)
    assert near(made.filter("product_name LIKE '   %   '").count(), 15 * 0.34)
    pairs = made.select("category", "subcategory").distinct().collect()
    assert sorted(map(tuple, pairs)) == sorted(
        (c, s) for c, parts in generate.CATEGORIES.items() for s in parts
    )
    low, high = made.selectExpr("min(double(cost_price))", "max(double(cost_price))").first()
    assert 50 <= low < 60 and 24_990 < high <= 25_000


def test_generated_orders(spark):
    made = generate.orders(ids(spark), 500)
    cleaned = clean.clean_orders(made)
    issues = cleaned.issues.first()
    assert near(issues.null_customer_id_handled, 5)
    assert near(issues.wrong_date_format_fixed, 6)
    assert cleaned.rows.filter("order_date IS NULL").count() == 0
    low, high = cleaned.rows.agg(F.min("order_date"), F.max("order_date")).first()
    assert low.date() == dt.date(2023, 1, 1) and high.date() == dt.date(2024, 12, 31)
    kinds = dict(made.groupBy("status").count().collect())
    assert all(near(kinds[k], w) for k, w in generate.ORDER_STATUSES.items())
    assert made.select("region_code").distinct().count() == len(generate.REGIONS)
    known = made.filter("customer_id <> ''").agg(F.countDistinct("customer_id")).first()[0]
    assert known == 500


def test_generated_items(spark):
    made = generate.order_items(ids(spark), 800, 500)
    issues = clean.clean_order_items(made).issues.first()
    assert near(issues.negative_quantity_rows, 3)
    assert near(issues.discount_over_100_capped, 0.5)
    assert issues.zero_quantity_rows == 0
    for orders, items in ((800, made), (1_000_000, generate.order_items(
            ids(spark), 1_000_000, 500))):
        ghosts = items.filter(f"int(substr(order_id, 2)) > {orders}")
        assert near(ghosts.count(), 1)
        assert ghosts.select("order_id").distinct().count() == generate.GHOST_ORDERS


def test_large_ids_keep_all_digits(spark):
    big = spark.range(123_456_789_012, 123_456_789_013)
    assert generate.products(big).first().product_id == "P123456789012"


def test_whole_run(spark, tmp_path):
    raw = Tables(
        generate.customers(ids(spark, 500)),
        generate.products(ids(spark, 500)),
        generate.orders(ids(spark, 800), 500),
        generate.order_items(ids(spark, 1_800), 800, 500),
    )
    files.write_clean_csv(raw, f"{tmp_path}/raw")
    counts = dict(end_to_end.run(spark, f"{tmp_path}/raw", f"{tmp_path}/out").collect())
    report = spark.read.options(**files.CSV_OPTIONS).csv(f"{tmp_path}/out/data_quality_report.csv")
    figures = {(r.table_name, r.metric): r.value for r in report.collect()}
    assert counts["customers"] == counts["products"] == 500
    assert counts["orders"] == 800
    orphans = int(figures["integrity", "orphan_rows"])
    assert orphans > 0
    assert counts["order_items"] == 1_800 - orphans
    assert figures["orders", "total_rows"] == "800"
    written = {name[:-4] for name in os.listdir(f"{tmp_path}/out/query_results")}
    assert written == set(QUESTIONS)
    quartiles = spark.read.options(**files.CSV_OPTIONS).csv(
        f"{tmp_path}/out/query_results/q11_value_quartiles.csv"
    )
    sizes = [r["count"] for r in quartiles.groupBy("quartile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_missing_folder(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_raw(spark, str(tmp_path), "orders")


def test_one_of_two_loads_at_once_is_published(spark, shop, tmp_path):
    folder = f"{tmp_path}/tables"
    files.load_tables(shop, folder)
    # Both began with the first version; the second one to publish must fail.
    few = shop._replace(orders=shop.orders.limit(0))
    files.load_tables(few, folder)
    with pytest.raises(files.LoadConflict):
        files._publish(spark, folder, 2, "late")
    assert files.read_tables(spark, folder).orders.count() == 0
    assert [r.version for r in files.published_loads(spark, folder).orderBy("version").collect()] == [
        1, 2]


def test_loads_from_many_threads_have_one_winner(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def publish(name):
        try:
            files._publish(spark, f"{tmp_path}/t", 1, name)
            return name
        except files.LoadConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        winners = [n for n in pool.map(publish, map(str, range(16))) if n]
    assert len(winners) == 1
    assert [r.load for r in files.published_loads(spark, f"{tmp_path}/t").collect()] == winners


def test_a_version_that_is_still_empty_is_not_read(spark, shop, tmp_path):
    folder = f"{tmp_path}/tables"
    files.load_tables(shop, folder)
    (tmp_path / "tables" / "published" / "000000000002.load").touch()
    assert files.read_tables(spark, folder).orders.count() == shop.orders.count()
    files.load_tables(shop._replace(orders=shop.orders.limit(0)), folder)
    assert files.read_tables(spark, folder).orders.count() == 0


def test_nothing_is_read_before_a_load(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_tables(spark, f"{tmp_path}/nothing")


def test_sample_in_the_order_of_many_files(spark, tmp_path):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    keys = [f"C{(i * 37) % 100:03}" for i in range(100)]
    for part in range(5):
        lines = ["customer_id,customer_name,email,registration_date,customer_type"]
        lines += [f"{k},Name,{'bad' if i % 3 == 0 else 'a@b.org'},2024-01-01,VIP"
                  for i, k in enumerate(keys) if i // 20 == part]
        (folder / f"part-{part:05}.csv").write_text("\n".join(lines) + "\n")
    rows = files.read_raw(spark, str(tmp_path), "customers", with_place=True)
    found = [r[0] for r in quality.invalid_email_sample(rows).collect()]
    assert found == [k for i, k in enumerate(keys) if i % 3 == 0][:10]
    staged = rows.write.parquet(f"{tmp_path}/staged") or spark.read.parquet(f"{tmp_path}/staged")
    assert [r[0] for r in quality.invalid_email_sample(staged.repartition(3)).collect()] == found
    plain = quality.invalid_email_sample(rows.drop(INPUT_PLACE))
    assert [r[0] for r in plain.collect()] == sorted(
        k for i, k in enumerate(keys) if i % 3 == 0)[:10]


def test_malformed_lines_are_told_and_kept(spark, tmp_path):
    lines = ["order_id,customer_id,order_date,status,region_code", "O1,C1,2024-01-01,PLACED,EAST",
             "O2,C1,2024-01-01,PLACED", 'O3,"C,1",2024-01-01,PLACED,EAST,more', "O4",
             'O5,"C,1",2024-01-01,PLACED,EAST']
    (tmp_path / "orders.csv").write_text("\n".join(lines) + "\n")
    found = files.malformed_lines(spark, str(tmp_path), "orders")
    assert sorted(r.line for r in found.collect()) == sorted([lines[2], lines[3], lines[4]])
    assert found.count() == 3
    rows = files.read_raw(spark, str(tmp_path), "orders").orderBy("order_id").collect()
    assert [r.region_code for r in rows] == ["EAST", None, "EAST", None, "EAST"]


@pytest.fixture(scope="module")
def star_folder(spark, tmp_path_factory):
    """Star-schema tables of 200 orders in four files, one order without a key."""
    folder = str(tmp_path_factory.mktemp("star"))
    ids = spark.range(1, 201)
    columns = {
        "customer": ["id AS c_custkey", "'Name' AS c_name", "'AUTO' AS c_mktsegment"],
        "part": ["id AS p_partkey", "'name' AS p_name", "'Brand' AS p_brand", "'TYPE' AS p_type",
                 "1.5D AS p_retailprice"],
        "orders": ["IF(id < 200, id, NULL) AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus",
                   "TIMESTAMP_NTZ '2024-01-05 00:00:00' AS o_orderdate"],
        "lineitem": ["id AS l_orderkey", "id AS l_partkey", "1 AS l_linenumber", "2D AS l_quantity",
                     "9D AS l_extendedprice", "0.1D AS l_discount", "'N' AS l_returnflag"],
    }
    for name, parts in columns.items():
        ids.repartition(4).selectExpr(*parts).write.parquet(f"{folder}/{name}.parquet")
    return folder


def malformed_lines_of_star() -> list[str]:
    return ["C1,2024-01-05 10:11:12,PLACED,EAST"] + [
        f"{i},C1,2024-01-05 10:11:12,PLACED{'' if i % 23 == 0 else ',EAST,more'}"
        for i in range(1, 200) if i % 23 == 0 or i % 29 == 0]


def test_malformed_lines_of_many_files(spark, star_folder):
    path = registry._malformed(spark, star_folder).removeprefix("file:")
    texts = [p.read_text() for p in Path(path, "orders.csv").glob("part-*")]
    assert len(texts) == 4  # no task holds all lines
    header = "order_id,customer_id,order_date,status,region_code"
    assert [t.split("\n")[0] for t in texts] == [header] * 4
    lines = [line for t in texts for line in t.splitlines()[1:]]
    assert len(lines) == 200 and '"' not in "".join(lines)
    found = registry.queries()["csv_malformed_lines"](spark, star_folder).collect()
    assert {r.table_name for r in found} == {"orders"}
    assert sorted(r.line for r in found) == sorted(malformed_lines_of_star())


def test_report_counts_malformed_lines_of_many_files(spark, star_folder, monkeypatch):
    made = []
    build = registry._malformed
    monkeypatch.setattr(registry, "_malformed", lambda *a: made.append(build(*a)) or made[-1])
    found = registry.queries()["quality_report_malformed_lines"](spark, star_folder).collect()
    assert len(list(Path(made[0].removeprefix("file:"), "orders.csv").glob("part-*"))) == 4
    assert {(r.table_name, r.metric): r.value for r in found} == {
        ("orders", "total_rows"): 200, ("orders", "wrong_date_format_fixed"): 0,
        ("orders", "null_customer_id_handled"): 0,
        ("orders", "malformed_lines"): len(malformed_lines_of_star())}
