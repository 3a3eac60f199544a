"""CSV edge cases of the raw tables and of the base table."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from encore.plans import preparation
from encore.schemas import BASE_TABLE, RAW
from encore.sources.base_table import load_abt, write_abt
from encore.sources.raw import NULL_TOKENS, load_raw, load_table
from encore.sources.staging import stage, staging_folder

FILES = {
    # columns in another order, and some that nobody needs
    "orders": """order_status,order_id,customer_id,order_purchase_timestamp,order_approved_at,order_delivered_customer_date,order_estimated_delivery_date
delivered,o1,k1,2018-01-01 10:00:00,x,2018-01-05 10:00:00,2018-01-04 00:00:00
delivered,o2,NA,not a time,x,,2018-01-04 00:00:00
""",
    "customers": """customer_id,customer_unique_id,customer_zip,customer_city,customer_state
k1,ann,01234,"são paulo, centro",SP
k2,null,01234,rio,N/A
""",
    "reviews": '''review_id,order_id,review_score,review_comment
r1,o1,5,"two
lines, a comma and a ""quote"""
r2,o1,nan,fine
''',
    "order_items": """order_id,order_item_id,product_id,price
o1,1,p,58.90
o1,2,p,
""",
}


@pytest.fixture
def raw(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"shop_{name}.csv").write_text(text, encoding="utf-8")
    return load_raw(spark, str(tmp_path), files={name: f"shop_{name}.csv" for name in FILES})


def test_declared_schemas(raw):
    for name, table in raw.items():
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in RAW[name]]


def test_columns_are_found_by_name_and_bad_values_are_null(raw):
    first, second = raw["orders"].orderBy("order_id").collect()
    assert first["order_delivered_customer_date"] == datetime(2018, 1, 5, 10)
    assert (second["customer_id"], second["order_purchase_timestamp"]) == (None, None)
    assert second["order_delivered_customer_date"] is None
    states = {r["customer_id"]: (r["customer_unique_id"], r["customer_state"]) for r in raw["customers"].collect()}
    assert states == {"k1": ("ann", "SP"), "k2": (None, None)}
    prices = [r["price"] for r in raw["order_items"].orderBy("order_item_id").collect()]
    assert prices == [Decimal("58.90"), None]


def test_quoted_line_breaks_stay_in_their_row(raw):
    scores = {r["review_id"]: r["review_score"] for r in raw["reviews"].collect()}
    assert scores == {"r1": 5.0, "r2": None}


def test_every_null_text_is_null(spark, tmp_path):
    lines = [f"k{i},u,{token}" for i, token in enumerate(NULL_TOKENS)]
    (tmp_path / "customers.csv").write_text("\n".join(["customer_id,customer_unique_id,customer_state", *lines]))
    for name in ("orders", "reviews", "order_items"):
        (tmp_path / f"{name}.csv").write_text(FILES[name], encoding="utf-8")
    customers = load_raw(spark, str(tmp_path))["customers"]
    assert customers.count() == len(NULL_TOKENS)
    assert customers.where("customer_state IS NOT NULL").count() == 0


def test_only_needed_csv_columns_are_read(spark, raw, tmp_path):
    names = {name: f"shop_{name}.csv" for name in FILES}
    whole = load_raw(spark, str(tmp_path), files=names, whole_files=tuple(RAW))
    plan = whole["customers"].select("customer_state")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_state:string>" in plan
    plan = raw["customers"].select("customer_state")._jdf.queryExecution().optimizedPlan().toString()
    assert "c4" in plan and "customer_city" not in plan


def base_rows(spark):
    rows = [
        ("ann", datetime(2018, 8, 29, 15, 0, 37), 1.0 / 3, 4.5, 1, 0, "SP", 2, Decimal("10.50"), 1),
        ("bob", datetime(2018, 8, 29, 0, 0, 0, 250), 2.0, None, 0, 0, None, 0, Decimal("0.00"), 0),
    ]
    return spark.createDataFrame(rows, BASE_TABLE)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_base_table_survives_the_disk(spark, tmp_path, fmt):
    path = str(tmp_path / "base")
    write_abt(base_rows(spark), path, fmt)
    back = load_abt(spark, path, fmt)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in BASE_TABLE]
    assert sorted(back.collect()) == sorted(base_rows(spark).collect(), key=lambda r: r[0])


def test_csv_text(spark, tmp_path):
    path = tmp_path / "base"
    write_abt(base_rows(spark).coalesce(1), str(path), "csv")
    (part,) = path.glob("part-*.csv")
    header, ann, bob = part.read_text().splitlines()
    assert header == ",".join(BASE_TABLE.names)
    assert ann.startswith("ann,2018-08-29 15:00:37,0.333")
    assert bob == "bob,2018-08-29 00:00:00.00025,2.0,,0,0,,0,0.00,0"


def test_bad_time_in_the_base_table_fails(spark, tmp_path):
    path = tmp_path / "base.csv"
    path.write_text(",".join(BASE_TABLE.names) + "\nann,yesterday,1.0,1.0,0,0,SP,1,1.00,0\n")
    with pytest.raises(Exception, match="not a timestamp: yesterday"):
        load_abt(spark, str(path), "csv").collect()


def test_base_table_from_csv_files(raw, spark):
    events = preparation.purchase_event(raw).collect()
    assert [(r["customer_unique_id"], r["first_item_cnt"], r["first_purchase_gmv"]) for r in events] == [
        ("ann", 2, Decimal("58.90"))
    ]


def test_staged_tables_go_to_the_shared_folder(spark):
    folder = staging_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", folder)
    staged = stage(spark.range(10), "numbers")
    assert staged.count() == 10
    assert staged.inputFiles()[0].split("file://")[-1].startswith(folder)
    assert isinstance(staged.schema["id"].dataType, T.LongType)


def test_texts_keep_outer_blanks_and_line_breaks(spark, tmp_path):
    texts = spark.createDataFrame([(1, ' SP '), (2, 'a "b"\nc, d')], "id bigint, state string")
    write_abt(texts, str(tmp_path / "t"), "csv")
    back = load_abt(spark, str(tmp_path / "t"), "csv", texts.schema)
    assert sorted(map(tuple, back.collect())) == [(1, " SP "), (2, 'a "b"\nc, d')]


def test_a_broken_row_fails_where_lines_are_rows(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "customers.csv").write_text('customer_id,customer_unique_id,customer_state\n1,u,"S\nP"\n')
    schema = RAW["customers"]
    path = str(folder / "customers.csv")
    assert load_table(spark, path, schema, multi_line=True).collect()[0]["customer_state"] == "S\nP"
    with pytest.raises(Exception, match="(?i)malformed"):
        load_table(spark, path, schema).select("customer_id").collect()
