import datetime as dt

from conftest import plan_of
from pyspark.sql import functions as F

from lakeops.functions.scalars import boundaries_crossed, mask_digits_but_last, mask_email, mask_partial, redact
from lakeops.operators import cleaning, governance, partitions
from lakeops.sources import landing


def test_mixed_dates(spark):
    rows = [(1, "2026-08-03T10:11:12"), (2, "03/08/2026 10:11"), (3, "2026-13-45T00:00:00"), (4, None), (5, "soon"), (6, "31/02/2026 10:00")]
    parsed, reason = cleaning.parse_mixed_dates(F.col("t"))
    got = {r.id: (r.p, r.r) for r in spark.createDataFrame(rows, "id int, t string").select("id", parsed.alias("p"), reason.alias("r")).collect()}
    assert got[1] == (dt.datetime(2026, 8, 3, 10, 11, 12), None) and got[2] == (dt.datetime(2026, 8, 3, 10, 11), None)
    assert {i: got[i][1] for i in (3, 4, 5, 6)} == {3: "unknown date format", 4: "missing date", 5: "unknown date format", 6: "unknown date format"}


def test_phones_in_all_layouts(spark):
    rows = [("Latvia", "+371 2034 5678"), ("Latvia", "(371) 20345678"), ("Latvia", "20-345-678"), ("Latvia", "+37120345678"), ("Sweden", "(462) 0345678"), ("Latvia", "123"), ("Mars", "+1 2034 5678")]
    frame = spark.createDataFrame(rows, "country string, phone string")
    got = [r.p for r in frame.select(cleaning.standardize_phone(F.col("phone"), cleaning.prefix_of(F.col("country"))).alias("p")).collect()]
    assert got == ["+37120345678"] * 4 + ["+4620345678", None, None]


def test_emails_and_countries(spark):
    email, flag = cleaning.standardize_email(F.col("e"))
    rows = spark.createDataFrame([(" A.b@Example.com ",), (None,), ("",), ("a.at.example.com",)], "e string").select(email.alias("e"), flag.alias("f")).collect()
    assert [(r.e, r.f) for r in rows] == [("a.b@example.com", "ok"), (None, "missing"), (None, "missing"), ("a.at.example.com", "invalid")]
    countries = spark.createDataFrame([("Latvia",), ("Austria",)], "country string")
    dirty = spark.createDataFrame([(1, "latvia "), (2, "LATVIA"), (3, "new land"), (4, None)], "id int, country string")
    got = {r.id: (r.country, r.country_known) for r in cleaning.standardize_country(dirty, countries).collect()}
    assert got == {1: ("Latvia", True), 2: ("Latvia", True), 3: ("New Land", False), 4: (None, False)}


def test_latest_status_tie_goes_to_the_later_load(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'Placed', 5, date'2026-08-02'), (1, 'Cancelled', 5, date'2026-08-05'), (2, 'Placed', 5, date'2026-08-02'), (2, 'Shipped', 4, date'2026-08-09') AS r(order_id, status, modified_at, load_date)")
    assert {(r.order_id, r.status) for r in cleaning.upsert_latest_status(rows).collect()} == {(1, "Cancelled"), (2, "Placed")}


def test_imputed_price_is_the_price_of_the_order_day(spark):
    prices = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2026-08-01', 10), (1, timestamp_ntz'2026-08-05', 12) AS p(product_id, load_date, list_price)")
    lines = spark.sql("SELECT * FROM VALUES (1, 1, timestamp_ntz'2026-08-04 09:00', CAST(NULL AS INT)), (2, 1, timestamp_ntz'2026-08-03 09:00', NULL), (3, 1, timestamp_ntz'2026-08-09', 7), (4, 2, timestamp_ntz'2026-08-09', NULL) AS l(id, product_id, at, unit_price)")
    got = {r.id: (r.unit_price, r.price_imputed) for r in cleaning.impute_unit_price(lines, prices, "at").collect()}
    assert got == {1: (12, True), 2: (10, True), 3: (7, False), 4: (None, False)}


def test_quarantine_keeps_every_row(spark):
    lines = spark.createDataFrame([(1, 1, 2), (2, 1, -1), (3, 9, 1), (4, 9, 0), (5, 1, None)], "id int, product_id long, quantity int")
    split = cleaning.quarantine_lines(lines, spark.createDataFrame([(1,)], "product_id long"))
    assert [r.id for r in split.good.collect()] == [1]
    assert {r.id: len(r.reasons) for r in split.rejected.collect()} == {2: 1, 3: 1, 4: 2, 5: 1}


def test_inferred_member_is_replaced(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    known = spark.createDataFrame([(1, "Ann")], "k long, name string")
    first = cleaning.inferred_members(facts, known, "k")
    assert {tuple(r) for r in first.collect()} == {(1, "Ann", False), (2, None, True)}
    later = cleaning.inferred_members(facts, spark.createDataFrame([(1, "Ann"), (2, "Bo")], "k long, name string"), "k")
    assert {tuple(r) for r in later.collect()} == {(1, "Ann", False), (2, "Bo", False)}


def test_scd2_versions(spark):
    changes = spark.sql("""SELECT * FROM VALUES (1, timestamp_ntz'2026-01-01', 'Riga', 'a@x'), (1, timestamp_ntz'2026-02-01', 'Riga', 'b@x'),
      (1, timestamp_ntz'2027-03-01', 'Oslo', 'b@x'), (1, timestamp_ntz'2027-04-01', NULL, 'c@x') AS c(id, at, city, email)""")
    got = cleaning.scd2(changes, "id", "at", ["city"], ["email"]).orderBy("valid_from").collect()
    assert [(r.city, str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current, r.email) for r in got] == [
        ("Riga", "2026-01-01", "2027-03-01", False, "c@x"), ("Oslo", "2027-03-01", "2027-04-01", False, "c@x"), (None, "2027-04-01", "9999-12-31", True, "c@x")]


def test_full_and_delta_files(spark, tmp_path):
    day = tmp_path / "load_date=2026-08-01"
    day.mkdir()
    (day / "customers_full.csv").write_text('id,name,attributes\n1,"Ann, B","{""a"": 1}"\nx,Bad,\n2,Bo,\n')
    later = tmp_path / "load_date=2026-08-02"
    later.mkdir()
    (later / "customers_delta.csv").write_text("id,name,attributes,_change\n2,Bo K,,tier\n")
    rows = landing.read_full_and_delta(spark, str(tmp_path), "id INT, name STRING, attributes STRING").collect()
    good = {(r.id, r.name, r.attributes, r["_change"], str(r.load_date)) for r in rows if r[landing.CORRUPT] is None}
    assert good == {(1, "Ann, B", '{"a": 1}', None, "2026-08-01"), (2, "Bo", None, None, "2026-08-01"), (2, "Bo K", None, "tier", "2026-08-02")}
    assert [r[landing.CORRUPT] for r in rows if r[landing.CORRUPT]] == ["x,Bad,"]


def test_partition_numbers_and_pruning(spark, tables):
    bounds = partitions.month_starts(dt.date(2026, 7, 1), 4)
    days = spark.sql("SELECT * FROM VALUES (date'2026-08-15'), (date'2026-06-30'), (date'2026-07-01'), (date'2027-01-01') AS d(day)")
    assert [r.p for r in days.select(partitions.partition_number(F.col("day"), bounds).alias("p")).collect()] == [3, 1, 2, 5]
    counted = partitions.rows_per_partition(days, "day", bounds).orderBy("partition_number").collect()
    assert [r.rows for r in counted] == [1, 1, 1, 0, 1]
    path = partitions.monthly_table(tables.orders.withColumnRenamed("o_orderdate", "at"), "at")
    plan = plan_of(partitions.read_months(spark, path, dt.date(1998, 8, 1), dt.date(1998, 9, 1)).select("o_orderkey"))
    assert "PartitionFilters: [isnotnull(event_month" in plan


def test_masks_and_redaction(spark):
    row = spark.range(1).select(
        mask_email(F.lit("john@x.org")).alias("e"), mask_email(F.lit(None).cast("string")).alias("n"), mask_partial(F.lit("+371 2034 5678"), 4, "XXXXXXX", 2).alias("p"),
        mask_partial(F.lit("12345"), 4, "XXXXXXX", 2).alias("s"), mask_digits_but_last(F.lit("+371 2034 5678")).alias("d"),
        redact(F.lit("write a.b@x.org or +371 2034 5678, (371) 20345678, 20-345-678")).alias("r"),
        boundaries_crossed("day", F.lit("2026-01-01 23:59:00").cast("timestamp_ntz"), F.lit("2026-01-02 00:01:00").cast("timestamp_ntz")).alias("b")).first()
    assert (row.e, row.n, row.p, row.s, row.d) == ("jXXX@XXXX.com", None, "+371XXXXXXX78", "XXXXXXX", "+*** **** 5678")
    assert row.r == "write [email] or [phone], [phone], [phone]" and row.b == 1


def test_row_filter_denies_by_default(spark):
    rows = spark.createDataFrame([(1, "Baltics"), (2, "Nordics"), (3, None)], "id int, region string")
    mapping = spark.createDataFrame([("ann", "Baltics"), ("ann", "Baltics")], "user_name string, region string")
    seen = lambda **kw: {r.id for r in governance.row_filter(rows, "region", **kw).collect()}
    assert seen(user="ann", mapping=mapping) == {1} and seen(user="bob", mapping=mapping) == set() and seen() == set()
    assert seen(context="Nordics") == {2} and seen(user="ann", mapping=mapping, context="Nordics") == {1, 2} and seen(admin=True) == {1, 2, 3}
    assert governance.row_policy_claims(rows, "region", "guest", {"region": "Baltics"}).count() == 0
    assert governance.row_policy_claims(rows, "region", "sales", {}).count() == 0
    guarded = governance.write_guard(rows, "region", "Baltics")
    assert (guarded.accepted.count(), guarded.blocked.count()) == (1, 2)


def test_shared_folder_comes_from_the_session(spark):
    from lakeops.session import CHECKPOINT_CONF, scratch_path

    assert scratch_path(spark, "x").startswith(spark.conf.get(CHECKPOINT_CONF))
