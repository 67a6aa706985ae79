from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import stored_seed
from tillstream.functions import pii
from tillstream.functions.ids import assign_business_id, assign_sequence, business_id
from tillstream.operators import entity_ops, mutate, quality
from tillstream.specs import SPECS, spec

NOW = datetime(2026, 1, 1)


def test_patch_modes(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, p string, q string")
    patch = spark.createDataFrame([(1, None, "z"), (7, "n", "n")], "id int, p string, q string")
    keep = mutate.apply_patch(t, patch, "id", ["p", "q"])
    clear = mutate.apply_patch(t, patch, "id", ["p", "q"], "overwrite")
    assert sorted(map(tuple, keep.df.collect())) == [(1, "a", "z"), (2, "b", "y")]
    assert sorted(map(tuple, clear.df.collect())) == [(1, None, "z"), (2, "b", "y")]
    assert [(r.id, r.reason) for r in keep.rejected.collect()] == [(7, "not found")]


def test_a_large_batch_is_gathered_by_key(spark, monkeypatch):
    """Tasks of a large batch do not grow with it: no partition is put together, no table key is aggregated."""
    monkeypatch.setattr(mutate, "is_small", lambda df: False, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.range(500).selectExpr("id", "'a' as p")
        patch = spark.range(400, 600).selectExpr("id", "'b' as p").unionByName(spark.range(450, 460).selectExpr("id", "'c' as p"))
        nulls = spark.range(2).selectExpr("cast(null as long) as id", "'d' as p")
        done = mutate.apply_patch(t, patch.unionByName(nulls), "id", ["p"])
        text = done.rejected._jdf.queryExecution().executedPlan().toString()
        assert "ENSURE_REQUIREMENTS" not in text and text.count("REPARTITION_BY_NUM") == 2
        assert "HashAggregate" not in text
        got = {(r.id, r.reason) for r in done.rejected.collect()}
        assert done.rejected.count() == 100 + 20 + 2
        assert got == ({(n, "not found") for n in [None, *range(500, 600)]}
                       | {(n, "requested more than once") for n in range(450, 460)})
        assert {r.id for r in done.df.filter("p = 'b'").collect()} == set(range(400, 500)) - set(range(450, 460))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_soft_delete_guard(spark):
    t = stored_seed(spark)
    products = t["products"].withColumn(
        "deleted_at", F.when(F.col("product_id") == "PROD_00002", F.lit(datetime(2025, 12, 1))))
    skus = t["products_sku"].filter("product_id <> 'PROD_00001'")
    keys = spark.createDataFrame([(f"PROD_0000{i}",) for i in (1, 2, 3, 9)], "product_id string")
    done = mutate.soft_delete(products, keys, "product_id", NOW, guard=(skus, "product_id"))
    deleted = {r.product_id: r.deleted_at for r in done.df.collect()}
    assert deleted["PROD_00001"] == NOW and deleted["PROD_00003"] is None
    assert {r.product_id: r.reason for r in done.rejected.collect()} == {
        "PROD_00002": "not found or already deleted", "PROD_00003": "has active children",
        "PROD_00009": "not found or already deleted"}


def test_stock_by_sku(spark):
    inv = stored_seed(spark)["inventory"]
    req = spark.createDataFrame([(6, 5), (7, -1), (99, 1)], "sku_id long, stock_quantity int")
    done = mutate.set_stock_by_sku(inv, req, NOW)
    rows = done.df.collect()
    assert {r.stock_quantity for r in rows if r.sku_id == 6} == {5}
    assert {r.stock_quantity for r in rows if r.sku_id == 7} == {200, 198}
    assert {(r.sku_id, r.reason) for r in done.rejected.collect()} == {
        (7, "stock cannot be negative"), (99, "not found")}


def test_customer_insert(spark):
    customers = stored_seed(spark)["customers"]
    req = spark.createDataFrame([
        (1, "A", "a@x.vn", "0123456789", "here"), (2, "B", "not-mail", "0123456789", "there"),
        (3, "C", "c@x.vn", "+84901111111", "there"), (4, "D", "D.D@X.COM", "12345678", "far"),
    ], "n int, name string, email string, phone string, address string")
    rules = [quality.matches("email", "(?i)" + quality.EMAIL_PATTERN),
             quality.matches("phone", quality.PHONE_PATTERN)]
    done = mutate.validated_insert(customers, req, rules,
                                   mutate.KeyRule("customer_id", ["n"], 6, "CUST_", 6),
                                   defaults={"created_at": NOW, "updated_at": NOW})
    assert sorted((r.customer_id, r.name) for r in done.inserted.collect()) == [
        ("CUST_000006", "A"), ("CUST_000007", "D")]
    assert {(r.n, r.reason) for r in done.rejected.collect()} == {
        (2, "chk_email_format"), (3, "chk_phone_format")}
    assert done.df.count() == 7


def test_sequences_have_no_gaps(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id"))
    got = [r.n for r in assign_sequence(df, "n", ["k", "id"], 10).orderBy("k", "id").collect()]
    assert got == list(range(10, 5010))
    assert assign_sequence(df.filter("id < 0"), "n", ["id"]).count() == 0


def test_business_ids(spark):
    df = spark.createDataFrame([("b",), ("a",)], "x string")
    got = {r.x: r.i for r in assign_business_id(df, "i", "EMP_", 4, ["x"], 9999).collect()}
    assert got == {"a": "EMP_9999", "b": "EMP_10000"}
    assert spark.range(1).select(business_id("P", 3, F.lit(7))).first()[0] == "P007"


def test_rules(spark):
    df = spark.createDataFrame([(1, "", -1), (2, None, 0), (None, " ", 5)], "id int, s string, n int")
    rules = [*quality.not_null("id"), *quality.non_empty("s"), *quality.not_blank("s"),
             *quality.positive("n"), *quality.non_negative("n"), quality.one_of("n", [0, 5])]
    flagged = {r.n: r.violations for r in quality.apply_rules(df, rules).flagged.collect()}
    assert flagged == {
        -1: ["chk_s_length", "chk_s_not_blank", "chk_n_positive", "chk_n_non_negative",
             "chk_n_allowed"],
        0: ["chk_s_not_blank", "chk_n_positive"], 5: ["id_not_null", "chk_s_not_blank"]}
    counts = {r.rule: r.violations for r in quality.rule_counts(df, rules).collect()}
    assert counts["chk_s_not_blank"] == 3 and counts["chk_n_allowed"] == 1
    assert quality.apply_rules(df, []).valid.count() == 3


def test_time_rules_allow_equality(spark):
    df = spark.createDataFrame([(NOW, NOW)], "a timestamp, b timestamp")
    checked = quality.apply_rules(df, [*quality.not_future(NOW, "a"), quality.after("a", "b")])
    assert checked.flagged.first().violations == ["chk_a_after_b"]


def test_sample_rows_obey_the_table_rules(spark):
    for name, df in stored_seed(spark).items():
        rules = quality.table_rules(spec(name), NOW, df.columns)
        assert quality.apply_rules(df, rules).rejected.count() == 0, name
    assert len(SPECS) == 21


def test_relaxed_rule_is_gone():
    names = {r.name for r in quality.table_rules(spec("audit_log_pos"), NOW)}
    assert "chk_object_name_length" not in names and "chk_query_length" in names


def test_encryption(spark):
    df = spark.createDataFrame([(1, "a@x"), (2, "a@x"), (3, None)], "id int, email string")
    locked = pii.encrypt(df, ["email"], "k1").cache()
    texts = [bytes(r.email) for r in locked.collect() if r.email]
    assert len(set(texts)) == 2
    assert {r.id: r.email for r in pii.decrypt(locked, ["email"], "k1").collect()} == {
        1: "a@x", 2: "a@x", 3: None}
    assert {r.email for r in pii.decrypt(locked, ["email"], "wrong").collect()} == {None}


def test_key_rotation_reports_and_keeps_bad_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, email string")
    good = pii.encrypt(df.filter("id = 1"), ["email"], "k1")
    bad = pii.encrypt(df.filter("id = 2"), ["email"], "other")
    rows = spark.createDataFrame(good.unionByName(bad).collect(), "id int, email binary")
    rotated, failed = pii.rotate_key(rows, ["email"], "k1", "k2")
    assert [r.id for r in failed.collect()] == [2]
    assert {r.id: r.email for r in pii.decrypt(rotated, ["email"], "k2").collect()} == {
        1: "a", 2: None}
    was = {r.id: bytes(r.email) for r in rows.collect()}
    assert bytes(rotated.filter("id = 2").first().email) == was[2]


def test_masks(spark):
    df = spark.createDataFrame([("ann@x.vn", "0123456789")], "email string, phone string")
    policy = {"email": pii.Mask("email"), "phone": pii.Mask("last4", frozenset({"support"}))}
    assert tuple(pii.mask(df, policy, "analyst").first()) == ("a***@x.vn", "******6789")
    assert pii.mask(df, policy, "support").first().phone == "0123456789"


def _request(spark, entity, **override):
    """The first sample row as an insert request, with some values changed."""
    s = spec(entity)
    df = stored_seed(spark)[entity].limit(1).drop(s.key[0]).withColumn("n", F.lit(1))
    for c, v in override.items():
        df = df.withColumn(c, F.lit(v))
    for c in ("email", "phone"):
        if c in df.columns and c not in override:
            df = df.withColumn(c, F.lit({"email": "a@b.vn", "phone": "0123456789"}[c]))
    return df


BAD = {
    "payment_types": {"name": " "}, "accounts": {"account_type": ""}, "departments": {"name": ""},
    "employees": {"salary": 0}, "suppliers": {"contact_name": " "},
    "purchase_orders": {"status": "lost"}, "purchase_order_items": {"quantity": 0},
    "financial_transactions": {"type": "gift"}, "warehouses": {"location": ""},
    "inventory": {"stock_quantity": -1}, "shipments": {"shipment_date": datetime(2030, 1, 1)},
    "delivery_tracking": {"status": "pending"}, "customers": {"email": "nobody"},
    "categories": {"name": "bOOks"}, "products_sku": {"product_id": "PROD_00099"},
}


def test_every_insert_checks_its_requests(spark):
    tables = stored_seed(spark)
    assert set(BAD) == set(entity_ops.INSERTS)
    for name, bad in BAD.items():
        fine = {"categories": {"name": "Toys"}, "products_sku": {"sku": "NEW"}}.get(name, {})
        good = _request(spark, name, **fine)
        both = good.unionByName(_request(spark, name, **{**fine, **bad}).withColumn("n", F.lit(2)))
        both = both.select(*[F.col(f.name).cast(good.schema[f.name].dataType).alias(f.name)
                             for f in both.schema.fields])
        done = entity_ops.insert_rows(name, tables, both, ["n"], 50, NOW, secret="k")
        assert [r.n for r in done.rejected.collect()] == [2], name
        assert done.inserted.count() == 1, name


def test_insert_encrypts_once(spark):
    tables = stored_seed(spark)
    done = entity_ops.insert_rows("customers", tables, _request(spark, "customers"), ["n"], 50,
                                  NOW, secret="k")
    assert pii.decrypt(done.inserted, ["email"], "k").first().email == "a@b.vn"
    assert done.df.count() == 6


def test_every_patch_and_soft_delete_runs(spark):
    tables = stored_seed(spark)
    for name, how in entity_ops.PATCHES.items():
        one = tables[name].limit(1)
        done = entity_ops.patch_rows(name, tables, one.select(*how.key, *how.columns), NOW, secret="k")
        assert done.df.filter(F.col(how.stamp) == F.lit(NOW)).count() == 1, name
        assert done.rejected.count() == 0, name
    for name in entity_ops.SOFT_DELETES:
        key = spec(name).key[0]
        done = entity_ops.soft_delete_rows(name, tables, tables[name].select(key), NOW)
        left = done.df.filter("deleted_at is null").count()
        assert left == (5 if name == "products" else 0), name


def test_patch_refusals(spark):
    tables = stored_seed(spark)
    req = spark.createDataFrame([(1, " "), (2, "bOOKS"), (4, "BOOKS"), (5, None)],
                                "category_id long, name string")
    done = entity_ops.patch_rows("categories", tables, req, NOW)
    assert {r.category_id: r.reason for r in done.rejected.collect()} == {
        1: "chk_name_not_blank", 2: "name already exists"}
    names = {r.category_id: r.name for r in done.df.collect()}
    assert names[4] == "BOOKS" and names[5] == "Outdoors" and names[2] == "Coats"
    lost = spark.createDataFrame([("PROD_00001", None, 77), ("PROD_00002", "Shirt", None)],
                                 "product_id string, name string, category_id long")
    done = entity_ops.patch_rows("products", tables, lost, NOW)
    assert [r.reason for r in done.rejected.collect()] == ["category_id not found"]
    assert done.df.filter("name = 'Shirt' and category_id = 2").count() == 1
