"""Hand-made micro fixtures (FIXTURES.md section 3) for the rules the
generated tables cannot isolate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skuflow.brands import validate_brand
from skuflow.operators import extract as X
from skuflow.operators import retention as R
from skuflow.operators import stock_flow as SF
from skuflow.operators import sunset as SU
from skuflow.sources.tables import EXPECTED_SCHEMAS, Sources

T0 = dt.datetime(2020, 1, 1, 10, 0)
EX_SCHEMA = ("brand string, order_id bigint, created_at timestamp_ntz, updated_at timestamp_ntz, "
             "payment_state string, quantity int, unit_price bigint, units_total bigint, product_id bigint, "
             "variant_id bigint, product_name string, variant_name string, scp_promotion_warehouse_sku string, "
             "scpi_promotion_warehouse_sku string, count int, mint_soft_sku string")
OX_SCHEMA = ("brand string, id bigint, customer_id bigint, created_at timestamp_ntz, state string, "
             "is_subscription boolean, created_from_order_id bigint, email string")
IX_SCHEMA = ("brand string, order_id bigint, id bigint, product_name string, variant_name string, "
             "quantity int, product_id bigint")


@pytest.fixture(params=["colocated", "salted"])
def mode(request):
    return request.param


def _salt(ex, mode):
    """The same lines as a hot order split over 3 salts (salted mode)."""
    if mode == "colocated":
        return ex
    from skuflow.operators import salting as S
    x = ex.withColumn("n_salts", F.lit(3)).withColumn("salt", S.line_salt(F.col("n_salts")))
    return x.repartition(S.partitions(ex.sparkSession), *S.SALT_KEY)


def ex_df(spark, *lines, mode="colocated"):
    return _salt(_ex_df(spark, *lines), mode)


def _ex_df(spark, *lines):
    rows = []
    for ln in lines:
        v = ln.get("variant", 10)
        q = ln.get("qty", 1)
        rows.append(("ABC", ln.get("order", 1), T0, T0, "paid", q, 100, None if q is None else 100 * q, v, v,
                     ln.get("name", f"p{v}"), ln.get("vname", f"v{v}"), ln.get("scp"), ln.get("scpi"),
                     ln.get("count"), ln.get("mint", f"M{v}")))
    return spark.createDataFrame(rows, EX_SCHEMA)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


# ----------------------------------------------------------- stock flow
def test_m1_mint_unsplit_without_any_sku(spark, mode):
    r = one(SF.stock_lines(ex_df(spark, dict(qty=5, mint="M#2"), mode=mode)))
    assert (r.final_sku, r.quantity, r.applied_count) == ("M#2", 5, 0)


def test_m2_largest_reachable_tier(spark, mode):
    ex = ex_df(spark, dict(qty=5, scpi="A", count=2), dict(qty=5, scpi="B#9", count=4), mode=mode)
    r = one(SF.stock_lines(ex))
    assert (r.final_sku, r.applied_count, r.quantity) == ("B", 4, 9)


def test_m3_no_tier_reachable_falls_back_to_mint(spark, mode):
    ex = ex_df(spark, dict(qty=1, scpi="A", count=2, mint="M#2"), dict(qty=1, scpi="B#9", count=4, mint="M#2"), mode=mode)
    r = one(SF.stock_lines(ex))
    assert (r.final_sku, r.applied_count, r.quantity) == ("M", 0, 2)


def test_m4_m5_order_level_tier_then_adjacency_reset(spark, mode):
    ex = ex_df(spark, dict(variant=20, qty=5, mint="MX"), dict(variant=30, qty=3, scpi="A#7", count=2), mode=mode)
    lines = {r.variant_id: r for r in SF.stock_lines(ex).collect()}
    assert (lines[20].final_sku, lines[20].quantity) == ("A", 5)      # M4: tier of another line, qty kept
    assert (lines[30].final_sku, lines[30].quantity) == ("A", 7)
    rep = {(r.warehouse_sku, r.quantity) for r in SF.report_non_bundle(SF.stock_lines(ex)).collect()}
    assert rep == {("MX", 5), ("A", 7)}                                # M5: bare line after a SKU line


def test_m6_pricing_multiplier_needs_own_tier(spark, mode):
    r = one(SF.stock_lines(ex_df(spark, dict(qty=4, scp="S#3"), mode=mode)))
    assert (r.final_sku, r.quantity) == ("S", 4)


def test_m7_bundle_explode(spark, mode):
    ex = ex_df(spark, dict(qty=6, scpi="A#4|B#0|C|D#x", count=1), mode=mode)
    lines = SF.stock_lines(ex)
    parts = SF.explode_bundles(SF.flag_lines(lines)).collect()
    assert sorted((r.warehouse_sku, r.quantity) for r in parts) == [("A", 4), ("B", 6), ("C", 6), ("D", 6)]
    assert {r.bundle_sku for r in parts} == {"A#4|B#0|C|D#x"}
    h = one(SF.report_only_bundle(SF.order_summary(lines)))
    assert (h.bundle_sku, h.bundle_quantity) == ("A|B|C|D", 6)


def test_m8_pricing_bundle_when_tier_has_no_pipe(spark, mode):
    ex = ex_df(spark, dict(qty=5, scpi="P", count=1, scp="A#1|B#2"), mode=mode)
    rep = sorted((r.warehouse_sku, r.quantity) for r in SF.report_non_bundle(SF.stock_lines(ex)).collect())
    assert rep == [("A", 1), ("B", 2)]


def test_m9_header_may_be_a_non_bundle_line(spark, mode):
    ex = ex_df(spark, dict(variant=40, qty=2, scp="S1", scpi="T1", count=1),
               dict(variant=50, qty=2, scp="X#1|Y"), mode=mode)
    h = one(SF.report_only_bundle(SF.order_summary(SF.stock_lines(ex))))
    assert (h.bundle_variant_id, h.bundle_sku) == (40, None)


def test_an_order_may_hold_several_resets(spark, mode):
    # line order: tier SKU descending, then by variant; bare lines 20 and 50 follow lines with a SKU, 60 follows a bare one
    ex = ex_df(spark, dict(variant=90, qty=1, scpi="A", count=9, mint="M90"), dict(variant=20, qty=1, mint="M20#7"),
               dict(variant=30, qty=1, scp="S30"), dict(variant=50, qty=1, mint="M50"), dict(variant=60, qty=1, mint="M60"),
               dict(variant=80, qty=1, scpi="B", count=9, mint="M80"), mode=mode)
    got = {r.variant_id: r.reset for r in SF.flag_lines(SF.stock_lines(ex)).collect()}
    assert got == {80: False, 90: False, 20: True, 30: False, 50: True, 60: False}


def test_headers_of_equal_priority_go_by_line_order(spark, mode):
    # both lines hold a tier SKU only: the greater tier SKU comes first, whatever the variant
    ex = ex_df(spark, dict(variant=10, qty=2, scpi="A|X", count=9), dict(variant=70, qty=3, scpi="AB|X", count=9), mode=mode)
    h = one(SF.report_only_bundle(SF.order_summary(SF.stock_lines(ex))))
    flagged = SF.bundle_headers(SF.flag_lines(SF.stock_lines(ex)))
    assert (h.bundle_variant_id, h.bundle_sku) == (10, "A|X") == (one(flagged).bundle_variant_id, one(flagged).bundle_sku)
    ex = ex_df(spark, dict(variant=10, qty=2, scpi="A", count=9, scp="X|Y"), dict(variant=70, qty=3, scpi="AB", count=9, scp="X|Z"), mode=mode)
    h = one(SF.report_only_bundle(SF.order_summary(SF.stock_lines(ex))))
    assert (h.bundle_variant_id, h.bundle_sku) == (70, "X|Z")


def test_non_bundle_order_has_no_header(spark, mode):
    ex = ex_df(spark, dict(qty=2, scp="S1"), mode=mode)
    assert SF.report_only_bundle(SF.order_summary(SF.stock_lines(ex))).count() == 0


def test_tier_edge_cases(spark, mode):
    # tier with NULL count: not reachable, but the order does have a tier SKU;
    # empty tier SKU: reachable, gives an empty code, no quantity override;
    # NULL quantity: reaches no tier.
    ex = ex_df(spark, dict(variant=10, qty=5, scpi="T#4", count=None, mint="M#3"),
               dict(variant=20, qty=5, scpi="", count=1, mint="N"),
               dict(variant=30, qty=None, mint="Q#2", scp="S#7"), mode=mode)
    got = {r.variant_id: (r.final_sku, r.quantity, r.applied_count) for r in SF.stock_lines(ex).collect()}
    assert got[10] == ("", 5, 1)       # best reachable tier is the empty SKU of line 20 (count 1 <= 5)
    assert got[20] == ("", 5, 1)       # own tier SKU is empty: no override
    assert got[30] == ("S", None, 0)   # NULL quantity: no tier; pricing SKU; own tier SKU NULL: no override


# ------------------------------------------------------ retention / sunset
def ox_df(spark, *orders):
    rows = [("ABC", o["id"], o.get("cust", 1), o.get("at", T0 + dt.timedelta(hours=o["id"])), "fulfilled",
             o.get("sub", False), o.get("from"), o.get("email", "e1")) for o in orders]
    return spark.createDataFrame(rows, OX_SCHEMA)


def ix_df(spark, *items):
    rows = [("ABC", i["order"], i["id"], i.get("name"), i.get("vname", f"v{i['id']}"), i.get("qty", 1),
             i.get("product", 7)) for i in items]
    return spark.createDataFrame(rows, IX_SCHEMA)


def test_m10_null_names_differ_between_reports(spark):
    ox = ox_df(spark, dict(id=100), dict(id=101))
    ix = ix_df(spark, dict(order=100, id=1), dict(order=100, id=2), dict(order=101, id=3, name="q"))
    ret = one(R.retention_table(ox, ix))
    assert ret.bought_upsell_more_of_the_same is True
    sun = one(SU.sunset_table(ox, ix))
    assert sun.bought_upsell_more_of_the_same is False


def test_m11_translation_fan_out_counts(spark):
    sch = EXPECTED_SCHEMAS

    def df(name, rows):
        return spark.createDataFrame(rows, sch[name])

    src = Sources(
        sylius_order=df("sylius_order", [("ABC", 1, 1, T0, T0, "new", "paid", 10, False, None)]),
        sylius_customer=df("sylius_customer", [("ABC", 1, "e1")]),
        sylius_order_item=df("sylius_order_item", [("ABC", 11, 1, 5, "", "v", 1, 100, 100)]),
        sylius_product_variant=df("sylius_product_variant", [("ABC", 5, 6)]),
        sylius_product=df("sylius_product", [("ABC", 6, "MS-6")]),
        sylius_product_translation=df("sylius_product_translation", [("ABC", 6, "en name"), ("ABC", 6, "de name")]),
        sylius_channel_pricing=df("sylius_channel_pricing", []),
        sylius_channel_pricing_item=df("sylius_channel_pricing_item", []),
    )
    ix = X.extract_items(src)
    assert ix.count() == 2
    r = one(R.retention_table(X.extract_orders(src), ix))
    assert (r.first_order_total_item_count, r.bought_any_upsell, r.bought_upsell_more_of_the_same) == (2, True, False)
    assert r.first_product_name == "de name"


def test_m12_no_second_order_gives_no_rows(spark):
    ox = ox_df(spark, dict(id=100), dict(id=200, cust=2, email="e2"))
    ix = ix_df(spark, dict(order=100, id=1, name="a"), dict(order=200, id=2, name="b"))
    assert SU.sunset_table(ox, ix).count() == 0


def test_m13_days_floor_across_midnight(spark):
    ox = ox_df(spark, dict(id=100, at=dt.datetime(2020, 1, 1, 23, 0)), dict(id=101, at=dt.datetime(2020, 1, 2, 1, 0)))
    ix = ix_df(spark, dict(order=100, id=1, name="a"), dict(order=101, id=2, name="b"))
    assert one(SU.sunset_table(ox, ix)).days_between_first_and_second_order == 0


def test_m14_first_order_needs_items(spark):
    ox = ox_df(spark, dict(id=10), dict(id=11))
    ix = ix_df(spark, dict(order=11, id=1, name="a"))
    r = one(R.retention_table(ox, ix))
    assert (r.first_order_id, r.order_count, r.first_product_name) == (11, 2, "a")


def test_m15_null_email_is_dropped(spark):
    ox = ox_df(spark, dict(id=10, email=None), dict(id=11, email=None))
    ix = ix_df(spark, dict(order=10, id=1, name="a"), dict(order=11, id=2, name="b"))
    assert R.retention_table(ox, ix).count() == 0
    assert SU.sunset_table(ox, ix).count() == 0


def test_m16_first_non_null_per_column(spark):
    ox = ox_df(spark, dict(id=100), dict(id=101))
    ix = ix_df(spark, dict(order=100, id=1, name=None, vname="v1", qty=3),
               dict(order=100, id=2, name="p", vname="v2", qty=4), dict(order=101, id=3, name="z"))
    r = one(SU.sunset_table(ox, ix))
    assert (r.first_product_name, r.first_product_variant, r.first_product_quantity) == ("p", "v1", 3)
    assert r.second_order_first_product_name == "z"


def test_retention_second_item_fallback(spark):
    ox = ox_df(spark, dict(id=100), dict(id=101))
    ix = ix_df(spark, dict(order=100, id=1, name="a"), dict(order=101, id=2, name="b"))
    r = one(R.retention_table(ox, ix))
    assert (r.second_item_product_name, r.bought_any_upsell) == ("b", False)
    ix2 = ix_df(spark, dict(order=100, id=1, name="a"), dict(order=100, id=5, name="c"),
                dict(order=101, id=2, name="b"))
    assert one(R.retention_table(ox, ix2)).second_item_product_name == "c"


def test_sunset_second_order_is_per_customer(spark):
    # Two customers share an email; the first order belongs to customer 1,
    # whose own second order is the one reported.
    ox = ox_df(spark, dict(id=1, cust=1), dict(id=2, cust=2), dict(id=3, cust=1), dict(id=4, cust=2))
    ix = ix_df(spark, *[dict(order=o, id=o * 10, name="x") for o in (1, 2, 3, 4)])
    r = one(SU.sunset_table(ox, ix))
    assert (r.customer_id, r.first_order_id, r.second_order_id, r.order_count) == (1, 1, 3, 4)


def test_m18_unknown_brand(spark):
    with pytest.raises(ValueError):
        validate_brand("XYZ")


def test_a1_min_id_and_min_date_are_independent(spark):
    # Email shared by customers 1 and 2; order 5 (customer 2) has the smaller
    # id, order 9 (customer 1) the earlier date.
    early, late = dt.datetime(2020, 1, 1), dt.datetime(2020, 3, 1)
    ox = ox_df(spark, dict(id=9, cust=1, at=early), dict(id=5, cust=2, at=late, sub=True))
    ix = ix_df(spark, dict(order=9, id=1, name="a"), dict(order=5, id=2, name="b"))
    r = one(R.retention_table(ox, ix))
    assert (r.first_order_id, r.first_order_date, r.customer_id) == (5, early, 2)
    assert (r.first_order_subscription, r.first_product_name, r.order_count) == (True, "b", 2)
    # second order by (created_at, id) is order 5 -- the first order itself
    assert r.second_item_product_name == "b"
