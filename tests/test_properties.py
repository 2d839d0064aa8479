"""Property test: the SKU Column functions agree with a plain-Python model of
the mini-language on random strings (one Spark job per generated batch)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skuflow.functions.sku import clean_bundle_sku, has_pipe, sku_code, sku_qty, split_bundle

# Characters of the mini-language plus digits and a sign; digit runs stay
# short so every integer fits in INT on both sides.
ALPHABET = "AB#|05-x"
sku_text = st.text(alphabet=ALPHABET, max_size=9)


def model_code(s):
    return s.split("#")[0]


def model_qty(s):
    parts = s.split("#")
    if len(parts) < 2:
        return None
    try:
        return int(parts[1])
    except ValueError:
        return None


def model_clean(s):
    return "|".join(p.split("#")[0] for p in s.split("|"))


@settings(max_examples=15, deadline=None)
@given(st.lists(sku_text, min_size=1, max_size=40))
def test_sku_functions_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select("s", sku_code("s").alias("code"), sku_qty("s").alias("qty"),
                    clean_bundle_sku("s").alias("clean"), split_bundle("s").alias("parts"),
                    has_pipe("s").alias("pipe")).collect()
    for r in got:
        s = r["s"]
        assert r["code"] == model_code(s), s
        assert r["qty"] == model_qty(s), s
        assert r["clean"] == model_clean(s), s
        assert r["parts"] == s.split("|"), s
        assert r["pipe"] == ("|" in s), s


def test_nulls_stay_null(spark):
    r = spark.createDataFrame([(None,)], "s string").select(
        sku_code("s").alias("c"), sku_qty("s").alias("q"), clean_bundle_sku("s").alias("k"),
        F.coalesce(has_pipe("s"), F.lit(None)).alias("p")).first()
    assert (r["c"], r["q"], r["k"], r["p"]) == (None, None, None, False)


# ---------------------------------------------------------------- tier pick
line = st.tuples(st.integers(1, 3),                                   # order
                 st.one_of(st.none(), st.integers(0, 12)),            # quantity
                 st.one_of(st.none(), st.integers(0, 12)),            # tier count
                 st.one_of(st.none(), st.sampled_from(["", "A", "B#2", "C|D", "A#9"])))  # tier SKU


def _brute(rows):
    picks = {}
    for i, (o, q, _, _) in enumerate(rows):
        tiers = [(c, s) for (o2, _, c, s) in rows if o2 == o and s is not None and c is not None]
        ok = [t for t in tiers if q is not None and t[0] <= q]
        picks[i] = max(ok) if ok else None
    anys = {o: any(s is not None for (o2, _, _, s) in rows if o2 == o) for (o, _, _, _) in rows}
    return picks, anys


@settings(max_examples=12, deadline=None)
@given(st.lists(line, min_size=1, max_size=25), st.sampled_from(["colocated", "salted"]))
def test_tier_pick_matches_brute_force(spark, rows, mode):
    from skuflow.operators import salting as S
    from skuflow.operators import stock_flow as SF

    data = [("ABC", o, q, c, s, i) for i, (o, q, c, s) in enumerate(rows)]
    ex = spark.createDataFrame(data, "brand string, order_id bigint, quantity int, count int, "
                                     "scpi_promotion_warehouse_sku string, variant_id bigint")
    if mode == "salted":
        ex = (ex.withColumn("unit_price", F.lit(1).cast("bigint")).withColumn("units_total", F.lit(1).cast("bigint"))
              .withColumn("product_name", F.lit("p")).withColumn("variant_name", F.lit("v"))
              .withColumn("n_salts", F.lit(3)))
        ex = ex.withColumn("salt", S.line_salt(F.col("n_salts"))).repartition(S.partitions(spark), *S.SALT_KEY)
    got = {r["variant_id"]: ((r["pick"]["count"], r["pick"]["sku"]) if r["pick"] else None, r["any_tier_sku"])
           for r in SF.tier_picks(ex).collect()}
    picks, anys = _brute(rows)
    for i, (o, _, _, _) in enumerate(rows):
        assert got[i] == (picks[i], anys[o]), (i, rows)


# ------------------------------------------------- adjacency reset / header
sku = st.one_of(st.none(), st.sampled_from(["", "A", "B#2", "C|D", "Z"]))
stock_line = st.tuples(st.integers(1, 3), sku, sku,                       # order, tier SKU, pricing SKU
                       st.one_of(st.none(), st.sampled_from(["n1", "n2"])))  # product name


def _line_key(scpi, scp, variant_id, name):
    # tier SKU descending (a prefix comes after the longer text), nulls last
    return (scpi is None, [-ord(c) for c in scpi or ""] + [1], variant_id, name is None, name or "")


def _priority(scpi, scp):
    return 0 if (scp is not None and scpi is not None) else 1 if scpi is not None else 2 if scp is not None else 3


@settings(max_examples=12, deadline=None)
@given(st.lists(stock_line, min_size=1, max_size=25), st.sampled_from(["colocated", "salted"]))
def test_reset_and_header_match_brute_force(spark, rows, mode):
    import datetime as dt

    from skuflow.operators import salting as S
    from skuflow.operators import stock_flow as SF

    t0 = dt.datetime(2020, 1, 1)
    data = [("ABC", o, t0, 1, 1, 1, scp, scpi, "F", 7, i, name, "v", "M") for i, (o, scpi, scp, name) in enumerate(rows)]
    lines = spark.createDataFrame(data, "brand string, order_id bigint, created_at timestamp_ntz, "
                                        "original_quantity int, unit_price bigint, units_total bigint, "
                                        "scp_promotion_warehouse_sku string, scpi_promotion_warehouse_sku string, "
                                        "final_sku string, product_id bigint, variant_id bigint, product_name string, "
                                        "variant_name string, mint_soft_sku string")
    if mode == "salted":
        lines = lines.withColumn("n_salts", F.lit(3)).withColumn("salt", S.line_salt(F.col("n_salts"))) \
            .repartition(S.partitions(spark), *S.SALT_KEY)
    got = {r["variant_id"]: (r["reset"], r["is_bundle"], r["header"]["bundle_variant_id"])
           for r in SF.flag_lines(lines).collect()}
    for o in {r[0] for r in rows}:
        members = sorted((_line_key(scpi, scp, i, name), i, scpi, scp)
                         for i, (o2, scpi, scp, name) in enumerate(rows) if o2 == o)
        bundle = any("|" in (x or "") for (_, _, scpi, scp) in members for x in (scpi, scp))
        header = min((_priority(scpi, scp), k, i) for (k, i, scpi, scp) in members)[2]
        for pos, (_, i, scpi, scp) in enumerate(members):
            prev = members[pos - 1] if pos else None
            reset = scpi is None and scp is None and prev is not None and (prev[2] is not None or prev[3] is not None)
            assert got[i] == (reset, bundle, header), (o, i, rows)
