"""The database reader against a stand-in: the statements it sends run on Spark views."""

import re

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skuflow.sources import jdbc as J
from skuflow.sources import snapshot as S
from skuflow.sources.fixtures import shop_from_testdata
from skuflow.sources.tables import COPIED_TABLES

TYPES = {"bigint": "bigint", "int": "int", "string": "varchar", "timestamp_ntz": "datetime", "boolean": "tinyint", "double": "double"}
PROPS = {"user": "u"}


class Databases:
    """Stands in for ``spark.read.jdbc``: url -> table -> frame."""

    def __init__(self, spark, tables, keys=()):
        self.spark, self.tables, self.keys, self.sent, self.parts = spark, tables, keys, [], {}

    def jdbc(self, reader, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None, predicates=None, properties=None):
        assert properties == PROPS and column is None
        own = self.tables[url]
        if not table.startswith("("):
            name = table.strip("`")
            parts = [own[name].where(p) for p in predicates]
            self.parts[url, name] = (own[name], parts, predicates)
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            return out
        q = re.fullmatch(r"\((.*)\) \w+", table, re.S).group(1)
        self.sent.append(q)
        if "information_schema" in q:
            name = re.search(r"table_name = '(\w+)'", q).group(1)
            fields = own[name].schema.fields if name in own else []
            rows = [(f.name, TYPES.get(f.dataType.simpleString(), "json").upper(), "PRI" if f.name in self.keys else None, k + 1) for k, f in enumerate(fields)]
            return self.spark.createDataFrame(rows[::-1], "name string, type string, col_key string, pos long")
        name = re.search(r"FROM `(\w+)`", q).group(1)
        own[name].createOrReplaceTempView("stand_in")
        return self.spark.sql(q.replace(f"`{name}`", "stand_in"))


@pytest.fixture()
def databases(spark, monkeypatch):
    def start(tables, **kw):
        db = Databases(spark, tables, **kw)
        monkeypatch.setattr(DataFrameReader, "jdbc", lambda reader, *a, **k: db.jdbc(reader, *a, **k))
        return db

    return start


@pytest.fixture(scope="module")
def shop(spark):
    """brand -> table -> frame without the brand, as each brand's database holds it."""
    src = shop_from_testdata(spark, SF_SMALL).as_dict()
    return {b: {n: t.where(F.col("brand") == b).drop("brand") for n, t in src.items()} for b in ("ABC", "GHI")}


def test_all_listed_tables_with_all_columns(spark, databases, shop):
    db = databases({f"jdbc:{b}": t for b, t in shop.items()})
    src = J.read_sources(spark, {b: (f"jdbc:{b}", f"crm_{b.lower()}") for b in shop}, PROPS, splits=4)
    assert set(src.as_dict()) == set(COPIED_TABLES) and len(COPIED_TABLES) == 17
    for n, t in src.as_dict().items():
        assert t.columns == [*shop["ABC"][n].columns, "brand"]            # ordinal order, nothing cut
        own, parts, _ = db.parts["jdbc:ABC", n]
        assert sum(p.count() for p in parts) == own.count()               # every row in exactly one split
    # two locales of one name stay two rows through the snapshot's DISTINCT
    names = S.snapshot_frame("sylius_product_translation", src.sylius_product_translation)
    assert names.count() == 2 * shop["ABC"]["sylius_product_translation"].count()
    assert names.select("brand", "translatable_id", "name").distinct().count() < names.count()


def test_a_run_from_databases(spark, databases, shop, tmp_root):
    databases({f"jdbc:{b}": t for b, t in shop.items()})
    where = {b: (f"jdbc:{b}", "crm") for b in shop}
    run_id, gate = S.snapshot_and_promote(spark, J.read_sources(spark, where, PROPS, splits=2), tmp_root, brands=list(shop))
    assert all(r.passed and r.tables_expected == 17 for r in gate.collect())
    live = S.read_live(spark, tmp_root, list(shop))
    assert live.sylius_customer.columns == ["brand", "id", "email"]       # cut to the reports' columns only here
    assert live.sylius_customer.count() == sum(t["sylius_customer"].count() for t in shop.values())


def test_missing_table_and_clash(spark, databases, shop):
    less = {n: t for n, t in shop["ABC"].items() if n != "product_cost"}
    less["sylius_customer"] = less["sylius_customer"].withColumn("brand", F.lit("x"))
    databases({"jdbc:ABC": less})
    with pytest.raises(S.TableMissing, match="product_cost"):
        J.read_table(spark, "jdbc:ABC", "crm", "product_cost", "ABC", PROPS)
    with pytest.raises(ValueError, match="brand"):
        J.read_table(spark, "jdbc:ABC", "crm", "sylius_customer", "ABC", PROPS)


def test_skewed_keys_give_even_ranges(spark, databases):
    # most ids in a corner of the key space, some far away, some missing
    ids = list(range(5000, 6000)) + [10 ** 6 + k * 1000 for k in range(40)] + [None] * 3
    t = spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string")
    db = databases({"jdbc:ABC": {"sylius_admin_user": t}})
    out = J.read_table(spark, "jdbc:ABC", "crm", "sylius_admin_user", "ABC", PROPS, splits=8)
    assert out.count() == len(ids)
    sizes = [p.count() for p in db.parts["jdbc:ABC", "sylius_admin_user"][1]]
    assert sum(sizes) == len(ids) and sizes[-1] == 3
    cuts = J.key_ranges([(k, 10) for k in range(100)], 0, 7, 4)
    assert cuts == [25 * 7, 50 * 7, 75 * 7]
    assert J.key_ranges([(0, 1000), (9, 1)], 100, 10, 4) == [190]         # one bucket holds nearly all
    assert J.key_ranges([], 0, 1, 4) == []


def test_tables_without_a_number_as_key(spark, databases):
    t = spark.createDataFrame([(f"k{i % 50}", None if i % 3 else "x") for i in range(200)], "code string, note string")
    db = databases({"jdbc:ABC": {"product_cost": t}})
    out = J.read_table(spark, "jdbc:ABC", "crm", "product_cost", "ABC", PROPS, splits=4)
    assert out.columns == ["code", "note", "brand"] and out.count() == 200
    sizes = [p.count() for p in db.parts["jdbc:ABC", "product_cost"][1]]
    assert len(sizes) == 4 and sum(sizes) == 200 and max(sizes) < 150
    assert all("CRC32" in p for p in db.parts["jdbc:ABC", "product_cost"][2])


def test_empty_table_and_choice_of_column(spark, databases):
    empty = spark.createDataFrame([], "id long, v string")
    databases({"jdbc:ABC": {"sylius_payment": empty}})
    assert J.read_table(spark, "jdbc:ABC", "crm", "sylius_payment", "ABC", PROPS).count() == 0
    c = J.SourceColumn
    assert J.split_column([c("code", "varchar", "PRI"), c("order_id", "bigint", ""), c("id", "int", "")]) == "id"
    assert J.split_column([c("id", "int", ""), c("number", "bigint", "PRI")]) == "number"
    assert J.split_column([c("code", "varchar", "PRI"), c("user_id", "int", "")]) == "user_id"
    assert J.split_column([c("code", "varchar", "PRI"), c("amount", "int", "")]) is None


def test_brands_with_different_columns(spark, databases):
    a = spark.createDataFrame([(1, "x")], "id long, note string")
    b = spark.createDataFrame([(2, 5)], "id long, extra int")
    databases({"jdbc:ABC": {"product_cost": a}, "jdbc:GHI": {"product_cost": b}})
    frames = [J.read_table(spark, f"jdbc:{x}", "crm", "product_cost", x, PROPS) for x in ("ABC", "GHI")]
    both = frames[0].unionByName(frames[1], allowMissingColumns=True)
    assert sorted(map(tuple, both.select("brand", "id", "note", "extra").collect())) == [("ABC", 1, "x", None), ("GHI", 2, None, 5)]
