"""Source tables that change: found before the write, told by the manifest."""

import json

import pytest
from pyspark.sql import types as T

from conftest import DAY1, DAY2, Shop, rows
from storelens.plans.models import LandedTables
from storelens.session import folder_exists, remove_folder
from storelens.sources import raw
from storelens.sources.drift import SchemaDrift, compare, lossless
from storelens.sources.schemas import TABLES

BRANDS = TABLES["brands"]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_what_fits(spark):
    def kind(name):
        return T._parse_datatype_string(name)

    for found, declared in (
        ("int", "bigint"), ("smallint", "smallint"), ("int", "decimal(12,2)"), ("decimal(8,2)", "decimal(10,2)"),
        ("decimal(18,0)", "bigint"), ("decimal(4,0)", "smallint"), ("date", "timestamp"), ("bigint", "string"), ("float", "double"),
    ):
        assert lossless(kind(found), kind(declared)), (found, declared)
    for found, declared in (
        ("bigint", "int"), ("double", "bigint"), ("string", "int"), ("int", "decimal(10,2)"), ("decimal(10,3)", "decimal(10,2)"),
        ("decimal(12,2)", "decimal(10,2)"), ("decimal(19,0)", "bigint"), ("decimal(5,1)", "int"), ("timestamp", "date"), ("array<int>", "string"),
    ):
        assert not lossless(kind(found), kind(declared)), (found, declared)
    assert lossless(T.NullType(), kind("date"))


def test_new_columns_are_kept_and_told(spark, root):
    first = Shop(spark).latest("brands")
    raw.write_snapshot(first, root, BRANDS, raw.Load(DAY1, "a"))
    wider = spark.sql("select 5 BRAND_ID, 'Late' brand_name, 'Japan' `home land`, null as `note`, date '2018-01-01' ingestion_date")
    raw.write_snapshot(wider, root, BRANDS, raw.Load(DAY2, "b"))
    notes = {r.run_id: r.schema_changes for r in raw.read_manifest(spark, root).collect()}
    assert notes["a"] is None
    assert json.loads(notes["b"]) == {"added": {"home land": "string", "note": "void"}, "retyped": {}}
    found = raw.scan(spark, root, BRANDS, "`home land` string, note string")
    assert sorted(rows(found, "brand_id", "home land", "ingestion_date")) == [(1, None, DAY1), (2, None, DAY1), (5, "Japan", DAY2)]
    assert LandedTables(spark, root).latest("brands").columns == ["brand_id", "brand_name", "ingestion_date", "run_id"]


def test_narrower_types_are_widened_and_told(spark, root):
    raw.write_snapshot(spark.sql("select 5S brand_id, 'x' brand_name"), root, BRANDS, raw.Load(DAY1, "a"))
    note = json.loads(raw.read_manifest(spark, root).first().schema_changes)
    assert note == {"added": {}, "retyped": {"brand_id": ["smallint", "int"]}}
    assert rows(raw.scan(spark, root, BRANDS), "brand_id") == [(5,)]


@pytest.mark.parametrize(
    ("query", "said"),
    [
        ("select 'x' brand_name", "production.brands: brand_id is gone"),
        ("select 5L brand_id, 'x' brand_name", "brand_id is bigint, int is declared"),
        ("select 1.5d brand_id, 'x' brand_name", "brand_id is double, int is declared"),
        ("select 1 brand_id, array('x') brand_name", "brand_name is array<string>, string is declared"),
    ],
)
def test_lost_and_narrowed_columns_stop_the_load(spark, root, query, said):
    with pytest.raises(SchemaDrift, match=said):
        raw.write_snapshot(spark.sql(query), root, BRANDS, raw.Load(DAY1, "a"))
    assert not folder_exists(spark, f"{root}/raw")


def test_declared_sources_do_not_drift(spark, shop):
    for table in TABLES.values():
        drift = compare(table, shop.latest(table.name).schema)
        assert drift.note() is None and not drift.lost and not drift.narrowed


def test_reconciliation(spark, root):
    brands = Shop(spark).latest("brands")
    tables = [BRANDS, TABLES["stores"]]
    for run in ("same", "gone", "short", "unrecorded"):
        raw.write_snapshot(brands, root, BRANDS, raw.Load(DAY1, run))
    raw.write_snapshot(brands.limit(0), root, BRANDS, raw.Load(DAY1, "empty"))
    remove_folder(spark, raw.snapshot_path(root, BRANDS, raw.Load(DAY1, "gone")))
    remove_folder(spark, raw.manifest_path(root, BRANDS, raw.Load(DAY1, "unrecorded")))
    brands.limit(1).write.mode("overwrite").parquet(raw.snapshot_path(root, BRANDS, raw.Load(DAY1, "short")))
    got = {r.run_id: (r.recorded, r.found, r.status) for r in raw.reconcile(spark, root, tables).collect()}
    assert got == {
        "same": (2, 2, "same"), "gone": (2, 0, "missing"), "short": (2, 1, "differs"),
        "unrecorded": (None, 2, "not recorded"), "empty": (0, 0, "same"),
    }
