"""Staged datasets: every declared column, newest version, types, flags, geography."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from placemetrics.plans.staging import DATASETS, registry, stage


def raw(spark, dataset, *rows):
    names = sorted({line.split()[0] for line in dataset.columns.split(";") if line.strip()} | {dataset.key, "_source_updated_at", "_ingested_at"})
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))


@pytest.mark.parametrize("dataset", DATASETS, ids=lambda d: d.name)
def test_newest_version_of_every_dataset(spark, dataset):
    old, new = {dataset.key: "1", "_source_updated_at": "2024-01-01T00:00:00.000Z"}, {dataset.key: "1", "_source_updated_at": "2024-02-01T01:00:00.000+01:00"}
    got = stage(raw(spark, dataset, new, old, {dataset.key: "2"}), dataset)
    assert got.count() == 2 and len(set(got.columns)) == len(got.columns)
    assert str(got.agg(F.max("source_updated_at")).first()[0]) == "2024-02-01 00:00:00"
    assert registry(spark).filter(F.col("dataset") == dataset.name).count() == 1


def test_types_flags_and_geography(spark):
    permits = next(d for d in DATASETS if d.name == "building_permits")
    rows = raw(spark, permits, {"record_id": "a", "estimated_cost": "unknown", "existing_units": "2.5", "adu": "Y", "reroof": None, "supervisor_district": "9.00000"}, {"record_id": "b", "filed_date": "2024-01-05"})
    places = spark.createDataFrame([("building_permits", "a", 7, "n1"), ("other", "b", 8, "n2")], "source_table string, row_key string, h3_r8 long, nation string")
    got = {r.permit_record_id: r for r in stage(rows, permits, places).collect()}
    a, b = got["a"], got["b"]
    assert (a.estimated_cost, a.existing_units, a.is_adu, a.is_reroof, a.upstream_supervisor_district, a.h3_r8, a.nation) == (None, 2, True, False, 9, 7, "n1")
    assert (b.is_adu, str(b.filed_at), b.h3_r8) == (None, "2024-01-05 00:00:00", None)
    business = next(d for d in DATASETS if d.name == "business_locations")
    one = stage(raw(spark, business, {"uniqueid": "x", "parking_tax": "true"}), business).first()
    assert one.is_active and one.pays_parking_tax and not one.is_administratively_closed
