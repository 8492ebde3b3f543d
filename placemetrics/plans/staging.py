"""Staging: the newest version of each landed record, renamed and typed by a declared projection, geography joined on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemetrics.functions.casts import flag, safe_cast, safe_int
from placemetrics.operators.versions import latest_by_key

UPDATED, INGESTED = "_source_updated_at", "_ingested_at"


def _column(source: str, kind: str) -> Column:
    c = F.col(source)
    made = {
        "text": lambda: c, "whole": lambda: safe_int(c), "flag_y": lambda: flag(c, "Y"), "flag_y_or_null": lambda: flag(c, "Y", nullable=True),
        "flag_true": lambda: flag(c, "true"), "absent": c.isNull, "sq_km": lambda: safe_cast(c, "float") / F.lit(1e6),
    }
    return made[kind]() if kind in made else safe_cast(c, kind)


@dataclass(frozen=True)
class Dataset:
    """One landed table: its grain key, age agreement in hours, refresh kind, where its coordinates are, and its projection."""

    name: str
    table: str
    key: str
    refresh: str
    sla_hours: float | None
    columns: str
    coordinates: tuple[str, ...] = ()
    kind: str = field(default="points")

    def projection(self) -> list[Column]:
        parsed = [line.split() for line in self.columns.split(";") if line.strip()]
        cols = [_column(p[0], p[2] if len(p) > 2 else "text").alias(p[1] if len(p) > 1 else p[0]) for p in parsed]
        return [*cols, safe_cast(F.col(UPDATED), "timestamp").alias("source_updated_at"), safe_cast(F.col(INGESTED), "timestamp").alias("ingested_at")]


# Published columns, the names they are staged under, and their types (text where none is given).
DATASETS = (
    Dataset(
        "service_requests", "311_cases", "service_request_id", "delta", 48.0,
        "service_request_id case_id; requested_datetime opened_at timestamp; closed_date closed_at timestamp; updated_datetime last_updated_at timestamp; "
        "status_description status; agency_responsible agency; service_name service_category; service_subtype service_subcategory; address; "
        "supervisor_district upstream_supervisor_district whole; analysis_neighborhood upstream_analysis_neighborhood; police_district; source request_source",
        ("lat", "long"),
    ),
    Dataset(
        "building_permits", "building_permits", "record_id", "snapshot", 48.0,
        "record_id permit_record_id; permit_number; permit_type permit_type_code; permit_type_definition permit_type; application_submission_method submission_method; "
        "status permit_status; status_date status_changed_at timestamp; permit_creation_date created_at timestamp; filed_date filed_at timestamp; "
        "approved_date approved_at timestamp; issued_date issued_at timestamp; completed_date completed_at timestamp; "
        "first_construction_document_date first_construction_doc_at timestamp; last_permit_activity_date last_activity_at timestamp; street_number; "
        "street_number_suffix; street_name; street_suffix; unit; unit_suffix; zipcode; block; lot; description permit_description; estimated_cost estimated_cost float; "
        "revised_cost revised_cost float; existing_use; proposed_use; existing_occupancy; proposed_occupancy; "
        "existing_construction_type_description existing_construction_type; proposed_construction_type_description proposed_construction_type; "
        "existing_units existing_units whole; proposed_units proposed_units whole; number_of_existing_stories existing_stories whole; "
        "number_of_proposed_stories proposed_stories whole; plansets plansets whole; adu is_adu flag_y_or_null; site_permit is_site_permit flag_y; "
        "fire_only_permit is_fire_only_permit flag_y; reroof is_reroof flag_y; structural_notification needs_structural_review flag_y; "
        "primary_address_flag is_primary_address flag_y; supervisor_district upstream_supervisor_district whole; "
        "neighborhoods_analysis_boundaries upstream_analysis_neighborhood",
        ("location",),
    ),
    Dataset(
        "business_locations", "business_locations", "uniqueid", "snapshot", 48.0,
        "uniqueid business_location_id; certificate_number; ttxid tax_id; ownership_name; dba_name business_name; lic license_code; "
        "lic_code_description business_category; lic_code_descriptions_list business_category_list; self_reported_naics_code naics_code; "
        "dba_start_date dba_started_at timestamp; dba_end_date dba_ended_at timestamp; location_start_date location_started_at timestamp; "
        "location_end_date location_ended_at timestamp; administratively_closed is_administratively_closed flag_true; location_end_date is_active absent; "
        "full_business_address business_address; city business_city; state business_state; business_zip; business_corridor; community_benefit_district; "
        "neighborhoods_analysis_boundaries upstream_analysis_neighborhood; supervisor_district upstream_supervisor_district whole; "
        "parking_tax pays_parking_tax flag_true; transient_occupancy_tax pays_transient_occupancy_tax flag_true",
        ("location",),
    ),
    Dataset(
        "film_locations", "film_locations", "_source_id", "snapshot", None,
        "_source_id film_location_id; title film_title; release_year release_year whole; production_company; distributor; director; writer; actor_1 actor_1_name; "
        "actor_2 actor_2_name; actor_3 actor_3_name; locations location_description; analysis_neighborhood upstream_analysis_neighborhood; "
        "supervisor_district upstream_supervisor_district whole; fun_facts",
        ("latitude", "longitude"),
    ),
    Dataset("neighborhoods", "analysis_neighborhoods", "nhood", "snapshot", None, "nhood analysis_neighborhood; sum_sqmi published_area_sq_mi float; sum_acres published_area_acres float; the_geom geojson", kind="polygons"),
    Dataset("districts", "supervisor_districts", "sup_dist_num", "snapshot", None, "sup_dist_num supervisor_district whole; sup_dist_name district_name; sup_name supervisor_name; polygon geojson", kind="polygons"),
    Dataset(
        "block_groups", "block_groups", "geoid", "snapshot", None,
        "geoid block_group_geoid; state state_fips; county county_fips; tract tract_code; blkgrp block_group_number; name block_group_name; pop100 population whole; "
        "hu100 housing_units whole; arealand land_area_sq_km sq_km; areawater water_area_sq_km sq_km; intptlat internal_point_latitude float; "
        "intptlon internal_point_longitude float; the_geom geojson",
        kind="polygons",
    ),
)


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d.name, d.table, d.key, d.refresh, d.sla_hours, d.kind) for d in DATASETS], "dataset string, table_name string, grain_key string, refresh string, sla_hours double, kind string")


def stage(raw: DataFrame, dataset: Dataset, geography: DataFrame | None = None) -> DataFrame:
    """Newest version of each key, projected; with ``geography`` each row gets its point's cells and places, rows staying as many."""
    newest = latest_by_key(raw, [dataset.key], [UPDATED, INGESTED])
    if geography is None:
        return newest.select(*dataset.projection())
    own = geography.filter(F.col("source_table") == dataset.table).drop("source_table")
    joined = newest.withColumn("row_key", F.col(dataset.key)).join(own, "row_key", "left")
    return joined.select(*dataset.projection(), *(F.col(c) for c in own.columns if c != "row_key"))
