"""Data contracts: the fields a record may have, their types, and which must be there."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Contract types and what a typed column of each is in Spark.
TYPES = {
    "string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "datetime": T.TimestampType(),
}

#: The version contract, name:type by group; "!" marks required, non-nullable fields.
VERSION_FIELDS = """
[identity_traceability]
version_id:string! manufacturer_id:string! model_id:string! generation_id:string! source:string! source_version_url:string!
source_version_url_canonical:string source_generation_url:string source_model_url:string source_manufacturer_url:string scrape_date:date
scrape_timestamp:datetime html_lang:string source_date_modified:date
[canonical_hierarchy]
manufacturer_name:string! manufacturer_name_upper:string model_name:string! model_name_upper:string generation_name:string!
generation_name_canonical:string generation_name_upper:string version_name:string! version_name_canonical:string version_name_upper:string
full_title:string headline:string meta_description:string
[general_classification]
body_type:string trim:string facelift_status:string doors:integer seats:integer
[production_timeline]
production_start_year:integer production_end_year:integer production_years_text:string model_year:integer is_current_generation:boolean
[commercial_summary]
power_cv:integer power_bhp:integer fuel_type:string drive_type:string drive_type_label:string
[engine_identity]
engine_name:string engine_code:string engine_family:string engine_type:string engine_layout:string cylinders:integer valves_total:integer
valves_per_cylinder:integer valvetrain:string aspiration:string fuel_system:string engine_position:string engine_orientation:string
[engine_geometry]
engine_displacement_cc:integer engine_displacement_l:number unitary_displacement_cc:number compression_ratio:number bore_mm:number stroke_mm:number
bore_stroke_text:string bore_stroke_ratio:number bore_stroke_ratio_label:string
[engine_power_torque]
max_power_cv:integer max_power_kw:number max_power_bhp:integer max_power_rpm:integer max_torque_nm:number max_torque_lbft:number
max_torque_rpm:integer specific_output_cv_l:number specific_output_kw_l:number power_per_cylinder_cv:number bmep_bar:number bmep_psi:number
[performance]
top_speed_kmh:number top_speed_mph:number acceleration_0_100_s:number acceleration_0_62_s:number power_to_weight_cv_ton:number
power_to_weight_kw_ton:number
[consumption_emissions]
fuel_consumption_urban_l_100km:number fuel_consumption_extraurban_l_100km:number fuel_consumption_combined_l_100km:number
fuel_consumption_combined_mpg_uk:number fuel_consumption_combined_mpg_us:number co2_emissions_g_km:number emission_standard:string start_stop:boolean
euro_ncap:string
[transmission_chassis]
gearbox_type:string gearbox_label:string gear_count:integer clutch_type:string front_suspension:string rear_suspension:string front_brakes:string
rear_brakes:string steering_type:string turning_circle_m:number
[wheels_tyres]
tyre_size:string front_tyre_size:string rear_tyre_size:string wheel_size:string front_wheel_size:string rear_wheel_size:string
[dimensions]
length_mm:number width_mm:number width_including_mirrors_mm:number height_mm:number wheelbase_mm:number front_track_mm:number rear_track_mm:number
ground_clearance_mm:number
[weights]
kerb_weight_kg:number gross_weight_kg:number payload_kg:number towing_capacity_braked_kg:number towing_capacity_unbraked_kg:number
[capacities]
boot_capacity_l:number boot_capacity_min_l:number boot_capacity_max_l:number fuel_tank_l:number
"""


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    nullable: bool = True
    group: str | None = None


@dataclass(frozen=True)
class Contract:
    """Fields in contract order, the operational minimum, and the fields of each group."""

    fields: dict[str, Field]
    minimum: list[str]
    groups: dict[str, list[str]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields.values() if f.required]

    @property
    def schema(self) -> T.StructType:
        """The typed zone: a Spark schema whose columns carry the contract in their metadata."""
        return T.StructType([T.StructField(f.name, TYPES[f.type], True, {"required": f.required, "nullable": f.nullable, "group": f.group or ""}) for f in self.fields.values()])

    def table(self, spark: SparkSession) -> DataFrame:
        """The contract as a small table, one row a field."""
        rows = [(k, f.name, f.type, f.required, f.nullable, f.group) for k, f in enumerate(self.fields.values())]
        return spark.createDataFrame(rows, "pos int, name string, type string, required boolean, nullable boolean, `group` string")


def parse_contract(document: dict, strict: bool = True) -> Contract:
    """A contract from its JSON document; ``strict`` refuses missing parts and unknown types."""
    fields = document.get("fields") or {}
    minimum = document.get("required_minimum_fields") or []
    if strict:
        if not fields:
            raise ValueError("the contract has no fields")
        if not minimum:
            raise ValueError("the contract has no required_minimum_fields")
        unknown = sorted({f.get("type") for f in fields.values()} - set(TYPES), key=str)
        if unknown:
            raise ValueError(f"the contract has unsupported types: {unknown}")
    made = {n: Field(n, f.get("type"), bool(f.get("required", False)), bool(f.get("nullable", True)), f.get("group")) for n, f in fields.items()}
    return Contract(made, list(minimum), {k: list(v) for k, v in (document.get("groups") or {}).items() if isinstance(v, list)})


def load_contract(path: str, strict: bool = True) -> Contract:
    """Read a contract file."""
    return parse_contract(json.loads(Path(path).read_text(encoding="utf-8")), strict)


def version_contract() -> Contract:
    """The built-in contract of catalogue versions: 124 fields in 15 groups."""
    fields, groups, group = {}, {}, None
    for word in VERSION_FIELDS.split():
        if word.startswith("["):
            group = word.strip("[]")
            continue
        name, _, kind = word.partition(":")
        must = kind.endswith("!")
        fields[name] = Field(name, kind.rstrip("!"), must, not must, group)
        groups.setdefault(group, []).append(name)
    return Contract(fields, [f.name for f in fields.values() if f.required], groups)
