"""Vendor configuration documents.

A vendor's config is one JSON document: field mapping, status map, carrier map
and flags. ``compile_configs`` turns a table of them (one row per vendor) into
columns the record operators read, so that all vendors run in one job.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import built_once, flag, let
from ..schemas import ITEM_FIELDS, SCALAR_TARGETS

# The keys a config document may carry.
CONFIG_SCHEMA = """
  mapping struct<fulfillment_table: array<struct<source_field: string, destination_field: string>>>,
  order_status_mapping map<string, string>,
  carrier_mapping struct<
    ups: map<string, int>, nonups: map<string, int>,
    check_character_for_mapping: string, check_string_for_mapping: string,
    carriermethod_for_mapping: string, change_carriermethod_to_lowercase: string>,
  multi_field string,
  check_response_body string,
  make_items_inside_items struct<field_to_nest: string>,
  position_for_checking_idx_for_nesting int,
  position_for_checking_idx_deliveries int,
  check_multi_invoice_and_split string,
  check_for_tracking_number_and_set_invoice_accordingly string,
  fields_to_split_for_multi_invoice array<string>,
  is_shipquantity_repeated string,
  is_shipcost_and_extraitemprice_same string,
  use_items_from_first_api_call string,
  iterate_over_invoice_for_second_api_call string,
  order_status_in_different_field_and_deliveries_field_factor string,
  data struct<payload_value_to_upper: array<string>, xml_payload: string, xml_payload_second: string,
              `x-www-form-urlencoded`: string>,
  api_request_template struct<url: struct<raw: string, method: string>, header: array<struct<key: string, value: string>>>,
  multi_api_call struct<url: struct<raw: string, method: string>, header: array<struct<key: string, value: string>>>,
  error_mapping struct<error_status: string, error_message: string>,
  fault_error_mapping struct<fault_error_status: string, fault_error_message: string>
"""

# Switch columns and the config keys they come from.
SWITCHES = {
    "split_invoices": "check_multi_invoice_and_split",
    "shipquantity_repeated": "is_shipquantity_repeated",
    "same_costs": "is_shipcost_and_extraitemprice_same",
    "items_from_first_call": "use_items_from_first_api_call",
    "call_per_invoice": "iterate_over_invoice_for_second_api_call",
    "status_in_invoice_field": "order_status_in_different_field_and_deliveries_field_factor",
}

# Qualifier fields, ``<key>['<sign>']``, and the sibling that carries the value.
QUALIFIED = r"^(.+)\['(IN|ON)'\]$"
QUALIFIED_SIBLING = "RefID"


def config_frame(spark: SparkSession, configs: dict[int, dict]) -> DataFrame:
    """Driver-side config dicts as a table ``(vendor_id, config)``."""
    rows = [(vendor, json.dumps(doc)) for vendor, doc in configs.items()]
    return spark.createDataFrame(rows, "vendor_id bigint, config string")


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """Config files named ``<vendor_id>.json`` as a table ``(vendor_id, config)``."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("f"))
    return files.select(F.regexp_extract("f", r"^(\d+)\.json$", 1).cast("bigint").alias("vendor_id"), F.col("value").alias("config"))


def parse_configs(df: DataFrame) -> DataFrame:
    """``(vendor_id, config)`` with the JSON text parsed to ``c``."""
    return df.select("vendor_id", F.from_json("config", CONFIG_SCHEMA).alias("c"))


def _mapping_entry(raw: Column, ord_: Column, c: Column) -> Column:
    path, target = raw["destination_field"], raw["source_field"]
    segments, goal = F.split(path, r"\."), F.split(target, r"\.")
    wild, dotted = path.contains("[i]"), F.size(goal) > 1
    qualified = path.rlike(QUALIFIED)
    many = F.size(segments) > 1
    last = F.element_at(segments, -1)
    kind = (
        F.when(qualified, "qualifier")
        .when(wild & many & dotted, "wild")
        .when(wild & dotted, "prefix")
        .when(wild & last.contains("[i]"), "join_prefix")
        .when(wild & (target == "ship_date"), "join_truthy")
        .when(wild, "join")
        .when(dotted, "suffix")
        .otherwise("exact")
    )
    grp = F.when(dotted, goal[0]).otherwise("")
    positioned = kind.isin("wild", "suffix")
    idx_seg = F.when((grp == "items") & positioned, c["position_for_checking_idx_for_nesting"]).when(
        (grp == "deliveries") & (kind == "wild"), c["position_for_checking_idx_deliveries"]
    )
    nested = (kind == "wild") & F.coalesce(c["make_items_inside_items"]["field_to_nest"] == grp, F.lit(False))
    first = F.split(F.split(path, r"\[i\]")[0], r"\.")[0]
    return F.struct(
        ord_.alias("ord"),
        path.alias("path"),
        target.alias("target"),
        grp.alias("grp"),
        F.element_at(goal, -1).alias("field"),
        kind.alias("kind"),
        F.when(qualified, F.regexp_extract(path, QUALIFIED, 1)).otherwise(first).alias("first"),
        last.alias("last"),
        F.concat(first, F.lit("|"), last).alias("ends"),
        F.when(qualified, F.regexp_extract(path, QUALIFIED, 2)).alias("sign"),
        # A nested group takes its outer position from the first number in the path.
        F.when(~nested | (grp == "deliveries"), idx_seg).alias("idx_seg"),
        c["position_for_checking_idx_for_nesting"].alias("inner_seg"),
        nested.alias("nested"),
    )


def _mapping(c: Column) -> Column:
    """Compiled mapping entries: the last target given for a path is the one that counts."""
    listed = F.filter(c["mapping"]["fulfillment_table"], lambda e: F.coalesce(e["destination_field"], F.lit("")) != "")
    numbered = F.transform(listed, lambda e, i: F.struct(e.alias("e"), i.alias("i")))
    latest = let(
        numbered,
        lambda all_: F.filter(
            all_,
            lambda x: ~F.exists(
                all_, lambda y: (y["e"]["destination_field"] == x["e"]["destination_field"]) & (y["i"] > x["i"])
            ),
        ),
    )
    return F.transform(latest, lambda x: _mapping_entry(x["e"], x["i"], c))


def status_lists(c: Column) -> Column:
    """``[{canonical, raw}]`` in config order; a plain string is a list of one."""
    as_list = F.transform(
        F.map_entries(c["order_status_mapping"]),
        lambda e: F.struct(
            e["key"].alias("canonical"),
            F.when(e["value"].startswith("["), F.from_json(e["value"], "array<string>"))
            .otherwise(F.array(e["value"]))
            .alias("raws"),
        ),
    )
    return F.flatten(
        F.transform(
            as_list,
            lambda e: F.transform(e["raws"], lambda r: F.struct(r.alias("raw"), e["canonical"].alias("canonical"))),
        )
    )


def _status_map(c: Column) -> Column:
    """``raw -> canonical``; the first canonical wins where lists overlap."""
    return let(
        status_lists(c),
        lambda pairs: F.map_from_entries(
            F.filter(
                pairs, lambda p, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda q: q["raw"] == p["raw"])
            )
        ),
    )


def _carrier(c: Column) -> Column:
    m = c["carrier_mapping"]
    empty = F.create_map().cast("map<string,int>")
    return F.when(
        m.isNotNull(),
        F.struct(
            F.create_map(
                F.lit("ups"), F.coalesce(m["ups"], empty), F.lit("nonups"), F.coalesce(m["nonups"], empty)
            ).alias("services"),
            m["check_character_for_mapping"].alias("check_character_for_mapping"),
            m["check_string_for_mapping"].alias("check_string_for_mapping"),
            m["carriermethod_for_mapping"].alias("carriermethod_for_mapping"),
            m["change_carriermethod_to_lowercase"].alias("change_carriermethod_to_lowercase"),
        ),
    )


@built_once
def _mapping_column() -> Column:
    """``entries`` in config order, the same as JSON ``text``, and whether one of them is ``nested``."""

    def described(entries: Column) -> Column:
        nested = F.exists(entries, lambda m: m["nested"])
        return F.struct(entries.alias("entries"), F.to_json(entries).alias("text"), nested.alias("nested"))

    return let(_mapping(F.col("c")), described)


@built_once
def _cfg_column() -> Column:
    c = F.col("c")
    no_text = F.array().cast("array<string>")
    return F.struct(
        _status_map(c).alias("status_map"),
        _carrier(c).alias("carrier"),
        F.coalesce(c["fields_to_split_for_multi_invoice"], no_text).alias("split_fields"),
        c["check_for_tracking_number_and_set_invoice_accordingly"].isNotNull().alias("split_by_column"),
        F.coalesce(c["data"]["payload_value_to_upper"], no_text).alias("upper_keys"),
        flag(c["multi_api_call"]["url"]["raw"]).alias("second_call"),
        F.nullif(c["multi_field"], F.lit("")).alias("multi_field"),
        F.nullif(c["check_response_body"], F.lit("")).alias("required_path"),
        F.nullif(c["error_mapping"]["error_status"], F.lit("")).alias("error_status"),
        F.nullif(c["error_mapping"]["error_message"], F.lit("")).alias("error_message"),
        F.nullif(c["fault_error_mapping"]["fault_error_status"], F.lit("")).alias("fault_status"),
        F.nullif(c["fault_error_mapping"]["fault_error_message"], F.lit("")).alias("fault_message"),
        *[flag(c[key]).alias(name) for name, key in SWITCHES.items()],
    )


def compile_configs(df: DataFrame) -> DataFrame:
    """``(vendor_id, config)`` to ``(vendor_id, mapping, cfg)``, one row per vendor.

    A table of configs is often one small file, and compiling is work: it is dealt out to all cores.
    """
    spread = df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return parse_configs(spread).select("vendor_id", _mapping_column().alias("mapping"), _cfg_column().alias("cfg"))


def vendor_mapping_rows(df: DataFrame) -> DataFrame:
    """One row per mapped field of each vendor."""
    entries = compile_configs(df).select("vendor_id", F.explode("mapping.entries").alias("m"))
    return entries.select(
        "vendor_id",
        F.col("m.path").alias("doc_path"),
        F.col("m.first").alias("first_segment"),
        F.col("m.last").alias("last_segment"),
        F.col("m.path").contains("[i]").alias("is_wildcard"),
        F.col("m.grp").alias("target_group"),
        F.col("m.field").alias("target_field"),
        F.col("m.kind").alias("kind"),
    )


def vendor_unknown_targets(df: DataFrame) -> DataFrame:
    """Mapped fields that no table has, which would be lost. Deliveries are stored as JSON and take any field."""
    known = [F.lit(f) for f in SCALAR_TARGETS]
    item_fields = [F.lit(f) for f in (*ITEM_FIELDS, "item_details")]
    rows = vendor_mapping_rows(df)
    stored = (
        F.when(F.col("target_group") == "", F.col("target_field").isin(*known))
        .when(F.col("target_group") == "items", F.col("target_field").isin(*item_fields))
        .otherwise(F.col("target_group") == "deliveries")
    )
    return rows.filter(~stored).select("vendor_id", "doc_path", "target_group", "target_field")


def vendor_status_rows(df: DataFrame) -> DataFrame:
    """One row per raw status of each vendor."""
    return parse_configs(df).select("vendor_id", F.inline(status_lists(F.col("c"))))


def vendor_carrier_rows(df: DataFrame) -> DataFrame:
    """One row per known service of each vendor."""
    services = compile_configs(df).select("vendor_id", F.explode("cfg.carrier.services").alias("carrier", "s"))
    return services.select("vendor_id", "carrier", F.explode("s").alias("service", "service_id"))
