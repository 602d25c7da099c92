"""Registered queries: coverage of the operator list, and a sample against the oracle."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import connect, normal
from checks.registry import ORACLES, QUERIES

SAMPLE = (
    "read_feed", "vendor_mapping_rows", "pending_purchase_orders", "resolve_order_id", "items_object_array", "vendor_bill_objects",
    "rollup_status", "dedup_first_by_pair", "upsert_invoices", "assign_ids", "coerce_and_validate", "flatten_json", "finish_record",
)
KEYS = """read_json_responses read_xml_responses read_feed build_requests enrich_second_call vendor_mapping_rows stage_read stage_write
table_query project_by_mapping filter_known_status pending_sales_orders pending_purchase_orders order_id_by_so order_id_by_po
existing_invoice_numbers valid_responses require_body_path attach_order_context drop_unbillable default_from_other_field not_fully_billed
conform_to_schema unbilled_invoice_filter route_by_outcome route_by_connection_type vendor_schedule orders_left_invoices resolve_order_id
drop_loaded_invoices attach_sales_order_id attach_invoice_id vendor_bill_objects update_where_in_subquery zip_items_with_deliveries
carrier_service_lookup status_map_lookup object_agg items_object_array key_to_id_agg group_distinct order_total rollup_status
max_money_token join_wildcard_values distinct_invoices run_summary dedup_first_by_pair dedup_first_by_key first_match first_wins_merge
append_batches flatten_json extract_path explode_multi_field map_exact_scalar map_exact_into_first_element collect_serial_numbers
map_by_qualifier map_wildcard_to_array map_wildcard_nested_array map_prefix_list map_suffix_to_array path_index map_record render_template
nested_to_json unnest_parallel_arrays split_zip split_pad split_columns clean_number money_from_multi first_of_list parse_date_format
parse_date_any normalize_carrier default_weight item_status mirror_cost upper_selected strip_suffix item_no_fallback ship_complete_flag
first_date_of money_or_zero empty_to_null coerce_and_validate status_from_invoice_field error_to_status apply_calculated_status
finish_record insert_rows update_by_key bulk_upsert upsert_sales_orders upsert_purchase_orders upsert_invoices replace_children assign_ids
update_bill_results update_order_status check_unique check_foreign_keys incremental_ingest explode_multi_field_by_vendor
require_body_path_by_vendor error_to_status_by_vendor second_call_job dispatch_duplicate_keys dispatch_rejects vendor_unknown_targets
stored_deliveries feed_rejects feed_files second_call_ingest""".split()


def test_every_operator_has_a_query_and_an_oracle():
    assert set(KEYS) <= set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) == set(ORACLES) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, name):
    folder = "/root/testdata/sf0.001"
    got = entry_points.queries()[name](spark, folder).toPandas()
    want = connect(folder).execute(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got).equals(normal(want))
