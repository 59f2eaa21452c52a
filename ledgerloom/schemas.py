"""Schemas of the stored tables, as DDL.  Identifiers are strings, so zeros in front
survive; amounts are decimals; an absent value is null, never zero."""

from __future__ import annotations

HOSPITALS = """ccn string, name string, provider_category_code string, provider_subtype_code string,
provider_subtype string, address string, city string, state string, zip5 string, county string, phone string,
ownership_code string, ownership_type string, certified_bed_count int, certification_date date,
termination_code string, is_active boolean, ssa_state_code string, fips_state_code string, source string,
source_edition string, ingested_at timestamp"""

INGESTION_RUNS = """id string, source string, state string, source_edition string, records_read long,
records_loaded long, started_at timestamp, finished_at timestamp, status string, message string"""

CHARGE_SOURCES = """source_file string, hospital_name string, location_name string, hospital_address string,
ein string, primary_npi string, npis array<string>, license_number string, license_state string,
mrf_version string, layout string, last_updated_on date, ccn string, link_method string, charge_count long,
ingested_at timestamp"""

NPI_CROSSWALK = "npi string, ccn string, name string, source string, loaded_at timestamp"

SERVICE_AREA = """ccn string, zip5 string, edition string, cases int, days int, charges decimal(16,2),
suppressed boolean, source string, loaded_at timestamp"""

CHNA_DOCUMENTS = """source_file string, ccn string, hospital_name string, county string, state string,
cycle_label string, consultant string, consultant_hint string, townhall_date string, year int, attendees int,
total_votes int, boilerplate_declines int, link_method string, ingested_at timestamp"""

CHNA_DOCUMENT_HOSPITALS = "source_file string, ccn string, link_method string, linked_at timestamp"

CHNA_NEEDS = """source_file string, table_kind string, rank int, label string, votes int, pct decimal(5,2),
accum decimal(5,2), prior_rank int, recovered boolean"""

CHNA_SHORTAGES = "source_file string, specialty string, verbatim string, recruiting boolean, confirmed boolean"

STANDARD_CHARGES = """source_file string, ein string, primary_npi string, description string, code string,
code_type string, additional_codes string, billing_class string, setting string,
drug_unit_of_measurement string, drug_type_of_measurement string, modifiers string,
gross_charge decimal(14,2), discounted_cash decimal(14,2), min_charge decimal(14,2), max_charge decimal(14,2),
payer_name string, plan_name string, negotiated_dollar decimal(14,2), negotiated_percentage decimal(9,4),
negotiated_algorithm string, methodology string, median_amount decimal(14,2), percentile_10 decimal(14,2),
percentile_90 decimal(14,2), count int, additional_notes string"""

COST_REPORTS = """vintage_year int, rpt_rec_num long, row_seq long, raw_line string, source_zip string, ccn string,
status_code string, fy_begin date, fy_end date, proc_date date, ingested_at timestamp"""

COST_NUMERIC = """vintage_year int, rpt_rec_num long, row_seq long, wksht_cd string, line_num string, clmn_num string,
value decimal(20,4)"""

COST_ALPHA = "vintage_year int, rpt_rec_num long, row_seq long, wksht_cd string, line_num string, clmn_num string, value string"

METRIC_VALUES = "vintage_year int, rpt_rec_num long, metric string, value_numeric decimal(20,4), value_text string"

METRIC_CROSSWALK = """metric string, label string, metric_type string, wksht_cd string, clmn_num string,
line_start string, line_end string, enabled boolean"""
