"""Column contracts of the raw, staged and final tables.

Fixed values: names, order and kinds of the columns. A column is (name, kind, source key); a kind is text, date, int,
numeric (unbounded), money (two places). Without a key the source does not supply the column and it is a typed NULL.
"""

from __future__ import annotations

LINEAGE = ["_snapshot_id", "_source_row_number", "_loaded_at"]


def _same(kind: str, *names: str) -> list[tuple[str, str, str | None]]:
    return [(n, kind, n) for n in names]


def _none(kind: str, *names: str) -> list[tuple[str, str, str | None]]:
    return [(n, kind, None) for n in names]


def _numbered(kind: str, stem: str) -> list[tuple[str, str, str | None]]:
    return _none(kind, *[f"{stem}_{i}" for i in range(1, 26)])


STAGING = {
    "eligibility": _same("text", "person_id", "member_id", "subscriber_id")
    + _same("date", "birth_date", "death_date", "enrollment_start_date", "enrollment_end_date")
    + _same("text", "payer", "payer_type", "plan", "original_reason_entitlement_code", "dual_status_code", "medicare_status_code", "group_id", "group_name", "fips_state_code", "data_source"),
    "medical_claim": _same("text", "claim_id")
    + _same("int", "claim_line_number")
    + _same("text", "claim_type", "person_id", "member_id", "payer", "plan")
    + _same("date", "claim_start_date", "claim_end_date", "claim_line_start_date", "claim_line_end_date", "admission_date", "discharge_date", "paid_date")
    + _same("text", "admit_source_code", "admit_type_code", "discharge_disposition_code", "place_of_service_code", "bill_type_code", "revenue_center_code", "drg_code_type", "drg_code")
    + _same("numeric", "service_unit_quantity")
    + _same("text", "hcpcs_code", "hcpcs_modifier_1", "hcpcs_modifier_2")
    + [("rendering_npi", "text", "rendering_id"), ("billing_npi", "text", "billing_id"), ("facility_npi", "text", "facility_id")]
    + _same("numeric", "paid_amount", "allowed_amount", "charge_amount", "coinsurance_amount", "copayment_amount", "deductible_amount")
    + _same("text", "data_source"),
    "pharmacy_claim": _same("text", "claim_id")
    + _same("int", "claim_line_number")
    + _same("text", "person_id", "member_id", "payer", "plan")
    + [("prescribing_provider_npi", "text", "prescribing_provider_id"), ("dispensing_provider_npi", "text", "dispensing_provider_id")]
    + _same("date", "dispensing_date")
    + _same("text", "ndc_code")
    + _same("int", "quantity", "days_supply", "refills")
    + _same("date", "paid_date")
    + _same("numeric", "paid_amount", "allowed_amount", "charge_amount", "coinsurance_amount", "copayment_amount", "deductible_amount")
    + _same("text", "data_source"),
}

_FILE = _none("text", "file_name") + _none("date", "file_date") + _none("timestamp", "ingest_datetime")

FINAL = {
    "eligibility": _same("text", "person_id", "member_id", "subscriber_id")
    + _none("text", "gender", "race")
    + _same("date", "birth_date", "death_date")
    + [("death_flag", "flag", "death_date")]
    + _same("date", "enrollment_start_date", "enrollment_end_date")
    + _same("text", "payer", "payer_type", "plan", "original_reason_entitlement_code", "dual_status_code", "medicare_status_code", "group_id", "group_name")
    + _none("text", "name_suffix", "first_name", "middle_name", "last_name", "email", "ethnicity", "social_security_number", "subscriber_relation", "address", "city", "state", "zip_code", "phone")
    + _same("text", "data_source")
    + _FILE,
    "medical_claim": _same("text", "claim_id")
    + _same("int", "claim_line_number")
    + _same("text", "claim_type", "person_id", "member_id", "payer", "plan")
    + _same("date", "claim_start_date", "claim_end_date", "claim_line_start_date", "claim_line_end_date", "admission_date", "discharge_date", "paid_date")
    + _same("text", "admit_source_code", "admit_type_code", "discharge_disposition_code", "place_of_service_code", "bill_type_code", "revenue_center_code", "drg_code_type", "drg_code")
    + _same("numeric", "service_unit_quantity")
    + _same("text", "hcpcs_code", "hcpcs_modifier_1", "hcpcs_modifier_2")
    + _none("text", "hcpcs_modifier_3", "hcpcs_modifier_4", "hcpcs_modifier_5")
    + [("rendering_npi", "text", "rendering_id"), ("rendering_tin", "text", None), ("billing_npi", "text", "billing_id"), ("billing_tin", "text", None), ("facility_npi", "text", "facility_id")]
    + _same("money", "paid_amount", "allowed_amount", "charge_amount", "coinsurance_amount", "copayment_amount", "deductible_amount")
    + _none("money", "total_cost_amount")
    + _none("text", "diagnosis_code_type")
    + _numbered("text", "diagnosis_code")
    + _numbered("text", "diagnosis_poa")
    + _none("text", "procedure_code_type")
    + _numbered("text", "procedure_code")
    + _numbered("date", "procedure_date")
    + _none("int", "in_network_flag")
    + _same("text", "data_source")
    + _FILE,
    "pharmacy_claim": _same("text", "claim_id")
    + _same("int", "claim_line_number")
    + _same("text", "person_id", "member_id", "payer", "plan")
    + [("prescribing_provider_npi", "text", "prescribing_provider_id"), ("dispensing_provider_npi", "text", "dispensing_provider_id")]
    + _same("date", "dispensing_date")
    + _same("text", "ndc_code")
    + _same("int", "quantity", "days_supply", "refills")
    + _same("date", "paid_date")
    + _same("money", "paid_amount", "allowed_amount", "charge_amount", "coinsurance_amount", "copayment_amount", "deductible_amount")
    + _none("int", "in_network_flag")
    + _same("text", "data_source")
    + _FILE,
}

GRAIN = {
    "eligibility": ["person_id", "member_id", "enrollment_start_date", "enrollment_end_date", "data_source"],
    "medical_claim": ["claim_id", "claim_line_number", "data_source"],
    "pharmacy_claim": ["claim_id", "claim_line_number", "data_source"],
}

#: Spark types of the kinds.
TYPES = {"text": "string", "date": "date", "int": "int", "numeric": "decimal(38,10)", "money": "decimal(38,2)", "flag": "int", "timestamp": "timestamp_ntz"}

#: Identifier fields of each feed, and the fields that are dates where they are present.
ID_FIELDS = {"eligibility": ["person_id"], "medical_claim": ["claim_id", "claim_line_number"], "pharmacy_claim": ["claim_id", "claim_line_number"]}
REQUIRED_TEXT = {"eligibility": ["person_id"], "medical_claim": ["claim_id"], "pharmacy_claim": ["claim_id"]}
REQUIRED_SCALAR = {"eligibility": [], "medical_claim": ["claim_line_number"], "pharmacy_claim": ["claim_line_number"]}
DATE_FIELDS = {"eligibility": ["enrollment_start_date", "enrollment_end_date"], "medical_claim": ["claim_start_date", "claim_end_date"], "pharmacy_claim": ["claim_start_date", "claim_end_date"]}
#: Tables by the names that feeds are asked for.
TABLES = {"eligibility": "eligibility", "medical-claims": "medical_claim", "pharmacy-claims": "pharmacy_claim"}


def table_of(endpoint: str) -> str:
    """The table of a feed, by its asked-for name or its table name."""
    if endpoint in FINAL:
        return endpoint
    if endpoint not in TABLES:
        raise ValueError(f"unknown endpoint {endpoint!r}; one of {', '.join(TABLES)} is meant")
    return TABLES[endpoint]
