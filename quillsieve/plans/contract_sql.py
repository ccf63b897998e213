"""The staged tables and the contracts as SQL, column by column, for checking the projections.

Fixed values: names, order, types and source keys of the columns. This module shares nothing with the specification that
the projections are made from, so a slip in either shows as a difference.
"""

from __future__ import annotations


def _text(key: str) -> str:
    return f"nullif(trim(json_extract_string(payload, '$.{key}')), '')"


def _t(*keys: str) -> list[str]:
    return [f"{_text(k)} AS {k}" for k in keys]


def _renamed(name: str, key: str) -> list[str]:
    return [f"{_text(key)} AS {name}"]


def _d(*keys: str) -> list[str]:
    return [f"CASE WHEN regexp_full_match({_text(k)}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({_text(k)} AS DATE) END AS {k}" for k in keys]


def _i(*keys: str) -> list[str]:
    return [f"CASE WHEN regexp_full_match({_text(k)}, '-?[0-9]+') THEN TRY_CAST({_text(k)} AS INTEGER) END AS {k}" for k in keys]


def _n(kind: str, *keys: str) -> list[str]:
    return [f"CASE WHEN regexp_full_match({_text(k)}, '-?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST({_text(k)} AS {kind}) END AS {k}" for k in keys]


def _absent(kind: str, *names: str) -> list[str]:
    return [f"CAST(NULL AS {kind}) AS {n}" for n in names]


def _source(default: str) -> list[str]:
    return [f"coalesce({_text('data_source')}, '{default}') AS data_source"]


WIDE, MONEY = "DECIMAL(38,10)", "DECIMAL(38,2)"


def _medical(amounts: str, contract: bool) -> list[str]:
    out = _t("claim_id") + _i("claim_line_number") + _t("claim_type", "person_id", "member_id", "payer", "plan")
    out += _d("claim_start_date", "claim_end_date", "claim_line_start_date", "claim_line_end_date", "admission_date", "discharge_date")
    out += _d("paid_date") + _t("admit_source_code", "admit_type_code", "discharge_disposition_code", "place_of_service_code", "bill_type_code")
    out += _t("revenue_center_code", "drg_code_type", "drg_code") + _n(WIDE, "service_unit_quantity") + _t("hcpcs_code", "hcpcs_modifier_1", "hcpcs_modifier_2")
    if contract:
        out += _absent("VARCHAR", "hcpcs_modifier_3", "hcpcs_modifier_4", "hcpcs_modifier_5")
    out += _renamed("rendering_npi", "rendering_id") + (_absent("VARCHAR", "rendering_tin") if contract else [])
    out += _renamed("billing_npi", "billing_id") + (_absent("VARCHAR", "billing_tin") if contract else []) + _renamed("facility_npi", "facility_id")
    out += _n(amounts, "paid_amount", "allowed_amount", "charge_amount", "coinsurance_amount", "copayment_amount", "deductible_amount")
    if contract:
        out += _absent(MONEY, "total_cost_amount") + _absent("VARCHAR", "diagnosis_code_type")
        for stem in ("diagnosis_code", "diagnosis_poa"):
            out += _absent("VARCHAR", *[f"{stem}_{i}" for i in range(1, 26)])
        out += _absent("VARCHAR", "procedure_code_type", *[f"procedure_code_{i}" for i in range(1, 26)])
        out += _absent("DATE", *[f"procedure_date_{i}" for i in range(1, 26)]) + _absent("INTEGER", "in_network_flag")
    return out


def _pharmacy(amounts: str, contract: bool) -> list[str]:
    out = _t("claim_id") + _i("claim_line_number") + _t("person_id", "member_id", "payer", "plan")
    out += _renamed("prescribing_provider_npi", "prescribing_provider_id") + _renamed("dispensing_provider_npi", "dispensing_provider_id")
    out += _d("dispensing_date") + _t("ndc_code") + _i("quantity", "days_supply", "refills") + _d("paid_date")
    out += _n(amounts, "paid_amount", "allowed_amount", "charge_amount", "coinsurance_amount", "copayment_amount", "deductible_amount")
    return out + (_absent("INTEGER", "in_network_flag") if contract else [])


def _eligibility(contract: bool) -> list[str]:
    out = _t("person_id", "member_id", "subscriber_id") + (_absent("VARCHAR", "gender", "race") if contract else []) + _d("birth_date", "death_date")
    if contract:
        out += [f"({_d('death_date')[0].removesuffix(' AS death_date')} IS NOT NULL)::INTEGER AS death_flag"]
    out += _d("enrollment_start_date", "enrollment_end_date")
    out += _t("payer", "payer_type", "plan", "original_reason_entitlement_code", "dual_status_code", "medicare_status_code", "group_id", "group_name")
    if contract:
        out += _absent("VARCHAR", "name_suffix", "first_name", "middle_name", "last_name", "email", "ethnicity", "social_security_number")
        out += _absent("VARCHAR", "subscriber_relation", "address", "city", "state", "zip_code", "phone")
    return out + ([] if contract else _t("fips_state_code"))


_FILE = _absent("VARCHAR", "file_name") + _absent("DATE", "file_date") + _absent("TIMESTAMP", "ingest_datetime")
_STAGED = {"eligibility": _eligibility(False), "medical_claim": _medical(WIDE, False), "pharmacy_claim": _pharmacy(WIDE, False)}
_CONTRACT = {"eligibility": _eligibility(True), "medical_claim": _medical(MONEY, True), "pharmacy_claim": _pharmacy(MONEY, True)}


def _from(raw: str) -> str:
    return f"FROM (SELECT *, coalesce(_raw_payload, raw_row) AS payload FROM ({raw}) r) x"


def staged(table: str, raw: str, default: str) -> str:
    columns = ["_snapshot_id", "_source_row_number", *_STAGED[table], *_source(default)]
    return f"SELECT {', '.join(columns)} {_from(raw)}"


def contract(table: str, raw: str, default: str) -> str:
    return f"SELECT {', '.join([*_CONTRACT[table], *_source(default), *_FILE])} {_from(raw)}"
