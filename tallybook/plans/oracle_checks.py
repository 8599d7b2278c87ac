"""DuckDB spellings of the check rules, for the correctness oracle only.

Each rule becomes the SQL a DBA would write by hand for it: a WHERE on the
negated CHECK (NULL passes), a GROUP BY .. HAVING count(*) > 1 for a unique
key, a NOT EXISTS for a reference.
"""

from __future__ import annotations

import re
from dataclasses import replace

from ..operators.checks import Rule


# Fixed values, spelled here a second time from the declared schema: a wrong value in the
# rule catalogue then shows as a difference instead of being wrong on both sides.
DECLARED = {
    "ck_account_type": """account_type in ('credit', 'debit', 'undefined', 'checking', 'savings', 'credit_card',
 'certificate', 'money_market', 'brokerage', 'retirement_401k', 'retirement_ira', 'retirement_roth', 'pension', 'hsa',
 'fsa', 'medical_savings', 'mortgage', 'auto_loan', 'student_loan', 'personal_loan', 'line_of_credit', 'utility',
 'prepaid', 'gift_card', 'business_checking', 'business_savings', 'business_credit', 'cash', 'escrow', 'trust')""",
    "ck_validation_transaction_state": "transaction_state in ('outstanding', 'future', 'cleared', 'undefined')",
    "ck_transaction_state": "transaction_state in ('outstanding', 'future', 'cleared', 'undefined')",
    "ck_transaction_account_type": "account_type in ('debit', 'credit', 'undefined')",
    "ck_transaction_type": "transaction_type in ('expense', 'income', 'transfer', 'undefined')",
    "ck_reoccurring_type": """reoccurring_type in ('annually', 'biannually', 'fortnightly', 'monthly', 'quarterly',
 'onetime', 'undefined')""",
    "ck_image_type": "image_format_type in ('jpeg', 'png', 'undefined')",
    "ck_review_status": "review_status in ('pending', 'approved', 'rejected')",
    "ck_provider_type": """provider_type in ('general', 'specialist', 'hospital', 'pharmacy', 'laboratory', 'imaging',
 'urgent_care', 'emergency', 'mental_health', 'dental', 'vision', 'physical_therapy', 'other')""",
    "ck_network_status": "network_status in ('in_network', 'out_of_network', 'unknown')",
    "ck_family_relationship": "relationship in ('self', 'spouse', 'child', 'dependent', 'other')",
    "ck_medical_expense_claim_status": """claim_status in ('submitted', 'processing', 'approved', 'denied', 'paid',
 'closed')""",
    "ck_billing_cycle_weekend_shift": "billing_cycle_weekend_shift in ('back', 'forward', 'back_sat_only')",
    "ck_npi_format": "length(npi) = 10 and translate(npi, '0123456789', '') = ''",
    "ck_zip_code_format": """(length(zip_code) = 5 and translate(zip_code, '0123456789', '') = '')
 or (length(zip_code) = 10 and substr(zip_code, 6, 1) = '-' and translate(zip_code, '0123456789', '') = '-')""",
    "ck_ssn_last_four_format": "length(ssn_last_four) = 4 and translate(ssn_last_four, '0123456789', '') = ''",
    "ck_phone_format": "length(phone) >= 10",
    "ck_insurance_member_id_length": "length(insurance_member_id) <= 50",
    "ck_medical_record_number_length": "length(medical_record_number) <= 50",
    "ck_image_size": "octet_length(image) <= 1048576",
    "ck_token_hash_length": "length(token_hash) <= 64",
    "ck_billing_statement_close_day": "billing_statement_close_day >= 1 and billing_statement_close_day <= 31",
    "ck_billing_grace_period_days": "billing_grace_period_days >= 1 and billing_grace_period_days <= 60",
    "ck_billing_due_day_same_month": "billing_due_day_same_month >= 1 and billing_due_day_same_month <= 31",
    "ck_billing_due_day_next_month": "billing_due_day_next_month >= 1 and billing_due_day_next_month <= 31",
    "ck_billing_due_method_exclusive": """(billing_grace_period_days is not null)::int
 + (billing_due_day_same_month is not null)::int + (billing_due_day_next_month is not null)::int <= 1""",
    "ck_medical_expense_financial_amounts": """billed_amount >= 0 and insurance_discount >= 0 and insurance_paid >= 0
 and patient_responsibility >= 0""",
    "ck_paid_amount_non_negative": "paid_amount >= 0",
    "ck_medical_expense_financial_consistency":
        "billed_amount >= insurance_discount + insurance_paid + patient_responsibility",
    "fits_transaction_amount": "abs(amount) <= 9999999999.99",
    "fits_transaction_amount_narrow": "abs(amount) <= 999999.99",
}


# NOT NULL columns of the final schema, by table, in the declared order.
NOT_NULL = {
    "t_account": "account_id account_name_owner account_type active_status moniker date_closed validation_date owner date_updated "
                 "date_added",
    "t_validation_amount": "validation_id account_id validation_date transaction_state amount owner active_status date_updated date_added",
    "t_user": "user_id username password first_name last_name active_status date_updated date_added",
    "t_role": "role_id role active_status date_updated date_added",
    "t_category": "category_id category_name owner active_status date_updated date_added",
    "t_description": "description_id description_name owner active_status date_updated date_added",
    "t_transaction_categories": "category_id transaction_id owner date_updated date_added",
    "t_receipt_image": "receipt_image_id transaction_id image thumbnail image_format_type owner active_status date_updated date_added",
    "t_transaction": "transaction_id account_id account_type transaction_type account_name_owner guid transaction_date description "
                     "category amount transaction_state active_status notes owner date_updated date_added",
    "t_pending_transaction": "pending_transaction_id account_name_owner transaction_date description amount review_status owner date_added",
    "t_payment": "payment_id source_account destination_account transaction_date amount guid_source guid_destination owner active_status "
                 "date_updated date_added",
    "t_transfer": "transfer_id source_account destination_account transaction_date amount guid_source guid_destination owner active_status "
                  "date_updated date_added",
    "t_parameter": "parameter_id parameter_name parameter_value owner active_status date_updated date_added",
    "t_medical_provider": "provider_id provider_name provider_type active_status date_added date_updated",
    "t_family_member": "family_member_id owner member_name relationship active_status date_added date_updated",
    "t_medical_expense": "medical_expense_id service_date billed_amount insurance_discount insurance_paid patient_responsibility "
                         "is_out_of_network claim_status owner active_status date_added date_updated paid_amount",
    "t_token_blacklist": "token_blacklist_id token_hash expires_at",
}

# Keys and references of the schema, as declared (the legacy ones before the tenant migration).
KEYS = {
    "pk_t_description": "t_description(description_id)",
    "pk_t_account": "t_account(account_id)",
    "pk_t_category": "t_category(category_id)",
    "pk_t_validation_amount": "t_validation_amount(validation_id)",
    "pk_t_parameter": "t_parameter(parameter_id)",
    "pk_t_transaction": "t_transaction(transaction_id)",
    "pk_t_pending_transaction": "t_pending_transaction(pending_transaction_id)",
    "pk_t_transaction_categories": "t_transaction_categories(category_id, transaction_id)",
    "pk_t_payment": "t_payment(payment_id)",
    "pk_t_transfer": "t_transfer(transfer_id)",
    "pk_t_receipt_image": "t_receipt_image(receipt_image_id)",
    "pk_t_medical_provider": "t_medical_provider(provider_id)",
    "pk_t_family_member": "t_family_member(family_member_id)",
    "pk_t_medical_expense": "t_medical_expense(medical_expense_id)",
    "pk_t_token_blacklist": "t_token_blacklist(token_blacklist_id)",
    "pk_t_user": "t_user(user_id)",
    "pk_t_role": "t_role(role_id)",
    "t_transaction_guid_key": "t_transaction(guid)",
    "t_medical_provider_npi_key": "t_medical_provider(npi)",
    "t_user_username_key": "t_user(username)",
    "t_role_role_key": "t_role(role)",
    "uk_token_blacklist_token_hash": "t_token_blacklist(token_hash)",
    "uk_medical_expense_transaction": "t_medical_expense(transaction_id)",
    "unique_owner_account_name_owner_account_type": "t_account(owner, account_name_owner, account_type)",
    "unique_owner_account_name_owner": "t_account(owner, account_name_owner)",
    "unique_owner_account_id_name_type": "t_account(owner, account_id, account_name_owner, account_type)",
    "unique_owner_account_id": "t_account(owner, account_id)",
    "unique_owner_category_name": "t_category(owner, category_name)",
    "unique_owner_description_name": "t_description(owner, description_name)",
    "unique_owner_transaction": "t_transaction(owner, account_name_owner, transaction_date, description, category, amount, notes)",
    "unique_owner_transaction_id": "t_transaction(owner, transaction_id)",
    "unique_owner_payment": "t_payment(owner, destination_account, transaction_date, amount)",
    "unique_owner_transfer": "t_transfer(owner, source_account, destination_account, transaction_date, amount)",
    "unique_owner_parameter_name": "t_parameter(owner, parameter_name)",
    "unique_owner_pending_transaction": "t_pending_transaction(owner, account_name_owner, transaction_date, description, amount)",
    "uk_family_member_owner_name": "t_family_member(owner, member_name)",
    "unique_owner_family_member_id": "t_family_member(owner, family_member_id)",
    "t_account_account_name_owner_key": "t_account(account_name_owner)",
    "unique_account_name_owner_account_type": "t_account(account_name_owner, account_type)",
    "unique_account_name_owner_account_id": "t_account(account_id, account_name_owner, account_type)",
    "t_category_category_name_key": "t_category(category_name)",
    "t_description_description_name_key": "t_description(description_name)",
    "transaction_constraint": "t_transaction(account_name_owner, transaction_date, description, category, amount, notes)",
    "payment_constraint": "t_payment(account_name_owner, transaction_date, amount)",
    "payment_constraint_destination": "t_payment(destination_account, transaction_date, amount)",
    "transfer_constraint": "t_transfer(source_account, destination_account, transaction_date, amount)",
    "t_parameter_parameter_name_key": "t_parameter(parameter_name)",
    "unique_pending_transaction_fields": "t_pending_transaction(account_name_owner, transaction_date, description, amount)",
}
REFERENCES = {
    "fk_account_id_account_name_owner": "t_transaction(owner, account_id, account_name_owner, account_type) "
                                        "t_account(owner, account_id, account_name_owner, account_type)",
    "fk_category_name": "t_transaction(owner, category) t_category(owner, category_name)",
    "fk_description_name": "t_transaction(owner, description) t_description(owner, description_name)",
    "fk_receipt_image": "t_transaction(receipt_image_id) t_receipt_image(receipt_image_id)",
    "fk_pending_account": "t_pending_transaction(owner, account_name_owner) t_account(owner, account_name_owner)",
    "fk_payment_source_account": "t_payment(owner, source_account) t_account(owner, account_name_owner)",
    "fk_payment_destination_account": "t_payment(owner, destination_account) t_account(owner, account_name_owner)",
    "fk_source_account": "t_transfer(owner, source_account) t_account(owner, account_name_owner)",
    "fk_destination_account": "t_transfer(owner, destination_account) t_account(owner, account_name_owner)",
    "fk_payment_guid_source": "t_payment(guid_source) t_transaction(guid)",
    "fk_payment_guid_destination": "t_payment(guid_destination) t_transaction(guid)",
    "fk_transfer_guid_source": "t_transfer(guid_source) t_transaction(guid)",
    "fk_transfer_guid_destination": "t_transfer(guid_destination) t_transaction(guid)",
    "fk_validation_account_id": "t_validation_amount(owner, account_id) t_account(owner, account_id)",
    "fk_receipt_transaction": "t_receipt_image(owner, transaction_id) t_transaction(owner, transaction_id)",
    "fk_medical_expense_transaction": "t_medical_expense(owner, transaction_id) t_transaction(owner, transaction_id)",
    "fk_medical_expense_provider": "t_medical_expense(provider_id) t_medical_provider(provider_id)",
    "fk_medical_expense_family_member": "t_medical_expense(owner, family_member_id) t_family_member(owner, family_member_id)",
    "fk_legacy_account": "t_transaction(account_id, account_name_owner, account_type) "
                         "t_account(account_id, account_name_owner, account_type)",
    "fk_legacy_category_name": "t_transaction(category) t_category(category_name)",
    "fk_legacy_description_name": "t_transaction(description) t_description(description_name)",
    "fk_legacy_pending_account": "t_pending_transaction(account_name_owner) t_account(account_name_owner)",
    "fk_account_name_owner": "t_payment(account_name_owner) t_account(account_name_owner)",
    "fk_legacy_payment_source_account": "t_payment(source_account) t_account(account_name_owner)",
    "fk_legacy_payment_destination_account": "t_payment(destination_account) t_account(account_name_owner)",
    "fk_legacy_source_account": "t_transfer(source_account) t_account(account_name_owner)",
    "fk_legacy_destination_account": "t_transfer(destination_account) t_account(account_name_owner)",
    "fk_legacy_validation_account_id": "t_validation_amount(account_id) t_account(account_id)",
    "fk_legacy_receipt_transaction": "t_receipt_image(transaction_id) t_transaction(transaction_id)",
    "fk_legacy_medical_expense_transaction": "t_medical_expense(transaction_id) t_transaction(transaction_id)",
    "fk_legacy_medical_expense_family_member": "t_medical_expense(family_member_id) t_family_member(family_member_id)",
    "orphaned_transaction_categories": "t_transaction_categories(transaction_id) t_transaction(transaction_id)",
    "orphaned_receipt_images": "t_receipt_image(transaction_id) t_transaction(transaction_id)",
}


def spelled(text: str) -> list[tuple[str, tuple[str, ...]]]:
    """(table, columns) of every ``table(column, ..)`` in a text."""
    return [(t, tuple(c.split(", "))) for t, c in re.findall(r"(\w+)\(([^)]*)\)", text)]


def declared(r: Rule) -> Rule:
    """The rule with the table and columns spelled here, if it is a key, a reference or NOT NULL."""
    if r.kind == "unique":
        (table, columns), = spelled(KEYS[r.name])
        return replace(r, table=table, columns=columns)
    if r.kind == "foreign_key":
        (table, columns), (ref_table, ref_columns) = spelled(REFERENCES[r.name])
        return replace(r, table=table, columns=columns, ref_table=ref_table, ref_columns=ref_columns)
    if r.kind == "not_null":
        table, column = next((t, c) for t, cs in NOT_NULL.items() for c in cs.split() if r.name == f"nn_{t}_{c}")
        return replace(r, table=table, columns=(column,))
    return r


def _str(c: str) -> str:
    return f"coalesce(cast({c} as varchar), 'NULL')"


def key_sql(cols) -> str:
    return "concat_ws(',', " + ", ".join(_str(c) for c in cols) + ")"


def detail_sql(cols) -> str:
    return "concat_ws(', ', " + ", ".join(f"'{c}=' || {_str(c)}" for c in cols) + ")"


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def ok_sql(r: Rule, as_of: str | None) -> str:
    c = r.columns[0]
    if r.name in DECLARED:
        return DECLARED[r.name]
    if r.kind == "not_null":
        return " and ".join(f"{x} is not null" for x in r.columns)
    if r.kind == "domain":  # a domain given with the rule, as when one is extended
        return f"{c} in ({', '.join(_q(v) for v in r.values)})"
    if r.kind == "lowercase":
        return f"{c} = lower({c})"
    if r.kind == "not_empty":
        return f"length(trim({c}, ' ')) > 0"
    if r.kind == "not_future":
        return f"{c} <= date '{as_of}'"
    raise ValueError(f"no declared form of {r.name}")


def violated_sql(r: Rule, as_of: str | None) -> str:
    if r.kind == "not_null":
        return f"not ({ok_sql(r, as_of)})"
    return f"coalesce(not ({ok_sql(r, as_of)}), false)"


def _head(r: Rule) -> str:
    return f"select '{r.name}' as rule, '{r.table}' as \"table\""


def violation_sql(r: Rule, table_cols: list[str], key_cols, as_of: str | None,
                  prefix: str = "") -> str:
    r = declared(r)
    src = prefix + r.table
    keys = [c for c in key_cols if c in table_cols] or table_cols[:1]
    if r.kind == "unique":
        nn = " and ".join(f"{c} is not null" for c in r.columns)
        cols = ", ".join(r.columns)
        return (f"{_head(r)}, {key_sql(r.columns)} as key, 'count=' || cast(n as varchar) as detail "
                f"from (select {cols}, count(*) as n from {src} where {nn} group by {cols} "
                f"having count(*) > 1) d")
    if r.kind == "foreign_key":
        return (f"{_head(r)}, {key_sql(keys)} as key, {detail_sql(r.columns)} as detail "
                f"from {src} c where {fk_orphan_where(r, 'c', prefix)}")
    if r.kind == "max_bytes":
        detail = f"'bytes=' || cast(octet_length({r.columns[0]}) as varchar)"
    else:
        detail = detail_sql(r.columns)
    return (f"{_head(r)}, {key_sql(keys)} as key, {detail} as detail from {src} "
            f"where {violated_sql(r, as_of)}")


def fk_orphan_where(r: Rule, alias: str, prefix: str = "") -> str:
    nn = " and ".join(f"{alias}.{c} is not null" for c in r.columns)
    match = " and ".join(f"p.{pc} = {alias}.{c}" for c, pc in zip(r.columns, r.ref_columns))
    return f"{nn} and not exists (select 1 from {prefix}{r.ref_table} p where {match})"


def count_sql(r: Rule, as_of: str | None, prefix: str = "") -> str:
    r = declared(r)
    src = prefix + r.table
    head = f"select '{r.name}' as rule, '{r.table}' as \"table\", '{r.severity}' as severity"
    if r.kind == "unique":
        nn = " and ".join(f"{c} is not null" for c in r.columns)
        cols = ", ".join(r.columns)
        return (f"{head}, count(*) as violations from (select {cols} from {src} where {nn} "
                f"group by {cols} having count(*) > 1) d")
    if r.kind == "foreign_key":
        return f"{head}, count(*) as violations from {src} c where {fk_orphan_where(r, 'c', prefix)}"
    return f"{head}, count(*) filter (where {violated_sql(r, as_of)}) as violations from {src}"
