"""The rule catalogue of the ledger schema (final state after all migrations).

NOT NULL rules are derived from the table schemas; every other rule mirrors
one declared CHECK / UNIQUE / FOREIGN KEY.  ``LEGACY_RULES`` holds the
un-scoped uniques and references that the tenant migration replaced; they are
what a single-tenant ledger is still checked against.
"""

from __future__ import annotations

from ..operators.cascade import CASCADE, NO_ACTION, RESTRICT, Reference
from ..operators.checks import Rule
from ..sources import schemas as S


def _nn() -> list[Rule]:
    out = []
    for table, schema in S.SCHEMAS.items():
        for f in schema.fields:
            if not f.nullable:
                out.append(Rule(f"nn_{table}_{f.name}", table, "not_null", (f.name,)))
    return out


def _dom(name, table, column, values):
    return Rule(name, table, "domain", (column,), values=tuple(values))


def _low(name, table, column):
    return Rule(name, table, "lowercase", (column,))


DOMAIN_RULES = [
    _dom("ck_account_type", "t_account", "account_type", S.ACCOUNT_TYPES),
    _dom("ck_validation_transaction_state", "t_validation_amount", "transaction_state",
         S.TRANSACTION_STATES),
    _dom("ck_transaction_state", "t_transaction", "transaction_state", S.TRANSACTION_STATES),
    _dom("ck_transaction_account_type", "t_transaction", "account_type", S.ACCOUNT_TYPES_LEGACY),
    _dom("ck_transaction_type", "t_transaction", "transaction_type", S.TRANSACTION_TYPES),
    _dom("ck_reoccurring_type", "t_transaction", "reoccurring_type", S.REOCCURRING_TYPES),
    _dom("ck_image_type", "t_receipt_image", "image_format_type", S.IMAGE_FORMAT_TYPES),
    _dom("ck_review_status", "t_pending_transaction", "review_status", S.REVIEW_STATUSES),
    _dom("ck_provider_type", "t_medical_provider", "provider_type", S.PROVIDER_TYPES),
    _dom("ck_network_status", "t_medical_provider", "network_status", S.NETWORK_STATUSES),
    _dom("ck_family_relationship", "t_family_member", "relationship", S.RELATIONSHIPS),
    _dom("ck_medical_expense_claim_status", "t_medical_expense", "claim_status",
         S.CLAIM_STATUSES),
    _dom("ck_billing_cycle_weekend_shift", "t_account", "billing_cycle_weekend_shift",
         S.WEEKEND_SHIFTS),
]

LOWERCASE_RULES = [
    _low("ck_account_type_lowercase", "t_account", "account_type"),
    _low("t_account_account_name_owner_lowercase_ck", "t_account", "account_name_owner"),
    _low("ck_lowercase_username", "t_user", "username"),
    _low("ck_lowercase_role", "t_role", "role"),
    _low("ck_lowercase_category", "t_category", "category_name"),
    _low("t_description_description_lowercase_ck", "t_description", "description_name"),
    _low("t_transaction_description_lowercase_ck", "t_transaction", "description"),
    _low("t_transaction_category_lowercase_ck", "t_transaction", "category"),
    _low("t_transaction_notes_lowercase_ck", "t_transaction", "notes"),
    _low("ck_provider_name_lowercase", "t_medical_provider", "provider_name"),
    _low("ck_family_member_name_lowercase", "t_family_member", "member_name"),
    _low("ck_family_owner_lowercase", "t_family_member", "owner"),
]

FORMAT_RULES = [
    Rule("ck_provider_name_not_empty", "t_medical_provider", "not_empty", ("provider_name",)),
    Rule("ck_family_member_name_not_empty", "t_family_member", "not_empty", ("member_name",)),
    Rule("ck_family_owner_not_empty", "t_family_member", "not_empty", ("owner",)),
    Rule("ck_npi_format", "t_medical_provider", "regex", ("npi",), pattern=S.NPI_PATTERN),
    Rule("ck_zip_code_format", "t_medical_provider", "regex", ("zip_code",),
         pattern=S.ZIP_PATTERN),
    Rule("ck_ssn_last_four_format", "t_family_member", "regex", ("ssn_last_four",),
         pattern=S.SSN_LAST_FOUR_PATTERN),
    Rule("ck_phone_format", "t_medical_provider", "min_length", ("phone",), limit=S.PHONE_MIN),
    Rule("ck_insurance_member_id_length", "t_family_member", "max_length",
         ("insurance_member_id",), limit=S.MEMBER_ID_MAX),
    Rule("ck_medical_record_number_length", "t_family_member", "max_length",
         ("medical_record_number",), limit=S.MEMBER_ID_MAX),
    Rule("ck_image_size", "t_receipt_image", "max_bytes", ("image",), limit=S.IMAGE_MAX_BYTES),
    Rule("ck_token_hash_length", "t_token_blacklist", "max_length", ("token_hash",),
         limit=S.TOKEN_HASH_MAX),
]

BILLING_RULES = [
    Rule("ck_billing_statement_close_day", "t_account", "range",
         ("billing_statement_close_day",), values=(1, 31)),
    Rule("ck_billing_grace_period_days", "t_account", "range", ("billing_grace_period_days",),
         values=(1, 60)),
    Rule("ck_billing_due_day_same_month", "t_account", "range", ("billing_due_day_same_month",),
         values=(1, 31)),
    Rule("ck_billing_due_day_next_month", "t_account", "range", ("billing_due_day_next_month",),
         values=(1, 31)),
    Rule("ck_billing_due_method_exclusive", "t_account", "exclusive",
         ("billing_grace_period_days", "billing_due_day_same_month",
          "billing_due_day_next_month"), limit=1),
]

EXPENSE_RULES = [
    Rule("ck_medical_expense_financial_amounts", "t_medical_expense", "non_negative",
         ("billed_amount", "insurance_discount", "insurance_paid", "patient_responsibility")),
    Rule("ck_paid_amount_non_negative", "t_medical_expense", "non_negative", ("paid_amount",)),
    Rule("ck_medical_expense_financial_consistency", "t_medical_expense", "sum_consistency",
         ("billed_amount", "insurance_discount", "insurance_paid", "patient_responsibility")),
    Rule("ck_medical_expense_service_date_valid", "t_medical_expense", "not_future",
         ("service_date",)),
]

NUMERIC_RULES = [
    Rule("fits_transaction_amount", "t_transaction", "numeric_fits", ("amount",),
         values=(12, 2)),
    Rule("fits_transaction_amount_narrow", "t_transaction", "numeric_fits", ("amount",),
         values=(8, 2), severity="warning", note="test-dialect NUMERIC(8,2)"),
]


def _uq(name, table, *cols, severity="error"):
    return Rule(name, table, "unique", tuple(cols), severity=severity)


def _fk(name, table, cols, ref_table, ref_cols, severity="error"):
    return Rule(name, table, "foreign_key", tuple(cols), ref_table=ref_table,
                ref_columns=tuple(ref_cols), severity=severity)


PK_RULES = [_uq(f"pk_{t}", t, *cols) for t, cols in S.PRIMARY_KEY.items()]

UNIQUE_RULES = [
    _uq("t_transaction_guid_key", "t_transaction", "guid"),
    _uq("t_medical_provider_npi_key", "t_medical_provider", "npi"),
    _uq("t_user_username_key", "t_user", "username"),
    _uq("t_role_role_key", "t_role", "role"),
    _uq("uk_token_blacklist_token_hash", "t_token_blacklist", "token_hash"),
    _uq("uk_medical_expense_transaction", "t_medical_expense", "transaction_id"),
    _uq("unique_owner_account_name_owner_account_type", "t_account", "owner",
        "account_name_owner", "account_type"),
    _uq("unique_owner_account_name_owner", "t_account", "owner", "account_name_owner"),
    _uq("unique_owner_account_id_name_type", "t_account", "owner", "account_id",
        "account_name_owner", "account_type"),
    _uq("unique_owner_account_id", "t_account", "owner", "account_id"),
    _uq("unique_owner_category_name", "t_category", "owner", "category_name"),
    _uq("unique_owner_description_name", "t_description", "owner", "description_name"),
    _uq("unique_owner_transaction", "t_transaction", "owner", "account_name_owner",
        "transaction_date", "description", "category", "amount", "notes"),
    _uq("unique_owner_transaction_id", "t_transaction", "owner", "transaction_id"),
    _uq("unique_owner_payment", "t_payment", "owner", "destination_account",
        "transaction_date", "amount"),
    _uq("unique_owner_transfer", "t_transfer", "owner", "source_account",
        "destination_account", "transaction_date", "amount"),
    _uq("unique_owner_parameter_name", "t_parameter", "owner", "parameter_name"),
    _uq("unique_owner_pending_transaction", "t_pending_transaction", "owner",
        "account_name_owner", "transaction_date", "description", "amount"),
    _uq("uk_family_member_owner_name", "t_family_member", "owner", "member_name"),
    _uq("unique_owner_family_member_id", "t_family_member", "owner", "family_member_id"),
]

FK_RULES = [
    _fk("fk_account_id_account_name_owner", "t_transaction",
        ("owner", "account_id", "account_name_owner", "account_type"), "t_account",
        ("owner", "account_id", "account_name_owner", "account_type")),
    _fk("fk_category_name", "t_transaction", ("owner", "category"), "t_category",
        ("owner", "category_name")),
    _fk("fk_description_name", "t_transaction", ("owner", "description"), "t_description",
        ("owner", "description_name")),
    _fk("fk_receipt_image", "t_transaction", ("receipt_image_id",), "t_receipt_image",
        ("receipt_image_id",)),
    _fk("fk_pending_account", "t_pending_transaction", ("owner", "account_name_owner"),
        "t_account", ("owner", "account_name_owner")),
    _fk("fk_payment_source_account", "t_payment", ("owner", "source_account"), "t_account",
        ("owner", "account_name_owner")),
    _fk("fk_payment_destination_account", "t_payment", ("owner", "destination_account"),
        "t_account", ("owner", "account_name_owner")),
    _fk("fk_source_account", "t_transfer", ("owner", "source_account"), "t_account",
        ("owner", "account_name_owner")),
    _fk("fk_destination_account", "t_transfer", ("owner", "destination_account"), "t_account",
        ("owner", "account_name_owner")),
    _fk("fk_payment_guid_source", "t_payment", ("guid_source",), "t_transaction", ("guid",)),
    _fk("fk_payment_guid_destination", "t_payment", ("guid_destination",), "t_transaction",
        ("guid",)),
    _fk("fk_transfer_guid_source", "t_transfer", ("guid_source",), "t_transaction", ("guid",)),
    _fk("fk_transfer_guid_destination", "t_transfer", ("guid_destination",), "t_transaction",
        ("guid",)),
    _fk("fk_validation_account_id", "t_validation_amount", ("owner", "account_id"), "t_account",
        ("owner", "account_id")),
    _fk("fk_receipt_transaction", "t_receipt_image", ("owner", "transaction_id"),
        "t_transaction", ("owner", "transaction_id")),
    _fk("fk_medical_expense_transaction", "t_medical_expense", ("owner", "transaction_id"),
        "t_transaction", ("owner", "transaction_id")),
    _fk("fk_medical_expense_provider", "t_medical_expense", ("provider_id",),
        "t_medical_provider", ("provider_id",)),
    _fk("fk_medical_expense_family_member", "t_medical_expense", ("owner", "family_member_id"),
        "t_family_member", ("owner", "family_member_id")),
]

# Declared actions (ON UPDATE, ON DELETE) of the references; what is not declared is NO ACTION.
REFERENCE_ACTIONS = {
    "fk_account_id_account_name_owner": (CASCADE, NO_ACTION),
    "fk_category_name": (CASCADE, RESTRICT),
    "fk_description_name": (CASCADE, RESTRICT),
    "fk_receipt_image": (CASCADE, NO_ACTION),
    "fk_pending_account": (CASCADE, NO_ACTION),
    "fk_payment_source_account": (CASCADE, NO_ACTION),
    "fk_payment_destination_account": (CASCADE, NO_ACTION),
    "fk_source_account": (CASCADE, NO_ACTION),
    "fk_destination_account": (CASCADE, NO_ACTION),
    "fk_payment_guid_source": (CASCADE, NO_ACTION),
    "fk_payment_guid_destination": (CASCADE, NO_ACTION),
    "fk_transfer_guid_source": (CASCADE, NO_ACTION),
    "fk_transfer_guid_destination": (CASCADE, NO_ACTION),
    "fk_validation_account_id": (CASCADE, NO_ACTION),
    "fk_receipt_transaction": (CASCADE, NO_ACTION),
    "fk_medical_expense_transaction": (NO_ACTION, CASCADE),
    "fk_medical_expense_provider": (NO_ACTION, NO_ACTION),
    "fk_medical_expense_family_member": (CASCADE, NO_ACTION),
}
REFERENCES = tuple(Reference(r.name, r.table, r.columns, r.ref_table, r.ref_columns, *REFERENCE_ACTIONS[r.name])
                   for r in FK_RULES)

# Un-scoped uniques and references replaced by the tenant migration; still the
# rules of a single-tenant ledger.
LEGACY_RULES = [
    _uq("t_account_account_name_owner_key", "t_account", "account_name_owner"),
    _uq("unique_account_name_owner_account_type", "t_account", "account_name_owner",
        "account_type"),
    _uq("unique_account_name_owner_account_id", "t_account", "account_id",
        "account_name_owner", "account_type"),
    _uq("t_category_category_name_key", "t_category", "category_name"),
    _uq("t_description_description_name_key", "t_description", "description_name"),
    _uq("transaction_constraint", "t_transaction", "account_name_owner", "transaction_date",
        "description", "category", "amount", "notes"),
    _uq("payment_constraint", "t_payment", "account_name_owner", "transaction_date", "amount"),
    _uq("payment_constraint_destination", "t_payment", "destination_account",
        "transaction_date", "amount"),
    _uq("transfer_constraint", "t_transfer", "source_account", "destination_account",
        "transaction_date", "amount"),
    _uq("t_parameter_parameter_name_key", "t_parameter", "parameter_name"),
    _uq("unique_pending_transaction_fields", "t_pending_transaction", "account_name_owner",
        "transaction_date", "description", "amount"),
    _fk("fk_legacy_account", "t_transaction", ("account_id", "account_name_owner",
                                               "account_type"), "t_account",
        ("account_id", "account_name_owner", "account_type")),
    _fk("fk_legacy_category_name", "t_transaction", ("category",), "t_category",
        ("category_name",)),
    _fk("fk_legacy_description_name", "t_transaction", ("description",), "t_description",
        ("description_name",)),
    _fk("fk_legacy_pending_account", "t_pending_transaction", ("account_name_owner",),
        "t_account", ("account_name_owner",)),
    _fk("fk_account_name_owner", "t_payment", ("account_name_owner",), "t_account",
        ("account_name_owner",)),
    _fk("fk_legacy_payment_source_account", "t_payment", ("source_account",), "t_account",
        ("account_name_owner",)),
    _fk("fk_legacy_payment_destination_account", "t_payment", ("destination_account",),
        "t_account", ("account_name_owner",)),
    _fk("fk_legacy_source_account", "t_transfer", ("source_account",), "t_account",
        ("account_name_owner",)),
    _fk("fk_legacy_destination_account", "t_transfer", ("destination_account",), "t_account",
        ("account_name_owner",)),
    _fk("fk_legacy_validation_account_id", "t_validation_amount", ("account_id",), "t_account",
        ("account_id",)),
    _fk("fk_legacy_receipt_transaction", "t_receipt_image", ("transaction_id",),
        "t_transaction", ("transaction_id",)),
    _fk("fk_legacy_medical_expense_transaction", "t_medical_expense", ("transaction_id",),
        "t_transaction", ("transaction_id",)),
    _fk("fk_legacy_medical_expense_family_member", "t_medical_expense", ("family_member_id",),
        "t_family_member", ("family_member_id",)),
]

# Orphan counts of the backup validation: warnings, not errors.
ORPHAN_RULES = [
    _fk("orphaned_transaction_categories", "t_transaction_categories", ("transaction_id",),
        "t_transaction", ("transaction_id",), severity="warning"),
    _fk("orphaned_receipt_images", "t_receipt_image", ("transaction_id",), "t_transaction",
        ("transaction_id",), severity="warning"),
]

NOT_NULL_RULES = _nn()
ROW_RULES = (NOT_NULL_RULES + DOMAIN_RULES + LOWERCASE_RULES + FORMAT_RULES + BILLING_RULES
             + EXPENSE_RULES + NUMERIC_RULES)
ALL_RULES = ROW_RULES + PK_RULES + UNIQUE_RULES + FK_RULES
BY_NAME = {r.name: r for r in ALL_RULES + LEGACY_RULES + ORPHAN_RULES}

# Key columns used to identify offending rows in violation reports.
KEY_COLUMNS = dict(S.PRIMARY_KEY)
KEY_COLUMNS["t_medical_expense"] = ("transaction_id", "provider_id", "service_date")
KEY_COLUMNS["t_transaction_categories"] = ("category_id", "transaction_id")


def rules(*names: str) -> list[Rule]:
    return [BY_NAME[n] for n in names]


def rules_of_kind(kind: str, pool=None) -> list[Rule]:
    return [r for r in (pool or ALL_RULES + LEGACY_RULES) if r.kind == kind]


def schema_findings() -> list[tuple[str, str, str]]:
    """Contradictions inside the declared schema itself, as
    (finding, table, detail): defaults outside their own domain, and
    references whose child column allows fewer values than the parent.
    Metadata only -- reported, never "fixed"."""
    out = []
    for r in DOMAIN_RULES:
        default = S.DEFAULTS.get(r.table, {}).get(r.columns[0])
        if isinstance(default, str) and default not in r.values:
            out.append(("default_outside_domain", r.table,
                        f"{r.columns[0]} default '{default}' fails {r.name}"))
    domains = {(r.table, r.columns[0]): set(r.values) for r in DOMAIN_RULES}
    for fk in FK_RULES + LEGACY_RULES:
        if fk.kind != "foreign_key":
            continue
        for c, pc in zip(fk.columns, fk.ref_columns):
            child, parent = domains.get((fk.table, c)), domains.get((fk.ref_table, pc))
            if child is not None and parent is not None and child != parent:
                out.append(("reference_domain_mismatch", fk.table,
                            f"{fk.name}: {fk.table}.{c} allows {len(child)} values, "
                            f"{fk.ref_table}.{pc} allows {len(parent)}"))
    return sorted(set(out))


def schema_audit(spark):
    """``schema_findings`` as a DataFrame (a handful of rows)."""
    return spark.createDataFrame(schema_findings(), "finding string, table string, detail string")
