"""The ledger tables with every declared column, for the checks.

Each table is the derived table of ``fixtures`` with the remaining columns of
its schema added, in schema order.  Child tables without a tenant take it from
their parent by one left join.  Some rows break a rule on purpose (NULL tenants,
blank names, repeated keys, amounts out of range), so that every check query
has something to find.

``COLUMNS`` gives each added or changed column as an expression that reads the
same in Spark SQL and in the oracle's dialect; it is data, not logic under test.
Columns that are neither derived nor listed are the epoch where the schema asks
for a timestamp, and NULL elsewhere.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators.joins import by_rows
from . import schemas as S
from .fixtures import FIXTURE_COLUMNS, Ledger

EPOCH = "cast('1970-01-01 00:00:00' as timestamp)"
#: owners that have their own row of each category and description
NAMED_OWNERS = 4

# derived table each complete table starts from, where it has another name
BASE = {"t_account": "t_account_billing"}
# tables with one row per owner (``n``) for each derived row
PER_OWNER = ("t_description", "t_category")
# child table -> (parent, child key, parent key, parent columns); they are named p_<column>
PARENT = {
    "t_validation_amount": ("t_account", "account_id", "account_id", ("owner",)),
    "t_pending_transaction": ("t_account", "account_name_owner", "account_name_owner", ("owner",)),
    "t_transfer": ("t_account", "source_account", "account_name_owner", ("owner",)),
    "t_transaction_categories": ("t_transaction", "transaction_id", "transaction_id", ("owner",)),
    "t_receipt_image": ("t_transaction", "transaction_id", "transaction_id", ("owner",)),
    "t_medical_expense": ("t_transaction", "transaction_id", "transaction_id", ("owner", "account_id")),
}


def _owner(key: str) -> str:
    return f"case when {key} % 997 = 0 then null else coalesce(p_owner, 'owner_0') end"


COLUMNS: dict[str, dict[str, str]] = {
    "t_description": {"description_id": f"description_id * {NAMED_OWNERS} + n",
                      "owner": "concat('owner_', cast(n as string))"},
    "t_category": {"category_id": f"category_id * {NAMED_OWNERS} + n",
                   "owner": "concat('owner_', cast(n as string))"},
    "t_account": {"account_type": "case when account_id % 211 = 0 then 'Checking' else account_type end",
                  "payment_required": "true", "moniker": "'0000'", "future": "0", "outstanding": "0"},
    "t_validation_amount": {"owner": _owner("validation_id")},
    "t_parameter": {"parameter_name": "case when parameter_id % 10 = 0 then 'param_common' else parameter_name end",
                    "active_status": "true"},
    "t_transaction": {"guid": "case when transaction_id % 1501 = 0 then 'guid-0' else guid end",
                      "amount": "case when transaction_id % 1009 = 0 then 12345678901.25 else amount end"},
    "t_pending_transaction": {"owner": _owner("pending_transaction_id")},
    "t_transaction_categories": {"owner": _owner("transaction_id")},
    "t_payment": {"owner": "case when payment_id % 997 = 0 then null else owner end", "active_status": "true",
                  "guid_source": "case when payment_id % 503 = 0 then 'guid-none' else guid_source end"},
    "t_transfer": {"owner": _owner("transfer_id")},
    "t_receipt_image": {"thumbnail": "case when receipt_image_id % 19 <> 0 then image end",
                        "owner": _owner("receipt_image_id"), "active_status": "true"},
    "t_medical_provider": {"provider_name": "case when provider_id % 13 = 0 then '  ' else provider_name end",
                           "country": "'US'", "active_status": "true"},
    "t_family_member": {
        "owner": "case when family_member_id % 401 = 0 then ' ' when family_member_id % 53 = 0 then upper(owner) "
                 "else owner end",
        "member_name": "case when family_member_id % 37 = 0 then '  ' else member_name end",
        "insurance_member_id": "case when family_member_id % 50 = 0 then repeat('m', 51) "
                               "else concat('m', cast(family_member_id as string)) end",
        "medical_record_number": "case when family_member_id % 49 = 0 then repeat('r', 51) end",
        "active_status": "true"},
    "t_medical_expense": {
        "medical_expense_id": "transaction_id * 1000 + provider_id % 1000",
        "family_member_id": "case when transaction_id % 29 = 0 then null when transaction_id % 31 = 0 then -p_account_id "
                            "else p_account_id end",
        "is_out_of_network": "provider_id % 2 = 0",
        "claim_status": "case transaction_id % 7 when 0 then 'submitted' when 1 then 'processing' when 2 then 'approved' "
                        "when 3 then 'denied' when 4 then 'paid' when 5 then 'closed' else 'lost' end",
        "active_status": "true",
        "paid_amount": "case when transaction_id % 43 = 0 then -1.00 else patient_responsibility end",
        "owner": _owner("transaction_id")},
    "t_token_blacklist": {"token_hash": "case when token_blacklist_id % 997 = 0 then concat(token_hash, '0') "
                                        "when token_blacklist_id % 499 = 0 then 'repeated' else token_hash end"},
    "t_user": {"username": "case when user_id % 19 = 0 then 'shared' else username end",
               "password": "concat('pw', cast(user_id as string))", "first_name": "'first'", "last_name": "'last'"},
    "t_role": {},
}
# types wider than declared, so that values beyond the declared range can occur
WIDER = {("t_transaction", "amount"): "decimal(14,2)"}


def columns(table: str) -> list[str]:
    """Declared columns, then derived ones of older schemas."""
    declared = S.SCHEMAS[table].names
    return declared + [c for c in FIXTURE_COLUMNS[BASE.get(table, table)] if c not in declared]


def expressions(table: str) -> list[tuple[str, str, str | None]]:
    """(column, expression, Spark type or None) of a complete table."""
    derived, out = FIXTURE_COLUMNS[BASE.get(table, table)], []
    for c in columns(table):
        field = S.SCHEMAS[table][c] if c in S.SCHEMAS[table].names else None
        kind = field.dataType.simpleString() if field else None
        text = COLUMNS[table].get(c) or (c if c in derived else EPOCH if kind in ("timestamp", "timestamp_ntz")
                                         and not field.nullable else "null")
        out.append((c, text, WIDER.get((table, c), kind)))
    return out


class CompleteLedger:
    """Lazy accessor for the complete tables of a ``Ledger``; other names are its own tables."""

    def __init__(self, ledger: Ledger):
        self.ledger = ledger
        self._judged: dict[tuple, DataFrame] = {}

    @classmethod
    def of(cls, ledger: Ledger) -> "CompleteLedger":
        """The one accessor of ``ledger``."""
        if not hasattr(ledger, "_complete"):
            ledger._complete = cls(ledger)
        return ledger._complete

    @classmethod
    def once(cls, ledger: Ledger) -> "CompleteLedger":
        """The one accessor for jobs that read a few columns of each table: projections are not written for it."""
        if not hasattr(ledger, "_complete_once"):
            ledger._complete_once = cls(ledger.unclustered().once())
        return ledger._complete_once

    def __getattr__(self, name: str) -> DataFrame:
        df = getattr(self.ledger, name) if name not in COLUMNS else self._complete(name)
        setattr(self, name, df)  # planned once per accessor
        return df

    def columns_of(self, name: str) -> list[str]:
        return columns(name) if name in COLUMNS else getattr(self, name).columns

    def _start(self, name: str) -> DataFrame:
        # a table that is written below is read once, so its derivation is not written before
        return self.ledger.derived(name) if name in PARENT else getattr(self.ledger, BASE.get(name, name))

    def _joined(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with the columns its rows take from their parents."""
        parent, child_key, parent_key, taken = PARENT[name]
        p = getattr(self.ledger, parent).select(F.col(parent_key).alias("p_key"),
                                                *[F.col(c).alias(f"p_{c}") for c in taken])
        return df.join(by_rows(p), F.col(child_key) == F.col("p_key"), "left")

    def _complete(self, name: str) -> DataFrame:
        df = self._start(name)
        if name in PER_OWNER:
            df = df.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(NAMED_OWNERS - 1))))
        if name in PARENT:
            df = self._joined(name, df)
        df = df.select(*_selected(name))
        # joined tables are written once, as the derived ones are, rather than joined again by every check
        return self.ledger._store(f"complete_{name}", df) if name in PARENT and self.ledger.materialize else df

    def judged(self, name: str, keys: tuple[str, ...], rules: tuple, as_of=None) -> DataFrame | None:
        """Columns ``keys`` of a joined table and, as bits of one long, which of ``rules`` (row rules) each row
        breaks.  Rules and keys that need no parent are judged and made before the join, so that the other
        columns (images, amounts) are neither shuffled nor written.  None for a table that is not joined or
        is written already, or with more rules than a long has bits."""
        if name not in PARENT or name in self.__dict__ or len(rules) > 63:
            return None
        which = name, keys, rules, as_of
        if which not in self._judged:
            self._judged[which] = self._judge(*which)
        return self._judged[which]

    def _judge(self, name: str, keys, rules, as_of) -> DataFrame:
        start, made = self._start(name), {c: (text, kind) for c, text, kind in expressions(name)}
        late = {c for c, (text, _) in made.items() if re.search(r"\bp_", text)}
        pairs = [*enumerate(rules)]
        rest = [(i, r) for i, r in pairs if late & set(r.columns)]
        carried = [c for c in dict.fromkeys([*keys, *(c for _, r in rest for c in r.columns)]) if c not in late]
        plain = {c for c in carried if made[c][0] == c and made[c][1] in (None, start.schema[c].dataType.simpleString())}
        # derived columns that the join and the later columns are made of
        base = [c for c in start.columns if c in plain or c == PARENT[name][1]
                or any(re.search(rf"\b{c}\b", made[x][0]) for x in late)]
        # carried columns that are made of those after the join, rather than taken through it
        again = {c for c in carried if c not in plain and {x for x in start.columns if re.search(rf"\b{x}\b", made[c][0])} <= set(base)}
        taken = [c for c in carried if c not in plain | again]
        own = start.select(*[F.col(c).alias(f"b_{c}") for c in base], *_selected(name, lambda c: c not in late))
        narrow = own.select(*[F.col(f"b_{c}").alias(c) for c in base], *[F.col(c).alias(f"k_{c}") for c in taken],
                            C.broken_bits([x for x in pairs if x not in rest], as_of).alias(C.BROKEN))
        whole = self._joined(name, narrow).select(*[F.col(c) for c in plain], *[F.col(f"k_{c}").alias(c) for c in taken],
                                                  *_selected(name, lambda c: c in late | again), C.BROKEN)
        out = whole.select(*keys, F.col(C.BROKEN).bitwiseOR(C.broken_bits(rest, as_of)).alias(C.BROKEN))
        return self.ledger._store(f"judged_{name}", out) if self.ledger.materialize else out


def _selected(name: str, wanted=lambda c: True) -> list:
    return [F.expr(text).cast(kind).alias(c) if kind else F.expr(text).alias(c)
            for c, text, kind in expressions(name) if wanted(c)]
