"""Registered queries of changes and deletes carried through the references.

Each statement is run once per ledger; its queries read one changed table each,
or what refuses it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import functions as F

from ..operators import cascade as C
from ..sources import schemas as S
from ..sources.complete import CompleteLedger
from .catalog import REFERENCES
from .registry import register

#: tables that the references join
_TABLES = sorted({t for r in REFERENCES for t in (r.child, r.parent)})


class _Tables(Mapping):
    """The complete tables, each made when it is first read: a statement reaches only some of them."""

    def __init__(self, full):
        self.full = full

    def __getitem__(self, name):
        if name not in _TABLES:
            raise KeyError(name)
        return getattr(self.full, name)

    def __iter__(self):
        return iter(_TABLES)

    def __len__(self):
        return len(_TABLES)


def _run(lg, name, statement):
    """The outcome of a statement on the complete tables, kept with the ledger."""
    held = lg.__dict__.setdefault("_cascades", {})
    if name not in held:
        # a statement follows keys and reads whole at most the table it is asked for, so no joined table is written
        held[name] = statement(_Tables(CompleteLedger.of(lg.unstored())))
    return held[name]


def _rename(tables):
    """Accounts of one tenant get another name and type: a key of four columns."""
    new = tables["t_account"].where(F.col("owner") == "owner_1").select(
        "account_id", F.concat("account_name_owner", F.lit("_moved")).alias("new_account_name_owner"),
        F.lit("cash").alias("new_account_type"))
    return C.update_keys(tables, REFERENCES, {"t_account": new}, S.PRIMARY_KEY)


def _hand_over(tables):
    """A third of one tenant's accounts go to a new tenant, and so do their transactions' receipts, two levels down."""
    new = tables["t_account"].where((F.col("owner") == "owner_2") & (F.col("account_id") % 3 == 0)).select(
        "account_id", F.lit("owner_9").alias("new_owner"))
    return C.update_keys(tables, REFERENCES, {"t_account": new}, S.PRIMARY_KEY)


def _delete_tree(tables):
    """Accounts with everything that refers to them, whatever the declared actions are."""
    gone = tables["t_account"].where((F.col("owner") == "owner_3") & (F.col("account_id") % 5 == 0))
    return C.delete_rows(tables, C.with_actions(REFERENCES, on_delete=C.CASCADE), {"t_account": gone}, S.PRIMARY_KEY)


def _delete_declared(tables):
    """Void transactions by the declared actions: medical expenses follow, other references refuse."""
    return C.delete_rows(tables, REFERENCES, {"t_transaction": tables["t_transaction"].where("description = 'void'")},
                         S.PRIMARY_KEY)


def _delete_restricted(tables):
    """Categories and descriptions of a tenant that transactions still use."""
    return C.delete_rows(tables, REFERENCES, {t: tables[t].where("owner = 'owner_0'") for t in ("t_category", "t_description")},
                         S.PRIMARY_KEY)


# accounts (owner, id, name, type) that change, one row each
_MOVED = """moved as (select owner, account_id as id, account_name_owner as name, account_type as kind from full_t_account
 where owner = 'owner_1')"""


def _renamed(table: str, *columns: str) -> str:
    """A table whose name columns refer to (owner, name) of an account."""
    new = ", ".join(f"case when exists (select 1 from moved m where m.owner = x.owner and m.name = x.{c}) "
                    f"then x.{c} || '_moved' else x.{c} end as {c}" for c in columns)
    return f"with {_MOVED} select x.* replace ({new}) from full_{table} x"


for _name, _table, _sql in (
    ("account", "t_account", """select x.* replace (case when owner = 'owner_1' then account_name_owner || '_moved' else account_name_owner
 end as account_name_owner, case when owner = 'owner_1' then 'cash' else account_type end as account_type) from full_t_account x"""),
    ("transaction", "t_transaction", f"""with {_MOVED} select x.* replace (coalesce(m.name || '_moved', x.account_name_owner)
 as account_name_owner, case when m.name is null then x.account_type else 'cash' end as account_type) from full_t_transaction x
 left join moved m on m.owner = x.owner and m.id = x.account_id and m.name = x.account_name_owner and m.kind = x.account_type"""),
    ("pending_transaction", "t_pending_transaction", _renamed("t_pending_transaction", "account_name_owner")),
    ("payment", "t_payment", _renamed("t_payment", "source_account", "destination_account")),
    ("transfer", "t_transfer", _renamed("t_transfer", "source_account", "destination_account")),
):
    register(f"cascade_rename_{_name}", _sql)(lambda lg, t=_table: _run(lg, "rename", _rename).tables[t])

# accounts that go to the new tenant, and what has gone with them
_HANDED = """handed as (select account_id as id, account_name_owner as name, account_type as kind from full_t_account
 where owner = 'owner_2' and account_id % 3 = 0),
 gone as (select x.transaction_id as id from full_t_transaction x join handed h on x.owner = 'owner_2' and h.id = x.account_id
  and h.name = x.account_name_owner and h.kind = x.account_type)"""


def _moved_owner(table: str, condition: str) -> str:
    return (f"with {_HANDED} select x.* replace (case when x.owner = 'owner_2' and ({condition}) then 'owner_9' else x.owner end as owner) "
            f"from full_{table} x")


def _by_names(*columns: str) -> str:
    return " or ".join(f"x.{c} in (select name from handed)" for c in columns)


for _name, _condition in (
    ("account", "x.account_id in (select id from handed)"), ("transaction", "x.transaction_id in (select id from gone)"),
    ("validation_amount", "x.account_id in (select id from handed)"), ("receipt_image", "x.transaction_id in (select id from gone)"),
    ("pending_transaction", _by_names("account_name_owner")), ("payment", _by_names("source_account", "destination_account")),
    ("transfer", _by_names("source_account", "destination_account")),
):
    register(f"cascade_owner_{_name}", _moved_owner(f"t_{_name}", _condition))(
        lambda lg, t=f"t_{_name}": _run(lg, "hand_over", _hand_over).tables[t])


def _no_parent(name: str, table: str, rows: str, column: str, parent: str) -> str:
    """Rows that have come to the new tenant and whose other reference has no parent there."""
    return (f"select '{name}' as reference, '{table}' as table, 'no parent' as event, 'owner_9|' || x.{column} as key, "
            f"count(*) as blocking_rows from full_{table} x where x.owner = 'owner_2' and ({rows}) and x.{column} is not null "
            f"and {parent} group by x.{column}")


_OUTSIDE = "x.{0} not in (select name from handed)"
register("cascade_owner_blocked", f"with {_HANDED} " + " union all ".join([
    _no_parent("fk_category_name", "t_transaction", "x.transaction_id in (select id from gone)", "category", "true"),
    _no_parent("fk_description_name", "t_transaction", "x.transaction_id in (select id from gone)", "description", "true"),
    *[_no_parent(n, t, _by_names("source_account", "destination_account"), c, _OUTSIDE.format(c)) for n, t, c in (
        ("fk_payment_source_account", "t_payment", "source_account"),
        ("fk_payment_destination_account", "t_payment", "destination_account"),
        ("fk_source_account", "t_transfer", "source_account"), ("fk_destination_account", "t_transfer", "destination_account"))],
    """select 'fk_medical_expense_transaction', 't_medical_expense', 'update', 'owner_2|' || transaction_id, count(*)
 from full_t_medical_expense where owner = 'owner_2' and transaction_id in (select id from gone) group by transaction_id""",
]))(lambda lg: _run(lg, "hand_over", _hand_over).blocked)

# one edge for every row that refers to another one, by the name of its table and its key
_ROWS = {"t_account": "account_id", "t_transaction": "transaction_id", "t_pending_transaction": "pending_transaction_id",
         "t_payment": "payment_id", "t_receipt_image": "receipt_image_id", "t_validation_amount": "validation_id",
         # ids of these repeat in the given tables
         "t_transfer": "concat_ws('/', {0}transfer_id, {0}source_account, {0}destination_account, {0}owner)",
         "t_medical_expense": "concat_ws('/', {0}medical_expense_id, {0}transaction_id, {0}provider_id, {0}owner)"}


def _row(table: str, of: str = "") -> str:
    name = _ROWS[table]
    return f"'{table}' || " + (name.format(of) if "{0}" in name else of + name)


def _edge(parent: str, child: str, on: str) -> str:
    return f"select {_row(parent, 'p.')} as up, {_row(child, 'c.')} as down from full_{parent} p join full_{child} c on {on}"


_EDGES = " union all ".join([
    _edge("t_account", "t_transaction", "p.owner = c.owner and p.account_id = c.account_id and "
          "p.account_name_owner = c.account_name_owner and p.account_type = c.account_type"),
    _edge("t_account", "t_validation_amount", "p.owner = c.owner and p.account_id = c.account_id"),
    *[_edge("t_account", t, f"p.owner = c.owner and p.account_name_owner = c.{c}") for t, c in (
        ("t_pending_transaction", "account_name_owner"), ("t_payment", "source_account"), ("t_payment", "destination_account"),
        ("t_transfer", "source_account"), ("t_transfer", "destination_account"))],
    *[_edge("t_transaction", t, f"p.guid = c.{c}") for t in ("t_payment", "t_transfer") for c in ("guid_source", "guid_destination")],
    *[_edge("t_transaction", t, "p.owner = c.owner and p.transaction_id = c.transaction_id")
      for t in ("t_receipt_image", "t_medical_expense")],
    _edge("t_receipt_image", "t_transaction", "p.receipt_image_id = c.receipt_image_id"),
])
_REACHED = f"""with recursive edge as ({_EDGES}), reached(place) as (
 select 't_account' || account_id from full_t_account where owner = 'owner_3' and account_id % 5 = 0
 union select e.down from reached r join edge e on e.up = r.place)"""

for _table in _ROWS:
    # the fixtures' common table expressions come first, so the recursive ones are a subquery of their own
    register(f"cascade_delete_{_table[2:]}",
             f"select * from full_{_table} where {_row(_table)} not in ({_REACHED} select place from reached)")(
        lambda lg, t=_table: _run(lg, "delete_tree", _delete_tree).tables[t])

_VOID = "(select {0} from full_t_transaction where description = 'void')"
register("cascade_delete_declared", f"""
select x.* from full_t_medical_expense x where not exists (select 1 from full_t_transaction t where t.description = 'void'
 and t.owner = x.owner and t.transaction_id = x.transaction_id)""")(
    lambda lg: _run(lg, "declared", _delete_declared).tables["t_medical_expense"])
register("cascade_delete_blocked", " union all ".join([
    f"select '{n}' as reference, '{t}' as table, 'delete' as event, {c} as key, count(*) as blocking_rows from full_{t} "
    f"where {c} in {_VOID.format('guid')} and {c} not in (select guid from full_t_transaction where guid is not null and "
    f"(description is null or description <> 'void')) group by {c}"
    for n, t, c in (("fk_payment_guid_source", "t_payment", "guid_source"), ("fk_payment_guid_destination", "t_payment", "guid_destination"),
                    ("fk_transfer_guid_source", "t_transfer", "guid_source"),
                    ("fk_transfer_guid_destination", "t_transfer", "guid_destination"))]
    + ["""select 'fk_receipt_transaction', 't_receipt_image', 'delete', x.owner || '|' || x.transaction_id, count(*)
 from full_t_receipt_image x join full_t_transaction t on t.description = 'void' and t.owner = x.owner
 and t.transaction_id = x.transaction_id group by x.owner, x.transaction_id"""]))(
    lambda lg: _run(lg, "declared", _delete_declared).blocked)
register("restrict_delete_graph", " union all ".join(
    f"select '{n}' as reference, 't_transaction' as table, 'delete' as event, 'owner_0|' || {c} as key, count(*) as blocking_rows "
    f"from full_t_transaction where owner = 'owner_0' and {c} in (select {p} from full_{t} where owner = 'owner_0') group by {c}"
    for n, c, t, p in (("fk_category_name", "category", "t_category", "category_name"),
                       ("fk_description_name", "description", "t_description", "description_name"))))(
    lambda lg: _run(lg, "restricted", _delete_restricted).blocked)
