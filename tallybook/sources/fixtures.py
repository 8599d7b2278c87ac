"""Ledger tables derived from the driver's TPC-H-style tables.

Each derivation is a column projection (plus one fact-to-dimension equi join
for ``t_transaction``), so it scales with the source tables and keeps parquet
column pruning and predicate pushdown: a report that reads three ledger
columns reads only the source columns behind them.

``Ledger(spark, sf_dir)`` hands out the derived DataFrames lazily; nothing is
computed until an action runs on a report built from them.
"""

from __future__ import annotations

import functools
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ids import sequential_ids
from ..operators.joins import by_rows
from ..session import shared_path
from .schemas import MONEY

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

# Fixed values used by the derivations (segment split of accounts).
CREDIT_SEGMENTS = ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD")


def _money(c) -> F.Column:
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def _key_name(prefix: str, key: str, width: int) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), width, "0"))


def _owner(nation_col: str) -> F.Column:
    return F.concat(F.lit("owner_"), (F.col(nation_col) % 5).cast("string"))


def _account_name(name_col: str) -> F.Column:
    return F.lower(F.replace(F.col(name_col), F.lit("#"), F.lit("_")))


# Layout of the stored tables: range-clustered and sorted on these columns
# so that scans of one account skip files and row groups (the account
# ledger).  Only where a query filters on the key: clustering costs a full
# shuffle of the table at load time.
CLUSTER_BY = {
    "t_transaction": ("account_name_owner", "transaction_date"),
}


def stored(fn):
    """Ledger table property: derived by ``fn``; when the ledger stores its
    tables, written once as parquet to the shared folder and read back."""
    @functools.wraps(fn)
    def get(self):
        df = fn(self)
        return self._store(fn.__name__, df) if self.materialize else df
    return cached_property(get)


class Ledger:
    """Lazy accessor for the derived ledger tables of one data directory.

    ``Ledger.of(spark, dir)`` returns one shared instance per session and
    directory, so the derived dimensions (whose surrogate keys are
    checkpointed to the shared checkpoint folder) are computed once per
    session rather than once per query.
    """

    _shared: dict[tuple[int, str], "Ledger"] = {}

    @staticmethod
    def _key(spark: SparkSession, sf_dir: str) -> tuple[int, str]:
        return id(getattr(spark, "_jsparkSession", None) or spark), sf_dir.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, path: str | None = None) -> "Ledger":
        """The session's stored ledger for ``sf_dir`` (tables written once), in
        a new folder of ``path``, by default under the shared checkpoint folder.
        Source files that change later are read after ``release()``."""
        key = cls._key(spark, sf_dir)
        lg = cls._shared.get(key)
        if lg is None:
            lg = cls._shared[key] = cls(spark, sf_dir, materialize=True, path=path)
        return lg

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False,
                 path: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self._cluster = True
        self._path = path
        self._base = None

    def release(self) -> None:
        """Delete the stored tables and forget them: the next ``Ledger.of``
        derives them anew from the source files."""
        self._shared.pop(self._key(self.spark, self.sf_dir), None)
        if self._base is not None:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._base)
            folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
            self._base = None

    def _folder(self) -> str:
        if self._base is None:
            name = uuid.uuid4().hex[:12]
            self._base = (f"{self._path.rstrip('/')}/{name}" if self._path
                          else shared_path(self.spark, "tallybook-ledger", name))
        return self._base

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        """Write a derived table as parquet under the shared checkpoint folder
        (clustered for the fact tables) and return the stored table: lineage
        is cut, scans keep column pruning / pushdown and split into tasks."""
        path = f"{self._folder()}/{name}"
        keys = CLUSTER_BY.get(name) if self._cluster else None
        out = df
        if keys:
            # no explicit partition count: AQE sizes the range partitions
            # (advisory partition size), so files stay large at any scale
            out = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        out.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def derived(self, name: str) -> DataFrame:
        """A table for one pass: as it is stored, or its derivation where it has not been written."""
        held = self.__dict__.get(name)
        return type(self).__dict__[name].func.__wrapped__(self) if held is None else held

    def unstored(self) -> "Ledger":
        """The tables for a job that reads a few columns or rows of each: those stored so far, the others as
        they are derived, so that its filters reach the source files."""
        other = Ledger(self.spark, self.sf_dir)
        other.__dict__.update({name: self.__dict__[name] for name in FIXTURE_COLUMNS if name in self.__dict__})
        return other

    def unclustered(self) -> "Ledger":
        """The tables for a job that reads whole columns: those stored so far, the others stored without
        clustering.  They lie in the folder of this ledger and go with it."""
        other = Ledger(self.spark, self.sf_dir, self.materialize)
        other._cluster = False
        if self.materialize:
            other._base = f"{self._folder()}/unclustered"
        other.__dict__.update({name: self.__dict__[name] for name in FIXTURE_COLUMNS if name in self.__dict__})
        return other

    def once(self) -> "_Once":
        """The tables for a job that reads each only for a few columns: projections are not written for it."""
        return _Once(self)

    # -- dimensions ---------------------------------------------------------
    @stored
    def t_account(self) -> DataFrame:
        c = self.source("customer")
        return c.select(
            F.col("c_custkey").alias("account_id"),
            _account_name("c_name").alias("account_name_owner"),
            F.when(F.col("c_mktsegment").isin(*CREDIT_SEGMENTS), "credit").otherwise("debit")
            .alias("account_type"),
            (F.col("c_acctbal") >= 0).alias("active_status"),
            _money("c_acctbal").alias("cleared"),
            _owner("c_nationkey").alias("owner"))

    @stored
    def t_account_billing(self) -> DataFrame:
        """Accounts with billing settings (the columns the backup job adds),
        some of them outside their declared ranges."""
        k = F.col("account_id")

        def short(c):
            return c.cast("short")
        return self.t_account.select(
            "*",
            F.when(k % 4 != 0, short(k % 35)).alias("billing_statement_close_day"),
            F.when(k % 3 == 0, short(k % 70)).alias("billing_grace_period_days"),
            F.when(k % 5 == 0, short(k % 33)).alias("billing_due_day_same_month"),
            F.when(k % 7 == 0, short(k % 31 + 1)).alias("billing_due_day_next_month"),
            F.when(k % 4 == 0, "back").when(k % 4 == 1, "forward")
            .when(k % 4 == 2, "back_sat_only").otherwise("sideways")
            .alias("billing_cycle_weekend_shift"))

    @stored
    def t_transaction(self) -> DataFrame:
        o = self.source("orders")
        a = self.t_account.select("account_id", "account_type", "account_name_owner", "owner")
        k = F.col("o_orderkey")
        void = (k % 2003) == 3
        description = (F.when(void, "void")
                       .when(k % 7 == 0, "payment").when(k % 7 == 1, "t-mobile.com")
                       .when(k % 7 == 2, "centerpoint  energy")
                       .otherwise(F.lower(F.col("o_orderpriority"))))
        sign = F.when(void, 0).when(k % 3 == 0, -1).otherwise(1)
        return o.join(by_rows(a), o.o_custkey == a.account_id).select(
            k.alias("transaction_id"), "account_id", "account_type", "account_name_owner",
            "owner",
            F.when(k % 4 == 0, "expense").when(k % 4 == 1, "income")
            .when(k % 4 == 2, "transfer").otherwise("undefined").alias("transaction_type"),
            F.concat(F.lit("guid-"), k.cast("string")).alias("guid"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            description.alias("description"),
            F.when(k % 7 == 0, "bill_pay")
            .otherwise(F.lower(F.substr(F.col("o_orderpriority"), F.lit(3)))).alias("category"),
            (_money("o_totalprice") * sign).cast(MONEY).alias("amount"),
            F.when(F.col("o_orderstatus") == "F", "cleared")
            .when(F.col("o_orderstatus") == "O", "outstanding").otherwise("future")
            .alias("transaction_state"),
            F.when(k % 6 == 0, "monthly").when(k % 6 == 1, "annually")
            .when(k % 6 == 2, F.lit(None).cast("string")).otherwise("undefined")
            .alias("reoccurring_type"),
            (k % 10 != 9).alias("active_status"),
            F.when(k % 11 == 0, "double  space   note").otherwise("").alias("notes"),
            F.when(k % 13 == 0, k).alias("receipt_image_id"))

    @stored
    def t_description(self) -> DataFrame:
        # names are distinct, so the numbering is a pure function of the data
        # (no checkpoint needed); the stored table then fixes it for all reads
        names = (self.t_transaction.select(F.col("description").alias("description_name"))
                 .distinct())
        return sequential_ids(names, ["description_name"], "description_id", start=1).select(
            "description_id", "description_name",
            (F.col("description_name") != "t-mobile.com").alias("active_status"))

    @stored
    def t_category(self) -> DataFrame:
        names = self.t_transaction.select(F.col("category").alias("category_name")).distinct()
        return sequential_ids(names, ["category_name"], "category_id", start=0).select(
            "category_id", "category_name", F.lit(True).alias("active_status"))

    @stored
    def t_transaction_categories(self) -> DataFrame:
        li = self.source("lineitem")
        shifted = (F.col("l_suppkey") % 7 == 0) & (F.col("l_partkey") % 31 == 0)
        return li.select(
            (F.col("l_partkey") % 8).alias("category_id"),
            (F.col("l_orderkey") + F.when(shifted, F.lit(100000000)).otherwise(F.lit(0)))
            .alias("transaction_id")).distinct()

    @stored
    def t_receipt_image(self) -> DataFrame:
        d = self.source("documents")
        k = F.col("doc_id")
        prefix = (F.when(k % 3 == 0, "data:image/jpeg;base64,")
                  .when(k % 3 == 1, "data:image/png;base64,").otherwise(""))
        return d.select(
            k.alias("receipt_image_id"), (k * 20).alias("transaction_id"),
            F.encode(F.concat(prefix, F.col("text")), "UTF-8").alias("image"),
            F.when(k % 17 == 0, "gif").when(k % 3 == 0, "jpeg").when(k % 3 == 1, "png")
            .otherwise("undefined").alias("image_format_type"))

    @stored
    def t_payment(self) -> DataFrame:
        t = self.t_transaction
        k, name = F.col("transaction_id"), F.col("account_name_owner")
        return t.select(
            k.alias("payment_id"), name.alias("account_name_owner"),
            F.when(k % 4 == 0, " ").when(k % 4 == 1, F.upper(name))
            .otherwise(F.replace(name, F.lit("_"), F.lit("-"))).alias("destination_account"),
            name.alias("source_account"), "transaction_date", "amount",
            F.col("guid").alias("guid_source"),
            F.concat(F.lit("guid-"), (k * 2).cast("string")).alias("guid_destination"),
            "owner")

    @stored
    def t_transfer(self) -> DataFrame:
        li = self.source("lineitem")
        k = F.col("l_orderkey")
        return li.select(
            k.alias("transfer_id"), _key_name("customer_", "l_suppkey", 9).alias("source_account"),
            _key_name("customer_", "l_partkey", 9).alias("destination_account"),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            _money("l_extendedprice").alias("amount"),
            F.concat(F.lit("guid-"), k.cast("string")).alias("guid_source"),
            F.concat(F.lit("guid-"), (k * 2).cast("string")).alias("guid_destination"),
            (F.col("l_returnflag") != "A").alias("active_status"))

    @stored
    def t_validation_amount(self) -> DataFrame:
        e = self.source("events")
        et = F.col("event_type")
        return e.select(
            F.col("event_id").alias("validation_id"), F.col("user_id").alias("account_id"),
            F.col("ts").alias("validation_date"),
            F.when(et == "purchase", "cleared").when(et == "signup", "future")
            .when(et == "error", "bogus").otherwise("outstanding").alias("transaction_state"),
            _money("value").alias("amount"), F.lit(True).alias("active_status"))

    @stored
    def t_pending_transaction(self) -> DataFrame:
        e = self.source("events")
        k = F.col("event_id")
        return e.select(
            k.alias("pending_transaction_id"),
            _key_name("customer_", "user_id", 9).alias("account_name_owner"),
            F.col("ts").cast("date").alias("transaction_date"),
            F.when(k % 5 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
            .alias("description"),
            _money("value").alias("amount"),
            F.when(k % 3 == 0, "pending").when(k % 3 == 1, "approved").otherwise("rejected")
            .alias("review_status"))

    @stored
    def t_medical_provider(self) -> DataFrame:
        s = self.source("supplier")
        k = F.col("s_suppkey")
        null = F.lit(None).cast("string")
        return s.select(
            k.alias("provider_id"),
            F.when(k % 6 == 0, F.col("s_name")).otherwise(_account_name("s_name"))
            .alias("provider_name"),
            F.when(k % 4 == 0, "general").when(k % 4 == 1, "pharmacy")
            .when(k % 4 == 2, "hospital").otherwise("spa").alias("provider_type"),
            F.when(k % 4 == 0, null).when(k % 9 == 0, "12345")
            .otherwise(F.lpad(k.cast("string"), 10, "0")).alias("npi"),
            F.when(k % 5 == 0, null).when(k % 5 == 1, "55401").when(k % 5 == 2, "55401-1234")
            .when(k % 5 == 3, "5540").otherwise("55401-12").alias("zip_code"),
            F.when(k % 3 == 0, null).when(k % 3 == 1, "6125550100").otherwise("555")
            .alias("phone"),
            F.when(F.col("s_acctbal") < 0, "out_of_network").otherwise("in_network")
            .alias("network_status"))

    @stored
    def t_family_member(self) -> DataFrame:
        c = self.source("customer")
        k = F.col("c_custkey")
        return c.select(
            k.alias("family_member_id"), _owner("c_nationkey").alias("owner"),
            _account_name("c_name").alias("member_name"),
            F.when(k % 5 == 0, "self").when(k % 5 == 1, "spouse").when(k % 5 == 2, "child")
            .when(k % 5 == 3, "dependent").otherwise("friend").alias("relationship"),
            F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, "12a4")
            .otherwise(F.lpad((k % 10000).cast("string"), 4, "0")).alias("ssn_last_four"))

    @stored
    def t_medical_expense(self) -> DataFrame:
        li = self.source("lineitem")
        billed = _money("l_extendedprice")
        rate = lambda c: F.col(c).cast("decimal(4,2)")
        return li.select(
            F.col("l_orderkey").alias("transaction_id"), F.col("l_suppkey").alias("provider_id"),
            F.col("l_shipdate").cast("date").alias("service_date"),
            billed.alias("billed_amount"),
            (billed * rate("l_discount")).cast(MONEY).alias("insurance_discount"),
            (billed * F.lit(0.90).cast("decimal(4,2)")).cast(MONEY).alias("insurance_paid"),
            (billed * rate("l_tax")).cast(MONEY).alias("patient_responsibility"))

    @stored
    def t_parameter(self) -> DataFrame:
        n = self.source("nation")
        return n.select(
            F.col("n_nationkey").cast("long").alias("parameter_id"),
            F.concat(F.lit("param_"), F.lower("n_name")).alias("parameter_name"),
            F.col("n_regionkey").cast("string").alias("parameter_value"),
            _owner("n_nationkey").alias("owner"))

    @stored
    def t_token_blacklist(self) -> DataFrame:
        e = self.source("events")
        return e.select(
            F.col("event_id").alias("token_blacklist_id"),
            F.sha2(F.col("event_id").cast("string"), 256).alias("token_hash"),
            (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("expires_at"))

    @stored
    def t_user(self) -> DataFrame:
        s = self.source("supplier")
        k = F.col("s_suppkey")
        return s.select(
            k.alias("user_id"),
            F.when(k % 7 == 0, F.col("s_name")).otherwise(_account_name("s_name"))
            .alias("username"),
            (F.col("s_acctbal") >= 0).alias("active_status"))

    @stored
    def t_role(self) -> DataFrame:
        r = self.source("region")
        return r.select(F.col("r_regionkey").cast("long").alias("role_id"),
                        F.lower("r_name").alias("role"), F.lit(True).alias("active_status"))


#: tables that are columns of one other table's rows, which costs less to derive than to write
PROJECTIONS = ("t_account", "t_receipt_image", "t_payment", "t_transfer", "t_validation_amount", "t_pending_transaction", "t_parameter",
               "t_account_billing", "t_medical_provider", "t_family_member", "t_token_blacklist", "t_user", "t_role")


class _Once:
    """The tables of a ledger, projections as they are derived unless they are stored already."""

    def __init__(self, ledger: Ledger):
        self._ledger = ledger

    def __getattr__(self, name: str) -> DataFrame:
        return self._ledger.derived(name) if name in PROJECTIONS else getattr(self._ledger, name)


LEDGER_TABLES = ("t_account", "t_transaction", "t_description", "t_category",
                 "t_transaction_categories", "t_receipt_image", "t_payment", "t_transfer",
                 "t_validation_amount", "t_pending_transaction", "t_medical_provider",
                 "t_family_member", "t_medical_expense", "t_parameter", "t_token_blacklist",
                 "t_user", "t_role")

# Column lists of the derived tables (kept in step with the derivations by a test).
FIXTURE_COLUMNS: dict[str, list[str]] = {
    "t_account": ["account_id", "account_name_owner", "account_type", "active_status", "cleared",
                  "owner"],
    "t_account_billing": ["account_id", "account_name_owner", "account_type", "active_status",
                          "cleared", "owner", "billing_statement_close_day",
                          "billing_grace_period_days", "billing_due_day_same_month",
                          "billing_due_day_next_month", "billing_cycle_weekend_shift"],
    "t_transaction": ["transaction_id", "account_id", "account_type", "account_name_owner",
                      "owner", "transaction_type", "guid", "transaction_date", "description",
                      "category", "amount", "transaction_state", "reoccurring_type",
                      "active_status", "notes", "receipt_image_id"],
    "t_description": ["description_id", "description_name", "active_status"],
    "t_category": ["category_id", "category_name", "active_status"],
    "t_transaction_categories": ["category_id", "transaction_id"],
    "t_receipt_image": ["receipt_image_id", "transaction_id", "image", "image_format_type"],
    "t_payment": ["payment_id", "account_name_owner", "destination_account", "source_account",
                  "transaction_date", "amount", "guid_source", "guid_destination", "owner"],
    "t_transfer": ["transfer_id", "source_account", "destination_account", "transaction_date",
                   "amount", "guid_source", "guid_destination", "active_status"],
    "t_validation_amount": ["validation_id", "account_id", "validation_date",
                            "transaction_state", "amount", "active_status"],
    "t_pending_transaction": ["pending_transaction_id", "account_name_owner",
                              "transaction_date", "description", "amount", "review_status"],
    "t_medical_provider": ["provider_id", "provider_name", "provider_type", "npi", "zip_code",
                           "phone", "network_status"],
    "t_family_member": ["family_member_id", "owner", "member_name", "relationship",
                        "ssn_last_four"],
    "t_medical_expense": ["transaction_id", "provider_id", "service_date", "billed_amount",
                          "insurance_discount", "insurance_paid", "patient_responsibility"],
    "t_parameter": ["parameter_id", "parameter_name", "parameter_value", "owner"],
    "t_token_blacklist": ["token_blacklist_id", "token_hash", "expires_at"],
    "t_user": ["user_id", "username", "active_status"],
    "t_role": ["role_id", "role", "active_status"],
}
