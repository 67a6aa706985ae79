"""One ``TableSpec`` per entity: columns, key, version order, rules and references."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

LONG, INT, STR = T.LongType(), T.IntegerType(), T.StringType()
TS, BIN = T.TimestampType(), T.BinaryType()
MONEY, PRICE = T.DecimalType(12, 2), T.DecimalType(10, 2)

LINEAGE = T.StructType([
    T.StructField("ingestion_time", TS),
    T.StructField("transaction_type", STR),
    T.StructField("connector", STR),
    T.StructField("source", STR),
    T.StructField("hash", STR),
])


@dataclass(frozen=True)
class Reference:
    """``cols`` of this table must exist as ``parent_cols`` of ``parent``.

    ``external`` marks a parent kept in another source system.
    """
    cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]
    external: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    system: str                           # source system: pos, logistic or erp
    fields: tuple[tuple[str, T.DataType], ...]
    key: tuple[str, ...]
    order_col: str = "updated_at"
    partition_col: str | None = None      # timestamp column the table is laid out by
    micros: tuple[str, ...] = ()          # timestamps that arrive as epoch microseconds
    file_fed: bool = False                # also delivered as a daily Parquet drop
    # Rules. Names follow the pattern chk_<column>[_length|_positive|_non_negative].
    not_null: tuple[str, ...] = ()
    # Demanded in one layer only: (layer, column); lineage columns among them.
    layer_not_null: tuple[tuple[str, str], ...] = ()
    non_empty: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    not_future: tuple[str, ...] = ()
    allowed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    after: tuple[tuple[str, str], ...] = ()
    dropped_rules: frozenset[str] = frozenset()
    references: tuple[Reference, ...] = ()
    # MERGE columns not taken from the source: (column, "now") or (column, "source").
    on_update: tuple[tuple[str, str], ...] = (("ingestion_time", "now"),)
    on_insert: tuple[tuple[str, str], ...] = (("ingestion_time", "now"),)

    @property
    def columns(self) -> list[str]:
        return [n for n, _ in self.fields]

    def type_of(self, column: str) -> T.DataType:
        return dict(self.fields)[column]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.fields])

    def bronze_schema(self) -> T.StructType:
        return T.StructType(self.schema().fields + LINEAGE.fields)

    def silver_schema(self) -> T.StructType:
        extra = [T.StructField(c, TS) for c, _ in self.on_insert
                 if c not in self.columns and c != "ingestion_time"]
        return T.StructType(self.schema().fields + extra
                            + [T.StructField("ingestion_time", TS), T.StructField("hash", STR)])

    def wire_type(self, column: str) -> T.DataType:
        """Type of a column inside the change message: times and decimals are text."""
        kind = self.type_of(column)
        return STR if isinstance(kind, (T.TimestampType, T.DecimalType)) else kind

    def envelope_schema(self) -> T.StructType:
        after = T.StructType([T.StructField(n, self.wire_type(n)) for n in self.columns])
        before = T.StructType([T.StructField(n, self.wire_type(n)) for n in self.key])
        source = T.StructType([T.StructField(n, STR)
                               for n in ("connector", "name", "db", "schema", "table")])
        payload = T.StructType([
            T.StructField("op", STR), T.StructField("before", before),
            T.StructField("after", after), T.StructField("source", source),
            T.StructField("ts_ms", STR),
        ])
        return T.StructType([T.StructField("payload", payload)])

    def drop_schema(self) -> T.StructType:
        """File-drop schema: text everywhere but a typed ``updated_at``."""
        return T.StructType([
            T.StructField(n, TS if n == "updated_at" else STR) for n in self.columns])

    def without(self, *rules: str) -> TableSpec:
        return replace(self, dropped_rules=self.dropped_rules | set(rules))


# The states each status column may take.
PAYMENT_STATES = ("pending", "completed", "failed")
SHIPMENT_STATES = ("pending", "in_transit", "delivered", "cancelled")
TRACKING_STATES = ("in_transit", "delivered", "cancelled")
ORDER_STATES = ("draft", "approved", "received", "cancelled")
LEDGER_SIDES = ("debit", "credit")


def _ref(col: str, parent: str, parent_col: str | None = None, external: bool = False) -> Reference:
    return Reference((col,), parent, (parent_col or col,), external)


_SPECS = [
    TableSpec(
        "customers", "pos",
        (("customer_id", STR), ("name", STR), ("email", BIN), ("phone", BIN),
         ("address", STR), ("created_at", TS), ("updated_at", TS)),
        key=("customer_id",),
        not_null=("customer_id", "name", "email", "phone", "address", "created_at", "updated_at"),
        layer_not_null=(("silver", "ingestion_time"),),
        non_empty=("customer_id", "name", "address", "email", "phone"),
        not_future=("created_at", "updated_at", "ingestion_time"),
        on_update=(("updated_at", "now"), ("ingestion_time", "source")),
        on_insert=(("ingestion_time", "source"),),
    ),
    TableSpec(
        "products", "pos",
        (("product_id", STR), ("name", STR), ("category_id", LONG),
         ("created_at", TS), ("deleted_at", TS), ("updated_at", TS)),
        key=("product_id",), file_fed=True,
        not_null=("product_id", "name", "category_id", "created_at"),
        layer_not_null=(("silver", "updated_at"), ("silver", "ingestion_time")),
        non_empty=("product_id", "name"),
        not_future=("created_at", "deleted_at", "updated_at", "ingestion_time"),
        after=(("deleted_at", "created_at"),),
        references=(_ref("category_id", "categories"),),
    ),
    TableSpec(
        "products_sku", "pos",
        (("sku_id", LONG), ("sku", STR), ("product_id", STR), ("color", STR), ("size", STR),
         ("price", PRICE), ("created_at", TS), ("deleted_at", TS), ("updated_at", TS)),
        key=("sku_id",), file_fed=True,
        # color and size may be null: their length rules and the source both allow it.
        not_null=("sku_id", "sku", "product_id", "price", "created_at"),
        non_empty=("sku", "product_id", "color", "size"),
        non_negative=("price",),
        not_future=("created_at", "deleted_at", "updated_at", "ingestion_time"),
        after=(("deleted_at", "created_at"),),
        references=(_ref("product_id", "products"),),
    ),
    TableSpec(
        "categories", "pos",
        (("category_id", LONG), ("name", STR), ("created_at", TS), ("deleted_at", TS),
         ("updated_at", TS)),
        key=("category_id",), file_fed=True,
        not_null=("category_id", "name", "created_at"),
        non_empty=("name",),
        not_future=("created_at", "deleted_at", "updated_at", "ingestion_time"),
        after=(("deleted_at", "created_at"),),
    ),
    TableSpec(
        "orders", "pos",
        (("order_id", LONG), ("customer_id", STR), ("order_date", TS), ("total_amount", MONEY),
         ("shipping_address", STR), ("payment_type_id", INT), ("payment_status", STR),
         ("updated_at", TS)),
        key=("order_id",), partition_col="order_date",
        not_null=("order_id", "customer_id", "order_date", "total_amount", "shipping_address",
                  "payment_type_id", "payment_status"),
        non_empty=("customer_id", "shipping_address", "payment_status"),
        non_negative=("total_amount", "payment_type_id"),
        not_future=("order_date", "updated_at"),
        allowed=(("payment_status", PAYMENT_STATES),),
        references=(_ref("customer_id", "customers"), _ref("payment_type_id", "payment_types")),
    ),
    TableSpec(
        "order_items", "pos",
        (("order_item_id", LONG), ("order_id", LONG), ("product_id", STR), ("sku_id", LONG),
         ("quantity", INT), ("unit_price", PRICE), ("order_date", TS), ("updated_at", TS)),
        key=("order_item_id",), partition_col="order_date",
        not_null=("order_item_id", "order_id", "product_id", "sku_id", "quantity",
                  "unit_price", "order_date"),
        non_empty=("product_id",),
        positive=("quantity", "order_id", "sku_id"),
        non_negative=("unit_price",),
        not_future=("order_date", "updated_at"),
        references=(_ref("product_id", "products"), _ref("sku_id", "products_sku"),
                    Reference(("order_id", "order_date"), "orders", ("order_id", "order_date"))),
    ),
    TableSpec(
        "payment_types", "pos",
        (("payment_type_id", INT), ("name", STR), ("updated_at", TS)),
        key=("payment_type_id",), file_fed=True,
        not_null=("payment_type_id", "name"),
        non_empty=("name",), positive=("payment_type_id",), not_future=("updated_at",),
    ),
    TableSpec(
        "warehouses", "logistic",
        (("warehouse_id", LONG), ("name", STR), ("location", STR), ("created_at", TS),
         ("deleted_at", TS), ("updated_at", TS)),
        key=("warehouse_id",), file_fed=True,
        not_null=("warehouse_id", "name", "location", "created_at"),
        non_empty=("name", "location"),
        not_future=("created_at", "deleted_at", "updated_at"),
        after=(("deleted_at", "created_at"),),
    ),
    TableSpec(
        "inventory", "logistic",
        (("inventory_id", LONG), ("warehouse_id", LONG), ("product_id", STR), ("sku_id", LONG),
         ("stock_quantity", INT), ("last_updated", TS)),
        key=("inventory_id",), order_col="last_updated", partition_col="last_updated",
        not_null=("inventory_id", "warehouse_id", "product_id", "sku_id", "stock_quantity",
                  "last_updated"),
        non_empty=("product_id",),
        positive=("inventory_id", "warehouse_id", "sku_id"),
        non_negative=("stock_quantity",),
        not_future=("last_updated", "updated_at"),
        references=(_ref("warehouse_id", "warehouses"),
                    _ref("product_id", "products", external=True),
                    _ref("sku_id", "products_sku", external=True)),
        on_update=(("updated_at", "now"), ("ingestion_time", "now")),
        on_insert=(("updated_at", "now"), ("ingestion_time", "now")),
    ),
    TableSpec(
        "shipments", "logistic",
        (("shipment_id", LONG), ("order_id", LONG), ("warehouse_id", LONG),
         ("shipment_date", TS), ("status", STR), ("updated_at", TS)),
        key=("shipment_id",), partition_col="shipment_date",
        not_null=("shipment_id", "order_id", "warehouse_id", "shipment_date", "status"),
        non_empty=("status",),
        positive=("shipment_id", "order_id", "warehouse_id"),
        not_future=("shipment_date", "updated_at"),
        allowed=(("status", SHIPMENT_STATES),),
        references=(_ref("warehouse_id", "warehouses"),
                    _ref("order_id", "orders", external=True)),
    ),
    TableSpec(
        "delivery_tracking", "logistic",
        (("tracking_id", LONG), ("shipment_id", LONG), ("shipment_date", TS),
         ("checkpoint_time", TS), ("location", STR), ("status", STR), ("updated_at", TS)),
        key=("tracking_id",), partition_col="checkpoint_time",
        not_null=("tracking_id", "shipment_id", "shipment_date", "checkpoint_time", "location",
                  "status"),
        non_empty=("location", "status"),
        positive=("tracking_id", "shipment_id"),
        not_future=("shipment_date", "checkpoint_time", "updated_at"),
        allowed=(("status", TRACKING_STATES),),
        references=(Reference(("shipment_id", "shipment_date"), "shipments",
                              ("shipment_id", "shipment_date")),),
    ),
    TableSpec(
        "employees", "erp",
        (("employee_id", STR), ("name", STR), ("email", BIN), ("department_id", LONG),
         ("hire_date", TS), ("salary", MONEY), ("deleted_at", TS), ("updated_at", TS)),
        key=("employee_id",), file_fed=True,
        not_null=("employee_id", "name", "email", "department_id", "hire_date", "salary"),
        non_empty=("employee_id", "name", "email"),
        positive=("department_id",), non_negative=("salary",),
        not_future=("hire_date", "deleted_at", "updated_at"),
        after=(("deleted_at", "hire_date"),),
        references=(_ref("department_id", "departments"),),
    ),
    TableSpec(
        "departments", "erp",
        (("department_id", LONG), ("name", STR), ("updated_at", TS)),
        key=("department_id",), file_fed=True,
        not_null=("department_id", "name"),
        non_empty=("name",), positive=("department_id",), not_future=("updated_at",),
    ),
    TableSpec(
        "suppliers", "erp",
        (("supplier_id", LONG), ("name", STR), ("contact_name", STR), ("phone", BIN),
         ("email", BIN), ("created_at", TS), ("deleted_at", TS), ("updated_at", TS)),
        key=("supplier_id",), file_fed=True,
        not_null=("supplier_id", "name", "contact_name", "phone", "email", "created_at"),
        non_empty=("name", "contact_name", "phone", "email"),
        positive=("supplier_id",),
        not_future=("created_at", "deleted_at", "updated_at"),
        after=(("deleted_at", "created_at"),),
    ),
    TableSpec(
        "accounts", "erp",
        (("account_id", LONG), ("account_name", STR), ("account_type", STR), ("updated_at", TS)),
        key=("account_id",), file_fed=True,
        not_null=("account_id", "account_name", "account_type"),
        non_empty=("account_name", "account_type"), positive=("account_id",),
        not_future=("updated_at",),
    ),
    TableSpec(
        "purchase_orders", "erp",
        (("po_id", LONG), ("supplier_id", LONG), ("order_date", TS), ("status", STR),
         ("total_amount", MONEY), ("updated_at", TS)),
        key=("po_id",), partition_col="order_date",
        not_null=("po_id", "supplier_id", "order_date", "total_amount"),
        non_empty=("status",), positive=("po_id", "supplier_id"),
        non_negative=("total_amount",), not_future=("order_date", "updated_at"),
        allowed=(("status", ORDER_STATES),),
        references=(_ref("supplier_id", "suppliers"),),
    ),
    TableSpec(
        "purchase_order_items", "erp",
        (("po_item_id", LONG), ("po_id", LONG), ("product_id", STR), ("quantity", INT),
         ("unit_price", PRICE), ("order_date", TS), ("updated_at", TS)),
        key=("po_item_id",), partition_col="order_date",
        not_null=("po_item_id", "po_id", "product_id", "quantity", "unit_price", "order_date"),
        non_empty=("product_id",), positive=("po_item_id", "po_id", "quantity"),
        non_negative=("unit_price",), not_future=("order_date", "updated_at"),
        references=(Reference(("po_id", "order_date"), "purchase_orders", ("po_id", "order_date")),
                    _ref("product_id", "products", external=True)),
    ),
    TableSpec(
        "financial_transactions", "erp",
        (("transaction_id", LONG), ("transaction_date", TS), ("account_id", LONG),
         ("amount", MONEY), ("type", STR), ("status", STR), ("updated_at", TS)),
        key=("transaction_id",), partition_col="transaction_date",
        not_null=("transaction_id", "transaction_date", "account_id", "amount"),
        non_empty=("type", "status"), positive=("transaction_id", "account_id"),
        non_negative=("amount",), not_future=("transaction_date", "updated_at"),
        allowed=(("type", LEDGER_SIDES), ("status", ORDER_STATES)),
        references=(_ref("account_id", "accounts"),),
    ),
]

_AUDIT_FIELDS = (
    ("log_id", LONG), ("log_time", TS), ("user_name", STR), ("action_type", STR),
    ("object_type", STR), ("object_name", STR), ("query", STR),
)

# Tag each audit log carries in the consolidated table.
AUDIT_SOURCES = {"pos": "Pos", "erp": "ERP", "logistic": "Logistic"}


def _audit(system: str) -> TableSpec:
    return TableSpec(
        f"audit_log_{system}", system, _AUDIT_FIELDS,
        key=("log_id",), order_col="ingestion_time", micros=("log_time",), file_fed=True,
        not_null=("log_id", "log_time", "user_name", "action_type", "object_type", "query",
                  "ingestion_time", "hash"),
        layer_not_null=tuple(("bronze", c) for c in (
            "object_name", "transaction_type", "connector", "source")),
        non_empty=("user_name", "action_type", "object_type", "object_name", "query",
                   "transaction_type", "connector", "source", "hash"),
        not_future=("log_time", "ingestion_time"),
    ).without("chk_object_name_length")


SPECS: dict[str, TableSpec] = {
    s.name: s for s in [*_SPECS, *(_audit(db) for db in AUDIT_SOURCES)]}

# The three audit logs share one current table, told apart by their source tag.
AUDIT_SILVER = replace(
    _audit("pos"), name="audit_log", key=("log_id", "origin"),
    fields=_AUDIT_FIELDS[:2] + (("origin", STR),) + _AUDIT_FIELDS[2:],
)


def spec(name: str) -> TableSpec:
    return AUDIT_SILVER if name == "audit_log" else SPECS[name]
