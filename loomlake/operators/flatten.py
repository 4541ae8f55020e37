"""Nested documents to flat tables: schema walk, flatten plan, child tables, typed domain tables."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions import columns as C
from loomlake.functions.names import child_table_name, is_pii_path, quote, safe_identifier, unique_names

DEPTH, MAX_COLUMNS, MAX_CHILDREN, MAX_PROFILED = 4, 250, 30, 120
# The audit columns of bronze tables, and which of them clean tables keep under other names.
AUDIT_COLUMNS = (
    "_bronze_ingested_at", "_raw_bucket", "_raw_object_key", "_source_id", "_source_name", "_source_db", "_source_collection",
    "_raw_run_id", "_raw_file_id", "_schema_version", "_record_hash", "_column_sanitized", "_column_mapping_version", "bronze_ingestion_date",
)
LINEAGE = {
    "source_id": "_source_id", "source_name": "_source_name", "source_database": "_source_db", "source_collection": "_source_collection",
    "raw_run_id": "_raw_run_id", "raw_file_id": "_raw_file_id", "raw_object_key": "_raw_object_key", "bronze_record_hash": "_record_hash",
    "bronze_ingested_at": "_bronze_ingested_at",
}


@dataclass
class Field:
    path: str
    kind: T.DataType
    depth: int

    @property
    def column(self) -> str:
        return ".".join(quote(p) for p in self.path.split("."))


@dataclass
class FlattenPlan:
    """What becomes of each field. columns: output name -> (path, treatment)."""

    columns: dict[str, tuple[str, str]] = field(default_factory=dict)
    children: dict[str, str] = field(default_factory=dict)
    raw_json: dict[str, str] = field(default_factory=dict)
    pii: list[str] = field(default_factory=list)

    @property
    def complexity(self) -> float:
        return min(100.0, 8 * len(self.raw_json) + 3 * len(self.children) + 0.5 * max(0, len(self.columns) - 80))

    def readiness(self, config_like: bool = False) -> float:
        score = 100 - 4 * len(self.raw_json) - 0.2 * max(0, len(self.columns) - 200)
        return max(70.0 if config_like else 0.0, min(100.0, score))

    def as_dict(self) -> dict:
        return asdict(self) | {"complexity": self.complexity, "readiness": self.readiness()}


def walk_schema(schema: T.StructType, depth: int = DEPTH) -> list[Field]:
    """All fields through structs, not into arrays; audit columns of the root are left out."""
    out: list[Field] = []

    def visit(struct: T.StructType, prefix: str, level: int) -> None:
        for f in struct.fields:
            if not prefix and f.name in AUDIT_COLUMNS:
                continue
            path = f"{prefix}.{f.name}" if prefix else f.name
            out.append(Field(path, f.dataType, level))
            if isinstance(f.dataType, T.StructType) and level < depth:
                visit(f.dataType, path, level + 1)

    visit(schema, "", 1)
    return out


def plan_flatten(schema: T.StructType, table: str = "table_clean", depth: int = DEPTH, max_columns: int = MAX_COLUMNS, reserved: tuple[str, ...] = ()) -> FlattenPlan:
    """Structs are opened down to ``depth``; arrays give a count and a child table, maps and whatever is too deep or too
    much give JSON. Names are unique regardless of case and never those in ``reserved``."""
    plan = FlattenPlan()
    wanted: list[tuple[str, str, str]] = []

    def visit(struct: T.StructType, prefix: str, level: int) -> None:
        for f in struct.fields:
            if not prefix and f.name in AUDIT_COLUMNS:
                continue
            path = f"{prefix}.{f.name}" if prefix else f.name
            name = safe_identifier(path.replace(".", "_"), 80)
            if is_pii_path(path):
                plan.pii.append(path)
            if len(wanted) >= max_columns:
                plan.raw_json[path] = "column limit"
                wanted.append((f"{name}_raw_json", path, "json"))
            elif isinstance(f.dataType, T.StructType):
                if level < depth:
                    visit(f.dataType, path, level + 1)
                else:
                    plan.raw_json[path] = "depth limit"
                    wanted.append((f"{name}_raw_json", path, "json"))
            elif isinstance(f.dataType, T.ArrayType):
                if len(plan.children) < MAX_CHILDREN:
                    plan.children[path] = child_table_name(table, path)
                    wanted.append((f"{name}_count", path, "count"))
                else:
                    plan.raw_json[path] = "unsafe to explode: child table limit"
                    wanted.append((f"{name}_raw_json", path, "json"))
            elif isinstance(f.dataType, T.MapType):
                plan.raw_json[path] = "map"
                wanted.append((f"{name}_raw_json", path, "json"))
            else:
                wanted.append((name, path, "scalar"))

    visit(schema, "", 1)
    names = unique_names([n for n, _, _ in wanted], reserved)
    plan.columns = {n: (path, how) for n, (_, path, how) in zip(names, wanted, strict=True)}
    return plan


def flatten(df: DataFrame, plan: FlattenPlan | None = None) -> DataFrame:
    """The flat columns of a plan, normalised by name and type, in one projection."""
    plan = plan or plan_flatten(df.schema)
    kinds = {f.path: f for f in walk_schema(df.schema, depth=32)}
    out: list[Column] = []
    for name, (path, how) in plan.columns.items():
        f = kinds[path]
        c = F.col(f.column)
        if how == "count":
            c = F.size(c).cast("int")
        elif how == "json":
            c = as_json(c, f.kind)
        else:
            c = C.normalised(c, f.kind, path.replace(".", "_"))
        out.append(c.alias(name))
    return df.select(*out)


def as_json(c: Column, kind: T.DataType) -> Column:
    """Nested values as JSON, others as text."""
    return F.to_json(c) if isinstance(kind, T.StructType | T.ArrayType | T.MapType) else c.cast("string")


def row_id(df: DataFrame, key: str = "record_hash") -> Column:
    """The key of a row: its record hash (a changed document is a new row) or its _id (it replaces the old one); where
    there is neither, the hash of the business columns."""
    wanted = ("_record_hash", "_id") if key == "record_hash" else ("_id", "_record_hash")
    for name in wanted:
        if C.field_of(df.schema, name):
            return C.optional(df, name)
    return C.record_hash(df, AUDIT_COLUMNS)


def with_audit(df: DataFrame, flat: DataFrame) -> DataFrame:
    """``flat`` with hash of all its columns, time and date of processing."""
    return flat.withColumns(
        {
            "silver_record_hash": C.stable_hash(*[F.col(quote(c)) for c in flat.columns]),
            "silver_processed_at": F.current_timestamp(),
            "silver_ingestion_date": F.current_date(),
        }
    )


def lineage_columns(df: DataFrame) -> list[Column]:
    return [C.optional(df, source, "timestamp" if source.endswith("_at") else "string").alias(name) for name, source in LINEAGE.items()]


def clean_table(df: DataFrame, table: str, key: str = "record_hash") -> DataFrame:
    """A document table as a flat one with row id, lineage and audit columns."""
    reserved = (*LINEAGE, "silver_row_id", "silver_record_hash", "silver_processed_at", "silver_ingestion_date")
    plan = plan_flatten(df.schema, table, reserved=reserved)
    kinds = {f.path: f for f in walk_schema(df.schema, depth=32)}
    tagged = df.select(row_id(df, key).alias("silver_row_id"), *lineage_columns(df), *[F.col(quote(c)).alias(c) for c in df.columns if c not in AUDIT_COLUMNS])
    flat = [
        (F.size(F.col(kinds[p].column)).cast("int") if how == "count" else as_json(F.col(kinds[p].column), kinds[p].kind) if how == "json"
         else C.normalised(F.col(kinds[p].column), kinds[p].kind, p.replace(".", "_"))).alias(n)
        for n, (p, how) in plan.columns.items()
    ]
    return with_audit(df, tagged.select("silver_row_id", *LINEAGE, *flat))


def child_table(df: DataFrame, path: str, parent_id: Column, parent_table: str = "table_clean") -> DataFrame:
    """One row per element of the array at ``path``: ids of parent and child, index, lineage, the element's columns.

    Null and empty arrays give no rows; null elements are left out.
    """
    f = next(x for x in walk_schema(df.schema, depth=32) if x.path == path)
    base = df.select(parent_id.cast("string").alias("parent_record_id"), C.optional(df, "_record_hash").alias("parent_record_hash"),
                     C.optional(df, "_source_db").alias("source_db"), C.optional(df, "_source_collection").alias("source_collection"), F.posexplode(F.col(f.column)).alias("child_index", "_element"))
    base = base.filter(F.col("_element").isNotNull())
    element = f.kind.elementType
    if isinstance(element, T.StructType):
        inner = base.select("_element.*")
        plan = plan_flatten(inner.schema, reserved=("child_record_id", "parent_record_id", "parent_record_hash", "child_index"))
        kinds = {x.path: x for x in walk_schema(inner.schema, depth=32)}
        values = [_child_value(how, f"_element.{kinds[p].column}", kinds[p].kind, p).alias(n) for n, (p, how) in plan.columns.items()]
    else:
        values = [F.col("_element").cast("string").alias("value")]
    return base.select(
        C.stable_hash(F.col("parent_record_id"), F.lit(path), F.col("child_index"), F.to_json(F.struct("_element"))).alias("child_record_id"),
        "parent_record_id", "parent_record_hash", "source_db", "source_collection",
        F.lit(parent_table).alias("source_table"), F.lit(path).alias("child_path"), "child_index", *values,
    )


def _child_value(how: str, column: str, kind: T.DataType, path: str) -> Column:
    c = F.col(column)
    if how == "count":
        return F.size(c).cast("int")
    return as_json(c, kind) if how == "json" else C.normalised(c, kind, path.replace(".", "_"))


def child_tables(df: DataFrame, parent_id: Column, parent_table: str, most: int = 40) -> dict[str, DataFrame]:
    """All child tables of a plan, at most ``most`` in a run."""
    plan = plan_flatten(df.schema, parent_table)
    return {name: child_table(df, path, parent_id, parent_table) for path, name in list(plan.children.items())[:most]}


# Typed tables of known collections. Missing fields are null.


def users(df: DataFrame) -> DataFrame:
    return df.select(
        C.optional(df, "_id").alias("user_id"), C.trimmed(C.optional(df, "name")).alias("full_name"), F.lower(C.trimmed(C.optional(df, "email"))).alias("email"),
        C.trimmed(C.optional(df, "phone")).alias("phone"), C.upper_code(C.optional(df, "country")).alias("country_code"),
        C.country_name(C.optional(df, "country")).alias("country_name"), C.enum_text(C.at_path(df, "preferences.theme")).alias("preferred_theme"),
        C.at_path(df, "preferences.notifications.email", "boolean").alias("email_notifications_enabled"),
        C.at_path(df, "preferences.notifications.sms", "boolean").alias("sms_notifications_enabled"),
        C.at_path(df, "preferences.newsletter", "boolean").alias("newsletter_enabled"), C.array_csv(df, "preferences.segments").alias("segments"),
        C.array_csv(df, "preferences.preferredCategories").alias("preferred_categories"), C.optional(df, "marketingConsent", "boolean").alias("marketing_consent"),
        F.try_to_timestamp(C.optional(df, "createdAt")).alias("created_at"), F.try_to_timestamp(C.optional(df, "updatedAt")).alias("updated_at"),
    )


def orders(df: DataFrame) -> DataFrame:
    items = C.field_of(df.schema, "items")
    array = isinstance(items.dataType, T.ArrayType) if items else False
    total = F.aggregate(F.col(items.name), F.lit(0), lambda acc, x: acc + F.coalesce(x["qty"].try_cast("int"), F.lit(0))) if array else F.lit(None).cast("int")
    return df.select(
        C.optional(df, "_id").alias("order_id"), C.optional(df, "customerId").alias("customer_id"), C.enum_text(C.optional(df, "status")).alias("order_status"),
        C.optional(df, "totalAmount", "decimal(18,2)").alias("total_amount"), C.upper_code(C.optional(df, "currency")).alias("currency_code"),
        (F.size(items.name).cast("int") if array else F.lit(None).cast("int")).alias("item_count"), total.alias("total_quantity"),
        C.optional(df, "customerEmail").alias("customer_email"), C.optional(df, "customerPhone").alias("customer_phone"),
        C.enum_text(C.at_path(df, "extraFields.channel")).alias("channel"), C.at_path(df, "extraFields.giftWrap", "boolean").alias("gift_wrap"),
        C.at_path(df, "extraFields.checkoutExperiment").alias("checkout_experiment"), C.enum_text(C.at_path(df, "extraFields.priority")).alias("priority"),
        C.optional(df, "promoCode").alias("promo_code"), F.try_to_timestamp(C.optional(df, "createdAt")).alias("created_at"),
        F.try_to_timestamp(C.optional(df, "updatedAt")).alias("updated_at"),
    )


def order_items(df: DataFrame) -> DataFrame:
    """Items without a sku are left out."""
    rows = df.select(C.optional(df, "_id").alias("order_id"), F.posexplode_outer("items").alias("item_index", "_item"))
    sku = F.trim(F.col("_item.sku"))
    found = rows.select("order_id", "item_index", sku.alias("sku"), F.col("_item.qty").try_cast("int").alias("quantity")).filter("sku IS NOT NULL")
    return found.select(C.stable_hash(F.col("order_id"), F.col("item_index"), F.col("sku")).alias("order_item_key"), "order_id", "item_index", "sku", "quantity")


def products(df: DataFrame) -> DataFrame:
    nested = {"color": "string", "material": "string", "dimensions.w": "bigint", "dimensions.h": "bigint", "lumens": "bigint", "smart": "boolean", "capacityMl": "bigint", "insulated": "boolean"}
    return df.select(
        C.optional(df, "_id").alias("product_id"), C.trimmed(C.optional(df, "sku")).alias("sku"), C.trimmed(C.optional(df, "name")).alias("product_name"),
        C.enum_text(C.optional(df, "category")).alias("category"), C.optional(df, "price", "decimal(18,2)").alias("price"),
        *[C.at_path(df, f"attributes.{p}", k).alias(safe_identifier("attribute_" + p.replace(".", "_"))) for p, k in nested.items()],
        C.array_csv(df, "attributes.compatibility").alias("compatibility"), C.array_csv(df, "attributes.tags").alias("tags"),
        C.at_path(df, "supplierMetadata.supplierId").alias("supplier_id"), C.at_path(df, "supplierMetadata.contractTier").alias("contract_tier"),
        F.try_to_timestamp(C.optional(df, "createdAt")).alias("created_at"), F.try_to_timestamp(C.optional(df, "updatedAt")).alias("updated_at"),
    )


def payments(df: DataFrame) -> DataFrame:
    gateway = {"avs": "string", "riskScore": "int", "processor": "string", "payerCountry": "string", "fraudCheck": "string", "deviceAccount": "string", "network": "string"}
    return df.select(
        C.optional(df, "_id").alias("payment_id"), C.optional(df, "orderId").alias("order_id"), C.enum_text(C.optional(df, "method")).alias("payment_method"),
        C.optional(df, "amount", "decimal(18,2)").alias("amount"), C.enum_text(C.optional(df, "status")).alias("payment_status"),
        C.optional(df, "providerRef").alias("provider_ref"), *[C.at_path(df, f"gatewayResponse.{p}", k).alias(f"gateway_{safe_identifier(p)}") for p, k in gateway.items()],
        F.try_to_timestamp(C.optional(df, "createdAt")).alias("created_at"), F.try_to_timestamp(C.optional(df, "updatedAt")).alias("updated_at"),
    )


#: Collections with a typed table; all others are flattened by schema.
DOMAIN = {"users": users, "orders": orders, "order_items": order_items, "products": products, "payments": payments}


def transform(df: DataFrame, collection: str, table: str) -> DataFrame:
    return with_audit(df, DOMAIN[collection](df)) if collection in DOMAIN else clean_table(df, table)
