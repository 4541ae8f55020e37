"""Identifiers, and what the names of columns and tables say about them. Driver-side: schemas, never rows."""

from __future__ import annotations

import re
from collections.abc import Iterable

# Markers and names that the rules below look for.
PII_PATH_MARKERS = (
    "email", "phone", "mobile", "emirates_id", "emiratesid", "passport", "fullname", "full_name", "password", "token", "secret", "credential",
)
PII_BLOCKED = {
    "email", "email_address", "customer_email", "phone", "phone_number", "customer_phone", "emirates_id", "passport", "passport_number",
    "full_name", "customer_name", "name", "password", "token", "secret",
}
PII_ALLOWED = {
    "source_name", "database_name", "collection_name", "service_name", "product_name", "role_name", "permission_name", "team_name",
}
PII_COLUMN_MARKERS = (
    "phone", "mobile", "email", "iban", "accountnumber", "accountname", "idnumber", "emirates_id", "passport", "username",
    "password", "secret", "token", "credential", "firstname", "lastname", "fullname", "dateofbirth",
)
PII_TYPES = {
    "email": ("email",),
    "phone": ("phone", "mobile"),
    "emirates_id": ("emirates_id", "emiratesid"),
    "passport": ("passport",),
    "credential": ("password", "secret", "token", "credential"),
    "account": ("iban", "accountnumber", "account_number", "accountname", "account_name"),
    "username": ("username", "user_name", "login"),
    "date_of_birth": ("dateofbirth", "date_of_birth", "birthdate", "birth_date", "dob"),
    "name": ("fullname", "full_name", "firstname", "first_name", "lastname", "last_name"),
}
PII_CERTAIN = {"email", "email_address", "phone", "phone_number", "password", "token", "emirates_id", "passport"}
JSON_MARKERS = ("raw_json", "json_blob", "payload_json", "raw_payload", "document_json", "profile_json", "pii_payload")
CONFIG_MARKERS = ("userpreference", "preference", "setting", "settings", "filter", "config")
LOG_MARKERS = ("log", "event", "audit")
TRANSACTION_MARKERS = ("order", "payment", "transaction", "invoice")
REFERENCE_MARKERS = ("master", "role", "permission", "tier", "lookup", "default")
RAW_JSON_REASONS = {
    "too deeply nested": ("depth", "deep", "nested"),
    "map/config-like object": ("map", "dynamic", "config"),
    "exceeded max columns": ("limit", "max", "cap", "column"),
    "low frequency": ("low", "rare", "frequency"),
    "unsafe to explode": ("array", "explode", "unsafe"),
}
CHILD_REASONS = {
    "high-cardinality nested data": ("cardinality", "many"),
    "repeated struct": ("repeated", "struct"),
    "column explosion prevention": ("explosion", "columns"),
}


def _has(text: str, markers: Iterable[str]) -> bool:
    return any(m in text for m in markers)


def _first(text: str | None, rules: dict[str, tuple[str, ...]], default: str) -> str:
    return next((k for k, markers in rules.items() if _has(str(text or "").lower(), markers)), default)


# Identifiers

#: Fixed value: the characters that a column name of a table must not have.
INVALID = r"[ \t\n\r,;{}()=./\\`-]"


def safe_identifier(value: str, max_length: int = 128) -> str:
    """Lower case, other characters as one underscore, ``t_`` before a digit, ``unnamed`` if nothing is left."""
    name = re.sub(r"[^a-z0-9_]+", "_", str(value).lower()).strip("_") or "unnamed"
    return (f"t_{name}" if name[0].isdigit() else name)[:max_length]


def sanitize_column(value: str | None) -> tuple[str, list[str]]:
    """A column name that all layers can hold, case and other letters kept, and why it was changed.

    Runs of INVALID characters become one underscore. Then underscores in a row count as one, and an end of the name
    that had such a character loses its underscores; names that are fine keep all of theirs.
    """
    name, reasons = "" if value is None else str(value), []
    if found := re.findall(INVALID, name):
        first, last = name.startswith(found[0]), name.endswith(found[-1])
        spelled = re.sub(f"{INVALID}+", "_", name)
        single = re.sub("_+", "_", spelled)
        name = single.lstrip("_") if first else single
        name = name.rstrip("_") if last else name
        reasons += ["invalid_characters"] + ["collapsed_underscores"] * (single != spelled) + ["trimmed_underscores"] * (name != single)
    if not name:
        name, reasons = "unnamed_field", [*reasons, "empty_name"]
    if name[0].isdigit():
        name, reasons = f"col_{name}", [*reasons, "starts_with_number"]
    return name, reasons


def unique_names(names: Iterable[str], taken: Iterable[str] = ()) -> list[str]:
    """``name``, ``name_2``, ``name_3`` ...: no two equal when case is ignored, none that is taken."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        candidate, n = name, 2
        while candidate.lower() in used:
            candidate, n = f"{name}_{n}", n + 1
        used.add(candidate.lower())
        out.append(candidate)
    return out


def sanitize_columns(names: Iterable[str]) -> dict[str, str]:
    names = list(names)
    return dict(zip(names, unique_names(sanitize_column(n)[0] for n in names), strict=True))


def quote(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def slugify(value: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", value.lower()).strip("-")


def humanize(value: str) -> str:
    return " ".join(w.capitalize() for w in re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", value).replace("_", " ").split())


def clean_table_name(database: str, collection: str) -> str:
    return f"{safe_identifier(database)}__{safe_identifier(collection)}_clean"


def child_table_name(parent: str, path: str) -> str:
    return f"{parent.removesuffix('_clean')}_{safe_identifier(path.replace('.', '_'), 80)}_clean"


def view_name(table: str) -> str:
    return f"{table.removesuffix('_clean')}_analytics"


# Personal data


def is_pii_path(path: str) -> bool:
    return _has(path.lower().replace(".", "_"), PII_PATH_MARKERS)


def is_pii_column(column: str) -> bool:
    name = column.lower()
    if name.endswith("_hash") or name in PII_ALLOWED:
        return False
    return name in PII_BLOCKED or _has(name, PII_COLUMN_MARKERS) or name.endswith("_name")


def is_unsafe_json(column: str, certified: Iterable[str] = ()) -> bool:
    name = safe_identifier(column)
    return name not in {safe_identifier(c) for c in certified} and (name.endswith("_json") or _has(name, JSON_MARKERS))


def pii_type(name: str) -> str:
    flat = name.lower().replace(".", "_")
    return _first(flat, PII_TYPES, "personal_identifier" if is_pii_column(flat) else "unknown")


def pii_confidence(name: str) -> float:
    flat = name.lower().replace(".", "_")
    if pii_type(flat) == "unknown":
        return 0.7
    return 0.98 if flat in PII_CERTAIN else 0.9 if flat.endswith(("_email", "_phone", "_name")) else 0.85


def pii_rule(name: str) -> str:
    kind = pii_type(name)
    return "silver_profile_pii_flag" if kind == "unknown" else f"column_name_contains_{kind}"


def pii_protection(column: str, view_columns: list[str] | None, pii_safe: bool = True) -> str:
    """missing_safe_view, exposed, hashed or excluded: what a safe view does with a column."""
    if view_columns is None:
        return "missing_safe_view"
    have = {c.lower() for c in view_columns}
    if column.lower() in have:
        return "exposed"
    if any(c.endswith("_hash") and column.lower() in c for c in have):
        return "hashed"
    return "excluded" if pii_safe else "exposed"


# Tables


def classify_table(table: str, collection: str, paths: Iterable[str]) -> str:
    """By the order of the transformation: configuration, personal data, logs, transactions, reference data."""
    text = f"{table} {collection}".lower()
    if _has(text, CONFIG_MARKERS):
        return "dynamic_config_like"
    if any(map(is_pii_path, paths)):
        return "pii_sensitive"
    return _table_kind(text, REFERENCE_MARKERS)


def classify_table_for_audit(table: str, collection: str, columns: Iterable[str]) -> str:
    """By the order of the quality audit: personal data come last."""
    text = f"{table} {collection}".lower()
    if _has(text, CONFIG_MARKERS):
        return "dynamic_config_like"
    kind = _table_kind(text, (*REFERENCE_MARKERS, "team"))
    return "pii_sensitive" if kind == "analytics_ready" and any(map(is_pii_column, columns)) else kind


def _table_kind(text: str, reference: Iterable[str]) -> str:
    kinds = {"log_like": LOG_MARKERS, "transactional": TRANSACTION_MARKERS, "reference_data": tuple(reference)}
    return _first(text, kinds, "analytics_ready")


def bi_suitability(kind: str, readiness: float | None = None) -> str:
    """Without a readiness score: the transformation's rule; with one: the audit's."""
    limited = {"dynamic_config_like", "log_like", "low_analytics_value"}
    if readiness is None:
        if kind in {"analytics_ready", "transactional", "reference_data"}:
            return "bi_ready"
        if kind in limited or kind == "operational_reference":
            return "limited"
        return "needs_custom_transform" if kind == "requires_custom_transform" else "governed"
    if kind in limited:
        return "limited"
    return "bi_ready" if readiness >= 85 else "needs_custom_transform" if readiness < 70 else "usable_with_warnings"


def raw_json_reason(text: str | None) -> str:
    return _first(text, RAW_JSON_REASONS, "rare/dynamic field")


def child_reason(text: str | None) -> str:
    return _first(text, CHILD_REASONS, "array of objects")


def raw_json_impact(reason: str) -> str:
    if reason in {"too deeply nested", "exceeded max columns", "unsafe to explode"}:
        return "custom_transform_recommended"
    return "limited_filtering" if reason == "map/config-like object" else "minor"


def failure_kind(message: str) -> tuple[str, str]:
    """(kind, recommended action) of a failed batch, by its message."""
    text = message.lower()
    if _has(text, ("sparkcontext was shut down", "connection refused", "py4jnetwork", "jvm")):
        return "jvm_crash", "restart the session and retry"
    if _has(text, ("_delta_log", "corrupt", "checksum", "is not a parquet file", "malformed")):
        return "corrupt_data", "restore or rebuild the files, then retry"
    if _has(text, ("analysisexception", "unresolved_column", "cannot resolve", "datatype mismatch", "table_or_view_not_found")):
        return "analysis_error", "review the schema change, then retry"
    if _has(text, ("timed out", "timeout", "unreachable", "no route")):
        return "source_unreachable", "check network and source, then retry"
    if _has(text, ("auth", "denied", "forbidden", "credential")):
        return "access_denied", "check the credentials, then retry"
    return "unknown", "inspect the log"
