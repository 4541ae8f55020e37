"""Log lines as JSON, and secrets out of values: by the name of a field, or by what a text looks like."""

from __future__ import annotations

import json
import logging
import re
import traceback
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.columns import masked
from loomlake.functions.names import quote

# A field whose name contains one of these is a secret.
SECRET_FIELDS = ("password", "secret", "token", "api_key", "access_key", "secret_key", "mongo_uri", "key_hash")
_URI, _PAIR = re.compile(r"://[^/@\s:]+:[^/@\s]+@"), re.compile(r"\b(password|passwd|secret|token|api_key|access_key)\s*[=:]\s*[^\s,;&]+", re.I)


def is_secret(name: str) -> bool:
    return any(s in name.lower() for s in SECRET_FIELDS)


def mask_text(text: str) -> str:
    return _PAIR.sub(r"\1=***", _URI.sub("://***:***@", text))


def mask_payload(value: object) -> object:
    """Nested values with secrets as ***."""
    if isinstance(value, dict):
        return {k: "***" if is_secret(str(k)) else mask_payload(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [mask_payload(v) for v in value]
    return mask_text(value) if isinstance(value, str) else value


def masked_fields(df: DataFrame) -> DataFrame:
    """``df`` with the values of columns named like secrets as ***, and secrets within other texts masked; nulls stay."""
    out = []
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        if is_secret(f.name):
            c = F.when(c.isNotNull(), F.lit("***"))
        elif isinstance(f.dataType, T.StringType):
            c = masked(c)
        out.append(c.alias(f.name))
    return df.select(*out)


class JsonFormatter(logging.Formatter):
    """A line of JSON: timestamp, service, level, operation, message; layer, duration and status where they are given."""

    def __init__(self, service: str):
        super().__init__()
        self.service = service

    def format(self, record: logging.LogRecord) -> str:
        out = {
            "timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(timespec="seconds"), "service": self.service, "level": record.levelname.lower(),
            "operation": record.funcName, "message": record.getMessage(),
        }
        out |= {k: getattr(record, k) for k in ("layer", "duration", "status") if hasattr(record, k)}
        if record.exc_info:
            out["error"] = "".join(traceback.format_exception(*record.exc_info)).strip()
        return json.dumps(mask_payload(out), sort_keys=True, default=str)
