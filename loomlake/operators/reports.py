"""Reports: a template of fields, matched to one safe view, checked, repaired and published as a view."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.functions.names import quote, safe_identifier, unique_names
from loomlake.operators import matching as M
from loomlake.operators.sets import clamp_limit

MOST_PREVIEW, REPAIR = 20, 0.66


@dataclass(frozen=True)
class Mapping:
    label: str
    required: bool
    view: str | None
    column: str | None
    confidence: float | None = None


@dataclass
class Template:
    name: str
    mappings: list[Mapping]
    notes: list[str] = field(default_factory=list)

    @property
    def view_name(self) -> str:
        return f"report_{safe_identifier(self.name)}_analytics"


def match_template(spark: SparkSession, name: str, fields: list[tuple[str, bool]], views: dict, rows: dict[str, int] | None = None, historical: DataFrame | None = None) -> Template:
    """The template with the columns of the view that answers it best."""
    asked, columns = M.field_table(spark, fields), M.column_table(spark, views, rows)
    candidates = M.ranked(M.score(asked, columns, historical)).cache()
    try:
        first = M.rank_views(candidates, asked).head()
        if first is None:
            return Template(name, [Mapping(label, need, None, None) for label, need in fields])
        chosen = M.select_columns(candidates, asked, first["view"]).collect()  # a row per field of the template
        return Template(name, [Mapping(r["field"], r["required"], r["view"], r["column"], r["confidence"]) for r in chosen])
    finally:
        candidates.unpersist()


def validate(template: Template, views: dict) -> list[tuple[str, str]]:
    """(severity, message): error stops a report, warning doesn't."""
    found, used = [], [m for m in template.mappings if m.column]
    if not used:
        found.append(("error", "no field is mapped"))
    for m in template.mappings:
        if not m.column and m.required:
            found.append(("error", f"required field is not mapped: {m.label}"))
        elif not m.column:
            found.append(("warning", f"optional field is empty: {m.label}"))
        elif m.view not in views:
            found.append(("error", f"view is not available: {m.view}"))
        elif m.column not in views[m.view].names:
            found.append(("error", f"column is not available: {m.view}.{m.column}"))
        else:
            want, have = M.expected_type(m.label), M.type_group(views[m.view][m.column].dataType)
            if want and want != have and (want, have) not in M.V.TYPE_DELTAS:
                found.append(("warning", f"{m.label} looks {want}, {m.column} is {have}"))
    if len({m.view for m in used}) > 1:
        found.append(("error", "fields come from several views"))
    for what, values in (("label", [m.label.lower() for m in template.mappings]), ("column", [(m.view, m.column) for m in used])):
        for v in sorted({str(x) for x in values if values.count(x) > 1}):
            found.append(("error" if what == "label" else "warning", f"{what} is used twice: {v}"))
    return found


def auto_fix(spark: SparkSession, template: Template, views: dict) -> Template:
    """The template mapped anew to one view, where what it has is not valid: mappings that are valid and in the view
    with most of them stay, others are replaced by candidates of at least REPAIR, or dropped."""
    valid = [m for m in template.mappings if m.column and m.view in views and m.column in views[m.view].names]
    counts: dict[str, int] = {}
    for m in valid:
        counts[m.view] = counts.get(m.view, 0) + 1
    fields = [(m.label, m.required) for m in template.mappings]
    if counts:
        view = max(sorted(counts), key=counts.get)
        asked, columns = M.field_table(spark, fields), M.column_table(spark, {view: views[view]})
        fresh = {r["field_no"]: r for r in M.select_columns(M.ranked(M.score(asked, columns)), asked, view).collect()}
        fresh = {k: Mapping(r["field"], r["required"], r["view"], r["column"], r["confidence"]) for k, r in fresh.items()}
    else:
        again = match_template(spark, template.name, fields, views)
        fresh, view = dict(enumerate(again.mappings)), next((m.view for m in again.mappings if m.view), None)
    out, taken, notes = [], set(), []
    for m in template.mappings:  # what stays takes its column first
        if m in valid and m.view == view and m.column not in taken:
            taken.add(m.column)
    kept = set()
    for i, m in enumerate(template.mappings):
        if m in valid and m.view == view and m.column not in kept:
            kept.add(m.column)
            out.append(m)
            continue
        new = fresh[i]
        if new.column and (new.confidence or 0) >= REPAIR and new.column not in taken:
            taken.add(new.column)
            notes.append(f"{m.label}: {m.view}.{m.column} -> {new.view}.{new.column}")
            out.append(new)
        else:
            if m.column:
                notes.append(f"{m.label}: {m.view}.{m.column} dropped")
            out.append(replace(m, view=None, column=None, confidence=None))
    return Template(template.name, out, notes)


def projection(template: Template, views: dict[str, DataFrame]) -> DataFrame:
    """Columns under their labels in the template's order; fields without a column are null texts."""
    view = next((m.view for m in template.mappings if m.view), None)
    if view is None:
        raise ValueError("no field is mapped")
    labels = unique_names([m.label for m in template.mappings])
    return views[view].select(*[(F.col(quote(m.column)) if m.column else F.lit(None).cast("string")).alias(x) for m, x in zip(template.mappings, labels, strict=True)])


def generate(spark: SparkSession, template: Template, views: dict[str, DataFrame], replace_existing: bool = False, preview: int = MOST_PREVIEW) -> dict:
    """Validates (and repairs once), publishes the report's view and returns its name, a preview and its null counts.

    Analysis stands for a dry run: a projection that Spark can't resolve fails before anything is published.
    """
    schemas = {k: v.schema for k, v in views.items()}
    if any(level == "error" for level, _ in validate(template, schemas)):
        template = auto_fix(spark, template, schemas)
    problems = validate(template, schemas)
    if errors := [text for level, text in problems if level == "error"]:
        raise ValueError("; ".join(errors))
    if spark.catalog.tableExists(template.view_name) and not replace_existing:
        raise FileExistsError(template.view_name)
    df = projection(template, views)
    df.createOrReplaceTempView(template.view_name)
    first = df.limit(clamp_limit(preview, MOST_PREVIEW))
    return {"view": template.view_name, "preview": first, "nulls": null_counts(first), "warnings": [t for _, t in problems], "notes": template.notes}


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(quote(c)).isNull()).alias(c) for c in df.columns])
