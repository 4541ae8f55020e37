"""Which columns of which views answer the fields of a report.

Names are described on the driver (they are schemas, not rows), everything else is a Spark job: fields and columns are
joined by the terms that both have, so only pairs with something in common are made; confidence is one expression over
a pair, and views and selections follow from windows over it.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions import vocabulary as V
from loomlake.functions.names import is_pii_column
from loomlake.storage import written

MOST_CANDIDATES, MOST_KEPT = 120, 50
SELECT, REVIEW, CANDIDATE = 0.85, 0.70, 0.50
PRIORITY = ("exact", "normalized", "business_alias", "historical", "acronym", "partial_word", "token")
EXACT = ("exact", "normalized", "business_alias", "historical")
_TERMS = "name string, plain string, compact string, norm string, core string, words array<string>, wide array<string>, aliases array<string>, acronym string"


# Names


def words_of(name: str) -> list[str]:
    """Lower-case words of a name, without stop words, abbreviations written out, plurals made singular."""
    out = []
    for w in re.findall(r"[a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name or "").lower()):
        if w in V.STOP_WORDS:
            continue
        w = V.ABBREVIATIONS.get(w, w)
        if w not in ("status", "business"):
            w = f"{w[:-3]}y" if len(w) > 4 and w.endswith("ies") else w[:-1] if len(w) > 3 and re.search(r"[^s]s$", w) else w
        out.append(w)
    return out


def core_of(words: list[str]) -> list[str]:
    """What is left without noise and number-like endings, if anything is."""
    if len(words) < 2:
        return words
    core = [w for w in words if w not in V.NOISE_WORDS]
    short = [w for w in core if w not in V.ENDINGS] if len(core) > 1 else core
    return short or core or words


def widened(words: Iterable[str]) -> set[str]:
    own = set(words)
    return own.union(*[V.SYNONYMS.get(w, ()) for w in own])


def without_hash(name: str) -> str:
    return re.sub(r"_?hash$", "", name, flags=re.I)


def describe(name: str) -> tuple:
    words = words_of(name)
    core = core_of(words)
    known = {a for key in (" ".join(words), "".join(words), "".join(core)) for a in V.ALIASES.get(key, ())}
    names = [*known, name, "_".join(words), "_".join(core)]
    aliases = {"".join(words_of(a)) for a in names} | {re.sub("[^a-z0-9]", "", a.lower()) for a in known}
    acronym = "".join(w[0] for w in words) if len(words) > 1 else ""
    compact = re.sub("[^a-z0-9]", "", name.lower())
    return name, name.strip().lower(), compact, "".join(words), "".join(core), words, sorted(widened([*words, *core])), sorted(aliases - {""}), acronym


def expected_type(name: str) -> str | None:
    words, norm = widened([*words_of(name), *core_of(words_of(name))]), "".join(words_of(name))
    if norm.endswith("at"):
        return "temporal"
    return next((k for k, v in V.TYPE_WORDS.items() if words & set(v)), None)


def type_group(kind: T.DataType) -> str:
    groups = ((T.TimestampType, "temporal"), (T.TimestampNTZType, "temporal"), (T.DateType, "temporal"), (T.NumericType, "number"), (T.StringType, "text"), (T.BooleanType, "boolean"))
    return next((g for t, g in groups if isinstance(kind, t)), "complex")


# Tables of fields and columns


def field_table(spark: SparkSession, fields: Iterable[tuple[str, bool]]) -> DataFrame:
    """(field_no, required, expected, and the description) of (label, required)."""
    rows = [(i, required, expected_type(label), *describe(label)) for i, (label, required) in enumerate(fields)]
    return spark.createDataFrame(rows, f"field_no int, required boolean, expected string, {_TERMS}")


def column_table(spark: SparkSession, views: dict[str, T.StructType], rows: dict[str, int] | None = None) -> DataFrame:
    """(view, column, data_type, found, platform, hashed, child, description of the name without _hash)."""
    out = []
    for view, schema in views.items():
        child, about = any(m in view.lower() for m in V.CHILD_MARKERS), sorted(widened(words_of(view)))
        for f in schema.fields:
            low = f.name.lower()
            platform = low in V.PLATFORM_COLUMNS or low.startswith(("bronze_", "silver_"))
            out.append((view, f.name, f.dataType.simpleString(), type_group(f.dataType), platform, low.endswith("_hash"), child, about, (rows or {}).get(view), is_pii_column(f.name), *describe(without_hash(f.name))))
    schema = f"view string, column string, data_type string, found string, platform boolean, hashed boolean, child boolean, about array<string>, view_rows long, pii boolean, {_TERMS}"
    return spark.createDataFrame(out, schema)


def _terms() -> Column:
    """Terms with weights by which pairs are found; three letters in a row find names that are merely similar."""
    whole = F.array(*[F.struct(F.col(c).alias("t"), F.lit(w).alias("w")) for c, w in (("norm", 10.0), ("core", 8.0), ("compact", 8.0))])
    many = [F.transform(c, lambda x, w=w: F.struct(x.alias("t"), F.lit(w).alias("w"))) for c, w in (("aliases", 7.0), ("wide", 3.0), ("words", 2.0))]
    threes = F.transform(F.sequence(F.lit(1), F.greatest(F.length("norm") - 2, F.lit(1))), lambda i: F.struct(F.concat(F.lit("~"), F.substring("norm", i, F.lit(3))).alias("t"), F.lit(0.1).alias("w")))
    return F.filter(F.concat(whole, *many, threes), lambda x: F.length(x["t"]) > 0)


def pairs(fields: DataFrame, columns: DataFrame, most: int = MOST_CANDIDATES) -> DataFrame:
    """(field_no, view, column) with a term in common, the ``most`` relevant of each field."""
    f = fields.select("field_no", F.explode(_terms()).alias("x")).groupBy("field_no", F.col("x.t").alias("t")).agg(F.max("x.w").alias("w"))
    c = columns.select("view", "column", F.explode(F.array_distinct(F.transform(_terms(), lambda x: x["t"]))).alias("t"))
    scored = f.join(c, "t").groupBy("field_no", "view", "column").agg(F.sum("w").alias("relevance"))
    rank = F.row_number().over(Window.partitionBy("field_no").orderBy(F.desc("relevance"), "view", "column"))
    return scored.withColumn("_r", rank).filter(F.col("_r") <= most).drop("_r")


def similarity(a: Column, b: Column) -> Column:
    """The larger of the share of ``a`` that ``b`` has, and Dice's coefficient."""
    both = F.size(F.array_intersect(a, b))
    value = F.greatest(both / F.size(a), 2 * both / (F.size(a) + F.size(b)))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), value).otherwise(F.lit(0.0))


def partial_words(a: Column, b: Column) -> Column:
    """The share of the words of ``a`` (of four letters or more) that contain a word of ``b`` or stand in one."""
    long = lambda x: F.length(x) >= 4
    hit = F.filter(a, lambda x: long(x) & F.exists(b, lambda y: long(y) & (F.contains(x, y) | F.contains(y, x))))
    return F.when(F.size(a) > 0, F.size(hit) / F.size(a)).otherwise(F.lit(0.0))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The similarity of two texts by their longest common blocks; Spark has no such function."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype=float)


# Confidence


def score(fields: DataFrame, columns: DataFrame, historical: DataFrame | None = None, preferred_view: str | None = None) -> DataFrame:
    """A row per candidate pair: field_no, field, view, column, confidence, match_type, category, warnings.

    historical: (field_norm, column_norm) of mappings that were used before.
    """
    f = fields.select([F.col(c).alias(f"f_{c}") if c != "field_no" else F.col(c) for c in fields.columns])
    p = pairs(fields, columns).join(f, "field_no").join(columns, ["view", "column"])
    known = columns.sparkSession.createDataFrame([], "field_norm string, column_norm string") if historical is None else historical
    known = known.select(F.col("field_norm").alias("f_norm"), F.col("column_norm").alias("norm"), F.lit(True).alias("_used")).distinct()
    p = p.join(known, ["f_norm", "norm"], "left")
    exact = (F.col("f_plain") == F.col("plain")) | (F.col("f_plain") == F.lower("column"))
    same = (F.col("f_compact") == F.col("compact")) | (F.col("f_compact") == F.regexp_replace(F.lower("column"), "[^a-z0-9]", ""))
    norm = (F.col("f_norm") == F.col("norm")) | ((F.col("f_core") == F.col("core")) & (F.col("f_core") != ""))
    alias = F.arrays_overlap("f_aliases", F.array("norm", "core", "compact"))
    acronym = (F.length("f_acronym") > 1) & F.col("f_acronym").isin(F.col("acronym"), F.col("compact"))
    p = p.withColumns({
        "_wide": similarity(F.col("f_wide"), F.col("wide")), "_words": similarity(F.col("f_words"), F.col("words")),
        "_part": partial_words(F.col("f_words"), F.col("words")), "_view": similarity(F.col("f_wide"), F.col("about")),
        "_fuzzy": F.greatest(ratio("f_norm", "norm"), F.when((F.col("f_core") != "") & (F.col("core") != ""), ratio("f_core", "core")).otherwise(0.0)),
    })
    p = written(p, "match-features")  # else every rule below would hold the features' expressions again
    token = F.greatest("_words", "_wide")
    tier = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("double").alias("value"))
    best = (
        F.when(exact, tier("exact", F.lit(1.0))).when(same, tier("normalized", F.lit(0.97))).when(norm, tier("normalized", F.lit(0.90)))
        .when(alias, tier("business_alias", F.lit(0.94))).when(F.col("_used"), tier("historical", F.lit(0.92))).when(acronym, tier("acronym", F.lit(0.88)))
        .when((F.col("_words") >= 0.85) | (F.col("_wide") >= 0.82), tier("token", F.least(F.lit(0.89), 0.72 + token * 0.19)))
        .when(F.col("_part") >= 0.67, tier("partial_word", F.least(F.lit(0.84), 0.64 + F.col("_part") * 0.22)))
        .when(F.col("_wide") >= 0.56, tier("token", F.least(F.lit(0.79), 0.53 + F.col("_wide") * 0.30)))
        .when(F.col("_fuzzy") >= CANDIDATE, tier("fuzzy", F.least(F.lit(0.62), F.col("_fuzzy")))).otherwise(tier("weak", F.col("_fuzzy")))
    )
    p = written(p.withColumn("_best", best).withColumn("match_type", F.col("_best.kind")), "match-kinds")
    relevant = F.when(F.col("_view") >= 0.28, F.least(F.lit(0.05), F.col("_view") * 0.08)).otherwise(0.0)
    strong = F.col("match_type").isin(*PRIORITY)
    liked = F.lit(0.0) if preferred_view is None else F.when(F.col("view") != preferred_view, -0.03).when(strong, 0.025).otherwise(0.0)
    child = F.when(F.col("child") & F.col("f_norm").rlike("stakeholder|visa|license|activit"), 0.04).otherwise(0.0)
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    value = clamp(clamp(F.col("_best.value") + _type_delta()) + relevant + liked)
    kinds = {"fuzzy": 0.69, "weak": 0.49, "partial_word": 0.84}
    most = F.lit(1.0)
    for kind, cap in kinds.items():
        most = F.when(F.col("match_type") == kind, F.lit(cap)).otherwise(most)
    most = F.when((F.col("match_type") == "token") & ~F.arrays_overlap("f_words", "words"), F.lit(0.78)).otherwise(most)
    value = clamp(F.least(value, most) + child)
    warnings = []
    for condition, cap, text in _caps():
        value = F.least(value, F.when(condition, F.lit(cap)))  # least leaves nulls out
        warnings.append(F.when(condition, F.lit(text)))
    value = F.least(value, F.when(F.col("match_type").isin("business_alias", "historical"), F.lit(0.94)))
    out = p.select(
        "field_no", F.col("f_name").alias("field"), F.col("f_required").alias("required"), "view", "column", "data_type", F.round(value, 3).alias("confidence"), "match_type",
        F.array_compact(F.array(*warnings)).alias("warnings"), _sensitive().alias("sensitive"), F.col("view_rows"), "about",
    )
    return out.withColumn("category", category(F.col("confidence")))


def _type_delta() -> Column:
    delta = F.when(F.col("f_expected").isNull() | F.col("found").isNull(), 0.0).when(F.col("f_expected") == F.col("found"), V.SAME_TYPE)
    for (want, have), x in V.TYPE_DELTAS.items():
        delta = delta.when((F.col("f_expected") == want) & (F.col("found") == have), x)
    return delta.otherwise(V.OTHER_TYPE)


def _sensitive() -> Column:
    probe = F.concat_ws(" ", F.lower("f_name"), F.lower("column"))
    plain = F.lower("column").isin("source_name", "source_type", "source_system", "database_name", "collection_name")
    return ~plain & (F.col("hashed") | F.col("pii") | F.concat(probe).rlike("|".join(V.SENSITIVE_MARKERS)))


def _caps() -> list[tuple[Column, float, str]]:
    """Conditions that leave only so much confidence, and what they warn of."""
    out = []
    for word, (others, cap) in V.REQUIRED_WORDS.items():
        needed = F.array(*[F.lit(w) for w in others])
        out.append((F.array_contains("f_wide", word) & ~F.arrays_overlap("wide", needed), cap, f"{word} is missing from the column"))
    own = F.array(*[F.lit(w) for w in ("source", "raw", "bronze", "silver")])
    out.append((F.col("platform") & ~F.arrays_overlap("f_wide", own), 0.55, "a column of the platform"))
    out.append((F.col("hashed") & ~F.lower("f_name").endswith("hash"), 0.91, "a hashed column"))
    asked = (F.col("f_norm") == F.col("norm")) | F.array_contains("f_aliases", F.col("norm"))
    shared = F.array_intersect(F.array_intersect("f_wide", "wide"), F.array(*[F.lit(w) for w in ("email", "phone", "mobile", "passport", "emirates", "dob", "birth", "name")]))
    out.append((_sensitive() & ~asked & (F.size(shared) == 0), 0.82, "sensitive"))
    return out


def category(c: Column) -> Column:
    pct = F.round(c * 100)
    return F.when(pct >= 95, "Excellent Match").when(pct >= 80, "Good Match").when(pct >= 60, "Possible Match").otherwise("Weak Match")


def _order() -> list[Column]:
    place = F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), F.col("match_type"))
    return [F.desc("confidence"), F.when(place == 0, 99).otherwise(place).asc(), F.length("column").asc(), F.col("sensitive").asc(), F.col("view").asc(), F.col("column").asc()]


def ranked(scores: DataFrame, most: int = MOST_KEPT) -> DataFrame:
    """Candidates of each field in order with their rank; those too weak are left out unless there are no others."""
    good = (F.col("confidence") >= CANDIDATE) | F.col("match_type").isin(*PRIORITY)
    any_good = F.max(good.cast("int")).over(Window.partitionBy("field_no"))
    rank = F.row_number().over(Window.partitionBy("field_no").orderBy(*_order()))
    kept = scores.withColumn("_any", any_good).filter(good | (F.col("_any") == 0)).drop("_any").withColumn("rank", rank)
    return kept.filter(F.col("rank") <= F.when(good, most).otherwise(5))


def rank_views(candidates: DataFrame, fields: DataFrame) -> DataFrame:
    """(view, score, matched_fields, coverage, ...) by the best candidate of each field in each view."""
    best = F.row_number().over(Window.partitionBy("field_no", "view").orderBy(*_order()))
    tops = candidates.withColumn("_b", best).filter("_b = 1")
    n = fields.agg(F.greatest(F.count_if("required"), F.lit(1)).alias("n_required"), F.count(F.lit(1)).alias("n_fields"), F.array_distinct(F.flatten(F.collect_list("wide"))).alias("asked"))
    grouped = tops.groupBy("view").agg(
        F.sum(F.col("confidence") * F.when(F.col("required"), 1.12).otherwise(0.86)).alias("_sum"), F.count(F.lit(1)).alias("matched_fields"),
        F.count_if(F.col("match_type").isin(*EXACT)).alias("exact_fields"), F.count_if("sensitive").alias("sensitive_fields"),
        F.any_value("about").alias("about"), F.max("view_rows").alias("view_rows"),
    )
    joined = grouped.join(F.broadcast(n))  # one row: the totals of the template
    relevance = similarity(F.col("asked"), F.col("about"))
    total = (
        F.col("_sum") + 1.6 * relevance + 1.25 * F.col("matched_fields") / F.col("n_required") + 0.22 * F.col("exact_fields")
        + F.when(F.col("view_rows") > 0, 0.04).otherwise(0.0) - 0.08 * F.col("sensitive_fields")
    )
    return joined.select(
        "view", F.round(total, 3).alias("score"), "matched_fields", "exact_fields", "sensitive_fields",
        F.round(F.col("matched_fields") / F.col("n_fields"), 3).alias("coverage"), F.round(relevance, 3).alias("relevance"),
    ).orderBy(F.desc("score"), F.desc("matched_fields"), "view")


def select_columns(candidates: DataFrame, fields: DataFrame, view: str) -> DataFrame:
    """One row per field: (field_no, field, required, view, column, confidence, match_type, status): the best column
    of one view; each column serves one field, the one it answers best. status: selected, needs_review or missing."""
    mine = candidates.filter(F.col("view") == view)
    by_column = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("confidence"), "rank", "field_no"))
    free = mine.withColumn("_c", by_column).filter("_c = 1")
    by_field = F.row_number().over(Window.partitionBy("field_no").orderBy(*_order()))
    best = free.withColumn("_f", by_field).filter(f"_f = 1 AND confidence >= {CANDIDATE}")
    joined = fields.select("field_no", F.col("name").alias("field"), "required").join(best.select("field_no", "view", "column", "confidence", "match_type"), "field_no", "left")
    status = F.when(F.col("confidence") >= SELECT, "selected").when(F.col("confidence").isNotNull(), "needs_review").otherwise("missing")
    return joined.withColumn("status", status).orderBy("field_no")
