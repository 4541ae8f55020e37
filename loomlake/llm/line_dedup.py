"""Line dedup by an exact set-similarity join (native).

A line is the set of its words. A line goes if an earlier line (by doc_id, then line number) has a Jaccard similarity
of THRESHOLD or more. Words are ordered by rarity (their number in a fixed count of hash buckets, then their hash; any
fixed order gives the same result, rare words first makes it fast). Two such lines share a word among the first words
of each (prefix filter: fewer for the shorter line), so lines are joined on those words only. Length and position
bounds, and the bound that the parities of both word sets give for their difference, are applied in the join. In 64 bits
the parities of long lines say little: a second one, of half of their words, goes with the sets and is applied to the
pairs before any text is read. Each pair that is left is verified with all words. Lines with equal word sets are one
line throughout.

Where many lines share two words of their prefixes (near copies of a passage), they are first compared with the earliest
of them only, in a large crowd with the earliest of each of LEADS parts. A line that goes by that isn't compared as the
later one again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import discard, stored, sweep, unused, with_group, workspace

THRESHOLD = 0.8
#: Hash buckets in which words are counted (a power of two); their counts travel as one array of so many small numbers.
BUCKETS = 1 << 22
_ROW_BITS = 11
#: Rows of what is looked up that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST = 300_000
#: A word of a prefix is a 32-bit code: its rarity class in the upper 6 bits (sign unused), its hash below. Words with
#: equal codes are only compared for nothing.
_HASH_BITS = 25
#: So many lines that share two of the FIRST words, by their hashes, of those of their prefixes that so many lines have
#: (one, where they have only one) are a crowd.
CROWD, FIRST = 32, 4
#: A crowd of so many lines has so many lines that the others are compared with first.
LARGE, LEADS = 256, 4
#: Sets of more words have a second parity.
LONG = 48


def _small(df: DataFrame) -> DataFrame:
    """A stored table as the side of a join: broadcast if it has at most MAX_BROADCAST rows."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def _text_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line_no, line): all lines; row is a hash of id and text, which tells rows with equal ids apart."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n").alias("lines")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), lines)  # texts are hashed here, not for each line
    return rows.select("doc_id", "row", F.posexplode_outer("lines").alias("line_no", "line"))


def _split(text: str) -> str:
    """Words, and empty texts where a text begins or ends with other characters."""
    return f"split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+')"


def rarity_classes(lines: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: rank, for each hash bucket of words (the upper bits of ids) the binary length of its number of words.

    A bucket of one word, or none, has 1: only the others are gathered.
    """
    width = min(buckets, 1 << _ROW_BITS)
    ids = lines.select(F.explode("ids").alias("id"))
    counts = ids.groupBy(F.shiftrightunsigned("id", 33 - buckets.bit_length()).alias("b")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    entry = F.struct(F.col("b").bitwiseAND(F.lit(width - 1)).alias("low"), F.length(F.bin("c")).cast("tinyint").alias("c"))
    every = counts.select(F.shiftright("b", _ROW_BITS).alias("high"), entry.alias("e"))
    every = every.union(lines.sparkSession.range(buckets // width).select(F.col("id").cast("int"), F.lit(None)))
    rows = every.groupBy("high").agg(F.sort_array(F.collect_list("e")).alias("x"))
    gaps = "transform(x, (e, i) -> concat(array_repeat(1Y, e.low - if(i = 0, 0, x[i - 1].low + 1)), array(e.c)))"
    rest = f"array_repeat(1Y, {width} - if(size(x) = 0, 0, element_at(x, -1).low + 1))"
    rows = rows.select("high", F.expr(f"concat(flatten({gaps}), {rest})").alias("x"))
    return rows.groupBy().agg(F.sort_array(F.collect_list(F.struct("high", "x"))).alias("x")).select(F.expr("flatten(transform(x, e -> e.x))").alias("rank"))


def _needed(n: str, share: float) -> str:
    return f"cast(ceil({n} * {share}D - 1e-9) as int)"


def line_words(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line_no, set_key, check, n, parity, half, ids) of all lines; n is 0 for those without a word.

    set_key and check: two hashes of the set. parity has a bit for each value of a word's hash mod 64: whether an odd
    number of words has it; half is the same of those words whose hash has its next bit set, null for sets of at most
    LONG words. ids: the upper halves of the words' hashes. A text's words are parted and hashed here only.
    """
    hashes = f"transform({_split('line')}, w -> xxhash64(w))"
    lines = _text_lines(docs).select("doc_id", "row", "line_no", F.expr(f"sort_array(array_distinct(array_remove({hashes}, xxhash64(''))))").alias("c"))
    return lines.select(
        "doc_id", "row", "line_no", F.xxhash64("c").alias("set_key"), F.xxhash64(F.lit("check"), "c").alias("check"), F.size("c").alias("n"),
        F.expr("aggregate(c, 0L, (a, x) -> a ^ shiftleft(1L, cast(x & 63L as int)))").alias("parity"),
        F.expr(f"if(size(c) > {LONG}, aggregate(c, 0L, (a, x) -> a ^ shiftleft(shiftright(x, 6) & 1L, cast(x & 63L as int))), null)").alias("half"),
        F.expr("transform(c, x -> cast(shiftright(x, 32) as int))").alias("ids"),
    )


def with_prefix(lines: DataFrame, threshold: float, buckets: int, within: str | None = None) -> DataFrame:
    """``lines`` of line_words with prefix, the codes of the rarest words, instead of ids.

    A set of fewer than threshold / (1 - threshold) words resembles only its equals: its prefix is empty.
    """
    most = f"n - {_needed('n', threshold)} + 1" if threshold < 1 else "0"
    least = f"{threshold / (1 - threshold)}D" if threshold < 1 else "1D"
    # The rank is a scalar subquery: it is evaluated once and read in place, as long as only projections stand between.
    rank = stored(rarity_classes(lines, buckets), "rarity", within).scalar()
    rarity = f"cast(get(rank, shiftrightunsigned(x, {33 - buckets.bit_length()})) as int)"
    code = f"coalesce(shiftleft({rarity}, {_HASH_BITS}) | shiftrightunsigned(x, {32 - _HASH_BITS}), 0)"  # no nulls: sorted as plain numbers
    codes = f"slice(sort_array(transform(ids, x -> {code})), 1, {most})"
    prefix = F.expr(f"if(n + 1e-9D >= {least}, {codes}, cast(array() as array<int>))")
    return lines.withColumn("rank", rank).withColumn("prefix", prefix).drop("rank", "ids")


def repeated_lines(docs: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, row, line_no) of the lines that an earlier line resembles; input columns doc_id and text.

    Lines are parted by \\n. Lines without a word are never removed. A null text has no lines with words. A null
    doc_id comes first. Rows that repeat both id and text are one document: they lose the same lines.
    """
    with workspace(docs.sparkSession, "line-sets") as within:
        return stored(_repeated(docs.select("doc_id", "text"), threshold, buckets, within), "repeated-lines")


def _repeated(docs: DataFrame, threshold: float, buckets: int, within: str) -> DataFrame:
    # A set is known by its first line (a number that no other line has): hashes only bring lines together.
    # Lines without a word are left out when the table is read: a filter before would compute the words twice.
    whole = stored(line_words(docs).withColumn("tie", F.monotonically_increasing_id()), "lines", f"{within}/lines")
    placed = whole.filter("n > 0")
    grouped = with_prefix(placed, threshold, buckets, within).groupBy("set_key", "check").agg(
        F.min(F.struct("doc_id", "row", "line_no", "tie")).alias("first"), F.count(F.lit(1)).alias("times"),
        F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("half").alias("half"), F.first("prefix").alias("prefix"),
    )
    at = F.struct("first.doc_id", "first.row", "first.line_no").alias("at")
    firsts = stored(grouped.select(F.col("first.tie").alias("sid"), at, "set_key", "check", "times", "n", "parity", "half", "prefix"), "sets", within)

    # Within equal sets: all but the first place goes.
    twice = firsts.filter("times > 1").select("set_key", "check", "at")
    places = placed.select("doc_id", "row", "line_no", "set_key", "check").join(twice, ["set_key", "check"])
    copies = places.filter("NOT (row = at.row AND line_no = at.line_no AND doc_id <=> at.doc_id)").select("doc_id", "row", "line_no")
    copies = stored(copies, "copies", within)
    discard(docs.sparkSession, f"{within}/lines")
    sweep(docs.sparkSession)

    # Between different sets: the later one goes; its other places are copies.
    crowds = later_sets(docs, firsts, _crowd_pairs(firsts, threshold, within), threshold, within)
    found = later_sets(docs, firsts, _close_pairs(firsts, crowds, threshold), threshold, within)
    later = _small(stored(crowds.union(found).distinct(), "all-later", within))
    gone = firsts.select("sid", "at").join(later, "sid", "left_semi").select("at.doc_id", "at.row", "at.line_no")
    return copies.union(gone).distinct()


def _class_of(code: str) -> Column:
    return F.shiftright(code, _HASH_BITS)


def _crowd_pairs(firsts: DataFrame, threshold: float, within: str) -> DataFrame:
    """Each set in a crowd with the earliest set of that crowd, in a large one with the earliest of each of its parts."""
    # A bucket of fewer words is no crowd's. By hashes alone, as a crowd's own words are less rare than those that its copies have for others.
    rare = f"filter(prefix, x -> shiftright(x, {_HASH_BITS}) >= {CROWD.bit_length()})"
    rare = F.expr(f"slice(sort_array(transform({rare}, x -> x & {(1 << _HASH_BITS) - 1})), 1, {FIRST})")
    one = F.when(F.size("rare") == 1, F.get("rare", F.lit(0)).cast("long"))
    two = [F.expr(f"shiftleft(cast(get(rare, {i}) as bigint), 32) | get(rare, {j})") for i in range(FIRST) for j in range(i + 1, FIRST)]
    rows = firsts.select("sid", "at", "n", "parity", F.explode(F.array(rare)).alias("rare"))  # exploded: evaluated once
    rows = rows.select("sid", "at", "n", "parity", F.explode(F.array(one, *two)).alias("code")).filter("code IS NOT NULL")
    crowds = stored(rows.groupBy("code").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") >= CROWD).select("code"), "crowds", within)
    members = stored(rows.join(_small(crowds), "code", "left_semi"), "crowd-members", within)
    place, part = F.struct("at", "sid", "n", "parity"), F.pmod(F.xxhash64("sid"), F.lit(LEADS))
    lead = {"_size": (F.count(F.lit(1)), F.sum("_size")), "_lead": (F.min(place), F.min("_lead"))}
    lead |= {f"_lead{i}": (F.min(F.when(part == i, place)), F.min(f"_lead{i}")) for i in range(LEADS)}
    members = with_group(members, ["code"], ["sid"], lead, F.lit(True))
    leads = F.when(F.col("_size") >= LARGE, F.array(*[f"_lead{i}" for i in range(LEADS)])).otherwise(F.array("_lead"))
    pairs = members.select("sid", "at", "n", "parity", F.explode(leads).alias("x"))
    pairs = pairs.filter("x.at < at")  # a part's first line may come later than one of another part
    pairs = pairs.select("sid", "n", "parity", *[F.col(f"x.{c}").alias(f"{c}2") for c in ("sid", "n", "parity")])
    possible = f"least(n, n2) >= {threshold}D * greatest(n, n2) - 1e-9 AND {_parity_bound(threshold)}"
    return pairs.filter(possible).select("sid", "sid2", _gap(), F.lit(True).alias("open"), F.lit(True).alias("open2")).distinct()


def _gap() -> Column:
    """How many words two sets differ by at least, by their parities."""
    return F.expr("bit_count(parity ^ parity2)").alias("gap")


def _parity_bound(threshold: float) -> str:
    """The words that two sets can share at most, by their parities, are as many as they need."""
    return f"(n + n2 - bit_count(parity ^ parity2)) * 0.5D >= {threshold / (1 + threshold)}D * (n + n2) - 1e-9"


def _close_pairs(firsts: DataFrame, gone: DataFrame, threshold: float) -> DataFrame:
    """The pairs of sets that all filters leave, the larger set first; pairs of two sets in ``gone`` are left out.

    open and open2: whether a set of the pair isn't in ``gone``.
    """
    marked = firsts.select("sid", "n", "parity", "prefix").join(_small(gone.withColumn("_gone", F.lit(True))), "sid", "left")
    index = marked.select("sid", "n", "parity", F.col("_gone").isNull().alias("open"), F.posexplode("prefix").alias("p", "code"))
    index = index.filter(_class_of("code") > 1)  # a bucket with one word: no other line has it
    place = F.expr("shiftleft(cast(n as bigint), 32) | shiftleft(cast(p as bigint), 1) | cast(open as bigint)")  # fewer bytes to shuffle
    index = index.select("code", "sid", "parity", place.alias("place"))
    lead = f"(p2 < n2 - {_needed('n2', 2 * threshold / (1 + threshold))} + 1)"
    both = f"{threshold / (1 + threshold)}D * (n + n2) - 1e-9"
    close = (
        f"(n > n2 OR (n = n2 AND sid > sid2)) AND (place | place2) & 1L = 1L AND n2 >= {threshold}D * n - 1e-9 AND {lead} "
        f"AND {_parity_bound(threshold)} AND least(p, p2) + least(n - p, n2 - p2) >= {both}"
    )
    for x in ("2", ""):
        close = re.sub(rf"\bn{x}\b", f"cast(shiftright(place{x}, 32) as int)", close)
        close = re.sub(rf"\bp{x}\b", f"cast(shiftright(place{x} & 4294967295L, 1) as int)", close)
    other = index.select(*[F.col(c).alias(f"{c}2") for c in index.columns])
    opened = [F.expr(f"place{x} & 1L = 1L").alias(f"open{x}") for x in ("", "2")]
    return index.join(other, F.expr(f"code = code2 AND {close}")).select("sid", "sid2", _gap(), *opened).distinct()


def _half_bound(threshold: float) -> str:
    """The same by the parities of both halves of the words, where both sets have them."""
    other = "(bit_count(half ^ half2) + bit_count(parity ^ half ^ parity2 ^ half2))"
    return f"coalesce((n + n2 - {other}) * 0.5D >= {threshold / (1 + threshold)}D * (n + n2) - 1e-9, true)"


def later_sets(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, threshold: float, within: str) -> DataFrame:
    """(sid): of each pair (sid, sid2, gap, open, open2) whose words have the similarity, the set that comes later, if it
    is open.

    One earlier set is enough for a later one to go: each later set is compared with the earlier one that its parities
    are nearest to, and only those that stay are compared with all the others.
    """
    pairs = stored(pairs, "line-pairs", within)
    sweep(docs.sparkSession)
    ordered = stored(_ordered_pairs(firsts, pairs, threshold), "line-order", within)
    sweep(docs.sparkSession)
    words = _whole_lines(docs, firsts, ordered, within)
    nearest = ordered.groupBy("later").agg(F.min(F.struct("gap", "earlier")).alias("x")).select("later", "x.earlier")
    found = stored(_alike(nearest, words, threshold), "later", within)
    rest = ordered.select("later", "earlier").join(_small(found), ordered["later"] == found["sid"], "left_anti")
    more = stored(_alike(rest, words, threshold), "later", within)
    sweep(docs.sparkSession)
    return found.union(more)


def _ordered_pairs(firsts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(later, earlier, gap) of the pairs whose later set is open and that the parities of halves leave."""
    slim = firsts.select("sid", "at", "n", "parity", "half")
    placed = pairs.join(slim, "sid").join(slim.toDF("sid2", "at2", "n2", "parity2", "half2"), "sid2").filter(_half_bound(threshold))
    swap = F.col("at") < F.col("at2")
    placed = placed.filter(F.when(swap, F.col("open2")).otherwise(F.col("open")))
    return placed.select(F.when(swap, F.col("sid2")).otherwise(F.col("sid")).alias("later"), F.when(swap, F.col("sid")).otherwise(F.col("sid2")).alias("earlier"), "gap")


def _alike(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """(sid): the later sets of the pairs (later, earlier) whose words have the similarity."""
    both = pairs.join(words.toDF("later", "words"), "later").join(words.toDF("earlier", "words2"), "earlier")
    common = F.size(F.array_intersect("words", "words2"))
    alike = both.filter(common >= F.lit(threshold) * (F.size("words") + F.size("words2") - common) - 1e-9)
    return alike.select(F.col("later").alias("sid")).distinct()


def _distinct_words(line: str) -> Column:
    return F.array_distinct(F.array_remove(F.expr(_split(line)), ""))


def _whole_lines(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, within: str) -> DataFrame:
    """(sid, words): the different words of the line at the first place of each set in ``pairs``."""
    keys = pairs.select(F.col("later").alias("sid")).union(pairs.select("earlier")).distinct()
    found = firsts.select("sid", "at").join(keys, "sid")
    wanted = found.groupBy(F.col("at.row").alias("_row"), F.col("at.doc_id").alias("_doc")).agg(F.collect_list(F.struct("sid", "at")).alias("_sets"))
    wanted = stored(wanted, "line-places", within)
    if wanted.agg(F.coalesce(F.sum(F.size("_sets")), F.lit(0))).head()[0] <= MAX_BROADCAST:  # else the texts are shuffled to them
        wanted = F.broadcast(wanted)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    matched = rows.join(wanted, (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    lines = matched.select(F.split("text", "\n").alias("lines"), "_sets")
    found = lines.select(F.explode(F.expr("transform(_sets, s -> struct(s.sid AS sid, get(lines, s.at.line_no) AS line))")).alias("s")).select("s.sid", "s.line")
    return stored(found.dropDuplicates(["sid"]).select("sid", _distinct_words("line").alias("words")), "whole-lines", within)


def line_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: (doc_id, n_lines, n_removed, removed array<int>): the numbers of its lines that go."""
    gone = repeated_lines(docs, threshold).groupBy(F.col("row").alias("_row"), F.col("doc_id").alias("_doc")).agg(F.array_sort(F.collect_list("line_no")).alias("removed"))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    found = rows.join(gone, (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return found.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def drop_repeated_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the repeated lines left out of text; all columns, null texts stay null."""
    row, key, doc, lines = unused(docs, "row", "key", "doc", "lines")
    gone = repeated_lines(docs, threshold).groupBy(F.col("row").alias(key), F.col("doc_id").alias(doc)).agg(F.collect_set("line_no").alias(lines))
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = keyed.join(gone, (F.col(row) == F.col(key)) & keyed["doc_id"].eqNullSafe(F.col(doc)), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(lines, i)), "\n")
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(kept)
    return found.withColumn("text", text).select(docs.columns)


def op9_line_dedup(spark, sf_dir):
    report = line_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return report.withColumn("removed", F.array_join("removed", ","))


OP9_SQL = r"""
WITH l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
w AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '[^\p{L}\p{N}]+'), lambda x: x <> ''))) AS ws FROM l
), s AS (SELECT row_number() OVER () AS sid, * FROM (SELECT ws, len(ws) AS n, min((doc_id, line_no)) AS first FROM w WHERE len(ws) > 0 GROUP BY ws)),
u AS (SELECT sid, n, unnest(ws) AS t FROM s),
f AS (SELECT t, count(*) AS c FROM u GROUP BY t),
p AS (SELECT * FROM (SELECT sid, n, u.t, row_number() OVER (PARTITION BY sid ORDER BY c, u.t) AS r FROM u JOIN f ON u.t = f.t) WHERE r <= n - ceil(n * 0.8 - 1e-9) + 1),
c AS (SELECT DISTINCT a.sid AS x, b.sid AS y FROM p a JOIN p b ON a.t = b.t AND a.sid < b.sid AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
v AS (
  SELECT CASE WHEN a.first < b.first THEN y ELSE x END AS sid FROM c JOIN s a ON a.sid = x JOIN s b ON b.sid = y
  WHERE len(list_intersect(a.ws, b.ws)) >= 0.8 * (a.n + b.n - len(list_intersect(a.ws, b.ws))) - 1e-9
), g AS (
  SELECT doc_id, line_no FROM w JOIN s ON w.ws = s.ws WHERE (doc_id, line_no) <> s.first OR s.sid IN (SELECT sid FROM v)
), r AS (SELECT doc_id, count(*) AS k, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS removed FROM g GROUP BY doc_id)
SELECT d.doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n_lines, coalesce(k, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id
"""
