"""The prefix trie of conversations, by ownership of prefixes.

A node is a distinct sequence of the first d turns of some conversation. It is owned by the smallest conversation that
starts with it, so a conversation owns a run of depths that ends with its last turn, or nothing. A table of all prefix
digests holds the smallest conversation of each; where a conversation's run begins is found by binary search, every round
one join of all open conversations with that table. The owned runs are chains that hang from one another: sums over
subtrees are taken chain by chain, by doubling the distance to the ancestor, and then along each chain.

Prefixes are told apart by 128 bits: the exclusive or of SHA-256 values of (place, turn), which can be taken in pieces.
Turns of one conversation are dealt by range and summed by segments, so a conversation may hold any share of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlake.llm.shared import stored, workspace

#: Turns that one step of a running sum takes together; longer conversations go by segments and carry between them.
SEGMENT = 4096
#: Characters of a turn that order turns of equal number and role; beyond them their digest does.
HEAD = 64
#: Characters of ids that are handed over for hashing as one piece.
PIECE = 1 << 16
#: Places of the original turns that other conversations may begin with, and the step of the ids they are taken from.
HEADS, STEP = 6, 100


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, chars) of every row of (conv_id, turn, role, text) with an id; place counts from 1.

    Turns are ordered by number, null first; equal numbers by role, the text's first HEAD characters and its digest.
    A null role or text is empty. Rows that are equal throughout are turns of their own. Rows without an id belong to no
    conversation and are left out. The digest is the SHA-256 of role and text.
    """
    with workspace(conversations.sparkSession, "turns") as within:
        return stored(_numbered(conversations, within), "numbered")


def _numbered(conversations: DataFrame, within: str) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), F.substring(text, 1, HEAD).alias("head"), digest.alias("digest"), F.char_length(text).cast("long").alias("chars"))
    order = [F.col("turn").asc_nulls_first(), "role", "head", "digest"]
    dealt = stored(rows, "rows", within).repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "dealt", within)
    sizes = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    later = before.filter("before > 0").select("conv_id", "part", "before")  # the first conversation of a partition at most
    within_part = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    placed = dealt.withColumn("place", within_part).join(later, ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "chars")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, chars) of the rebuilt conversations, and (conv_id) of all of them, turnless ones too.

    Conversation c begins with the first h turns of conversation c - c % STEP (the remainder has the sign of c), h being
    crc32(c) % HEADS; its own turns after its first h follow.
    """
    h, base = F.crc32(F.col("conv_id").cast("string")) % HEADS, F.col("conv_id") - F.col("conv_id") % STEP
    heads = turns.filter((F.col("conv_id") % STEP == 0) & (F.col("place") < HEADS)).withColumnRenamed("conv_id", "base")
    lengths = heads.groupBy("base").agg(F.max("place").alias("length"))
    members = turns.filter("place = 1").select("conv_id")
    taken = members.select("conv_id", h.alias("h"), base.alias("base")).join(heads, "base").filter("place <= h").select("conv_id", F.col("place").alias("depth"), "digest", "chars")
    own = turns.select("*", h.alias("h"), base.alias("base")).filter("place > h").join(lengths, "base", "left")
    depth = F.col("place") - F.col("h") + F.least("h", F.coalesce("length", F.lit(0)))
    return taken.union(own.select("conv_id", depth.alias("depth"), "digest", "chars")), members


def _running(rows: DataFrame, columns: dict[str, Column], total: str, longest: int, falling: bool = False) -> DataFrame:
    """``rows`` of (conv_id, depth, ...) with running aggregates by depth: from the first on, or (``falling``) from the last.

    total: the SQL aggregate. A conversation of more than SEGMENT turns is summed by segments, whose totals are carried.
    """
    plain = rows.withColumns(columns).withColumn("_seg", F.floor(F.col("depth") / SEGMENT))
    order = F.col("depth").desc() if falling else F.col("depth")
    window = Window.partitionBy("conv_id", "_seg").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    agg = getattr(F, total)
    if longest < SEGMENT:
        return plain.withColumns({c: agg(c).over(window) for c in columns}).drop("_seg")
    segments = plain.groupBy("conv_id", "_seg").agg(*[agg(c).alias(c) for c in columns])
    along = F.col("_seg").desc() if falling else F.col("_seg")
    past = Window.partitionBy("conv_id").orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    carried = segments.select("conv_id", "_seg", *[agg(c).over(past).alias(f"_{c}") for c in columns]).filter(f"_{next(iter(columns))} IS NOT NULL")
    both = plain.withColumns({c: agg(c).over(window) for c in columns}).join(carried, ["conv_id", "_seg"], "left")
    add = (lambda c: F.col(c).bitwiseXOR(F.coalesce(f"_{c}", F.lit(0)))) if total == "bit_xor" else (lambda c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)))
    return both.withColumns({c: add(c) for c in columns}).drop("_seg", *[f"_{c}" for c in columns])


def prefixes(turns: DataFrame, members: DataFrame, longest: int) -> DataFrame:
    """(conv_id, depth, a, b, chars): the digest (a, b) of each prefix, the empty one too, and the code points of its last text."""
    term = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")), 256)
    word = lambda at: F.conv(F.substring(term, at, 16), 16, -10).cast("long")
    running = _running(turns.select("conv_id", F.col("depth").cast("long").alias("depth"), "digest", "chars"), {"a": word(1), "b": word(17)}, "bit_xor", longest)
    empty = [F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b", "chars")]
    return running.select("conv_id", "depth", "a", "b", "chars").union(members.select("conv_id", *empty))


def first_owned(places: DataFrame, minima: DataFrame, longest: int, within: str) -> DataFrame:
    """(conv_id, length, first) by binary search: ``first`` is the least depth that a conversation owns, length + 1 if none.

    A conversation that owns a prefix owns every longer one of its own: fewer conversations share that, and it is among them.
    """
    state = places.groupBy("conv_id").agg(F.max("depth").alias("length")).select("conv_id", "length", F.lit(0).cast("long").alias("low"), (F.col("length") + 1).alias("high"))
    state = stored(state, "search", within)
    for _ in range((longest + 1).bit_length()):
        asked = state.filter("low < high").withColumn("depth", F.floor((F.col("low") + F.col("high")) / 2))
        owner = asked.join(places.select("conv_id", "depth", "a", "b"), ["conv_id", "depth"]).join(minima.select("depth", "a", "b", "owner"), ["depth", "a", "b"])
        owned = F.col("owner") == F.col("conv_id")
        halved = owner.select("conv_id", "length", F.when(owned, F.col("low")).otherwise(F.col("depth") + 1).alias("low"), F.when(owned, F.col("depth")).otherwise(F.col("high")).alias("high"))
        state = stored(state.filter("low = high").union(halved), "search", within)
    return state.select("conv_id", "length", F.col("low").alias("first"))


def _chain_totals(chains: DataFrame, within: str) -> DataFrame:
    """(conv_id, saved, leaves) summed over a chain and all that hangs from it, in as many rounds as the height has binary digits."""
    state = stored(chains.select("conv_id", F.col("parent").alias("above"), "saved", "leaves"), "totals", within)
    while state.filter("above IS NOT NULL").head(1):
        gained = state.filter("above IS NOT NULL").groupBy(F.col("above").alias("conv_id")).agg(F.sum("saved").alias("_saved"), F.sum("leaves").alias("_leaves"))
        next_above = state.select(F.col("conv_id").alias("above"), F.col("above").alias("_next"))
        more = state.join(gained, "conv_id", "left").join(next_above, "above", "left")
        state = stored(more.select("conv_id", F.col("_next").alias("above"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("saved", "leaves")]), "totals", within)
    return state.drop("above")


def _id_hashes(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): SHA-256 of the decimal members of each node, ascending and comma-joined.

    Members are dealt by range and joined into pieces; a node's pieces are hashed one after the other, so none is held whole.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, held, size = None, [], 0
        for batch in batches:
            out = []
            for conv, depth, member in zip(batch["conv_id"], batch["depth"], batch["member"], strict=True):
                if node is not None and (node != (conv, depth) or size > PIECE):
                    out.append((*node, held[0], ",".join(map(str, held))))
                    held, size = [], 0
                node = (conv, depth)
                held.append(member)
                size += 21
            yield pd.DataFrame(out, columns=["conv_id", "depth", "least", "ids"])
        if node is not None:
            yield pd.DataFrame([(*node, held[0], ",".join(map(str, held)))], columns=["conv_id", "depth", "least", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, sha = None, None
        for batch in batches:
            out = []
            for conv, depth, ids in zip(batch["conv_id"], batch["depth"], batch["ids"], strict=True):
                if node == (conv, depth):
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = (conv, depth), hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["conv_id", "depth", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, sha.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])

    order = ["conv_id", "depth", "member"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pieces, "conv_id long, depth long, least long, ids string")
    dealt = runs.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "least")
    return dealt.select("conv_id", "depth", "ids").mapInPandas(hashed, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    turns: (conv_id, depth, digest, chars), depth from 1 without gaps, once each; members: (conv_id), once each, those
    without turns too. conv_id is the node's owner, n_convs the conversations that start with it, n_leaves the childless
    nodes of its subtree (itself included), saved_tokens the sum over its subtree of (n_convs - 1) * chars, ends_sha256 the
    hash of the conversations that end there. No members: no rows, not even the root.
    """
    with workspace(turns.sparkSession, "trie") as within:
        return stored(_trie(stored(turns, "turns", within), stored(members, "members", within), within), "trie")


def _trie(turns: DataFrame, members: DataFrame, within: str) -> DataFrame:
    longest = turns.agg(F.max("depth")).first()[0] or 0
    places = stored(prefixes(turns, members, longest), "places", within)
    minima = places.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"))
    minima = stored(minima, "minima", within)

    found = first_owned(places, minima, longest, within)
    hung = found.filter("first > 0").withColumn("depth", F.col("first") - 1)
    above = hung.join(places.select("conv_id", "depth", "a", "b"), ["conv_id", "depth"]).join(minima.select("depth", "a", "b", "owner"), ["depth", "a", "b"])
    placed = above.select("conv_id", "length", "first", F.col("owner").alias("parent"))
    placed = stored(placed.union(found.filter("first = 0").select("conv_id", "length", "first", F.lit(None).cast("long"))), "placed", within)
    chains = placed.filter("first <= length")

    hanging = chains.filter("parent IS NOT NULL").select(F.col("parent").alias("conv_id"), (F.col("first") - 1).alias("depth"), F.col("conv_id").alias("child"))
    at_end = hanging.select("conv_id", F.col("depth").alias("length")).distinct().withColumn("leaves", F.lit(0).cast("long"))
    saving = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    own = minima.select(F.col("owner").alias("conv_id"), saving).groupBy("conv_id").agg(F.sum("saved").alias("saved"))
    valued = chains.join(at_end, ["conv_id", "length"], "left").join(own, "conv_id").select("conv_id", "parent", "saved", F.coalesce("leaves", F.lit(1)).alias("leaves"))
    totals = _chain_totals(valued, within)

    side = hanging.join(totals.withColumnRenamed("conv_id", "child"), "child").groupBy("conv_id", "depth")
    side = side.agg(F.count(F.lit(1)).alias("hung"), F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    nodes = minima.select(F.col("owner").alias("conv_id"), "depth", "n_convs", saving).join(side, ["conv_id", "depth"], "left").join(chains, "conv_id")
    n_children = F.coalesce("hung", F.lit(0)) + (F.col("depth") < F.col("length")).cast("long")
    nodes = nodes.withColumn("n_children", n_children)
    sums = {
        "saved_tokens": F.col("saved") + F.coalesce("hung_saved", F.lit(0)),
        "n_leaves": (F.col("n_children") == 0).cast("long") + F.coalesce("hung_leaves", F.lit(0)),
    }
    summed = _running(nodes, sums, "sum", longest, falling=True)
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("parent"))

    last = F.when(F.col("first") <= F.col("length"), F.col("conv_id")).otherwise(F.col("parent"))
    ends = placed.select(last.alias("conv_id"), F.col("length").alias("depth"), F.col("conv_id").alias("member"))
    whole = summed.join(_id_hashes(ends), ["conv_id", "depth"], "left")
    return whole.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op13_prefix_trie(spark, sf_dir):
    turns, members = rebuilt_turns(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return prefix_trie(turns, members)


OP13_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
steps AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
      lambda a, b: xor(a >> 8, step[1 + (xor(a, b) & 255)])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t), steps),
r AS (SELECT c.conv_id, t.place AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, t.place - c.h + least(c.h, (SELECT count(*) FROM t b WHERE b.conv_id = c.base)), role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h),
p AS (SELECT conv_id, 0 AS depth, '' AS key, 0 AS chars FROM c
  UNION ALL
  SELECT conv_id, depth, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
      OVER (PARTITION BY conv_id ORDER BY depth)), length(text) FROM r),
n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM p GROUP BY ALL),
e AS (SELECT p.conv_id AS member, p.depth, p.key FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY 1) USING (conv_id, depth)),
g AS (SELECT n.*, u.conv_id AS parent_conv_id, u.key AS parent_key
  FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN n u ON u.depth = p.depth AND u.key = p.key),
k AS (SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
s AS (SELECT p.depth, p.key, sum((d.n_convs - 1) * d.chars) AS saved, count(*) FILTER (WHERE k.key IS NULL) AS leaves
  FROM n d LEFT JOIN k ON k.depth = d.depth AND k.key = d.key JOIN p ON p.conv_id = d.conv_id AND p.depth <= d.depth GROUP BY ALL)
SELECT g.conv_id, g.depth, g.parent_conv_id, g.n_convs, coalesce(k.n_children, 0) AS n_children, s.leaves AS n_leaves,
  s.saved::BIGINT AS saved_tokens,
  sha256(coalesce((SELECT string_agg(member, ',' ORDER BY member) FROM e WHERE e.depth = g.depth AND e.key = g.key), '')) AS ends_sha256
FROM g JOIN s USING (depth, key) LEFT JOIN k USING (depth, key)
"""
