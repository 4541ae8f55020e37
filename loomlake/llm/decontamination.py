"""Benchmark decontamination: size-partitioned MinHash containment search (native).

An item is found in a text when the text holds at least THRESHOLD of the item's distinct five-word shingles. Items of
fewer words are one shingle of all their words, and are sought among the texts' shingles of that width. Items are
partitioned by size. In a partition of at most n shingles per item, an item is sketched by its
n - ceil(THRESHOLD * n) + 1 least shingle hashes (its bottom-k MinHash): a text that holds THRESHOLD of the item
can't miss all of them, so the search loses nothing, however long the text is. Texts with a sketch value are then
verified by exact containment of the whole shingle set, inside the row, so no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import shingle_hashes, stored, unused, word_array

WORDS, THRESHOLD = 5, 0.8
#: Bytes of items (shingles, sketches and their index) that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST = 64 << 20


def _whole(words: str) -> Column:
    """The shingles of an item: of WORDS words, or one of all words where there are fewer."""
    short = F.when(F.size(F.expr(words)) == 1, shingle_hashes(words, 1))
    for k in range(2, WORDS):
        short = short.when(F.size(F.expr(words)) == k, shingle_hashes(words, k))
    return short.otherwise(shingle_hashes(words, WORDS))


def item_sketches(items: DataFrame) -> DataFrame:
    """(item_id, item_key, width, size_class, n_item, shingles, sketch) of the items that have a word.

    width: words of a shingle. Size class c holds items of 2^c to 2^(c+1) - 1 distinct shingles; its sketch size
    follows from its largest size. item_key tells items of one id and different texts apart. Null items, and items
    without a word, are never found.
    """
    words = items.select("item_id", F.expr(word_array()).alias("words"))
    hashed = words.select("item_id", F.least(F.size("words"), F.lit(WORDS)).alias("width"), F.array_sort(F.array_distinct(_whole("words"))).alias("shingles"))
    n, cls = F.size("shingles"), F.floor(F.log2(F.size("shingles")))
    most = F.pow(F.lit(2), cls + 1) - 1
    keep = (most - F.ceil(most * THRESHOLD - 1e-9) + 1).cast("int")
    key = F.xxhash64("item_id", "width", "shingles").alias("item_key")
    sized = hashed.filter(n > 0).select("item_id", key, "width", cls.cast("int").alias("size_class"), n.alias("n_item"), "shingles", keep.alias("_keep"))
    return sized.withColumn("sketch", F.slice("shingles", 1, F.least("_keep", "n_item"))).drop("_keep")


def find_leaks(docs: DataFrame, items: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per text and item it holds: (doc_id, row, item_id, n_item, n_shared, containment).

    row is a hash of id and text, which tells rows with null or repeated ids apart. Null and empty texts hold
    nothing; repeated rows are reported once. Of items that share an id each is reported, and those of equal
    shingles too count once; no items: no rows.
    """
    sketches = stored(item_sketches(items).dropDuplicates(["item_id", "item_key"]), "sketches")
    size = F.sum(8 * F.size("shingles") + 56 * F.size("sketch") + 64)
    about = sketches.agg(F.coalesce(size, F.lit(0)).alias("bytes"), F.sort_array(F.collect_set("width")).alias("widths")).head()
    held = F.array_distinct(shingle_hashes(word_array(), *(about["widths"] or [WORDS]))).alias("held")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), held)
    index = sketches.select("item_key", F.posexplode("sketch").alias("place", "value"), "sketch")
    index = index.select("item_key", "value", F.get("sketch", F.col("place") - 1).alias("before"))
    shared = F.size(F.array_intersect("shingles", "held"))
    if about["bytes"] <= max_broadcast:
        # A pair is kept at the first sketch value that the text has, so each pair comes out once. Most others go at once:
        # the text has the value before them too.
        hits = rows.select("doc_id", "row", "held", F.explode_outer("held").alias("value")).join(F.broadcast(index), "value")
        hits = hits.filter(F.col("before").isNull() | ~F.array_contains("held", F.col("before")))
        pairs = hits.join(F.broadcast(sketches), "item_key").filter(F.array_intersect("sketch", "held")[0] == F.col("value"))
    else:
        values = rows.select("doc_id", "row", F.explode_outer("held").alias("value"))
        keys = values.join(index, "value").groupBy("doc_id", "row", "item_key").agg(F.lit(1).alias("_"))
        pairs = keys.join(sketches, "item_key").join(rows.select(F.col("row").alias("_row"), "held"), F.col("row") == F.col("_row"))
    checked = pairs.select("doc_id", "row", "item_id", "item_key", F.col("n_item").cast("long").alias("n_item"), shared.cast("long").alias("n_shared"))
    return (
        checked.filter(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(THRESHOLD) - 1e-9))
        .dropDuplicates(["doc_id", "row", "item_id", "item_key"])
        .drop("item_key")
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose texts hold no item, all columns."""
    row, leak, doc = unused(docs, "row", "leak", "doc")
    leaks = find_leaks(docs, items).select(F.col("row").alias(leak), F.col("doc_id").alias(doc)).distinct()
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    return keyed.join(leaks, (keyed[row] == leaks[leak]) & keyed["doc_id"].eqNullSafe(leaks[doc]), "left_anti").drop(row)


def op4_decontamination(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return find_leaks(docs, items).select("doc_id", "item_id", "n_item", "n_shared", "containment")


OP4_SQL = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark
), widths AS (SELECT DISTINCT least(5, len(ws)) AS k FROM w WHERE side = 'b' AND len(ws) > 0),
s AS (
  SELECT DISTINCT side, id, k, unnest(list_transform(range(1, greatest(len(ws) - k + 2, 1)), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g
  FROM w JOIN widths ON side = 'd' OR k = least(5, len(ws))
), n AS (SELECT id, count(*) AS n_item FROM s WHERE side = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, n.n_item, count(*) AS n_shared, count(*) / n.n_item AS containment
FROM s d JOIN s b ON d.k = b.k AND d.g = b.g AND d.side = 'd' AND b.side = 'b' JOIN n ON n.id = b.id
GROUP BY d.id, b.id, n.n_item HAVING count(*) >= ceil(n.n_item * 0.8 - 1e-9)
"""
