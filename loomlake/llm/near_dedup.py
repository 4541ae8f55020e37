"""Near-duplicate classes by BagMinHash signatures.

A text is a multiset of five-word shingles. Its signature has REGISTERS registers such that two texts agree in a
register with a probability equal to their weighted Jaccard similarity sum(min) / sum(max) of shingle counts. Bands
of ROWS registers give candidates: a pair of similarity 0.8 or more misses all bands with a probability below 4e-5.

In each bucket every member is paired with one representative, the member with the largest buckets over all bands
(the centre of its surroundings), pairs are verified by exact multiset overlap, and components are formed. In buckets
whose members then are still in different components, what is left is compared across components: small buckets are
paired whole, in larger ones the texts outside the largest component are compared with all others, in blocks that give
links only. No link between different texts that share a bucket is lost. Copies are one text throughout.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import as_long, as_text, stored, sweep, tidy, unused, with_group, workspace

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 26, 5
REGISTERS = BANDS * ROWS
#: A pair is verified if so many registers agree: 0.8 is 4 standard deviations above.
AGREE = int(REGISTERS * (THRESHOLD - 4 * (THRESHOLD * (1 - THRESHOLD) / REGISTERS) ** 0.5))
#: Buckets of up to so many texts are paired whole where their texts are in several components.
PAIRED = 32
#: Texts, and bytes of shingle hashes, that a block holds when the texts of a larger bucket are compared.
BLOCK_TEXTS, BLOCK_BYTES = 2000, 8 << 20
#: Numbers in an array that a comparison of a block makes at a time.
GRID = 1 << 20
#: Texts to be read for verification whose ids may be broadcast.
MAX_BROADCAST = 500_000
_WORD = re.compile(r"[^\W_]+")
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_multiset(text: str | None) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Sorted 64-bit hashes of the distinct five-word shingles, their counts, and a digest of the text's words.

    Words are lower-cased runs of letters and digits. A text of one to four words is one shingle; a text without
    words has none, and its digest is of the text itself.
    """
    words = _WORD.findall((text or "").lower())
    digest = hashlib.blake2b(("w " + " ".join(words) if words else "t " + (text or "")).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    if not words:
        return np.zeros(0, _U), np.zeros(0, np.int64), digest
    codes = pd.util.hash_array(np.array(words, object), categorize=False)
    k = min(WORDS, len(words))
    h = np.full(len(words) - k + 1, len(words) if k < WORDS else 0, _U)
    for j in range(k):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + codes[j : j + len(h)])
    return *np.unique(h, return_counts=True), digest


def bag_min_hash(sets: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """Signatures of weighted sets (hashes, positive integer counts): an array of m 32-bit values per set.

    The weights are discretised to the integers and arranged in the blocks [0, 1), [1, 2), [2, 4), [4, 8), ...
    A block of width w is a Poisson process of rate w, split by halves down to unit intervals; a point's way down
    that hierarchy is given by the bits of one uniform number. Points come in order of time, each falls on a random
    register and counts if its interval lies below the element's weight. A register keeps its earliest point. The
    points depend on element, block and number only, so equal weights see equal points. An element stops at the
    first point that is later than the latest register of its set.
    """
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    out = np.zeros((len(sets), m), np.uint32)
    if not len(owner):
        return out
    key = np.concatenate([h for h, _ in sets])
    weight = np.concatenate([c for _, c in sets]).astype(np.int64)
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1  # blocks that begin below the weight
    at = np.repeat(np.arange(len(key)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    owner, weight = owner[at], weight[at]
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.where(level == 0, 1, low)
    seed = _mix(key[at] + level.astype(_U) * _U(0xD1342543DE82EF95))
    time, value = np.full(len(sets) * m, np.inf), np.zeros(len(sets) * m, np.uint32)
    clock, rate, bound = np.zeros(len(seed)), width.astype(float), np.full(len(sets), np.inf)
    live, n = np.arange(len(seed)), 0
    while len(live):
        n += 1
        r = _mix(seed[live] + _U(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        u = ((r >> _U(11)).astype(float) + 0.5) / float(1 << 53)
        clock[live] -= np.log(u) / rate[live]
        going = clock[live] < bound[owner[live]]
        live, r = live[going], r[going]
        s = _mix(r ^ _U(0x2545F4914F6CDD1D))
        step = (((s >> _U(32)) * width[live].astype(_U)) >> _U(32)).astype(np.int64)
        ok = low[live] + step < weight[live]
        hit = live[ok]
        slot = owner[hit] * m + ((s[ok] & _U(0xFFFFFFFF)) * _U(m) >> _U(32)).astype(np.int64)
        t = clock[hit]
        better = t < time[slot]
        slot, t, mark = slot[better], t[better], (_mix(s[ok][better]) >> _U(32)).astype(np.uint32)
        order = np.argsort(-t, kind="stable")  # the earliest is written last
        time[slot[order]], value[slot[order]] = t[order], mark[order]
        if n % 4 == 0 or n < 4:
            bound = time.reshape(-1, m).max(axis=1)
    out[:] = value.reshape(-1, m)
    return out


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted hashes, counts); 0 where either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    return shared / (a[1].sum() + b[1].sum() - shared)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text_key, bands array<long>, signature binary); bands is empty for texts without words."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held, size = [], [], 0
            for doc, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
                h, c, digest = shingle_multiset(text)
                held.append((doc, row, digest, h, c))
                size += len(h)
                if size > 100_000:
                    rows += signed(held)
                    held, size = [], 0
            rows += signed(held)
            yield pd.DataFrame(rows, columns=["doc_id", "row", "text_key", "bands", "signature"])
            rows = held = None
            tidy()

    def signed(held: list) -> list[tuple]:
        if not held:
            return []
        sig = bag_min_hash([(h, c) for *_, h, c in held])
        code = np.repeat(np.arange(BANDS, dtype=_U)[None], len(held), axis=0)
        for j in range(ROWS):
            code = _mix(code * _U(0x9E3779B97F4A7C15) + sig.reshape(len(held), BANDS, ROWS)[:, :, j].astype(_U))
        code = code.astype(np.int64)
        return [(d, r, k, code[i] if len(h) else code[i, :0], sig[i].tobytes() if len(h) else b"") for i, (d, r, k, h, _) in enumerate(held)]

    rows = as_text(docs.select("doc_id", row_key().alias("row"), "text"), "doc_id")
    signed_rows = rows.mapInPandas(sign, "doc_id string, row long, text_key binary, bands array<long>, signature binary")
    return as_long(signed_rows, "doc_id")


def row_key() -> Column:
    """A hash of id and text: with the id it tells rows apart whose id is null or repeated."""
    return F.xxhash64("doc_id", "text")


def components(links: DataFrame, within: str | None = None) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b): component is the smallest node that can be reached.

    Each round takes the least label around a node and then the label of that label; every round is written to the
    shared folder. Rounds grow with the logarithm of the longest path.
    """
    edges = stored(links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).distinct(), "edges", within)
    labels = stored(edges.groupBy("node").agg(F.min("other").alias("_m")).select("node", F.least("node", "_m").alias("component")), "labels", within)
    while True:
        near = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("_near"))
        own = labels.join(near, "node").select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        following = stored(own.join(up, "component", "left").select("node", "_old", F.least("component", F.coalesce("_up", "component")).alias("component")), "labels", within)
        labels = following.select("node", "component")
        if not following.filter("_old <> component").head(1):
            return labels


def elements(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the k-th occurrence of a shingle is an element of its own. The Jaccard similarity of
    such sets is sum(min) / sum(max) of the counts."""
    if not (counts > 1).any():
        return hashes
    every = np.repeat(hashes, counts)
    k = np.arange(len(every)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(np.where(k > 0, _mix(every + k.astype(_U) * _U(0x9E3779B97F4A7C15)), every))


def verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) of text keys whose texts have a multiset overlap of THRESHOLD or more.

    bags: (text_key, elements) of at least all texts in ``pairs``, each once.
    """
    left = pairs.join(bags.select(F.col("text_key").alias("a"), F.col("elements").alias("_x")), "a")
    both = left.join(bags.select(F.col("text_key").alias("b"), F.col("elements").alias("_y")), "b")

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        def alike(p: bytes, q: bytes) -> bool:
            one, two = np.frombuffer(p, _U), np.frombuffer(q, _U)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            return shared > 0 and shared >= THRESHOLD * (len(one) + len(two) - shared) - 1e-9

        return pd.Series([alike(p, q) for p, q in zip(x, y, strict=True)], dtype=bool)

    return both.filter(near("_x", "_y")).select("a", "b")


def compare_all(keys: list[bytes], groups: list[bytes], bags: list[bytes], query: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Links from queries to rows of other groups, exact; for each query one link to each group that it resembles.

    A product of incidence matrices, some columns at a time; elements that one row alone has are left out. Beside the
    hashes themselves (once as they come, once sorted) a block takes a few arrays of GRID numbers and the products.
    """
    sets = [np.frombuffer(b, _U) for b in bags]
    size = np.array([len(x) for x in sets])
    q, m = np.flatnonzero(query), np.flatnonzero(~query)
    place = np.empty(len(sets), np.int32)  # a row's place among the queries or among the others
    place[q], place[m] = np.arange(len(q)), np.arange(len(m))
    every = np.concatenate(sets)
    order = np.argsort(every)
    every = every[order]
    same = every[1:] == every[:-1]
    kept = (np.append(same, False) | np.append(False, same))[: len(every)]
    row = np.repeat(np.arange(len(sets), dtype=np.int32), size)[order[kept]]
    every = every[kept]
    del order, same, kept
    code = np.cumsum(np.append(False, every[1:] != every[:-1])[: len(every)], dtype=np.int32)
    del every
    shared = np.zeros((len(q), len(m)), np.float32)
    step = max(1, min(GRID // len(sets), int(code[-1]) + 1 if len(code) else 0))
    asked, given = np.zeros((len(q), step), np.float32), np.zeros((len(m), step), np.float32)
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, step):
        lo, hi = np.searchsorted(code, [first, first + step])
        r, c = row[lo:hi], code[lo:hi] - first
        for grid, of in ((asked, query[r]), (given, ~query[r])):
            grid[:] = 0
            grid[place[r[of]], c[of]] = 1
        shared += asked @ given.T
    _, group = np.unique(np.array(groups, dtype=object), return_inverse=True)
    links, some = [], max(1, GRID // max(1, len(m)))
    for first in range(0, len(q), some):
        rows, x = q[first : first + some], shared[first : first + some]
        hit = (x > 0) & (x >= THRESHOLD * (size[rows][:, None] + size[m][None] - x) - 1e-4) & (group[rows][:, None] != group[m][None])
        i, j = np.nonzero(hit)
        _, one = np.unique(np.stack([i, group[m][j]]), axis=1, return_index=True)
        links += [(keys[rows[i[y]]], keys[m[j[y]]]) for y in one]
    return links


def links_across(split: DataFrame, bags: DataFrame) -> DataFrame:
    """Links (a, b) between components within buckets of more than PAIRED texts.

    split: (band, text_key, component, _n), _n being the texts of the bucket. Texts that aren't in a bucket's largest
    component are compared with all its texts, in blocks that bound what a task holds; only links come out, at most
    one for each text and component. A bucket's rows are dealt over as many parts as its size asks for.
    """
    dealt_over = F.ceil(F.col("_n") / BLOCK_TEXTS).cast("int")
    rows = split.join(bags, "text_key").withColumn("_bytes", F.octet_length("elements")).withColumn("_part", F.pmod(F.xxhash64(F.lit("part"), "text_key"), dealt_over).cast("int"))
    parts = rows.groupBy("band", "component").agg(F.count(F.lit(1)).alias("_c"), F.sum("_bytes").alias("_b"), F.max(dealt_over).alias("_parts"))
    whole = parts.groupBy("band").agg(F.max_by("component", F.struct("_c", "component")).alias("_main"), F.sum("_c").alias("_c"), F.sum("_b").alias("_b"), F.max("_parts").alias("_parts"))
    blocks = F.ceil(F.greatest(F.col("_c") / BLOCK_TEXTS, F.col("_b") / BLOCK_BYTES)).cast("int")
    copied = whole.select("band", "_main", blocks.alias("_k"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    dealt = rows.join(copied, ["band", "_part"])
    own, every = F.pmod(F.xxhash64("text_key"), F.col("_k")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    asked = dealt.filter(F.col("component") != F.col("_main")).select("band", own.alias("i"), every.alias("j"), F.lit(True).alias("query"), "text_key", "component", "elements")
    given = dealt.select("band", every.alias("i"), own.alias("j"), F.lit(False).alias("query"), "text_key", "component", "elements")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        query = pdf["query"].to_numpy(bool)
        found = compare_all(list(pdf["text_key"]), list(pdf["component"]), list(pdf["elements"]), query) if query.any() and not query.all() else []
        tidy()
        return pd.DataFrame(found, columns=["a", "b"])

    return asked.union(given).groupBy("band", "i", "j").applyInPandas(compare, "a binary, b binary").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """One row per input row: (doc_id, row, class), class being a key of one of the class's texts. Texts with equal
    words are copies. Texts without words are copies if equal, null counting as empty."""
    with workspace(docs.sparkSession, "near") as within:
        return stored(_classes(docs, within), "classes")


def _classes(docs: DataFrame, within: str) -> DataFrame:
    signed = stored(signatures(docs), "signatures", within)
    once = signed.groupBy("text_key").agg(F.min("row").alias("row"), F.any_value("bands").alias("bands"), F.any_value("signature").alias("signature"))
    once = stored(once, "texts", within)
    buckets = once.select("text_key", F.explode("bands").alias("band"))
    size = {"_n": (F.count(F.lit(1)), F.sum("_n"))}
    crowded = stored(with_group(buckets, ["band"], ["text_key"], size, F.col("_n") > 1).filter("_n > 1"), "buckets", within)
    sweep(docs.sparkSession)
    central = crowded.groupBy("text_key").agg(F.sum("_n").alias("_weight"))
    weighed = crowded.join(central, "text_key").select("band", "text_key", F.struct(F.col("_weight"), F.col("text_key")).alias("_rank"))
    centre = {"_best": (F.max("_rank"), F.max("_best"))}
    stars = with_group(weighed, ["band"], ["text_key"], centre, F.lit(True))
    pairs = stars.select(F.col("text_key").alias("a"), F.col("_best.text_key").alias("b")).filter("a <> b").distinct()
    candidates = alike(pairs, once, within)
    sweep(docs.sparkSession)

    links = stored(verified(candidates, _bags(docs, once, _both(candidates), within)), "links", within)
    labels = components(links, within)
    sweep(docs.sparkSession)
    of = crowded.join(labels.withColumnRenamed("node", "text_key"), "text_key", "left")
    of = of.select("band", "text_key", "_n", F.coalesce("component", "text_key").alias("component"))
    spread = {"_low": (F.min("component"), F.min("_low")), "_high": (F.max("component"), F.max("_high"))}
    split = with_group(of, ["band"], ["text_key"], spread, F.col("_low") != F.col("_high")).filter("_low IS NOT NULL")
    split = stored(split.select("band", "text_key", "component", "_n"), "split", within)
    small, large = split.filter(F.col("_n") <= PAIRED), split.filter(F.col("_n") > PAIRED)
    x, y = (small.select("band", F.col("text_key").alias(n), F.col("component").alias(f"c{n}")) for n in "ab")
    across = x.join(y, "band").filter("ca < cb").select("a", "b").distinct()
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    fresh = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    more = alike(fresh, once, within)
    sweep(docs.sparkSession)
    bags = _bags(docs, once, _both(more).union(large.select("text_key")), within)
    links = stored(links.union(verified(more, bags)).union(links_across(large, bags)), "links", within)

    labels = components(links, within).withColumnRenamed("node", "text_key")
    sweep(docs.sparkSession)
    return signed.select("doc_id", "row", "text_key").join(labels, "text_key", "left").select("doc_id", "row", F.coalesce("component", "text_key").alias("class"))


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per input row: (doc_id, class_id, class_size, kept).

    class_id is the smallest doc_id of the class (null if all are null), class_size counts its rows, kept holds for
    the row whose doc_id is class_id. Rows that repeat the smallest doc_id are all kept. No rows: no rows.
    """
    values = {"_first": (F.min("doc_id"), F.min("_first")), "_size": (F.count(F.lit(1)), F.sum("_size"))}
    found = with_group(classes(docs).drop("row"), ["class"], ["doc_id"], values, F.col("_size") > 1)
    first = F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_first"))
    return found.select("doc_id", first.alias("class_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("class_size"), first.eqNullSafe(F.col("doc_id")).alias("kept"))


def alike(pairs: DataFrame, once: DataFrame, within: str | None = None) -> DataFrame:
    """The pairs whose signatures agree in at least AGREE registers, written to the shared folder."""
    sig = once.select("text_key", "signature")
    joined = pairs.join(sig.toDF("a", "_x"), "a").join(sig.toDF("b", "_y"), "b")

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        left, right = (np.frombuffer(b"".join(v), np.uint32).reshape(len(v), -1) for v in (x, y))
        return pd.Series((left == right).sum(axis=1) >= AGREE)

    return stored(joined.filter(agree("_x", "_y")).select("a", "b"), "candidates", within)


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("text_key")).union(pairs.select("b"))


def _bags(docs: DataFrame, once: DataFrame, keys: DataFrame, within: str) -> DataFrame:
    """(text_key, elements) of the texts in ``keys``, each once: of copies only that with the smallest row key is read."""
    wanted = stored(once.select("text_key", F.col("row").alias("_row")).join(keys.distinct(), "text_key"), "wanted", within)
    if wanted.count() <= MAX_BROADCAST:  # else the texts are shuffled to their row keys
        wanted = F.broadcast(wanted)
    found = docs.select(row_key().alias("_row"), "text").join(wanted, "_row")

    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["text_key"], batch["text"], strict=True):
                h, c, digest = shingle_multiset(text)
                if digest == key:  # texts whose row keys collide may bring others
                    rows.append((key, elements(h, c).tobytes()))
            yield pd.DataFrame(rows, columns=["text_key", "elements"])
            rows = None
            tidy()

    bags = found.select("text_key", "text").mapInPandas(bag, "text_key binary, elements binary")
    return stored(bags.dropDuplicates(["text_key"]), "bags", within)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, with the columns of ``docs``: that with the smallest doc_id, nulls last, and of those with
    the smallest row key. Rows of equal id and text are one text: any of them."""
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("kept"), F.col("row").alias("kept_row"))
    row, kept, kept_row = unused(docs, "row", "kept", "kept_row")
    first = classes(docs).groupBy("class").agg(F.min(rank).alias("first")).select(F.col("first.kept").alias(kept), F.col("first.kept_row").alias(kept_row))
    keyed = docs.withColumn(row, row_key())
    same = (keyed[row] == first[kept_row]) & keyed["doc_id"].eqNullSafe(first[kept])
    return keyed.join(first, same, "left_semi").dropDuplicates(["doc_id", row]).drop(row)


def op5_near_dedup(spark, sf_dir):
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
