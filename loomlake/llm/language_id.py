"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased and everything but letters becomes a single space. For each language the n-gram counts of a
sample of labelled texts give an interpolated Kneser-Ney model. The n-grams of all languages are kept together, per
order, in an array of 64-bit hashes in sorted order beside a matrix of log probabilities (a column per language);
an n-gram that no language has falls back to the next lower order with the context's weight. A text gets the
language with the lowest cross-entropy per letter, a confidence, and is rejected where even that is too high.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import tidy

ORDER = 4
#: About so many texts per language are sampled to fit the models (all, where there are fewer), by a hash of the id,
#: and so many more to calibrate confidence and rejection.
MAX_FIT, MAX_CALIBRATE = 1500, 300
#: The share of a language's own texts that sets its ceiling.
WORST = 0.995
#: Rejection needs so many letters: shorter texts say too little.
MIN_LETTERS = 20
#: Characters scored at once; bounds the memory of a task.
WINDOW = 1 << 19
_SPACE = 32
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """A table over all code points, built once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def normalise(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, a single space for anything between, none at the start."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[points]
    before = np.empty_like(letter)
    before[:1], before[1:] = False, letter[:-1]
    return np.where(letter, points, _SPACE)[letter | before]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _extend(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hashes of n-grams, each with one more character in front: last character first, so suffixes come for free."""
    return _mix(h * np.uint64(0x9E3779B97F4A7C15) + points.astype(np.uint64) + np.uint64(1))


def _gram_hashes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1..order, the hash of the k-gram that ends at each position from order - 1 on."""
    n = len(points) - order + 1
    out = [_extend(np.zeros(n, np.uint64), points[order - 1 :])]
    for k in range(1, order):
        out.append(_extend(out[-1], points[order - 1 - k : order - 1 - k + n]))
    return out


class _Hashes(NamedTuple):
    """Sorted hashes, and for each prefix of bits where it starts."""

    keys: np.ndarray
    starts: np.ndarray
    shift: np.uint64
    depth: int

    @classmethod
    def of(cls, keys: np.ndarray) -> _Hashes:
        bits = max(4, int(np.ceil(np.log2(len(keys) + 1))) + 1)
        starts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int64)
        depth = int(np.diff(np.append(starts, len(keys))).max(initial=1))
        return cls(np.append(keys, np.uint64(0)), starts, np.uint64(64 - bits), depth)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Positions of ``h``, -1 where absent."""
        at = self.starts[(h >> self.shift).astype(np.int64)]
        last = len(self.keys) - 1
        hit = self.keys[np.minimum(at, last - 1)] == h if last else np.zeros(len(h), bool)
        out = np.where(hit, at, -1)
        left = np.flatnonzero(~hit)
        for step in range(1, self.depth):
            if not len(left):
                break
            pos = np.minimum(at[left] + step, last)
            ok = (self.keys[pos] == h[left]) & (pos < last)
            out[left[ok]] = pos[ok]
            left = left[~ok]
        return out


class Models(NamedTuple):
    """tables[k - 1]: hashes of k-grams with log probabilities; backoff[k - 1]: of k-gram contexts with log weights."""

    languages: list[str]
    tables: list[tuple[_Hashes, np.ndarray]]
    backoff: list[tuple[_Hashes, np.ndarray]]
    unseen: np.ndarray
    sharpness: float
    ceiling: np.ndarray


def _score_points(m: Models, points: np.ndarray) -> np.ndarray:
    """Log probability of each character after the first ORDER - 1, a column per language."""
    order = len(m.tables)
    grams = _gram_hashes(points, order)
    contexts = _gram_hashes(points[:-1], order - 1) if order > 1 else []
    n = len(grams[0])
    found = m.tables[-1][0].find(grams[-1])
    out = m.tables[-1][1][found]
    left = np.flatnonzero(found < 0)
    out[left] = 0
    for k in range(order - 1, 0, -1):
        if not len(left):
            return out
        at = m.backoff[k - 1][0].find(contexts[k - 1][-n:][left])
        out[left] += np.where((at >= 0)[:, None], m.backoff[k - 1][1][at], 0)
        found = m.tables[k - 1][0].find(grams[k - 1][left])
        hit = found >= 0
        out[left[hit]] += m.tables[k - 1][1][found[hit]]
        left = left[~hit]
    out[left] += m.unseen
    return out


def score_texts(m: Models, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the number of characters scored, and the summed log probabilities (a column per language)."""
    order, sums, sizes = len(m.tables), np.zeros((len(texts), len(m.languages))), np.zeros(len(texts), np.int64)
    pad = np.full(order - 1, _SPACE, np.uint32)
    held: list[np.ndarray] = []
    owners: list[int] = []
    waiting = 0

    def flush() -> None:
        nonlocal waiting
        waiting = 0
        if not held:
            return
        logs = _score_points(m, np.concatenate(held))
        at = 0
        for owner, part in zip(owners, held, strict=True):
            n = len(part) - order + 1
            sums[owner] += logs[at : at + n].sum(axis=0, dtype=np.float64)
            sizes[owner] += n
            at += n + order - 1  # the characters across two parts belong to neither
        held.clear()
        owners.clear()

    for i, text in enumerate(texts):
        tail = pad
        for first in range(0, len(text or ""), WINDOW):
            points = normalise("a" + text[first : first + WINDOW])[1:] if first else normalise(text[:WINDOW])
            if len(points) and tail[-1] == _SPACE and points[0] == _SPACE:
                points = points[1:]
            if not len(points) or not (points != _SPACE).any():
                continue
            part = np.concatenate([tail, points])
            tail = part[len(part) - order + 1 :]
            held.append(part)
            owners.append(i)
            waiting += len(part)
            if waiting > WINDOW:
                flush()
    flush()
    return sizes, sums


# Fitting ----------------------------------------------------------------------------------------------------------


def _unpack(rows: pd.DataFrame, order: int) -> np.ndarray:
    """The code points of counted n-grams, a row each, first character first."""
    head, last = rows["head"].to_numpy(np.uint64), rows["last"].to_numpy(np.uint32)
    cols = [(head >> np.uint64(21 * j) & np.uint64(0x1FFFFF)).astype(np.uint32) for j in range(order - 1)]
    return np.stack([*cols, last], axis=1)


def count_grams(sample: DataFrame, order: int) -> pd.DataFrame:
    """(lang, head, last, n) of all n-grams of the sampled texts; bounded as the sample is."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                parts = []
                for text in texts:
                    points = normalise(text)
                    parts.append(np.concatenate([np.full(order - 1, _SPACE, np.uint32), points]))
                heads, lasts = [], []
                for p in parts:
                    n = len(p) - order + 1
                    head = np.zeros(n, np.uint64)
                    for j in range(order - 1):
                        head |= p[j : j + n].astype(np.uint64) << np.uint64(21 * j)
                    heads.append(head)
                    lasts.append(p[order - 1 :])
                pair = pd.DataFrame({"head": np.concatenate(heads).astype(np.int64), "last": np.concatenate(lasts).astype(np.int32)})
                yield pair.groupby(["head", "last"]).size().reset_index(name="n").assign(lang=lang)[["lang", "head", "last", "n"]]

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, head long, last int, n long")
    return counted.groupBy("lang", "head", "last").agg(F.sum("n").alias("n")).toPandas()


def _hash_rows(grams: np.ndarray) -> np.ndarray:
    h = np.zeros(len(grams), np.uint64)
    for j in range(grams.shape[1] - 1, -1, -1):
        h = _extend(h, grams[:, j])
    return h


def kneser_ney(counts: pd.DataFrame, order: int) -> Models:
    """Interpolated Kneser-Ney models of all languages in ``counts``: absolute discount n1 / (n1 + 2 n2) by order,
    lower orders from the number of characters that precede an n-gram, and an even share for unseen characters."""
    languages = sorted(counts["lang"].unique())
    grams, inverse = np.unique(_unpack(counts, order), axis=0, return_inverse=True)
    column = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    tally = np.zeros((len(grams), len(languages)))
    np.add.at(tally, (inverse.ravel(), column), counts["n"].to_numpy())
    levels = [(grams, tally)]
    for _ in range(order - 1):  # continuation counts: how many distinct characters stand in front
        grams, inverse = np.unique(levels[0][0][:, 1:], axis=0, return_inverse=True)
        fewer = np.zeros((len(grams), len(languages)))
        np.add.at(fewer, inverse.ravel(), (levels[0][1] > 0).astype(float))
        levels.insert(0, (grams, fewer))
    alphabet = np.maximum((levels[0][1] > 0).sum(axis=0), 1)
    even = 1.0 / (alphabet + 1)
    tables, backoff, below = [], [], None
    for k, (grams, tally) in enumerate(levels, 1):
        ones, twos = (tally == 1).sum(axis=0), (tally == 2).sum(axis=0)
        discount = np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5).clip(0.1, 0.95)
        contexts, of = np.unique(grams[:, :-1], axis=0, return_inverse=True) if k > 1 else (np.zeros((1, 0), np.uint32), np.zeros(len(grams), int))
        of = of.ravel()
        total, kinds = np.zeros((len(contexts), len(languages))), np.zeros((len(contexts), len(languages)))
        np.add.at(total, of, tally)
        np.add.at(kinds, of, (tally > 0).astype(float))
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        if k == 1:
            lower = np.broadcast_to(even, tally.shape)
        else:
            hashes = _hash_rows(grams[:, 1:])
            lower = below[1][np.searchsorted(below[0], hashes)]
        p = np.where(total[of] > 0, np.maximum(tally - discount, 0) / np.maximum(total[of], 1), 0) + weight[of] * lower
        hashes = _hash_rows(grams)
        rank = np.argsort(hashes)
        below = (hashes[rank], p[rank])
        tables.append((_Hashes.of(hashes[rank]), np.log(p[rank]).astype(np.float32)))
        if k > 1:
            hashes = _hash_rows(contexts)
            rank = np.argsort(hashes)
            backoff.append((_Hashes.of(hashes[rank]), np.log(weight[rank]).astype(np.float32)))
        else:
            unseen = np.log(np.maximum(weight[0] * even, 1e-12)).astype(np.float32)
    return Models(languages, tables, backoff, unseen, 1.0, np.full(len(languages), np.inf))


def calibration(m: Models, texts: DataFrame) -> pd.DataFrame:
    """(lang, letters, sums, noise) of each of (lang, text), scored in tasks: its letters, its log likelihood in each language,
    and the least cross-entropy of its letters in random order. Only numbers come to the driver."""
    shared = texts.sparkSession.sparkContext.broadcast(m)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                (n,), (sums,) = score_texts(shared.value, [text])
                (k,), (mixed,) = score_texts(shared.value, [_shuffled(text, np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace"))))])
                rows.append((lang, int(n), sums.astype(float), float((-mixed / k).min()) if k else float("nan")))
            yield pd.DataFrame(rows, columns=["lang", "letters", "sums", "noise"])
        tidy()

    found = texts.mapInPandas(score, "lang string, letters long, sums array<double>, noise double").toPandas()
    shared.unpersist()
    return found


def calibrate(m: Models, tried: pd.DataFrame) -> Models:
    """Sets how sharply entropies become confidences (least log loss on texts the models weren't fitted on), and for
    each language the cross-entropy beyond which a text is rejected: half-way between what WORST of its own texts keep
    below (so that a mislabelled text doesn't lift it) and the same letters in random order. tried: see ``calibration``."""
    tried = tried[tried["letters"] >= MIN_LETTERS]
    if not len(tried):
        return m
    own = np.array([m.languages.index(x) for x in tried["lang"]])
    entropy = -np.stack(list(tried["sums"])) / tried["letters"].to_numpy()[:, None]
    best, sharpness, each = np.inf, 1.0, np.arange(len(own))
    for s in (0.5, 1, 2, 4, 8, 16, 32):
        loss = -np.log(_confidence(entropy, s)[each, own].clip(1e-9)).mean()
        if loss < best - 1e-4:
            best, sharpness = loss, float(s)
    noise, ceiling = tried["noise"].to_numpy(), np.full(len(m.languages), np.inf)
    for i in range(len(m.languages)):
        mine = own == i
        if mine.any():
            worst = np.quantile(entropy[mine, i], WORST)
            ceiling[i] = max(worst + 0.1, (worst + np.median(noise[mine])) / 2)
    return m._replace(sharpness=sharpness, ceiling=ceiling)


def _shuffled(text: str, rng: np.random.Generator) -> str:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return rng.permutation(points).tobytes().decode("utf-32-le")


def _confidence(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(-sharpness * (entropy - entropy.min(axis=1, keepdims=True)))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, order: int = ORDER, max_fit: int = MAX_FIT, max_calibrate: int = MAX_CALIBRATE) -> Models | None:
    """Models of the languages in ``docs`` (text, lang; with doc_id), or None without any labelled text.

    The caller chooses which rows may be learned from. Rows with a null text or lang are left out.
    """
    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(1.0 / n))])
    place = known.withColumn("_place", draw / share[F.col("lang")])  # uniform over 0 .. the language's texts
    counts = count_grams(place.filter(F.col("_place") < max_fit), order)
    if not len(counts):
        return None
    models = kneser_ney(counts, order)
    first = F.when(F.col("lang").isin([k for k, n in sizes.items() if n <= max_fit]), 0).otherwise(max_fit)  # 0: no others are left
    tried = place.filter((F.col("_place") >= first) & (F.col("_place") < first + max_calibrate)).select("lang", "text")
    fitted = calibrate(models, calibration(models, tried.filter(F.col("lang").isin(models.languages))))
    del counts
    tidy()
    return fitted


def identify(models: Models | None, text: Column, spark) -> Column:
    """struct<lang string, score double, rejected boolean, entropy double, letters long> of a text.

    lang is ``und``, score 0 and rejected true for null texts and texts without a letter, and where there are no
    models. Equal entropies: the first language in order of name.
    """
    shared = spark.sparkContext.broadcast(models)

    @F.pandas_udf("lang string, score double, rejected boolean, entropy double, letters long")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            if m is None:
                yield pd.DataFrame({"lang": "und", "score": 0.0, "rejected": True, "entropy": np.nan, "letters": 0}, index=texts.index)
                continue
            sizes, sums = score_texts(m, [None if x is None else x for x in texts])
            entropy = -sums / np.maximum(sizes, 1)[:, None]
            best = entropy.argmin(axis=1)
            each = np.arange(len(best))
            high = (sizes >= MIN_LETTERS) & (entropy[each, best] > m.ceiling[best])
            none = sizes == 0
            score = _confidence(entropy, m.sharpness)[each, best]
            yield pd.DataFrame(
                {
                    "lang": np.where(none, "und", np.array(m.languages, object)[best]),
                    "score": np.where(none, 0.0, score),
                    "rejected": none | high,
                    "entropy": np.where(none, np.nan, entropy[each, best]),
                    "letters": sizes,
                }
            )
        tidy()

    return predict(text)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def language_of_documents(docs: DataFrame, into: str = "_language") -> DataFrame:
    """``docs`` with a column ``into`` (see identify); learned from rows that aren't held out. A null doc_id is
    not learned from and counts as held out. Of equal entropies the first language by name counts."""
    models = fit(docs.filter(~F.coalesce(held_out(), F.lit(True))))
    return docs.withColumn(into, identify(models, F.col("text"), docs.sparkSession))


def op2_language_id(spark, sf_dir):
    docs = language_of_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    x = F.col("_language")
    return docs.select(
        "doc_id", F.coalesce(held_out(), F.lit(True)).alias("held_out"), x["lang"].alias("lang_pred"), x["score"].alias("score"),
        x["rejected"].alias("rejected"), x["entropy"].alias("entropy"),
    )
