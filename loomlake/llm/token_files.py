"""Token ids in binary files, coded by a static range asymmetric numeral system (rANS).

One frequency table, counted over all documents, is shared by all files. A file holds consecutive documents in
ascending order of doc_id: a JSON header, the documents' ids and lengths, and blocks. A block codes up to BLOCK ids
by LANES interleaved coders (id j belongs to lane j mod LANES), so each step codes a row of LANES ids at once. Blocks
are independent; every CHECKPOINT steps the lanes' states and the place in the stream are kept, so that decoding can
start there too. Table, blocks and the documents' ids carry CRC-32 values, and each is checked when read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.files import read_files, write_file
from loomlake.llm.shared import as_long, as_text, discard, scratch, tidy

BLOCK, LANES, CHECKPOINT = 1 << 18, 1024, 64
MAGIC = b"LLTOK1\n"
END_ID = 2
#: Characters of texts that are encoded together, and stems that the tokenizer gets in one call.
TOGETHER, LEARN = 8 << 20, 100_000
#: Stems whose ids an encoder keeps; beyond that it begins anew.
KNOWN = 1 << 20
#: A chunk that ends with ASCII punctuation (no apostrophe) after a Latin letter.
_STEM = r"(?s)^(?P<stem>.*[A-Za-zÀ-ÖØ-öø-ɏ])(?P<tail>[!-&(-/:-@\[-`{-~]+)$"
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
#: White space besides spaces and line feeds: texts with it aren't cut into chunks.
_ODD = re.compile("[\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0                　]")


class Table(NamedTuple):
    """freq, start: share and first slot of each id, of 2 ** bits slots; crc: of the frequencies."""

    freq: np.ndarray
    start: np.ndarray
    bits: int
    crc: int

    def slots(self) -> np.ndarray:
        """The id of each slot."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def frequency_table(counts: np.ndarray) -> Table:
    """Counts scaled to sum to a power of two, at least 1 where there is a count."""
    used = np.flatnonzero(counts)
    bits = max(16, int(np.ceil(np.log2(4 * max(len(used), 1)))))
    freq = np.zeros(len(counts), np.int64)
    if len(used):
        share = counts[used] / counts[used].sum() * (1 << bits)
        freq[used] = np.maximum(1, np.floor(share)).astype(np.int64)
        spare = (1 << bits) - int(freq.sum())
        order = used[np.argsort(-share, kind="stable")]
        while spare:  # the largest shares give or take what is over, in proportion at most
            step = np.minimum(np.maximum(1, freq[order] // 64), freq[order] - 1 if spare < 0 else abs(spare))
            step = np.minimum(step, np.maximum(0, abs(spare) - (np.cumsum(step) - step)))
            freq[order] += step if spare > 0 else -step
            spare = (1 << bits) - int(freq.sum())
    packed = freq.astype(np.uint32)
    return Table(freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64), bits, zlib.crc32(packed.tobytes()))


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """A block: head, the checkpoints (lane states and stream position), the stream of 32-bit words."""
    steps = -(-len(ids) // LANES)
    x = np.full(LANES, _LOW, np.uint64)
    chunks: list[np.ndarray] = []
    marks, words = [], 0
    limit = np.uint64(63 - table.bits)
    for t in range(steps - 1, -1, -1):
        row = ids[t * LANES : (t + 1) * LANES]
        n = len(row)
        f, c, y = table.freq[row], table.start[row], x[:n]
        full = y >= f << limit
        out = y[full].astype(np.uint32)
        chunks.append(out)
        words += len(out)
        y = np.where(full, y >> _32, y)
        q = y // f
        x[:n] = (q << np.uint64(table.bits)) + (y - q * f) + c
        if t % CHECKPOINT == 0:
            marks.append((x.copy(), words))
    stream = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.uint32)
    states = np.stack([m[0] for m in marks[::-1]]) if marks else np.zeros((0, LANES), np.uint64)
    places = np.array([words - m[1] for m in marks[::-1]], np.uint32)
    body = places.tobytes() + states.tobytes() + stream.tobytes()
    head = struct.pack("<IIIIII", len(ids), LANES, CHECKPOINT, len(marks), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body))
    return head + body


def decode_block(block: bytes, table: Table, slots: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a block, or from checkpoint ``first`` up to checkpoint ``last``; raises ValueError if it is damaged."""
    n, lanes, every, marks, ids_crc, body_crc = struct.unpack_from("<IIIIII", block)
    body = block[24:]
    if zlib.crc32(body) != body_crc:
        raise ValueError("damaged block")
    places = np.frombuffer(body, np.uint32, marks)
    states = np.frombuffer(body, np.uint64, marks * lanes, 4 * marks).reshape(marks, lanes)
    stream = np.frombuffer(body, np.uint32, offset=4 * marks + 8 * marks * lanes)
    begin, end = first * every * lanes, n if last is None else min(n, last * every * lanes)
    out = np.empty(max(0, end - begin), np.uint32)
    if len(out):
        x, at = states[first].copy(), int(places[first])
        mask, bits = np.uint64((1 << table.bits) - 1), np.uint64(table.bits)
        for pos in range(begin, end, lanes):
            k = min(lanes, n - pos)
            slot = x[:k] & mask
            ids = slots[slot.astype(np.int64)]
            y = table.freq[ids] * (x[:k] >> bits) + slot - table.start[ids]
            low = np.flatnonzero(y < _LOW)
            y[low] = (y[low] << _32) | stream[at : at + len(low)]
            at += len(low)
            x[:k] = y
            out[pos - begin : pos - begin + k] = ids
    if first == 0 and last is None and zlib.crc32(out.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("damaged ids")
    return out


def encode_file(docs: list[tuple[int | None, np.ndarray]], table: Table, part: int = 0, first: int = 0) -> Iterator[bytes]:
    """The parts of a file of (doc_id, ids) in the given order; a null doc_id is kept as null. first: the ids of the
    files before it of its part."""
    lengths = np.array([len(x) for _, x in docs], np.uint64)
    names = np.array([0 if d is None else d for d, _ in docs], np.int64)
    nulls = np.array([d is None for d, _ in docs], bool)
    ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0, np.uint32)
    index = zlib.compress(names.tobytes() + lengths.tobytes() + nulls.tobytes(), 3)
    blocks = [encode_block(ids[i : i + BLOCK], table) for i in range(0, len(ids), BLOCK)]
    head = {"part": part, "first": first, "docs": len(docs), "ids": len(ids), "table": table.crc, "index": len(index), "index_crc": zlib.crc32(index), "blocks": [len(b) for b in blocks]}
    text = json.dumps(head).encode()
    yield MAGIC + struct.pack("<I", len(text)) + text + index
    yield from blocks


def file_head(data: bytes) -> tuple[dict, int]:
    """The header of a file and where it ends; raises ValueError if it can't be read."""
    if not data.startswith(MAGIC):
        raise ValueError("not a token file")
    at = len(MAGIC) + 4
    end = at + struct.unpack_from("<I", data, at - 4)[0]
    return json.loads(data[at:end]), end


def decode_file(data: bytes, table: Table, slots: np.ndarray | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """The (doc_id, ids) of a file, in order, a block at a time; raises ValueError if anything in it is damaged."""
    head, at = file_head(data)
    if head["table"] != table.crc:
        raise ValueError("another frequency table")
    index = data[at : at + head["index"]]
    if zlib.crc32(index) != head["index_crc"]:
        raise ValueError("damaged index")
    raw, n = zlib.decompress(index), head["docs"]
    names, lengths = np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.uint64, n, 8 * n).astype(np.int64)
    nulls = np.frombuffer(raw, bool, n, 16 * n)
    at += head["index"]
    slots = table.slots() if slots is None else slots
    held, doc = np.zeros(0, np.uint32), 0
    for size in head["blocks"]:
        held = np.concatenate([held, decode_block(data[at : at + size], table, slots)])
        at += size
        used = 0
        while doc < n and used + lengths[doc] <= len(held):
            yield (None if nulls[doc] else int(names[doc])), held[used : used + lengths[doc]]
            used += lengths[doc]
            doc += 1
        held = held[used:]
    for d in range(doc, n):
        if lengths[d]:
            raise ValueError("blocks are missing")
        yield (None if nulls[d] else int(names[d])), held[:0]


def _gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` that begin at ``first`` and have ``size`` values, one after another."""
    at = np.repeat(first - np.cumsum(size) + size, size)
    at += np.arange(len(at), dtype=at.dtype)
    return flat[at]


class Encoder:
    """A tokenizer that encodes each different chunk of some texts once. A single space or line feed between two
    characters that aren't white space always starts a token, so texts are cut there: a line feed before a space is a
    token of its own, and so is one before a word. Punctuation that ends a chunk after a Latin letter is apart from the
    letter too: stems and tails of chunks are encoded apart. Other texts are encoded whole. The ids of at most KNOWN
    stems, and of those of one more group of texts, are kept between calls."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(spec)
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        feed = self._ids("\n")
        parts = [self._ids(x) for x in ("a", " b", "c")]
        joined = np.concatenate([parts[0], feed, parts[1], feed, parts[2]])
        self.feed = int(feed[0]) if len(feed) == 1 and np.array_equal(self._ids("a\n b\nc"), joined) else None
        self._forget()

    def _forget(self) -> None:
        self.known, self.flat = pa.array([], pa.large_string()), np.zeros(0, np.uint32)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _by_feeds(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of texts that each begin with a line feed, all in one; where those of each begin, and how many there are."""
        ids = [self._ids("".join(texts.slice(i, LEARN).to_pylist())) for i in range(0, len(texts), LEARN)]
        flat = np.concatenate([np.zeros(0, np.uint32), *ids])
        first = np.flatnonzero(flat == self.feed)
        if len(first) != len(texts):
            raise ValueError("the tokenizer joins line feeds with words")
        return flat, first, np.diff(first, append=len(flat))

    def _places(self, stems: pa.Array) -> np.ndarray:
        """Where the ids of different stems are among those kept, after those not yet known were encoded."""
        if len(self.known) > KNOWN:
            self._forget()
        found = pc.index_in(stems, value_set=self.known)
        new = stems.filter(pc.is_null(found))
        place = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.known) + np.arange(len(new))
        if len(new):
            flat, first, size = self._stems(new)
            self.first, self.size = np.append(self.first, first + len(self.flat)), np.append(self.size, size)
            self.known, self.flat = pa.concat_arrays([self.known, new]), np.append(self.flat, flat)
        return place

    def _stems(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of stems; one that starts with a carriage return begins a text."""
        opens = pc.match_substring_regex(stems, "^[\r\n]")
        begins = pc.starts_with(stems, "\r").to_numpy(zero_copy_only=False)
        words = pc.replace_substring_regex(stems, "^[^\r\n]", "\n \\0")
        words = pc.replace_substring(words, "\r", "\n", max_replacements=1)
        flat, first, size = self._by_feeds(words)
        skip = 1 - (opens.to_numpy(zero_copy_only=False) & ~begins)  # the feed is put in, but for chunks of their own feed
        return flat, first + skip, size - skip

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different chunks in one, where those of each begin, and how many there are."""
        found = pc.extract_regex(chunks, _STEM)
        stems = pc.coalesce(pc.struct_field(found, "stem"), chunks).dictionary_encode()
        tails = pc.fill_null(pc.struct_field(found, "tail"), "").dictionary_encode()
        place = self._places(stems.dictionary)
        flat, first, size = self.flat, self.first[place], self.size[place]
        ends = [self._ids(x) if x else np.zeros(0, np.uint32) for x in tails.dictionary.to_pylist()]
        n = np.array([len(x) for x in ends], np.int64)
        stem, tail = (x.indices.to_numpy(zero_copy_only=False) for x in (stems, tails))
        firsts = np.stack([first[stem], (len(flat) + np.cumsum(n) - n)[tail]], axis=1).ravel()
        sizes = np.stack([size[stem], n[tail]], axis=1)
        size = sizes.sum(axis=1)
        return _gather(np.concatenate([flat, *ends]), firsts, sizes.ravel()), np.cumsum(size) - size, size

    def _joined(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of texts that can be cut: chunks are numbered, and their ids gathered by number."""
        lines = pc.replace_substring(pa.array(["\r" + x for x in texts], pa.large_string()), "\n", " \n")
        cut = pc.split_pattern(lines, " ")
        words = cut.flatten().dictionary_encode()
        flat, first, size = (x.astype(np.int32) if x.dtype == np.int64 else x for x in self._chunks(words.dictionary))
        number = words.indices.to_numpy(zero_copy_only=False)
        each = size[number]
        bounds = np.append(0, np.cumsum(each, dtype=np.int64))[cut.offsets.to_numpy()]
        ids = _gather(flat, first[number], each)
        return (ids[i:j].tobytes() for i, j in zip(bounds, bounds[1:], strict=False))

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text the ids as little-endian unsigned 32-bit integers."""
        out: dict[str, bytes] = {}
        some, size = [], 0
        for text in dict.fromkeys(texts):
            odd = self.feed is None or len(text) > TOGETHER or not text or text[0] in " \n" or text[-1] in " \n"
            if odd or any(x in text for x in ("  ", " \n", "\n ", "\n\n", *self.specials)) or _ODD.search(text):
                out[text] = self._ids(text).tobytes()
                continue
            if size + len(text) > TOGETHER:
                out.update(zip(some, self._joined(some), strict=True))
                some, size = [], 0
            some.append(text)
            size += len(text)
        if some:
            out.update(zip(some, self._joined(some), strict=True))
        return [out[x] for x in texts]


@lru_cache(maxsize=1)
def _encoder(spec: str, job: str) -> Encoder:
    """The encoder of a Python worker, which runs many tasks of a job; another job begins without known stems."""
    return Encoder(spec)


def token_ids(docs: DataFrame, spec: str) -> DataFrame:
    """(doc_id, n_tokens, crc, packed): the ids of whole texts and END_ID, packed with zstd. A null text is empty."""
    shared, job = docs.sparkSession.sparkContext.broadcast(spec), uuid.uuid4().hex

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        import zstandard

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(shared.value, job)
        packer, end = zstandard.ZstdCompressor(1), np.array([END_ID], np.uint32).tobytes()
        for batch in batches:
            rows, texts = [], [x or "" for x in batch["text"]]
            for raw in encoder.encode(texts):
                ids = np.frombuffer(raw + end, np.uint32)
                small = ids.astype(np.uint16) if ids.max() < 1 << 16 else ids
                rows.append((batch["doc_id"].iloc[len(rows)], len(ids), zlib.crc32(ids.tobytes()), packer.compress(small.tobytes())))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "crc", "packed"])
            tidy()

    rows = as_text(docs.select("doc_id", "text"), "doc_id")
    return as_long(rows.mapInPandas(encode, "doc_id string, n_tokens long, crc long, packed binary"), "doc_id")


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32).astype(np.uint32)


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents: a dense count per task, summed by id."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if len(batch):
                ids = np.concatenate([_unpacked(p, n) for p, n in zip(batch["packed"], batch["n_tokens"], strict=True)])
                total += np.bincount(ids, minlength=size)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    found = tokens.select("n_tokens", "packed").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[found["id"].to_numpy(int)] = found["n"].to_numpy()
    return out


class Written(NamedTuple):
    """parts: the documents and ids of each range of ids; a file says how many ids of its range are before it."""

    path: str
    table: Table
    parts: list[tuple[int, int, int]]


def write_token_files(docs: DataFrame, path: str, spec: str, vocabulary: int) -> Written:
    """Encodes (doc_id, text) into files below ``path`` in ascending order of doc_id (nulls first; equal ids in order
    of their ids' check sum). ``vocabulary``: one more than the largest id. No documents: no files."""
    spark = docs.sparkSession
    draft = scratch(spark, "tokens")
    token_ids(docs, spec).write.option("compression", "none").parquet(draft)
    tokens = spark.read.parquet(draft)
    table = frequency_table(count_ids(tokens, vocabulary))
    shared = spark.sparkContext.broadcast(table)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, files, docs, ids = TaskContext.get().partitionId(), 0, 0, 0

        def save(held: list, n: int) -> None:
            nonlocal files, docs, ids
            write_file(f"{path}/part-{part:06d}-{files:06d}.tok", encode_file(held, shared.value, part, ids))
            files, docs, ids = files + 1, docs + len(held), ids + n

        held, n = [], 0
        for batch in batches:
            for doc, size, packed in zip(batch["doc_id"], batch["n_tokens"], batch["packed"], strict=True):
                held.append((None if doc is None else int(doc), _unpacked(packed, size)))
                n += size
                if n >= 8 * BLOCK:
                    save(held, n)
                    held, n = [], 0
        if held:
            save(held, n)
        if files:
            yield pd.DataFrame({"part": [part], "docs": [docs], "ids": [ids]})
        tidy()

    ordered = tokens.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "crc", "n_tokens")
    parts = as_text(ordered.select("doc_id", "n_tokens", "packed"), "doc_id").mapInPandas(write, "part long, docs long, ids long").collect()  # a row per partition
    discard(spark, draft)
    shared.unpersist()
    return Written(path, table, sorted((r["part"], r["docs"], r["ids"]) for r in parts))


def read_token_files(spark: SparkSession, written: Written) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids binary): decoded from the files, start counted over all files."""
    base, starts = 0, {}
    for part, _, n in written.parts:
        starts[part] = base
        base += n
    shared = spark.sparkContext.broadcast((written.table, starts))
    schema = "doc_id string, start long, n_tokens long, ids_crc32 long, ids binary"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, starts = shared.value
        slots = table.slots()
        for batch in batches:
            for data in batch["content"]:
                head, rows = file_head(data)[0], []
                at = starts[head["part"]] + head["first"]
                for doc, ids in decode_file(data, table, slots):
                    raw = ids.astype("<u4").tobytes()
                    rows.append((None if doc is None else str(doc), at, len(ids), zlib.crc32(raw), raw))
                    at += len(ids)
                    if len(rows) >= 2000:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)
        tidy()

    if not written.parts:
        return as_long(spark.createDataFrame([], schema), "doc_id")
    return as_long(read_files(spark, written.path, "*.tok").mapInPandas(read, schema), "doc_id")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def default_tokenizer() -> tuple[str, int]:
    """The JSON of the public byte-level BPE with 50,257 ids, and one more than its largest id."""
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    return spec, Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True)


def token_index(docs: DataFrame, spec: str | None = None, vocabulary: int | None = None) -> DataFrame:
    """Writes the token files of ``docs`` and reads them back: (doc_id, start, n_tokens, ids_crc32)."""
    if spec is None or vocabulary is None:
        spec, vocabulary = default_tokenizer()
    written = write_token_files(docs, scratch(docs.sparkSession, "token-files"), spec, vocabulary)
    return read_token_files(docs.sparkSession, written).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_token_files(spark, sf_dir):
    return token_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
