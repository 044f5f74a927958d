r"""Token ids as length-delimited binary records with an offset index.

A dataset is a folder with one ``.rec`` and one ``.idx`` file per shard and a
table ``manifest``.  Shards and the records in them ascend by doc_id.

Record (little-endian, integers unsigned unless said)::

    length   u64   bytes of the payload
    check    u32   masked CRC-32 of the 8 length bytes
    payload        doc_id i64, has_id u8, width u8 (2 or 4), ids of that width
    check    u32   masked CRC-32 of the payload

Index: one entry per record, ``offset u64, n_ids u64``.  A checksum is masked
as ``rotate_right(crc, 15) + 0xA282EAD8``, so that a checksum stored inside
checked bytes does not check itself.

Tasks write files named by attempt and return a manifest row each; the
manifest is written by Spark's own commit, so files of lost or repeated
attempts are never read.  ``read`` streams shards in order, ``shuffled`` deals
records by a seeded hash and fetches each through the index.

Encoding cuts texts where a non-space meets a space or a newline.  Byte-level
pre-tokens never cross such a border, so a piece's ids do not depend on its
surroundings, and a worker encodes each distinct piece once and gathers.

Defined results: a null or empty text holds the end id only; a null doc_id
comes first; rows of equal id are ordered by a hash of their text (equal rows
are interchangeable); special tokens' strings in a text are ordinary text; an
empty table gives a dataset without records; other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.common import stage
from tickwise.session import ensure_checkpoint_dir, ship_package

# Fixed values of the format.
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
CHECK = struct.Struct("<I")
PAYLOAD = struct.Struct("<qBB")
INDEX = np.dtype([("offset", "<u8"), ("n_ids", "<u8")])
#: How a byte-level vocabulary writes a byte: printable ones as themselves, the others by the next code point from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
SIGNS = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
#: Letters below are letters in every edition of the character tables.
LATIN_END = "\u0250"

MANIFEST = "shard long, records string, index string, n_records long, n_ids long"
#: Pieces, and ids of them, that a worker remembers at most; past it the memory starts anew.
REMEMBER = 1_000_000
REMEMBER_IDS = 1 << 25
#: Bytes read from a shard, and characters encoded, at a time.
READ_BYTES = 8 << 20
CHUNK_CHARS = 9 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


class Encoder:
    """Texts -> ids, each distinct piece encoded once."""

    #: Two white spaces in a row or the marker itself: such a text is cut by CUT.
    UNEVEN = r"[\t-\r\x1c-\x20\x{85}\p{Z}][\t-\r\x1c-\x20\x{85}\p{Z}]|\x01"
    #: One stop between a letter and a white space is a pre-token of its own.
    STOP = r"(\pL)([.,]) "
    CUT = re.compile(r"(?<=\S)(?=[ \n])")

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        told = json.loads(spec)
        # cutting is right for a plain byte-level vocabulary; any other one takes whole texts
        self.cuts = told["normalizer"] is None and told["pre_tokenizer"] is not None and told["pre_tokenizer"]["type"] == "ByteLevel" \
            and told["pre_tokenizer"].get("use_regex", True) and not told["pre_tokenizer"]["add_prefix_space"]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.used = np.empty(1 << 16, self.dtype), 0
        self.start, self.size = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces; a piece of letters is a single pre-token, so the vocabulary's model takes it as it is."""
        if not self.cuts:
            return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        split, found, rest = self.tokenizer.model.tokenize, [], []
        for i, p in enumerate(pieces):
            letters = p[1:] if p[:1] == " " else p
            if letters.isalpha() and (p.isascii() or max(letters) < LATIN_END):
                signs = p.replace(" ", SIGNS[32]) if p.isascii() else p.encode().decode("latin-1").translate(SIGNS)
                found.append([t.id for t in split(signs)])
            else:
                found.append(None)
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)):
            found[i] = e.ids
        return found

    def slots(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece in the memory; unknown ones are encoded and added."""
        known = self.known
        new = list(dict.fromkeys(itertools.filterfalse(known.__contains__, pieces)))
        for lo in range(0, len(new), 20_000):
            part = new[lo:lo + 20_000]
            found = self._encoded(part)
            sizes = np.fromiter(map(len, found), np.int64, len(part))
            ids = np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(sizes.sum()))
            k, n = len(known), len(ids)
            if self.used + n > len(self.ids):
                self.ids = np.resize(self.ids, 2 * (self.used + n))
            if k + len(part) > len(self.start):
                self.start, self.size = np.resize(self.start, 2 * (k + len(part))), np.resize(self.size, 2 * (k + len(part)))
            self.ids[self.used:self.used + n] = ids
            self.start[k:k + len(part)], self.size[k:k + len(part)] = self.used + np.cumsum(sizes) - sizes, sizes
            self.used += n
            known.update(zip(part, range(k, k + len(part))))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each); null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.cuts:
            found = self._encoded(texts.to_pylist())
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(sizes.sum())), sizes
        uneven = np.flatnonzero(pc.match_substring_regex(texts, self.UNEVEN).to_numpy(zero_copy_only=False))
        # a piece after a space starts with the marker, so that splitting at spaces keeps the space
        marked = pc.replace_substring(pc.replace_substring(texts, " ", " \x01"), "\n", " \n ")
        marked = pc.replace_substring_regex(marked, self.STOP, r"\1 \2 ")
        lists = pc.split_pattern(marked, " ")
        counts, values = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
        own: list[list[str]] = []
        if len(uneven):
            own = [self.CUT.split(texts[int(i)].as_py()) for i in uneven]
            keep = np.ones(len(texts), bool)
            keep[uneven] = False
            values = values.filter(pa.array(np.repeat(keep, counts)))
            counts[uneven] = [len(o) for o in own]
        pieces = values.dictionary_encode()
        spelled = self.slots([" " + p[1:] if p.startswith("\x01") else p for p in pieces.dictionary.to_pylist()])
        slot = spelled[pieces.indices.to_numpy()]
        del texts, marked, lists, values, pieces  # before the gather below
        if len(uneven):  # back to the order of the texts
            slot = np.concatenate([slot, self.slots([p for o in own for p in o])])
            order = np.concatenate([np.flatnonzero(keep), uneven])
            where = np.empty(len(counts), np.int64)
            where[order] = np.cumsum(counts[order]) - counts[order]
            slot = slot[_runs(where, counts)]
        size = self.size[slot]
        ids = self.ids[_runs(self.start[slot], size)]
        total = np.concatenate([[0], np.cumsum(size)])
        ends = np.cumsum(counts)
        if len(self.known) > REMEMBER or self.used > REMEMBER_IDS:
            self.forget()
        return ids, total[ends] - total[ends - counts]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run in a row."""
    ends = np.cumsum(sizes)
    small = not len(ends) or max(ends[-1], starts.max()) < 1 << 31
    at = np.repeat((starts - (ends - sizes)).astype(np.int32 if small else np.int64), sizes)
    at += np.arange(len(at), dtype=at.dtype)
    return at


_ENCODERS: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """The worker's encoder, kept between tasks."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about CHUNK_CHARS."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK_CHARS, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0) -> str:
    """Encode ``text`` with the tokenizer file, append ``end_id`` to each document and write the dataset; returns its folder.

    A shard per shuffle partition.  The tokenizer file is read on the driver and sent with the tasks (a vocabulary, no data).
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or f"{ensure_checkpoint_dir(spark)}/llm/token-records-{uuid.uuid4().hex}"
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    order = [F.col("doc_id").asc_nulls_first(), F.col("_h").asc(), F.col("_row").asc()]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"),
                        F.monotonically_increasing_id().alias("_row"))  # lets rows of one id be split
    ranged = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        context = TaskContext.get()
        encoder, shard = _encoder(spec.value), context.partitionId()
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{shard:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        end = end_id.to_bytes(encoder.dtype.itemsize, "little")
        offset, n_ids, n_records = 0, 0, 0
        with fs.open_output_stream(f"{base}/{name}.rec") as rec, fs.open_output_stream(f"{base}/{name}.idx") as idx:
            for chunk in (c for b in batches for c in _chunks(b)):
                ids, sizes = encoder.encode(chunk.column("text"))
                index, out, lo = np.empty(len(sizes), INDEX), [], 0
                for i, (doc, size) in enumerate(zip(chunk.column("doc_id").to_pylist(), sizes.tolist())):
                    record = framed(doc, ids[lo:lo + size].tobytes() + end, encoder.dtype.itemsize)
                    out.append(record)
                    index[i] = offset, size + 1
                    offset, lo = offset + len(record), lo + size
                rec.write(b"".join(out))
                idx.write(index.tobytes())
                n_ids, n_records = n_ids + int(index["n_ids"].sum()), n_records + len(sizes)
                del ids, out
                pa.default_memory_pool().release_unused()
        if n_records:
            yield pa.RecordBatch.from_pydict({"shard": [shard], "records": [f"{name}.rec"], "index": [f"{name}.idx"],
                                              "n_records": [n_records], "n_ids": [n_ids]})

    ranged.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards in order with the ids before each (``start``); one row per shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def framed(doc: int | None, ids: bytes, width: int) -> bytes:
    """One record."""
    payload = PAYLOAD.pack(doc or 0, doc is not None, width) + ids
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def fetched(f, offset: int) -> tuple[int | None, np.ndarray]:
    """The record at ``offset`` of an open shard."""
    f.seek(offset)
    head = f.read(HEAD.size)
    doc, ids, _ = unframe(memoryview(head + f.read(HEAD.unpack(head)[0] + CHECK.size)), 0)
    return doc, ids


def unframe(view: memoryview, at: int) -> tuple[int | None, np.ndarray, int] | None:
    """(doc_id, ids, next offset) of the record at ``at``; None if the bytes end before it does; ValueError if a checksum fails."""
    if len(view) - at < HEAD.size:
        return None
    length, check = HEAD.unpack_from(view, at)
    if masked(view[at:at + 8]) != check:
        raise ValueError(f"record length at {at} is damaged")
    lo, hi = at + HEAD.size, at + HEAD.size + length
    if len(view) < hi + CHECK.size:
        return None
    if masked(view[lo:hi]) != CHECK.unpack_from(view, hi)[0]:
        raise ValueError(f"record at {at} is damaged")
    doc, has, width = PAYLOAD.unpack_from(view, lo)
    ids = np.frombuffer(view[lo + PAYLOAD.size:hi], "<u2" if width == 2 else "<u4").astype("<u4")
    return (doc if has else None), ids, hi + CHECK.size


def _records(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of a shard, READ_BYTES at a time."""
    rest = b""
    while block := stream.read(READ_BYTES):
        rest, at = rest + block if rest else block, 0
        view = memoryview(rest)
        while found := unframe(view, at):
            yield found[0], found[1]
            at = found[2]
        rest = bytes(view[at:])
    if rest:
        raise ValueError("the shard ends inside a record")


def _scan(spark: SparkSession, folder: str, value, schema: str) -> DataFrame:
    """One row per record: doc_id, start and ``value(ids)``; a task reads whole shards."""
    ship_package(spark)
    shards = manifest(spark, folder)
    name, kind = schema.split(" ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        types = pa.int64() if kind == "long" else pa.list_(pa.int64())
        for row in (r for b in batches for r in b.to_pylist()):
            start, out, held = row["start"], [], 0

            def batch() -> pa.RecordBatch:
                doc, at, size, val = zip(*out)
                return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(size, pa.int64()),
                                                   pa.array(val, types)], names=["doc_id", "start", "n_tokens", name])
            with fs.open_input_stream(f"{base}/{row['records']}") as stream:
                for doc, ids in _records(stream):
                    out.append((doc, start, len(ids), value(ids)))
                    start, held = start + len(ids), held + len(ids)
                    if len(out) >= 10_000 or kind != "long" and held > 1 << 20:
                        yield batch()
                        out, held = [], 0
            if out:
                yield batch()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartitionByRange(n, "shard").mapInArrow(run, f"doc_id long, start long, n_tokens long, {name} {kind}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record, checksums verified."""
    return _scan(spark, folder, lambda ids: ids.astype(np.int64), "ids array<long>")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record; the CRC-32 is of the ids as 32-bit integers."""
    return _scan(spark, folder, lambda ids: zlib.crc32(ids.tobytes()), "ids_crc32 long")


def shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """(place, doc_id, ids): records dealt over partitions and ordered in them by a seeded hash, each fetched by its offset."""
    ship_package(spark)
    base = folder

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(base)
        for row in (r for b in batches for r in b.to_pylist()):
            with fs.open_input_stream(f"{root}/{row['index']}") as stream:
                while block := stream.read(INDEX.itemsize * 65_536):
                    at = np.frombuffer(block, INDEX)["offset"].astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"records": [row["records"]] * len(at), "offset": pa.array(at)})

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(base)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['records']}") as f:
                    doc, ids = fetched(f, row["offset"])
                yield pa.RecordBatch.from_arrays([pa.array([row["place"]], pa.int64()), pa.array([doc], pa.int64()),
                                                  pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], names=["place", "doc_id", "ids"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = manifest(spark, folder).repartitionByRange(n, "shard").mapInArrow(entries, "records string, offset long")
    # the shard's number, not its file name, so that a repeated write shuffles alike
    placed = index.withColumn("place", F.xxhash64(F.lit(seed), F.substring("records", 1, 11), "offset"))
    dealt = placed.repartition(n, "place").sortWithinPartitions("place")
    return dealt.mapInArrow(fetch, "place long, doc_id long, ids array<long>")
