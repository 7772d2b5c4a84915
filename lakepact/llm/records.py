"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A data file is a sequence of frames, all numbers little-endian:

    uint64 length | uint32 masked crc of those 8 bytes | payload | uint32 masked crc of the payload

The crc is CRC-32 as in zlib; masking rotates it right by 15 bits and adds 0xa282ead8, so the
checksum of data that itself holds checksums stays sound. The payload is int64 doc_id (0 for null), uint8 flags (1: doc_id is null; 2:
ids take two bytes, else four), uint32 token count, then the ids. Vocabularies of up to 65,536 ids
are written in two bytes. Beside each data file lies
an index file: one int64 offset per frame and the file's length at the end, so record k of a file
is read by two seeks.

Files are written in ascending doc_id order (nulls first, repeated ids by text): a range
partitioning on doc_id, sorted inside each partition, one file per partition. A task writes under
a name of its own attempt and reports it; only reported files are in the manifest, so a lost or
repeated task leaves no wrong file behind. Reading back verifies every checksum.

Defined cases: null or empty text is one end id; whole texts are encoded; repeated rows are
separate records in a row; an empty table writes no file and reads back empty; extra columns are
not stored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepact.llm.common import checkpoint_root, cut, map_batches, slices, text_bytes

MASK_DELTA = 0xA282EAD8
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
# Distinct words whose ids a worker remembers (about 200 bytes each).
CACHE_WORDS = 1_000_000
FLUSH_BYTES = 4 << 20
PLAIN = b"abcdefghijklmnopqrstuvwxyz"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def read_frame(data: memoryview) -> bytes:
    """The payload of one frame, its length and both checksums verified."""
    if len(data) < 16:
        raise ValueError("truncated record")
    (length,), (head_crc,) = struct.unpack_from("<Q", data, 0), struct.unpack_from("<I", data, 8)
    if masked_crc(bytes(data[:8])) != head_crc or len(data) != length + 16:
        raise ValueError("damaged record length")
    payload = bytes(data[12:12 + length])
    if masked_crc(payload) != struct.unpack_from("<I", data, 12 + length)[0]:
        raise ValueError("damaged record payload")
    return payload


def pack(doc_id: int | None, ids: bytes, width: int = 4) -> bytes:
    return frame(struct.pack("<qBI", doc_id or 0, (doc_id is None) + 2 * (width == 2), len(ids) // width) + ids)


def unpack(payload: bytes) -> tuple[int | None, bytes]:
    """doc_id and the ids as uint32."""
    doc_id, flags, n = struct.unpack_from("<qBI", payload, 0)
    ids = np.frombuffer(payload, "<u2" if flags & 2 else "<u4", offset=13)
    if len(ids) != n:
        raise ValueError("record holds another number of ids than it says")
    return (None if flags & 1 else doc_id), ids.astype("<u4").tobytes()


class Encoder(dict):
    """Ids of whole texts, by words. No token of this vocabulary spans white space, so texts are cut
    at ASCII white space and each distinct word is encoded once; the ids are those of encoding the
    whole text. The first ``CACHE_WORDS`` words met are remembered for the life of the worker."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        # Words of a-z pass this vocabulary's other steps unchanged: they go straight to its merges.
        model = self.tokenizer.model
        probes = ("thereof", "qzxv", "a", PLAIN.decode())
        same = all([t.id for t in model.tokenize(w)] == self.tokenizer.encode(w, add_special_tokens=False).ids for w in probes)
        self.direct = model.tokenize if same else None

    def __missing__(self, word: bytes) -> bytes:
        rest = word.translate(None, PLAIN)
        if not rest and self.direct:
            ids = array(self.kind, [t.id for t in self.direct(word.decode())]).tobytes()
        elif rest in (b".", b",") and len(word) > 1 and word[-1:] == rest:
            # The vocabulary parts letters from marks: "word," is the ids of "word" and those of ",".
            ids = self[word[:-1]] + self[rest]
        else:
            ids = array(self.kind, self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        if len(self) < CACHE_WORDS:
            self[word] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, ``width`` bytes each."""
        # The vocabulary is of lower case; only special tokens' names are looked for before that.
        ids = self.__getitem__
        return [b"".join(map(ids, (t if b"<|" in t else t.lower()).split())) for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` under ``folder``; the manifest (shard, file, records, tokens, bytes), one row
    per file, in ascending doc_id order by shard."""
    def write(batches: Iterator[pa.RecordBatch]):
        ctx = TaskContext.get()
        shard, name = ctx.partitionId(), f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, offsets, at, tokens, held, size = None, [], 0, 0, [], 0
        where = fs = None
        own = encoder(tokenizer_path)
        end = end_id.to_bytes(own.width, "little")
        for b in slices(batches):
            if out is None:
                fs, where = _open(folder)
                out = fs.open_output_stream(f"{where}/{name}.rec")
            for doc_id, ids in zip(b.column(0).to_pylist(), own.encode(text_bytes(b.column(1)))):
                data = pack(doc_id, ids + end, own.width)
                offsets.append(at)
                at += len(data)
                tokens += len(ids) // own.width + 1
                held.append(data)
                size += len(data)
                if size >= FLUSH_BYTES:
                    out.write(b"".join(held))
                    held, size = [], 0
        if out is None:
            return
        out.write(b"".join(held))
        out.close()
        with fs.open_output_stream(f"{where}/{name}.idx") as index:
            index.write(np.array([*offsets, at], "<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (shard, name, len(offsets), tokens, at)],
            ["shard", "file", "records", "tokens", "bytes"],
        )

    fs, where = _open(folder)
    fs.create_dir(where, recursive=True)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The text settles ties of repeated ids; a prefix would do for most, the hash does for all.
    ordered = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    schema = "shard bigint, file string, records bigint, tokens bigint, bytes bigint"
    return cut(map_batches(ordered, write, schema))


def open_record(folder: str, file: str, k: int) -> tuple[int | None, bytes]:
    """Record ``k`` of one file through its offset index (a shuffled read)."""
    fs, where = _open(folder)
    with fs.open_input_file(f"{where}/{file}.idx") as index:
        index.seek(8 * k)
        start, stop = np.frombuffer(index.read(16), "<i8")
    with fs.open_input_file(f"{where}/{file}.rec") as data:
        data.seek(int(start))
        return unpack(read_frame(memoryview(data.read(int(stop - start)))))


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the manifest's files, verified: doc_id, start, n_tokens, ids_crc32, file, record.

    ``start`` counts the ids of all documents before it. The files' own totals (one small row per
    file) give each file's start; inside a file it is a running sum while reading."""
    w = "sum(tokens) over (order by shard rows between unbounded preceding and 1 preceding)"
    files = manifest.select("shard", "file", "records", F.coalesce(F.expr(w), F.lit(0)).cast("bigint").alias("base"))
    # One row per file again spread over tasks: the window above holds file totals only.
    spread = files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")

    def load(batches: Iterator[pa.RecordBatch]):
        fs, where = _open(folder)
        for b in batches:
            for _, file, n, start in zip(*(b.column(i).to_pylist() for i in range(4))):
                with fs.open_input_file(f"{where}/{file}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<i8")
                if len(offsets) != n + 1:
                    raise ValueError(f"index of {file} holds another number of records")
                with fs.open_input_file(f"{where}/{file}.rec") as data:
                    k = 0
                    while k < n:
                        stop = k + 1
                        while stop < n and offsets[stop + 1] - offsets[k] <= FLUSH_BYTES:
                            stop += 1
                        data.seek(int(offsets[k]))
                        block = memoryview(data.read(int(offsets[stop] - offsets[k])))
                        cols: list[list] = [[], [], [], [], [], []]
                        for r in range(k, stop):
                            doc_id, ids = unpack(read_frame(block[offsets[r] - offsets[k]:offsets[r + 1] - offsets[k]]))
                            for c, v in zip(cols, (doc_id, start, len(ids) // 4, zlib.crc32(ids), file, r)):
                                c.append(v)
                            start += len(ids) // 4
                        kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(cols, kinds)],
                            ["doc_id", "start", "n_tokens", "ids_crc32", "file", "record"],
                        )
                        k = stop

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string, record bigint"
    return map_batches(spread, load, schema)


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/token-records-{uuid.uuid4().hex[:12]}"


def encode_documents(docs: DataFrame, folder: str | None = None, tokenizer_path: str | None = None) -> DataFrame:
    """Write all documents and read them back."""
    folder = folder or new_folder(docs.sparkSession)
    manifest = write_records(docs, folder, tokenizer_path or tokenizer_file())
    return read_records(manifest, folder)
