"""Token ids as files of fixed-width bit fields (operator 13).

Every id takes as many bits as the largest id of the vocabulary needs. 64 ids make
`bits` whole 64-bit words, so numpy packs and unpacks all groups of 64 at once, and
ids anywhere in a file are reached by arithmetic: a block holds `BLOCK` ids and the
file names every block's first byte and every document's first id.

A file, in little-endian numbers:

    8 bytes   IDPACK01
    4 * u64   bits, number of documents, number of ids, number of blocks
    i64       document ids
    u8        1 where the document has no id (null)
    u64       first id of each document within the file, and the number of ids
    u64       first byte of each block, and the end of the last
    u64       the fields, lowest bits first; the last group is filled up with zeros

Documents are sorted by id over all files. The files of a store are those its manifest
names, which is written last: files of failed or repeated attempts are never read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm.common import materialise
from railyard.llm.segments import SegmentEncoder, kept, slices

MAGIC = b"IDPACK01"
#: Ids of a block: a multiple of 64.
BLOCK = 4096
#: Ids of a file, about; one document is never divided between files.
FILE_IDS = 2_000_000


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """64-bit words that hold the ids in `bits` bits each, filled up to 64 ids."""
    group = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    group.reshape(-1)[:len(ids)] = ids
    words = np.zeros((len(group), bits), np.uint64)
    for j in range(64):
        at, shift = divmod(j * bits, 64)
        words[:, at] |= group[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, at + 1] |= group[:, j] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    """The ids of whole groups of 64."""
    words = words.reshape(-1, bits)
    out = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        at, shift = divmod(j * bits, 64)
        v = words[:, at] >> np.uint64(shift)
        if shift + bits > 64:
            v = v | words[:, at + 1] << np.uint64(64 - shift)
        out[:, j] = v & mask
    return out.reshape(-1)


def file_bytes(doc_ids: list, start: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """A file of documents: their ids (None allowed), and where each one's tokens begin (and the end)."""
    n_blocks = -(-len(ids) // BLOCK)
    words = pack(ids, bits)
    table = [np.array([bits, len(doc_ids), len(ids), n_blocks], np.uint64),
             np.array([d or 0 for d in doc_ids], np.int64), np.array([d is None for d in doc_ids], np.uint8),
             np.asarray(start, np.uint64)]
    body = len(MAGIC) + sum(x.nbytes for x in table) + 8 * (n_blocks + 1)
    size = BLOCK // 64 * bits * 8
    blocks = body + np.minimum(np.arange(n_blocks + 1, dtype=np.uint64) * np.uint64(size), np.uint64(words.nbytes))
    return b"".join([MAGIC, *(x.tobytes() for x in table), blocks.tobytes(), words.tobytes()])


class PackedFile:
    """Reads a file's bytes (or a memory map of them); only the blocks asked for are unpacked."""

    def __init__(self, data):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a file of packed ids")
        self.data = data
        self.bits, self.n_docs, self.n_ids, self.n_blocks = (int(x) for x in np.frombuffer(data, np.uint64, 4, 8))
        at = 40
        numbers = np.frombuffer(data, np.int64, self.n_docs, at)
        null = np.frombuffer(data, np.uint8, self.n_docs, at := at + 8 * self.n_docs)
        self.start = np.frombuffer(data, np.uint64, self.n_docs + 1, at := at + self.n_docs).astype(np.int64)
        self.blocks = np.frombuffer(data, np.uint64, self.n_blocks + 1, at + 8 * (self.n_docs + 1)).astype(np.int64)
        self.doc_ids = [None if z else d for d, z in zip(numbers.tolist(), null.tolist())]

    def ids(self, a: int = 0, z: int | None = None) -> np.ndarray:
        """The ids at places a to z (excluded) of the file."""
        z = self.n_ids if z is None else min(z, self.n_ids)
        if a >= z:
            return np.empty(0, np.uint32)
        first, last = a // BLOCK, (z - 1) // BLOCK
        at, end = self.blocks[first], self.blocks[last + 1]
        return unpack(np.frombuffer(self.data, np.uint64, (end - at) // 8, at), self.bits)[a - first * BLOCK:z - first * BLOCK]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.start[k]), int(self.start[k + 1]))


def _bits(path: str, end_id: int | None) -> int:
    """Bits of the largest id of the vocabulary (or the end id, if that is larger)."""
    from railyard.llm.segments import tokenizer

    t = tokenizer(path)
    size = t.get_piece_size() if path.endswith(".model") else max(t.get_vocab(with_added_tokens=True).values()) + 1
    return max(1, size - 1, end_id or 0).bit_length()


def _writer(path: str, out: str, end_id: int | None, bits: int, file_ids: int):
    """Encode documents in the order they come, write them as files and name these."""
    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(out)
        enc = kept(("segments", path), lambda: SegmentEncoder(path))
        part, seq = TaskContext.get().partitionId(), 0
        docs, pieces, sizes, held = [], [], [], 0

        def flush():
            nonlocal seq, docs, pieces, sizes, held
            ids, size = np.concatenate(pieces), np.concatenate(sizes)
            data = file_bytes(docs, np.concatenate(([0], np.cumsum(size))), ids, bits)
            name = f"part-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(data)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([name]), pa.array([len(docs)], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([len(data)], pa.int64())], ["part", "seq", "file", "n_docs", "n_ids", "n_bytes"])
            seq, docs, pieces, sizes, held = seq + 1, [], [], [], 0
            return row

        for rb in batches:
            for at, texts in slices(rb.column("text"), min(4_000_000, 2 * file_ids)):
                ids, start = enc.encoded(texts)
                if end_id is not None:
                    ids = np.insert(ids, start[1:], np.uint32(end_id))
                    start = start + np.arange(len(start))
                docs += rb.column("doc_id").slice(at, len(texts)).to_pylist()
                pieces.append(ids), sizes.append(np.diff(start))
                held += len(ids)
                if held >= file_ids:
                    yield flush()
        if docs:
            yield flush()
    return run


def write_packed(docs: DataFrame, path: str, out: str, end_id: int | None = None, file_ids: int = FILE_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, write them in ascending order of their ids to the folder `out` and return the manifest.

    `path` is a vocabulary file (.json for tokenizers, .model for sentencepiece);
    `end_id`, if given, follows each document. Manifest: file, part, seq, base (ids in
    all files before it), n_docs, n_ids, n_bytes; also kept in ``out/manifest``.

    Defined cases: a null text is empty. Null ids come first. Rows that repeat an id
    each are a document, the shorter text first, then by its hash. Other columns are
    ignored. An empty table gives a store without files.
    """
    spark = docs.sparkSession
    spark_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    spark_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(spark_path)
    bits = _bits(path, end_id)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.select("*", F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    # the texts are dealt, not their ids: dealing by ranges reads its input twice, and texts are cheap to read
    order = [F.col("doc_id").asc_nulls_first(), "size", "hash", "row"]  # `row` spreads repeats of one document
    files = (src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
             .mapInArrow(_writer(path, out, end_id, bits, file_ids), "part int, seq int, file string, n_docs bigint, n_ids bigint, n_bytes bigint"))
    files = materialise(files, "packed-files")
    # one number for each task of the write
    base, total = [], 0
    for r in sorted(files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect(), key=lambda r: r.part):
        base.append((r.part, total))
        total += r.n
    before = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    of_part = spark.createDataFrame(base, "part int, base bigint")
    (files.withColumn("before", F.coalesce(before, F.lit(0))).join(F.broadcast(of_part), "part")
     .select("file", "part", "seq", (F.col("base") + F.col("before")).alias("base"), "n_docs", "n_ids", "n_bytes")
     .write.parquet(f"{out}/manifest"))
    return spark.read.parquet(f"{out}/manifest")


def _reader(with_ids: bool):
    def run(batches):
        for rb in batches:
            for data, base in zip(rb.column("content"), rb.column("base").to_pylist()):
                f = PackedFile(data.as_buffer())
                ids = f.ids()
                wide = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(wide[4 * a:4 * z]) for a, z in zip(f.start[:-1].tolist(), f.start[1:].tolist())]
                columns = [pa.array(f.doc_ids, pa.int64()), pa.array(base + f.start[:-1], pa.int64()),
                           pa.array(np.diff(f.start), pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(f.start, pa.int32()), pa.array(ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])
    return run


def read_packed(spark: SparkSession, out: str, with_ids: bool = True) -> DataFrame:
    """The documents of a store: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and their ids.

    ids_crc32 is that of the ids as little-endian unsigned 32-bit numbers. All are as read
    from the files that the manifest names.
    """
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    manifest = spark.read.parquet(f"{out}/manifest")
    if not manifest.limit(1).count():
        return spark.createDataFrame([], schema)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(out)
             .select(F.regexp_extract("path", "[^/]*$", 0).alias("file"), "content"))
    return files.join(manifest.select("file", "base"), "file").select("base", "content").mapInArrow(_reader(with_ids), schema)
