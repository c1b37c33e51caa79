"""Token ids in patched frame-of-reference blocks.

A data set is a table of *segments*, each a run of whole documents in ascending ``doc_id`` order, self-contained and
readable alone:

    magic "PFB1" | n_docs, n_ids, n_blocks: 3 x uint32 | doc_ids: int64[n_docs] | has_id: uint8[n_docs]
    | n_tokens: uint32[n_docs] | block starts: uint32[n_blocks + 1], in bytes from the end of this index | blocks

Blocks hold BLOCK ids (the last one is filled up with its own first id): ``minimum uint32, width uint8, pad uint8,
n_exceptions uint16``, then the ids less the minimum in ``width`` bits each, 64 of them to ``width`` little-endian
words, then the exceptions: positions (uint16) and whole residuals (uint32). The width is what the PERCENTILE-th of a
block's residuals needs; what needs more is an exception. A document is found by its running count of ids: its first
block is ``start // BLOCK``.

Segments are rows of a Parquet table (``shard, segment, n_docs, n_ids, payload``) because only Spark's writers reach
every store and commit whole files when executors are lost.

Defined results: a null text counts as empty; an empty text has the end id alone; null doc_ids come first; rows of
equal doc_id are all kept, in an order fixed by their text; an empty table gives no segments.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..ship import ship
from .arrow import slices, text_rows
from .chunks import LONGEST, blank_runs, lowered, word_and_marks
from .store import shared_dir
from .trie_bpe import byte_alphabet

BLOCK = 1024
PERCENTILE = 95
HEAD = struct.Struct("<4sIII")
SEGMENTS = "shard int, segment int, n_docs long, n_ids long, payload binary"


def bits(x: np.ndarray) -> np.ndarray:
    """Binary digits of each unsigned number, 1 at least."""
    return np.maximum(1, np.ceil(np.log2(x.astype(np.float64) + 1))).astype(np.uint8)


def pack_words(values: np.ndarray, width: int) -> np.ndarray:
    """(k, 64 m) numbers below 2**width -> (k, m * width) words of 64 bits."""
    k, m = values.shape[0], values.shape[1] // 64
    v = np.ascontiguousarray(values.reshape(k * m, 64).T).astype(np.uint64)
    out = np.zeros((width, k * m), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[word] |= v[j] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= v[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(k, m * width)


def unpack_words(words: np.ndarray, width: int) -> np.ndarray:
    k, m = words.shape[0], words.shape[1] // width
    w = np.ascontiguousarray(words.reshape(k * m, width).T)
    out = np.empty((64, k * m), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        x = w[word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (w[word + 1] << np.uint64(64 - shift))
        out[j] = x & mask
    return np.ascontiguousarray(out.T).reshape(k, m * 64)


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts and the blocks' bytes."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(1, np.uint32), b""
    whole = np.full(n * BLOCK, ids[(n - 1) * BLOCK], np.uint32)
    whole[: len(ids)] = ids
    whole = whole.reshape(n, BLOCK)
    low = whole.min(axis=1)
    rest = whole - low[:, None]
    at = BLOCK * PERCENTILE // 100
    widths = bits(np.partition(rest, at, axis=1)[:, at])
    parts: list[bytes] = [b""] * n
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        values = rest[own]
        mask = np.uint32((1 << width) - 1)
        over = values > mask
        words = pack_words(values & mask, width)
        rows, places = np.nonzero(over)
        outside = values[rows, places]
        ends = np.searchsorted(rows, np.arange(len(own) + 1))
        for i, b in enumerate(own.tolist()):
            s, e = ends[i], ends[i + 1]
            parts[b] = struct.pack("<IBBH", int(low[b]), width, 0, int(e - s)) + words[i].tobytes() + places[s:e].astype("<u2").tobytes() + outside[s:e].astype("<u4").tobytes()
    starts = np.zeros(n + 1, np.uint32)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return starts, b"".join(parts)


def unpack_blocks(starts: np.ndarray, data: memoryview) -> np.ndarray:
    n = len(starts) - 1
    out = np.empty((n, BLOCK), np.uint32)
    heads = [struct.unpack_from("<IBBH", data, s) for s in starts[:-1].tolist()]
    widths = np.array([h[1] for h in heads], np.uint8)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        size = BLOCK * width // 8
        words = np.frombuffer(b"".join([data[s + 8 : s + 8 + size] for s in starts[own].tolist()]), "<u8").reshape(len(own), -1)
        out[own] = unpack_words(words, width)
    for b, (low, width, _, n_out) in enumerate(heads):
        if n_out:
            at = int(starts[b]) + 8 + BLOCK * width // 8
            places = np.frombuffer(data, "<u2", n_out, at)
            out[b, places] = np.frombuffer(data, "<u4", n_out, at + 2 * n_out)
        out[b] += np.uint32(low)
    return out.reshape(-1)


def write_segment(doc_ids: list[int | None], n_tokens: np.ndarray, ids: np.ndarray) -> bytes:
    starts, blocks = pack_blocks(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([d or 0 for d in doc_ids], "<i8")
    return HEAD.pack(b"PFB1", len(doc_ids), len(ids), len(starts) - 1) + docs.tobytes() + known.tobytes() + n_tokens.astype("<u4").tobytes() + starts.astype("<u4").tobytes() + blocks


class Segment:
    """A reader of one segment."""

    def __init__(self, payload: bytes):
        magic, self.n_docs, self.n_ids, n_blocks = HEAD.unpack_from(payload)
        if magic != b"PFB1":
            raise ValueError("not a segment of token blocks")
        at = HEAD.size
        ids = np.frombuffer(payload, "<i8", self.n_docs, at)
        known = np.frombuffer(payload, np.uint8, self.n_docs, at := at + 8 * self.n_docs)
        self.doc_ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)]
        self.n_tokens = np.frombuffer(payload, "<u4", self.n_docs, at := at + self.n_docs)
        self.starts = np.frombuffer(payload, "<u4", n_blocks + 1, at := at + 4 * self.n_docs)
        self.blocks = memoryview(payload)[at + 4 * (n_blocks + 1) :]
        self.offsets = np.concatenate([[0], np.cumsum(self.n_tokens, dtype=np.int64)])

    def ids(self) -> np.ndarray:
        """All ids, document after document."""
        return unpack_blocks(self.starts, self.blocks)[: self.n_ids]

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, from its own blocks alone."""
        s, e = int(self.offsets[i]), int(self.offsets[i + 1])
        first, last = s // BLOCK, -(-e // BLOCK)
        return unpack_blocks(self.starts[first : last + 1], self.blocks)[s - first * BLOCK : e - first * BLOCK]


class RunIds(dict):
    """Runs between blanks -> their ids as little-endian bytes, by the tokenizers library; what is missing is encoded.

    Plain words and the marks after them go to the library's model alone, all other runs through all of its steps.
    """

    #: Distinct runs that are remembered; words and marks that make up a run are runs as well.
    KEPT = 800_000

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(tokenizer_path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model.tokenize
        self.stand_in = byte_alphabet()

    def __missing__(self, run: str) -> bytes:
        own = word_and_marks(run)
        if own is None:
            ids = array("I", self.library.encode(run, add_special_tokens=False).ids).tobytes()
        elif own[1]:
            ids = self[own[0]] + self[own[1]]
        else:
            word = run if run.isascii() else "".join([self.stand_in[b] for b in run.encode()])
            ids = array("I", [t.id for t in self.model(word)]).tobytes()
        if len(run) <= LONGEST:
            self[run] = ids
        return ids

    def text(self, text: str) -> bytes:
        """The ids of a whole text."""
        return b"".join(map(self.__getitem__, blank_runs(lowered(text))))

    def tidy(self) -> None:
        if len(self) > self.KEPT:
            self.clear()


@lru_cache(maxsize=1)
def run_ids(tokenizer_path: str) -> RunIds:
    """One encoder in each Python worker, which later tasks find with what it remembers."""
    return RunIds(tokenizer_path)


def write_blocks(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text with the tokenizers library, append ``end_id`` to each, write segments at ``path``.

    Documents are dealt by ranges of ``(doc_id, hash of the text)``, so equal ids can be split as well; one shuffle.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, known, count = TaskContext.get().partitionId(), None, 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch):
                known = run_ids(tokenizer_path) if known is None else known
                own = [known.text(t) + end for t in part.column("text").to_pylist()]
                known.tidy()
                n_tokens = np.array([len(x) // 4 for x in own])
                payload = write_segment(part.column("id").to_pylist(), n_tokens, np.frombuffer(b"".join(own), "<u4"))
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "segment": pa.array([count], pa.int32()), "n_docs": [len(own)], "n_ids": [int(n_tokens.sum())], "payload": [payload]})
                count += 1

    spark = docs.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = text_rows(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    # The bytes are packed already, so the files that hold them are not compressed again.
    ordered.mapInArrow(encoded, SEGMENTS).write.option("compression", "none").parquet(path)


def read_blocks(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document, read from the files: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``)."""
    ship(spark)
    segments = spark.read.schema(SEGMENTS).parquet(path)
    extra = ", ids array<long>" if with_ids else ""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, number, payload = (batch.column(c)[row].as_py() for c in ("shard", "segment", "payload"))
                s = Segment(payload)
                ids = s.ids().astype("<u4", copy=False)
                at, n = s.offsets.tolist(), s.n_docs
                columns = {
                    "shard": pa.array([shard] * n, pa.int32()), "segment": pa.array([number] * n, pa.int32()), "doc_id": pa.array(s.doc_ids, pa.int64()), "before": pa.array(at[:-1], pa.int64()),
                    "n_tokens": pa.array(s.n_tokens.astype(np.int64)), "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    rows = segments.select("shard", "segment", "payload").mapInArrow(decoded, f"shard int, segment int, doc_id long, before long, n_tokens long, ids_crc32 long{extra}")
    # Ids before a segment: those of earlier shards (a row each) and of earlier segments of its shard.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_start"))
    own = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("shard", "segment", F.coalesce(F.sum("n_ids").over(own), F.lit(0)).alias("own_start")).join(shards, "shard")
    starts = starts.select("shard", "segment", (F.col("own_start") + F.col("shard_start")).alias("segment_start"))
    out = rows.join(starts, ["shard", "segment"])
    return out.select("doc_id", (F.col("segment_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_blocks(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the blocks (to ``path``, or a new folder in the shared one) and return what ``read_blocks`` finds there."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/token-blocks-{uuid.uuid4().hex}"
    write_blocks(docs, path, tokenizer_path, end_id)
    return read_blocks(spark, path)
