"""Token-ID files: independent zstandard frames, a trailing seek table and a checksum per frame.

Documents are sorted by id over range partitions; each partition writes one file. A frame holds
whole documents (at least one, up to about ``frame_tokens`` tokens) and can be decompressed alone:

    frame    u32 documents, u64 tokens before the frame in this file, then per document
             i64 id, u8 id-is-set, u64 tokens; then all token ids as u32
    meta     skippable frame: u64 documents, u64 tokens, then per frame i64 first and last id
    seek     skippable frame of the public seekable format: compressed size, size and checksum
             (low 32 bits of XXH64) of every frame, then the number of frames and the magic number

All numbers are little-endian. A task writes under a name of its own and only the names that
reach the manifest count, so a repeated or lost task leaves no trace in the result.
"""

from __future__ import annotations

import math
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.common import stage
from ebbline.session import work_dir

# Fixed values of the seekable zstandard format.
SEEK_MAGIC, SEEK_FRAME, META_FRAME = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
CACHED_PIECES = 600_000
FRAMES_PER_TASK = 16
SPECIAL = "<|"
# The tokenizer's own cut, for texts of ASCII and Latin-1 letters.
SIMPLE = re.compile("[\x20-\x7e\t\n\rÀ-ÖØ-öø-ÿ]*")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_frames long"
DOCUMENT = "doc_id long, shard int, frame int, place int, start long, n_tokens long, ids_crc32 long"


class WordEncoder:
    """Encodes with the given tokenizer, each piece of a text once while it is cached.

    The tokenizer lower-cases, cuts a text into pieces (letters, single digits, other marks) and encodes each
    alone. Where a text has only ASCII and Latin-1 letters the same cut is made here, and pieces that are not
    cached are encoded together, without the cut. All other texts go through the tokenizer as they are. The cache
    keeps two generations of bounded size.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.pieces = Tokenizer(self.full.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.full.get_vocab_size()
        self.ends = np.array([(self.full.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _need(self, pieces: set[str]) -> None:
        """Make every piece known in the young generation."""
        unknown = pieces.difference(self.new)
        if unknown and len(self.new) > CACHED_PIECES:
            self.old, self.new = self.new, {}
            unknown = pieces
        learn = []
        for piece in unknown:
            known = self.old.get(piece)
            if known is None:
                learn.append(piece)
            else:
                self.new[piece] = known
        for at in range(0, len(learn), 256):
            some = learn[at:at + 256]
            ids = np.array(self.pieces.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4  # a piece ends with the only token that ends a word
            if len(cuts) != len(some):
                self.new.update((w, self._plain(w)) for w in some)
                continue
            raw, cuts = ids.tobytes(), cuts.tolist()
            self.new.update(zip(some, map(raw.__getitem__, map(slice, [0, *cuts], cuts))))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Token ids of each text as little-endian u32 bytes; null is empty."""
        out = []
        for at in range(0, len(texts), 64):
            block = [t or "" for t in texts[at:at + 64]]
            cut = [PIECE.findall(t.lower()) if SIMPLE.fullmatch(t) and SPECIAL not in t else None for t in block]
            self._need(set().union(*[c for c in cut if c]))
            get = self.new.__getitem__
            out += [self._plain(t) if c is None else b"".join(map(get, c)) for t, c in zip(block, cut)]
        return out


@cache
def worker_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker: what it has learned serves the later tasks of the worker."""
    return WordEncoder(path)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def pack_frame(ids: list[int | None], tokens: list[bytes], before: int) -> bytes:
    head = struct.pack("<IQ", len(ids), before)
    names = np.array([i or 0 for i in ids], "<i8").tobytes() + np.array([i is not None for i in ids], "u1").tobytes()
    return head + names + np.array([len(t) // 4 for t in tokens], "<u8").tobytes() + b"".join(tokens)


def unpack_frame(raw: bytes) -> tuple[int, list[int | None], np.ndarray, np.ndarray]:
    """Tokens before the frame, document ids, tokens of each document, all token ids."""
    n, before = struct.unpack_from("<IQ", raw)
    at = 12
    ids = np.frombuffer(raw, "<i8", n, at)
    held = np.frombuffer(raw, "u1", n, at + 8 * n)
    sizes = np.frombuffer(raw, "<u8", n, at + 9 * n).astype(np.int64)
    return before, [int(i) if h else None for i, h in zip(ids, held)], sizes, np.frombuffer(raw, "<u4", -1, at + 17 * n)


class ShardWriter:
    """One file, written frame by frame; memory is bounded by one frame."""

    def __init__(self, out, frame_tokens: int, level: int):
        import zstandard

        self.out, self.limit, self.zstd = out, frame_tokens, zstandard.ZstdCompressor(level=level)
        self.ids: list[int | None] = []
        self.tokens: list[bytes] = []
        self.held = self.before = self.docs = 0
        self.entries: list[tuple[int, int, int]] = []
        self.bounds: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        self.ids.append(doc_id)
        self.tokens.append(tokens)
        self.held += len(tokens) // 4
        if self.held >= self.limit:
            self.flush()

    def flush(self) -> None:
        import xxhash

        if not self.ids:
            return
        raw = pack_frame(self.ids, self.tokens, self.before)
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        lowest = -(1 << 63)
        self.bounds.append((self.ids[0] if self.ids[0] is not None else lowest, self.ids[-1] if self.ids[-1] is not None else lowest))
        self.before, self.docs = self.before + self.held, self.docs + len(self.ids)
        self.ids, self.tokens, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        meta = struct.pack("<QQ", self.docs, self.before) + np.array(self.bounds, "<i8").tobytes()
        self.out.write(struct.pack("<II", META_FRAME, len(meta)) + meta)
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), 0x80, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)
        self.out.close()


class ShardReader:
    """Random access to the frames of one file; every frame read is checked against its checksum."""

    def __init__(self, path: str):
        import zstandard

        system, name = _filesystem(path)
        self.file, self.zstd = system.open_input_file(name), zstandard.ZstdDecompressor()
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError(f"{path} has no seek table")
        at = size - 9 - 12 * n
        self.entries = np.frombuffer(self._at(at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.offsets = np.append(0, np.cumsum(self.entries[:, 0]))
        meta = self._at(int(self.offsets[-1]), 24 + 16 * n)
        self.n_docs, self.n_tokens = struct.unpack_from("<QQ", meta, 8)
        self.bounds = np.frombuffer(meta, "<i8", 2 * n, 24).reshape(n, 2)

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def frame(self, k: int):
        import xxhash

        size, full, checksum = self.entries[k].tolist()
        raw = self.zstd.decompress(self._at(int(self.offsets[k]), size), max_output_size=full)
        if len(raw) != full or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return unpack_frame(raw)


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None,
                 frame_tokens: int = 1 << 18, level: int = 3) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write one file for each range of ids; returns the manifest.

    ``end_id`` is appended to every document. Null and empty texts hold only ``end_id``. Null ids come
    first; rows with the same id follow each other in the order of their text's hash. Other columns are
    ignored. An empty table gives an empty manifest.
    """
    folder = folder or work_dir(spark, "tokens")
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, path = TaskContext.get().partitionId(), f"{folder}/part-{uuid.uuid4().hex}.tokens.zst"
        encoder = writer = None
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                system, name = _filesystem(path)
                system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                encoder, writer = worker_encoder(tokenizer), ShardWriter(system.open_output_stream(name, compression=None), frame_tokens, level)
            ids = [None if pd.isna(i) else int(i) for i in batch.doc_id]
            texts = [None if t is None or t != t else t for t in batch.text]
            for doc_id, tokens in zip(ids, encoder.encode(texts)):
                writer.add(doc_id, tokens + end)
        if writer is not None:
            writer.close()
            yield pd.DataFrame([(shard, path, writer.docs, writer.before, len(writer.entries))],
                               columns=["shard", "path", "n_docs", "n_tokens", "n_frames"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(spark, ordered.mapInPandas(write, MANIFEST), "token_manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every document of the files: id, tokens before it, number of tokens and checksum of its ids."""
    def frames(batches):
        for batch in batches:
            for shard, path in zip(batch.shard, batch.path):
                reader = ShardReader(path)
                yield pd.DataFrame({"shard": shard, "path": path, "n_tokens": reader.n_tokens, "frame": range(len(reader.entries))})

    def documents(batches):
        for batch in batches:
            for (path, shard), group in batch.groupby(["path", "shard"], sort=False):
                reader = ShardReader(path)
                for k in group.frame.tolist():
                    before, ids, sizes, tokens = reader.frame(k)
                    ends = np.cumsum(sizes)
                    crcs = [zlib.crc32(tokens[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                    yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "shard": shard, "frame": k, "place": range(len(ids)),
                                        "start": before + ends - sizes, "n_tokens": sizes, "ids_crc32": crcs})

    # Few bytes stand for much work here, so the numbers of tasks are given.
    listed = manifest.select("shard", "path").repartition(math.ceil(max(1, manifest.count()) / 4), "path").mapInPandas(frames, "shard int, path string, n_tokens long, frame int")
    listed = stage(spark, listed, "token_frames")
    # One row for each file, so at most one for each partition of the writing job.
    bases = listed.where("frame = 0").select("shard", F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    tasks = math.ceil(max(1, listed.count()) / FRAMES_PER_TASK)
    read = listed.select("path", "shard", "frame").repartition(tasks, "path", (F.col("frame") / FRAMES_PER_TASK).cast("int")).mapInPandas(documents, DOCUMENT)
    return read.join(bases, "shard").withColumn("start", F.col("base") + F.col("start")).drop("base")


def fetch_documents(spark: SparkSession, manifest: DataFrame, ids: list[int]) -> DataFrame:
    """``doc_id, tokens`` of the requested documents; only frames whose id range holds one are decompressed."""
    wanted = np.unique(np.array(ids, np.int64))

    def fetch(batches):
        for batch in batches:
            for path in batch.path:
                reader = ShardReader(path)
                low, high = np.searchsorted(wanted, reader.bounds[:, 0]), np.searchsorted(wanted, reader.bounds[:, 1], side="right")
                for k in np.flatnonzero(high > low).tolist():
                    _, names, sizes, tokens = reader.frame(k)
                    ends = np.cumsum(sizes)
                    hits = [(n, tokens[e - s:e].tolist()) for n, s, e in zip(names, sizes.tolist(), ends.tolist())
                            if n is not None and wanted[min(np.searchsorted(wanted, n), len(wanted) - 1)] == n]
                    if hits:
                        yield pd.DataFrame(hits, columns=["doc_id", "tokens"])

    return manifest.select("path").repartition(math.ceil(max(1, manifest.count()) / 4), "path").mapInPandas(fetch, "doc_id long, tokens array<long>")
