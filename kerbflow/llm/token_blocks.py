"""Token ids in patched frame-of-reference blocks (operator 7).

A file is, in little-endian order::

    magic "PFOR" | version u32 | block size u32
    blocks:  least u32 | ids u16 | width u8 | exceptions u16 | packed bits | places u16 each | values u32 each
    block starts (byte place u64 each) | documents (doc_id i64, has id u8, first id u64, ids u64 each)
    footer: place of the block starts u64 | blocks u64 | documents u64 | ids u64 | magic "PFOR"

In a block the least id is taken from all, and the rest is packed at the width that holds ``percentile`` of them. The
others are exceptions: their place and whole value stand behind the bits. The block starts let a reader
fetch the ids of one document without the blocks before them.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbflow.llm.common import ready, resident, store, written
from kerbflow.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
MAGIC, VERSION, BLOCK, PERCENTILE = b"PFOR", 1, 4096, 95.0
HEAD, BLOCK_HEAD, FOOTER = struct.Struct("<4sII"), struct.Struct("<IHBH"), struct.Struct("<QQQQ4s")
DOCUMENT = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("first", "<u8"), ("ids", "<u8")])
MANIFEST = "part int, path string, documents bigint, ids bigint, bytes bigint"
ROWS = "doc_id bigint, place bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
READ = 64


# --- blocks -------------------------------------------------------------------------------------


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1 to 65535 unsigned 32-bit ids."""
    least = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(least)
    widths = np.frexp(rest.astype(np.float64))[1]
    width = int(np.searchsorted(np.cumsum(np.bincount(widths)), percentile / 100 * len(rest)))
    large = np.flatnonzero(widths > width)
    fits = rest.copy()
    fits[large] = 0
    bits = b""
    if width:
        spread = (fits[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
        bits = np.packbits(spread.astype(np.uint8), axis=None, bitorder="little").tobytes()
    head = BLOCK_HEAD.pack(least, len(ids), width, len(large))
    return head + bits + large.astype("<u2").tobytes() + rest[large].astype("<u4").tobytes()


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    least, n, width, exceptions = BLOCK_HEAD.unpack_from(data, at)
    at += BLOCK_HEAD.size
    rest = np.zeros(n, dtype=np.uint32)
    if width:
        size = (n * width + 7) // 8
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little")
        padded = np.zeros((n, 32), dtype=np.uint8)
        padded[:, :width] = bits.reshape(n, width)
        rest = np.packbits(padded, axis=1, bitorder="little").view("<u4").ravel().copy()
        at += size
    if exceptions:
        places = np.frombuffer(data, "<u2", exceptions, at)
        rest[places] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return rest + np.uint32(least)


class BlockWriter:
    """Writes ids document after document; what is held is one block and the index."""

    def __init__(self, file, block: int = BLOCK, percentile: float = PERCENTILE):
        self.file, self.block, self.percentile = file, block, percentile
        self.held: list[np.ndarray] = []
        self.size = self.ids = 0
        self.starts: list[int] = []
        self.documents: list[tuple] = []
        self.place = HEAD.size
        file.write(HEAD.pack(MAGIC, VERSION, block))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id or 0, doc_id is not None, self.ids, len(ids)))
        self.ids += len(ids)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.block:
            self._flush(self.block)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        at = 0
        while len(ids) - at >= least and at < len(ids):
            data = pack_block(ids[at : at + self.block], self.percentile)
            self.starts.append(self.place)
            self.file.write(data)
            self.place += len(data)
            at += self.block
        self.held, self.size = [ids[at:]], max(0, len(ids) - at)

    def close(self) -> int:
        """Bytes written in all."""
        self._flush(1)
        documents = np.array(self.documents, dtype=DOCUMENT)
        self.file.write(np.array(self.starts, dtype="<u8").tobytes() + documents.tobytes())
        self.file.write(FOOTER.pack(self.place, len(self.starts), len(documents), self.ids, MAGIC))
        return self.place + 8 * len(self.starts) + documents.nbytes + FOOTER.size


class BlockReader:
    """Reads a file by its index; ``file`` is seekable."""

    def __init__(self, file, size: int):
        self.file = file
        magic, version, self.block = HEAD.unpack(self._bytes(0, HEAD.size))
        self.end, blocks, documents, self.ids, tail = FOOTER.unpack(self._bytes(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or tail != MAGIC or version != VERSION:
            raise ValueError("no file of token blocks, or one that was cut off")
        self.starts = np.frombuffer(self._bytes(self.end, 8 * blocks), "<u8")
        self.documents = np.frombuffer(self._bytes(self.end + 8 * blocks, DOCUMENT.itemsize * documents), DOCUMENT)

    def _bytes(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(size)
        if len(data) != size:
            raise ValueError("the file ends too soon")
        return data

    def _blocks(self, first: int, last: int) -> list[np.ndarray]:
        start = int(self.starts[first])
        end = int(self.starts[last]) if last < len(self.starts) else self.end
        data = self._bytes(start, end - start)
        return [unpack_block(data, int(at) - start) for at in self.starts[first:last]]

    def read(self, first: int, ids: int) -> np.ndarray:
        """``ids`` ids from the place ``first`` on; only their blocks are read."""
        if not ids:
            return np.zeros(0, np.uint32)
        low, high = first // self.block, (first + ids - 1) // self.block + 1
        whole = np.concatenate(self._blocks(low, high))
        return whole[first - low * self.block :][:ids]

    def all_documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first place, ids) in the order of the file, some blocks at a time."""
        held, begins, following = np.zeros(0, np.uint32), 0, 0
        for doc_id, has_id, first, ids in self.documents.tolist():
            while begins + len(held) < first + ids:
                last = min(following + READ, len(self.starts))
                held = np.concatenate([held[max(0, first - begins) :], *self._blocks(following, last)])
                begins, following = max(begins, first), last
            yield (doc_id if has_id else None), first, held[first - begins : first - begins + ids]


# --- documents ----------------------------------------------------------------------------------


class WordEncoder:
    """Ids of whole texts, part by part.

    The tokenizer drops white space, lowers case, and lets no token cross white space or the border between letters and
    other signs (but for an apostrophe). So a text's ids are those of its parts in order: runs of lower-case letters
    and runs of other signs in words of Latin-1 letters, whole words elsewhere. Parts come back, so their ids
    are remembered (at most ``limit``). New runs of letters are encoded together; the ends are told by the tokens
    that end a word. A tokenizer for which a probe shows that this does not hold is given whole texts.
    """

    WORDS = re.compile(r"[^ \t\n\r]+").findall
    LETTERS = "a-zà-öø-ÿßªµº"
    PARTS = re.compile(f"[{LETTERS}]+|[^ \t\n\r{LETTERS}]+").findall
    PROBE = "Probe  of\n\ttwo é́ WORDS, 12 ﬁ!\r\nit's ÀÖÿ,ß(x)µ-ª7a <|b|> naïve...End 3a\u00a0b ΑΣ"

    def __init__(self, path: str, limit: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.limit, self.memo = limit, {}
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[ends] = True
        self.whole = False
        self.whole = self.encode_all([self.PROBE])[0].tolist() != self._ids(self.PROBE)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _plain(text: str) -> bool:
        """Latin-1 letters and signs without an apostrophe or what could begin a special token."""
        if "'" in text or "<" in text:
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def _parts(self, text: str) -> list[str]:
        if self._plain(text):
            return self.PARTS(text.lower())
        parts: list[str] = []
        for word in self.WORDS(text):
            if self._plain(word):
                parts += self.PARTS(word.lower())
            else:
                parts.append(word)
        return parts

    def _learn(self, new: set[str]) -> None:
        letters = [w for w in new if w.isalpha()]
        others = [w for w in new if not w.isalpha()]
        for at in range(0, len(letters), 256):
            some = letters[at : at + 256]
            ids = np.array(self._ids(" ".join(some)), dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                raw, ends = ids.tobytes(), (4 * cuts).tolist()
                self.memo.update(zip(some, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=True))
            else:
                others += some
        for word in others:
            self.memo[word] = np.array(self._ids(word), dtype="<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        if self.whole:
            return [np.array(self._ids(t), dtype="<u4") for t in texts]
        if len(self.memo) >= self.limit:
            self.memo.clear()
        get = self.memo.get
        parts = [self._parts(t) for t in texts]
        # One look-up a part: the memo is far larger than a processor's cache.
        known = [list(map(get, some)) for some in parts]
        self._learn({w for some, raw in zip(parts, known, strict=True) if None in raw for w, r in zip(some, raw, strict=True) if r is None})
        filled = (
            [r if r is not None else get(w) for w, r in zip(some, raw, strict=True)] if None in raw else raw
            for some, raw in zip(parts, known, strict=True)
        )
        return [np.frombuffer(b"".join(raw), dtype="<u4") for raw in filled]


def load_encoder(path: str) -> WordEncoder:
    return resident(("words", path), lambda: WordEncoder(path))


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str | None = None,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Encodes whole texts into files of one order by ``doc_id``, and returns their manifest, ``part`` giving that order.

    Each document's ids end with ``end_id``; null and empty texts are that id alone. Null ids come first. Rows
    of one id are ordered by their text's hash, so repeated rows follow each other, and even one id on very many different
    texts is spread over files. A folder may lie in any file system that pyarrow opens by its address.

    Documents are dealt into ranges of the key and sorted there; each task writes one file under a name of its own
    attempt. Only a finished task's row reaches the manifest, which is a table of its own, so what a lost executor left
    half-written is never read.
    """
    spark = ready(docs.sparkSession)
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(path)
        end = np.array([end_id], dtype="<u4")
        writer = file = name = None
        task = TaskContext.get()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                encoded = encoder.encode_all([value or "" for value in part.column(1).to_pylist()])
                for key, ids in zip(part.column(0).to_pylist(), encoded, strict=True):
                    if writer is None:
                        system, base = store(folder)
                        system.create_dir(base, recursive=True)
                        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.pfor"
                        file = system.open_output_stream(f"{base}/{name}", compression=None)
                        writer = BlockWriter(file, block)
                    writer.add(key, np.concatenate([ids, end]))
        if writer is not None:
            size = writer.close()
            file.close()
            line = {"part": task.partitionId(), "path": f"{folder}/{name}", "documents": len(writer.documents), "ids": writer.ids, "bytes": size}
            yield pa.RecordBatch.from_pylist([line], schema=MANIFEST_KIND)

    return written(dealt.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


MANIFEST_KIND = pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])
ROWS_KIND = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def with_offsets(manifest: DataFrame) -> DataFrame:
    """The manifest with the ids and documents in all files before each one; a row per file, so one task sums them."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select(
        "*",
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("ids_before"),
        F.coalesce(F.sum("documents").over(before), F.lit(0)).alias("documents_before"),
    )


def read_token_files(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``place`` among all documents, ``start`` (ids before it in all
    files), ``n_tokens``, ``ids_crc32`` (CRC-32 of its ids as little-endian 32-bit numbers), and with ``ids`` the ids.

    Each file is read by one task, some blocks at a time; a manifest without rows gives none.
    """
    ready(manifest.sparkSession)
    kind = ROWS_KIND.append(pa.field("ids", pa.list_(pa.int64()))) if ids else ROWS_KIND

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line in batch.to_pylist():
                system, base = store(line["path"])
                with system.open_input_file(base) as file:
                    reader = BlockReader(file, line["bytes"])
                    out = []
                    for n, (doc_id, first, found) in enumerate(reader.all_documents()):
                        row = {"doc_id": doc_id, "place": line["documents_before"] + n, "start": line["ids_before"] + first}
                        row |= {"n_tokens": len(found), "ids_crc32": zlib.crc32(found.astype("<u4").tobytes())}
                        out.append(row | {"ids": found.tolist()} if ids else row)
                        if len(out) == 1024:
                            yield pa.RecordBatch.from_pylist(out, schema=kind)
                            out = []
                    yield pa.RecordBatch.from_pylist(out, schema=kind)

    files = with_offsets(manifest)
    spread = files.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInArrow(read, ROWS + (", ids array<bigint>" if ids else ""))


def token_folder(spark) -> str:
    return scratch_dir(spark, "token-files")
