"""Token ids on disk: patched frame-of-reference blocks behind a Spark data source.

A folder holds files of ids and a manifest.  A file is a run of documents in ascending
doc_id order; its ids stand in blocks of ``BLOCK`` ids.  A block subtracts its least id,
packs the low ``width`` bits of the rest, and lists what does not fit as exceptions
(place, high bits).  ``width`` is the number of bits that ``PERCENTILE`` of the block's
ids need.  The file ends with the documents (id, number of ids) and the start of every
block, so a reader fetches any stretch of ids from the blocks that hold it.

File (little endian): ``MAGIC``, blocks, documents (int64 ids, uint8 1 = no id, uint64
numbers of ids), block starts (uint64, one more than blocks), ``FOOTER``.  Block:
``HEAD`` (ids, least id, exceptions, width), packed low bits, uint16 places, uint32 high
bits.  ``_manifest.json`` names the files in order with their documents and ids.

Tasks write files under names of their own; the manifest is written once, at commit, from
the messages of the attempts that count.  What a lost executor or a second attempt left
behind is never read.
"""

from __future__ import annotations

import json
import math
import os
import re
import string
import struct
import uuid
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from pickwise.llm.common import slices
from pickwise.session import checkpoint_dir

MAGIC = b"PFORIDS1"
HEAD = struct.Struct("<IIHB")
FOOTER = struct.Struct("<QQQQQ8s")  # place of documents, place of block starts, documents, ids, blocks, MAGIC
MANIFEST = "_manifest.json"
BLOCK = 4096          # ids to a block; places of exceptions are uint16, so at most 65536
PERCENTILE = 98       # share of a block's ids that its width must hold
BATCH_IDS = 1 << 20   # ids that a reader unpacks at a time
#: text bytes to a file: MOST at most, LEAST at least where the session has partitions to spare
LEAST_BYTES, MOST_BYTES = 8 << 20, 256 << 20

SCHEMA = "doc_id long, start long, n_tokens long, ids array<int>"


# ---------------------------------------------------------------- blocks

def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of uint32 ids."""
    least = ids.min()
    rest = ids - least
    _, bits = np.frexp(rest.astype(np.float64))  # of whole numbers: how many bits each needs
    width = int(np.searchsorted(np.cumsum(np.bincount(bits)), max(1, math.ceil(len(bits) * percentile / 100))))
    low = rest & np.uint32((1 << width) - 1)
    packed = np.unpackbits(low.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=width) \
        if width else np.zeros(0, np.uint8)
    at = np.flatnonzero(rest != low)
    high = rest[at] >> np.uint32(width) if width < 32 else rest[at]
    return (HEAD.pack(len(ids), int(least), len(at), width) + np.packbits(packed, bitorder="little").tobytes()
            + at.astype("<u2").tobytes() + high.astype("<u4").tobytes())


def unpack(data: memoryview | bytes) -> np.ndarray:
    """The ids of a block written by ``pack``."""
    n, least, odd, width = HEAD.unpack_from(data)
    at = HEAD.size + (n * width + 7) // 8
    low = np.zeros((n, 32), np.uint8)
    if width:
        low[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, at - HEAD.size, HEAD.size), bitorder="little",
                                       count=n * width).reshape(n, width)
    ids = np.packbits(low, axis=1, bitorder="little").reshape(-1).view("<u4").astype(np.uint32)
    if odd:
        places = np.frombuffer(data, "<u2", odd, at)
        ids[places] |= np.frombuffer(data, "<u4", odd, at + 2 * odd).astype(np.uint32) << np.uint32(width)
    return ids + np.uint32(least)


# ---------------------------------------------------------------- files

def opened(path: str):
    """(file system, path in it) of a folder; any that pyarrow knows (local and shared folders, hdfs, s3, ...)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


class FileWriter:
    """Appends documents to a file; holds less than a block of ids beside the index."""

    def __init__(self, out, block: int = BLOCK, percentile: float = PERCENTILE):
        if not 0 < block <= 1 << 16 or not 0 < percentile <= 100:
            raise ValueError("block must be in 1..65536, percentile over 0 and up to 100")
        self.out, self.block, self.percentile = out, block, percentile
        self.left = np.zeros(0, np.uint32)
        self.docs, self.sizes, self.starts, self.place = [], [], [], len(MAGIC)
        out.write(MAGIC)

    def _put(self, ids: np.ndarray) -> None:
        data = pack(ids, self.percentile)
        self.starts.append(self.place)
        self.place += len(data)
        self.out.write(data)

    def add(self, doc_ids: list, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents in their order: ids (None allowed), numbers of token ids, all token ids."""
        self.docs += doc_ids
        self.sizes.append(sizes.astype(np.uint64))
        ids = np.concatenate((self.left, ids)) if len(self.left) else ids
        whole = len(ids) - len(ids) % self.block
        for k in range(0, whole, self.block):
            self._put(ids[k:k + self.block])
        self.left = ids[whole:].copy()

    def close(self) -> tuple[int, int]:
        """Write the index; (documents, ids)."""
        if len(self.left):
            self._put(self.left)
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.uint64)
        names = np.array([d or 0 for d in self.docs], "<i8")
        missing = np.array([d is None for d in self.docs], np.uint8)
        starts = np.array([*self.starts, self.place], "<u8")
        tail = names.tobytes() + missing.tobytes() + sizes.astype("<u8").tobytes()
        n_ids = int(sizes.sum())
        self.out.write(tail + starts.tobytes())
        self.out.write(FOOTER.pack(self.place, self.place + len(tail), len(names), n_ids, len(self.starts), MAGIC))
        return len(names), n_ids


class FileReader:
    """Random access to a file of blocks."""

    def __init__(self, source, size: int):
        self.source = source
        docs_at, starts_at, self.n_docs, self.n_ids, blocks, magic = FOOTER.unpack(self._bytes(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token blocks")
        self._docs_at = docs_at
        self.starts = np.frombuffer(self._bytes(starts_at, 8 * (blocks + 1)), "<u8").astype(np.int64)
        # every block but the last is full, so the first one tells the size of all
        self.block = HEAD.unpack(self._bytes(int(self.starts[0]), HEAD.size))[0] if blocks else 1

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(n)
        if len(data) != n:
            raise ValueError("token file ends too early")
        return data

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, whether a document has none, numbers of token ids)."""
        n = self.n_docs
        data = self._bytes(self._docs_at, 17 * n)
        return (np.frombuffer(data, "<i8", n), np.frombuffer(data, np.uint8, n, 8 * n).astype(bool),
                np.frombuffer(data, "<u8", n, 9 * n).astype(np.int64))

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids first..last-1 of the file, from the blocks that hold them."""
        if not 0 <= first <= last <= self.n_ids:
            raise IndexError("ids outside the file")
        if first == last:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, (last - 1) // self.block
        base = int(self.starts[a])
        data = memoryview(self._bytes(base, int(self.starts[b + 1]) - base))
        cuts = (self.starts[a:b + 2] - base).tolist()
        ids = np.concatenate([unpack(data[x:y]) for x, y in zip(cuts, cuts[1:])])
        return ids[first - a * self.block:last - a * self.block]


def manifest(path: str) -> list[dict]:
    """A folder's files in order: name, part, docs, ids, and first, the ids of all files before."""
    system, folder = opened(path)
    with system.open_input_stream(f"{folder}/{MANIFEST}") as f:
        files = json.loads(f.read())["files"]
    first = 0
    for file in files:
        file["first"] = first
        first += file["ids"]
    return files


def read_ids(path: str, first: int, n: int) -> np.ndarray:
    """``n`` ids from the place ``first`` of the whole folder, as training samples are cut."""
    system, folder = opened(path)
    out = []
    for file in manifest(path):
        a, b = max(first, file["first"]), min(first + n, file["first"] + file["ids"])
        if a < b:
            with system.open_input_file(f"{folder}/{file['name']}") as source:
                out.append(FileReader(source, source.size()).ids(a - file["first"], b - file["first"]))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


# ---------------------------------------------------------------- the data source

@dataclass
class Written(WriterCommitMessage):
    name: str | None
    part: int
    docs: int = 0
    ids: int = 0


class Part(InputPartition):
    def __init__(self, name: str, first: int):
        super().__init__(name)
        self.name, self.first = name, first


class TokenWriter(DataSourceArrowWriter):
    """Writes (doc_id long, ids array<int>), one file to a task, in the order of the rows."""

    def __init__(self, path: str, block: int, percentile: float, overwrite: bool):
        self.path, self.block, self.percentile, self.overwrite = path, block, percentile, overwrite

    def write(self, iterator):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        name, out, writer = f"part-{part:06d}-{uuid.uuid4().hex}.ids", None, None
        system, folder = opened(self.path)
        for batch in iterator:
            for some in slices([batch], 512):
                if not some.num_rows:
                    continue
                if writer is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}")
                    writer = FileWriter(out, self.block, self.percentile)
                ids = some.column(1)
                writer.add(some.column(0).to_pylist(), ids.value_lengths().to_numpy(),
                           ids.flatten().to_numpy().astype(np.uint32))
        if writer is None:
            return Written(None, part)
        docs, n = writer.close()
        out.close()
        return Written(name, part, docs, n)

    def commit(self, messages):
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        files = [m for m in sorted((m for m in messages if m is not None), key=lambda m: m.part) if m.name]
        if not self.overwrite:
            from pyarrow import fs
            if system.get_file_info(f"{folder}/{MANIFEST}").type != fs.FileType.NotFound:
                raise ValueError(f"{self.path} already holds token files")
        with system.open_output_stream(f"{folder}/{MANIFEST}") as f:
            f.write(json.dumps({"format": MAGIC.decode(), "files": [
                {"name": m.name, "part": m.part, "docs": m.docs, "ids": m.ids} for m in files]}).encode())

    def abort(self, messages):
        system, folder = opened(self.path)
        for m in messages:
            if m is not None and m.name:
                system.delete_file(f"{folder}/{m.name}")


class TokenReader(DataSourceReader):
    """Reads a folder's documents, one partition to a file."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [Part(f["name"], f["first"]) for f in manifest(self.path)]

    def read(self, partition):
        if partition is None:  # a folder without files
            return
        system, folder = opened(self.path)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
        with system.open_input_file(f"{folder}/{partition.name}") as source:
            file = FileReader(source, source.size())
            names, missing, sizes = file.documents()
            ends = np.cumsum(sizes)
            i = 0
            while i < len(sizes):
                start = int(ends[i] - sizes[i])
                j = max(i + 1, min(int(np.searchsorted(ends, start + BATCH_IDS, "right")), i + 4096))
                ids = file.ids(start, int(ends[j - 1]))
                cuts = np.concatenate(([0], ends[i:j] - start)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[i:j], mask=missing[i:j]), pa.array(ends[i:j] - sizes[i:j] + partition.first),
                    pa.array(sizes[i:j]), pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32)))], schema=schema)
                i = j


class TokenBlocks(DataSource):
    """``spark.read.format("token_blocks").load(path)`` and ``df.write.format("token_blocks")``."""

    @classmethod
    def name(cls):
        return "token_blocks"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TokenReader(self.options["path"])

    def writer(self, schema, overwrite):
        return TokenWriter(self.options["path"], int(self.options.get("block", BLOCK)),
                           float(self.options.get("percentile", PERCENTILE)), overwrite)


# ---------------------------------------------------------------- texts to ids

#: a text's cuts before a run of blanks and lines: pretokens never reach over one, whatever stands around it
CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: blanks of other kinds join the runs that the tokenizer sees; such texts are encoded whole
OTHER_BLANK = re.compile(r"[^\S \n]")
#: marks that make one pretoken together and none with letters or digits before them
POINTS = string.punctuation.replace("'", "")
LATIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: letters and digits: a pretoken ends between one and marks, and between a single line end and one
PLAIN = frozenset(string.ascii_letters + string.digits + "".join(c for c in map(chr, range(0xC0, 0x100)) if c.isalpha()))
CALL_CHARS = 1 << 16  # characters of texts cut at a time: the chunks looked up are still in the cache
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it can be
    printed, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)}


class Encoder:
    """``encode`` of the tokenizers library, its results kept by chunk of a text.

    The ids of a text are those of its chunks, as the byte-level pattern cuts there anyway.
    Two generations of ``keep`` chunks at most are held.  A chunk that is one pretoken goes to
    the library's model without its pattern, as the characters that stand for its bytes.
    """

    def __init__(self, path: str, keep: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task to a core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.by_chunk = (self.tokenizer.normalizer is None
                         and json.loads(self.tokenizer.pre_tokenizer.__getstate__()) == BYTE_LEVEL)
        self.table = byte_characters()
        self.keep, self.new, self.old = keep, {}, {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pretokens(self, chunks: list[str]) -> list[bytes]:
        shown = "\n".join(chunks).encode().decode("latin-1").translate(self.table)
        tokens = self.model.tokenize
        return [array("I", [t.id for t in tokens(x)]).tobytes() for x in shown.split(self.table[10])]

    def learn(self, chunks: set[str]) -> None:
        """Ids of all chunks into ``new``; one with a line end before or marks after is put together from its parts."""
        new, old = self.new, self.old
        joined, missing = [], set()
        for chunk in chunks.difference(new):
            ids = old.get(chunk)
            if ids is not None:
                new[chunk] = ids
                continue
            part = chunk.rstrip(POINTS)
            parts = [part, chunk[len(part):]] if part != chunk and part[-1:] in PLAIN else [chunk]
            if chunk[0] == "\n" and chunk[1:2] in PLAIN:
                parts[:1] = "\n", parts[0][1:]
            if len(parts) == 1:
                missing.add(chunk)
            else:
                joined.append((chunk, parts))
        for part in {p for _, parts in joined for p in parts}.difference(new):
            ids = old.get(part)
            if ids is None:
                missing.add(part)
            else:
                new[part] = ids
        one, other = [], []
        for part in missing:
            (one if LATIN.fullmatch(part) or not part.strip(POINTS) else other).append(part)
        for some, how in ((one, self.pretokens), (other, self.whole)):
            for k in range(0, len(some), 4096):
                new.update(zip(some[k:k + 4096], how(some[k:k + 4096])))
        for chunk, parts in joined:
            new[chunk] = b"".join([new[p] for p in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as uint32 of the machine's order."""
        if not self.by_chunk:
            return self.whole(texts)
        out: list[bytes] = []
        flat: list[str] = []   # the chunks of the texts since the last call, one text after the other
        ends: list[int] = []   # where each text's end, -1 minus that for a text to be encoded whole
        held = 0
        for i, text in enumerate(texts):
            other = OTHER_BLANK.search(text) is not None
            if not other:
                flat += CHUNK.findall(text)
            ends.append(-1 - len(flat) if other else len(flat))
            held += len(text)
            if held < CALL_CHARS and i + 1 < len(texts):
                continue
            ids = list(map(self.new.get, flat))
            missing = [k for k, x in enumerate(ids) if x is None]
            self.learn({flat[k] for k in missing})
            for k in missing:
                ids[k] = self.new[flat[k]]
            first = 0
            for text, end in zip(texts[len(out):i + 1], ends):
                out.append(b"".join(ids[first:end]) if end >= 0 else self.whole([text])[0])
                first = end if end >= 0 else -1 - end
            flat, ends, held = [], [], 0
            if len(self.new) > self.keep:
                self.old, self.new = self.new, {}
        return out


ENCODERS: dict[str, Encoder] = {}  # one to a Python worker: its chunks serve later tasks too


def encoder(path: str) -> Encoder:
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def encode(path: str, end_id: int | None):
    """mapInArrow function from (doc_id, text) to (doc_id, ids)."""
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches):
        own = encoder(path)
        for batch in slices(batches, 1024):
            ids = [x + end for x in own.encode(batch.column(1).to_pylist())]
            cuts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(cuts, values)], names=["doc_id", "ids"])
    return run


def file_count(size: int, rows: int, partitions: int) -> int:
    """Files for ``size`` bytes of text: as many as the session's partitions, within the bounds to a file."""
    size += 32 * rows
    return max(1, -(-size // MOST_BYTES), min(partitions, -(-size // LEAST_BYTES)))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0,
                 block: int = BLOCK, percentile: float = PERCENTILE) -> None:
    """Encode every whole text and write the ids under ``path`` in ascending doc_id order.

    ``docs`` has doc_id and text; other columns are not read.  Null texts count as empty:
    such a document has the end id only (none at all where ``end_id`` is None).  Rows
    without doc_id come last.  Rows that share a doc_id stand by the hash of their text, then
    the text; whole repeats are all written.  Rows are dealt by range of (doc_id, hash of the
    text, place in the input), so an id that fills a third of the table is spread over files.
    An empty table gives a manifest without files.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenBlocks)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size, rows = d.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)), F.count(F.lit(1))).first()
    files = file_count(size, rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    dealt = (d.withColumn("h", F.xxhash64("text")).withColumn("i", F.monotonically_increasing_id())
             .repartitionByRange(files, *order, F.col("i")).sortWithinPartitions(*order, "text"))
    ids = dealt.select("doc_id", "text").mapInArrow(encode(tokenizer, end_id), "doc_id long, ids array<int>")
    (ids.write.format("token_blocks").option("block", block).option("percentile", percentile)
     .mode("append").save(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of a folder; start is the number of ids before it."""
    spark.dataSource.register(TokenBlocks)
    return spark.read.format("token_blocks").load(path)


def crc32_of_ids(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): crc32 of the ids as little-endian uint32."""
    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            flat = np.ascontiguousarray(ids.flatten().to_numpy(), "<u4").tobytes()
            cuts = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy()))) * 4
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return (tokens.select("doc_id", "start", "n_tokens", "ids")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_file_digests(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """``write_tokens`` to the shared folder, then ``crc32_of_ids`` of what ``read_tokens`` gives back."""
    path = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, end_id)
    return crc32_of_ids(read_tokens(docs.sparkSession, path))
