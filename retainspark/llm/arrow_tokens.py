"""Token files: Arrow IPC files of fixed-size-list batches.

Documents are put in id order, encoded, ended with the end id and written as one
stream of ids cut into sequences of equal length, a file per partition.  A row of
a file is a sequence:

``ids``    fixed_size_list<uint16 or uint32>[length]
``mask``   fixed_size_list<uint8>[length / 8], a bit per token: 0 is padding
``ends``   fixed_size_list<uint8>[length / 8], a bit per token: 1 ends a document
``docs``   list<int64>, ids of the documents that end in the sequence

Bits count from the lowest.  All batches of a file but the last have the same number of
sequences and only a file's last sequence is padded, so sequence i of a mapped
file is a view at a computable place.  A document may go on over sequences, not
over files.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from retainspark.llm.common import binary_values, by_bytes, id_key, materialise, require, shared_folder, text_bytes

LENGTH, BATCH = 2048, 256
#: Word pieces whose ids one Python worker remembers.
MEMO = 600_000

_PLAIN = [chr(c) for c in (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250))]
_LETTERS = re.escape("".join(c for c in _PLAIN if unicodedata.category(c)[0] == "L"))
_NUMBERS = re.escape("".join(c for c in _PLAIN if unicodedata.category(c)[0] == "N"))
#: Anything else may fall into other classes in other libraries.
_OTHER = re.compile(f"[^{re.escape(''.join(_PLAIN))}]")
#: Fixed pattern of the byte-level pre-tokenizer, over the plain characters.
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+"
                     rf"| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+")


class Encoder:
    """Ids of whole texts by the tokenizers library.

    A byte-level vocabulary encodes the pieces of its fixed pattern one by one,
    so each distinct piece is encoded once and remembered.  Texts with other than
    plain characters, and other kinds of vocabulary, go to the library whole."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        pre = kind.get("pre_tokenizer") or {}
        self.by_piece = (kind.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.memo: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [i for i, t in enumerate(texts) if self.by_piece and not _OTHER.search(t)]
        pieces = [_PIECES.findall(texts[i]) for i in plain]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list(set(itertools.chain.from_iterable(pieces)).difference(self.memo))
        self.memo.update(zip(new, self.whole(new), strict=True))
        done = dict(zip(plain, (b"".join(map(self.memo.__getitem__, p)) for p in pieces), strict=True))
        rest = [i for i in range(len(texts)) if i not in done]
        done.update(zip(rest, self.whole([texts[i] for i in rest]), strict=True))
        return [np.frombuffer(done[i], dtype="<u4") for i in range(len(texts))]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def schema_of(wide: bool, length: int) -> pa.Schema:
    bits = pa.list_(pa.uint8(), length // 8)
    return pa.schema([("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("mask", bits), ("ends", bits),
                      ("docs", pa.list_(pa.int64()))])


class _Writer:
    """Cuts a stream of documents into sequences and writes full batches."""

    def __init__(self, sink, wide: bool, length: int):
        self.schema, self.length, self.sink = schema_of(wide, length), length, sink
        self.kind = np.uint32 if wide else np.uint16
        self.file = None
        self.ids: list[np.ndarray] = []
        self.ends: list[int] = []
        self.docs: list[int | None] = []
        self.held = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids.astype(self.kind))
        self.held += len(ids)
        self.ends.append(self.held - 1)
        self.docs.append(doc)
        if self.held >= self.length * BATCH:
            self._flush(self.held // (self.length * BATCH) * BATCH)

    def _flush(self, rows: int) -> None:
        if self.file is None:
            self.file = pa.ipc.new_file(self.sink, self.schema)
        stream = np.concatenate(self.ids)
        size = rows * self.length
        used, left = stream[:size], stream[size:]
        done = int(np.searchsorted(self.ends, size))
        place = np.array(self.ends[:done], dtype=np.int64)
        flags = np.zeros(size, dtype=bool)
        flags[place] = True
        mask = np.zeros(size, dtype=bool)
        mask[:len(used)] = True
        if len(used) < size:
            used = np.concatenate((used, np.zeros(size - len(used), dtype=self.kind)))
        bits = [np.packbits(x, bitorder="little") for x in (mask, flags)]
        per_row = np.searchsorted(place, np.arange(rows + 1) * self.length).astype(np.int32)
        batch = pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(used), self.length),
            *[pa.FixedSizeListArray.from_arrays(pa.array(b), self.length // 8) for b in bits],
            pa.ListArray.from_arrays(pa.array(per_row), pa.array(self.docs[:done], pa.int64()))], schema=self.schema)
        for lo in range(0, rows, BATCH):
            self.file.write_batch(batch.slice(lo, BATCH))
        self.ids, self.held = [left], len(left)
        self.ends, self.docs = [e - size for e in self.ends[done:]], self.docs[done:]

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length))
        if self.file is not None:
            self.file.close()


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, length: int = LENGTH,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of ``docs`` below ``folder`` (any file system that
    Spark and Arrow both know) and return ``(file, documents, tokens)``, a row
    per file; names sort in id order.

    Null texts count as empty: the end id alone.  Null ids come first and are
    null in the files; rows of one id follow a hash of their texts, and equal
    rows stay apart, so a frequent id spreads over files like any other rows.
    An empty table writes no file.  A file appears under its name only when
    complete, and a task that runs again writes the same content."""
    if length % 8:
        raise ValueError("the sequence length must be a multiple of 8")
    rows = require(docs, [id_col, text_col]).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), text_bytes(f"`{text_col}`").alias("t"))
    keys = [id_key("id"), F.xxhash64(F.coalesce("t", F.lit(b""))), F.monotonically_increasing_id()]
    rows = rows.withColumns({f"k{i}": k for i, k in enumerate(keys)})
    ordered = rows.repartitionByRange("k0", "k1", "k2").sortWithinPartitions("k0", "k1").select("id", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        wide = own.tokenizer.get_vocab_size() > 1 << 16
        store, path = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"part-{task.partitionId():08d}.arrow"
        store.create_dir(path, recursive=True)
        draft = f"{path}/.{name}.{task.taskAttemptId()}"
        count = total = 0
        with store.open_output_stream(draft) as sink:
            writer = _Writer(sink, wide, length)
            for b in by_bytes(batches, 1):
                texts = [t.decode("utf-8", "replace") for t in binary_values(b.column(1))]
                for doc, ids in zip(b.column(0).to_pylist(), own.encode(texts), strict=True):
                    writer.add(doc, np.append(ids, np.uint32(end_id)))
                    count, total = count + 1, total + len(ids) + 1
            writer.close()
        if count:
            store.move(draft, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "documents": [count], "tokens": [total]})
        else:
            store.delete_file(draft)

    return materialise(ordered.mapInArrow(run, "file string, documents long, tokens long"), "token-files")


class Sequences:
    """Random access to a token file: sequence i without reading or copying
    another one (local files are mapped)."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        batches = self.file.num_record_batches
        self.per_batch = self.file.get_batch(0).num_rows if batches else 1
        self.count = (batches - 1) * self.per_batch + self.file.get_batch(batches - 1).num_rows if batches else 0

    def __len__(self) -> int:
        return self.count

    def batch(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """``ids``, ``mask`` and ``ends`` (packed bits) of a batch, a row per
        sequence, as views; and its documents' ids."""
        b = self.file.get_batch(n)
        view = [b.column(k).flatten().to_numpy(zero_copy_only=True).reshape(b.num_rows, -1) for k in range(3)]
        return *view, b.column(3).flatten().to_pylist()

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and packed mask of sequence ``i``."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        ids, mask, _, _ = self.batch(i // self.per_batch)
        return ids[i % self.per_batch], mask[i % self.per_batch]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Every document's id and ids, in file order, a batch at a time."""
        kept: list[np.ndarray] = []
        for n in range(self.file.num_record_batches):
            ids, mask, ends, docs = self.batch(n)
            flat = ids.reshape(-1)
            last = np.flatnonzero(np.unpackbits(ends.reshape(-1), bitorder="little"))
            at = 0
            for doc, stop in zip(docs, last.tolist(), strict=True):
                yield doc, np.concatenate((*kept, flat[at:stop + 1])) if kept else flat[at:stop + 1]
                kept, at = [], stop + 1
            real = int(np.unpackbits(mask.reshape(-1), bitorder="little").sum())
            if at < real:
                kept.append(flat[at:real].copy())


def read_documents(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """One row per document, read back from the files (a task each):
    ``(doc_id, start, n_tokens, ids_crc32)``; ``start`` counts the ids of all
    documents before it."""
    names = files.select("file")
    names = names.repartition(max(1, files.count()), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                rows: list[list] = [[], [], [], []]
                at = 0
                for doc, ids in Sequences(f"{folder}/{name}").documents():
                    for c, v in zip(rows, (doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                        c.append(v)
                    at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows[0])), *[pa.array(c, pa.int64()) for c in rows]],
                    names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = materialise(names.mapInArrow(run, "file string, doc_id long, at long, n_tokens long, ids_crc32 long"), "read-back")
    sizes = found.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()  # a row per file
    before = dict(zip([r["file"] for r in sizes], itertools.accumulate([0, *[r["n"] for r in sizes]]), strict=False))
    bases = spark.createDataFrame(list(before.items()), "file string, base long")
    return (found.join(F.broadcast(bases), "file")
            .select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"))


def token_folder(spark: SparkSession) -> str:
    """A fresh folder for token files, as a URI that Arrow can open."""
    folder = shared_folder(spark, "tokens")
    if "://" in folder:
        return folder
    return f"file://{folder.removeprefix('file:')}" if folder.startswith(("file:", "/")) else folder
