"""Token ids of documents as Arrow files of equal-length sequences.

Each task of the writing job turns its range of ids into one shard of three
files. ``ids`` and ``mask`` are Arrow IPC files whose record batches hold
fixed-size lists: ids of ``length`` tokens a row and, row for row, a mask that is
true for tokens and false for the padding behind the shard's last one. ``docs``
lists doc_id, first token and number of tokens of each document of the shard.
Sequence ``i`` of a shard is row ``i % rows`` of batch ``i // rows``; read through
a memory map nothing is copied.

Defined cases: a null or empty text has the end id alone; rows without doc_id
come first; rows that share a doc_id stay apart, ordered by a hash of the text; an empty table
gives no shard. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import drop, folder, kept, passes

#: Encodings of distinct pieces that a worker keeps at most, twice.
CACHE_PIECES = 400_000
#: A word of Latin letters before a mark, or a run of non-blanks, each with the blanks before it. Blanks are those of
#: the tokenizer's pattern: all that Python calls blank but the separators 0x1C-0x1F.
_PIECE = r"[^\S\x1c-\x1f]*(?:[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[.,;:!?*&%$#|])|[\S\x1c-\x1f]+)|[^\S\x1c-\x1f]+"
#: A word that the tokenizer's pattern takes as one, with at most one blank before it.
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SHARDS = "shard string, first_id long, first_hash long, n_docs long, n_tokens long, n_rows long"


class _Memo(dict):
    """Ids of pieces as bytes, encoded when first asked for; two generations of at most CACHE_PIECES each."""

    def __init__(self, encode_piece):
        self.encode_piece, self.old = encode_piece, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode_piece(piece)
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def word_encoder(tok):
    """A function from a word (``_WORD``) to its ids, asked of the tokenizer's model itself, or None if an added token could be part of a word.

    Such a word is one unit of a byte-level tokenizer, so the search for added tokens,
    the pattern and the offsets say nothing new.
    """
    if any(re.fullmatch("[ A-Za-zÀ-ÖØ-öø-ÿ]*", t.content) for t in tok.get_added_tokens_decoder().values()):
        return None
    # A byte-level vocabulary writes a byte that is no visible Latin-1 character as one from 256 on, in the order of the bytes.
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    byte = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in seen)}
    written = {chr(c): "".join(byte[b] for b in chr(c).encode()) for c in range(256)}
    blank, letter, tokenize = written[" "], written.__getitem__, tok.model.tokenize

    def encode_word(word: str) -> list[int]:
        return [t.id for t in tokenize(word.replace(" ", blank) if word.isascii() else "".join(map(letter, word)))]

    return encode_word


def encoder(tokenizer_file: str):
    """A function from a text to its ids, as an array of the smallest type that holds the vocabulary.

    A byte-level BPE never merges across the place where a blank follows a
    non-blank, nor where a mark follows a letter, so a text's ids are those of its
    pieces between such places. Each distinct piece is encoded once and remembered
    for the life of the worker process.
    """
    import tokenizers

    known = tokenizers.__dict__.setdefault("_remembered", {})
    if tokenizer_file in known:
        return known[tokenizer_file]
    tok = tokenizers.Tokenizer.from_file(tokenizer_file)
    kind = json.loads(tok.pre_tokenizer.__getstate__()) if tok.pre_tokenizer is not None else {}
    by_piece = tok.normalizer is None and kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space", True)
    dtype = np.dtype("<u2" if tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")

    encode_word = word_encoder(tok) if by_piece else None
    is_word = _WORD.fullmatch if encode_word else lambda piece: None

    def encode_piece(piece: str) -> bytes:
        return np.array(encode_word(piece) if is_word(piece) else tok.encode(piece, add_special_tokens=False).ids, dtype).tobytes()

    find, get = re.compile(_PIECE).findall, _Memo(encode_piece).__getitem__

    def encode(text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(get, find(text))) if by_piece else encode_piece(text), dtype)

    known[tokenizer_file] = encode, dtype
    return encode, dtype


def _open(root: str):
    fs, path = pafs.FileSystem.from_uri(root)
    return fs, path


class _Sequences:
    """Packs ids into rows of ``length`` and writes full batches; holds one batch."""

    def __init__(self, fs, path: str, length: int, rows: int, dtype: np.dtype):
        ids, mask = pa.list_(pa.from_numpy_dtype(dtype), length), pa.list_(pa.bool_(), length)
        self.length, self.rows, self.dtype = length, rows, dtype
        self.schemas = pa.schema([("ids", ids)]), pa.schema([("mask", mask)])
        self.sinks = [fs.open_output_stream(f"{path}.{k}.arrow") for k in ("ids", "mask")]
        self.files = [pa.ipc.new_file(s, schema) for s, schema in zip(self.sinks, self.schemas, strict=True)]
        self.buffer, self.held, self.total, self.n_rows = np.zeros(length * rows, dtype), 0, 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            n = min(len(ids), len(self.buffer) - self.held)
            self.buffer[self.held : self.held + n] = ids[:n]
            self.held += n
            ids = ids[n:]
            if self.held == len(self.buffer):
                self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        rows = -(-self.held // self.length)
        valid = np.arange(rows * self.length) < self.held
        self.buffer[self.held : rows * self.length] = 0
        for file, schema, flat in zip(self.files, self.schemas, (self.buffer[: rows * self.length], valid), strict=True):
            file.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length)], schema=schema))
        self.n_rows += rows
        self.held = 0

    def close(self) -> None:
        self.flush()
        for file, sink in zip(self.files, self.sinks, strict=True):
            file.close()
            sink.close()


def write(docs: DataFrame, tokenizer_file: str, end_id: int, length: int = 2048, rows: int = 64, root: str | None = None) -> tuple[DataFrame, str]:
    """Write ``docs`` as shards in ascending doc_id order; the table of shards, and the folder.

    Tasks write under names of their own and report them when complete, so a
    repeated or speculative task leaves a file that nothing refers to.
    """
    spark = docs.sparkSession
    root = root or folder(spark, "tokens")
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in chain.from_iterable(map(passes, batches)):
            if out is None:
                encode, dtype = encoder(tokenizer_file)
                fs, base = _open(root)
                fs.create_dir(base, recursive=True)
                name = f"shard-{uuid.uuid4().hex}"
                out = _Sequences(fs, f"{base}/{name}", length, rows, dtype)
                schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
                sink = fs.open_output_stream(f"{base}/{name}.docs.arrow")
                index, first, n_docs, end = pa.ipc.new_file(sink, schema), None, 0, np.array([end_id], dtype)
            starts, sizes = [], []
            for ids in map(encode, ("" if t is None else t for t in batch.column(1).to_pylist())):
                starts.append(out.total)
                sizes.append(len(ids) + 1)
                out.add(ids)
                out.add(end)
            index.write_batch(pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=schema))
            first = first or [batch.column(k)[0].as_py() for k in (0, 2)]
            n_docs += batch.num_rows
        if out is not None:
            out.close()
            index.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"shard": [name], "first_id": pa.array([first[0]], pa.int64()), "first_hash": [first[1]], "n_docs": [n_docs], "n_tokens": [out.total], "n_rows": [out.n_rows]})

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = chosen.repartitionByRange(parts, "doc_id", "hash").sortWithinPartitions("doc_id", "hash")
    shards, _ = kept(ordered.mapInArrow(work, _SHARDS), "shards")
    return shards, root


def read_sequences(root: str, shard: str, what: str = "ids"):
    """The Arrow file of one shard, memory-mapped where the store is local."""
    fs, base = _open(root)
    path = f"{base}/{shard}.{what}.arrow"
    source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
    return pa.ipc.open_file(source)


def sequence(file, i: int, rows: int) -> np.ndarray:
    """Row ``i`` of a shard's file, without a copy."""
    column = file.get_batch(i // rows).column(0)
    n = column.type.list_size
    at = column.offset + i % rows
    return column.values.slice(at * n, n).to_numpy(zero_copy_only=not pa.types.is_boolean(column.type.value_type))


def tokens(file, start: int, n: int, rows: int) -> np.ndarray:
    """``n`` tokens from ``start`` on: whole batches are views, joined if the run crosses one."""
    size = rows * file.schema.field(0).type.list_size
    out = []
    while n:
        column = file.get_batch(start // size).column(0)
        part = column.values.slice(start % size, n).to_numpy(zero_copy_only=not pa.types.is_boolean(column.type.value_type))
        out.append(part)
        start, n = start + len(part), n - len(part)
    return out[0] if len(out) == 1 else np.concatenate(out or [np.zeros(0, np.uint16)])


def read(shards: DataFrame, root: str, rows: int = 64) -> DataFrame:
    """One row per document from the files: doc_id, start among all ids, n_tokens, ids_crc32, masked (true if its mask is set throughout).

    Shards are read in parallel; the only window is over one row per shard.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, offset in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist(), strict=True):
                ids, mask, index = (read_sequences(root, shard, k) for k in ("ids", "mask", "docs"))
                for k in range(index.num_record_batches):
                    part = index.get_batch(k)
                    start, size = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
                    crc = [zlib.crc32(tokens(ids, int(a), int(n), rows).astype("<u4")) for a, n in zip(start, size, strict=True)]
                    full = [bool(tokens(mask, int(a), int(n), rows).all()) for a, n in zip(start, size, strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(start + offset), part.column("n_tokens"), pa.array(crc, pa.int64()), pa.array(full)], names=["doc_id", "start", "n_tokens", "ids_crc32", "masked"])

    ahead = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("before", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0))).select("shard", "before")
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, "shard").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long, masked boolean")


def encode_table(docs: DataFrame, tokenizer_file: str, end_id: int, length: int = 2048, rows: int = 64) -> DataFrame:
    """Write the files and read the documents back from them."""
    shards, root = write(docs, tokenizer_file, end_id, length, rows)
    return read(shards, root, rows)


def remove(spark: SparkSession, root: str) -> None:
    drop(spark, root)
