"""Token ids in binary files: each document compressed by itself, with one shared dictionary.

A table of token ids is a folder:

- ``dictionary``: a zstandard dictionary trained on the serialized ids of a sample, its SHA-256
  and the width of an id. Short documents compress badly alone; the dictionary holds what
  they have in common.
- ``frames``: files in ascending order of doc_id. A file is a sequence of records: a head
  (``HEAD``), the zstandard frame of the document's ids, and a line feed as end mark.
- ``index``: for every document the file, offset and length of its record, the ids before it
  in its file, and the dictionary's hash. One document is read by one look-up and one short read.

The files are written and read by Spark's own writers and readers, so they can be on any file
system that it knows, and a lost executor's half-written file never becomes part of a table.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import struct
import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from slipmatch.llm.tables import batch_rows, runs, to_utf8
from slipmatch.llm.words import BYTES, prefix_sums, stretch_hashes
from slipmatch.sources.shared import remove, write_aside

# Bytes of the frame, whether the document has an id, its id, number of token ids.
HEAD = "<IBqI"
HEAD_BYTES = struct.calcsize(HEAD)
END_MARK = b"\n"
FILE_BYTES = 16 << 20
# The dictionary: its size, and at most so many documents and ids of each that it is trained on.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_IDS = 64 << 10, 1000, 2048
# Fewer samples than this train no dictionary; frames then have none.
LEAST_SAMPLES = 16
# Pieces whose ids a worker remembers, about 25 bytes each; the memory is emptied when full.
MEMO_PIECES = 2_000_000
# Rows of an Arrow batch.
BATCH_ROWS = 1000
YIELD_BYTES = 4 << 20
# Letters below this code point are letters in every Unicode version.
OLD_LETTERS = 0x250
CLOSING = ".,;:!?"

ENCODED = "doc_id long, tie long, size int, record binary"
INDEX = "file long, doc_id long, offset long, length int, n_tokens long, before long"
IDS = "doc_id long, start long, n_tokens long, ids binary"


def _other_space(data: np.ndarray) -> np.ndarray:
    """Where white space other than blank and line feed starts, or a character that some Unicode versions count as such."""
    second, third = np.zeros_like(data), np.zeros_like(data)
    second[:-1], third[:-2] = data[1:], data[2:]
    pair = data.astype(np.uint16) << 8 | second
    of_2080 = ((third >= 0x80) & (third <= 0x8B)) | np.isin(third, (0xA8, 0xA9, 0xAF))
    return np.flatnonzero(
        ((data < 0x20) & (data != 0x0A) & ((data >= 0x1C) | ((data >= 0x09) & (data <= 0x0D))))
        | np.isin(pair, (0xC285, 0xC2A0, 0xE19A, 0xE1A0, 0xE281, 0xEFBB))
        | ((pair == 0xE280) & of_2080)
        | ((pair == 0xE380) & (third == 0x80))
    )


class Encoder:
    """Ids as the tokenizers library gives them, remembering pieces.

    A byte-level pre-tokenizer without a normalizer starts a new piece at each blank, and
    around each line feed, that stands between two characters which aren't white space. The
    ids of such pieces are those of the whole. Texts with other white space, or other
    tokenizers, go to the library whole. Pieces are remembered by 64-bit fingerprints; that two
    of a worker's share one has a chance of one in a million.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        layout = self.model.to_str().replace(" ", "")
        self.cuts = '"type":"ByteLevel","add_prefix_space":false' in layout and self.model.normalizer is None
        ids = self.model.get_vocab(with_added_tokens=True).values()
        self.width = 2 if max(ids, default=0) < 1 << 16 else 4
        self.letters = self._letters() if self.cuts else {}
        self._forget()

    def _forget(self) -> None:
        self.prints = np.zeros(0, dtype=np.uint64)
        # Of each piece, where its ids begin in the pool, and how many they are.
        self.begins, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.pool = np.zeros(0, dtype=f"<u{self.width}")
        self.used = 0

    def documents(self, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin and the last ends."""
        safe = np.full(len(texts), self.cuts)
        if len(data):
            space = (data == 0x20) | (data == 0x0A)
            edges = np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]] - 1])
            odd = [_other_space(data), np.flatnonzero(space[:-1] & space[1:]), edges[space[edges]]]
            safe[np.searchsorted(offsets, np.concatenate(odd), "right") - 1] = False
        cut = np.zeros(len(data), dtype=bool)
        if len(data):
            cut |= space
            cut[1:] |= data[:-1] == 0x0A
            cut[edges[: len(edges) // 2]] = True
        starts = np.flatnonzero(cut)
        text = np.searchsorted(offsets, starts, "right") - 1
        ends = np.append(starts[1:], len(data))[safe[text]]
        starts, text = starts[safe[text]], text[safe[text]]
        begins, sizes = self._known(data, starts, ends)
        counts = np.bincount(text, weights=sizes, minlength=len(texts)).astype(np.int64)
        whole = {}
        rest = np.flatnonzero(~safe)
        for at in range(0, len(rest), 64):
            some = rest[at : at + 64].tolist()
            for i, ids in zip(some, self.encoded([texts[i].as_py() or "" for i in some]), strict=True):
                whole[i] = ids
                counts[i] = len(ids)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        found = self.pool[np.repeat(begins, sizes) + inside]
        if not whole:
            return found, bounds
        out = np.zeros(bounds[-1], dtype=self.pool.dtype)
        out[np.repeat(safe, counts)] = found
        for i, ids in whole.items():
            out[bounds[i] : bounds[i + 1]] = ids
        return out, bounds

    def _known(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of the ids of each piece; those of new pieces are found first."""
        prints, first, which = np.unique(
            stretch_hashes(prefix_sums(data, BYTES), starts, ends), return_index=True, return_inverse=True
        )
        if len(self.prints) + len(prints) > MEMO_PIECES:
            self._forget()
        place = np.searchsorted(self.prints, prints)
        new = np.ones(len(prints), dtype=bool)
        inner = place < len(self.prints)
        new[inner] = self.prints[place[inner]] != prints[inner]
        if new.any():
            raw, at = data.tobytes(), first[new]
            pieces = [raw[b:e].decode() for b, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            self._remember(prints[new], place[new], self._pieces(pieces))
            place = np.searchsorted(self.prints, prints)
        place = place[which]
        return self.begins[place], self.sizes[place]

    def _remember(self, prints: np.ndarray, place: np.ndarray, found: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        total = int(sizes.sum())
        if self.used + total > len(self.pool):
            grown = np.zeros(2 * (self.used + total), dtype=self.pool.dtype)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : self.used + total] = np.fromiter(itertools.chain.from_iterable(found), dtype=self.pool.dtype, count=total)
        begins = self.used + np.cumsum(sizes) - sizes
        self.used += total
        self.prints = np.insert(self.prints, place, prints)
        self.begins = np.insert(self.begins, place, begins)
        self.sizes = np.insert(self.sizes, place, sizes)

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        out = [self.word(p) if self.letters else None for p in pieces]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for at in range(0, len(rest), 2000):
            some = rest[at : at + 2000]
            for i, ids in zip(some, self.encoded([pieces[i] for i in some]), strict=True):
                out[i] = ids
        return out

    def encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self) -> dict[int, str]:
        """How the pre-tokenizer spells letters and the blank before a word; none if letters
        may be part of an added token, or the blank is not spelled apart."""
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        if any(t.isalpha() for t in added):
            return {}
        spell = self.model.pre_tokenizer.pre_tokenize_str
        out = {c: spell(chr(c))[0][0] for c in range(OLD_LETTERS) if chr(c).isalpha()}
        blank, rest = spell(" a")[0][0][:1], spell(" a")[0][0][1:]
        return out | {0x20: blank} if rest == "a" else {}

    def word(self, piece: str) -> list[int] | None:
        """The ids of a piece that is a word of plain letters, a blank before and a mark behind
        it allowed; None for others. Such a word is one pre-token, which goes to the library's
        model itself, and a mark at the end of a piece is another."""
        body = piece[1:] if piece[:1] == " " else piece
        mark = body[-1:] if body[-1:] in CLOSING else ""
        body = body[: len(body) - len(mark)]
        if not body.isalpha() or not (body.isascii() or max(body) < chr(OLD_LETTERS)):
            return None
        tokenize = self.model.model.tokenize
        found = tokenize(piece[: len(piece) - len(mark)].translate(self.letters))
        return [t.id for t in (found + tokenize(mark) if mark else found)]


def encoder(path: str) -> Encoder:
    """One for each tokenizer and Python worker, which later tasks of the worker find filled.

    Functions of this package travel by value, so nothing of it outlasts a task; a module of
    the worker's own does.
    """
    kept = sys.modules.setdefault("token_files_of_worker", types.ModuleType("token_files_of_worker"))
    if path not in vars(kept):
        setattr(kept, path, Encoder(path))
    return getattr(kept, path)


def forget_encoders() -> None:
    """For tasks that need none: frees what encoding tasks have left in the worker."""
    sys.modules.pop("token_files_of_worker", None)


class Dictionary(NamedTuple):
    content: bytes
    sha256: str
    width: int

    def _shared(self):
        return zstandard.ZstdCompressionDict(self.content) if self.content else None

    def compressor(self) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=3, dict_data=self._shared())

    def decompressor(self) -> zstandard.ZstdDecompressor:
        if hashlib.sha256(self.content).hexdigest() != self.sha256:
            raise ValueError("the stored dictionary does not have the stored hash")
        return zstandard.ZstdDecompressor(dict_data=self._shared())

    def ids(self, decompressor: zstandard.ZstdDecompressor, frame: bytes) -> np.ndarray:
        return np.frombuffer(decompressor.decompress(frame), dtype=f"<u{self.width}").astype("<u4")


def trained(docs: DataFrame, tokenizer: str) -> Dictionary:
    """A dictionary from the first ids of about SAMPLE_DOCS documents chosen by hash, twice as many at most.

    The sample only decides how well the files compress; all documents are encoded whole. A
    task sends its own few, however many tasks there are.
    """
    every = max(1, docs.count() // SAMPLE_DOCS)
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0
    sample = docs.where(chosen & (F.col("text") != "")).select("text").limit(2 * SAMPLE_DOCS)

    def serialized(batches):
        own = encoder(tokenizer)
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                ids, bounds = own.documents(part.column("text"), data, offsets)
                cut = [ids[a : min(b, a + SAMPLE_IDS)].tobytes() for a, b in itertools.pairwise(bounds.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary())], ["ids"])

    samples = [bytes(r["ids"]) for r in sample.mapInArrow(serialized, "ids binary").collect()]
    content = b""
    if len(samples) >= LEAST_SAMPLES:
        # zstandard wants some times more samples than dictionary.
        size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
        try:
            content = zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass  # Too few or too like samples: frames go without.
    return Dictionary(content, hashlib.sha256(content).hexdigest(), encoder(tokenizer).width)


def records(docs: DataFrame, tokenizer: str, dictionary: Dictionary, end_id: int) -> DataFrame:
    """Each document's record, with the end id behind its own ids."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(to_utf8("text")).alias("tie"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def pack(batches):
        own, compressor = encoder(tokenizer), dictionary.compressor()
        end = np.array([end_id], dtype=f"<u{own.width}").tobytes()
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                ids, bounds = own.documents(part.column("text"), data, offsets)
                spans = zip(part.column("doc_id").to_pylist(), *zip(*itertools.pairwise(bounds.tolist()), strict=True), strict=True)
                out = [record(doc_id, compressor.compress(ids[a:b].tobytes() + end), b - a + 1) for doc_id, a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tie"), pa.array(map(len, out), pa.int32()), pa.array(out, pa.binary())],
                    ["doc_id", "tie", "size", "record"],
                )

    return rows.mapInArrow(pack, ENCODED)


def record(doc_id: int | None, frame: bytes, n_tokens: int) -> bytes:
    """A record but for its end mark."""
    return struct.pack(HEAD, len(frame), doc_id is not None, doc_id or 0, n_tokens) + frame


class Record(NamedTuple):
    doc_id: int | None
    offset: int
    length: int
    n_tokens: int
    frame: bytes


def parsed(content: bytes, offset: int = 0) -> Iterator[Record]:
    """Records of a file's bytes."""
    view, at = memoryview(content), 0
    while at < len(view):
        size, named, doc_id, n_tokens = struct.unpack_from(HEAD, view, at)
        end = at + HEAD_BYTES + size
        if view[end : end + 1] != END_MARK:
            raise ValueError(f"no end mark behind the record at byte {offset + at}")
        yield Record(doc_id if named else None, offset + at, end + 1 - at, n_tokens, view[at + HEAD_BYTES : end])
        at = end + 1


class TokenFiles:
    """Token ids of documents below ``folder``, which every executor can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, docs: DataFrame, tokenizer: str, end_id: int, file_bytes: int = FILE_BYTES) -> None:
        """Writes the files of a new table; a folder that has some already is an error.

        Null texts are empty ones; rows without doc_id come first. Rows of one doc_id, however
        many, are ordered by a hash of their text and dealt over files like any others. Other
        columns are left out. The index is made from the files themselves.
        """
        dictionary = trained(docs, tokenizer)
        self.spark.createDataFrame([tuple(dictionary)], "content binary, sha256 string, width int").coalesce(1).write.parquet(
            f"{self.folder}/dictionary"
        )
        aside = write_aside(records(docs, tokenizer, dictionary, end_id).withColumn("place", F.monotonically_increasing_id()), "token-records")
        encoded = aside.read(self.spark)
        total = encoded.agg(F.sum("size")).first()[0] or 0
        order = ["doc_id", "tie", "place"]
        (
            encoded.repartitionByRange(max(1, math.ceil(total / file_bytes)), *order)
            .sortWithinPartitions(*order)
            .select(F.col("record").cast("string").alias("value"))
            .write.option("lineSep", END_MARK.decode())
            .text(f"{self.folder}/frames")
        )
        remove(self.spark, aside.path)
        self._indexed().withColumn("dictionary", F.lit(dictionary.sha256)).write.parquet(f"{self.folder}/index")

    def dictionary(self) -> Dictionary:
        row = self.spark.read.parquet(f"{self.folder}/dictionary").first()
        return Dictionary(bytes(row["content"]), row["sha256"], row["width"])

    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/index")

    def _files(self) -> DataFrame:
        """Number and content of every file; the number is the order."""
        number = F.regexp_extract(F.col("path"), r"part-(\d+)[^/]*$", 1).cast("long")
        files = self.spark.read.format("binaryFile").load(f"{self.folder}/frames")
        return files.where(F.col("length") > 0).select(number.alias("file"), "content")

    def _indexed(self) -> DataFrame:
        def index(batches):
            forget_encoders()
            for batch in batches:
                for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                    found = list(parsed(content.as_buffer()))
                    n = np.array([r.n_tokens for r in found], dtype=np.int64)
                    columns = [[file] * len(found), [r.doc_id for r in found], [r.offset for r in found], [r.length for r in found], n, np.cumsum(n) - n]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int32() if i == 3 else pa.int64()) for i, c in enumerate(columns)],
                        ["file", "doc_id", "offset", "length", "n_tokens", "before"],
                    )

        return self._files().mapInArrow(index, INDEX)

    def read(self) -> DataFrame:
        """doc_id, start, n_tokens and ``ids`` (little-endian unsigned 32-bit) of all documents.

        ``start`` counts the ids of all documents before. The driver sums up one number a file,
        8 bytes for each of FILE_BYTES or so; places within a file come from the file.
        """
        dictionary, starts = self.dictionary(), self._starts()

        def decode(batches):
            forget_encoders()
            decompressor = dictionary.decompressor()
            for batch in batches:
                for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                    before, rows, held = int(starts[file]), [], 0
                    for found in parsed(content.as_buffer()):
                        ids = dictionary.ids(decompressor, found.frame)
                        rows.append((found.doc_id, before, len(ids), ids.tobytes()))
                        before += len(ids)
                        held += 4 * len(ids)
                        if held >= YIELD_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

        return self._files().mapInArrow(decode, IDS)

    def _starts(self) -> np.ndarray:
        """Ids before each file, by its number."""
        sums = self.index().groupBy("file").agg(F.sum("n_tokens").alias("ids")).toPandas().sort_values("file")
        out = np.zeros(int(sums["file"].max()) + 2 if len(sums) else 1, dtype=np.int64)
        out[sums["file"].to_numpy(np.int64) + 1] = sums["ids"].to_numpy(np.int64)
        return np.cumsum(out)

    def document(self, doc_id: int) -> list[np.ndarray]:
        """Ids of the rows of one document: only its part of the index and its records are read."""
        dictionary = self.dictionary()
        places = self.index().where(F.col("doc_id") == doc_id).orderBy("file", "offset").collect()
        if not places:
            return []
        if any(p["dictionary"] != dictionary.sha256 for p in places):
            raise ValueError("the index was made with another dictionary")
        jvm, decompressor = self.spark._jvm, dictionary.decompressor()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/frames")
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = []
        for place in places:
            (found,) = system.globStatus(jvm.org.apache.hadoop.fs.Path(folder, f"part-{place['file']:05d}-*"))
            stream = system.open(found.getPath())
            try:
                stream.seek(place["offset"])
                raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, place["length"]))
            finally:
                stream.close()
            (only,) = parsed(raw, place["offset"])
            out.append(dictionary.ids(decompressor, only.frame))
        return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * 3 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "n_tokens", "ids"]
    )


def stored(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Writes the documents' ids below ``folder`` and gives what the files hold."""
    files = TokenFiles(docs.sparkSession, folder)
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        files.write(docs, tokenizer, end_id)
    return files.read()
