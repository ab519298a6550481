"""Token ids in binary files of compressed byte planes, and back.

A file holds the ids of many documents one after the other, cut into blocks of a fixed number of
ids. Each block is transposed into four planes, one for each byte of its 32-bit ids, so that the
nearly constant high bytes lie together, and each plane is compressed with zstandard.

    "BPT1"  planes of block 0, of block 1, ...  footer  length of the footer (8 bytes)  "BPT1"

The footer, compressed too, is a JSON head and four arrays: the chunk index (ids in each block,
compressed length of each plane) and the document table (ids, null flags, numbers of ids). So a
reader can go to any block or document. All numbers are little-endian.

A table is written as one file per range of its order; the files in their order hold all documents
in it. Without another order that is ascending by id (null first, equal ids in the order of a hash
of the text), so rows that share an id or have none are spread over files too.

Null and empty texts give the end id alone. Rows that repeat are written each. Other columns are
ignored. An empty table gives no files. A task holds one block and the document table of its file.
"""

import json
import os
import re
import string
import sys
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenshoe.llm.shared import Scratch, bounded_batches, per_process, text_of, text_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC, BLOCK, LEVEL, WIDTH = b"BPT1", 16_384, 3, 4
END_ID = 2
# Words whose ids a worker remembers (some 120 MB at most, and what one group of texts adds), words
# encoded in one call, and bytes of texts whose words are looked up together.
REMEMBERED, AT_ONCE, GROUP_BYTES = 600_000, 500, 8 << 20
SIGNS = string.punctuation.encode()


def filesystem(path: str):
    """The file system of a path and the path in it, for executors to write to and read from."""
    from pyarrow import fs

    if re.match(r"^(file:)?/", path):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:", "", path).lstrip("/")
    return fs.FileSystem.from_uri(path)


def to_planes(ids: np.ndarray, compressor) -> list[bytes]:
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, WIDTH).T
    return [compressor.compress(np.ascontiguousarray(p)) for p in planes]


def from_planes(planes: list[bytes], n: int, decompressor) -> np.ndarray:
    raw = [np.frombuffer(decompressor.decompress(p, max_output_size=n), np.uint8) for p in planes]
    return np.stack(raw, axis=1).reshape(-1).view("<u4")


class Writer:
    """Writes documents' ids to one file."""

    def __init__(self, stream):
        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=LEVEL)
        self.waiting, self.n_waiting = [], 0
        self.index, self.ids, self.null, self.sizes = [], [], [], []
        stream.write(MAGIC)

    def add(self, doc_id: int | None, data: bytes) -> None:
        """``data``: the document's ids as 32-bit numbers."""
        self.ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.sizes.append(len(data) // WIDTH)
        self.waiting.append(data)
        self.n_waiting += self.sizes[-1]
        if self.n_waiting >= BLOCK:
            ids = np.frombuffer(b"".join(self.waiting), "<u4")
            whole = len(ids) // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                self._block(ids[at : at + BLOCK])
            self.waiting, self.n_waiting = [ids[whole:].tobytes()], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        planes = to_planes(ids, self.compressor)
        self.index.append([len(ids), *map(len, planes)])
        self.stream.write(b"".join(planes))

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.frombuffer(b"".join(self.waiting), "<u4"))
        arrays = [
            np.array(self.index, "<i4").reshape(-1, WIDTH + 1),
            np.array(self.ids, "<i8"), np.array(self.null, "u1"), np.array(self.sizes, "<i8"),
        ]
        head = {"blocks": len(self.index), "documents": len(self.ids), "block": BLOCK}
        text = json.dumps(head).encode()
        body = len(text).to_bytes(4, "little") + text + b"".join(a.tobytes() for a in arrays)
        footer = self.compressor.compress(body)
        self.stream.write(footer + len(footer).to_bytes(8, "little") + MAGIC)


class Reader:
    """Reads a file; ``blocks`` goes through its ids one block at a time."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        stream.seek(size - 12)
        tail = stream.read(12)
        if tail[8:] != MAGIC:
            raise ValueError("not a token file")
        length = int.from_bytes(tail[:8], "little")
        stream.seek(size - 12 - length)
        body = zstandard.ZstdDecompressor().decompress(stream.read(length))
        n = int.from_bytes(body[:4], "little")
        head, at = json.loads(body[4 : 4 + n]), 4 + n

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, count, at)
            at += out.nbytes
            return out

        self.index = take(head["blocks"] * (WIDTH + 1), "<i4").reshape(-1, WIDTH + 1)
        self.ids = take(head["documents"], "<i8")
        self.null = take(head["documents"], "u1")
        self.sizes = take(head["documents"], "<i8")

    def blocks(self) -> Iterator[np.ndarray]:
        decompressor = zstandard.ZstdDecompressor()
        self.stream.seek(len(MAGIC))
        for n, *lengths in self.index.tolist():
            data = self.stream.read(sum(lengths))
            cuts = np.cumsum([0, *lengths]).tolist()
            planes = [data[a:b] for a, b in zip(cuts, cuts[1:])]
            yield from_planes(planes, n, decompressor)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(id, ids before it in this file, its ids, crc32 of them)."""
        blocks, block, at, start = self.blocks(), b"", 0, 0
        for doc_id, null, size in zip(self.ids.tolist(), self.null.tolist(), self.sizes.tolist()):
            crc, left = 0, size * WIDTH
            while left:
                if at == len(block):
                    block, at = next(blocks).tobytes(), 0
                part = block[at : at + left]
                crc, at, left = zlib.crc32(part, crc), at + len(part), left - len(part)
            yield (None if null else doc_id), start, size, crc
            start += size


class Encoder:
    """Ids of texts as 32-bit numbers, for vocabularies that drop white space between words.

    Such a vocabulary gives a word the same ids wherever it stands, so each distinct word is
    encoded once and remembered. Signs after letters must be a part of their own, which is looked
    at on a probe. A-Z may be lower-cased first, as the vocabulary does it anyway, unless an accent
    of its own follows, which may join a small letter only, or a special token would come about.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known = Tokenizer.from_str(vocabulary), {}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # First bytes of U+0300 to U+037F, the accents that a letter of A-Z can join.
        self.cased = [b"\xcc", b"\xcd", *(t.encode().lower() for t in special)]

        # Ids that end a part of a text, if each part ends in one: all bytes need one.
        vocab = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        every = [c + e for c in pre_tokenizers.ByteLevel.alphabet() for e in ("", suffix or "")]
        split = self.tokenizer.pre_tokenizer
        parts = split and [part for part, _ in split.pre_tokenize_str("ab.,;")]
        self.ends = None
        if suffix and parts == ["ab", ".,;"] and all(c in vocab for c in every):
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def learn(self, words: list[bytes]) -> None:
        """A word of letters and signs after them is put together from both."""
        letters, others, joined = set(), set(), []
        for word in words:
            stem = word.rstrip(SIGNS)
            text = unicodedata.normalize("NFC", stem.decode("utf-8", "replace")).lower()
            if self.ends is None or not text.isalpha():
                others.add(word)
                continue
            letters.add(stem)
            if stem != word:
                others.add(word[len(stem) :])
                joined.append((word, len(stem)))
        for new, encode in ((letters, self._by_ends), (others, self._by_offsets)):
            new = list(new.difference(self.known))
            for i in range(0, len(new), AT_ONCE):
                part = new[i : i + AT_ONCE]
                data, cuts = encode([w.decode("utf-8", "replace") for w in part])
                self.known.update((w, data[a:b]) for w, a, b in zip(part, cuts, cuts[1:]))
        self.known.update((w, self.known[w[:n]] + self.known[w[n:]]) for w, n in joined)

    def _by_ends(self, texts: list[str]) -> tuple[bytes, list[int]]:
        """Ids of words and where each begins, for words that are one part each."""
        together = [" ".join(texts)]
        encoding = self.tokenizer.encode_batch_fast(together, add_special_tokens=False)[0]
        ids = np.array(encoding.ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(texts):  # some are of several parts, and every word is of one at least
            return self._by_offsets(texts)
        return ids.tobytes(), [0, *(ends * WIDTH).tolist()]

    def _by_offsets(self, texts: list[str]) -> tuple[bytes, list[int]]:
        """Ids of words and where each begins, by the places of ids in the text, which cost more."""
        encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        starts = np.array([a for a, _ in encoding.offsets], np.int64)
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = [0, *(np.searchsorted(starts, ends) * WIDTH).tolist()]
        return np.array(encoding.ids, "<u4").tobytes(), cuts

    def _together(self, texts: list[bytes]) -> Iterator[bytes]:
        """Each word that several texts share is looked up once."""
        lower = [text.lower() for text in texts]
        for i, text in enumerate(lower):
            if any(mark in text for mark in self.cased):
                lower[i] = texts[i]
        lists = pc.ascii_split_whitespace(pa.array(lower, pa.binary()).view(pa.string()))
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        data = list(map(self.known.get, distinct))
        new = [word for word, ids in zip(distinct, data) if ids is None]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {w: ids for w, ids in zip(distinct, data) if ids is not None}
            self.learn(new)
            data = list(map(self.known.__getitem__, distinct))
        ids = pa.array(data, pa.large_binary()).take(words.indices)
        _, offsets, content = ids.buffers()
        cuts = np.frombuffer(offsets, np.int64)[lists.offsets.to_numpy()].tolist()
        content = memoryview(content or b"")
        for a, b in zip(cuts, cuts[1:]):
            yield bytes(content[a:b])

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        group, size = [], 0
        for text in texts:
            if size + len(text) > GROUP_BYTES and group:
                yield from self._together(group)
                group, size = [], 0
            if len(text) > GROUP_BYTES:
                yield b"".join(d for piece in text_slices(text) for d in self._together([piece]))
            else:
                group.append(text)
                size += len(text)
        if group:
            yield from self._together(group)


def stored_order(docs: DataFrame) -> list[Column]:
    """What rows sort by as they lie in the files of a table that Spark has written.

    Only for a table as it was read; there is no such order for other rows, and none is given.
    """
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long")
    order = [number, name, F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return []
    return order


def write_files(
    docs: DataFrame,
    scratch: Scratch,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    order: list[Column] | None = None,
) -> DataFrame:
    """Encode and write all documents, by id or in another order; gives the list of files.

    Files (shard, path, n_documents, n_ids): shards ascend in the order. The list is written last
    and names only files of tasks that ended well, so what a lost executor leaves is not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(vocabulary, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    folder = scratch.path("files")
    text = text_of(text_col)
    keys = order or [F.col(id_col).cast("long"), F.xxhash64(text)]
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        text.cast("binary").alias("_text"),
        *[key.alias(f"_key{k}") for k, key in enumerate(keys)],
    )
    by = [f"_key{k}" for k in range(len(keys))]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(*by)
    end = int(end_id).to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = per_process(f"ids_{zlib.crc32(content.value.encode())}", lambda: Encoder(content.value))
        files, root = filesystem(folder)
        shard = TaskContext.get().partitionId()
        path = f"{root}/{shard:08d}-{uuid.uuid4().hex}.bpt"
        writer = stream = None
        for batch in batches:
            if writer is None and batch.num_rows:
                files.create_dir(root, recursive=True)
                stream = files.open_output_stream(path)
                writer = Writer(stream)
            texts = batch.column(1).to_pylist()
            for doc_id, data in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                writer.add(doc_id, data + end)
        if writer is not None:
            writer.close()
            stream.close()
            row = {
                "shard": shard,
                "path": f"{folder}/{path.rpartition('/')[2]}",
                "n_documents": len(writer.sizes),
                "n_ids": sum(writer.sizes),
            }
            yield pa.RecordBatch.from_pylist([row])

    files = ordered.mapInArrow(run, "shard long, path string, n_documents long, n_ids long")
    return scratch.save(files, "list")


def read_documents(files: DataFrame) -> DataFrame:
    """Documents as they stand in the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, also in earlier files. The list has one
    row per file, so its running sum is the only thing that one task makes alone.
    """
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).cast("long")
    n = max(1, files.count())
    rows = files.withColumn("base", base).select("path", "base").repartition(n, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns)):
                system, inside = filesystem(path)
                with system.open_input_file(inside) as stream:
                    found = []
                    for doc_id, start, size, crc in Reader(stream).documents():
                        found.append((doc_id, before + start, size, crc))
                        if len(found) == 10_000:
                            yield _rows(found, names)
                            found = []
                    yield _rows(found, names)

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in found], pa.int64()) for k in range(len(names))]
    return pa.RecordBatch.from_arrays(columns, names)
