"""Token ids in seekable files: independent zstandard frames, a seek table at the end, a checksum per frame.

A file holds the ids of consecutive documents as little-endian unsigned 32-bit integers, cut into frames
of ``FRAME_IDS`` ids. Behind the frames stand two skippable frames, which plain zstandard readers ignore:
the document index (ids and lengths, compressed) and the seek table of the public seekable format
(compressed size, size and checksum of each frame; a 9-byte footer). A reader takes the footer, the
table and the index, and decompresses only the frames that hold the documents it is asked for.

Files are written by the tasks of one range-partitioned job, under a name of their own per attempt; the
manifest, a Parquet table committed by Spark, lists those that count. A lost executor therefore leaves at
worst an unlisted file.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections import ChainMap
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.shared import lanes, slices, texts

FRAME_IDS = 1 << 16
#: Fixed values of the public seekable zstandard format.
SEEK_TABLE, FOOTER, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Skippable frame of the document index.
INDEX = 0x184D2A5D
_MANIFEST = "shard int, path string, documents long, tokens long"


# Encoding ---------------------------------------------------------------------


class WordEncoder:
    """Encode texts with a tokenizer file whose pieces never reach across blanks.

    The tokenizer lowers a text, drops white space and cuts the rest by its own pattern; each piece is encoded alone. A plain
    text is checked, lowered and split in one call each, and its words are looked up. New words are cut into pieces, new pieces
    are encoded by the library, many in one call. A text that holds anything the normaliser treats specially is encoded word by
    word, odd words by the whole tokenizer. The memory of words is bounded; what is beyond it is just encoded again.
    """

    #: The split pattern of the tokenizer file (a fixed value).
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: The same in the standard library's faster terms, for texts without numbers beyond 0 to 9.
    COMMON = r"[^\W\d_]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]|_)+"
    KEEP_WORDS, LONG, STRETCH = 800_000, 64, 1 << 20

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks already fill the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary, mark = self.whole.get_vocab(), self.whole.model.end_of_word_suffix
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if mark and t.endswith(mark)]] = True
        self.cut_any = regex.compile(self.PIECES).findall
        self.cut_common = re.compile(self.COMMON).findall
        self.words: dict[str, bytes] = {}

    def __call__(self, batch: Sequence[str]) -> list[bytes]:
        texts = [t.replace("\n", " ") for t in batch]
        out: list[bytes] = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if len(t) <= self.STRETCH and self._plain(t)]
        for i, ids in zip(plain, self._sound([texts[i].lower().split(" ") for i in plain])):
            out[i] = ids
        for i in set(range(len(texts))).difference(plain):
            out[i] = b"".join(map(self._stretch, _stretches(texts[i], self.STRETCH)))
        return out

    @staticmethod
    def _plain(text: str) -> bool:
        """Whether the normaliser does nothing but lower it."""
        if not text.isprintable() or "<|" in text:
            return False
        return text.isascii() or not ("Σ" in text or "İ" in text) and unicodedata.is_normalized("NFC", text)

    def _stretch(self, text: str) -> bytes:
        if self._plain(text):
            return self._sound([text.lower().split(" ")])[0]
        words = text.split(" ")
        kinds = {w: self._plain(w) for w in set(words)}
        sound, odd = ([w for w, ok in kinds.items() if ok is kind] for kind in (True, False))
        found = dict(zip(sound, self._sound([[w.lower()] for w in sound])))
        found |= {w: _bytes(e.ids) for w, e in zip(odd, self.whole.encode_batch(odd, add_special_tokens=False))}
        return b"".join(map(found.__getitem__, words))

    def _sound(self, parts: list[list[str]]) -> list[bytes]:
        """The ids of texts given as plain words in lower case."""
        new = set(chain.from_iterable(parts)).difference(self.words)
        known = self._kept(self._new_words(new)) if new else self.words
        return [b"".join(map(known.__getitem__, p)) for p in parts]

    def _new_words(self, new: set[str]) -> dict[str, bytes]:
        """New words and the new pieces they are made of; a word of letters is its own piece."""
        cut = {w: self.cut(w) for w in new if not w.isalpha()}
        pieces = new.difference(cut)
        pieces.update(set(chain.from_iterable(cut.values())).difference(self.words))
        fresh = self._new_pieces(pieces)
        known = self.words
        fresh |= {w: b"".join([fresh[x] if x in fresh else known[x] for x in p]) for w, p in cut.items()}
        return fresh

    def cut(self, word: str) -> Sequence[str]:
        """The pieces of a plain word in lower case."""
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return word[:-1], word[-1]
        if word.isascii() or not any(map(str.isnumeric, set(word).difference("0123456789"))):
            return self.cut_common(word)
        return self.cut_any(word)

    def _kept(self, fresh: dict[str, bytes]) -> Mapping[str, bytes]:
        """Remember what fits; returns all there is for this call."""
        memory, room = self.words, self.KEEP_WORDS - len(self.words)
        if len(fresh) <= room and max(map(len, fresh)) <= self.LONG:
            memory.update(fresh)
            return memory
        memory.update(islice(((k, v) for k, v in fresh.items() if len(k) <= self.LONG), max(room, 0)))
        return ChainMap(fresh, memory)

    def _new_pieces(self, new: set[str]) -> dict[str, bytes]:
        """Pieces encoded many at a time; the last token of a piece is one that ends a word."""
        found: dict[str, bytes] = {}
        order = list(new)
        groups = [order[i:i + 512] for i in range(0, len(order), 512)]
        for group, made in zip(groups, self.bare.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(made.ids, "<u4")
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            if len(ends) != len(group):
                raise ValueError("the tokenizer does not mark the ends of words")
            found.update(zip(group, map(ids.tobytes().__getitem__, map(slice, [0, *ends], ends))))
        return found


def _stretches(text: str, size: int) -> Iterator[str]:
    """A long text in stretches of about ``size`` characters, cut at blanks; one without blanks stays whole."""
    at = 0
    while len(text) - at > size:
        end = text.rfind(" ", at, at + size)
        end = end if end > at else text.find(" ", at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _bytes(ids: Iterable[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, so that what it has learnt serves its later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# The file ---------------------------------------------------------------------


class Writer:
    """Write ids and documents of one file, front to back."""

    def __init__(self, out, level: int = 3):
        self.out, self.pack = out, zstandard.ZstdCompressor(level=level)
        self.waiting, self.frames, self.ids, self.counts = bytearray(), [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.waiting += ids
        full = len(self.waiting) // (FRAME_IDS * 4) * (FRAME_IDS * 4)
        for at in range(0, full, FRAME_IDS * 4):
            self._frame(bytes(self.waiting[at:at + FRAME_IDS * 4]))
        del self.waiting[:full]

    def _frame(self, data: bytes) -> None:
        packed = self.pack.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.waiting:
            self._frame(bytes(self.waiting))
        named = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        index = self.pack.compress(named.tobytes() + ids.tobytes() + np.array(self.counts, "<i8").tobytes())
        self.out.write(struct.pack("<IIQ", INDEX, len(index) + 8, len(ids)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(table) + 9) + table)
        self.out.write(struct.pack("<IBI", len(self.frames), CHECKSUMS, FOOTER))


class Reader:
    """Random access to one file; ``frames_read`` counts the frames it had to decompress."""

    def __init__(self, source, size: int):
        self.source, self.frames_read, self._last = source, 0, (None, b"")
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER or flags != CHECKSUMS:
            raise ValueError("not a file with a seek table and checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = table[:, 0], table[:, 1], table[:, 2]
        self.at = np.concatenate([[0], np.cumsum(self.packed)])
        magic, length, docs = struct.unpack("<IIQ", self._at(int(self.at[-1]), 16))
        if magic != INDEX:
            raise ValueError("the document index is missing")
        index = zstandard.ZstdDecompressor().decompress(self._at(int(self.at[-1]) + 16, length - 8))
        named = np.frombuffer(index, np.uint8, docs)
        ids = np.frombuffer(index, "<i8", docs, docs)
        self.doc_ids = [i if ok else None for i, ok in zip(ids.tolist(), named)]
        self.counts = np.frombuffer(index, "<i8", docs, 9 * docs)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            data = zstandard.ZstdDecompressor().decompress(self._at(int(self.at[k]), int(self.packed[k])), int(self.sizes[k]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last, self.frames_read = (k, data), self.frames_read + 1
        return self._last[1]

    def ids(self, document: int) -> bytes:
        """The ids of the document at a position in the file, from the frames that hold them."""
        a, b = int(self.starts[document]), int(self.starts[document + 1])
        out = []
        while a < b:
            k = a // FRAME_IDS
            stop = min(b, (k + 1) * FRAME_IDS)
            out.append(self._frame(k)[(a - k * FRAME_IDS) * 4:(stop - k * FRAME_IDS) * 4])
            a = stop
        return b"".join(out)


def open_file(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system and path of a URI, as any executor sees them."""
    return pa.fs.FileSystem.from_uri(uri)


# The operator -----------------------------------------------------------------


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1) -> DataFrame:
    """Encode every text, append ``end_id`` to each, write the ids by ascending ``doc_id``; return the manifest.

    NULL and empty texts hold the end id alone; rows without ``doc_id`` come first; repeated rows are all
    written, next to each other. An empty table gives an empty manifest. The range partitions keep the order
    across files and split even a ``doc_id`` that many rows share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), _bytes([end_id])
        shard, out, path = TaskContext.get().partitionId(), None, None
        for batch in slices(batches):
            if out is None:
                path = f"{folder}/ids-{shard:06d}-{uuid.uuid4().hex}.zst"
                fs, place = open_file(path)
                fs.create_dir(place.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(place, compression=None)
                file = Writer(out)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                file.add(doc_id, ids + end)
        if out is not None:
            file.close()
            out.close()
            rows = [[shard], [path], [len(file.ids)], [sum(file.counts)]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], ["shard", "path", "documents", "tokens"])

    spark = docs.sparkSession
    order = ["doc_id", "tie", "text"]
    ranged = texts(docs).withColumn("tie", F.xxhash64("text")).repartitionByRange(lanes(spark), "doc_id", "tie")
    rows = ranged.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, _MANIFEST)
    rows.write.parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _each(manifest: DataFrame, run, schema: str) -> DataFrame:
    """Apply a reader to every file; the manifest has a row per file, so its running sums are small."""
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("start"))
    return files.repartition(lanes(manifest.sparkSession)).mapInArrow(run, schema)


def _readers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Reader, int]]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fs, place = open_file(path)
            with fs.open_input_file(place) as source:
                yield Reader(source, source.size()), start


def digests(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start in _readers(batches):
            for at in range(0, len(file.doc_ids), 10_000):
                part = range(at, min(at + 10_000, len(file.doc_ids)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file.doc_ids[i] for i in part], pa.int64()),
                        pa.array(file.starts[part.start:part.stop] + start, pa.int64()),
                        pa.array(file.counts[part.start:part.stop], pa.int64()),
                        pa.array([zlib.crc32(file.ids(i)) for i in part], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return _each(manifest, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read(manifest: DataFrame, doc_ids: Sequence[int]) -> DataFrame:
    """``doc_id, ids`` of the requested documents; only their frames are decompressed."""
    wanted = frozenset(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, _ in _readers(batches):
            for i, doc_id in enumerate(file.doc_ids):
                if doc_id in wanted:
                    ids = np.frombuffer(file.ids(i), "<u4").astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return _each(manifest, run, "doc_id long, ids array<long>")
