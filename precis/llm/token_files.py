"""Token ids in binary files: a zstandard frame for each document, and a seek table at the end.

A file holds, one after another,

* one zstandard frame for each document, ids as little-endian unsigned 32-bit
  integers, with zstandard's own content checksum,
* a skippable frame (magic 0x184D2A50) with the documents' keys as signed 64-bit
  integers and one byte each that is 1 for a null key,
* the seek table, laid out as in zstandard's seekable format: a skippable frame
  (magic 0x184D2A5E) of compressed size, content size and checksum (the low half
  of the content's XXH64) for each frame, the number of frames, a flag byte and
  the magic 0x8F92EAB1.

A reader takes the table from the file's end and decompresses only the frames of the
documents it wants. ``_manifest.json`` names the files in the order of the documents.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.llm.words import buffers
from precis.session import ship_package, write_file

# Fixed values of the file format.
_KEYS_MAGIC, _TABLE_MAGIC, _END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80

# The published pattern of byte-level BPE that cuts a text before its merges, spelt out for Latin letters.
_BEYOND_LATIN = "[\u0250-\U0010ffff]"
_LATIN = [chr(c) for c in range(0x250)]
_L, _N, _S = ("".join(re.escape(c) for c in _LATIN if regex.match(kind, c)) for kind in (r"\p{L}", r"\p{N}", r"\s"))
_PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

LEVEL = 1
# Texts of so many bytes are encoded together, and the model sees so many words in one call.
_BYTES = 16_000_000
_WORDS = 50_000
_ROWS = 2048

# A space before more white space may belong to one token with what stands before it.
_OPEN_SPACE = re.compile(r" (?:\s|\Z)")


def _byte_letters() -> np.ndarray:
    """The letter that byte-level BPE uses for each byte: itself if it prints, else one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in prints]
    letters = np.arange(256, dtype="<u4")
    letters[hidden] = 256 + np.arange(len(hidden))
    return letters


def _spaced(texts: pa.Array, letters: np.ndarray | None = None) -> np.ndarray:
    """The bytes of all texts, or a letter for each, with a space between texts."""
    data, bounds = buffers(texts)
    data = data[bounds[0] : bounds[-1]]
    return np.insert(data if letters is None else letters[data], bounds[1:-1] - bounds[0], ord(" "))


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


class Encoder:
    """Ids of texts, as bytes, from a byte-level BPE tokenizer that starts a new token at a single space.

    Such a tokenizer never joins what stands on both sides of a space that follows
    and precedes other characters, so texts are cut before their spaces. Many texts
    are cut together, their distinct pieces are cut into words, and the model sees
    each distinct word once, many in one call. The first piece of a text, which
    stands after no space, texts with runs of white space around a space, and pieces
    beyond Latin letters or with an added token in them go through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._apart = re.compile("|".join([_BEYOND_LATIN, *map(re.escape, added)]))
        self._letters = _byte_letters()
        self._model = Tokenizer(self._tokenizer.model)
        self._model.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self._lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self._lengths[list(vocabulary.values())] = [len(t) for t in vocabulary]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The model's ids of words, without another cut, and how many each word has."""
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for at in range(0, len(words), _WORDS):
            part = words.slice(at, _WORDS)
            letters = _spaced(part, self._letters).tobytes().decode("utf-32-le")
            found = np.array(self._model.encode_batch_fast([letters], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(self._lengths[found])
            word_ends = np.cumsum(pc.binary_length(part).to_numpy().astype(np.int64))
            if not len(ends) or ends[-1] != word_ends[-1]:  # the model leaves out a byte
                each = [x.ids for x in self._model.encode_batch_fast(letters.split(" "), add_special_tokens=False)]
                found = np.array(list(chain.from_iterable(each)), "<u4")
                counts.append(np.array([len(x) for x in each], np.int64))
            else:
                counts.append(np.diff(np.searchsorted(ends, word_ends) + 1, prepend=0))
            ids.append(found)
        return np.concatenate(ids), np.concatenate(counts)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each piece after a space begin, and how many they are."""
        counts = np.zeros(len(pieces), np.int64)
        text, apart, names = " " * bool(len(pieces)) + _spaced(pieces).tobytes().decode(), [], []
        if self._apart.search(text):
            names = text[1:].split(" ")
            apart = [i for i, p in enumerate(names) if self._apart.search(p)]
            text = "".join([" " + p for p in names if not self._apart.search(p)])
        plain = np.delete(np.arange(len(pieces)), apart)
        words = pa.array(_PATTERN.findall(text), pa.string())
        coded = words.dictionary_encode()
        ids, sizes = self._words(coded.dictionary)
        place = coded.indices.to_numpy()
        of_words = sizes[place]
        own = [ids[_places((np.cumsum(sizes) - sizes)[place], of_words)]]
        if len(plain):  # a space begins a piece
            counts[plain] = np.add.reduceat(of_words, np.flatnonzero(pc.starts_with(words, " ")))
        for i, content in zip(apart, self._whole([" " + names[i] for i in apart]), strict=True):
            own.append(np.frombuffer(content, "<u4"))
            counts[i] = len(own[-1])
        order = np.concatenate([plain, np.array(apart, np.int64)])
        starts = np.zeros(len(pieces), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(own), starts, counts

    def _together(self, texts: list[str]) -> list[bytes]:
        cut = [text.partition(" ") for text in texts]
        lists = pc.split_pattern(pa.array([rest or None for _, _, rest in cut], pa.string()), " ")
        coded = lists.flatten().dictionary_encode()
        ids, starts, counts = self._pieces(coded.dictionary)
        place = coded.indices.to_numpy()
        content = ids[_places(starts[place], counts[place])].tobytes()
        ends = np.concatenate([[0], np.cumsum(counts[place])])
        last = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        bounds = [0, *(4 * ends[last]).tolist()]
        firsts = self._whole([first for first, _, _ in cut])
        return [x + content[a:b] for x, a, b in zip(firsts, bounds, bounds[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that are held in memory together."""
        closed = [not _OPEN_SPACE.search(t) for t in texts]
        found = iter(self._together([t for x, t in zip(closed, texts, strict=True) if x]))
        return [next(found) if x else self._whole([t])[0] for x, t in zip(closed, texts, strict=True)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class FrameWriter:
    """Appends frames to a binary stream and closes it with keys and seek table."""

    def __init__(self, sink):
        self._sink = sink
        self._zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self._keys, self._table = [], []

    def add(self, key: int | None, content: bytes) -> None:
        frame = self._zstd.compress(content)
        self._sink.write(frame)
        self._keys.append(key)
        self._table.append(struct.pack("<III", len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def finish(self) -> None:
        keys = np.array([k or 0 for k in self._keys], dtype="<i8").tobytes()
        nulls = bytes(k is None for k in self._keys)
        table = b"".join(self._table) + struct.pack("<IBI", len(self._table), _CHECKSUMS, _END_MAGIC)
        for magic, content in ((_KEYS_MAGIC, keys + nulls), (_TABLE_MAGIC, table)):
            self._sink.write(struct.pack("<II", magic, len(content)) + content)


class FrameReader:
    """Keys and single documents of one file."""

    def __init__(self, source):
        self._source = source
        end = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != _END_MAGIC or flags != _CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        begin = end - 9 - 12 * n - 8
        table = np.frombuffer(self._at(begin + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.checks = table[:, 1], table[:, 2]
        self._bounds = np.concatenate([[0], np.cumsum(table[:, 0])])
        stored = self._at(int(self._bounds[-1]) + 8, 9 * n)
        keys, nulls = np.frombuffer(stored[: 8 * n], "<i8"), np.frombuffer(stored[8 * n :], "u1")
        self.keys = [None if x else int(k) for k, x in zip(keys, nulls, strict=True)]
        self._zstd = zstandard.ZstdDecompressor()

    def _at(self, place: int, n: int) -> bytes:
        self._source.seek(place)
        return self._source.read(n)

    def document(self, i: int) -> bytes:
        """The ids of document ``i``, after its checksum was held against them."""
        a, b = int(self._bounds[i]), int(self._bounds[i + 1])
        content = self._zstd.decompress(self._at(a, b - a))
        if len(content) != self.sizes[i] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[i]:
            raise ValueError(f"document {i} is damaged")
        return content


def _place(uri: str):
    return pafs.FileSystem.from_uri(uri)


def write_token_files(
    df: DataFrame, key: str, text: str, path: str, tokenizer: str, end_id: int
) -> list[dict]:
    """Encode ``text`` of every row, write files below ``path`` in ascending ``key`` order, return the manifest.

    ``path`` is a shared folder that pyarrow can open, ``tokenizer`` a file of the
    tokenizers library that every worker can read. Null keys come first; rows of
    equal key follow one another in the order of a hash of their text. A null text
    is empty and gives ``end_id`` alone. Rows are dealt out by ranges of key and
    hash, so a repeated key fills no task; each task encodes its rows and writes one
    file, first under a name of its attempt, so that a repeated task replaces it.
    An empty table leaves a manifest without files. The manifest has a row per file.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = path.rstrip("/")
    end = struct.pack("<I", end_id)

    def write(batches):
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}.tok"
        fs, folder = _place(path)
        fs.create_dir(folder, recursive=True)
        trial = f"{folder}/_{name}.{context.taskAttemptId()}"
        sink, docs, ids = None, 0, 0
        for batch in batches:
            _, bounds = buffers(batch.column(1))
            at = 0
            while at < batch.num_rows:
                size = max(1, int(np.searchsorted(bounds, bounds[at] + _BYTES, "right")) - 1 - at)
                part = batch.slice(at, size)
                at += part.num_rows
                if sink is None:
                    sink = fs.open_output_stream(trial)
                    writer = FrameWriter(sink)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for k, content in zip(part.column(0).to_pylist(), encoder(tokenizer).encode(texts), strict=True):
                    writer.add(k, content + end)
                    ids += len(content) // 4 + 1
                docs += part.num_rows
        if sink is not None:
            writer.finish()
            sink.close()
            fs.move(trial, f"{folder}/{name}")
            yield pa.RecordBatch.from_pylist([{"file": name, "n_docs": docs, "n_ids": ids}])

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ways = [F.col("key"), F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = rows.repartitionByRange(*ways).sortWithinPartitions("key", F.xxhash64("text"))
    files = dealt.mapInArrow(write, "file string, n_docs long, n_ids long").collect()
    manifest, start = [], 0
    for f in sorted(files, key=lambda f: f["file"]):
        manifest.append({**f.asDict(), "start": start})
        start += f["n_ids"]
    write_file(spark, f"{path}/_manifest.json", json.dumps({"files": manifest}).encode())
    return manifest


def read_manifest(path: str) -> list[dict]:
    fs, folder = _place(path.rstrip("/"))
    with fs.open_input_stream(f"{folder}/_manifest.json") as source:
        return json.loads(source.read())["files"]


def read_token_files(
    spark: SparkSession, path: str, only: Sequence[int] | None = None, with_ids: bool = False
) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)``, with ``ids`` on demand, of the documents below ``path``.

    ``start`` counts the ids of all earlier documents. ``only`` names the wanted
    keys: no other frame is read or decompressed, and files are opened just for
    their tables. A damaged frame raises an error.
    """
    ship_package(spark)
    path = path.rstrip("/")
    schema = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    files = [(f["file"], f["start"]) for f in read_manifest(path)]
    wanted = None if only is None else set(only)

    def read(batches):
        for batch in batches:
            for file in batch.to_pylist():
                fs, folder = _place(path)
                with fs.open_input_file(f"{folder}/{file['file']}") as source:
                    frames = FrameReader(source)
                    starts = file["start"] + np.concatenate([[0], np.cumsum(frames.sizes // 4)])
                    chosen = [i for i, k in enumerate(frames.keys) if wanted is None or k in wanted]
                    for at in range(0, len(chosen), _ROWS):
                        yield _rows(frames, starts, chosen[at : at + _ROWS])

    def _rows(frames, starts, chosen):
        out = []
        for i in chosen:
            content = frames.document(i)
            row = {"key": frames.keys[i], "start": int(starts[i]), "n_tokens": len(content) // 4, "ids_crc32": zlib.crc32(content)}
            out.append(row | ({"ids": np.frombuffer(content, "<u4").tolist()} if with_ids else {}))
        fields = [("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        fields += [("ids", pa.list_(pa.int64()))] * with_ids
        return pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))

    listed = spark.createDataFrame(files, "file string, start long")
    return listed.repartition(max(1, len(files))).mapInArrow(read, schema)
