"""Token-ID output: fixed-width bit packing with block offsets.

File format, little-endian throughout::

    b"LGPK0001"                       magic
    packed blocks                     each holds BLOCK ids (the last one fewer) of `width` bits,
                                      lowest bit first, padded to a whole byte
    uint64 offset of each block, and of the end of the last
    uint64 ids, uint64 position of the offsets, uint32 width, uint32 BLOCK, magic

`width` is the least number of bits that holds every id of the vocabulary.  A reader finds
any span of ids from the block offsets and unpacks it with numpy.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.llm.common import frugal, new_path, slices, small_batches

MAGIC = b"LGPK0001"
BLOCK = 4096
_TRAILER = struct.Struct("<QQII8s")

#: A space with white space on both sides (or at the end of the text): there, words are not
#: tokenised independently of each other.
_JOINED_SPACES = r"[\t-\r \x{85}\p{Z}] (?:[\t-\r \x{85}\p{Z}]|\z)"
#: Chunks after which a worker starts a new generation of those it remembers; it holds two, some 70 MB each.
_REMEMBERED = 300_000
#: Bytes of text that a worker encodes at a time.
_SLICE = 8_000_000


def bit_width(vocabulary: int) -> int:
    """The least bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive ``width``-bit numbers, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of what ``pack`` made."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little")
    return bits.reshape(count, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


class PackedWriter:
    """Appends ids to one file, holding one block at most."""

    def __init__(self, uri: str, width: int):
        system, path = fs.FileSystem.from_uri(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self._out = system.open_output_stream(path, compression=None)
        self._out.write(MAGIC)
        self._width, self._held, self._n_held = width, [], 0
        self._offsets, self.count = [len(MAGIC)], 0

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids)
        self._n_held += len(ids)
        self.count += len(ids)
        if self._n_held >= 64 * BLOCK:
            self._flush(self._n_held // BLOCK * BLOCK)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate(self._held) if self._held else np.empty(0, np.uint32)
        for i in range(0, upto, BLOCK):
            data = pack(ids[i : min(i + BLOCK, upto)], self._width)
            self._out.write(data)
            self._offsets.append(self._offsets[-1] + len(data))
        self._held, self._n_held = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._flush(self._n_held)
        self._out.write(np.array(self._offsets, "<u8").tobytes())
        self._out.write(_TRAILER.pack(self.count, self._offsets[-1], self._width, BLOCK, MAGIC))
        self._out.close()


class PackedReader:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self._in = system.open_input_file(path)
        size = self._in.size()
        self.count, at, self._width, self._block, magic = _TRAILER.unpack(self._in.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no packed id file")
        self._offsets = np.frombuffer(self._in.read_at(size - _TRAILER.size - at, at), "<u8")

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count``; reads only the blocks that hold them."""
        if not count:
            return np.empty(0, np.uint32)
        first, last = start // self._block, (start + count - 1) // self._block
        data = self._in.read_at(int(self._offsets[last + 1] - self._offsets[first]), int(self._offsets[first]))
        held, base = [], int(self._offsets[first])
        for b in range(first, last + 1):
            n = min(self._block, self.count - b * self._block)
            held.append(unpack(data[int(self._offsets[b]) - base : int(self._offsets[b + 1]) - base], self._width, n))
        skip = start - first * self._block
        return np.concatenate(held)[skip : skip + count]

    def close(self) -> None:
        self._in.close()


class _Encoder:
    """Encodes batches of texts.

    A byte-level vocabulary splits a text before each space that has no white space beside
    it, whatever stands around, so a text is the sequence of its space-led chunks.  Chunks
    repeat, so each distinct chunk goes to the tokenizer once and the ids of a batch are
    gathered by numpy.  Texts with longer runs of white space are encoded whole, and so are
    those with the string of an added token, which the tokenizer finds before all else; with
    ``special_as_text``, strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False, remembered: int | None = None):
        # a task has one core; threads of the library would each keep memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._limit = remembered
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = special_as_text
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)]
        # an added token's string may stand within a chunk or over several
        self._whole = "|".join([_JOINED_SPACES, *map(re.escape, added)])
        self._tellable = not any(" " in x for x in added)
        self.size = self._tokenizer.get_vocab_size()
        self._leads = np.zeros(self.size, bool)
        for token, i in self._tokenizer.get_vocab().items():
            self._leads[i] = token.startswith("Ġ")
        (self._newline,) = self._each(["\n"])
        self._marks: dict[str, bytes] = {}
        # ids of chunks with a space before them (True) and without: those met lately, and before that
        self._known: dict[bool, tuple[dict[str, bytes], dict[str, bytes]]] = {True: ({}, {}), False: ({}, {})}

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, chunks: list[str], led: bool) -> None:
        """Encode chunks; words many in one text, which the ids that open with a space (or those of line ends) part again."""
        new, lead, gap = self._known[led][0], " " * led, " " if led else "\n"
        words = [c for c in chunks if c.split() == [c]]
        alone = [c for c in chunks if c.split() != [c]]
        for group in (words[i : i + 256] for i in range(0, len(words), 256)):
            (raw,) = self._each([lead + gap.join(group)])
            ids = np.frombuffer(raw, "<u4")
            cuts = (np.flatnonzero(self._leads[ids] if led else ids == np.frombuffer(self._newline, "<u4")[0]) * 4).tolist()
            begins, ends = (cuts, [*cuts[1:], len(raw)]) if led else ([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])
            if len(begins) == len(group):
                new.update((c, raw[i:j]) for c, i, j in zip(group, begins, ends, strict=True))
            else:
                alone += group
        new.update(zip(alone, self._each([lead + c for c in alone]), strict=True))

    def _remember(self, chunks: Iterable[str], led: bool) -> None:
        """Have the ids of chunks in the newer generation."""
        new, old = self._known[led]
        missing, marked = [], []
        for c in chunks:
            if c not in new:
                if (ids := old.get(c)) is not None:
                    new[c] = ids
                elif len(word := c.rstrip(punctuation)) < len(c) and word.isalpha():
                    marked.append((c, word))
                else:
                    missing.append(c)
        if marked:
            self._remember({word for _, word in marked}, led)
        if missing := [c for c in missing if c not in new]:
            self._learn(missing, led)
        # a word with marks behind it is the word's ids and the marks'
        for c, word in marked:
            marks = c[len(word) :]
            if marks not in self._marks:
                if len(self._marks) >= 10_000:
                    self._marks.clear()
                (self._marks[marks],) = self._each([marks])
            new[c] = new[word] + self._marks[marks]

    def _ids_of(self, distinct: list[str], led: bool) -> list[bytes]:
        """The ids of chunks; one with a line's end between two words is made of theirs each time."""
        lines = {}
        for c in distinct:
            if "\n" in c and len(words := c.split()) == 2 and len(words[0]) + len(words[1]) + 1 == len(c):
                lines[c] = words
        self._remember([c for c in distinct if c not in lines] if lines else distinct, led)
        self._remember({left for left, _ in lines.values()}, led)
        self._remember({right for _, right in lines.values()}, False)
        known, first = self._known[led][0], self._known[False][0]
        return [known[lines[c][0]] + self._newline + first[lines[c][1]] if c in lines else known[c] for c in distinct]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; there are no nulls."""
        for led, (new, _) in self._known.items():
            if len(new) > (self._limit or _REMEMBERED):  # what isn't met until the next time is forgotten
                self._known[led] = {}, new
        whole = pc.match_substring_regex(texts, self._whole).to_numpy(zero_copy_only=False) | (not self._tellable)
        out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        at = np.flatnonzero(whole)
        for i, raw in zip(at, self._each(texts.take(pa.array(at)).to_pylist()) if len(at) else (), strict=True):
            out[i] = np.frombuffer(raw, "<u4")
        at = np.flatnonzero(~whole)
        if not len(at):
            return out
        split = pc.split_pattern(texts.take(pa.array(at)), " ")
        chunks = split.flatten().dictionary_encode()
        begin = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        first = split.flatten().take(pa.array(begin)).dictionary_encode()
        index = chunks.indices.to_numpy().astype(np.int64)
        index[begin] = len(chunks.dictionary) + first.indices.to_numpy()
        used = np.zeros(len(chunks.dictionary) + len(first.dictionary), bool)
        used[index] = True
        words = chunks.dictionary.to_pylist()
        led = [w for w, u in zip(words, used, strict=False) if u]
        ids = [b""] * len(used)
        for i, raw in zip(np.flatnonzero(used[: len(words)]), self._ids_of(led, True), strict=True):
            ids[i] = raw
        ids[len(words) :] = self._ids_of(first.dictionary.to_pylist(), False)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        starts = np.cumsum(sizes) - sizes
        taken = sizes[index]
        ends = np.cumsum(taken)
        gathered = flat[np.repeat(starts[index] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.append((ends - taken)[begin], len(gathered))
        for k, i in enumerate(at):
            out[i] = gathered[bounds[k] : bounds[k + 1]]
        return out


_encoders: dict[tuple[str, bool, int | None], _Encoder] = {}


def _encoder(*settings) -> _Encoder:
    if settings not in _encoders:
        _encoders[settings] = _Encoder(*settings)
    return _encoders[settings]


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = True, remembered: int | None = None, at_once: int = _SLICE
) -> DataFrame:
    """Encode every whole text and write the ids, in ascending id order, to packed files.

    A range partition of the ids becomes one file.  Its name holds a part that no other
    attempt of the task shares, and the index, which Spark commits, names the file of the
    attempt that counted; so lost executors, retries and speculation leave whole results.

    Returns the index: (id, part, file, begin, n_tokens), `begin` within the file.  A null
    text is empty and yields the end id alone; rows with a null id come first; rows with the
    same id stand next to each other in one file, in no promised order; further columns are ignored; an
    empty table gives an empty index.  A worker remembers `remembered` chunks before a new
    generation and encodes ``at_once`` bytes of text; less takes less memory and more time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = _encoder(tokenizer, special_as_text, remembered), None
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        end = np.array([end_id], np.uint32)
        for batch in batches:
            if writer is None:
                writer = PackedWriter(f"{folder}/{name}", bit_width(max(encoder.size, end_id + 1)))
            begins, counts = [], []
            for _, texts in slices(batch.column(1), at_once):
                for ids in encoder.encode(texts):
                    begins.append(writer.count)
                    writer.add(ids)
                    writer.add(end)
                    counts.append(len(ids) + 1)
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * n, pa.int32()), pa.array([name] * n, pa.string()), pa.array(begins, pa.int64()), pa.array(counts, pa.int64())],
                names=["id", "part", "file", "begin", "n_tokens"],
            )
        if writer is not None:
            writer.close()

    schema = "id long, part int, file string, begin long, n_tokens long"
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")
    ordered.mapInArrow(frugal(write), schema).write.parquet(f"{folder}/index")
    return spark.read.schema(schema).parquet(f"{folder}/index")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """Read every document's ids from the files: (id, start, n_tokens, ids_crc32).

    `start` counts the ids of all documents before it over all files; `ids_crc32` is the
    CRC-32 of its ids as little-endian unsigned 32-bit numbers.
    """
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = files.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            ids, files, begins, counts, befores = (batch.column(c).to_pylist() for c in range(5))
            sums = []
            for file, begin, count in zip(files, begins, counts, strict=True):
                if file != name:
                    if reader is not None:
                        reader.close()
                    name, reader = file, PackedReader(f"{folder}/{file}")
                sums.append(zlib.crc32(reader.read(begin, count).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a + b for a, b in zip(befores, begins, strict=True)], pa.int64()), batch.column(3), pa.array(sums, pa.int64())],
                names=["id", "start", "n_tokens", "ids_crc32"],
            )
        if reader is not None:
            reader.close()

    # one row per file, and a file per range partition: far below any broadcast limit
    placed = index.join(F.broadcast(before), "part").select("id", "file", "begin", "n_tokens", "before")
    return placed.mapInArrow(frugal(read), "id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None, special_as_text: bool = True, remembered: int | None = None, at_once: int = _SLICE) -> DataFrame:
    """Write ``docs`` as token files and read them back: (doc_id, start, n_tokens, ids_crc32).

    With `special_as_text`, the strings of special tokens in a text are ordinary text; without
    it, they become those tokens, as the tokenizers library has it unless told otherwise.
    """
    folder = folder or new_path(docs.sparkSession, "token-ids")
    index = write_token_files(docs, tokenizer, folder, end_id, special_as_text=special_as_text, remembered=remembered, at_once=at_once)
    return read_token_files(index, folder).withColumnRenamed("id", "doc_id")


def load_ids(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (or of each row with its id), by random access."""
    found = spark.read.parquet(f"{folder}/index").filter(F.col("id") == doc_id).collect()
    return [PackedReader(f"{folder}/{r.file}").read(r.begin, r.n_tokens) for r in found]
