"""Operator 12: token sequences of a fixed length, packed by best-fit decreasing.

Documents become token ids and an end id; one longer than a window is cut into full windows first, so
only its rest is packed. Pieces are dealt into blocks; a task streams over the sorted pieces of a block,
longest first, and puts each into the open window with the least room that is enough. A segment tree
over room (0 to the window) finds it in logarithmic time. A task holds a block's open windows, nothing else.

Texts are cut before white space that follows another character, where no pre-token of a byte-level BPE
reaches across. The ids of such chunks are kept by the worker, as most stand in many documents; chunks that
are new to it are joined and encoded together, and the bytes that each id stands for tell where the next one begins.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from carespan.llm.common import portions, settle, table
from carespan.llm.token_counts import vocabulary_path

WINDOW = 2048
END_ID = 1
BLOCK_PIECES = 10_000
MAX_TASKS = 16_384
KEPT_CHUNKS = 400_000
KEPT_BYTES = 64
TOGETHER_CHUNKS = 4000
BATCH_BYTES = 4 << 20
# Cut where white space follows a character that no engine takes for white space.
_CHUNK = re.compile(r"[ \t\n\r]*(?:[^ \t\n\r]+(?:(?<!\S)[ \t\n\r]+)?)+|[ \t\n\r]+")
_SPACE_AFTER_SPACE = re.compile(r"\s[ \n]")
_CUT_BEFORE = np.frombuffer(b" \t\n\r", np.uint8)
_ASCII_SPACE = np.frombuffer(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ", np.uint8)


def marked(text: str) -> str:
    """The text (without NUL) with a NUL at each place to cut: before white space that follows another character.

    Where no space or line end follows other white space, which is the rule, each of them is such a place.
    """
    if _SPACE_AFTER_SPACE.search(text):
        return "\0".join(_CHUNK.findall(text))
    return text.replace(" ", "\0 ").replace("\n", "\0\n")


def _binary(parts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """An array of binary values from all their bytes and where each one ends."""
    offsets = np.concatenate((np.zeros(1, np.int64), ends.astype(np.int64)))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(parts)])


def _offsets(array) -> np.ndarray:
    """Where the values of a binary or text array start and the last one ends, in its buffer."""
    return np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, with the chunks seen before kept.

    Chunks and ids are kept in two generations of Arrow arrays: when the younger is full it becomes the
    older, from which a chunk that comes again is taken over.
    """

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.model._resize_cache(0)  # chunks reach it once, so its own store only costs time
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(words.values()) + 1, np.int64)
        for word, number in words.items():  # a character of the vocabulary stands for one byte
            self.bytes_of[number] = len(word)
        nothing = (pa.array([], pa.large_string()), pa.array([], pa.large_binary()))
        self.known, self.older = nothing, nothing

    def _alone(self, texts: list[str]) -> pa.LargeBinaryArray:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return pa.array([np.array(f.ids, "<u4").tobytes() for f in found], pa.large_binary())

    def _together(self, chunks: pa.LargeStringArray) -> list[pa.LargeBinaryArray]:
        """Ids of chunks that may stand one after another: each starts with white space and ends without."""
        found = []
        for at in range(0, len(chunks), TOGETHER_CHUNKS):
            part = chunks.slice(at, TOGETHER_CHUNKS)
            offsets = _offsets(part)
            text = bytes(memoryview(part.buffers()[2])[offsets[0]:offsets[-1]]).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends, reached = offsets[1:] - offsets[0], np.cumsum(self.bytes_of[ids])
            last = np.searchsorted(reached, ends)
            if not np.array_equal(reached[last], ends):
                raise ValueError("a token reaches across chunks")
            found.append(_binary(ids.view(np.uint8), 4 * (last + 1)))
        return found

    def _ids_of(self, chunks: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct chunks, those kept or encoded now."""
        if len(self.known[0]) > KEPT_CHUNKS:
            self.known, self.older = (pa.array([], pa.large_string()), pa.array([], pa.large_binary())), self.known
        at = pc.fill_null(pc.index_in(chunks, self.known[0]), -1).to_numpy().astype(np.int64)
        unknown = chunks.filter(pa.array(at < 0))
        place = pc.index_in(unknown, self.older[0])
        again = pc.is_valid(place)
        new = unknown.filter(pc.invert(again))
        offsets = _offsets(new)
        data = np.frombuffer(new.buffers()[2] or b"", np.uint8)
        filled = np.diff(offsets) > 0
        first, last = np.zeros(len(new), np.uint8), np.zeros(len(new), np.uint8)
        first[filled], last[filled] = data[offsets[:-1][filled]], data[offsets[1:][filled] - 1]
        joinable = np.isin(first, _CUT_BEFORE) & ~np.isin(last, _ASCII_SPACE) & filled
        foreign = np.flatnonzero(joinable & (last > 127))
        joinable[foreign] = [not c[-1].isspace() for c in new.take(pa.array(foreign)).to_pylist()]
        fit = new.filter(pa.array(joinable))
        rest = new.filter(pa.array(~joinable))
        parts = [
            (unknown.filter(again), self.older[1].take(place.filter(again))),
            (rest, self._alone(rest.to_pylist())),
            (fit, pa.concat_arrays([pa.array([], pa.large_binary()), *self._together(fit)])),
        ]
        # what was unknown follows what is known, in the order of the parts
        came = again.to_numpy(zero_copy_only=False)
        kind = np.zeros(len(unknown), np.int64)
        kind[~came] = 1 + joinable
        order = np.empty(len(unknown), np.int64)
        order[np.argsort(kind, kind="stable")] = np.arange(len(unknown))
        at[at < 0] = len(self.known[0]) + order
        every = [pa.concat_arrays([self.known[i], *(p[i] for p in parts)]) for i in (0, 1)]
        found = every[1].take(pa.array(at))
        short = pc.less_equal(pc.binary_length(every[0]), KEPT_BYTES)
        self.known = (every[0].filter(short), every[1].filter(short))
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts. Chunks are cut, told apart and put together again by Arrow."""
        plain = [i for i, t in enumerate(texts) if "\0" not in t]
        found: list[bytes] = [b""] * len(texts)
        if plain:
            cut = pc.split_pattern(pa.array([marked(texts[i]) for i in plain], pa.large_string()), "\0")
            chunks = cut.values.dictionary_encode()
            packed = self._ids_of(chunks.dictionary).take(chunks.indices)
            ends = _offsets(packed)[cut.offsets.to_numpy()]
            whole = memoryview(packed.buffers()[2] or b"")
            for i, start, end in zip(plain, ends[:-1], ends[1:]):
                found[i] = bytes(whole[start:end])
        odd = [i for i, t in enumerate(texts) if "\0" in t]
        for i, own in zip(odd, self._alone([texts[i] for i in odd]).to_pylist()):
            found[i] = own
        return found


_encoders: dict[str | None, Encoder] = {}


def _encoder(path: str | None) -> Encoder:
    """The worker's encoder; it lives as long as the worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_pieces(
    docs: DataFrame, path: str | None = None, keep: tuple = ("doc_id",), window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """The columns `keep` with start, length, ids (binary) and doc_tokens of every piece of every row.

    A document's ids are its text's and `end_id`; its pieces are full windows and the rest. Null and
    empty texts have the end id only. `path` names the tokenizer file, readable on every executor.
    """
    chosen = docs.select(*keep, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("__text"))
    added = _parse_datatype_string("start bigint, length bigint, ids binary, doc_tokens bigint")
    schema = StructType([*(f for f in chosen.schema.fields if f.name != "__text"), *added.fields])
    arrow = to_arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            at = batch.num_columns - 1
            for part in portions(batch, at, BATCH_BYTES):
                rows, starts, lengths, ids, totals = [], [], [], [], []
                for row, found in enumerate(encoder.ids([t.decode() for t in part.column(at).to_pylist()])):
                    whole = found + end
                    total = len(whole) // 4
                    for start in range(0, total, window):
                        piece = whole[4 * start:4 * (start + window)]
                        rows.append(row)
                        starts.append(start)
                        lengths.append(len(piece) // 4)
                        ids.append(piece)
                        totals.append(total)
                taken = part.take(pa.array(rows, pa.int64()))
                columns = [taken.column(i).cast(arrow.field(i).type) for i in range(at)]
                columns += [pa.array(v, arrow.field(at + i).type) for i, v in enumerate((starts, lengths, ids, totals))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return chosen.mapInArrow(run, schema)


class Windows:
    """Open windows of one block by their room: a segment tree that counts them, and their numbers."""

    def __init__(self, window: int):
        self.window = window
        self.leaf = 1 << window.bit_length()  # leaves for a room of 0 to the window
        self.tree = [0] * (2 * self.leaf)
        self.open: dict[int, list[int]] = {}
        self.made = 0

    def _count(self, room: int, change: int) -> None:
        at = self.leaf + room
        while at:
            self.tree[at] += change
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of `length` or more that an open window has."""
        tree, at = self.tree, self.leaf + length
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):  # up, until a right sibling holds some
                at >>= 1
            if at == 1:
                return None
            at += 1
            while at < self.leaf:  # down to the leftmost
                at *= 2
                at += not tree[at]
        return at - self.leaf

    def place(self, length: int) -> tuple[int, int]:
        """Window number and offset of a piece; the latest opened of equally tight windows."""
        room = self.tightest(length)
        if room is None:
            number, room = self.made, self.window
            self.made += 1
        else:
            number = self.open[room].pop()
            self._count(room, -1)
        left = room - length
        if left:
            self.open.setdefault(left, []).append(number)
            self._count(left, 1)
        return number, self.window - room


def _packer(window: int):
    """Windows and offsets of pieces that arrive sorted by block and length, longest first."""

    def run(batches):
        block, windows = None, None
        for batch in batches:
            blocks, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            numbers, offsets = [], []
            for this, length in zip(blocks, lengths):
                if this != block:
                    block, windows = this, Windows(window)
                number, offset = windows.place(length)
                numbers.append((block << 32) + number)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return run


def packed(
    docs: DataFrame, path: str | None = None, keep: tuple = ("doc_id",), window: int = WINDOW, end_id: int = END_ID,
    with_ids: bool = False, block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """The columns `keep` with start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    A block's window number and the block make the sequence_id. Pieces are dealt into blocks by the
    place they were written at, so equal rows spread, too; the number of blocks follows that of pieces, and a
    task packs one block after another.
    `with_ids` carries the ids (binary) along. Null and empty texts have one piece, the end id; repeated rows are
    packed once each; an empty table gives none; other columns are ignored.
    """
    own = [f"__kept_{i}" for i in range(len(keep))]
    made = token_pieces(docs.select(*[F.col(c).alias(o) for c, o in zip(keep, own)], "text"), path, tuple(own), window, end_id)
    rows = settle(made.select(
        "length", *own, "start", F.crc32("ids").alias("ids_crc32"), "doc_tokens", *(["ids"] if with_ids else []),
        F.monotonically_increasing_id().alias("piece"),
    ))
    blocks = max(1, -(-rows.count() // block_pieces))
    dealt = rows.select(F.pmod(F.xxhash64("piece"), F.lit(blocks)).alias("block"), "*")
    dealt = dealt.repartition(min(blocks, MAX_TASKS), "block").sortWithinPartitions("block", F.desc("length"), "piece")
    schema = StructType([*dealt.schema.fields, *_parse_datatype_string("sequence_id bigint, offset bigint").fields])
    placed = dealt.mapInArrow(_packer(window), schema)
    return placed.select(
        *[F.col(o).alias(c) for c, o in zip(keep, own)], "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
        *(["ids"] if with_ids else []),
    )


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per sequence of `packed(..., with_ids=True)`: sequence_id, used, padded_to and ids (binary).

    A sequence is padded to the window, except where its length is a power of two. A sequence has at
    most as many pieces as a window has ids.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"), ordered.alias("pieces"))
    whole = F.aggregate("pieces", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    even = F.bit_count("used") == 1
    return rows.select(
        "sequence_id", "used", F.when(even, F.col("used")).otherwise(F.lit(window).cast("long")).alias("padded_to"),
        whole.alias("ids"),
    )


def op12_packing(spark, sf_dir) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


QUERIES = {"op12_packing": op12_packing}
SQL: dict[str, str] = {}
