"""Bounded-space online packing of documents into windows of a fixed number of tokens.

Every partition keeps at most ``open_windows`` windows open. A document longer than a window
fills windows of its own; what is left of it goes to the open window with the least room that
suffices (best fit). Where none has room and no more may be opened, the fullest window is
filled up with the beginning of the piece and emitted, and the rest is placed again; if its
room is less than ``least_piece`` tokens it is emitted as it is. The windows left open at the
end are merged: those of ``fan_in`` partitions are packed once more by the same rule.

Tokens are those of a public tokenizer file, then an end mark. Words between single spaces
are tokenized once and remembered within bounds, since no token reaches across a space that
stands between two other characters.

Defined results: a null text is empty and has the end mark only. Equal rows are packed each.
Documents of one window or less are cut only to fill a window. Without documents there are
no pieces. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.llm import text as tx
from regloom.llm.ship import ship
from regloom.session import scratch_path

SIZE, OPEN_WINDOWS, LEAST_PIECE, FAN_IN = 2048, 32, 8, 64
END_MARK = 1
#: Words remembered by a worker.
REMEMBERED = 1_000_000

PIECES = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s")
#: Marks that the tokenizer's pattern parts from a word of letters before them.
MARKS = ".,!?;:|#$%&*"
#: Fixed value: what stands for a space in byte-level vocabularies.
SPACE_SIGN = "\u0120"
#: Words learned from one string.
LEARNED = 1000


class Encoder:
    """Texts to little-endian 32-bit token ids, with a memory of words."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Tokens of words with a space in front, and of what stands at the beginning or is marks.
        self.known: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        # Which tokens begin with a space, by the sign that byte-level vocabularies have for it.
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[n for token, n in vocabulary.items() if token.startswith(SPACE_SIGN)]] = True

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One for each worker process, so its memory serves later tasks."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    @staticmethod
    def words(text: str) -> list[str]:
        """A text cut at single spaces; where white space meets white space, only at spaces between two other characters."""
        if _WIDE.search(text) or text[:1] == " " or text[-1:] == " ":
            return _CUT.split(text)
        return text.split(" ")

    def _learn(self, memory: dict[str, bytes], words: set[str], before: str) -> None:
        # Not a difference of sets: that would walk through the whole memory.
        new = [w for w in words if w not in memory]
        if before == " ":
            new = self._learn_joined(memory, new)
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            for word, found in zip(some, self.tokenizer.encode_batch_fast([before + w for w in some], add_special_tokens=False)):
                memory[word] = array("I", found.ids).tobytes()

    def _learn_joined(self, memory: dict[str, bytes], words: list[str]) -> list[str]:
        """Learn words from strings in which each stands behind a space; returns those left to learn.

        A token that begins with a space begins a word, and there must be as many as words.
        """
        parts = [words[at : at + LEARNED] for at in range(0, len(words), LEARNED)]
        left = []
        for some, found in zip(parts, self.tokenizer.encode_batch_fast([" " + " ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(some) or starts[0] or any(" " in w for w in some):
                left += some
                continue
            raw, places = ids.tobytes(), [*(starts * 4).tolist(), 4 * len(ids)]
            memory.update((w, raw[a:b]) for w, a, b in zip(some, places, places[1:]))
        return left

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) + len(self.bare) > REMEMBERED:
            self.known.clear()
            self.bare.clear()
        parts = [self.words(t) for t in texts]
        found = [[*map(self.known.get, p)] for p in parts]
        missing, holes = set(), []
        for p, f in zip(parts, found):
            f[0] = b""
            own, at = [], 0
            if None in f:
                while True:
                    try:
                        at = f.index(None, at + 1)
                    except ValueError:
                        break
                    own.append(at)
                missing.update([p[i] for i in own])
            holes.append(own)
        # Letters and the marks behind them are tokens of their own, so they are learned apart.
        split = {}
        for word in missing:
            stem = word.rstrip(MARKS)
            if len(stem) < len(word) and stem.isalpha() and max(stem) < "\u0250":
                split[word] = stem
        self._learn(self.known, (missing - split.keys()) | set(split.values()), " ")
        self._learn(self.bare, {w[len(s) :] for w, s in split.items()} | {p[0] for p in parts}, "")
        for word, stem in split.items():
            self.known[word] = self.known[stem] + self.bare[word[len(stem) :]]
        for p, f, own in zip(parts, found, holes):
            f[0] = self.bare[p[0]]
            for i in own:
                f[i] = self.known[p[i]]
        return list(map(b"".join, found))


tx.MEMORIES["packing"] = Encoder._made.clear


class Windows:
    """The open windows of a partition. A piece is (doc, start, ids, tokens of the document)."""

    def __init__(self, size: int, most: int, least_piece: int):
        self.size, self.most, self.least_piece = size, most, least_piece
        self.open: list[list] = []
        self.room: list[int] = []

    def place(self, piece: tuple) -> Iterator[list]:
        """Windows that are complete once the piece has its place."""
        doc, start, ids, total = piece
        while len(ids) >= 4 * self.size:
            yield [(doc, start, ids[: 4 * self.size], total)]
            start, ids = start + self.size, ids[4 * self.size :]
        while ids:
            n = len(ids) // 4
            fitting = [r for r in self.room if r >= n]
            if fitting:
                at = self.room.index(min(fitting))
                self.open[at].append((doc, start, ids, total))
                self.room[at] -= n
                if not self.room[at]:
                    yield self.close(at)
                return
            if len(self.open) < self.most:
                self.open.append([(doc, start, ids, total)])
                self.room.append(self.size - n)
                return
            at = self.room.index(min(self.room))
            fill = self.room[at]
            if fill >= self.least_piece:
                self.open[at].append((doc, start, ids[: 4 * fill], total))
                start, ids = start + fill, ids[4 * fill :]
            yield self.close(at)

    def close(self, at: int) -> list:
        self.room.pop(at)
        return self.open.pop(at)


def _rows(windows: list[tuple[int | None, list]], ids: bool) -> pa.RecordBatch:
    """Record batch of the pieces of (sequence, window); without a sequence the ids stay."""
    columns: list[list] = [[] for _ in range(8)]
    for sequence, window in windows:
        offset = 0
        for doc, start, data, total in window:
            row = (doc, start, len(data) // 4, data if ids or sequence is None else None, zlib.crc32(data), total, sequence, offset)
            for column, value in zip(columns, row):
                column.append(value)
            offset += len(data) // 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    open_windows: int = OPEN_WINDOWS,
    least_piece: int = LEAST_PIECE,
    fan_in: int = FAN_IN,
    ids: bool = True,
) -> DataFrame:
    """One row for each piece: ``doc_id``, ``start`` and ``length`` in the document's tokens,
    ``ids`` (little-endian 32-bit; null unless asked for), ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset`` there.
    """
    spark = documents.sparkSession
    ship(spark)
    mark = np.array([END_MARK], "<u4").tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, windows = Encoder.of(tokenizer), Windows(size, open_windows, least_piece)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in tx.slices(batch, "text"):
                done = []
                encoded = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                for doc, data in zip(part.column("id").to_pylist(), encoded):
                    data += mark
                    for window in windows.place((doc, 0, data, len(data) // 4)):
                        done.append((number, window))
                        number += 2
                if done:
                    yield _rows(done, ids)
        if windows.open:
            yield _rows([(None, w) for w in windows.open], ids)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list] = {}
        for batch in batches:
            for group, *piece in zip(*(batch.column(c).to_pylist() for c in ("group", "doc_id", "start", "ids", "doc_tokens"))):
                groups.setdefault(group, []).append(tuple(piece))
        for group, pieces in groups.items():
            # Large pieces first, in an order that does not depend on their arrival.
            pieces.sort(key=lambda p: (-len(p[2]), p[0] is not None, p[0] or 0, p[1], p[2]))
            windows, number, done = Windows(size, open_windows, 1), (group << 40) + 1, []
            for piece in pieces:
                for window in windows.place(piece):
                    done.append((number, window))
                    number += 2
            # The last windows fill one another, fullest first.
            rest = sorted(zip(windows.room, windows.open), key=lambda x: x[0])
            last = Windows(size, 1, 1)
            for _, window in rest:
                for piece in window:
                    for full in last.place(piece):
                        done.append((number, full))
                        number += 2
            for window in last.open:
                done.append((number, window))
                number += 2
            yield _rows(done, ids)

    path = scratch_path(spark, "pieces")
    source = documents.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    packed = source.mapInArrow(tx.tidy(first), PIECES).withColumns({"partition": F.spark_partition_id(), "leftover": F.col("sequence_id").isNull()})
    packed.write.partitionBy("leftover").parquet(path)
    stored = spark.read.schema(f"{PIECES}, partition int, leftover boolean").parquet(path)
    names = [c.split()[0] for c in PIECES.split(", ")]
    left = stored.where("leftover").select(F.floor(F.col("partition") / fan_in).cast("bigint").alias("group"), "doc_id", "start", "ids", "doc_tokens")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = left.repartition(parts, "group").mapInArrow(tx.tidy(merge), PIECES)
    return stored.where("not leftover").select(*names).unionByName(merged)
