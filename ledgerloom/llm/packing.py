"""Best-fit-decreasing packing of token pieces into sequences.

Documents are tokenized whole and cut into full windows; what is left over is packed by
descending length into the open sequence with the least room that still fits, found in a
segment tree over remaining capacity. Pieces are dealt evenly to groups of bounded size,
so a task never holds more than GROUP_PIECES small rows; tokens are not moved.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import is_latin, latin_pattern, table
from ledgerloom.session import written_table

CAPACITY = 1024
GROUP_PIECES = 50_000
#: Matches kept per Python worker, in each of two halves.
REMEMBERED = 3 << 17
_WHOLE = 1 << 20
_CUT_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """Open sequences by remaining capacity: a segment tree over 0..capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)
        self.held: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, window: tuple[int, int]) -> None:
        self.held.setdefault(room, []).append(window)
        node = room + self.size
        while node:
            self.open[node] += 1
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """Least room of at least ``need`` with an open window."""
        node = need + self.size
        if self.open[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None

    def take(self, room: int) -> tuple[int, int]:
        node = room + self.size
        while node:
            self.open[node] -= 1
            node >>= 1
        return self.held[room].pop()


def best_fit(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece (lengths 1 to ``capacity``)."""
    lengths = np.asarray(lengths, np.int64)
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, sequences = OpenWindows(capacity), 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        room = tree.tightest(need)
        if room is None:
            window, used = sequences, 0
            sequences += 1
        else:
            window, used = tree.take(room)
        place[i], offset[i] = window, used
        if capacity - used - need > 0:
            tree.add(capacity - used - need, (window, used + need))
    return place, offset


class _Known(dict):
    """Ids of matches; when full, they become old ones and those still old are forgotten."""

    def __init__(self, plain: Callable[[str], bytes]):
        super().__init__()
        self.plain, self.old = plain, {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece) or self.plain(piece)
        if len(piece) <= 32:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out


class Coder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    Equal to one call of the byte-level tokenizer in ``file``, which merges within the
    matches of ``pattern`` only: the ids of a match are found once and remembered (those of
    the last 2 * REMEMBERED different ones).
    """

    def __init__(self, file: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = False
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut, self.latin = regex.compile(pattern), latin_pattern(pattern)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.known = _Known(self.plain)
        # Letters and digits newer than the interpreter's tables: the two packages may differ.
        self.unsure = frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and regex.match(r"[\p{L}\p{N}]", c))

    def plain(self, text: str) -> bytes:
        ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __call__(self, text: str) -> bytes:
        if self.latin and is_latin(text):
            cut = self.latin
        elif self.unsure.isdisjoint(text):
            cut = self.cut
        else:
            return self.plain(text)
        out = []
        for part in self.apart.split(text) if any(t in text for t in self.added) else (text,):
            if part in self.added:
                out.append(self.added[part])
            elif len(part) <= _WHOLE:
                out += map(self.known.__getitem__, cut.findall(part))
            else:
                out += (self.known[m[0]] for m in cut.finditer(part))
        return b"".join(out)


@functools.cache
def coder(tokenizer: str) -> Coder:
    return Coder(public_tokenizers.path(tokenizer), public_tokenizers.PATTERN)


def cut_text(text: Column, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> Column:
    """Pieces of a text's ids and the end id: array of (start, length, ids_crc32, doc_tokens).

    ``tokenizer`` names the file of a byte-level public tokenizer. Null text is empty: one
    piece with the end id alone.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = coder(tokenizer)
        for batch in batches:
            rows = []
            for text in batch:
                ids = encode(text.as_py() or "") + end
                size = len(ids) // 4
                rows.append([(at, min(capacity, size - at), zlib.crc32(ids[4 * at : 4 * (at + capacity)]), size) for at in range(0, size, capacity)])
            ends = np.cumsum([0, *map(len, rows)])
            flat = np.array([p for row in rows for p in row], np.int64).reshape(-1, 4)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(4)], ["start", "length", "ids_crc32", "doc_tokens"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)

    return F.arrow_udf(run, "array<struct<start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint>>")(text)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Cut documents: doc_id, start, length, ids_crc32, doc_tokens per piece."""
    return docs.select(F.col("doc_id").cast("long"), F.inline(cut_text(F.col("text"), tokenizer, capacity, end_id)))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; offsets have no gaps.

    A group of pieces fills its own sequences, so at most a few sequences of a group stay
    part empty. Groups are dealt by row position in the written pieces, which no repeated
    key can skew. An empty table gives no rows; repeated rows are packed each, rows with a
    null doc_id too, and ids are carried untouched; other columns are ignored.
    """
    cut = written_table(pieces(docs, tokenizer, capacity), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("part", F.monotonically_increasing_id() % groups)

    def fill(part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        place, offset = best_fit(part["length"].to_numpy(), capacity)
        sequence = part["part"].to_numpy() * (1 << 32) + place
        return part.drop_columns("part").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("part").applyInArrow(fill, f"{_CUT_SCHEMA}, sequence_id long, offset long")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), "byte_bpe_50k.json")
