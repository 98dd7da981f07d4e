"""Operator 3: bounded-space online best-fit packing of token sequences.

Documents become pieces of at most `room` tokens (only longer ones are cut).  Pieces are dealt over partitions by a
hash; in each, they arrive one after another and go to the open bin with the least free space that still holds them.
A fixed number of bins is open; they are found through a bitset keyed by free space, and the fullest closes first.
State per task is the open bins alone, so memory doesn't depend on the number of pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from limes.llm.common import arrow_fields, columns, cut, prepare

ROOM = 1024
OPEN_BINS = 1 << 16
#: Tokens that one task packs: about half as many sequences as it may keep open.
TOKENS_PER_TASK = 32 << 20


class ByteBpe:
    """Ids of whole texts under a byte-level BPE given as a rank file; strings of special tokens become their ids."""

    def __init__(self, ranks: str, pattern: str, special: dict[str, int]):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=special)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [self.encoding.encode_to_numpy(t, allowed_special="all").astype("<u4", copy=False).tobytes() for t in texts]


@lru_cache(maxsize=2)
def byte_bpe(ranks: str, pattern: str, special: tuple[tuple[str, int], ...]) -> ByteBpe:
    return ByteBpe(ranks, pattern, dict(special))


def token_pieces(docs: DataFrame, ranks: str, pattern: str, special: dict[str, int], end_id: int = 2, room: int = ROOM) -> DataFrame:
    """Pieces of documents: doc_id, piece (from 0), start, length, ids_le (little-endian unsigned 32 bit).

    A document is its ids, then end_id; a null text counts as empty, so each row has a piece.  Only a document of more than room
    tokens is cut; its first piece takes the odd rest, so that all others are full.  Rows with a null or repeated
    id are packed like any other row.  An empty table gives no pieces.  Other columns are left out.
    """
    given = tuple(sorted(special.items()))
    kinds = arrow_fields("doc_id long, piece int, start long, length long, ids_le binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            bpe = byte_bpe(ranks, pattern, given)
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += end
                n = len(ids) // 4
                edges = [0, *range(n % room or room, n + 1, room)] if n > room else [0, n]
                out += [(doc, k, a, b - a, ids[4 * a : 4 * b]) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*out), kinds)] if out else [pa.array([], kind) for _, kind in kinds], [c for c, _ in kinds])

    prepare(docs.sparkSession)
    return columns(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_le binary")


class OpenBins:
    """At most `limit` open bins of `room` tokens; bit f of `bits` says that a bin with f tokens of free space is open."""

    def __init__(self, room: int, limit: int):
        self.room, self.limit, self.count, self.made, self.bits = room, limit, 0, 0, 0
        self.free: list[list[int]] = [[] for _ in range(room + 1)]

    def take(self, space: int) -> int:
        """One of the bins with so much free space."""
        found = self.free[space].pop()
        if not self.free[space]:
            self.bits ^= 1 << space
        return found

    def put(self, size: int) -> tuple[int, int]:
        """The bin for a piece of this size, and the place in it."""
        fitting = self.bits >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            bin_ = self.take(space)
        else:
            space, bin_ = self.room, self.made
            self.made += 1
            self.count += 1
        if rest := space - size:
            if not self.free[rest]:
                self.bits |= 1 << rest
            self.free[rest].append(bin_)
        else:
            self.count -= 1
        if self.count > self.limit:
            self.take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            self.count -= 1
        return bin_, self.room - space


def pack(pieces: DataFrame, room: int = ROOM, open_bins: int = OPEN_BINS, tokens_per_task: int = TOKENS_PER_TASK) -> DataFrame:
    """pieces with sequence_id and offset: each sequence holds at most room tokens, gapless from 0.

    Needs columns doc_id, piece and length (1 to room); all columns stay.  The number of tasks follows the sum of the lengths.
    Large pieces come first in each task, ties by hash and id, so a task that is run again gives the same ids.  Full
    pieces fill sequences of their own.  No pieces, no sequences; repeated rows are packed each.
    """
    prepare(pieces.sparkSession)
    pieces = cut(pieces)
    total = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // tokens_per_task))
    schema = StructType(pieces.schema.fields).add("sequence_id", "long").add("offset", "long")
    at = pieces.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        bins = OpenBins(room, open_bins)
        for batch in batches:
            placed = [bins.put(n) for n in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([first + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], schema.names)

    spread = F.xxhash64("doc_id", "piece")
    dealt = pieces.repartition(tasks, spread).sortWithinPartitions(F.desc("length"), spread, "doc_id", "piece")
    return dealt.mapInArrow(run, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids_le, from placed pieces that carry ids_le."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids_le"))), lambda x: F.hex(x.ids_le))
    return placed.groupBy("sequence_id").agg(F.unhex(F.concat_ws("", parts)).alias("ids_le"))
