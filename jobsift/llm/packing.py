"""Packing: sum-of-squares online packing of documents into token windows.

A window has ``size`` tokens. A level array counts the partially filled
windows at every fill level; a document's remainder goes to the level where
placing it makes the sum of the squared counts smallest (a new window is level
0; of equal choices the fullest). Whole windows of a long document are cut
off first. Each task packs its own rows as they stream by, so the work has no
shuffle and its memory is the open windows.

More than ``most_open`` open windows, and those left at the end, are closed by
re-cutting: their pieces are laid end to end and cut at window ends, so that
all but one window become full. The last window of a task is cut into
power-of-two sequences, which need no padding.

Defined results: null text counts as empty (its only id is ``end_id``); null
or repeated doc_ids are kept, each row is packed once; an empty table gives no
pieces; other columns are not read. Sequence ids are the partition's number
times 2^32 plus a count: stable as long as the rows' partitions are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import TokenIds, arrow_rows, arrow_schema, quoted

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long")


class SumOfSquares:
    """Level array of partially filled windows; a piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int, most_open: int = 1024):
        self.size, self.most_open = size, most_open
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(size + 1)]
        self.n_open = 0

    def level_for(self, n: int) -> int:
        """The level whose choice gives the least sum of squared counts."""
        here = self.count[:self.size - n + 1]
        cost = 2 * (self.count[n:] - here) + 2
        cost[here == 0] = np.iinfo(np.int64).max
        cost[-1] = 1 - 2 * here[-1] if here[-1] else np.iinfo(np.int64).max  # fills the window: one square less
        cost[0] = 2 * self.count[n] + 1
        return len(cost) - 1 - int(cost[::-1].argmin())

    def place(self, piece: tuple) -> Iterator[list[tuple]]:
        """Give the windows that are full or closed once ``piece`` (shorter than a window) is placed."""
        n = len(piece[2])
        level = self.level_for(n)
        window = [] if level == 0 else self.open[level].pop()
        window.append(piece)
        if level:
            self.count[level] -= 1
            self.n_open -= 1
        yield from self._keep(window, level + n)
        if self.n_open > self.most_open:
            yield from self.recut()

    def _keep(self, window: list[tuple], level: int) -> Iterator[list[tuple]]:
        if level == self.size:
            yield window
        else:
            self.count[level] += 1
            self.open[level].append(window)
            self.n_open += 1

    def recut(self) -> Iterator[list[tuple]]:
        """Lay the pieces of all open windows end to end and cut at window ends; keep the rest open."""
        pieces = [p for at in range(self.size, 0, -1) for w in self.open[at] for p in w]
        self.__init__(self.size, self.most_open)
        window, level = [], 0
        for doc_id, start, ids, total in pieces:
            while len(ids):
                cut = min(len(ids), self.size - level)
                window.append((doc_id, start, ids[:cut], total))
                start, ids, level = start + cut, ids[cut:], level + cut
                if level == self.size:
                    yield window
                    window, level = [], 0
        if level:
            yield from self._keep(window, level)

    def close(self) -> Iterator[list[tuple]]:
        """All that is left: full windows, then sequences of powers of two."""
        yield from self.recut()
        for level in np.flatnonzero(self.count):
            for window in self.open[level]:
                left, room, out = int(level), 0, []
                for doc_id, start, ids, total in window:
                    while len(ids):
                        room = room or 1 << (left.bit_length() - 1)
                        cut = min(len(ids), room)
                        out.append((doc_id, start, ids[:cut], total))
                        start, ids, left, room = start + cut, ids[cut:], left - cut, room - cut
                        if not room:
                            yield out
                            out = []


def packed(size: int, end_id: int, tokens):
    schema = arrow_schema(PIECES)

    def sequences(batches, ids_of):
        packer = SumOfSquares(size)
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array([*ids_of(text or ""), end_id], "<u4")
                whole = len(ids) // size * size
                for at in range(0, whole, size):
                    yield [(doc_id, at, ids[at:at + size], len(ids))]
                if whole < len(ids):
                    yield from packer.place((doc_id, whole, ids[whole:].copy() if whole else ids, len(ids)))
        yield from packer.close()

    def run(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32

        def rows():
            for no, window in enumerate(sequences(batches, tokens())):
                offset, fill = 0, sum(len(p[2]) for p in window)
                for doc_id, start, ids, total in window:
                    yield doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, first + no, offset, fill
                    offset += len(ids)

        return arrow_rows(rows(), schema)

    return run


def pack(docs: DataFrame, tokens, size: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of all documents; ``tokens()`` gives, in a task, the function from text to ids."""
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    return rows.mapInArrow(packed(size, end_id, tokens), PIECES)


def byte_bpe(name: str = "byte_bpe_50k"):
    """Loader of the installed byte-level BPE: files are looked up in the task, on its own machine."""
    def load():
        import public_tokenizers as P

        return TokenIds(P.path(f"{name}.json"), P.path(f"{name}.tiktoken"), P.PATTERN)

    return load


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), byte_bpe())


def filling(pieces: DataFrame) -> DataFrame:
    """Sequences, tokens and padding (to the window, none at a power of two)."""
    seq = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, 0).otherwise(2048 - F.col("n"))
    return seq.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(pad).alias("padding"))
