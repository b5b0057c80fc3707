"""Exact dedup: Patricia-trie owners of equal texts.

Texts are equal when identical after lower-casing A-Z. Three steps:

1. Every task inserts its full byte strings into a compressed radix trie whose
   terminal nodes hold the group's owner, its size and the salts of its rows.
   When the trie holds more than ``budget`` bytes, the largest subtrees are
   spilled: their terminals leave as partial rows into the shuffle (which
   survives a lost executor, unlike a file beside the task). A text that a
   third of all rows share leaves each task about once.
2. Partial rows are dealt by (length, content hash) and sorted by it. The
   owners' trie of one (length, hash) takes the full strings, so that strings
   that merely collide stay apart; it closes when the next key begins.
3. Rows look up their owner by (SHA-256, salt), see ``common``. Rows alike in
   every column are counted per batch and spread by batch, so that a third of the
   table may be one row (``digests``).

Defined results: null text counts as empty; null doc_id loses against any
id; rows equal in doc_id are ranked by the hash of all their columns; of rows
alike in every column one is kept; an empty table gives an empty result;
other columns of ``docs`` serve only to tell rows apart.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm.common import SALTS, arrow_rows, arrow_schema, batch_of, quoted, row_hash, salt_of

NODE_BYTES = 400  # rough cost of a node besides its label
PARTIAL = ("length long, content_hash long, sha binary, body binary, owner long, owner_hash long, "
           "n long, mask long")
DIGESTS = "doc_id long, row_hash long, salt int, sha binary, n int, head boolean"
OWNERS = "sha binary, salt int, keep_id long, keep_hash long, group_size long"
LABEL, CHILDREN, VALUE = 0, 1, 2


def shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``, by bisection."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Compressed radix trie over byte strings; a node is [label, children by first byte, value]."""

    def __init__(self):
        self.root = [b"", {}, None]
        self.held: dict[int | None, int] = {}  # bytes below each child of the root; None: the empty string

    def add(self, key: bytes, value: list, merge) -> None:
        node, at, first = self.root, 0, key[0] if key else None
        while at < len(key):
            child = node[CHILDREN].get(key[at])
            if child is None:
                node[CHILDREN][key[at]] = child = [key[at:], {}, None]
                self.held[first] = self.held.get(first, 0) + len(key) - at + NODE_BYTES
            elif not key.startswith(child[LABEL], at):
                k = shared(child[LABEL], key, at)
                fork = [child[LABEL][:k], {child[LABEL][k]: child}, None]
                child[LABEL] = child[LABEL][k:]
                node[CHILDREN][key[at]] = child = fork
                self.held[first] += NODE_BYTES
            node, at = child, at + len(child[LABEL])
        node[VALUE] = value if node[VALUE] is None else merge(node[VALUE], value)

    def spill(self, down_to: int = 0) -> Iterator[tuple[bytes, list]]:
        """Remove the largest subtrees until at most ``down_to`` bytes are held; give their strings."""
        if self.root[VALUE] is not None:
            yield b"", self.root[VALUE]
            self.root[VALUE] = None
        while self.held and sum(self.held.values()) > down_to or not down_to and self.held:
            first = max(self.held, key=self.held.get)
            del self.held[first]
            todo = [(b"", self.root[CHILDREN].pop(first))]
            while todo:
                before, node = todo.pop()
                key = before + node[LABEL]
                if node[VALUE] is not None:
                    yield key, node[VALUE]
                todo.extend((key, child) for child in node[CHILDREN].values())


def merger(keep: str):
    """Terminal values are [owner, owner's row hash, size, salt mask, SHA-256 or None]."""
    sign = 1 if keep == "largest" else -1
    rank = lambda v: (v[0] is not None, sign * (v[0] or 0), sign * v[1])

    def merge(a: list, b: list) -> list:
        best = a if rank(a) >= rank(b) else b
        return [best[0], best[1], a[2] + b[2], a[3] | b[3], a[4]]

    return merge


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def partial_owners(keep: str, budget: int, content_hash):
    schema, merge = arrow_schema(PARTIAL), merger(keep)

    def rows(batches):
        trie = RadixTrie()
        leave = lambda to: ((len(k), signed(content_hash(k)), hashlib.sha256(k).digest(), k, *v[:3], signed(v[3]))
                            for k, v in trie.spill(to))
        for batch in batches:
            for doc_id, tie, salt, text in zip(*(c.to_pylist() for c in batch.columns)):
                trie.add((text or b"").lower(), [doc_id, tie, 1, 1 << salt, None], merge)
                if sum(trie.held.values()) > budget:
                    yield from leave(budget // 2)
        yield from leave(0)

    return lambda batches: arrow_rows(rows(batches), schema, heavy=3)


def merged_owners(keep: str):
    schema, merge = arrow_schema(OWNERS), merger(keep)

    def close(trie):
        for _, (owner, tie, n, mask, sha) in trie.spill():
            for salt in range(SALTS):
                if n >= SALTS or mask >> salt & 1:
                    yield sha, salt, owner, tie, n

    def rows(batches):
        at, trie = None, RadixTrie()
        for batch in batches:
            for length, code, sha, body, owner, tie, n, mask in zip(*(c.to_pylist() for c in batch.columns)):
                if (length, code) != at:
                    yield from close(trie)
                    at, trie = (length, code), RadixTrie()
                trie.add(body, [owner, tie, n, mask % (1 << 64), sha], merge)
        yield from close(trie)

    return lambda batches: arrow_rows(rows(batches), schema)


def digests(batches):
    """Rows alike in every column are counted per batch before they are shuffled. Where a batch holds ``SALTS`` of them or
    more, one stays at the row's own salt as ``head`` and the others go to a salt of the batch's: their group has
    ``SALTS`` rows at least, so its owner stands at every salt."""
    schema, task = arrow_schema(DIGESTS), TaskContext.get()
    at = task.partitionId() if task else 0
    for batch in batches:
        alike: Counter = Counter()
        for doc_id, row_hash, salt, body in zip(*(c.to_pylist() for c in batch.columns)):
            alike[doc_id, row_hash, salt, hashlib.sha256((body or b"").lower()).digest()] += 1
        rows = []
        for row, n in alike.items():
            rows.append((*row, n if n < SALTS else 1, True))
            if n >= SALTS:
                rows.append((*row[:2], at % SALTS, row[3], n - 1, False))
        at += 1
        if rows:
            yield batch_of(rows, schema)


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
                budget: int = 64 << 20, content_hash=xxhash.xxh64_intdigest) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_hash, keep_id, group_size, kept, text_sha256.

    ``keep``: whether the smallest or the largest doc_id owns a group.
    """
    named = docs.select(quoted(id_col).cast("long").alias("doc_id"), row_hash(docs).alias("row_hash"),
                        quoted(text_col).cast("string").cast("binary").alias("body"))
    rows = named.select("doc_id", "row_hash", salt_of(F.col("doc_id"), F.col("row_hash")).alias("salt"), "body")
    partial = rows.mapInArrow(partial_owners(keep, budget, content_hash), PARTIAL)
    owners = (partial.repartition("length", "content_hash").sortWithinPartitions("length", "content_hash")
              .mapInArrow(merged_owners(keep), OWNERS))
    looked = rows.mapInArrow(digests, DIGESTS).join(owners, ["sha", "salt"])
    # heads of rows alike in every column share sha and salt, one a batch: numbered without a further exchange
    same = Window.partitionBy("sha", "salt", "doc_id", "row_hash").orderBy(F.desc("head"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row_hash") == F.col("keep_hash"))
    first = F.col("head") & (F.row_number().over(same) == 1)
    copies = F.explode(F.sequence(F.lit(1), F.col("n")))  # at most the rows of a batch
    return looked.withColumn("first", first).withColumn("copy", copies).select(
        "doc_id", "keep_id", "group_size", (kept & F.col("first") & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "row_hash")


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs, keep="largest").drop("row_hash")


ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM t
"""
