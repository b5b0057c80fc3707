"""Benchmark decontamination: one Aho-Corasick automaton over the test items' word windows.

Texts and items are normalised alike: A-Z lowered, words are runs of a-z, 0-9 and
non-ASCII characters, joined by single spaces. A window is ``width`` consecutive
words of an item; an item of fewer words, but not none, is one window. The automaton holds
every window with a space on both sides, so a match starts and ends at words.
Each text is scanned once; matches are mapped back to words and to character
offsets of the original text.

Size of what is broadcast. The windows go out in blocks of about ``block``
characters (a window stands in the block of its hash). One block is the usual case: one scan, no
shuffle, no intermediate table. With more, each block is one more scan over the
texts, and what has been found so far is written to the shared scratch folder in between,
so a task never holds more than one automaton.

Defined cases: a null or wordless text has no words and no hits; an item
without words has no window; items are told apart by their id, so rows that share one are one
item; a null id counts under the empty string. Every row of the documents gives one row,
repeated rows included; a null doc_id stays null. Other columns, whatever their names, are not read. With
an empty benchmark nothing is hit.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import arrow_rows, arrow_schema, documents, drop, quoted, written

WIDTH = 10
BLOCK = 2 << 20
#: byte -> itself lowered if it is part of a word, else a space; lengths stay, so offsets do
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
                   for b in range(256))

FOUND = "doc_id long, body binary, n_words long, runs array<long>, items array<string>"
REPORT = "doc_id long, n_words long, n_hit long, items array<string>, spans array<long>"


def words_of(body: bytes | None) -> list[bytes]:
    return (body or b"").translate(WORD_BYTES).split()


def windows_of(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def item_windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, window): the distinct windows of every item."""
    schema = arrow_schema("item_id string, window binary")

    def run(batches):
        return arrow_rows(((i, w) for batch in batches for i, body in zip(*(c.to_pylist() for c in batch.columns))
                           for w in sorted(windows_of(words_of(body), width))), schema)

    rows = items.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("item_id"),
                        quoted(text_col).cast("string").cast("binary").alias("body"))
    return rows.mapInArrow(run, "item_id string, window binary").distinct()


def blocks_of(windows: DataFrame, block: int) -> Iterator[dict[bytes, list[str]]]:
    """The blocks: window -> ids of its items."""
    total = windows.agg(F.sum(F.length("window") + F.lit(2))).first()[0] or 0
    n = max(1, math.ceil(total / block))
    for k in range(n):
        part = windows if n == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
        held: dict[bytes, list[str]] = {}
        for item, window in part.toLocalIterator():
            held.setdefault(bytes(window), []).append(item)
        yield held


_AUTOMATA: dict[str, tuple] = {}


def automaton(sent) -> tuple:
    """(automaton, words per window, items per window) of a block, built once in a worker process."""
    key, block_of = sent.value
    if key not in _AUTOMATA:
        import ahocorasick

        found, counts, items = ahocorasick.Automaton(), [], []
        for k, (window, ids) in enumerate(sorted(block_of.items())):
            found.add_word(f" {window.decode('latin-1')} ", k)
            counts.append(window.count(b" ") + 1)
            items.append(ids)
        if counts:
            found.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = found, counts, items
    return _AUTOMATA[key]


def merged(runs: list[tuple[int, int]]) -> list[int]:
    """Word ranges (first, past the last) as a flat list, overlapping and touching ones joined."""
    out: list[int] = []
    for a, b in sorted(runs):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def scan(body: bytes | None, found, counts, items) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of a text, word ranges of the windows that occur in it, and their items."""
    words = words_of(body)
    if not words or not counts:
        return len(words), [], set()
    hits = list(found.iter(f" {b' '.join(words).decode('latin-1')} "))  # Latin-1: one character a byte
    if not hits:
        return len(words), [], set()
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # where the space behind a word stands
    last = np.searchsorted(ends, [e for e, _ in hits]) + 1
    runs = [(int(b) - counts[k], int(b)) for b, (_, k) in zip(last, hits)]
    return len(words), runs, {i for k in {k for _, k in hits} for i in items[k]}


def offsets(body: bytes, runs: list[int]) -> list[int]:
    """Character offsets (start, end) in the original text of word ranges."""
    inside = np.concatenate([[False], np.frombuffer(body.translate(WORD_BYTES), np.uint8) != 0x20, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    at = np.array([starts[r] if k % 2 == 0 else ends[r - 1] for k, r in enumerate(runs)])
    lead = np.frombuffer(body, np.uint8) & 0xC0 != 0x80  # a character's first byte
    chars = np.concatenate([[0], np.cumsum(lead)])
    return chars[at].tolist()


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH, block: int = BLOCK, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, spans.

    ``items``: ids of the test items of which a window occurs, in string order. ``spans``:
    the hit passages as character offsets of the original text, flat (start, end, start, end, ...).
    """
    spark = docs.sparkSession
    found_schema, report_schema = arrow_schema(FOUND), arrow_schema(REPORT)

    def first(rows_of):
        for doc_id, body in rows_of:
            yield doc_id, body, [], set()

    def later(rows_of):
        for doc_id, body, _, runs, ids in rows_of:
            yield doc_id, body, list(zip(runs[::2], runs[1::2])), set(ids)

    def pass_over(sent, before, last: bool):
        def run(batches):
            tables = automaton(sent)

            def out():
                for batch in batches:
                    for doc_id, body, runs, ids in before(zip(*(c.to_pylist() for c in batch.columns))):
                        n, more, which = scan(body, *tables)
                        runs, ids = merged(runs + more), sorted(ids | which)
                        if not last:
                            yield doc_id, body, n, runs, ids
                        else:
                            yield (doc_id, n, sum(runs[1::2]) - sum(runs[::2]), ids,
                                   offsets(body, runs) if runs else [])

            return arrow_rows(out(), report_schema if last else found_schema, heavy=None if last else 1)

        return run

    state = docs.select(quoted(id_col).cast("long").alias("doc_id"),
                        quoted(text_col).cast("string").cast("binary").alias("body"))
    before, path, held = first, None, None
    for block_of in blocks_of(item_windows(items, width, item_col, item_text_col), block):
        if held is not None:
            state, new = written(state.mapInArrow(pass_over(held, before, False), FOUND), "decontaminate")
            held.unpersist()
            if path:
                drop(spark, path)
            before, path = later, new
        held = spark.sparkContext.broadcast((uuid.uuid4().hex, block_of))
    return state.mapInArrow(pass_over(held, before, True), REPORT)


def clean_text(body: str | None, spans: list[int]) -> str | None:
    """The text without its hit passages, a space where each one stood."""
    if not body or not spans:
        return body
    cuts = [0, *spans, len(body)]
    return " ".join(body[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def op13_decontamination(spark, sf_dir: str) -> DataFrame:
    report = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return report.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                         (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH low AS (
  SELECT row_number() OVER () AS row, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
doc AS (SELECT row, doc_id, regexp_extract_all(body, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT k FROM win),
pos AS (SELECT row, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
hit AS (
  SELECT pos.row, pos.i, win.k, win.item_id
  FROM pos CROSS JOIN size JOIN win ON win.k = size.k AND win.p = array_to_string(pos.w[pos.i:pos.i + size.k - 1], ' ')
  WHERE pos.i + size.k - 1 <= len(pos.w)),
covered AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + k)) AS j FROM hit) GROUP BY row),
named AS (SELECT row, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT row, item_id FROM hit) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""
