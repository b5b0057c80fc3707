"""Phrase collocations: Apriori levels over double-array tries, scored by their weakest cut.

A-Z are lowered; ``[.,;:!?\\x0A-\\x0D]`` cut a text into pieces, blanks and tabs a piece into
words. Everything is counted per language. A phrase of k words can be frequent only
if its first and its last k-1 words are (Apriori), so the levels go up one word at a time:

1. Words are counted and the frequent ones numbered. Texts are written once as word
   numbers, -1 for a break (piece end, or a word that no frequent phrase can hold).
2. For k = 2, 3, ...: the frequent phrases of up to k-1 words go out as a double-array trie. In
   each task numpy advances the states of all text positions at once, level by
   level. A position whose state accepts and whose next position's state accepts as
   well starts an Apriori-safe candidate. Each level is done in three steps (Park, Chen and Yu's hashing
   and pruning): the texts are cut down to the words of candidates; all candidates are counted by the
   bucket that their words hash to, and the buckets' counts are summed over the tasks; the candidates of
   buckets that reach ``least`` are counted per task, Spark sums the tasks' counts, and those below
   ``least`` go. A phrase is at most as frequent as its bucket, so no frequent one is lost. Only such
   candidates become rows: about the frequent ones, once per task, not every window of frequent parts.
3. Cuts, scores and the dropping of parts of longer phrases are joins of the
   frequent phrases, in exact decimal arithmetic.

The candidates themselves are never broadcast: there are as many as different windows of frequent words,
which grows with the corpus. The tries hold frequent phrases only and go out in blocks of about ``block``
phrases, by hash of the first word, one scan of the numbered texts per block; words are numbered block by block as
well. With several blocks the second half of a candidate is tested only where its first word is
in the same block, which lets more candidates be counted and changes no count. Buckets number about ``SPARE``
candidates' occurrences for each ``least`` (2^``BITS`` at most; then more candidates are counted, none is lost); one bit
each goes out.

Defined cases: a null text is empty; a null language is ``und``; repeated rows count
each; an empty table gives no rows; no other column is read. Long texts are handled whole, about ``CHUNK``
positions at a time, several texts together.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm.common import arrow_rows, arrow_schema, documents, drop, quoted, written

LEAST, LONGEST, TOP = 100, 5, 2000
BLOCK = 1 << 18
CHUNK = 1 << 21
HELD = 1 << 20
SPARE, BITS, SLICES = 8, 29, 1 << 10
#: byte -> itself lowered; line ends and .,;:!? become a line feed, a tab a blank
CLEAN = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b for b in range(256))


def tokens(body: bytes | None) -> list[bytes]:
    """Words in order, a line feed for every piece end."""
    return [w for w in (body or b"").translate(CLEAN).replace(b"\n", b" \n ").split(b" ") if w]


# --- level 1: words ---------------------------------------------------------------

def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of (lang, body), summed per task before the shuffle."""
    schema = arrow_schema("lang string, word binary, n long")

    def run(batches):
        def out():
            held: dict[str, Counter] = {}
            for batch in batches:
                for lang, body in zip(*(c.to_pylist() for c in batch.columns)):
                    counts = held.setdefault(lang, Counter())
                    counts.update(tokens(body))
                    if sum(map(len, held.values())) > HELD:
                        yield from left(held)
                        held = {}
            yield from left(held)

        def left(held):
            return ((lang, w, n) for lang, counts in held.items() for w, n in counts.items() if w != b"\n")

        return arrow_rows(out(), schema)

    return (rows.mapInArrow(run, "lang string, word binary, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def numbered(frequent: DataFrame, n_blocks: int, block: int) -> DataFrame:
    """(lang, word, n, id): ids are unique over all languages; block b's run from b * 2 * block."""
    b = F.pmod(F.xxhash64("lang", "word"), F.lit(n_blocks))
    at = F.row_number().over(Window.partitionBy("b").orderBy("lang", "word"))  # about ``block`` rows
    return frequent.withColumn("b", b).select("lang", "word", "n", "b", (F.col("b") * 2 * block + at - 1).cast("int").alias("id"))


def numbering(sent, last: bool):
    """Rows (lang, body, ids): the numbers of the words that stand in this block are filled in."""
    schema = arrow_schema("lang string, body binary, ids binary")

    def run(batches):
        table = sent.value

        def out():
            for batch in batches:
                for lang, body, ids in zip(*(c.to_pylist() for c in batch.columns)):
                    known = table.get(lang, {})
                    words = tokens(body)
                    now = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
                    if ids:
                        now = np.maximum(now, np.frombuffer(ids, np.int32))
                    if not last:
                        yield lang, body, now.tobytes()
                    elif len(now := runs_of(now)):
                        yield lang, None, now.tobytes()

        return arrow_rows(out(), schema, heavy=2 if last else 1)

    return run


def runs_of(ids: np.ndarray) -> np.ndarray:
    """The runs of two or more numbered words (no other place can hold a phrase), a break behind each."""
    ids = np.append(ids, np.int32(-1))
    pair = (ids[1:] >= 0) & (ids[:-1] >= 0)
    use = np.append(pair, False) | np.append(False, pair)
    return ids[use | np.append(False, use[:-1])]


# --- tries ------------------------------------------------------------------------

class DoubleArray:
    """Trie over word numbers. The state of a word is its slot in ``roots``' order; of a longer
    phrase, its slot in ``check``: from state s word c leads to base[s] + c if check there is s."""

    def __init__(self, phrases: np.ndarray):
        """``phrases``: rows of word numbers, unused places -1; with a phrase all its beginnings are in."""
        self.roots = np.unique(phrases[:, 0]) if len(phrases) else np.zeros(0, np.int64)
        self.letters = np.unique(phrases[:, 1:][phrases[:, 1:] >= 0]) if len(phrases) else np.zeros(0, np.int64)
        n = len(self.roots)
        self.base = np.zeros(n, np.int64)
        self.check = np.full(n, -1, np.int64)  # the roots' slots are taken by no edge
        self.taken, self.free, self.hint = np.ones(n, bool), n, n
        state = np.searchsorted(self.roots, phrases[:, 0])
        for level in range(1, phrases.shape[1]):
            rows = np.flatnonzero(phrases[:, level] >= 0)
            letter = np.searchsorted(self.letters, phrases[rows, level])
            order = np.lexsort([letter, state[rows]])
            rows, letter = rows[order], letter[order]
            edge = np.ones(len(rows), bool)
            edge[1:] = (state[rows][1:] != state[rows][:-1]) | (letter[1:] != letter[:-1])
            at = np.flatnonzero(edge)
            self.place(state[rows[at]], letter[at])
            state[rows] = self.base[state[rows]] + letter

    def place(self, parents: np.ndarray, letters: np.ndarray) -> None:
        """Give each parent a base so that its edges meet free slots, the widest parents first."""
        first = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]])) if len(parents) else np.zeros(0, int)
        sizes = np.diff(np.concatenate([first, [len(parents)]])).astype(int)
        for k in np.argsort(-sizes, kind="stable"):
            parent, own = parents[first[k]], letters[first[k]:first[k] + sizes[k]]
            b = (self.free if sizes[k] == 1 else max(self.free, self.hint)) - int(own[0])
            while True:
                self.grow(b + int(own[-1]) + 1)
                if not self.taken[b + own].any():
                    break
                b += max(1, int(sizes[k]) // 4)
            if sizes[k] > 1:
                self.hint = b + int(own[0])
            self.base[parent] = b
            self.check[b + own] = parent
            self.taken[b + own] = True
            while self.free < len(self.taken) and self.taken[self.free]:
                self.free += 1

    def grow(self, size: int) -> None:
        if size > len(self.taken):
            more = max(size, 2 * len(self.taken)) - len(self.taken)
            self.taken = np.concatenate([self.taken, np.zeros(more, bool)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def start(self, ids: np.ndarray) -> np.ndarray:
        """State of each position after its own word, -1 where none."""
        if not len(self.roots):
            return np.full(len(ids), -1, np.int64)
        at = np.minimum(np.searchsorted(self.roots, ids), len(self.roots) - 1)
        return np.where(self.roots[at] == ids, at, -1)

    def codes(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.letters):
            return np.full(len(ids), -1, np.int64)
        at = np.minimum(np.searchsorted(self.letters, ids), len(self.letters) - 1)
        return np.where(self.letters[at] == ids, at, -1)

    def advance(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next state of every position that has one."""
        to = self.base[states] + codes
        ok = (states >= 0) & (codes >= 0) & (to >= 0) & (to < len(self.check))
        to = np.where(ok, to, 0)
        return np.where(ok & (self.check[to] == states), to, -1)


def windows(trie: DoubleArray, ids: np.ndarray, k: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the Apriori-safe candidates of k words, and a key for each candidate's words."""
    state, code = trie.start(ids), trie.codes(ids)
    for level in range(1, k - 1):
        state = trie.advance(state[:len(ids) - level], code[level:])
    first, second = state[:-1], state[1:]
    if whole:
        at = np.flatnonzero((first >= 0) & (second >= 0))
        return at, first[at] * len(trie.check) + second[at]
    here = trie.start(ids[1:len(first) + 1]) >= 0  # the second half is known only where its first word is in this block
    at = np.flatnonzero((first >= 0) & (ids[k - 1:] >= 0) & ((second >= 0) | ~here))
    return at, first[at] << 31 | ids[at + k - 1]


def shards(batches, k: int):
    """The numbered texts of a task, about ``CHUNK`` positions at a time, where they can hold ``k`` words."""
    held, size = [], 0
    for batch in batches:
        for ids in batch.column(0).to_pylist():
            held.append(np.frombuffer(ids, np.int32))
            size += len(held[-1])
            if size >= CHUNK:
                yield np.concatenate(held).astype(np.int64)  # a break ends every text
                held, size = [], 0
    if size >= k:
        yield np.concatenate(held).astype(np.int64)


def trimmed(sent, k: int, whole: bool):
    """Rows (ids): the runs of words that stand in a candidate, a break behind each."""
    schema = arrow_schema("ids binary")

    def run(batches):
        def out():
            for ids in shards(batches, k):
                at, _ = windows(sent.value, ids, k, whole)
                edges = np.zeros(len(ids) + 1, np.int8)
                edges[at] += 1
                edges[at + k] -= 1
                use = np.cumsum(edges[:-1], dtype=np.int32) > 0
                left = np.where(use, ids, -1)[use | np.append(False, use[:-1])]
                if len(left):
                    yield (left.astype(np.int32).tobytes(),)

        return arrow_rows(out(), schema, heavy=0)

    return run


def buckets(ids: np.ndarray, at: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The bucket, one of 2^``bits``, of the ``k`` words at each position."""
    h = np.zeros(len(at), np.uint64)
    for i in range(k):
        h = (h ^ ids[at + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype(np.int64)


def bucketed(sent, k: int, whole: bool, bits: int, least: int):
    """Rows (slice, at, n): places within the slice of the buckets met in a shard, and their counts up to ``least``."""
    schema = arrow_schema("slice int, at binary, n binary")
    width = (1 << bits) // SLICES
    places, counts = np.min_scalar_type(width - 1), np.min_scalar_type(least)

    def run(batches):
        def out():
            for ids in shards(batches, k):
                at, _ = windows(sent.value, ids, k, whole)
                met, n = np.unique(buckets(ids, at, k, bits), return_counts=True)
                place, n = (met % width).astype(places), np.minimum(n, least).astype(counts)
                edges = np.searchsorted(met, np.arange(SLICES + 1) * width)
                for i in np.flatnonzero(np.diff(edges)):
                    a, b = edges[i:i + 2]
                    yield int(i), place[a:b].tobytes(), n[a:b].tobytes()

        return arrow_rows(out(), schema, heavy=1)

    return run


def full_slices(bits: int, least: int):
    """Rows (slice, full) of rows (slice, at, n) in slice order: a bit for each bucket, set where its counts reach ``least``."""
    schema = arrow_schema("slice int, full binary")
    width = (1 << bits) // SLICES
    places, counts = np.min_scalar_type(width - 1), np.min_scalar_type(least)

    def run(batches):
        def out():
            now, total = None, np.zeros(width, np.int64)
            for batch in batches:
                for i, at, n in zip(*batch.columns):
                    if i.as_py() != now:
                        if now is not None and (total >= least).any():
                            yield now, np.packbits(total >= least).tobytes()
                        now, total = i.as_py(), np.zeros(width, np.int64)
                    total[np.frombuffer(at.as_buffer(), places)] += np.frombuffer(n.as_buffer(), counts)
            if now is not None and (total >= least).any():
                yield now, np.packbits(total >= least).tobytes()

        return arrow_rows(out(), schema, heavy=1)

    return run


def full_buckets(texts: DataFrame, sent, k: int, whole: bool, bits: int, least: int) -> np.ndarray:
    """A bit for each of the 2^``bits`` buckets: whether all its candidates together reach ``least``."""
    rows = texts.mapInArrow(bucketed(sent, k, whole, bits, least), "slice int, at binary, n binary")
    rows = rows.repartition("slice").sortWithinPartitions("slice")
    full = np.zeros((SLICES, (1 << bits) // SLICES // 8), np.uint8)
    for i, line in rows.mapInArrow(full_slices(bits, least), "slice int, full binary").collect():  # 2^(bits - 3) bytes
        full[i] = np.frombuffer(line, np.uint8)
    return full.reshape(-1)


def summed(parts: list[tuple]) -> list[tuple]:
    """One (keys, words, n) of several, each key once."""
    keys, words, n = (np.concatenate(c) for c in zip(*parts))
    keys, shown, number = np.unique(keys, return_index=True, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, number, n)
    return [(keys, words[shown], total)]


def counted(sent, full, k: int, whole: bool, bits: int):
    """Rows (w1, ..., wk, n): the block's candidates in full buckets with their counts in this task's texts."""
    names = ", ".join(f"w{i} int" for i in range(1, k + 1)) + ", n long"
    schema = arrow_schema(names)

    def run(batches):
        trie, bitmap = sent.value, full.value

        def parts():
            held = []
            for ids in shards(batches, k):
                at, key = windows(trie, ids, k, whole)
                b = buckets(ids, at, k, bits)
                use = bitmap[b >> 3] >> (7 - (b & 7)).astype(np.uint8) & 1 > 0
                at, key = at[use], key[use]
                key, shown, n = np.unique(key, return_index=True, return_counts=True)
                words = ids[at[shown][:, None] + np.arange(k)].astype(np.int32)
                held.append((key, words, n))
                if sum(len(p[0]) for p in held) > HELD:
                    held = summed(held)
                    if len(held[0][0]) > HELD // 2:
                        yield held[0]
                        held = []
            if held:
                yield summed(held)[0]

        for _, words, n in parts():
            columns = [pa.array(words[:, i]) for i in range(k)] + [pa.array(n.astype(np.int64))]
            yield from pa.Table.from_arrays(columns, schema=schema).to_batches(max_chunksize=1 << 16)

    return run, names


def frequent_phrases(texts: DataFrame, words: DataFrame, least: int, longest: int, block: int) -> DataFrame:
    """(ids array<int>, n) of the frequent phrases of 2 to ``longest`` words; ``texts``: (ids), ``words``: (id, ...)."""
    spark, left = texts.sparkSession, None
    tasks = 2 * spark.sparkContext.defaultParallelism
    levels = [words.select(F.col("id").alias("w1"), "n")]
    for k in range(2, longest + 1):
        names, before, found = [f"w{i}" for i in range(1, k + 1)], levels[-1], []
        size, load = before.agg(F.count("*"), F.sum("n")).first()  # a candidate starts with one of these
        blocks = math.ceil(size / block)
        whole = blocks == 1
        for b in range(blocks):
            part = before.where(F.pmod(F.xxhash64("w1"), F.lit(blocks)) == b).select(*names[:-1])
            table = np.array([tuple(r) for r in part.toLocalIterator()], np.int64).reshape(-1, k - 1)  # about ``block`` rows
            if not len(table):
                continue
            sent = spark.sparkContext.broadcast(DoubleArray(table[np.lexsort(table.T[::-1])]))
            here, path = texts, None
            if k > 2 or not whole:
                here, path = written(texts.mapInArrow(trimmed(sent, k, whole), "ids binary"), f"trimmed-{k}")
            bits = min(BITS, max(16, math.ceil(math.log2(SPARE * load / blocks / least))))
            full = spark.sparkContext.broadcast(full_buckets(here, sent, k, whole, bits, least))
            run, schema = counted(sent, full, k, whole, bits)
            # A frequent phrase is a row of nearly every task: a fixed number of tasks, not one for each split of a growing corpus.
            level, _ = written(here.coalesce(tasks).mapInArrow(run, schema).groupBy(*names)
                               .agg(F.sum("n").alias("n")).where(F.col("n") >= least), f"phrases-{k}")
            sent.unpersist()
            full.unpersist()
            found.append(level)
            old = path
            if path and whole:  # longer candidates stand in these texts too
                texts, old, left = here, left, path
            if old:
                drop(spark, old)
        if not found:
            break
        levels.append(reduce(DataFrame.unionByName, found))
    if left:
        drop(spark, left)
    out = spark.createDataFrame([], "ids array<int>, n bigint")
    for k, level in enumerate(levels[1:], 2):
        out = out.unionByName(level.select(F.array(*[f"w{i}" for i in range(1, k + 1)]).alias("ids"), "n"))
    return out


# --- scores -----------------------------------------------------------------------

def scored(words: DataFrame, phrases: DataFrame, totals: DataFrame, cover: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that stand.

    ``words``: (lang, word, n) frequent words, ``phrases``: (lang, phrase, a) candidates, ``totals``:
    (lang, n). The cut with the lowest score counts, of equal ones the first. A candidate goes if
    a longer one holds it and has ``cover`` percent of its count or more.
    """
    counts = words.select("lang", F.col("word").alias("part"), F.col("n").alias("f")).unionByName(
        phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    listed = phrases.withColumn("ws", F.split("phrase", " "))
    size = F.size("ws")

    def joined(start, length):
        return F.array_join(F.slice("ws", start, length), " ")

    cuts = listed.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = (cuts.join(counts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(counts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
            .join(totals, "lang"))
    wide = [F.col(c).cast("decimal(38,0)").alias(c) for c in ("a", "n", "l", "r")]
    cuts = cuts.select("lang", "phrase", "k", *wide).withColumn(
        "score", F.expr("(cast(1000 as decimal(38,0)) * a * n) div (l * r)"))
    best = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("m"))
    inside = listed.where(size > 2).withColumn("m", F.explode(F.sequence(F.lit(2), size - 1)))
    inside = inside.withColumn("i", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)))
    inside = (inside.select("lang", joined(F.col("i"), F.col("m")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    return (best.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(38,0)") < cover * F.col("m.a")))
            .select("lang", "phrase", *[F.col(f"m.{c}").cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, cover: int = 100, block: int = BLOCK,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, a, l, r, n, score): the candidates of every language that no longer one replaces."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       quoted(text_col).cast("string").cast("binary").alias("body"))
    counts, _ = written(word_counts(rows), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") >= least)
    n_blocks = max(1, math.ceil(often.count() / block))
    words, _ = written(numbered(often, n_blocks, block), "numbers")

    texts, path = rows.withColumn("ids", F.lit(None).cast("binary")), None
    for b in range(n_blocks):
        table: dict[str, dict[bytes, int]] = {}
        for lang, word, at in words.where(F.col("b") == b).select("lang", "word", "id").toLocalIterator():  # about ``block``
            table.setdefault(lang, {})[bytes(word)] = at
        sent, last = spark.sparkContext.broadcast(table), b == n_blocks - 1
        step = texts.mapInArrow(numbering(sent, last), "lang string, body binary, ids binary")
        texts, new = written(step.select("ids") if last else step, "numbered")
        sent.unpersist()
        if path:
            drop(spark, path)
        path = new

    found = frequent_phrases(texts, words, least, longest, block)
    drop(spark, path)  # the levels are written; nothing reads the numbered texts again
    spelled = (found.withColumn("key", F.col("ids")).select("key", "n", F.posexplode("ids").alias("i", "id"))
               .join(words.select("id", "lang", F.col("word").cast("string").alias("word")), "id")
               .groupBy("key").agg(F.max("n").alias("a"), F.max("lang").alias("lang"),
                                   F.array_sort(F.collect_list(F.struct("i", "word"))).alias("ws")))  # at most ``longest``
    phrases, _ = written(spelled.select("lang", F.array_join(F.transform("ws", lambda x: x["word"]), " ").alias("phrase"), "a"),
                         "phrases")
    return scored(words.select("lang", F.col("word").cast("string").alias("word"), "n"), phrases, totals, cover)


def ranked(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` by score, count and phrase, with their rank."""
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (candidates.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return ranked(collocations(documents(spark, sf_dir)))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?
-
]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
pos AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM split GROUP BY lang),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM pos CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)
  GROUP BY 1, 2, 3 HAVING count(*) >= 100),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cut AS (SELECT *, unnest(range(1, k)) AS c FROM cand),
scored AS (
  SELECT cut.lang, cut.phrase, cut.k, a, x.f AS l, y.f AS r, n, c, (1000 * a * n) // (x.f * y.f) AS score
  FROM cut JOIN total USING (lang)
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:c], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[c + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT DISTINCT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, k, ws, m, unnest(range(1, k - m + 2)) AS i FROM (
          SELECT *, unnest(range(2, k)) AS m FROM cand))),
kept AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM inside WHERE inside.lang = best.lang AND inside.phrase = best.phrase AND 100 * inside.a >= 100 * best.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM kept QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
