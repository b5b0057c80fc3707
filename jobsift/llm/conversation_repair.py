"""Conversation structure repair: generalised LR parsing with weighted edits.

The roles' initials of a well-formed conversation match ``(s?(ua)+)?``. ``RoleGrammar`` builds
the LR(0) automaton of that language. A parse keeps a frontier of stack tops over one graph of
shared stacks (a node is a state and the node below it, made once); a row moves
every top by its weighted edits:

- keep (K): shift the row's own initial; costs nothing;
- rerole (R): shift user or assistant instead; costs 1;
- delete (D): the stack stays; costs 2, and is the only edit of a blank or repeated row;
- insert (I): an empty user or assistant row ahead of a kept or reroled one, or at the end; costs 5.

A truncated row that stays costs 5 more. Equal tops are merged by their minimum (cost, audit). The
audit is the edits' initials in order; among equal costs the ASCII-least counts. Audits of the same rows
are never beginnings of one another, so their order is kept as a rank and a row costs the same however long the
conversation is. (An insert just ahead of a deleted row is never least: behind it, it reads smaller.)

Hot conversations. Rows are dealt out by ranges of (conversation, turn), narrow and without texts, so one
conversation may lie in many tasks, in pieces of at most ``piece`` rows. A piece that does not begin its
conversation is parsed from every stack it could meet; the pieces are joined in order by the same
merge. Equal rows of a turn are counted before they are moved, and the first
occurrence of a (role, text) is looked up by (key, salt). The repaired rows come in order per
conversation: there a conversation's texts pass through one task as a stream, of which only its audit and a
batch of rows are held. (A hash over the whole conversation can only be taken in order.)

Defined cases: a null conv_id is a conversation of its own; null turns come first and count in no gap;
null roles and texts are one blank. Rows of the same turn stand by role, then by the hash of their text. Rows with
the same conv_id, turn, role and text are as many rows. A conversation without rows has zeros, an empty audit and the hash
of the empty string. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import arrow_rows, arrow_schema, each_salt, mask_of, quoted, salt_of, written

# Fixed values of the contract: grammar, roles that edits may give, costs, what separates words
GRAMMAR = (("S", ()), ("S", ("P",)), ("S", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
PIECE = 4096


class RoleGrammar:
    """LR(0) automaton of ``productions`` (the first left side is the start) and its graph of stacks."""

    def __init__(self, productions=GRAMMAR, roles: str = "ua"):
        self.rules, self.start, self.roles = productions, productions[0][0], roles
        self.left = {a for a, _ in productions}
        self.sets: list[frozenset] = [self.closure({(r, 0) for r, (a, _) in enumerate(productions) if a == self.start})]
        self.numbers = {self.sets[0]: 0}
        self.nodes: dict[tuple, int] = {}
        self.stacks: list[tuple[int, int]] = []  # node -> (state, node below)
        self.moved: dict[tuple, list] = {}
        self.shifted: dict[tuple, list] = {}
        self.node(0, -1)
        known = 0
        while known < len(self.stacks):  # every stack that some row of roles leads to
            if len(self.stacks) > 1000:
                raise ValueError("the grammar's stacks are unbounded: write its repetitions left-recursively")
            for t in sorted({x for _, rhs in productions for x in rhs} - self.left):
                self.shift(known, t)
            known += 1

    def closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            r, dot = todo.pop()
            rhs = self.rules[r][1]
            for n, (a, _) in enumerate(self.rules):
                if dot < len(rhs) and rhs[dot] == a and (n, 0) not in items:
                    items.add((n, 0))
                    todo.append((n, 0))
        return frozenset(items)

    def goto(self, state: int, symbol: str) -> int | None:
        over = {(r, dot + 1) for r, dot in self.sets[state] if self.rules[r][1][dot:dot + 1] == (symbol,)}
        if not over:
            return None
        at = self.closure(over)
        if at not in self.numbers:
            self.numbers[at] = len(self.sets)
            self.sets.append(at)
        return self.numbers[at]

    def node(self, state: int, below: int) -> int:
        if (state, below) not in self.nodes:
            self.nodes[state, below] = len(self.stacks)
            self.stacks.append((state, below))
        return self.nodes[state, below]

    def complete(self, node: int) -> Iterator[tuple[str, int]]:
        """(left side, node that remains) of each rule that ends at the top of this stack."""
        for r, dot in sorted(self.sets[self.stacks[node][0]]):
            a, rhs = self.rules[r]
            if dot == len(rhs):
                at = node
                for _ in rhs:
                    at = self.stacks[at][1]
                yield a, at

    def shift(self, node: int, terminal: str) -> list[int]:
        """The stacks that a terminal leads to, reductions done; where a rule may end or go on, both."""
        if (node, terminal) not in self.shifted:
            if len(self.shifted) > 1 << 16:  # initials are any character
                self.shifted.clear()
            self.shifted[node, terminal] = self.reduced(node, terminal)
        return self.shifted[node, terminal]

    def reduced(self, node: int, terminal: str) -> list[int]:
        state = self.goto(self.stacks[node][0], terminal)
        if state is None:
            return []
        out, todo = [], [self.node(state, node)]
        while todo:
            at = todo.pop()
            open_ = any(dot < len(self.rules[r][1]) for r, dot in self.sets[self.stacks[at][0]])
            ends = list(self.complete(at))
            if open_ or any(a == self.start for a, _ in ends):
                out.append(at)
            for a, rest in ends:
                if a != self.start:
                    todo.append(self.node(self.goto(self.stacks[rest][0], a), rest))
        return out

    def accepts(self, node: int) -> bool:
        return any(a == self.start and rest == 0 for a, rest in self.complete(node))

    def inserted(self, node: int) -> dict[int, int]:
        """Stacks that inserts lead to -> the fewest inserts."""
        far, todo = {node: 0}, [node]
        for at in todo:
            for t in self.roles:
                for to in self.shift(at, t):
                    if to not in far:
                        far[to] = far[at] + 1
                        todo.append(to)
        return far

    def moves(self, node: int, initial: str, forced: bool, truncated: bool) -> list[tuple[int, int, str]]:
        """(stack, cost, edits) of every way to take a row from this stack."""
        key = (node, initial, forced, truncated)
        if key not in self.moved:
            out = [(node, DELETE, "D")]
            if not forced:
                more = TRUNCATED * truncated
                for at, j in self.inserted(node).items():
                    cost, ahead = INSERT * j + more, "I" * j
                    out += [(to, cost, ahead + "K") for to in self.shift(at, initial)] if initial else []
                    out += [(to, cost + REROLE, ahead + "R") for t in self.roles for to in self.shift(at, t)]
            if len(self.moved) > 1 << 16:  # initials are any character
                self.moved.clear()
            self.moved[key] = out
        return self.moved[key]

    def role(self, node: int) -> str:
        """The one role that an edit can give next."""
        return next(t for t in self.roles if self.shift(node, t))


class Frontier:
    """Stack tops with their least cost; the edits hang on backward links, tops ordered by audit."""

    def __init__(self, grammar: RoleGrammar, node: int = 0):
        self.grammar, self.tops = grammar, [(node, 0, None)]  # in the order of their audits

    def take(self, moves_of) -> None:
        best: dict[int, tuple] = {}
        for rank, (node, cost, link) in enumerate(self.tops):
            for to, more, edits in moves_of(node):
                top, new = self.grammar.stacks[to][0], (cost + more, rank, edits)
                if top not in best or new < best[top][0]:
                    best[top] = new, to, link
        kept = sorted(best.values(), key=lambda x: x[0][1:])
        self.tops = [(to, cost, (edits, link)) for (cost, _, edits), to, link in kept]

    def spelled(self, link) -> str:
        out = []
        while link is not None:
            out.append(link[0])
            link = link[1]
        return "".join(reversed(out))

    def table(self) -> list[tuple[int, int, str]]:
        return [(node, cost, self.spelled(link)) for node, cost, link in self.tops]

    def finish(self) -> tuple[int, str]:
        """Cost and audit of the cheapest end."""
        cost, _, edits, link = min((cost + INSERT * j, rank, "I" * j, link) for rank, (node, cost, link) in enumerate(self.tops)
                                   for at, j in self.grammar.inserted(node).items() if self.grammar.accepts(at))
        return cost, self.spelled(link) + edits


# --- rows -------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with one kind of damage by crc32(conv_id:turn) % 20:
    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown[2].alias("role"), shown[3].alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def keyed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, sha, text, copies): null conversations under the empty key, null roles and texts as a blank."""
    text = F.coalesce(quoted("text").cast("string"), F.lit(" "))
    copies = quoted("copies") if "copies" in rows.columns else F.lit(1)
    return rows.select(F.coalesce(quoted("conv_id").cast("string"), F.lit("")).alias("conv"), quoted("turn").cast("long").alias("turn"),
                       F.coalesce(quoted("role").cast("string"), F.lit(" ")).alias("role"),
                       F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"), copies.cast("long").alias("copies"))


def runs(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, sha, blank, truncated, n, first): equal rows of a turn as one; ``first``: no earlier
    turn has that role and text."""
    seen = F.rtrim("text", F.lit(BLANKS))
    each = (rows.withColumn("blank", seen == "").withColumn("truncated", ~F.right(seen, F.lit(1)).isin(".", "!", "?"))
            .groupBy("conv", "turn", "role", "sha", "blank", "truncated").agg(F.sum("copies").alias("n"))
            .withColumn("salt", salt_of(F.col("turn"))))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = (each.groupBy("conv", "role", "sha").agg(F.min(when).alias("at"), mask_of("salt").alias("mask"))
              .select("conv", "role", "sha", "at", each_salt("mask").alias("salt")))
    return (each.join(firsts, ["conv", "role", "sha", "salt"])
            .select("conv", "turn", "role", "sha", "blank", "truncated", "n", (F.col("at.turn").eqNullSafe(F.col("turn"))).alias("first")))


ORDER = ["conv", "turn", "role", "sha"]  # nulls first
PIECES = ("conv string, turn long, role string, sha binary, blank long, duplicate long, truncated long, illegal long, opens string, "
          "closes string, first_turn long, last_turn long, turns long, ways string")


def pieces(piece: int):
    """Sorted runs -> one row per piece of a conversation, with its ways from stack to stack."""
    schema = arrow_schema(PIECES)

    def run(batches):
        grammar, parsed = RoleGrammar(), None

        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def out():
            held, size, conv, opening = [], 0, None, False
            for row in rows():
                if conv is not None and row[0] != conv:
                    yield closed(held, opening)
                    held, size, opening = [], 0, True
                elif size >= piece:
                    yield closed(held, opening)
                    held, size, opening = [], 0, False
                conv = row[0]
                n, at = row[6], 0
                while at < n:  # a run of equal rows may be longer than a piece
                    part = min(n - at, piece)
                    held.append((*row[:6], part, row[7] and at == 0))
                    size, at = size + part, at + part
                    if at < n:
                        yield closed(held, opening)
                        held, size, opening = [], 0, False
            if held:
                yield closed(held, opening)

        def closed(held, opening):
            blank = duplicate = truncated = illegal = turns = 0
            before = last = None
            entries = {e: Frontier(grammar, e) for e in ([0] if opening else range(len(grammar.stacks)))}
            known = [r[1] for r in held if r[1] is not None]
            for _, turn, role, _, is_blank, is_cut, n, is_first in held:
                initial = role[:1]
                illegal += n - 1 + (before is not None and before + initial not in LEGAL)
                before = initial
                turns += turn is not None and turn != last
                last = turn
                extra = 0 if is_blank else n - is_first
                blank += n if is_blank else 0
                duplicate += extra
                truncated += not is_blank and is_first and is_cut
                for f in entries.values():
                    if is_first and not is_blank:
                        f.take(lambda node: grammar.moves(node, initial, False, is_cut))
                    for _ in range(n if is_blank else extra):
                        f.take(lambda node: grammar.moves(node, "", True, False))
            ways = json.dumps({e: f.table() for e, f in entries.items()})
            return (*held[0][:4], blank, duplicate, truncated, illegal, held[0][2][:1], before,
                    known[0] if known else None, known[-1] if known else None, turns, ways)

        return arrow_rows(out(), schema, heavy=13)

    return run


REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def folded():
    """Sorted pieces -> one row per conversation."""
    schema = arrow_schema(REPORT)

    def run(batches):
        grammar = RoleGrammar()

        def out():
            conv = None
            for batch in batches:
                for at, _, _, _, blank, duplicate, truncated, illegal, opens, closes, low, high, turns, ways in zip(
                        *(c.to_pylist() for c in batch.columns)):
                    if at != conv:
                        if conv is not None:
                            yield total()
                        conv, frontier, sums, least, most, distinct, before = at, Frontier(grammar), [0, 0, 0, 0], None, None, 0, None
                    table = json.loads(ways)
                    frontier.take(lambda node: table[str(node)])
                    sums = [a + b for a, b in zip(sums, (blank, duplicate, truncated, illegal))]
                    sums[3] += before is not None and before + opens not in LEGAL
                    before = closes
                    if low is not None:
                        distinct += turns - (most == low)
                        least, most = low if least is None else least, high

                    def total():
                        return (conv, 0 if least is None else most - least + 1 - distinct, *sums, *frontier.finish())

            if conv is not None:
                yield total()

        return arrow_rows(out(), schema, heavy=7)

    return run


def examine(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation (conv, see ``keyed``): gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``rows``: conv_id, turn, role, text and, if there, copies."""
    each, _ = written(runs(keyed(rows)), "conversation-runs")  # its range bounds are sampled
    dealt = each.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    parts = dealt.select(*ORDER, "blank", "truncated", "n", "first").mapInArrow(pieces(piece), PIECES)
    return parts.repartition("conv").sortWithinPartitions(*ORDER).mapInArrow(folded(), REPORT)


REPAIRED = "conv string, position long, edit string, turn long, role string, text string"


def applied():
    """A conversation's audit, then its sorted rows -> its repaired rows in order."""
    schema = arrow_schema(REPAIRED)

    def run(batches):
        grammar = RoleGrammar()

        def rows():
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    yield row
            yield "", 0, None, None, None, None, None, ""  # closes the last conversation

        def out():
            audit, at, node, position, conv = "", 0, 0, 0, None
            for key, kind, turn, role, _, text, copies, edits in rows():
                if kind == 0:  # edits behind the last row of the conversation before are inserts
                    while at < len(audit):
                        t = grammar.role(node)
                        yield conv, position, "I", None, ROLES[t], ""
                        node, position, at = grammar.shift(node, t)[0], position + 1, at + 1
                    audit, at, node, position, conv = edits, 0, 0, 0, key
                    continue
                for _ in range(copies):
                    while audit[at] == "I":
                        t = grammar.role(node)
                        yield conv, position, "I", None, ROLES[t], ""
                        node, position, at = grammar.shift(node, t)[0], position + 1, at + 1
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    t = role[:1] if edit == "K" else grammar.role(node)
                    yield conv, position, edit, turn, role if edit == "K" else ROLES[t], text
                    node, position = grammar.shift(node, t)[0], position + 1

        return arrow_rows(out(), schema, heavy=5)

    return run


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The rows that stay, with their edits, and the inserted ones: a conversation's rows stand together, in order."""
    none = F.lit(None)
    texts = keyed(rows).select("conv", F.lit(1).alias("kind"), "turn", "role", "sha", "text", "copies", none.cast("string").alias("audit"))
    audits = report.select("conv", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
                           none.cast("binary").alias("sha"), none.cast("string").alias("text"), none.cast("long").alias("copies"), "audit")
    both = audits.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "sha")
    return both.mapInArrow(applied(), REPAIRED)


def digests(rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of ``repaired``'s rows, taken as they come."""
    schema = arrow_schema("conv string, repaired_sha256 string")

    def run(batches):
        def out():
            conv, digest = None, None
            for batch in batches:
                for key, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if key != conv:
                        if conv is not None:
                            yield conv, digest.hexdigest()
                        conv, digest = key, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{role}:{text}".encode())
            if conv is not None:
                yield conv, digest.hexdigest()

        return arrow_rows(out(), schema)

    return rows.select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = damage(talks)
    report, _ = written(examine(rows), "conversation-report")
    result = report.join(digests(repaired(rows, report)), "conv", "left")
    kind = talks.schema["conv_id"].dataType
    every = talks.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")).distinct()
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(result, "conv", "left").select(
        F.nullif("conv", F.lit("")).cast(kind).alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: CAST(z AS BIGINT))),
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         substr(role, 1, 1) AS c, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen FROM damaged),
faults AS (
  SELECT *, seen = '' AS blank, seen <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM placed),
facts AS (SELECT *, blank OR duplicate AS forced,
                 NOT blank AND NOT duplicate AND right(seen, 1) NOT IN ('.', '!', '?') AS truncated FROM faults),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 't': ''} AS a, {'c': 1000000000, 't': ''} AS s,
         {'c': 1000000000, 't': ''} AS u, {'c': 1000000000, 't': ''} AS f FROM facts
  UNION ALL
  SELECT conv_id, i, {'c': a.c + 2, 't': a.t || 'D'},
    CASE WHEN forced OR c <> 's' THEN {'c': s.c + 2, 't': s.t || 'D'}
         ELSE list_min([{'c': s.c + 2, 't': s.t || 'D'}, {'c': a.c + x, 't': a.t || 'K'}]) END,
    CASE WHEN forced THEN {'c': u.c + 2, 't': u.t || 'D'} ELSE list_min([{'c': u.c + 2, 't': u.t || 'D'},
      {'c': before_u.c + x + CASE WHEN c = 'u' THEN 0 ELSE 1 END, 't': before_u.t || CASE WHEN c = 'u' THEN 'K' ELSE 'R' END}]) END,
    CASE WHEN forced THEN {'c': f.c + 2, 't': f.t || 'D'} ELSE list_min([{'c': f.c + 2, 't': f.t || 'D'},
      {'c': before_a.c + x + CASE WHEN c = 'a' THEN 0 ELSE 1 END, 't': before_a.t || CASE WHEN c = 'a' THEN 'K' ELSE 'R' END}]) END
  FROM (
    SELECT facts.conv_id, facts.i, a, s, u, f, c, forced, CASE WHEN truncated THEN 5 ELSE 0 END AS x,
      list_min([a, s, f, {'c': u.c + 5, 't': u.t || 'I'}]) AS before_u,
      list_min([u, {'c': a.c + 5, 't': a.t || 'I'}, {'c': s.c + 5, 't': s.t || 'I'}, {'c': f.c + 5, 't': f.t || 'I'}]) AS before_a
    FROM walk JOIN facts ON facts.conv_id IS NOT DISTINCT FROM walk.conv_id AND facts.i = walk.i + 1)),
ends AS (
  SELECT conv_id, list_min([a, f, {'c': u.c + 5, 't': u.t || 'I'}, {'c': s.c + 10, 't': s.t || 'II'}]) AS e
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
letters AS (SELECT conv_id, p, substr(e.t, p, 1) AS edit FROM (SELECT *, unnest(range(1, length(e.t) + 1)) AS p FROM ends)),
counted AS (
  SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY p) AS i,
         sum(CASE WHEN edit = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY p) AS o FROM letters),
shown AS (
  SELECT counted.conv_id, counted.p, o, edit, role, CASE WHEN edit = 'I' THEN '' ELSE text END AS text,
         max(CASE WHEN o = 1 AND edit = 'K' AND c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY counted.conv_id) AS led
  FROM counted LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM counted.conv_id AND facts.i = counted.i AND edit <> 'I'
  WHERE edit <> 'D'),
digest AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - 1 - led) % 2 = 0 THEN 'user' ELSE 'assistant' END
                                    || ':' || text, chr(10) ORDER BY p)) AS sha FROM shown GROUP BY conv_id),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.c, 0) AS BIGINT) AS cost, coalesce(e.t, '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM every LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN digest ON digest.conv_id IS NOT DISTINCT FROM every.conv_id
"""
