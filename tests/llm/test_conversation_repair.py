import hashlib
import re
from itertools import product

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.llm import conversation_repair as cr

WELL_FORMED = re.compile(r"(s?(ua)+)?")
INSERTS = ["", "u", "a", "ua", "au"]
TALK = "conv_id long, turn long, role string, text string"


def slow(rows):
    """Cheapest (cost, audit) of (initial, forced, truncated) rows: every combination of edits is tried."""
    best = None
    ways = [[("D", "", 2)] if forced else
            [("D", "", 2)] + ([("K", c, 5 * cut)] if c else []) + [("R", t, 1 + 5 * cut) for t in "ua"] for c, forced, cut in rows]
    for edits in product(*ways):
        for gaps in product(INSERTS, repeat=len(rows) + 1):
            if WELL_FORMED.fullmatch(gaps[0] + "".join(e[1] + g for e, g in zip(edits, gaps[1:]))):
                audit = "I" * len(gaps[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, gaps[1:]))
                cost = sum(e[2] for e in edits) + 5 * sum(map(len, gaps))
                best = min(best or (cost, audit), (cost, audit))
    return best


ROWS = st.lists(st.tuples(st.sampled_from("usax") | st.just(""), st.booleans(), st.booleans()), max_size=3)


@settings(max_examples=150, deadline=None)
@given(ROWS)
def test_against_every_combination_of_edits(rows):
    f = cr.Frontier(cr.RoleGrammar())
    for c, forced, cut in rows:
        f.take(lambda node: f.grammar.moves(node, "" if forced else c, forced, cut))
    assert f.finish() == slow(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("uasax"), st.booleans(), st.booleans()), max_size=25), st.integers(1, 6))
def test_pieces_join_to_the_whole(rows, size):
    g = cr.RoleGrammar()

    def over(f, part):
        for c, forced, cut in part:
            f.take(lambda node: g.moves(node, "" if forced else c, forced, cut))
        return f

    joined = cr.Frontier(g)
    for i in range(0, len(rows), size):
        tables = {e: over(cr.Frontier(g, e), rows[i:i + size]).table() for e in range(len(g.stacks))}
        joined.take(lambda node: tables[node])
    assert joined.finish() == over(cr.Frontier(g), rows).finish()


def test_grammar_accepts_what_the_pattern_does():
    g = cr.RoleGrammar()
    for n in range(7):
        for word in product("sua", repeat=n):
            tops = {0}
            for t in word:
                tops = {to for at in tops for to in g.shift(at, t)}
            assert any(map(g.accepts, tops)) == bool(WELL_FORMED.fullmatch("".join(word)))
    with pytest.raises(ValueError):
        cr.RoleGrammar((("S", ("P",)), ("P", ("u", "a")), ("P", ("u", "a", "P"))))


def talks():
    rows = []
    for conv in [*range(60), None]:
        x = (conv or 0) * 977 + 5
        for turn in range((conv or 4) % 9):
            x = (x * 1103515245 + 12345) % (1 << 31)
            role = ("user", "assistant", "system", "user", "assistant", "tool", "", None)[(x >> 8) % 8]
            text = ("Yes.", "No!", "", " \t\n", "cut", None, f"t{turn}?", "Über. ")[(x >> 12) % 8]
            rows.append((conv, turn * (1 + (x >> 16) % 2) if (x >> 18) % 7 else None, role, text))
    return rows + [(70, 1, "user", "same.")] * 3 + [(71, t, "user", "hi.") for t in range(40)] + [(72, None, None, None)] * 2


def columns(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("piece", [cr.PIECE, 2])
def test_rows_against_the_sql(spark, tmp_path, monkeypatch, piece):
    """Null conversations, turns, roles and texts, repeated rows, unequal rows of one turn, many texts alike."""
    spark.createDataFrame(talks(), TALK).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    monkeypatch.setattr(cr.examine, "__defaults__", (piece,))
    got = cr.op11_conversation_repair(spark, str(tmp_path))
    want = con.sql(cr.ORACLE)
    assert got.columns == want.columns
    assert columns(got) == sorted(want.fetchall(), key=str)


def test_repaired_rows(spark):
    rows = spark.createDataFrame([
        (1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "What"), (1, 3, "assistant", "That."),
        (1, 4, "assistant", "That."), (2, 0, "user", "Well?"), (3, 0, "user", "Yes!"), (3, 1, "assistant", "No.")], TALK)
    report = cr.examine(rows)
    assert {r.conv: (r.cost, r.audit, r.duplicate, r.truncated, r.illegal) for r in report.collect()} == {
        "1": (5, "KRDKD", 1, 1, 2), "2": (2, "D", 0, 0, 0), "3": (0, "KK", 0, 0, 0)}
    out = cr.repaired(rows, report)
    by = {}
    for r in sorted(out.collect(), key=lambda r: (r.conv, r.position)):
        by.setdefault(r.conv, []).append((r.role, r.text))
    audits = {r.conv: r.audit for r in report.collect()}
    assert by["3"] == [("user", "Yes!"), ("assistant", "No.")] and "2" not in by
    assert all(WELL_FORMED.fullmatch("".join(role[0] for role, _ in v)) for v in by.values())
    assert all(len(v) == sum(c != "D" for c in audits[k]) for k, v in by.items())
    digest = {r.conv: r.repaired_sha256 for r in cr.digests(out).collect()}
    assert digest == {k: hashlib.sha256("\n".join(f"{a}:{b}" for a, b in v).encode()).hexdigest() for k, v in by.items()}


def test_empty_and_wide_tables(spark, tmp_path):
    wide = spark.createDataFrame([(1, 0, "user", "a.", "x", 5, True)], TALK + ", audit string, copies long, kind boolean")
    wide.write.parquet(str(tmp_path / "conversations.parquet"))
    assert [r.conv_id for r in cr.op11_conversation_repair(spark, str(tmp_path)).collect()] == [1]
    wide.limit(0).write.mode("overwrite").parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert cr.op11_conversation_repair(spark, str(tmp_path / "none")).count() == 0
