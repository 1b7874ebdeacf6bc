import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from noema.llm import conversation_repair as C

TURNS = "conv_id bigint, turn int, role string, text string, place string, seq int"
WS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    """rows of one conversation, in order -> their first faults."""
    seen, out = set(), []
    for _, _, role, text in rows:
        tail = text.rstrip(WS)
        out.append("b" if not tail else "d" if (role, text) in seen else "t" if tail[-1] not in ".!?" else "c")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines): row by row over the states, all strings written out."""
    nxt = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    role_of = {0: "user", 1: "user", 2: "assistant", 3: "user"}

    def inserts(best):
        for _ in range(3):
            for p, (cost, audit, out) in list(best.items()):
                new = (cost + 5, audit + "I", out + [role_of[p] + ":"])
                q = 3 if p == 2 else 2
                if q not in best or new < best[q]:
                    best[q] = new
        return best

    best = {0: (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults(rows)):
        new = {}

        def offer(q, cost, audit, out):
            if q not in new or (cost, audit) < new[q][:2]:
                new[q] = (cost, audit, out)

        for p, (cost, audit, out) in inserts(best).items():
            offer(p, cost + 2, audit + "D", out)
            if fault in "tc":
                more = 5 if fault == "t" else 0
                if (p, role[:1]) in nxt:
                    offer(nxt[p, role[:1]], cost + more, audit + "K", out + [f"{role}:{text}"])
                offer(3 if p == 2 else 2, cost + 1 + more, audit + "R", out + [f"{role_of[p]}:{text}"])
        best = new
    return min(v for p, v in inserts(best).items() if p in (0, 3))


def brute_force(rows):
    """rows as they are -> conv: report"""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in mine if r[1] is not None}
        cost, audit, lines = cheapest(mine)
        f = faults(mine)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("b"), f.count("d"), f.count("t"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def run(df, **kw):
    fixed = C.repair(df, **kw)
    sha = {r.conv: r.sha for r in C.digests(fixed.turns).collect()}
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sha.get(r.conv, C._EMPTY_SHA))
            for r in fixed.report.collect()}


def corpus(n=60):
    g = random.Random(3)
    rows = []
    for conv in range(n):
        for turn in range(g.randrange(1, 12)):
            role = g.choice(["system", "user", "user", "assistant", "assistant", "tool", "unknown", "", None])
            text = g.choice(["Fine.", "Right!", "cut off", "Why? \n", "", " \t", None, "é…", "a.", "b."])
            rows.append((conv, g.choice([turn, turn, turn + 1, None]), role, text))
    rows += [(None, 0, "user", "Hello."), (None, 1, "assistant", "Yes."), (900, None, None, None)]
    return rows + [(901, 0, "user", "Long text. " * 100_000), (901, 1, "assistant", "x" * 300_000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)


def test_same_as_brute_force(spark):
    assert run(frame(spark, corpus()).repartition(5)) == brute_force(corpus())


def test_one_long_conversation_in_many_segments(spark, monkeypatch):
    """Half of all rows in one conversation; segments of two turns, few rules."""
    g = random.Random(8)
    rows = [(1, t, g.choice(["system", "user", "assistant"]), g.choice(["a.", f"t{t}.", "cut", ""])) for t in range(150)]
    rows += [(2 + t % 40, t, g.choice(["user", "assistant"]), f"{t}.") for t in range(150)]
    monkeypatch.setattr(C, "_CHUNK_BITS", 1)
    want = brute_force(rows)
    assert run(frame(spark, rows).repartition(4), max_rules=3) == want


def test_rules_do_not_change_products():
    g = random.Random(1)
    plain, grammar = C.Grammar(), C.Grammar()
    for pair in ("be", "eb", "aa"):
        grammar.add(pair)
    grammar.add(chr(C._RULE) + chr(C._RULE))
    for _ in range(300):
        seq = "".join(g.choice("abceghl") for _ in range(g.randrange(1, 30)))
        flat = lambda m: [e and (e[0], C._text(e[1])) for e in m]
        assert flat(plain.matrix(seq)) == flat(grammar.matrix(seq))


def test_ropes_compare_as_strings():
    def cut(s, g):
        if len(s) < 2:
            return s
        k = g.randrange(len(s) + 1)
        return (cut(s[:k], g), cut(s[k:], g)) if 0 < k < len(s) else s

    g = random.Random(2)
    words = ["".join(w) for n in range(5) for w in itertools.product("DK", repeat=n)]
    for a, b in itertools.product(words, words):
        assert C.rope_less(cut(a, g), cut(b, g)) == (a < b)


def test_grammar_learns_frequent_pairs_and_keeps_within_bounds(spark):
    seqs = spark.createDataFrame([("debedebe", 10), ("dede", 3), ("a", 5), ("l", 1)], "seq string, n bigint")
    grammar = C.learn(seqs)
    assert grammar.rules[0][0] in ("de", "be") and len(grammar.compress("debedebe")) == 1
    assert len(C.learn(seqs, max_rules=1).rules) == 1 and C.learn(seqs.limit(0)).rules == []


def test_turns_are_the_repaired_conversation(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "cut"), (1, 2, "tool", "Ok."), (1, 3, "system", "No."), (2, 0, "system", " ")]
    fixed = C.repair(frame(spark, rows))
    assert [(r.turn, r.role, r.text, r.edit) for r in fixed.turns.orderBy("conv", "place").collect()] == [
        (0, "user", "Hi.", "K"), (3, "assistant", "No.", "R")]
    assert {r.conv: (r.cost, r.audit) for r in fixed.report.collect()} == {1: (5, "KDDR"), 2: (2, "D")}
    one = C.repair(frame(spark, [(1, 5, "user", "Hi.")] + [(1, 5, "system", "x.")] * 2))
    assert [(r.cost, r.audit, r.gaps, r.duplicate) for r in one.report.collect()] == [(4, "RDR", 0, 1)]
    two = C.repair(frame(spark, [(1, t, r, f"{r} {t}.") for t, r in enumerate(["system", "user", "assistant", "user"])]))
    assert [(r.turn, r.role, r.text, r.edit) for r in two.turns.orderBy("place").collect()][2:] == [(2, "assistant", "assistant 2.", "K")]
    assert two.report.first().audit == "KKKD"
    cut = C.repair(frame(spark, [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c"), (1, 3, "assistant", "d.")]))
    assert cut.report.first().audit == "DKDK"


def test_empty_table_and_conversations_that_lose_all_rows(spark, tmp_path):
    assert run(frame(spark, [])) == {}
    drop = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    frame(spark, [(7, drop, "user", "Gone.")]).write.parquet(str(tmp_path / "conversations.parquet"))
    assert [tuple(r) for r in C.op12(spark, str(tmp_path)).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", C._EMPTY_SHA)]


def test_query_same_as_its_sql_and_brute_force(spark, tmp_path):
    frame(spark, corpus()).drop("place", "seq").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    for d, glob in (("/root/testdata/sf0.01", "conversations.parquet"), (str(tmp_path), "conversations.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/{glob}'")
        df, rel = C.op12(spark, d), con.sql(C.OP12_SQL)
        assert sorted(df.columns) == sorted(rel.columns)
        got, want = (sorted((tuple(r) for r in x), key=repr) for x in (df.select(*rel.columns).collect(), rel.fetchall()))
        assert got == want
    brute = brute_force(damaged([r[:4] for r in corpus()]))
    assert {r[0]: r[1:] for r in got if r[0] in brute} == brute
