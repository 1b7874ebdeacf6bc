"""Repair of the structure of conversations by a grammar-compressed dynamic programme.

Every turn is a symbol: the initial of its role (s, u, a or another) and its fault.  The
cheapest edits that bring a conversation into the form ``(s?(ua)+)?`` are a shortest path
through a machine of four states: nothing yet, after s, after u, after a.  What a string
of symbols does to the states is a min-plus matrix, 4 x 4, of the least cost and, as a
rope, the audit of the edits: among equally cheap ones the ASCII-least.  Matrices of
neighbouring strings multiply.

Sequences of all conversations are compressed by Re-Pair: in rounds, the most frequent
pairs of neighbouring symbols (which share no symbol) become rules, counted over the
distinct sequences of all conversations and their numbers.  The rules' matrices are made
bottom-up, one product a rule, and their ropes refer to those of their parts.  Tasks
get the rules and multiply what is left of a sequence; equal sequences of a task are
multiplied once.  ``max_rules`` and ``max_rounds`` bound the grammar: beyond them more
products are left, with the same result.

Rows are range-sorted, so a conversation of any share of the rows is spread; sequences
are cut into segments of at most 1,024 turns.  Two passes over segments (one small row
each) carry the cost of what follows backwards and the state reached forwards.  A segment's
audits end with a turn's own edit, so none is the beginning of another, and the
segments' choices add up to the ASCII-least audit of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from noema.llm.store import columns, partitions, schema, table

MAX_RULES, MAX_ROUNDS = 2048, 12
_CHUNK_BITS = 10
_BLANK = " \t\n\x0b\x0c\r"
_SYMBOLS = "abcdefghijkl"           # 3 * initial (s, u, a, another) + kind (sound, truncated, to delete)
_RULE = 0xE000                      # rules are private-use characters
_NEXT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}   # (state, initial) -> state
_TAIL = ((0, ""), (10, "II"), (5, "I"), (0, ""))                   # cheapest end from each state
_ROLE = ("user", "user", "assistant", "user")                      # of a turn inserted or rerolled in a state
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _after(state: int) -> int:
    """The state after the user or assistant turn that may follow ``state``."""
    return 3 if state == 2 else 2


# ---- min-plus matrices with audit ropes ---------------------------------------------
# A matrix is a list of 16 entries, None or (cost, rope); a rope is a string or (left, right).

def rope_less(a, b) -> bool:
    """Whether rope ``a`` is the smaller string; parts in common are not looked into."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q:
            continue
        wide = isinstance(p, tuple), isinstance(q, tuple)
        if any(wide):
            x += p[::-1] if wide[0] else (p,)
            y += q[::-1] if wide[1] else (q,)
            continue
        m = min(len(p), len(q))
        if p[:m] != q[:m]:
            return p < q
        if len(p) > m:
            x.append(p[m:])
        if len(q) > m:
            y.append(q[m:])
    return any(_text(r) for r in y) and not any(_text(r) for r in x)


def _text(rope) -> str:
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, tuple):
            todo += r[::-1]
        else:
            out.append(r)
    return "".join(out)


def _better(new, old) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and rope_less(new[1], old[1])


def terminal(symbol: str) -> list:
    """The matrix of one turn: insertions before it, then its own edit."""
    initial, kind = divmod(_SYMBOLS.index(symbol), 3)
    out: list = [None] * 16
    for start in range(4):
        state, inserted = start, ""
        for _ in range(3):
            edits = [("D", state, 2)]
            if kind < 2:
                if (state, initial) in _NEXT:
                    edits.append(("K", _NEXT[state, initial], 5 * kind))
                edits.append(("R", _after(state), 1 + 5 * kind))
            for edit, to, cost in edits:
                new = (5 * len(inserted) + cost, inserted + edit)
                if _better(new, out[4 * start + to]):
                    out[4 * start + to] = new
            state, inserted = _after(state), inserted + "I"
    return out


def product(a: list, b: list) -> list:
    out: list = [None] * 16
    for p in range(4):
        for r in range(4):
            x = a[4 * p + r]
            if x is None:
                continue
            for q in range(4):
                y = b[4 * r + q]
                if y is not None:
                    old = out[4 * p + q]
                    if old is None or x[0] + y[0] <= old[0]:
                        new = (x[0] + y[0], (x[1], y[1]))
                        if _better(new, old):
                            out[4 * p + q] = new
    return out


class Grammar:
    """Re-Pair rules, and the matrices of symbols and rules."""

    def __init__(self):
        self.rules: list[tuple[str, str]] = []          # (pair, its symbol), in the order of their making
        self.matrices = {s: terminal(s) for s in _SYMBOLS}
        self._known: dict[str, list] = {}

    def add(self, pair: str) -> None:
        symbol = chr(_RULE + len(self.rules))
        self.rules.append((pair, symbol))
        self.matrices[symbol] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def compress(self, seq: str, first: int = 0) -> str:
        for pair, symbol in self.rules[first:]:
            if len(seq) < 2:
                break
            seq = seq.replace(pair, symbol)
        return seq

    def matrix(self, seq: str) -> list:
        """The matrix of a sequence of turns; equal ones are multiplied once."""
        out = self._known.get(seq)
        if out is None:
            if len(self._known) >= 4096:
                self._known.clear()
            out = self._known[seq] = reduce(product, [self.matrices[s] for s in self.compress(seq)])
        return out


def learn(seqs: DataFrame, max_rules: int = MAX_RULES, max_rounds: int = MAX_ROUNDS) -> Grammar:
    """Rules from (seq, n: how often).  Only the 256 most frequent pairs of a round reach the
    driver.  A pair of equal symbols counts at each place; that only concerns the choice."""
    grammar, now = Grammar(), seqs
    for _ in range(max_rounds):
        pairs = now.where("length(seq) > 1").select(
            "n", F.explode(F.regexp_extract_all("seq", F.lit("(?=(..))"), 1)).alias("pair"))
        top = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair").limit(256).collect()
        first, used = len(grammar.rules), set()
        for r in top:
            if len(grammar.rules) < max_rules and not used & set(r.pair):
                used |= set(r.pair)
                grammar.add(r.pair)
        if len(grammar.rules) == first:
            break
        rules = grammar.rules[first:]

        def replaced(batches, rules=rules):
            import pyarrow.compute as pc
            for b in batches:
                seq = b.column("seq")
                for pair, symbol in rules:
                    seq = pc.replace_substring(seq, pattern=pair, replacement=symbol)
                yield pa.RecordBatch.from_arrays([seq, b.column("n")], ["seq", "n"])

        now = table(now.mapInArrow(replaced, "seq string, n bigint"), "re-pair")
    return grammar


# ---- passes over segments -----------------------------------------------------------

def _illegal(seq: str) -> int:
    initials = [_SYMBOLS.index(s) // 3 for s in seq]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(initials, initials[1:]))


def _with_columns(b: pa.RecordBatch, **new: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*b.columns, *new.values()], [*b.schema.names, *new])


def _weighed(grammar: Grammar):
    """Each segment's costs, and for each start the order of the audits by end state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            costs, ranks = [], []
            for seq in b.column("seq").to_pylist():
                m = grammar.matrix(seq)
                costs.append([-1 if e is None else e[0] for e in m])
                texts = [None if e is None else _text(e[1]) for e in m]
                ranks.append([-1 if texts[4 * p + q] is None else
                              sum(t is not None and t < texts[4 * p + q] for t in texts[4 * p:4 * p + 4])
                              for p in range(4) for q in range(4)])
            kind = pa.list_(pa.int64())
            yield _with_columns(b, costs=pa.array(costs, kind), ranks=pa.array(ranks, kind))
    return run


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments come by conversation, last first: the least cost of all that follows, by state."""
    conv, cost = object(), None
    for b in batches:
        rest, last = [], []
        for c, costs in zip(b.column("conv").to_pylist(), b.column("costs").to_pylist()):
            last.append(c != conv)
            if c != conv:
                conv, cost = c, [t[0] for t in _TAIL]
            rest.append(cost)
            cost = [min(costs[4 * p + q] + cost[q] for q in range(4) if costs[4 * p + q] >= 0) for p in range(4)]
        yield _with_columns(b, rest=pa.array(rest, pa.list_(pa.int64())), last=pa.array(last, pa.bool_()))


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments come by conversation, first first: the states before and after, the cost, and
    the illegal neighbours in the segment and at its start."""
    conv, state, before = object(), 0, ""
    for b in batches:
        out = {k: [] for k in ("start", "end", "cost", "illegal")}
        for c, seq, costs, ranks, rest, last in zip(*(b.column(k).to_pylist() for k in ("conv", "seq", "costs", "ranks", "rest", "last"))):
            if c != conv:
                conv, state, before = c, 0, ""
            q = min((q for q in range(4) if costs[4 * state + q] >= 0),
                    key=lambda q: (costs[4 * state + q] + rest[q], ranks[4 * state + q]))
            out["start"].append(state)
            out["end"].append(q)
            out["cost"].append(costs[4 * state + q] + (_TAIL[q][0] if last else 0))
            out["illegal"].append(_illegal(before + seq))
            state, before = q, seq[-1]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(k) for k in ("conv", "chunk", "mid", "seq", "last")), *(pa.array(v, pa.int64()) for v in out.values())],
            ["conv", "chunk", "mid", "seq", "last", *out])


def _audited(grammar: Grammar):
    def run(batches):
        for b in batches:
            audit = [_text(grammar.matrix(s)[4 * p + q][1]) + (_TAIL[q][1] if last else "") for s, p, q, last in zip(
                *(b.column(k).to_pylist() for k in ("seq", "start", "end", "last")))]
            yield _with_columns(b, audit=pa.array(audit, pa.string()))
    return run


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mid, before, edit, role, after) of each turn: the roles inserted before it, its edit, its
    new role if it gets one, and the roles inserted after a conversation's last turn."""
    for b in batches:
        for seq, mid, audit, state in zip(*(b.column(k).to_pylist() for k in ("seq", "mid", "audit", "start"))):
            before, edits, roles, inserted = [], [], [], []
            for c in audit:
                if c == "I":
                    inserted.append(_ROLE[state])
                    state = _after(state)
                    continue
                initial = _SYMBOLS.index(seq[len(edits)]) // 3
                roles.append(_ROLE[state] if c == "R" else None)
                state = state if c == "D" else _after(state) if c == "R" else _NEXT[state, initial]
                before.append(inserted)
                edits.append(c)
                inserted = []
            after = [[]] * (len(edits) - 1) + [inserted]
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(mid, mid + len(edits)), pa.int64()), pa.array(before, kind), pa.array(edits, pa.string()),
                 pa.array(roles, pa.string()), pa.array(after, kind)], ["mid", "before", "edit", "new_role", "after"])


# ---- the operator -------------------------------------------------------------------

@dataclass
class Repaired:
    """``turns``: the repaired conversations, a row a turn: conv, place (orders a conversation's
    turns), turn (null if inserted), role, text, edit (K, R or I).  ``report``: a row for each
    conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    turns: DataFrame
    report: DataFrame


def repair(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", max_rules: int = MAX_RULES, max_rounds: int = MAX_ROUNDS) -> Repaired:
    """Repair every conversation at the least cost.

    A conversation's rows go by turn (nulls first), then role and text; a null role or text
    is one space, null ids are one conversation.  The first fault of a row counts:
    blank (no ``[^\\x20\\x09-\\x0D]``), duplicate (role and text stand earlier),
    truncated (the last such character is none of ``.!?``).  Keep costs 0, Rerole to user or
    assistant 1, Delete 2 (the only choice for blank and duplicate rows), Insert of an empty
    user or assistant turn 5; a truncated row that stays adds 5.  Initials of roles count:
    roles beginning with s, u and a are those of the form ``(s?(ua)+)?``.  ``audit`` has the
    initials of the edits in order, the ASCII-least of the cheapest; ``illegal`` counts
    neighbours other than su, ua, au.  Equal texts are recognised by SHA-256.  An empty table
    gives empty results.  Other columns are ignored.
    """
    spark = conversations.sparkSession
    df = columns(conversations, conv=id_col, turn=turn_col, role=role_col, text=text_col)
    df = df.select("conv", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                   F.coalesce("text", F.lit(" ")).alias("text"))
    order = ["conv", "turn", "role", "text", "tie"]     # the tie only splits equal rows
    rows = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *order) \
        .sortWithinPartitions(*order).drop("tie").withColumn("mid", F.monotonically_increasing_id())
    rows = table(rows, "turns")

    tail = F.rtrim("text", F.lit(_BLANK))
    blank, cut = tail == "", ~F.right(tail, F.lit(1)).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select("conv", "turn", "mid", "role", initial.alias("initial"), blank.alias("blank"), cut.alias("cut"),
                         F.sha2("text", 256).alias("digest"))
    firsts = narrow.where("not blank").groupBy("conv", "role", "digest").agg(F.min("mid").alias("mid")).select(
        "mid", F.lit(True).alias("first"))
    known = narrow.join(firsts, "mid", "left").withColumn(
        "fault", F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("c"))
    kind = F.when(F.col("fault").isin("b", "d"), 2).when(F.col("fault") == "t", 1).otherwise(0)
    symbol = F.substring(F.lit(_SYMBOLS), F.col("initial") * 3 + kind + 1, F.lit(1))
    known = table(known.select("conv", "turn", "mid", "fault", symbol.alias("symbol")), "symbols")

    collected = F.sort_array(F.collect_list(F.struct("mid", "symbol")))
    segments = known.groupBy("conv", F.shiftright("mid", _CHUNK_BITS).alias("chunk")).agg(
        F.min("mid").alias("mid"), F.array_join(collected["symbol"], "").alias("seq"))
    segments = table(segments, "segments")
    grammar = learn(segments.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), max_rules, max_rounds)

    conv = segments.schema["conv"].dataType
    base = schema("", conv=conv).fields + StructType.fromDDL("chunk bigint, mid bigint, seq string").fields

    def typed(ddl: str) -> StructType:
        return StructType(base + StructType.fromDDL(ddl).fields)

    weighed = segments.mapInArrow(_weighed(grammar), typed("costs array<bigint>, ranks array<bigint>"))
    back = weighed.repartition("conv").sortWithinPartitions("conv", F.desc("chunk")).mapInArrow(
        _backward, typed("costs array<bigint>, ranks array<bigint>, rest array<bigint>, last boolean"))
    on = back.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(
        _forward, typed("last boolean, start bigint, end bigint, cost bigint, illegal bigint"))
    chosen = table(on.mapInArrow(_audited(grammar), typed(
        "last boolean, start bigint, end bigint, cost bigint, illegal bigint, audit string")), "audits")

    counts = known.groupBy("conv", "turn").agg(*[F.sum((F.col("fault") == f).cast("bigint")).alias(f) for f in "bdt"])
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = counts.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"), F.sum("b").alias("blank"),
                                        F.sum("d").alias("duplicate"), F.sum("t").alias("truncated"))
    audits = chosen.groupBy(F.col("conv").alias("c")).agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "audit")))["audit"], "").alias("audit"))
    report = counts.join(audits, F.col("conv").eqNullSafe(F.col("c"))).drop("c")

    edits = chosen.mapInArrow(_edits, "mid bigint, before array<string>, edit string, new_role string, after array<string>")
    inserted = lambda r: F.struct(F.lit(None).cast(df.schema["turn"].dataType).alias("turn"), r.alias("role"),
                                  F.lit("").alias("text"), F.lit("I").alias("edit"))
    own = F.array(F.struct("turn", F.coalesce("new_role", "role").alias("role"), "text", "edit"))
    parts = F.concat(F.transform("before", inserted), F.when(F.col("edit") == "D", F.slice(own, 1, 0)).otherwise(own),
                     F.transform("after", inserted))
    # a segment's row becomes a row for each turn, which Spark's estimate of its size doesn't know
    turns = rows.join(edits.hint("merge"), "mid").select("conv", "mid", F.posexplode(parts).alias("part", "t"))
    return Repaired(turns.select("conv", F.struct("mid", "part").alias("place"), "t.*"), report)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns come by conversation, in order; one hash is carried at a time."""
    conv, sha, kind = None, None, None
    for b in batches:
        kind, done = b.schema.field("conv").type, []
        for c, line in zip(b.column("conv").to_pylist(), b.column("line").to_pylist()):
            if sha is None or c != conv:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(line.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done])], ["conv", "sha"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([sha.hexdigest()])], ["conv", "sha"])


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 of the ``role:text`` of a conversation's turns, newline-joined.  A hash
    is one chain, so a conversation's turns pass through one task, a batch at a time."""
    lines = turns.select("conv", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(
        _hashed, StructType(schema("", conv=turns.schema["conv"].dataType).fields + StructType.fromDDL("sha string").fields))


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with the contract's faults, dealt by crc32 of ``conv_id:turn`` modulo 20."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), h.alias("_h"))
    rows = rows.where("_h <> 0").select(
        "conv_id", "turn", F.when(F.col("_h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"))
    return rows.drop("_copy")


def op12(spark, sf_dir: str) -> DataFrame:
    """Contract query: all of ``conversations``, damaged, then repaired."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    fixed = repair(damage(conversations))
    every = conversations.select("conv_id").distinct()
    out = every.join(fixed.report, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    out = out.join(digests(fixed.turns), F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(_EMPTY_SHA)).alias("repaired_sha256"))


#: The same in DuckDB SQL: the dynamic programme runs turn by turn over the states.
OP12_SQL = r"""
WITH RECURSIVE
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS MATERIALIZED (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(key, ''),
              lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END),
          CAST(4294967295 AS BIGINT)) % 20 AS h FROM k),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE h WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE h <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tail FROM d),
f AS MATERIALIZED (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS ini,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev,
         CASE WHEN tail = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(tail, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'c' END AS fault FROM r),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         sum(CASE WHEN fault = 'b' THEN 1 ELSE 0 END) AS blank, sum(CASE WHEN fault = 'd' THEN 1 ELSE 0 END) AS duplicate,
         sum(CASE WHEN fault = 't' THEN 1 ELSE 0 END) AS truncated,
         sum(CASE WHEN prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal,
         max(i) AS n FROM f GROUP BY conv_id),
ins(p, mark, line, p2, cost) AS (VALUES (0, '', '', 0, 0), (0, 'I', chr(10) || 'user:', 2, 5),
  (0, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 3, 10), (1, '', '', 1, 0), (1, 'I', chr(10) || 'user:', 2, 5),
  (1, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 3, 10), (2, '', '', 2, 0), (2, 'I', chr(10) || 'assistant:', 3, 5),
  (3, '', '', 3, 0), (3, 'I', chr(10) || 'user:', 2, 5)),
edit(p2, mark, ini, role, q, cost) AS (VALUES (0, 'D', NULL, NULL, 0, 2), (1, 'D', NULL, NULL, 1, 2), (2, 'D', NULL, NULL, 2, 2),
  (3, 'D', NULL, NULL, 3, 2), (0, 'K', 's', NULL, 1, 0), (0, 'K', 'u', NULL, 2, 0), (1, 'K', 'u', NULL, 2, 0), (2, 'K', 'a', NULL, 3, 0),
  (3, 'K', 'u', NULL, 2, 0), (0, 'R', NULL, 'user', 2, 1), (1, 'R', NULL, 'user', 2, 1), (2, 'R', NULL, 'assistant', 3, 1),
  (3, 'R', NULL, 'user', 2, 1)),
step AS MATERIALIZED (
  SELECT ins.p, edit.q, edit.ini, edit.role, ins.mark || edit.mark AS mark, ins.line, edit.mark AS e, ins.cost + edit.cost AS cost
  FROM ins JOIN edit ON ins.p2 = edit.p2),
dp(conv_id, i, p, cost, audit, out) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, 0, '', '' FROM counts
  UNION ALL
  SELECT f.conv_id, f.i, s.q, dp.cost + s.cost + CASE WHEN f.fault = 't' AND s.e <> 'D' THEN 5 ELSE 0 END AS cost,
         dp.audit || s.mark AS audit,
         dp.out || s.line || CASE WHEN s.e = 'D' THEN '' ELSE chr(10) || coalesce(s.role, f.role) || ':' || f.text END
  FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1
          JOIN step s ON s.p = dp.p AND (s.e = 'D' OR f.fault IN ('t', 'c') AND (s.e = 'R' OR s.ini = f.ini))
  QUALIFY row_number() OVER (PARTITION BY f.conv_id, s.q ORDER BY dp.cost + s.cost + CASE WHEN f.fault = 't' AND s.e <> 'D' THEN 5 ELSE 0 END,
                                                                  dp.audit || s.mark) = 1),
ends AS (
  SELECT c.conv_id, dp.cost + CASE dp.p WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END AS cost,
         dp.audit || CASE dp.p WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
         dp.out || CASE dp.p WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END AS out
  FROM counts c JOIN dp ON dp.conv_id IS NOT DISTINCT FROM c.conv_id AND dp.i = c.n),
done AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(x.cost, 0) AS BIGINT) AS cost,
       coalesce(x.audit, '') AS audit, sha256(coalesce(substr(x.out, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""
