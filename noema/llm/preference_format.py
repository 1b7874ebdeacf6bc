"""Preference pairs for chat models.

For each pair of a chosen and a rejected conversation: the longest common prefix of
their turns is rendered once as the prompt, and what remains of each is rendered as
its completion, with the character spans (of prompt plus completion) that a loss
looks at.  Only the words of assistant turns of the completion are in them; prompt,
role headers and other roles are masked out.

Built-in expressions only: the turns of a conversation meet in one array (a
conversation is one example), and pairs are an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from noema.llm.store import columns
from noema.operators.rows import with_global_index

ASSISTANT = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(id, turns): the sorted turns, array<struct<turn, role, text>>, of each conversation.

    Turns without a conversation id are left out.  Equal turn numbers are in the order of
    role and text; a turn that is repeated in all of them counts once.  A null turn
    number comes first, a null role is ``none``, a null text is empty.
    """
    t = columns(turns, id=id_col, turn=turn_col, role=role_col, text=text_col).where("id is not null")
    t = t.select("id", F.struct("turn", F.coalesce("role", F.lit("none")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text")).alias("t")).distinct()
    return t.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: _render(t["role"], t["text"])), "")


def _spans(turns: Column, base: Column) -> Column:
    """array<array<bigint>>: (start, stop) of the assistant words, from ``base`` on."""
    def step(acc, t):
        head = acc["at"] + F.length(t["role"]) + 5  # "<|" role "|>" line end
        span = F.array(head.cast("bigint"), (head + F.length(t["text"])).cast("bigint"))
        return F.struct((acc["at"] + F.length(_render(t["role"], t["text"]))).cast("bigint").alias("at"),
                        F.when(t["role"] == ASSISTANT, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))
    start = F.struct(base.cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("spans"))
    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(id, chosen, rejected: arrays of turns, other columns) -> the other columns and
    prompt_turns, chosen_turns, rejected_turns, prompt, chosen, rejected, chosen_spans,
    rejected_spans.

    Turns are equal if role and text are.  If one conversation begins with all of
    the other (or both are equal), the shorter one's completion is empty.  A null
    conversation has no turns.  An empty table gives an empty result.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    plain = lambda c: F.coalesce(F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), none)
    p = pairs.withColumn("chosen", plain("chosen")).withColumn("rejected", plain("rejected"))
    least = F.least(F.size("chosen"), F.size("rejected"))
    head = lambda c: F.slice(c, F.lit(1), least)
    same = F.zip_with(head("chosen"), head("rejected"), lambda x, y: x == y)
    differs = F.array_position(same, F.lit(False))
    p = p.withColumn("prompt_turns", F.when(differs > 0, differs - 1).otherwise(least).cast("bigint"))
    rest = lambda c: F.slice(c, F.col("prompt_turns").cast("int") + 1, F.size(c))
    p = p.withColumn("prompt", _text(F.slice("chosen", F.lit(1), F.col("prompt_turns").cast("int"))))
    p = p.withColumn("chosen", rest("chosen")).withColumn("rejected", rest("rejected"))
    others = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    base = F.length("prompt")
    return p.select(*others, "prompt_turns", F.size("chosen").cast("bigint").alias("chosen_turns"),
                    F.size("rejected").cast("bigint").alias("rejected_turns"), "prompt",
                    _text(F.col("chosen")).alias("chosen"), _text(F.col("rejected")).alias("rejected"),
                    _spans(F.col("chosen"), base).alias("chosen_spans"),
                    _spans(F.col("rejected"), base).alias("rejected_spans"))


def pairs_from_conversations(convs: DataFrame) -> DataFrame:
    """(id, turns) -> (id, kind, chosen, rejected): every conversation is the chosen
    side once.  Its rejected side is the next conversation (by id) with the same first
    turn (kind ``sibling``), or, in the last one of such a group, the conversation
    itself with the last assistant turn's text replaced by that of the assistant turn
    before, or without it if it is the only one (kind ``earlier_reply``).  A
    conversation without assistant turns is paired with itself.

    Siblings are found by a distributed row index over (first turn, id), not by a window
    over a group, so a first turn that many conversations share is spread.
    """
    first = lambda t: F.struct(F.col(t)[0]["role"], F.col(t)[0]["text"])
    keyed = convs.select("id", F.xxhash64(first("turns")).alias("k1"), F.xxhash64(F.lit(1), first("turns")).alias("k2"))
    at = with_global_index(keyed, ["k1", "k2", "id"], "at")
    nxt = at.select((F.col("at") - 1).alias("prev"), F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("id").alias("next_id"))
    link = at.join(nxt, (F.col("at") == F.col("prev")) & (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")))
    sibling = convs.select(F.col("id").alias("s"), F.col("turns").alias("sibling"))
    both = convs.join(link.select(F.col("id").alias("i"), "next_id"), F.col("id") == F.col("i"), "left") \
        .join(sibling, F.col("next_id") == F.col("s"), "left")
    # grouped by two hashes; the turns themselves decide
    same = F.coalesce(first("turns") == first("sibling"), F.lit(False))
    places = F.filter(F.transform("turns", lambda t, k: F.when(t["role"] == ASSISTANT, k)), lambda k: k.isNotNull())
    both = both.withColumn("places", places)
    last, before = F.col("places")[F.size("places") - 1], F.col("places")[F.size("places") - 2]
    swapped = F.when(F.size("places") == 0, F.col("turns")) \
        .when(F.size("places") == 1, F.filter("turns", lambda t, k: k != last)) \
        .otherwise(F.transform("turns", lambda t, k: F.when(
            k == last, F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.col("turns")[before]["text"].alias("text")))
            .otherwise(t)))
    return both.select("id", F.when(same, "sibling").otherwise("earlier_reply").alias("kind"),
                       F.col("turns").alias("chosen"),
                       F.when(same, F.col("sibling")).otherwise(swapped).alias("rejected"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Whole ``conversations``: one formatted pair for each conversation; spans as text."""
    convs = conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    out = format_pairs(pairs_from_conversations(convs))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s[0].cast("string"), s[1].cast("string"))), ",")
    return out.withColumn("chosen_spans", text("chosen_spans")).withColumn("rejected_spans", text("rejected_spans")) \
        .withColumnRenamed("id", "conv_id")


#: The same pairs in DuckDB SQL, by window functions.
OP6_SQL = r"""
WITH t AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, role, text
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'none') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
sib AS MATERIALIZED (SELECT conv_id, lead(conv_id) OVER (PARTITION BY role, text ORDER BY conv_id) AS next_id FROM t WHERE p = 1),
asst AS MATERIALIZED (
  SELECT conv_id, p, text, row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) AS back FROM t WHERE role = 'assistant'),
rej AS MATERIALIZED (
  SELECT sib.conv_id, t.p, t.role, t.text FROM sib JOIN t ON t.conv_id = next_id
  UNION ALL
  SELECT t.conv_id, row_number() OVER (PARTITION BY t.conv_id ORDER BY t.p), t.role, CASE WHEN t.p = a.p THEN b.text ELSE t.text END
  FROM sib JOIN t ON t.conv_id = sib.conv_id LEFT JOIN asst a ON a.conv_id = t.conv_id AND a.back = 1
       LEFT JOIN asst b ON b.conv_id = t.conv_id AND b.back = 2
  WHERE next_id IS NULL AND NOT (a.p IS NOT NULL AND t.p = a.p AND b.p IS NULL)),
cmp AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.p, r.p) AS p,
         coalesce(c.role = r.role AND c.text = r.text, false) AS same
  FROM t c FULL JOIN rej r ON c.conv_id = r.conv_id AND c.p = r.p),
pre AS MATERIALIZED (
  SELECT conv_id, coalesce(min(CASE WHEN NOT same THEN p END) - 1, max(p)) AS n FROM cmp GROUP BY conv_id),
side AS MATERIALIZED (
  SELECT 'c' AS side, * FROM t UNION ALL SELECT 'r', * FROM rej),
ren AS MATERIALIZED (
  SELECT side, conv_id, p, n, role, text, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS s,
         coalesce(sum(length('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10)))
           OVER (PARTITION BY side, conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM side JOIN pre USING (conv_id)),
agg AS MATERIALIZED (
  SELECT side, conv_id, coalesce(string_agg(CASE WHEN p <= n THEN s END, '' ORDER BY p), '') AS prompt,
         coalesce(string_agg(CASE WHEN p > n THEN s END, '' ORDER BY p), '') AS body, count(*) FILTER (p > n) AS k,
         coalesce(string_agg(CASE WHEN p > n AND role = 'assistant' THEN
           CAST(off + length(role) + 5 AS BIGINT) || '-' || CAST(off + length(role) + 5 + length(text) AS BIGINT) END, ',' ORDER BY p), '') AS spans
  FROM ren GROUP BY side, conv_id)
SELECT sib.conv_id, CASE WHEN next_id IS NULL THEN 'earlier_reply' ELSE 'sibling' END AS kind, CAST(pre.n AS BIGINT) AS prompt_turns,
       coalesce(c.k, 0) AS chosen_turns, coalesce(r.k, 0) AS rejected_turns, coalesce(c.prompt, '') AS prompt, coalesce(c.body, '') AS chosen,
       coalesce(r.body, '') AS rejected, coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM sib JOIN pre USING (conv_id) LEFT JOIN agg c ON c.conv_id = sib.conv_id AND c.side = 'c'
     LEFT JOIN agg r ON r.conv_id = sib.conv_id AND r.side = 'r'
"""
