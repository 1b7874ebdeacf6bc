import duckdb
import pytest
from pyspark.sql import functions as F

from noema.llm import preference_format as P

TURNS = "conv_id bigint, turn bigint, role string, text string"


def render(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def brute_pair(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    prompt = render(chosen[:n])

    def side(turns):
        text, spans = "", []
        for r, t in turns[n:]:
            text += f"<|{r}|>\n"
            if r == "assistant":
                spans.append([len(prompt) + len(text), len(prompt) + len(text) + len(t)])
            text += f"{t}<|end|>\n"
        return text, spans
    (c, cs), (r, rs) = side(chosen), side(rejected)
    return n, len(chosen) - n, len(rejected) - n, prompt, c, r, cs, rs


def brute_pairs(data):
    convs = {}
    for i, n, r, t in set(data):
        if i is not None:
            convs.setdefault(i, []).append((n is not None, n or 0, r if r is not None else "none", t or ""))
    convs = {i: [(r, t) for _, _, r, t in sorted(set(v))] for i, v in convs.items()}
    out = []
    for i, turns in convs.items():
        later = sorted(j for j in convs if j > i and convs[j][0] == turns[0])
        if later:
            kind, other = "sibling", convs[later[0]]
        else:
            kind, at = "earlier_reply", [k for k, (r, _) in enumerate(turns) if r == "assistant"]
            other = list(turns)
            if len(at) == 1:
                del other[at[0]]
            elif at:
                other[at[-1]] = ("assistant", turns[at[-2]][1])
        out.append((i, kind, *brute_pair(turns, other)))
    return sorted(out)


def corpus():
    u, a = "user", "assistant"
    convs = [[(u, "hi"), (a, "hello"), (u, "été?"), (a, "oui 日本")], [(u, "hi"), (a, "hello"), (u, "été?"), (a, "non")],
             [(u, "hi"), (a, "bye")], [(u, "hi"), (a, "hello")], [(u, "solo")], [(a, "one")], [("system", "s"), (u, "x"), (a, "1"), (a, "2")],
             [(None, None), (a, "r")], [(u, ""), (a, "")], [(u, "long " * 20000), (a, "y")], [(u, "same"), (a, "z")], [(u, "same"), (a, "z")]]
    data = [(7 * i + 1, k, r, t) for i, c in enumerate(convs) for k, (r, t) in enumerate(c)]
    data += [(None, 0, u, "lost"), (1, 0, u, "hi"), (500, 1, u, "b"), (500, 1, u, "a"), (500, None, a, "first")]
    return data


def test_same_as_brute_force(spark):
    df = spark.createDataFrame(corpus(), TURNS).withColumn("id", F.lit("x")).withColumn("chosen", F.lit(1)).repartition(4)
    out = P.format_pairs(P.pairs_from_conversations(P.conversations(df)))
    assert sorted(tuple(r) for r in out.collect()) == brute_pairs(corpus())


def test_pairs_of_two_tables_and_nulls(spark):
    t = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")], [("user", "a")]), (2, None, [("user", "q")]), (3, [], None)],
                               f"id bigint, chosen {t}, rejected {t}")
    got = {r.id: r for r in P.format_pairs(df).collect()}
    assert (got[1].prompt, got[1].chosen, got[1].rejected) == (render([("user", "a")]), render([("assistant", "b")]), "")
    assert got[2].rejected == render([("user", "q")]) and got[3].prompt == got[3].chosen == got[3].rejected == ""


def test_empty(spark):
    none = spark.createDataFrame([], TURNS)
    assert P.format_pairs(P.pairs_from_conversations(P.conversations(none))).collect() == []


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_its_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    df, rel = P.op6(spark, d), con.sql(P.OP6_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = (sorted(tuple(r) for r in x) for x in (df.select(*rel.columns).collect(), rel.fetchall()))
    assert got == want


def test_fixture_equals_its_sql(spark, tmp_path):
    spark.createDataFrame(corpus(), TURNS).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    df, rel = P.op6(spark, str(tmp_path)), con.sql(P.OP6_SQL)
    assert sorted(tuple(r) for r in df.select(*rel.columns).collect()) == sorted(rel.fetchall())
