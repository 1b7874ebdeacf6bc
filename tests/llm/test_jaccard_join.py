import random

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from noema.llm import jaccard_join as J

DOCS = "doc_id bigint, text string"


def shingles(text, k=5):
    w = brute.words(text)
    return frozenset(tuple(w[s:s + k]) for s in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_force(docs, threshold=0.8):
    sets = [shingles(t) for _, t in docs]
    ids = [i for i, _ in docs]
    n = len(docs)
    near = [[j for j in range(n) if j != i and sets[i] and sets[j]
             and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        cls = min([ids[i]] + [ids[j] for j in near[i] if sets[j] == sets[i]])
        comp = min(ids[j] for j in seen)
        out.append((ids[i], cls, len(near[i]), comp, comp == ids[i]))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice("sea rain of the Stone été x".split()) + str(rng.randint(0, 40)) for _ in range(n)]
    docs = []
    for _ in range(6):
        base = prose(rng.choice([30, 80, 200, 400]))
        docs.append(" ".join(base))
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "edit" + str(rng.randint(0, 99))
            docs.append(" ".join(w))
    docs += [docs[0], docs[0].upper(), docs[3], None, "", "", "one two", "one two", "...", "one two three four five six"]
    docs += [" ".join(prose(60)) for _ in range(10)]
    rng.shuffle(docs)
    return [(3 * i + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed, rows, size", [(1, 1024, 1 << 20), (2, 3, 1 << 20), (3, 1024, 600)])
def test_same_as_brute_force(spark, seed, rows, size):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, DOCS).withColumn("rid", F.lit(1)).withColumn("nodes", F.lit("x")).repartition(3)
    got = sorted(tuple(r) for r in J.near_duplicates(df, block_rows=rows, block_bytes=size).drop("text_key").collect())
    assert got == brute_force(docs)


def test_repeated_and_null_ids(spark):
    long = "a b c d e f g h i j"
    docs = [(1, long), (1, long), (1, long + " z"), (None, long), (2, None), (2, None), (None, "")]
    got = sorted((tuple(r) for r in J.near_duplicates(spark.createDataFrame(docs, DOCS)).drop("text_key").collect()), key=repr)
    assert len(got) == 7
    # (1, long) counts once; (1, long + z) shares 6 of 7 shingles; the null id comes last
    assert [(r[2], r[3]) for r in got if r[0] == 1] == [(2, 1)] * 3
    assert [r[2:] for r in got if r[0] is None and r[2]] == [(2, 1, False)]
    assert [r for r in got if r[0] == 2] == [(2, 2, 0, 2, True)] * 2


def test_empty_table_and_depth(spark):
    assert J.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    assert J.matched_depth(0.8, 24, 10, 0.999) == 6 and J.matched_depth(0.8, 24, 10, 0.9) == 10


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_its_sql(spark, sf):
    """The exact join: recall is 1 on these tables."""
    d = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    df, rel = J.op5(spark, d), con.sql(J.OP5_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = (sorted(tuple(r) for r in x) for x in (df.select(*rel.columns).collect(), rel.fetchall()))
    assert got == want and any(not r[rel.columns.index("kept")] for r in got)


def test_keep_one_of_each(spark):
    docs = corpus(4)
    df = spark.createDataFrame(docs, DOCS).withColumn("kept", F.lit("x"))
    got = sorted((r.doc_id, r.text) for r in J.keep_one_of_each(df).collect())
    assert got == sorted((r[0], dict(docs)[r[0]]) for r in brute_force(docs) if r[4])
    twice = docs + docs[:9] + [(None, "a b c d e f"), (None, "a b c d e f")]
    out = J.keep_one_of_each(spark.createDataFrame(twice, DOCS)).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out))) == sorted(map(repr, [*got, (None, "a b c d e f")]))


def test_rows_of_equal_id_and_text_do_not_depend_on_partitions(spark):
    text = "a b c d e f g h i j"
    docs = [(1, text, f"s{i}") for i in range(9)] + [(2, None, "x"), (2, None, None)]
    df = spark.createDataFrame(docs, DOCS + ", source string")
    got = {tuple(sorted(map(repr, J.keep_one_of_each(df.repartition(n)).collect()))) for n in (1, 4)}
    assert len(got) == 1 and "source='s0'" in str(got)


@pytest.mark.parametrize("parts", [1, 5])
def test_forest_links_rows_of_common_prefixes(spark, parts):
    """Rows joined by links of d values or more are those that share d values in a tree."""
    rng = random.Random(parts)
    key = lambda: b"".join(rng.choice([0, 1]).to_bytes(4, "big") for _ in range(4))
    rows = [(i, [key() for _ in range(3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "rid bigint, leaves array<binary>").repartition(parts)
    links = [tuple(r) for r in J._forest(df, 4, 2).collect()]
    for d in (2, 3, 4):
        for a, b, common in links:
            x, y = rows[a][1], rows[b][1]
            assert common == max(c for c in range(5) if any(p[:4 * c] == q[:4 * c] for p, q in zip(x, y))
                                 and c <= common), (a, b, common)
        root = {i: i for i, _ in rows}
        find = lambda i: i if root[i] == i else find(root[i])
        for a, b, common in links:
            if common >= d:
                root[find(a)] = find(b)
        for i, x in rows:
            for j, y in rows:
                if any(p[:4 * d] == q[:4 * d] for p, q in zip(x, y)):
                    assert find(i) == find(j)


def test_prefixes_are_shortened_by_what_is_found(spark, monkeypatch):
    used = []
    verified = J._verified
    monkeypatch.setattr(J, "_verified", lambda edges, *a: used.append(edges.agg(F.min("common")).first()[0]) or verified(edges, *a))
    words = [f"w{i}" for i in range(400)]
    edit = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(words))
    docs = [(1, edit()), (2, edit(7)), (3, edit(300))]
    got = [tuple(r) for r in J.near_duplicates(spark.createDataFrame(docs, DOCS)).drop("text_key").collect()]
    assert sorted(got) == brute_force(docs) and min(used) == 10   # only strong links: no prefix is shortened
    used.clear()
    docs += [(4, edit(*range(0, 200, 25), 399))]
    got = [tuple(r) for r in J.near_duplicates(spark.createDataFrame(docs, DOCS)).drop("text_key").collect()]
    assert sorted(got) == brute_force(docs) and min(used) < 10


def test_very_long_texts(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(50000)}" for _ in range(120000)]
    other = list(words)
    other[1000] = "edit"
    docs = [(1, " ".join(words)), (2, " ".join(other)), (3, "word " * 100000), (4, "word " * 90000)]
    got = sorted(tuple(r) for r in J.near_duplicates(spark.createDataFrame(docs, DOCS)).drop("text_key").collect())
    assert got == brute_force(docs)
