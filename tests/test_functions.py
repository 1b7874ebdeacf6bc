"""Column-function cases from FIXTURES."""

from pyspark.sql import functions as F

from noema.functions import jsonx as J, lists as L, text as X


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_parse_to_list(spark):
    cases = {"['a', 'b']": ["a", "b"], "a, b": ["a", "b"], "": [], None: [],
             "['a', b]": ["['a'", "b]"], "['it\\'s']": ["it's"], "[1, 'x']": ["1", "x"],
             '["a", "b\'s"]': ["a", "b's"], "['a',]": ["a"]}
    for text, want in cases.items():
        assert one(spark, L.parse_to_list, text) == want, text


def test_listlike_and_literal(spark):
    assert one(spark, L.listlike, "('a', 'b')") == ["a", "b"]
    assert one(spark, L.listlike, "  x ") == ["x"]
    assert one(spark, L.listlike, "  ") == []
    assert one(spark, L.literal_or_empty, "a, b") == []
    assert one(spark, L.literal_or_empty, "['x']") == ["x"]


def test_strip_matches_python(spark):
    s = "　\t a b\xa0\x1c"
    assert one(spark, X.strip, s) == s.strip()
    assert one(spark, X.norm, "  Back \t propagation ") == "back propagation"


def test_link_encoders(spark):
    from urllib.parse import quote
    names = ["Gödel's completeness theorem", "Alpha–beta pruning", "C++ (language)", "a~b*c", "x/y:z,w", "100%"]
    for n in names:
        assert one(spark, X.name_link, n) == X.WIKI_PREFIX + quote(n.strip().replace(" ", "_"), safe="()'_-")
        assert one(spark, X.path_quote, n) == quote(n.replace(" ", "_"), safe="()_-.,:")
        assert one(spark, X.page_link, n) == X.WIKI_PREFIX + quote(n.replace(" ", "_"), safe="")
    assert one(spark, X.name_link, "   ") is None


def test_title_from_url(spark):
    assert one(spark, X.title_from_url, "https://en.wikipedia.org/wiki/Chain_rule/?x=1#top") == "Chain_rule"
    assert one(spark, X.title_from_url, "https://en.wikipedia.org/wiki/Backpropagation#History") == "Backpropagation"


def test_categories_and_cleanups(spark):
    df = spark.createDataFrame([(["CS"], [{"category": "CS", "source": "x"}, {"category": "Math", "source": "y"},
                                          {"category": None, "source": "z"}]), (None, None)],
                               "f array<string>, s array<struct<category:string,source:string>>")
    got = [r["c"] for r in df.select(L.categories_of("f", "s").alias("c")).collect()]
    assert got == [["CS", "Math"], []]
    xs = [" a ", "a", "", "b" * 81, "b" * 80]
    assert one(spark, L.clean_concepts, xs, "v array<string>") == list(dict.fromkeys(x.strip() for x in xs if x and x.strip()))
    assert one(spark, lambda c: L.clean_concepts(c, 80), xs, "v array<string>") == ["a", "b" * 80]
    assert all(len(x) > 80 for x in one(spark, lambda c: L.long_concepts(c, 80), xs, "v array<string>"))
    r = spark.createDataFrame([(["x", " x ", "y", "N", ""], "N")], "a array<string>, n string") \
        .select(L.clean_aliases("a", "n").alias("r")).first()["r"]
    assert r == ["x", "y"]
    r = spark.createDataFrame([(["a", "b"], ["b", "c", "c", None])], "c array<string>, n array<string>") \
        .select(L.append_new("c", "n").alias("r")).first()["r"]
    assert r == ["a", "b", "c", "c"]


def test_one_line(spark):
    assert one(spark, X.one_line, "  a\n b ") == "a b."
    assert one(spark, X.one_line, "a?") == "a?"
    assert one(spark, X.one_line, "   ") == ""


def test_extract_json_fixture():
    f = lambda t: J.typed_fields(J.extract_json(t))
    assert f('<think>x {"a":0}</think>{"alias":["A"]}')["alias"] == ["A"]
    r = f('prose ```json {"strength":0.9,"reason":"r"} ``` more')
    assert (r["strength"], r["reason"], r["has_strength_or_reason"]) == (0.9, "r", True)
    assert f('``` {"alias":["A"] ```')["alias"] == ["A"]
    assert f('text {"strength": 1.7} tail')["strength"] == 1.7
    assert f('{"alias":["A","B"]')["alias"] == ["A", "B"]
    r = f('{"strength":true,"reason":"  "}')
    assert r["strength"] == 1.0 and r["reason"] == "  "
    r = f('{"strength":"0.5"}')
    assert r["strength"] is None and r["has_strength_or_reason"] is True
    assert f('{"a":1} and {"b":2}')["is_object"] is False
    for t in ["[1,2]", "", None, "no json"]:
        assert f(t)["is_object"] is False


def test_model_output_columns(spark):
    df = spark.createDataFrame([('text {"strength": 1.7} tail',), ('{"strength":NaN}',), ('{"strength":true}',),
                                ('{"reason":" r "}',)], "raw string")
    out = J.with_parsed(df, "raw", tuple(J.PARSED.fieldNames())).select(
        J.clamp01(F.col("p.strength")).alias("s"), X.reason_clean(F.col("p.reason")).alias("r"),
        F.col("p.has_strength_or_reason").alias("ok")).collect()
    assert [(r["s"], r["r"], r["ok"]) for r in out] == [(1.0, None, True), (1.0, None, True), (1.0, None, True),
                                                      (None, "r", True)]


def test_ranked_items_defaults(spark):
    r = one(spark, L.ranked_items, '[{"rank":1,"topic":"a","rationale":"r"},{"topic":"b"}]')
    assert [tuple(x) for x in r] == [(1, "a", "r"), (0, "b", "")]
