"""N-gram Jaccard join with a MinHash LSH forest.

Documents are sets of word shingles.  Documents with equal sets are one class,
and the smallest document of a class stands for it from then on.

The forest: a document has ``depth`` MinHash values in each of ``trees`` trees.  The
rows of a tree are sorted by these values (a range sort, so equal prefixes of any
number are spread), which makes them the leaves of a prefix trie: a row and the one
before it share a prefix of some length, and rows share one of length ``d`` when all
rows between them do.  One pass over the sorted rows gives each row's link to the row
before it, with the length of their common prefix.

Matching begins with the longest prefixes and shortens them by what it finds.  The
links of at least ``d`` common values join documents into candidate groups, which are
verified exactly.  A pair of similarity ``s`` is found at length ``d`` with
probability ``1 - (1 - s^d)^trees``.  While that is below ``recall`` for the weakest
resemblance seen so far, ``d`` is shortened to the longest prefix that reaches it, and
the groups that grew are verified again.  Pairs of 3/4 of the threshold and more
count as resemblance, so that the threshold itself is taken as soon as anything near it
is seen; if nothing is seen at all, it is taken too.  Prefixes are therefore never
shorter than the threshold asks for (6 with the defaults), and about 0.07% of pairs
just at 0.8 meet in no tree; such a pair is lost unless other documents connect it.

All pairs of a group are verified by counting common shingles: members are dealt
into blocks of bounded number and bytes, and each pair of blocks is a task of its
own, so a group of a third of all rows is spread.  Pairs are counted where they
are verified; what leaves a task is a number of links for each document and a
spanning forest of the verified links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from noema.llm import textcore as T
from noema.llm.components import components
from noema.llm.pairs import LINKS, block_pairs, by_task, links_of
from noema.llm.store import columns, table, with_row_order

SHINGLE, THRESHOLD, TREES, DEPTH, RECALL = 5, 0.8, 24, 10, 0.999
BLOCK_ROWS, BLOCK_BYTES = 1024, 8 << 20
_COLUMNS = 2048  # shingles counted at once
_VALUE = 4  # bytes of a MinHash value in a key
_NEAR = 0.75  # of the threshold: what counts as resemblance


def matched_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix that gives the target recall at the threshold."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold ** d) ** trees >= recall:
            return d
    return 1


def _sets(w: T.Words, docs: int, k: int):
    """Distinct shingles of each document: (document, id), sorted, and set sizes."""
    ids, at = T.shingle_ids(w, k)
    doc = w.doc[at]
    order = np.lexsort((ids, doc))
    ids, doc = ids[order], doc[order]
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] != ids[:-1]) | (doc[1:] != doc[:-1])
    ids, doc = ids[keep], doc[keep]
    return doc, ids, np.bincount(doc, minlength=docs)


def _signatures(k: int, trees: int, depth: int):
    """(rid, text_key, size, set1, set2, leaves, bytes): two names of the set, and its
    leaf in each tree: ``depth`` values of four bytes, most significant first."""
    factor = T.mix(np.arange(1, trees * depth + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in T.runs(b.column("text")):
                n = hi - lo
                doc, ids, size = _sets(T.words(data, offsets), n, k)
                some = np.flatnonzero(size)
                set1, set2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                value = np.zeros((len(some), trees * depth), ">u4")
                if len(some):
                    head = np.searchsorted(doc, some)
                    set1[some] = np.add.reduceat(T.mix(ids), head)
                    set2[some] = np.add.reduceat(T.mix(~ids), head)
                    for i, f in enumerate(factor):
                        value[:, i] = T.mix(np.minimum.reduceat(ids * f, head)) >> np.uint64(32)
                cut = pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, trees, 0))]).astype(np.int32))
                ends = np.arange(len(some) * trees + 1, dtype=np.int32) * np.int32(depth * _VALUE)
                leaves = pa.Array.from_buffers(pa.binary(), len(some) * trees,
                                               [None, pa.py_buffer(ends), pa.py_buffer(value.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [b.column("rid").slice(lo, n), b.column("text_key").slice(lo, n),
                     pa.array(size.astype(np.int64)), T.as_long(set1),
                     T.as_long(set2), pa.ListArray.from_arrays(cut, leaves),
                     pa.array(np.diff(offsets))],
                    ["rid", "text_key", "size", "set1", "set2", "leaves", "bytes"])
    return run


def _neighbours(depth: int, least: int):
    """Rows (tree, leaf, rid) of a sorted partition; out: each row's link to the row
    before it (a, b, common) if they share ``least`` values, and the first and the last
    row of the partition (part, tree, leaf, a), to be linked across partitions."""
    names = ["a", "b", "common", "part", "tree", "leaf"]

    def edges(part: int, ends: list[tuple[int, bytes, int]]) -> pa.RecordBatch:
        tree, leaf, rid = zip(*ends)
        none = pa.nulls(len(ends), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(rid, pa.int64()), none, pa.nulls(len(ends), pa.int32()), pa.array([part] * len(ends), pa.int32()),
             pa.array(tree, pa.int32()), pa.array(leaf, pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            tree = b.column("tree").to_numpy()
            rid = b.column("rid").to_numpy()
            leaf = b.column("leaf").cast(pa.binary())
            value = np.frombuffer(b"".join(leaf.to_pylist()), ">u4").reshape(n, depth)
            ends = (int(tree[-1]), leaf[n - 1].as_py(), int(rid[-1]))
            if last is None:
                yield edges(part, [(int(tree[0]), leaf[0].as_py(), int(rid[0]))])
            else:  # the row before this batch comes first
                tree, rid = np.append(last[0], tree), np.append(last[2], rid)
                value = np.concatenate([np.frombuffer(last[1], ">u4")[None, :], value])
            last = ends
            same = (value[1:] == value[:-1]) & (tree[1:] == tree[:-1])[:, None]
            common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
            at = np.flatnonzero(common >= least)
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[at + 1]), pa.array(rid[at]), pa.array(common[at].astype(np.int32)),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if last is not None:
            yield edges(part, [last])
    return run


def _forest(reps: DataFrame, depth: int, least: int) -> DataFrame:
    """(a, b, common): neighbours in the sorted tries that share ``least`` values or more."""
    leaves = reps.select("rid", F.posexplode("leaves").alias("tree", "leaf"))
    out = table(leaves.repartitionByRange("tree", "leaf", "rid").sortWithinPartitions("tree", "leaf", "rid").mapInArrow(
        _neighbours(depth, least), "a bigint, b bigint, common int, part int, tree int, leaf binary"), "neighbours")
    # two rows a partition: the last of one and the first of the next that has rows
    order = Window.orderBy("part", "tree", "leaf", "a")
    ends = out.where("part is not null").select(
        "a", "part", *[F.lag(c).over(order).alias(f"{c}_") for c in ("a", "part")],
        *[F.when(F.lag("tree").over(order) == F.col("tree"), F.lag("leaf").over(order)).alias("before")], "leaf")
    prefix = lambda c, d: F.substring(c, 1, _VALUE * d)
    common = F.coalesce(*[F.when(prefix("leaf", d) == prefix("before", d), F.lit(d)) for d in range(depth, least - 1, -1)])
    across = ends.where("part <> part_").select("a", F.col("a_").alias("b"), common.alias("common")).where("common is not null")
    return table(out.where("common is not null").select("a", "b", "common").unionAll(across), "forest")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        for lo, hi, data, offsets in T.runs(b.column("text")):
            packed = [z.compress(data[i:j]) for i, j in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column("rid").slice(lo, hi - lo), pa.array(packed, pa.binary())],
                                             ["rid", "packed"])


def _common(doc: np.ndarray, ids: np.ndarray, n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common shingles of each left and right document, as a matrix."""
    _, at, times = np.unique(ids, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    to = np.full(len(times), -1)
    to[shared] = np.arange(len(shared))
    col = to[at]
    doc, col = doc[col >= 0], col[col >= 0]
    order = np.argsort(col, kind="stable")
    doc, col = doc[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, len(shared), _COLUMNS):
        x, y = np.searchsorted(col, [c, c + _COLUMNS])
        m = np.zeros((n, min(_COLUMNS, len(shared) - c)), np.float32)
        m[doc[x:y], col[x:y] - c] = 1
        out += m[left] @ m[right].T
    return out


def _verify(k: int, threshold: float):
    """Rows sorted by task (grp, i, j); out: (rid, links, root, grp, weakest), the last the
    least resemblance in the task.  A task without links may have a row of no links."""
    def work(t: pa.Table):
        z = zstandard.ZstdDecompressor()
        texts = [z.decompress(x) for x in t["packed"].to_pylist()]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        rid, copies, block = (t[c].to_numpy() for c in ("rid", "copies", "block"))
        n, i, j = len(rid), t["i"][0].as_py(), t["j"][0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):
            return None
        doc, ids, size = _sets(T.words(data, offsets), n, k)
        common = _common(doc, ids, n, left, right).astype(np.float64)
        similar = common / (size[left][:, None] + size[right][None, :] - common)
        if i == j:
            np.fill_diagonal(similar, 0)
        weakest = similar.min(initial=2, where=similar >= threshold * _NEAR)
        if weakest > 1:
            return None
        out = links_of(similar >= threshold, left, right, i == j, rid, copies)
        if not out.num_rows:
            out = pa.RecordBatch.from_arrays([pa.array(rid[:1]), pa.array([0]), pa.array(rid[:1])], out.schema.names)
        m = out.num_rows
        return pa.RecordBatch.from_arrays([*out.columns, pa.array(np.full(m, t["grp"][0].as_py())),
                                           pa.array(np.full(m, weakest))], [*out.schema.names, "grp", "weakest"])
    return by_task(work)


def _verified(edges: DataFrame, reps: DataFrame, rows: DataFrame, before: DataFrame | None, shingle: int, threshold: float,
              block_rows: int, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The candidate groups (grp, n) of the links ``edges``, and the rows of ``_verify``
    for those that are not among the groups ``before``.  Groups only grow, so one of
    the same smallest member and number is the same."""
    group = components(edges)
    member = table(group.join(reps.select("rid", "copies", "bytes"), F.col("node") == F.col("rid")).select(
        "rid", F.col("component").alias("grp"), "copies", "bytes"), "members")
    groups = table(member.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")), "groups")
    parts = groups.select("grp", F.greatest(F.ceil(F.col("n") / F.lit(block_rows)),
                                            F.ceil(F.col("bytes") / F.lit(block_bytes))).cast("int").alias("parts"), "n")
    if before is not None:
        parts = parts.join(before, ["grp", "n"], "left_anti")
    packed = rows.mapInArrow(_pack, "rid bigint, packed binary")
    loaded = member.join(parts.drop("n"), "grp").join(packed, "rid")
    tasks = block_pairs(loaded, F.col("parts"), F.col("rid"), ["rid", "copies", "packed"])
    return groups.select("grp", "n"), table(
        tasks.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j").mapInArrow(
            _verify(shingle, threshold), LINKS + ", grp bigint, weakest double"), "links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES,
                    depth: int = DEPTH, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text",
                    block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: its id; class_id (smallest id with the same set of
    shingles); n_links (other documents, copies included, with Jaccard similarity of
    at least ``threshold``); component_id (smallest id reachable by links, itself
    included); kept (id = component_id; of rows that share an id, the first by
    text_key); text_key (xxhash64 of the text, null as empty).

    Words are lower-cased (A-Z); a text of 1 to shingle - 1 words has one shingle:
    all its words.  Null texts and texts without words have none and link with
    nothing, each its own class.  Rows equal in id and text are one document and get
    the same result; rows that share only the id are documents of their own, and
    null ids come last.  An empty table gives an empty result.  Other columns are
    ignored.
    """
    source = columns(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows, index = with_row_order(source)
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    sign = table(keyed.mapInArrow(_signatures(shingle, trees, depth),
                                 "rid bigint, text_key bigint, size bigint, set1 bigint, set2 bigint, leaves array<binary>, bytes bigint"),
                 "signatures")
    classes = table(sign.where("size > 0").groupBy("set1", "set2").agg(
        F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = sign.join(classes.select("rep", "copies"), F.col("rid") == F.col("rep")).select(
        "rid", "copies", "bytes", "leaves")

    least = matched_depth(threshold, trees, depth, recall)
    forest = _forest(reps, depth, least)
    d, groups, checked = depth, None, None
    while True:
        now, fresh = _verified(forest.where(F.col("common") >= d), reps, rows, groups, shingle, threshold,
                               block_rows, block_bytes)
        # groups that did not grow keep their links
        checked = fresh if checked is None else checked.join(
            groups.join(now, ["grp", "n"]).select("grp"), "grp", "left_semi").unionByName(fresh)
        groups = now
        weakest = checked.agg(F.min("weakest")).first()[0]
        to = least if weakest is None else matched_depth(max(weakest, threshold), trees, depth, recall)
        if to >= d:
            break
        d = to
    links = checked.where("links > 0").groupBy("rid").agg(F.sum("links").alias("links"))
    joined = components(checked.select(F.col("rid").alias("a"), F.col("root").alias("b")))

    per_class = classes.join(links, F.col("rep") == F.col("rid"), "left").drop("rid").join(
        joined, F.col("rep") == F.col("node"), "left").select(
        "set1", "set2", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"))
    # documents without shingles have no class row
    c = per_class.select(F.col("set1").alias("c1"), F.col("set2").alias("c2"), "rep", "n_links", "component")
    out = sign.join(c, (F.col("size") > 0) & (F.col("set1") == F.col("c1")) & (F.col("set2") == F.col("c2")), "left").select(
        "rid", "text_key", F.coalesce("rep", "rid").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "rid").alias("component_id"), (F.coalesce("component", "rid") == F.col("rid")).alias("kept"))
    kind = dict(source.dtypes)["id"]
    if index is None:
        return out.select(F.col("rid").cast(kind).alias(id_col), F.col("class_id").cast(kind).alias("class_id"),
                          "n_links", F.col("component_id").cast(kind).alias("component_id"), "kept", "text_key")
    name = lambda c: index.select(F.col("rid").alias(f"{c}_r"), F.col("id").alias(f"{c}_v"))
    out = index.join(out.drop("text_key"), "rid").join(name("c"), F.col("class_id") == F.col("c_r")) \
        .join(name("k"), F.col("component_id") == F.col("k_r"))
    mine = source.select(F.col("id").alias("row_id"), F.xxhash64("text").alias("row_key"))
    return mine.join(out, mine["row_id"].eqNullSafe(out["id"]) & (mine["row_key"] == out["key"])).select(
        F.col("row_id").alias(id_col), F.col("c_v").alias("class_id"), "n_links", F.col("k_v").alias("component_id"), "kept",
        F.col("row_key").alias("text_key"))


def op5(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: five words, similarity 0.8 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, whole, that stand for their group of near duplicates; of rows
    equal in id and text one stays.  Other arguments as for ``near_duplicates``."""
    kept = near_duplicates(docs, id_col=id_col, text_col=text_col, **how).where("kept")
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    # one non-null key of the row to join and number by, so the texts are dealt out once
    kept = kept.select(F.col(id_col).alias("_id"), F.col("text_key").alias("_key"),
                       F.xxhash64(id_col, "text_key").alias("_row")).distinct()
    rows = docs.withColumn("_text_key", text_key).withColumn("_row_key", F.xxhash64(F.col(id_col), F.col("_text_key")))
    met = rows.join(kept, (F.col("_row_key") == F.col("_row")) & (F.col("_text_key") == F.col("_key"))
                    & F.col(id_col).eqNullSafe(F.col("_id")), "left_semi")
    # rows equal in id and text may differ elsewhere: the first by all other columns that have an order
    other = [F.col(f"`{f.name}`") for f in docs.schema.fields
             if f.name not in (id_col, text_col) and not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    one = Window.partitionBy("_row_key", id_col, "_text_key").orderBy(*other or [F.lit(0)])
    return met.withColumn("_n", F.row_number().over(one)).where("_n = 1").select(*docs.columns)


#: The exact join in DuckDB SQL.
OP5_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS s FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS cls FROM sh GROUP BY doc_id),
reps AS MATERIALIZED (SELECT cls, min(doc_id) AS rep, any_value(n) AS n, count(*) AS copies FROM n GROUP BY cls),
rs AS MATERIALIZED (SELECT sh.* FROM sh JOIN reps ON doc_id = rep),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM rs a JOIN rs b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b, y.copies FROM common JOIN reps x ON a = x.rep JOIN reps y ON b = y.rep WHERE c / (x.n + y.n - c) >= 0.8),
reach(a, b) AS (SELECT rep, rep FROM reps UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
deg AS (SELECT a, CAST(sum(copies) AS BIGINT) AS k FROM link GROUP BY a)
SELECT d.doc_id, coalesce(rep, d.doc_id) AS class_id, coalesce(k, 0) + coalesce(copies, 1) - 1 AS n_links,
       coalesce(component, d.doc_id) AS component_id, coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reps USING (cls) LEFT JOIN comp ON comp.a = rep LEFT JOIN deg ON deg.a = rep
"""
