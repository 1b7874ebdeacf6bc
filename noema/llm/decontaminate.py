"""Benchmark decontamination with a distributed positional inverted index.

The index holds postings (term, document, position) of training text for the
terms that a benchmark window is probed by: its two rarest ones.  Rarity is
counted over all documents.  A window is looked up from its rarest term; the
offset-adjusted list (position less the term's place in the item) is
intersected with the adjusted list of the second rarest.  Places that agree are
verified word by word against the document itself, first by the words' names and
then by their bytes, which gives exact phrase matches; places that agree up to ``near`` words are proximity matches.

What keeps it bounded:

* documents are filtered against a bitmap of fixed size (``2**22`` bits) of the
  benchmark's words before anything is emitted; the bitmap only saves work, the
  joins decide;
* windows that share their two probe terms are one probe, so overlapping windows
  do not repeat look-ups, and windows with a word that no document has are dropped;
* counting is partially aggregated in the tasks; the joins are plain equi-joins
  that adaptive execution may split on hot terms;
* a document is keyed by the hash of its text.  Copies share their look-ups, and
  since matches are verified in each document, a hash collision is harmless.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from noema.llm import textcore as T
from noema.llm.store import columns, schema, table

BITS = 1 << 22
_BITMAP = 4096 * 8  # bits of one row that bitmap_construct_agg makes


def _bitmap(df: DataFrame, term: str) -> np.ndarray:
    """Bits of the terms' low 22 bits: at most BITS / 32768 = 128 rows of 4 KB."""
    bit = F.col(term).bitwiseAND(F.lit(BITS - 1)) + 1
    out = np.zeros(BITS // 8, np.uint8)
    for r in df.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m")).collect():
        lo = (r.k - 1) * _BITMAP // 8
        out[lo:lo + _BITMAP // 8] = np.frombuffer(bytes(r.m), np.uint8)
    return out


def _has(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    low = (ids & np.uint64(BITS - 1)).astype(np.int64)
    return (bitmap[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offsets in T.runs(b.column("text")):
            w = T.words(data, offsets)
            item = b.column("item").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            low = T.LOWER[data]
            word = [low[x:y].tobytes() for x, y in zip(w.start.tolist(), w.end.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(item[w.doc]), pa.array(w.pos), T.as_long(w.id), pa.array(word, pa.binary())],
                ["item", "pos", "term", "word"])


def _counts(bitmap: np.ndarray):
    """Occurrences per task of the words in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            for _, _, data, offsets in T.runs(b.column("text")):
                ids = T.words(data, offsets).id
                t, n = np.unique(ids[_has(bitmap, ids)], return_counts=True)
                both = np.concatenate([terms, t])
                terms, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n]), len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([T.as_long(terms), pa.array(counts)], ["term", "n"])
    return run


def _postings(bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in T.runs(b.column("text")):
                w = T.words(data, offsets)
                hit = _has(bitmap, w.id)
                key = b.column("key").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [T.as_long(w.id[hit]), pa.array(key[w.doc[hit]]), pa.array(w.pos[hit])],
                    ["term", "key", "pos"])
    return run


def _probes(window: int):
    """From an item's words (sorted) with their counts: one row for each run of
    windows with the same two rarest words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, words in zip(b.column("item").to_pylist(), b.column("words").to_pylist()):
                term = np.array([x["term"] for x in words], np.int64)
                n = np.array([x["n"] for x in words], np.int64)
                m = min(window, len(term))
                windows = np.lib.stride_tricks.sliding_window_view(n, m)
                order = np.argsort(windows, axis=1, kind="stable")
                one, two = order[:, 0], order[:, min(1, m - 1)]
                last = None
                for s in range(len(windows)):
                    if windows[s].min() == 0:
                        last = None
                        continue
                    j1, j2 = s + int(one[s]), s + int(two[s])
                    if last and last["j1"] == j1 and last["j2"] == j2:
                        last["hi"] = s
                        continue
                    last = {"item": item, "j1": j1, "t1": int(term[j1]), "j2": j2, "t2": int(term[j2]),
                            "lo": s, "hi": s, "size": m}
                    rows.append((last, term, words))
            for r, term, words in rows:
                r["phrase"] = term[r["lo"]:r["hi"] + r["size"]].tobytes()
                r["letters"] = b" ".join(x["word"] for x in words[r["lo"]:r["hi"] + r["size"]])
            yield pa.RecordBatch.from_pylist([r for r, _, _ in rows], schema=_PROBE)
    return run


_PROBE = pa.schema([("item", pa.int64()), ("j1", pa.int64()), ("t1", pa.int64()), ("j2", pa.int64()),
                    ("t2", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("size", pa.int64()),
                    ("phrase", pa.binary()), ("letters", pa.binary())])
_PROBE_SQL = "item bigint, j1 bigint, t1 bigint, j2 bigint, t2 bigint, lo bigint, hi bigint, size bigint, phrase binary, letters binary"


def _windows(same: np.ndarray, m: int) -> np.ndarray:
    """Starts of the windows of ``m`` words that are all the same."""
    run = np.cumsum(np.concatenate([[0], same]))
    return np.flatnonzero(run[m:] - run[:-m] == m)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        carried = [c for c in ("body", "extra") if c in b.schema.names]
        for lo, hi, data, offsets in T.runs(b.column("text")):
            w = T.words(data, offsets)
            n_words, n_hit, names, spans = w.counts(), [], [], []
            found = b.column("found").slice(lo, hi - lo)
            low = None
            for d in range(hi - lo):
                cell = found[d].as_py()
                items, hit = set(), None
                if cell:
                    ids = w.id[w.first[d]:w.first[d + 1]].view(np.int64)
                    hit = np.zeros(len(ids), bool)
                    for c in cell:
                        phrase = np.frombuffer(c["phrase"], np.int64)
                        at = c["base"] + c["lo"]
                        cut = max(0, -at)
                        part = ids[at + cut:at + len(phrase)]
                        same = np.zeros(len(phrase), bool)
                        same[cut:cut + len(part)] = part == phrase[cut:cut + len(part)]
                        m = c["size"]
                        if len(_windows(same, m)):
                            # equal names so far: the words themselves decide
                            low = T.LOWER[data] if low is None else low
                            letters, k = c["letters"].split(b" "), w.first[d] + at
                            for j in np.flatnonzero(same):
                                same[j] = low[w.start[k + j]:w.end[k + j]].tobytes() == letters[j]
                        for s in _windows(same, m):
                            hit[at + s:at + s + m] = True
                            items.add(c["name"])
                names.append(sorted(items))
                if hit is None or not hit.any():
                    n_hit.append(0)
                    spans.append([])
                    continue
                n_hit.append(int(hit.sum()))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                spans.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [b.column("id").slice(lo, hi - lo), pa.array(n_words.astype(np.int64)),
                 pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                 b.column("near").slice(lo, hi - lo), *(b.column(c).slice(lo, hi - lo) for c in carried)],
                ["id", "n_words", "n_hit", "items", "spans", "near_items", *carried])


def find_matches(docs: DataFrame, items: DataFrame, window: int = 10, near: int = 3,
                 id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Benchmark passages in documents: per row of ``docs`` its id (as ``id_col``),
    n_words, n_hit (words inside an occurring window), ``items`` (names of items
    with an occurring window, as sorted strings), ``spans`` (hit words, from 0) and
    ``near_items`` (items with the probe terms of a window at most ``near`` words
    from their places, the exact ones included).

    A window is ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  Null texts have no words.  Items without an id
    are left out, as they can't be named; items that repeat an id are one item.
    Repeated documents get equal results.  Empty tables give empty results, or
    results without hits.  Other columns are ignored, but for those named in ``carry``,
    which come back as a struct ``extra`` beside the text, ``body``.
    """
    id_type = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                         F.struct(*[F.col(f"`{c}`") for c in carry]).alias("extra")) if carry \
        else columns(docs, id=id_col, text=text_col)
    source = source.withColumn("key", F.xxhash64("text"))
    named = columns(items, name=item_col, text=item_text_col).where("name is not null and text is not null")
    named = named.select(F.col("name").cast("string").alias("name"), "text").distinct()
    named = named.withColumn("item", F.xxhash64("name", "text"))

    terms = table(named.select("item", "text").mapInArrow(_item_words, "item bigint, pos bigint, term bigint, word binary"),
                  "item-words")
    counts = (source.select("text").mapInArrow(_counts(_bitmap(terms, "term")), "term bigint, n bigint")
              .groupBy("term").agg(F.sum("n").alias("n")))
    known = terms.join(counts, "term", "left").groupBy("item").agg(
        F.sort_array(F.collect_list(F.struct("pos", "term", F.coalesce("n", F.lit(0)).alias("n"), "word"))).alias("words"))
    probes = table(known.mapInArrow(_probes(window), _PROBE_SQL).withColumn("probe", F.xxhash64("item", "j1", "j2")),
                   "probes")
    probed = probes.select(F.explode(F.array("t1", "t2")).alias("term"))

    postings = table(source.select("key", "text").mapInArrow(
        _postings(_bitmap(probed, "term")), "term bigint, key bigint, pos bigint"), "postings")
    width = 2 * near + 1
    first = postings.join(probes.select("probe", "t1", "j1", "t2", "j2", "hi"), F.col("term") == F.col("t1")).select(
        "key", "probe", "t2", "hi", (F.col("pos") - F.col("j1")).alias("base"),
        (F.col("pos") - F.col("j1") + F.col("j2")).alias("want")).distinct()
    bin_of = lambda c: F.floor(c / F.lit(width))
    first = first.withColumn("bin", F.explode(F.sequence(bin_of(F.col("want") - near), bin_of(F.col("want") + near))))
    second = postings.select(F.col("term").alias("t"), F.col("key").alias("k"), "pos",
                             bin_of(F.col("pos")).alias("pbin")).distinct()
    met = first.join(second, (F.col("key") == F.col("k")) & (F.col("t2") == F.col("t"))
                     & (F.col("bin") == F.col("pbin")))
    met = met.where(F.abs(F.col("pos") - F.col("want")) <= near).select(
        "key", "probe", F.when((F.col("pos") == F.col("want")) & (F.col("base") + F.col("hi") >= 0),
                               F.col("base")).alias("base")).distinct()
    labelled = met.join(probes.select("probe", "item", "lo", "size", "phrase", "letters"), "probe") \
        .join(named.select("item", "name"), "item")
    found = labelled.groupBy("key").agg(
        F.collect_list(F.when(F.col("base").isNotNull(),
                              F.struct("base", "lo", "size", "phrase", "letters", "name"))).alias("found"),
        F.sort_array(F.collect_set("name")).alias("near"))
    met = source.join(found, "key", "left")
    ddl = (f"id {id_type}, n_words bigint, n_hit bigint, items array<string>, "
           "spans array<struct<first:bigint,last:bigint>>, near_items array<string>")
    if carry:
        met = met.withColumn("body", F.col("text"))
    more = {"body": StringType(), "extra": source.schema["extra"].dataType} if carry else {}
    out = met.drop("key").mapInArrow(_verify, schema(ddl, **more))
    return out.withColumn("near_items", F.coalesce("near_items", F.array().cast("array<string>"))) \
        .withColumnRenamed("id", id_col)


def op8(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents`` against whole ``benchmark``, windows of 10."""
    out = find_matches(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                       spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


#: The op8 contract in DuckDB SQL: windows joined on their words' text.
OP8_SQL = r"""
WITH dw AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM bw WHERE len(w) > 0)),
dwin AS MATERIALIZED (
  SELECT doc_id, s, m, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM dw, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hits AS MATERIALIZED (SELECT doc_id, s, m, item_id FROM dwin JOIN win USING (m, phrase)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
