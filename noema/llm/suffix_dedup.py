"""Exact substring dedup over all documents by bucket-pointer refinement.

A byte is removed when some ``length``-byte string that covers it also starts
earlier: in an earlier document, or earlier in the same one.

Suffixes are bucketed by their first ``q = length / 4`` bytes and buckets are
refined by the bucket identifiers of later offsets.  An identifier is a 64-bit
name that depends on the string alone, so the name of 2q bytes is made of the
names at offsets 0 and q, that of 4q bytes of the *updated* names at offsets 0
and 2q, and no pass over other documents is needed for an update.  What must
cross documents is the question which buckets still hold several suffixes, and
it is asked for few suffixes:

* every string of ``length`` bytes is represented by the smallest q-gram name in
  it (leftmost on ties).  Equal strings choose the same one, so comparing at
  the chosen places loses nothing.  Consecutive strings that share their place
  form a *block* (about 1 suffix in 35 bytes of prose remains);
* pass 1 counts the initial q-gram buckets refined by the block's own name, with
  map-side partial aggregation, and keeps the buckets with several members;
* pass 2 hands the surviving buckets back to the documents (a join that adaptive
  execution may split on hot names).  A whole block that an earlier document
  has is removed; the first holder of a block goes on when its q-gram bucket
  also holds other blocks;
* those are refined once more, by the names of the 63 bytes that all strings of
  a half block share, and compared string by string inside a refined bucket.
  A refined bucket with over ``bucket_rows`` members is refined recursively:
  equal members are settled by one aggregation, and a holder of each goes on
  with the two halves of its strings, which share more bytes, down to single
  strings.  So no task ever holds a bucket of unbounded size.

The text crosses the network twice, compressed: to cut out the contexts of the
last refinement, and to apply the removals.

Order: rows by ``id`` (null last), rows with equal ids by the hash of their text;
rows equal in id and text are one document and get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from noema.llm import textcore as T
from noema.llm.store import schema, table, with_row_order

BUCKET_ROWS = 2000
_BATCH_BYTES = 4 << 20

U = np.uint64


def _blocks(data: np.ndarray, offsets: np.ndarray, length: int):
    """The blocks of a run of documents: chosen place, first and last string start,
    document, q-gram name and block name."""
    q = length // 4
    width = length - q + 1
    sums = T.prefix_sums(T.BYTE_CODE[data])
    name = T.gram_ids(sums, q)
    empty = np.zeros(0, np.int64)
    if len(name) < width:
        return empty, empty, empty, empty, empty.astype(U), empty.astype(U)
    low = U(0xFFFFFFFF)
    best = T.sliding_min((name & ~low) | np.arange(len(name), dtype=U), width)
    place = (best & low).astype(np.int64)
    start = np.arange(len(best))
    doc = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[doc + 1]
    start, place, doc = start[inside], place[inside], doc[inside]
    if not len(start):
        return empty, empty, empty, empty, empty.astype(U), empty.astype(U)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    first, last = start[at], start[np.append(at[1:], len(start)) - 1]
    place, doc = place[at], doc[at]

    def whole(p):
        # names of 2q and 4q bytes, each made of the names before
        half = lambda x: T.pair_id(name[x], name[x + q])
        return T.pair_id(half(p), half(p + 2 * q))

    shape = ((place - first) * length + (last - first)).astype(U)
    block = T.mix(T.pair_id(whole(first), whole(last)) + shape)
    return place, first, last, doc, name[place], block


def _first_in_doc(doc: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Whether each block is the first of its name in its document."""
    order = np.lexsort((np.arange(len(doc)), block, doc))
    first = np.ones(len(doc), bool)
    first[1:] = (doc[order][1:] != doc[order][:-1]) | (block[order][1:] != block[order][:-1])
    out = np.empty(len(doc), bool)
    out[order] = first
    return out


def _name_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in T.runs(b.column("text")):
                _, _, _, doc, gram, block = _blocks(data, offsets, length)
                keep = _first_in_doc(doc, block)
                if not keep.any():
                    continue
                rid = b.column("rid").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [T.as_long(gram[keep]), T.as_long(block[keep]), pa.array(rid[doc[keep]])],
                    ["gram", "block", "rid"])
    return run


def _placed_rows(length: int):
    """(block, rid, spot, again): the first block of a name in its document, and
    merged stretches of the later ones (again).  ``spot`` packs the place and its
    distances to the first and last string start, or both starts if again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in T.runs(b.column("text")):
                place, first, last, doc, _, block = _blocks(data, offsets, length)
                if not len(doc):
                    continue
                keep = _first_in_doc(doc, block)
                later = np.flatnonzero(~keep)
                if len(later):
                    head = np.ones(len(later), bool)
                    head[1:] = (np.diff(later) > 1) | (np.diff(doc[later]) > 0)
                    last = last.copy()
                    last[later[head]] = last[later[np.append(np.flatnonzero(head)[1:], len(later)) - 1]]
                    later = later[head]
                rows = np.sort(np.concatenate([np.flatnonzero(keep), later]))
                rid = b.column("rid").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                base, again = offsets[doc[rows]], ~keep[rows]
                x, y, z = (v[rows] - base for v in (first, last, place))
                packed = np.where(again, x << 32 | y, z << 24 | (z - x) << 12 | np.maximum(z - y, 0))
                yield pa.RecordBatch.from_arrays(
                    [T.as_long(block[rows]), pa.array(rid[doc[rows]]), pa.array(packed), pa.array(again)],
                    ["block", "rid", "spot", "again"])
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle."""
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        extra = [c for c in b.schema.names if c == "extra"]
        for lo, hi, data, offsets in T.runs(b.column("text")):
            packed = [z.compress(data[i:j]) for i, j in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("rid").slice(lo, hi - lo), pa.array(packed, pa.binary()),
                 *(b.column(c).slice(lo, hi - lo) for c in extra)], ["rid", "packed", *extra])


def _unpack(cells: pa.Array) -> Iterator[tuple[int, bytes]]:
    z = zstandard.ZstdDecompressor()
    for i in range(len(cells)):
        yield i, z.decompress(cells[i].as_py())


def _contexts(length: int):
    """From (rid, packed, places) the half blocks: (core, rid, start, off, u, v, ctx).

    A string's offset is the distance from its start to the chosen place.  All
    strings with offsets ``u..v`` share the bytes ``place - u .. place - v + length``,
    their core.  ``off`` is the offset of the first string of ``ctx``."""
    q = length // 4
    split = (length - q + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rids = b.column("rid").to_numpy(zero_copy_only=False)
            out, size = [], 0
            for i, text in _unpack(b.column("packed")):
                data = np.frombuffer(text, np.uint8)
                sums = T.prefix_sums(T.BYTE_CODE[data])
                at = np.unique(np.array(b.column("places")[i].as_py(), np.int64))
                place = at >> 24
                first, last = place - ((at >> 12) & 4095), place - (at & 4095)
                for u, v in ((0, split - 1), (split, length - q)):
                    lo, hi = np.maximum(first, place - v), np.minimum(last, place - u)
                    some = np.flatnonzero(lo <= hi)
                    lo, hi, at_ = lo[some], hi[some], place[some]
                    out.append((T.span_ids(sums, at_ - u, at_ - v + length), np.full(len(some), rids[i]), lo, at_ - lo,
                                np.full(len(some), u), np.full(len(some), v),
                                [text[x:y + length] for x, y in zip(lo.tolist(), hi.tolist())]))
                    size += 2 * length * len(some)
                if size > _BATCH_BYTES:
                    yield _context_batch(out)
                    out, size = [], 0
            if size:
                yield _context_batch(out)
    return run


def _context_batch(parts) -> pa.RecordBatch:
    core, rid, start, off, u, v = (np.concatenate([p[k] for p in parts]) for k in range(6))
    ctx = [x for p in parts for x in p[6]]
    return pa.RecordBatch.from_arrays(
        [T.as_long(core ^ T.mix(u.astype(U))), pa.array(rid.astype(np.int64)), pa.array(start.astype(np.int32)),
         *(pa.array(x.astype(np.int16)) for x in (off, u, v)), pa.array(ctx, pa.binary())], _CONTEXT.names)


_CONTEXT = pa.schema([("core", pa.int64()), ("rid", pa.int64()), ("start", pa.int32()), ("off", pa.int16()),
                      ("u", pa.int16()), ("v", pa.int16()), ("ctx", pa.binary())])
_CONTEXT_SQL = "core bigint, rid bigint, start int, off smallint, u smallint, v smallint, ctx binary"


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts with the name of their whole content and place."""
    for b in batches:
        data = b.column("ctx").to_pylist()
        cut = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        name = T.span_ids(T.prefix_sums(T.BYTE_CODE[np.frombuffer(b"".join(data), np.uint8)]), cut[:-1], cut[1:])
        where = b.column("off").to_numpy().astype(U) * U(4096) + b.column("u").to_numpy().astype(U)
        yield pa.RecordBatch.from_arrays([*b.columns, T.as_long(T.pair_id(name, where))], [*b.schema.names, "whole"])


def _halves(length: int):
    """Each context as the contexts of the two halves of its range of offsets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, cores = [], []
            for r in b.to_pylist():
                n, mid = len(r["ctx"]) - length + 1, (r["u"] + r["v"]) // 2
                for u, v in ((r["u"], mid), (mid + 1, r["v"])):
                    hi, lo = min(v, r["off"]), max(u, r["off"] - n + 1)
                    if u > v or lo > hi:
                        continue
                    cores.append(r["ctx"][r["off"] - u:r["off"] - v + length])
                    rows.append((r["rid"], r["start"] + r["off"] - hi, hi, u, v,
                                 r["ctx"][r["off"] - hi:r["off"] - lo + length]))
            if not rows:
                continue
            cut = np.concatenate([[0], np.cumsum([len(x) for x in cores])]).astype(np.int64)
            name = T.span_ids(T.prefix_sums(T.BYTE_CODE[np.frombuffer(b"".join(cores), np.uint8)]), cut[:-1], cut[1:])
            rid, start, off, u, v, ctx = zip(*rows)
            yield _context_batch([(name, *(np.array(x) for x in (rid, start, off, u, v)), list(ctx))])
    return run


def _strings(ctx: pa.Array, rid: np.ndarray, start: np.ndarray, length: int):
    """All strings of the contexts: name, rid, start."""
    lens = np.array([len(x) for x in ctx.to_pylist()], np.int64)
    data = np.frombuffer(b"".join(ctx.to_pylist()), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(lens)])
    name = T.gram_ids(T.prefix_sums(T.BYTE_CODE[data]), length)
    p = np.arange(len(name))
    row = np.searchsorted(offsets, p, "right") - 1
    ok = p + length <= offsets[row + 1]
    p, row = p[ok], row[ok]
    return name[p], rid[row], start[row] + (p - offsets[row])


def _repeats(name: np.ndarray, rid: np.ndarray, start: np.ndarray) -> pa.RecordBatch | None:
    """Strings that occur earlier, as stretches (rid, start, stop of starts)."""
    order = np.lexsort((start, rid, name))
    name, rid, start = name[order], rid[order], start[order]
    again = np.zeros(len(name), bool)
    again[1:] = name[1:] == name[:-1]
    rid, start = rid[again], start[again]
    if not len(rid):
        return None
    order = np.lexsort((start, rid))
    rid, start = rid[order], start[order]
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(new)
    stop = start[np.append(at[1:], len(rid)) - 1]
    return pa.RecordBatch.from_arrays(
        [pa.array(rid[at]), pa.array(start[at].astype(np.int32)), pa.array(stop.astype(np.int32))],
        ["rid", "first", "last"])


def _compare(length: int):
    """Compare inside refined buckets; rows come sorted by core, buckets are kept
    whole.  Strings of different buckets differ, so many are done at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def work(t: pa.Table):
            ctx = t["ctx"].combine_chunks()
            ctx = ctx.chunk(0) if isinstance(ctx, pa.ChunkedArray) else ctx
            return _repeats(*_strings(ctx, t["rid"].to_numpy(), t["start"].to_numpy().astype(np.int64), length))

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size < 6000:
                continue
            t = pa.Table.from_batches(held)
            core = t["core"].to_numpy()
            cut = int(np.searchsorted(core, core[-1], "left"))  # sorted: the last bucket may go on
            if cut:
                out = work(t.slice(0, cut))
                if out is not None:
                    yield out
            held, size = t.slice(cut).to_batches(), t.num_rows - cut
        if held and size:
            out = work(pa.Table.from_batches(held))
            if out is not None:
                yield out
    return run


def _apply(length: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            gone = b.column("gone")
            for i, text in _unpack(b.column("packed")):
                cell = gone[i].as_py()
                n_bytes.append(len(text))
                if not cell:
                    kept.append(text)
                    n_removed.append(0)
                    n_spans.append(0)
                    continue
                span = np.array(cell, np.int64)
                mark = np.zeros(len(text) + 1, np.int32)
                np.add.at(mark, span >> 32, 1)
                np.add.at(mark, (span & 0xFFFFFFFF) + length, -1)
                keep = np.cumsum(mark[:-1]) == 0
                kept.append(np.frombuffer(text, np.uint8)[keep].tobytes())
                n_removed.append(int((~keep).sum()))
                n_spans.append(int((~keep[:1]).sum() + (keep[:-1] & ~keep[1:]).sum()))
            extra = [c for c in b.schema.names if c == "extra"]
            # as text, what is left of a character that was cut apart is dropped
            body = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text \
                else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), body, *map(b.column, extra)],
                ["rid", "n_bytes", "n_removed", "n_spans", "kept", *extra])
    return run


def _shared_blocks(rows: DataFrame, length: int) -> DataFrame:
    """(k, holder, mixed): the blocks of q-gram buckets with several members, the first
    document of each, and whether the bucket has other blocks too."""
    names = rows.mapInArrow(_name_rows(length), "gram bigint, block bigint, rid bigint")
    buckets = names.groupBy("gram", "block").agg(F.min("rid").alias("holder"), F.count(F.lit(1)).alias("n"))
    # with the holder used here too, both reads of the buckets share one exchange
    shared = buckets.groupBy("gram").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("members"),
                                         F.min("holder").alias("first"))
    shared = shared.where("members > 1 and first is not null").select(
        "gram", (F.col("blocks") > 1).alias("mixed"))
    return table(buckets.join(shared, "gram").where("n > 0").select(F.col("block").alias("k"), "holder", "mixed"), "blocks")


def _found(rows: DataFrame, known: DataFrame, length: int) -> DataFrame:
    """(rid, gone, place): stretches to remove, and places whose blocks need refining."""
    placed = rows.mapInArrow(_placed_rows(length), "block bigint, rid bigint, spot bigint, again boolean")
    met = placed.join(known, F.col("block") == F.col("k"), "left")
    gone = F.col("again") | F.coalesce(F.col("rid") > F.col("holder"), F.lit(False))
    rest = ~F.col("again") & (F.col("rid") == F.col("holder")) & F.col("mixed")
    place = F.shiftright("spot", 24)
    whole = F.shiftleft(place - F.shiftright("spot", 12).bitwiseAND(F.lit(4095)), 32).bitwiseOR(
        place - F.col("spot").bitwiseAND(F.lit(4095)))
    return table(met.where(gone | rest).select(
        "rid", F.when(F.col("again"), F.col("spot")).when(gone, whole).alias("gone"),
        F.when(~gone, F.col("spot")).alias("place")), "found")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     length: int = 100, bucket_rows: int = BUCKET_ROWS, carry: Sequence[str] = (),
                     as_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id (under its own name), n_bytes, n_removed,
    n_spans and ``kept`` (binary: the bytes that stay).

    ``length`` is a multiple of 4, at least 16.  Nulls: a null text is empty; a
    null id comes last.  Texts shorter than ``length`` are never touched.  An
    empty table gives an empty result.  ``bucket_rows`` only chooses how a refined
    bucket is compared, never what is compared.  Other columns are ignored, but for
    those named in ``carry``, which come back as a struct ``extra``.  With ``as_text``,
    ``kept`` is a string without the rests of characters that were cut apart.
    """
    if length % 4 or length < 16:
        raise ValueError("length must be a multiple of 4, at least 16")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                         *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("extra")] if carry else []))
    rows, index = with_row_order(source.select("id", "text"))

    found = _found(rows, _shared_blocks(rows, length), length)
    span = F.shiftleft(F.col("first").cast("bigint"), 32).bitwiseOR(F.col("last").cast("bigint"))
    # texts travel with their carried columns where a row is a document of its own
    with_text = rows if index is not None else source.withColumn("rid", F.col("id").cast("bigint")).drop("id")
    extra = {"extra": source.schema["extra"].dataType} if carry and index is None else {}
    packed = with_text.mapInArrow(_pack, schema("rid bigint, packed binary", **extra))
    places = found.where("place is not null").groupBy("rid").agg(F.collect_list("place").alias("places"))
    level = table(places.join(packed.select("rid", "packed"), "rid").mapInArrow(_contexts(length), _CONTEXT_SQL), "contexts")
    spans = found.where("gone is not null").select("rid", "gone")
    while True:
        large = table(level.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
                      .select("core"), "large-buckets")
        small = (level.join(large, "core", "left_anti").repartition("core").sortWithinPartitions("core")
                 .mapInArrow(_compare(length), "rid bigint, first int, last int"))
        spans = spans.unionAll(small.select("rid", span.alias("gone")))
        if large.limit(1).count() == 0:
            break
        # large buckets: equal contexts at once, one holder of each goes on to half its range
        rows_ = level.join(large, "core", "left_semi").mapInArrow(_named, _CONTEXT_SQL + ", whole bigint")
        holder = rows_.groupBy("whole").agg(F.min(F.struct("rid", "start")).alias("head")).withColumnRenamed("whole", "w")
        told = table(rows_.join(holder, F.col("whole") == F.col("w")).withColumn(
            "again", F.struct("rid", "start") > F.col("head")).drop("w", "head", "whole"), "refined")
        strings = F.octet_length("ctx") - F.lit(length)
        again = told.where("again").select("rid", F.col("start").alias("first"), (F.col("start") + strings).alias("last"))
        spans = spans.unionAll(again.select("rid", span.alias("gone")))
        level = table(told.where("not again and u < v").drop("again").mapInArrow(_halves(length), _CONTEXT_SQL), "contexts")
    spans = spans.groupBy("rid").agg(F.collect_list("gone").alias("gone"))
    out = packed.join(spans, "rid", "left").mapInArrow(
        _apply(length, as_text), schema("rid bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                        f"kept {'string' if as_text else 'binary'}", **extra))
    result = ["n_bytes", "n_removed", "n_spans", "kept", *(["extra"] if carry else [])]
    if index is None:
        return out.select(F.col("rid").cast(dict(source.dtypes)["id"]).alias(id_col), *result)
    # every row of the input, also those that were one document
    per_key = index.join(out, "rid")
    keyed = source.withColumnRenamed("id", "row_id").withColumn("row_key", F.xxhash64("text")).drop("text")
    on = keyed["row_id"].eqNullSafe(per_key["id"]) & (keyed["row_key"] == per_key["key"])
    return keyed.join(per_key, on).select(F.col("row_id").alias(id_col), *result)


def op10(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``, 100-byte strings."""
    out = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
