"""All pairs of bounded blocks, without emitting them: shared by the joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def block_pairs(rows: DataFrame, parts: Column, salt: Column, keep: Sequence[str]) -> DataFrame:
    """Deal the rows of a group (``grp``) into ``parts`` blocks by hash and give each
    row to the tasks (grp, i, j), i <= j, of every pair of blocks it is in."""
    dealt = rows.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64(salt), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.select("grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                        "block", *keep)


def by_task(work: Callable[[pa.Table], pa.RecordBatch | None], keys: Sequence[str] = ("grp", "i", "j")):
    """A mapInArrow function over rows sorted by ``keys`` that calls ``work`` with the
    whole rows of one key at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            cols = [b.column(c).to_numpy() for c in keys]
            edge = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in cols])) + 1
            cuts = [0, *edge.tolist(), b.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                key = tuple(c[x] for c in cols)
                if held and key != last:
                    out = work(pa.Table.from_batches(held))
                    if out is not None and out.num_rows:
                        yield out
                    held = []
                held.append(b.slice(x, y - x))
                last = key
        if held:
            out = work(pa.Table.from_batches(held))
            if out is not None and out.num_rows:
                yield out
    return run


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray, rid: np.ndarray) -> np.ndarray:
    """For every row the smallest rid that the linked pairs (a matrix of left and
    right rows) join it to, itself included."""
    label, top = rid.copy(), np.iinfo(np.int64).max
    while True:
        before = label.copy()
        np.minimum.at(label, left, np.where(linked, label[right][None, :], top).min(axis=1))
        np.minimum.at(label, right, np.where(linked, label[left][:, None], top).min(axis=0))
        if (label == before).all():
            return label


def links_of(linked: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool,
             rid: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
    """(rid, links, root) of the rows that have links; links count copies."""
    links = np.zeros(len(rid), np.int64)
    links[left] += linked @ copies[right]
    if not same:
        links[right] += copies[left] @ linked
    root = forest(linked, left, right, rid)
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.array(links[some]), pa.array(root[some])],
                                      ["rid", "links", "root"])


LINKS = "rid bigint, links bigint, root bigint"
