"""License scan: phrases, and an exact set-similarity join with license templates.

A template is the set of its words.  A text block matches when it holds at least
``threshold`` of a template's words (containment).  The join is exact:

* words of all templates are ordered globally, rarest first, by their counts over
  all documents (ties: by the word).  A first distributed pass counts them;
* prefix filter: a block with ``c = ceil(threshold * n)`` of a template's n words
  holds one of its n - c + 1 rarest.  Only those are looked up;
* length filter: the block has at least c different template words;
* positional filter: from the first common word, at place i in the template's
  order and j in the block's, at most ``1 + min(n - i, m - j) - 1`` words can be
  common; fewer than c ends it;
* what remains is verified by counting the common words.

A block is a line of a text; a line of over ``block_words`` words is cut into
blocks of that many words, which overlap by half.  Notices are often wrapped, so the
words of the whole document, whatever its line ends, are cut into windows in the same
way and matched too.  Every template must fit half a block.  Nothing is shuffled but
the word counts: templates are a parameter of the call, so what each task gets of them
does not grow with the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from noema.llm import textcore as T
from noema.llm.store import columns

#: Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: Opening or notice sentences of common licenses, and labels.
TEMPLATES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("you may not use this file except in compliance with the License", "apache-2"),
    ("This work is licensed under the GNU General Public License", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License", "gpl"),
    ("This library is free software; licensed under the GNU Lesser General Public License", "lgpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial License", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike License", "cc-by-sa"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl-2"),
]

THRESHOLD = 0.8
BLOCK_WORDS = 64
FOUND = "array<struct<kind:string,label:string,first:bigint,last:bigint,containment:double>>"


def _ids(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return T.words(data, np.array([0, len(data)])).id


def _need(n: int, threshold: float) -> int:
    """Least number of common words of a template of n words."""
    return max(1, math.ceil(threshold * n - 1e-9))


def _lookup(vocab: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Place of each id in the sorted vocabulary, -1 if absent."""
    if not len(vocab):
        return np.full(len(ids), -1)
    at = np.minimum(np.searchsorted(vocab, ids), len(vocab) - 1)
    return np.where(vocab[at] == ids, at, -1)


def _count_rows(vocab: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocab), np.int64)
        for b in batches:
            for _, _, data, offsets in T.runs(b.column("text")):
                at = _lookup(vocab, T.words(data, offsets).id)
                total += np.bincount(at[at >= 0], minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocab))), pa.array(total)], ["word", "n"])
    return run


def _lines(w: T.Words, data: np.ndarray) -> np.ndarray:
    """Line of the run of each word."""
    return np.cumsum(np.concatenate([[0], data == 10]))[w.start] if len(w.start) else np.zeros(0, np.int64)


def _blocks(w: T.Words, unit: np.ndarray, at: np.ndarray, block_words: int):
    """(first word, last word + 1, index into ``at``) of the blocks of the words at ``at``.

    ``unit`` is the line of each word, or its document; blocks never cross it."""
    half = block_words // 2
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (w.doc[1:] != w.doc[:-1])
    head = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    size = np.diff(np.append(head, len(unit)))
    first, n = head[of[at]], size[of[at]]
    k = (at - first) // half            # block k has words k * half .. k * half + block_words - 1
    last_block = np.maximum(0, -(-(n - block_words) // half))
    one = np.minimum(k, last_block)
    two = np.minimum(k - 1, last_block)
    rows = np.arange(len(at))
    both = (k >= 1) & (two != one)
    idx = np.concatenate([rows, rows[both]])
    block = np.concatenate([one, two[both]])
    start = first[idx] + block * half
    stop = np.minimum(start + block_words, first[idx] + n[idx])
    return start, stop, idx


class _Index:
    """Templates over the global word order."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: dict[int, int], threshold: float):
        sets = [np.unique(_ids(t)) for t, _ in templates]
        self.labels = [label for _, label in templates]
        self.vocab = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]))
        rarity = np.lexsort((self.vocab, np.array([counts.get(i, 0) for i in range(len(self.vocab))], np.int64)))
        self.rank = np.empty(len(self.vocab), np.int64)
        self.rank[rarity] = np.arange(len(self.vocab))
        self.holds = np.zeros((len(sets), len(self.vocab)), bool)
        self.size = np.array([len(s) for s in sets], np.int64)
        self.need = np.array([_need(len(s), threshold) for s in sets], np.int64)
        self.prefix: list[list[tuple[int, int]]] = [[] for _ in self.vocab]
        for t, s in enumerate(sets):
            ranks = np.sort(self.rank[_lookup(self.vocab, s)])
            self.holds[t, ranks] = True
            for i, r in enumerate(ranks[:len(s) - self.need[t] + 1]):
                self.prefix[r].append((t, i))
        flat = [(r, t, i) for r, p in enumerate(self.prefix) for t, i in p]
        self.p_rank, self.p_template, self.p_place = (np.array(x, np.int64) for x in zip(*flat)) \
            if flat else (np.zeros(0, np.int64),) * 3

    def match(self, start: np.ndarray, stop: np.ndarray, rank: np.ndarray):
        """(start, stop, template, common) of all blocks that meet the threshold;
        one input row per template word of a block."""
        none = np.zeros(0, np.int64)
        if not len(start) or not len(self.p_rank):
            return none, none, none, none
        order = np.lexsort((rank, start))
        start, stop, rank = start[order], stop[order], rank[order]
        keep = np.ones(len(start), bool)
        keep[1:] = (start[1:] != start[:-1]) | (rank[1:] != rank[:-1])
        start, stop, rank = start[keep], stop[keep], rank[keep]
        new = np.ones(len(start), bool)
        new[1:] = start[1:] != start[:-1]
        head = np.flatnonzero(new)
        block = np.cumsum(new) - 1
        m = np.diff(np.append(head, len(start)))
        # prefix filter: rows whose word is in some template's prefix, one per template
        lo = np.searchsorted(self.p_rank, rank, "left")
        n = np.searchsorted(self.p_rank, rank, "right") - lo
        row = np.repeat(np.arange(len(rank)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]
        template, i = self.p_template[at], self.p_place[at]
        # the first common word of a block and a template decides (rows are in rank order)
        pair = block[row] * len(self.size) + template
        _, one = np.unique(pair, return_index=True)
        row, template, i = row[one], template[one], i[one]
        j = row - head[block[row]]
        size = m[block[row]]
        bound = 1 + np.minimum(self.size[template] - i, size - j) - 1
        ok = (size >= self.need[template]) & (bound >= self.need[template])
        row, template = row[ok], template[ok]
        if not len(row):
            return none, none, none, none
        b = block[row]
        count = m[b]
        words = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(head[b], count)
        common = np.add.reduceat(self.holds[np.repeat(template, count), rank[words]].astype(np.int64),
                                 np.cumsum(count) - count)
        ok = common >= self.need[template]
        return start[row][ok], stop[row][ok], template[ok], common[ok]


def _cells(docs: int, doc, kind, label, first, last, part) -> pa.ListArray:
    """One list of (kind, label, first, last, containment) for each document."""
    order = np.lexsort((label, first, kind, doc)) if len(doc) else np.zeros(0, np.int64)
    cut = np.searchsorted(doc[order], np.arange(docs + 1)).astype(np.int32)
    cells = pa.StructArray.from_arrays(
        [pa.array(kind[order], pa.string()), pa.array(label[order], pa.string()),
         pa.array(first[order], pa.int64()), pa.array(last[order], pa.int64()),
         pa.array(part[order], pa.float64())], ["kind", "label", "first", "last", "containment"])
    return pa.ListArray.from_arrays(pa.array(cut), cells)


def _scan(index: _Index, phrases: Sequence[tuple[str, str]], block_words: int):
    known = [(_ids(p), label) for p, label in phrases]

    def matched(w: T.Words, unit: np.ndarray, name: str):
        """(doc, kind, label, first, last, containment) of the units' matching blocks."""
        at = _lookup(index.vocab, w.id)
        hit = np.flatnonzero(at >= 0)
        start, stop, idx = _blocks(w, unit, hit, block_words)
        s, e, template, common = index.match(start, stop, index.rank[at[hit[idx]]])
        base = w.first[w.doc[s]]
        return (w.doc[s], np.array([name] * len(s), object), np.array([index.labels[t] for t in template], object),
                s - base, e - 1 - base, common / index.size[template] if len(s) else np.zeros(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in T.runs(b.column("text")):
                w = T.words(data, offsets)
                docs = hi - lo
                found = [matched(w, _lines(w, data), "block")]
                for ids, name in known:
                    k = len(ids)
                    if not k or len(w.id) < k:
                        continue
                    same = np.ones(len(w.id) - k + 1, bool)
                    for t in range(k):
                        same &= w.id[t:len(w.id) - k + 1 + t] == ids[t]
                    s = np.flatnonzero(same)
                    s = s[s + k <= w.first[w.doc[s] + 1]]
                    at = s - w.first[w.doc[s]]
                    found.append((w.doc[s], np.array(["phrase"] * len(s), object), np.array([name] * len(s), object),
                                  at, at + k - 1, np.ones(len(s))))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, docs), pa.array(w.counts().astype(np.int64)),
                     _cells(docs, *(np.concatenate(x) for x in zip(*found))),
                     _cells(docs, *matched(w, w.doc, "window"))], ["id", "n_words", "found", "windows"])
    return run


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
                  templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                  block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, n_words and ``found``, an array of (kind, label,
    first, last, containment): every place of a phrase (kind ``phrase``) and every
    block that meets a template's threshold (kind ``block``), with word numbers;
    and ``windows``, the same of the windows of the whole document (kind ``window``),
    in which a notice wrapped over several lines is found.

    Null and empty texts have no words and nothing found.  Repeated rows and ids
    are scanned each on their own; null ids stay null.  Empty tables give empty
    results.  Other columns are ignored.  Templates of more than half a block, or
    without words, are refused.
    """
    for text, _ in templates:
        if not 0 < len(_ids(text)) <= block_words // 2:
            raise ValueError(f"a template has 1 to {block_words // 2} words: {text[:60]!r}")
    id_type = dict(docs.dtypes)[id_col]
    source = columns(docs, id=id_col, text=text_col)
    vocab = _Index(templates, {}, threshold).vocab
    counts = {r.word: r.n for r in source.select("text").mapInArrow(_count_rows(vocab), "word bigint, n bigint")
              .groupBy("word").agg(F.sum("n").alias("n")).collect()}  # a row per template word
    index = _Index(templates, counts, threshold)
    out = source.mapInArrow(
        _scan(index, phrases, block_words),
        f"id {id_type}, n_words bigint, found {FOUND}, windows {FOUND}")
    return out.withColumnRenamed("id", id_col)


def op9(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``; score 1 with a phrase, else the largest
    containment of a matching block or window, else 0."""
    out = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("found", lambda x: x["kind"] == "phrase")
    both = F.concat("found", "windows")
    text = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda x: x["label"]))), ",")
    starts = F.transform("base", lambda x: x["first"])
    return out.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        text(F.col("base")).alias("base_labels"), text(both).alias("labels"),
        F.coalesce(F.array_max(F.transform(both, lambda x: x["containment"])), F.lit(0.0)).alias("score"))


def op9_sql() -> str:
    """The same rows in DuckDB SQL: blocks by line and word number, words counted."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    t = ", ".join(f"({i}, {quote(x)}, {quote(label)})" for i, (x, label) in enumerate(TEMPLATES))
    p = ", ".join(f"({quote(x)}, {quote(label)})" for x, label in PHRASES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH templates(tid, txt, label) AS (VALUES {t}),
phrases(txt, label) AS (VALUES {p}),
tw AS (SELECT DISTINCT tid, label, unnest(regexp_extract_all(translate(txt, '{upper}', '{lower}'), '{word}')) AS w FROM templates),
tn AS (SELECT tid, label, count(*) AS n FROM tw GROUP BY ALL),
lines AS MATERIALIZED (
  SELECT doc_id, l, regexp_extract_all(string_split(low, chr(10))[l], '{word}') AS ws
  FROM (SELECT doc_id, low, unnest(range(1, len(string_split(low, chr(10))) + 1)) AS l
        FROM (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS low FROM documents))),
sized AS (SELECT *, coalesce(sum(len(ws)) OVER (PARTITION BY doc_id ORDER BY l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM lines),
dw AS MATERIALIZED (
  SELECT doc_id, l, len(ws) AS n, CAST(off + i - 1 AS BIGINT) AS pos, i - 1 AS k, ws[i] AS w
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM sized)),
blocks AS (
  SELECT doc_id, l, b, w FROM (
    SELECT doc_id, l, w, unnest(list_distinct([least(k // {BLOCK_WORDS // 2}, top), least(greatest(k // {BLOCK_WORDS // 2} - 1, 0), top)])) AS b
    FROM (SELECT *, CASE WHEN n <= {BLOCK_WORDS} THEN 0 ELSE (n - {BLOCK_WORDS} + {BLOCK_WORDS // 2 - 1}) // {BLOCK_WORDS // 2} END AS top FROM dw))),
common AS (SELECT doc_id, l, b, tid, label, count(DISTINCT w) AS c FROM blocks JOIN tw USING (w) GROUP BY ALL),
matched AS (SELECT doc_id, common.label, c / n AS part FROM common JOIN tn USING (tid) WHERE c >= ceil({THRESHOLD} * n - 1e-9)),
joined AS MATERIALIZED (SELECT doc_id, list(w ORDER BY pos) AS ws FROM dw GROUP BY doc_id),
base AS MATERIALIZED (
  SELECT doc_id, label, CAST(s - 1 AS BIGINT) AS pos
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS s FROM joined), phrases
  WHERE ws[s] = split_part(txt, ' ', 1) AND array_to_string(ws[s:s + len(string_split(txt, ' ')) - 1], ' ') = txt),
b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(part) AS score
       FROM (SELECT doc_id, label, 1.0::DOUBLE AS part FROM base UNION ALL SELECT doc_id, label, part FROM matched) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ws), 0) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM documents d LEFT JOIN joined USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN al USING (doc_id)
"""


OP9_SQL = op9_sql()
