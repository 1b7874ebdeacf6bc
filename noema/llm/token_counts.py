"""Token counts by offset-mapped attribution.

Each whole document is encoded once by a byte-level BPE tokenizer.  Its tokens cover
the text's bytes without gaps, so their spans are the running sums of the tokens'
lengths.  Sections (or any fields of the text) are spans as well, and both sorted
span lists are interval-joined by binary search in the task that has the document.

A token that crosses a boundary goes to the section that holds most of its bytes, and
on a tie to the earlier one; so every token is counted exactly once and the
sections of a document add up to its tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from noema.llm import textcore as T
from noema.llm.store import columns

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the tokenizer of this vocabulary cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_vocabulary(spark, path: str) -> dict[bytes, int]:
    """A rank file (base64 token, rank) by Spark's readers, so it may be in any store.
    Its size is the vocabulary's."""
    rows = spark.read.text(path).collect()
    return {base64.b64decode(a): int(r) for a, r in (x.value.split() for x in rows if x.value.strip())}


def line_sections(data: bytes) -> np.ndarray:
    """Section starts: each line with its line end (a text without bytes has none)."""
    if not data:
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return np.concatenate([[0], ends[ends < len(data)]])


def attribute(ends: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Section of each token: ``ends`` are the tokens' ends (their starts are the ends
    before), ``starts`` the sections' starts; both cover 0 to ``size``."""
    if not len(ends):
        return np.zeros(0, np.int64)
    begin = np.concatenate([[0], ends[:-1]])
    stops = np.append(starts[1:], size)
    one = np.searchsorted(starts, begin, "right") - 1
    last = np.searchsorted(starts, ends, "left") - 1
    out = one.copy()
    for t in np.flatnonzero(last > one):  # crosses a boundary
        s = np.arange(one[t], last[t] + 1)
        part = np.minimum(stops[s], ends[t]) - np.maximum(starts[s], begin[t])
        out[t] = s[part.argmax()]
    return out


def _encode(ranks: dict[bytes, int], sections):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        coder = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            width[rank] = len(token)
        for b in batches:
            for lo, hi, data, offsets in T.runs(b.column("text")):
                raw, n_tokens, n_cross, cells, cut = data.tobytes(), [], [], [], [0]
                for i, j in zip(offsets[:-1], offsets[1:]):
                    text = raw[i:j]
                    ends = np.cumsum(width[np.array(coder.encode_ordinary(text.decode()), np.int64)])
                    starts = sections(text)
                    own = attribute(ends, starts, len(text))
                    first = np.concatenate([[0], ends[:-1]])[:len(ends)]
                    n_tokens.append(len(ends))
                    n_cross.append(int(((np.searchsorted(starts, ends, "left") - 1)
                                        > (np.searchsorted(starts, first, "right") - 1)).sum()))
                    cells.append((starts, np.append(starts[1:], len(text))[:len(starts)],
                                  np.bincount(own, minlength=len(starts)) if len(starts) else starts))
                    cut.append(cut[-1] + len(starts))
                flat = [np.concatenate([c[k] for c in cells]).astype(np.int64) for k in range(3)]
                spans = pa.StructArray.from_arrays([pa.array(x) for x in flat], ["start", "stop", "tokens"])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(n_tokens, pa.int64()),
                     pa.array(n_cross, pa.int64()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), spans)],
                    ["id", "n_bytes", "n_tokens", "n_crossing", "sections"])
    return run


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, sections=line_sections, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, n_crossing (tokens that lie in
    several sections) and ``sections``, an array of (start, stop, tokens) in byte
    offsets that covers the text.

    ``sections`` maps a text's bytes to the sorted starts of its sections, the first
    being 0.  Null and empty texts have no tokens and no sections.  Repeated rows and
    ids are counted each on their own, null ids stay null, an empty table gives an
    empty result, other columns are ignored.
    """
    ranks = read_vocabulary(docs.sparkSession, vocabulary)
    source = columns(docs, id=id_col, text=text_col)
    out = source.mapInArrow(_encode(ranks, sections), f"id {dict(source.dtypes)['id']}, n_bytes bigint, n_tokens bigint, "
                            "n_crossing bigint, sections array<struct<start:bigint,stop:bigint,tokens:bigint>>")
    return out.withColumnRenamed("id", id_col)


def op7(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``: tokens of each line (section numbers from 0)."""
    out = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_tokens", "n_crossing", F.size("sections").cast("bigint").alias("n_sections"),
                      F.transform("sections", lambda s: s["tokens"]).alias("section_tokens"))
