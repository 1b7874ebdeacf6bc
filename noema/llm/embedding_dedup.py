"""Near-duplicate embeddings by an exact metric range join.

Cosine similarity of at least ``threshold`` is a Euclidean distance of at most
``r = sqrt(2 - 2 * threshold)`` between unit vectors.  Within each label, pivots
partition the vectors: a vector's home is its nearest pivot's cell.  A partner y
at home in another cell j satisfies ``d(y, p_j) <= d(y, p_i)``, so the triangle
inequality gives ``d(x, p_j) - d(x, p_i) <= 2 r`` for x at home in i; in Euclidean
space x is also at most r from the plane between both pivots.  A vector visits the
higher-numbered cells that pass both tests (with a margin for rounding), and cells
are joined independently: every pair meets in exactly one cell.

Equal vectors of a label are one class before the join.  Every label of several classes
gets pivots, about one for ``cell_rows`` classes, at least two and at most ``FAN``.  Cells of
over ``large_rows`` rows are split again in the same way, up to ``LEVELS`` levels in all, and
a pair is compared where, at every level, one of both is at home: again exactly once.  How
many pivots a cell of over ``large_rows`` rows gets follows from the copies that its first
rows would make (``_fans``): a deeper split that would bring the whole table over ``GROWTH``
rows a class, or send its rows to over ``SAVING`` of the new cells, is not made.  That decides on
the work only; all rows are dealt and compared.
The pivots are rows of a table and go to the tasks of their own cell only, 2,048 vectors
each; none reach the driver.

A cell lists names of vectors, and the table that is compared holds each vector once, with
its cells.  A cell's rows are dealt into panels of ``PANEL`` bytes of vectors; a task holds
one panel and streams at most ``SPAN`` others past it, so a dense cell is spread.  Tasks are
run in rounds whose shuffle is about half as large as the vectors, and a round's
shuffle is gone before the one after the next: disk follows the input, not the pairs.  A
task keeps its panel by pivots of its own and looks at a bound of the cosine in 16
dimensions first (``_Panel``); what passes is compared in double precision.  Tasks return
counts and a spanning forest, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from noema.llm import textcore as T
from noema.llm.components import components
from noema.llm.pairs import LINKS, by_task
from noema.llm.store import columns, drop, table, with_row_order

THRESHOLD, CELL_ROWS, LARGE_ROWS, BLOCK_ROWS = 0.98, 512, 8192, 1024
FAN, LEVELS, GROWTH, SAVING = 128, 3, 4, 0.6
PANEL, SPAN, ROUND = 24 << 20, 3, 64 << 20
_TASK, _SEEN, _NARROW = 2048, 1024, 16
_MARGIN = 1e-9


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; zeros where a length is not a number above 0 and below infinity."""
    with np.errstate(all="ignore"):
        x = x / np.linalg.norm(x, axis=1)[:, None]
    x[~np.isfinite(x).all(axis=1)] = 0
    return x


def _visits(x: np.ndarray, p: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """(each row's home, which cells it visits) for the pivots ``p``."""
    sq = np.maximum(2 - 2 * (x @ p.T), 0)
    home = sq.argmin(axis=1)
    near = sq[np.arange(len(x)), home]
    gap = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))[home]
    visit = (np.sqrt(sq) - np.sqrt(near)[:, None] <= 2 * r + _MARGIN) \
        & (sq - near[:, None] <= 2 * gap * r + _MARGIN) & (np.arange(len(p))[None, :] >= home[:, None])
    visit[np.arange(len(x)), home] = True
    return home, visit


def _fans(r: float, limit: float, saving: float, least: int, width: int):
    """The first rows of a cell of ``n`` -> how many of them are its pivots: the most, of ``fan`` and its halves, that
    make up to ``limit`` copies of a row and send it to up to ``saving`` of the new cells, or in a cell of several
    panels those of them that send the fewest rows to tasks; ``least`` if none does."""
    def work(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        x = _unit(_matrix(t["vec"].combine_chunks(), t["dim"][0].as_py()))[np.argsort(t["at"].to_numpy())]
        n, k, held = t["n"][0].as_py(), t["fan"][0].as_py(), max(1, PANEL // (width * x.shape[1]))
        best, cost = least, math.inf
        while k > 1:
            copies = _visits(x, x[:k], r)[1].sum() / len(x)
            sent = copies * (1 + math.ceil(n * copies / k / held) / 2) if n > held else -k
            if copies <= min(limit, saving * k) and sent < cost:
                best, cost = k, sent
            k //= 2
        return pa.RecordBatch.from_arrays([t["grp"].combine_chunks()[:1], pa.array([best], pa.int32())], ["grp", "k"])
    return by_task(work, ("grp",))


def _deal(r: float, level: int):
    """A cell's pivots and up to 2,048 of its rows -> a row for each new cell that a row visits; bit ``level``
    of ``own`` tells whether it is at home there."""
    def work(t: pa.Table) -> pa.RecordBatch | None:
        t = t.combine_chunks()
        x = _unit(_matrix(t["vec"].combine_chunks(), t["dim"][0].as_py()))
        pivot, rid = t["pivot"].to_numpy(), t["rid"].to_numpy()
        at = np.flatnonzero(pivot)
        p = x[at[np.argsort(rid[at])]]          # the same order in all tasks of the cell
        at = np.flatnonzero(~pivot)
        if not len(at):
            return None
        home, visit = _visits(x[at], p, r)
        row, cell = np.nonzero(visit)
        parent = t["grp"].to_numpy()[:1]
        grp = T.mix(T.pair_id(np.full(len(row), parent[0], np.int64).view(np.uint64), cell.astype(np.uint64)))
        own = t["own"].to_numpy()[at][row] | (cell == home[row]).astype(np.int64) << level
        order = np.lexsort((rid[at][row], cell))        # alike rows side by side: fewer bytes
        return pa.RecordBatch.from_arrays(
            [T.as_long(grp[order]), pa.array(np.repeat(parent, len(row))), pa.array(own[order]), pa.array(rid[at][row][order])],
            ["grp", "parent", "own", "rid"])
    return by_task(work, ("grp", "i"))


def _cells(reps: DataFrame, r: float, cell_rows: int, large_rows: int) -> tuple[DataFrame, int]:
    """((grp, own, rid): a row for each cell that a class visits; the bits of ``own`` that two
    rows must have between them to be compared)."""
    vec, full = dict(reps.dtypes)["vec"], (1 << LEVELS) - 1
    top = reps.select(F.xxhash64("label", "dim").alias("grp"), F.lit(0).cast("bigint").alias("own"), "rid", "dim", "vec")
    rows, limit = top.select("grp", "own", "rid"), float(GROWTH)
    for level in range(LEVELS):
        sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > (large_rows if level else 1))
        fan = F.least(F.lit(FAN), F.greatest(F.lit(2), F.ceil(F.col("n") / F.lit(cell_rows))))
        large = table(sizes.withColumn("fan", fan.cast("int")).withColumn("cuts", F.ceil(F.col("n") / F.lit(_TASK)).cast("int")),
                      "large-cells")
        if not large.limit(1).count():
            return rows, (1 << level) - 1
        classes = reps.count()
        if level:
            limit = GROWTH * classes / rows.count()

        def loaded(some: DataFrame, those: Column = F.lit(True)) -> DataFrame:
            """The rows of some cells, or those of them, with their vectors."""
            if not level:
                return top.join(some, "grp").where(those)
            return rows.join(some, "grp").where(those).join(reps.select("rid", "dim", "vec"), "rid")
        rank = F.xxhash64(F.lit(level), "rid")
        wanted = F.when(F.col("n") > large_rows, F.lit(FAN + _SEEN)).otherwise(F.col("fan"))
        # about twice as many rows as are wanted, and 64 more, are put in order
        few = F.pmod(rank, F.lit(1 << 40)) / F.lit(1 << 40) < (wanted * 2 + 64) / F.col("n")
        first = loaded(large, few).withColumn("at", F.row_number().over(Window.partitionBy("grp").orderBy(rank, "rid"))) \
            .where(F.col("at") <= wanted)
        first = table(first.select("grp", "n", "fan", "at", "own", "rid", "dim", "vec"), "first-rows")
        tried = first.where(F.col("n") > large_rows).select("grp", "n", "fan", "at", "dim", "vec").repartition("grp") \
            .sortWithinPartitions("grp").mapInArrow(_fans(r, limit, SAVING if level else 1, 0 if level else 2, _width(vec)), "grp bigint, k int")
        small = large.where(F.col("n") <= large_rows).select("grp", F.col("fan").alias("k"))
        divided = table(tried.where("k > 1").unionByName(small).join(large.select("grp", "n", "cuts"), "grp"), "divided-cells")
        if not divided.limit(1).count():
            return rows.withColumn("own", F.col("own").bitwiseOR(F.lit(full >> level << level))), full
        pivots = first.drop("n", "fan").join(divided, "grp").where("at <= k") \
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).withColumn("pivot", F.lit(True))
        cols = ["grp", "i", "pivot", "own", "rid", "dim", "vec"]
        # as many rounds of cells as their rows are times the vectors: each ships about all vectors once
        turns = max(1, math.ceil(divided.agg(F.sum("n")).first()[0] / classes))

        def deals() -> Iterator[DataFrame]:
            for turn in range(turns):
                some = F.pmod(F.xxhash64("grp"), F.lit(turns)) == turn
                dealt = loaded(divided.where(some)).withColumn("i", F.pmod(F.xxhash64("rid", F.lit(level)), F.col("cuts")).cast("int")) \
                    .withColumn("pivot", F.lit(False))
                yield dealt.select(cols).unionByName(pivots.where(some).select(cols)).repartition("grp", "i") \
                    .sortWithinPartitions("grp", "i").mapInArrow(_deal(r, level), "grp bigint, parent bigint, own bigint, rid bigint")
        split = table(deals(), "split-cells")
        whole = rows.join(divided, "grp", "left_anti").withColumn("own", F.col("own").bitwiseOR(F.lit(1 << level)))
        rows = table(whole.unionByName(split.drop("parent")), "cells")
        drop(first)
    return rows, full


def _width(vec: str) -> int:
    return 4 if vec == "array<float>" else 8


class _Panel:
    """Rows held by a task, compared with themselves and with rows that are streamed past them.

    They are kept in the order of ``own`` and of the nearest of the panel's pivots; a row meets
    those of its pivots' cells that the test of ``_visits`` leaves, in single precision with
    a margin for it.  Of these, only pairs are looked at whose cosine can be large enough: orthonormal
    directions Q and the rest's length make each unit vector x a short one, (Qx, |x - QQ'x|),
    and the cosine of two short ones is at least that of the vectors.  What passes is
    compared in double precision with the whole vectors.
    """

    def __init__(self, t: pa.Table, threshold: float, full: int, block_rows: int):
        x = _raw(t)
        n, dim = x.shape
        self.threshold, self.full, self.step, self.dim = threshold, full, 4 * block_rows, dim
        self.r = np.float32(math.sqrt(max(2 - 2 * threshold, 0)))
        self.bar, self.margin = np.float32(threshold - 1e-5), np.float32(2e-5 + 1e-6 * dim)
        g = np.random.default_rng(0)
        some = _unit(x[::max(1, n // 2048)].astype(np.float64))
        self.q = None
        if dim > _NARROW:
            self.q = np.linalg.qr(some.T @ (some @ g.normal(size=(dim, _NARROW - 1))))[0]
        k = min(1024, n // max(1, block_rows // 8))
        self.p = _unit(x[np.arange(k) * n // k].astype(np.float64)).astype(np.float32) if k > 1 else np.zeros((1, dim), np.float32)
        self.reach = np.sqrt(np.maximum(2 - 2 * (self.p @ self.p.T), 0)) * self.r + self.margin
        short, home, norm = [], [], []
        for a in range(0, n, self.step):
            s, unit, length = self._short(x[a:a + self.step])
            short.append(s)
            norm.append(length)
            home.append((unit @ self.p.T).argmax(axis=1))
        home, own = np.concatenate(home), t["own"].to_numpy()
        order = np.lexsort((home, own))
        self.x, self.short, self.norm = x[order], np.concatenate(short)[order], np.concatenate(norm)[order]
        self.own, rid = own[order], t["rid"].to_numpy()[order]
        home = home[order]
        edge = np.flatnonzero((self.own[1:] != self.own[:-1]) | (home[1:] != home[:-1])) + 1
        self.cells = [(int(home[a]), int(self.own[a]), int(a), int(b)) for a, b in zip([0, *edge], [*edge, n])]
        self.n = n
        # behind the panel's rows there is room for the rows that are met
        self.rid, self.copies, self.links, self.label = (np.concatenate([v, np.zeros(self.step, np.int64)]) for v in (
            rid, t["copies"].to_numpy()[order], np.zeros(n, np.int64), rid))
        self.edges: list[np.ndarray] = []

    def _short(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = x.astype(np.float64)
        with np.errstate(all="ignore"):
            norm = np.linalg.norm(x, axis=1)
        x = _unit(x)
        s = x
        if self.q is not None:
            s = x @ self.q
            s = np.column_stack([s, np.sqrt(np.maximum((x * x).sum(axis=1) - (s * s).sum(axis=1), 0))])
        return np.ascontiguousarray(s, np.float32), x.astype(np.float32), norm

    def itself(self) -> Iterator[pa.RecordBatch]:
        """Compare the panel's rows with each other."""
        for a in range(0, self.n, self.step):
            b = min(a + self.step, self.n)
            self._meet(self.x[a:b], self.own[a:b], a, True)
            yield from self._found()

    def meet(self, t: pa.Table) -> Iterator[pa.RecordBatch]:
        x, n = _raw(t), self.n
        rid, copies, own = (t[c].to_numpy() for c in ("rid", "copies", "own"))
        for a in range(0, len(x), self.step):
            b = min(a + self.step, len(x))
            here = slice(n, n + b - a)
            self.rid[here], self.copies[here], self.links[here], self.label[here] = rid[a:b], copies[a:b], 0, rid[a:b]
            self._meet(x[a:b], own[a:b], n, False)
            yield from self._found()
            yield from self._rows(here)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The panel's own rows, at the end."""
        yield from self._rows(slice(0, self.n))

    def _rows(self, here: slice) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(self.links[here]) + here.start
        if len(some):
            yield _links(self.rid[some], self.links[some], self.label[some])

    def _found(self) -> Iterator[pa.RecordBatch]:
        """The labels that were joined since the last call."""
        if self.edges:
            e = np.unique(np.concatenate(self.edges, axis=1), axis=1)
            self.edges = []
            yield _links(e[0], np.zeros(e.shape[1], np.int64), e[1])

    def _meet(self, y: np.ndarray, own: np.ndarray, first: int, same: bool) -> None:
        """Compare with rows ``y``, whose place among labels and links begins at ``first``; with rows of the panel
        itself, the earlier of two is the left one."""
        short, unit, norm = self._short(y)
        near = unit @ self.p.T
        home = near.argmax(axis=1)
        best = near[np.arange(len(y)), home]
        for a in range(0, len(y), 1024):
            near[a:a + 1024] += self.reach[home[a:a + 1024]]
        visit = np.ascontiguousarray((near >= best[:, None]).T)
        fits = {o: None if ((own | o) == self.full).all() else (own | o) == self.full for o in np.unique(self.own[:self.n])}
        sparse: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for cell, o, start, end in self.cells:
            if same and start >= first + len(y):
                continue
            at = np.flatnonzero(visit[cell] if fits[o] is None else visit[cell] & fits[o])
            for b in range(0, len(at), 1024):
                right = at[b:b + 1024]
                thin = short[right].T
                for a in range(start, end, 256):
                    left = slice(a, min(a + 256, end))
                    bound = self.short[left] @ thin
                    if not bound.max() >= self.bar:
                        continue
                    some = bound >= self.bar
                    if same:
                        some &= np.arange(left.start, left.stop)[:, None] < (first + right)[None, :]
                    i, j = np.nonzero(some)
                    if len(i) * 8 > some.size:
                        cos = self.x[left].astype(np.float64) @ y[right].astype(np.float64).T
                        with np.errstate(all="ignore"):
                            cos /= self.norm[left][:, None] * norm[right][None, :]
                        self._dense((cos >= self.threshold) & some, np.arange(left.start, left.stop), first + right)
                    elif len(i):
                        sparse.append((i + left.start, right[j]))
                        waiting += len(i)
                        if waiting > 1 << 18:
                            self._sparse(sparse, y, norm, first)
                            sparse, waiting = [], 0
        if sparse:
            self._sparse(sparse, y, norm, first)

    def _sparse(self, pairs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, norm: np.ndarray, first: int) -> None:
        i, j = (np.concatenate(v) for v in zip(*pairs))
        good, step = np.zeros(len(i), bool), max(1, (1 << 20) // self.dim)
        for a in range(0, len(i), step):
            s, t = i[a:a + step], j[a:a + step]
            cos = np.einsum("ij,ij->i", self.x[s].astype(np.float64), y[t].astype(np.float64))
            with np.errstate(all="ignore"):
                good[a:a + step] = cos / (self.norm[s] * norm[t]) >= self.threshold
        i, j = i[good], j[good] + first
        if not len(i):
            return
        np.add.at(self.links, i, self.copies[j])
        np.add.at(self.links, j, self.copies[i])
        rows, places = np.unique(np.concatenate([i, j]), return_inverse=True)
        a, b = places[:len(i)], places[len(i):]
        label = self.label[rows]
        while True:
            low = np.minimum(label[a], label[b])
            if (low == label[a]).all() and (low == label[b]).all():
                break
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
        self._relabel(rows, label)

    def _dense(self, linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        self.links[left] += linked @ self.copies[right]
        self.links[right] += self.copies[left] @ linked
        a, b = linked.any(axis=1), linked.any(axis=0)
        if not a.any():
            return
        left, right, linked = left[a], right[b], linked[a][:, b]
        label = self.label
        if (label[left] == label[left[0]]).all() and (label[right] == label[left[0]]).all():
            return
        rows, places = np.unique(np.concatenate([left, right]), return_inverse=True)
        a, b = places[:len(left)], places[len(left):]
        label, far = label[rows], np.iinfo(np.int64).max
        while True:
            before = label.copy()
            np.minimum.at(label, a, np.where(linked, label[b][None, :], far).min(axis=1))
            np.minimum.at(label, b, np.where(linked, label[a][:, None], far).min(axis=0))
            if (label == before).all():
                break
        self._relabel(rows, label)

    def _relabel(self, rows: np.ndarray, label: np.ndarray) -> None:
        """Give rows a smaller label and note what was joined: the old label to the new one."""
        old = self.label[rows]
        new = label != old
        if new.any():
            self.edges.append(np.unique(np.stack([old[new], label[new]]), axis=1))
            self.label[rows] = label


def _raw(t: pa.Table) -> np.ndarray:
    values = t["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if values.dtype not in (np.float32, np.float64):
        values = values.astype(np.float64)
    return values.reshape(-1, t["dim"][0].as_py())


def _links(rid: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rid), pa.array(links), pa.array(root)], ["rid", "links", "root"])


def _compare(threshold: float, full: int, block_rows: int):
    """Rows sorted by task, a task's panel (``side`` 0) first -> links and roots of those that have links."""
    def panel_of(held: list[pa.RecordBatch], key: tuple) -> Iterator:
        t = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        panel = _Panel(t, threshold, full, block_rows)
        del t
        if key[2] == 0:
            yield from panel.itself()
        return panel

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, panel = None, [], None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("grp", "i", "s", "side")]
            edge = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
            cuts = [0, *edge.tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                now, part = tuple(c[a] for c in cols[:3]), batch.slice(a, b - a)
                if now != key:
                    if held:
                        panel = yield from panel_of(held, key)
                    if panel is not None:
                        yield from panel.rows()
                    key, held, panel = now, [], None
                if cols[3][a] == 0:
                    held.append(part)
                    continue
                if held:
                    panel = yield from panel_of(held, key)
                    held = []
                if panel is not None:
                    yield from panel.meet(pa.Table.from_batches([part]))
        if held:
            panel = yield from panel_of(held, key)
        if panel is not None:
            yield from panel.rows()
    return run


def _rounds(reps: DataFrame, cells: DataFrame, threshold: float, full: int, block_rows: int) -> Iterator[DataFrame]:
    """The links that each round of tasks finds.

    A panel of a cell is held by one task, or several, each of which streams up to ``SPAN`` of the next
    panels past it (counted in a ring, up to half of it): every two panels meet once.
    """
    width = _width(dict(reps.dtypes)["vec"])
    sizes = cells.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = cells.join(sizes, "grp").groupBy("rid").agg(F.collect_list(F.struct("grp", "own", "n")).alias("cells"))
    dealt = table(reps.join(listed, "rid").select("rid", "copies", "dim", "vec", "cells"), "dealt-vectors")
    drop(reps)

    held = F.greatest(F.lit(block_rows), F.floor(F.lit(PANEL) / (F.col("dim") * width)))
    sent = dealt.withColumn("cell", F.explode("cells")).select("rid", "copies", "dim", "vec", "cell.*") \
        .withColumn("ring", F.ceil(F.col("n") / held)).withColumn("half", F.floor(F.col("ring") / 2)) \
        .withColumn("tasks", F.greatest(F.lit(1), F.ceil(F.col("half") / SPAN)))
    bytes_ = F.col("dim") * width + 64
    volume = sent.agg(F.sum((F.col("half") + F.col("tasks")) * bytes_)).first()[0] or 0
    vectors = dealt.agg(F.sum(bytes_)).first()[0] or 0
    rounds = max(1, math.ceil(volume / max(ROUND, vectors / 2)))
    e, s = F.col("e"), F.col("s")
    left = (e == 0) | (e > F.col("half"))
    sent = sent.withColumn("panel", F.pmod(F.xxhash64("rid"), F.col("ring"))) \
        .withColumn("e", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("half") + F.col("tasks") - 1))) \
        .withColumn("i", F.when(left, F.col("panel")).otherwise(F.pmod(F.col("panel") - e, F.col("ring")))) \
        .withColumn("s", F.when(e == 0, e).when(left, e - F.col("half")).otherwise(F.floor((e - 1) / SPAN))) \
        .where(left | (e * 2 < F.col("ring")) | (F.col("i") < F.col("half"))) \
        .select("grp", "i", "s", F.when(left, 0).otherwise(1).alias("side"), "own", "rid", "copies", "dim", "vec")
    for k in range(rounds):
        mine = sent.where(F.pmod(F.xxhash64("grp", "i", s), F.lit(rounds)) == k)
        yield mine.repartition("grp", "i", "s").sortWithinPartitions("grp", "i", "s", "side") \
            .mapInArrow(_compare(threshold, full, block_rows), LINKS)


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                           vec_col: str = "embedding", label_col: str = "label", cell_rows: int = CELL_ROWS,
                           large_rows: int = LARGE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``vectors``: id; n_links (other vectors of its label with a
    cosine of at least ``threshold``, in double precision); component_id (smallest
    id reachable by links, itself included); kept (id = component_id).

    Vectors that are null, zero or empty, or hold null or non-finite components, and
    those without a label link with nothing.  Vectors of different lengths do not
    link.  Rows equal in id, vector and label are one vector and get the same result;
    null ids come last.  An empty table gives an empty result.  Other columns are
    ignored.  Labels are whole numbers or strings.
    """
    source = columns(vectors, id=id_col, vec=vec_col, label=label_col)
    if dict(source.dtypes)["label"] not in ("tinyint", "smallint", "int", "bigint"):
        source = source.withColumn("label", F.when(F.col("label").isNotNull(), F.xxhash64("label")))
    source = source.withColumn("item", F.struct("vec", F.col("label").cast("bigint").alias("label"))).select("id", "item")
    rows, index = with_row_order(source, "item")
    rows = rows.select("rid", "item.vec", "item.label")
    fine = (F.col("label").isNotNull() & F.col("vec").isNotNull()
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists("vec", lambda x: x != 0))
    plus = F.transform("vec", lambda x: x + F.lit(0).cast("float"))  # -0.0 equals 0.0
    good = table(rows.where(F.coalesce(fine, F.lit(False))).withColumn("vec", plus).select(
        "rid", "label", F.size("vec").cast("bigint").alias("dim"),
        F.xxhash64("vec").alias("h1"), F.xxhash64(F.reverse("vec"), F.lit(1)).alias("h2")), "vectors")
    key = ["label", "dim", "h1", "h2"]
    classes = table(good.groupBy(*key).agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    reps = table(rows.join(classes.select("rep", "copies", "dim"), F.col("rid") == F.col("rep"))
                 .select("rid", "copies", "label", "dim", "vec"), "vector-reps")

    cells, full = _cells(reps, math.sqrt(2 - 2 * threshold), cell_rows, large_rows)
    checked = table(_rounds(reps, cells, threshold, full, block_rows), "vector-links")
    links = checked.groupBy("rid").agg(F.sum("links").alias("links"))
    joined = components(checked.select(F.col("rid").alias("a"), F.col("root").alias("b")))

    per_class = classes.join(links, F.col("rep") == F.col("rid"), "left").drop("rid") \
        .join(joined, F.col("rep") == F.col("node"), "left").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"))
    linked = good.select("rid", *key).join(per_class, key).select(F.col("rid").alias("r"), "n_links", "component")
    out = rows.select("rid").join(linked, F.col("rid") == F.col("r"), "left").select(
        "rid", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "rid").alias("component"))
    out = out.withColumn("kept", F.col("rid") == F.col("component"))
    kind = dict(source.dtypes)["id"]
    if index is None:
        return out.select(F.col("rid").cast(kind).alias(id_col), "n_links",
                          F.col("component").cast(kind).alias("component_id"), "kept")
    roots = index.select(F.col("rid").alias("root"), F.col("id").alias("component_id"))
    out = index.join(out, "rid").join(roots, F.col("component") == F.col("root"))
    mine = source.select(F.col("id").alias("row_id"), F.xxhash64("item").alias("row_key"))
    return mine.join(out, mine["row_id"].eqNullSafe(out["id"]) & (mine["row_key"] == out["key"])).select(
        F.col("row_id").alias(id_col), "n_links", "component_id", "kept")


def op3(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``embeddings``, cosine 0.98, equal labels."""
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: The exact join in DuckDB SQL.
OP3_SQL = r"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS k FROM link GROUP BY a)
SELECT vec_id, coalesce(k, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON comp.a = vec_id LEFT JOIN deg ON deg.a = vec_id
"""
