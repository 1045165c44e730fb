"""Pairs of embeddings within a cosine threshold, by dual traversal of cover trees.

On the unit sphere a cosine is a distance: |x - y|^2 = 2 - 2 cos. Each label is cut into cells
around pivots, the top level of the tree; pairs of cells that their covering radii keep apart
are dropped. Cells are cut into blocks of bounded size, and each pair of blocks is a task: it
builds a cover tree for either block (nested levels, radii halved from level to level) and
walks both at once. A pair of nodes is dropped when the distance of the centres exceeds both
covering radii and the threshold, and is taken whole, uncounted pair by pair, when the
threshold exceeds all three. What remains is decided by the cosine itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, stored
from curbline.llm.components import components

COSINE = 0.98
LEAF = 8
BLOCK = 512
# Pivots over all labels at most, and the vectors that one stands for at least.
PIVOTS, CELL = 4096, 512
# Wider than any rounding of a distance; what lies within it is decided by the cosine.
SLACK = 1e-7
CHUNK = 1 << 15


class CoverTree:
    """Flat cover tree of the rows of ``x`` (unit length). ``order`` lists the rows so that every
    node is a range of it; the rows of a node lie within ``radius`` of its centre."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.apart = np.sqrt(np.maximum(0, 2 - 2 * (x @ x.T)))  # BLOCK x BLOCK at most
        self.order = np.arange(len(x))
        self.center, self.radius, self.begin, self.end = [], [], [], []
        self.children: list[tuple[int, int]] = []
        self._grow()
        self.center = np.array(self.center)
        self.radius = np.array(self.radius)
        self.begin, self.end = np.array(self.begin), np.array(self.end)
        bounds = np.array(self.children)
        self.first, self.count = bounds[:, 0], bounds[:, 1] - bounds[:, 0]

    def _distance(self, center: int, rows: np.ndarray) -> np.ndarray:
        return self.apart[center].take(rows)

    def _add(self, center: int, far: np.ndarray, begin: int, end: int) -> None:
        self.center.append(center)
        self.radius.append(float(far.max()))
        self.begin.append(begin)
        self.end.append(end)
        self.children.append((0, 0))

    def _grow(self) -> None:
        self._add(0, self._distance(0, self.order), 0, len(self.order))
        at = 0
        while at < len(self.center):
            begin, end, radius = self.begin[at], self.end[at], self.radius[at]
            if end - begin > LEAF and radius > SLACK:
                self.children[at] = self._split(self.center[at], begin, end, radius / 2)
            at += 1

    def _split(self, center: int, begin: int, end: int, radius: float) -> tuple[int, int]:
        """Children with centres more than ``radius`` apart; the node's centre is the first."""
        first, rest, out = len(self.center), self.order[begin:end].copy(), begin
        while len(rest):
            far = self._distance(center, rest)
            near = far <= radius
            near[rest == center] = True
            own = rest[near]
            self.order[out : out + len(own)] = own
            self._add(center, far[near], out, out + len(own))
            out += len(own)
            rest, far = rest[~near], far[~near]
            if len(rest):
                center = int(rest[far.argmax()])
        return first, len(self.center)


def expand(first: np.ndarray, count: np.ndarray, other: np.ndarray):
    """Every pair with all children of its first node."""
    total = int(count.sum())
    start = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return start + np.arange(total), np.repeat(other, count)


def ranges(begin: np.ndarray, end: np.ndarray):
    """Positions of all ranges, and the range of each."""
    return expand(begin, end - begin, np.arange(len(begin)))


def distances(a: CoverTree, b: CoverTree, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of rows i of a and j of b, pair by pair; by one product where most combinations occur."""
    rows, i_at = np.unique(i, return_inverse=True)
    columns, j_at = np.unique(j, return_inverse=True)
    if 4 * len(i) >= len(rows) * len(columns):
        return np.sqrt(np.maximum(0, 2 - 2 * (a.x[rows] @ b.x[columns].T)))[i_at, j_at]
    out = np.empty(len(i))
    for s in range(0, len(i), CHUNK):
        part = slice(s, s + CHUNK)
        cosines = np.einsum("ij,ij->i", a.x[i[part]], b.x[j[part]])
        out[part] = np.sqrt(np.maximum(0, 2 - 2 * cosines))
    return out


def dual_traversal(a: CoverTree, b: CoverTree, cosine: float = COSINE):
    """Linked rows (i of a, j of b), and whole ranges that are linked (begin, end in the order of
    a, begin, end in that of b)."""
    reach = np.sqrt(2 - 2 * cosine)
    left, right = np.zeros(1, np.int64), np.zeros(1, np.int64)
    single, whole = [], []
    while len(left):
        gap = distances(a, b, a.center[left], b.center[right])
        both = a.radius[left] + b.radius[right]
        inside = gap + both <= reach - SLACK
        whole.append(
            np.stack(
                [
                    a.begin[left[inside]],
                    a.end[left[inside]],
                    b.begin[right[inside]],
                    b.end[right[inside]],
                ],
                1,
            )
        )
        open_ = ~inside & (gap <= both + reach + SLACK)
        left, right = left[open_], right[open_]
        leaf = (a.count[left] == 0) & (b.count[right] == 0)
        for s in range(0, int(leaf.sum()), CHUNK):
            u, v = left[leaf][s : s + CHUNK], right[leaf][s : s + CHUNK]
            i, k = ranges(a.begin[u], a.end[u])
            j, k = expand(b.begin[v][k], (b.end - b.begin)[v][k], np.arange(len(i)))
            i, j = a.order[i[k]], b.order[j]
            close = np.einsum("ij,ij->i", a.x[i], b.x[j]) >= cosine - SLACK
            single.append(np.stack([i[close], j[close]], 1))
        left, right = left[~leaf], right[~leaf]
        # The wider of the two nodes goes down a level; a leaf stays.
        down = (a.count[left] > 0) & (
            (a.radius[left] >= b.radius[right]) | (b.count[right] == 0)
        )
        l1, r1 = expand(a.first[left[down]], a.count[left[down]], right[down])
        r2, l2 = expand(b.first[right[~down]], b.count[right[~down]], left[~down])
        left, right = np.concatenate([l1, l2]), np.concatenate([r1, r2])
    none = np.zeros((0, 2), np.int64)
    return np.concatenate([none, *single]), np.concatenate(whole)


class Union:
    """Disjoint sets of numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)


def links_of_blocks(x, y, weight_x, weight_y, same: bool, cosine: float = COSINE):
    """Raw vectors of two blocks, and how many vectors each stands for. Returns the weight linked
    to each of x, that of y, and pairs (i, j of x then y) that span the same components as
    all links do. For a block with itself, all is counted on the side of x."""
    length_x, length_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    a = CoverTree(x / length_x[:, None])
    b = a if same else CoverTree(y / length_y[:, None])
    pairs, whole = dual_traversal(a, b, cosine)
    i, j = pairs[:, 0], pairs[:, 1]
    exact = np.einsum("ij,ij->i", x[i], y[j]) / (length_x[i] * length_y[j]) >= cosine
    if same:
        exact &= i != j
    i, j = i[exact], j[exact]
    to_x = np.bincount(i, weight_y[j], len(x)).astype(float)
    to_y = np.bincount(j, weight_x[i], len(y)).astype(float)
    shift = 0 if same else len(x)
    sets = Union(len(x) + (0 if same else len(y)))
    for u, v in np.unique(np.stack([i, j + shift], 1), axis=0).tolist():
        sets.join(u, v)
    sum_x = np.concatenate([[0], np.cumsum(weight_x[a.order])])
    sum_y = np.concatenate([[0], np.cumsum(weight_y[b.order])])
    more_x, more_y = np.zeros(len(x) + 1), np.zeros(len(y) + 1)
    for b1, e1, b2, e2 in whole.tolist():
        more_x[b1] += sum_y[e2] - sum_y[b2]
        more_x[e1] -= sum_y[e2] - sum_y[b2]
        more_y[b2] += sum_x[e1] - sum_x[b1]
        more_y[e2] -= sum_x[e1] - sum_x[b1]
        root = int(b.order[b2]) + shift
        for k in a.order[b1:e1].tolist():
            sets.join(k, root)
        for k in b.order[b2:e2].tolist():
            sets.join(k + shift, root)
    to_x[a.order] += np.cumsum(more_x)[:-1]
    to_y[b.order] += np.cumsum(more_y)[:-1]
    if same:
        # Ranges that a node shares with itself hold each vector's own weight.
        own = np.zeros(len(x) + 1)
        for b1, e1, b2, e2 in whole.tolist():
            low, high = max(b1, b2), min(e1, e2)
            if low < high:
                own[low] += 1
                own[high] -= 1
        to_x[a.order] -= np.cumsum(own)[:-1] * weight_x[a.order]
    roots = [(k, r) for k in range(len(sets.parent)) if (r := sets.root(k)) != k]
    return to_x, to_y, roots


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _assigned(classes: DataFrame, pivots: dict) -> DataFrame:
    """Each vector with the nearest pivot of its label and size, and the distance to it."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS vectors at most

    def run(batches):
        for rows in batches:
            label, dim = (rows.column(c).to_numpy() for c in ("label", "dim"))
            cell, far = np.full(rows.num_rows, -1, np.int64), np.full(rows.num_rows, 2.0)
            vectors = rows.column("x")
            for key in set(zip(label.tolist(), dim.tolist(), strict=True)):
                if key not in shared.value:
                    continue
                own = np.flatnonzero((label == key[0]) & (dim == key[1]))
                x = _matrix(vectors.take(pa.array(own)))
                x /= np.linalg.norm(x, axis=1)[:, None]
                cosine = x @ shared.value[key].T
                cell[own] = cosine.argmax(1)
                far[own] = np.sqrt(np.maximum(0, 2 - 2 * cosine.max(1)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(cell), pa.array(far)], [*rows.schema.names, "cell", "far"]
            )

    return map_arrow(classes, run, classes_schema("cell bigint", "far double"))


def classes_schema(*more: str) -> str:
    return ", ".join(
        ["rep bigint", "label bigint", "dim int", "x array<double>", "copies bigint", *more]
    )


def near_pairs(cells, pivots: dict, reach: float):
    """Pairs of cells, by label and size, that their radii do not keep apart."""
    of: dict[tuple, list] = {}
    for r in cells:
        of.setdefault((r["label"], r["dim"]), []).append(r)
    for key, own in of.items():
        for p, first in enumerate(own):
            for second in own[p:]:
                if first["cell"] >= 0 and second["cell"] >= 0:
                    x, y = pivots[key][first["cell"]], pivots[key][second["cell"]]
                    gap = np.sqrt(max(0.0, 2 - 2 * float(x @ y)))
                    if gap > first["radius"] + second["radius"] + reach + SLACK:
                        continue
                yield key, first, second


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label).

    Vectors that are null, empty or zero, have a null or non-finite component, or no label,
    link with nothing; neither do vectors of different sizes. Equal vectors of a label are one
    node with as many copies. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    fine = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    valid = F.col("label").isNotNull() & fine & F.exists("x", lambda v: v != 0)
    x = F.transform("x", lambda v: v + F.lit(0.0))  # no negative zeros
    keyed = rows.where(valid & F.col("vec_id").isNotNull()).select(
        "vec_id",
        "label",
        F.size("x").alias("dim"),
        x.alias("x"),
    )
    keyed = keyed.withColumns(
        {"key1": F.xxhash64("label", "x"), "key2": F.xxhash64(F.lit(5), "x", "label")}
    )
    classes = keyed.groupBy("key1", "key2").agg(
        F.min("vec_id").alias("rep"),
        F.first("label").alias("label"),
        F.first("dim").alias("dim"),
        F.first("x").alias("x"),
        F.count("*").alias("copies"),
    )
    classes = stored(classes, "vector-classes")
    names = ["rep", "label", "dim", "x", "copies"]
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # One pivot for CELL vectors, fewer where that would be more than PIVOTS in all.
    rate = min(1 / CELL, PIVOTS / 2 / max(1, total))
    chance = F.pmod(F.xxhash64(F.lit(9), "rep"), F.lit(1 << 30))
    chosen = classes.where(chance < int(rate * (1 << 30))).orderBy("rep").limit(PIVOTS)
    pivots: dict[tuple, list] = {}
    for r in chosen.collect():
        pivots.setdefault((r["label"], r["dim"]), []).append(r["x"])
    pivots = {k: np.array(v) / np.linalg.norm(v, axis=1)[:, None] for k, v in pivots.items()}

    placed = stored(_assigned(classes.select(*names), pivots), "vector-cells")
    cell = placed.groupBy("label", "dim", "cell").agg(
        F.max("far").alias("radius"), F.count("*").alias("n")
    )
    reach = float(np.sqrt(2 - 2 * cosine))
    # Cells without a pivot, of labels that have none, are one for a label.
    known = cell.where("cell >= 0").collect()
    tasks = []
    for key, a, b in near_pairs(known, pivots, reach):
        tasks.append((*key, a["cell"], b["cell"], -(-a["n"] // BLOCK), -(-b["n"] // BLOCK)))
    schema = "label bigint, dim int, a bigint, b bigint, blocks_a bigint, blocks_b bigint"
    alone = cell.where("cell < 0").select(
        "label",
        "dim",
        F.col("cell").alias("a"),
        F.col("cell").alias("b"),
        F.ceil(F.col("n") / BLOCK).alias("blocks_a"),
        F.ceil(F.col("n") / BLOCK).alias("blocks_b"),
    )
    tasks = stored(spark.createDataFrame(tasks, schema).unionByName(alone), "cell-pairs")

    def side(own: str, other: str, is_left: bool) -> DataFrame:
        """Vectors of the cells on one side, once for each block on the other side."""
        joined = placed.join(
            tasks.withColumnRenamed(own, "cell"), ["label", "dim", "cell"]
        ).withColumn("own", F.pmod(F.xxhash64("rep"), F.col(f"blocks_{own}")))
        joined = joined.withColumn(
            "others", F.explode(F.sequence(F.lit(0), F.col(f"blocks_{other}") - 1))
        )
        mine, theirs = F.col("own").cast("bigint"), F.col("others").cast("bigint")
        pair = (F.col("cell"), F.col(other)) if is_left else (F.col(other), F.col("cell"))
        blocks = (mine, theirs) if is_left else (theirs, mine)
        shown = joined.select(
            "label",
            "dim",
            pair[0].alias("a"),
            pair[1].alias("b"),
            blocks[0].alias("i"),
            blocks[1].alias("j"),
            F.lit(is_left).alias("is_left"),
            "rep",
            "x",
            "copies",
        )
        # Within a cell, each pair of blocks is one task, and a block with itself has one side.
        return shown.where("a <> b OR i < j" + (" OR i = j" if is_left else ""))

    both = side("a", "b", True).unionByName(side("b", "a", False))

    def run(key, table):
        left = table.column("is_left").to_numpy()
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        x = _matrix(table.column("x"))
        a, b = np.flatnonzero(left), np.flatnonzero(~left)
        same = key[2].as_py() == key[3].as_py() and key[4].as_py() == key[5].as_py()
        if not len(a) or not (same or len(b)):
            return pa.table({"rep": pa.array([], pa.int64()), "n": [], "root": []}, LINKS)
        b = a if same else b
        to_a, to_b, roots = links_of_blocks(x[a], x[b], copies[a], copies[b], same, cosine)
        ids = rep[a] if same else np.concatenate([rep[a], rep[b]])
        n = to_a if same else np.concatenate([to_a, to_b])
        root = ids.copy()
        for k, r in roots:
            root[k] = ids[r]
        n = np.rint(n).astype(np.int64)
        used = n > 0
        return pa.table({"rep": ids[used], "n": n[used], "root": root[used]}, LINKS)

    found = both.groupBy("label", "dim", "a", "b", "i", "j").applyInArrow(
        run, "rep bigint, n bigint, root bigint"
    )
    found = stored(found, "vector-links")
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("n").alias("n"))
    described = (
        classes.select("key1", "key2", "rep", "copies")
        .join(linked, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "key1",
            "key2",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linking = keyed.select("vec_id", "key1", "key2").join(described, ["key1", "key2"])
    others = rows.where(~F.coalesce(valid, F.lit(False)) | F.col("vec_id").isNull())
    result = linking.select("vec_id", "n_links", "component_id").unionByName(
        others.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


LINKS = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])
