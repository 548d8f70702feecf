"""Embedding near-dedup by int8 tile products with error bounds, exact at cosine >= ``least``.

* *Copies.* Equal vectors become one node with a number of copies, so a group of copies costs one row.
* *Cells.* Vectors go to the nearest of about sqrt(n)/8 pivots. For unit vectors a, b with cosine >= least the distance
  is at most d = sqrt(2 - 2 least). If a is nearest to pivot c and b to c', then b lies at most d from the plane between
  them; so b visits the cell of c only when it is that near, and no linked pair is missed. Each pair of cells is compared
  in the lower-numbered one.
* *Tiles.* A cell's own and visiting vectors are dealt by hash into tiles of about ``tile`` rows. A task takes one pair of
  tiles of a cell, so a cell with any share of the rows only makes more tasks, of the same size.
* *Products.* Within a task the unit vectors are quantised to int8 with one scale s; e(u) is the length of what rounding
  left over for u. Then |u.v - s^2 q(u).q(v)| <= e(u) + e(v) + 3 e(u) e(v), so only pairs whose quantised product lies
  within that bound of the threshold are computed again, in double precision from the original vectors.
* *Result.* A task returns sums of links per vector and a spanning forest of its links, never the pairs. Components are
  joined up over all tasks.

Defined results: a vector that is null, empty, all zero or holds null or non-finite components is linked with nothing
and kept; vectors of different dimensions are not linked; equal rows are copies, each counting the others as links; a
null vec_id is linked like any other and is kept only if alone in its component; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dayloom.llm.components import components
from dayloom.llm.sampling import smallest_marks
from dayloom.session import stored

LEAST = 0.9
TILE = 4096
MAX_CELLS = 4096
_ROWS = 1024  # of a tile, multiplied at once
_SLACK = 1e-9


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors in double precision from a list column without nulls."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _cells(unit: np.ndarray, pivots: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Own cell of each vector, and which lower-numbered cells it visits (a matrix of booleans)."""
    near = unit @ pivots.T
    own = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))[own]
    ahead = near[np.arange(len(unit)), own][:, None] - near
    visits = ahead <= math.sqrt(2 - 2 * least) * apart + _SLACK
    return own, visits & (np.arange(len(pivots)) < own[:, None])


def _count_cells(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, least: float) -> Iterator[pa.RecordBatch]:
    k = len(pivots)
    total = np.zeros((2, k), np.int64)
    for batch in batches:
        if batch.num_rows:
            own, visits = _cells(_matrix(batch.column(0)), pivots, least)
            total += np.stack((np.bincount(own, minlength=k), visits.sum(axis=0)))
    yield pa.record_batch(
        {"cell": pa.array(np.arange(k)), "own": pa.array(total[0]), "visiting": pa.array(total[1])}
    )


def _deal(
    batches: Iterator[pa.RecordBatch], pivots: np.ndarray, least: float, tiles: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Every vector once for each task it takes part in, as a row or as a column of the product."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column(0).to_numpy(zero_copy_only=False)
        own, visits = _cells(_matrix(batch.column(2)), pivots, least)
        rows, tasks, sides = [], [], []
        for i, cell in enumerate(own.tolist()):
            n_own, n_visiting = tiles[:, cell].tolist()
            mine = int(node[i]) % n_own
            tasks += [f"{cell}/{mine}/{j}" for j in range(mine, n_own)] + [f"{cell}/{j}/{mine}" for j in range(mine + 1)]
            sides += [0] * (n_own - mine) + [1] * (mine + 1)
            tasks += [f"{cell}/{mine}/v{j}" for j in range(n_visiting)]
            sides += [0] * n_visiting
            for other in np.flatnonzero(visits[i]).tolist():
                n_there, n_tiles = tiles[:, other].tolist()
                tasks += [f"{other}/{j}/v{int(node[i]) % n_tiles}" for j in range(n_there)]
                sides += [1] * n_there
            rows += [i] * (len(tasks) - len(rows))
        for a in range(0, len(rows), 8192):
            part = batch.take(pa.array(rows[a : a + 8192]))
            sent = [pa.array(tasks[a : a + 8192]), pa.array(sides[a : a + 8192], pa.int32()), *part.columns]
            yield pa.record_batch(sent, names=["task", "side", "node", "copies", "embedding"])


def _quantised(unit: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    codes = np.rint(unit / scale).astype(np.int8)
    return codes, np.linalg.norm(unit - codes * scale, axis=1)


def linked_pairs(left: np.ndarray, right: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of the pairs of unit vectors with cosine >= least, block by block."""
    scale = max(np.abs(left).max(), np.abs(right).max()) / 127
    (codes_l, error_l), (codes_r, error_r) = _quantised(left, scale), _quantised(right, scale)
    # sums of products of int8 codes are whole numbers, exact in the float type chosen
    exact = np.float32 if left.shape[1] * 127**2 < 1 << 24 else np.float64
    columns = np.ascontiguousarray(codes_r.T).astype(exact)
    bound = error_l + error_r.max() + 3 * error_l * error_r.max() + _SLACK
    floor = ((least - bound) / scale**2).astype(exact)
    floor -= np.abs(floor) * exact(1e-6)  # the conversion may round up
    for a in range(0, len(left), _ROWS):
        products = codes_l[a : a + _ROWS].astype(exact) @ columns
        i, j = np.nonzero(products >= floor[a : a + _ROWS, None])
        for b in range(0, len(i), 1 << 18):
            r, c = i[b : b + (1 << 18)] + a, j[b : b + (1 << 18)]
            near = np.einsum("ij,ij->i", left[r], right[c]) >= least
            yield r[near], c[near]


def _roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the labels of every a with those of its b."""
    while True:
        la, lb = parent[a], parent[b]
        open_ = la != lb
        if not open_.any():
            return parent
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(parent, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _compare(table: pa.Table, least: float) -> pa.Table:
    """(a, b, links): counts of links with a null b, and the links of a spanning forest with null ``links``."""
    side = table.column("side").to_numpy()
    node = table.column("node").to_numpy()
    copies = table.column("copies").to_numpy()
    unit = _matrix(table.column("embedding"))
    l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    task = table.column("task")[0].as_py().split("/")
    same = task[1] == task[2]  # a tile with itself: every pair comes both ways round
    links = np.zeros(len(node), np.int64)
    parent = np.arange(len(node))
    if len(l) and len(r):
        for i, j in linked_pairs(unit[l], unit[r], least):
            a, b = l[i], r[j]
            other = node[a] != node[b]
            a, b = a[other], b[other]
            links += np.bincount(a, copies[b], len(node)).astype(np.int64)
            if not same:
                links += np.bincount(b, copies[a], len(node)).astype(np.int64)
            parent = _roots(parent, a, b)
    if same:  # the two sides hold the same vectors
        order = np.argsort(node[r])
        twin = r[order][np.searchsorted(node[r][order], node[l])]
        parent = _roots(parent, l, twin)
    some = np.flatnonzero(links)
    hung = np.flatnonzero(node != node[parent])
    a = np.concatenate((node[some], node[hung]))
    b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[parent[hung]])])
    counts = pa.concat_arrays([pa.array(links[some]), pa.nulls(len(hung), pa.int64())])
    return pa.table({"a": pa.array(a, pa.int64()), "b": b, "links": counts})


def _links(nodes: DataFrame, dim: int, least: float, tile: int) -> DataFrame:
    """(a, b, links) of all nodes of one dimension."""
    own = nodes.where(F.size("embedding") == dim).select("node", "copies", "embedding")
    n = own.count()
    k = max(1, min(MAX_CELLS, round(math.sqrt(n) / 8)))
    drawn = smallest_marks(own.select("embedding", F.xxhash64("node").alias("mark")), n, k)
    k = len(drawn)
    pivots = _matrix(pa.array([r["embedding"] for r in drawn], pa.list_(pa.float64())))
    counted = own.select("embedding").mapInArrow(
        functools.partial(_count_cells, pivots=pivots, least=least), "cell bigint, own bigint, visiting bigint"
    )
    tiles = np.zeros((2, k), np.int64)
    for r in counted.groupBy("cell").agg(F.sum("own").alias("own"), F.sum("visiting").alias("visiting")).collect():
        tiles[:, r["cell"]] = max(1, -(-r["own"] // tile)), -(-r["visiting"] // tile)
    dealt = own.mapInArrow(
        functools.partial(_deal, pivots=pivots, least=least, tiles=tiles),
        "task string, side int, node bigint, copies bigint, embedding array<double>",
    )

    def compare(table):  # without type hints: they choose the kind of function here
        return _compare(table, least)

    return dealt.groupBy("task").applyInArrow(compare, "a bigint, b bigint, links bigint")


def _named(bits: int, clashes: list[list[int]]) -> Column:
    """The key of a vector: ``bits`` of a hash; one that several vectors had is replaced by another hash, round by round."""
    key = F.xxhash64("embedding") if bits == 64 else F.xxhash64("embedding").bitwiseAND(F.lit((1 << bits) - 1))
    for i, clashing in enumerate(clashes):
        key = F.when(key.isin(*clashing), F.xxhash64(F.lit(i), "embedding")).otherwise(key)
    return key


def near_duplicates(vectors: DataFrame, least: float = LEAST, tile: int = TILE, key_bits: int = 64) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors(vec_id, embedding)``."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    sound = F.expr(
        "embedding IS NOT NULL AND size(embedding) > 0 AND exists(embedding, x -> x != 0) AND "
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    valid = F.coalesce(sound, F.lit(False))
    second = F.xxhash64(F.lit("second"), "embedding")
    clashes: list[list[int]] = []
    # keys that several vectors have are few (none below about 10^9 vectors); these get others until all differ
    while True:
        keyed = rows.withColumn("node", F.when(valid, _named(key_bits, clashes)))
        nodes = stored(
            keyed.where("node IS NOT NULL").groupBy("node").agg(
                F.count("*").alias("copies"), F.min("vec_id").alias("vec_id"), F.first("embedding").alias("embedding"),
                (F.min(second) != F.max(second)).alias("several"),
            )
        )
        clashing = [r["node"] for r in nodes.where("several").select("node").collect()]
        if not clashing:
            break
        clashes.append(clashing)
    shape = nodes.agg(F.collect_set(F.size("embedding")).alias("dims")).first()
    parts = [_links(nodes, dim, least, tile) for dim in sorted(shape["dims"])]
    if not parts:
        parts = [nodes.selectExpr("node AS a", "node AS b", "node AS links").where("false")]
    found = stored(functools.reduce(DataFrame.union, parts))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    named = nodes.select("node", "vec_id", "copies").join(roots, "node", "left").join(counts, "node", "left")
    named = named.select("node", "vec_id", "copies", "links", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    by_node = named.join(smallest, "root").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    joined = keyed.select("vec_id", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
