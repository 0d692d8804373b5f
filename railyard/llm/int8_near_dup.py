"""Near-duplicate vectors by int8 tile products with error bounds (operator 1).

Every valid vector is scaled to length one and rounded to int8 with a scale of
its own, and keeps the exact length e of its rounding error. For two vectors

    |cos - q.q' / (s s')| <= e (1 + e') + e' (1 + e) + e e'

so one integer matrix product per pair of tiles decides nearly all pairs: surely
linked, or surely not. Only the pairs whose interval holds the threshold are
computed again, in double precision from the vectors themselves.

Equal vectors are one class (a vector held by a third of all rows costs one row
per task). Classes are dealt to groups of at most about `tile` vectors, and each
pair of groups is one task that holds two groups. A task reports, for each of
its vectors, the number of vectors linked and one vector of the same local
cluster: as many rows as vectors, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import components, materialise

#: Rows of one side of an integer product inside a task.
SUB = 1024
#: Bound on what rounding can add in the double-precision steps themselves.
SLACK = 1e-9


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, their int8 rounding, scales and lengths of the rounding errors."""
    x = x / np.abs(x).max(1, keepdims=True)  # so that very large or small vectors keep a finite length
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    scale = 127.0 / np.abs(u).max(1)
    q = np.rint(u * scale[:, None]).astype(np.int8)
    err = np.sqrt(((u - q / scale[:, None]) ** 2).sum(1)) + SLACK
    return u, q, scale, err


def bound(e1: np.ndarray, e2: np.ndarray) -> np.ndarray:
    return e1 * (1 + e2) + e2 * (1 + e1) + e1 * e2


def _join(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite nodes i and j (parent: the root of every node, smallest index first)."""
    while len(i):
        a, b = parent[i], parent[j]
        m = a != b
        if not m.any():
            return
        i, j, a, b = i[m], j[m], a[m], b[m]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def linked_pairs(u, q, scale, err, rows, cols, threshold):
    """Index pairs (rows x cols, blockwise) whose cosine reaches the threshold."""
    wide = u.shape[1] * 127 * 127 >= 1 << 24  # beyond it float32 no longer holds the integer sums exactly
    kind = np.float64 if wide else np.float32
    for r0 in range(0, len(rows), SUB):
        r = rows[r0:r0 + SUB]
        left = q[r].astype(kind)
        for c0 in range(0, len(cols), SUB):
            c = cols[c0:c0 + SUB]
            if c[-1] <= r[0]:
                continue
            dot = left @ q[c].astype(kind).T
            # a coarse screen first: only entries that can reach the threshold
            low = threshold - bound(err[r].max(), err[c].max()) - SLACK
            i, j = np.nonzero(dot >= np.outer(scale[r], scale[c] * (low - 1e-6 * abs(low))).astype(kind))
            keep = r[i] < c[j]
            i, j, v = i[keep], j[keep], dot[i[keep], j[keep]].astype(np.float64)
            gi, gj = r[i], c[j]
            cos, e = v / (scale[gi] * scale[gj]), bound(err[gi], err[gj]) + SLACK
            sure, maybe = cos - e >= threshold, np.abs(cos - threshold) <= e
            for k in np.array_split(np.flatnonzero(maybe & ~sure), max(1, int(maybe.sum()) // 65536)):
                sure[k] = np.einsum("ij,ij->i", u[gi[k]], u[gj[k]]) >= threshold
            yield gi[sure], gj[sure]


def _tile(threshold: float):
    def run(key, t):
        ids = t.column("cls").to_numpy()
        side = t.column("side").to_numpy()
        order = np.lexsort((ids, side))
        ids, side = ids[order], side[order]
        weight = t.column("copies").to_numpy()[order]
        x = np.asarray(pc.list_flatten(t.column("v")).to_numpy(), np.float64).reshape(len(ids), -1)[order]
        u, q, scale, err = quantise(x)
        rows = np.flatnonzero(side == 0)
        cols = rows if key[1] == key[2] else np.flatnonzero(side == 1)  # a group with itself, or with another
        links, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for i, j in linked_pairs(u, q, scale, err, rows, cols, threshold):
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            _join(parent, i, j)
        hit = np.flatnonzero(links)
        return pa.table({"cls": ids[hit], "links": links[hit], "near": ids[parent[hit]]})
    return run


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           threshold: float = 0.95, tile: int = 8192) -> DataFrame:
    """One row per row of `df`: vec_id, n_links, component_id, kept.

    Links rows whose cosine is at least `threshold` (0 < threshold < 1) and
    whose vectors have the same number of dimensions. ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest id reachable.

    Defined cases: a null or zero vector, an empty one, and one with null or
    non-finite components link with nothing. Rows that repeat an id get a row
    each, with the links of that row's vector; the id is one node for the
    component. A null id takes part in no link (component null, kept). Other columns are ignored. An empty table
    gives an empty result.
    """
    kind = df.schema[vector_col].dataType.elementType.simpleString()
    v = F.col(vector_col) if kind in ("float", "double") else F.col(vector_col).cast("array<double>")
    base = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    fine = (F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.exists("v", lambda x: x != 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    base = base.select("vec_id", F.when(F.coalesce(fine, F.lit(False)), F.col("v")).alias("v"))
    # A class is all rows with exactly the same components. Its number is given
    # as the table is written, so it stays the same for every later reader.
    groups = (base.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
              .withColumn("cls", F.monotonically_increasing_id()))
    groups = materialise(groups, "vector-classes")
    k = max(1, -(-groups.count() // tile))
    dealt = groups.select("cls", "copies", "v", F.size("v").alias("d"), F.pmod(F.xxhash64("v"), F.lit(k)).cast("int").alias("g"))
    # group g meets every group h: as the left side where g <= h, else as the right side
    pairs = dealt.select("cls", "copies", "v", "d", "g", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("h"))
    pairs = pairs.select("cls", "copies", "v", "d", F.least("g", "h").alias("gi"), F.greatest("g", "h").alias("gj"),
                         F.when(F.col("g") <= F.col("h"), 0).otherwise(1).alias("side"))
    found = materialise(pairs.groupBy("d", "gi", "gj").applyInArrow(_tile(threshold), "cls bigint, links bigint, near bigint"), "vector-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    first = groups.select("cls", "first")
    spread = base.where("v is not null").select("vec_id", F.col("v"))
    member = spread.join(groups.select("v", "cls", "first", "copies"), "v").select("vec_id", "cls", "first", "copies")
    member = materialise(member, "vector-members")
    twice = member.groupBy("vec_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a <> z").drop("z")
    edges = (found.select(F.col("cls").alias("a"), F.col("near").alias("b")).where("a <> b")
             .unionByName(member.join(twice, "vec_id").select("a", F.col("cls").alias("b")).where("a <> b").distinct()))
    comps = components(edges, "vector-components")
    named = (first.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
             .select("cls", "first", F.coalesce("component", "cls").alias("component")))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = named.join(smallest, "component").join(links, "cls", "left").select("cls", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    linked = (member.join(of_class, "cls")
              .select("vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"))
    alone = base.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
