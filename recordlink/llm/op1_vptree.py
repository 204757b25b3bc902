"""Approximate nearest neighbours: vantage-point trees per shard, by inner product.

Largest inner product becomes smallest distance by one extra coordinate: with ``M`` the largest
norm of all vectors, ``x' = (x, sqrt(M^2 - |x|^2))`` and ``q' = (q, 0)`` give
``|q' - x'|^2 = |q|^2 + M^2 - 2 q.x``, a metric, so the triangle inequality holds.

* Routing. A vantage-point tree over a bounded sample (``sample_rows``) cuts space into cells;
  every vector is put into its cell, and a cell is cut into shards of about ``shard_rows`` rows
  by the id's hash, so equal or close vectors cannot make one shard large.
* Shards. Each shard builds its own vantage-point tree (split at the median distance to a
  vantage point, leaves of ``leaf`` vectors).
* Search. A subtree whose triangle-inequality bound is ``b`` is skipped once
  ``factor * b > tau``, with ``tau`` the query's present k-th distance. Factor 1 is exact;
  a larger factor prunes more and may miss neighbours. Queries first search their home cell,
  which gives ``tau``, and then the cells whose routing bound passes the same test, in blocks:
  a block of queries walks a shard's tree together, and every visited leaf is one matrix
  product in double precision.

Queries are a stated set (``vec_id`` divisible by ``every``). Equal vectors are collapsed first:
only the ``k + 1`` smallest ids of a vector can be among the k nearest (one may be the query
itself), so a vector that a third of all rows share is one entry.

Edge cases: vectors that are null, all zero, or hold null or non-finite components take no
part; the first dimension seen most often is the table's dimension and other lengths take no
part; null ids take no part; an id with several vectors counts with each (the best is kept);
fewer candidates than ``k`` return them all; an empty table returns no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlink.llm.common import keep, tasks_of

LARGE, LARGEST = 2.0 ** 400, 1e300      # components whose squares, summed, may overflow; the largest slack
FOUND = "query_id long, vec_id long, score double"


def make_tree(points, leaf: int, seed: int = 0):
    """Vantage-point tree over rows of ``points``: a list of nodes, root first.

    Inner node: ``(vantage row, median, near, far, near_low, near_high, far_low, far_high)``
    with child positions and the range of distances in each child; leaf: array of rows.
    """
    import numpy as np
    rng = np.random.default_rng(seed)
    nodes: list = [None]
    todo = [(0, np.arange(len(points)))]
    while todo:
        at, rows = todo.pop()
        if len(rows) <= leaf:
            nodes[at] = rows
            continue
        v = rows[rng.integers(len(rows))]
        d = np.sqrt(((points[rows] - points[v]) ** 2).sum(1))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        if d[order[0]] == d[order[-1]]:            # all at one distance: nothing to cut by
            nodes[at] = rows
            continue
        nodes += [None, None]
        kids = (len(nodes) - 2, len(nodes) - 1)
        nodes[at] = (int(v), kids, (d[near[0]], d[near[-1]]), (d[far[0]], d[far[-1]]))
        todo += [(kids[0], rows[near]), (kids[1], rows[far])]
    return nodes


def search_tree(points, nodes, queries, tau, factor: float, visit):
    """Walk the tree for all queries together. ``tau`` is updated by ``visit(rows, leaf)``,
    which scores query rows against a leaf's rows and returns their new tau."""
    import numpy as np
    stack = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
    while stack:
        at, rows, bound = stack.pop()
        alive = factor * bound <= tau[rows]
        rows, bound = rows[alive], bound[alive]
        if not len(rows):
            continue
        node = nodes[at]
        if not isinstance(node, tuple):
            if len(node):
                tau[rows] = visit(rows, node)
            continue
        v, kids, near, far = node
        d = np.sqrt(np.maximum(((queries[rows] - points[v]) ** 2).sum(1), 0))
        to_near = np.maximum(bound, np.maximum(near[0] - d, d - near[1]))
        to_far = np.maximum(bound, np.maximum(far[0] - d, d - far[1]))
        first_far = to_far < to_near
        # nearer child last on the stack, so it is searched first and tightens tau
        stack.append((kids[0], rows[first_far], to_near[first_far]))
        stack.append((kids[1], rows[~first_far], to_far[~first_far]))
        stack.append((kids[1], rows[first_far], to_far[first_far]))
        stack.append((kids[0], rows[~first_far], to_near[~first_far]))


def route(points, nodes, items):
    """Leaf (node position) of every item: nearer to the vantage point than the cut, or not."""
    import numpy as np
    out = np.zeros(len(items), np.int64)
    todo = [(0, np.arange(len(items)))]
    while todo:
        at, rows = todo.pop()
        node = nodes[at]
        if not isinstance(node, tuple):
            out[rows] = at
            continue
        v, kids, near, far = node
        d = np.sqrt(((items[rows] - points[v]) ** 2).sum(1))
        is_near = d < (near[1] + far[0]) / 2
        todo += [(kids[0], rows[is_near]), (kids[1], rows[~is_near])]
    return out


def routing_bounds(points, nodes, queries):
    """``{leaf: lower bound of the distance from each query to anything routed there}``."""
    import numpy as np
    out = {}
    todo = [(0, np.zeros(len(queries)))]
    while todo:
        at, bound = todo.pop()
        node = nodes[at]
        if not isinstance(node, tuple):
            out[at] = bound
            continue
        v, kids, near, far = node
        d = np.sqrt(((queries - points[v]) ** 2).sum(1))
        cut = (near[1] + far[0]) / 2
        todo += [(kids[0], np.maximum(bound, d - cut)), (kids[1], np.maximum(bound, cut - d))]
    return out


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest(table: DataFrame, every: int = 20, k: int = 20, factor: float = 1.0, sample_rows: int = 20_000,
            cells: int = 64, shard_rows: int = 8192, block_rows: int = 2048, leaf: int = 64, seed: int = 0,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found by inner product.

    ``factor``: pruning relaxation, 1 exact. ``sample_rows`` bounds the routing sample the
    driver holds; ``shard_rows`` and ``block_rows`` bound what one group holds.
    """
    import numpy as np
    if factor < 1:
        raise ValueError("factor must be at least 1")
    spark = table.sparkSession
    rows = (table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & usable(F.col("v"))))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = F.array_max(F.transform("v", F.abs))
    about = (rows.select(F.size("v").alias("dim"), squares.alias("sq"), largest.alias("big")).groupBy("dim")
             .agg(F.count("*").alias("n"), F.max("sq").alias("sq"), F.max("big").alias("big")).orderBy(F.desc("n"), "dim").first())
    if about is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, top, unit = int(about["dim"]), float(about["sq"]), 1.0
    rows = rows.filter(F.size("v") == dim)
    if about["big"] > LARGE:            # squares would overflow: distances are taken in units of a power of two
        unit = 2.0 ** math.frexp(about["big"])[1]
        top = float(rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.lit(unit)) * (x / F.lit(unit))))).first()[0])

    # Equal vectors once, with their k + 1 smallest ids; salted first so that no task holds them all.
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    code = F.xxhash64("v")
    w1, w2 = Window.partitionBy("_code", "v", "_salt").orderBy("vec_id"), Window.partitionBy("_code", "v").orderBy("vec_id")
    least = (rows.select("vec_id", "v", code.alias("_code"), salt.alias("_salt"))
             .withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k + 1)
             .withColumn("_r", F.row_number().over(w2)).filter(F.col("_r") <= k + 1))
    distinct = least.groupBy("_code", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))   # at most k + 1 ids

    # Routing tree over a bounded sample (smallest hashes: the same rows on every run).
    sample = np.array([r["v"] for r in rows.select("v").orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id")
                       .limit(sample_rows).collect()], float).reshape(-1, dim)

    def lift(x):
        x = x / unit
        return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))[:, None]])

    def lift_query(x):
        return np.hstack([x / unit, np.zeros((len(x), 1))])

    def far(x, score):
        """Distance of the query ``x`` to a vector of this score, a little more for rounding."""
        x, score = x / unit, score / unit / unit
        return np.sqrt(np.maximum((x * x).sum(1) + top - 2 * score, 0)) * (1 + 1e-9) + 1e-9

    pivots = lift(sample)
    tree = make_tree(pivots, max(1, -(-len(sample) // cells)), seed)
    used = sorted({n[0] for n in tree if isinstance(n, tuple)})
    place = {v: i for i, v in enumerate(used)}
    pivots = pivots[used]
    tree = [(place[n[0]], *n[1:]) if isinstance(n, tuple) else np.arange(0) for n in tree]

    def placed(batches):
        import pyarrow as pa
        for b in batches:
            x = np.stack(b.column(0).to_numpy(zero_copy_only=False)) if b.num_rows else np.zeros((0, dim))
            cell = route(pivots, tree, lift(x))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64())], names=["v", "ids", "cell"])

    index = keep(distinct.select("v", "ids").mapInArrow(placed, "v array<double>, ids array<long>, cell long"), "vp-index")
    sizes = {r["cell"]: -(-r["count"] // shard_rows) for r in index.groupBy("cell").count().collect()}   # one row per cell
    parts = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    shards = index.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), parts[F.col("cell")]).cast("int"))

    queries = rows.filter(F.col("vec_id") % every == 0)

    def search(shard_table, query_table, limits):
        """Found neighbours of a block of queries in one shard."""
        q = np.stack(query_table.column("v").to_numpy()).astype(float)
        qid = query_table.column("query_id").to_numpy()
        x = np.stack(shard_table.column("v").to_numpy()).astype(float)
        ids = shard_table.column("ids").to_pylist()
        pts, lifted = lift(x), lift_query(q)
        nodes = make_tree(pts, leaf, seed)
        kept_score = np.full((len(q), k + 1), -np.inf)
        kept_row = np.full((len(q), k + 1), -1)
        first = np.array([i[0] for i in ids])
        # Twice what a matrix product may differ from the scores below, by rounding.
        with np.errstate(over="ignore"):
            slack = np.minimum(4 * (dim + 1) * np.finfo(float).eps * np.sqrt(((q / unit) ** 2).sum(1) * top) * unit * unit, LARGEST)

        def exact(at, rows):
            """Scores summed the same way for every pair, whatever the block, so that ties are ties."""
            out = np.empty(len(at))
            for i in range(0, len(at), 16_384):
                out[i:i + 16_384] = (x[rows[i:i + 16_384]] * q[at[i:i + 16_384]]).sum(1)
            return out

        def visit(r, cand):
            s = q[r] @ x[cand].T
            kth = -np.partition(-np.hstack([kept_score[r], s]), k, axis=1)[:, k]
            near = s >= (kth - slack[r])[:, None]
            hit = np.flatnonzero(near.any(1))
            if len(hit):
                at, col = np.nonzero(near[hit])
                s, h = np.full((len(hit), len(cand)), -np.inf), r[hit]
                s[at, col] = exact(h[at], cand[col])
                score = np.hstack([kept_score[h], s])
                row = np.hstack([kept_row[h], np.broadcast_to(cand, s.shape)])
                top_at = np.lexsort((first[row], -score))[:, :k + 1]     # smallest first ids among ties
                kept_score[h] = np.take_along_axis(score, top_at, 1)
                kept_row[h] = np.take_along_axis(row, top_at, 1)
            # the (k+1)-th vector bounds the k-th neighbour, the query's own vector counted out
            return np.minimum(limits[r], far(q[r], kept_score[r, k]))

        tau = limits.copy()
        search_tree(pts, nodes, lifted, tau, factor, visit)
        out = []
        for i in range(len(q)):
            ok = kept_row[i] >= 0
            rr, ss = kept_row[i][ok], kept_score[i][ok]
            for j in np.lexsort((first[rr], -ss)):
                out += [(int(qid[i]), n, float(ss[j])) for n in ids[rr[j]] if n != qid[i]]
        return out

    def as_table(found):
        import pyarrow as pa
        a, b, c = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    def pair(left, right):
        if not left.num_rows or not right.num_rows:
            return as_table([])
        return as_table(search(left, right, right.column("tau").to_numpy().astype(float)))

    def per_shard(wanted: DataFrame) -> DataFrame:
        """``wanted``: query_id, v, tau, cell. Each query meets every shard of the cell, in blocks."""
        blocks = F.pmod(F.xxhash64("query_id"), F.greatest(F.lit(1), F.ceil(F.col("_n") / block_rows)))
        loads = wanted.groupBy("cell").agg(F.count("*").alias("_n"))                    # one row per cell
        spread = (wanted.join(F.broadcast(loads), "cell").withColumn("block", blocks.cast("int"))
                  .withColumn("shard", F.explode(F.sequence(F.lit(0), (parts[F.col("cell")] - 1).cast("int")))))
        copies = (shards.join(F.broadcast(loads), "cell")
                  .withColumn("block", F.explode(F.sequence(F.lit(0), (F.greatest(F.lit(1), F.ceil(F.col("_n") / block_rows)) - 1).cast("int")))))
        return (copies.select("cell", "shard", "block", "v", "ids").groupBy("cell", "shard", "block")
                .cogroup(spread.select("cell", "shard", "block", "query_id", "v", "tau").groupBy("cell", "shard", "block"))
                .applyInArrow(pair, FOUND))

    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)

    def home(batches):
        import pyarrow as pa
        for b in batches:
            x = np.stack(b.column(1).to_numpy(zero_copy_only=False)) if b.num_rows else np.zeros((0, dim))
            cell = route(pivots, tree, lift(x))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(x), np.inf)), pa.array(cell, pa.int64())],
                                             names=["query_id", "v", "tau", "cell"])

    wanted = "query_id long, v array<double>, tau double, cell long"
    base = queries.select(F.col("vec_id").alias("query_id"), "v")
    live = set(sizes)
    first_found = keep(best(per_shard(base.mapInArrow(home, wanted).filter(F.col("cell").isin(list(live))))), "vp-home")
    reach = (first_found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low")))

    def others(batches):
        """One row per further cell whose bound passes the pruning test."""
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack(b.column(1).to_numpy(zero_copy_only=False))
            low = b.column(2).to_numpy(zero_copy_only=False)
            tau = np.where(np.isnan(low), np.inf, far(x, np.nan_to_num(low)))
            own = route(pivots, tree, lift(x))
            for cell, bound in routing_bounds(pivots, tree, lift_query(x)).items():
                pick = np.flatnonzero((factor * bound <= tau) & (own != cell)) if cell in live else []
                if len(pick):
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(pick)), b.column(1).take(pa.array(pick)), pa.array(tau[pick]),
                         pa.array(np.full(len(pick), cell), pa.int64())], names=["query_id", "v", "tau", "cell"])

    second = (base.join(reach, "query_id", "left")
              .select("query_id", "v", F.when(F.col("n") >= k, F.col("low")).cast("double").alias("low"))
              .mapInArrow(others, wanted))
    found = per_shard(second).unionByName(first_found.select("query_id", "vec_id", "score"))
    return best(found).select("query_id", "rank", "vec_id", "score")
