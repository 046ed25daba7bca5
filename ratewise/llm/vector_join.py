"""Near-duplicate vectors by lattice hashing.

Each of several tables projects unit vectors at random to blocks of eight
dimensions and decodes every block to its nearest E8 lattice point; the points
together are the vector's cell. A vector lives in its home cell and visits the
cells that lie next in the directions of its residual (a multi-probe), so two
vectors meet in a table if one of them visits the other's home. Pairs that
meet are verified by their cosine in double precision.

Equal vectors are one class with a weight, so exact copies cost nothing. A cell
with many members is cut into blocks, and each pair of blocks is a task of its
own: no cell is gathered whole. A pair may meet several times; only the first
place (table, then cell) counts, which both vectors' cells tell without any
exchange. Tasks return the sum of links per vector and a spanning forest, never
the pairs, so a group of n near copies does not emit n * n rows.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing; vectors of different lengths do not link. Repeated rows are kept,
each with its own count; null ids are kept (a component's id is its smallest
non-null one, and such a row is never ``kept``). Other columns are ignored whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import stored
from ratewise.llm.components import components
from ratewise.llm.lattice import DIM, SHORTEST, nearest

COSINE = 0.95
#: Tables, blocks of eight dimensions per cell, cells visited per table, edge of a cell, members compared at a time.
TABLES, BLOCKS, VISITS, EDGE, BLOCK = 5, 2, 6, 0.5, 512
_SEED = 20_240_229


@functools.lru_cache(maxsize=16)
def _projections(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Per table a random projection of ``dim`` to 8 * BLOCKS dimensions, and odd multipliers that hash a cell."""
    rng = np.random.default_rng([_SEED, dim])
    size = DIM * BLOCKS
    maps = rng.normal(size=(TABLES, dim, size)) / (np.sqrt(size) * EDGE)
    return maps, rng.integers(1, 1 << 62, size=(TABLES, size)) * 2 + 1


def cells(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home cells (n, TABLES), visited cells (n, TABLES, VISITS)) of unit vectors, as 64-bit hashes."""
    n, dim = unit.shape
    maps, multipliers = _projections(dim)
    homes, visits = np.empty((n, TABLES), np.int64), np.empty((n, TABLES, VISITS), np.int64)
    for t in range(TABLES):
        x = (unit @ maps[t]).reshape(n, BLOCKS, DIM)
        point = nearest(x)
        # twice a lattice point is whole; hashing is linear, so a visit is the home plus a step's hash
        homes[:, t] = (np.rint(2 * point).astype(np.int64).reshape(n, -1) * multipliers[t]).sum(axis=1) + t
        steps = np.rint(2 * SHORTEST).astype(np.int64) @ multipliers[t].reshape(BLOCKS, DIM).T  # (240, BLOCKS)
        gain = np.einsum("nbd,sd->nbs", x - point, SHORTEST).reshape(n, -1)
        best = np.argpartition(-gain, VISITS, axis=1)[:, :VISITS]
        visits[:, t] = homes[:, t, None] + steps.T.reshape(-1)[best]
    return homes, visits


def _unit(vector) -> np.ndarray | None:
    """The vector scaled to length one; None if it cannot link."""
    if not vector or any(v is None for v in vector):
        return None
    x = np.array(vector, dtype=np.float64)
    top = np.abs(x).max()
    if not np.isfinite(x).all() or top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _hashed(classes: DataFrame) -> DataFrame:
    """(cid, weight, unit, homes, visits) of classes of equal vectors that can link."""
    schema = pa.schema([("cid", pa.int64()), ("weight", pa.int64()), ("unit", pa.binary()), ("homes", pa.list_(pa.int64())), ("visits", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            by_dim: dict[int, list] = {}
            for cid, weight, vector in zip(*(b.column(c).to_pylist() for c in ("cid", "weight", "vector"))):
                unit = _unit(vector)
                if unit is not None:
                    by_dim.setdefault(len(unit), []).append((cid, weight, unit))
            for rows in by_dim.values():
                units = np.stack([r[2] for r in rows])
                homes, visits = cells(units)
                yield pa.RecordBatch.from_pydict({
                    "cid": [r[0] for r in rows], "weight": [r[1] for r in rows], "unit": [u.tobytes() for u in units],
                    "homes": homes.tolist(), "visits": visits.reshape(len(rows), -1).tolist()}, schema=schema)

    return classes.mapInArrow(run, "cid long, weight long, unit binary, homes array<long>, visits array<long>")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(cosine: float):
    """Links within one tile: a cell's members of one block, or of two."""
    def run(group: pa.Table) -> pa.Table:
        table, cell = group["tab"][0].as_py(), group["cell"][0].as_py()
        order = np.argsort(group["cid"].to_numpy())
        group = group.take(pa.array(order))
        cid, weight, block = (group[c].to_numpy() for c in ("cid", "weight", "block"))
        n = len(cid)
        units = np.frombuffer(b"".join(group["unit"].to_pylist()), np.float64).reshape(n, -1)
        homes = np.array(group["homes"].to_pylist(), dtype=np.int64).reshape(n, TABLES)
        visits = np.array(group["visits"].to_pylist(), dtype=np.int64).reshape(n, TABLES, VISITS)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        near = units[left] @ units[right].T >= cosine
        near &= (homes[left, table] == cell)[:, None] | (homes[right, table] == cell)[None, :]
        if low == high:
            near &= left[:, None] < right[None, :]
        a, b = (side[k] for side, k in zip((left, right), np.nonzero(near)))

        def meets(t: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Whether a and b meet in a's home, and in b's home, in table t."""
            same = homes[a, t] == homes[b, t]
            return same | (visits[b, t] == homes[a, t, None]).any(axis=1), same | (visits[a, t] == homes[b, t, None]).any(axis=1)

        for t in range(table):  # a pair that met in an earlier table was counted there
            at_a, at_b = meets(t, a, b)
            a, b = a[~(at_a | at_b)], b[~(at_a | at_b)]
        at_a, at_b = meets(table, a, b)
        top = np.iinfo(np.int64).max
        first = np.minimum(np.where(at_a, homes[a, table], top), np.where(at_b, homes[b, table], top))
        a, b = a[first == cell], b[first == cell]
        links = np.bincount(a, weight[b], minlength=n) + np.bincount(b, weight[a], minlength=n)
        some = np.flatnonzero(links)
        return pa.table({"cid": cid[some], "links": links[some].astype(np.int64), "root": cid[_forest(a, b, n)][some]})

    return run


def link_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(members, linked): (vec_id, cid, weight) of every row, and stored (cid, links, root): links and spanning edges by tile.

    ``cid`` is the class of equal vectors; ``weight`` its number of rows, 0 for vectors that cannot link.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    members = stored(rows.select("vec_id", F.xxhash64("vector").alias("cid"), "vector"), "vectors")
    classes = members.groupBy("cid").agg(F.count("*").alias("weight"), F.first("vector").alias("vector"))
    hashed = stored(_hashed(classes), "hashed-vectors")
    home = hashed.select("cid", F.posexplode("homes").alias("tab", "cell"), F.lit(1).alias("home"))
    visit = hashed.select("cid", F.posexplode("visits").alias("tab", "cell"), F.lit(0).alias("home")).withColumn(
        "tab", F.floor(F.col("tab") / VISITS).cast("int"))
    placed = home.unionByName(visit)
    met = placed.groupBy("tab", "cell").agg(F.sum("home").alias("homes"), F.count("*").alias("n")).where("homes > 0 AND n > 1")
    met = met.select("tab", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    tiles = (placed.join(met, ["tab", "cell"]).withColumn("block", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cid", "tab", "cell", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
    found = tiles.join(hashed, "cid").groupBy("tab", "cell", "low", "high").applyInArrow(_compare(cosine), "cid long, links long, root long")
    weights = hashed.select("cid", "weight")
    return members.join(weights, "cid", "left").select("vec_id", "cid", F.coalesce("weight", F.lit(0)).alias("weight")), stored(found, "vector-links")


def join_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    members, found = link_vectors(vectors, cosine)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = stored(components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b"))), "components")
    classes = links.join(groups, F.col("cid") == F.col("node"), "full").select(
        F.coalesce("cid", "node").alias("cid"), F.coalesce("links", F.lit(0)).alias("links"), "component")
    rows = members.join(classes, "cid", "left").select(
        "vec_id", F.when(F.col("weight") > 0, F.col("weight") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"),
        F.when(F.col("weight") > 0, F.coalesce("component", "cid")).alias("component"))
    least = rows.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("vec_id").alias("least"))
    joined = rows.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return joined.select("vec_id", F.col("n_links").cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
