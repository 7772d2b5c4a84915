"""Near-duplicate embeddings by Euclidean p-stable hashing, checked by exact cosines.

Vectors are normalised, so cosine >= c means a distance of at most sqrt(2 - 2c). A hash is
``floor((a . v + b) / w)`` with Gaussian ``a``; ``k`` of them make a bucket in each of ``tables``
tables. For a pair at the threshold itself one hash agrees with probability p1, for unrelated
(orthogonal) vectors with p2. ``k`` follows the largest label's count n, so that about one
unrelated vector shares a bucket: k = ceil(ln n / ln(1 / p2)); the number of tables follows from
the wanted recall at the threshold: tables = ceil(ln(1 - recall) / ln(1 - p1 ** k)), about
n ** 0.22. Closer pairs are found more often than that.

Equal vectors of a label collapse to one class with a count before hashing. Only rows of buckets
with two or more classes carry their vector on. A bucket of more than ``CHUNK`` classes is cut
into chunks, and every pair of chunks is a task's block of its own, so a hot bucket spreads over
the cluster. A pair that shares several buckets is counted in the first of its tables only. Blocks
emit no pairs: they sum each class's links and emit one edge per linked class (its component in
the block).

Defined cases: null label, null vector, null, infinite or NaN components, zero and empty vectors
link with nothing and are their own component; vectors of other length never compare; repeated
rows are vectors that link with each other; a null vec_id links but names no component; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepact.llm.common import components, cut, map_batches

COSINE = 0.93
RECALL = 0.95
WIDTH = 2.0
CHUNK = 1024


def agree(distance: float, w: float = WIDTH) -> float:
    """Probability that one hash agrees on two vectors ``distance`` apart."""
    if distance <= 0:
        return 1.0
    r = w / distance
    phi = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Tables:
    k: int
    tables: int
    width: float = WIDTH
    seed: int = 11

    def signatures(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables) int32 bucket names of normalised vectors."""
        rng = np.random.default_rng([self.seed, unit.shape[1]])
        a = rng.standard_normal((unit.shape[1], self.k * self.tables))
        b = rng.uniform(0, self.width, self.k * self.tables)
        out = np.empty((len(unit), self.tables), np.int32)
        for at in range(0, len(unit), 1024):
            h = np.floor((unit[at:at + 1024] @ a + b) / self.width).astype(np.int64)
            h = h.reshape(-1, self.tables, self.k).astype(np.uint64)
            mixed = np.full(h.shape[:2], 0x9E3779B97F4A7C15, np.uint64)
            for i in range(self.k):
                mixed = (mixed ^ h[:, :, i]) * np.uint64(0xFF51AFD7ED558CCD)
                mixed ^= mixed >> np.uint64(29)
            out[at:at + 1024] = (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return out


def plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> Tables:
    p1, p2 = agree(math.sqrt(2 - 2 * cosine)), agree(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 2)) / math.log(1 / p2)))
    return Tables(k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - p1**k))))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _block(cosine: float, tables: int):
    """Scans rows sorted by block; blocks may run over batch ends."""

    def flush(t: pa.Table):
        # Rows of whole blocks, possibly many blocks; vectors of one length share a matrix.
        lengths = t["dim"].to_numpy()
        out = []
        for dim in np.unique(lengths):
            own = t.filter(pa.array(lengths == dim))
            out += work(own, int(dim))
        return out

    def work(t: pa.Table, dim: int):
        unit = _matrix(t["unit"].combine_chunks(), dim)
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), "<i4").reshape(-1, tables)
        key, at, chunk = (t[c].to_numpy() for c in ("block", "t", "chunk"))
        across, n, cid = t["across"].to_numpy(zero_copy_only=False), t["n"].to_numpy(), t["cid"].to_numpy()
        group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        links = np.zeros(len(cid), np.int64)
        us, vs = [], []
        live = np.arange(len(cid))
        d = 1
        while True:
            live = live[live + d < len(cid)]
            live = live[group[live] == group[live + d]]
            if not len(live):
                break
            i = live[~across[live] | (chunk[live] != chunk[live + d])]
            for lo in range(0, len(i), 8192):
                x = i[lo:lo + 8192]
                y = x + d
                near = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
                x, y = x[near], y[near]
                if len(x):
                    first = (sig[x] == sig[y]).argmax(axis=1) == at[x]
                    x, y = x[first], y[first]
                    np.add.at(links, x, n[y])
                    np.add.at(links, y, n[x])
                    us.append(cid[x])
                    vs.append(cid[y])
            d += 1
        if not us:
            return []
        u, v = np.concatenate(us), np.concatenate(vs)
        names, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
        a, b = flat[:len(u)], flat[len(u):]
        root = np.arange(len(names))
        while True:  # smallest label over the links, halving paths
            new = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = links > 0
        total = np.zeros(len(names), np.int64)
        np.add.at(total, np.searchsorted(names, cid[some]), links[some])
        return [pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(names[root]), pa.array(total)], ["u", "v", "links"]
        )]

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            last = t["block"][-1].as_py()
            same = t["block"].to_numpy() == last
            tail = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if tail:
                yield from flush(t.slice(0, tail))
            held = t.slice(tail)
        if held is not None and held.num_rows:
            yield from flush(held)

    return run


def classes(vectors: DataFrame) -> DataFrame:
    """Distinct comparable vectors of each label: label, dim, cid, low (smallest vec_id), n, unit."""
    v = F.col("embedding").cast("array<double>")
    good = (
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0)
    )
    own = vectors.where(F.coalesce(good, F.lit(False))).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("n")
    )
    return cut(own).withColumn("cid", F.monotonically_increasing_id())


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    own = classes(vectors.select("vec_id", "embedding", "label"))
    most = own.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    tables = plan(most, cosine, recall)

    def hash_rows(batches):
        for b in batches:
            rows = [np.array(x, np.float64) for x in b.column(3).to_pylist()]
            unit, sig = [], []
            for at in range(0, len(rows), 1024):
                part = rows[at:at + 1024]
                dims = np.array([len(x) for x in part])
                u: list = [None] * len(part)
                s: list = [None] * len(part)
                for dim in np.unique(dims):
                    i = np.flatnonzero(dims == dim)
                    m = np.stack([part[j] for j in i])
                    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow of the squares
                    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
                    for j, x, y in zip(i, m, tables.signatures(m)):
                        u[j], s[j] = x.astype("<f8").tobytes(), y.astype("<i4")
                unit += u
                sig += s
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([len(x) for x in rows], pa.int32()),
                 pa.array(unit, pa.binary()), pa.array([x.tobytes() for x in sig], pa.binary()),
                 pa.array([x.tolist() for x in sig], pa.list_(pa.int32()))],
                ["cid", "label", "n", "dim", "unit", "sig", "names"],
            )

    label = dict(vectors.dtypes)["label"]
    schema = f"cid bigint, label {label}, n bigint, dim int, unit binary, sig binary, names array<int>"
    hashed = cut(map_batches(own.select("cid", "label", "n", "embedding"), hash_rows, schema))
    bucket = ["label", "dim", "t", "h"]
    rows = hashed.select("cid", "label", "dim", F.posexplode("names").alias("t", "h"))
    full = rows.groupBy(*bucket).agg(F.count("*").alias("in_bucket")).where("in_bucket > 1")
    # Chunks of hot buckets, and one copy of a row for every pair of chunks that its chunk is in.
    chunks = F.ceil(F.col("in_bucket") / CHUNK).cast("int")
    placed = (
        rows.join(full, bucket)
        .withColumn("chunks", chunks)
        .withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "cid", "t", "chunk", (F.col("chunk") != F.col("other")).alias("across_"),
            F.xxhash64(
                *bucket, F.least("chunk", "other"), F.greatest("chunk", "other")
            ).alias("block"),
        )
    )
    # In a block of two chunks the rows of both are compared across chunks only. (Two blocks whose
    # 64-bit names are equal would be compared too; the check of t keeps links exact.)
    work = (
        placed.join(hashed.select("cid", "dim", "n", "unit", "sig"), "cid")
        .repartition(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block")
        .sortWithinPartitions("block", "dim")
        .select("block", "t", "chunk", F.col("across_").alias("across"), "cid", "n", "dim", "unit", "sig")
    )
    found = cut(map_batches(work, _block(cosine, tables.tables), "u bigint, v bigint, links bigint"))
    links = found.groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    roots = components(found.select("u", "v")).withColumnRenamed("id", "cid")
    whole = own.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    lowest = whole.groupBy("root").agg(F.min("low").alias("component_id"))
    named = cut(
        whole.join(lowest, "root").join(links, "cid", "left").select(
            "label", "embedding", "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    v = vectors.select("vec_id", "embedding", "label")
    return v.join(named, ["label", "embedding"], "left").select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("bigint").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
