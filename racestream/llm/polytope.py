"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the axis, with sign, that it then
lies nearest to. Several such hashes, more for labels of very many vectors, and the label make the bucket of a table. A vector is entered into its own bucket of each
table, and probes those in which one hash is replaced by the second nearest axis. Pairs meet where one's own bucket is
the other's own or probed one; their cosines are computed in double precision.

Equal vectors are one class. A crowded bucket is cut into blocks, and pairs of blocks go to tasks of bounded size, where a
matrix product finds the links. Links are counted where they are found, each in the first table in which its ends meet; what
leaves a task is a count per vector and, for components, the links of a small bucket or a spanning forest of a large one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from racestream.llm.components import components, forest
from racestream.llm.tables import group_starts, map_rows, ship, whole_groups
from racestream.session import written

COSINE = 0.93
#: Tables, and hashes of a bucket's key, for labels of up to ``FEW`` classes.
TABLES, HASHES, FEW = 24, 3, 1_000_000
#: For every factor of so many classes beyond, a key has one hash more, so that buckets do not fill as the table grows; and there are
#: so many times the tables, which keeps the chance that a pair meets.
CLASSES_A_HASH, TABLES_A_HASH = 100, 1.75
#: Classes of a bucket that one task compares with each other, or with as many others.
BLOCK = 512
#: Up to this size the pairs of a bucket are listed; beyond, a matrix product finds the links.
SMALL = 48


# Hashes

def n_tables(hashes: int) -> int:
    return math.ceil(TABLES * TABLES_A_HASH ** (hashes - HASHES))


def _signs(width: int, hashes: int) -> np.ndarray:
    random = np.random.default_rng(1000 + width)
    return random.choice(np.array([-1.0, 1.0], np.float32), (n_tables(hashes) * hashes, 3, width))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform along the last axis, whose length is a power of two."""
    width, half = x.shape[-1], 1
    while half < width:
        pairs = x.reshape(*x.shape[:-1], width // (2 * half), 2, half)
        out = np.empty_like(pairs)
        np.add(pairs[..., 0, :], pairs[..., 1, :], out=out[..., 0, :])
        np.subtract(pairs[..., 0, :], pairs[..., 1, :], out=out[..., 1, :])
        x = out.reshape(x.shape)
        half *= 2
    return x


def axes(vectors: np.ndarray, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the second nearest signed axis of each vector after each rotation: arrays of (vectors, tables, hashes)."""
    n, size = vectors.shape
    width = max(2, 1 << (size - 1).bit_length())
    padded = np.zeros((n, width), np.float32)
    padded[:, :size] = vectors
    every = _signs(width, hashes)
    first = np.empty((n, len(every)), np.int32)
    second = np.empty_like(first)
    rows = np.arange(n)
    for k, signs in enumerate(every):
        x = padded
        for s in signs:
            x = hadamard(x * s)
        size_of = np.abs(x)
        for target in (first, second):
            axis = size_of.argmax(1)
            target[:, k] = 2 * axis + (x[rows, axis] < 0)
            size_of[rows, axis] = -1
    return first.reshape(n, -1, hashes), second.reshape(n, -1, hashes)


def _meet(own: np.ndarray, other: np.ndarray, own_b: np.ndarray, other_b: np.ndarray) -> np.ndarray:
    """In which tables two vectors meet; arrays of (pairs, tables, hashes)."""
    differ = own != own_b
    near = ~differ | (other == own_b)
    near_b = ~differ | (own == other_b)
    one = differ.sum(2) <= 1
    return one & (near.all(2) | near_b.all(2))


# Classes and buckets

def _usable(label: Column, vec_id: Column, x: Column) -> Column:
    """Only finite vectors with an id, a label and a length take part."""
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vec_id.isNotNull() & label.isNotNull() & finite & F.exists(x, lambda v: v != 0)


def _classes(vectors: DataFrame) -> DataFrame:
    """Classes of equal label and vector: the least id and the number of rows."""
    rows = vectors.where(_usable(F.col("label"), F.col("vec_id"), F.col("vector")))
    grouped = rows.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("vec_id").alias("copies"))
    return grouped


def _with_hashes(classes: DataFrame) -> DataFrame:
    """Adds the number of hashes of a key, from the classes of each label; labels beyond ``FEW`` are few, and are joined."""
    more = F.ceil(F.log(F.col("n") / F.lit(float(FEW))) / F.lit(math.log(CLASSES_A_HASH))).cast("int")
    large = classes.groupBy(F.col("label").alias("large")).agg(F.count("rep").alias("n")).where(F.col("n") > FEW)
    large = written(large.select("large", (more + HASHES).alias("hashes")), "polytope-large")
    joined = classes.join(large, F.col("label") == F.col("large"), "left").drop("large")
    return joined.withColumn("hashes", F.coalesce("hashes", F.lit(HASHES)))


def _hashed(classes: DataFrame) -> DataFrame:
    """Adds to every class its unit vector and axes, as bytes, and the keys of its own and of its probed buckets."""

    def enter(columns: dict[str, list]) -> dict[str, list]:
        n = len(columns["rep"])
        out: dict[str, list] = {"unit": [None] * n, "axes": [None] * n, "own": [None] * n, "probed": [None] * n}
        sizes = np.array([len(v) for v in columns["vector"]])
        of_key = np.array(columns["hashes"])
        for size, hashes in sorted(set(zip(sizes.tolist(), of_key.tolist()))):
            chosen = np.flatnonzero((sizes == size) & (of_key == hashes))
            x = np.array([columns["vector"][i] for i in chosen], np.float64)
            x /= np.abs(x).max(1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            first, second = axes(x, hashes)
            keys = [first.copy() for _ in range(hashes + 1)]
            for h in range(hashes):
                keys[h + 1][:, :, h] = second[:, :, h]
            # Keys of many hashes may wrap round: then buckets hold some pairs more, which do not meet.
            radix = np.int64(1 << 20 if hashes == HASHES else 1_000_003) ** np.arange(hashes, dtype=np.int64)
            own, *probed = ((k.astype(np.int64) * radix).sum(2) for k in keys)
            both = np.stack([first, second], 1).astype("<i4")
            for row, i in enumerate(chosen):
                out["unit"][i] = x[row].tobytes()
                out["axes"][i] = both[row].tobytes()
                out["own"][i] = own[row]
                out["probed"][i] = np.stack([p[row] for p in probed], 1).reshape(-1)
        return {name: columns[name] for name in ("rep", "copies", "label", "hashes")} | out

    schema = "rep long, copies long, label string, hashes int, unit binary, axes binary, own array<long>, probed array<long>"
    return map_rows(classes, enter, schema)


def _bucket_rows(hashed: DataFrame) -> DataFrame:
    """Classes in the buckets where a pair can meet, by block: ``(bucket, low, high)`` is the work of one task."""
    bucket = F.xxhash64("label", F.length("unit"), "place", "key").alias("bucket")
    own = hashed.select("rep", "label", "unit", F.posexplode("own").alias("place", "key"))
    probed = hashed.select("rep", "label", "unit", "hashes", F.posexplode("probed").alias("at", "key"))
    probed = probed.withColumn("place", F.expr("at div hashes").cast("int"))
    rows = own.select(bucket, "rep", "place", F.lit(True).alias("is_own")).unionByName(
        probed.select(bucket, "rep", "place", F.lit(False).alias("is_own"))
    )
    live = rows.groupBy("bucket").agg(F.count("rep").alias("n"), F.max("is_own").alias("has_own")).where("n > 1 AND has_own")
    blocks = F.ceil(F.col("n") / BLOCK)
    block = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    return (
        rows.join(live.drop("has_own"), "bucket")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "place", "is_own")
    )


# Links

def _linked(x: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    found = np.empty(len(a), bool)
    for at in range(0, len(a), 50_000):
        part = slice(at, at + 50_000)
        found[part] = np.einsum("ij,ij->i", x[a[part]], x[b[part]]) >= least
    return found


def _first_meeting(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the bucket in which pairs are looked at is the one that counts them.

    That is in the first table in which they meet; there it is the bucket of both, or that of the one the other probes, and
    if they probe each other's, that of the lesser one.
    """
    codes, table, own, rep = rows["codes"], rows["place"], rows["own"], rows["rep"]
    first = np.empty(len(a), bool)
    for at in range(0, len(a), 20_000):
        i, j = a[at : at + 20_000], b[at : at + 20_000]
        meet = _meet(codes[i, 0], codes[i, 1], codes[j, 0], codes[j, 1])
        here, there = codes[i, :, table[i]], codes[j, :, table[i]]
        same = here[:, 0] == there[:, 0]
        mutual = (same | ((here[:, 1] == there[:, 0]) & (there[:, 1] == here[:, 0]))).all(1)
        lesser_owns = np.where(rep[i] < rep[j], own[i], own[j])
        counts = (own[i] & own[j]) | ((own[i] | own[j]) & (~mutual | lesser_owns))
        first[at : at + 20_000] = counts & meet.any(1) & (meet.argmax(1) == table[i])
    return first


def _compare(rows: dict[str, np.ndarray], starts: np.ndarray, least: float) -> list[tuple[np.ndarray, ...]]:
    """Counts ``(rep, none, links)`` and edges ``(rep, other, 0)`` of the tasks that begin at ``starts``."""
    x, rep, block, own, label = rows["x"], rows["rep"], rows["block"], rows["own"], rows["label"]
    ends = np.append(starts[1:], len(rep))
    listed: list[np.ndarray] = []
    out = []
    counted: list[tuple[np.ndarray, np.ndarray]] = []
    for start, end in zip(starts, ends):
        n = end - start
        if n <= SMALL:
            listed.append(np.stack(np.triu_indices(n, 1)) + start)
            continue
        i, j = np.nonzero(np.triu(x[start:end] @ x[start:end].T >= least - 1e-9, 1))
        i, j = i + start, j + start
        fit = _linked(x, i, j, least) & (label[i] == label[j])
        i, j = i[fit], j[fit]
        counted.append((i, j))
        root = forest(n, i - start, j - start)
        moved = np.flatnonzero(root != np.arange(n))
        out.append((rep[start + moved], rep[start + root[moved]], np.zeros(len(moved), np.int64)))
    if listed:
        i, j = np.concatenate(listed, 1)
        fit = (own[i] | own[j]) & (label[i] == label[j])
        i, j = i[fit], j[fit]
        fit = _linked(x, i, j, least)
        i, j = i[fit], j[fit]
        out.append((rep[i], rep[j], np.zeros(len(i), np.int64)))
        counted.append((i, j))
    for i, j in counted:
        # Two blocks are compared with each other only; within itself a block is compared once.
        fit = (block[i] != block[j]) == rows["cross"][i]
        i, j = i[fit], j[fit]
        fit = _first_meeting(rows, i, j)
        i, j = i[fit], j[fit]
        links = np.bincount(i, rows["copies"][j], len(rep)) + np.bincount(j, rows["copies"][i], len(rep))
        some = np.flatnonzero(links)
        out.append((rep[some], np.full(len(some), -1), links[some].astype(np.int64)))
    return out


_TASK = ["bucket", "low", "high"]
_OUT = "rep long, other long, links long"


def _search(heavy: DataFrame, least: float) -> DataFrame:
    """Runs over rows sorted by task."""
    ship(heavy.sparkSession)
    schema = heavy.sparkSession.createDataFrame([], _OUT).schema
    target = to_arrow_schema(schema)

    def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = pc.binary_length(table.column("unit")).to_numpy().astype(np.int64)
        kinds = sizes << 32 | table.column("hashes").to_numpy()
        alike = np.unique(kinds)
        for kind in alike:
            part = table.filter(pa.array(kinds == kind)) if len(alike) > 1 else table
            hashes = int(kind & 0xFFFFFFFF)
            column = lambda name: part.column(name).to_numpy()
            n = part.num_rows
            starts = group_starts(part, _TASK)
            rows = {
                "x": np.frombuffer(b"".join(part.column("unit").to_pylist()), np.float64).reshape(n, -1),
                "codes": np.frombuffer(b"".join(part.column("axes").to_pylist()), "<i4").reshape(n, 2, n_tables(hashes), hashes),
                "label": np.unique(np.array(part.column("label").to_pylist()), return_inverse=True)[1],
                "cross": column("low") != column("high"),
                "own": part.column("is_own").to_numpy(zero_copy_only=False).astype(bool),
            } | {name: column(name) for name in ("rep", "block", "place", "copies")}
            for rep, other, links in _compare(rows, starts, least):
                empty = pa.array(other, mask=other < 0) if len(other) else pa.array(other)
                yield pa.RecordBatch.from_arrays([pa.array(rep), empty.cast(pa.int64()), pa.array(links)], schema=target)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _TASK):
            yield from emit(table)

    return heavy.mapInArrow(search, schema)


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``embeddings(vec_id, embedding, label)``: its links, its component, and whether it is the kept one.

    Vectors are only compared if their labels and lengths are equal and no label is null. A vector that is null, zero or empty,
    or holds a null or a number that is not finite, is linked with nothing, and so is one without an id, which has no
    component and is kept. Repeated rows are further vectors, and linked with each other. Further columns are ignored; an empty table gives an empty one.
    """
    vectors = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        F.transform(F.col("embedding").cast("array<double>"), lambda v: v + F.lit(0.0)).alias("vector"),
    )
    known = written(_classes(vectors), "polytope-classes")
    classes = known.select("rep", "copies", F.col("label").cast("string").alias("label"), "vector")
    hashed = written(_hashed(_with_hashes(classes)), "polytope-hashes")
    rows = written(_bucket_rows(hashed), "polytope-buckets")
    heavy = rows.join(hashed.select("rep", "copies", "label", "hashes", "unit", "axes"), "rep")
    heavy = heavy.repartition(*_TASK).sortWithinPartitions(*_TASK)
    found = written(_search(heavy, cosine), "polytope-links")
    edges = found.where(F.col("other").isNotNull()).select(F.col("rep").alias("a"), F.col("other").alias("b"))
    counts = found.where(F.col("other").isNull()).groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(edges, "polytope-components")
    results = (
        known.join(counts, "rep", "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    # Rows that take no part find no class: their keys are null, or not among the classes'.
    whole = vectors.withColumn("vector", F.when(_usable(F.col("label"), F.col("vec_id"), F.col("vector")), F.col("vector")))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return whole.join(results, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
