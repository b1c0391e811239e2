"""Near-duplicate documents by MinHash with tensored tables.

A table of a locality-sensitive hash needs a key of several minhashes to be selective, and many tables are needed to miss no
similar pair. Here the keys come from two small collections of hashed groups: table (i, j) has as its key the i-th group of the
left collection and the j-th of the right one. ``m`` groups on each side give ``m * m`` tables for the minhashes of ``2 * m`` groups.

1. Documents of equal shingle sets form a class. Only classes go on, each as its least document.
2. A key in table (i, j) can only be shared if its left part and its right part are. Parts that one class alone has are dropped
   before the pairs are formed, which loses nothing and leaves classes without any near-duplicate no rows.
3. In each bucket of a table the class that shares most is the hub, and all others are candidates with it. Candidates are
   verified on whole sets, and links joined to components.
4. Around a hub whose classes are of several components, links between classes that are no hubs may be hidden. There all classes
   of different components are compared, in blocks, by matrix products that only give links. So no two classes that share a
   bucket go untested unless they are already connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from racestream.llm.components import components, forest
from racestream.llm.tables import doc_texts, group_starts, map_rows, ship, whole_groups
from racestream.session import written

#: Words of a shingle, and the least similarity of a link in percent, unless others are asked for.
WORDS, PERCENT = 5, 80
#: Minhashes of a group; a table's key has two groups.
GROUP = 3
#: Chance that a pair of just the least similarity shares no table.
MISSED = 1e-6
#: Ids of candidates, or of dropped documents, are broadcast up to this number (16 MB), and joined by shuffle beyond.
BROADCAST_IDS = 1_000_000

#: Sets, and shingles of sets, of a block of a hub's classes; a task compares two blocks.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1_000_000

_TASK = ["hub", "low", "high"]
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 4096


def groups_for(percent: int) -> int:
    """Groups per side: ``m`` independent chances on each side to agree, both of which must not all fail."""
    agree = (percent / 100) ** GROUP
    return max(1, math.ceil(math.log(MISSED / 2) / math.log(1 - agree))) if agree < 1 else 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 150_000:
            self[word] = value
        return value


_word_hashes = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: str, words: int) -> np.ndarray:
    """The distinct shingles of a text as 64-bit hashes, sorted. Fewer words than a shingle are one; no words are none."""
    tokens = text.encode().lower().split()
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_word_hashes.__getitem__, tokens), np.uint64, n)
    width = min(n, words)
    value = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        value = _mixed(value * _STEP + hashes[k : n - width + 1 + k])
    return np.unique(value)


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, (2, n), np.uint64, endpoint=False) | np.uint64(1)


def group_keys(values: np.ndarray, groups: int) -> np.ndarray:
    """The hashed groups of a set: left ones, then right ones."""
    a, b = _multipliers(2 * groups * GROUP)
    least = np.full(len(a), 2**64 - 1, np.uint64)
    for at in range(0, len(values), _BLOCK):
        block = np.multiply.outer(a, values[at : at + _BLOCK])
        block += b[:, None]
        np.minimum(least, block.min(1), out=least)
    parts = least.reshape(2 * groups, GROUP)
    key = np.zeros(2 * groups, np.uint64)
    for k in range(GROUP):
        key = _mixed(key * _STEP + parts[:, k])
    return key.view(np.int64)


def signatures(documents: DataFrame, words: int, groups: int) -> DataFrame:
    """Per document the size and the identity of its set, and its groups. An empty set has neither identity nor groups."""

    def sign(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"n_shingles": [], "set_id": [], "left": [], "right": []}
        for text in columns["text"]:
            values = shingles(text, words)
            keys = group_keys(values, groups) if len(values) else None
            out["n_shingles"].append(len(values))
            out["set_id"].append(blake2b(values.tobytes(), digest_size=16).hexdigest() if len(values) else None)
            out["left"].append(None if keys is None else keys[:groups])
            out["right"].append(None if keys is None else keys[groups:])
        return out | {"doc_id": columns["doc_id"]}

    schema = "doc_id long, n_shingles long, set_id string, left array<long>, right array<long>"
    return map_rows(doc_texts(documents), sign, schema)


def _shared_parts(classes: DataFrame, side: str) -> DataFrame:
    """The groups of a side that at least two classes have: class, position, key, and how many have it."""
    parts = classes.select("rep", F.posexplode(side).alias("i", "key"))
    often = parts.groupBy("i", "key").agg(F.count("rep").alias("n")).where("n > 1")
    return parts.join(often, ["i", "key"])


def table_rows(classes: DataFrame) -> DataFrame:
    """One row per class and table whose two parts are both shared: the bucket, and the weight of the class.

    The weight says how many others share its parts: in a group of similar texts the one nearest to all others has the most.
    """
    side = lambda name: (
        _shared_parts(classes, name)
        .groupBy("rep")
        .agg(F.collect_list(F.struct("i", "key")).alias(name), F.sum("n").alias(f"{name}_weight"))
    )
    both = side("left").join(side("right"), "rep")
    rows = both.select("rep", (F.col("left_weight") + F.col("right_weight")).alias("weight"), F.explode("left").alias("l"), "right")
    rows = rows.select("rep", "weight", "l", F.explode("right").alias("r"))
    return rows.select(F.xxhash64("l.i", "l.key", "r.i", "r.key").alias("bucket"), "rep", "weight")


def _may_link(n: Column, m: Column, percent: int) -> Column:
    """Sets of too different sizes cannot reach the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``(a, b)`` of classes whose whole sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return pairs.join(right, "b").join(left, "a").where(100 * common >= percent * union).select("a", "b")


def _sets(documents: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """The whole sets of the given classes. Their texts are found by a checked broadcast of the ids, or by shuffle."""
    ids = written(ids, "minhash-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = doc_texts(documents).join(wanted, F.col("doc_id") == F.col("rep"), "left_semi")

    def cut(columns: dict[str, list]) -> dict[str, list]:
        return {"rep": columns["doc_id"], "shingles": [shingles(text, words).view(np.int64) for text in columns["text"]]}

    return written(map_rows(texts, cut, "rep long, shingles array<long>"), "minhash-sets")


# Links between those that are not hubs

def _across(spokes: DataFrame, labels: DataFrame, sizes: DataFrame) -> DataFrame:
    """The classes around each hub whose classes are of several components, in blocks of bounded size.

    ``(hub, low, high)`` is the work of one task: all pairs of a block, or those between two blocks.
    """
    around = (
        spokes.join(labels, F.col("b") == F.col("node"), "left")
        .join(sizes, F.col("b") == F.col("rep"))
        .select(F.col("a").alias("hub"), F.col("b").alias("member"), F.coalesce("component", "b").alias("component"), "n_shingles")
    )
    size = F.greatest(F.count("member") / BLOCK_SETS, F.sum("n_shingles") / BLOCK_SHINGLES)
    mixed = around.groupBy("hub").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.ceil(size).cast("int").alias("blocks")
    )
    mixed = mixed.where("least < most").select("hub", "blocks")
    dealt = around.join(mixed, "hub").withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        "hub", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "member", "component"
    )


def common_counts(values: np.ndarray, lengths: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets, given end to end: of those at ``left`` with those at ``right``."""
    _, element, often = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    shared = often[element] > 1
    owner, element = owner[shared], (np.cumsum(often > 1) - 1)[element[shared]]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    common = np.zeros((len(left), len(right)), np.float32)
    width = int(element[-1]) + 1 if len(element) else 0
    for at in range(0, width, _BLOCK):
        part = slice(*np.searchsorted(element, [at, at + _BLOCK]))
        dense = np.zeros((len(lengths), min(_BLOCK, width - at)), np.float32)
        dense[owner[part], element[part] - at] = 1
        common += dense[left] @ dense[right].T
    return common


def _links_within(heavy: DataFrame, percent: int) -> DataFrame:
    """Links of each task, as a spanning forest: sets are compared by matrix products, and no pair leaves a task."""
    spark = heavy.sparkSession
    ship(spark)
    schema = spark.createDataFrame([], "a long, b long").schema
    target = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _TASK):
            starts = group_starts(table, _TASK)
            shingle_lists = table.column("shingles").combine_chunks()
            values, offsets = shingle_lists.flatten().to_numpy(), shingle_lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            member, component = table.column("member").to_numpy(), table.column("component").to_numpy()
            block, low, high = (table.column(name).to_numpy() for name in ("block", "low", "high"))
            out: list[np.ndarray] = []
            for start, end in zip(starts, [*starts[1:], table.num_rows]):
                mine = component[start:end]
                if (mine == mine[0]).all():
                    continue
                cross = low[start] != high[start]
                left = np.flatnonzero(block[start:end] == low[start])
                right = np.flatnonzero(block[start:end] == high[start])
                lengths = np.diff(offsets[start : end + 1])
                common = common_counts(values[offsets[start] : offsets[end]], lengths, left, right)
                union = lengths[left][:, None] + lengths[right][None, :] - common
                linked = (100 * common >= percent * union) & (mine[left][:, None] != mine[right][None, :])
                i, j = np.nonzero(linked if cross else np.triu(linked, 1))
                root = forest(end - start, left[i], right[j])
                moved = np.flatnonzero(root != np.arange(end - start))
                out.append(np.stack([member[start + root[moved]], member[start + moved]]))
            if out:
                a, b = np.concatenate(out, 1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=target)

    return heavy.mapInArrow(search, schema)


def _members(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: its set, and its component. ``component_id`` is the document itself where it has no links."""
    signed = written(signatures(documents, words, groups_for(percent)), "minhash-signatures")
    linked = signed.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    chosen = F.min_by(F.struct("n_shingles", "left", "right"), "doc_id").alias("s")
    classes = linked.groupBy("set_id").agg(F.min("doc_id").alias("rep"), chosen).select("set_id", "rep", "s.*")
    classes = written(classes, "minhash-classes")
    rows = written(table_rows(classes), "minhash-tables")
    hubs = rows.groupBy("bucket").agg(F.min(F.struct(-F.col("weight"), "rep")).alias("hub"), F.count("rep").alias("n"))
    hubs = hubs.where("n > 1").select("bucket", F.col("hub.rep").alias("a"))
    spokes = written(rows.join(hubs, "bucket").where("rep != a").select("a", F.col("rep").alias("b")).distinct(), "minhash-spokes")
    ids = spokes.select(F.col("a").alias("rep")).unionByName(spokes.select(F.col("b").alias("rep"))).distinct()
    sets = _sets(documents, ids, words)
    sizes = classes.select("rep", "n_shingles")
    fitting = (
        spokes.join(sizes.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n")), "b")
        .join(sizes.select(F.col("rep").alias("a"), F.col("n_shingles").alias("m")), "a")
        .where(_may_link(F.col("n"), F.col("m"), percent))
        .select("a", "b")
    )
    links = written(verified(fitting, sets, percent), "minhash-links")
    labels = written(components(links, "minhash-components"), "minhash-labels")
    around = _across(spokes, labels, sizes).join(sets, F.col("member") == F.col("rep")).drop("rep")
    more = written(
        _links_within(around.repartition(*_TASK).sortWithinPartitions(*_TASK), percent).distinct(), "minhash-across"
    )
    if not more.isEmpty():
        labels = written(components(links.unionByName(more), "minhash-components"), "minhash-labels")
    found = (
        classes.select("set_id", "rep")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("set_id", F.coalesce("component", "rep").alias("component"))
    )
    return (
        signed.select("doc_id", "n_shingles", "set_id")
        .join(found, "set_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            "set_id",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
    )


def near_duplicates(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: the size of its set, its component, and whether it is the kept one.

    Documents are linked if 100 * common shingles >= percent * shingles of either. Null and empty texts are linked with nothing.
    A null id has no component and is kept. Repeated rows are reported each time, as kept or not alike. Further columns are
    ignored; an empty table gives an empty one.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return _members(documents, words, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def keep_one(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with all their columns, without near-duplicates: the least id of each group stays.

    Rows without an id all stay. Of rows of one id and one text, one stays; an id goes if none of its rows is kept.
    """
    members = written(near_duplicates(documents, words, percent), "minhash-members").where(F.col("doc_id").isNotNull())
    ids = members.groupBy(F.col("doc_id").alias("_id")).agg(F.max("kept").alias("kept"), F.count("doc_id").alias("n"))
    dropped = written(ids.where(~F.col("kept")).select("_id"), "minhash-dropped")
    if dropped.count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)  # so the texts are not shuffled
    repeated = ids.where("kept AND n > 1").select("_id")
    same = F.col("doc_id") == F.col("_id")
    stay = documents.join(dropped, same, "left_anti")
    if repeated.isEmpty():
        return stay
    once = stay.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.join(repeated, same, "left_anti").unionByName(once)
