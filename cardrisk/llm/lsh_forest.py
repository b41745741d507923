"""MinHash near-duplicates with an LSH forest.

Documents with equal shingle sets are one class, so copies cost nothing after
the first step. Each class has a signature of ``TREES * WIDTH`` minima. A tree
is one order of the signature (it starts at the tree's own place and runs on
cyclically); classes sorted by it stand beside those with which they share the
longest prefix.

Candidates. A region is the set of all classes that share a prefix of ``WIDTH``
minima in a tree. In a task its members are sorted by the tree's whole order, so
that those with the longest common prefix stand side by side; neighbours are
linked first, and what they join is compared on until every likely pair of the region is
connected. A spanning forest of the likely pairs is kept, never the pairs.

Depth. A region of up to ``REGION`` classes is compared in one task, one of up to
``CROWDED`` in blocks, with a task for every two blocks. A more crowded region goes
deeper: its members are sorted on by ``WIDTH`` further minima, in the tree's
own order and in ``MORE - 1`` further orders drawn for that region, as a deeper
prefix is shared more rarely. So a prefix that unrelated texts share (a frequent
shingle) falls apart, in as many steps as each part needs. Where a
step leaves the parts as large as pairs of similarity 0.8 would, the members resemble each other, depth does not
part them, and the region is compared in blocks: mostly true links, which join
at once, but the rows of a block are read once per block beside it.

Components of the links over all trees are the groups in which links are looked for.

Confirmation. The full shingle sets of a group are counted against each other
exactly; a group of more than ``BLOCK`` members is dealt into blocks, with a
task for every two blocks, and again only spanning links are kept. Components
of confirmed links are the result.

Chance of missing a link at similarity 0.8 with the defaults: a pair shares a
region of a tree with probability 0.8^4 = 0.41 and, where that is deepened, one
of the eight orders with 1 - 0.59^8 = 0.985. Were every region it shares deepened
three times, it would be missed with (1 - 0.41 * 0.985^3)^32 < 1.5e-7; without,
with less than 1e-7. Its signatures agree too rarely (six standard deviations) with
about 1e-9; more similar pairs are missed far more rarely still.

Defined results: words are runs of characters other than space and U+0009 to
U+000D, A-Z lower-cased; a text with fewer words than a shingle has one
shingle, its whole sequence; a null, empty or wordless text has none, is linked
with nothing and forms its own component; rows with a null id take part, and
their component is named by the smallest id in it (null if it has none); rows
that repeat an id are judged by it, so they are kept together; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .common import join_sized, mix64, pieces, task_sized, texts_of
from .components import components
from .shingles import set_digest, shingle_set, signature

TREES = 32
WIDTH = 4
REGION = 2048
CROWDED = 16 * REGION         # a region of more classes goes deeper
MORE = 8                      # orders in which it does
STEPS = 3                     # and how often, at most
LIKE = (4 / 5) ** WIDTH       # share of pairs of similarity 0.8 that a step leaves together
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21      # shingles of a block's members, about
N_HASHES = TREES * WIDTH
MULTIPLIERS = np.random.default_rng(20240101).integers(1, 1 << 62, N_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sign_documents(spark: SparkSession, docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text hash, n_shingles, class (null for an empty set) and signature.

    The signature holds the high bytes of all minima, then their low bytes, so
    that prefixes of both can be cut out of it as binary strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            n, digests, signatures = [], [], []
            for t in texts_of(b.column(2)):
                s = shingle_set(t, width)
                n.append(len(s))
                if len(s):
                    m = mix64(signature(s, MULTIPLIERS))
                    signatures.append(((m >> np.uint64(8)) & np.uint64(255)).astype(np.uint8).tobytes()
                                      + (m & np.uint64(255)).astype(np.uint8).tobytes())
                    digests.append(set_digest(s))
                else:
                    signatures.append(None)
                    digests.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())], ["doc_id", "th", "n_shingles", "cls", "sig"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        run, "doc_id long, th long, n_shingles long, cls binary, sig binary")


def tree_key(tree):
    """Prefix of ``WIDTH`` minima in the order of ``tree`` (a column), as a binary string."""
    return F.concat(*(F.substring("sig", tree * WIDTH + 1 + k * N_HASHES, F.lit(WIDTH)) for k in (0, 1)))


@lru_cache(maxsize=None)
def used_places(tree: int, path: str) -> tuple[int, ...]:
    """Signature places of the prefix that a region of ``tree`` shares, deepened along ``path``."""
    if not path:
        return tuple((tree * WIDTH + k) % N_HASHES for k in range(WIDTH))
    used = used_places(tree, path[:-1])
    return used + further_places(tree, path[:-1])[int(path[-1])]


@lru_cache(maxsize=None)
def further_places(tree: int, path: str) -> list[tuple[int, ...]]:
    """The next ``WIDTH`` places of the region in each order: the tree's own, and further ones drawn for it."""
    used = set(used_places(tree, path))
    left = [p for k in range(N_HASHES) if (p := (tree * WIDTH + k) % N_HASHES) not in used]
    rng = np.random.default_rng([20240102, tree, int("1" + path)])
    drawn = rng.permutation(left[WIDTH:])[:(MORE - 1) * WIDTH].reshape(MORE - 1, WIDTH)      # no place twice
    return [tuple(left[:WIDTH])] + [tuple(x) for x in drawn.tolist()]


def deepen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(region, tree, path, cls, sig) to (parent, tree, path, cls, key): every member in every further order."""
    for b in batches:
        regions, trees, paths = (b.column(k).to_pylist() for k in range(3))
        sigs = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint8).reshape(-1, 2 * N_HASHES)
        alike: dict[tuple, list[int]] = {}
        for i, at in enumerate(zip(trees, paths)):
            alike.setdefault(at, []).append(i)
        for (tree, path), rows in alike.items():
            for r, places in enumerate(further_places(tree, path)):
                keys = sigs[np.ix_(rows, [*places, *(p + N_HASHES for p in places)])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([regions[i] for i in rows], pa.int64()), pa.array([tree] * len(rows), pa.int32()),
                     pa.array([f"{path}{r}"] * len(rows)), b.column(3).take(pa.array(rows)),
                     pa.array([k.tobytes() for k in keys], pa.binary())], ["parent", "tree", "path", "cls", "key"])


def likely_forest(members: list[bytes], low: np.ndarray, tree: int, least: int, side: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Spanning links among the members whose signatures agree in ``least`` places or
    more; of members on two sides only pairs across are looked at."""
    n = len(members)
    across = bool(side.any() and not side.all())
    order = np.arange(n)
    if n > 2:      # by the tree's order: neighbours share the longest prefixes
        order = np.argsort(np.roll(low, -tree * WIDTH, axis=1).copy().view(f"S{N_HASHES}").ravel(), kind="stable")
    a, b = order[:-1], order[1:]
    near = (low[a] == low[b]).sum(1) >= least
    if across:
        near &= side[a] != side[b]
    run = np.zeros(n, np.int64)
    run[b] = np.cumsum(~near)
    out = [(members[i], members[j]) for i, j in zip(a[near], b[near])]
    open_ = np.ones(n, bool)
    for root in order:
        if not open_[root]:
            continue
        new = np.flatnonzero(open_ & (run == run[root]))
        queue = []
        while True:
            open_[new] = False
            queue += new.tolist()
            new = new[:0]
            while queue and not len(new):
                i = queue.pop()
                rest = np.flatnonzero(open_ & (side != side[i]) if across else open_)
                hits = rest[(low[rest] == low[i]).sum(1) >= least]
                out += [(members[root], members[j]) for j in hits]
                new = np.flatnonzero(open_ & np.isin(run, run[hits])) if len(hits) else hits
            if not len(new):
                break
    return out


def link_batch(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()),
                                       pa.array([x[1] for x in links], pa.binary())], ["u", "v"])


def forest_regions(spark: SparkSession, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The regions to compare -- region, tree, n (its classes) -- and their members (region, cls)."""
    places = classes.select("cls", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig")
    keyed = places.select("cls", "tree", F.lit("").alias("path"), F.xxhash64("tree", tree_key(F.col("tree"))).alias("region"))
    at = ["region", "tree", "path"]
    count = F.count(F.lit(1)).alias("n")
    sizes = keyed.groupBy(*at).agg(count).filter("n > 1")
    sizes = materialize(spark, task_sized(sizes, TREES * classes.count()), "regions")
    regions, members = [], []
    for step in range(STEPS + 1):
        crowded = sizes.filter(F.col("n") > CROWDED)
        members.append(keyed.select("region", "cls"))
        if step == STEPS or crowded.isEmpty():
            regions.append(sizes.select("region", "tree", "n"))
            break
        rows = join_sized(keyed.select(*at, "cls"), crowded.select("region", "n"), "region", keyed.count())
        rows = rows.join(classes.select("cls", "sig"), "cls").select(*at, "cls", "sig")
        rows = rows.mapInArrow(deepen, "parent long, tree int, path string, cls binary, key binary")
        rows = rows.withColumn("region", F.xxhash64("parent", "path", "key")).drop("key")
        rows = materialize(spark, rows, "deeper-members")
        parts = materialize(spark, rows.groupBy("parent", *at).agg(count).filter("n > 1"), "deeper-regions")
        # pairs left together, of all pairs and orders of the region
        together = parts.groupBy(F.col("parent").alias("region")).agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
        alike = crowded.join(together, "region").filter(F.col("pairs") >= LIKE * MORE * F.col("n").cast("double") * F.col("n"))
        alike = materialize(spark, alike.select(*at, "n"), "alike-regions")
        regions.append(sizes.filter(F.col("n") <= CROWDED).unionByName(alike).select("region", "tree", "n"))
        sizes = parts.join(alike.select(F.col("region").alias("parent")), "parent", "left_anti").drop("parent")
        sizes = materialize(spark, sizes, "regions")
        keyed = rows.drop("parent")
    return reduce(DataFrame.unionByName, regions), reduce(DataFrame.unionByName, members)


def candidate_links(spark: SparkSession, classes: DataFrame, threshold: float) -> DataFrame:
    """Links (u, v) whose components hold every pair worth confirming."""
    slack = 6 * (threshold * (1 - threshold) / N_HASHES) ** 0.5
    least = int(max(1, np.floor(N_HASHES * (threshold - slack))))

    def forest(members: list[bytes], low: list[bytes], tree: int, side: np.ndarray) -> list[tuple[bytes, bytes]]:
        matrix = np.frombuffer(b"".join(low), np.uint8).reshape(len(low), N_HASHES)
        return likely_forest(members, matrix, tree, least, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            links = []
            for tree, region in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                links += forest([m["cls"] for m in region], [m["low"] for m in region], tree, np.zeros(len(region), bool))
            yield link_batch(links)

    def run_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, low, other = None, [], [], []
        for batch in batches:
            for region, tree, a, b, mine, cls, sig in zip(*(c.to_pylist() for c in batch.columns)):
                if (region, tree, a, b) != now:
                    if len(members) > 1:
                        yield link_batch(forest(members, low, now[1], np.array(other, bool)))
                    now, members, low, other = (region, tree, a, b), [], [], []
                members.append(cls)
                low.append(sig)
                other.append(mine != a)
        if len(members) > 1:
            yield link_batch(forest(members, low, now[1], np.array(other, bool)))

    sizes, keyed = forest_regions(spark, classes)
    lows = classes.select("cls", F.substring("sig", N_HASHES + 1, N_HASHES).alias("low"))
    small = keyed.join(sizes.filter(F.col("n") <= REGION).select("region", "tree"), "region")
    regions = small.join(lows, "cls").groupBy("region", "tree").agg(F.collect_list(F.struct("cls", "low")).alias("members"))
    links = regions.select("tree", "members").mapInArrow(run, "u binary, v binary")
    large = sizes.filter(F.col("n") > REGION)
    if large.isEmpty():
        return links
    # Few regions are this large; they are at most 1/REGION of the places.
    large = large.select("region", "tree", F.ceil(F.col("n") / REGION).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    rows = keyed.join(large, "region").join(lows, "cls").select(
        "region", "tree", "cls", "low", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    at = ["region", "tree", "a", "b"]
    rows = rows.select("region", "tree", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "cls", "low")
    rows = rows.repartition(*at).sortWithinPartitions(*at)
    return links.unionByName(rows.mapInArrow(run_blocks, "u binary, v binary"))


def exact_forest(keys: list[bytes], sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[bytes, bytes]]:
    """Spanning links among sets with 100 * intersection >= percent * union; of
    members on two sides only pairs across are looked at."""
    n = len(sets)
    if n < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[ids] > 1                      # a shingle of one set adds to no intersection
    number = np.cumsum(counts > 1) - 1
    ids, owner = number[ids[shared]], owner[shared]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    step = 2048
    for at in range(0, int(number[-1]) + 1, step):
        lo, hi = np.searchsorted(ids, [at, at + step])
        x = np.zeros((n, step), np.float32)
        x[owner[lo:hi], ids[lo:hi] - at] = 1
        both += x @ x.T
    inter = both.astype(np.int64)
    near = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
    if side.any() and not side.all():
        near &= side[:, None] != side[None, :]
    np.fill_diagonal(near, False)
    open_ = np.ones(n, bool)
    out = []
    for root in range(n):
        if not open_[root]:
            continue
        open_[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            new = np.flatnonzero(near[i] & open_)
            open_[new] = False
            queue += new.tolist()
            out += [(keys[root], keys[j]) for j in new]
    return out


def confirmed_links(spark: SparkSession, docs: DataFrame, classes: DataFrame, groups: DataFrame,
                    width: int, percent: int) -> DataFrame:
    """Spanning links among the classes of each group, counted on full shingle sets."""
    members = groups.withColumnRenamed("node", "cls").join(
        classes.select("cls", "rep_id", "rep_th", "n_shingles"), "cls")
    n_members = groups.count()
    members = materialize(spark, task_sized(members, n_members), "group-members")
    sizes = members.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("n"))
    sizes = materialize(spark, task_sized(sizes, n_members), "group-sizes")
    members = task_sized(join_sized(members, sizes, "root", n_members), n_members)
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rows = texts.join(members, texts["doc_id"].eqNullSafe(members["rep_id"]) & (texts["th"] == members["rep_th"]))
    mine = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    rows = rows.select("root", "cls", "text", mine.alias("mine"),
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("root", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "cls", "text")
    rows = rows.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def finish() -> pa.RecordBatch:
            keys = list(held)
            side = np.array([held[k][0] != now[1] for k in keys], bool)
            links = exact_forest(keys, [held[k][1] for k in keys], side, percent)
            return link_batch(links)

        for batch in pieces(batches):
            for root, a, b, mine, cls, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, a, b) != now:
                    if len(held) > 1:
                        yield finish()
                    now, held = (root, a, b), {}
                if cls not in held:      # rows that repeat id and text come twice
                    held[cls] = (mine, shingle_set(text or "", width))
        if len(held) > 1:
            yield finish()

    return rows.mapInArrow(run, "u binary, v binary")


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and the text's hash ``th`` of every row of ``docs``."""
    signed = materialize(spark, sign_documents(spark, docs, width), "signed")
    n_rows = signed.count()
    sized = lambda df: task_sized(df, n_rows)
    full = signed.filter(F.col("cls").isNotNull())
    classes = full.groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "n_shingles", "sig")).alias("rep"),
        F.count(F.lit(1)).alias("n")).select(
        "cls", "n", "rep.n_shingles", "rep.sig", F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("rep_th"))
    classes = materialize(spark, sized(classes), "classes")
    groups = components(spark, candidate_links(spark, classes, percent / 100))
    groups = materialize(spark, groups, "groups")
    roots = components(spark, confirmed_links(spark, docs, classes, groups, width, percent))
    named = classes.select("cls", "n", "rep_id").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = materialize(spark, sized(named.withColumn("root", F.coalesce("root", "cls"))), "named")
    names = named.groupBy("root").agg(F.min("rep_id").alias("component_id"), F.count(F.lit(1)).alias("m"))
    names = materialize(spark, sized(names), "names")
    named = join_sized(named.select("cls", "n", "root"), names, "root", named.count(), "m").drop("root")
    named = materialize(spark, sized(named), "class-names")
    out = sized(join_sized(full.drop("sig"), named, "cls", n_rows))
    alone = signed.filter(F.col("cls").isNull()).withColumn("component_id", F.col("doc_id"))
    return out.unionByName(alone.drop("sig")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "th")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """The documents, all columns as they were, one id of each component."""
    kept = near_duplicates(spark, docs, width, percent).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    own = docs.withColumn("__h", F.xxhash64("text"))
    return own.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left_semi").drop("__h")
