"""Embedding near-duplicates over a robust-pruned flat graph.

Equal vectors are one node with a weight.  Centroids, fitted on a bounded sample, make
shards, and those within the link radius of each other make one; a node is a member of its
``OVERLAP`` nearest shards, so that shards overlap.  A shard over ``BLOCK`` members is dealt into blocks.  Each block links its members by robust
pruning of their nearest members and of their nearest members outside their own group of
near copies; a node's lists from all its blocks are united.  Each node then asks all
blocks of its nearest shard: a greedy search from the medoids and from the node itself
goes on along the united lists as long as a better node among the best ``BEAM`` is open,
and through every node within the range.  What it finds is verified by the cosine in
double precision.  An audit compares a sample of nodes with all nodes, until enough nodes
with links are in it; while the mean share of its links that such a node has is under
``GOAL``, the search is done again with more overlap.  Where the most overlap does not do,
all blocks are compared with all nodes, which finds every link.

A task keeps one block and a chunk of those who ask, and returns a count for each of them
and a spanning forest of the links it found, never the pairs of a group.  A link counts
for both ends: a member whose own search cannot meet the asker gets a count too.

Defined cases: null or zero vectors and vectors with a null, NaN or infinite component link
with nothing; vectors of different lengths have no cosine, so those of each length are
searched on their own; rows of equal vectors are linked; repeated rows are rows of their own; rows with a null key are linked like
others, and a component's id is its smallest key that is not null; an empty table gives
an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import ragged
from .common import components, stored

#: most vectors that centroids are fitted on, and members of a block
SAMPLE, BLOCK = 20_000, 2048
OVERLAP, MOST_OVERLAP, DEGREE, BEAM = 4, 12, 20, 12
#: members of a shard that the number of centroids aims at
MEMBERS = 1200
#: nodes that the audit compares with all nodes at first and at most at a time, those with
#: links that it needs, and the recall it wants
AUDIT, MOST_AUDIT, LINKED, GOAL = 400, 6400, 100, 0.97
CHUNK = 512


def _usable(vector: Column) -> Column:
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no square of a very large component
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(5)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        own = (sample @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def merged(c: np.ndarray, least: float) -> np.ndarray:
    """The shard of each centroid: centroids within the link radius of each other, or over
    others between them, are one shard, as links run between their nodes."""
    a, b = np.nonzero(np.triu(c @ c.T >= least, 1))
    return np.unique(_forest(a, b, len(c)), return_inverse=True)[1]


def pruned(x: np.ndarray, degree: int, near: float, alpha: float = 1.2) -> list[np.ndarray]:
    """Neighbours (indexes) of each row of ``x`` by robust pruning of its nearest rows, and
    of its nearest rows under the cosine ``near``; and all rows that chose it, as a row
    that many others choose is the only way to some of them."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, np.int64)]
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    links = []
    for allowed in (sim, np.where(sim < near, sim, -2)):
        c = min(2 * degree, n - 1)
        cand = np.argpartition(-allowed, c - 1, axis=1)[:, :c]
        value = np.take_along_axis(allowed, cand, 1)
        alive = value > -2
        rows = np.arange(n)
        for _ in range(degree // 2):
            best = np.where(alive, value, -3).argmax(1)
            ok = alive[rows, best]
            star = cand[rows, best]
            links.append(np.stack([rows[ok], star[ok]]))
            # squared distances of unit vectors are 2 - 2 cos
            covers = alpha * (2 - 2 * sim[star[:, None], cand]) <= 2 - 2 * value
            alive &= ~covers
            alive[rows, best] = False
            if not alive.any():
                break
    a, b = np.concatenate(links, axis=1)
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.split(pairs % n, np.searchsorted(pairs, np.arange(1, n) * n))


def medoids(x: np.ndarray, k: int = 4) -> np.ndarray:
    """The row nearest to the mean, and rows far from those before."""
    first = int((x @ x.mean(0)).argmax())
    picked, far = [first], x @ x[first]
    while len(picked) < min(k, len(x)):
        picked.append(int(far.argmin()))
        far = np.maximum(far, x @ x[picked[-1]])
    return np.array(picked)


def range_search(x: np.ndarray, lists: list[np.ndarray], starts: np.ndarray, asked: np.ndarray, own: np.ndarray, least: float,
                 beam: int = BEAM) -> np.ndarray:
    """Cosines (asked x rows of x) of what the searches have seen; -2: not seen."""
    flat, offsets = np.concatenate(lists), np.concatenate([[0], np.cumsum([len(v) for v in lists])])
    m, n = len(asked), len(x)
    seen = np.full((m, n), -2.0)
    closed = np.zeros((m, n), bool)

    def look(who: np.ndarray, at: np.ndarray) -> None:
        new = (at >= 0) & (seen[who, at] == -2)
        who, at = who[new], at[new]
        for i in range(0, len(who), 50_000):
            w, a = who[i:i + 50_000], at[i:i + 50_000]
            seen[w, a] = np.einsum("ij,ij->i", asked[w], x[a])

    everyone = np.arange(m)
    look(np.repeat(everyone, len(starts)), np.tile(starts, m))
    look(everyone, own)
    while True:
        free = np.where(closed, -3.0, seen)
        best = free.argmax(1)
        value = free[everyone, best]
        kth = np.partition(seen, max(0, n - beam), axis=1)[:, max(0, n - beam)]
        going = np.flatnonzero((value > -2) & (value >= kth))
        if not len(going):
            return seen
        who, at = np.nonzero(free >= least)
        who, at = np.concatenate([going, who]), np.concatenate([best[going], at])
        closed[who, at] = True
        if offsets[at + 1].sum() - offsets[at].sum() > m * n // 2:  # more to look at than the block has
            return asked @ x.T
        to, many = ragged(flat, offsets, at)
        look(np.repeat(who, many), to)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index connected to each of 0..n-1 over the pairs."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _groups(frames: Iterator[pd.DataFrame], keys: list[str], chunk: int) -> Iterator[tuple[pd.DataFrame, Iterator[pd.DataFrame]]]:
    """Of rows sorted by ``keys`` with members first: the members of a block, and those
    who ask it, a chunk at a time."""
    held: list[pd.DataFrame] = []
    now = None

    def cut() -> tuple[pd.DataFrame, Iterator[pd.DataFrame]]:
        whole = pd.concat(held, ignore_index=True)
        asking = whole[whole["asks"]]
        return whole[whole["member"]], (asking.iloc[i:i + chunk] for i in range(0, len(asking), chunk))

    for frame in frames:
        for key, part in frame.groupby(keys, sort=False):
            if key != now and held:
                yield cut()
                held = []
            now = key
            held.append(part)
            if sum(map(len, held)) > 4 * BLOCK:  # members are there, as they come first: go on with those who ask
                members, chunks = cut()
                yield members, chunks
                held = [members.assign(asks=False)]
    if held:
        yield cut()


def _search_shards(nodes: DataFrame, c: np.ndarray, shard: np.ndarray, overlap: int, least: float,
                   whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(node, found) and links (a, b) for nodes (node, weight, vector); ``shard`` is that of
    each centroid; ``whole``: blocks are compared as a whole, not searched."""
    spark = nodes.sparkSession
    order = np.argsort(shard, kind="stable")
    begins = np.searchsorted(shard[order], np.arange(shard.max() + 1))
    sent = spark.sparkContext.broadcast((c[order], begins))  # at most SAMPLE vectors
    near = least - 0.1

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, begins = sent.value
        for frame in frames:
            for i in range(0, len(frame), 4096):
                part = frame.iloc[i:i + 4096]
                sim = np.maximum.reduceat(_unit(part["vector"]) @ c.T, begins, axis=1)  # with the nearest centroid of a shard
                order = np.argsort(-sim, axis=1)[:, :overlap]
                yield pd.DataFrame({"node": part["node"].to_numpy().repeat(order.shape[1]), "shard": order.ravel(),
                                    "nearest": np.tile(np.arange(order.shape[1]) == 0, len(part)),
                                    "shards": [o for o in order for _ in range(order.shape[1])]})

    placed = nodes.select("node", "vector").mapInPandas(assign, "node long, shard long, nearest boolean, shards array<long>")
    sizes = placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # at most as many sizes as centroids
    dealt = placed.join(F.broadcast(sizes), "shard").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = stored(dealt.withColumn("block", F.explode(F.when(F.col("nearest"), F.sequence(F.lit(0), F.col("blocks") - 1))
                                                       .otherwise(F.array("own"))))
                   .select("shard", "block", "node", (F.col("own") == F.col("block")).alias("member"), F.col("nearest").alias("asks"),
                           "shards"), "dealt")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["shard", "block", "node", "vector"]

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for members, _ in _groups(frames, ["shard", "block"], CHUNK):
            node, lists = members["node"].to_numpy(), pruned(_unit(members["vector"]), DEGREE, near)
            yield pd.DataFrame({"node": node, "lists": [node[r] for r in lists]})

    members = dealt.filter("member").join(nodes.select("node", "vector"), "node").select(*columns, "member", F.lit(False).alias("asks"))
    lists = (members.repartition(tasks, "shard", "block").sortWithinPartitions("shard", "block")
             .mapInPandas(build, "node long, lists array<long>")
             # at most the members of the node's blocks
             .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("lists"))).alias("lists")))
    full = dealt.join(nodes, "node")
    full = (full.withColumn("lists", F.array().cast("array<long>")) if whole else full.join(lists, "node")).select(*columns, "weight", "lists", "member", "asks", "shards")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for members, chunks in _groups(frames, ["shard", "block"], CHUNK):
            x, node, weight = _unit(members["vector"]), members["node"].to_numpy(), members["weight"].to_numpy()
            home = np.array([s[0] for s in members["shards"]], np.int64)
            order = np.argsort(node)
            at = lambda ids: order[np.minimum(np.searchsorted(node, ids, sorter=order), len(node) - 1)]  # noqa: E731, B023
            table = []
            for ids in members["lists"]:
                place = at(np.asarray(ids, np.int64))
                table.append(place[node[place] == ids])
            starts = medoids(x)
            for asking in chunks:
                who = asking["node"].to_numpy()
                own = at(who)
                own = np.where(node[own] == who, own, -1)
                asked = _unit(asking["vector"])
                cos = asked @ x.T if whole else range_search(x, table, starts, asked, own, least)
                a, b = np.nonzero(cos >= least)
                other = who[a] != node[b]
                a, b = a[other], b[other]
                found = np.bincount(a, weight[b], len(who)).astype(np.int64)
                # an asker is met by the member's own search if it is a member of the shard where that one asks
                alone = (np.stack(asking["shards"].to_numpy())[a] != home[b][:, None]).all(1)
                given = np.bincount(b[alone], asking["weight"].to_numpy()[a[alone]], len(node)).astype(np.int64)
                both = np.concatenate([who, node])
                ids, back = np.unique(both, return_inverse=True)
                low = _forest(back[a], back[len(who) + b], len(ids))
                linked = np.flatnonzero(low != np.arange(len(ids)))
                got = np.flatnonzero(given)
                yield pd.DataFrame({"a": np.concatenate([who, node[got], ids[linked]]), "b": np.concatenate([who, node[got], ids[low[linked]]]),
                                    "found": np.concatenate([found, given[got], np.zeros(len(linked), np.int64)])})

    out = stored(full.repartition(tasks, "shard", "block").sortWithinPartitions("shard", "block", F.desc("member"), "node")
                 .mapInPandas(search, "a long, b long, found long"), "found")
    return out.filter("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("found").alias("found")), out.filter("a <> b").select("a", "b")


def recall(nodes: DataFrame, found: DataFrame, least: float) -> float:
    """The mean share of its links that a node with links was found to have.  The sample is
    drawn until ``LINKED`` such nodes are in it, or all nodes."""
    n = nodes.count()
    place = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 32))
    begin, size, many, total = 0, AUDIT, 0, 0.0
    while begin < 1 << 32 and many < LINKED:
        end = min(1 << 32, begin + max(1, (size << 32) // n))
        some = nodes.filter((place >= begin) & (place < end)).select("node", "vector").toPandas()
        begin, size = end, min(4 * size, MOST_AUDIT)
        if not len(some):
            continue
        # about ``MOST_AUDIT`` vectors
        sent = nodes.sparkSession.sparkContext.broadcast((_unit(some["vector"]), some["node"].to_numpy()))

        def compare(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            x, ids = sent.value
            total = np.zeros(len(ids), np.int64)
            step = max(64, 2_000_000 // len(ids))
            for frame in frames:
                for i in range(0, len(frame), step):
                    part = frame.iloc[i:i + step]
                    a, b = np.nonzero(x @ _unit(part["vector"]).T >= least)
                    node, weight = part["node"].to_numpy(), part["weight"].to_numpy()
                    other = ids[a] != node[b]
                    total += np.bincount(a[other], weight[b[other]], len(ids)).astype(np.int64)
            some = np.flatnonzero(total)
            yield pd.DataFrame({"node": ids[some], "true": total[some]})

        true = nodes.mapInPandas(compare, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
        share = F.least("true", F.coalesce("found", F.lit(0))) / F.col("true")
        met = true.join(found, "node", "left").agg(F.count(F.lit(1)).alias("n"), F.sum(share).alias("s")).first()
        many, total = many + met.n, total + (met.s or 0.0)
    return total / many if many else 1.0


def _linked(usable: DataFrame, least: float) -> DataFrame:
    """(x, y, n_links, component_id) of the classes of equal vectors; all vectors have one length."""
    classes = stored(usable.groupBy("x", "y").agg(F.min("id").alias("node"), F.min("key").alias("low"), F.count(F.lit(1)).alias("weight")), "classes")
    nodes = stored(classes.join(usable.select(F.col("id").alias("node"), "vector"), "node").select("node", "weight", "vector"), "nodes")
    n = nodes.count()
    sample = _unit(nodes.select("vector", F.xxhash64(F.lit("sample"), "node").alias("o")).orderBy("o").limit(SAMPLE).toPandas()["vector"])
    c = centroids(sample, max(1, min(len(sample) // 8, n * OVERLAP // MEMBERS)))
    shard = merged(c, least)
    overlap = OVERLAP
    while True:
        found, links = _search_shards(nodes, c, shard, overlap, least)
        found = stored(found, "links")
        if recall(nodes, found, least) >= GOAL:
            break
        if overlap >= min(MOST_OVERLAP, shard.max() + 1):
            found, links = _search_shards(nodes, c[:1], shard[:1] * 0, 1, least, whole=True)
            found = stored(found, "links")
            break
        overlap *= 2
    groups = components(links)
    named = (classes.join(found, "node").join(groups, "node", "left")
             .select("x", "y", "low", (F.col("found") + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("c")))
    lows = named.groupBy("c").agg(F.min("low").alias("component_id"))
    return named.join(lows, "c").select("x", "y", "n_links", "component_id")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    v = F.col(vector)
    base = df.select(F.col(key).alias("key"), v.alias("vector"), _usable(v).alias("ok"), F.size(v).alias("dims"),
                     F.xxhash64(v.cast("array<double>")).alias("x"), F.xxhash64(F.lit("v"), v.cast("array<double>")).alias("y"))
    base = stored(base.withColumn("id", F.monotonically_increasing_id()), "vectors")
    rows = base.select("key", "x", "y", "id")
    lengths = [r.dims for r in base.filter("ok").select("dims").distinct().orderBy("dims").collect()]
    if not lengths:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"),
                           F.lit(True).alias("kept"))
    per_class = None
    for n in lengths:
        own = _linked(base.filter(F.col("ok") & (F.col("dims") == n)), least)
        per_class = own if per_class is None else per_class.unionByName(own)
    out = rows.join(per_class, ["x", "y"], "left")
    component = F.coalesce("component_id", "key")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))
