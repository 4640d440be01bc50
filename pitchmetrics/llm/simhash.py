"""SimHash near-duplicates through BK-trees.

Fingerprints are cut into ``radius + 1`` blocks of bits; two fingerprints within the
radius agree in one block, so each fingerprint goes to the shards of its own block
values only.  A shard over ``TREE`` fingerprints is dealt out once more by blocks of
the bits left (the same argument holds inside it), and what is still larger is held as
several trees, each of which every fingerprint of the shard visits once.  A tree has its
children keyed by their integer Hamming distance to the parent; a search follows only
edges whose key is within the radius of its own distance.  Trees and queries meet in a
task through a shuffle, as they are as many as the corpus needs; nothing is broadcast.
A task keeps one tree and a union-find of its members and returns at most a link for
each fingerprint it read, so groups of copies of any size give linear output.

Defined cases: a text that is null, empty or without words has fingerprint zero and is
linked like any other; fewer words than a shingle make one shingle; repeated shingles
count each time; repeated rows are rows of their own with one component; a null key is
kept, and the component is the smallest key that is not null; an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import slices
from .common import components, stored

#: fingerprints in one BK-tree
TREE = 4096
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, ngram: int, seed: int) -> int:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    begins = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    n = min(ngram, len(words))
    hashes = [digest(flat[a:b], seed) for a, b in zip(begins, ends[n - 1:], strict=False)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 50_000):
        part = np.array(hashes[i:i + 50_000], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = 3, seed: int = 42) -> DataFrame:
    """(key, fp): fp is the 64-bit fingerprint as a signed bigint."""
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in slices(batch.column(1)):
                fp = np.array([fingerprint(t, ngram, seed) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), pa.array(fp)], ["key", "fp"])

    return rows.mapInArrow(run, T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("fp", T.LongType())]))


class BkTree:
    """Distinct 64-bit integers; ``kids`` of a node: distance to it -> child."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.kids: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        new, node = len(self.value), 0
        self.value.append(x)
        self.kids.append({})
        while new:
            d = (self.value[node] ^ x).bit_count()
            if d not in self.kids[node]:
                self.kids[node][d] = new
                return
            node = self.kids[node][d]

    def within(self, x: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.value else []
        while todo:
            node = todo.pop()
            d = (self.value[node] ^ x).bit_count()
            if d <= radius:
                found.append(node)
            kids = self.kids[node]
            if len(kids) <= 2 * radius:
                todo += [k for e, k in kids.items() if abs(e - d) <= radius]
            else:
                todo += [kids[e] for e in range(d - radius, d + radius + 1) if e in kids]
        return found


def _masks(bits: list[int], parts: int) -> list[list[int]]:
    cut = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _signed(bits: list[int]) -> int:
    return int(np.uint64(sum(1 << b for b in bits)).view(np.int64))


def _tree_links(radius: int):
    """Rows (table, value, tree, fp, member) sorted by shard, members first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[tuple[int, int]] = []
        for _, shard in groupby(rows(), key=lambda r: r[:3]):
            tree, root = BkTree(), []

            def top(i: int, root=root) -> int:
                while root[i] != i:
                    root[i] = i = root[root[i]]
                return i

            for _, _, _, fp, member in shard:
                found = tree.within(fp & 0xFFFFFFFFFFFFFFFF, radius)
                for a in found[1:]:
                    root[top(a)] = top(found[0])
                if member:
                    tree.add(fp & 0xFFFFFFFFFFFFFFFF)
                    root.append(top(found[0]) if found else len(root))
                elif found:
                    out.append((fp, tree.value[found[0]]))
            out += [(tree.value[i], tree.value[top(i)]) for i in range(len(root)) if top(i) != i]
            while len(out) > 20_000:
                yield _link_batch(out[:20_000])
                out = out[20_000:]
        if out:
            yield _link_batch(out)

    return run


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array([[x & 0xFFFFFFFFFFFFFFFF for x in pair] for pair in links], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])


def links(fps: DataFrame, radius: int = 2, tree: int = TREE) -> DataFrame:
    """(a, b): links between distinct fingerprints within ``radius``, enough of them to
    connect all that are connected."""
    spark = fps.sparkSession
    blocks = _masks(list(range(64)), radius + 1)
    rest = [[b for b in range(64) if b not in set(block)] for block in blocks]
    fine = [[block + sub for sub in _masks(left, radius + 1)] for block, left in zip(blocks, rest, strict=True)]

    def routed(df: DataFrame, masks: list[list[int]], base: int) -> DataFrame:
        cells = [F.struct(F.lit(base + i).alias("tab"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("val"))
                 for i, m in enumerate(masks)]
        return df.select("fp", F.explode(F.array(*cells)).alias("c")).select("c.tab", "c.val", "fp")

    def sized(df: DataFrame) -> DataFrame:
        n = df.groupBy("tab", "val").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        return df.join(n, ["tab", "val"])

    coarse = sized(routed(fps, blocks, 0))
    large = coarse.filter(F.col("n") > tree)
    split = None
    for i, masks in enumerate(fine):
        part = routed(large.filter(F.col("tab") == i).select("fp"), masks, len(blocks) + i * len(masks))
        split = part if split is None else split.unionByName(part)
    both = coarse.filter(F.col("n") <= tree).unionByName(sized(split))
    trees = F.ceil(F.col("n") / tree).cast("int")
    own = F.pmod(F.xxhash64(F.lit("tree"), "fp"), trees).cast("int")
    dealt = (both.select("tab", "val", "fp", own.alias("own"), F.explode(F.sequence(own, trees - 1)).alias("tree"))
             .select("tab", "val", "tree", "fp", (F.col("own") == F.col("tree")).alias("member")))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(shards, "tab", "val", "tree")
            .sortWithinPartitions("tab", "val", "tree", F.desc("member"), "fp")
            .mapInArrow(_tree_links(radius), "a long, b long"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = 3, radius: int = 2,
                    seed: int = 42, tree: int = TREE) -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``df``."""
    docs = stored(fingerprints(df, key, text, ngram, seed), "fingerprints")
    distinct = docs.groupBy("fp").agg(F.min("key").alias("low"))
    groups = components(links(distinct.select("fp"), radius, tree))
    lows = (distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    whole = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    named = lows.join(whole, "component").select("fp", "component_id")
    return docs.join(named, "fp").select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")
