"""Operator 7: Jaccard self-join on word n-grams by MinHash banding.

Two documents link if the Jaccard similarity of their sets of word 5-grams is
0.8 or more.  The band count follows from the target recall: with ``ROWS`` = 7
rows a pair at 0.8 shares one of 40 bands with probability 0.9999.

1. Every text becomes a set key (a digest of its whole n-gram set) and band
   hashes.  Documents with equal sets are one node, whatever their ids
   (pre-aggregated, so a hot text is one row).
2. Shuffle on band hashes: each bucket links its members to its smallest one,
   a star, so a bucket of n members gives n - 1 rows and not all pairs.
3. Connected components of these candidate links (large-star / small-star
   rounds on a shared table) bound where links can be: every pair that shares
   a band lies in one component.
4. Texts of candidates are dealt by component, components above ``WHOLE``
   members or twice ``GRAMS`` n-grams by pairs of blocks of about ``BLOCK``
   members and ``GRAMS`` n-grams; a task builds the full n-gram
   sets and verifies *all* pairs of its group exactly.  No pair is emitted:
   out come each member's number of links and its verified class in the group.
5. Classes of block pairs are connected once more.

Result: one row per document with ``class_id`` (the smallest doc_id of its
connected class of verified links) and ``n_links`` (the number of other
documents with similarity 0.8 or more, copies counted).  A component of m texts
costs m / BLOCK copies of each text, the price of exact links in it.

Defined results: null texts and texts without a word have an empty set, link to
nothing and are their own class; texts of fewer than five words have one n-gram
of all their words; every row counts by its own text, so rows that repeat a
doc_id may be of different classes, and rows without id link like others (their
class_id is the smallest id of the class, null if it has none); ids may be of any
type that has an order; ties go to the smaller doc_id; an empty table gives an
empty result; extra columns are ignored by ``join`` and kept by ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, identified, map_rows, partitions, staged, text_or_empty
from .shingles import band_shape, gram_sets, minhash_functions, mixed

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
ROWS = 7
SEED = 71
WHOLE = 512
BLOCK = 256
GRAMS = 2_000_000
#: Grams that verification lays side by side at once.
SLICE = 1 << 20


def _key(grams: np.ndarray) -> str | None:
    if not len(grams):
        return None
    return hashlib.blake2b(np.ascontiguousarray(grams), digest_size=16).hexdigest()


def _signatures(docs: DataFrame, words: int, rows: int, bands: int) -> DataFrame:
    """doc_id, _file, _index, set_key (null: empty set), grams (its size), bands
    (one 64-bit key each) and row (a number of its own) for identified ``docs``."""
    def start():
        a, b = minhash_functions(rows * bands, SEED)
        salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))

        def work(cols):
            *ids, texts = cols
            keys, sizes, buckets = [], [], []
            for begin in range(0, len(texts), 64):
                for grams in gram_sets(texts[begin:begin + 64], words):
                    keys.append(_key(grams))
                    sizes.append(len(grams))
                    if not len(grams):
                        buckets.append(None)
                        continue
                    least = np.full(rows * bands, 2**32 - 1, np.uint32)
                    for at in range(0, len(grams), 256):
                        x = (grams[at:at + 256] >> np.uint64(32)).astype(np.uint32)
                        part = x[:, None] * a
                        part += b
                        part ^= part >> np.uint32(15)
                        np.minimum(least, part.min(axis=0), out=least)
                    key = salt.copy()
                    for row in least.reshape(bands, rows).T.astype(np.uint64):
                        key = mixed(key ^ row)
                    buckets.append(key.view(np.int64).tolist())
            return [*ids, keys, sizes, buckets]
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, [F.col("doc_id"), F.col("_file"), F.col("_index"),
                           text_or_empty().alias("text")],
                    f"doc_id {kind}, _file long, _index long, set_key string, grams long, "
                    "bands array<long>", start).withColumn("row", F.monotonically_increasing_id())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; a > b): the smallest
    node of its component.  Alternates large-star and small-star until every
    edge ends at a root; the edges stay linear in the nodes."""
    spark = edges.sparkSession
    edges = staged(spark, edges.distinct(), "cc-edges")
    for _ in range(rounds):
        # Large star: neighbours above a node link to the least of its closed
        # neighbourhood.  The least nodes are read from a table, so the join
        # shuffles both sides itself and AQE can split a node with very many
        # neighbours.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")),
                       "cc-least")
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: a node and its neighbours below it link to the least.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
                 .where("a > b").distinct())
        edges = staged(spark, small, "cc-edges")
        # Done when every node either begins one edge or only ends edges.
        roles = (edges.select(F.explode(F.array(
            F.struct(F.col("a").alias("node"), F.lit(1).alias("begins")),
            F.struct(F.col("b").alias("node"), F.lit(0).alias("begins")))).alias("r"))
            .groupBy("r.node").agg(F.sum("r.begins").alias("n"), F.min("r.begins").alias("least")))
        if roles.where("n > 1 OR (n = 1 AND least = 0)").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _count_common(common: np.ndarray, sets: list[np.ndarray], width: int = 4096) -> None:
    """Add to ``common`` how many grams each two of the sorted ``sets`` share."""
    n = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), list(map(len, sets)))
    if not len(flat):
        return
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    gram = np.cumsum(new) - 1
    shared = np.bincount(gram)[gram] > 1
    owner, gram = owner[shared], np.cumsum(new & shared)[shared] - 1
    for begin in range(0, int(gram[-1]) + 1 if len(gram) else 0, width):
        a, b = np.searchsorted(gram, [begin, begin + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], gram[a:b] - begin] = 1
        common += part @ part.T


def _verify(texts: list[str], weights: np.ndarray, block: np.ndarray, cross: bool,
            words: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(links by member, least member of its linked class): all pairs of a
    group, or with ``cross`` those of different blocks."""
    n = len(texts)
    sets = gram_sets(texts, words)
    sizes = np.array([len(s) for s in sets], np.int64)
    common = np.zeros((n, n))
    # Sets are sorted, so ranges of hashes are slices of them; about ``SLICE``
    # grams are laid side by side at once.
    ranges = -(-int(sizes.sum()) // SLICE)
    bounds = [int(2**64 * i / ranges) for i in range(1, ranges)]
    cuts = [np.r_[0, np.searchsorted(s, np.array(bounds, np.uint64)), len(s)] for s in sets]
    for i in range(ranges):
        _count_common(common, [s[c[i]:c[i + 1]] for s, c in zip(sets, cuts)])
    both = sizes[:, None] + sizes[None, :] - common
    linked = (common > 0) & (common >= similarity * both - 1e-9)
    np.fill_diagonal(linked, False)
    if cross:
        linked &= block[:, None] != block[None, :]
    root = np.arange(n)
    while True:
        near = np.where(linked, root[None, :], n).min(axis=1, initial=n)
        new_root = np.minimum(root, near)
        new_root = new_root[new_root]
        if (new_root == root).all():
            break
        root = new_root
    return linked @ weights, root


def _verified(members: DataFrame, words: int, similarity: float) -> DataFrame:
    """Run ``_verify`` on every group of (comp, i, j); rows (node, root, links, whole)."""
    schema = "node long, root long, links long, whole boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

        def done():
            nodes, weights, block, texts = zip(*held)
            nodes = np.array(nodes)
            links, root = _verify(texts, np.array(weights, np.int64), np.array(block),
                                  at[1] != at[2], words, similarity)
            made = [nodes, nodes[root], links.astype(np.int64), np.full(len(nodes), at[1] < 0)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, types)],
                                              names=["node", "root", "links", "whole"])

        for batch in batches:
            for comp, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (comp, i, j) != at:
                    if held:
                        yield done()
                    held, at = [], (comp, i, j)
                held.append(row)
        if held:
            yield done()

    return (members.select("comp", "i", "j", "node", "weight", "block", "text")
            .mapInArrow(run, schema))


def _classes(docs: DataFrame, words: int, similarity: float, recall: float, rows: int
             ) -> tuple[DataFrame, DataFrame]:
    """(signatures of all rows; set_key, root, class_id, n_links of every set)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    bands = band_shape(similarity, recall, rows)
    signed = staged(spark, _signatures(docs, words, rows, bands), "ngram-signatures")
    # A node is a different set; the first row that has it stands for it.
    sets = (signed.where("set_key IS NOT NULL").groupBy("set_key")
            .agg(F.min("row").alias("node"), F.min("doc_id").alias("rep"),
                 F.count(F.lit(1)).alias("weight")))
    sets = staged(spark, sets, "ngram-sets")

    # Candidate links: a star in every bucket.  The least members are read from
    # a table, so that AQE can split the join of a bucket with very many members.
    stand = signed.join(sets.select("node"), F.col("row") == F.col("node"))
    banded = stand.select("node", F.explode("bands").alias("bucket"))
    least = staged(spark, banded.groupBy("bucket")
                   .agg(F.min("node").alias("lead"), F.max("node").alias("top"))
                   .where("lead < top").drop("top"), "ngram-leads")
    stars = (banded.join(least, "bucket").where("node > lead")
             .select(F.col("node").alias("a"), F.col("lead").alias("b")))
    parts = staged(spark, components(stars), "ngram-components")

    # Groups to verify: whole components, or pairs of blocks of large ones.
    at = signed.select(F.col("row").alias("node"), "_file", "_index", "grams")
    own = sets.select("node", "weight").join(at, "node")
    parts = parts.join(own, "node")
    size = parts.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("grams").alias("g"))
    blocks = F.when((F.col("m") > WHOLE) | (F.col("g") > 2 * GRAMS),
                    F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("g") / GRAMS))
                    ).otherwise(F.lit(1))
    placed = (parts.join(size, "root").withColumn("nb", blocks.cast("int"))
              .withColumn("block", F.expr("CAST(pmod(xxhash64(node), nb) AS INT)"))
              .withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
              .select("node", F.col("root").alias("comp"), "block", "weight", "_file", "_index",
                      F.expr("IF(nb = 1, -1, least(block, other))").alias("i"),
                      F.expr("IF(nb = 1, -1, greatest(block, other))").alias("j")))
    texts = docs.select("_file", "_index", text_or_empty().alias("text"))
    dealt = (texts.join(placed, ["_file", "_index"])
             .repartition(partitions(spark), "comp", "i", "j")
             .sortWithinPartitions("comp", "i", "j", "node"))
    checked = staged(spark, _verified(dealt, words, similarity), "ngram-links")

    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    settled = checked.where("whole").select("node", "root")
    open_ = checked.where("NOT whole AND node > root").select(
        F.col("node").alias("a"), F.col("root").alias("b"))
    if not open_.isEmpty():
        settled = settled.union(components(open_))
    found = links.join(settled, "node", "left")
    rooted = staged(spark, sets.join(found, "node", "left").select(
        "set_key", "rep", F.coalesce("root", "node").alias("root"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "ngram-classes")
    names = rooted.groupBy("root").agg(F.min("rep").alias("class_id"))
    return signed, rooted.drop("rep").join(names, "root")


def join(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
         recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, n_links for every row of ``docs``."""
    signed, by_set = _classes(identified(docs), words, similarity, recall, rows)
    return (signed.select("doc_id", "set_key").join(by_set, "set_key", "left")
            .select("doc_id", F.when(F.col("set_key").isNull(), F.col("doc_id"))
                    .otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
         recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """One row of each class stays, with all its columns: the first with the
    smallest doc_id, or the first of a class without ids.  Rows without a word
    all stay."""
    own = identified(docs)
    signed, by_set = _classes(own, words, similarity, recall, rows)
    best = (signed.select("doc_id", "row", "set_key").join(by_set, "set_key")
            .where(F.col("doc_id").eqNullSafe(F.col("class_id")))
            .groupBy("root").agg(F.min("row").alias("row")))
    place = signed.select("row", "_file", "_index", "set_key")
    stay = (place.where("set_key IS NULL").select("_file", "_index")
            .union(place.join(best.select("row"), "row").select("_file", "_index")))
    return own.join(stay, ["_file", "_index"], "left_semi").select(*docs.columns)
