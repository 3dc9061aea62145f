"""Near-duplicates by one-permutation MinHash with optimal densification.

One hash of each shingle gives both its bin and its value; a bin keeps its least value, and an empty bin
borrows from another that its own sequence of probes finds. Bands of bins are buckets. In a bucket
all members are paired with one centre, so pairs are as many as rows; a pair is a link when the
full shingle sets are similar enough. Members that are not yet linked get a few other centres of their bucket. A bucket
that still has members of several components is compared as a whole, block against block, where the blocks' sets
meet in one task that gives out no pairs, only a spanning forest of the components that it finds linked.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import byte_texts, give_back, lists, map_batches, sealed, small_batches
from weir.llm.components import components, forest
from weir.llm.text_arrays import joined, lower_ascii, mixed, run_hashes, runs, separator_table

BINS = 128
BAND = 4

# Centres of a bucket in the second round.
CENTRES = 4

# Links need 100 * intersection >= PERCENT * union.
PERCENT = 80

# Sets, and shingles of sets, of a block; columns of shingles that are compared at once.
BLOCK_SETS = 2048
BLOCK_SHINGLES = 1 << 21
COLUMNS = 2048

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of all texts, and where each text's begin.

    Words are runs without separators, with A-Z lower-cased. Fewer words than ``size`` are one shingle.
    """
    data, offsets = joined(texts)
    starts, ends = runs(separator_table()[data])
    words = run_hashes(data, starts, ends, lower_ascii())
    first = np.searchsorted(starts, offsets)
    n = np.diff(first)
    state = np.zeros(len(words), np.uint64)
    for k in range(size):  # a window that leaves its text is cut off below
        state = mixed(state * _STEP + np.roll(words, -k))
    doc = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(words)) - np.repeat(first[:-1], n)
    whole = place <= np.repeat(n, n) - size
    docs, hashes = [doc[whole]], [state[whole]]
    for i in np.flatnonzero((n > 0) & (n < size)).tolist():
        own = np.full(1, n[i], np.uint64)
        for word in words[first[i] : first[i + 1]]:
            own = mixed(own * _STEP + word)
        docs.append([i])
        hashes.append(own)
    doc, hashed = np.concatenate(docs).astype(np.int64), np.concatenate(hashes).astype(np.uint64)
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    doc, hashed = doc[new], hashed[new]
    return hashed, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray, bins: int = BINS) -> np.ndarray:
    """A row of ``bins`` values for each set that is not empty, other rows are undefined."""
    n = np.diff(first)
    table = np.full(len(n) * bins, _EMPTY)
    spread = mixed(hashes + _STEP)
    at = np.repeat(np.arange(len(n)), n) * bins + (spread % np.uint64(bins)).astype(np.int64)
    np.minimum.at(table, at, spread // np.uint64(bins))
    table = table.reshape(len(n), bins)
    filled = table != _EMPTY
    row, column = np.nonzero(~filled & (n > 0)[:, None])
    out = table.copy()
    probe = 0
    while len(row):  # every probe of a bin is the same for all sets
        probe += 1
        donor = (mixed(column.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(probe)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, donor]
        out[row[hit], column[hit]] = table[row[hit], donor[hit]]
        row, column = row[~hit], column[~hit]
    return out


def bands(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    rows, bins = signature.shape
    parts = signature.reshape(rows, bins // band, band)
    state = np.broadcast_to(np.arange(bins // band, dtype=np.uint64), parts.shape[:2])
    for k in range(band):
        state = mixed(state * _STEP + parts[:, :, k])
    return state


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, n_shingles, set_key, bands)`` of whole texts; the key stands for the set, NULL for none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first = shingle_sets(byte_texts(batch.column(1)), size)
        n = np.diff(first)
        buckets = bands(signatures(hashes, first)).view(np.int64)
        full = n > 0
        keys = [
            md5(hashes[a:b].tobytes()).digest() if b > a else None
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
        ]
        offsets = np.concatenate([[0], np.cumsum(full * buckets.shape[1])])
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), lists(buckets[full].ravel(), offsets, pa.int64())]
        give_back()
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "bands"])

    schema = "doc_id BIGINT, n_shingles BIGINT, set_key BINARY, bands ARRAY<BIGINT>"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def _sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``(node, shingles)`` of the documents named by ``ids``; a repeated id has a row for each of its rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first = shingle_sets(byte_texts(batch.column(1)), size)
        give_back()
        return pa.RecordBatch.from_arrays([batch.column(0), lists(hashes.view(np.int64), first, pa.int64())], ["node", "shingles"])

    chosen = docs.select("doc_id", "text").join(ids.select(F.col("node").alias("doc_id")), "doc_id")
    return map_batches(chosen, run, "node BIGINT, shingles ARRAY<BIGINT>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", (F.size("x") + F.size("y")).alias("sizes"), common.alias("common"))
        .where(F.col("common") * 100 >= F.lit(percent) * (F.col("sizes") - F.col("common")))
        .select("a", "b")
    )


def _tested(pairs: DataFrame, sets: DataFrame, percent: int, links: DataFrame | None) -> DataFrame | None:
    fresh = sealed(_confirmed(sealed(pairs, "minhash-pairs"), sets, percent), "minhash-links")
    if fresh.isEmpty():
        return links
    return fresh if links is None else links.unionByName(fresh)


def _labelled(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """``(bucket, node, component)`` of the buckets that have members of several components."""
    if links is None:
        rows = members.select("bucket", "node", F.col("node").alias("component"))
    else:
        label = components(links)
        rows = members.select("bucket", "node").join(label, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    rows = sealed(rows, "minhash-labelled")
    several = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return sealed(rows.join(several.select("bucket"), "bucket"), "minhash-open")


def _star_pairs(members: DataFrame) -> DataFrame:
    """Every member of an open bucket with :data:`CENTRES` members of it, but for those of its own component.

    Buckets of one group rank their members alike, so they mostly choose the same centres; a node's are gathered,
    no more than its buckets times :data:`CENTRES`, before a row is made of each.
    """
    rank = [F.xxhash64("node", F.lit(i)) for i in range(CENTRES)]
    chosen = [F.struct(F.min_by("node", r).alias("centre"), F.min_by("component", r).alias("own")) for r in rank]
    centres = members.groupBy("bucket").agg(F.array_distinct(F.array(*chosen)).alias("chosen"))
    others = F.filter("chosen", lambda c: c["own"] != F.col("component"))
    each = members.join(centres, "bucket").select("node", others.alias("others")).where("size(others) > 0")
    gathered = each.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("others"))).alias("others"))
    pairs = gathered.select("node", F.explode("others.centre").alias("centre"))
    return pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _block_edges(table: pa.Table, percent: int) -> pa.Table:
    """``(a, b)`` of components that the sets of two blocks link: a spanning forest, fewer rows than components."""
    names, label = np.unique(table["component"].to_numpy(), return_inverse=True)
    block, low, high = table["block"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    shingles = table["shingles"].combine_chunks()
    n = shingles.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    # Shingles that stand in one set alone are in no intersection.
    _, column, held = np.unique(shingles.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
    number = np.cumsum(held > 1) - 1
    row = np.repeat(np.arange(len(n)), n)[held[column] > 1]
    column = number[column[held[column] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    common = np.zeros((len(left), len(right)), np.float32)
    place = np.full((2, len(n)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    for start in range(0, int(held.size and number[-1] + 1), COLUMNS):
        part = slice(*np.searchsorted(column, [start, start + COLUMNS]))
        sides = []
        for k, size in enumerate((len(left), len(right))):
            at = place[k, row[part]]
            side = np.zeros((size, COLUMNS), np.float32)
            side[at[at >= 0], column[part][at >= 0] - start] = 1
            sides.append(side)
        common += sides[0] @ sides[1].T
    common = common.astype(np.int64)
    near = common * 100 >= percent * (n[left][:, None] + n[right][None, :] - common)
    x, y = np.nonzero(near & (label[left][:, None] != label[right][None, :]))
    root = forest(len(names), label[left][x], label[right][y])
    at = np.flatnonzero(root != np.arange(len(names)))
    return pa.table({"a": pa.array(names[at], pa.int64()), "b": pa.array(names[root[at]], pa.int64())})


def _open_edges(members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``(a, b)`` between components of the open buckets ``(bucket, node, component)``: all that their members' links lead to.

    A bucket's members are dealt into blocks of bounded size, and each two blocks are compared in one task with their
    sets. Buckets with the same members are looked at once, and of two members, which the first star has paired, not at all.
    """
    weighed = members.join(sizes, "node")
    lanes = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"lane{i}") for i in range(2)]
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks")
    buckets = weighed.groupBy("bucket").agg(F.count("*").alias("n"), *lanes, blocks).where("n > 2")
    once = sealed(buckets.groupBy("n", "lane0", "lane1").agg(F.min("bucket").alias("bucket"), F.max("blocks").alias("blocks")), "minhash-blocks")
    dealt = members.join(once.select("bucket", "blocks"), "bucket").withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    met = dealt.select("bucket", "node", "component", "block", other).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "block"
    )
    small_batches(members.sparkSession)
    whole = met.join(sets, "node").groupBy("bucket", "i", "j")
    return whole.applyInArrow(lambda table: _block_edges(table, percent), "a BIGINT, b BIGINT").distinct()


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for every row of ``docs``.

    Equal sets are one node, so exact copies cost a row each. Texts without words, empty or NULL, link with
    nothing. Of repeated ids each row is looked at, and they share a component when their sets do. A NULL id
    takes no part: its component is NULL and it is kept. Other columns are not read.

    Similar sets meet in some bucket with certainty but for some ``(1 - s ** BAND) ** (BINS / BAND)``, below one in
    ten million at a similarity of 0.8. There is no limit on the size of a bucket, and no two of its members are left
    apart that are similar.
    """
    found = sealed(sketch(docs, size), "minhash-sketch")
    nodes = sealed(
        found.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
        .groupBy("set_key").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"), F.any_value("n_shingles").alias("n_shingles")),
        "minhash-nodes",
    )
    rows = nodes.select("node", F.explode_outer("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = sealed(rows.join(shared, "bucket"), "minhash-members")
    sets = sealed(_sets(docs, members.select("node").distinct(), size), "minhash-sets")
    # The smallest member is the centre of all buckets of a group in which it stands.
    first = members.groupBy("bucket").agg(F.min("node").alias("centre"))
    pairs = members.join(first, "bucket").where("node > centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = _tested(pairs, sets, percent, None)
    members = _labelled(members, links)
    if not members.isEmpty():
        links = _tested(_star_pairs(members), sets, percent, links)
        members = _labelled(members, links)
    if not members.isEmpty():
        edges = sealed(_open_edges(members, nodes.select("node", "n_shingles"), sets, percent), "minhash-open-links")
        if not edges.isEmpty():
            links = edges if links is None else links.unionByName(edges)
    labels = None if links is None else components(links)
    of_set = nodes.select("set_key", "node")
    if labels is not None:
        of_set = of_set.join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    else:
        of_set = of_set.select("set_key", F.col("node").alias("component"))
    result = found.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_copies(docs: DataFrame, size: int = 5) -> DataFrame:
    """``docs`` with one document of each group left; rows that repeat an id stay together."""
    dropped = near_duplicates(docs, size).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")


def near_duplicates_sql(size: int = 4, percent: int = PERCENT) -> str:
    """The same rows in DuckDB's SQL, over all pairs of documents that share a shingle."""
    shingle = "array_to_string(w[i:i + least(len(w), {0}) - 1], ' ')".format(size)
    return rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, hash({shingle}) AS s FROM
        (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - {size - 1}, 1))) AS i FROM d WHERE len(w) > 0)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    e AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
        WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
    r AS (SELECT DISTINCT a AS doc_id, a AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
    m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id,
           d.doc_id = coalesce(m.c, d.doc_id) AS kept
    FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
    """
