"""A z-fast trie of conversations: which share which first turns, and what sharing them saves.

Sequences are compared by digests of their prefixes, never by texts. Nodes of the compacted trie are stored under a handle, the
prefix whose length is the number in the node's stretch of depths that most twos divide. A sequence finds where it leaves the
trie by a binary search over such lengths: each step is one join with the handles. Sequences go in by batches: of those
that leave at the same place with the same next turn one is inserted, the others search on from there, so a batch holds a path
into every open branch and the number of batches grows with the logarithm of the input. At the end the edges are expanded to
a row for each depth.

Digests lie in chunks of :data:`CHUNK` depths, edges end where chunks do, and every chunk searches for itself, so a very long
conversation is many rows, never one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import sealed, small_batches

CHUNK = 256

EMPTY_SHA256 = sha256(b"").hexdigest()

_ROOT = "named_struct('depth', 0L, 'x', 0L, 'y', 0L)"


# --- conversations as sequences -------------------------------------------------------------------


def positions(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, pos, t, size)``: every turn's place in its conversation, digest of role and text, bytes of its text;
    and ``(conv_id, n)``, the turns of each conversation.

    Turns are in order of ``turn``, NULL first, equal ones of their digests. Turns of a conversation may lie in many
    tasks: each counts its own, and what stands before them is added.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.md5(content).alias("t"), F.octet_length(text).cast("bigint").alias("size")
    )
    first = F.col("turn").asc_nulls_first()
    # Equal rows are told apart by where they were read, else they would all go to one task.
    dealt = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("conv_id", first, "t", "row")
    parts = sealed(dealt.drop("row").withColumn("part", F.spark_partition_id()), "trie-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = sealed(parts.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "trie-parts")
    offsets = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(first, "t"))
    placed = parts.withColumn("own", own).join(offsets, ["conv_id", "part"])
    turns = sealed(placed.select("conv_id", (F.col("offset") + F.col("own")).alias("pos"), "t", "size"), "trie-positions")
    return turns, counts.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(c, depth, t, size)`` of every turn of the rebuilt conversations, and ``(c, length)`` of these.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % 5`` and its own after its first ``h``;
    ``h`` is the CRC-32 of ``c`` in digits, modulo 9.
    """
    turns, lengths = positions(conversations)
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    base = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = lengths.select("conv_id", "n", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base")).join(base, "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = sealed(convs.select("conv_id", "h", taken.alias("taken"), (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + taken).alias("length")), "trie-convs")
    own = turns.join(convs, "conv_id").where("pos > h").select(F.col("conv_id").alias("c"), (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "t", "size")
    lent = (
        turns.where("conv_id % 5 = 0 AND pos <= 8")
        .select("pos", "t", "size", F.col("conv_id").alias("base"), F.explode(F.sequence(F.lit(-4), F.lit(4))).alias("k"))
        .select("pos", "t", "size", "base", F.try_add("base", F.col("k").cast("bigint")).alias("conv_id"))
        .where("conv_id - conv_id % 5 = base")
        .join(convs, "conv_id").where("pos <= h")
        .select(F.col("conv_id").alias("c"), F.col("pos").alias("depth"), "t", "size")
    )
    return own.unionByName(lent), convs.select(F.col("conv_id").alias("c"), "length")


def chunks(turns: DataFrame) -> DataFrame:
    """``(c, k, before, ps)``: of each :data:`CHUNK` depths the prefixes ``(x, y, bytes)``, and the one before them.

    A prefix's digest is what its turns' digests, each made with its depth, give by exclusive or, so chunks are made
    apart and joined by what their totals give.
    """
    lanes = [F.xxhash64(F.lit(lane), F.col("depth"), F.col("t")).alias(name) for lane, name in ((1, "x"), (2, "y"))]
    rows = turns.select("c", "depth", F.expr(f"(depth - 1) DIV {CHUNK}").alias("k"), *lanes, "size")
    upto = Window.partitionBy("c", "k").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = [F.bit_xor("x").over(upto).alias("x"), F.bit_xor("y").over(upto).alias("y"), F.sum("size").over(upto).alias("bytes")]
    own = rows.select("c", "k", "depth", *running).groupBy("c", "k").agg(F.array_sort(F.collect_list(F.struct("depth", "x", "y", "bytes"))).alias("own"))
    own = sealed(own, "trie-chunks-own")
    last = own.select("c", "k", F.element_at("own", -1).alias("p")).select("c", "k", "p.x", "p.y", "p.bytes")
    earlier = Window.partitionBy("c").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    totals = [F.coalesce(f(n).over(earlier), F.lit(0).cast("bigint")).alias(n) for f, n in ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "bytes"))]
    whole = own.join(last.select("c", "k", F.struct(*totals).alias("before")), ["c", "k"])

    def added(p: Column) -> Column:
        x, y = (p[n].bitwiseXOR(F.col("before")[n]) for n in "xy")
        return F.struct(x.alias("x"), y.alias("y"), (p["bytes"] + F.col("before.bytes")).alias("bytes"))

    return whole.select("c", "k", "before", F.transform("own", added).alias("ps"))


# --- the trie ---------------------------------------------------------------------------------------


def two_fattest(low: str, high: str) -> str:
    """SQL of the number in ``(low, high]`` that most twos divide."""
    return f"shiftleft(shiftright({high}, length(bin({low} ^ {high})) - 1), length(bin({low} ^ {high})) - 1)"


def _at(depth: str, ps: str = "ps") -> str:
    """SQL of the prefix at a depth of the row's chunk, NULL outside."""
    return f"get({ps}, CAST({depth} - k * {CHUNK} - 1 AS INT))"


def _edges(stretches: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges ``(rep, k, s, e)`` with the digests under which they are found: of both ends, the handle and the first turn.

    An edge covers the depths from ``s + 1`` to ``e`` of the path of ``rep``.
    """
    fat = two_fattest("s", "e")
    found = stretches.join(parts.withColumnRenamed("c", "rep"), ["rep", "k"]).withColumn("f", F.expr(fat))
    return found.selectExpr(
        "rep", "k", "s", "e",
        f"named_struct('depth', f, 'x', {_at('f')}.x, 'y', {_at('f')}.y) AS handle",
        f"named_struct('depth', s + 1, 'x', {_at('s + 1')}.x, 'y', {_at('s + 1')}.y) AS first",
        f"named_struct('depth', e, 'x', {_at('e')}.x, 'y', {_at('e')}.y) AS id",
        f"if(s = k * {CHUNK}, named_struct('depth', s, 'x', before.x, 'y', before.y), named_struct('depth', s, 'x', {_at('s')}.x, 'y', {_at('s')}.y)) AS parent",
        f"if(s = k * {CHUNK}, before.bytes, {_at('s')}.bytes) AS bytes_s", f"{_at('e')}.bytes AS bytes_e",
    )


def _search(open_chunks: DataFrame, edges: DataFrame, longest: int) -> DataFrame:
    """Fat binary search: the rows with ``a``, the depth of the last node on their path, and the edge ``hit`` they go on into, if any.

    Rows that need no further step get a key of their own that nothing has, so they are spread.
    """
    edge = F.struct("rep", "s", "e", "id").alias("found")
    handles = edges.select(F.col("handle").alias("key"), edge)
    state = open_chunks.selectExpr("*", f"greatest(lo, k * {CHUNK}) AS a", f"k * {CHUNK} + size(ps) AS high").withColumn("b", F.col("high"))
    state = state.withColumn("hit", F.lit(None).cast(edges.select(edge).schema[0].dataType))
    none = "named_struct('depth', -1L, 'x', c, 'y', k)"
    for _ in range(longest.bit_length()):
        state = state.withColumn("f", F.expr(f"if(a < b, {two_fattest('a', 'b')}, NULL)"))
        state = state.withColumn("key", F.expr(f"if(a < b, named_struct('depth', f, 'x', {_at('f')}.x, 'y', {_at('f')}.y), {none})"))
        state = state.join(handles, "key", "left")
        whole = f"found.e <= high AND {_at('found.e')}.x = found.id.x AND {_at('found.e')}.y = found.id.y"
        state = state.selectExpr(
            *open_chunks.columns, "high",
            f"CASE WHEN a < b AND found IS NOT NULL AND ({whole}) THEN found.e ELSE a END AS a",
            # The search is over when an edge is left inside; a node that is passed keeps the upper end.
            f"CASE WHEN a >= b THEN b WHEN found IS NULL THEN f - 1 WHEN {whole} THEN b ELSE a END AS b",
            f"CASE WHEN a < b AND found IS NOT NULL AND NOT ({whole}) THEN found ELSE hit END AS hit",
        )
    firsts = edges.select(F.col("first").alias("key"), edge)
    look = "hit IS NULL AND a < high"
    state = state.withColumn("key", F.expr(f"if({look}, named_struct('depth', a + 1, 'x', {_at('a + 1')}.x, 'y', {_at('a + 1')}.y), {none})"))
    return state.join(firsts, "key", "left").select(*open_chunks.columns, "high", "a", F.coalesce("hit", "found").alias("hit"))


def _exits(searched: DataFrame, parts: DataFrame) -> DataFrame:
    """``(c, length, m, cut, next)``: the depth to which a sequence lies in the trie, the edge to cut there, the prefix it goes on with."""
    # Rows that are on no edge get a key that no chunk has, each its own.
    found = searched.withColumn("key", F.expr("if(hit IS NULL, named_struct('on', false, 'rep', c, 'k', k), named_struct('on', true, 'rep', hit.rep, 'k', k))"))
    other = parts.select(F.expr("named_struct('on', true, 'rep', c, 'k', k)").alias("key"), F.col("ps").alias("qs"))
    same = f"{_at('d')}.x = {_at('d', 'qs')}.x AND {_at('d')}.y = {_at('d', 'qs')}.y"
    shared = f"if(hit IS NULL, a, a + size(filter(sequence(a + 1, least(hit.e, high)), d -> {same}))) AS m"
    placed = found.join(other, "key", "left").selectExpr("c", "length", "k", "ps", "high", "hit", shared)
    placed = placed.selectExpr(
        "c", "length", "k", "m", "high",
        "if(m > hit.s AND m < hit.e, named_struct('rep', hit.rep, 'k', k, 's', hit.s, 'e', hit.e), NULL) AS cut",
        f"if(m < high, named_struct('x', {_at('m + 1')}.x, 'y', {_at('m + 1')}.y), NULL) AS next",
    )
    # The first chunk that is not in the trie as a whole, else the last one.
    order = F.expr("if(m < high, k, 4611686018427387904L - k)")
    chosen = placed.groupBy("c", "length").agg(F.min_by(F.struct("m", "cut", "next"), order).alias("exit"))
    return sealed(chosen.select("c", "length", "exit.*"), "trie-exits")


def build(parts: DataFrame, ends: DataFrame) -> DataFrame:
    """The edges of the compacted trie of all sequences; ``ends`` has their ``(c, id, bytes)``."""
    different = ends.where("id.depth > 0").groupBy("id").agg(F.min("c").alias("c"))
    sequences = sealed(different.select("c", F.col("id.depth").alias("length")), "trie-sequences")
    longest = min(sequences.agg(F.max("length")).first()[0] or 0, CHUNK)
    todo = sequences.withColumn("lo", F.lit(0).cast("bigint"))
    edges = None
    while not todo.isEmpty():
        live = parts.join(todo, "c").where(f"k >= lo DIV {CHUNK}")
        if edges is None:  # nothing to search in
            exits = live.where("k = 0").selectExpr("c", "length", "0L AS m", f"named_struct('x', {_at('1')}.x, 'y', {_at('1')}.y) AS next")
        else:
            exits = _exits(_search(live, edges, longest), parts)
        leaving = exits.where("next IS NOT NULL")
        chosen = leaving.groupBy("m", "next").agg(F.min_by(F.struct("c", "length"), F.xxhash64("c")).alias("l")).select("m", "l.*")
        chosen = sealed(chosen, "trie-leaders")
        k = F.explode(F.expr(f"sequence(m DIV {CHUNK}, (length - 1) DIV {CHUNK})")).alias("k")
        added = chosen.select(F.col("c").alias("rep"), "m", "length", k)
        added = added.selectExpr("rep", "k", f"greatest(m, k * {CHUNK}) AS s", f"least(length, (k + 1) * {CHUNK}) AS e")
        if edges is None:
            edges = sealed(_edges(added, parts), "trie-edges")
        else:
            cuts = exits.where("cut IS NOT NULL").select("cut.*", "m").groupBy("rep", "k", "s", "e").agg(F.collect_set("m").alias("ms"))
            bounds = cuts.selectExpr("rep", "k", "array_sort(concat(array(s, e), ms)) AS b")
            split = bounds.selectExpr("rep", "k", "inline(transform(slice(b, 1, size(b) - 1), (s, i) -> named_struct('s', s, 'e', b[i + 1])))")
            kept = edges.join(cuts.select("rep", "s"), ["rep", "s"], "left_anti").select(*edges.columns)
            edges = sealed(kept.unionByName(_edges(added.unionByName(split), parts)), "trie-edges")
        waiting = leaving.select("c", "length", F.col("m").alias("lo")).join(chosen.select("c"), "c", "left_anti")
        todo = sealed(waiting, "trie-todo")
    return edges if edges is not None else _edges(sequences.selectExpr("c AS rep", "0L AS k", "0L AS s", "length AS e"), parts)


# --- what the nodes hold ----------------------------------------------------------------------------


def _subtree_sums(nodes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """``nodes (id, least, ...)`` with the least of ``least`` and the sums of the others over each subtree.

    Each round adds what lies twice as deep: rounds grow with the logarithm of the depth of the tree.
    """
    names = [n for n in nodes.columns if n not in ("id", "least")]
    sums = sealed(nodes, "trie-sums")
    while not ancestors.isEmpty():
        more = [F.min("least").alias("more_least"), *[F.sum(n).alias(f"more_{n}") for n in names]]
        below = ancestors.join(sums, "id").groupBy(F.col("up").alias("id")).agg(*more)
        added = [(F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names]
        sums = sealed(sums.join(below, "id", "left").select("id", F.least("least", "more_least").alias("least"), *added), "trie-sums")
        further = ancestors.select(F.col("id").alias("up"), F.col("up").alias("top"))
        ancestors = sealed(ancestors.join(further, "up").select("id", F.col("top").alias("up")), "trie-ancestors")
    return sums


def _end_digests(ends: DataFrame) -> DataFrame:
    """``(id, ends)``: digest of the ids that end at a node, numbers in order.

    The digest of a node takes its ids one after the other, so they pass through one task in order, and none is kept there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, digest = None, None
        done: list[tuple] = []
        for batch in batches:
            for *key, c in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if key != open_key:
                    if digest:
                        done.append((*open_key, digest.hexdigest()))
                    open_key, digest = key, sha256(str(c).encode())
                else:
                    digest.update(f",{c}".encode())
            yield rows(done)
            done = []
        if digest:
            yield rows([(*open_key, digest.hexdigest())])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = zip(*found, strict=True) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], ["depth", "x", "y", "ends"])

    small_batches(ends.sparkSession, 1 << 14)
    flat = ends.select("id.depth", "id.x", "id.y", "c").repartition("depth", "x", "y").sortWithinPartitions("depth", "x", "y", "c")
    found = flat.mapInArrow(run, "depth BIGINT, x BIGINT, y BIGINT, ends STRING")
    return found.select(F.struct("depth", "x", "y").alias("id"), "ends")


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """A row for every node of the trie of rebuilt conversations, the root included.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``, see :func:`rebuilt`.
    NULL roles and texts are empty, a NULL turn stands first, equal turns are in order of their digests, a repeated
    row is a turn of its own. Rows with a NULL conversation take no part. An empty table has no conversation and so no node.
    Other columns are not read. Two different prefixes are taken for the same if 128 bits of digest agree.
    """
    turns, convs = rebuilt(conversations.select("conv_id", "turn", "role", "text"))
    parts = sealed(chunks(turns), "trie-chunks")
    last = parts.selectExpr("c", f"named_struct('depth', k * {CHUNK} + size(ps), 'x', element_at(ps, -1).x, 'y', element_at(ps, -1).y) AS id", "element_at(ps, -1).bytes AS bytes")
    ends = convs.join(last.withColumn("length", F.col("id.depth")), ["c", "length"], "left")
    ends = sealed(ends.selectExpr("c", f"coalesce(id, {_ROOT}) AS id", "coalesce(bytes, 0L) AS bytes"), "trie-ends")
    edges = build(parts, ends)

    root = convs.limit(1).selectExpr(f"{_ROOT} AS id", "0L AS edge_bytes")
    here = ends.groupBy("id").agg(F.count("*").alias("n"), F.min("c").alias("least"), F.sum("bytes").alias("end_bytes"))
    children = sealed(edges.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children")), "trie-children")
    zero = F.lit(0).cast("bigint")
    nodes = (
        edges.selectExpr("id", "bytes_e - bytes_s AS edge_bytes").unionByName(root)
        .join(here, "id", "left").join(children, "id", "left")
        .select(
            "id", "least", F.coalesce("n", zero).alias("n"), F.coalesce("end_bytes", zero).alias("end_bytes"), "edge_bytes",
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        )
    )
    sums = _subtree_sums(nodes, edges.select("id", F.col("parent").alias("up")))
    about = sealed(
        sums.join(children, "id", "left").join(_end_digests(ends), "id", "left")
        .withColumn("n_children", F.coalesce("n_children", zero)).withColumn("ends", F.coalesce("ends", F.lit(EMPTY_SHA256))),
        "trie-nodes",
    )
    above = sums.select(F.col("id").alias("parent"), F.col("least").alias("parent_least"))
    wide = edges.select("rep", "k", "s", "e", "id", "parent", "bytes_s").join(about, "id").join(above, "parent")
    each = wide.join(parts.withColumnRenamed("c", "rep"), ["rep", "k"]).withColumn("d", F.explode(F.expr("sequence(s + 1, e)")))
    # Bytes of the path before the node's own turn: what its subtree's conversations and edges have before it does not count.
    each = each.withColumn("start", F.expr(f"if(d - 1 = k * {CHUNK}, before.bytes, {_at('d - 1')}.bytes)"))
    below = each.selectExpr(
        "least AS conv_id", "d AS depth", "if(d = s + 1, parent_least, least) AS parent_conv_id", "n AS n_convs",
        "if(d = e, n_children, 1L) AS n_children", "leaves AS n_leaves",
        "end_bytes - n * start - (edge_bytes - (start - bytes_s)) AS saved_tokens", f"if(d = e, ends, '{EMPTY_SHA256}') AS ends_sha256",
    )
    top = about.where("id.depth = 0").selectExpr(
        "least AS conv_id", "0L AS depth", "CAST(NULL AS BIGINT) AS parent_conv_id", "n AS n_convs", "n_children", "leaves AS n_leaves",
        "end_bytes - edge_bytes AS saved_tokens", "ends AS ends_sha256",
    )
    return below.unionByName(top)


def prefix_nodes_sql() -> str:
    """The same rows in DuckDB's SQL, from every prefix of every conversation."""
    # Fixed value: the polynomial of CRC-32, reflected.
    step = "CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    bits = "list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: " + step + ")"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))), lambda a, b: {bits}), 4294967295)"
    return f"""
    WITH t AS (SELECT conv_id AS c, turn, md5(concat(length(r), ':', r, x)) AS t, octet_length(encode(x)) AS size FROM
        (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
    o AS (SELECT c, list(struct_pack(t := t, size := size) ORDER BY turn NULLS FIRST, t) AS own FROM t GROUP BY c),
    h AS (SELECT c, own, {crc} % 9 AS h FROM o),
    r AS (SELECT h.c, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS s FROM h LEFT JOIN o b ON b.c = h.c - h.c % 5),
    p AS MATERIALIZED (SELECT c, d, md5(CAST(list_transform(s[1:d], lambda z: z.t) AS VARCHAR)) AS p,
        CASE WHEN d > 0 THEN md5(CAST(list_transform(s[1:d - 1], lambda z: z.t) AS VARCHAR)) END AS up,
        CASE WHEN d > 0 THEN s[d].size ELSE 0 END AS size, d = len(s) AS ended
        FROM (SELECT c, s, unnest(generate_series(0, len(s))) AS d FROM r)),
    n AS MATERIALIZED (SELECT p, d, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(size) AS size,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ended), '')) AS ends FROM p GROUP BY p, d),
    k AS (SELECT up, d - 1 AS d, count(*) AS k FROM n WHERE d > 0 GROUP BY up, d),
    w AS MATERIALIZED (SELECT n.*, coalesce(k.k, 0) AS k, (n.n - 1) * n.size AS saved FROM n LEFT JOIN k ON k.up = n.p AND k.d = n.d),
    a AS (SELECT q.p, q.d, sum(w.saved) AS saved, count(*) FILTER (WHERE w.k = 0) AS leaves
        FROM w JOIN p q ON q.c = w.c AND q.d <= w.d GROUP BY q.p, q.d)
    SELECT w.c AS conv_id, CAST(w.d AS BIGINT) AS depth, f.c AS parent_conv_id, CAST(w.n AS BIGINT) AS n_convs, CAST(w.k AS BIGINT) AS n_children,
           CAST(a.leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
    FROM w JOIN a ON a.p = w.p AND a.d = w.d LEFT JOIN n f ON f.p = w.up AND f.d = w.d - 1
    """
