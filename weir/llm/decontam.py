"""Benchmark passages in training texts, found by spaced seeds. DataFrame functions only.

A mask fixes some token positions of a short window and ignores the others, so a seed survives
substitutions in the ignored places. Seeds of all masks are taken at every position of benchmark items
and documents; an equal seed aligns an item with a document. Along the alignment the longest overlap with few
substitutions is taken, and overlaps that a few inserted or left out tokens have set against each other are put together.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import sealed

# Token positions a seed looks at. Eight tokens or more of which a fifth at most are substituted hold one of them untouched.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 5, 6), (0, 1, 5, 7, 8))

# Share of an overlap's tokens that must be equal, in percent.
OVERLAP = 80

# Tokens of an item, or all it has, of which this share makes a leak.
LEAST = 13

# Overlaps of an item that are put together have this many tokens, and stand this many places off from one to the next at most.
PIECE = 8
SLIP = 3

# Benchmark seeds sent to every executor at once, some 40 bytes each; a larger benchmark goes in blocks.
BLOCK_SEEDS = 1_000_000

_OTHER = r"[^\p{L}\p{N}]+"


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits; NULL and empty texts have none."""
    plain = F.trim(F.regexp_replace(F.lower(text), _OTHER, " "))
    return F.when(F.length(plain) > 0, F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def _seeds(hashes: str, m: int, mask: tuple[int, ...]) -> Column:
    """A seed for every position where the mask fits."""
    at = lambda i, k: F.get(F.col(hashes), i + F.lit(k))
    places = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - F.lit(mask[-1]), F.lit(0)))
    seed = lambda x, i: F.xxhash64(F.lit(m), x, *[at(i, k) for k in mask[1:]])
    return F.transform(places, seed)


def _with_seeds(rows: DataFrame, masks: tuple[tuple[int, ...], ...], *kept: str) -> DataFrame:
    """A row for every seed: ``(kept..., place, seed)``.

    The outer forms of explode: for the others Spark adds a filter on the arrays' size and moves it
    below the projections, where tokens are made again for each position.
    """
    hashed = rows.withColumn("hashes", F.transform("toks", lambda x: F.xxhash64(x)))
    per_mask = [_seeds("hashes", m, mask) for m, mask in enumerate(masks)]
    return (
        hashed.select(*kept, F.array(*per_mask).alias("masks"))
        .select(*kept, F.explode_outer("masks").alias("seeds"))
        .select(*kept, F.posexplode_outer("seeds").alias("place", "seed"))
        .where("seed IS NOT NULL")
    )


def _overlaps(aligned: DataFrame, overlap: int) -> DataFrame:
    """``(row, doc_id, item_id, shift, n_item, i, j, m, words)``: the longest overlap of each alignment.

    It begins at the item's token ``i`` and ends at ``j``, both equal to the document's, and ``m`` of its tokens are equal,
    ``overlap`` percent or more; ``words`` are their places as bits. Of equally long ones it is the first.

    A running sum goes up by ``100 - overlap`` for an equal token and down by ``overlap`` for another, so a stretch has enough
    equal tokens if the sum is no lower behind it than before it; for each end the first such start is taken.
    """
    up, down = 100 - overlap, overlap
    sums = f"""aggregate(same, named_struct('p', 0L, 'starts', CAST(array() AS ARRAY<BIGINT>), 'ends', CAST(array() AS ARRAY<BIGINT>)),
        (s, e) -> named_struct('p', s.p + if(e, {up}, -{down}), 'starts', array_append(s.starts, if(e, s.p, 9223372036854775807L)),
                               'ends', array_append(s.ends, s.p + if(e, {up}, -{down}))))"""
    longest = """array_max(transform(sums.ends, (p, j) -> if(get(same, j),
        named_struct('n', j - array_position(transform(sums.starts, s -> s <= p), true) + 2, 'first', -array_position(transform(sums.starts, s -> s <= p), true)), NULL)))"""
    words = """transform(sequence(0, CAST((size(same) - 1) DIV 63 AS INT)), k -> aggregate(sequence(0, 62), 0L,
        (b, t) -> b | if(63 * k + t BETWEEN i AND j AND get(same, CAST(63 * k + t AS INT)), shiftleft(1L, t), 0L)))"""
    return (
        aligned.selectExpr("row", "doc_id", "item_id", "shift", "transform(item_toks, (x, j) -> coalesce(get(toks, shift + j) = x, false)) AS same")
        .selectExpr("*", f"{sums} AS sums")
        .selectExpr("row", "doc_id", "item_id", "shift", "same", f"{longest} AS best")
        .where("best IS NOT NULL")
        .selectExpr("row", "doc_id", "item_id", "shift", "same", "CAST(-best.first - 1 AS BIGINT) AS i", "CAST(best.n - best.first - 2 AS BIGINT) AS j")
        .selectExpr("row", "doc_id", "item_id", "shift", "CAST(size(same) AS BIGINT) AS n_item", "i", "j", f"{words} AS words")
        .selectExpr("*", "aggregate(words, 0L, (n, b) -> n + bit_count(b)) AS m")
    )


def _needed(least: int, overlap: int) -> str:
    """SQL of the equal tokens that make a leak of an item; a short one must stand there as it is."""
    return f"if(n_item < {PIECE}, n_item, CAST(ceil(least(n_item, {least}) * {overlap} / 100) AS BIGINT))"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[tuple[int, ...], ...] = MASKS,
    overlap: int = OVERLAP,
    least: int = LEAST,
    block_seeds: int = BLOCK_SEEDS,
) -> DataFrame:
    """``(doc_id, item_id, place, n_matched, n_item)``: items that documents hold, whole or in part.

    An overlap is a stretch of an item that stands in a document with ``overlap`` percent of its tokens equal. Of an item of
    ``n_item`` tokens an overlap with ``overlap`` percent of ``least`` tokens, or of all it has if they are fewer,
    is a leak. Overlaps of :data:`PIECE` tokens and more whose places differ by :data:`SLIP` from one to the next are
    also taken as one, where what lies between the first and the last token has enough equal ones. An item of 5 to 7
    tokens must stand there as it is, a shorter one must be all the document says; an item without tokens is in none.
    Every such overlap holds a seed, so none is missed.

    ``n_matched`` counts the equal tokens; ``place`` is the token where the item would begin (negative when its head is cut
    off) in the overlap with the most of them, the first among equals. NULL texts have no tokens;
    repeated rows and ids give one row for each id and item; a NULL id is an id of its own; other columns
    are not read. Documents are shuffled only where the hits are too many to broadcast.
    """
    # Written: the benchmark is small, and its seeds are counted before they are used.
    items = sealed(benchmark.select("item_id", tokens("text").alias("toks")).where("size(toks) > 0").distinct(), "benchmark-items")
    shortest = min(len(mask) for mask in masks)
    seeds = sealed(
        _with_seeds(items, masks, "item_id").select("seed", "item_id", F.col("place").alias("item_place")),
        "benchmark-seeds",
    )
    blocks = max(1, ceil(seeds.count() / block_seeds))
    # Only ids go with the seeds: a long text would be copied for each of its seeds.
    rows = _with_seeds(docs.select("doc_id", tokens("text").alias("toks")), masks, "doc_id")
    found = None
    for block in range(blocks):
        part = seeds.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        part = rows.join(F.broadcast(part), "seed")
        found = part if found is None else found.unionByName(part)
    shift = (F.col("place") - F.col("item_place")).alias("shift")
    # Written, so its size decides whether the texts of the check are shuffled.
    hits = sealed(found.select("doc_id", "item_id", shift).distinct(), "benchmark-hits")
    # The texts with hits, cut into tokens once however many hits they have.
    ids = hits.select(F.col("doc_id").alias("hit_id")).distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
    texts = sealed(texts.select("doc_id", F.monotonically_increasing_id().alias("row"), tokens("text").alias("toks")), "benchmark-texts")
    item_toks = items.select("item_id", F.col("toks").alias("item_toks"))
    hits = hits.join(F.broadcast(item_toks), "item_id") if blocks == 1 else hits.join(item_toks, "item_id")
    hits = hits.withColumnRenamed("doc_id", "hit_id")
    aligned = texts.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")))
    overlaps = sealed(_overlaps(aligned, overlap).where(f"j - i + 1 >= {PIECE} OR m >= {_needed(least, overlap)}"), "benchmark-overlaps")

    by_place = Window.partitionBy("row", "item_id").orderBy("shift")
    apart = F.coalesce((F.col("shift") - F.lag("shift").over(by_place) > SLIP).cast("int"), F.lit(0))
    grouped = overlaps.withColumn("apart", apart).withColumn("part", F.sum("apart").over(by_place))
    alone = F.max(F.when(F.expr(f"m >= {_needed(least, overlap)}"), F.col("m"))).alias("alone")
    best = F.max(F.struct("m", -F.col("shift"))).alias("best")
    extent = [F.min("i").alias("i"), F.max("j").alias("j")]
    keys = ("row", "doc_id", "item_id", "n_item", "part")
    # Tokens that several overlaps hold count once: their bits are put together word by word.
    bits = grouped.select("*", F.posexplode("words").alias("word", "b")).groupBy(*keys, "word").agg(alone, best, *extent, F.bit_or("b").alias("b"))
    whole = [F.max("alone").alias("alone"), F.max("best").alias("best"), *extent, F.sum(F.bit_count("b")).alias("together")]
    enough = F.expr(f"together >= {_needed(least, overlap)} AND together * 100 >= (j - i + 1) * {overlap}")
    counted = bits.groupBy(*keys).agg(*whole).select(
        "doc_id", "item_id", "n_item", (-F.col("best.col2")).cast("bigint").alias("place"),
        F.greatest("alone", F.when(enough, F.col("together"))).alias("n_matched"),
    ).where("n_matched IS NOT NULL")
    # Items too short for a seed.
    short = items.where(F.size("toks") < shortest)
    if not short.isEmpty():
        said = docs.select("doc_id", tokens("text").alias("toks")).where(F.size("toks") < shortest).join(short, "toks")
        n = F.size("toks").cast("bigint")
        counted = counted.unionByName(said.select("doc_id", "item_id", n.alias("n_item"), F.lit(0).cast("bigint").alias("place"), n.alias("n_matched")))
    chosen = F.max(F.struct("n_matched", -F.col("place"), "n_item"))
    return counted.groupBy("doc_id", "item_id").agg(chosen.alias("b")).select(
        "doc_id", "item_id", (-F.col("b.col2")).alias("place"), "b.n_matched", "b.n_item"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item of the benchmark, whole or in part. NULL ids stay."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti")


def leaks_sql(overlap: int = OVERLAP, least: int = LEAST) -> str:
    """The same rows in DuckDB's SQL without seeds: every alignment of an item with a document in which tokens are equal."""
    toks = r"""list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"""
    needed = f"CASE WHEN n_item < {PIECE} THEN n_item ELSE CAST(ceil(least(n_item, {least}) * {overlap} / 100.0) AS BIGINT) END"
    up, down = 100 - overlap, overlap
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {toks} AS toks FROM documents WHERE text IS NOT NULL),
    b AS MATERIALIZED (SELECT DISTINCT item_id, {toks} AS toks FROM benchmark WHERE text IS NOT NULL),
    dt AS (SELECT r, unnest(toks) AS x, unnest(range(0, len(toks))) AS at FROM d),
    bt AS (SELECT item_id, len(toks) AS n_item, unnest(toks) AS x, unnest(range(0, len(toks))) AS at FROM b),
    e AS MATERIALIZED (SELECT r, item_id, n_item, dt.at - bt.at AS shift, bt.at AS j FROM dt JOIN bt ON dt.x = bt.x),
    -- Enough equal tokens somewhere: four of five in a row.
    f AS MATERIALIZED (SELECT DISTINCT r, item_id, shift FROM
        (SELECT *, lead(j, 3) OVER (PARTITION BY r, item_id, shift ORDER BY j) AS fourth FROM e) WHERE fourth - j <= 4),
    g AS MATERIALIZED (SELECT e.*, {up + down} * row_number() OVER w - {down} * (j + 1) AS p FROM e JOIN f USING (r, item_id, shift)
        WINDOW w AS (PARTITION BY e.r, e.item_id, e.shift ORDER BY j)),
    s AS (SELECT r, item_id, shift, any_value(x.n_item) AS n_item, max(struct_pack(n := y.j - x.j + 1, i := -x.j, j := y.j)) AS best
        FROM g x JOIN g y USING (r, item_id, shift) WHERE y.j >= x.j AND y.p >= x.p - {up} GROUP BY r, item_id, shift),
    o AS MATERIALIZED (SELECT s.r, s.item_id, s.shift, s.n_item, -best.i AS i, best.j AS j, count(*) AS m, list(g.j) AS places
        FROM s JOIN g ON g.r = s.r AND g.item_id = s.item_id AND g.shift = s.shift AND g.j BETWEEN -best.i AND best.j GROUP BY ALL),
    k AS (SELECT * FROM o WHERE j - i + 1 >= {PIECE} OR m >= {needed}),
    c AS (SELECT *, sum(apart) OVER (PARTITION BY r, item_id ORDER BY shift) AS part FROM
        (SELECT *, CASE WHEN shift - lag(shift) OVER (PARTITION BY r, item_id ORDER BY shift) > {SLIP} THEN 1 ELSE 0 END AS apart FROM k)),
    t AS (SELECT r, item_id, n_item, part, max(CASE WHEN m >= {needed} THEN m END) AS alone, len(list_distinct(flatten(list(places)))) AS together,
        min(i) AS i, max(j) AS j, max(struct_pack(m := m, s := -shift)) AS best FROM c GROUP BY r, item_id, n_item, part),
    u AS (SELECT d.doc_id, t.item_id, n_item, -best.s AS place,
        greatest(alone, CASE WHEN together >= {needed} AND together * 100 >= (j - i + 1) * {overlap} THEN together END) AS n_matched FROM t JOIN d USING (r)
        UNION ALL SELECT doc_id, item_id, len(b.toks), 0, len(b.toks) FROM d JOIN b ON d.toks = b.toks WHERE len(b.toks) BETWEEN 1 AND 4),
    v AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, place) AS rn FROM u WHERE n_matched IS NOT NULL)
    SELECT doc_id, item_id, CAST(place AS BIGINT) AS place, CAST(n_matched AS BIGINT) AS n_matched, CAST(n_item AS BIGINT) AS n_item FROM v WHERE rn = 1
    """
