"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are the unit.  A source's documents are dealt by a hash to shards of
about ``SHARD`` documents, and a shard's words, in hash order, make blocks of
``BLOCK`` words.  The mix is a number of blocks; they are allocated to sources
by highest quotients (target / (2 k + 1)), and a source's blocks to its shards
likewise by their sizes, so every shard has an integer quota.  A shard of n
blocks with quota q takes all its blocks q div n times and q mod n of them
once more: those a seeded start and an even stride pick, so that how many of
the first j blocks are picked is one integer division and a document's words
follow from where it lies, without a row per block.

All of it is DataFrame functions; hashes are MD5, so SQL can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Words of a block, documents of a shard, and weights by source in order.
BLOCK, SHARD, WEIGHTS, SHARE, REPEAT = 64, 4096, (3, 1, 2), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def number(*parts: Column | str) -> Column:
    """A 32-bit number from the MD5 of the parts as text."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """(source, source_size, ..., target): ``share`` of all words by weight;
    a source stops at ``repeat`` times its size and the excess goes to the
    others by weight, until none is above.  That is one level x with
    target = min(repeat * size, x * weight), found in order of cap / weight.
    One row per source, so windows over all of them are small."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("rank", F.row_number().over(order)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                               (F.col("rank") - 1) % len(weights) + 1))
    cap = F.col("source_size") * F.lit(float(repeat))
    w = w.withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    fill = Window.orderBy("full_at", "rank")
    whole = Window.partitionBy()
    w = (w.withColumn("all_words", F.sum("source_size").over(whole))
         .withColumn("below", F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)))
         .withColumn("at_or_above", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))))
    level = (F.col("all_words") * F.lit(share) - F.coalesce("below", F.lit(0.0))) / F.col("at_or_above")
    first = F.min(F.when(level <= F.col("full_at"), F.struct("full_at", "rank", level.alias("level")))).over(whole)
    w = w.withColumn("level", first["level"])
    return w.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), "cap")))


def apportion(parties: DataFrame, votes: str, seats: Column, by: tuple[str, ...], order: tuple[str, ...],
              out: str) -> DataFrame:
    """Sainte-Lague: ``seats`` of each group ``by`` to its parties, by highest
    quotients votes / (2 k + 1).  Each party starts at its rounded share; only
    quotients near there can still change hands (the rounding is off by at most
    half a seat a party), so candidates are a few rows per party."""
    group = Window.partitionBy(*by)
    p = (parties.withColumn("_seats", seats)
         .withColumn("_votes", F.sum(votes).over(group)).withColumn("_n", F.count("*").over(group))
         .withColumn("_share", F.when(F.col("_votes") > 0, F.col(votes) / F.col("_votes")).otherwise(F.lit(0.0)))
         .withColumn("_first", F.floor(F.col("_share") * F.col("_seats") + 0.5).cast("bigint"))
         .withColumn("_near", F.ceil(F.col("_share") * 1.5 * F.col("_n")).cast("bigint") + 1)
         .withColumn("_sure", F.greatest(F.lit(0).cast("bigint"), F.col("_first") - F.col("_near"))))
    p = p.withColumn("_open", F.col("_seats") - F.sum("_sure").over(group))
    rank = Window.partitionBy(*by).orderBy(F.col("_quotient").desc(), *order)
    won = (p.withColumn("_k", F.explode(F.sequence(F.col("_sure"), F.col("_first") + F.col("_near") - 1)))
           .withColumn("_quotient", F.col(votes) / (2 * F.col("_k") + 1))
           .withColumn("_won", (F.row_number().over(rank) <= F.col("_open")) & (F.col("_quotient") > 0)))
    keep = [c for c in parties.columns]
    return won.groupBy(*keep, "_sure").agg(F.sum(F.col("_won").cast("bigint")).alias("_more")) \
        .withColumn(out, F.col("_sure") + F.col("_more")).select(*keep, out)


def mix(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id",
        seed: int = 1, copies: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and, with
    ``copies``, how often a mix of whole documents takes it: taken / size
    rounded down or up, by turns (steps of the golden ratio) in a shard's order
    of size, so that sources come near their targets too.  ``taken`` is the words the mix takes of it, repeats
    counted, 0 to ``REPEAT`` times its size; documents without words take 0,
    a null source is a source of its own, null ids and repeated rows are rows
    like others (which of several equal rows gives the words is of no
    account).  Text does not move: only ids, sources and sizes are shuffled."""
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"),
                                words(F.col(text)).alias("size")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    plan = targets(sizes).select("source", "rank", "source_size", "rows", "target",
                                 F.round(F.sum("target").over(Window.partitionBy()) / BLOCK).cast("bigint").alias("blocks"))
    quotas = apportion(plan, "target", F.col("blocks"), (), ("rank",), "quota")
    spread = quotas.withColumn("shards", F.ceil(F.col("rows") / SHARD).cast("bigint"))

    seeded = number(F.lit(str(seed)), "doc_id", "size")
    # One row per source: a lookup far below any broadcast limit of tables.
    d = (sized.withColumn("place", seeded).join(
        spread.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("shard", F.col("place") % F.col("shards")))
    shards = d.groupBy("rank", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("quota").alias("quota"))
    blocks = (apportion(shards, "shard_size", F.col("quota"), ("rank",), ("shard",), "share")
              .withColumn("n", F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("shard_size") / BLOCK).cast("bigint")))
              .withColumn("share", F.least("share", F.col("n") * REPEAT))
              .select(F.col("rank").alias("_rank"), F.col("shard").alias("_shard"), "n", "share",
                      F.expr("share div n").alias("each"), (F.col("share") % F.col("n")).alias("extra"),
                      (number(F.lit(f"{seed} start"), "rank", "shard") % F.col("n")).alias("start")))
    run = Window.partitionBy("rank", "shard").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("to", F.sum("size").over(run)).withColumn("from", F.col("to") - F.col("size"))
    d = d.join(blocks, (F.col("rank") == F.col("_rank")) & (F.col("shard") == F.col("_shard")))

    def upto(x: str) -> Column:
        """Words taken of the shard's first x: whole blocks picked, then the part of the block at x."""
        picked = f"((({x} div {BLOCK}) * extra + start) div n)"
        here = f"((({x} div {BLOCK} + 1) * extra + start) div n - {picked})"
        return F.expr(f"{BLOCK} * {picked} + {here} * ({x} % {BLOCK})")

    out = d.withColumn("taken", F.col("each") * F.col("size") + upto("to") - upto("from"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    if copies:
        turn = F.row_number().over(Window.partitionBy("rank", "shard").orderBy("size", "place", "doc_id")) * 0.6180339887498949
        out = out.withColumn("copies", F.when(F.col("size") == 0, 0).otherwise(
            F.floor(F.col("taken") / F.col("size") + turn - F.floor(turn))).cast("int"))
        columns.append("copies")
    return out.select(*columns)


def mix_sql(table: str = "documents", seed: int = 1) -> str:
    """The same rows in DuckDB SQL."""
    def num(*parts: str) -> str:
        return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"

    def seats(name: str, parties: str, cols: str, votes: str, seats_: str, by: str, order: str, out: str) -> str:
        part = f"PARTITION BY {by}" if by else ""
        return f"""
{name}_a AS (SELECT *, {seats_} AS _seats, sum({votes}) OVER ({part}) AS _votes, count(*) OVER ({part}) AS _n FROM {parties}),
{name}_b AS (SELECT *, CASE WHEN _votes > 0 THEN {votes}::DOUBLE / _votes::DOUBLE ELSE 0.0::DOUBLE END AS _share FROM {name}_a),
{name}_c AS (SELECT *, floor(_share * _seats::DOUBLE + 0.5::DOUBLE)::BIGINT AS _first,
    ceil(_share * 1.5::DOUBLE * _n::DOUBLE)::BIGINT + 1 AS _near FROM {name}_b),
{name}_d AS (SELECT *, greatest(0, _first - _near) AS _sure FROM {name}_c),
{name}_e AS (SELECT *, _seats - sum(_sure) OVER ({part}) AS _open FROM {name}_d),
{name}_f AS (SELECT *, unnest(range(_sure, _first + _near)) AS _k FROM {name}_e),
{name}_g AS (SELECT *, {votes}::DOUBLE / (2 * _k + 1)::DOUBLE AS _quotient FROM {name}_f),
{name}_h AS (SELECT *, (row_number() OVER ({part} ORDER BY _quotient DESC, {order}) <= _open AND _quotient > 0)::INT AS _won FROM {name}_g),
{name} AS (SELECT {cols}, (_sure + sum(_won))::BIGINT AS {out} FROM {name}_h GROUP BY {cols}, _sure)"""

    def upto(x: str) -> str:
        picked = f"((({x} // {BLOCK}) * extra + start) // n)"
        return f"({BLOCK} * {picked} + ((({x} // {BLOCK} + 1) * extra + start) // n - {picked}) * ({x} % {BLOCK}))"

    weights = ", ".join(f"{float(w)}::DOUBLE" for w in WEIGHTS)
    return f"""WITH sized AS (SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {table}),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
    row_number() OVER (ORDER BY source COLLATE C NULLS LAST) AS rank FROM sized GROUP BY source),
w AS (SELECT *, [{weights}][(rank - 1) % {len(WEIGHTS)} + 1] AS weight, source_size * {float(REPEAT)}::DOUBLE AS cap FROM sizes),
f AS (SELECT *, cap / weight AS full_at FROM w),
l AS (SELECT *, (sum(source_size) OVER () * {SHARE}::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(weight) OVER (ORDER BY full_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM f),
t AS (SELECT *, least(cap, coalesce((SELECT lev FROM l WHERE lev <= full_at ORDER BY full_at, rank LIMIT 1) * weight, cap)) AS target FROM l),
plan AS (SELECT source, rank, source_size, n_rows, target, round(sum(target) OVER () / {BLOCK})::BIGINT AS blocks FROM t),
{seats("quotas", "plan", "source, rank, source_size, n_rows, target, blocks", "target", "blocks", "", "rank", "quota")},
d AS (SELECT s.doc_id, s.size, q.rank, q.source_size, q.target, q.quota, {num(f"'{seed}'", "s.doc_id", "s.size")} AS place,
    place % ceil(n_rows::DOUBLE / {SHARD})::BIGINT AS shard FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
shards AS (SELECT rank, shard, sum(size)::BIGINT AS shard_size, any_value(quota) AS quota FROM d GROUP BY rank, shard),
{seats("given", "shards", "rank, shard, shard_size, quota", "shard_size", "quota", "rank", "shard", "share")},
n AS (SELECT rank, shard, share, greatest(1, ceil(shard_size::DOUBLE / {BLOCK})::BIGINT) AS n FROM given),
b AS (SELECT rank, shard, n, least(share, n * {REPEAT}) // n AS each, least(share, n * {REPEAT}) % n AS extra,
    {num(f"'{seed} start'", "rank", "shard")} % n AS start FROM n),
r AS (SELECT d.*, sum(size) OVER (PARTITION BY rank, shard ORDER BY place, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upper FROM d)
SELECT doc_id, size, source_size, target,
    (each * size + {upto("upper")} - {upto("(upper - size)")})::BIGINT AS taken
FROM r JOIN b ON r.rank = b.rank AND r.shard = b.shard"""
