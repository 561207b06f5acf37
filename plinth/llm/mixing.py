"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled (by a hash of seed and id) and cut into blocks of equal tokens. Slot n of the
schedule looks at the golden-ratio point frac(n * 0.618...), held as an integer, and belongs to the source in whose
interval of the cumulative weights it falls; the r-th slot of a source plays its block r modulo its blocks. Any stretch
of the schedule is thus close to the target weights. The schedule is as long as the source that is shortest of its
weight needs to be played once; the others begin again (``epoch``). Blocks that found no slot by then follow at the end
(``epoch`` 0), so every document is played.

Running sums are taken in two levels (buckets, then within a bucket), so that no source is one task's work.

``mixed_documents`` moves texts once. The played schedule, which has no texts, is cut into parts of equal bytes. What a
part plays of a source in an epoch is one stretch of the order of keys, so a row finds its parts in a small table of
stretches, goes straight there, and meets its exact slots in the part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plinth.llm.components import cut, discard, text_version

BLOCK_TOKENS = 8192
EXPONENT = 0.8
SEED = "mix-1"
_ONE = 1 << 32
_GOLDEN = 2654435769
_CHUNK = 4096
_CELLS = 256
_SLOTS = 64
#: A part of the mix holds so many bytes at least; up to so many stretches are broadcast.
PART_BYTES = 1 << 20
STRETCHES = 250_000


def _running(df: DataFrame, group: list[str], bucket: Column, value: Column, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the group's earlier rows; buckets ascend with the order."""
    df = df.withColumn("__bucket", bucket).withColumn("__value", value)
    sums = df.groupBy(*group, "__bucket").agg(F.sum("__value").alias("__sum"))
    before = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(W.partitionBy(*group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__sum")
    inner = F.coalesce(F.sum("__value").over(W.partitionBy(*group, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("__inner", inner).join(before, [*group, "__bucket"]).withColumn(name, F.col("__inner") + F.col("__before")).drop("__bucket", "__value", "__inner", "__before")


def _key(doc_id: Column, seed: str) -> Column:
    """Orders the documents of a source."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix_schedule(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = EXPONENT, block_tokens: int = BLOCK_TOKENS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(slot, source, epoch, block, offset, doc_id, n_tokens): when each document is played, and again.

    A document belongs to the block in which its first token falls; ``offset`` is where that lies in the source. Tokens
    are white-space separated words. ``weights`` gives the target share per source (sources that it leaves out get no
    slots but are played at the end); by default a source weighs its tokens to the power ``exponent``. A null source
    counts as '', null and empty texts have 0 tokens, and rows that repeat an id are played each. An empty table gives
    an empty schedule. Without any weight (an empty dictionary, or one of absent sources) there are no slots and all is
    played at the end, once. Other columns are ignored.
    """
    return _schedule(docs, weights, exponent, block_tokens, seed, id_col, text_col, source_col)[0].drop("version", "n_bytes")


def _schedule(docs: DataFrame, weights: dict[str, float] | None, exponent: float, block_tokens: int, seed: str, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, list[DataFrame]]:
    """(``mix_schedule`` with each row's version and bytes, tables that it reads)."""
    if weights and min(weights.values()) < 0:
        raise ValueError("weights must not be negative")
    spark = docs.sparkSession
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("source"),
        F.regexp_count(F.coalesce(docs[text_col].cast("string"), F.lit("")), F.lit("[^ \t\n\r]+")).cast("long").alias("n_tokens"),
        text_version(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("version"),
        F.coalesce(F.octet_length(docs[text_col].cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
    ).withColumn("key", _key(F.col("doc_id"), seed))
    rows = cut(rows, "mix")
    placed = _running(rows, ["source"], F.substring("key", 1, 3), F.col("n_tokens"), [F.col("key"), F.col("doc_id"), F.col("n_tokens")], "offset")
    placed = placed.withColumn("block", F.floor(F.col("offset") / F.lit(block_tokens)).cast("long")).select("doc_id", "source", "version", "n_tokens", "n_bytes", "offset", "block")
    totals = rows.groupBy("source").agg(F.greatest(F.sum("n_tokens"), F.lit(1)).alias("tokens"))
    if weights is None:
        weighed = totals.withColumn("weight", F.pow(F.col("tokens").cast("double"), F.lit(float(exponent))))
    else:
        given = spark.createDataFrame([(k or "", float(v)) for k, v in weights.items()], "source string, weight double")
        weighed = totals.join(given, "source", "left").fillna(0.0, ["weight"])
    order = W.partitionBy(F.lit(0)).orderBy("source")  # one row per source
    whole = F.sum("weight").over(W.partitionBy(F.lit(0)))
    shares = weighed.withColumn("share", F.when(whole > 0, F.col("weight") / whole).otherwise(0.0)).withColumn("blocks", F.ceil(F.col("tokens") / F.lit(block_tokens)).cast("long"))
    shares = shares.withColumn("high", F.round(F.sum("share").over(order) * F.lit(_ONE)).cast("long")).withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0)))
    shares = cut(shares, "shares")
    length = shares.where("share > 0").agg(F.max(F.ceil(F.col("tokens") / (F.lit(float(block_tokens)) * F.col("share"))))).first()[0] or 0
    slots = spark.range(int(length)).select(F.col("id").alias("slot"), ((F.col("id") % (_ONE // 2)) * F.lit(_GOLDEN) % F.lit(_ONE)).alias("point"))
    step = _ONE // _CELLS
    cells = shares.where("high > low").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / step), F.floor((F.col("high") - 1) / step)))).select("source", "low", "high", "blocks", "cell")
    owned = slots.withColumn("cell", F.floor(F.col("point") / step)).join(cells, "cell").where("point >= low and point < high").select("slot", "source", "blocks")
    ranked = _running(owned, ["source"], F.floor(F.col("slot") / _CHUNK), F.lit(1), [F.col("slot")], "rank")
    played = ranked.select("slot", "source", (F.col("rank") % F.col("blocks")).alias("block"), F.floor(F.col("rank") / F.col("blocks")).cast("long").alias("epoch"))
    missed = placed.select("source", "block").distinct().join(played.select("source", "block").distinct(), ["source", "block"], "left_anti")
    # Blocks without a slot follow one another, by block and source; their places are counted in two levels too.
    late = missed.withColumn("all", F.lit("")).withColumn("one", F.lit(1))
    tail = _running(late, ["all"], F.floor(F.col("block") / _CHUNK), F.col("one"), [F.col("block"), F.col("source")], "place")
    tail = tail.select((F.col("place") + F.lit(int(length))).cast("long").alias("slot"), "source", "block", F.lit(0).cast("long").alias("epoch"))
    plan = played.unionByName(tail).join(placed, ["source", "block"]).select("slot", "source", "epoch", "block", "offset", "doc_id", "version", "n_tokens", "n_bytes")
    return plan, [rows, shares]


def mixed_documents(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = EXPONENT, block_tokens: int = BLOCK_TOKENS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents in the mix, in the order of ``mix_schedule`` and as often as it plays them, with all their columns.

    A row is known by its id, source and text, so a repeated id is played as often as its own source is. Rows that are
    equal in all three are played the same number of times each, all of them where the first of them has its slot. Rows
    are sorted by slot across partitions; what is written of them keeps that order by file.
    """
    spark = docs.sparkSession
    plan, reads = _schedule(docs, weights, exponent, block_tokens, seed, id_col, text_col, source_col)
    plays = plan.groupBy(F.col("doc_id").alias("__mixed"), F.col("source").alias("__source"), F.col("version").alias("__version"), F.col("epoch").alias("__epoch")).agg(F.min(F.struct("slot", "offset")).alias("__at"), F.sum(F.col("n_bytes") + 64).alias("__size"))
    plays = cut(plays.withColumn("__place", _place(F.col("__mixed"), seed)), "plays")
    discard(*reads)
    size = plays.agg(F.sum("__size")).first()[0] or 1
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES))
    order = [F.col(c) for c in ("__at", "__place", "__mixed", "__source", "__version", "__epoch")]
    placed = _running(plays.withColumn("__all", F.lit("")), ["__all"], F.floor(F.col("__at.slot") / _SLOTS), F.col("__size"), order, "__start")
    placed = placed.withColumn("__part", F.least(F.floor(F.col("__start") / F.lit(size / parts)), F.lit(parts - 1)).cast("int"))
    placed = cut(placed.select("__part", "__epoch", "__mixed", "__source", "__version", "__at", "__place"), "placed")
    discard(plays)
    # A source's stretches are looked up by the first bits of their keys: about 16 of them at most in a cell.
    bits = max(0, (parts // 16).bit_length())
    cell = lambda place: F.shiftright(place, 60 - bits).cast("int")
    stretches = cut(placed.groupBy("__source", "__epoch", "__part", cell(F.col("__place")).alias("__cell")).agg(F.min("__place").alias("__low"), F.max("__place").alias("__high")), "stretches")
    stretches = stretches.withColumnsRenamed({"__source": "__of", "__epoch": "__in", "__part": "__to"})
    if stretches.count() <= STRETCHES:
        stretches = F.broadcast(stretches)
    doc_id, text = docs[id_col].cast("long"), F.coalesce(docs[text_col].cast("string"), F.lit(""))
    own = docs.withColumns({"__doc": doc_id, "__from": F.coalesce(docs[source_col].cast("string"), F.lit("")), "__text": text_version(text), "__key": _place(doc_id, seed)})
    sent = own.join(stretches, (own["__from"] == stretches["__of"]) & (cell(own["__key"]) == stretches["__cell"]) & own["__key"].between(stretches["__low"], stretches["__high"]))
    sent, placed = sent.repartitionById(parts, "__to"), placed.repartitionById(parts, "__part")
    same = (F.col("__to") == F.col("__part")) & (F.col("__in") == F.col("__epoch")) & (F.col("__from") == F.col("__source")) & (F.col("__text") == F.col("__version"))
    both = sent.join(placed, same & F.col("__doc").eqNullSafe(F.col("__mixed")))
    # Parts ascend with the slots; both sides come by part, so the join leaves them where they are.
    return both.sortWithinPartitions("__at.slot", "__at.offset").select(*[docs[c] for c in docs.columns])


def _place(doc_id: Column, seed: str) -> Column:
    """The first 60 bits of the key."""
    return F.conv(F.substring(_key(doc_id, seed), 1, 15), 16, 10).cast("long")


ORACLE_SQL = f"""
WITH rows_ AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens,
         md5('{SEED}:' || CAST(doc_id AS VARCHAR)) AS key
  FROM documents),
placed AS (
  SELECT *, CAST(floor("offset" / {BLOCK_TOKENS}) AS BIGINT) AS block FROM (
    SELECT doc_id, source, n_tokens, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY key, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM rows_)),
totals AS (SELECT source, greatest(sum(n_tokens), 1) AS tokens FROM rows_ GROUP BY source),
shares AS (
  SELECT source, tokens, CAST(ceil(tokens / {BLOCK_TOKENS}) AS BIGINT) AS blocks, pow(tokens, {EXPONENT}) / sum(pow(tokens, {EXPONENT})) OVER () AS share FROM totals),
cuts AS (
  SELECT *, coalesce(lag(high) OVER (ORDER BY source), 0) AS low FROM (
    SELECT *, CAST(round(sum(share) OVER (ORDER BY source) * {_ONE}) AS BIGINT) AS high FROM shares)),
span AS (SELECT CAST(max(ceil(tokens / ({float(BLOCK_TOKENS)} * share))) AS BIGINT) AS n FROM shares),
slots AS (SELECT slot, slot * {_GOLDEN} % {_ONE} AS point FROM (SELECT unnest(range(0, (SELECT n FROM span))) AS slot)),
ranked AS (
  SELECT slot, source, blocks, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
  FROM slots JOIN cuts ON point >= low AND point < high),
played AS (SELECT slot, source, rank % blocks AS block, CAST(floor(rank / blocks) AS BIGINT) AS epoch FROM ranked),
missed AS (SELECT DISTINCT source, block FROM placed EXCEPT SELECT source, block FROM played),
tail AS (SELECT row_number() OVER (ORDER BY block, source) - 1 + (SELECT n FROM span) AS slot, source, block, CAST(0 AS BIGINT) AS epoch FROM missed),
plan AS (SELECT * FROM played UNION ALL SELECT * FROM tail)
SELECT slot, source, epoch, block, "offset", doc_id, n_tokens FROM plan JOIN placed USING (source, block)
"""
