"""Address scores and the joins that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.text import SPACES, canonical, clean, jaccard, postcode, ratcliff_ratio, text
from plinth.operators.dedup import spread, top_k

NOISE = ("A", "AN", "AND", "APARTMENT", "AT", "FLAT", "HOUSE", "PROPERTY", "SURREY", "THE", "UNIT")
FILL = ("AVE", "AVENUE", "LANE", "LN", "RD", "ROAD", "ST", "STREET", "THE")


def address_tokens(address: Column, code: Column, town: Column, noise: tuple[str, ...] = NOISE) -> Column:
    """Words of two letters or more in their order, without postcodes, noise and the town's words."""
    line, own = canonical(address), postcode(code)
    line = F.when(own == "", line).otherwise(F.replace(line, own, F.lit(" ")))
    line = F.regexp_replace(line, r"[A-Z]{1,2}[0-9]{1,2}[A-Z]?\s*[0-9][A-Z]{2}", " ")
    towns = F.split(canonical(town), " ")
    return F.filter(F.split(line, " "), lambda t: (F.length(t) >= 2) & ~t.isin(*noise) & ~F.array_contains(towns, t))


def numbers(address: Column) -> Column:
    return F.regexp_extract_all(canonical(address), F.lit(r"\b([0-9]+[A-Z]?)\b"), 1)


def token_score(left: Column, right: Column, left_numbers: Column, right_numbers: Column, left_code: Column, right_code: Column) -> Column:
    """0..1 from containment, Jaccard, shared house numbers, the first word, and the postcode; 0 if postcodes differ."""
    both, union = F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right))
    least = F.least(F.size(F.array_distinct(left)), F.size(F.array_distinct(right)))
    lead = F.get(F.filter(left, lambda t: ~t.rlike("^[0-9]+$")), 0)
    score = 0.62 * both / F.greatest(F.lit(1), least) + 0.28 * both / F.greatest(F.lit(1), union)
    score = score + F.when(F.arrays_overlap(left_numbers, right_numbers), 0.14).otherwise(0.0)
    score = score + F.when((both > 0) & F.coalesce(F.array_contains(right, lead), F.lit(False)), 0.06).otherwise(0.0)
    score = score + F.when((left_code != "") & (left_code == right_code), 0.06).otherwise(0.0)
    none = (F.size(left) == 0) | (F.size(right) == 0) | ((left_code != "") & (right_code != "") & (left_code != right_code))
    return F.when(none, 0.0).otherwise(F.least(F.lit(1.0), score))


def best_token_match(rows: DataFrame, candidates: DataFrame, block: str, row_id: str, score: Column, valid: Column, order: list[Column], least: float = 0.55, examined: int = 8, row_columns: list[str] | None = None, candidate_columns: list[str] | None = None) -> DataFrame:
    """The best candidate of each row within its block: (row columns, candidate columns, score), matched rows only.

    The ``examined`` candidates of the best rough score are looked at, those below least - 0.2 not at all; the winner
    must reach ``least`` and be ``valid``; ties go by ``order``. ``row_columns`` and ``candidate_columns`` are what the
    score reads besides the block (None: any column): rows that agree in them are scored once, and of candidates that
    agree, which tie for every row, only the first ``examined`` count. So pairs grow with the different lines of a block.
    """
    mine, theirs = [c if c is not None else [x for x in df.columns if x != block] for c, df in ((row_columns, rows), (candidate_columns, candidates))]
    kind, other = F.struct(block, *mine).alias("__kind"), F.struct(block, *theirs).alias("__other")
    few = top_k(candidates.where(F.col(block).isNotNull()).withColumn("__other", other), ["__other"], order, examined)
    lines = rows.where(F.col(block).isNotNull()).select(kind).distinct().select("__kind", "__kind.*")
    scored = lines.join(few.select("__other").distinct().select("__other", *[F.col("__other")[c].alias(c) for c in [block, *theirs]]), block).withColumn("score", F.round(score, 6)).where(F.col("score") >= least - 0.2)
    near = top_k(scored.select("__kind", "__other", "score").join(few.drop(block), "__other"), ["__kind"], [F.col("score").desc(), *order], examined).drop("__other")
    every = top_k(rows.withColumn("__kind", kind).join(near.hint("merge"), "__kind").drop("__kind"), [row_id], [F.col("score").desc(), *order], examined)
    return top_k(every.where((F.col("score") >= least) & valid), [row_id], [F.col("score").desc(), *order], 1)


def planning_tokens(address: Column, ignored: tuple[str, ...] = FILL, places: str = "SURREY|UNITED KINGDOM|UK") -> Column:
    line = F.regexp_replace(F.upper(F.regexp_replace(text(address), SPACES, " ")), r"[A-Z]{1,2}[0-9][0-9A-Z]?\s*[0-9][A-Z]{2}", " ")
    line = F.regexp_replace(F.regexp_replace(line, rf"\b({places})\b", " "), "[^A-Z0-9]+", " ")
    return F.filter(F.split(F.trim(line), " "), lambda t: (t != "") & ~t.isin(*ignored))


def planning_score(left: Column, right: Column) -> Column:
    """0..1 from Jaccard, Ratcliff-Obershelp ratio and the first word; much less if that is a number and missing."""
    lead = F.get(left, 0)
    hit = F.coalesce(F.array_contains(right, lead), F.lit(False))
    shared = F.size(F.array_intersect(left, right)) / F.greatest(F.lit(1), F.size(F.array_union(left, right)))
    score = shared * 0.55 + ratcliff_ratio(F.array_join(left, " "), F.array_join(right, " ")) * 0.35 + F.when(hit, 0.10).otherwise(0.0)
    score = F.when(lead.rlike("[0-9]") & ~hit, score * 0.45).otherwise(score)
    return F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0).otherwise(F.round(F.least(F.lit(1.0), score), 3))


def match_applications(properties: DataFrame, applications: DataFrame, least: float = 0.72) -> DataFrame:
    """(property_id, reference, confidence, method): applications of a property.

    properties: property_id, address, postcode, uprn; applications: reference, site_address, postcode, uprn. A property
    with hits by reference number takes those, with confidence 1; the others are scored against applications of their
    postcode. Scores are worked out once per distinct pair of addresses, so only what is returned grows with copies.
    """
    p, a = properties.dropDuplicates(["property_id"]), applications
    sure = p.where("uprn <> ''").join(a.where("uprn <> ''").select("reference", "uprn"), "uprn").select("property_id", "reference", F.lit(1.0).alias("confidence"), F.lit("uprn").alias("method"))
    rest = p.join(sure.select("property_id").distinct(), "property_id", "left_anti").where("postcode <> ''").select("property_id", "address", "postcode")
    # Words are taken once from each address, and postcodes pair different addresses alone. The ratio and the first word
    # add 0.45 at most: pairs whose common words can't make up the rest never reach Python.
    ours, theirs = rest.select("postcode", "address").distinct(), a.select("postcode", "site_address").distinct()
    left, right = [df.select(c).distinct().withColumn(t, planning_tokens(F.col(c))) for df, c, t in ((ours, "address", "__l"), (theirs, "site_address", "__r"))]
    pairs = ours.join(theirs, "postcode")
    alike = pairs.select("address", "site_address").distinct().join(left, "address").join(right, "site_address").where(jaccard(F.col("__l"), F.col("__r")) * 0.55 + 0.4501 >= least)
    alike = alike.withColumn("confidence", planning_score(F.col("__l"), F.col("__r"))).where(F.col("confidence") >= least).drop("__l", "__r")
    hits = pairs.join(alike, ["address", "site_address"])
    # What is returned grows with the product of equal addresses on both sides; it is made in many parts of few rows.
    references = spread(a.select("reference", "site_address", "postcode").join(hits, ["postcode", "site_address"]), "reference")
    near = references.join(spread(rest, "property_id"), ["postcode", "address"]).select("property_id", "reference", "confidence", F.lit("address").alias("method"))
    return sure.unionByName(near)


def sales_coverage(properties: DataFrame, cache: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """(property_id, coverage_status, coverage_reason): whether a property's registered sales have been looked up.

    properties: property_id, postcode; cache: postcode, updated_at, last_error; selected: the postcodes asked for, all if
    None. Without postcode it's unavailable, outside the selection not_checked, without a dated look-up unavailable,
    else complete (and then without a reason).
    """
    code = postcode("postcode").alias("__code")
    looked = top_k(cache.select(code, F.col("updated_at").alias("__when"), clean("last_error").alias("__error")), ["__code"], [F.col("__when").desc_nulls_last(), F.col("__error")], 1)
    chosen = F.lit(True)
    both = properties.select("property_id", code).join(looked, "__code", "left")
    if selected is not None:
        both = both.join(selected.select(code).distinct().withColumn("__chosen", F.lit(True)), "__code", "left")
        chosen = F.col("__chosen").isNotNull()
    none, late = F.col("__code") == "", F.col("__when").isNull()
    status = F.when(none, "unavailable").when(~chosen, "not_checked").when(late, "unavailable").otherwise("complete")
    error = F.coalesce(F.nullif(F.col("__error"), F.lit("")), F.lit("Look-up of the postcode unavailable"))
    reason = F.when(none, "No postcode in the source's record").when(~chosen, "Excluded by the postcodes asked for").when(late, error).otherwise("")
    return both.select("property_id", status.alias("coverage_status"), reason.alias("coverage_reason"))


def anchored_sales(properties: DataFrame, known: DataFrame, registry: DataFrame, score: Column) -> DataFrame:
    """(property_id, sale_id, method): all registered sales of a property.

    properties: property_id, address, block; known: property_id, date, price; registry: sale_id, block, sale_address,
    date, price. Rows of the same block and address are taken; where there are none, the registered address that shares
    a known sale (date and price) and scores best is the anchor, and all its rows are taken. The known sales come first
    and meet the registry on block, date and price, so pairs grow with the sales, not with the square of a block.
    """
    exact = properties.join(registry, "block").where("address = sale_address").select("property_id", "sale_id", F.lit("exact-address").alias("method"))
    rest = properties.join(exact.select("property_id").distinct(), "property_id", "left_anti")
    sales = known.select("property_id", "date", "price").distinct()
    signed = rest.join(sales, "property_id").join(registry, ["block", "date", "price"]).withColumn("__score", score)
    anchor = signed.groupBy("property_id", "block").agg(F.max_by("sale_address", F.struct(F.col("__score"), F.col("sale_address"))).alias("sale_address"))
    more = anchor.join(registry, ["block", "sale_address"]).select("property_id", "sale_id", F.lit("known-sale-anchor").alias("method"))
    return exact.unionByName(more).distinct()
