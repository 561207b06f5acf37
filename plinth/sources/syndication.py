"""RSS and Atom feeds with Spark's XML functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.temporal import parse_when
from plinth.functions.text import canonical_url, strip_tags, text

MAX_BYTES = 5_000_000
_LINK = "array<struct<_href:string,_rel:string,_VALUE:string>>"
_ITEM = f"struct<title:string,link:{_LINK},description:string,summary:string,content:string,encoded:string,pubDate:string,published:string,updated:string,date:string>"


def _bare(c: Column) -> Column:
    """Without name space prefixes, comments and the XML declaration."""
    c = F.regexp_replace(c, r"(?s)<!--.*?-->|<\?.*?\?>", "")
    return F.regexp_replace(c, r"<(/?)[A-Za-z0-9]+:([A-Za-z])", "<$1$2")


def entries(payloads: DataFrame, xml: str, now: Column) -> DataFrame:
    """The payload's columns with url, title, description and published_at of each item or entry.

    Of several links the alternate (or unmarked) one is taken; items without a title or an https link are left out; a
    date that can't be read is ``now``. Payloads of more than ``MAX_BYTES`` bytes are refused (no rows).
    """
    fine = payloads.where((F.octet_length(xml) <= MAX_BYTES) & (F.length(F.trim(F.col(xml))) > 0))
    parts = F.regexp_extract_all(_bare(F.col(xml)), F.lit(r"(?s)(<(?:item|entry)(?:\s[^>]*)?>.*?</(?:item|entry)>)"), 1)
    item = F.from_xml(F.col("__part"), _ITEM, {"rowTag": "item", "mode": "PERMISSIVE"})
    keep = [F.col(c) for c in payloads.columns if c != xml]
    rows = fine.withColumn("__part", F.explode(parts)).withColumn("__part", F.regexp_replace("__part", r"^<entry|</entry>$", "<item")).withColumn("__part", F.regexp_replace("__part", r"<item$", "</item>"))
    rows = rows.withColumn("__i", item)
    links = F.filter("__i.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(links, 0)["_href"], F.get(links, 0)["_VALUE"])
    when = F.coalesce(F.col("__i.pubDate"), F.col("__i.published"), F.col("__i.updated"), F.col("__i.date"))
    out = rows.select(*keep, canonical_url(link).alias("url"), strip_tags(F.col("__i.title"), full=True).alias("title"), strip_tags(F.coalesce(F.col("__i.description"), F.col("__i.summary"), F.col("__i.content"), F.col("__i.encoded")), full=True).alias("description"), parse_when(text(when), now).alias("published_at"))
    return out.where("url <> '' and title <> ''")
