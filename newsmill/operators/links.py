"""Links of stored pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.columns import computed_once
from newsmill.functions.urls import absolutize, decode_entities, hrefs


def page_links(pages: DataFrame, keep: list[str], base: Column | None = None) -> DataFrame:
    """One row per `<a href>` with its position `pos` in the page and the `href`.

    `keep` names the page columns to carry along; the HTML is dropped here.  With
    a `base` the absolute `full_url` is added (NULL for links of other kinds).
    """
    carried = [F.col(c) for c in keep]
    if base is not None:
        carried.append(base.alias("_base"))
    links = (
        pages.select(*carried, F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))
        .withColumn("href", decode_entities(F.col("href")))
    )
    if base is None:
        return links
    return computed_once(links, absolutize(F.col("href"), F.col("_base")), "full_url").drop("_base")
