"""Results around a match: joins back to the rows, price differences, wide and long reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import price_diff, price_index, sanitize_name
from ..functions.similarity import Scoring
from .best_match import best_match
from .lineage import cut_lineage

# Columns of the price report, in order.
PRICE_REPORT = [
    "scraping_date", "mkp_sku_id", "scrap_id", "mkp_sku_name", "competitor_name", "competitor_sku_name",
    "confidence", "mkp_price", "competitor_price", "price_diff", "price_index",
    "mkp_sku_name_clean", "comp_sku_name_clean", "competitor_url",
]
# what is shown of a competitor's product
PRODUCT = ["competitor_sku_name", "competitor_price", "competitor_url"]
# competitors a wide report has columns for
WIDE_COMPETITORS = 1000

LONG_REPORT = [
    "competitor_name", "mkp_sku_id", "mkp_sku_name", "mkp_price", "competitor_sku_name", "competitor_url",
    "competitor_price", "price_diff", "%_price_diff", "%_confidence", "scraping_date",
]


def matched_rows(scraped: DataFrame, matches: DataFrame, name: str = "comp_sku_name_clean", threshold: float = 0.40) -> DataFrame:
    """Scraped rows with the sku and confidence of their name; unmatched rows go."""
    kept = matches.where(F.col("confidence") >= threshold)
    return scraped.join(kept, name).drop(name)


def price_report(scraped: DataFrame, catalog: DataFrame, matches: DataFrame, scraping_date: Column, ordered: bool = False) -> DataFrame:
    """Matches with both sides' prices, their difference and index; ``ordered`` by own id, then confidence, best first.

    ``scraped``: scrap_id, competitor_*, comp_sku_name_clean.  ``catalog``: mkp_sku_id,
    mkp_sku_name, mkp_price, mkp_sku_name_clean.  ``matches``: comp_sku_name_clean, mkp_sku_id, confidence.
    """
    report = (
        scraped.join(matches, "comp_sku_name_clean").join(catalog, "mkp_sku_id")
        .withColumn("scraping_date", scraping_date)
        .withColumn("price_diff", price_diff(F.col("mkp_price"), F.col("competitor_price")))
        .withColumn("price_index", price_index(F.col("price_diff"), F.col("mkp_price")))
        .fillna("", ["competitor_url"])
        .select(*PRICE_REPORT)
    )
    return report.orderBy("mkp_sku_id", F.desc("confidence")) if ordered else report


def first_products(scraped: DataFrame, key: str) -> DataFrame:
    """The rows of ``scraped`` (competitor_name, competitor_sku_name, competitor_price, competitor_url and ``key``) that come first
    among those alike in competitor and ``key``, by name, then price, then address; with ``product_id``, an id in that order."""
    product = F.struct(*PRODUCT)
    price = F.lpad(F.round(F.col("competitor_price") * 1e6).cast("decimal(30,0)").cast("string"), 30, "0")
    ident = F.concat_ws("\x01", *[F.coalesce(c, F.lit("")) for c in (F.col("competitor_sku_name"), price, F.col("competitor_url"))])
    first = scraped.groupBy("competitor_name", F.col(key).alias("_key")).agg(F.min(F.struct(ident.alias("product_id"), product.alias("product"))).alias("first"))
    found = first.select("competitor_name", F.col("_key"), "first.product_id", "first.product.*")
    return found.drop("_key") if key in PRODUCT else found.withColumnRenamed("_key", key)


def reverse_match(
    catalog: DataFrame, scraped: DataFrame, threshold: float = 0.75, scoring: Scoring = Scoring.first_version(), names: DataFrame | None = None,
) -> DataFrame:
    """Best competitor product per own product and competitor.

    ``catalog``: sku, sku_name_clean.  ``scraped``: competitor_name, sku_name_clean,
    competitor_sku_name, competitor_price, competitor_url.  One row per (sku,
    competitor_name) that reaches the threshold, equal products by smallest name,
    then price, then address.  ``names``: the sku_name_clean of the catalogue, if the caller has them without its rows.
    """
    # the first product of each name, written down: what follows reads names, not rows
    products = cut_lineage(first_products(scraped, "sku_name_clean"))
    best = best_match(
        catalog if names is None else names, products, left_name="sku_name_clean", right_name="sku_name_clean", right_id="product_id",
        threshold=threshold, scoring=scoring, by="competitor_name",
    )
    shown = products.groupBy("competitor_name", "product_id").agg(F.min(F.struct(*PRODUCT)).alias("product"))
    found = cut_lineage(best.join(shown, ["competitor_name", "product_id"]).select("sku_name_clean", "competitor_name", "product.*", "confidence"))
    return catalog.select("sku", "sku_name_clean").join(found, "sku_name_clean").drop("sku_name_clean")


def competitor_counts(matches: DataFrame, scraped: DataFrame, catalog_rows: Column | int) -> DataFrame:
    """Per competitor: products evaluated, own products matched and left without a match."""
    evaluated = scraped.groupBy("competitor_name").agg(F.count("*").alias("n_evaluated"))
    matched = matches.groupBy("competitor_name").agg(F.count("*").alias("n_matched"))
    n_own = catalog_rows if isinstance(catalog_rows, Column) else F.lit(catalog_rows)
    return (
        evaluated.join(matched, "competitor_name", "left").fillna(0, ["n_matched"])
        .withColumn("n_unmatched", n_own - F.col("n_matched"))
    )


def competitor_list(scraped: DataFrame) -> list[str]:
    """Competitor names in order, at most ``WIDE_COMPETITORS``, as each becomes columns of a wide report."""
    names = scraped.select("competitor_name").where("competitor_name is not null").distinct()
    rows = names.orderBy("competitor_name").limit(WIDE_COMPETITORS + 1).collect()
    if len(rows) > WIDE_COMPETITORS:
        raise ValueError(f"more than {WIDE_COMPETITORS} competitors: a wide report would have too many columns")
    return [r[0] for r in rows]


def column_names(competitors: list[str]) -> dict[str, str]:
    """The column name of each competitor; two competitors with one name are an error."""
    names = {c: sanitize_name(c) for c in competitors}
    if len(set(names.values())) < len(names):
        clash = sorted(c for c, n in names.items() if list(names.values()).count(n) > 1)
        raise ValueError(f"competitors share a column name: {', '.join(clash)}")
    return names


def match_wide(catalog: DataFrame, matches: DataFrame, competitors: list[str]) -> DataFrame:
    """One row per own product; sku, conf, price and url of every competitor, null without a match."""
    names = column_names(competitors)
    cells = {"sku": "competitor_sku_name", "conf": "confidence", "price": "competitor_price", "url": "competitor_url"}
    wide = matches.groupBy("sku").agg(*[
        F.max(F.when(F.col("competitor_name") == c, F.col(value))).alias(f"c_{names[c]}_{cell}")
        for c in competitors for cell, value in cells.items()
    ])
    return catalog.select("sku", "sku_name", "price").join(wide, "sku", "left")


def wide_to_long(wide: DataFrame, competitors: list[str]) -> DataFrame:
    """A wide report back to one row per own product and competitor, unmatched pairs dropped."""
    names = column_names(competitors)
    cells = F.array(*[
        F.struct(
            F.lit(names[c]).alias("competitor_name"),
            F.col(f"c_{names[c]}_sku").alias("competitor_sku_name"),
            F.col(f"c_{names[c]}_conf").alias("confidence"),
            F.col(f"c_{names[c]}_price").alias("competitor_price"),
            F.col(f"c_{names[c]}_url").alias("competitor_url"),
        )
        for c in competitors
    ])
    return (
        wide.select("sku", "sku_name", "price", F.explode(cells).alias("c"))
        .select("sku", "sku_name", "price", "c.*")
        .where("competitor_sku_name is not null")
    )


def match_map(catalog: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per own product with ``matches``, a map from competitor to its product: a wide report of any width.

    Nothing is asked of the driver, and a new competitor is a new entry, not new columns.
    """
    cell = F.struct("competitor_sku_name", "confidence", "competitor_price", "competitor_url")
    entries = matches.groupBy("sku").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("competitor_name", cell.alias("match"))))).alias("matches"))
    return catalog.select("sku", "sku_name", "price").join(entries, "sku", "left")


def map_to_long(wide: DataFrame) -> DataFrame:
    """The map report back to one row per own product and competitor."""
    rows = wide.select("sku", "sku_name", "price", F.explode("matches").alias("competitor_name", "match"))
    return rows.select("sku", "sku_name", "price", "competitor_name", "match.*")


def long_report(long: DataFrame, scraping_date: Column, ordered: bool = False) -> DataFrame:
    """The first version's report: priced rows, difference to 5 decimals, share of the own price.

    ``ordered``: by competitor, then by confidence, both ascending.
    """
    diff = F.round(F.col("price") - F.col("competitor_price"), 5)
    report = (
        long.where("price > 0")
        .withColumnsRenamed({"sku": "mkp_sku_id", "sku_name": "mkp_sku_name"})
        .withColumn("price_diff", diff)
        .withColumn("mkp_price", F.round("price", 5))
        .withColumn("%_price_diff", price_index(F.col("price_diff"), F.col("mkp_price"), None))
        .withColumn("%_confidence", F.round("confidence", 5))
        .withColumn("competitor_price", F.round("competitor_price", 5))
        .withColumn("scraping_date", scraping_date)
        .fillna("Pending", ["competitor_url"])
        .select(*[F.col(f"`{c}`") for c in LONG_REPORT])
    )
    return report.orderBy("competitor_name", "`%_confidence`") if ordered else report
