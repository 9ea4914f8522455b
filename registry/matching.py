"""Queries over the best-match join and the reports built on it."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfmatch.functions import fields as C
from shelfmatch.functions.scorer import SLACK, TILE, Scorer, common_bound
from shelfmatch.functions.shared import Overlap
from shelfmatch.operators import reports
from shelfmatch.operators.best_match import best_match
from shelfmatch.operators.lineage import cut_lineage
from shelfmatch.plans.daily import clean_names, match_day, with_clean_names
from shelfmatch.sources.scraped import clean_scraped

from . import duck as D
from . import fields as FQ
from . import inputs as I

SPARK, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


# ------------------------------------------------------------- own side wins


def _own_names(spark, sf):
    """The distinct names of the catalogue, with the least sku of each."""
    return clean_names(I.read(spark, sf, I.CATALOG), "sku_name", "mkp_sku_name_clean", F.min("sku").alias("sku"))


def _scraped_names(spark, sf):
    return clean_names(I.read(spark, sf, I.SCRAPED), "name", "comp_sku_name_clean")


CATALOG_CLEAN = f"select sku, sku_name, price, x as name from ({D.normalize(I.CATALOG, 'sku_name')})"
SCRAPED_CLEAN = f"select * replace (x as name) from (select *, name as raw_name from ({D.normalize(I.SCRAPED, 'name')}))"


def best_sql(left: str, threshold: float) -> str:
    """Best catalogue sku per distinct left name: brute force over all pairs."""
    scores = D.all_scores(f"select distinct name from ({left})", f"select sku, name from ({CATALOG_CLEAN})")
    return f"""
    select left_name as comp_sku_name_clean, sku, conf as confidence from (
      select *, row_number() over (partition by left_name order by conf desc, sku) as rn from ({scores}))
    where rn = 1 and conf >= {threshold}"""


@query("best_match_join", best_sql(SCRAPED_CLEAN, 0.4))
def best_match_join(spark, sf):
    return best_match(_scraped_names(spark, sf), _own_names(spark, sf))


@query("best_match_strict", best_sql(SCRAPED_CLEAN, 0.9))
def best_match_strict(spark, sf):
    return best_match(_scraped_names(spark, sf), _own_names(spark, sf), threshold=0.9)


class TokenOverlap(Scorer):
    """Jaccard similarity of the distinct tokens: a measure of a caller's own."""

    columns = ("tokens",)
    buckets = 31

    def prepared(self, names, text):
        return names.withColumn("tokens", F.array_distinct(F.split(text, " ")))

    def features(self, texts):
        """How many tokens, and how many in each bucket of a hash."""
        out = np.zeros((len(texts), 1 + self.buckets), np.int64)
        for row, tokens in enumerate(texts["tokens"]):
            out[row, 0] = len(tokens)
            for t in tokens:
                out[row, 1 + zlib.crc32(t.encode()) % self.buckets] += 1
        return out

    def bound(self, low_a, high_a, low_b, high_b):
        common = common_bound(low_a[..., 1:], high_a[..., 1:], low_b[..., 1:], high_b[..., 1:])
        union = np.maximum(np.maximum(low_a[..., 0], low_b[..., 0]), low_a[..., 0] + low_b[..., 0] - common)
        return np.minimum(1.0, common / np.maximum(union, 1))

    def score(self, a: pd.DataFrame, b: pd.DataFrame):
        common = np.array([len({*x} & {*y}) for x, y in zip(a["tokens"], b["tokens"])], np.float64)
        return common / (a["tokens"].str.len().to_numpy() + b["tokens"].str.len().to_numpy() - common)

    def match(self, left, right, threshold):
        """Tokens with a digit are looked up, the others compared set by set; sets with many such tokens are scored in pairs."""
        overlap = Overlap(left["tokens"].tolist(), right["tokens"].tolist(), lambda t: not any(c.isdigit() for c in t))
        best = overlap.best(self.digits, self.least(threshold), SLACK, TILE)
        n, mine, theirs = len(right), ~overlap.left_listed, ~overlap.right_listed
        for some_l, some_r in ((mine, np.ones(n, bool)), (~mine, theirs)):
            if some_l.any() and some_r.any():
                at, places = np.flatnonzero(some_l), np.flatnonzero(some_r)
                li, ri, scores = super().match(left[some_l].reset_index(drop=True), right[some_r].reset_index(drop=True), threshold)
                np.maximum.at(best, at[li], np.rint(scores * 10**self.digits).astype(np.int64) * n + (n - 1 - places[ri]))
        scores = best // max(n, 1) / 10**self.digits
        li = np.flatnonzero((best >= 0) & (scores >= threshold))
        return li, n - 1 - best[li] % n, scores[li]


def _tokens_sql(source: str, columns: str) -> str:
    return f"select {columns}, unnest(list_distinct(string_split(name, ' '))) as t, len(list_distinct(string_split(name, ' '))) as n from ({source})"


@query("best_match_custom", f"""
with l as materialized ({_tokens_sql(f"select distinct name from ({SCRAPED_CLEAN})", "name")}),
r as materialized ({_tokens_sql(CATALOG_CLEAN, "name, sku")}),
p as (select l.name, r.sku, count(*) / (any_value(l.n) + any_value(r.n) - count(*)) as j from l join r using (t) group by 1, 2)
select name as comp_sku_name_clean, sku, c as confidence
from (select *, row_number() over (partition by name order by c desc, sku) as rn from (select *, round_even(j, 4) as c from p)) where rn = 1 and c >= 0.5""")
def best_match_custom(spark, sf):
    """Best catalogue product by a scorer of the caller."""
    return best_match(_scraped_names(spark, sf), _own_names(spark, sf), threshold=0.5, scorer=TokenOverlap())


CLEANED = FQ.SQL["scraped_clean"]
CLEANED_NAMES = D.normalize(f"select distinct competitor_sku_name from ({CLEANED})", "competitor_sku_name")


@query("best_match_rows", f"""
select s.*, b.sku, b.confidence
from ({CLEANED}) s join (select competitor_sku_name, x from ({CLEANED_NAMES})) n using (competitor_sku_name)
join ({best_sql(f"select x as name from ({CLEANED_NAMES})", 0.4)}) b on b.comp_sku_name_clean = n.x""")
def best_match_rows(spark, sf):
    """Cleaned scrape rows with the best sku, as the daily job appends them."""
    scraped = clean_scraped(I.read(spark, sf, I.SCRAPED, dealt=True)).where("reason is null").drop("reason")
    return match_day(scraped, I.read(spark, sf, I.CATALOG, dealt=True))


REPORT_SQL = f"""
select date '2026-01-05' as scraping_date, b.sku as mkp_sku_id, s.row_key as scrap_id, c.sku_name as mkp_sku_name, s.company as competitor_name,
       s.raw_name as competitor_sku_name, b.confidence, c.price as mkp_price, s.competitor_price,
       round(c.price - s.competitor_price, 2) as price_diff, round(round(c.price - s.competitor_price, 2) / c.price, 2) + 0.0::double as price_index,
       c.name as mkp_sku_name_clean, s.name as comp_sku_name_clean, coalesce(s.url, '') as competitor_url
from (select *, {FQ.price_sql('price')} as competitor_price from ({SCRAPED_CLEAN})) s
join ({best_sql(SCRAPED_CLEAN, 0.35)}) b on b.comp_sku_name_clean = s.name
join ({CATALOG_CLEAN}) c on c.sku = b.sku"""


@query("price_report", REPORT_SQL)
def price_report(spark, sf):
    own_names, names = _own_names(spark, sf), _scraped_names(spark, sf)
    matches = best_match(names, own_names, threshold=0.35).withColumnRenamed("sku", "mkp_sku_id")
    catalog = I.read(spark, sf, I.CATALOG, dealt=True).join(own_names.drop("sku"), "sku_name")
    scraped = I.read(spark, sf, I.SCRAPED, dealt=True).join(names, "name")
    own = catalog.withColumnsRenamed({"sku": "mkp_sku_id", "sku_name": "mkp_sku_name", "price": "mkp_price"})
    rows = scraped.select(
        F.col("row_key").alias("scrap_id"), F.col("company").alias("competitor_name"), F.col("name").alias("competitor_sku_name"),
        C.parse_price(F.col("price")).alias("competitor_price"), F.col("url").alias("competitor_url"), "comp_sku_name_clean")
    return reports.price_report(rows, own, matches, F.lit("2026-01-05").cast("date"), ordered=True)


@query("top_confidence", f"select * from ({best_sql(SCRAPED_CLEAN, 0.4)}) order by confidence desc, comp_sku_name_clean limit 20")
def top_confidence(spark, sf):
    return best_match_join(spark, sf).orderBy(F.desc("confidence"), "comp_sku_name_clean").limit(20)


# ------------------------------------------------------------- competitor side wins


def _evaluated(spark, sf):
    """Scraped products with a name and a price."""
    return I.read(spark, sf, I.SCRAPED).select(
        F.col("company").alias("competitor_name"), F.col("name").alias("competitor_sku_name"),
        C.parse_price(F.col("price"), digits=None, on_error=0.0).alias("competitor_price"), F.col("url").alias("competitor_url"),
    ).where("competitor_price > 0 and competitor_sku_name is not null")


def _reverse(spark, sf):
    """The catalogue's rows, its distinct names, and the matches.  Of the products of one name only the first goes on."""
    names = clean_names(I.read(spark, sf, I.CATALOG), "sku_name", "sku_name_clean")
    own = I.read(spark, sf, I.CATALOG).join(names, "sku_name")
    products = cut_lineage(reports.first_products(_evaluated(spark, sf), "competitor_sku_name"))
    products = with_clean_names(products, "competitor_sku_name", "sku_name_clean")
    return own, _evaluated(spark, sf), reports.reverse_match(own, products, names=names)


PRICED = f"""select company as competitor_name, name, raw_name as competitor_sku_name, url as competitor_url, competitor_price
  from (select *, coalesce({FQ.price_sql('price')}, 0) as competitor_price from ({SCRAPED_CLEAN})) where competitor_price > 0"""
REVERSE_SQL = f"""
select sku, competitor_name, competitor_sku_name, competitor_price, competitor_url, conf as confidence from (
  select *, row_number() over (partition by sku, competitor_name order by conf desc, competitor_sku_name, competitor_price nulls first, competitor_url nulls first) as rn
  from ({D.all_scores(f"select sku, name from ({CATALOG_CLEAN})", PRICED, unit_weight=0.1, decay=1.1, digits=2)}))
where rn = 1 and conf >= 0.75"""


@query("reverse_best_match", REVERSE_SQL)
def reverse_best_match(spark, sf):
    return _reverse(spark, sf)[2]


COMPETITORS = [f"competitor_{i}" for i in range(5)]
CELLS = {"sku": "competitor_sku_name", "conf": "confidence", "price": "competitor_price", "url": "competitor_url"}
WIDE_SQL = f"""
select c.sku, c.sku_name, c.price, {", ".join(f"w.c_{c}_{cell}" for c in COMPETITORS for cell in CELLS)}
from ({I.CATALOG}) c left join (
  select sku, {", ".join(f"max({value}) filter (competitor_name = '{c}') as c_{c}_{cell}" for c in COMPETITORS for cell, value in CELLS.items())}
  from ({REVERSE_SQL}) group by 1) w on w.sku = c.sku"""


@query("best_match_wide", WIDE_SQL)
def best_match_wide(spark, sf):
    own, scraped, matches = _reverse(spark, sf)
    return reports.match_wide(own, matches, reports.competitor_list(scraped))


LONG_SQL = f"select r.sku, c.sku_name, c.price, competitor_name, competitor_sku_name, confidence, competitor_price, competitor_url from ({REVERSE_SQL}) r join ({I.CATALOG}) c on c.sku = r.sku"


@query("wide_to_long", LONG_SQL)
def wide_to_long(spark, sf):
    own, scraped, matches = _reverse(spark, sf)
    competitors = reports.competitor_list(scraped)
    return reports.wide_to_long(reports.match_wide(own, matches, competitors), competitors)


@query("best_match_map", LONG_SQL)
def best_match_map(spark, sf):
    """The report of any number of competitors, there and back."""
    own, _, matches = _reverse(spark, sf)
    return reports.map_to_long(reports.match_map(own, matches))


@query("long_report", f"""
select competitor_name, sku as mkp_sku_id, sku_name as mkp_sku_name, round(price, 5) as mkp_price, competitor_sku_name,
       coalesce(competitor_url, 'Pending') as competitor_url, round(competitor_price, 5) as competitor_price,
       round(price - competitor_price, 5) as price_diff, round(price - competitor_price, 5) / price as "%_price_diff",
       round(confidence, 5) as "%_confidence", date '2026-01-05' as scraping_date
from ({LONG_SQL}) where price > 0""")
def long_report(spark, sf):
    return reports.long_report(wide_to_long(spark, sf), F.lit("2026-01-05").cast("date"), ordered=True)


@query("competitor_counts", f"""
select e.competitor_name, n_evaluated, coalesce(n_matched, 0) as n_matched, n_own - coalesce(n_matched, 0) as n_unmatched
from (select competitor_name, count(*) as n_evaluated from ({PRICED}) group by 1) e
left join (select competitor_name, count(*) as n_matched from ({REVERSE_SQL}) group by 1) m using (competitor_name), (select count(*) as n_own from part)""")
def competitor_counts(spark, sf):
    _, scraped, matches = _reverse(spark, sf)
    return reports.competitor_counts(matches, scraped, I.read(spark, sf, I.CATALOG).where("sku_name is not null").count())
