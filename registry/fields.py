"""Queries over field functions, dates, checks, sources and table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmatch.functions import dates as D
from shelfmatch.functions import fields as C
from shelfmatch.operators import catalog, checks
from shelfmatch.sources import delimited, listing, scraped, tables
from shelfmatch.sources.prices import clean_prices

from . import inputs as I

SPARK, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


PRICE_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def price_sql(x: str) -> str:
    bare = f"trim(regexp_replace({x}, '[\"$,cu/]', '', 'g'))"
    return f"(case when regexp_matches({bare}, '{PRICE_NUMBER}') then round(try_cast({bare} as double), 2) end)"


def name_sql(x: str) -> str:
    return (
        f"(case when length({x}) >= 10 and len(string_split({x}, ' ')) > 2 then array_to_string(list_transform(string_split({x}, ' '), "
        f"lambda w: case when length(w) >= 3 then case when w[1] = 'ß' then 'Ss' else upper(w[1]) end || lower(substr(w, 2)) else lower(w) end), ' ') end)"
    )


def url_sql(x: str) -> str:
    return f"(case when length({x}) > 10 then case when regexp_matches({x}, '^https?://[\\w.-]+') then {x} else 'https://' || {x} end end)"


def dmy_sql(x: str) -> str:
    return f"(case when regexp_matches({x}, '^\\d{{1,2}}-\\d{{1,2}}-\\d{{2}}$') then try_strptime({x}, '%d-%m-%y')::date end)"


def iso_sql(x: str) -> str:
    return f"(case when regexp_matches({x}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') then try_strptime({x}, '%Y-%m-%d')::date end)"


@query("parse_price", f"""
select row_key, {price_sql('price')} as price, coalesce({price_sql('price')}, 0.0::double) as price_or_zero, {price_sql('specialPrice')} as special_price
from ({I.SCRAPED})""")
def parse_price(spark, sf):
    return I.read(spark, sf, I.SCRAPED).select(
        "row_key", C.parse_price(F.col("price")).alias("price"),
        C.parse_price(F.col("price"), on_error=0.0).alias("price_or_zero"),
        C.parse_price(F.col("specialPrice")).alias("special_price"))


@query("check_url", f"select page_id, {url_sql('url')} as url from ({I.URLS})")
def check_url(spark, sf):
    return I.read(spark, sf, I.URLS).select("page_id", C.check_url(F.col("url")).alias("url"))


@query("split_gift", f"""
select row_key, string_split(name, ' + ')[1] as product,
       case when strpos(name, ' + ') > 0 then substr(name, strpos(name, ' + ') + 3) else 'None' end as gift
from ({I.SCRAPED})""")
def split_gift(spark, sf):
    product, gift = C.split_gift(F.col("name"))
    return I.read(spark, sf, I.SCRAPED).select("row_key", product.alias("product"), gift.alias("gift"))


@query("check_name", f"""
select row_key, {name_sql('name')} as name, {name_sql('company')} as company from ({I.SCRAPED})""")
def check_name(spark, sf):
    return I.read(spark, sf, I.SCRAPED).select(
        "row_key", C.check_name(F.col("name")).alias("name"), C.check_name(F.col("company")).alias("company"))


@query("check_name_texts", f"select conv_id, turn, {name_sql('text')} as text from conversations")
def check_name_texts(spark, sf):
    return I.read(spark, sf, "select * from conversations").select("conv_id", "turn", C.check_name(F.col("text")).alias("text"))


@query("strip_zeros", f"""
select distinct trim(ltrim(sku, '0')) as sku, (l_suppkey::double)::bigint::varchar as supplier_id from ({I.PRICES})""")
def strip_zeros(spark, sf):
    return I.read(spark, sf, I.PRICES).select(
        C.strip_zeros(F.col("sku")).alias("sku"), C.float_id(F.col("l_suppkey").cast("double")).alias("supplier_id")).distinct()


@query("replace_zone", f"""
select case when zone = 'unique' then 'Nacional' else zone end as zone, count(*) as n from ({I.SCRAPED}) group by 1""")
def replace_zone(spark, sf):
    return I.read(spark, sf, I.SCRAPED).groupBy(C.replace_zone(F.col("zone")).alias("zone")).agg(F.count("*").alias("n"))


@query("scraped_clean", f"""
select type, country, locality, date, competitor_name, competitor_sku_name || ' ' || coalesce(quantity, '') as competitor_sku_name,
       competitor_price, special_price, competitor_url, gift_or_extra_prod
from (select type, country, case when zone = 'unique' then 'Nacional' else zone end as locality, {dmy_sql('date')} as date,
             company as competitor_name, {name_sql("string_split(name, ' + ')[1]")} as competitor_sku_name, quantity,
             {price_sql('price')} as competitor_price, {price_sql('specialPrice')} as special_price, {url_sql('url')} as competitor_url,
             case when strpos(name, ' + ') > 0 then substr(name, strpos(name, ' + ') + 3) else 'None' end as gift_or_extra_prod
      from ({I.SCRAPED}))
where competitor_sku_name is not null and competitor_price is not null and date is not null""")
def scraped_clean(spark, sf):
    return scraped.clean_scraped(I.read(spark, sf, I.SCRAPED)).where("reason is null").drop("reason")


@query("scraped_rejects", f"""
select competitor_name, reason, count(*) as n
from (select company as competitor_name,
             case when {name_sql("string_split(name, ' + ')[1]")} is null then 'bad name' when {price_sql('price')} is null then 'bad price'
                  when {dmy_sql('date')} is null then 'bad date' end as reason
      from ({I.SCRAPED}))
where reason is not null group by 1, 2""")
def scraped_rejects(spark, sf):
    cleaned = scraped.clean_scraped(I.read(spark, sf, I.SCRAPED)).where("reason is not null")
    return cleaned.groupBy("competitor_name", "reason").agg(F.count("*").alias("n"))


@query("scraped_lines", f"""
select row_key, name, company, price, quantity from ({I.SCRAPED}) where company <> 'competitor_3'""")
def scraped_lines(spark, sf):
    """Rows written as separated lines and split again; the lines of one competitor have a field too many."""
    header = ["name", "company", "url", "price", "date", "zone", "type", "country", "quantity"]
    rows = I.read(spark, sf, I.SCRAPED)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in header]
    line = F.concat(F.concat_ws("<s>", *fields), F.when(F.col("company") == "competitor_3", "<s>surplus").otherwise(""))
    lines = rows.select(
        F.col("row_key").cast("string").alias("file"), F.lit("x.txt").alias("file_name"), line.alias("line"),
        F.array(*[F.lit(c) for c in header]).alias("header"))
    return scraped.split_lines(lines).where("not too_long").select(
        F.col("file").cast("bigint").alias("row_key"), "name", "company", "price", "quantity")


@query("date_formats", """
select distinct o_orderdate::date as date, strftime(o_orderdate, '%d-%m-%y') as dmy, strftime(o_orderdate, '%Y-%d-%m') as ydm,
       strftime(o_orderdate, '%d%m%Y') as ddmmyyyy from orders""")
def date_formats(spark, sf):
    date = F.col("o_orderdate").cast("date")
    return I.read(spark, sf, "select * from orders").select(
        date.alias("date"), D.to_dmy(date).alias("dmy"), D.to_ydm(date).alias("ydm"), D.to_ddmmyyyy(date).alias("ddmmyyyy")).distinct()


@query("two_format_date", f"""
select o_orderkey, coalesce({dmy_sql('text')}, {iso_sql('text')}) as date, {dmy_sql('text')} as dmy_date from ({I.DATE_TEXTS})""")
def two_format_date(spark, sf):
    return I.read(spark, sf, I.DATE_TEXTS).select(
        "o_orderkey", D.parse_two_formats(F.col("text")).alias("date"), D.parse_dmy(F.col("text")).alias("dmy_date"))


@query("week_number", """
select strftime(o_orderdate, '%U')::int as week_num, count(*) as n, min(o_orderdate::date) as first_date from orders group by 1""")
def week_number(spark, sf):
    date = F.col("o_orderdate").cast("date")
    return I.read(spark, sf, "select * from orders").groupBy(D.week_of_year(date).alias("week_num")).agg(
        F.count("*").alias("n"), F.min(date).alias("first_date"))


DATES_SQL = f"""
select date, strftime(date, '%d-%m-%y') as str_date, strftime(date, '%U')::int as week_num
from (select distinct coalesce({dmy_sql('d')}, {iso_sql('d')}) as date
      from (select substr(file_name, 1, 8) as d from ({I.FILES})))
where date is not null"""


@query("available_dates", DATES_SQL)
def available_dates(spark, sf):
    return listing.available_dates(I.read(spark, sf, I.FILES))


@query("nth_date", f"select * from ({DATES_SQL}) order by date offset 9 limit 1")
def nth_date(spark, sf):
    return listing.nth_date(listing.available_dates(I.read(spark, sf, I.FILES)), 10)


@query("file_competitors", f"""
select competitor, country, count(*) as n from (
  select replace(list_last(string_split(file_name, '-')), '.txt', '') as competitor, substr(file_name, 1, 2) as country
  from ({I.FILES}) where not contains(file_name, 'competitor_4')) group by 1, 2""")
def file_competitors(spark, sf):
    files = listing.exclude_files(I.read(spark, sf, I.FILES), "competitor_4")
    return files.groupBy(
        listing.competitor_of(F.col("file_name")).alias("competitor"),
        listing.country_of(F.col("file_name")).alias("country")).agg(F.count("*").alias("n"))


@query("text_predicates", """
select doc_id, contains(text, '√') as broken, contains(lower(text), 'tion') as has_word from documents""")
def text_predicates(spark, sf):
    return I.read(spark, sf, "select * from documents").select(
        "doc_id", C.has_broken_encoding(F.col("text")).alias("broken"), C.contains_lower(F.col("text"), "TION").alias("has_word"))


@query("price_diff_index", f"""
select sku, round(price - other, 2) as price_diff, round(round(price - other, 2) / price, 2) + 0.0::double as price_index
from (select sku, c.price, {price_sql('s.price')} as other from ({I.CATALOG}) c join ({I.SCRAPED}) s on c.sku::bigint = s.row_key)""")
def price_diff_index(spark, sf):
    own, other = I.read(spark, sf, I.CATALOG), I.read(spark, sf, I.SCRAPED).select("row_key", C.parse_price(F.col("price")).alias("other"))
    diff = C.price_diff(F.col("price"), F.col("other"))
    return own.join(other, F.col("sku").cast("bigint") == F.col("row_key")).select(
        "sku", diff.alias("price_diff"), C.price_index(diff, F.col("price")).alias("price_index"))


PRICE_ORDER = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice"
CLEAN_PRICES_SQL = f"""
select country, date, region_name, trim(ltrim(sku, '0')) as sku, sku_name, price from (
  select *, row_number() over (partition by country, date, sku, region_name order by {PRICE_ORDER}) as rn from ({I.PRICES}))
where rn = 1 and sku_name is not null and country is not null and date is not null and region_name is not null and price is not null"""


def _prices(spark, sf):
    return clean_prices(I.read(spark, sf, I.PRICES), F.col("country"), [], F.struct(*PRICE_ORDER.split(", ")))


@query("dedup_prices", CLEAN_PRICES_SQL)
def dedup_prices(spark, sf):
    return _prices(spark, sf)


@query("valid_countries", f"""
select country, country in ('MX', 'CO', 'PE', 'EC', 'PA', 'SV', 'HN') as valid, count(*) as n from ({I.PRICES}) group by 1, 2""")
def valid_countries(spark, sf):
    return I.read(spark, sf, I.PRICES).groupBy("country", checks.valid_country(F.col("country")).alias("valid")).agg(F.count("*").alias("n"))


@query("date_summary", f"""
select count(distinct date) as n_dates, min(date) as first_date, max(date) as last_date from ({I.PRICES})""")
def date_summary(spark, sf):
    return checks.date_summary(I.read(spark, sf, I.PRICES))


@query("duplicate_keys", f"""
select country, date, sku, region_name, count(*) as n from ({I.PRICES}) group by all having count(*) > 1""")
def duplicate_keys(spark, sf):
    return checks.duplicate_keys(I.read(spark, sf, I.PRICES), "country", "date", "sku", "region_name")


RECENT = "date between date '1998-06-01' - 14 and date '1998-06-01'"
NEWEST_SQL = """select country, sku, sku_name from (
  select country, sku, sku_name, row_number() over (partition by country, sku order by date desc, sku_name) as rn from ({src})) where rn = 1"""


@query("catalog_lookback", NEWEST_SQL.format(src=f"""
  select p.* from ({I.PRICES}) p semi join ({I.MASTER}) m on p.country = m.country and p.sku = m.sku
  where sku_name is not null and {RECENT}"""))
def catalog_lookback(spark, sf):
    prices = I.read(spark, sf, I.PRICES).where("sku_name is not null")
    return catalog.catalog_names(prices, I.read(spark, sf, I.MASTER), F.lit("1998-06-01").cast("date"))


@query("latest_name_per_sku", NEWEST_SQL.format(src=f"select * from ({I.PRICES}) where sku_name is not null"))
def latest_name_per_sku(spark, sf):
    return catalog.newest_names(I.read(spark, sf, I.PRICES).where("sku_name is not null"))


@query("insert_if_absent", f"""
with new as ({I.PRICES}), old as (select distinct country, date from new where region_name = 'ASIA' and l_linenumber < 3)
select country, date, sku, price from new n where not exists (select 1 from old o where o.country = n.country and o.date = n.date)""")
def insert_if_absent(spark, sf):
    new = I.read(spark, sf, I.PRICES)
    old = new.where("region_name = 'ASIA' and l_linenumber < 3")
    return tables.absent_rows(new, old).select("country", "date", "sku", "price")


@query("skip_processed", f"""
with done as (select distinct company from ({I.SCRAPED}) where url = 'short')
select file_name from ({I.FILES}) where replace(list_last(string_split(file_name, '-')), '.txt', '') not in (select company from done)""")
def skip_processed(spark, sf):
    done = I.read(spark, sf, I.SCRAPED).where("url = 'short'").select(F.col("company").alias("done")).distinct()
    files = I.read(spark, sf, I.FILES)
    return files.join(done, listing.competitor_of(F.col("file_name")) == F.col("done"), "left_anti")


@query("null_profile", f"""
select column_name, n_rows, n_not_null, n_rows - n_not_null as n_null from (
  select count(*) as n_rows, unnest(['name', 'quantity', 'specialPrice', 'url']) as column_name,
         unnest([count(name), count(quantity), count(specialPrice), count(url)]) as n_not_null from ({I.SCRAPED}))""")
def null_profile(spark, sf):
    return checks.null_profile(I.read(spark, sf, I.SCRAPED), "name", "quantity", "specialPrice", "url")


@query("omit_profile", f"""
select n_rows, n_zero, n_null, n_zero + n_null as n_omit, ((n_zero + n_null) * 100)::double / n_rows::double as pct_omit from (
  select count(*) as n_rows, count(*) filter (p <= 0) as n_zero, count(*) filter (p is null) as n_null
  from (select case when row_key % 19 = 0 then 0.0 else {price_sql('price')} end as p from ({I.SCRAPED})))""")
def omit_profile(spark, sf):
    priced = I.read(spark, sf, I.SCRAPED).select(
        F.when(F.col("row_key") % 19 == 0, 0.0).otherwise(C.parse_price(F.col("price"))).alias("p"))
    return checks.omit_profile(priced, "p")


@query("drop_unpriced", f"""
select row_key, name, {price_sql('price')} as price from ({I.SCRAPED}) where name is not null and {price_sql('price')} > 0""")
def drop_unpriced(spark, sf):
    return checks.drop_unpriced(
        I.read(spark, sf, I.SCRAPED).select("row_key", "name", C.parse_price(F.col("price")).alias("price")), "name", "price")


@query("group_counts", f"""
select company, count(*) as n, count(*) filter (url is null) as n_null_urls, count(distinct name) as n_names from ({I.SCRAPED}) group by 1""")
def group_counts(spark, sf):
    return I.read(spark, sf, I.SCRAPED).groupBy("company").agg(
        F.count("*").alias("n"), F.count_if(F.col("url").isNull()).alias("n_null_urls"), F.count_distinct("name").alias("n_names"))


@query("fill_nulls", f"""
select row_key, coalesce(url, 'Pending') as url, coalesce(quantity, '') as quantity, coalesce({price_sql('price')}, 0) as price from ({I.SCRAPED})""")
def fill_nulls(spark, sf):
    return I.read(spark, sf, I.SCRAPED).select("row_key", "url", "quantity", C.parse_price(F.col("price")).alias("price")).fillna(
        {"url": "Pending", "quantity": "", "price": 0.0})


@query("union_sources", f"""
select company as "Store", concat(name, ' ', coalesce(quantity, '')) as "Category", price as "Price", url as "Url" from ({I.SCRAPED})
union all
select 'own', concat(sku_name, ' '), price::varchar, null from ({I.CATALOG})""")
def union_sources(spark, sf):
    names = {"company": "Store", "name": "Category", "price": "Price", "quantity": "Quantity", "url": "Url"}
    shops = I.read(spark, sf, I.SCRAPED).select(*names).withColumnsRenamed(names)
    own = I.read(spark, sf, I.CATALOG).select(
        F.lit("own").alias("Store"), F.col("sku_name").alias("Category"), F.col("price").cast("string").alias("Price"))
    both = shops.unionByName(own, allowMissingColumns=True)
    return both.select("Store", C.with_quantity(F.col("Category"), F.col("Quantity")).alias("Category"), "Price", "Url")


@query("source_rules", f"""
with s as (select company, zone, {price_sql('price')} as price, {price_sql('specialPrice')} as unit_price, row_key from ({I.SCRAPED})),
g as (select company, count(*) filter (price is null) as gaps from s group by 1)
select row_key, case when gaps > 10 then 'Unit store' else s.company end as company, case when gaps > 10 then unit_price else price end as price
from s join g on s.company = g.company where s.company <> 'competitor_1' or zone = 'north'""")
def source_rules(spark, sf):
    rows = I.read(spark, sf, I.SCRAPED).select(
        "row_key", "company", "zone", C.parse_price(F.col("price")).alias("price"), C.parse_price(F.col("specialPrice")).alias("unit_price"))
    priced = delimited.price_from_unit(rows.withColumn("store", F.col("company")), "company", "price", "unit_price", limit=10, store="store", store_name="Unit store")
    kept = delimited.keep_state(priced, F.col("company") == "competitor_1", "zone", "north")
    return kept.select("row_key", F.col("store").alias("company"), "price")


@query("eval_size", f"""
select n_left, n_right, n_left * n_right as n_evals from (select count(*) as n_left from ({I.CATALOG})), (select count(*) as n_right from ({I.SCRAPED}))""")
def eval_size(spark, sf):
    return catalog.evaluation_size(I.read(spark, sf, I.CATALOG), I.read(spark, sf, I.SCRAPED))


@query("geo_mean", f"select round(exp(avg(ln(l_extendedprice))), 4) as geo_mean from lineitem")
def geo_mean(spark, sf):
    return I.read(spark, sf, "select l_extendedprice from lineitem").agg(F.round(catalog.geo_mean(F.col("l_extendedprice")), 4).alias("geo_mean"))


@query("partition_max", f"""
select sku, region_name, date, price, best from (select *, max(price) over (partition by sku) as best from ({I.PRICES})) where price = best""")
def partition_max(spark, sf):
    return catalog.with_group_max(I.read(spark, sf, I.PRICES), ["sku"], "price", "best").where("price = best").select(
        "sku", "region_name", "date", "price", "best")


@query("top_per_key", f"""
select sku, date, region_name, price from (
  select *, row_number() over (partition by sku order by price desc, date, region_name, l_orderkey, l_linenumber, l_suppkey) as rn from ({I.PRICES})) where rn = 1""")
def top_per_key(spark, sf):
    order = F.struct(-F.col("price"), "date", "region_name", "l_orderkey", "l_linenumber", "l_suppkey")
    return catalog.dedup_first(
        I.read(spark, sf, I.PRICES).select("sku", "date", "region_name", "price", "l_orderkey", "l_linenumber", "l_suppkey"), ["sku"], order
    ).select("sku", "date", "region_name", "price")


@query("row_ids", f"select count(*) as n, count(distinct (company, name, price, url)) as n_ids from ({I.SCRAPED})")
def row_ids(spark, sf):
    rows = I.read(spark, sf, I.SCRAPED).select(catalog.row_key("company", "name", "price", "url").alias("id"))
    return rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


@query("sanitized_columns", f"""
select sku, price as "c_big_store_price", sku_name as "c_big_store_sku" from ({I.CATALOG})""")
def sanitized_columns(spark, sf):
    df = I.read(spark, sf, I.CATALOG).select("sku", F.col("price").alias("c_big - store_price"), F.col("sku_name").alias("c_big store_sku"))
    return df.toDF(*[C.sanitize_name(c) for c in df.columns])


@query("sample_names", f"select * from ({I.CATALOG}) order by md5('7|' || sku), sku limit 100")
def sample_names(spark, sf):
    """A random sample of a given size."""
    return catalog.sample_rows(I.read(spark, sf, I.CATALOG), 100, "sku", seed=7)
