"""Inputs of the registered queries, derived from the given tables.

The statements use the SQL that Spark and DuckDB share, so both sides of a check
read the same rows.  All of them run over whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from shelfmatch.functions.names import spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# own catalogue: one product per part, units in every name
CATALOG = """
select lpad(cast(p_partkey as string), 8, '0') as sku,
       concat(case p_type when 'ECONOMY' then 'REFRESCO' when 'STANDARD' then 'CERVEZA CLASICA' when 'PROMO' then 'TEQUILA JOSE CUERVO'
                          when 'SMALL' then 'AGUA SANTA MARIA' when 'MEDIUM' then 'LECHE LALA' else 'WHISKY JOHNNIE WALKER' end,
              ' ', upper(p_name), ' ', cast(p_size * 25 as string), 'ML - ', cast(1 + p_partkey % 24 as string), ' PZS') as sku_name,
       p_retailprice as price
from part
"""

# scrape lists: every part at one of five competitors, other notations of count and volume
SCRAPED = """
select p_partkey as row_key,
       'online' as type, 'MX' as country,
       case when p_partkey % 4 = 0 then 'unique' else 'north' end as zone,
       concat(lpad(cast(1 + p_partkey % 28 as string), 2, '0'), case when p_partkey % 17 = 0 then '/' else '-' end, '01-26') as date,
       concat('competitor_', cast(p_partkey % 5 as string)) as company,
       concat(case p_type when 'ECONOMY' then 'Refresco' when 'STANDARD' then 'Cerveza Clásica' when 'PROMO' then 'Teq. Cuervo Tradicional'
                          when 'SMALL' then 'Agua Natural Santa María' when 'MEDIUM' then 'Lala Leche Entera' else 'Johnnie Walker Whisky' end,
              ' ', p_name, ' ',
              case p_partkey % 4 when 0 then concat(cast(p_size * 25 as string), ' ml Presentación: Caja ', cast(1 + (p_partkey * 7) % 24 as string), ' Artículo(s)')
                                 when 1 then concat(cast(1 + (p_partkey * 7) % 24 as string), 'P/', cast(p_size * 25 as string), 'M')
                                 when 2 then concat(cast(p_size * 25 as string), ' Mililitros con ', cast(1 + (p_partkey * 7) % 24 as string), ' piezas')
                                 else concat(cast(p_size * 25 as string), 'ML') end,
              case when p_partkey % 10 = 0 then ' + vaso de regalo' else '' end) as name,
       case when p_partkey % 6 = 0 then cast(1 + p_partkey % 3 as string) end as quantity,
       case when p_partkey % 13 = 0 then 'n.d.' else concat('$', cast(cast(floor(p_retailprice * 97) as double) / cast(100 as double) as string), ' c/u') end as price,
       case when p_partkey % 3 = 0 then concat('$', cast(cast(floor(p_retailprice * 90) as double) / cast(100 as double) as string)) end as specialPrice,
       case p_partkey % 5 when 0 then concat('shop.example.com/p/', cast(p_partkey as string)) when 1 then 'short' when 2 then cast(null as string)
                          else concat('https://shop.example.com/p/', cast(p_partkey as string)) end as url
from part
"""

# price history: a price per country, day, region and part, with repeated keys
PRICES = """
select case when n_nationkey % 3 = 0 then 'MX' when n_nationkey % 3 = 1 then 'CO' else 'XX' end as country,
       cast(o_orderdate as date) as date, r_name as region_name,
       lpad(cast(p_partkey as string), 8, '0') as sku,
       case when l_linenumber = 7 then cast(null as string) else concat(p_name, ' ', lower(l_returnflag)) end as sku_name,
       floor(l_extendedprice / l_quantity * 100) / 100 as price,
       l_orderkey, l_linenumber, l_suppkey, l_extendedprice
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
     join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey
"""

# own products the master catalogue lists
MASTER = """
select case when s_nationkey % 2 = 0 then 'MX' else 'CO' end as country, lpad(cast(l_partkey as string), 8, '0') as sku
from lineitem join supplier on l_suppkey = s_suppkey
where l_quantity > 25
"""

# labels with a score
EVAL = """
select d.doc_id, l.quality as label, cast(1000 - floor(abs(n_chars - 2000) / 20) as double) / 1000 as score
from documents d join labels l on d.doc_id = l.doc_id
"""

# addresses: scheme missing, too short
URLS = """
select page_id,
       case when page_id % 3 = 0 then regexp_replace(url, '^https?://', '') when page_id % 11 = 0 then 'short' else url end as url
from pages
"""

# already normalised pairs: every part with itself in another notation, and with another part
PAIRS = """
select 'same' as kind, p_partkey as k,
       concat(lower(p_type), ' ', p_name, ' ', cast(p_size * 25 as string), 'ml ', cast(1 + p_partkey % 24 as string), 'pz') as a,
       concat(p_name, ' ', lower(p_type), ' ', cast(1 + (p_partkey * 7) % 24 as string), 'pz') as b
from part
union all
select 'other', x.p_partkey,
       concat(lower(x.p_type), ' ', x.p_name, ' ', cast(x.p_size * 25 as string), 'ml'),
       concat(lower(y.p_type), ' ', y.p_name, ' ', cast(y.p_size * 25 as string), 'ml')
from part x join part y on y.p_partkey = (x.p_partkey * 13 + 7) % (select count(*) from part)
"""

# raw pairs for the whole path from names to confidence
RAW_PAIRS = f"select c.sku as k, c.sku_name as a, s.name as b from ({CATALOG}) c join ({SCRAPED}) s on cast(c.sku as bigint) = s.row_key"

# file names of scrapes, in two date formats
FILES = """
select concat(case when o_orderkey % 2 = 0
                   then concat(lpad(cast(day(o_orderdate) as string), 2, '0'), '-', lpad(cast(month(o_orderdate) as string), 2, '0'), '-', substring(cast(year(o_orderdate) as string), 3, 2))
                   else concat(cast(year(o_orderdate) as string), '-', cast(month(o_orderdate) % 9 + 1 as string), '-', cast(day(o_orderdate) % 9 + 1 as string)) end,
              '_store-competitor_', cast(o_custkey % 5 as string), '.txt') as file_name
from orders
"""

# dates as text in the two formats, and text that is none
DATE_TEXTS = """
select o_orderkey,
       case o_orderkey % 4
            when 0 then concat(lpad(cast(day(o_orderdate) as string), 2, '0'), '-', lpad(cast(month(o_orderdate) as string), 2, '0'), '-', substring(cast(year(o_orderdate) as string), 3, 2))
            when 1 then concat(cast(year(o_orderdate) as string), '-', lpad(cast(month(o_orderdate) as string), 2, '0'), '-', lpad(cast(day(o_orderdate) as string), 2, '0'))
            when 2 then concat('31-', lpad(cast(month(o_orderdate) as string), 2, '0'), '-', substring(cast(year(o_orderdate) as string), 3, 2))
            else o_orderpriority end as text
from orders
"""


def read(spark: SparkSession, sf_dir: str, sql: str, dealt: bool = False) -> DataFrame:
    """The result of one of the statements over the tables in ``sf_dir``.

    ``dealt``: rows are dealt over all cores before the statement, for one that is heavy per row; a small file of very many
    short rows would otherwise be read, and worked on, by one task or two.
    """
    for table in TABLES:
        if re.search(rf"\b(from|join)\s+{table}\b", sql):
            rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            (spread(rows) if dealt else rows).createOrReplaceTempView(table)
    return spark.sql(sql)
