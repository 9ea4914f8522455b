"""Queries over name normalisation, units and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmatch.functions import name_rules as R
from shelfmatch.functions import names as N
from shelfmatch.functions import similarity as S
from shelfmatch.functions.lcs import indel_percent, lcs_length
from shelfmatch.functions.similarity import Scoring
from shelfmatch.operators import evaluation

from . import duck as D
from . import inputs as I

SPARK, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


DOCUMENTS = "select doc_id, text from documents"
NAMES = f"select row_key as id, name from ({I.SCRAPED}) union all select 1000000000 + cast(sku as bigint), sku_name from ({I.CATALOG})"


def _names(spark, sf):
    return I.read(spark, sf, NAMES)


@query("normalize_basic", f"""
with t as (select doc_id, unnest(string_split({D.squeeze(D.fold_accents("lower(trim(text))"))}, ' ')) as w, generate_subscripts(string_split({D.squeeze(D.fold_accents("lower(trim(text))"))}, ' '), 1) as i from documents),
f as (select doc_id, w, min(i) as i from t group by 1, 2)
select doc_id, string_agg(w, ' ' order by i) as text from f group by 1""")
def normalize_basic(spark, sf):
    """Lower case, accents, white space and repeated tokens of whole texts."""
    text = N.dedup_tokens(N.squeeze(N.fold_accents(F.lower(F.trim(F.col("text"))))))
    return N.spread(I.read(spark, sf, DOCUMENTS)).select("doc_id", text.alias("text"))


@query("normalize_specials", D.chain(DOCUMENTS, "text", D.steps(R.SPECIAL)).replace("select * from s1", "select doc_id, x as text from s1"))
def normalize_specials(spark, sf):
    return I.read(spark, sf, DOCUMENTS).select("doc_id", N.clean_specials(F.col("text")).alias("text"))


@query("normalize_stopwords", f"select doc_id, {D.drop_stop_words('lower(text)')} as text from documents")
def normalize_stopwords(spark, sf):
    return I.read(spark, sf, DOCUMENTS).select("doc_id", N.drop_stop_words(F.lower("text")).alias("text"))


def _stage(name: str, expressions: list[str], fn):
    chained = D.chain(NAMES, f"{D.squeeze(D.fold_accents('lower(name)'))}", expressions)
    SQL[name] = f"select id, x as name from ({chained})"

    def run(spark, sf):
        names = _names(spark, sf)
        # each distinct name once, over all cores: a small file of many names is one task
        texts = N.distinct_texts(names, "name").withColumn("staged", fn(N.squeeze(N.fold_accents(F.lower("name")))))
        return names.join(texts, "name", "left").select("id", F.col("staged").alias("name"))

    run.__name__ = name
    SPARK[name] = run


_stage("normalize_units", D.steps(R.UNITS), N.homogenize_units)
_stage("normalize_quantity", D.steps(R.QUANTITIES), N.coarsen_quantities)
_stage("normalize_brands", D.steps(R.VOCABULARY), N.fix_vocabulary)
_stage("normalize_colors", D.steps(R.COLORS), N.homogenize_colors)
_stage("normalize_sizes", D.steps(R.SIZES), N.homogenize_sizes)


@query("normalize_name", f"select id, x as name from ({D.normalize(NAMES, 'name')})")
def normalize_name(spark, sf):
    return N.normalize_names(N.spread(_names(spark, sf)), "name", "name").select("id", "name")


@query("normalize_texts", f"select conv_id, turn, x as text from ({D.normalize('select conv_id, turn, text from conversations', 'text')})")
def normalize_texts(spark, sf):
    """Whole conversation turns through every stage."""
    return I.read(spark, sf, "select conv_id, turn, text from conversations").select("conv_id", "turn", N.normalize_name(F.col("text")).alias("text"))


def _pairs(spark, sf):
    return I.read(spark, sf, I.PAIRS)


@query("unit_extract", f"select kind, k, array_to_string({D.units('a')}, '|') as a_units, len({D.units('b')})::int as n_b_units from ({I.PAIRS})")
def unit_extract(spark, sf):
    return _pairs(spark, sf).select("kind", "k", F.array_join(S.extract_units(F.col("a")), "|").alias("a_units"), F.size(S.extract_units(F.col("b"))).alias("n_b_units"))


@query("unit_remove", f"select kind, k, {D.base('a')} as a, {D.base('b')} as b from ({I.PAIRS})")
def unit_remove(spark, sf):
    return _pairs(spark, sf).select("kind", "k", S.remove_units(F.col("a")).alias("a"), S.remove_units(F.col("b")).alias("b"))


@query("token_sort", f"select kind, k, {D.token_sort('a')} as a, {D.token_sort('b')} as b from ({I.PAIRS})")
def token_sort(spark, sf):
    return _pairs(spark, sf).select("kind", "k", S.token_sort(F.col("a")).alias("a"), S.token_sort(F.col("b")).alias("b"))


@query("lcs_ratio", f"select kind, k, lcs::int as lcs, {D.percent('lcs', 'length(a)', 'length(b)')}::int as percent from ({D.lcs(I.PAIRS, 'a', 'b')})")
def lcs_ratio(spark, sf):
    a, b = F.col("a"), F.col("b")
    return _pairs(spark, sf).select("kind", "k", lcs_length(a, b).alias("lcs"), indel_percent(a, b).alias("percent"))


SORTED_PAIRS = f"select kind, k, {D.token_sort('a')} as sa, {D.token_sort('b')} as sb from ({I.PAIRS})"


@query("token_sort_ratio", f"""
select kind, k, {D.percent('lcs', 'length(sa)', 'length(sb)')}::int as percent,
       (100 - {D.percent('lcs', 'length(sa)', 'length(sb)')}) * 0.01::double as distance from ({D.lcs(SORTED_PAIRS, 'sa', 'sb')})""")
def token_sort_ratio(spark, sf):
    pairs = _pairs(spark, sf).withColumn("percent", S.token_sort_ratio(F.col("a"), F.col("b")))
    return pairs.select("kind", "k", "percent", S.percent_to_distance(F.col("percent")).alias("distance"))


@query("dice_chars", f"select kind, k, {D.dice(D.chars('a'), D.chars('b'))} as dice from ({I.PAIRS})")
def dice_chars(spark, sf):
    return _pairs(spark, sf).select("kind", "k", S.dice_distance(F.col("a"), F.col("b")).alias("dice"))


@query("jaccard_lists", f"select kind, k, {D.jaccard(D.units('a'), D.units('b'))} as jaccard from ({I.PAIRS})")
def jaccard_lists(spark, sf):
    return _pairs(spark, sf).select("kind", "k", S.jaccard_similarity(S.extract_units(F.col("a")), S.extract_units(F.col("b"))).alias("jaccard"))


@query("unit_jaccard", f"select kind, k, {D.unit_dist('ua', 'ub')} as unit_distance from (select *, {D.units('a')} as ua, {D.units('b')} as ub from ({I.PAIRS}))")
def unit_jaccard(spark, sf):
    return _pairs(spark, sf).select("kind", "k", S.unit_distance(F.col("a"), F.col("b")).alias("unit_distance"))


@query("combined_distance", f"select kind, k, round(1 - close, 9) as distance from ({D.scored_pairs(I.PAIRS)})")
def combined_distance(spark, sf):
    return _pairs(spark, sf).select("kind", "k", F.round(1 - (1 - S.combined_distance(F.col("a"), F.col("b"))), 9).alias("distance"))


@query("confidence", f"select kind, k, {D.confidence('close', 'udist')} as confidence from ({D.scored_pairs(I.PAIRS)})")
def confidence(spark, sf):
    return _pairs(spark, sf).select("kind", "k", S.confidence(F.col("a"), F.col("b")).alias("confidence"))


@query("confidence_first_version", f"select kind, k, {D.confidence('close', 'udist', 0.1, 1.1, 2)} as confidence from ({D.scored_pairs(I.PAIRS)})")
def confidence_first_version(spark, sf):
    return _pairs(spark, sf).select("kind", "k", S.confidence(F.col("a"), F.col("b"), Scoring.first_version()).alias("confidence"))


@query("calibration", """
select label, score, case when score <= 0 then 0.0::double else round(exp(1 - 1 / pow(score, 1.02::double)), 9) end as value
from (""" + I.EVAL + ")")
def calibration(spark, sf):
    return I.read(spark, sf, I.EVAL).select("label", "score", F.round(S.calibrate(F.col("score")), 9).alias("value"))


NORMAL_PAIRS = f"""
select r.k, r.a, r.b, na.x as a_clean, nb.x as b_clean from ({I.RAW_PAIRS}) r
join ({D.normalize(f'select distinct a from ({I.RAW_PAIRS})', 'a')}) na on na.a = r.a
join ({D.normalize(f'select distinct b from ({I.RAW_PAIRS})', 'b')}) nb on nb.b = r.b"""


@query("pair_explain", f"""
select k, a, b, a_clean, b_clean, round(close, 2) as lvd_conf, round(1 - udist, 2) as jac_conf, {D.confidence('close', 'udist')} as comb_conf,
       array_to_string(ua, '|') as a_units, array_to_string(ub, '|') as b_units
from ({D.scored_pairs(NORMAL_PAIRS, 'a_clean', 'b_clean')})""")
def pair_explain(spark, sf):
    explained = evaluation.explain_pairs(N.spread(I.read(spark, sf, I.RAW_PAIRS)), "a", "b")
    return explained.withColumns({"a_units": F.array_join("a_units", "|"), "b_units": F.array_join("b_units", "|")})


EXPECTED = f"select k as own_key, a as own_name, b as competitor_name, cast(k as bigint) % 11 / cast(10 as double) as expected, case cast(k as bigint) % 3 when 0 then '<=' when 1 then '>=' else '==' end as op from ({I.RAW_PAIRS})"


@query("expectation_check", f"""
select k as own_key, conf as confidence, case op when '==' then conf = expected when '<=' then conf <= expected else conf >= expected end as passed
from (select k, {D.confidence('close', 'udist')} as conf, k::bigint % 11 / 10.0::double as expected,
             case k::bigint % 3 when 0 then '<=' when 1 then '>=' else '==' end as op
      from ({D.scored_pairs(NORMAL_PAIRS, 'a_clean', 'b_clean')}))""")
def expectation_check(spark, sf):
    return evaluation.check_expected(N.spread(I.read(spark, sf, EXPECTED))).select("own_key", "confidence", "passed")
