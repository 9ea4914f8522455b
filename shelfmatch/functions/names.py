"""Name normalisation as one Column expression.

The stages run in a fixed order (``normalize_name``); every stage is also
usable alone.  All of them are built-in expressions, so nothing leaves the JVM.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from dataclasses import dataclass, field, replace
from weakref import WeakKeyDictionary

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import name_rules as R
from .binding import let
from .stop_words import spanish


@dataclass(frozen=True)
class NameRules:
    """The tables behind ``normalize_name``; replace any of them for another vocabulary."""

    special: list = field(default_factory=lambda: R.SPECIAL)
    units: list = field(default_factory=lambda: R.UNITS)
    quantities: list = field(default_factory=lambda: R.QUANTITIES)
    vocabulary: list = field(default_factory=lambda: R.VOCABULARY)
    colors: list = field(default_factory=lambda: R.COLORS)
    sizes: list = field(default_factory=lambda: R.SIZES)
    brands: list = field(default_factory=lambda: R.BRANDS)
    brand_joint: str = R.BRAND_JOINT
    stop_words: list | None = None

    def tidy(self) -> NameRules:
        """The same rules with two known slips put right: the blank behind a
        weighted brand is kept, and the misspelt brand is spelt ``pepsi``."""
        brands = ["pepsi" if b == "pepse" else b for b in self.brands]
        return replace(self, brands=brands, brand_joint=" ")

    def all_stop_words(self) -> list[str]:
        words = self.stop_words
        if words is None:
            words = spanish()
        return list(words) + R.EXTRA_STOP_WORDS


#: Rules behind one test for the words they need.
GUARDED = 10
#: Letters that a word must have to be tested for; shorter ones are in most names.
TELLING = 3


def needed_words(pattern: str) -> set[str] | None:
    """Texts of which every match of a pattern contains one; None if it has no such texts of ``TELLING`` letters."""
    try:
        from re import _constants as op
        from re import _parser

        tree = _parser.parse(pattern)
    except (ImportError, re.error):  # a pattern of another dialect, or another Python: the rule goes without a test
        return None

    def needs(items) -> set[str] | None:
        found, run = [], ""
        for kind, value in [*items, (None, None)]:
            if kind is op.LITERAL:
                run += chr(value)
                continue
            if run:
                found.append({run})
                run = ""
            if kind is op.SUBPATTERN:
                found.append(needs(value[3]))
            elif kind is op.MAX_REPEAT and value[0] > 0:
                found.append(needs(value[2]))
            elif kind is op.BRANCH:
                parts = [needs(branch) for branch in value[1]]
                found.append(None if None in parts else set().union(*parts))
        return max((f for f in found if f), key=lambda f: min(map(len, f)), default=None)

    words = needs(tree)
    return words if words and min(map(len, words)) >= TELLING else None


def grouped(rules: list) -> list[tuple[set[str] | None, list]]:
    """The rules in order, neighbouring ones that need a word together: (the words, up to ``GUARDED`` rules)."""
    out: list[tuple[set[str] | None, list]] = []
    for rule in rules:
        words = needed_words(rule[0]) if type(rule) is tuple else None
        if words and out and out[-1][0] and len(out[-1][1]) < GUARDED:
            out[-1][0].update(words)
            out[-1][1].append(rule)
        else:
            out.append((words, [rule]))
    return out


def apply_rules(col: Column, rules: list, names: NameRules | None = None) -> Column:
    """Fold a rule table over a column, in table order.

    Neighbouring rules that need a word stand behind one test for all these words.  Where a text has none of them the first
    rule leaves it as it is, and so every other one finds it as it was: skipping them changes nothing.
    """
    for words, some in grouped(rules):
        if words and len(some) > 1:
            col = _if_any(col, words, lambda v, some=some: _apply(v, some, names))
        else:
            col = _apply(col, some, names)
    return col


def _if_any(col: Column, words, change) -> Column:
    """``change`` where the text contains one of the words."""
    test = "|".join(sorted(re.escape(w) for w in words))
    return let(col, lambda v: F.when(v.rlike(test), change(v)).otherwise(v))


def _apply(col: Column, rules: list, names: NameRules | None = None) -> Column:
    names = names or NameRules()
    for rule in rules:
        match rule:
            case R.When(word, inner):
                col = _guarded(col, word, inner, names)
            case R.Add(text):
                col = F.concat(col, F.lit(text))
            case R.Text(old, new):
                col = F.replace(col, F.lit(old), F.lit(new))
            case R.Dedup():
                col = dedup_tokens(col)
            case R.Weight():
                col = weigh_brands(col, names)
            case (pattern, replacement):
                col = F.regexp_replace(col, pattern, replacement)
    return col


def _guarded(col: Column, word: str, rules: list, names: NameRules) -> Column:
    def step(v: Column) -> Column:
        return F.when(v.contains(word), apply_rules(v, rules, names)).otherwise(v)

    return let(col, step)


def squeeze(col: Column) -> Column:
    """ASCII white space to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(col, r"[\t-\r\x1c-\x1f ]{2,}|[\t-\r\x1c-\x1f]", " "))


def clean_specials(col: Column, names: NameRules | None = None) -> Column:
    return apply_rules(col, (names or NameRules()).special, names)


@functools.lru_cache(maxsize=1)
def _ascii_folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions with an ASCII part: single characters, and longer ones."""
    single_from, single_to, longer = [], [], {}
    for code in range(0x80, 0x110000):
        ch = chr(code)
        if not unicodedata.decomposition(ch):
            continue
        ascii_part = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(ascii_part) == 1:
            single_from.append(ch)
            single_to.append(ascii_part)
        elif ascii_part:
            longer[ch] = ascii_part
    return "".join(single_from), "".join(single_to), longer


def _ranges(chars) -> str:
    """Inside of a character class: neighbouring code points as ranges."""
    codes = set(map(ord, chars))
    starts = sorted(c for c in codes if c - 1 not in codes)
    ends = sorted(c for c in codes if c + 1 not in codes)
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends))


def fold_accents(col: Column) -> Column:
    """Compatibility decomposition, then everything outside ASCII dropped."""
    single_from, single_to, longer = _ascii_folding()
    table = F.from_json(F.lit(json.dumps(longer)), "map<string,string>")
    # the look-ahead keeps ASCII characters away from the long class
    any_longer = r"(?=[^\x00-\x7F])[" + _ranges(longer) + "]"

    def expand(text: Column) -> Column:
        chars = F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c))
        return F.when(text.rlike(any_longer), F.array_join(chars, "")).otherwise(text)

    def fold(text: Column) -> Column:
        translated = F.translate(text, single_from, single_to)
        expanded = let(translated, expand)
        ascii_only = F.regexp_replace(expanded, r"[^\x00-\x7F]+", "")
        return F.when(text.rlike(r"[^\x00-\x7F]"), ascii_only).otherwise(text)

    return let(col, fold)


def homogenize_units(col: Column, names: NameRules | None = None) -> Column:
    return apply_rules(col, (names or NameRules()).units, names)


def coarsen_quantities(col: Column, names: NameRules | None = None) -> Column:
    return apply_rules(col, (names or NameRules()).quantities, names)


def drop_stop_words(col: Column, names: NameRules | None = None) -> Column:
    """Tokens (split on single blanks) that are stop words go; the blanks between the others stay."""
    stop = (names or NameRules()).all_stop_words()
    # a list of literals becomes a hash set
    kept = F.filter(F.split(col, " ", -1), lambda w: ~w.isin(stop))
    return F.array_join(kept, " ")


def dedup_tokens(col: Column) -> Column:
    """First occurrence of every token, in order."""
    return F.array_join(F.array_distinct(F.split(squeeze(col), " ")), " ")


def weigh_brands(col: Column, names: NameRules | None = None) -> Column:
    names = names or NameRules()

    def weigh(v: Column) -> Column:
        for brand in names.brands:
            times = next(n for longest, n in R.BRAND_REPEATS if longest is None or len(brand) <= longest)
            v = F.regexp_replace(v, rf"(\s|^)({brand})(\s|$)", "$1" + brand * times + names.brand_joint)
        return v

    return _if_any(col, names.brands, weigh)


def fix_vocabulary(col: Column, names: NameRules | None = None) -> Column:
    names = names or NameRules()
    return apply_rules(col, names.vocabulary, names)


def homogenize_colors(col: Column, names: NameRules | None = None) -> Column:
    return apply_rules(col, (names or NameRules()).colors, names)


def homogenize_sizes(col: Column, names: NameRules | None = None) -> Column:
    return apply_rules(col, (names or NameRules()).sizes, names)


def normalize_name(col: Column, names: NameRules | None = None) -> Column:
    """Product name to its normalised form; null stays null."""
    names = names or NameRules()
    col = F.lower(F.trim(col))
    col = clean_specials(col, names)
    col = fold_accents(col)
    col = squeeze(col)
    col = homogenize_units(col, names)
    col = coarsen_quantities(col, names)
    col = drop_stop_words(col, names)
    col = fix_vocabulary(col, names)
    col = dedup_tokens(col)
    col = homogenize_colors(col, names)
    return homogenize_sizes(col, names)


_default_normalizer: WeakKeyDictionary = WeakKeyDictionary()


def _normalized_text() -> Column:
    """``normalize_name`` of the column ``_text``, built once per Spark context: some
    two hundred expressions take longer to build than to plan."""
    sc = SparkContext._active_spark_context
    if sc not in _default_normalizer:
        _default_normalizer[sc] = normalize_name(F.col("_text"))
    return _default_normalizer[sc]


def normalize_names(df, source: str, target: str, rules: NameRules | None = None, normalizer=None):
    """Add ``target``, the normalised ``source``.  ``normalizer`` may be any Column -> Column."""
    if normalizer is not None or rules is not None:
        fn = normalizer or (lambda c: normalize_name(c, rules))
        return df.withColumn(target, fn(F.col(source)))
    return df.withColumn("_text", F.col(source)).withColumn(target, _normalized_text()).drop("_text")


def spread(df, *keys: str):
    """Over all cores: adaptive execution would put few small rows into one task,
    but what follows is heavy per row."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def distinct_texts(df, source: str):
    """The distinct texts of a column, spread for the work per text that follows."""
    return spread(df.select(source).where(F.col(source).isNotNull()).distinct(), source)
