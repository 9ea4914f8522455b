import re

import pytest
from pyspark.sql import functions as F

from shelfmatch.functions import name_rules as R
from shelfmatch.functions import names as N

from .brute import fold

# derived by hand from the rules, stage by stage
WHOLE = [
    ("VEL ROSITA 12 PZS", "velrositavelrositavelrosita\x0312pz"),
    ("LALA LECHE LIGHT 1L - 12 PZS", "lalalalalalalalalala\x03leche light 1lt 12pz"),
    ("leche Lala deslactosada Light 12/1L", "leche lalalalalalalalalala\x03delac light 12pz 1lt"),
    ("CABRITO TEQ REPOSADO 950 +250 ML - 1 PZ", "cabritocabritocabrito\x03teq reposado 950ml 250ml"),
    ("Caja Vodka Smirnoff 12P/750M", "vodka smirnoffsmirnoffsmirnoff\x0312pz 750ml"),
    ("Jack Daniels Ginger 350 ml 24 Pieza(s)", "jack daniels ginger 350ml 24pz"),
    ("Frijol Negro Queretaro Verde Valle QUERETANO 900 g Presentación: Paquete - 20 artículo(s).", "frijol bla verdevalle 900g 20pz"),
    ("WHISKY BLACK AND WHITE 700 ML / BOTELLA", "whisky bla & whi 700ml"),
    ("Toalla grande azul", "toalla xl blu"),
    ("", ""),
    (None, None),
]


@pytest.mark.parametrize("raw, clean", WHOLE)
def test_normalize_name(apply, raw, clean):
    assert apply(N.normalize_name, [raw]) == [clean]


@pytest.mark.parametrize("raw, clean", [
    ("4 piezas", "4pz"), ("agua 355 ml", "agua 355ml"), ("2 litros", "2lt"), ("500 gramos", "500g"), ("12 onzas", "12oz"),
    ("jugo 1000ml", "jugo  1lt"), ("coca 355", "coca 355ml"), ("6 355ml", "6pz 355ml"), ("10pack", "10pz"), ("10 pack", "10pz"),
    ("2x1 jabon", "twoxone jabon"), ("agua 500ml 1pz", "agua 500ml "), ("24/150g", "24pz 150g"), ("media naranja", " naranja"),
])
def test_units(apply, raw, clean):
    assert [re.sub(" +", " ", x) for x in apply(N.homogenize_units, [raw])] == [re.sub(" +", " ", clean)]


def test_quantities(apply):
    assert apply(N.coarsen_quantities, ["355g", "355ml", "1250g", "25kg", "95ml"]) == ["300g", "350ml", "1200g", "25kg", "90ml"]


def test_specials(apply):
    texts = ["a-b|c(d)", "&apos;x", "1.5 l.", "1,5", "100% ¿'x'?!", "a–b"]
    assert apply(N.clean_specials, texts) == ["a b c d ", "x", "1.5 l ", "1.5", "100 ¿x", "a b"]


def test_accents_follow_compatibility_decomposition(apply):
    texts = ["áéíóúñü", "½ ﬁn ㎏ №5 ™", "𝐀𝐛 ﹠ ＡＢ", "ß ø đ", "¨x ´y", "ªº", "①⑳", "한글 日本", "cafe\u0301", "ǅ ŉ"]
    assert apply(N.fold_accents, texts) == [fold(t) for t in texts]


def test_stop_words(apply):
    texts = ["leche de la vaca", "sabor  a fresa", "el the los", "más mas"]
    # blanks between kept tokens stay; an accented stop word is a token like any other here
    assert apply(N.drop_stop_words, texts) == ["leche vaca", " fresa", "", "mas"]


def test_dedup_tokens(apply):
    once = apply(N.dedup_tokens, ["b a  b c a", ""])
    assert once == ["b a c", ""]
    assert apply(N.dedup_tokens, once) == once


@pytest.mark.parametrize("raw, clean", [
    ("vino cabernet", "vino tinto cbrnet"), ("cabernet", "cabernet"), ("smirnoff", "smirnoffsmirnoffsmirnoff\x03vodka"),
    ("gillette 3hx8pz", "gillette triple hoja 8pz prestobarba maquina afeitar"), ("glenlivet 12", "glenlivet 12 founders"),
    ("tequila don julio", "teq donjuliodonjuliodonjulio\x03"), ("red bull", "redbullredbullredbull\x03"), ("yogoyogo fresa", "yogo fresa"),
    ("freskaleche leche", "freskaleche"), ("santa fe", "santafe"),
])
def test_vocabulary(apply, raw, clean):
    assert apply(N.fix_vocabulary, [raw]) == [clean]


def test_brand_repeats(apply):
    names = ["lala x", "diana", "bacardi", "johnniewalker x"]
    assert apply(N.weigh_brands, names) == ["lala" * 5 + "\x03x", "diana" * 5 + "\x03", "bacardi" * 3 + "\x03", "johnniewalker" * 2 + "\x03x"]
    tidy = N.NameRules().tidy()
    assert apply(lambda c: N.weigh_brands(c, tidy), ["lala x", "pepsi cola"]) == ["lala" * 5 + " x", "pepsi" * 5 + " cola"]


def test_colors_and_sizes(apply):
    assert apply(N.homogenize_colors, ["vino blanco", "roja", "azul", "dorado x", "black label", "blackout"]) == ["vino whi", "red", "blu", "gol x", "bla label", "blackout"]
    assert apply(N.homogenize_sizes, ["largo", "grandes", "chico", "small"]) == ["xl", "xls", "xs", "xs"]


def test_rules_agree_with_another_regex_engine(apply):
    """The single-pattern tables folded with Python's engine over awkward texts."""
    texts = ["caja 12p/750m leche", "x24 pza 100's 20 cig 10pack", "a +b 950 +250ml 2 lts", "1pz 21pz pz x6", "500ml x 12", "6 355ml 12 pack u", "0.5l/24 x12g"]
    for table in (R.UNITS, R.COLORS, R.SIZES):
        expected = list(texts)
        for pattern, replacement in table:
            expected = [re.sub(pattern, re.sub(r"\$(\d)", r"\\g<\1>", replacement), t) for t in expected]
        assert apply(lambda c: N.apply_rules(c, table), texts) == expected


def test_own_normalizer(spark):
    df = spark.createDataFrame([("AbC",)], "n string")
    assert N.normalize_names(df, "n", "c", normalizer=F.lower).first().c == "abc"


def test_rules_behind_a_test_change_nothing(spark):
    """Every text gives what the rules give one after the other, and texts without a word pass no rule."""
    import random

    from pyspark.sql import functions as F

    from shelfmatch.functions import name_rules as R
    from shelfmatch.functions import names as N

    rng = random.Random(4)
    words = sorted({w for rules in (R.UNITS, R.VOCABULARY, R.COLORS, R.SIZES) for needed, _ in N.grouped(rules) for w in needed or ()} | set(R.BRANDS))
    words += ["leche", "12", "355ml", "a", "1lt", "s", "negra", "rojo", "x6", "pz", "verde valle", "queretaro", "teq 1800"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 7))) for _ in range(1500)] + ["", " ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    names = N.NameRules()
    for rules in (R.UNITS, R.VOCABULARY, R.COLORS, R.SIZES):
        plain = F.col("t")
        for rule in rules:
            plain = N._apply(plain, [rule], names)
        assert df.where(~N.apply_rules(F.col("t"), rules, names).eqNullSafe(plain)).isEmpty()


def test_needed_words():
    from shelfmatch.functions.names import needed_words

    assert needed_words(r"(\s|^)(comida|alimento)(\s|$)") == {"comida", "alimento"}
    assert needed_words(r"(\s|^)estandar|standard(\s|$)") == {"estandar", "standard"}
    assert needed_words(r"(\s|^)(agua )*(santa maria)(\s|$)") == {"santa maria"}
    assert needed_words(r"(promo)?(\s|$)") is None
    assert needed_words(r"(\d|\s|^)(p|pieza)(\s|$)") is None
    assert needed_words(r"(?<n>\d)\d(ml)") is None
