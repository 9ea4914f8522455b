"""Rule tables of the product-name vocabulary (Spanish retail).

Everything in this file is a fixed value: changing a pattern, a replacement or
the order changes the normalised names and with them every confidence.

A rule is one of

* ``(pattern, replacement)``   replace all matches, ``$n`` is a group;
* ``Text(old, new)``           replace a literal text;
* ``Add(text)``                append a text;
* ``When(word, [rules])``      apply the rules where the name contains the word;
* ``Dedup()``                  keep the first of equal tokens;
* ``Weight()``                 repeat the brands of ``BRANDS``.
"""

from __future__ import annotations

from typing import NamedTuple


class Text(NamedTuple):
    old: str
    new: str


class Add(NamedTuple):
    text: str


class When(NamedTuple):
    word: str
    rules: list


class Dedup(NamedTuple):
    pass


class Weight(NamedTuple):
    pass


# Special characters, before accents are dropped.  (?U) because the
# text may still hold digits and letters of any script here.
SPECIAL = [
    (r"[(|)|-|–|-]", " "),
    (r"&apos;", ""),
    (r"(?U)(\d+)\.(\d+)", "$1#$2"),
    (r"[·|•|'|\"|®|*|:|%|!|\?]", ""),
    (r"\.", " "),
    (r"(?U)(\d+)#(\d+)", "$1.$2"),
    (r"(?U)(\d+),(\d+)", "$1.$2"),
]

# Measure units and pack counts.
UNITS = [
    (r"(\d|\s|^)(p|zk|pieza|pzas|articulo|unidades|rollo|unid|c/u|cajetilla|unidad|und|pza|pzs|pk|botella|bo|bulto|lata|laton|charola)[s|\(s\)]?(\s|$|/)", "$1pz$3"),
    (r"(box|paquete|empaque|multiempaque|pack|cja|cj|caja|bolsa|bolsa|vaso)[s]?(\s|$)", "pz$2"),
    (r"(duopz|duopk)", "2pz"),
    (r"([\d*|\s])cig(\s|$)", "$1pz$2"),
    (r"(^| )and( |$)", "$1&$2"),
    (r"(^| )(etiqueta|label|surtidos|pet|rep100%|tetra|display|familiar)( |$)", "$1$3"),
    (r"(\s|^)media|cuart[o|a]|garrafa(\s|$)", "$1$2"),
    (r"presentacion", ""),
    (r"([\d|\s])ct(\s|$)", "$1pz$2"),
    (r"([\d|\s])u[n]?(\s|$)", "$1pz$2"),
    (r"([\d]+)\s(pack)", "$1pz"),
    (r"(bebida( alcoholica)*)", ""),
    (r"(\s|[\d]+)(mls|mililitros|m)(/|-|\s|$)", "$1ml$3"),
    (r"([\d|\s])(l)(x|/|-|\s|$)", "$1lt$3"),
    (r"([\d|\s])(lts|litros|litro|l)(/|-|\s|$)", "$1lt$3"),
    (r"(onzas|onza|oza|onz)(/|-|\s|$)", "oz"),
    (r"(\s|[\d]+)(g|gramos|gs|gr|grs|gramo)(/|-|\s|$)", "$1g$3"),
    (r"([\d]+)\s(ml|pz|g|kg|lt|oz)", "$1$2"),
    (r"([\d]+)[\s]+[\+]([\d]+)ml", "$1ml $2ml"),
    (r"(\s|^)2x1(\s|$)", "$1twoxone$2"),
    (r"([\d]{3,}$)", "$1ml"),
    (r"(1000ml|\slt)(\s|$)", " 1lt$2"),
    (r"(6|12|24|36)\s(\d{1,4}[ml|g])", "$1pz $2"),
    (r"([\d]+)(/|x| x )", "$1pz "),
    (r"(\b[\d]+)(g|ml|lt|l)(x|/|\s)", "$1$2 "),
    (r"([\d]+(:?ml|lt|g)?[\s]?)[\s]?[/|x][\s]?([\d]+)\b", "$1$3pz"),
    (r"(\bx)(\d+)(g|ml|pz)(\b)", "$2$3$4"),
    (r"\bpz x(\d+)\b", "$1pz"),
    (r"(\s|1|^)pz(\s|$)", " "),
    (r"(^| )[a-z]( |$)", "$1$2"),
    (r"/", " "),
]

# Grams to the hundred below, millilitres to the ten below.
QUANTITIES = [
    (r"(?<n>\d)\d{2}(g)", "${n}00g"),
    (r"(?<n>\d)\d(ml)", "${n}0ml"),
]

# Words dropped on top of the Spanish stop-word list.
EXTRA_STOP_WORDS = ["the", "sabor", "bisabor", "sabores", "saborizada"]

# Brands whose name is repeated to weigh more.
BRANDS = [
    "caribecooler", "velrosita", "lala", "grancentenario", "mezcalito", "alpura",
    "campoazul", "cabrito", "aztecaoro", "bacardi", "jimador", "donjulio", "npv",
    "pepse", "vitaloe", "vodkaskyyblue", "johnniewalker", "smirnoff", "cuervo",
    "jumex", "presidente", "sauzahacienda", "boing", "colgate", "redbull",
    "santamaria", "electrolit", "loltun", "nescafe", "klim", "antioqueno",
    "medellin", "diana",
]

# Fixed values: (longest name, repetitions); longer names take the last one.
BRAND_REPEATS = [(5, 5), (10, 3), (None, 2)]

# Fixed value: what takes the place of the blank behind a repeated brand.  The
# published results carry this control character, so it stays the default.
BRAND_JOINT = "\x03"

# Product classes, flavours, brand spellings.
VOCABULARY = [
    (r"([aeioumn])s($|\s)", "$1$2"),
    (r"(mexico)", ""),
    (r"(\s|^)(suero rehidratante)(\s|$)", "$1$3"),
    (r"(\s|^)(suero)(\s|$)", "$1$3"),
    (r"(\s|^)(vidrio)(\s|$)", "$1$3"),
    (r"(\s|^)es[s]?en[c|t]ial(\s|$)", "$1esencial$2"),
    (r"(\s|^)(comida|alimento)(\s|$)", "$1$3"),
    (r"(\s|^)(humed[o|a])(\s|$)", "$1$3"),
    (r"(\s|^)(hidratante)(\s|$)", "$1$3"),
    (r"(\s|^)(pasaboca|botana|dulce|chicle|gomita|condon[e]?)(\s|$)", "$1$3"),
    (r"(\s|^)(clasic[o|a])(\s|$)", "$1cls$3"),
    (r"(\s|^)(fortificad[o|a])(\s|$)", "$1frt$3"),
    (r"(\s|^)(sin azucar|sinaz)(\s|$)", "$1sa$3"),
    (r"(\s|^)(deslactosada|deslact)(\s|$)", "$1delac$3"),
    (r"(\s|^)(adulto)(\s|$)", "$1adlt$3"),
    (r"carne[\re]?", "re"),
    (r"(\s|^)(energ[a-z]+)(\s|$)", "$1$3"),
    (r"(\s|^)(cigarro|cig)(\s|$)", "$1$3"),
    (r"(\s|^)tequila(\s|$)", "$1teq$2"),
    (r"(\s|^)whiskey(\s|$)", "$1whisky$2"),
    (r"(\s|^)brandy(\s|$)", "$1brdy$2"),
    (r"(\s|^)aceite(\s|$)", "$1ace$2"),
    (r"(\s|^)ace soya(\s|$)", "$1ace$2"),
    (r"(\s|^)morena(\s|$)", "$1mrn$2"),
    (r"(\s|^)promo(\s|$)", "$1$2"),
    (r"(\s|^)fresh(\s|$)", "$1fsh$2"),
    (r"(\s|^)tradicion(al)?(\s|$)", "$1trd$3"),
    (r"(\s|^)estandar|standard(\s|$)", "$1esd$2"),
    (r"(\s|^)original(\s|$)", "$1$2"),
    (r"(\s|^)papel higienico(\s|$)", "$1$2"),
    (r"(\s|^)club(\s|$)", "$1clb$2"),
    (r"(\s|^)edicion(\s|$)", "$1ed$2"),
    (r"(\s|^)(\d*) ano(\s|$)", "$1$2a$3"),
    (r"(\s|^)cristalino(\s|$)", "$1cristal$2"),
    (r"(\s|^)pocket(\s|$)", "$1$2"),
    (r"(\s|^)x[\d] shots(\s|$)", "$1$2"),
    (r"(\s|^)(licor|destilado)(\sagave)*(\s|$)", "$1$4"),
    (r"(\s|^)(alim[\.]*)(\s|$)", "$1amilento$3"),
    (r"(\blima|limalimon)\b", " limon "),
    (r"modelo$", ""),
    (r"([\s]*)promo(\s|$)", "$1$2"),
    (r"([\s]*)pouch[e]?(\s|$)", "$1pch$2"),
    (r"([\s]*)jugo(\s|$)", "$1$2"),
    (r"([\s]*)promocion(\s|$)", "$1$2"),
    (r"(\s|^)trigo(\s|$)", "$1tr$2"),
    (r"(\s|^)papa frita(\s|$)", "$1papa$2"),
    (r"(\s|^)refinad[a|o](\s|$)", "$1rfd$2"),
    (r"(\s|^)soluble(\s|$)", "$1slb$2"),
    (r"(\s|^)sopa (instantanea)", "sopa"),
    (r"(\s|^)sopa (ramen)", "sopa"),
    (r"(\s|^)(chile)* habanero(\s|$)", "$1habanero$3"),
    (r"(\s|^)(chile)* piquin(\s|$)", "$1piquin$3"),
    (r"(\s|^)(quereta[a-z]+ )?verde valle( quereta[a-z]+)?(\s|$)", "$1verdevalle$4"),
    (r"(\s|^)agua natural(\s|$)", "$1$2"),
    (r"(\s|^)refresco(\s|$)", "$1$2"),
    (r"(\s|^)aguardiente(\s|$)", "$1aguard$2"),
    (r"(\s|^)producto lacteo(\s|$)", "$1leche$2"),
    When("toalla", [
        (r"(\s|^)femenina|higienica(\s|$)", "$1$2"),
    ]),
    When("vino", [
        (r"(\s|^)sauvignon(\s|$)", "$1cbrnet$2"),
        (r"(\s|^)cabernet(\s|$)", "$1cbrnet$2"),
        (r"(\s|^)carmenere(\s|$)", "$1cmenre$2"),
        (r"(\s|^)(cmenre|cbrnet|merlot)(\s|$)", "$1tinto $2$3"),
    ]),
    When("maruchan", [
        (r"maruchan", "sopa maruchan ramen instantanea 64g"),
        (r"picante|chile", "piquin"),
        (r"camaron?\s*piquin", "camaron piquin"),
    ]),
    When("smirnoff", [Add(" vodka")]),
    When("gillette", [
        Add(" prestobarba maquina afeitar"),
        Text("3hx8pz", "triple hoja 8pz"),
    ]),
    When("glenlivet", [Add(" founders")]),
    (r"(\s|^)yogoyogo(\s|$)", "$1yogo$2"),
    When(" yogo ", [Add(" alpina yogurt")]),
    When("skyy", [
        (r"(\s|^)mezcla|vodka|blue|original(\s|$)", "$1$2"),
        (r"(\s|^)skyy(\s|$)", "$1vodkaskyyblue$2"),
        (r"appletini(:?\smanzana)?(:?\sverde)?", "ap"),
        (r"275(\s|$)", " 275ml$1"),
        (r"cosmo(:?\sarandano)?", "cs"),
        (r"citru", ""),
    ]),
    (r"camaron?\s*habanero", "camaron piquin"),
    (r"(\s|^)rb(\s|$)", "$1redbull$2"),
    (r"(\s|^)red bull(\s|$)", "$1redbull$2"),
    (r"(\s|^)ped[r]?igre[e]?(\s|$)", "$1pedigree$2"),
    (r"(\s|^)vive\s?100[pz]*(\s|$)", "$1vive100$2"),
    (r"(\s|^)lol tun(\s|$)", "$1loltun$2"),
    (r"(\s|^)vogue 600hoja(\s|$)", "$1vogue 600 hoja$2"),
    (r"(\s|^)don pedro(\s|$)", "$1donpedro$2"),
    (r"(\s|^)(bry\s)?(domecq)?\sdonpedro(\s|$)", "$1$2donpedro$4"),
    (r"(\s|^)bacardi carta blanca(\s|$)", "$1bacardi blanco$2"),
    (r"(\s|^)(bry )*azteca oro(\s|$)", "$1aztecaoro$3"),
    (r"passport scot[c]?h", "passport"),
    (r"(\s|^)sauza hacienda(\s|$)", "$1sauzahacienda$2"),
    (r"(\s|^)campo azul(\s|$)", "$1campoazul$2"),
    (r"(\s|^)(johnne|johnie)(\s|$|w)", "$1johnnie$3"),
    (r"(\s|^)johnnie walker(\s|$|w)", "$1johnniewalker$2"),
    (r"(\s|^)buchana(\s|$)", "$1buchanan$2"),
    (r"(\s|^)cava de oro(\s|$)", "$1cavadeoro$2"),
    (r"(\s|^)don julio(\s|$)", "$1donjulio$2"),
    (r"(\s|^)rancho escondido(\s|$)", "$1ranchoescondido$2"),
    (r"(\s|^)jose cuervo(\s|$)", "$1cuervo$2"),
    (r"(\s|^)gran centenar[i]*o(\s|$)", "$1grancentenario$2"),
    (r"(\s|^)teq 1800(\s|$)", "$1cuervo 1800$2"),
    (r"(\s|^)(teq|destilado|licor)\scompadre(\s|$)", "$1compadre$3"),
    (r"(\s|^)nestle pureza vital(\s|$)", "$1npv$2"),
    (r"(\s|^)nestle pv(\s|$)", "$1npv$2"),
    (r"(\s|^)lechera(\s|$)", "$1lechera nestle condensada$2"),
    (r"(\s|^)pepsi cola(\s|$)", "$1pepsi$2"),
    (r"(\s|^)vitaloe original(\s|$)", "$1vitaloe$2"),
    (r"(\s|^)(vel rosita)(\s|$)", "$1velrosita$3"),
    (r"(\s|^)caribe cooler(\s|$)", "$1caribecooler$2"),
    (r"(\s|^)(sta[\.]*)(\s|$)", "$1santa$3"),
    (r"(\s|^)(agua )*(natural )*(santa maria)(\s|$)", "$1santamaria$5"),
    (r"(\s|^)(agua )*(natural )*(san pellegrino)(\s|$)", "$1san pellegrino$5"),
    Dedup(),
    Weight(),
    (r"fres[c|k]aleche(:? leche)?", "freskaleche"),
    (r"viejo calda", "calda"),
    (r"santa fe", "santafe"),
    (r"amarillo manzanares", "manzanares"),
]

# Colours to English, then to three letters.
COLORS = [
    (r"(\b)blanco(\b)", "$1white$2"),
    (r"(\s|^)roj[a|o](\s|$)", "$1red$2"),
    (r"(\s|^)azul(\s|$)", "$1blue$2"),
    (r"(\s|^)golden|dorado(\s|$)", "$1gold$2"),
    (r"(\s|^)negr[a|o](\s|$)", "$1black$2"),
    (r"\b(?:(red)|(bla)ck|(gol)d|(yel)low|(gre)en|(ora)nge|(blu)e|(whi)te)\b", "$1$2$3$4$5$6$7$8"),
]

# Size words.
SIZES = [
    (r"(\b)largo|grande|big(\b)", "$1xl$2"),
    (r"(\b)pequeno|small|chico(\b)", "$1xs$2"),
]
