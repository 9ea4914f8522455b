"""Building blocks of the DuckDB side."""

from __future__ import annotations

import re

from shelfmatch.functions import name_rules as R
from shelfmatch.functions.similarity import UNIT, UNIT_TAIL
from shelfmatch.functions.stop_words import spanish


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sub(expr: str, pattern: str, replacement: str) -> str:
    pattern = pattern.replace("(?U)", "").replace("(?<n>", "(")
    replacement = re.sub(r"\$(\d)", r"\\\1", replacement).replace("${n}", r"\1")
    if "\x03" in replacement:
        head, tail = replacement.split("\x03")
        return f"regexp_replace({expr}, {quote(pattern)}, {quote(head)} || chr(3) || {quote(tail)}, 'g')"
    return f"regexp_replace({expr}, {quote(pattern)}, {quote(replacement)}, 'g')"


def dedup_tokens(x: str) -> str:
    tokens = f"string_split_regex(trim({x}), '\\s+')"
    return f"array_to_string(list_filter({tokens}, lambda w, i: list_position({tokens}, w) = i), ' ')"


def stop_words() -> list[str]:
    return spanish() + R.EXTRA_STOP_WORDS


def drop_stop_words(x: str) -> str:
    words = ", ".join(quote(w) for w in stop_words())
    return f"array_to_string(list_filter(string_split({x}, ' '), lambda w: not list_contains([{words}], w)), ' ')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def fold_accents(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


def steps(rules: list, x: str = "x") -> list[str]:
    """Expressions over ``x`` that apply the rules one after the other."""
    out, run, used = [], x, False

    def flush():
        nonlocal run, used
        if used:
            out.append(run)
        run, used = x, False

    for rule in rules:
        match rule:
            case R.When(word, inner):
                flush()
                body = x
                for r in inner:
                    body = _one(r, body)
                out.append(f"case when contains({x}, {quote(word)}) then {body} else {x} end")
            case R.Dedup():
                flush()
                out.append(dedup_tokens(x))
            case R.Weight():
                flush()
                for brand in R.BRANDS:
                    times = next(n for longest, n in R.BRAND_REPEATS if longest is None or len(brand) <= longest)
                    run = _sub(run, rf"(\s|^)({brand})(\s|$)", "$1" + brand * times + R.BRAND_JOINT)
                used = True
                flush()
            case _:
                run, used = _one(rule, run), True
    flush()
    return out


def _one(rule, x: str) -> str:
    match rule:
        case R.Add(text):
            return f"({x} || {quote(text)})"
        case R.Text(old, new):
            return f"replace({x}, {quote(old)}, {quote(new)})"
        case (pattern, replacement):
            return _sub(x, pattern, replacement)


def chain(source: str, name: str, expressions: list[str]) -> str:
    """``source`` with column ``name`` put through the expressions over ``x`` in order, as ``x``."""
    ctes = [f"s0 as (select *, {name} as x from ({source}))"]
    for i, e in enumerate(expressions):
        ctes.append(f"s{i + 1} as materialized (select * replace ({e} as x) from s{i})")
    return "with " + ", ".join(ctes) + f" select * from s{len(expressions)}"


def normalize(source: str, name: str) -> str:
    return chain(source, name, [
        "lower(trim(x))", *steps(R.SPECIAL), fold_accents("x"), squeeze("x"), *steps(R.UNITS), *steps(R.QUANTITIES),
        drop_stop_words("x"), *steps(R.VOCABULARY), dedup_tokens("x"), *steps(R.COLORS), *steps(R.SIZES),
    ])


def units(x: str) -> str:
    return f"regexp_extract_all({x}, '{UNIT}')"


def base(x: str) -> str:
    return f"trim(regexp_replace({x}, '{UNIT_TAIL}', '', 'g'))"


def token_sort(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split_regex(lower(regexp_replace({x}, '\\W', ' ', 'g')), '\\s+'), lambda t: t <> '')), ' ')"


def chars(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split({x}, ''), lambda c: c <> '')))"


def lcs(pairs: str, a: str, b: str) -> str:
    """``pairs`` with column ``lcs``: bits of ``a`` (up to 62 characters), one step per character of ``b``."""
    masks = (
        f"map_from_entries(list_transform(list_distinct(string_split({a}, '')), lambda c: "
        f"struct_pack(k := c, v := list_sum(list_transform(range(1, length({a}) + 1), lambda i: "
        f"case when substr({a}, i, 1) = c then (1::bigint << (i - 1)::int) else 0::bigint end))::bigint)))"
    )
    full = f"((1::bigint << length({a})::int) - 1)"
    step = "((v + (v & m)) | (v - (v & m)))"
    return (
        f"select * exclude (_m), case when length({a}) = 0 or length({b}) = 0 then 0 else length({a}) - bit_count("
        f"list_reduce(list_prepend({full}, list_transform(string_split({b}, ''), lambda c: coalesce(element_at(_m, c)[1], 0::bigint))), "
        f"lambda v, m: {step} & {full})) end as lcs "
        f"from (select p.*, q._m from ({pairs}) p join (select {a}, {masks} as _m from (select distinct {a} from ({pairs}))) q using ({a}))"
    )


def percent(lcs_: str, la: str, lb: str) -> str:
    return f"(case when {la} + {lb} = 0 then 100 else round_even((1 - ({la} + {lb} - 2 * {lcs_})::double / ({la} + {lb})::double) * 100, 0) end)"


def dice(a: str, b: str) -> str:
    """Over two lists of distinct characters."""
    return f"(case when len({a}) + len({b}) = 0 then 0.0::double else 1 - len(list_intersect({a}, {b})) * 2.0::double / (len({a}) + len({b}))::double end)"


def jaccard(a: str, b: str) -> str:
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"(case when {union} = 0 then 1.0::double else len(list_intersect(list_distinct({a}), list_distinct({b})))::double / {union}::double end)"


def unit_parts(u: str) -> str:
    runs = f"regexp_extract_all({u}, '\\d+|\\D+')"
    return f"(case when regexp_matches({u}, '^\\d') then list_prepend('', {runs}) else {runs} end)"


def unit_dist(ua: str, ub: str) -> str:
    """Over two unit lists."""
    parts = jaccard(unit_parts(f"{ua}[1]"), unit_parts(f"{ub}[1]"))
    return f"(1 - case when len({ua}) = 1 and len({ub}) = 1 then {parts} else {jaccard(ua, ub)} end)"


def confidence(closeness: str, dist: str, unit_weight: float = 0.17, decay: float = 1.01, digits: int = 4, clamp: bool = True) -> str:
    raw = f"({closeness} - {dist} * {unit_weight}::double)"
    return f"round(case when {raw} <= 0 then 0.0::double else exp(1 - 1 / pow({raw}, {decay}::double)) end, {digits})"


def closeness(lcs_: str, la: str, lb: str, dice_: str) -> str:
    lev = f"((100 - {percent(lcs_, la, lb)}) * 0.01::double)"
    return f"(1 - ({lev} * 1.3::double + {dice_} * 0.7::double) / 2)"


def features(source: str, name: str) -> str:
    """``source`` with ub, srt, chs, uns of a clean name."""
    return (
        f"select *, {token_sort('ub')} as srt, {chars('ub')} as chs, {units(name)} as uns "
        f"from (select *, {base(name)} as ub from ({source}))"
    )


def scored_pairs(pairs: str, a: str = "a", b: str = "b") -> str:
    """Pairs of clean names with sa, sb, ca, cb, ua, ub, lcs, close, udist."""
    prepared = (
        f"select *, {token_sort('_ba')} as sa, {token_sort('_bb')} as sb, {chars('_ba')} as ca, {chars('_bb')} as cb, {units(a)} as ua, {units(b)} as ub "
        f"from (select *, {base(a)} as _ba, {base(b)} as _bb from ({pairs}))"
    )
    return (
        f"select *, {closeness('lcs', 'length(sa)', 'length(sb)', dice('ca', 'cb'))} as close, {unit_dist('ua', 'ub')} as udist "
        f"from ({lcs(prepared, 'sa', 'sb')})"
    )


def all_scores(left: str, right: str, **weights) -> str:
    """Every left row with every right row and ``conf``; both carry ``name`` and other columns.

    Brute force over the pairs of names; the LCS runs once per pair of unit-free forms.
    """
    forms = "select distinct srt, chs from"
    return f"""
    with l as materialized ({features(left, 'name')}), r as materialized ({features(right, 'name')}),
    f as materialized (select sa, ca, sb, cb, {closeness('lcs', 'length(sa)', 'length(sb)', dice('ca', 'cb'))} as close from (
        {lcs(f"select a.srt as sa, a.chs as ca, b.srt as sb, b.chs as cb from ({forms} l) a, ({forms} r) b", 'sa', 'sb')})),
    u as materialized (select ua, ub, {unit_dist('ua', 'ub')} as udist from (select distinct uns as ua from l), (select distinct uns as ub from r))
    select l.* exclude (ub, srt, chs, uns, name), r.* exclude (ub, srt, chs, uns, name), l.name as left_name, r.name as right_name,
           {confidence('f.close', 'u.udist', **weights)} as conf
    from l join f on f.sa = l.srt and f.ca = l.chs join r on r.srt = f.sb and r.chs = f.cb
         join u on u.ua = l.uns and u.ub = r.uns
    """
