"""Queries over match evaluation."""

from __future__ import annotations

from shelfmatch.operators import evaluation as E

from . import inputs as I

SPARK, SQL = {}, {}

POINTS = f"""
select score, n_pos, n_neg, sum(n_pos) over (order by score desc)::bigint as tp, sum(n_neg) over (order by score desc)::bigint as fp,
       sum(n_pos) over ()::bigint as p, sum(n_neg) over ()::bigint as n
from (select score, count(*) filter (label = 1) as n_pos, count(*) filter (label <> 1) as n_neg from ({I.EVAL}) group by 1)"""
COUNTS = f"""
select count(*) filter (label <> 1 and score < 0.8) as tn, count(*) filter (label <> 1 and score >= 0.8) as fp,
       count(*) filter (label = 1 and score < 0.8) as fn, count(*) filter (label = 1 and score >= 0.8) as tp from ({I.EVAL})"""


def _add(name: str, sql: str, fn):
    def run(spark, sf):
        return fn(I.read(spark, sf, I.EVAL))

    run.__name__ = name
    SPARK[name], SQL[name] = run, sql


_add("confusion_matrix", f"select *, {', '.join(f'{c}::double / (tn + fp + fn + tp)::double as {c}_share' for c in ('tn', 'fp', 'fn', 'tp'))} from ({COUNTS})", E.confusion)


def _ratio(a: str, b: str) -> str:
    return f"(case when {b} = 0 then 0.0::double else ({a})::double / ({b})::double end)"


_add("class_report", f"""
with c as ({COUNTS}), r as (
  select {_ratio('tn', 'tn + fn')} as p0, {_ratio('tn', 'tn + fp')} as r0, {_ratio('2 * tn', '2 * tn + fn + fp')} as f0, tn + fp as n0,
         {_ratio('tp', 'tp + fp')} as p1, {_ratio('tp', 'tp + fn')} as r1, {_ratio('2 * tp', '2 * tp + fp + fn')} as f1, tp + fn as n1,
         {_ratio('tp + tn', 'tn + fp + fn + tp')} as acc from c)
select '0' as class, p0 as precision, r0 as recall, f0 as f1, n0 as support from r
union all select '1', p1, r1, f1, n1 from r
union all select 'accuracy', acc, acc, acc, n0 + n1 from r
union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 from r
union all select 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 from r""", E.class_report)
_add("roc_points", f"select score, fp::double / n::double as fpr, tp::double / p::double as tpr from ({POINTS})", E.roc_points)
_add("pr_points", f"select score, tp::double / (tp + fp)::double as precision, tp::double / p::double as recall from ({POINTS})", E.pr_points)
_add("roc_auc", f"select sum(n_neg * (2 * tp - n_pos))::double / (2.0::double * max(p) * max(n)) as roc_auc from ({POINTS})", E.roc_auc)
_add("average_precision", f"select round(sum(n_pos * tp / (tp + fp)::double) / max(p)::double, 9) as average_precision from ({POINTS})",
     lambda df: E.average_precision(df).selectExpr("round(average_precision, 9) as average_precision"))
_add("positive_rate", f"select avg(label::double) as positive_rate from ({I.EVAL})", E.positive_rate)
