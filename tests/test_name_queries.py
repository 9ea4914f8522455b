"""Stage queries apply their rules once per distinct name."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from registry import names as NQ
from shelfmatch.functions import names as N


def test_rules_run_once_per_distinct_name(spark, tmp_path):
    rows = [{"p_partkey": 120 * k, "p_name": n, "p_brand": "b", "p_type": t, "p_size": 4, "p_retailprice": 9.5}
            for k, (n, t) in enumerate([("hot bolt", "PROMO"), ("hot bolt", "PROMO"), (None, "SMALL"), ("blue ring", "OTHER")] * 3)]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "part.parquet")
    found = NQ.SPARK["normalize_brands"](spark, str(tmp_path))
    plain = NQ._names(spark, str(tmp_path)).select("id", N.fix_vocabulary(N.squeeze(N.fold_accents(F.lower("name")))).alias("name"))
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count() == 24
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the rules stand above the aggregation that makes the names distinct
    assert "Aggregate" in plan and plan.index("regexp_replace") < plan.index("Aggregate")
