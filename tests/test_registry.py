import math
import random

from pyspark.sql import functions as F

from workload.registry import present, rounded


def test_rounding_is_that_of_spark_without_decimals(spark):
    seed = random.Random(7)
    values = [s * v for s in (1.0, -1.0) for k in (0, 1, 2, 3, 7, 1023, 2**31, 2**51, 2**52, 2**53, 2**62, 2**63, 10**25) for d in (0.0, 0.5, 1.0)
              for v in (k + d, math.nextafter(k + d, math.inf), math.nextafter(k + d, 0.0))]
    values += [seed.uniform(-1, 1) * 10.0 ** seed.randint(-9, 30) for _ in range(3000)] + [seed.randint(-9999, 9999) / 2 for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert rows.filter(~(rounded(F.col("x")) + 0.0).eqNullSafe(F.round("x") + 0.0)).collect() == []
    odd = present(spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, -1e305), (4, -0.0), (5, 2.5e-6), (6, None)], "i int, x double"), 6)
    got = {r.i: r.x for r in odd.collect()}
    assert math.isnan(got[1]) and got[2] == math.inf and got[3] == -1e305 and str(got[4]) == "0.0" and got[5] == 3e-6 and got[6] is None
    assert "round(" not in odd._jdf.queryExecution().optimizedPlan().toString()
