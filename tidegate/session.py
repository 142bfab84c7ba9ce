"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits the partitions of a hot key in a join. By default it does
#: not where a later join on the same key would need one more shuffle, as between mart
#: and report; a hot client matters more than that shuffle, which only happens when
#: there is one.
#: Methods above 8000 bytes are not compiled by the JVM. A stage whose generated code would have one, like
#: the row rules, is generated operator by operator instead, in methods that are.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
