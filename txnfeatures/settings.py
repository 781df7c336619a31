"""Session settings the plans do best with.  Nothing in the library sets them.

    builder = SparkSession.builder
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
"""

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash instead of sort where every partition of the per-key table is small:
    # the fact side of the keyed joins then needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Plans are built of many column expressions; capturing the call site of
    # each costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
