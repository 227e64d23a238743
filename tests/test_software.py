"""Software rows: equal ones count once, and only raw columns are shuffled."""
from pyspark.sql import functions as F

from ticketlake.plans import staging_inventory as S
from ticketlake.sources.tables import Tables


def test_equal_installations_count_once_and_raw_columns_are_shuffled(spark, folder):
    bronze = Tables(spark, folder).bronze("ocs_software")
    # the same installation again, and once more with blanks that the staging drops
    twice = bronze.unionByName(bronze).unionByName(bronze.withColumn("PUBLISHER", F.concat(F.col("PUBLISHER"), F.lit(" "))))
    once, again = S.software(bronze), S.software(twice)
    assert again.count() == once.count() == bronze.distinct().count()
    assert again.exceptAll(once).isEmpty() and once.exceptAll(again).isEmpty()
    plan = again._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert moved and not any("software_category" in line for line in moved)
