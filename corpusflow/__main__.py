from pyspark.sql import SparkSession

from .operators.scale import remove_written
from .plans.programs import main

try:
    main()
finally:
    if (spark := SparkSession.getActiveSession()) is not None:
        remove_written(spark)
