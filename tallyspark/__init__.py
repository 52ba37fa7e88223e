"""tallyspark — a Spark-native sales-analytics engine.

Raw order/customer/product inputs are cleaned, validated and modelled as a
star schema with marts and KPI result sets.  Every public operator is a plain
``DataFrame -> DataFrame`` function built from built-in Spark expressions, so
Catalyst sees the whole plan (pushdown, pruning, codegen) and AQE can re-plan
joins and skew at run time.
"""

__version__ = "0.1.0"
