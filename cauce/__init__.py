"""cauce: governed batch analytics as plain Spark DataFrame functions.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or a
``Column``) so that Catalyst plans, prunes and pushes down the whole job.
"""

__version__ = "0.1.0"
