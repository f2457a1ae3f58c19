"""lodestar: link ranking, key sorting and linear-model training as Spark jobs.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects so that
Catalyst sees one declarative plan; the only Python that runs inside tasks is
Arrow-batched numpy (gradients, image arrays).
"""

__version__ = "0.1.0"
