"""Account dormancy analytics as PySpark DataFrame operators."""
