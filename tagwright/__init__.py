"""Spark-native text classification and pool-based active learning.

Every public function takes and returns DataFrames (or Column expressions); there are no
mutable dataset objects.  See the README for the module map.
"""

__version__ = "0.1.0"
