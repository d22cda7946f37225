"""chatloom: Spark-native preparation and analysis of chat / text training data.

Every operator takes DataFrames and returns DataFrames; the heavy lifting runs in
Spark (scans, projections, aggregations, joins, windows, shuffles).  Python code
inside tasks is limited to small Arrow/numpy kernels driven by ``mapInArrow``.
"""

from chatloom.session import get_spark, work_dir, checkpoint_dir

__all__ = ["get_spark", "work_dir", "checkpoint_dir"]
