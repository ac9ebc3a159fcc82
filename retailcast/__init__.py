"""retailcast — retail demand analytics as Spark DataFrame plans.

Operators are plain functions ``DataFrame -> DataFrame`` (or a one-row
DataFrame for whole-table reports). Nothing is collected to the driver
except bounded scalars (a handful of thresholds or partition offsets).
"""

__version__ = "0.1.0"
