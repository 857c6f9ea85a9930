"""ledgerline: sales analytics and data-quality operators on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (use it with
``df.transform``) built from built-in column expressions, so Catalyst can
push filters and projections to the scan and keep the work in whole-stage
codegen.  Nothing in the library collects rows to the driver.
"""

from ledgerline.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
