"""ledgerline: entity mastering and incremental loads as Spark DataFrame jobs.

Every public operator takes DataFrames (or Columns) and returns DataFrames
(or Columns).  Nothing is collected to the driver except small, bounded
configuration (mapping rows, a single watermark value, a count report).
"""

from ledgerline.session import get_spark, checkpoint_dir, read_tables  # noqa: F401

__version__ = "0.1.0"
