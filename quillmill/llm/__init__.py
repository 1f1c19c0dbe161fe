"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; the driver contract adds its queries only
when it can be imported.  Conventions that hold for every operator in it:

* Documents are ``(doc_id, text)`` rows; further columns never take part and cannot clash, because
  each operator selects what it needs under names of its own.
* A null text is the empty text unless an operator says otherwise.
* Intermediate tables that cut a lineage are Parquet files below ``spark.checkpoint.dir``.
"""
