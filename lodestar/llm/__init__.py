"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing outside this subpackage imports it.  Common rules of all operators:
a null text is the empty text unless the operator says otherwise, input frames
may carry any extra columns (only the named ones are read), empty tables give
empty results of the same schema, and repeated rows are kept.
"""
