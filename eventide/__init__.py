"""eventide: event-analytics operators for PySpark tables and streams.

Operators take and return DataFrames. Unless a docstring says otherwise the
same function works on a batch DataFrame and on a streaming one.
"""

__version__ = "0.1.0"
