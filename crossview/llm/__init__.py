"""Training-data operators: each module holds one operator and its thin query.

Nothing outside this subpackage imports it; ``__spark_entry__`` registers the
queries only when the subpackage is present.
"""
