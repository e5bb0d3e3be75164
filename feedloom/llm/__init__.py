"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries when it is there.
"""
