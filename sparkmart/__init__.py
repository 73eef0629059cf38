"""sparkmart: a dimensional sales mart built from composable DataFrame operators.

Layout
------
sources/    scans, test-data bindings, incremental reads, snapshot sinks
operators/  staging extracts, surrogate keys, calendar, SCD merges, fact load,
            data-quality checks, incremental sync
functions/  column-level helpers (predicates, money casts, weekday numbering)
plans/      analytic views, dashboard measures, the end-to-end build, the
            query registry used by ``__spark_entry__``
streaming/  the incremental sync re-expressed as a Structured Streaming job
"""

__version__ = "0.1.0"
