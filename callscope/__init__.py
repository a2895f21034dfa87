"""callscope: LLM call analytics on Spark.

Templates, stream assembly, redaction, events, thread runs, feedback,
sessions and rollups as DataFrame and Structured Streaming jobs.

    functions/   Column -> Column (templates, redaction, ids)
    operators/   DataFrame -> DataFrame (assembly, events, threads, feedback)
    sources/     readers, derived logs and sinks
    plans/       the registered queries and their DuckDB twins
    streaming/   Structured Streaming jobs
"""

__version__ = "0.1.0"
