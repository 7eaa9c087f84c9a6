"""skein: incremental, quality-gated enrichment of text records on Spark.

Layout
------
functions/  Column -> Column expressions (text cleaning, JSON typing, ids)
sources/    readers and writers (CSV, JSON docs, staged docs, tables)
operators/  DataFrame -> DataFrame steps (ingest, validate, repair, merge,
            publish, inference job, reports)
plans/      run modes that compose operators into jobs
streaming/  incremental availableNow runs over a file source
"""

from skein.session import configure, get_spark, scratch_path  # noqa: F401
