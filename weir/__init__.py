"""weir: the ingest layer of a real-time warehouse as PySpark jobs.

Two flows, each as batch DataFrame functions and as a Structured Streaming job:

* log flow: raw app logs -> parsed records -> new-visitor flag repair -> one stream per record kind
* dim flow: database change log -> live routing rules -> dimension tables, last value per key and column
"""
