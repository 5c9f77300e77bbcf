"""footmark: a Spark-native building registry.

Conforms open building-footprint and address layers to one schema, matches them
with grid-cell spatial joins, merges attributes by source priority and mints a
plus code per building, all as DataFrame plans that cover every county in one
job.

Sub-packages
------------
functions  column functions: WKB geometry kernels (Arrow UDFs), text parsers,
           projection and plus codes (pure Column math)
operators  spatial joins, correspondence, merge, county lookup
providers  per-provider conform functions and the provider registry
sources    raw-layer readers, fixture layers, counties, table sinks
plans      the conform and conflate jobs
streaming  (empty: the workload is batch only)
"""

__version__ = "0.1.0"
