"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
Conventions shared by all operators:

* a NULL text counts as the empty text; a NULL id is a value like any other;
* only the named input columns are read, so extra columns never clash;
* work is split by file ranges or by hashed keys that are pre-aggregated, and
  lineage is cut by written tables in the folder of ``spark.checkpoint.dir``.
"""
