"""Operators for large-scale training-data preparation.

One module per operator; each module holds the general operator (DataFrame in,
DataFrame out, real outputs such as texts, spans, files) and the thin
registered query ``opN_<name>`` that derives its digest columns from it.
Nothing outside this subpackage imports it, except the guarded import in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
