"""marginalis: document-review annotations as DataFrames.

Subpackages: ``functions`` (column expressions), ``sources`` (readers and the
snapshot store), ``operators`` (DataFrame to DataFrame), ``plans`` (composed
pipelines and the query catalogue), ``streaming`` (incremental wrapper) and the
optional ``llm`` (operators on text for training data), which nothing else
imports.
"""
