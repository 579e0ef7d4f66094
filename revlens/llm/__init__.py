"""Operations of a training-data pipeline, one module per operator.

Nothing else in the library imports this package; ``__spark_entry__`` adds
its queries (:mod:`revlens.llm.registry`) when it is present.
"""
