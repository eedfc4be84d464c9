"""marketlens: e-commerce analytics as Spark DataFrame programs.

Layout
------
sources    table loading, stand-in views, readers and writers (S-*)
functions  Column-level expressions: dates, numbers, text (X-*)
operators  generic frame operators: filters, joins, aggregates, windows, top-k (F, J, A, W, T)
plans      business operators built from the above (Q, C, M, R, B, I, P, O)
streaming  streaming forms of the scoring operators
"""

from marketlens.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
