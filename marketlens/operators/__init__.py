"""Generic frame operators: F (frame), J (joins), A (aggregates), W (windows), T (ordering)."""

from marketlens.operators import aggregates, frame, joins, ordering, windows  # noqa: F401
