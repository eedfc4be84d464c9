"""Column expressions (X-*): dates, numbers and text."""

from marketlens.functions import dates, numeric, text  # noqa: F401
