"""Key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroline.fixed_values import NULL_KEY_PART


def _part(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NULL_KEY_PART))


def surrogate_key(*names: str, separator: str = "-") -> Column:
    """md5 over the named columns as text.

    ``concat_ws`` skips NULLs, which would let (a, NULL, b) collide with (a, b); every NULL part is therefore
    replaced by a fixed marker first.
    """
    return F.md5(F.concat_ws(separator, *[_part(name) for name in names]))


def path_key(*names: str) -> Column:
    """The ``_``-joined flavour used by the file-based star schema."""
    return surrogate_key(*names, separator="_")


def message_key(code: str = "IntlAQSCode", parameter: str = "Parameter") -> Column:
    """Message key ``code_parameter``; all readings of one instrument share a topic partition."""
    return F.concat_ws("_", F.coalesce(F.col(code), F.lit("")), F.coalesce(F.col(parameter), F.lit("")))
