"""Missing-value markers."""

from pyspark.sql import Column, functions as F

from pixelflow.constants import MISSING, MISSING_TEXTS
from pixelflow.functions._util import col


# One pattern for the whole marker set, so the input is referenced once and
# nested calls do not multiply the expression tree.
_MARKER_RE = "(?iu)^(?:" + "|".join(t for t in MISSING_TEXTS if t) + ")?\\z"


def norm_marker(c) -> Column:
    """Empty, ``unknown`` or ``null`` text (any case), or SQL NULL -> ``-``."""
    return F.coalesce(F.regexp_replace(col(c), _MARKER_RE, MISSING), F.lit(MISSING))
