"""Regex extraction and browser / OS name cleaning."""

from pyspark.sql import Column, functions as F

from pixelflow.constants import RE_BROWSER_DROP, RE_OS_DROP
from pixelflow.functions._util import col
from pixelflow.functions.markers import norm_marker


def first_group(c, pattern: str) -> Column:
    """First capture group of the first match, ``''`` when nothing matches."""
    return F.regexp_extract(col(c), pattern, 1)


def payload_extract(c, pattern: str) -> Column:
    """First capture group, missing markers folded to ``-``."""
    return norm_marker(first_group(c, pattern))


def clean_browser(c, renormalise: bool = True) -> Column:
    """Browser family: letters only (``Internet Explorer 11`` -> ``InternetExplorer``)."""
    out = F.regexp_replace(col(c), RE_BROWSER_DROP, "")
    return norm_marker(out) if renormalise else out


def clean_os(c, renormalise: bool = True) -> Column:
    """OS family: drop blanks, parenthesised parts and a dot with one following
    alphanumeric (``Windows 8.1`` -> ``Windows8``)."""
    out = F.regexp_replace(col(c), RE_OS_DROP, "")
    return norm_marker(out) if renormalise else out
