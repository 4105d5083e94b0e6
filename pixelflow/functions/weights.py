"""Weighted lists ``id,weight|id,weight|...``."""

from pyspark.sql import Column, functions as F

from pixelflow.functions._util import col


def _entries(c) -> Column:
    """Non-empty ``|``-separated entries."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\|"), lambda x: x != "")


def _pair(e: Column) -> Column:
    """``id,weight`` split on commas after dropping trailing empty parts."""
    return F.split(F.regexp_replace(e, ",+$", ""), ",")


# An entry with exactly two comma parts (trailing commas dropped); entries
# are separated by "|", so a match starts at the start or after a "|".
_PAIR_RE = r"(?:^|\|)([^|,]*),([^|,]*),*(?=\||\z)"


def weighted_pairs(c) -> tuple[Column, Column]:
    """``(ids, weights)`` arrays of the two-part entries; a weight that does
    not parse is NULL."""
    src = F.coalesce(col(c), F.lit(""))
    return (F.regexp_extract_all(src, F.lit(_PAIR_RE), 1),
            F.regexp_extract_all(src, F.lit(_PAIR_RE), 2).try_cast("array<double>"))


def rank_pairs(ids, ws) -> tuple[Column, Column]:
    """``(ranked, non_nan)``: ``(weight, position, id)`` structs sorted
    ascending (NULL weights first, NaN last) and the count of non-NaN
    weights, i.e. the position of the candidate in ``ranked``."""
    ids, ws = col(ids), col(ws)
    seq = F.sequence(F.lit(1), F.greatest(F.size(ids), F.lit(1)))
    ranked = F.sort_array(F.arrays_zip(ws.alias("w"), seq.alias("p"), ids.alias("i")))
    non_nan = F.when(F.size(ids) > 0, F.size(F.array_remove(ws, F.lit(float("nan"))))).otherwise(F.lit(0))
    return ranked, non_nan


def pick_top(ranked, non_nan) -> Column:
    """Id of the candidate when its weight is a number >= 0, else ``''``."""
    ranked, non_nan = col(ranked), col(non_nan)
    top = F.try_element_at(ranked, F.greatest(non_nan, F.lit(1)))
    ok = (non_nan > 0) & top["w"].isNotNull() & (top["w"] >= 0)
    return F.when(ok, top["i"]).otherwise(F.lit(""))


def argmax_of(ids, ws) -> Column:
    """Arg-max over :func:`weighted_pairs` arrays (see :func:`weighted_argmax`)."""
    return pick_top(*rank_pairs(ids, ws))


def weighted_argmax(c) -> Column:
    """Id of the entry with the largest weight; entries need exactly two parts
    and a parseable weight >= 0 (not NaN); ties go to the last such entry;
    none -> ``''``.

    Without lambdas (so it stays in generated code): the two-part entries are
    extracted by one regex, weights cast element-wise (unparseable -> NULL),
    and ``(weight, position, id)`` sorted: NULL weights sort first and NaN
    last, so the last non-NaN element is the largest weight with the latest
    position among equals.  In a plan, selecting :func:`weighted_pairs`,
    :func:`rank_pairs` and :func:`pick_top` in successive projections keeps
    each generated method small."""
    return argmax_of(*weighted_pairs(c))


def weighted_pick(c, key, seed: str = "0") -> Column:
    """Reproducible uniform pick over the non-empty entries: index from the md5
    of ``seed || key``; the id when the entry has two parts, else ``''``."""
    ent = _entries(c)
    n = F.size(ent)
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed), col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    picked = F.try_element_at(ent, (F.pmod(h, F.greatest(n, F.lit(1))) + 1).cast("int"))
    p = _pair(picked)
    return F.when((n > 0) & (F.size(p) == 2), p.getItem(0)).otherwise(F.lit(""))
