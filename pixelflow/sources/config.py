"""Configuration tables: the pixel map and the ad-group list.

Both arrive as one comma-separated string (``pixel|campaign_id|category,...``
and ``pixel|adgroup_id,...``), the job parameter the driver already holds.
The driver splits the string into entries; they and the derived lookups are
local tables with exact size statistics, from which the planner picks
broadcast or shuffle joins by its own threshold.  Maps kept as tables use
:func:`lookups_from_entries`.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession, functions as F

PM_SCHEMA = "ord int not null, pixel string not null, campaign_id string not null, category string not null"


def local_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A driver-side table as a local relation (planned without a Spark job
    and with exact size statistics)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    st = StructType.fromDDL(schema)
    names = st.names
    arrow = to_arrow_schema(st)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow), st)


def _parts(spec: str | None):
    """(position, parts) of the non-empty comma entries; ``|`` parts with
    trailing empty parts dropped."""
    pos = 0
    for e in (spec or "").split(","):
        if e:
            yield pos, e.rstrip("|").split("|") if e.rstrip("|") else [""]
            pos += 1


def spec_entries(spec: str | None, arity: int) -> int:
    """Number of entries with ``arity`` parts."""
    return sum(1 for _, p in _parts(spec) if len(p) == arity)


def _rows(spec: str | None, arity: int):
    return [(o, *p) for o, p in _parts(spec) if len(p) == arity]


def pixel_map(spark: SparkSession, spec: str | None) -> DataFrame:
    """``(ord, pixel, campaign_id, category)``; entries without exactly three
    parts are ignored; duplicates are kept."""
    return local_table(spark, _rows(spec, 3), PM_SCHEMA)


def adgroup_table(spark: SparkSession, spec: str | None) -> DataFrame:
    """Distinct ``adgroup_id`` of the two-part entries."""
    ids = sorted({r[2] for r in _rows(spec, 2)})
    return local_table(spark, [(i,) for i in ids], "adgroup_id string not null")


class PixelLookups:
    """Lookup tables derived from the pixel map, built on first use.

    ``category``: campaign -> category of its last entry; ``weights``: one row per entry with ``1/n``
    (n = entries of the pixel); ``pairs``: distinct (pixel, campaign_id);
    ``pixels`` / ``campaigns``: distinct ids; ``entries``: the map itself."""

    def __init__(self, builders: dict, is_table: bool = False):
        self._builders = builders
        self.is_table = is_table      # a map of any size, not a job parameter
        self._built: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    entries = property(lambda self: self._get("entries"))
    category = property(lambda self: self._get("category"))
    weights = property(lambda self: self._get("weights"))
    pairs = property(lambda self: self._get("pairs"))
    pixels = property(lambda self: self._get("pixels"))
    campaigns = property(lambda self: self._get("campaigns"))


def lookups_from_entries(pm: DataFrame) -> PixelLookups:
    """Lookup tables derived by Spark from a map held as a table
    ``(ord, pixel, campaign_id, category)`` of any size."""
    # entries per pixel by an aggregate (combined map-side, so a pixel with a
    # huge share of the entries is not gathered in one task), joined back
    def weights():
        n = pm.groupBy("pixel").agg(F.count(F.lit(1)).alias("_n"))
        return pm.join(n, "pixel").select("pixel", "category", (F.lit(1.0) / F.col("_n")).alias("weight"))
    return PixelLookups({
        "entries": lambda: pm,
        "category": lambda: pm.groupBy("campaign_id").agg(F.max_by("category", "ord").alias("category")),
        "weights": weights,
        "pairs": lambda: pm.select("pixel", "campaign_id").distinct(),
        "pixels": lambda: pm.select("pixel").distinct(),
        "campaigns": lambda: pm.select("campaign_id").distinct(),
    }, is_table=True)


_CACHE: dict = {}


def pixel_lookups(spark: SparkSession, spec: str | PixelLookups | None) -> PixelLookups:
    """Lookup tables of a ``pixel|campaign_id|category,...`` string.  Reused
    for the same session and string (DataFrames are immutable).  Lookups made
    before (:func:`lookups_from_entries`) are taken as they are."""
    if isinstance(spec, PixelLookups):
        return spec
    key = (id(spark), spec)
    hit = _CACHE.get(key)
    if hit is not None and hit[0]() is spark:      # same live session object
        return hit[1]
    rows = _rows(spec, 3)
    last, count = {}, {}
    for _, px, camp, cat in rows:
        last[camp] = cat
        count[px] = count.get(px, 0) + 1

    def mk(data, schema):
        return lambda: local_table(spark, data, schema)
    lk = PixelLookups({
        "entries": mk(rows, PM_SCHEMA),
        "category": mk(sorted(last.items()), "campaign_id string not null, category string not null"),
        "weights": mk([(px, cat, 1.0 / count[px]) for _, px, _, cat in rows],
                      "pixel string not null, category string not null, weight double not null"),
        "pairs": mk(sorted({(px, camp) for _, px, camp, _ in rows}), "pixel string not null, campaign_id string not null"),
        "pixels": mk(sorted({(px,) for _, px, _, _ in rows}), "pixel string not null"),
        "campaigns": mk(sorted({(camp,) for _, _, camp, _ in rows}), "campaign_id string not null"),
    })
    if len(_CACHE) > 64:
        _CACHE.clear()
    _CACHE[key] = (weakref.ref(spark), lk)
    return lk
