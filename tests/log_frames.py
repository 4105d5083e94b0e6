"""Typed log frames for the tests."""

from pixelflow.constants import LOG_FIELDS


def imp_frame(spark, rows):
    """Typed impression log from dicts; fields not given are absent (NULL)."""
    cols = ("event_id",) + LOG_FIELDS
    data = [tuple(r.get(c) for c in cols) for r in rows]
    schema = "event_id bigint, " + ", ".join(f"`{c}` string" for c in LOG_FIELDS)
    return spark.createDataFrame(data, schema)


def conv_frame(spark, rows):
    """Retargeting log rows: (event_id, cookie, payload) or payload lists."""
    if rows and isinstance(rows[0][2], list):
        return spark.createDataFrame(rows, "event_id bigint, cookie string, payloads array<string>")
    return spark.createDataFrame(rows, "event_id bigint, cookie string, payload string")


def payload(cmpn=None, ua=None, date=None, st=None):
    parts = []
    if cmpn is not None:
        parts.append(f'"cmpn":"{cmpn}"')
    if ua is not None:
        parts.append(f'"brwsos":"{ua}"')
    if date is not None:
        parts.append(f'"date":"{date}"')
    if st is not None:
        parts.append(f'"st":"{st}"')
    return "{" + ",".join(parts) + "}"
