"""DuckDB statements, one per registered query, over the same parquet tables.

They are the independent check of the Spark jobs: the same rules written
as plain SQL (list lambdas, ``regexp_*`` with RE2, window functions).
``events`` and the other test tables are views supplied by the caller.
"""

from __future__ import annotations

from pixelflow.constants import (LOG_FIELDS, RE_BRWSOS, RE_CMPN, RE_CONV_HOUR,
                                 RE_DATE, RE_HOUR, RE_SEQ_HOUR, RE_STATE, RE_BROWSER_DROP,
                                 RE_OS_DROP, CTR_FIELD_COUNT)
from pixelflow.sources import fixtures as fx

# The range of the scan query, cutting rows at both ends.
SCAN_FROM, SCAN_TO = "2024010500", "2024012423"

# --- fixed values: the display names of the test agents, by hand ---
AGENT_NAMES = (
    ("Windows 7", "Chrome 38"),
    ("Windows 8.1", "Internet Explorer 11"),
    ("Mac OS X", "Safari"),
    ("iOS 8 (iPhone)", "Safari"),
    ("iOS 7 (iPhone)", "Chrome 38"),
    ("iOS 8 (iPad)", "Safari"),
    ("Android 4.x", "Chrome 37"),
    ("Android 2.x", "Android Browser"),
    ("Windows 10", "Microsoft Edge 12"),
    ("Windows 8", "Firefox 33"),
    ("Windows XP", "Internet Explorer 8"),
    ("Windows 8", "Internet Explorer 10"),
    ("Linux", "Opera 25"),
    ("Windows Vista", "Opera"),
    ("Unknown", "Robot/Spider"),
    ("Unknown", "Unknown"),
    ("Chrome OS", "Chrome 38"),
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def norm(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL OR lower({x}) IN ('', 'unknown', 'null') THEN '-' ELSE ({x}) END)"


def ext(x: str, pat: str) -> str:
    return f"regexp_extract({x}, {q(pat)}, 1)"


def fmt_ms(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') AND TRY_CAST({x} AS BIGINT) IS NOT NULL "
            f"THEN strftime(epoch_ms(TRY_CAST({x} AS BIGINT)), '%Y%m%d %H:%M:%S') ELSE '' END)")


def hg(hh: str) -> str:
    """Hour group by ranges of the two-digit hour."""
    return (f"(CASE WHEN NOT regexp_full_match({hh}, '[0-9][0-9]') THEN NULL "
            f"WHEN {hh} BETWEEN '07' AND '13' THEN '1' WHEN {hh} BETWEEN '14' AND '17' THEN '2' "
            f"WHEN {hh} BETWEEN '18' AND '23' OR {hh} = '00' THEN '3' WHEN {hh} BETWEEN '01' AND '06' THEN '4' END)")


def hg_imp(ts: str) -> str:
    return f"COALESCE({hg(ext(fmt_ms(norm(ts)), RE_HOUR))}, '1')"


def hg_conv(payload: str) -> str:
    return f"COALESCE({hg(norm(ext(payload, RE_CONV_HOUR)))}, '-')"


def hg_ctr(date: str) -> str:
    hh = ext(date, RE_HOUR)
    hh2 = f"(CASE WHEN {date} IS NULL OR {hh} = '' OR lower({hh}) = 'null' THEN 'null' ELSE {hh} END)"
    return f"COALESCE({hg(hh2)}, {hh2})"


def geo_parts(x: str) -> str:
    return f"string_split(regexp_replace({x}, '\\|+$', ''), '|')"


def geo_state(x: str) -> str:
    p = geo_parts(x)
    return norm(f"(CASE WHEN len({p}) >= 3 THEN {p}[1] END)")


def geo_dma(x: str) -> str:
    p = geo_parts(x)
    return norm(f"(CASE WHEN len({p}) >= 3 THEN {p}[3] END)")


def ctr_state(x: str) -> str:
    p = geo_parts(x)
    s = f"(CASE WHEN len({p}) >= 3 THEN {p}[1] ELSE '' END)"
    return f"(CASE WHEN {x} IS NULL THEN '' WHEN {s} = '' OR lower({s}) = 'null' THEN 'null' ELSE {s} END)"


def clean_browser(x: str, renorm: bool = True) -> str:
    e = f"regexp_replace({x}, {q(RE_BROWSER_DROP)}, '', 'g')"
    return norm(e) if renorm else e


def clean_os(x: str, renorm: bool = True) -> str:
    e = f"regexp_replace({x}, {q(RE_OS_DROP)}, '', 'g')"
    return norm(e) if renorm else e


def classify(ua: str, which: int) -> str:
    whens = " ".join(f"WHEN {q(agent)} THEN {q(names[which])}" for agent, names in zip(fx.AGENTS, AGENT_NAMES, strict=True))
    return f"(CASE {ua} {whens} ELSE 'Unknown' END)"


def weighted_argmax(x: str) -> str:
    ent = f"list_filter(string_split(COALESCE({x}, ''), '|'), lambda e: e <> '')"
    pr = "string_split(regexp_replace(e, ',+$', ''), ',')"
    parsed = (f"list_transform({ent}, lambda e: {{'id': {pr}[1], 'n': len({pr}), "
              f"'w': TRY_CAST({pr}[2] AS DOUBLE)}})")
    valid = f"list_filter({parsed}, lambda s: s.n = 2 AND s.w IS NOT NULL AND NOT isnan(s.w) AND s.w >= 0)"
    top = f"list_max(list_transform({valid}, lambda s: s.w))"
    best = f"list_filter({valid}, lambda s: s.w = {top})"
    return f"COALESCE(({best})[-1].id, '')"


def weighted_pick(x: str, key: str, seed: str = "0") -> str:
    ent = f"list_filter(string_split(COALESCE({x}, ''), '|'), lambda e: e <> '')"
    h = f"CAST('0x' || substr(md5({q(seed)} || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"
    n = f"len({ent})"
    picked = f"{ent}[1 + ({h} % (CASE WHEN {n} > 0 THEN {n} ELSE 1 END))]"
    p = f"string_split(regexp_replace({picked}, ',+$', ''), ',')"
    return f"(CASE WHEN {n} > 0 AND len({p}) = 2 THEN {p}[1] ELSE '' END)"


def day_shift(x: str, n: int) -> str:
    if n == 0:
        return x
    d = f"try_strptime({x}, '%Y%m%d')"
    return (f"(CASE WHEN regexp_full_match({x}, '[0-9]{{8}}') AND {d} IS NOT NULL "
            f"THEN strftime({d} + INTERVAL ({n}) DAY, '%Y%m%d') ELSE '' END)")


def _qi(name: str) -> str:
    return f'"{name}"'


# ---------------------------------------------------------------- fixture CTE
def _imp_cte() -> str:
    seg = ("'v' || CAST(k % 3 AS VARCHAR) || ',0.' || CAST(k % 10 AS VARCHAR) || '|v' || "
           "CAST((k + 1) % 3 AS VARCHAR) || ',0.5'")
    filled = {
        "campaign_id": "'c' || CAST(k % 7 AS VARCHAR)",
        "adgroup_id": "'a' || CAST(k % 5 AS VARCHAR)",
        "cookie": "CASE WHEN k % 17 = 0 THEN '-' ELSE md5(CAST(user_id AS VARCHAR)) END",
        "timestamp": "CASE WHEN k = 98 THEN 'null' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END",
        "date": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
        "geo_location": f"{lst(fx.GEOS)}[1 + user_id % 6]",
        "browser": f"{lst(fx.BROWSERS)}[1 + k % 5]",
        "os": f"{lst(fx.OSES)}[1 + user_id % 5]",
        "visibility": f"{lst(fx.VISIBILITY)}[1 + k % 4]",
        "verticle_list": seg,
        "user_seg_list": seg,
        "click_flag": "CASE WHEN event_type = 'click' THEN '1' ELSE '0' END",
    }
    cols = ", ".join(f"{filled.get(f, q('null'))} AS {_qi(f)}" for f in LOG_FIELDS)
    return f"SELECT event_id, ts, {cols} FROM ev WHERE event_type IN ('view', 'click')"


def _conv_cte() -> str:
    ua = f"{lst(fx.AGENTS)}[1 + (user_id + 7 * k) % {len(fx.AGENTS)}]"
    payload = ("'{\"cmpn\":\"p' || CAST(k % 5 AS VARCHAR) || '\",\"brwsos\":\"' || " + ua +
               " || '\",\"date\":\"' || strftime(ts, '%Y%m%d %H:%M:%S') || '\",\"st\":\"' || " +
               f"{lst(fx.STATES)}[1 + user_id % 6] || '\"}}'")
    return (f"SELECT event_id, ts, md5(CAST(user_id AS VARCHAR)) AS cookie, {payload} AS payload "
            f"FROM ev WHERE event_type IN ('purchase', 'signup')")


def _spec_cte(spec: str) -> str:
    return (f"SELECT CAST(pos AS INTEGER) AS ord, string_split(regexp_replace(e, '\\|+$', ''), '|') AS p "
            f"FROM (SELECT unnest(l) AS e, unnest(generate_series(0, len(l) - 1)) AS pos "
            f"FROM (SELECT list_filter(string_split({q(spec)}, ','), lambda x: x <> '') AS l))")


def prefix() -> str:
    line_cols = ", ".join(_qi(f) for f in LOG_FIELDS)
    return f"""WITH ev AS (
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
imp AS ({_imp_cte()}),
conv AS ({_conv_cte()}),
imp_lines AS (SELECT event_id, ts, concat_ws(chr(9), {line_cols}) AS line FROM imp),
conv_lines AS (SELECT event_id, cookie || chr(9) || payload AS line FROM conv),
pm AS (SELECT ord, p[1] AS pixel, p[2] AS campaign_id, p[3] AS category
       FROM ({_spec_cte(fx.PIXEL_SPEC)}) WHERE len(p) = 3),
adg AS (SELECT DISTINCT p[2] AS adgroup_id FROM ({_spec_cte(fx.ADGROUP_SPEC)}) WHERE len(p) = 2),
cat AS (SELECT campaign_id, max_by(category, ord) AS category FROM pm GROUP BY campaign_id),
pw AS (SELECT pixel, category, CAST(1.0 AS DOUBLE) / count(*) OVER (PARTITION BY pixel) AS weight FROM pm),
ia AS ({_collect_impressions_body()}),
ca AS ({_collect_conversions_body()}),
tl AS ({_timeline_body()}),
"""


def _collect_impressions_body(src: str = "imp") -> str:
    return f"""SELECT hour_group, state, os, browser, category, count(*) AS imp FROM (
  SELECT {hg_imp('i."timestamp"')} AS hour_group,
         {geo_state(norm('i.geo_location'))} AS state,
         CASE WHEN i.os IS NULL THEN '-' ELSE {clean_os(norm('i.os'))} END AS os,
         CASE WHEN i.browser IS NULL THEN '-' ELSE {clean_browser(norm('i.browser'))} END AS browser,
         {norm('c.category')} AS category
  FROM {src} i JOIN cat c ON c.campaign_id = {norm('i.campaign_id')}
  WHERE i.campaign_id IS NOT NULL) GROUP BY hour_group, state, os, browser, category"""


def _collect_conversions_body(src: str = "conv") -> str:
    ua = norm(ext("c.payload", RE_BRWSOS))
    return f"""SELECT hour_group, state, os, browser, category, sum(weight) AS conv FROM (
  SELECT {hg_conv('c.payload')} AS hour_group,
         {norm(ext('c.payload', RE_STATE))} AS state,
         {clean_os(classify(ua, 0))} AS os,
         {clean_browser(classify(ua, 1))} AS browser,
         w.category, w.weight
  FROM {src} c JOIN pw w ON w.pixel = {ext('c.payload', RE_CMPN)}
  WHERE COALESCE(c.cookie, '') <> '' AND COALESCE(c.payload, '') <> '')
  GROUP BY hour_group, state, os, browser, category"""


def _timeline_body(markers: bool = False) -> str:
    """Timeline rows, or the row of every retargeting line at date ``-``."""
    d = fmt_ms(norm('i."timestamp"'))
    imp_rows = f"""SELECT i.cookie, {d} AS event_date, 0 AS is_conv, i.event_id AS tie, 0 AS ord,
         CAST(NULL AS VARCHAR) AS pixel, {norm('i.campaign_id')} AS campaign_id,
         regexp_extract({d}, {q(RE_SEQ_HOUR)}, 1) AS hour,
         {geo_state(norm('i.geo_location'))} AS state,
         CASE WHEN i.os IS NULL THEN '' ELSE {clean_os(norm('i.os'), False)} END AS os,
         CASE WHEN i.browser IS NULL THEN '' ELSE {clean_browser(norm('i.browser'), False)} END AS browser,
         {norm('c.category')} AS category
  FROM imp i JOIN cat c ON c.campaign_id = {norm('i.campaign_id')}
  WHERE i.campaign_id IS NOT NULL AND i.cookie IS NOT NULL AND i."timestamp" IS NOT NULL
    AND {norm('i.cookie')} <> '-'"""
    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in
                      ("campaign_id", "hour", "state", "os", "browser", "category"))
    kept = f"FROM conv c WHERE {ext('c.payload', RE_CMPN)} IN (SELECT pixel FROM pm) AND length(c.cookie) = 32"
    tag_rows = f"SELECT c.cookie, '-' AS event_date, 1 AS is_conv, c.event_id AS tie, 0 AS ord, '-' AS pixel, {nulls} {kept}"
    if markers:
        return tag_rows
    pay_rows = (f"SELECT c.cookie, {norm(ext('c.payload', RE_DATE))} AS event_date, 1 AS is_conv, "
                f"c.event_id AS tie, 1 AS ord, {norm(ext('c.payload', RE_CMPN))} AS pixel, {nulls} {kept}")
    return f"{imp_rows}\n  UNION ALL {pay_rows}"


def _dedup(key_cols: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key_cols} "
            f"ORDER BY is_conv DESC, tie DESC, ord DESC) AS rn FROM tl2) WHERE rn = 1")


def _seq_label_body() -> str:
    return f"""tl2 AS (SELECT * FROM tl UNION ALL {_timeline_body(markers=True)}),
dd AS ({_dedup('cookie, event_date')}),
nx AS (SELECT *, lead(is_conv) OVER w AS next_conv, lead(pixel) OVER w AS next_pixel
       FROM dd WINDOW w AS (PARTITION BY cookie ORDER BY event_date)),
lab AS (SELECT cookie, hour, state, os, browser, category,
       CASE WHEN next_conv = 1 AND EXISTS (SELECT 1 FROM pm WHERE pm.pixel = nx.next_pixel
            AND pm.campaign_id = nx.campaign_id) THEN 1 ELSE 0 END AS label
       FROM nx WHERE is_conv = 0)
"""


def _intermediate() -> str:
    key = "concat_ws(chr(9), hour_group, state, os, browser, category)"
    return (f"tg AS (SELECT {key} AS key, 'IMP' AS tag, CAST(imp AS DOUBLE) AS value FROM ia "
            f"UNION ALL SELECT {key} AS key, 'CONV' AS tag, round(conv, 6) AS value FROM ca)\n")


def _fields(arr: str, fields) -> str:
    return ", ".join(f"{arr}[{i + 1}] AS {_qi(f)}" for i, f in enumerate(fields))


def statements() -> dict[str, str]:
    P = prefix()
    tok = "list_filter(string_split(line, chr(9)), lambda x: x <> '')"
    fld = ("(CASE WHEN regexp_full_match(line, '\\t+') THEN CAST([] AS VARCHAR[]) "
           "ELSE string_split(regexp_replace(line, '\\t+$', ''), chr(9)) END)")
    s: dict[str, str] = {}

    s["scan_hour_range"] = (P + "x AS (SELECT 1)\n"
        f"SELECT strftime(ts, '%Y%m%d%H') AS dthr, line AS value FROM imp_lines "
        f"WHERE strftime(ts, '%Y%m%d%H') BETWEEN {q(SCAN_FROM)} AND {q(SCAN_TO)}")
    s["scan_manifest"] = s["scan_hour_range"]
    s["parse_impressions_tokens"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, {_fields('t', LOG_FIELDS)} FROM (SELECT event_id, {tok} AS t FROM imp_lines)")
    s["parse_impressions_fields"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, {_fields('t', LOG_FIELDS)} FROM (SELECT event_id, {fld} AS t FROM imp_lines)")
    s["parse_retarg_first"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, t[1] AS cookie, t[2] AS payload FROM (SELECT event_id, {tok} AS t FROM conv_lines) "
        f"WHERE t[1] IS NOT NULL AND t[2] IS NOT NULL")
    s["parse_retarg_all"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, cookie, CAST(unnest(generate_series(0, len(pl) - 1)) AS INTEGER) AS pos, "
        f"unnest(pl) AS payload FROM (SELECT event_id, t[1] AS cookie, t[2:] AS pl FROM "
        f"(SELECT event_id, {fld} AS t FROM conv_lines) WHERE len(t) > 1 AND length(t[1]) = 32)")
    s["route_mixed"] = (P + "ml AS (SELECT event_id, line FROM imp_lines UNION ALL SELECT event_id, line FROM conv_lines)\n"
        f"SELECT event_id, CASE WHEN length(t[1]) = 32 THEN 'CONV' ELSE 'IMP' END AS kind "
        f"FROM (SELECT event_id, {fld} AS t FROM ml) WHERE len(t) > 1")
    s["pixel_map"] = (P + "x AS (SELECT 1)\n"
        f"SELECT pm.ord, pm.pixel, pm.campaign_id, pm.category, COALESCE(nc.n_conv, 0) AS n_conv, "
        f"COALESCE(ni.n_imp, 0) AS n_imp FROM pm "
        f"LEFT JOIN (SELECT {ext('payload', RE_CMPN)} AS pixel, count(*) AS n_conv FROM conv "
        f"WHERE {ext('payload', RE_CMPN)} IN (SELECT pixel FROM pm) GROUP BY 1) nc ON nc.pixel = pm.pixel "
        f"LEFT JOIN (SELECT {norm('campaign_id')} AS campaign_id, count(*) AS n_imp FROM imp "
        f"WHERE campaign_id IS NOT NULL AND {norm('campaign_id')} IN (SELECT campaign_id FROM pm) GROUP BY 1) ni "
        f"ON ni.campaign_id = pm.campaign_id")
    s["adgroup_filter"] = (P + "x AS (SELECT 1)\n"
        "SELECT adgroup_id, count(*) AS n_imp FROM imp WHERE adgroup_id IN (SELECT adgroup_id FROM adg) "
        "GROUP BY adgroup_id")
    s["agg_row_parse"] = P + _intermediate() + "SELECT key, tag, value FROM tg"
    s["agg_pivot"] = (P + _intermediate() +
        "SELECT key, COALESCE(sum(CASE WHEN tag = 'IMP' THEN value END), 0.0) AS imp, "
        "COALESCE(sum(CASE WHEN tag = 'CONV' THEN value END), 0.0) AS conv FROM tg GROUP BY key")
    s["collect_impressions"] = P + "x AS (SELECT 1)\nSELECT * FROM ia"
    s["sink_partitioned"] = s["collect_impressions"]
    s["collect_conversions"] = (P + "x AS (SELECT 1)\n"
        "SELECT hour_group, state, os, browser, category, round(conv, 6) AS conv FROM ca")
    s["agg_rate"] = (P + "g AS (SELECT DISTINCT hour_group FROM ia WHERE hour_group IN ('1','2','3','4') "
        "INTERSECT SELECT DISTINCT hour_group FROM ca WHERE hour_group IN ('1','2','3','4'))\n"
        "SELECT ia.hour_group, ia.state, ia.os, ia.browser, ia.category, CAST(ia.imp AS DOUBLE) AS imp, "
        "round(COALESCE(ca.conv, 0.0), 6) AS conv, "
        "round((COALESCE(ca.conv, 0.0) + 1.0) / (CAST(ia.imp AS DOUBLE) + 1000.0), 8) AS rate "
        "FROM ia LEFT JOIN ca ON ia.hour_group = ca.hour_group AND ia.state = ca.state AND ia.os = ca.os "
        "AND ia.browser = ca.browser AND ia.category = ca.category "
        "WHERE ia.hour_group IN (SELECT hour_group FROM g) AND ia.imp > 0")

    # absent fields and malformed lines, from the error events
    err = "err AS (SELECT *, k % 6 AS gap, md5(CAST(user_id AS VARCHAR)) AS ck, CAST(k AS VARCHAR) AS kt FROM ev WHERE event_type = 'error')"
    ml = (err + ", ml AS (SELECT event_id, CASE gap WHEN 0 THEN repeat(chr(9), 3) WHEN 1 THEN kt WHEN 2 THEN ck "
          "WHEN 3 THEN concat_ws(chr(9), ck, 'x' || kt, '', 'z' || kt, '', '') WHEN 4 THEN concat_ws(chr(9), substr(ck, 1, 31), kt) "
          "ELSE concat_ws(chr(9), 'b', '', kt) END AS line FROM err)\n")
    s["required_fields"] = (P + err + f", st AS (SELECT *, {ctr_state('geo')} AS state FROM (SELECT *, "
        f"CASE WHEN gap <> 4 THEN {lst(fx.GEOS)}[1 + user_id % 6] END AS geo FROM err))\n"
        "SELECT event_id, 'ids' AS has, state FROM st WHERE gap NOT IN (1, 2, 3) "
        "UNION ALL SELECT event_id, 'timestamp', state FROM st WHERE gap <> 0 "
        "UNION ALL SELECT event_id, 'cookie', state FROM st WHERE gap <> 5")
    s["route_malformed"] = (P + ml + "SELECT event_id, CASE WHEN length(t[1]) = 32 THEN 'CONV' ELSE 'IMP' END AS kind "
        f"FROM (SELECT event_id, {fld} AS t FROM ml) WHERE len(t) > 1")
    s["retarg_all_malformed"] = (P + ml + "SELECT event_id, cookie, CAST(unnest(generate_series(0, len(pl) - 1)) AS INTEGER) AS pos, "
        "unnest(pl) AS payload FROM (SELECT event_id, t[1] AS cookie, t[2:] AS pl FROM "
        f"(SELECT event_id, {fld} AS t FROM ml) WHERE len(t) > 1 AND length(t[1]) = 32)")
    s["retarg_first_malformed"] = (P + ml + f"SELECT event_id, t[1] AS cookie, t[2] AS payload FROM (SELECT event_id, {tok} AS t FROM ml) "
        "WHERE t[1] IS NOT NULL AND t[2] IS NOT NULL")
    s["fields_malformed"] = (P + ml + "SELECT event_id, " + ", ".join(f"t[{i}] AS f{i}" for i in range(1, 6))
        + f" FROM (SELECT event_id, {fld} AS t FROM ml)")
    s["agg_row_malformed"] = (P + err + "\nSELECT concat_ws(chr(9), '1', 'CA', 'os', 'b', 'cat' || kt) AS key, 'IMP' AS tag, "
        "CAST(k AS DOUBLE) AS value FROM err WHERE k % 3 = 1")
    part = _collect_conversions_body("cp")
    s["agg_rate_one_sided"] = (P + "cp AS (SELECT * FROM conv WHERE hour(ts) BETWEEN 1 AND 17),\n"
        f"cb AS ({part}),\n"
        "g AS (SELECT DISTINCT hour_group FROM ia WHERE hour_group IN ('1','2','3','4') "
        "INTERSECT SELECT DISTINCT hour_group FROM cb)\n"
        "SELECT ia.hour_group, ia.state, ia.os, ia.browser, ia.category, CAST(ia.imp AS DOUBLE) AS imp, "
        "round(COALESCE(cb.conv, 0.0), 6) AS conv, "
        "round((COALESCE(cb.conv, 0.0) + 1.0) / (CAST(ia.imp AS DOUBLE) + 1000.0), 8) AS rate "
        "FROM ia LEFT JOIN cb USING (hour_group, state, os, browser, category) "
        "WHERE ia.hour_group IN (SELECT hour_group FROM g) AND ia.imp > 0")

    # scalar functions
    s["norm_marker"] = (P + "x AS (SELECT 1)\nSELECT event_id, " + ", ".join(
        f"{norm(_qi(c))} AS {_qi(c)}" for c in
        ("browser", "os", "timestamp", "geo_location", "cookie", "visibility")) + " FROM imp")
    pats = {"cmpn": RE_CMPN, "brwsos": RE_BRWSOS, "pdate": RE_DATE, "st": RE_STATE, "phour": RE_CONV_HOUR}
    s["payload_extract"] = (P + "x AS (SELECT 1)\nSELECT event_id, " + ", ".join(
        f"{norm(ext('payload', p))} AS {n}" for n, p in pats.items()) + " FROM conv")
    s["clean_browser"] = P + f"x AS (SELECT 1)\nSELECT event_id, {clean_browser(norm('browser'))} AS browser FROM imp"
    s["clean_os"] = P + f"x AS (SELECT 1)\nSELECT event_id, {clean_os(norm('os'))} AS os FROM imp"
    d = fmt_ms(norm('"timestamp"'))
    s["seq_features"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, regexp_extract({d}, {q(RE_SEQ_HOUR)}, 1) AS hour, "
        f"{clean_os(norm('os'), False)} AS os, {clean_browser(norm('browser'), False)} AS browser FROM imp")
    ua = norm(ext("payload", RE_BRWSOS))
    s["classify_user_agent"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, {classify(ua, 0)} AS os_name, {classify(ua, 1)} AS browser_name, "
        f"{clean_os(classify(ua, 0))} AS os, {clean_browser(classify(ua, 1))} AS browser FROM conv")
    s["format_epoch_ms"] = P + f"x AS (SELECT 1)\nSELECT event_id, {fmt_ms(_qi('timestamp'))} AS formatted FROM imp"
    day = f"substr({norm(ext('payload', RE_DATE))}, 1, 8)"
    s["day_shift"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, day, {day_shift('day', 1)} AS next_day, {day_shift('day', -1)} AS prev_day, "
        f"{day_shift('day', 45)} AS plus_45, {day_shift('day', 0)} AS same_day "
        f"FROM (SELECT event_id, {day} AS day FROM conv)")
    s["hour_group_impressions"] = P + f"x AS (SELECT 1)\nSELECT event_id, {hg_imp(_qi('timestamp'))} AS hour_group FROM imp"
    s["hour_group_conversions"] = P + f"x AS (SELECT 1)\nSELECT event_id, {hg_conv('payload')} AS hour_group FROM conv"
    s["hour_group_ctr"] = P + f"x AS (SELECT 1)\nSELECT event_id, {hg_ctr(_qi('date'))} AS hour_group FROM imp"
    g = norm("geo_location")
    s["geo_state_dma"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, {geo_state(g)} AS state, {geo_dma(g)} AS dma, {ctr_state('geo_location')} AS ctr_state FROM imp")
    ctr_cols = _ctr_dim_cols()
    s["ctr_dims"] = P + "x AS (SELECT 1)\nSELECT event_id, " + ctr_cols + " FROM imp"
    s["weighted_argmax"] = P + f"x AS (SELECT 1)\nSELECT event_id, {weighted_argmax('verticle_list')} AS vertical FROM imp"
    s["weighted_pick"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, {weighted_pick('user_seg_list', 'event_id', '0')} AS segment FROM imp")

    # filters and joins
    s["filter_known_pixels"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, {ext('payload', RE_CMPN)} AS pixel FROM conv WHERE {ext('payload', RE_CMPN)} IN (SELECT pixel FROM pm)")
    s["filter_known_campaigns"] = (P + "x AS (SELECT 1)\n"
        f"SELECT event_id, campaign_id FROM imp WHERE campaign_id IS NOT NULL AND {norm('campaign_id')} IN (SELECT campaign_id FROM pm)")
    s["conv_fanout"] = (P + "x AS (SELECT 1)\n"
        f"SELECT c.event_id, w.pixel, w.category, w.weight FROM conv c JOIN pw w ON w.pixel = {ext('c.payload', RE_CMPN)}")
    s["campaign_category"] = (P + "x AS (SELECT 1)\n"
        f"SELECT i.event_id, {norm('i.campaign_id')} AS campaign_id, {norm('c.category')} AS category "
        f"FROM imp i JOIN cat c ON c.campaign_id = {norm('i.campaign_id')} WHERE i.campaign_id IS NOT NULL")
    s["pixel_lists"] = (P + "x AS (SELECT 1)\n"
        f"SELECT l.pixel, l.campaigns, COALESCE(n.n_conv, 0) AS n_conv FROM "
        f"(SELECT pixel, array_to_string(list_sort(list(campaign_id)), ',') AS campaigns FROM pm GROUP BY pixel) l "
        f"LEFT JOIN (SELECT {ext('payload', RE_CMPN)} AS pixel, count(*) AS n_conv FROM conv GROUP BY 1) n "
        f"ON n.pixel = l.pixel")

    # sequence
    s["seq_events"] = P + "x AS (SELECT 1)\nSELECT * FROM tl"
    s["seq_dedup"] = (P + "tl2 AS (SELECT *, substr(event_date, 1, 11) AS event_hour FROM tl)\n"
                      + "SELECT * FROM (" + _dedup("cookie, event_hour") + ")")
    s["seq_label"] = P + _seq_label_body() + "SELECT * FROM lab"
    s["sink_flat"] = s["seq_label"]
    s["seq_label_mixed"] = s["seq_label"]
    s["seq_label_split"] = s["seq_label"]
    s["check_label_bound"] = (P + _seq_label_body() +
        "SELECT CAST(COALESCE(sum(label), 0) AS BIGINT) AS labels, count(*) AS rows, "
        "(SELECT count(*) FROM conv WHERE length(cookie) = 32) AS conversions, "
        "COALESCE(sum(label), 0) <= (SELECT count(*) FROM conv WHERE length(cookie) = 32) AS bounded FROM lab")
    s["check_credit_conserved"] = (P + "x AS (SELECT 1)\n"
        f"SELECT (SELECT count(*) FROM conv WHERE {ext('payload', RE_CMPN)} IN (SELECT pixel FROM pm)) AS kept, "
        f"round((SELECT sum(conv) FROM ca), 6) AS credit")

    # ctr
    ctr_where = "adgroup_id IS NOT NULL AND COALESCE(adgroup_id, '') <> '' AND COALESCE(campaign_id, '') <> ''"
    body = (f"SELECT hour_group, state, view, vertical, campaign, count(*) AS imp, CAST(sum(click) AS BIGINT) AS clk, "
            f"CAST(sum(click) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS ctr FROM (SELECT {ctr_cols} FROM imp WHERE @WHERE@) "
            f"GROUP BY hour_group, state, view, vertical, campaign")
    s["ctr_leaves"] = P + "x AS (SELECT 1)\n" + body.replace("@WHERE@", ctr_where + " AND adgroup_id IN (SELECT adgroup_id FROM adg)")
    ctrlog = (f"ctrlog AS (SELECT {_fields('t', LOG_FIELDS[:CTR_FIELD_COUNT])} FROM "
              f"(SELECT {tok} AS t FROM imp_lines))\n")
    s["ctr_leaves_text"] = P + ctrlog + body.replace("FROM imp WHERE", "FROM ctrlog WHERE").replace(
        "@WHERE@", ctr_where + " AND adgroup_id IN (SELECT adgroup_id FROM adg)")
    s["agg_rate_text"] = (P + _intermediate() +
        ", hg AS (SELECT key, tag, value, split_part(key, chr(9), 1) AS hour_group FROM tg),\n"
        "good AS (SELECT hour_group FROM hg WHERE tag = 'IMP' AND hour_group IN ('1','2','3','4') "
        "INTERSECT SELECT hour_group FROM hg WHERE tag = 'CONV' AND hour_group IN ('1','2','3','4')),\n"
        "pv AS (SELECT key, COALESCE(sum(CASE WHEN tag = 'IMP' THEN value END), 0.0) AS imp, "
        "COALESCE(sum(CASE WHEN tag = 'CONV' THEN value END), 0.0) AS conv FROM hg "
        "WHERE hour_group IN (SELECT hour_group FROM good) GROUP BY key)\n"
        "SELECT key, imp, conv, round((conv + 1.0) / (imp + 1000.0), 8) AS rate FROM pv WHERE imp > 0")
    s["agg_rate_bucketed"] = s["agg_rate"]
    s["agg_rate_files"] = s["agg_rate_text"]
    implog = (f"implog AS (SELECT {_fields('t', LOG_FIELDS)} FROM "
              f"(SELECT {tok} AS t FROM imp_lines))\n")
    s["collect_impressions_table_map"] = s["collect_impressions"]
    s["collect_conversions_table_map"] = s["collect_conversions"]
    s["seq_label_table_map"] = s["seq_label"]
    s["collect_impressions_text"] = P + implog + _collect_impressions_body("implog")
    convlog = (f"convlog AS (SELECT t[1] AS cookie, t[2] AS payload FROM (SELECT {tok} AS t FROM conv_lines) "
               f"WHERE t[1] IS NOT NULL AND t[2] IS NOT NULL)\n")
    s["collect_conversions_text"] = (P + convlog + "SELECT hour_group, state, os, browser, category, "
                                     "round(conv, 6) AS conv FROM (" + _collect_conversions_body("convlog") + ")")
    s["ctr_leaves_all"] = P + "x AS (SELECT 1)\n" + body.replace("@WHERE@", ctr_where)
    return s


def _ctr_dim_cols() -> str:
    return ", ".join([
        f"{hg_ctr(_qi('date'))} AS hour_group",
        f"{ctr_state('geo_location')} AS state",
        "COALESCE(NULLIF(visibility, ''), 'NO_DETECTION') AS view",
        f"(CASE WHEN verticle_list IS NULL THEN '' ELSE {weighted_argmax('verticle_list')} END) AS vertical",
        "campaign_id AS campaign",
        "CASE WHEN click_flag = '1' THEN 1 ELSE 0 END AS click",
    ])
