"""Spark jobs and functions against plain-Python models on random inputs."""

import datetime as dt
import random
import re

from log_frames import conv_frame, imp_frame
from pyspark.sql import functions as F

from pixelflow import functions as pf
from pixelflow.plans import sequence_labels
from pixelflow.sources import fixtures as fx

PIX = fx.PIXEL_SPEC
ENTRIES = [e.split("|") for e in PIX.split(",")]
PAIRS = {(p, c) for p, c, _ in ENTRIES}
PIXELS = {p for p, _, _ in ENTRIES}
CATEGORY = {c: cat for _, c, cat in ENTRIES}          # later entries overwrite: last wins
DAY0 = 1704067200000


def m_norm(v):
    return "-" if v is None or v.lower() in ("", "unknown", "null") else v


def m_fmt(v):
    if not re.fullmatch(r"[+-]?[0-9]+", v or ""):
        return ""
    t = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=int(v))
    return t.strftime("%Y%m%d %H:%M:%S")


def m_geo_state(v):
    parts = v.rstrip("|").split("|") if v.rstrip("|") else [""]
    return m_norm(parts[0] if len(parts) >= 3 else "")


def m_group(p, pat):
    m = re.search(pat, p)
    return m.group(1) if m else ""


def model_sequence(imps, convs):
    line = {}

    def put(cookie, date, prio, rec):
        cur = line.setdefault(cookie, {}).get(date)
        if cur is None or prio > cur[0]:
            line[cookie][date] = (prio, rec)

    for r in imps:
        camp, cookie = m_norm(r["campaign_id"]), r["cookie"]
        if camp not in CATEGORY or m_norm(cookie) == "-":
            continue
        date = m_fmt(m_norm(r["timestamp"]))
        hour = m_group(date, r"\s(\d\d?):.+?")
        dims = (hour, m_geo_state(m_norm(r["geo_location"])),
                re.sub(r"\s|(\(.+?\))|\.[a-zA-Z0-9]+?", "", m_norm(r["os"])),
                re.sub(r"[^a-zA-Z]", "", m_norm(r["browser"])), m_norm(CATEGORY[camp]))
        put(cookie, date, (0, r["event_id"], 0), ("I", camp, dims))
    for eid, cookie, payloads in convs:
        kept = [(i, p) for i, p in enumerate(payloads) if m_group(p, r'"cmpn":"(\w+?)"') in PIXELS]
        if not kept:
            continue
        put(cookie, "-", (1, eid, 0), ("C", "-"))
        for i, p in kept:
            put(cookie, m_norm(m_group(p, r'"date":"(.+?)"')), (1, eid, i + 1),
                ("C", m_group(p, r'"cmpn":"(\w+?)"')))
    out = []
    for cookie, m in line.items():
        keys = sorted(m)
        for j, k in enumerate(keys):
            rec = m[k][1]
            if rec[0] != "I":
                continue
            nxt = m[keys[j + 1]][1] if j + 1 < len(keys) else None
            label = int(nxt is not None and nxt[0] == "C" and (nxt[1], rec[1]) in PAIRS)
            out.append((cookie,) + rec[2] + (label,))
    return sorted(out)


def random_logs(rng, n_imp=120, n_conv=60):
    cookies = [(c * 32)[:32] for c in "abcd"] + ["-"]
    secs = [rng.randrange(0, 6 * 3600) for _ in range(25)]           # few seconds -> collisions
    imps = []
    for i in range(n_imp):
        s = rng.choice(secs)
        ts = rng.choice([str(DAY0 + s * 1000 + rng.randrange(1000))] * 8 + ["null", "x1", ""])
        imps.append(dict(event_id=i, cookie=rng.choice(cookies), campaign_id=f"c{rng.randrange(8)}",
                         timestamp=ts, geo_location=rng.choice(["CA|US|807", "WA", "|US|1", "unknown|x|y"]),
                         os=rng.choice(["Windows 8.1", "null", "iOS 8 (iPhone)"]),
                         browser=rng.choice(["Chrome 38", "unknown", "Safari"])))
    convs = []
    for i in range(n_conv):
        pls = []
        for _ in range(rng.randrange(1, 4)):
            s = rng.choice(secs)
            d = (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)).strftime("%Y%m%d %H:%M:%S")
            date = f',"date":"{d}"' if rng.random() > 0.1 else ""
            pls.append(f'{{"cmpn":"p{rng.randrange(6)}"{date}}}')
        convs.append((1000 + i, rng.choice(cookies[:4]), pls))
    return imps, convs


def test_sequence_labels_match_model(spark):
    for seed in (1, 2, 3):
        imps, convs = random_logs(random.Random(seed))
        out = sequence_labels(spark, imp_frame(spark, imps), conv_frame(spark, convs), PIX)
        got = sorted(tuple(r) for r in out.collect())
        assert got == model_sequence(imps, convs), f"seed {seed}"


def m_argmax(v):
    best, top = "", 0.0
    for e in [x for x in (v or "").split("|") if x]:
        p = e.rstrip(",").split(",") if e.rstrip(",") else [""]
        if len(p) != 2:
            continue
        try:
            w = float(p[1])
        except ValueError:
            continue
        if w == w and w >= top:
            best, top = p[0], w
    return best


def test_list_geo_marker_epoch_functions_match_models(spark):
    rng = random.Random(7)
    tok = ["a", "b", "", "0.5", "1", "-1", "x", "0", "2.5", "1e1", "NaN", "-0", "-0.0", " 3 ", ",", "inf"]
    lists = ["|".join(",".join(rng.choice(tok) for _ in range(rng.randrange(1, 4)))
                      for _ in range(rng.randrange(0, 5))) for _ in range(300)]
    geos = ["|".join(rng.choice(["", "CA", "null", "US", "7"]) for _ in range(rng.randrange(1, 5)))
            for _ in range(300)]
    marks = [rng.choice(["", "NULL", "Unknown", "x", "nul", "unknownx", "-"]) for _ in range(300)]
    nums = [rng.choice([str(rng.randrange(-10**13, 10**13)), "+12", "1.5", "", "abc"]) for _ in range(300)]
    df = spark.createDataFrame(list(zip(lists, geos, marks, nums)), "l string, g string, m string, n string")
    got = df.select(pf.weighted_argmax("l"), pf.geo_state(pf.norm_marker("g")), pf.norm_marker("m"),
                    pf.format_epoch_ms("n")).collect()
    for (l, g, m, n), r in zip(zip(lists, geos, marks, nums), got):
        assert tuple(r) == (m_argmax(l), m_geo_state(m_norm(g)), m_norm(m), m_fmt(n)), (l, g, m, n)


def _lines(imps, convs):
    from pixelflow.constants import LOG_FIELDS
    out = []
    for r in imps:
        vals = [r.get(f) or "" for f in LOG_FIELDS]
        out.append((r["event_id"], "\t".join(vals)))
    for eid, cookie, pls in convs:
        out.append((eid, "\t".join([cookie] + pls)))
    return out


def test_mixed_input_sequence_matches_model(spark):
    from pixelflow.plans import sequence_labels_mixed
    for seed in (4, 5):
        imps, convs = random_logs(random.Random(seed))
        # the model reads absent fields as empty text, as a text line carries them
        imps = [dict(r, **{k: (v if v is not None else "") for k, v in r.items()}) for r in imps]
        df = spark.createDataFrame(_lines(imps, convs), "event_id bigint, value string")
        got = sorted(tuple(r) for r in sequence_labels_mixed(spark, df, PIX, tie_col="event_id").collect())
        assert got == model_sequence(imps, convs), f"seed {seed}"


def test_split_sequence_matches_model(spark):
    from pixelflow.plans import sequence_labels_split
    for seed, hot_rows, slice_rows in ((4, 1, 3), (5, 3, 10), (6, 10, 2), (7, 10**6, 5)):
        imps, convs = random_logs(random.Random(seed))
        imps = [dict(r, **{k: (v if v is not None else "") for k, v in r.items()}) for r in imps]
        df = spark.createDataFrame(_lines(imps, convs), "event_id bigint, value string")
        got = sorted(tuple(r) for r in sequence_labels_split(spark, df, PIX, tie_col="event_id", hot_rows=hot_rows, slice_rows=slice_rows).collect())
        assert got == model_sequence(imps, convs), f"seed {seed}"


def test_parsers_match_split_models(spark):
    from pixelflow.constants import LOG_FIELDS
    from pixelflow.sources import logs
    rng = random.Random(11)
    alphabet = ["", "", "a", "b1", "null", " ", "x|y"]
    lines = ["\t".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 70))) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id bigint, value string")
    tok = {r[0]: tuple(r[1:]) for r in logs.parse_impressions_tokens(df, keep=("id",)).collect()}
    fld = {r[0]: tuple(r[1:]) for r in logs.parse_impressions_fields(df, keep=("id",)).collect()}
    n = len(LOG_FIELDS)
    for i, v in enumerate(lines):
        t = [x for x in v.split("\t") if x]
        f = v.split("\t")
        if len(f) > 1:                       # a separator matched: drop trailing empties
            while f and f[-1] == "":
                f.pop()
        assert tok[i] == tuple(t[:n] + [None] * (n - len(t[:n]))), v
        assert fld[i] == tuple(f[:n] + [None] * (n - len(f[:n]))), v
    first = {r[0]: (r[1], r[2]) for r in logs.parse_retarg_first(df, keep=("id",)).collect()}
    for i, v in enumerate(lines):
        t = [x for x in v.split("\t") if x]
        assert first.get(i) == ((t[0], t[1]) if len(t) >= 2 else None), v


HOURS = {f"{h:02d}": g for g, hs in (("1", range(7, 14)), ("2", range(14, 18)), ("3", [18, 19, 20, 21, 22, 23, 0]),
                                     ("4", range(1, 7))) for h in hs}


def test_payload_and_hour_rules_match_models(spark):
    from pixelflow.constants import RE_BRWSOS, RE_CMPN, RE_DATE, RE_STATE
    rng = random.Random(13)
    frags = ['"cmpn":"p1"', '"cmpn":"px-1"', '"cmpn":""', '"st":""', '"st":"CA"', '"st":"unknown"',
             '"date":"20141007 13:22:11"', '"date":"20141007 7:22:11"', '"date":"x"', '"date":""',
             '"brwsos":"Mozilla/5.0 (X11)"', '"brwsos":"null"', 'junk', '']
    pays = ["{" + ",".join(rng.choice(frags) for _ in range(rng.randrange(0, 6))) + "}" for _ in range(300)]
    dates = [rng.choice(["2024-01-01 14:00:00", "2024-01-01 7:05:00", "no hour", "12:", "99:00", "x 00:1"])
             for _ in range(300)]
    df = spark.createDataFrame(list(zip(pays, dates)), "p string, d string")
    pats = (RE_CMPN, RE_BRWSOS, RE_DATE, RE_STATE)
    got = df.select(*[pf.payload_extract("p", x) for x in pats], pf.hour_group_conversions("p"),
                    pf.hour_group_ctr("d")).collect()
    for (p, d), r in zip(zip(pays, dates), got):
        exp = [m_norm(m_group(p, x)) for x in pats]
        h = m_norm(m_group(p, r'"date":".+? (\d+?):.+?"'))
        exp.append(HOURS.get(h, "-"))
        hh = m_group(d, r"(\d\d?):.+?") or "null"
        exp.append(HOURS.get(hh, hh))
        assert list(r) == exp, (p, d)


def test_epoch_hour_matches_formatted_hour(spark):
    from pixelflow.functions.dates import epoch_hour
    rng = random.Random(17)
    vals = [str(rng.randrange(-10**13, 10**13)) for _ in range(400)] + ["-1", "0", "x", "", "+3600000"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = df.select(epoch_hour("c"), F.regexp_extract(pf.format_epoch_ms("c"), r"(\d\d?):.+?", 1)).collect()
    for v, (a, b) in zip(vals, got):
        assert a == b, v


def _parts(v):
    t = v.rstrip("|")
    return t.split("|") if t else [""]


def test_geo_variants_and_day_shift_match_models(spark):
    rng = random.Random(19)
    geos = ["|".join(rng.choice(["", "CA", "null", "NULL", "US", "807", "unknown"]) for _ in range(rng.randrange(1, 6)))
            for _ in range(300)] + [None]
    days = [rng.choice(["20240131", "20241231", "20240229", "20230229", "2024013", "x", "", "20240100",
                        f"2024{rng.randrange(1, 13):02d}{rng.randrange(1, 29):02d}"]) for _ in range(301)]
    df = spark.createDataFrame(list(zip(geos, days)), "g string, d string")
    got = df.select(pf.geo_dma(pf.norm_marker("g")), pf.ctr_state("g"), pf.day_shift("d", 1),
                    pf.day_shift("d", -40)).collect()

    def m_ctr_state(v):
        if v is None:
            return ""
        p = _parts(v)
        s = p[0] if len(p) >= 3 else ""
        return "null" if s == "" or s.lower() == "null" else s

    def m_shift(v, n):
        if not re.fullmatch(r"[0-9]{8}", v):
            return ""
        try:
            d = dt.datetime.strptime(v, "%Y%m%d")
        except ValueError:
            return ""
        return (d + dt.timedelta(days=n)).strftime("%Y%m%d")

    for (g, d), r in zip(zip(geos, days), got):
        p = _parts(m_norm(g))
        dma = m_norm(p[2] if len(p) >= 3 else "")
        assert tuple(r) == (dma, m_ctr_state(g), m_shift(d, 1), m_shift(d, -40)), (g, d)
