"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, schemes, plus
signs, digits and identifier cue words.  Deterministic local parsers expand
each anchor to the boundaries of an email address, IP address, card number,
phone number (the base kinds, leftmost and non-overlapping per kind), IBAN,
URL with credentials, or account number after a cue that is a word of its
own, and validate it (part sizes, Luhn, digit counts, mod 97).  Parsers read around an anchor only and each
keeps a floor (the end of its last match), so the work stays linear.

Nulls and edges: a null text counts as empty and has no spans; whole texts
are searched, whatever their length; other columns are carried unread (null
and repeated ids are fine); an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pixelflow.llm.common import map_batches

#: Kinds in span order; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "login", "account")
N_BASE = 4
SPAN = "array<struct<ord: int, start: int, end: int, kind: string>>"

#: The character classes of the base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){0,3}")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

CUES = ("account", "acct", "konto", "kontonummer", "cuenta", "compte", "passport", "ssn")
#: After a cue: a designator, if any, that ends its word, then the value.
CUED = re.compile(r"(?: ?(?:no|nr|number|num|id))?(?u:(?![^\W\d_]))\.?[ ]?[:#=]?[ ]?(?=([A-Z0-9][A-Z0-9-]{4,32}[A-Z0-9])(?![A-Za-z0-9]))", re.I | re.A)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country (IBAN registry).
IBAN_SIZES = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
LOGIN = re.compile(r"://[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, "digit")
    a.add_word("@", "at")
    a.add_word("+", "plus")
    a.add_word("://", "scheme")
    for c in CUES:
        for w in (c, c.capitalize(), c.upper()):
            a.add_word(w, w)
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def iban_end(text: str, start: int) -> int:
    """The end of the IBAN at ``start``, or 0: where its country's size ends,
    or, of an unknown country, the longest groups of 15 characters or more that
    pass mod 97."""
    m = IBAN.match(text, start)
    if not m:
        return 0
    run, size = m[0], IBAN_SIZES.get(text[start:start + 2])
    ends = [len(run), *(k for k in range(len(run) - 1, 14, -1) if run[k] == " ")]
    codes = {k: run[:k].replace(" ", "") for k in ends}
    return next((start + k for k in ends if len(codes[k]) == (size or max(len(codes[k]), 15)) and mod97(codes[k])), 0)


def spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of one text, sorted; code points, end exclusive."""
    out: list[tuple[int, int, int]] = []
    at_floor = ip_floor = card_floor = phone_floor = iban_floor = login_floor = 0
    for end, what in automaton().iter(text):
        p = end
        if what == "digit":
            if p >= ip_floor:
                m = DOTTED.match(text, p)
                ip_floor = m.end()
                parts = m[0].split(".")
                if len(parts) == 4 and all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in parts):
                    out.append((1, p, ip_floor))
            if p >= card_floor:
                m = DIGITS.match(text, p)
                card_floor = m.end()
                if card_floor - p >= 13:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out.append((2, p, card_floor))
            if p >= iban_floor + 2 and "A" <= text[p - 1] <= "Z" and not (p > 2 and text[p - 3].isalnum()):
                if stop := iban_end(text, p - 2):
                    out.append((4, p - 2, stop))
                    iban_floor = stop
        elif what == "at":
            if m := DOMAIN.match(text, p + 1):
                s = p
                while s > at_floor and text[s - 1] in LOCAL:
                    s -= 1
                if s < p:
                    out.append((0, s, m.end()))
                    at_floor = m.end()
        elif what == "plus":
            if p >= phone_floor and (m := PHONE.match(text, p)):
                phone_floor = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, p, phone_floor))
        elif what == "scheme":
            s = p - 2
            if s >= login_floor and (m := LOGIN.match(text, s)):
                b = s
                while b > login_floor and text[b - 1].isascii() and text[b - 1].isalnum():
                    b -= 1
                if b < s:
                    out.append((5, b, m.end()))
                    login_floor = m.end()
        elif not text[max(p - len(what), 0):p - len(what) + 1].isalpha() and (m := CUED.match(text, p + 1)) and sum(c.isdigit() for c in m[1]) >= 6:
            out.append((6, m.start(1), m.end(1)))
    return sorted(set(out))


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans``: array<struct<ord, start, end, kind>> sorted by
    kind, then start."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    names = [f.name for f in fields]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    kind = pa.list_(pa.struct([("ord", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [[(k, s, e, KINDS[k]) for k, s, e in spans(t.as_py() or "")] for t in b.column("text")]
        as_dicts = [[dict(zip(("ord", "start", "end", "kind"), x)) for x in one] for one in found]
        return pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(as_dicts, kind)], [*names, "spans"])
    return map_batches(docs.select(*dict.fromkeys([*names, "text"])), batch, f"{ddl}spans {SPAN}")


def render(found: Column) -> Column:
    """``kind:start:end``, comma-joined in the given order."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(text: Column, found: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by its
    kind's mark, such as ``<EMAIL>``; a null text stays null."""
    by_start = F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k"))))
    done = F.aggregate(
        by_start, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.when(x["s"] < acc["at"], F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(x["e"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]),
                                                  F.lit("<"), F.upper(x["k"]), F.lit(">")).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) == 0, text).otherwise(done)
