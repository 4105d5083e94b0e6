"""Secret scans: fixed patterns and a randomness test battery.

Three fixed kinds (``assign``, ``access``, ``hex``) are found as leftmost
non-overlapping matches.  Further spans (``random``) come from the battery:
every run of 20 or more characters of the common encodings is a candidate;
its encoding is inferred (hex, base32, base62, base64), its symbols fall into
eight bins of the encoding's alphabet, and three statistics are taken of them:

* chi-squared of the bins against the uniform alphabet,
* the runs test (lower against upper half of the alphabet),
* the lag-1 serial correlation of the bins.

The fourth is the likelihood ratio of the whole alphabet's symbols under the
uniform alphabet against ordinary strings (small letters, capitals, mixed case,
numbers; each with the letter shares of text), as a p-value of ordinary strings
by Chernoff's bound; the largest over their kinds counts.

A candidate is reported when the first three do not reject randomness
(Bonferroni at ``alpha``) and ordinary text is rejected under
Benjamini-Hochberg control at ``fdr`` among the candidates of the same
encoding and length band (powers of two) of the whole corpus.  P-values are
counted in steps of a twentieth of a decade, rounded up; the corpus-wide
table has at most encodings x bands x 601 rows.

DataFrame functions only.  The texts are read once into a narrow table of
spans and candidates.

Nulls and edges: a null text counts as empty and has no spans; ids are
carried unread (null and repeated ids are fine); an empty table gives no
rows; other columns are not read; whole texts are searched.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pixelflow.llm.common import stored

#: The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"       # the whole match has 20 characters at least
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("random",)

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
BINS = 8


@dataclass(frozen=True)
class Encoding:
    """An alphabet and the kinds of ordinary strings in it: the shares of
    small letters, capitals, digits and separators."""
    name: str
    pattern: str
    alphabet: str
    ordinary: tuple[tuple[float, float, float, float], ...]

    @property
    def bins(self) -> str:
        """The bin (digit) of each alphabet character."""
        return "".join(str(i * BINS // self.width) for i in range(len(self.alphabet)))

    @property
    def width(self) -> int:
        return max(len(self.alphabet), BINS)

    @property
    def uniform(self) -> list[float]:
        return [self.bins.count(str(b)) / len(self.alphabet) for b in range(BINS)]

    def shares(self, kind: tuple[float, ...]) -> dict[str, float]:
        """The share of each alphabet character in a kind of ordinary strings."""
        out = {}
        for group, share in zip((_LOW, _UP, _DIG, "+/"), kind):
            weight = {c: LETTERS.get(c.lower(), 1.0) for c in group if c in self.alphabet}
            out.update({c: share * w / sum(weight.values()) for c, w in weight.items()})
        return out

    def steps(self, kind: tuple[float, ...]) -> dict[str, int]:
        """The logarithm of each character's uniform over its ordinary share, in steps of 1 / SCALE."""
        return {c: math.floor(SCALE * math.log(1 / len(self.alphabet) / x)) for c, x in self.shares(kind).items()}


_UP, _LOW, _DIG = string.ascii_uppercase, string.ascii_lowercase, string.digits
SCALE, ZERO = 10, 0x4e00        # steps of a tenth, held as characters around this code
TILTS = (0.25, 0.5, 0.75, 1.0, 1.5)
#: Rounded shares of the letters in text, in per cent (the rarest raised).
LETTERS = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (
    12.0, 9.1, 8.1, 7.7, 7.3, 7.0, 6.3, 5.9, 6.0, 4.3, 4.0, 2.8, 2.9, 2.6, 2.1, 2.3, 2.0, 2.1, 1.9, 1.5, 1.1, 0.9, 0.3, 0.4, 0.3, 0.3)))
_TEXT = ((0.85, 0.06, 0.05, 0.04), (0.06, 0.85, 0.05, 0.04), (0.65, 0.2, 0.1, 0.05), (0.15, 0.08, 0.7, 0.07))
ENCODINGS = (
    Encoding("hex", "^([0-9a-f]+|[0-9A-F]+)$", _DIG + "abcdef", ((0.05, 0, 0.95, 0), (0.8, 0, 0.2, 0))),
    Encoding("base32", "^[A-Z2-7]+$", _UP + "234567", ((0, 0.95, 0.05, 0), (0, 0.3, 0.7, 0))),
    Encoding("base62", "^[A-Za-z0-9]+$", _UP + _LOW + _DIG, _TEXT),
    Encoding("base64", "^.*$", _UP + _LOW + _DIG + "+/", _TEXT),
)


@dataclass(frozen=True)
class ScanConfig:
    alpha: float = 0.001     # level of the three randomness tests together
    fdr: float = 0.05        # expected share of ordinary strings among the reported


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>> of the leftmost non-overlapping matches, in code
    points: the pieces between the matches give the offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    none = F.expr("cast(array() as array<struct<s: int, e: int, m: string>>)")
    spans = F.aggregate(
        F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("g"), m.alias("m"))),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + F.length(x["m"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["g"]).alias("s"),
                                                  (acc["at"] + x["g"] + F.length(x["m"])).alias("e"),
                                                  x["m"].alias("m")))).alias("out")),
        lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function (Abramowitz-Stegun 26.2.17)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def _per_encoding(name: Column, value) -> Column:
    out = None
    for e in ENCODINGS:
        out = F.when(name == e.name, value(e)) if out is None else out.when(name == e.name, value(e))
    return out


def _chi(bins: Column, n: Column, e: Encoding) -> Column:
    """Chi-squared of the bin counts against the uniform alphabet."""
    total = F.lit(0.0)
    for b, p in enumerate(e.uniform):
        count = n - F.length(F.replace(bins, F.lit(str(b)), F.lit("")))
        total = total + (count - n * p) * (count - n * p) / (n * p)
    return total


def _ratio(core: Column, e: Encoding) -> Column:
    """Minus the logarithm of the ordinary-text p-value: for each kind of
    ordinary strings the best Chernoff bound of the summed steps."""
    text = F.lower(core) if e.name == "hex" else core
    out = []
    for kind in e.ordinary:
        share, step = e.shares(kind), e.steps(kind)
        codes = "".join(chr(ZERO + step[c]) for c in e.alphabet)
        total = F.aggregate(F.split(F.translate(text, e.alphabet, codes), ""), F.lit(0), lambda a, c: a + F.ascii(c) - ZERO)
        grow = {t: math.log(sum(x * math.exp(t * step[c] / SCALE) for c, x in share.items())) for t in TILTS}
        bound = F.transform(F.array(total), lambda s: F.greatest(*[s * (t / SCALE) - F.length(core) * grow[t] for t in TILTS]))
        out.append(bound[0])
    return F.least(*out).cast("double")


def battery(token: Column, cfg: ScanConfig) -> Column:
    """struct<enc, band, step, fair>: encoding, length band, the ordinary-text
    p-value in twentieths of a decade (rounded up) and whether randomness
    stands."""
    core = F.regexp_replace(F.translate(token, "_-", "/+"), "=+$", "")
    enc = None
    for e in ENCODINGS:
        hit = core.rlike(e.pattern)
        enc = F.when(hit, e.name) if enc is None else enc.when(hit, e.name)
    one = F.struct(core.alias("core"), enc.alias("enc"))

    def with_bins(x: Column) -> Column:
        bins = _per_encoding(x["enc"], lambda e: F.translate(F.lower(x["core"]) if e.name == "hex" else x["core"], e.alphabet, e.bins))
        return F.struct(bins.alias("bins"), x["enc"].alias("enc"), F.length(x["core"]).cast("double").alias("n"),
                        _per_encoding(x["enc"], lambda e: _ratio(x["core"], e)).alias("ratio"))

    def with_counts(x: Column) -> Column:
        low_high = F.translate(x["bins"], "01234567", "00001111")
        values = F.transform(F.split(x["bins"], ""), lambda c: c.cast("double"))
        return F.struct(
            x["enc"].alias("enc"), x["n"].alias("n"), x["ratio"].alias("ratio"),
            _per_encoding(x["enc"], lambda e: _chi(x["bins"], x["n"], e)).alias("chi"),
            (x["n"] - F.length(F.replace(low_high, F.lit("1"), F.lit("")))).alias("ones"),
            F.length(F.regexp_replace(low_high, "0+|1+", "x")).cast("double").alias("runs"),
            values.alias("v"), (F.aggregate(values, F.lit(0.0), lambda a, c: a + c) / x["n"]).alias("mean"))

    def with_z(x: Column) -> Column:
        zeros = x["n"] - x["ones"]
        mu = 2 * zeros * x["ones"] / x["n"] + 1
        var = (mu - 1) * (mu - 2) / (x["n"] - 1)
        size = x["n"].cast("int")
        square = F.aggregate(x["v"], F.lit(0.0), lambda a, c: a + (c - x["mean"]) * (c - x["mean"]))
        cross = F.aggregate(F.zip_with(F.slice(x["v"], F.lit(1), size - 1), F.slice(x["v"], F.lit(2), size - 1),
                                       lambda p, q: (p - x["mean"]) * (q - x["mean"])), F.lit(0.0), lambda a, c: a + c)
        df = F.lit(BINS - 1.0)
        z_chi = (F.pow(x["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        z_runs = F.when(var > 0, (x["runs"] - mu) / F.sqrt(var)).otherwise(F.lit(99.0))
        z_serial = F.when(square > 0, cross / square * F.sqrt(x["n"])).otherwise(F.lit(99.0))

        p_rand = 3 * F.least(1 - normal_cdf(z_chi), 2 * (1 - normal_cdf(F.abs(z_runs))), 2 * (1 - normal_cdf(F.abs(z_serial))))
        p_text = F.greatest(F.least(F.exp(-x["ratio"]), F.lit(1.0)), F.lit(1e-30))
        return F.struct(x["enc"].alias("enc"), F.floor(F.log2(x["n"])).cast("int").alias("band"),
                        F.floor(-20 * F.log10(p_text)).cast("int").alias("step"), (p_rand >= cfg.alpha).alias("fair"))
    out = F.transform(F.array(one), with_bins)
    for step in (with_counts, with_z):
        out = F.transform(out, step)
    return out[0]


def scan(docs: DataFrame, cfg: ScanConfig = ScanConfig(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans``: array<struct<start, ord, end, kind>> (``ord`` is
    the kind's place in :data:`KINDS`), sorted by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(*[F.col(k) for k in keep], matches(text, ASSIGN).alias("_assign"), matches(text, ACCESS).alias("_access"),
                        matches(text, HEX).alias("_hex"), matches(text, CANDIDATE).alias("_cand"))

    def plain(c: Column, kind: str) -> Column:
        return F.transform(c, lambda x: F.struct(x["s"].alias("start"), F.lit(KINDS.index(kind)).alias("ord"),
                                                 x["e"].alias("end"), F.lit(kind).alias("kind")))
    assign = F.filter("_assign", lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6)
    base = F.concat(plain(assign, "assign"), plain(F.col("_access"), "access"), plain(F.col("_hex"), "hex"))
    tested = F.transform("_cand", lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), battery(x["m"], cfg).alias("t")))
    found = stored(found.select(*[F.col(k) for k in keep], base.alias("_base"), tested.alias("_cand")), "secret-candidates")

    limits = thresholds(found, cfg)
    key = lambda t: F.concat_ws(":", t["enc"], t["band"].cast("string"))
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]) if limits else F.expr("cast(map() as map<string, int>)")
    secret = F.filter("_cand", lambda x: x["t"]["fair"] & F.coalesce(x["t"]["step"] >= F.try_element_at(limit, key(x["t"])), F.lit(False))
                      & ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    more = F.transform(secret, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("random")).alias("ord"),
                                                  x["end"].alias("end"), F.lit("random").alias("kind")))
    return found.select(*[F.col(k) for k in keep], F.array_sort(F.concat("_base", more)).alias("spans"))


def thresholds(found: DataFrame, cfg: ScanConfig) -> dict[str, int]:
    """Benjamini-Hochberg per encoding and length band: the smallest step whose
    (rounded up) p-value stays within fdr * rank / tests.  At most encodings x
    bands entries reach the driver."""
    steps = (found.select(F.explode("_cand.t").alias("t")).groupBy("t.enc", "t.band", "t.step")
             .agg(F.count(F.lit(1)).alias("n")))
    by = W.partitionBy("enc", "band")
    rank = F.sum("n").over(by.orderBy(F.desc("step")))
    ok = F.pow(F.lit(10.0), -F.col("step") / 20) <= cfg.fdr * F.col("rank") / F.col("m")
    rows = (steps.withColumn("rank", rank).withColumn("m", F.sum("n").over(by)).where(ok)
            .groupBy("enc", "band").agg(F.min("step").alias("step")).collect())
    return {f"{r.enc}:{r.band}": r.step for r in rows}


def render(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the given order."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
