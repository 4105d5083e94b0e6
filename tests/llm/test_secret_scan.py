import base64
import random
import re
import string

from pixelflow.llm import secret_scan as S


ALPHABET = string.ascii_letters + string.digits


def base(text):
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def found(df, random_too=False):
    rows = S.scan(df, keep=("doc_id", "text")).collect()
    return [(r.text, [(x.start, x.ord, x.end) for x in r.spans if random_too or x.ord < 3]) for r in rows]


def test_base_spans_against_regexes(spark):
    r = random.Random(1)
    bits = ["token", "TOKEN", "api_key", "apikey", "passwd", "=", ":", " ", '"', "'", "abc", "secret=", "0123456789abcdef", "AKIA",
            "ABCDEFGH", "é", "𝄞", "\n", "x.y/", "f" * 9]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    texts += ["token=token:abcdefgh", "AKIA" * 6, "password: abcde", None, ""]
    got = found(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    assert len(got) == len(texts)
    assert all(spans == base(t) for t, spans in got)


def test_battery_separates_random_strings_from_words(spark):
    r = random.Random(2)
    words = ("the internationalization/is/a_long-path/with-words configuration_setting_name_here aaaaaaaaaaaaaaaaaaaaaaaa "
             "abcdefghijklmnopqrstuvwxyz some_module_name_for_testing/utils thatisaverylongconcatenatedword").split()
    rows = [(i, " ".join(r.sample(words, 4)) + " " + (base64.b64encode(r.randbytes(33)).decode() if i % 2 else "nothing")) for i in range(200)]
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"), random_too=True)
    for t, spans in got:
        secret = not t.endswith("nothing")
        assert [x for x in spans if x[1] < 3] == base(t)         # 24 letters a are the hex kind
        extra = [t[a:b] for a, k, b in spans if k == 3]
        assert extra == ([t.split()[-1]] if secret else [])


def test_short_keys_that_are_rare(spark):
    r = random.Random(3)
    words = "the state of public information from every major report about water people system number between under through".split()
    kinds = (lambda w: "-".join(w), lambda w: "_".join(w).upper(), lambda w: "".join(x.title() for x in w),
             lambda w: "/".join(["2024", "03", *w]), lambda w: "".join(w) + str(r.randrange(10 ** 6)))
    rows = []
    for i in range(6000):
        size, key = r.choice((20, 24, 28, 32, 36)), i % 100 == 0
        token = r.choice(kinds)(r.sample(words, 6))[:r.choice((24, 31, 40))]
        rows.append((i, "".join(r.choice(ALPHABET) for _ in range(size)) if key else token))
    got = {t: bool(spans) for t, spans in found(spark.createDataFrame(rows, "doc_id bigint, text string"), random_too=True)}
    keys = [t for i, t in rows if i % 100 == 0]
    recall = {a: [got[t] for t in keys if a <= len(t) < b] for a, b in ((20, 28), (28, 37))}
    wrong = [t for i, t in rows if i % 100 and got[t]]
    assert sum(recall[20]) >= 0.6 * len(recall[20]) and sum(recall[28]) >= 0.85 * len(recall[28]), (recall, wrong[:5])
    assert len(wrong) <= 0.1 * len(keys), wrong[:9]


def test_odd_rows(odd, none, clashing):
    assert len(found(odd)) == odd.count()
    assert found(none) == []
    assert len(found(clashing)) == odd.count()
