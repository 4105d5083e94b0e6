import random
import re

from pyspark.sql import functions as F

from pixelflow.llm import pii_anchor as P

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def base(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2 and not (13 <= len(digits) <= 19 and P.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return sorted(out)


def test_base_spans_against_regexes():
    r = random.Random(6)
    bits = ["@", "a", "b.", ".", "1", "2", "25", "4.", "-", " ", "+", "(", ")", "x@y.z", "+1 ", "4111111111111111", "é", "\n",
            "192.168.1.", "%", "0", "00", "DE", "://", "account "]
    for _ in range(20000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 40)))
        assert [s for s in P.spans(text) if s[0] < P.N_BASE] == base(text), text


def test_added_kinds():
    def named(text):
        return [(P.KINDS[k], text[a:b]) for k, a, b in P.spans(text) if k >= P.N_BASE]
    assert named("pay DE89 3704 0044 0532 0130 00 now") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert named("pay DE88 3704 0044 0532 0130 00 now") == []
    assert named("see ftp://bob:pw@host.example/x") == [("login", "ftp://bob:pw@host.example")]
    assert named("Account no: 12345678.") == [("account", "12345678")]
    assert named("on account of the many things") == []


def test_cues_are_words_of_their_own():
    def accounts(text):
        return [text[a:b] for k, a, b in P.spans(text) if P.KINDS[k] == "account"]
    for text in ("accounting-20240301 report", "subaccount 12345678", "kontor 12345678", "éacct 12345678", "accounté 12345678",
                 "account numbers 12345678", "passports: 12345678", "account noé 12345678"):
        assert accounts(text) == [], text
    for text in ("account 12345678", "ACCT#12345678", "(account) no", "_ssn 12345678", "1konto:12345678", "kontonummer: 12345678",
                 "konto nr. 12345678", "accountno 12345678", "account id 12345678", "Passport number: 12345678", "ssn12345678"):
        assert accounts(text) == ([] if text == "(account) no" else ["12345678"]), text


def test_iban_before_capitals_and_numbers():
    ibans = ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NO93 8601 1117 947",
             "FR14 2004 1010 0505 0001 3M02 606", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "NO9386011117947")
    for iban in ibans:
        for rest in ("", " BIC COBADEFFXXX", " 2024", " PAY NOW", " BIC", " A B C D E F G H", " 12 34 56 78 90 12 34", ", BIC", "\nBIC"):
            text = f"to {iban}{rest}"
            assert [text[a:b] for k, a, b in P.spans(text) if P.KINDS[k] == "iban"] == [iban], text
    assert not [x for x in P.spans("to DE88370400440532013000 2024") if P.KINDS[x[0]] == "iban"]


def test_odd_rows_and_redaction(spark, odd, none, clashing):
    assert P.find(odd).count() == odd.count() and P.find(none).count() == 0 and P.find(clashing).count() == odd.count()
    rows = [(1, "é mail bob@host.example.org or +1 (017) 555-7713, 10.1.2.3!"), (2, None), (3, "nothing"),
            (4, "ftp://bob:pw@host.example/x"), (5, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = P.find(df, ("doc_id", "text")).select("doc_id", P.redact(F.col("text"), F.col("spans")).alias("t"), P.render(F.col("spans")).alias("s"))
    got = {r.doc_id: r for r in got.collect()}
    assert got[1].t == "é mail <EMAIL> or <PHONE>, <IP>!"
    assert got[1].s.startswith("email:7:27,ip:")
    assert got[2].t is None and got[3].t == "nothing" and got[5].t == ""
    assert got[4].t == "<LOGIN>/x"
