import hashlib
import re

import pytest

from sftframe.llm import pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def expected(text):
    return [(k, *m.span()) for k, p in BASE.items() for m in p.finditer(text or "") if passes(k, m[0])]


TEXTS = [
    "mail a.b+c@x.example.com, or é.c@d or @ or a@b.c@d.e and x@y..z",
    "ip 1.2.3.4 and 256.1.1.1 and 0001.02.3.255 and 1.2.3.4.5.6.7.8",
    "card 4539 1488 0343 6467, 4539148803436467 and 4539148803436468, 1-2-3",
    "phone +1 (202) 555-0143, +12, +1234567, ++49 30 1234567",
    "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 and GB82WEST12345698765433",
    "account 123456789 and 123456789 elsewhere far away from any such word, indeed",
    "9" * 5000,
    "1." * 3000,
    "",
    None,
    "@" * 2000 + "a" * 2000 + "@",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    found = [s[:3] for s in pii.find(text or "") if s[0] in pii.BASE_KINDS]
    assert found == expected(text)


def test_added_kinds():
    assert [s[0] for s in pii.find(TEXTS[4])] == ["iban", "iban"]
    assert [(s[0], s[1]) for s in pii.find(TEXTS[5])] == [("account", 8), ("account", 22)]
    assert pii.find("number 123456789 of it") == []


def test_digest(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(0, TEXTS[0])], "doc_id BIGINT, text STRING")
    for row in pii.digest(docs).collect():
        wanted = expected(TEXTS[row["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in wanted)
        assert row["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in BASE] == [sum(w[0] == k for w in wanted) for k in BASE]
        assert set(line.split(",")) - {""} <= set(row["spans"].split(","))
    assert pii.digest(docs.where("false")).collect() == []


def test_redaction_leaves_other_texts_alone(docs):
    changed = pii.redacted(docs)
    assert sorted(map(str, changed.collect())) == sorted(map(str, docs.collect()))
    assert pii.redact("to a@b.cd now", pii.find("to a@b.cd now")) == "to [email] now"


def test_clash(docs):
    with pytest.raises(ValueError):
        pii.pii_spans(docs, out="Core")
