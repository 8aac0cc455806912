"""Personal data: patterns propose spans, checksums confirm them, and nearby words move the score.

Every whole text is searched.  ``email``, ``ip``, ``card`` and ``phone`` are the base kinds; a base match that
passes its check is always kept.  The method adds the kinds ``iban`` (confirmed by modulo 97) and ``account``
(digit runs that no checksum confirms, kept only if a word nearby says so).  Offsets are code points, ends exclusive.
A null or empty text has no spans; repeated rows give repeated results; columns of the input pass through
unchanged, and a new column that would clash with one of them raises ``ValueError``.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftframe.llm import textcore as X

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account")
THRESHOLD = 0.5
CONTEXT_CHARS = 40

_AT = re.compile("@")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: The contract's pattern; a run of digits is tried from its first digit only, as its later digits end alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?<![A-Za-z0-9.+-])[0-9]{8,12}(?![A-Za-z0-9]|[.-][0-9])")
_CONTEXT = {
    "iban": re.compile(r"(?i)\b(?:iban|bank|bic|swift|konto|compte|cuenta)\b"),
    "account": re.compile(r"(?i)\b(?:account|acct|passport|konto(?:nummer)?|compte|cuenta|ssn|tax id)\b"),
}
_PRIOR = {"iban": 0.9, "account": 0.2}
_NEAR = 0.4
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    """Whether the checksum of a card number holds."""
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the check digits of an account number with country code hold."""
    plain = iban.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    moved = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    last = 0
    for at in _AT.finditer(text):
        if at.start() < last:
            continue
        begin = at.start()
        while begin > last and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        if begin < at.start() and (domain := _DOMAIN.match(text, at.start())):
            last = domain.end()
            yield begin, last


def _valid_ip(match: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-4:] if len(part) > 4 else part) <= 255 for part in match.split("."))


def find(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """All spans ``(kind, start, end, score)`` of a text, by kind as in ``KINDS``, then by start."""
    spans: list[tuple[str, int, int, float]] = [("email", a, b, 1.0) for a, b in _emails(text)]
    spans += [("ip", *m.span(), 1.0) for m in _IP.finditer(text) if _valid_ip(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span(), 1.0))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            spans.append(("phone", *m.span(), 1.0))
    taken = sorted((a, b) for _, a, b, _ in spans)
    for kind, pattern in (("iban", _IBAN), ("account", _ACCOUNT)):
        for m in pattern.finditer(text):
            a, b = m.span()
            if kind == "iban" and not mod97(m[0]) or any(x < b and a < y for x, y in taken):
                continue
            around = text[max(0, a - CONTEXT_CHARS) : a] + " " + text[b : b + CONTEXT_CHARS]
            score = min(1.0, _PRIOR[kind] + (_NEAR if _CONTEXT[kind].search(around) else 0))
            if score >= threshold:
                spans.append((kind, a, b, score))
    return spans


def joined(spans, kinds=KINDS) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans if k in kinds)


def redact(text: str, spans) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union gets the first's."""
    parts, last = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            parts += [text[last:a], f"[{kind}]"]
        last = max(last, b)
    return "".join([*parts, text[last:]])


def _detector(threshold: float):
    @F.arrow_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def detect(texts: pa.Array) -> pa.Array:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        )
        found = (find(t.as_py() or "", threshold) for t in texts)
        return pa.array([[dict(zip(("kind", "start", "end", "score"), s)) for s in row] for row in found], kind)

    return detect


def _redactor(threshold: float):
    @F.arrow_udf("string")
    def replace(texts: pa.Array) -> pa.Array:
        plain = (t.as_py() for t in texts)
        found = pa.array([t and redact(t, find(t, threshold)) for t in plain], pa.string())
        X.give_back()
        return found

    return replace


def pii_spans(docs: DataFrame, text: str = "text", out: str = "pii", threshold: float = THRESHOLD) -> DataFrame:
    """Add the spans of personal data of every text as an array of ``kind, start, end, score``."""
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the input has a column {out} already")
    return docs.withColumn(out, _detector(threshold)(F.col(f"`{text}`")))


def redacted(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Replace personal data in the text column by its kind; a null text stays null."""
    return docs.withColumn(text, _redactor(threshold)(F.col(f"`{text}`")))


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the counts by base kind, the digest of base spans and all spans as text."""
    found = pii_spans(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), out="found")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("found", _is_kind(k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS
        ],
        F.sha2(F.concat_ws(",", F.transform(base, line)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("found", line)).alias("spans"),
    )
