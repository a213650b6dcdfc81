"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Candidates are e-mail addresses, IPv4 addresses, card numbers (14 to 19 digits, Luhn), phone numbers
with a plus sign (10 to 15 digits), and bank accounts (IBAN, mod 97). These five are certain by
themselves (score 0.7 or more). Three weaker patterns need a word beside them: a local phone number
(8 to 12 grouped digits), a 13 digit card number, and a secret: 12 or more letters and digits, both
among them, that a word such as token or password assigns. A span counts from a score of 0.5.

score = pattern's prior + 0.3 if a checksum holds + 0.3 if a context word of its kind stands within
40 characters before or 20 after it. The first four kinds are kept whatever the score; spans that
the method adds never overlap a kept one. Scores are returned in the order of the spans.

Defined cases: null text is empty and has no spans; positions are code points, end exclusive; texts
are searched whole, in time proportional to their length; rows are independent, so repeated rows
and ids repeat their result; other columns are ignored."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, functions as F

from faremill.llm import common

KINDS = ("email", "ip", "card", "phone")  # fixed order of the certain kinds
MIN_SCORE = 0.5
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match starts at the start of its digit run: later starts in a run fail where the first failed
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(
    r"(?<![0-9A-Za-z.+-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ -])[0-9]{3,4}[ -][0-9]{3,4}"
    r"(?![0-9A-Za-z-])")
_CONTEXT = {
    "phone": re.compile(r"\b(?:call|phone|tel|telephone|mobile|fax|telefon|llame|appelez)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\b", re.I),
    "iban": re.compile(r"\b(?:iban|bank|account|konto|compte|cuenta)\b", re.I),
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|login|adresse)\b", re.I),
}
_SECRET = re.compile(
    r"\b(?:token|secret|api[_-]?key|access[_-]?key|auth|password|passwd)[\"']?[ \t]{0,3}[:=]"
    r"[ \t]{0,3}[\"']?([A-Za-z0-9_+/=-]{12,})", re.I | re.A)
# by themselves, and with a checksum where the kind has one
_PRIOR = {"email": 0.7, "ip": 0.7, "card": 0.4, "phone": 0.7, "iban": 0.4,
          "short card": 0.1, "local phone": 0.3, "secret": 0.3}
_CHECKED = 0.3
_BESIDE = 0.3


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Every address starts at the first local character of the run before its @, or at the end of
    the address before it: the same spans as a search from the left, without its backtracking."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The certain spans by start, then kind."""
    found = [(s, KINDS.index("email"), e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
               for part in m[0].split(".")):
            found.append((m.start(), KINDS.index("ip"), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), KINDS.index("card"), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), KINDS.index("phone"), m.end()))
    return [(s, e, KINDS[kind]) for s, kind, e in sorted(found)]


def _near(kind: str, text: str, start: int, end: int) -> bool:
    return bool(_CONTEXT[kind].search(text[max(0, start - 40):start])
                or _CONTEXT[kind].search(text[end:end + 20]))


def _score(kind: str, text: str, start: int, end: int, checked: bool = False,
           prior: str | None = None) -> float:
    return min(1.0, _PRIOR[prior or kind] + _CHECKED * checked
               + _BESIDE * _near(kind, text, start, end))


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The longest beginning of the match that ends with a group and passes the checksum: capitals
    that follow an account number look like another group of it."""
    while end > start:
        account = text[start:end].replace(" ", "")
        if 15 <= len(account) <= 34 and mod97(account):
            return start, end
        end = text.rfind(" ", start, end)
    return None


def added_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
    """Further spans whose score reaches MIN_SCORE, none of which overlaps another."""
    proposed = []
    for m in _IBAN.finditer(text):
        span = _account(text, *m.span())
        if span:
            proposed.append((*span, "iban", _score("iban", text, *span, checked=True)))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) == 13 and luhn(digits):
            proposed.append((*m.span(), "card", _score("card", text, *m.span(), checked=True,
                                                       prior="short card")))
    for m in _LOCAL_PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 12:
            proposed.append((*m.span(), "phone", _score("phone", text, *m.span(),
                                                        prior="local phone")))
    for m in _SECRET.finditer(text):
        if re.search("[0-9]", m[1]) and re.search("[A-Za-z]", m[1]):  # its word is in the match
            proposed.append((*m.span(1), "secret", _PRIOR["secret"] + _BESIDE))
    good = sorted(p for p in proposed if p[3] >= MIN_SCORE)
    taken, kept = [(s, e) for s, e, _ in base], []
    for start, end, kind, score in good:
        # both lists are in order of start, so only a few neighbours can overlap
        if kept and kept[-1][1] > start:
            continue
        kept.append((start, end, kind, score))
    merged, i = [], 0
    reach = 0
    for span in kept:
        while i < len(taken) and taken[i][0] < span[1]:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= span[0]:
            merged.append(span)
    return merged


def scored(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
    """The certain spans, and all spans with their scores, each by start and kind."""
    base = base_spans(text)
    order = {kind: i for i, kind in enumerate((*KINDS, "iban", "secret"))}
    every = [(*s, _score(s[2], text, s[0], s[1], checked=s[2] == "card")) for s in base]
    every += added_spans(text, base)
    return base, sorted(every, key=lambda s: (s[0], order[s[2]], s[1]))


def spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The certain spans, and all spans, each by start and kind."""
    base, every = scored(text)
    return base, [s[:3] for s in every]


def redact(text: str) -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    out, end, kind_before = [], 0, None
    for start, stop, kind in spans(text)[1]:
        if start < end:
            end = max(end, stop)
            continue
        out += [text[end:start], f"[{kind.upper()}]"]
        end = stop
    return "".join(out) + text[end:]


def _joined(found) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def _rows(keys, texts):
    for key, text in zip(keys, texts):
        base, every = scored(text or "")
        counts = [sum(s[2] == kind for s in base) for kind in KINDS]
        yield (key, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(),
               _joined(s[:3] for s in every), ",".join(f"{s[3]:.1f}" for s in every))


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every row's text: counts, a digest of the certain ones, all of them, their scores."""
    kind = df.schema[key].dataType.simpleString()
    return common.map_texts(
        df.select(F.col(key), F.col(text).cast("string")), _rows,
        f"key {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, scores string").withColumnRenamed("key", key)


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the spans of its text replaced; null stays null."""
    @F.pandas_udf("string")
    def hide(texts):
        return texts.map(lambda t: None if t is None else redact(t))

    every = {c: common.column(c) for c in df.columns}
    return common.bounded_batches(df).select(*(
        hide(column).alias(c) if c == text else column for c, column in every.items()))


def query(spark, sf_dir: str) -> DataFrame:
    return find(common.documents(spark, sf_dir))
