"""Personal data and secrets: regular expressions propose spans, checksums and entropy confirm them, nearby words move the score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import log2
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaiq.llm.common import arrow_map, text_of

BASE = ("email", "ip", "card", "phone")
#: What the method adds to the base kinds, in the order in which spans at one start are listed.
ADDED = ("iban", "card_short", "ssn", "phone_local", "private_key", "api_key", "secret", "hex_token")
#: Of these those that say who may come in; they may hold a base span.
SECRETS = frozenset(ADDED[4:])
KINDS = BASE + ADDED

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits does: the look-behind and the possessive repeats keep long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_CARD_SHORT = re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{3}){3}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PHONE_LOCAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])")
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----[A-Za-z0-9+/=\s:,.-]{0,20000}?-----END [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----")
# How publishers of keys begin them, and signed tokens of three parts.
_API_KEY = re.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,80}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{24,64}|eyJ[A-Za-z0-9_-]{8,2000}\.eyJ[A-Za-z0-9_-]{8,2000}\.[A-Za-z0-9_-]{8,2000})(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?i:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|credentials?)[\"']?\x20?(?:=|:|:=|=>)\x20?[\"']?([A-Za-z0-9+/=_.~!@#$%^&*-]{8,512})")
_HEX_TOKEN = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Words near a span that raise its score, by kind. Lower case.
CONTEXT = {
    "email": ("mail", "e-mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "card_short": ("card", "visa", "credit", "payment"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "phone_local": ("phone", "tel", "call", "mobile", "fax"),
    "private_key": ("key", "private"),
    "api_key": ("key", "token", "secret", "api"),
    "secret": ("key", "token", "secret", "password", "login", "auth", "api"),
    "hex_token": ("key", "token", "secret", "password", "bearer", "auth", "api", "credential"),
}
#: The score before the context is looked at. Base kinds are certain by their rule.
PRIOR = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "iban": 0.9, "card_short": 0.4, "ssn": 0.4, "phone_local": 0.4, "private_key": 0.9, "api_key": 0.9, "secret": 0.6, "hex_token": 0.3}
CONTEXT_GAIN, CONTEXT_WINDOW, THRESHOLD = 0.4, 40, 0.6


class Span(NamedTuple):
    start: int
    kind: str
    end: int
    score: float


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def entropy(text: str) -> float:
    """Bits a letter."""
    n = len(text)
    return -sum(c / n * log2(c / n) for c in Counter(text).values())


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern over the whole text would find them; each @ is looked at once, so a long word costs no more than its length."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest of the ends of groups at which the check digits hold: a word in capitals may follow the number."""
    at = 0
    while m := _IBAN.search(text, at):
        start, found = m.start(), m.group()
        ends = [len(found), *(i for i in range(len(found) - 1, 0, -1) if found[i] == " ")]
        end = next((e for e in ends if _confirmed("iban", found[:e])), None)
        if end:
            yield start, start + end
        at = start + (end or 1)


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE), ("card_short", _CARD_SHORT), ("ssn", _SSN), ("phone_local", _PHONE_LOCAL), ("private_key", _KEY_BLOCK), ("api_key", _API_KEY), ("secret", _SECRET), ("hex_token", _HEX_TOKEN)):
        for m in pattern.finditer(text):
            yield kind, m.start(m.re.groups), m.end(m.re.groups)  # of a secret the value alone
    for start, end in _ibans(text):
        yield "iban", start, end


def _confirmed(kind: str, found: str) -> bool:
    """The check of its kind; what fails is dropped and, but for IBANs, not tried again at another length."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind in ("card", "card_short"):
        digits = _NOT_DIGIT.sub("", found)
        return (14 <= len(digits) <= 19 if kind == "card" else len(digits) == 13) and luhn(digits)
    if kind == "phone":
        return 10 <= len(_NOT_DIGIT.sub("", found)) <= 15
    if kind == "iban":
        plain = found.replace(" ", "")
        return 15 <= len(plain) <= 34 and mod97(plain)
    if kind in ("secret", "hex_token", "api_key"):  # of mixed letters, as no word and no number is
        mixed = any(c.isdigit() for c in found) and any(c.isalpha() for c in found)
        return mixed and len(found) >= 8 and entropy(found[:512]) >= (2.8 if len(found) >= 16 else 2.5)
    if kind == "ssn":
        area, group, serial = found.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    return True


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", (text[max(0, start - CONTEXT_WINDOW) : start] + " " + text[end : end + CONTEXT_WINDOW]).lower())
    return min(1.0, PRIOR[kind] + CONTEXT_GAIN * any(w in CONTEXT[kind] for w in near))


def find(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind as in KINDS. An added span needs THRESHOLD and must not overlap a base one, but for
    secrets; of secrets that overlap the first kind counts."""
    if not text or not re.search(r"[@0-9]|-----BEGIN", text):
        return []
    kept = [Span(s, k, e, _score(text, k, s, e)) for k, s, e in _proposed(text) if _confirmed(k, text[s:e])]
    base = [x for x in kept if x.kind in BASE]
    base.sort()
    starts, reach = [x.start for x in base], [*accumulate((x.end for x in base), max)]
    apart = lambda x: not (i := bisect_left(starts, x.end)) or reach[i - 1] <= x.start
    free = [x for x in kept if x.kind not in BASE and x.score >= THRESHOLD and (x.kind in SECRETS or apart(x))]
    hidden = sorted((x for x in free if x.kind in SECRETS), key=lambda x: (KINDS.index(x.kind), x.start))
    taken: list[Span] = []
    for x in hidden:
        at = bisect_left(taken, (x.start,))
        if (at == 0 or taken[at - 1].end <= x.start) and (at == len(taken) or x.end <= taken[at].start):
            taken.insert(at, x)
    free = [x for x in free if x.kind not in SECRETS] + taken
    return sorted(base + free, key=lambda x: (x.start, KINDS.index(x.kind)))


def detect_pii(docs: DataFrame) -> DataFrame:
    """doc_id and findings: an array of (kind, start, end, score, value) by start, then kind. Offsets count code points.

    A null or empty text has no findings. Every input row gives one row: repeated rows give repeated results, an empty
    table an empty one. Columns besides doc_id and text are left aside. Texts are handled one by one in Arrow slices of
    bounded size, without a shuffle.
    """

    def per_slice(batch: pa.RecordBatch):
        texts = batch.column(1).to_pylist()
        rows = [[{"kind": x.kind, "start": x.start, "end": x.end, "score": x.score, "value": t[x.start : x.end]} for x in find(t)] for t in texts]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("value", pa.string())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "findings"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", text_of(docs).alias("text")), per_slice, f"doc_id {kind}, findings array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of spans that overlap the first counts."""
    out, at = [], 0
    for x in spans:
        if x.start >= at:
            out += [text[at : x.start], f"[{x.kind}]"]
            at = x.end
    return "".join(out) + text[at:]


def spans_digest(docs: DataFrame) -> DataFrame:
    """The registered columns, from what detect_pii finds."""
    found = detect_pii(docs)
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("findings", lambda x: x["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in BASE]
    secrets = F.size(F.filter("findings", lambda x: x["kind"].isin(*sorted(SECRETS)))).cast("long")
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"), secrets.alias("n_secrets"), F.size("findings").cast("long").alias("n_spans"))


__all__ = ["BASE", "KINDS", "Span", "detect_pii", "find", "luhn", "mod97", "redact", "spans_digest"]
