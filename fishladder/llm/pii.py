"""Personal data: patterns propose spans, checksums confirm, context scores.

Base kinds (fixed definitions): e-mail address, IPv4 address (parts at most
255), payment card (12 to 19 digits, Luhn) and international phone number (9
to 15 digits). Further kinds of this operator: ``iban`` (mod 97 = 1 at its
country's length; for a country without a registered length, at the greatest
length from 15 to 34 that ends at a token border), ``ssn`` (3-2-4 digits with
valid groups) and ``secret`` (a word such as password or token in any case, an
assignment sign and a value of at least 8 characters with letters and digits,
whose parts may be joined by single dots, or an access key id).

Every span has a score in [0, 1]: the prior of its kind plus a bonus for each
context word of that kind within ``WINDOW`` characters before or after it,
minus a malus for words before it that speak against it. A base span always
stays; a further span stays if its score reaches ``threshold``.

The patterns are written so that a long run of letters or digits is read
once: addresses are found from their ``@`` outwards, digit runs are matched
from their start only and never given back.

Defined cases: null text counts as empty; ids may be null or repeated; other
columns of the input are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.llm.common import documents, prepare_workers

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("iban", "ssn", "secret")
WINDOW = 48
THRESHOLD = 0.5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_GROUP = re.compile(r" ?([A-Z0-9]{1,30}+)(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:(?ai:password|passwd|secret|token|api[_-]?key)[\"']? ?[:=] ?[\"']?"
                     r"(?=[A-Za-z0-9+/_=-](?:[A-Za-z0-9+/_=-]|\.(?=[A-Za-z0-9+/_=-])){7})"        # 8 characters at least
                     r"([A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+)|(AKIA[0-9A-Z]{16})(?![0-9A-Z]))")
_KEYWORD = 9                                  # longest keyword and its sign

# Fixed value: account lengths of the IBAN registry.
IBAN_LENGTH = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}

# Score of a span without context, and the words that raise or lower it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "secret": 0.7}
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"), "ssn": ("ssn", "social", "security"),
    "secret": ("key", "login", "credential", "auth")}
AGAINST = {"ip": ("version", "release", "section"), "card": ("isbn", "serial", "order"),
           "phone": ("version",), "ssn": ("order", "part", "serial"), "secret": ("example", "placeholder")}
BONUS, MALUS = 0.2, 0.3
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """IBAN check: country and check digits moved behind, letters as 10..35."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text):
    low = 0                                   # first position a local part may use
    for m in _DOMAIN.finditer(text):
        at = m.start()
        low = max(low, text.rfind("@", low, at) + 1)
        before = text[low:at]
        start = low + len(before.rstrip(_LOCAL))
        if start < at:
            yield start, m.end()
            low = m.end()
        else:
            low = at + 1


def _ips(text):
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def _cards(text):
    for m in _CARD.finditer(text):
        if len(m[0]) <= 37:                   # 19 digits with 18 separators
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text):
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


def _ibans(text):
    end = 0
    for m in _IBAN.finditer(text):
        if m.start() < end:
            continue
        account, at, ends = m[0], m.end(), {}
        while (g := _IBAN_GROUP.match(text, at)) and len(account) + len(g[1]) <= 34:
            account, at = account + g[1], g.end()
            ends[len(account)] = at
        own = IBAN_LENGTH.get(m[0][:2])
        for n in [own] if own else sorted(ends, reverse=True):
            if n >= 15 and n in ends and mod97(account[:n]):
                end = ends[n]
                yield m.start(), end
                break


def _ssns(text):
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _secrets(text):
    at = 0
    while m := _SECRET.search(text, at):
        group = 1 if m[1] else 2
        value, at = m[group], m.end()
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            yield m.span(group)
        else:                                 # the value may end in the keyword of another
            at = max(m.start(group), at - _KEYWORD)


FINDERS = {"email": ("@", _emails), "ip": (".", _ips), "card": ("", _cards), "phone": ("+", _phones),
           "iban": ("", _ibans), "ssn": ("-", _ssns), "secret": ("", _secrets)}
_DIGIT = re.compile("[0-9]")


def score(kind: str, text: str, start: int, end: int) -> float:
    before = set(_WORD.findall(text[max(0, start - WINDOW):start].lower()))
    near = before.union(_WORD.findall(text[end:end + WINDOW].lower()))
    s = PRIOR[kind] + BONUS * sum(w in near for w in CONTEXT[kind]) - MALUS * sum(w in before for w in AGAINST.get(kind, ()))
    return min(1.0, max(0.0, s))


def find_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by start, then kind in the order of ``KINDS``."""
    digits = _DIGIT.search(text) is not None
    out = []
    for rank, kind in enumerate(KINDS):
        need, finder = FINDERS[kind]
        if (need and need not in text) or (kind != "email" and not digits):
            continue
        for start, end in finder(text):
            s = score(kind, text, start, end)
            if kind in BASE or s >= threshold:
                out.append((start, rank, kind, end, s))
    return [(kind, start, end, s) for start, _, kind, end, s in sorted(out)]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                            ("score", pa.float64()), ("value", pa.string())]))


def pii_spans(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end, score, value), code points."""
    prepare_workers(df.sparkSession)
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            spans = []
            for t in b.column(1):
                t = t.as_py()
                spans.append([{"kind": k, "start": s, "end": e, "score": p, "value": t[s:e]}
                              for k, s, e, p in find_spans(t, threshold)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, SPANS)], names=["doc_id", "spans"])

    return src.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:int,end:int,score:double,value:string>>")


def pii_digest(spans: DataFrame) -> DataFrame:
    """Counts and joined span lists per document."""
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    item = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    joined = lambda a: F.concat_ws(",", F.transform(a, item))
    return spans.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(pii_spans(documents(spark, sf_dir)))
