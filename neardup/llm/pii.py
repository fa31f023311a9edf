"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Base kinds follow fixed patterns and are never dropped for a low score. On top
of them come account numbers (IBAN, mod 97) and shorter card numbers (Luhn, an
issuer's first digit and a word nearby that speaks of cards). Spans are code
points, end exclusive.

Defined results: a null text is searched as the empty text and has no spans; a
null text stays null when masked; repeated rows get equal spans; other columns
of the input pass through ``mask_pii`` and are ignored by ``find_pii``. Time is
linear in the length of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import return_memory, text_or_empty

KINDS = ("email", "ip", "card", "phone", "iban")
#: Confidence of a span before its surroundings are seen.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
#: Words that raise (or lower) the score of a kind where they stand nearby.
CONTEXT = {
    "email": {"mail": 0.05, "email": 0.05, "contact": 0.05, "@": 0.0},
    "ip": {"ip": 0.2, "host": 0.2, "server": 0.2, "address": 0.1, "version": -0.4, "release": -0.4},
    "card": {"card": 0.15, "visa": 0.15, "mastercard": 0.15, "amex": 0.15, "payment": 0.1, "credit": 0.1},
    "phone": {"phone": 0.2, "tel": 0.2, "call": 0.2, "mobile": 0.2, "fax": 0.1},
    "iban": {"iban": 0.1, "account": 0.05, "bank": 0.05},
}
CONTEXT_CHARS = 40
#: Score from which spans beyond the base kinds count.
MIN_SCORE = 0.85

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){11,30}")
#: Characters of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31,
    "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
_NEARBY = re.compile(r"[a-z@]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the check digits of an account number without spaces hold."""
    value = 0
    for c in iban[4:] + iban[:4]:
        n = int(c, 36)
        value = (value * (100 if n > 9 else 10) + n) % 97
    return value == 1


def _emails(text: str):
    # Walks from each @ to the left: what the pattern finds, in linear time.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str):
    # A dotted run is read four parts at a time, as successive matches would.
    for run in _DOTTED.finditer(text):
        parts, at = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) < 4 and int(p or "0") <= 255 for x in four):
                yield at, end
            at = end + 1


def _accounts(text: str):
    """Account numbers, whatever upper-case or numeric words follow them.

    The country says where a number ends. Without a known country each end of a
    word is tried, the farthest first; with one, the farthest only.
    """
    at = 0
    while head := _IBAN.search(text, at):
        start, at = head.span()
        rest = _IBAN_REST.match(text, at)
        if not rest:
            continue
        places = [i for i in range(start, rest.end()) if text[i] != " "]
        # Numbers of characters after which a word ends.
        ends = [
            n for n in range(len(places), 14, -1)
            if not text[(i := places[n - 1] + 1) : i + 1].isascii() or not text[i : i + 1].isalnum()
        ]
        known = IBAN_LENGTHS.get(text[start : start + 2])
        if known:
            ends = [n for n in ends if n == known] + ends[:1]
        for n in ends:
            if mod97("".join(text[i] for i in places[:n])):
                at = places[n - 1] + 1
                yield start, at
                break


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = CONTEXT[kind]
    change = [words[w] for w in set(_NEARBY.findall(near.lower())) if w in words]
    return min(1.0, max(0.0, PRIOR[kind] + max([0.0, *change]) + min([0.0, *change])))


def spans_of(text: str) -> list[tuple[str, int, int, float, bool]]:
    """All spans of a text by kind, then start: (kind, start, end, score, base)."""
    found = [("email", a, b, True) for a, b in _emails(text)]
    found += [("ip", a, b, True) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        number = _digits(m.group())
        if 13 <= len(number) <= 19 and luhn(number):
            if len(number) >= 16:
                found.append(("card", *m.span(), True))
            elif number[0] in "3456":
                found.append(("card", *m.span(), False))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span(), True))
    found += [("iban", a, b, False) for a, b in _accounts(text)]
    scored = [(k, a, b, _score(k, text, a, b), base) for k, a, b, base in found]
    kept = [x for x in scored if x[4] or x[3] >= MIN_SCORE]
    return sorted(kept, key=lambda x: (KINDS.index(x[0]), x[1]))


_ARROW_SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
         ("score", pa.float64()), ("base", pa.bool_())]
    )
)


def pii_spans(text: str | Column) -> Column:
    """Spans of a text column as ``SPAN_TYPE``."""

    @F.arrow_udf(SPAN_TYPE)
    def find(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "score", "base")
        rows = ([dict(zip(names, s)) for s in spans_of(t.as_py())] for t in texts)
        return pa.array(rows, _ARROW_SPANS)

    return find(text_or_empty(text))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row."""
    return docs.select(F.col(id_col).alias("doc_id"), pii_spans(text_col).alias("spans"))


def masked(text: str) -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    out, at = [], 0
    joined: list[list] = []
    for kind, start, end, _, _ in sorted(spans_of(text), key=lambda x: (x[1], -x[2])):
        if joined and start < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], end)
        else:
            joined.append([kind, start, end])
    for kind, start, end in joined:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with personal data in ``text_col`` replaced by ``[KIND]``; null stays null."""

    @F.arrow_udf("string")
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = (t.as_py() for t in texts)
            yield pa.array([None if t is None else masked(t) for t in rows], pa.string())
            return_memory()

    return docs.withColumn(text_col, mask(F.col(text_col)))


def span_list(spans: str | Column) -> Column:
    """``kind:start:end`` of spans, comma-joined in their order."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
