"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from arrivalmart.llm.texts import column, parts_of

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its first one only: from a later one the rest of the match would be the same.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# How many signs an account number has in the countries of the IBAN registry.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
NEAR = 40  # characters on either side in which a context word counts
CONTEXT_GAIN = 0.3
LEAST_SCORE = 0.6


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an international account number: its first four signs put last, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def valid_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def valid_card(found: str) -> bool:
    return 14 <= len(d := digits_of(found)) <= 19 and luhn(d)


def valid_iban(found: str) -> bool:
    return 15 <= len(s := found.replace(" ", "")) <= 34 and mod97(s)


def valid_ssn(found: str) -> bool:
    area, group, serial = found.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap. Each sign @ takes the run of allowed signs before it, so long runs are read once."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if domain:
            yield start, domain.end()
            free = at = domain.end()


def iban_ends(text: str, start: int, end: int) -> Iterator[int]:
    """Where an account number that begins a proposed span may end: at its country's length or with the span, else at any blank, the longest first."""
    if length := IBAN_LENGTHS.get(text[start : start + 2]):
        at = start
        for at in range(start, end):
            length -= text[at] != " "
            if not length:
                break
        if not length and not (text[at + 1 : at + 2].isascii() and text[at + 1 : at + 2].isalnum()):
            yield at + 1
        yield end
    else:
        yield end
        yield from (at for at in range(end - 1, start, -1) if text[at] == " ")


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers without the signs that follow them; the search goes on behind a number, or behind the first sign of what is none."""
    at = 0
    while m := IBAN.search(text, at):
        found = next((end for end in iban_ends(text, *m.span()) if valid_iban(text[m.start() : end])), 0)
        if found:
            yield m.start(), found
        at = found or m.start() + 1


def matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes spans, what confirms them, and the score of a confirmed one without context."""

    name: str
    propose: Callable[[str], Iterator[tuple[int, int]]]
    confirm: Callable[[str], bool]
    score: float
    context: re.Pattern
    needs: str  # a sign without which the text has none


def context(words: str) -> re.Pattern:
    return re.compile(rf"\b(?:{words})\b", re.IGNORECASE)


KINDS = (
    Kind("email", emails, lambda found: True, 0.7, context("e-?mail|mail|contact|write to"), "@"),
    Kind("ip", matches(IP), valid_ip, 0.6, context("ip|address|host|server|client"), "."),
    Kind("card", matches(CARD), valid_card, 0.7, context("card|credit|debit|visa|mastercard|amex|payment"), ""),
    Kind("phone", matches(PHONE), lambda found: 10 <= len(digits_of(found)) <= 15, 0.6, context("phone|tel|call|mobile|fax"), "+"),
    Kind("iban", ibans, valid_iban, 0.8, context("iban|account|bank|konto|cuenta|compte"), ""),
    # No checksum: it counts only beside a word that says what it is.
    Kind("ssn", matches(SSN), valid_ssn, 0.4, context("ssn|social security|taxpayer"), "-"),
)
BASE = ("email", "ip", "card", "phone")


def find_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of all personal data of a text, by start, then kind. Kinds may overlap; spans of one kind don't."""
    found = []
    for order, kind in enumerate(KINDS):
        if kind.needs and kind.needs not in text:
            continue
        for start, end in kind.propose(text):
            if kind.confirm(text[start:end]):
                around = f"{text[max(0, start - NEAR) : start]} | {text[end : end + NEAR]}"
                score = round(kind.score + (CONTEXT_GAIN if kind.context.search(around) else 0.0), 2)
                if kind.name in BASE or score >= LEAST_SCORE:
                    found.append((start, order, end, score))
    return [(start, end, KINDS[order].name, score) for start, order, end, score in sorted(found)]


def redact(text: str, spans: list[tuple[int, int, str, float]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first one."""
    parts, at = [], 0
    for start, end, kind, _ in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def listed(spans: list[tuple[int, int, str, float]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


def spans_of(texts: pa.Array) -> list[list[tuple[int, int, str, float]]]:
    """The spans of all texts; only those with a digit or an @ are searched, as each kind needs one."""
    found: list[list] = [[] for _ in range(len(texts))]
    for row in pc.indices_nonzero(pc.match_substring_regex(texts, "[0-9@]")).to_pylist():
        found[row] = find_spans(texts[row].as_py())
    return found


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every row: id, spans array<struct<kind, start, end, score, found>>.

    Null and empty texts have none; null ids, ties and equal rows are kept as they are; offsets count code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("found", pa.string())]))
        for batch in batches:
            for part, texts in parts_of(batch, text_col):
                rows = [
                    [{"kind": k, "start": a, "end": b, "score": s, "found": texts[row].as_py()[a:b]} for a, b, k, s in own]
                    for row, own in enumerate(spans_of(texts))
                ]
                yield pa.RecordBatch.from_arrays([column(part, id_col), pa.array(rows, kind)], [id_col, "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, spans array<struct<kind string, start long, end long, score double, found string>>"
    )


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each base kind, the digest of the base spans and the list of all spans, for every row; as scan otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, text_col):
                found = spans_of(texts)
                base = [[s for s in own if s[2] in BASE] for own in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, id_col),
                        *[pa.array([sum(s[2] == kind for s in own) for own in base], pa.int64()) for kind in BASE],
                        pa.array([hashlib.sha256(listed(own).encode()).hexdigest() for own in base], pa.string()),
                        pa.array([listed(own) for own in found], pa.string()),
                        pa.array([max((s[3] for s in own), default=0.0) for own in found], pa.float64()),
                    ],
                    [id_col, *[f"n_{kind}" for kind in BASE], "base_sha256", "spans", "top_score"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{kind} long" for kind in BASE)
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string, top_score double")


def redacted(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, each span in the text replaced by its kind in angle brackets; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part, texts in parts_of(batch, text_col):
                found = spans_of(texts)
                if any(found):
                    values = part.column(at).to_pylist()
                    for row, own in enumerate(found):
                        if own:
                            values[row] = redact(values[row], own)
                    part = part.set_column(at, batch.schema.field(at), pa.array(values, pa.string()))
                yield part

    return df.mapInArrow(run, df.schema)
