"""
Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text: at-signs, plus signs, digits, URL
schemes and identifier cues. From each anchor a local parser expands to the left and right as
far as its kind allows and validates what it got. No parser looks further than the run of
characters its kind may hold, and a kind's anchors inside an accepted or refused run are
skipped, so a text is read a constant number of times.

Kinds: ``email, ip, card, phone`` (the base) and the method's own ``url`` (scheme anchors) and
``account`` (identifier cues, filler words, and a token with a digit, a number in groups or an IBAN,
which must have its country's length and check digits). Spans are in code points, end
exclusive. Null texts count as empty and have no spans; every input row gives one output row,
null ids and repeated rows included. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import ship_package

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("account", "acct", "iban", "passport", "ssn", "token", "password", "api_key", "apikey", "secret")

DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
DIAL = DIGITS | frozenset(" ().-")
URL = ALNUM | frozenset("-._~:/?#[]@!$&'()*+,;=%")
TOKEN = ALNUM | frozenset("_-")

FILLERS = frozenset(("number", "numbers", "num", "no", "nr", "id", "is"))
IBAN_LENGTHS = {country: int(n) for n, countries in (line.split(":") for line in """
15:NO 16:BE 18:DK,FO,FK,FI,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA
23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM
28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU""".split())
    for country in countries.split(",")}


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for sign in ("@", "+", *DIGITS):
        found.add_word(sign, (sign if sign in "@+" else "0", 1))
    for scheme in SCHEMES:
        found.add_word(scheme, ("s", len(scheme)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, ("c", len(form)))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters that starts at ``at``."""
    size = len(text)
    while at < size and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, sign: int, free: int) -> tuple[int, int] | None:
    start = sign
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, sign + 1, LABEL)
    if start == sign or end == sign + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == "." and (more := _run(text, end + 1, LABEL)) > end + 1:
        end, labels = more, labels + 1
    return (start, end) if labels > 1 else None


def phone_at(text: str, sign: int) -> tuple[int, int] | None:
    if sign + 1 >= len(text) or text[sign + 1] not in DIGITS:
        return None
    end = _run(text, sign + 2, DIAL)
    while end > sign + 3 and text[end - 1] not in DIGITS:
        end -= 1
    # a digit, one character or more, a digit
    return (sign, end) if end > sign + 3 and text[end - 1] in DIGITS else None


def _numbers(text: str, at: int) -> list[tuple[int, int]]:
    """Numbers joined by single dots, from ``at`` on."""
    parts = []
    while (end := _run(text, at, DIGITS)) > at:
        parts.append((at, end))
        if end >= len(text) or text[end] != ".":
            break
        at = end + 1
    return parts


def _chain(text: str, at: int) -> tuple[int, str]:
    """Digits with single blanks or hyphens between them: where they end, and the digits."""
    end, size = at + 1, len(text)
    while end < size:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return end, text[at:end].replace(" ", "").replace("-", "")


def luhn(digits: str) -> bool:
    twice = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(twice[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def iban_at(text: str, start: int) -> int | None:
    """The end of an IBAN with single blanks or hyphens in it, if one starts here."""
    length, at, held = IBAN_LENGTHS.get(text[start:start + 2].upper(), 0), start, []
    while len(held) < length and at < len(text):
        if text[at] in ALNUM:
            held.append(text[at].upper())
        elif text[at] not in " -" or not held or text[at - 1] not in ALNUM:
            return None
        at += 1
    if not held or len(held) < length or (at < len(text) and (text[at].isalnum() or text[at] == "_")):
        return None
    if not (held[2] in DIGITS and held[3] in DIGITS):
        return None
    return at if int("".join(str(int(c, 36)) for c in held[4:] + held[:4])) % 97 == 1 else None


def account_at(text: str, at: int, free: int, iban: bool) -> tuple[int, tuple[int, int] | None]:
    """How far the text after a cue was read, and the identifier there."""
    for _ in range(5):
        start = at
        while start < len(text) and start < at + 8 and text[start] in " :=#\"'._":
            start += 1
        if start == at or start < free:
            return free, None
        if (end := iban_at(text, start)) is not None:
            return end, (start, end)
        end = _run(text, start, TOKEN)
        if text[start:min(end, start + 8)].lower() not in FILLERS or end - start > 7:
            break
        at = end
    read = end
    if iban or (end < len(text) and text[end].isalnum()):
        return read, None
    if end > start and text[start] in DIGITS:
        chain, digits = _chain(text, start)
        if chain > end and len(digits) >= 6 and (chain == len(text) or not (text[chain].isalnum() or text[chain] == "_")):
            return chain, (start, chain)
    return read, (start, end) if end - start >= 6 and any(c in DIGITS for c in text[start:end]) else None


def spans_of(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of every kind, each in order of start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    email_free = phone_free = ip_free = card_free = url_free = account_free = 0
    for last, (sort, width) in automaton().iter(text):
        at = last - width + 1
        if sort == "0":
            if at >= card_free:
                card_free, digits = _chain(text, at)
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((at, card_free))
            if at >= ip_free:
                parts = _numbers(text, at)
                ip_free = parts[-1][1]
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k:k + 4]
                    if all(len(n := text[a:b].lstrip("0")) <= 3 and int(n or 0) <= 255 for a, b in four):
                        found["ip"].append((four[0][0], four[3][1]))
        elif sort == "@":
            if span := email_at(text, at, email_free):
                found["email"].append(span)
                email_free = span[1]
        elif sort == "+":
            if at >= phone_free and (span := phone_at(text, at)):
                phone_free = span[1]
                if 8 <= sum(c in DIGITS for c in text[span[0]:span[1]]) <= 15:
                    found["phone"].append(span)
        elif sort == "s":
            if at >= url_free:
                end = _run(text, last + 1, URL)
                while end > last + 1 and text[end - 1] in ".,;:!?)'":
                    end -= 1
                url_free = end
                if end > last + 1:
                    found["url"].append((at, end))
        elif at == 0 or not text[at - 1].isalnum():
            account_free, span = account_at(text, last + 1, account_free, text[at:last + 1].lower() == "iban")
            if span:
                found["account"].append(span)
    return found


def redact(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with every span replaced by its kind in brackets; the earlier, then longer span wins."""
    spans = sorted((a, -b, k) for k, list_ in found.items() for a, b in list_)
    out, upto = [], 0
    for start, end, kind in spans:
        if start >= upto:
            out += [text[upto:start], f"[{kind}]"]
            upto = -end
        else:
            upto = max(upto, -end)
    return "".join([*out, text[upto:]])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, joined = {k: [] for k in KINDS}, [], []
        for text in batch.column("text").to_pylist():
            found = spans_of(text or "")
            base, spans = (",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k]) for kinds in (BASE_KINDS, KINDS))
            for kind in KINDS:
                counts[kind].append(len(found[kind]))
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            joined.append(spans)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts.values()),
             pa.array(digests, pa.string()), pa.array(joined, pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, all spans."""
    ship_package(docs.sparkSession)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    given = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {given}, {counts}, base_sha256 string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; all other columns stay. Null texts stay null."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact(t, spans_of(t)))

    return docs.withColumn("text", clean("text"))
