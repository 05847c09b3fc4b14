"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs, plus signs, digits, schemes and the
cues of accounts and addresses. From each anchor a parser of that kind walks outwards over the characters its kind
allows, and validates what it has found. The four base kinds (email, ip, card, phone) are those of the patterns below,
found leftmost and without overlap per kind; a span that fails its test is dropped, and not tried again from elsewhere.
Kinds of its own: url (scheme and host), address (number and street cue), account (IBAN by its check digits).

Base patterns: email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``
with parts up to 255; card ``[0-9]([\\x20-]?[0-9])+`` of 16 to 19 digits passing Luhn; phone
``\\+[0-9][\\x20().0-9-]+[0-9]`` of 8 to 15 digits.

Defined results: a null or empty text has no spans; texts are read whole; repeated rows give equal rows; an empty
table gives no rows; in ``mask`` other columns are left as they are.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free, per_text, quoted, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "address", "account")
SCHEMES = ("http://", "https://", "ftp://")
STREETS = ("street", "avenue", "road", "lane", "boulevard", "drive")
ACCOUNT_CUES = ("IBAN", "iban", "Iban")

_local, _host = re.compile(r"[A-Za-z0-9._%+-]*\Z"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_card, _dotted, _phone = re.compile(r"[0-9](?:[ -]?[0-9])*"), re.compile(r"[0-9]+(?:\.[0-9]+)*"), re.compile(r"[ ().0-9-]*")
_url = re.compile(r"[^\s\"'<>(){}\[\]|\\^`]*[A-Za-z0-9/]")
_iban = re.compile(r"[\s:.]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
_local_chars = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_digits = frozenset("0123456789")


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, cues in (("at", "@"), ("plus", "+"), ("digit", "0123456789"), ("scheme", SCHEMES), ("street", STREETS + tuple(s.title() for s in STREETS)), ("account", ACCOUNT_CUES)):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(d if k % 2 == 0 else doubled[int(d)]) for k, d in enumerate(reversed(digits))) % 10 == 0


def iban_holds(text: str) -> bool:
    t = text.replace(" ", "")
    return 15 <= len(t) <= 34 and int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def _part_holds(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def spans(text: str, anchors) -> dict[str, list[tuple[int, int]]]:
    """(start, end) by kind, in order. ``upto`` is where the last try of a kind ended: kinds don't overlap themselves."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    upto = dict.fromkeys(KINDS, 0)
    dotted_upto = 0
    for last, (anchor, size) in anchors.iter(text):
        at = last + 1 - size
        if anchor == "digit":
            if at >= upto["card"]:
                m = _card.match(text, at)
                upto["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
            if at >= dotted_upto:
                m = _dotted.match(text, at)
                dotted_upto = m.end()
                if m[0].count(".") >= 3:
                    parts, start = m[0].split("."), at
                    for k in range(0, len(parts) - 3, 4):
                        end = start + sum(map(len, parts[k : k + 4])) + 3
                        if all(map(_part_holds, parts[k : k + 4])):
                            out["ip"].append((start, end))
                        start = end + 1
        elif anchor == "at":
            if m := _host.match(text, at + 1):
                start = at
                while start > upto["email"] and text[start - 1] in _local_chars:
                    start -= 1
                if start < at:
                    out["email"].append((start, m.end()))
                    upto["email"] = m.end()
        elif anchor == "plus":
            if at >= upto["phone"] and text[at + 1 : at + 2] in _digits and at + 1 < len(text):
                run = _phone.match(text, at + 2)
                end = run.end()
                while end > at + 2 and text[end - 1] not in _digits:
                    end -= 1
                if end > at + 3:
                    upto["phone"] = end
                    if 8 <= sum(c in _digits for c in text[at:end]) <= 15:
                        out["phone"].append((at, end))
        elif anchor == "scheme":
            if at >= upto["url"] and (m := _url.match(text, last + 1)):
                out["url"].append((at, m.end()))
                upto["url"] = m.end()
        elif anchor == "street":
            if at >= upto["address"] and not text[last + 1 : last + 2].isalnum():
                # a number and up to three capitalised words stand before the cue
                head = text[max(upto["address"], at - 80) : at]
                if m := re.search(r"(?<![0-9A-Za-z])[0-9]{1,5}(?: [A-Z][A-Za-z'-]*){1,3} \Z", head):
                    out["address"].append((at - len(m[0]), last + 1))
                    upto["address"] = last + 1
        elif at >= upto["account"] and (m := _iban.match(text, last + 1)):
            # groups may run into the words after them: the longest valid beginning counts
            end = m.end(1)
            while end > m.start(1) + 14 and not iban_holds(text[m.start(1) : end]):
                end -= 1
            if end > m.start(1) + 14 and text[end - 1] != " ":
                out["account"].append((m.start(1), end))
                upto["account"] = end
    return out


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def masked(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with a mark in the place of each span; overlapping spans have one mark, of the first of them."""
    parts, done = [], 0
    for start, end, kind in sorted((a, -b, k) for k in KINDS for a, b in found[k]):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, -end)
    return "".join(parts) + text[done:]


def _finder(fn, fields: str):
    made: list[ahocorasick.Automaton] = []

    def run(text: str) -> tuple:
        if not made:
            made.append(automaton())
        return fn(text, spans(text, made[0]))

    return per_text(run, fields)


def _digest(text: str, found) -> tuple:
    base = joined(found, BASE)
    return *(len(found[k]) for k in BASE), hashlib.sha256(base.encode()).hexdigest(), joined(found, KINDS)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, the number of spans of each base kind, the hash of the base spans, and all spans as text."""
    fields = ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return docs.select(quoted(doc_id).alias("doc_id"), _finder(_digest, fields)(quoted(text)).alias("f")).select("doc_id", "f.*")


def mask(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with every span put out of the text, in the same columns; ``n_chars``, if there, follows."""
    out = free(docs, "masked")
    done = docs.withColumn(out, _finder(lambda t, found: (masked(t, found),), "text string")(quoted(text))["text"])
    clean = F.when(quoted(text).isNotNull(), F.col(out))
    columns = {text: clean} | ({n_chars: F.length(clean).cast("long")} if n_chars in docs.columns else {})
    return done.withColumns(columns).drop(out)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data masked."""
    return mask(docs)
