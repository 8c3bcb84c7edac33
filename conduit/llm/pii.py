"""Personal data by anchors: an Aho-Corasick pass finds cues, local parsers grow them.

One automaton finds at-signs, plus signs, digits, scheme separators and words that
announce an account number. Each hit is handed to a small deterministic parser that
expands it to its boundaries and validates it. A text without any cue costs the pass
alone, and no parser looks at a character twice but for a bounded look-ahead.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from conduit.llm.common import batch, ship, texts_of

DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LABEL = DIGITS | _LETTERS | {"-"}
_LOCAL = _LABEL | frozenset("._%+")
_DIALLED = DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\f\v<>\"'`{}|\\^")
_NAME_END = _URL_END | frozenset("/?#@")
#: Words that announce an account number.
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")
KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]


def _automaton():
    found = ahocorasick.Automaton()
    for mark in "@+":
        found.add_word(mark, (mark, 1))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("://", ("scheme", 3))
    for cue in ACCOUNT_CUES:
        for form in (cue, cue.upper(), cue.title()):
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


_AUTOMATON = None


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _run(text: str, at: int, kind) -> int:
    """End of the run of characters of ``kind`` that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in kind:
        at += 1
    return at


def _email(text: str, at: int, floor: int):
    """The address around the at-sign at ``at``, beginning at ``floor`` at the earliest."""
    end = _run(text, at + 1, _LABEL)
    if end == at + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end = _run(text, end + 1, _LABEL)
        dots += 1
    begin = at
    while begin > floor and text[begin - 1] in _LOCAL:
        begin -= 1
    return (begin, end) if dots and begin < at else None


def _ip(text: str, at: int):
    """``(end, valid)`` of what four dotted numbers at ``at`` span; valid is None if they don't."""
    first = end = _run(text, at, DIGITS)
    parts = [text[at:end]]
    for _ in range(3):
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS:
            begin, end = end + 1, _run(text, end + 1, DIGITS)
            parts.append(text[begin:end])
        else:
            return first, None
    small = all(len(p) <= 3 or len(p.lstrip("0")) <= 3 for p in parts)
    return end, small and all(int(p.lstrip("0") or "0") <= 255 for p in parts)


def _card(text: str, at: int):
    """End and digits of the chain of digits at ``at``, with single spaces or hyphens between."""
    begin, n = at, len(text)
    while True:
        at = _run(text, at, DIGITS)
        if at + 1 < n and text[at] in " -" and text[at + 1] in DIGITS:
            at += 1
        else:
            break
    return at, text[begin:at].replace(" ", "").replace("-", "")


def _phone(text: str, at: int):
    """End of the dialled number at the plus sign ``at``, or None."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = _run(text, at + 2, _DIALLED)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return end, sum(c in DIGITS for c in text[at:end])


def _address(text: str, at: int):
    """A web address that carries a user's name, around the scheme separator at ``at``."""
    begin = at
    while begin > max(0, at - 16) and text[begin - 1] in _LABEL | {"+", "."}:
        begin -= 1
    if begin == at or text[begin] not in _LETTERS:
        return None
    # a name ends at the first at-sign, before any slash: so the next separator ends this look
    sign = at + 3
    while sign < len(text) and text[sign] not in _NAME_END:
        sign += 1
    if sign >= len(text) or text[sign] != "@" or sign == at + 3:
        return None
    end = sign
    while end < len(text) and text[end] not in _URL_END:
        end += 1
    while end > at + 3 and text[end - 1] in ".,;:!?)":
        end -= 1
    return begin, end


def _iban(text: str, at: int):
    """An international account number whose check digits begin at ``at``."""
    begin = at - 2
    if begin < 0 or not ("A" <= text[begin] <= "Z" and "A" <= text[begin + 1] <= "Z"):
        return None
    if begin and text[begin - 1].isalnum():
        return None
    end, kept = begin, ""
    while end < len(text) and len(kept) < 35:
        c = text[end]
        if c in DIGITS or "A" <= c <= "Z":
            kept += c
        elif c != " " or not kept or text[end - 1] == " ":
            break
        end += 1
    if end < len(text) and text[end] in _LETTERS:  # a word that follows is not part of it
        while end > begin and text[end - 1] != " ":
            end -= 1
        kept = text[begin:end].replace(" ", "")
    stop = end
    while stop > begin and len(kept) >= 15:
        if text[stop - 1] != " " and 15 <= len(kept) <= 34 and kept[2:4].isdigit():
            if int("".join(str(int(c, 36)) for c in kept[4:] + kept[:4])) % 97 == 1:
                return begin, stop
        if text[stop - 1] != " ":
            kept = kept[:-1]
        stop -= 1
    return None


def _account(text: str, at: int):
    """Digits of an account number that a cue ending at ``at`` announces."""
    n, stop = len(text), min(len(text), at + 12)
    while at < stop and text[at] not in DIGITS:
        if text[at] not in " \t:#=.-nNoOrRuUmMbBeE":
            return None
        at += 1
    if at >= stop or text[at] not in DIGITS:
        return None
    end, digits = _card(text, at)
    bounded = end >= n or text[end] not in _LETTERS
    return (at, end) if bounded and 6 <= len(digits) <= 20 else None


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """``(kind, begin, end)`` by kind in the order of KINDS, then begin; code points, end exclusive."""
    global _AUTOMATON
    if _AUTOMATON is None:
        _AUTOMATON = _automaton()
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    mail_end = ip_end = card_end = url_end = account_end = 0
    for last, (cue, size) in _AUTOMATON.iter(text):
        at = last - size + 1
        if cue == "digit":
            if at >= ip_end:
                ip_end, valid = _ip(text, at)
                if valid:
                    found["ip"].append((at, ip_end))
            if at >= card_end:
                card_end, digits = _card(text, at)
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    found["card"].append((at, card_end))
            if at >= account_end and at >= 2 and text[at - 1] not in DIGITS:
                if span := _iban(text, at):
                    found["account"].append(span)
                    account_end = span[1]
        elif cue == "@":
            if span := _email(text, at, mail_end):
                found["email"].append(span)
                mail_end = span[1]
        elif cue == "+":
            if (phone := _phone(text, at)) and 9 <= phone[1] <= 15:
                found["phone"].append((at, phone[0]))
        elif cue == "scheme":
            if at >= url_end and (span := _address(text, at)):
                found["address"].append(span)
                url_end = span[1]
        elif last + 1 >= account_end and (span := _account(text, last + 1)):
            found["account"].append(span)
            account_end = span[1]
    return [(kind, *span) for kind in KINDS for span in found[kind]]


def masked(text: str) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans are one."""
    spans = spans_of(text)
    if not spans:
        return text
    out, at = [], 0
    for begin, end, kind in sorted((begin, end, kind) for kind, begin, end in spans):
        if begin >= at:
            out += [text[at:begin], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _told(spans) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in spans)


_FOUND = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{kind}", pa.int64()) for kind in BASE]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def _found_batches(batches):
    for rows in batches:
        spans = [spans_of(text) for text in rows.column(1).to_pylist()]
        counts = {f"n_{kind}": [sum(s[0] == kind for s in x) for x in spans] for kind in BASE}
        base = [_told([s for s in x if s[0] in BASE]) for x in spans]
        yield batch(
            _FOUND,
            doc_id=rows.column(0),
            base_sha256=[hashlib.sha256(x.encode()).hexdigest() for x in base],
            spans=[_told(x) for x in spans],
            **counts,
        )


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every row of ``docs``.

    Null and empty texts have no spans, an empty spans string and the digest of nothing.
    Repeated rows and rows without a doc_id come out as they came in; other columns play
    no part; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    counts = ", ".join(f"n_{kind} long" for kind in BASE)
    return texts_of(docs).mapInArrow(_found_batches, f"doc_id long, {counts}, base_sha256 string, spans string")


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in its text masked; all rows and other columns stay."""
    ship(docs.sparkSession)
    place = docs.columns.index("text")

    def mask(batches):
        for rows in batches:
            texts = [None if x is None else masked(x) for x in rows.column(place).to_pylist()]
            yield rows.set_column(place, rows.schema.field(place), pa.array(texts, rows.schema.field(place).type))

    return docs.mapInArrow(mask, docs.schema)
