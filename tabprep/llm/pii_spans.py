"""Spans of personal data in a text, candidates for more, and three labelers that vote on them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

KINDS = ("email", "ip", "card", "phone")

_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits can only match if the start of the run does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NO = r"(?<![A-Za-z0-9@._+-])"
_END = r"(?![A-Za-z0-9@_+-])"
_LOOSE = {
    "email": re.compile(
        _NO + r"[A-Za-z0-9._%+-]{1,64}\s?[\[({]\s?(?:at|AT|@)\s?[\])}]\s?[A-Za-z0-9-]{1,63}"
        r"(?:\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,8}" + _END
    ),
    "ip": re.compile(_NO + r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}" + _END),
    "card": re.compile(_NO + r"[0-9](?:[\x20.-]?[0-9]){12,18}" + _END),
    "phone": re.compile(_NO + r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}" + _END),
}

# Words that name a kind, words that name other numbers, and ends of domains.
_CUES = {
    "email": frozenset("email mail contact write courriel correo".split()),
    "ip": frozenset("ip ipv6 address host server adresse".split()),
    "card": frozenset("card visa mastercard amex credit debit karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell telefon telefono numero".split()),
}
_OTHER = frozenset("version isbn issn order invoice id token password hash serial sku build page line".split())
_ENDINGS = frozenset("com org net edu gov info io de fr es uk it eu ch at nl be pt ca us au".split())
_WORDS = re.compile(r"[a-zà-ÿ0-9]+")


class Candidate(NamedTuple):
    """A span with the votes (1 yes, -1 no, 0 abstains) of format, gazetteer and context."""

    kind: str
    start: int
    end: int
    votes: tuple[int, int, int]
    base: bool


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _is(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    digits = _digits(found)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def _matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Every match of a base pattern, and whether it meets the conditions of its kind."""
    for start, end in _emails(text):
        yield "email", start, end, True
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end(), _is(kind, m[0])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by kind as in ``KINDS``, then start: leftmost, not overlapping within a kind."""
    return [(kind, start, end) for kind, start, end, good in _matches(text) if good]


def _votes(text: str, kind: str, start: int, end: int, good: bool) -> tuple[int, int, int]:
    found = text[start:end]
    if kind == "email":
        listed = 1 if re.split(r"[^A-Za-z0-9-]+", found.rstrip(")]} "))[-1].lower() in _ENDINGS else 0
    elif kind == "card":
        listed = 1 if _digits(found)[0] in "3456" else -1
    elif kind == "phone":
        area = _digits(found)[-10:-7]
        listed = 1 if len(area) == 3 and area[0] not in "01" else -1
    else:
        listed = -1 if found.startswith(("0.", "255.")) else 0
    near = set(_WORDS.findall(text[max(0, start - 40) : start].lower())[-4:])
    context = 1 if near & _CUES[kind] else -1 if near & _OTHER else 0
    return 1 if good else -1, listed, context


def candidates(text: str) -> list[Candidate]:
    """Base spans, matches of base patterns that fail a condition, and looser writings.

    A looser one counts as well-formed if it has a check of its own (a card's Luhn sum); it is
    left out where it overlaps a base span.
    """
    out, taken = [], []
    for kind, start, end, good in _matches(text):
        if good:
            taken.append((start, end))
        elif kind == "card" and end - start < 12:  # short numbers are no candidates at all
            continue
        out.append(Candidate(kind, start, end, _votes(text, kind, start, end, good), good))
    loose = []
    if "(" in text or "[" in text or "{" in text:
        loose.append("email")
    if _DIGIT.search(text):
        loose += ["card", "phone"] + ["ip"] * (":" in text)
    seen = {(c.kind, c.start, c.end) for c in out}
    for kind in loose:
        for m in _LOOSE[kind].finditer(text):
            start, end = m.span()
            if (kind, start, end) in seen or any(a < end and start < b for a, b in taken):
                continue
            good = kind != "card" or luhn(_digits(m[0]))
            votes = _votes(text, kind, start, end, good)
            out.append(Candidate(kind, start, end, (votes[0] if kind == "card" else 0, *votes[1:]), False))
    return out


def features(text: str, c: Candidate, buckets: int = 32) -> list[float]:
    """Kind, votes, shape and hashed words before a candidate."""
    from zlib import crc32

    found = text[c.start : c.end]
    out = [0.0] * (len(KINDS) + 6 + 3 + buckets)
    out[KINDS.index(c.kind)] = 1.0
    for k, v in enumerate(c.votes):
        out[len(KINDS) + 2 * k + (v < 0)] = float(v != 0)
    at = len(KINDS) + 6
    out[at : at + 3] = [len(found) / 32, len(_digits(found)) / max(1, len(found)), float(found[:1] == "+")]
    for w in _WORDS.findall(text[max(0, c.start - 40) : c.start].lower())[-2:]:
        out[at + 3 + crc32(w.encode()) % buckets] = 1.0
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span, or run of overlapping ones, as the name of its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
