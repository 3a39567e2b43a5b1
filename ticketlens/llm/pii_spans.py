"""Personal data told by form: e-mail and IP addresses, card and phone numbers.

Matches are the leftmost non-overlapping ones of each kind's pattern; those
that fail the kind's check are dropped.  Every search is linear in the text:
an address is found from its ``@``, dotted and spaced digits by whole runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

# possessive runs and a look behind keep the searches linear
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_NUMBER = re.compile(r"[0-9]+")
_DIGITS = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[Span]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end, "email"))
        else:
            end = max(end, at + 1)  # what comes next starts behind this sign anyhow
        at = text.find("@", max(end, at + 1))
    return out


def addresses(text: str) -> list[Span]:
    out = []
    for run in _DOTTED.finditer(text):
        parts = [(m.start(), m.end()) for m in _NUMBER.finditer(text, run.start(), run.end())]
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(_at_most_255(text[a:b]) for a, b in four):
                out.append((four[0][0], four[3][1], "ip"))
    return out


def _at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _card_forms(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether the check digit is right) of numbers of a card's length."""
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19:
                yield m.start(), m.end(), luhn(digits)


def cards(text: str) -> list[Span]:
    return [(a, b, "card") for a, b, right in _card_forms(text) if right]


def failed_cards(text: str) -> list[tuple[int, int]]:
    """Numbers of a card's length whose check digit is wrong."""
    return [(a, b) for a, b, right in _card_forms(text) if not right]


def phones(text: str) -> list[Span]:
    out, at = [], text.find("+")
    while at >= 0:
        found = _PHONE.match(text, at)
        end = 0
        if found:
            end = found.end()
            while not "0" <= text[end - 1] <= "9":
                end -= 1
        if found and end - at >= 4:  # a sign, a digit, one character and a digit at least
            if 9 <= sum("0" <= c <= "9" for c in text[at:end]) <= 15:
                out.append((at, end, "phone"))
            at = text.find("+", end)
        else:
            at = text.find("+", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    found = [*emails(text), *addresses(text), *cards(text), *phones(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))
