"""Base patterns of the secret and personal-data scans, found over whole texts as code-point spans.

Every finder gives the leftmost non-overlapping matches of its pattern; a match that fails its check is
dropped and its characters are not tried again. Cheap substring tests only decide whether a pattern can
match at all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

Span = tuple[str, int, int]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_MAP = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9][\x20().0-9-]{6}")

SECRET_KINDS = ("assign", "access", "hex")
PII_KINDS = ("email", "ip", "card", "phone")


def secrets(text: str) -> list[Span]:
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in ("password", "passwd", "secret", "token", "api")):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"h" * 32 in text.encode("utf-8", "surrogatepass").translate(_HEX_MAP):
        out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 32]
    return ordered(out, SECRET_KINDS)


def emails(text: str) -> list[Span]:
    """Every start inside one run of local characters leads to the same ``@``, so only ``@`` signs are tried."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text: str) -> list[Span]:
    out = emails(text) if "@" in text else []
    if _DIGITS.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start():
                d = re.sub(r"[\x20-]", "", m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ordered(out, PII_KINDS)


def ordered(spans: Iterable[Span], kinds: Iterable[str]) -> list[Span]:
    place = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], place[s[0]], s[2]))


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
