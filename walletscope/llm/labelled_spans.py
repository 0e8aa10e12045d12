"""The labelled spans that the personal-data tagger learns from.

Short texts of invented words around invented personal data in many notations, and around
numbers that are none: dates, times, prices, versions, keys and counts.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: Separators that the fixed card pattern does not take.
CARDS_APART = (".", "/", "_", "  ")

_SYLLABLES = ("th er on an re he in ed nd ha en to it ou ea hi is or ti as te et ng of al de se le sa si ar ve ra ld ur "
              "ción os ment eau é è ü ö ß ungen sch keit ñ í que").split()


def _word(rng: random.Random) -> str:
    word = "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))
    return word.capitalize() if rng.random() < 0.15 else word


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _name(rng: random.Random) -> str:
    name = "".join(rng.choice("abcdefghijklmnoprstuvwy") for _ in range(rng.randint(2, 9)))
    return name + rng.choice(("", "", ".", "_", "-")) + rng.choice(("", _digits(rng, 2), "lee", "x7"))


def _email(rng: random.Random) -> str:
    local = _name(rng).strip("._-") or "me"
    host = rng.choice(("mail", "post", "example", "web", "inbox")) + rng.choice(("", _digits(rng, 1)))
    top = rng.choice((".com", ".org", ".net", ".example.com", ".de", ".co.uk"))
    style = rng.random()
    if style < 0.55:
        return f"{local}@{host}{top}"
    if style < 0.7:
        return f"{local} @ {host}{top}"
    at = rng.choice(("(at)", "[at]"))
    if style < 0.85:
        return f"{local}{at}{host}{top}"
    dot = " [dot] " if at == "[at]" else " (dot) "
    return f"{local} {at} {host}{top.replace('.', dot, 1) if top.count('.') == 1 else top}"


def _ip(rng: random.Random) -> str:
    return rng.choice((".", ".", ".", "[.]", " . ", "(.)")).join(str(rng.randint(1, 255)) for _ in range(4))


def _card(rng: random.Random) -> str:
    digits = rng.choice("3456") + _digits(rng, 15)
    apart = rng.choice(("", "", " ", "-", *CARDS_APART))
    return apart.join(digits[i:i + 4] for i in range(0, 16, 4))


def _phone(rng: random.Random) -> str:
    a, b, c = str(rng.randint(200, 999)), str(rng.randint(200, 999)), _digits(rng, 4)
    return rng.choice((f"+1 ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"+{rng.randint(20, 99)} {a} {b}{c}", f"({a}) {b}-{c}",
                       f"{a}-{b}-{c}", f"({a}) {b} {c}", f"{a}.{b}.{c}", f"00{rng.randint(20, 99)} {a} {b}{c}"))


def _none(rng: random.Random) -> str:
    n = rng.randint
    return rng.choice((
        f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)}", f"{n(10, 23)}:{n(10, 59)}:{n(10, 59)}", f"{n(1, 28)}.{n(1, 12)}.{n(1990, 2030)}",
        f"{n(1, 9)},{_digits(rng, 3)}.{_digits(rng, 2)}", f"v{n(1, 9)}.{n(0, 20)}.{n(0, 9)}", f"{n(1, 9999)}", f"{n(1, 99)}%",
        f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(n(16, 40)))}"', f"#{_digits(rng, n(3, 7))}",
        f"{_digits(rng, n(5, 7))}", f"{n(2, 9)} x {n(2, 9)} = {n(4, 81)}", f"@{_name(rng)}", f"pages {n(1, 400)}-{n(401, 900)}",
        f"{n(1, 99)} + {n(1, 99)}", f"ISBN {_digits(rng, 3)}-{_digits(rng, 1)}-{_digits(rng, 5)}", f"{n(1, 9)}.{_digits(rng, n(2, 8))}"))


def examples(count: int, width: int, seed: int) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Texts of at most ``width`` characters, each with its spans (kind number, start, end)."""
    rng = random.Random(seed)
    for _ in range(count):
        text, spans = "", []
        while len(text) < width:
            if text:
                text += rng.choice((" ", " ", " ", " ", ", ", ". ", "\n", ": ", "### ", "&&& ", "\n- "))
            pick = rng.random()
            if pick < 0.72:
                text += _word(rng)
            elif pick < 0.82:
                text += _none(rng)
            else:
                kind = rng.randrange(4)
                found = (_email, _ip, _card, _phone)[kind](rng)
                spans.append((kind, len(text), len(text) + len(found)))
                text += found + rng.choice(("", "", "", ".", ",", ";", ")", "###", "%%%"))
        cut = rng.randint(0, max(0, len(text) - width))  # windows may cut what they hold
        yield text[cut:cut + width], [(k, max(a - cut, 0), min(b - cut, width)) for k, a, b in spans
                                      if a < cut + width and b > cut]
