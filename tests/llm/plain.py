"""Brute-force versions of the operators in plain Python, and small tables with odd rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def spaced(text, lower=False):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(UPPER) if lower else text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=13):
    cut = {}
    for item_id, text in items:
        words = alnum(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            cut.setdefault(tuple(words[i : i + n]), set()).add(str(item_id))
    sizes = {len(w) for w in cut}
    out = []
    for doc_id, text in docs:
        words, hit, found = alnum(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if ids := cut.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    digits = lambda x: re.sub("[^0-9]", "", x)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def shape(text):
    words = spaced(text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def phrases(text):
    words = alnum(text)
    found = [
        (label, i)
        for label, phrase in (("cc-by", ["cc", "by"]), ("gpl", ["general", "public", "license"]), ("reserved", ["all", "rights", "reserved"]))
        for i in range(len(words))
        if words[i : i + len(phrase)] == phrase
    ]
    places = [i for _, i in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for x, _ in found}))


#: Odd texts: NULL, empty, blank, repeated, ties, long, control and non-ASCII characters.
ODD = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "one",
    "The end é Ö 中文 \U0001f600 of\x00it",
    "mail a@b.co a.b+c@d-e.f.g_h@i.jk x@y @z. 1.2.3.4 1.2.3.4.5.6.7.8 999.1.1.1 00001.2.3.255 1.2.3.256",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112 and 4111111111111111, 79927398713 0000000000000",
    "call +1 (017) 555-7713 or +49 30 123456 ) +1 2 +123456789012345678 +1..5",
    "€\U0001f600 x@y.zz \U0001f600 8.8.8.8",
    "9" * 3000 + " " + "a" * 20000 + "@" + "b.c" * 50,
    "general public license CC-BY cc by  ALL rights RESERVED All Rights reserved general public",
    "a b c a b c a b c\nx\nx\n \n \ny\nx",
    "z " * 3000,
    "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
]
