"""Small corpora and plain-Python versions of what the operators compute."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def prose(n: int, seed: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    parts = ["ba", "do", "ki", "lu", "mé", "ra", "sto", "tin", "ver", "ñu"]
    vocab = ["".join(random.Random(1000 + i).choices(parts, k=1 + i % 4)) for i in range(vocabulary)]
    out = []
    for i in range(n):
        w = r.choice(vocab)
        out.append(w.capitalize() if i % 13 == 0 else w)
        if i % 13 == 12:
            out[-1] += "." + ("\n" if i % 3 == 0 else "")
    return " ".join(out)


def corpus() -> list[tuple[int | None, str | None]]:
    """Texts of all kinds: null, empty, tiny, copies, near copies, shared passages, very long."""
    base = [prose(60 + 17 * i, i) for i in range(14)]
    passage = prose(70, 900)
    rows: list[tuple[int | None, str | None]] = [(i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, "  \n\t "), (103, "one"), (104, "one two"), (105, "ONE TWO"), (106, "one  two"), (107, "é É")]
    rows += [(200 + i, base[3]) for i in range(40)]  # a large group of copies
    rows += [(300 + i, base[5].replace("ba", "BA", 1 + i % 2)) for i in range(6)]
    for i in range(8):  # near copies
        own = base[9].split(" ")
        own[11 + 3 * i] = "changed"
        rows.append((400 + i, " ".join(own)))
    rows += [(500 + i, prose(40, 600 + i) + " " + passage + " " + prose(30, 700 + i)) for i in range(5)]
    rows += [(600, prose(9_000, 77) + " " + passage), (601, "x " * 5_000), (602, "x" * 50_000)]
    rows += [(None, base[2]), (None, None), (700, base[1]), (700, base[1]), (701, base[1])]
    return rows
