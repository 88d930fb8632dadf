"""Fill-in-middle rewriting of whole texts, cut and joined as ropes.

A text becomes a balanced binary tree whose leaves are stretches of about LEAF code
points, never cutting a unit; every node caches the units and code points below
it.  The tree is split at two unit ranks, in as many steps as it is deep, and the
parts are concatenated with sentinels as leaves of their own:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text, where it is empty, holds a sentinel, or is dealt so

Reading back is the same in reverse: the output's tree is split around its
sentinels, and the parts are concatenated in the order of the text.

A document's cuts and form come of the SHA-256 of ``<seed>:<key>``, so they are the
same on any cluster and in any order of rows.  Units are code points, words (each with
the white space before it) or lines.  Nothing is shuffled, and only the text and
the digest go to Python, so columns of any type and name may be there.

Defined results: a null text is empty, an empty one plain; a null key counts as the
empty text in the digest, so repeated keys with equal texts are cut alike; columns of docs that are
named like an output are replaced; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted

LEAF = 1024
#: Patterns that cut a text into units end to end; code points need none.
UNITS = {"char": None, "word": re.compile(r"\s*\S+(?:\s+\Z)?|\s+\Z"), "line": re.compile(r"[^\n]*\n|[^\n]+")}
OUTPUTS = ("n_units", "form", "prefix_chars", "middle_chars", "output")
RESULT = pa.struct([("n_units", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
RESULT_SQL = "n_units long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Format:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain_percent: int = 10
    spm_percent: int = 20

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Rope:
    """A node: a leaf holds text, any other two ropes; both hold what is below them in units and code points."""

    __slots__ = ("text", "left", "right", "units", "chars")

    def __init__(self, text: str | None, left: Rope | None, right: Rope | None, units: int, chars: int):
        self.text, self.left, self.right, self.units, self.chars = text, left, right, units, chars

    def leaves(self) -> Iterator[str]:
        held = [self]
        while held:
            node = held.pop()
            if node.text is None:
                held += (node.right, node.left)
            else:
                yield node.text

    def __str__(self) -> str:
        return "".join(self.leaves())


EMPTY = Rope("", None, None, 0, 0)


def concat(a: Rope, b: Rope) -> Rope:
    if not a.chars or not b.chars:
        return b if not a.chars else a
    return Rope(None, a, b, a.units + b.units, a.chars + b.chars)


def leaf(text: str, units: int | None = None) -> Rope:
    return Rope(text, None, None, len(text) if units is None else units, len(text))


def build(text: str, unit: str = "char", size: int = LEAF) -> Rope:
    """A balanced rope; a leaf ends with the first unit that fills it, so one long unit is one leaf."""
    pattern = UNITS[unit]
    if pattern is None:
        level = [leaf(text[at : at + size]) for at in range(0, len(text), size)]
    else:
        level, begun, n, end = [], 0, 0, 0
        for found in pattern.finditer(text):
            n, end = n + 1, found.end()
            if end - begun >= size:
                level.append(leaf(text[begun:end], n))
                begun, n = end, 0
        if end > begun:
            level.append(leaf(text[begun:end], n))
    while len(level) > 1:
        level = [concat(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else EMPTY


def split(node: Rope, rank: int, unit: str = "char") -> tuple[Rope, Rope]:
    """The first rank units and the rest; only the nodes on the way to the cut are made anew."""
    if rank <= 0:
        return EMPTY, node
    if rank >= node.units:
        return node, EMPTY
    if node.text is not None:
        at = rank
        if UNITS[unit] is not None:
            for i, found in enumerate(UNITS[unit].finditer(node.text), 1):
                if i == rank:
                    at = found.end()
                    break
        return leaf(node.text[:at], rank), leaf(node.text[at:], node.units - rank)
    if rank < node.left.units:
        a, b = split(node.left, rank, unit)
        return a, concat(b, node.right)
    a, b = split(node.right, rank - node.left.units, unit)
    return concat(node.left, a), b


def draws(digest: str) -> list[int]:
    """Four numbers of 32 bits from the hex digest of a key."""
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def rewrite(text: str, digest: str, unit: str, use: Format) -> tuple[int, str, int | None, int | None, str]:
    whole = build(text, unit)
    h1, h2, h3, h4 = draws(digest)
    if not text or any(s in text for s in use.sentinels) or h3 % 100 >= 100 - use.plain_percent:
        return whole.units, "plain", None, None, text
    first, second = sorted((h1 % (whole.units + 1), h2 % (whole.units + 1)))
    prefix, rest = split(whole, first, unit)
    middle, suffix = split(rest, second - first, unit)
    form = "spm" if h4 % 100 < use.spm_percent else "psm"
    parts = [(use.prefix, prefix), (use.suffix, suffix)]
    out = EMPTY
    for sentinel, part in [*(reversed(parts) if form == "spm" else parts), (use.middle, middle)]:
        out = concat(concat(out, leaf(sentinel)), part)
    return whole.units, form, prefix.chars, middle.chars, str(out)


def read_back(output: str, form: str, use: Format) -> str:
    """The text that output was made of; no text holds a sentinel, so each one's first place is its own."""
    if form == "plain":
        return output
    order = [use.prefix, use.suffix] if form == "psm" else [use.suffix, use.prefix]
    at = output.index(order[1], len(order[0]))
    end = output.index(use.middle, at + len(order[1]))
    _, rest = split(build(output), len(order[0]))
    one, rest = split(rest, at - len(order[0]))
    _, rest = split(rest, len(order[1]))
    two, rest = split(rest, end - at - len(order[1]))
    _, middle = split(rest, len(use.middle))
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return str(concat(concat(prefix, middle), suffix))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", unit: str = "char", seed: str = "1", use: Format = Format()) -> DataFrame:
    """docs (key, text, ...) with n_units, form, prefix_chars, middle_chars (null if plain) and output."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")

    def run(texts: pa.Array, digests: pa.Array) -> pa.Array:
        made = [rewrite(t or "", d, unit, use) for t, d in zip(texts.to_pylist(), digests.to_pylist(), strict=True)]
        return pa.array([dict(zip(OUTPUTS, row, strict=True)) for row in made], RESULT)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    made = F.arrow_udf(run, RESULT_SQL)(F.col("text").cast("string"), digest)
    kept = docs.drop(*OUTPUTS)
    name = fresh("made", kept.columns)
    return kept.withColumn(name, made).select(*(quoted(c) for c in kept.columns), F.col(f"{name}.*"))


def restored(output: Column, form: Column, use: Format = Format()) -> Column:
    """The texts that outputs of fill_in_middle were made of."""

    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return pa.array([read_back(o, f, use) for o, f in zip(outputs.to_pylist(), forms.to_pylist(), strict=True)], pa.string())

    return F.arrow_udf(run, "string")(output, form)
