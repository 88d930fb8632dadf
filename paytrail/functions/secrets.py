"""Tokens, fingerprints and redaction of personal data, as column expressions where Spark has them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import OPTIONAL_FIELD, PROHIBITED_FIELDS, REDACTED

BLOCK = 64


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once for a row however often use speaks of it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def stripped(text: Column) -> Column:
    """Without white space of any script at the ends."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def is_plain(text: Column) -> Column:
    """Whether text is printable ASCII without blanks, quotes and backslashes: as it is, it is stripped, and JSON between quotes."""
    return text.rlike(r"\A[!#-\[\]-~]*\z")


def normalised(email: Column) -> Column:
    return F.lower(F.when(is_plain(email), email).otherwise(stripped(email)))


def hmac_sha256(message: Column, key: bytes) -> Column:
    """Hex HMAC-SHA256 of a binary or string column; the pads are made once, on the driver."""
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK, b"\0")
    inner, outer = (F.lit(bytearray(k ^ pad for k in key)) for pad in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))
    return F.sha2(F.concat(outer, first), 256)


def customer_token(email: Column, key: bytes) -> Column:
    """Keyed token of a normalised address; null stays null."""
    if len(key) < 32:
        raise ValueError("token_key_too_short")
    return F.when(email.isNotNull(), hmac_sha256(normalised(email), key))


def escape_non_ascii(text: Column) -> Column:
    r"""JSON text with every character beyond ASCII as \uXXXX, in UTF-16 units."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("(.{4})"), 1)
    ascii_unit = lambda h: F.decode(F.unhex(F.substring(h, 3, 2)), "US-ASCII")
    each = F.transform(units, lambda h: F.when(h < "0080", ascii_unit(h)).otherwise(F.concat(F.lit("\\u"), F.lower(h))))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, text).otherwise(F.array_join(each, ""))


#: Letters beyond ASCII that case folding turns into letters of the names.
FOLDED = {"k": "\u212a", "s": "\u017f"}


def _any_case(name: str) -> str:
    return "".join(f"[{c}{c.upper()}{FOLDED.get(c, '')}]" if c.isalpha() else c for c in name)


_NAMES = "|".join(map(_any_case, sorted(PROHIBITED_FIELDS)))
_HEADS = "".join(sorted({c for name in PROHIBITED_FIELDS for c in name[0] + name[0].upper() + FOLDED.get(name[0], "")}))


def may_be_prohibited(text: Column) -> Column:
    """Whether JSON text may hold a prohibited key: one of the names before a colon, or a key written with escapes."""
    # A pattern that begins with one character is looked for where that is; with alternatives at its head, everywhere.
    return F.contains(text, F.lit("\\u")) | text.rlike(rf'"(?=[{_HEADS}])(?:{_NAMES})"\s*:')


def prohibited_keys(canonical: Column) -> Column:
    """Sorted prohibited keys at any depth, comma-joined, or null, of JSON text without white space between tokens.

    A key there follows a brace or a comma; within a text value, quotes have a backslash before them.
    """
    folded = lambda found: F.transform(found, lambda k: F.lower(F.translate(k, "".join(FOLDED.values()), "".join(FOLDED))))
    joined = lambda found: F.when(F.size(found) > 0, F.array_join(F.array_sort(F.array_distinct(folded(found))), ","))
    return once(F.regexp_extract_all(canonical, F.lit(rf'[{{,]"({_NAMES})":'), 1), joined)


#: Levels to which a hidden value is looked through for its end.
DEEPEST = 64
_TEXT = r'"(?:[^"\\]|\\.)*+"'
_NESTED = r"[^\[\]{}]"
for _ in range(DEEPEST):
    _NESTED = rf'[\[{{](?:[^\[\]{{}}"]++|{_TEXT}|{_NESTED})*+[\]}}]'
_HIDDEN_KEY = rf'([{{,]"(?:{_NAMES}|{_any_case(OPTIONAL_FIELD)})":)'


def redacted(text: Column) -> Column:
    """JSON text with the values of prohibited keys and of the address replaced, at any depth; for quarantined rows.

    The text comes out with sorted keys and without white space.  In that form a key follows a
    brace or a comma, and a value ends where its brackets are even.  Of a text that can't
    be read, or whose hidden values are nested too deep, size and digest stay.
    """
    hidden = rf'{_HIDDEN_KEY}(?:{_TEXT}|{_NESTED}|[^\[{{",}}\]]++)'
    unreadable = F.concat(F.lit('{"unreadable_bytes":'), F.octet_length(text).cast("string"), F.lit(',"unreadable_sha256":"'), F.sha2(text.cast("binary"), 256), F.lit('"}'))
    told = lambda safe: F.when(safe.isNull() | safe.rlike(rf"{_HIDDEN_KEY}[\[{{]"), unreadable).otherwise(escape_non_ascii(safe))
    # Reading the text and searching it are all the cost, and the rules look at what comes of them again and again.
    return F.when(text.isNotNull(), once(F.regexp_replace(F.to_json(F.try_parse_json(text)), hidden, rf'$1"{REDACTED}"'), told))
