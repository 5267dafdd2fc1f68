"""Format-preserving pseudonyms for personal data and secrets.

What is found and passes its validation (card numbers by check digit, bank accounts by their
remainder, addresses by their parts, dates by the calendar) is replaced by another value of the
same format. The value without its separators is read as a number below the size of its format,
permuted by a keyed Feistel network over enough bits, walked along the cycle until it lies in the
format again and is valid, and written back into the separators it had. The permutation depends
on the key and the kind of value only, so equal values stay equal in all documents, different
ones stay different, and whoever has the key can undo it (``backwards``).

A null text stays null; an empty one, and every text in which nothing is found, is unchanged.
Other columns pass as they are. Everything is per document: no shuffle, any number of rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b
from string import ascii_lowercase, ascii_uppercase, digits

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tagloom.llm.tokens import slices

ROUNDS = 8

#: Texts without any of these hold nothing to replace.
HINT = "[0-9@]|(?i:password|passwd|secret|token|api[_-]?key)"

FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)


class Permutation:
    """Keyed permutations of ``range(size)``, one per kind and size."""

    def __init__(self, key: bytes, backwards: bool = False):
        self.key, self.backwards = blake2b(key, digest_size=32).digest(), backwards

    def _once(self, value: int, half: int, tweak: bytes) -> int:
        mask, size = (1 << half) - 1, (half + 7) // 8
        left, right = value >> half, value & mask

        def turn(k: int, x: int) -> int:
            out, block = b"", 0
            while len(out) < size:
                told = b"%s|%d|%d|%s" % (tweak, k, block, x.to_bytes(size, "big"))
                out += blake2b(told, key=self.key).digest()
                block += 1
            return int.from_bytes(out[:size], "big") & mask

        if self.backwards:
            for k in reversed(range(ROUNDS)):
                left, right = right ^ turn(k, left), left
        else:
            for k in range(ROUNDS):
                left, right = right, left ^ turn(k, right)
        return left << half | right

    def __call__(self, value: int, size: int, kind: str, valid: Callable[[int], bool] = lambda v: True) -> int:
        """Where ``value`` goes among the valid numbers below ``size``."""
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        tweak = f"{kind}|{size}".encode()
        while True:
            value = self._once(value, half, tweak)
            if value < size and valid(value):
                return value


def permute_text(text: str, permute: Permutation, kind: str, hexadecimal: bool = False) -> str:
    """Letters and digits of ``text`` permuted within their classes; other characters stay."""
    hexes = "0123456789abcdef"
    alphabets = []
    for c in text:
        classes = (hexes, hexes.upper()) if hexadecimal else (digits, ascii_lowercase, ascii_uppercase)
        alphabets.append(next((a for a in classes if c in a), ""))
    value, size = 0, 1
    for c, alphabet in zip(text, alphabets, strict=True):
        if alphabet:
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    shape = "".join(a[0] if a else c for c, a in zip(text, alphabets, strict=True))
    value = permute(value, size, f"{kind}|{shape}")
    out = []
    for c, alphabet in zip(reversed(text), reversed(alphabets), strict=True):
        if alphabet:
            value, at = divmod(value, len(alphabet))
            c = alphabet[at]
        out.append(c)
    return "".join(reversed(out))


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def respaced(written: str, replaced: str) -> str:
    """``replaced`` with the separators of ``written``."""
    chars = iter(replaced)
    return "".join(next(chars) if c.isalnum() else c for c in written)


def email(found: re.Match, permute: Permutation) -> str | None:
    name, _, host = found[0].rpartition("@")
    labels, _, top = host.rpartition(".")
    changed = permute_text(f"{name}@{labels}", permute, "email")
    return f"{changed}.{top}"


def address(found: re.Match, permute: Permutation) -> str | None:
    parts = [int(p) for p in found[0].split(".")]
    if any(p > 255 for p in parts) or any(len(p) > 1 and p[0] == "0" for p in found[0].split(".")):
        return None
    value = int.from_bytes(bytes(parts), "big")
    return ".".join(map(str, permute(value, 1 << 32, "ipv4").to_bytes(4, "big")))


def card(found: re.Match, permute: Permutation) -> str | None:
    number = re.sub(r"\D", "", found[0])
    if not 13 <= len(number) <= 19 or not luhn(number) or len(set(number)) == 1:
        return None
    n = len(number) - 1
    head = str(permute(int(number[:-1]), 10**n, "card")).zfill(n)
    check = next(c for c in digits if luhn(head + c))
    return respaced(found[0], head + check)


def account(found: re.Match, permute: Permutation) -> str | None:
    def remainder(country: str, check: str, rest: str) -> int:
        return int("".join(str(int(c, 36)) for c in rest + country + check)) % 97

    # Groups after the number may look like more of it.
    groups = found[0].split(" ")
    for last in range(len(groups), 0, -1):
        number, written = "".join(groups[:last]), " ".join(groups[:last])
        country, check, rest = number[:2], number[2:4], number[4:]
        if 15 <= len(number) <= 34 and remainder(country, check, rest) == 1:
            rest = permute_text(rest, permute, "iban|" + country)
            changed = respaced(written, f"{country}{98 - remainder(country, '00', rest):02d}{rest}")
            return changed + found[0][len(written) :]
    return None


def social(found: re.Match, permute: Permutation) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    value = int(found[0].replace("-", "").replace(" ", ""))
    return respaced(found[0], f"{permute(value, 10**9, 'ssn', valid):09d}") if valid(value) else None


def phone(found: re.Match, permute: Permutation) -> str | None:
    """Ten digits of the North American plan; of other numbers all but the first two digits."""
    number = re.sub(r"\D", "", found[0])
    plus = found[0].startswith("+")
    own = number[1:] if len(number) == 11 and number[0] == "1" else number if len(number) == 10 and not plus else ""

    def valid(v: int) -> bool:
        return v // 10**9 >= 2 and v // 10**6 % 10 >= 2

    if own and valid(int(own)):
        changed = number[: len(number) - 10] + f"{permute(int(own), 10**10, 'phone', valid):010d}"
    elif plus and 8 <= len(number) <= 15:
        changed = number[:2] + str(permute(int(number[2:]), 10 ** (len(number) - 2), "phone|" + number[:2])).zfill(len(number) - 2)
    else:
        return None
    return respaced(found[0], changed)


def local_phone(found: re.Match, permute: Permutation) -> str | None:
    value = int(found[0].replace("-", ""))
    changed = permute(value, 10**7, "local", lambda v: v >= 2_000_000)
    return respaced(found[0], f"{changed:07d}") if value >= 2_000_000 else None


def day(found: re.Match, permute: Permutation) -> str | None:
    """Year first, or day (or else month) before month and a four-digit year."""
    parts = re.split(r"[-./]", found[0])
    orders = [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 1, 0), (2, 0, 1)]
    for order in orders:
        try:
            known = date(*[int(parts[k]) for k in order])
        except ValueError:
            continue
        if not FIRST_DAY <= known <= LAST_DAY:
            continue

        def written(v: int, order: tuple[int, ...] = order) -> tuple[str, bool]:
            moved = FIRST_DAY + timedelta(days=v)
            new = dict(zip(order, (moved.year, moved.month, moved.day), strict=True))
            text = [str(new[k]).zfill(len(parts[k])) for k in range(3)]
            # The other order would read a day of up to 12 first.
            again = order == orders[0] or moved.day > 12
            return re.sub(r"\d+", lambda m, it=iter(text): next(it), found[0]), again and all(
                len(a) == len(b) for a, b in zip(text, parts, strict=True)
            )

        kind = "|".join(["date", str(order), *[str(len(p)) for p in parts]])
        span = (LAST_DAY - FIRST_DAY).days + 1
        return written(permute((known - FIRST_DAY).days, span, kind, lambda v: written(v)[1]))[0]
    return None


def secret(found: re.Match, permute: Permutation) -> str | None:
    value = found["secret"]
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None
    changed = permute_text(value, permute, "secret", hexadecimal)
    at = found.start("secret") - found.start()
    return found[0][:at] + changed + found[0][at + len(value) :]


def access_key(found: re.Match, permute: Permutation) -> str | None:
    return found[0][:4] + permute_text(found[0][4:], permute, "access")


#: Tried in this order; what one has taken, later ones don't see.
KINDS: list[tuple[str, re.Pattern, Callable[[re.Match, Permutation], str | None]]] = [
    ("email", re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"), email),
    ("secret", re.compile(
        r"""(?i:password|passwd|pwd|secret|token|api[_-]?key)["']?\s*[=:]\s*["']?(?P<secret>(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{8,})"""), secret),
    ("access_key", re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"), access_key),
    ("iban", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b"), account),
    ("ipv4", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"), address),
    ("phone", re.compile(r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?)[0-9]{3,4}[ .-]?[0-9]{3,4}(?![\w-]|[.][0-9])"), phone),
    ("card", re.compile(r"(?<![\w.-])[0-9]{13,19}(?![\w-]|\.[0-9])"), card),
    ("card", re.compile(r"(?<![\w.-])[0-9]{4}([ -])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{6}\1[0-9]{5})(?![\w-]|\.[0-9])"), card),
    ("ssn", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), social),
    ("date", re.compile(r"(?<![\w./-])(?:[0-9]{4}([-./])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2[0-9]{4})(?![\w-]|[./][0-9])"), day),
    ("phone", re.compile(r"(?<![\w+])(?:\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![\w-]|[.][0-9])"), phone),
    ("local_phone", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{4}(?![\w-])"), local_phone),
]


def replace(text: str, permute: Permutation) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kinds that were replaced, in order of place."""
    taken: list[tuple[int, int, str, str]] = []  # apart from each other, in order of place
    for kind, pattern, change in KINDS:
        fresh, at = [], 0
        for found in pattern.finditer(text):
            a, b = found.span()
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at < len(taken) and taken[at][0] < b:
                continue
            changed = change(found, permute)
            if changed is not None:
                fresh.append((a, b, changed, kind))
        if fresh:
            taken = sorted(taken + fresh)  # two sorted runs, merged in one go
    if not taken:
        return text, []
    out, at = [], 0
    for a, b, changed, _ in taken:
        out += [text[at:a], changed]
        at = b
    return "".join([*out, text[at:]]), [kind for *_, kind in taken]


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", backwards: bool = False) -> DataFrame:
    """All columns, the text with pseudonyms, and ``replaced``: the kinds found, in order of place.
    A column of that name gives way."""
    docs = docs.drop("replaced")
    place, names = docs.columns.index(text), [*docs.columns, "replaced"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Permutation(key, backwards)
        for batch in slices(batches, place, 1 << 20):
            hint = pc.fill_null(pc.match_substring_regex(batch.column(place), HINT), False).to_numpy(zero_copy_only=False)
            texts = batch.column(place)
            done = {int(k): replace(texts[int(k)].as_py(), permute) for k in hint.nonzero()[0]}
            changed = sorted(k for k, (_, kinds) in done.items() if kinds)
            if changed:
                mask = np.zeros(len(texts), bool)
                mask[changed] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([done[k][0] for k in changed], texts.type))
            columns = [*batch.columns, pa.array([done[k][1] if k in done else [] for k in range(len(texts))], pa.list_(pa.string()))]
            columns[place] = texts
            yield pa.RecordBatch.from_arrays(columns, names=names)

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{head}, replaced array<string>")
