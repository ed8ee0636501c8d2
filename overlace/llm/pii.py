"""PII: format-preserving Feistel pseudonyms.

Card numbers that pass the Luhn check, bank account numbers that pass mod 97, phone
numbers, IPv4 addresses, dates, e-mail addresses, access keys, passwords and tokens are
replaced by values of the same format. A value is written as an integer below the size
of its format (a date as its day, a card as its digits without the check digit); a keyed
Feistel network permutes the integers of that size. Equal values thus get equal
pseudonyms in every document, different values different ones, and check digits are
recomputed, so that a pseudonym is as valid as its value. The key never leaves the
operator's argument.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from bisect import bisect_left, insort

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from overlace.llm.common import map_batches

ROUNDS = 8
DIGITS, HEX, UPPER, LOWER = "0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Dates of this span are permuted among themselves, as days.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1: Feistel rounds over two halves, walked until the result is below ``size``."""
    if size < 2:
        return value
    width = max(2, (size - 1).bit_length())
    right_bits = width // 2
    left_bits = width - right_bits
    while True:
        left, right = value >> right_bits, value & ((1 << right_bits) - 1)
        a, b = left_bits, right_bits
        for r in range(ROUNDS):
            seal = hmac.digest(key, f"{tweak}|{size}|{r}|{right}".encode(), hashlib.sha256)
            left, right = right, left ^ (int.from_bytes(seal, "big") & ((1 << a) - 1))
            a, b = b, a
        value = left << right_bits | right
        if value < size:
            return value


def in_alphabet(text: str, alphabet: str, key: bytes, tweak: str) -> str:
    """``text`` permuted among the texts of its length over ``alphabet``."""
    base, value = len(alphabet), 0
    for c in text:
        value = value * base + alphabet.index(c)
    value = permute(value, base ** len(text), key, f"{tweak}{len(text)}")
    out = []
    for _ in text:
        value, digit = divmod(value, base)
        out.append(alphabet[digit])
    return "".join(reversed(out))


def luhn_digit(body: str) -> str:
    """The check digit that makes ``body`` and it pass the Luhn check."""
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c)
        total += d if k % 2 else d * 2 - 9 * (d > 4)
    return str(-total % 10)


def _shaped(text: str, new: str, alphabet: str) -> str:
    """``text`` with its characters of ``alphabet`` replaced by those of ``new``, in order."""
    fresh = iter(new)
    return "".join(next(fresh) if c in alphabet else c for c in text)


def _card(text: str, key: bytes) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = in_alphabet(digits[:-1], DIGITS, key, "card")
    return _shaped(text, body + luhn_digit(body), DIGITS)


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = "".join(in_alphabet(run, DIGITS if run.isdigit() else UPPER[:26], key, "iban") for run in re.findall("[0-9]+|[A-Z]+", plain[4:]))
    made = f"{plain[:2]}{98 - number(f'{body}{plain[:2]}00') % 97:02d}{body}"
    return _shaped(text, made, UPPER)


def _address(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    value = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(str(b) for b in value.to_bytes(4, "big"))


#: Places of year, month and day in the dates that are known, and how they are written.
DATES = (("([0-9]{4})-([0-9]{2})-([0-9]{2})", (1, 2, 3), "{0:04d}-{1:02d}-{2:02d}"), ("([0-9]{4})/([0-9]{2})/([0-9]{2})", (1, 2, 3), "{0:04d}/{1:02d}/{2:02d}"), ("([0-9]{2})\\.([0-9]{2})\\.([0-9]{4})", (3, 2, 1), "{2:02d}.{1:02d}.{0:04d}"))


def _date(text: str, key: bytes) -> str | None:
    """A day's pseudonym is the same day in every way of writing dates."""
    found, places, written = next((m, places, written) for pattern, places, written in DATES if (m := re.fullmatch(pattern, text)))
    try:
        day = datetime.date(*(int(found[p]) for p in places)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    made = datetime.date.fromordinal(FIRST_DAY + permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date"))
    return written.format(made.year, made.month, made.day)


def _phone(text: str, key: bytes) -> str | None:
    """An international number of 8 to 15 digits keeps its country code; of one in brackets all digits change."""
    head = re.match(r"\+[0-9]{1,3}", text)
    code = head[0] if head else ""
    digits = re.sub("[^0-9]", "", text[len(code) :])
    if code and (code[1] == "0" or not 8 <= len(code) - 1 + len(digits) <= 15):
        return None
    return code + _shaped(text[len(code) :], in_alphabet(digits, DIGITS, key, f"phone{code}"), DIGITS)


def _cased(text: str, new: str) -> str:
    """``new`` with the capitals where ``text`` has them."""
    return "".join(n.upper() if c.isupper() else n for c, n in zip(text, new, strict=True))


def _email(text: str, key: bytes) -> str | None:
    """Runs of letters and of digits change, capitals stay where they are, and so does the last label."""
    local, _, domain = text.rpartition("@")
    swap = lambda m: _cased(m[0], in_alphabet(m[0].lower(), DIGITS if m[0].isdigit() else LOWER, key, "email"))
    host, _, top = domain.rpartition(".")
    return f"{re.sub('[0-9]+|[A-Za-z]+', swap, local)}@{re.sub('[0-9]+|[A-Za-z]+', swap, host)}.{top}"


def _secret(text: str, key: bytes) -> str | None:
    head = re.match(r"(?i)(?:AKIA|[a-z_]+\s*[=:]\s*[\"']?)?", text)[0]
    body = text[len(head) :]
    alphabet = HEX if set(body) <= set(HEX) else HEX.upper() if set(body) <= set(HEX.upper()) else UPPER if set(body) <= set(UPPER) else None
    if alphabet:
        return head + in_alphabet(body, alphabet, key, "secret")
    kinds = ((DIGITS, "[0-9]+"), (LOWER, "[a-z]+"), (UPPER[:26], "[A-Z]+"))
    for letters, pattern in kinds:
        body = re.sub(pattern, lambda m, letters=letters: in_alphabet(m[0], letters, key, "secret"), body)
    return head + body


#: In order: (what a text must hold, pattern, pseudonym). Earlier rules take their places first.
NAMES = ("password", "passwd", "pwd", "token", "secret", "apikey", "api_key", "akia")
RULES = (
    (NAMES, r"(?i:\b(?:password|passwd|pwd|token|secret|api_?key)\s*[=:]\s*[\"']?)[A-Za-z0-9]{6,}|\bAKIA[0-9A-Z]{16}\b", _secret),
    (("@",), r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    ((), r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    (("+", ") "), r"\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ -]?[0-9]{3}[ -]?[0-9]{4}(?![0-9])|(?<![0-9] )\([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])", _phone),
    ((".",), r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])", _address),
    (("-", "/", "."), r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9/])[0-9]{4}/[0-9]{2}/[0-9]{2}(?![0-9/])|(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])", _date),
    ((), r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])", _card),
)
#: Numbers in groups, whose pattern may run on into the next number: shorter ends and later starts are tried.
GROUPED = (_iban, _card)
COMPILED = tuple((marks, re.compile(pattern), make) for marks, pattern, make in RULES)


def _found(text: str, pattern: re.Pattern, make, key: bytes, taken: list) -> None:
    """Adds (begin, end, pseudonym) of each value to ``taken``.

    Of a number in groups every run of whole groups is tried; of runs that pass the check
    and overlap, the longest counts.
    """
    at, passed = 0, []

    def free(begin: int, end: int) -> bool:  # `taken` is sorted and its spans are apart
        i = bisect_left(taken, (end,))
        return not i or taken[i - 1][1] <= begin

    while match := pattern.search(text, at):
        begin, end = match.span()
        ends, at = [end], end
        if make in GROUPED:
            at = begin + 1
            ends += [e for e in range(end - 1, begin, -1) if text[e] in " -" and text[e - 1] not in " -" and pattern.fullmatch(text, begin, e)]
        passed += [(begin - e, begin, e, made) for e in ends if free(begin, e) and (made := make(text[begin:e], key)) is not None]
    for _, begin, end, made in sorted(passed):
        if free(begin, end):
            insort(taken, (begin, end, made))


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, int]:
    """The text with its values replaced, and how many were."""
    if not text:
        return text, 0
    lowered, taken = text.lower(), []
    for marks, pattern, make in COMPILED:
        if marks and not any(m in lowered for m in marks):
            continue
        _found(text, pattern, make, key, taken)
    out, at = [], 0
    for begin, end, made in taken:
        out += text[at:begin], made
        at = end
    return "".join(out) + text[at:], len(taken)


def pseudonyms(docs: DataFrame, *, key: str) -> DataFrame:
    """doc_id, text, n_replaced for every document; the text has pseudonyms for its values.

    ``docs``: doc_id, text and any other columns. Null text stays null, empty text empty,
    both with 0. Repeated rows give repeated results, a null doc_id is carried along. An
    empty table gives an empty result. Values of other formats, and numbers that fail
    their check, stay.
    """
    secret = key.encode()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for low in range(0, len(batch), 1024):
                part = batch.slice(low, 1024)
                # Every value holds a digit or an @ or a named secret: other texts pass as they are.
                texts = part.column(1)
                may = pc.fill_null(pc.match_substring_regex(texts, r"[0-9@]|(?i:password|passwd|pwd|token|secret|api_?key)"), False).to_numpy(zero_copy_only=False)
                made = [pseudonymise(t, secret) if m else (t, 0) for t, m in zip(texts.to_pylist(), may.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t for t, _ in made], pa.string()), pa.array([n for _, n in made], pa.int32())], names=["doc_id", "text", "n_replaced"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, text string, n_replaced int")
