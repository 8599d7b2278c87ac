"""Surrogates for personal data: detected entities get keyed replacements of the same kind.

Detected: e-mail addresses, telephone numbers, payment card and similar long
numbers, IPv4 addresses, social security numbers, IBANs, access keys and other
secrets, and names of persons (after a form of address, or a listed given name
with initials and family names after it, across any white space), with every
other mention of a word of such a name in the same document.

A replacement depends on the key, the kind and the entity in normal form alone,
so all mentions of an entity, in any document, get the same one.  It keeps the
format: digits stay digits where they were, letters stay letters of the same
case and script, card and account numbers that passed the check-digit test
still do, names keep number of words and the gender of listed given names.  Digits and letters are permuted by a keyed
Feistel cipher over all characters of one alphabet, which is one-to-one, so
different entities of one format stay different; where formats could meet, the
cipher is walked until its value is of the entity's own class.  Names are the
enciphered number of their letters, spelled in syllables, one-to-one as well.
So no key can make two entities clash, however many there are;
``surrogate_clashes`` verifies it over all documents.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, rows_of, store

KEY = "surrogate-key-1"
ROUNDS = 8

# Forms of address and given names by gender.
TITLES = {
    "m": "Mr Herr Monsieur Señor Sir Mister Г-н Κύριος",
    "f": "Mrs Ms Miss Frau Madame Mademoiselle Señora Señorita Madam Г-жа Κυρία",
    "n": "Dr Prof Professor Docteur Doctor Doktor",
}
GIVEN = {
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Peter Paul Andrew Hans "
         "Karl Stefan Jürgen Klaus Wolfgang Pierre Jacques François Michel Philippe José Juan Carlos Luis Miguel Pedro "
         "Mohammed Ahmed Omar Raj Arjun Wei Hiroshi Mehmet Antonio Giovanni Антон Иван Сергей Дмитрий Γιώργος Νίκος",
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emma Olivia Anna Laura Julia Ursula "
         "Monika Petra Sabine Heike Claudia Marie Isabelle Nathalie Sophie Catherine María Carmen Ana Lucía Elena Rosa "
         "Aisha Fatima Priya Mei Yuki Ayşe Francesca Giulia Анна Мария Елена Ольга Ελένη Σοφία",
}
#: country codes of two digits; 1 and 7 have one, all others three
TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                       "81 82 84 86 90 91 92 93 94 95 98".split())
#: digits of a whole number after the country code, where its plan fixes them; elsewhere 15 with the code at most
LENGTHS = {"+1": (10,), "+7": (10,), "+30": (10,), "+31": (9,), "+32": (8, 9), "+33": (9,), "+34": (9,), "+41": (9,),
           "+44": (10,), "+45": (8,), "+46": (7, 8, 9), "+47": (8,), "+48": (9,), "+49": (10, 11), "+52": (10,),
           "+55": (10, 11), "+61": (9,), "+81": (9, 10), "+86": (11,), "+90": (10,), "+91": (10,), "+351": (9,),
           "+353": (9,), "+380": (9,)}
#: card numbers as printed
GROUPINGS = frozenset({(4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 4, 4, 4, 2), (4, 4, 4, 1), (4, 4, 5), (4, 5, 4), (4, 6, 4), (4, 6, 5), (6, 13)})
SYLLABLES = {
    "latin": "ba be bo da de di do fa fe ga go ha he ka ke ko la le li lo ma me mi mo na ne no ra re ri ro sa se si so ta te "
             "ti to va ve vi vo wa we za ze zo",
    "cyrillic": "ба бе бо ва ве во га го да де ди до ка ке ко ла ле ли ло ма ме ми мо на не но па по ра ре ри ро са се со та "
                "те то",
    "greek": "βα βε βο γα γε δα δε δο θα θε κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το",
}
ENDINGS = {("latin", "m"): "n", ("latin", "f"): "a", ("cyrillic", "m"): "н", ("cyrillic", "f"): "а",
           ("greek", "m"): "ος", ("greek", "f"): "η"}

_GENDER = {w: g for g, names in GIVEN.items() for w in names.split()}
_TITLE = {w: g for g, names in TITLES.items() for w in names.split()}
_LETTERS = r"(?:[^\W\d_][\u0300-\u036f]*)+"
#: a word of a name: letters of any script, inner apostrophes (not a genitive's); hyphens join two words
_WORD = re.compile(rf"(?<!\w){_LETTERS}(?:['’](?!s\b){_LETTERS})*(?!\w)")
_JOINT = re.compile(r"\s+|-")
_STOP_JOINT = re.compile(r"\.\s*|\s+|-")  # after an initial or a form of address
#: lower-case words inside a name, which stay as they are when a family name follows
PARTICLES = frozenset("van von der den de del della da di dos du ter zu bin ibn al".split())
_ANCHORS = "|".join(map(re.escape, sorted({unicodedata.normalize(f, w) for w in (*_TITLE, *_GENDER) for f in ("NFC", "NFD")},
                                          key=len, reverse=True)))
_ANCHOR = re.compile(_ANCHORS)
#: where a number can begin, and what it is there, in order
_START = re.compile(r"[\d+(A-Z](?:(?<=\d)\d*|(?<=[+(])\d+|[A-Z]\d{2}|(?<=A)[KS]IA)")
_RUN = re.compile(r"(?<![\w.-])(?:[0-9]{13,19}(?!\w)|[0-9]+(?!\w)(?=[ \xa0\u202f-][0-9]))(?:[ \xa0\u202f-][0-9]+(?!\w))*(?!-[\w-]*[0-9])")
_NUMBER = re.compile("|".join((
    r"(?P<secret>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b)",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b)",
    r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d))",
    r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d))",
    r"(?P<phone>(?<![\w+])(?:\+|00(?=[1-9]))[0-9]+(?!\w)(?:(?:[ \xa0\u202f./-]|[ \xa0\u202f]?\(|\)[ \xa0\u202f-]?)[0-9]+(?!\w))*"
    r"|(?<![\w(])\((?:[0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|0[0-9]{1,5}\)[ -]?[0-9]{2,8}(?:[ -][0-9]{2,4}){0,3})(?![\w-]*[0-9])"
    r"|(?<![\w.-])(?:[0-9]{3}\.[0-9]{3}\.[0-9]{4}|0[0-9](?:\.[0-9][0-9]){4}|0[0-9]{1,5}/ ?[0-9]{4,8})(?![\w.-]*[0-9]))",
    rf"(?P<run>{_RUN.pattern})",
)))
_DIGITS = re.compile("[0-9]+")
_HOST = re.compile(r"@[\w-]+(?:\.[\w-]+)+")
_USER = re.compile(r"[\w.+%-]")
_ASSIGNED = re.compile("[=:]")
_SECRET_NAME = re.compile(r"\b(?i:password|passwd|pwd|token|secret|api_?key|access_?key)\Z")
_SECRET_VALUE = re.compile(r"\s*(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|[^\s\"',;]{6,})")


def _digest(size: int, key: str, *parts: str) -> int:
    """Keyed digest of ``size`` bytes as a number."""
    return int.from_bytes(hashlib.shake_256("\x1f".join((key, *parts)).encode()).digest(size), "big")


def permute(value: int, size: int, key: str, tweak: str) -> int:
    """Keyed one-to-one map of 0..size-1: a Feistel cipher, walked until it falls in range."""
    if size < 2:
        return value
    side = max(1, (size - 1).bit_length() + 1 >> 1)
    mask, width = (1 << side) - 1, (side + 7) // 8
    while True:
        left, right = value >> side, value & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_digest(width, key, tweak, str(r), f"{right:x}") & mask)
        value = left << side | right
        if value < size:
            return value


#: permuted characters of a text that are one number; longer texts are permuted by halves, in time linear in their length
WIDE = 64
#: groups of digits that a number without country code can have
NATIONAL = 13


def _permuted_halves(values: list[int], sizes: list[int], key: str, tweak: str) -> list[int]:
    """Digits of mixed sizes permuted one-to-one: each half in turn is moved by a stream that the other one gives."""
    cut = len(values) // 2
    halves, bounds = [values[:cut], values[cut:]], [sizes[:cut], sizes[cut:]]
    for r in range(ROUNDS + ROUNDS % 2):
        side = r % 2
        source = hashlib.shake_256(repr((key, tweak, r)).encode() + bytes(halves[1 - side])).digest(2 * len(halves[side]))
        halves[side] = [(v + (source[2 * k] << 8 | source[2 * k + 1])) % n
                        for k, (v, n) in enumerate(zip(halves[side], bounds[side], strict=True))]
    return halves[0] + halves[1]


def _classes(text: str) -> list[str]:
    """Alphabet of every character that is permuted; empty for the others."""
    out = []
    for c in text:
        if c in string.digits:
            out.append(string.digits)
        elif c in string.ascii_lowercase:
            out.append(string.ascii_lowercase)
        elif c in string.ascii_uppercase:
            out.append(string.ascii_uppercase)
        else:
            out.append("")
    return out


def permute_text(text: str, key: str, kind: str, hexadecimal: bool = False) -> str:
    """The characters of each alphabet permuted together, all others in place."""
    classes = _classes(text)
    if hexadecimal:
        classes = ["0123456789abcdef" if c in "0123456789abcdef" else "" for c in text]
    shape = "".join(a[:1] or c for a, c in zip(classes, text, strict=True))
    if sum(map(bool, classes)) > WIDE:
        places = [k for k, a in enumerate(classes) if a]
        made = _permuted_halves([classes[k].index(text[k]) for k in places], [len(classes[k]) for k in places], key, f"{kind}|{shape}")
        out = list(text)
        for k, v in zip(places, made, strict=True):
            out[k] = classes[k][v]
        return "".join(out)
    value, size = 0, 1
    for c, alphabet in zip(text, classes, strict=True):
        if alphabet:
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    value = permute(value, size, key, f"{kind}|{shape}")
    out = []
    for c, alphabet in zip(reversed(text), reversed(classes), strict=True):
        if alphabet:
            value, at = divmod(value, len(alphabet))
            c = alphabet[at]
        out.append(c)
    return "".join(reversed(out))


def _walked(text: str, key: str, tweak: str, kind_of: Callable[[str], object], hexadecimal: bool = False) -> str:
    """``text`` permuted among the texts of its own class: a walk along the cycle, one-to-one on each class."""
    made, own = permute_text(text, key, tweak, hexadecimal), kind_of(text)
    while kind_of(made) != own:
        made = permute_text(made, key, tweak, hexadecimal)
    return made


def luhn(digits: str) -> int:
    """Check sum of a digit string; 0 for a valid card number."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def iban_check(country: str, body: str) -> str:
    """The two check digits that make ``country``, digits, ``body`` a valid account number."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _regrouped(template: str, characters: str) -> str:
    """``characters`` in the places of the letters and digits of ``template``."""
    source = iter(characters)
    return "".join(next(source) if c.isalnum() else c for c in template)


def _laid(templates: list[str], characters: str) -> Iterator[str]:
    """``characters`` in the places of the digits of one template after the other."""
    for t in templates:
        n = sum(c in string.digits for c in t)
        yield _regrouped(t, characters[:n])
        characters = characters[n:]


def script_of(word: str) -> str:
    for c in word:
        name = unicodedata.name(c, "")
        for script in ("cyrillic", "greek"):
            if name.startswith(script.upper()):
                return script
    return "latin"


@functools.cache
def _capitals(block: int, script: str) -> list[str]:
    return [c for c in map(chr, range(block, block + 128))
            if c.isupper() and c.lower().upper() == c and unicodedata.name(c, "").startswith(script)]


def _initial(letter: str, key: str) -> str:
    """Another capital of the same script and block, one for each; the few without a lower case of their own stay."""
    block, script = ord(letter) & ~127, unicodedata.name(letter, "").split(" ")[0]
    capitals = _capitals(block, script)
    if letter not in capitals:
        return letter
    return capitals[permute(capitals.index(letter), len(capitals), key, f"initial{block}{script}")]


@functools.cache
def _alphabets(script: str) -> tuple[str, ...]:
    """Ever wider sets of letters that words of a script are numbered by; the last has every character."""
    marks = "'’"
    if script == "latin":
        return string.ascii_lowercase, string.ascii_lowercase + marks + "".join(map(chr, range(0xdf, 0x180)))
    first, last = (0x430, 0x460) if script == "cyrillic" else (0x3ac, 0x3cf)
    letters = "".join(map(chr, range(first, last)))
    return letters, letters + marks + string.ascii_lowercase


def _numbered(word: str, key: str, script: str) -> int:
    """A number for each word: its letters' enciphered, after those of all shorter words, apart for each alphabet."""
    alphabets = _alphabets(script)
    tier = next((k for k, a in enumerate(alphabets) if set(word) <= set(a)), len(alphabets))
    digits = [alphabets[tier].index(c) for c in word] if tier < len(alphabets) else [ord(c) for c in word]
    base = len(alphabets[tier]) if tier < len(alphabets) else 0x110000
    value = 0
    for d in digits:
        value = value * base + d
    shorter = (base ** len(digits) - base) // (base - 1)
    value = shorter + permute(value, base ** len(digits), key, f"name|{script}|{tier}|{len(digits)}")
    return value * (len(alphabets) + 1) + tier


def _spelled(word: str, key: str) -> str:
    """A name of the same script and case, one for each word in lower case."""
    if word in PARTICLES:
        return word
    low = normal_form("name", word)
    if len(low.upper()) == 1:
        return _initial(low.upper(), key)
    script = script_of(low)
    syllables, out = SYLLABLES[script].split(), ""
    value = _numbered(low, key, script)
    while value >= 0:  # numerals without a zero, so that every number has its own
        value, at = divmod(value, len(syllables))
        out, value = out + syllables[at], value - 1
    out += ENDINGS.get((script, _GENDER.get(low.capitalize(), "n")), "")
    return out.upper() if word.isupper() else out.capitalize()


def secret_parts(text: str) -> tuple[str, str, str]:
    """A secret's name, its value without quotes, and what comes after."""
    if _secret_class(text) == "access key":
        return "", text, ""
    head = re.match(r"[^=:]*[=:]\s*", text)[0]
    quote = text[len(head):len(head) + 1]
    n = len(head) + (quote in ("'", '"') and text[-1] == quote)
    return text[:n], text[n:len(text) - (n - len(head))], text[len(text) - (n - len(head)):]


def _secret_class(value: str) -> str:
    if re.fullmatch("(?:AKIA|ASIA)[0-9A-Z]{16}", value):
        return "access key"
    return "hexadecimal" if re.fullmatch("[0-9a-f]+", value) else "other"


def phone_parts(text: str) -> tuple[str, str]:
    """What stays and what is enciphered of a number: its country code, and its digits without a trunk zero in brackets."""
    digits = "".join(c for c in text.replace("(0)", "") if c in string.digits)
    if text[0] != "+":
        if not digits.startswith("00") or digits[2:3] in ("", "0"):
            return "", digits
        digits = digits[2:]
    size = 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGITS else 3
    return "+" + digits[:size], digits[size:]


def surrogate(kind: str, text: str, key: str = KEY) -> str:
    """Replacement of one entity, as long and of the same format (names: of the same script)."""
    plain = "".join(c for c in text if c.isalnum())
    if kind == "email":
        head, dot, top = normal_form(kind, text).rpartition(".")
        return permute_text(head, key, kind) + dot + top
    if kind == "ip":
        parts = [int(p) for p in text.split(".")]
        value = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, kind)
        return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "card":
        body = permute_text(plain[:-1], key, f"{kind}{luhn(plain)}")
        last = next(d for d in string.digits if luhn(body + d) == luhn(plain))
        return _regrouped(text, body + last)
    if kind == "phone":
        code, own = phone_parts(text)
        if code:
            made = ("" if text[0] == "+" else "00") + code[1:] + permute_text(own, key, kind + code)
        else:  # a trunk zero stays one, and no other number gets one or a country code
            zero = own[:own[0] == "0"]
            made = zero + _walked(own[len(zero):], key, kind + zero, lambda t: (
                t[0] == "0" if not zero else t[0] == "0" and t[1:2] not in ("", "0")))
        return "(0)".join(_laid(text.split("(0)"), made))
    if kind == "ssn":
        return _regrouped(text, permute_text(plain, key, kind))
    if kind == "iban":
        if iban_check(plain[:2], plain[4:]) == plain[2:4]:
            body = permute_text(plain[4:], key, f"valid{kind}{plain[:2]}")
            return _regrouped(text, plain[:2] + iban_check(plain[:2], body) + body)
        return _regrouped(text, plain[:2] + _walked(plain[2:], key, kind + plain[:2],
                                                    lambda t: iban_check(plain[:2], t[2:]) == t[:2]))
    if kind == "secret":
        head, body, tail = secret_parts(text)
        fixed = body[:4] if _secret_class(body) == "access key" else ""
        return head + fixed + _walked(body[len(fixed):], key, kind + fixed, lambda t: _secret_class(fixed + t),
                                      _secret_class(body) == "hexadecimal") + tail
    return _WORD.sub(lambda m: _spelled(m[0], key), text)


def _name_end(text: str, at: int, limit: int, most: int, joint: re.Pattern = _JOINT) -> int:
    """End of up to ``most`` name words that follow ``at``; ``at`` itself if there is none.

    A word begins with a capital of any script; single capitals are initials
    and, like particles, count only with a name word after them.
    """
    end, n, before = at, 0, 0
    while before < 4 and (gap := joint.match(text, at, limit)) and (word := _WORD.match(text, gap.end(), limit)):
        joint, first = _JOINT, word[0][0]
        if len(word[0]) == 1 and first.isupper():
            joint, before = _STOP_JOINT, before + 1
        elif word[0] in PARTICLES:
            before += 1
        elif (first.isupper() or first.istitle()) and (n < most or gap[0] == "-"):
            n, before, end = n + (gap[0] != "-"), 0, word.end()
        else:
            break
        at = word.end()
    return end


def _phone_end(text: str, start: int, end: int) -> int:
    """Where the number that begins at ``start`` is whole; ``start`` if it never is.

    A group of digits belongs to it as a whole or not at all.
    """
    last = start
    for m in re.finditer(r"[0-9]+\)?", text[start:end]):
        if m[0].endswith(")") and text[start:start + m.end()].endswith("(0)"):
            continue
        code, own = phone_parts(text[start:start + m.end()])
        lengths = LENGTHS.get(code, ())
        if len(own) + len(code) - 1 > 15 or lengths and len(own) > lengths[-1] and last > start:
            break
        if len(own) >= 5:
            last = start + m.end()
            if len(own) in lengths:
                break
    return last


def _national(groups: list[tuple[int, int]], marks: list[str], sizes: tuple[int, ...], text: str) -> int:
    """How many of the first groups make a number without country code; 0 if none do."""
    lead = text[slice(*groups[0])]
    if sizes[:3] == (3, 3, 4) and lead[0] in "23456789":
        return 3
    if lead[0] != "0" or lead[:2] == "00" or not 2 <= len(lead) <= 6:
        return 0
    digits, n = sizes[0], 1
    while n < len(sizes) and 2 <= sizes[n] <= 8 and (n < 2 or marks[n - 1] == marks[1 if n > 1 else 0]) and digits < 10:
        digits, n = digits + sizes[n], n + 1
    return n if 9 <= digits <= 12 and n > 1 else 0


def _run(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Cards and telephone numbers among the groups of a run of digits.

    A card ends with a complete grouping, else where its check digit is right,
    else with the run.
    """
    groups = [m.span() for m in _DIGITS.finditer(text, start, end)]
    marks = [text[a[1]] for a in groups[:-1]]
    sizes = tuple(b - a for a, b in groups)
    at = 0
    while at < len(groups):
        best = None
        for n in range(1, min(19, len(groups) - at) + 1):
            total = sum(sizes[at:at + n])
            if total > 19:
                break
            if total < 13:
                continue
            digits = "".join(text[slice(*g)] for g in groups[at:at + n])
            rank = (0 if n == 1 or sizes[at:at + n] in GROUPINGS and not luhn(digits) else
                    1 if sizes[at:at + n] in GROUPINGS else 2 if not luhn(digits) else 3)
            if best is None or rank < best[0] or rank == best[0] == 3:
                best = rank, n
        phone = _national(groups[at:at + NATIONAL], marks[at:at + NATIONAL], sizes[at:at + NATIONAL], text)
        if phone and (best is None or best[0] > 1):
            yield "phone", groups[at][0], groups[at + phone - 1][1]
            at += phone
        elif best and (best[0] < 2 or not _later(text, groups, marks, sizes, at)):
            yield "card", groups[at][0], groups[at + best[1] - 1][1]
            at += best[1]
        else:
            at += 1


def _later(text: str, groups: list[tuple[int, int]], marks: list[str], sizes: tuple[int, ...], at: int) -> bool:
    """Whether a complete card or telephone number begins at a later group within the next 19 digits."""
    before = 0
    for k in range(at + 1, len(groups)):
        before += sizes[k - 1]
        if before >= 19:
            return False
        if 13 <= sizes[k] <= 19 or any(sizes[k:k + len(g)] == g for g in GROUPINGS) or _national(
                groups[k:k + NATIONAL], marks[k:k + NATIONAL], sizes[k:k + NATIONAL], text):
            return True
    return False


def _emails(text: str) -> Iterator[tuple[int, int, str]]:
    at, low = text.find("@"), 0
    while at >= 0:
        end = at + 1
        if host := _HOST.match(text, at):
            start = at
            while start > low and _USER.match(text, start - 1):
                start -= 1
            if start < at:
                end = low = host.end()
                yield start, end, "email"
        at = text.find("@", end)


def _secrets(text: str) -> Iterator[tuple[int, int, str]]:
    low = 0
    for mark in _ASSIGNED.finditer(text):
        if mark.start() < low:
            continue
        at = mark.start()
        while at > low and text[at - 1].isspace():
            at -= 1
        name = _SECRET_NAME.search(text, max(low, at - 10), at)
        if name and (value := _SECRET_VALUE.match(text, mark.end())):
            low = value.end()
            yield name.start(), low, "secret"


def _plain(text: str) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, end)`` of every entity but names."""
    at = 0
    for start, end, kind in sorted([*_emails(text), *_secrets(text), (len(text), len(text), "")]):
        if start < at:
            continue
        yield from _numbers(text, at, start)
        if kind:
            yield kind, start, end
        at = end


def _numbers(text: str, at: int, limit: int) -> Iterator[tuple[str, int, int]]:
    """Entities that are told by their digits, between two others."""
    while found := _START.search(text, at, limit):
        start = found.start()
        m = _NUMBER.match(text, start, limit)
        if not m:
            at = found.end() if text[start].isdigit() else start + 1
            continue
        kind, at = m.lastgroup, m.end()
        if kind == "run":
            yield from _run(text, start, at)
            continue
        if kind == "phone" and phone_parts(m[0])[0]:
            end = _phone_end(text, start, at)
            if text[start] == "0" and not _dialled(text[start:end], m[0]):
                if m := _RUN.match(text, start, limit):
                    at = m.end()
                    yield from _run(text, start, at)
                    continue
                end = start
            at = end
            if at == start:
                at = found.end()
                continue
        yield kind, start, at


def _dialled(number: str, whole: str) -> bool:
    """Whether digits after 00 are a whole number of their country's plan, and no card."""
    code, own = phone_parts(number) if number else ("", "")
    groups = _DIGITS.findall(whole)
    sizes = tuple(map(len, groups))
    return len(own) in LENGTHS.get(code, ()) and not any(
        sizes[:len(g)] == g and not luhn("".join(groups[:len(g)])) for g in GROUPINGS)


def _names(text: str, start: int, limit: int) -> Iterator[tuple[int, int]]:
    """Spans of the names between two other entities."""
    at = start
    while found := _ANCHOR.search(text, at, limit):
        at = found.end()
        word = _WORD.match(text, found.start(), limit)
        if unicodedata.normalize("NFC", found[0]) in _TITLE:
            if at < limit and text[at].isalnum() or found.start() and text[found.start() - 1].isalnum():
                continue
            end = _name_end(text, at, limit, 3, _STOP_JOINT)
            if end > at:
                yield _STOP_JOINT.match(text, at, limit).end(), end
                at = end
        elif word and word[0] == found[0]:
            end = _name_end(text, at, limit, 2)
            if end > at:
                yield found.start(), end
                at = end


def mentions(text: str | None) -> Iterator[tuple[str, int, int, bool]]:
    """``(kind, start, end, repeated)`` of every mention in a whole text, in order.

    ``repeated`` marks a word of a name that was detected elsewhere in the text.
    """
    if not text:
        return
    out, at = [], 0
    for kind, start, end in [*_plain(text), ("", len(text), len(text))]:
        out += [("name", a, b, False) for a, b in _names(text, at, start)]
        out += [(kind, start, end, False)] if kind else []
        at = end
    known = {normal_form("name", w[0]) for kind, a, b, _ in out if kind == "name" for w in _WORD.finditer(text, a, b)
             if len(normal_form("name", w[0])) > 1 and w[0] not in PARTICLES}
    if not known:
        yield from out
        return
    at = 0
    for item in [*out, ("", len(text), len(text), False)]:
        for w in _WORD.finditer(text, at, item[1]):
            if w[0][0] != w[0][0].lower() and normal_form("name", w[0]) in known:
                yield "name", *w.span(), True
        if item[0]:
            yield item
        at = item[2]


def entities(text: str | None) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, end)`` of every entity of a whole text, in order, without a name's repeated words."""
    return ((kind, start, end) for kind, start, end, repeated in mentions(text) if not repeated)


def normal_form(kind: str, text: str) -> str:
    """What two mentions of one entity share."""
    if kind == "email":
        return text.lower()
    if kind == "phone":
        return "".join(phone_parts(text))
    if kind in ("card", "ssn", "iban"):
        return "".join(c for c in text if c.isalnum())
    if kind == "ip":
        return ".".join(str(int(p)) for p in text.split("."))
    if kind == "secret":
        return secret_parts(text)[1]
    return unicodedata.normalize("NFC", text).lower() if kind == "name" else text


def rewritten(text: str | None, key: str = KEY) -> tuple[str | None, list[tuple[dict, bool]]]:
    """The whole text with surrogates, and every mention's spans in it and in the original, with ``repeated``."""
    out, found, at, shift = [], [], 0, 0
    for kind, start, end, repeated in mentions(text):
        new = surrogate(kind, text[start:end], key)
        out += [text[at:start], new]
        found.append(({"kind": kind, "start": start, "length": end - start,
                       "new_start": start + shift, "new_length": len(new)}, repeated))
        shift += len(new) - (end - start)
        at = end
    if not found:
        return text, []
    return "".join([*out, text[at:]]), found


def replace(text: str | None, key: str = KEY) -> tuple[str | None, list[dict]]:
    """The whole text with surrogates, and the detected entities' spans; a name's repeated words are replaced too."""
    new, found = rewritten(text, key)
    return new, [f for f, repeated in found if not repeated]


_MENTION = pa.schema([("kind", pa.string()), ("entity", pa.string()), ("made", pa.string())])


def _mentions(key: str):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (text,) in rows_of(batches):
                for kind, start, end in entities(text):
                    if kind == "name":  # words are replaced one by one, so that short mentions agree
                        for w in _WORD.finditer(text, start, end):
                            if w[0] not in PARTICLES:
                                yield kind, normal_form(kind, w[0]), normal_form(kind, _spelled(w[0], key))
                    else:
                        new = surrogate(kind, text[start:end], key)
                        yield kind, normal_form(kind, text[start:end]), normal_form(kind, new)
        return batches_of(rows(), _MENTION)
    return pairs


def surrogate_clashes(docs: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """``kind, made`` of surrogates that different entities share, and of those of one entity with several."""
    pairs = store(docs.select(F.col(text_col)).mapInArrow(_mentions(key), "kind string, entity string, made string")
                  .distinct(), "surrogates")
    n = F.count(F.lit(1)).alias("n")
    shared = pairs.groupBy("kind", "made").agg(n).where("n > 1").select("kind", "made")
    several = pairs.groupBy("kind", "entity").agg(n, F.min("made").alias("made")).where("n > 1").select("kind", "made")
    return shared.union(several).distinct()


_OUT_TYPE = ("doc_id long, text string, n_entities long, "
             "entities array<struct<kind:string,start:long,length:long,new_start:long,new_length:long>>")
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                   ("new_start", pa.int64()), ("new_length", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_entities", pa.int64()),
                  ("entities", pa.list_(_SPAN))])


def anonymise(docs: DataFrame, key: str = KEY, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text, n_entities, entities`` for every row of ``docs``.

    Texts without entities, null and empty ones included, stay as they are.
    Equal rows get equal results; null ids stay null.  The surrogates are
    one-to-one by construction at every number of entities; that none is shared
    and none has several is verified over all documents.  An empty table gives
    an empty result; other columns are left out.
    """
    if store(surrogate_clashes(docs, key, text_col), "clashes").limit(1).count():
        raise AssertionError("the surrogates' ciphers are not one-to-one")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc, text in rows_of(batches):
                new, found = rewritten(text, key)
                yield doc, new, len(found), [f for f, _ in found]
        return batches_of(rows(), _OUT, 512)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        rewrite, _OUT_TYPE)
