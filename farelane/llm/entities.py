"""Finding personal entities in a text, and one entity's surrogate: small helpers for ``surrogates``."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from typing import NamedTuple


class Mention(NamedTuple):
    start: int
    end: int
    kind: str
    #: What mentions of one entity have in common, whatever their format.
    value: str


_DIGITS = re.compile(r"[+(0-9][0-9 ()./-]*[0-9]", re.ASCII)
_NUMBERS = re.compile(
    r"""(?<!\w)(?<![0-9]\.)(?:
      (?P<ip>(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.[0-9]))
    | (?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?!-[0-9])
    | (?P<phone>\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9](?:[ ./-]?[0-9]){5,12}
        | \([0-9]{2,5}\)[ .-]?[0-9](?:[ ./-]?[0-9]){5,9}
        | [0-9]{3}[.-][0-9]{3}[.-][0-9]{4}
        | 0[0-9]{1,4}[/ -][0-9]{3,8}(?:[ -]?[0-9]{2,4})+)
    | (?P<card>[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,7} | [0-9]{13,19})
    )(?!\w)""",
    re.VERBOSE,
)
_LOCAL = re.compile(r"[\w.%+'-]*\w$")
_DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,24}(?![A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_IP6_RUN = re.compile(r"[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*")
#: Titles that announce a name, by gender.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "M", "Sr", "Señor", "Г-н", "Κος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Madame", "Sra", "Srta", "Señora", "Г-жа", "Κα"),
    "n": ("Dr", "Prof"),
}
#: Titles that are also written small inside a sentence.
SMALL_TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Monsieur", "Madame", "Sr", "Sra", "Srta", "Señor", "Señora", "Herr", "Frau", "Г-н", "Г-жа", "Κος", "Κα")
#: Small words inside family names.
PARTICLES = "van von der den de del della di da dos du la le ten ter zu zur af av bin ibn al el y".split()
_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
_GENDER |= {title.lower(): _GENDER[title] for title in SMALL_TITLES}
_UPPER = "A-ZÀ-ÖØ-ÞŠŽŁŚŻΑ-ΩЀ-Я"
# Without the s of a possessive; a letter and an apostrophe may stand in front.
_NAME = rf"(?:[{_UPPER}]['’](?=[{_UPPER}]))?[{_UPPER}][^\W\d_]+(?:['’-](?!s(?!\w))[{_UPPER}]?[^\W\d_]+)*"
_PARTICLE = rf"(?:{'|'.join(sorted(PARTICLES, key=len, reverse=True))})(?!\w)"
# Cheap to search for: a letter that begins a title and no word before it, and a capital or a particle after the word, which may begin a title itself.
_MAYBE_TITLED = re.compile(
    rf"(?<![^\W_])[{''.join(sorted({t[0] for t in _GENDER}))}](?=[^\W\d_-]{{0,7}}(?:-[нж]а?)?\.?[ \u00a0](?:[{_UPPER}]|{_PARTICLE}|(?:{'|'.join(sorted(map(str.lower, SMALL_TITLES)))})\.?[ \u00a0]))"
)
_POINTED = ("M", "Sr", "sr")
_LONG = "|".join(sorted((t for t in _GENDER if t not in _POINTED), key=len, reverse=True))
# Titles that are letters or words otherwise need their point.
_TITLE = rf"(?:(?:{_LONG})\.?|(?:{'|'.join(_POINTED)})\.)"
_WORD = rf"(?!(?:{_LONG}|Sr|Jr)(?!\w)){_NAME}"
_INITIALS = rf"[{_UPPER}](?:\.[{_UPPER}])*\.?(?!\w|['’][{_UPPER}])"
_TITLED = re.compile(rf"({_TITLE}(?:[ \u00a0]{_TITLE})*)[ \u00a0]((?:(?:{_WORD}|{_INITIALS}|{_PARTICLE})[ \u00a0])*{_WORD})")


def _script(word: str) -> str:
    code = ord(word[0])
    return "cyrillic" if 0x400 <= code < 0x530 else "greek" if 0x370 <= code < 0x400 else "latin"


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _family(word: str, gender: str) -> str:
    low = word.casefold()
    return low[:-1] if _script(word) == "cyrillic" and gender == "f" and low.endswith("а") else low


def _names(text: str) -> list[Mention]:
    found, known, begins, done = [], {}, {}, 0
    for m in filter(None, (_TITLED.match(text, at.start()) for at in _MAYBE_TITLED.finditer(text))):
        if m.start() < done or m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_"):
            continue
        done = m.end()
        genders = [_GENDER[t.rstrip(".")] for t in re.split("[ \u00a0]", m[1])]
        gender = next((g for g in genders if g != "n"), "n")
        words = [w for w in re.finditer("[^ \u00a0]+", m[2]) if w[0] not in PARTICLES]
        parts = []
        for k, w in enumerate(words):
            last = k == len(words) - 1
            initials = re.fullmatch(_INITIALS, w[0]) is not None
            value = _family(w[0], gender) if last else w[0].casefold().replace(".", "") if initials else w[0].casefold()
            part = "family" if last else "initial" if initials else "given"
            parts.append(Mention(m.start(2) + w.start(), m.start(2) + w.end(), f"{part}-{_script(w[0])}-{gender}", value))
        found += parts
        if m[2] not in known:
            known[m[2]], begins[m[2]] = parts, m.start(2)
    # A known word that stands alone is a family name rather than a given name.
    for part in sorted(found, key=lambda p: not p.kind.startswith("family")):
        if not part.kind.startswith("initial"):
            known.setdefault(text[part.start : part.end], [part])
    if not known:
        return found
    forms = {form: parts for name, parts in known.items() for form in (name.upper(), name.title()) if len(form) == len(name)} | known
    again = "|".join(map(re.escape, sorted(forms, key=len, reverse=True)))
    starts = {form: begin for name, begin in begins.items() for form in (name, name.upper(), name.title())}
    taken = {p.start for p in found}
    for m in re.finditer(rf"(?<!\w)(?<![^\W\d_]['’-])(?:{again})(?!\w|['’-][{_UPPER}])", text):
        parts = forms[m[0]]
        if m.start() not in taken and m.start() + parts[0].start - starts.get(m[0], parts[0].start) not in taken:
            # A whole name begins where its title ended, be it with a particle.
            base = starts.get(m[0], parts[0].start)
            found += [p._replace(start=p.start + m.start() - base, end=p.end + m.start() - base) for p in parts]
    return found


def _ip6(text: str) -> list[Mention]:
    """IPv6 addresses in full or compressed form; one that maps an IPv4 address is that address."""
    found = []
    if text.count(":") < 2:
        return found
    for m in _IP6_RUN.finditer(text):
        run, start = m[0].rstrip("."), m.start()
        if run.endswith(":") and not run.endswith("::"):
            run = run[:-1]
        before = text[start - 1 : start]
        label = before.isalnum() or before == "_"
        if label or run.startswith(":") and not run.startswith("::"):
            # What stands before the first colon is a word, as in ip:2001:db8::1.
            cut = run.find(":") + 1
            run, start = run[cut:], start + cut
            if not cut or label and run.startswith(":"):
                continue
        after = text[start + len(run) : start + len(run) + 1]
        if run == "::" or len(run) > 45 or after.isalnum() or after == "_":
            continue
        try:
            address = ipaddress.IPv6Address(run)
        except ValueError:
            continue
        if address.ipv4_mapped:
            found.append(Mention(start, start + len(run), "ip", str(address.ipv4_mapped)))
        else:
            value = ":".join(f"{int(p, 16):x}" for p in address.exploded.split(":"))
            found.append(Mention(start, start + len(run), "ip6", value))
    return found


def mentions(text: str | None) -> list[Mention]:
    """Mentions in the order of the text, none inside another."""
    if not text:
        return []
    found: list[Mention] = []
    at = text.find("@")
    while at >= 0:
        local, domain = _LOCAL.search(text, max(0, at - 64), at), _DOMAIN.match(text, at + 1)
        if local and domain:
            found.append(Mention(local.start(), domain.end(), "email", text[local.start() : domain.end()].lower()))
        at = text.find("@", at + 1)
    for chunk in _DIGITS.finditer(text):
        if chunk.end() - chunk.start() < 7:
            continue
        for m in _NUMBERS.finditer(text, chunk.start(), chunk.end()):
            after = text[m.end() : m.end() + 1]
            digits = re.sub("[^0-9]", "", m[0])
            if after.isalnum() or after == "_":
                continue
            kind = next(k for k in ("ip", "ssn", "phone", "card") if m[k])
            if kind != "phone" or 7 <= len(digits) <= 15:
                value = ".".join(str(int(p)) for p in m[0].split(".")) if kind == "ip" else "+" * m[0].startswith("+") + digits
                found.append(Mention(m.start(), m.end(), kind, value))
    for m in _IBAN.finditer(text):
        plain = m[0].replace(" ", "")
        if not text[m.start() - 1 : m.start()].isalnum() and 15 <= len(plain) <= 34 and _iban_rest(plain) == 1:
            found.append(Mention(m.start(), m.end(), "iban", plain))
    found += _ip6(text)
    found += _names(text)
    kept: list[Mention] = []
    for m in sorted(set(found), key=lambda m: (m.start, -m.end)):
        if not kept or m.start >= kept[-1].end:
            kept.append(m)
    return kept


class _Stream:
    """Numbers that the key, the entity and the attempt fix."""

    def __init__(self, key: bytes, *about: object):
        self.key, self.about, self.count, self.pool = key, "\0".join(map(str, about)).encode(), 0, 0
        self.left = 1

    def below(self, n: int) -> int:
        if self.left < n << 64:
            digest = hmac.new(self.key, self.about + b"\0%d" % self.count, hashlib.sha256).digest()
            self.pool, self.left, self.count = int.from_bytes(digest), 1 << 256, self.count + 1
        self.pool, value = divmod(self.pool, n)
        self.left //= n
        return value

    def pick(self, items: str | tuple) -> str:
        return items[self.below(len(items))]


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = {"latin": _LETTERS, "cyrillic": "абвгдезиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
_SYLLABLES = {
    "latin": ("bdfgklmnprstv", "aeiou", ("n", "r", "s", "l"), ("a", "ia", "ina")),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("н", "р", "л", "м"), ("а", "ина", "ия")),
    "greek": ("βγδκλμνπρστφ", "αεηιο", ("ος", "ης", "ων"), ("α", "η", "ια")),
}


def _shaped(s: _Stream, text: str) -> str:
    return "".join(s.pick("0123456789") if c.isdigit() else s.pick(_LETTERS) if c.isalpha() else c for c in text)


def _number(s: _Stream, n: int) -> str:
    return s.pick("123456789") + "".join(s.pick("0123456789") for _ in range(n - 1))


# Country codes of two digits. +1 and +7 have one, all others three.
COUNTRY_CODES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _kept(kind: str, value: str) -> str:
    """What a replacement shares with the entity: the country code, with its plus sign, or the network of a private address."""
    if kind == "ip":
        parts = value.split(".")
        private = parts[:2] == ["192", "168"] or parts[0] == "172" and 16 <= int(parts[1]) < 32
        return ".".join(parts[: 1 if parts[0] in ("10", "127") else 2 if private else 0])
    if kind == "phone" and value.startswith("+"):
        return value[: 2 if value[1] in "17" else 3 if value[1:3] in COUNTRY_CODES else 4]
    return value[: max(0, len(value) - 10)] if kind == "phone" else ""


#: First octets of public addresses.
_PUBLIC = [p for p in range(1, 224) if p not in (10, 127, 172, 192)]
#: Attempts from here on are ranks in the list of all replacements of a form.
RANKED = 1 << 20


def form(kind: str, value: str) -> str | None:
    """Entities of one form draw on the same list of replacements; None where later attempts widen the form without end."""
    if kind not in ("ip", "phone", "ssn"):
        return None
    return f"{_kept(kind, value)}/{0 if kind == 'ip' else len(value)}"


def ranked(key: bytes, kind: str, value: str, rank: int) -> str:
    """The replacement with this rank in the list of an entity's form, in an order the key fixes.

    Lists go on beyond the form: addresses of a private network are followed by those of 10.0.0.0/8 and by public ones, and
    numbers by numbers of one digit more.
    """
    kept = _kept(kind, value)
    if kind == "ip":
        fixed = [int(p) for p in kept.split(".") if p]
        lists = [(fixed, 256 ** (4 - len(fixed)))] if fixed else []
        lists += [([10], 1 << 24)] if fixed and fixed != [10] else []
        lists += [([first], 1 << 24) for first in _PUBLIC]
        for octets, size in lists:
            if rank < size:
                at = (rank * 40503 + _Stream(key, "ranked", *octets).below(size)) % size
                return ".".join(map(str, octets + [at >> 8 * k & 255 for k in range(3 - len(octets), -1, -1)]))
            rank -= size
        raise ValueError("more addresses than IPv4 has")
    n = len(value) - len(kept)
    while rank >= 9 * 10 ** (n - 1):
        rank, n = rank - 9 * 10 ** (n - 1), n + 1
    size = 9 * 10 ** (n - 1)
    return kept + str(size // 9 + (rank * 7919 + _Stream(key, "ranked", kind, kept, n).below(size)) % size)


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of an entity in the form of ``value``; other attempts give other replacements.

    Where the form alone leaves too few replacements, later attempts add letters or syllables, or are ranks in a list.
    """
    if attempt >= RANKED:
        return ranked(key, kind, value, attempt - RANKED)
    entity = kind.rsplit("-", 1)[0] if kind.startswith("family") else kind
    s = _Stream(key, entity, value, attempt)
    more = max(0, attempt - 3)
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        labels = domain.split(".")
        d = _Stream(key, "domain", domain)
        host = ".".join([_shaped(d, label) for label in labels[:-1]] + labels[-1:])
        return _shaped(s, local) + "".join(s.pick(_LETTERS) for _ in range(more)) + "@" + host
    if kind == "ip":
        parts, kept = value.split("."), _kept(kind, value)
        keep = kept.count(".") + 1 if kept else 0
        fresh = [str(_PUBLIC[s.below(len(_PUBLIC))])] + [str(s.below(256)) for _ in parts[1:]]
        return ".".join(parts[:keep] + fresh[keep:])
    if kind == "ip6":
        first = value.split(":")[0]
        local = first if int(first, 16) >= 0xFC00 else f"{0x2000 + s.below(0x2000):x}"
        return ":".join([local] + [f"{s.below(1 << 16):x}" for _ in range(7)])
    if kind == "card":
        body = _number(s, len(value) - 1)
        check = next(str(c) for c in range(10) if luhn(body + str(c)))
        return body + (check if luhn(value) else str((int(check) + 1 + s.below(9)) % 10))
    if kind == "iban":
        body = "".join(s.pick("0123456789") if c.isdigit() else s.pick(_LETTERS).upper() for c in value[4:])
        return value[:2] + f"{98 - _iban_rest(value[:2] + '00' + body):02d}" + body
    if kind in ("phone", "ssn"):
        keep = _kept(kind, value)
        return keep + _number(s, len(value) - len(keep))
    part, script, gender = kind.split("-")
    if part == "initial":
        return "".join(s.pick(_ALPHABETS[script].replace(c, "")) for c in value)
    heads, vowels, male, female = _SYLLABLES[script]
    stem = "".join(s.pick(heads) + s.pick(vowels) for _ in range(2 + s.below(2) + more)) + s.pick(heads)
    if part == "family":
        return stem + {"latin": s.pick(("er", "man", "ton", "ley")), "cyrillic": "ов", "greek": "ης"}[script]
    if gender == "n":
        return stem + s.pick(vowels)
    return stem + s.pick(female) if gender == "f" else stem[:-1] + s.pick(male)


def rendered(m: Mention, surface: str, new: str) -> str:
    """``new`` in the format of the mention: its separators and its letter case."""
    if m.kind in ("phone", "ssn", "card", "iban"):
        fresh = iter(new.lstrip("+"))
        # A number of a wider form ends in the digits that the format has no place for.
        return "".join(next(fresh) if c.isalnum() else c for c in surface) + "".join(fresh)
    if m.kind.startswith("initial"):
        fresh = iter(new.upper())
        return "".join(next(fresh) if c.isalpha() else c for c in surface)
    if m.kind == "email":
        return new.upper() if surface.isupper() else new
    if m.kind == "ip":
        return f"::ffff:{new}" if ":" in surface else new
    if m.kind == "ip6":
        return new.upper() if surface.upper() == surface else new
    if m.kind.startswith("family-cyrillic-f"):
        new += "а"
    return new.upper() if surface.isupper() and len(surface) > 1 else new.title()
