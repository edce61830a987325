"""Personal data by candidate generation and gradient boosting.

Base patterns find what is certain. High-recall generators propose further, overlapping spans: written-out
addresses, numbers in other notations, and numbers inside runs that the base patterns read as one and drop.
Boosted trees score each by its format and context; a threshold for each kind selects; of overlapping candidates the
likelier stays, and base spans always stay.

The trees learn from made examples (EXAMPLES of them, drawn with a fixed seed, so every run and every cluster
has the same model): personal data and look-alikes (dates, versions, prices, order numbers, prose) in context. Their
probabilities are calibrated, and the thresholds set for a precision of PRECISION, on examples that training didn't
see: other made ones, and written sentences in several languages (SENTENCES), each of which counts WEIGHT times.

Bounds of the added spans: a label of a written-out domain has at most 63 characters, phones have 9 to 17 digits, cards
13 to 19, account numbers up to 34 characters.

Spans are code point offsets, end exclusive. Defined cases: a null text counts as empty; repeated rows give
equal results; an empty table gives an empty result; texts of any length are searched whole, in time
proportional to their length; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from nomograph.llm.boosting import BoostedTrees
from nomograph.llm.common import no_table, pick, small_batches, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "iban")
EXAMPLES = 6000
PRECISION = 0.95

Span = tuple[int, int]
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        n = n * 2 if i % 2 else n
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return _NO_DIGITS.sub("", s)


def base_emails(text: str) -> list[Span]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @ outwards so that long words cost no more than their length."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    found: dict[str, list[Span]] = {"email": base_emails(text) if "@" in text else []}
    found["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    found["card"] = [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return found


# Candidate generators. Each is linear in the text: repetitions are possessive or bounded.
_AT = re.compile(r"[\x20]?(?:\(at\)|\[at\]|\{at\}|\x20at\x20|@)[\x20]?([A-Za-z0-9-]{1,63}(?:(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\.)\x20?|\x20dot\x20)[A-Za-z0-9-]{2,63})++)", re.I)
_LOOSE_PHONE = re.compile(r"(?<![0-9.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_RUN = re.compile(r"[0-9]+")


def others(text: str) -> list[tuple[str, int, int]]:
    """Candidates of all kinds but cards."""
    found = []
    for m in _AT.finditer(text):
        start = m.start()
        while start and not _NOT_LOCAL.match(text, start - 1):  # ends at the sign before, so that all walks together are linear
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
    found += [("phone", *m.span()) for m in _LOOSE_PHONE.finditer(text)]
    found += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
    return found


def runs(text: str) -> Iterator[re.Match[str]]:
    """Runs of digits and separators that may hold a card."""
    return (m for m in _CARD.finditer(text) if m.end() - m.start() >= 13)


def candidates(text: str) -> list[tuple[str, int, int]]:
    """All candidates, windows that fail Luhn's test among them: the trees learn from these too."""
    found = others(text)
    for m in runs(text):
        windows = Windows(m, sound=False)
        found += [("card", a, b) for k in windows.blocks() for a, b in zip(*(x.tolist() for x in windows.spans(*k)), strict=True)]
    return found


def _running(x: np.ndarray) -> np.ndarray:
    """Sums of what comes before each place, and of all."""
    out = np.zeros(len(x) + 1, np.int32)
    np.cumsum(x, out=out[1:])
    return out


class Windows:
    """The windows of whole groups of 13 to 19 digits in a run; sound: only those that pass Luhn's test, which running sums tell at once."""

    def __init__(self, m: re.Match[str], sound: bool = True):
        self.text, self.start, self.sound = m.string, m.start(), sound
        self.raw = raw = np.frombuffer(m[0].encode("ascii"), np.uint8)
        self.at = np.flatnonzero(raw >= 48).astype(np.int32)  # all separators come before the digits
        self.digit = digit = raw[self.at] - 48
        first = np.concatenate([[True], np.diff(self.at) > 1])
        self.firsts, self.last = np.flatnonzero(first).astype(np.int32), np.append(first[1:], True)
        self.group = np.cumsum(first, dtype=np.int32) - 1
        self.size = np.diff(np.append(self.firsts, len(digit))).astype(np.int32)
        doubled = (2 * digit - 9 * (digit > 4)).astype(np.int32)
        even = np.zeros(len(digit), bool)
        even[::2] = True
        self.sums = [_running(np.where(even == side, digit, doubled)) for side in (True, False)]
        self.dashes = _running(raw == 45)

    def blocks(self, starts: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First and last digits (exclusive) of windows, by start and end, some thousand groups at a time."""
        for at in range(0, len(self.firsts), starts):
            a = np.repeat(self.firsts[at : at + starts], 7)
            b = a + np.tile(np.arange(13, 20, dtype=np.int32), len(a) // 7)
            fits = b <= len(self.digit)
            a, b = a[fits], b[fits]
            whole = self.last[b - 1]
            a, b = a[whole], b[whole]
            if self.sound:
                good = self.luhn(a, b)
                a, b = a[good], b[good]
            if len(a):
                yield a, b

    def luhn(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of running sums in which even digits count once, or odd ones: that in which the window's last digit does."""
        plain, other = self.sums
        return np.where(b % 2 == 1, plain[b] - plain[a], other[b] - other[a]) % 10 == 0

    def spans(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.start + self.at[a], self.start + self.at[b - 1] + 1

    def features(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """features() of each window."""
        out = np.zeros((len(a), 25))
        low, high, g, h = self.at[a], self.at[b - 1] + 1, self.group[a], self.group[b - 1]
        most = self.size[g].copy()
        for k in range(1, 19):
            some = g + k <= h
            if not some.any():
                break
            most[some] = np.maximum(most[some], self.size[g[some] + k])
        dashes = self.dashes[high] - self.dashes[low]
        out[:, :8] = np.stack([np.full(len(a), KINDS.index("card")), high - low, b - a, h - g + 1, self.size[g], self.size[h], most, self.luhn(a, b)], axis=1)
        out[:, 10], out[:, 11] = dashes, high - low - (b - a) - dashes
        # what stands before a window is text only near the run's start, else digits and separators; the neighbours likewise
        for k in np.flatnonzero(low < 40):
            before = self.text[max(0, self.start + low[k] - 40) : self.start + low[k]]
            out[k, 17], out[k, 18] = bool(_HINTS["card"].search(before)), bool(_AGAINST.search(before[-16:]))
        out[:, 21], out[:, 22] = (self.raw[low - 1] == 45) & (low > 0), self.raw[np.minimum(high, len(self.raw) - 1)] == 45
        left, right = self.text[self.start - 1 : self.start], self.text[self.start + len(self.raw) : self.start + len(self.raw) + 1]
        out[low == 0, 19], out[low == 0, 21] = left.isalnum(), left in _BEFORE and left != ""
        ends = high == len(self.raw)
        out[ends, 20], out[ends, 22] = right.isalnum(), right in _AFTER and right != ""
        one = self.digit[a]
        year = (one == 1) & (self.digit[a + 1] == 9) | (one == 2) & (self.digit[a + 1] == 0)
        out[:, 23], out[:, 24] = year & (self.size[g] == 4), (one >= 3) & (one <= 6)
        return out


_HINTS = {
    "email": re.compile(r"mail|contact|write|reach|send", re.I),
    "phone": re.compile(r"tel|phone|call|mobile|cell|fax|dial|ring|handy|móvil|contact", re.I),
    "card": re.compile(r"card|visa|master|credit|debit|amex|tarjeta|karte|carte|payment", re.I),
    "ssn": re.compile(r"ssn|social|security|tax", re.I),
    "iban": re.compile(r"iban|account|bank|konto|cuenta|compte", re.I),
}
_AGAINST = re.compile(r"version|release|order|invoice|isbn|part|page|item|serial|ref|no\.|#|\$|€|£|total|date|id\b", re.I)
#: Neighbours that speak against a candidate, before and after it.
_BEFORE, _AFTER = "-/.:,$€£#", "-/:%$€£"


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    s, before = text[start:end], text[max(0, start - 40) : start]
    digits, groups = _digits(s), [len(g) for g in _RUN.findall(s)]
    left, right = text[start - 1 : start], text[end : end + 1]
    iban = 0
    if kind == "iban":
        code = s.replace(" ", "")
        iban = int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1
    return [
        KINDS.index(kind), len(s), len(digits), len(groups), groups[0] if groups else 0, groups[-1] if groups else 0, max(groups, default=0),
        luhn(digits) if digits else 0, s.startswith("+"), "(" in s, s.count("-"), s.count(" "), s.count("."), "@" in s,
        bool(re.search(r"[\[({]at[\])}]", s, re.I)), bool(re.search(r"dot", s, re.I)), iban,
        bool(_HINTS[kind].search(before)), bool(_AGAINST.search(before[-16:])), left.isalnum(), right.isalnum(), left in _BEFORE and left != "", right in _AFTER and right != "",
        digits[:2] in ("19", "20") and len(groups[:1]) and groups[0] == 4, digits[:1] in "3456" and digits != "",
    ]


def _example(r: random.Random) -> tuple[str, str, bool]:
    """A made text, the kind it is about, and whether that candidate is personal data."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 9)))
    kind, good = r.choice(list(_HINTS)), r.random() < 0.5
    lead, hint = " ".join(word() for _ in range(r.randint(0, 4))), ""
    if kind == "email":
        name, host, top = word(), word(), r.choice(["com", "org", "net", "de", "fr", "es"])
        at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" (at) ", "."), (" at ", " dot "), ("@", "(dot)"), (" @ ", ".")])
        body = f"{name}{at}{host}{dot}{top}" if good else f"{name} at {host}.{r.choice([' ', ''])}{word().title()}"
        hint = r.choice(["", "mail", "contact", "write to"]) if good else r.choice(["", "look", "contact"])
    elif kind == "phone":
        if good:
            body = r.choice([f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"+{d(2)} {d(3)} {d(3)} {d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}"])
            hint = r.choice(["", "", "call", "tel", "phone", "mobile"]) if body[0] in "+(" else r.choice(["call", "tel", "phone", "mobile"])
        else:
            body = r.choice([f"20{d(2)} {d(3)} {d(3)}", f"{d(3)}.{d(3)}.{d(3)}", f"{d(3)} {d(3)} {d(3)}", f"{d(2)}.{d(3)}.{d(4)}", f"{d(4)}-{d(4)}{d(1)}", f"{d(3)} {d(3)} {d(4)}"])
            hint = r.choice(["", "order", "invoice", "total", "version", "item no."])
    elif kind == "card":
        digits = r.choice("3456") + d(14) if good else d(r.choice([13, 15, 16, 16, 17]))
        if good:
            digits += next(c for c in "0123456789" if luhn(digits + c))
        elif luhn(digits):
            digits = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        sep = r.choice(["", "", " ", "-"])
        size = r.choice([4, 4, 4, 4, 2, 3, 6])
        body = sep.join(digits[i : i + size] for i in range(0, len(digits), size))
        if r.random() < 0.4:
            body = f"{body} {d(16)}" if r.random() < 0.5 else f"{d(16)} {body}"
        hint = r.choice(["", "", "card", "visa"]) if good else r.choice(["", "order", "serial", "card"])
    elif kind == "ssn":
        body, hint = f"{d(3)}-{d(2)}-{d(4)}", r.choice(["SSN", "social security", "tax id"]) if good else r.choice(["", "part", "order", "invoice"])
    else:
        code = r.choice(["DE", "FR", "ES", "GB"]) + "00" + d(r.choice([16, 18, 20]))
        rest = 98 - int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97
        code = code[:2] + f"{rest if good else (rest + r.randint(1, 90)) % 97:02d}" + code[4:]
        body, hint = " ".join(code[i : i + 4] for i in range(0, len(code), 4)) if r.random() < 0.5 else code, r.choice(["", "IBAN", "account"])
    return f"{lead} {hint}{r.choice([' ', ': ']) if hint else ' '}{body}{r.choice([' ', '.', ', '])}{word()}", kind, good


#: Written sentences to calibrate on: kind -> sentences with personal data between angle brackets, and sentences whose bracketed span looks like it.
SENTENCES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "email": (
        ("Write to <maria.lopez (at) correo (dot) es> before Friday", "Reach me: <jdoe[at]posteo[dot]de>, thanks", "Kontakt: <anna.klein at firma dot de>", "Mail <paul @ atelier.fr> pour un devis", "my address is <s_brown (at) mail.example.org>", "Schreiben Sie an <info{at}verein{dot}org>.", "escríbeme a <luis at buzon dot com> hoy", "send it to <k.meyer@uni(dot)edu> please"),
        ("We met <him at noon. Then> we left", "She looked <up at once. Nobody> spoke", "prices start <low at first. Later> they rise", "They arrived <late at night. Rain> fell", "He laughed <out at sea. Gulls> cried", "Sit <down at home. Read> this", "I was <good at chess. Now> I rest", "look <carefully at this.Next> comes more"),
    ),
    "phone": (
        ("Call me at <(415) 555-0132> tonight", "Tel: <030 1234 5678>", "Teléfono <612 345 678>, por favor", "mobile <555-867-5309> or fax", "dial <0171 555 0199> now", "Phone <202-555-0175>", "contact: <(0221) 4710 812>", "ring <0161 496 0123> after six"),
        ("population <1985 204 311> in total", "Invoice <204 118 7733> is due", "version <10.20.3040> was released", "order <118-204-3311> shipped", "total <250 000 000> people", "item no. <330 410 2208>", "in <2019 100 200> copies", "Part <12.345.6789> of the list"),
    ),
    "card": (
        ("my visa <4539 1488 0343 6467> 1234567890123456 expires soon", "card 0000111122223333 <4556737586899855> again", "Karte <5425-2334-3010-9903> 9999888877776666", "pay with <4024007103939509> 1111000011110000", "tarjeta 2222000022220000 <3530111333300000>", "master <5105 1051 0510 5100> 4444333322221111"),
        ("serial <4539 1488 0343 6461> 1234 end", "order <4556737586899850> 12", "ref <7425-2334-3010-9904> 99", "tracking <9024007103939502> 11", "code <1111222233334445> 77", "count <9000 0000 0000 0002> 5"),
    ),
    "ssn": (
        ("SSN <219-09-9999> on file", "social security <078-05-1120>", "her tax id <457-55-5462> was shown", "Security number: <212-33-4455>"),
        ("part <100-20-3000> in stock", "order <999-10-2000> left", "invoice <204-11-7733>", "item <300-45-1200> sold out"),
    ),
    "iban": (
        ("IBAN <DE89 3704 0044 0532 0130 00>", "account <GB29NWBK60161331926819> please", "Konto: <FR1420041010050500013M02606>", "cuenta <ES9121000418450200051332>", "bank <NL91ABNA0417164300> details"),
        ("code <DE88 3704 0044 0532 0130 00> failed", "model <GB21NWBK60161331926819> sold", "serial <FR9920041010050500013M02606>", "key <AB12CDEF3456GHIJ7890>", "ref <XX00AAAA1111BBBB2222>"),
    ),
}
WEIGHT = 4


def _sentences() -> Iterator[tuple[str, str, int, int, bool]]:
    for kind, both in SENTENCES.items():
        for good, sentences in zip((True, False), both, strict=True):
            for sentence in sentences:
                a, b = sentence.index("<"), sentence.index(">") - 1
                yield sentence.replace("<", "").replace(">", ""), kind, a, b, good


@functools.lru_cache(1)
def model() -> BoostedTrees:
    """Trained on three quarters of the examples, calibrated on the rest and on the sentences. Candidates that overlap what an example is about share its label only if they are right: for cards, if they pass Luhn's test."""
    r, x, y, held = random.Random(7), [], [], []
    for n in range(EXAMPLES):
        text, kind, good = _example(r)
        base = [s for spans in base_spans(text).values() for s in spans]
        for k, a, b in candidates(text):
            if k == kind and not any(a < e and s < b for s, e in base):
                x.append(features(text, k, a, b))
                y.append(good and (k != "card" or luhn(_digits(text[a:b]))))
                held.append(n % 4 == 0)
    for text, kind, start, end, good in _sentences():
        for k, a, b in candidates(text):
            if k == kind and a < end and start < b:
                x += [features(text, k, a, b)] * WEIGHT
                y += [good and (k != "card" or luhn(_digits(text[a:b])))] * WEIGHT
                held += [True] * WEIGHT
    x, y, held = np.array(x, float), np.array(y, float), np.array(held)
    return BoostedTrees().fit(x[~held], y[~held]).calibrate(x[held], y[held], PRECISION, x[held, 0].astype(int))


#: Candidates that are scored at a time.
AT_ONCE = 8192


class Likely:
    """Candidates of a batch of texts that reach their kind's threshold; candidates come in, and are let go of when scored."""

    def __init__(self, trees: BoostedTrees):
        self.trees, self.waiting, self.rows, self.found = trees, [], 0, []
        self.least = np.array([trees.thresholds.get(k, 2.0) for k in range(len(KINDS))])

    def add(self, text: int, a: np.ndarray, b: np.ndarray, x: np.ndarray) -> None:
        if len(x):
            self.waiting.append((np.full(len(a), text), a, b, x))
            self.rows += len(a)
            if self.rows >= AT_ONCE:
                self.score()

    def score(self) -> None:
        if self.waiting:
            text, a, b, x = (np.concatenate(c) for c in zip(*self.waiting, strict=True))
            kind, p = x[:, 0].astype(np.int64), self.trees.probability(x)
            good = p >= self.least[kind]
            self.found.append((text[good].astype(np.int32), kind[good].astype(np.int8), a[good].astype(np.int32), b[good].astype(np.int32), p[good]))
            self.waiting, self.rows = [], 0

    def best(self) -> Iterator[tuple[int, int, int, int]]:
        """(text, kind, start, end) of all, by text; the likeliest first."""
        self.score()
        if self.found:
            text, kind, a, b, p = (np.concatenate(c) for c in zip(*self.found, strict=True))
            self.found = []
            order = np.lexsort((b, a, kind, -p, text))
            for at in range(0, len(order), AT_ONCE):
                k = order[at : at + AT_ONCE]
                yield from zip(text[k].tolist(), kind[k].tolist(), a[k].tolist(), b[k].tolist(), strict=True)


def find_all(texts: list[str], trees: BoostedTrees) -> list[tuple[dict[str, list[Span]], list[tuple[int, int, int]]]]:
    """For each text its base spans, and all spans (kind's number, start, end) in order. Of cards only windows that pass Luhn's test are proposed."""
    base, likely = [base_spans(t) for t in texts], Likely(trees)
    for i, text in enumerate(texts):
        taken = sorted(s for spans in base[i].values() for s in spans)
        starts = np.array([s for s, _ in taken], np.int64)
        far = np.concatenate([[-1], np.maximum.accumulate(np.array([e for _, e in taken], np.int64))]) if taken else np.array([-1])
        free = lambda a, b, starts=starts, far=far: far[np.searchsorted(starts, b)] <= a  # noqa: E731  overlaps no base span
        found = others(text)
        for at in range(0, len(found), AT_ONCE):
            some = found[at : at + AT_ONCE]
            a, b = np.array([s for _, s, _ in some]), np.array([e for _, _, e in some])
            left = np.flatnonzero(free(a, b))
            likely.add(i, a[left], b[left], np.array([features(text, *some[k]) for k in left], float))
        for m in runs(text):
            windows = Windows(m)
            for k in windows.blocks():
                a, b = windows.spans(*k)
                left = free(a, b)
                likely.add(i, a[left], b[left], windows.features(k[0][left], k[1][left]))
    extra: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    used: list[Span] = []
    now = -1
    for i, k, a, b in likely.best():
        if i != now:
            now, used = i, []
        at = bisect.bisect_left(used, (b, b))
        if at == 0 or used[at - 1][1] <= a:
            used.insert(at, (a, b))
            extra[i].append((k, a, b))
    return [(found, sorted([(KINDS.index(k), a, b) for k, spans in found.items() for a, b in spans] + more)) for found, more in zip(base, extra, strict=True)]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, the digest of the base spans, and all spans, of every row. Narrow: no shuffle."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            counts, digests, joined = [], [], []
            for base, spans in find_all([t or "" for t in batch.column(1).to_pylist()], shared.value):
                counts.append([len(base[k]) for k in BASE])
                digests.append(hashlib.sha256(_joined([(KINDS.index(k), a, b) for k in BASE for a, b in base[k]]).encode()).hexdigest())
                joined.append(_joined(spans))
            by_kind = zip(*counts, strict=True) if counts else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in by_kind], pa.array(digests, pa.string()), pa.array(joined, pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by <KIND>; of overlapping spans the first is named."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
