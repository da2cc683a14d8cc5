"""Personal data by patterns and by a linear-chain conditional random field over word shapes.

The patterns are the base and always stand. The field adds what they miss: other spellings
of addresses and numbers, and numbers that run together. A text is cut into runs of letters,
runs of digits and single signs; what the field sees of each is its shape, a class of about
130: kind, letter case, length, value checks of digit runs, a few words, and whether a blank
stands before it. The score of a label sums weights of the shapes at five places around it,
of the two pairs of neighbours, and of the label before. Weights are fitted to a small table
of labelled texts by the gradient of the likelihood (forward and backward sums over all
texts at once); texts are decoded line by line with Viterbi, all lines of a batch in step.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)     # outside, then begin and inside of each kind
SLICE = 4 << 20                 # bytes of text decoded at once; a longer text goes alone
EXAMPLES = 1200                 # labelled texts made by the rule below
TURNS, RATE, DECAY = 50, 0.25, 1e-3
COLUMNS = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
           "spans string, n_added long")

# --- base patterns ----------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBERS = str.maketrans("", "", "".join(chr(c) for c in range(128) if not 48 <= c <= 57))


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _is_card(digits: str) -> bool:
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` by the patterns, in order.

    Every search is linear: an address is looked for to the left of its sign, a dotted run is
    taken whole and dealt out in fours, which is where the patterns would match.
    """
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        run = text[done:at]
        start = at - len(run) + len(run.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            found.append((start, 0, done))
        at = text.find("@", done)
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".") if "." in run[0] else ()
        begin = run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = begin + sum(map(len, four)) + 3
            if all(map(_is_octet, four)):
                found.append((begin, 1, end))
            begin = end + 1
    for match in _CARD.finditer(text):
        if _is_card(match[0].translate(_NUMBERS)):
            found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(match[0].translate(_NUMBERS)) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- shapes -----------------------------------------------------------------------------------

# Words that stand for a sign or announce a kind.
WORDS = ("at", "dot", "com", "org", "net", "de", "fr", "es", "mail", "email", "phone", "tel", "call", "mobile",
         "fax", "card", "visa", "ip", "host", "server")
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_TYPE = np.zeros(128, np.uint8)
_TYPE[33:127] = _SIGN
_TYPE[48:58] = _DIGIT
_TYPE[65:91] = _TYPE[97:123] = _LETTER
_BLANKS = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
_SIGNS, _DIGITS, _LETTERS = 0, 33, 33 + 17
_NAMES = _LETTERS + 20
SHAPES = 2 * (_NAMES + len(WORDS))  # twice: without and with a blank before; the next one is "none"


def _packed(words: np.ndarray) -> np.ndarray:
    return (words.astype(np.uint64) << (8 * np.arange(words.shape[1], dtype=np.uint64))).sum(1)


_WORD_KEYS = _packed(np.array([list(w.encode().ljust(6, b"\0")) for w in WORDS], np.uint8))
_WORD_ORDER = np.argsort(_WORD_KEYS)


class Tokens:
    """The tokens of some texts: where each starts and ends, its shape and its line."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.row_at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        kind = np.where(codes < 128, _TYPE[np.minimum(codes, 127)], _LETTER)
        high = np.flatnonzero(codes >= 128)
        kind[high[np.isin(codes[high], _BLANKS)]] = 0
        opens = kind != 0
        opens[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _SIGN)
        self.start = np.flatnonzero(opens)
        last = kind != 0
        last[:-1] &= (kind[1:] != kind[:-1]) | (kind[1:] == _SIGN)
        self.end = np.flatnonzero(last) + 1
        self.codes = codes
        line = np.cumsum(codes == 10)[self.start] if len(self.start) else np.zeros(0, np.int64)
        self.shape = self._shapes(kind, line)
        self.line_at = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, np.int64)

    def _shapes(self, kind: np.ndarray, line: np.ndarray) -> np.ndarray:
        start, size = self.start, self.end - self.start
        own, first = kind[start], self.codes[start]
        shape = np.zeros(len(start), np.int64)
        sign = own == _SIGN
        code = first[sign].astype(np.int64)
        # the signs of ASCII in order, without the digits and letters between them
        shape[sign] = _SIGNS + code - 33 - 10 * (code > 57) - 26 * (code > 90) - 26 * (code > 122)
        digit = np.flatnonzero(own == _DIGIT)
        shape[digit] = _DIGITS + self._digit_shapes(digit, size[digit])
        letter = own == _LETTER
        upper = (self.codes >= 65) & (self.codes <= 90)
        plain = self.codes < 128
        n_upper = np.concatenate([[0], np.cumsum(upper)])
        n_plain = np.concatenate([[0], np.cumsum(plain)])
        big = n_upper[self.end] - n_upper[start]
        case = np.where(big == 0, 0, np.where(big == size, 1, np.where((big == 1) & upper[start], 2, 3)))
        case = np.where(n_plain[self.end] - n_plain[start] < size, 4, case)
        long = np.searchsorted([2, 4, 7], size, "right")
        shape[letter] = (_LETTERS + case * 4 + long)[letter]
        some = np.flatnonzero(letter & (size <= 6))
        place = start[some, None] + np.arange(6)
        chars = np.where(np.arange(6) < size[some, None], self.codes[np.minimum(place, len(self.codes) - 1)] | 32, 0)
        key = _packed(np.where(chars < 128, chars, 255))
        at = np.minimum(np.searchsorted(_WORD_KEYS[_WORD_ORDER], key), len(WORDS) - 1)
        hit = _WORD_KEYS[_WORD_ORDER][at] == key
        shape[some[hit]] = _NAMES + _WORD_ORDER[at[hit]]
        apart = np.ones(len(start), bool)
        apart[1:] = (start[1:] > self.end[:-1]) | (line[1:] != line[:-1])
        return shape * 2 + apart

    def _digit_shapes(self, digit: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Length up to 8, 9 to 10, 11 to 13, then whether 14 to 19 digits pass the check of
        card numbers; three digits above 255 apart."""
        shape = np.where(size <= 8, size - 1, np.where(size <= 10, 8, np.where(size <= 13, 9, np.where(size <= 19, 10, 12))))
        for k in np.flatnonzero((size >= 14) & (size <= 19)):
            begin = self.start[digit[k]]
            shape[k] = 11 if luhn("".join(map(chr, self.codes[begin:begin + size[k]]))) else 10
        three = np.flatnonzero(size == 3)
        begin = self.start[digit[three]]
        value = sum((self.codes[begin + k].astype(np.int64) - 48) * 10 ** (2 - k) for k in range(3))
        shape[three[value > 255]] = 13
        return shape

    def around(self) -> np.ndarray:
        """The shapes at the five places around each token of its line, ``SHAPES`` where there is none."""
        n = len(self.shape)
        out = np.full((5, n), SHAPES, np.int64)
        out[2] = self.shape
        line = np.zeros(n, np.int64)
        line[self.line_at] = 1
        line = np.cumsum(line)
        for k in (1, 2):
            same = line[k:] == line[:-k]
            out[2 - k, k:] = np.where(same, self.shape[:-k], SHAPES)
            out[2 + k, :-k] = np.where(same, self.shape[k:], SHAPES)
        return out


# --- the field --------------------------------------------------------------------------------


class Field:
    """Weights: ``single[place, shape]`` and ``pair[0 or 1, left shape, right shape]`` by label,
    and ``step[label before, label]``; ``START`` is the row of a line's first label."""

    def __init__(self):
        wide = SHAPES + 1
        self.single = np.zeros((5, wide, LABELS), np.float32)
        self.pair = np.zeros((2, wide * wide, LABELS), np.float32)
        self.step = np.zeros((LABELS + 1, LABELS), np.float32)
        for label in range(2, LABELS, 2):   # an inside follows a begin or an inside of its kind only
            self.step[:, label] = -1e4
            self.step[[label - 1, label], label] = 0
        self.free = self.step > -1

    def weights(self) -> list[np.ndarray]:
        return [self.single, *self.pair, self.step]

    def scores(self, around: np.ndarray, pairs: list[np.ndarray] | None = None) -> np.ndarray:
        out = self.single[2][around[2]]
        for place in (0, 1, 3, 4):
            out += self.single[place][around[place]]
        for k, pair in enumerate(pairs or _pairs(around)):
            out += self.pair[k][pair]
        return out

    def labels(self, tokens: Tokens) -> np.ndarray:
        """The likeliest labels of every line (Viterbi); all lines advance in step, the longest first."""
        n = len(tokens.shape)
        if not n:
            return np.zeros(0, np.int64)
        score = self.scores(tokens.around())
        size = np.diff(np.append(tokens.line_at, n))
        order = np.argsort(-size, kind="stable")
        begin, size = tokens.line_at[order], size[order]
        active = np.searchsorted(-size, -np.arange(size[0]), "left")  # lines with more than t tokens
        back = np.zeros((n, LABELS), np.uint8)
        best = score[begin] + self.step[LABELS]
        final = best.copy()
        for t in range(1, size[0]):
            here = begin[:active[t]] + t
            before = best[:active[t]]
            top = before[:, :1] + self.step[0]
            which = np.zeros(top.shape, np.uint8)
            for label in range(1, LABELS):
                other = before[:, label:label + 1] + self.step[label]
                better = other > top
                which[better] = label
                np.maximum(top, other, out=top)
            back[here] = which
            best = top + score[here]
            final[:active[t]] = best
        out = np.zeros(n, np.int64)
        label = final.argmax(1)
        for t in range(size[0] - 1, -1, -1):
            here = begin[:active[t]] + t
            out[here] = label[:active[t]]
            if t:
                label[:active[t]] = back[here, label[:active[t]]]
        return out


def _pairs(around: np.ndarray) -> list[np.ndarray]:
    return [around[1 + k] * (SHAPES + 1) + around[2 + k] for k in (0, 1)]


def _gradient(field: Field, tokens: Tokens, around: np.ndarray, pairs: list[np.ndarray], gold: np.ndarray):
    """Gradient of the log likelihood of ``gold``, by forward and backward sums."""
    n = len(gold)
    score = field.scores(around, pairs).astype(np.float64)
    step = field.step.astype(np.float64)
    size = np.diff(np.append(tokens.line_at, n))
    order = np.argsort(-size, kind="stable")
    begin, size = tokens.line_at[order], size[order]
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(longest), "left")  # lines with more than t tokens
    there = np.arange(longest) < size[:, None]
    place = begin[:, None] + np.minimum(np.arange(longest), size[:, None] - 1)
    s = np.where(there[:, :, None], score[place], 0.0)

    def summed(x, axis):
        top = x.max(axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)

    ahead = np.zeros(s.shape)
    ahead[:, 0] = s[:, 0] + step[LABELS]
    for t in range(1, longest):
        k = active[t]
        ahead[:k, t] = summed(ahead[:k, t - 1, :, None] + step[:LABELS], 1) + s[:k, t]
        ahead[k:, t] = ahead[k:, t - 1]
    total = summed(ahead[:, -1], 1)
    behind = np.zeros(s.shape)
    moved = np.zeros((LABELS + 1, LABELS))
    for t in range(longest - 1, 0, -1):
        k = active[t]
        after = step[:LABELS] + (s[:k, t] + behind[:k, t])[:, None, :]
        behind[:k, t - 1] = summed(after, 2)
        moved[:LABELS] -= np.exp(ahead[:k, t - 1, :, None] + after - total[:k, None, None]).sum(0)
    marginal = np.zeros((n, LABELS))
    marginal[place[there]] = -np.exp(ahead + behind - total[:, None, None])[there]
    moved[LABELS] += marginal[begin].sum(0)
    opens = np.zeros(n, bool)
    opens[tokens.line_at] = True
    np.add.at(moved, (np.where(opens, LABELS, np.roll(gold, 1)), gold), 1)
    marginal[np.arange(n), gold] += 1
    single = np.zeros(field.single.shape)
    for k in range(5):
        np.add.at(single[k], around[k], marginal)
    seen = [np.zeros(w.shape) for w in field.pair]
    for k, pair in enumerate(pairs):
        np.add.at(seen[k], pair, marginal)
    return [single, *seen, np.where(field.free, moved, 0)]


def fitted(examples: tuple[tuple[str, str], ...]) -> Field:
    """The field fitted to ``(text, spans)``, spans as ``kind:start:end`` joined by commas.

    ``TURNS`` steps of adaptive gradient ascent from zero over all texts, so the same examples
    give the same weights.
    """
    texts = [text for text, _ in examples]
    tokens, field = Tokens(texts), Field()
    gold = np.zeros(len(tokens.shape), np.int64)
    for row, (_, spans) in enumerate(examples):
        for span in filter(None, spans.split(",")):
            kind, start, end = span.split(":")
            first = np.searchsorted(tokens.start, tokens.row_at[row] + int(start))
            stop = np.searchsorted(tokens.start, tokens.row_at[row] + int(end))
            gold[first:stop] = 2 + 2 * KINDS.index(kind)
            gold[first] -= 1
    if not len(gold):
        return field
    around = tokens.around()
    used, pairs = zip(*(np.unique(pair, return_inverse=True) for pair in _pairs(around)))
    whole = field.pair
    field.pair = [np.zeros((len(u), LABELS), np.float32) for u in used]  # other pairs keep no weight
    squares = [np.full(w.shape, 1e-8) for w in field.weights()]
    for _ in range(TURNS):
        for weights, square, gradient in zip(field.weights(), squares, _gradient(field, tokens, around, pairs, gold)):
            gradient = gradient - DECAY * np.where(weights > -1e3, weights, 0)
            square += gradient ** 2
            weights += (RATE * gradient / np.sqrt(square)).astype(np.float32)
    for k in (0, 1):
        whole[k][used[k]] = field.pair[k]
    field.pair = whole
    return field


# --- labelled table ---------------------------------------------------------------------------

# The frames of the labelled texts. A name in braces is filled in; those of the
# four kinds are labelled.
FRAMES = (
    "{w} {w} {email} {w} {w}", "{w} {w}, {phone}, {w} {w}.", "{w} {ip} {w}", "{w} {w} {card} {w} {w}",
    "{w}: {email}", "tel: {phone}", "call {phone} {w}", "phone {phone}.", "fax {phone}, {w}", "({email})", "<{email}>",
    "{w} card {card}, {w}", "visa: {card}", "{card} {card} {w}", "{w} {card} {card}", "host {ip}, {w}", "ip = {ip}",
    "{w} {w}&&& {email}### {w}*** {w}%%", "{w}$$$ {card}### {w}", "{w}!! {ip}!! {w},!!", "{w}*** {phone}%%% {w}",
    "{w} {w} {w} {w}, {w} {w} {w}. {w} {w}.", "{w} {w} {w}: {w} ({w}) {w} - {w}!", "{w}!! {w},!! {w}!! {w}!!",
    "{w}### {w}&&& {w}*** {w}$$$ {w}%%%", "{w} at {w} dot {w} {w}", "{w} the host at {w}, {w} {w}.",
    "{w} of {date}, {w}", "{date} {time} {w}", "version {version} {w}", "{w} {version}.", "{w} {price} {w} {price}",
    "{w} {small} {w} {small} {w}", "page {small}, {small}-{small}", "{w} {number} {w}", "order {number}, {w} {w}",
    "token = \"{hex}\" {w}", "{w} {hex}### {w}", "{w} {long} {w}", "{w} {long} {long} {w}", "({small}) {w} {w}",
    "{url} {w}", "{w} {url}, {w}", "{small}. {w} {w} {w}", "{w} [{small}] {w}", "{small} {small} {small} {small}",
    "{w} {code} {w}", "{w} @{w} {w}", "{w}/{w} {w}_{w}", "{w} {small}:{small} {w}", "{w} {year}-{year} {w}", "{w} {small}%")


def labelled_examples(count: int = EXAMPLES, seed: int = 13) -> tuple[tuple[str, str], ...]:
    """``count`` labelled texts by rule: frames filled with invented words and numbers, the
    kinds in the spellings that the patterns know and in others, among numbers that are none."""
    rng = random.Random(seed)
    vowels, consonants = "aeiouéü", "bcdfghklmnprstvwz"

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def word():
        w = "".join(rng.choice(consonants) + rng.choice(vowels) for _ in range(rng.randint(1, 5)))
        return rng.choice([w, w, w, w + rng.choice(consonants), w.capitalize(), w.upper()])

    def plain():
        return "".join(rng.choice(consonants) + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    def checked(n, good=True):
        lead = rng.choice("3456") + digits(n - 2)
        last = next(d for d in "0123456789" if luhn(lead + d))
        return lead + (last if good else str((int(last) + rng.randint(1, 9)) % 10))

    def email():
        name = rng.choice([plain(), plain() + "." + plain(), plain() + "." + digits(2), plain() + digits(2), plain() + "_" + plain()])
        end = rng.choice(["com", "org", "net", "de", "fr", "es"])
        host = rng.choice([plain(), "mail" + digits(1) + "." + plain(), plain() + "-" + plain()])
        if rng.random() < 0.15:
            host = plain() + rng.choice("éü") + plain()
        return rng.choice(["{}@{}.{}", "{}@{}.{}", "{}@{}.{}", "{} (at) {} (dot) {}", "{} [at] {} [dot] {}", "{}(at){}.{}",
                           "{} at {} dot {}", "{} @ {} . {}", "{} [at] {}.{}"]).format(name, host, end)

    def phone():
        shape = rng.choice(["+1 (ddd) ddd-dddd", "+1 (ddd) ddd-dddd", "+dd ddd ddddddd", "+dd dd dd dd dd dd", "(ddd) ddd-dddd",
                            "ddd-ddd-dddd", "ddd.ddd.dddd", "1-ddd-ddd-dddd", "0dd dd dd dd dd", "0ddd ddddddd", "0dd/ddddddd",
                            "+dd (0)dd/ddddddd", "00dd ddd ddddddd", "0d dd dd dd dd"])
        return re.sub("d", lambda _: digits(1), shape)

    def ip():
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        hexes = ["%x" % rng.randrange(1 << 16) for _ in range(8)]
        return rng.choice([".".join(parts), ".".join(parts), ".".join(parts), "[.]".join(parts), " . ".join(parts),
                           ":".join(hexes), ":".join(hexes[:3]) + "::" + ":".join(hexes[5:])])

    def card():
        c = checked(16)
        four = [c[k:k + 4] for k in range(0, 16, 4)]
        return rng.choice([c, c, c, checked(15), " ".join(four), "-".join(four), ".".join(four), "/".join(four), "_".join(four)])

    makers = {
        "email": email, "phone": phone, "ip": ip, "card": card, "w": word,
        "date": lambda: rng.choice([f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
                                    f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}",
                                    f"{rng.randint(1, 12)}/{rng.randint(1, 28)}/{rng.randint(1900, 2030)}"]),
        "time": lambda: f"{rng.randint(0, 23):02}:{rng.randint(0, 59):02}:{rng.randint(0, 59):02}",
        "version": lambda: ".".join(str(rng.randint(0, 20)) for _ in range(rng.randint(2, 3))),
        "price": lambda: rng.choice(["${}.{}", "{},{} €", "{}.{}"]).format(rng.randint(1, 9999), digits(2)),
        "small": lambda: str(rng.randint(0, 500)), "year": lambda: str(rng.randint(1900, 2030)),
        "number": lambda: digits(rng.randint(5, 13)), "long": lambda: checked(rng.randint(14, 19), good=False),
        "hex": lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 32, 40]))),
        "url": lambda: f"https://{plain()}.{rng.choice(['com', 'org'])}/{plain()}/{digits(3)}",
        "code": lambda: rng.choice([f"{plain().upper()}-{digits(4)}", f"CC BY-NC {digits(1)}.0", f"{digits(3)}{plain()}",
                                    f"{digits(3)}-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}"])}
    out = []
    for k in range(count):
        text, spans = "", []
        for part in re.split(r"(\{\w+\})", FRAMES[k % len(FRAMES)]):
            name = part[1:-1] if part.startswith("{") else ""
            filled = makers[name]() if name in makers else part
            if name in KINDS:
                spans.append((len(text), KINDS.index(name), len(text) + len(filled)))
            text += filled
        out.append((text, _joined(spans)))
    return tuple(out)


@lru_cache(maxsize=2)
def _field_of(examples: tuple[tuple[str, str], ...]) -> Field:
    return fitted(examples)


# --- detection --------------------------------------------------------------------------------


def _is_kind(kind: int, found: str) -> bool:
    """Value checks of what the field adds."""
    digits = found.translate(_NUMBERS) if found.isascii() else "".join(c for c in found if "0" <= c <= "9")
    if kind == 0:
        lower = found.lower()
        return ("@" in found or "at" in lower) and ("." in found or "dot" in lower)
    if kind == 1:
        parts = re.findall(r"[0-9]+", found)
        return (len(parts) == 4 and not re.search("[A-Za-z:]", found) and all(map(_is_octet, parts))
                or found.count(":") >= 3 and re.fullmatch(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}", found) is not None)
    return _is_card(digits) if kind == 2 else 8 <= len(digits) <= 15


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], field: Field) -> list[list[tuple[int, int, int]]]:
    """What the field finds in each text, passes the value checks and overlaps no base span."""
    tokens = Tokens(texts)
    labels = field.labels(tokens)
    opens = np.flatnonzero(labels % 2)
    inner = (labels > 0) & (labels % 2 == 0)
    # an inside label always follows a label of its kind, so a span ends before the next other one
    stops = np.flatnonzero(~inner)
    after = np.searchsorted(stops, opens, "right")
    last = np.append(stops, len(labels))[after] - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    rows = np.searchsorted(tokens.row_at, tokens.start[opens], "right") - 1
    for first, end, row in zip(opens.tolist(), last.tolist(), rows.tolist()):
        begin = int(tokens.row_at[row])
        start, stop, kind = int(tokens.start[first]) - begin, int(tokens.end[end]) - begin, (int(labels[first]) - 1) // 2
        if _is_kind(kind, texts[row][start:stop]) and not any(s < stop and start < e for s, _, e in base[row]):
            out[row].append((start, kind, stop))
    return out


def _found(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        for batch in slices(batches, "text", SLICE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added = added_spans(texts, base, field)
            counts = [[sum(k == kind for _, k, _ in spans) for spans in base] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([_joined(sorted(b + a)) for b, a in zip(base, added)], pa.string()),
                 pa.array([len(a) for a in added], pa.int64())],
                [c.split()[0] for c in COLUMNS.split(", ")])
    return run


def personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` for each row of
    ``docs(doc_id, text)``.

    The counts and the digest are those of the base patterns, ``spans`` has all spans as
    ``kind:start:end`` in code points, those of the field included (``n_added`` of them). A null
    text is empty: zeros, the digest of nothing, no spans. Rows without ``doc_id`` and repeated
    rows are rows like others; other columns are ignored; an empty table gives no row.

    ``labelled(text, spans)`` are texts to fit the field to, a small table that goes to the
    driver; by default the ``EXAMPLES`` of :func:`labelled_examples`, which do not depend on
    the corpus. A null text is left out, null spans are none. Detection is one pass without a
    shuffle; the weights, about 1.5 MB whatever the corpus, go to all tasks.
    """
    if labelled is None:
        examples = labelled_examples()
    else:
        examples = tuple((r.text, r.spans or "") for r in labelled.select("text", "spans").where("text is not null").collect())
    sent = docs.sparkSession.sparkContext.broadcast(_field_of(examples))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_found(sent), COLUMNS)
