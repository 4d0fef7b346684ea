"""Personal data by patterns and a semi-Markov conditional random field.

Four patterns find e-mail addresses, IP addresses, payment cards and phone numbers. Beside them a
semi-Markov random field scores whole candidate segments by features of the segment (its shape,
digits, separators, checksums, neighbours) and a dynamic programme over segments of bounded
length chooses boundaries and types jointly. It adds what the patterns do not cover: other
spellings of these four, account numbers (iban) and social security numbers (ssn). What a pattern
found stays; a segment that overlaps it is dropped.

The field is trained in numpy, by its log-likelihood, on sentences made by a seeded rule
(``training_sentences``); no table is needed for that. It runs over the parts of a text around digits
and at-signs, which every segment must hold; texts are read whole.

Rows: null counts as the empty text, which has no spans. Spans depend on the text alone; ties and
repeated rows need no rule. An empty table gives no rows. Columns called like a result are replaced.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.common import append_columns, texts

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
MAX_TOKENS = 16
# Characters read on either side of digits and at-signs, and fewest digits of a segment without one.
MARGIN = 48
FEWEST_DIGITS = 7

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only begin where a run of digits does, so runs are never tried again from within.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
ANY = re.compile(r"[0-9@]")
AT_WORD = r"[\[({]\s?(?:at|AT)\s?[\])}]"
TRIGGER = re.compile(rf"[0-9@]|{AT_WORD}")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the four patterns, by kind and start."""
    found: list[tuple[str, int, int]] = []
    if not ANY.search(text):
        return found
    # Leftmost local parts: the run of their characters before an at-sign.
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", at + 1)
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", match[0])
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


# --- segments and their features ------------------------------------------------


def _shape(segment: str) -> str:
    """Runs of digits by length, runs of letters as one, the rest as it stands."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda run: f"{min(len(run[0]), 20)}d", segment))


def _valid_iban(compact: str) -> bool:
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", compact):
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def features(text: str, start: int, end: int, tokens: int, before: str, after: str) -> list[str]:
    """Names of the features of the segment ``text[start:end]`` between two neighbouring tokens."""
    segment = text[start:end]
    digits = NOT_DIGIT.sub("", segment)
    compact = re.sub(r"[\x20-]", "", segment)
    groups = re.findall(r"[0-9]+", segment)
    left = text[start - 1] if start else " "
    right = text[end] if end < len(text) else " "
    right_next = text[end + 1] if end + 1 < len(text) else " "
    letters = bool(re.search(r"[^\W\d_]", segment))
    names = [
        "bias",
        f"shape={_shape(segment)}",
        f"digits={min(len(digits), 24)}",
        f"groups={min(len(groups), 8)}",
        f"marks={''.join(sorted(set(re.sub(r'[A-Za-z0-9]', '', segment))))[:8]}",
        f"tokens={min(tokens, 12)}",
        f"letters={letters}",
        f"first={segment[0] if not segment[0].isalnum() else 'x'}",
        f"last={segment[-1] if not segment[-1].isalnum() else 'x'}",
        f"before={before.lower()}",
        f"after={after.lower()}",
        f"joined_left={left.isalnum() or left in '.-_/=@+#%'}",
        f"joined_right={right.isalnum() or right in '-_/=@%' or (right in '.,:' and right_next.isalnum())}",
        f"quoted={left in chr(34) + chr(39)}",
    ]
    if "@" in segment or re.search(AT_WORD, segment):
        names.append("at" + str(len(re.findall(rf"@|{AT_WORD}", segment))))
        names.append(f"host={bool(re.search(r'(?:[.]|[(]dot[)]|\[dot\]|[{]dot[}])[^0-9 ]{2,}$', segment.replace(' ', '')))}")
    if 13 <= len(digits) <= 19 and not letters:
        names.append(f"luhn={passes_luhn(digits)}")
    if len(groups) == 4 and re.fullmatch(r"[0-9]+(?:\s?\.\s?[0-9]+){3}", segment):
        names.append(f"octets={all(int(g) <= 255 for g in groups)}")
    if letters and re.match(r"[A-Z]{2}[0-9]{2}", compact):
        names.append(f"iban={_valid_iban(compact)}")
    if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", segment):
        names.append(f"ssn={groups[0] not in ('000', '666') and groups[0] < '900' and groups[1] != '00' and groups[2] != '0000'}")
    return names


class Lattice:
    """Tokens of a stretch of text, its candidate segments and their features."""

    def __init__(self, text: str, start: int = 0, end: int | None = None):
        self.tokens = [m.span() for m in TOKEN.finditer(text, start, len(text) if end is None else end)]
        words = [text[a:b] for a, b in self.tokens]
        opens = [w[0].isalnum() or w[0] in "+([{" for w in words]
        closes = [w[-1].isalnum() or w[-1] in ")]}" for w in words]
        digit_count = np.cumsum([0, *(len(w) if w[0] in "0123456789" else 0 for w in words)])
        ats = np.cumsum([0, *(w == "@" or (w in ("at", "AT") and 0 < i < len(words) - 1 and words[i - 1] in "([{" and words[i + 1] in ")]}") for i, w in enumerate(words))])
        self.segments: list[tuple[int, int]] = []
        self.names: list[list[str]] = []
        for i in range(len(words)):
            if not opens[i]:
                continue
            for j in range(i + 1, min(i + MAX_TOKENS, len(words)) + 1):
                if not closes[j - 1]:
                    continue
                if digit_count[j] - digit_count[i] < FEWEST_DIGITS and ats[j] == ats[i] and not _dotted(words[i:j]):
                    continue
                a, b = self.tokens[i][0], self.tokens[j - 1][1]
                if "\n" in text[a:b]:
                    break
                self.segments.append((i, j))
                self.names.append(features(text, a, b, j - i, words[i - 1] if i else "", words[j] if j < len(words) else ""))


def _dotted(words: list[str]) -> bool:
    return len(words) == 7 and words[1] == words[3] == words[5] == "." and all(w.isdigit() for w in words[::2])


class Field:
    """Weights of features by type, and the dynamic programmes over a lattice. A token outside
    any segment scores 0."""

    def __init__(self, index: dict[str, int], weights: np.ndarray):
        self.index, self.weights = index, weights

    def rows(self, lattice: Lattice) -> np.ndarray:
        """Feature numbers of each segment; the last row of the weights, all zero, fills up."""
        none = len(self.weights) - 1
        width = max(map(len, lattice.names), default=1)
        return np.array([[self.index.get(n, none) for n in names] + [none] * (width - len(names)) for names in lattice.names], np.int64).reshape(-1, width)

    def best(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """The best scoring choice of segments: first token, end token, type."""
        if not lattice.segments:
            return []
        scores = self.weights[self.rows(lattice)].sum(1)
        kind = scores.argmax(1)
        value = scores.max(1)
        ending: dict[int, list[int]] = {}
        for s, (_, j) in enumerate(lattice.segments):
            if value[s] > 0:
                ending.setdefault(j, []).append(s)
        n = len(lattice.tokens)
        total, choice = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            total[j] = total[j - 1]
            for s in ending.get(j, ()):
                if (candidate := total[lattice.segments[s][0]] + value[s]) > total[j]:
                    total[j], choice[j] = candidate, s
        found, j = [], n
        while j > 0:
            if choice[j] < 0:
                j -= 1
                continue
            i, _ = lattice.segments[choice[j]]
            found.append((i, j, int(kind[choice[j]])))
            j = i
        return found[::-1]

    def shares(self, lattice: Lattice, rows: np.ndarray) -> np.ndarray:
        """Probability of each segment and type, by the sums over all segmentations."""
        scores = self.weights[rows].sum(1)
        peak = np.log(np.exp(scores - scores.max(1, keepdims=True)).sum(1)) + scores.max(1)
        n = len(lattice.tokens)
        forward, backward = np.zeros(n + 1), np.zeros(n + 1)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for s, (i, j) in enumerate(lattice.segments):
            ending[j].append(s)
            starting[i].append(s)
        for j in range(1, n + 1):
            forward[j] = _log_sum([forward[j - 1], *(forward[lattice.segments[s][0]] + peak[s] for s in ending[j])])
        for i in range(n - 1, -1, -1):
            backward[i] = _log_sum([backward[i + 1], *(backward[lattice.segments[s][1]] + peak[s] for s in starting[i])])
        firsts, ends = np.array(lattice.segments).T
        return np.exp(scores + (forward[firsts] + backward[ends] - forward[n])[:, None])


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(sum(np.exp(v - top) for v in values)))


# --- training --------------------------------------------------------------------


def training_sentences(count: int = 500, seed: int = 11) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Sentences with labelled spans, made by rule: filler words around personal data in many
    spellings, and around numbers that are none."""
    rng = random.Random(seed)

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def word() -> str:
        return "".join(rng.choice(("an", "er", "the", "ou", "st", "in", "re", "que", "ment", "os", "de", "la", "ch", "ei")) for _ in range(rng.randint(1, 4)))

    def card() -> str:
        body = rng.choice("3456") + digits(rng.choice((12, 14, 14, 14, 17)))
        number = next(body + c for c in "0123456789" if passes_luhn(body + c))
        mark = rng.choice(("", "", " ", "-", ".", "  "))
        return mark.join(number[i : i + 4] for i in range(0, len(number), 4))

    def not_card() -> str:
        number = digits(16)
        return card_like(number) if not passes_luhn(number) else card_like(number[:-1] + str((int(number[-1]) + 1) % 10))

    def card_like(number: str) -> str:
        mark = rng.choice(("", " ", "-"))
        return mark.join(number[i : i + 4] for i in range(0, len(number), 4))

    def phone() -> str:
        a, b, c = str(rng.randint(201, 989)), digits(3), digits(4)
        return rng.choice(
            (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"{a}.{b}.{c}", f"+49 30 {digits(7)}", f"0049 30 {digits(7)}", f"+33 1 {digits(2)} {digits(2)} {digits(2)} {digits(2)}", f"1-{a}-{b}-{c}", f"+44 20 {digits(4)} {digits(4)}")
        )

    def email() -> str:
        name, host, end = word() + rng.choice(("", ".", "_")) + rng.choice((word(), digits(2))), word() + rng.choice(("", digits(1))), rng.choice(("com", "org", "net", "de", "fr"))
        at, dot = rng.choice((("@", "."), ("@", "."), (" (at) ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (AT) ", " (DOT) ")))
        return f"{name}{at}{host}{dot if ' ' in at else '.'}{end}".replace(" (DOT) ", " (dot) ")

    def ip() -> str:
        return rng.choice((".", ".", ".", " . ")).join(str(rng.randint(1, 254)) for _ in range(4))

    def iban() -> str:
        country, body = rng.choice(("DE", "FR", "ES", "GB", "NL")), digits(18)
        check = 98 - int(body + "".join(str(int(c, 36)) for c in country) + "00") % 97
        whole = f"{country}{check:02d}{body}"
        return rng.choice((whole, " ".join(whole[i : i + 4] for i in range(0, len(whole), 4))))

    def ssn() -> str:
        return f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"

    makers = {"card": card, "phone": phone, "email": email, "ip": ip, "iban": iban, "ssn": ssn}
    plain = (
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
        lambda: f"{rng.randint(1, 28):02d}.{rng.randint(1, 12):02d}.{rng.randint(1900, 2030)} {rng.randint(0, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
        lambda: f"{rng.randint(1, 9)},{digits(3)},{digits(3)}.{digits(2)}",
        lambda: f"{rng.randint(256, 999)}.{digits(1)}.{digits(2)}.{rng.randint(300, 999)}",
        lambda: f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((18, 32, 40)))),
        lambda: f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"',
        lambda: f"password={''.join(rng.choice('0123456789abcdef') for _ in range(18))}",
        lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
        lambda: digits(rng.choice((7, 8, 10, 11, 12, 20))),
        lambda: f"{digits(4)} {digits(4)}",
        lambda: f"{digits(3)} {digits(3)} {digits(3)}",
        lambda: f"{digits(5)}-{digits(6)}",
        lambda: f"{digits(4)}-{digits(4)}/{digits(2)}",
        lambda: f"{digits(3)}.{digits(7)}, -{digits(2)}.{digits(6)}",
        lambda: f"{digits(2)} {digits(3)} {digits(4)} {digits(2)}",
        lambda: f"{word()} @ {digits(3)} {word()}",
        lambda: f"@{word()}{digits(2)}",
        not_card,
    )
    sentences = []
    for at in range(count):
        text, spans = " ".join(word() for _ in range(rng.randint(1, 4))), []
        for _ in range(rng.randint(1, 2)):
            text += rng.choice((" ", " ", ", ", ": ", " (", "\n"))
            if (at + len(spans)) % 2:
                kind = rng.choice(list(makers))
                made = makers[kind]()
                spans.append((len(text), len(text) + len(made), kind))
                text += made
            else:
                text += rng.choice(plain)()
            text += rng.choice(("", "", ".", ",", "!")) + " " + " ".join(word() for _ in range(rng.randint(1, 4)))
        sentences.append((text, spans))
    return sentences


@lru_cache(maxsize=1)
def trained(epochs: int = 8, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """The field fitted to ``training_sentences`` by gradient steps on the log-likelihood."""
    examples = [(Lattice(text), spans) for text, spans in training_sentences()]
    index: dict[str, int] = {}
    for lattice, _ in examples:
        for names in lattice.names:
            for name in names:
                index.setdefault(name, len(index))
    field = Field(index, np.zeros((len(index) + 1, len(KINDS))))
    squares = np.full_like(field.weights, 1e-6)
    targets = []
    for lattice, spans in examples:
        truth = np.zeros((len(lattice.segments), len(KINDS)))
        wanted = {(a, b): KINDS.index(kind) for a, b, kind in spans}
        for s, (i, j) in enumerate(lattice.segments):
            if (kind := wanted.get((lattice.tokens[i][0], lattice.tokens[j - 1][1]))) is not None:
                truth[s, kind] = 1
        targets.append((lattice, field.rows(lattice), truth))
    for _ in range(epochs):
        for lattice, rows, truth in targets:
            if not len(rows):
                continue
            slope = field.shares(lattice, rows) - truth
            used, place = np.unique(rows, return_inverse=True)
            grad = decay * field.weights[used]
            np.add.at(grad, place.reshape(rows.shape), slope[:, None, :])
            squares[used] += grad**2
            field.weights[used] -= rate * grad / np.sqrt(squares[used])
            field.weights[-1] = 0
    return field


# --- over texts ------------------------------------------------------------------


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Parts of a text around digits and at-signs that can hold a segment."""
    start = end = None
    digits, ats = 0, 0
    for match in TRIGGER.finditer(text):
        if end is None or match.start() > end + MARGIN:
            if start is not None and (ats or digits >= 4):
                yield max(start - MARGIN, 0), min(end + MARGIN, len(text))
            start, digits, ats = match.start(), 0, 0
        end = match.end()
        if match[0] in "0123456789":
            digits += 1
        else:
            ats += 1
    if start is not None and (ats or digits >= 4):
        yield max(start - MARGIN, 0), min(end + MARGIN, len(text))


def added_spans(text: str, base: list[tuple[str, int, int]], field: Field) -> list[tuple[str, int, int]]:
    """Spans of the field that overlap no base span."""
    if not TRIGGER.search(text):
        return []
    taken = sorted((a, b) for _, a, b in base)
    found, last = [], 0
    for start, end in _stretches(text):
        # Cut at white space, so that no token is halved, and never read a part twice.
        while start > last and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if end <= last:
            continue
        start = max(start, last)
        last = end
        inside = [(a, b) for a, b in taken if a < end and b > start]
        # What the patterns explain whole needs no second opinion.
        rest = _blank(text[start:end], [(a - start, b - start) for a, b in inside])
        if not re.search(rf"@|{AT_WORD}|[0-9](?:[^0-9]{{0,4}}[0-9]){{3}}", rest):
            continue
        lattice = Lattice(text, start, end)
        for i, j, kind in field.best(lattice):
            a, b = lattice.tokens[i][0], lattice.tokens[j - 1][1]
            if not any(a < y and b > x for x, y in inside):
                found.append((KINDS[kind], a, b))
    return found


def _blank(text: str, spans: list[tuple[int, int]]) -> str:
    for a, b in spans:
        a, b = max(a, 0), min(b, len(text))
        text = text[:a] + " " * (b - a) + text[b:]
    return text


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def find(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, start, end) in code points, end
    exclusive, by kind as in ``KINDS`` and start; without the text unless ``keep_text``."""
    field = trained()

    def compute(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            base, spans = [], []
            for body in texts(batch, text):
                own = base_spans(body)
                base.append(_rows(own))
                spans.append(_rows(sorted(own + added_spans(body, own, field), key=lambda s: (KINDS.index(s[0]), s[1]))))
            yield [base, spans]

    fields = [T.StructField("base", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN))]
    return append_columns(docs, fields, compute, () if keep_text else (text,))


def _rows(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": kind, "start": a, "end": b} for kind, a, b in spans]
