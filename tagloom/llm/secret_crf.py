"""Secret scan: fixed patterns, and a linear-chain conditional random field.

The patterns give the base spans.  The field tags the tokens of each line as
beginning a secret, inside one, or outside, from the token's shape, the words
around it and features of the whole file; Viterbi finds the best tags.  Tagged
spans that touch no base span are added as kind ``crf``.

The field is trained in numpy on a sample of documents (``SAMPLE`` at most,
chosen by a hash of the id; documented bound), whose base spans are the tags to
learn: the full-batch gradient of the likelihood, by forward and backward sums
over windows of ``SPAN`` tokens around odd tokens, with adaptive steps.  Base
spans alone would teach nothing but the base patterns, so ``varied`` adds lines
made from the sample: its values and values of other shapes behind other words
of the same meaning (``CUES``), with the word left out, and without assignment;
and as counter-examples those words in prose, and plain words, numbers, dates,
versions and paths behind them or behind words of the sample.

Features hash the neighbouring words themselves and, over quotes and an
assignment, the word that names the value (whole, in parts, and by prefix).

The field is constrained as tag fields usually are: a secret is tagged inside
only after its begin, and begins with a token of ``ODD`` characters or more, with
or without digits.  A line is decoded, as a whole chain, if it has a digit in
such a token, a token of ``LONG`` characters, or a ``:`` or ``=``; a secret of
fewer letters alone that nothing assigns is not looked for.

Defined results: a null text is empty and has no span; repeated rows are
scanned each; a line of any length is decoded as one chain; if the sample has
no base span nothing is added; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

# The base patterns, in the order in which ties are listed.
_WORDS = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                          for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
PATTERNS = [
    ("assign", re.compile(_WORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_RUN = re.compile(r"[0-9a-f]{24,}")

TOKEN = re.compile(r"[A-Za-z0-9+/_.-]+|[^\sA-Za-z0-9+/_.-]")
ODD, LONG = 6, 20
_ODD_TOKEN = re.compile(r"(?=[A-Za-z+/_.-]*[0-9])[A-Za-z0-9+/_.-]{%d,}|[A-Za-z0-9+/_.-]{%d,}" % (ODD, LONG))
SAMPLE = 4000
SEEN = 4000
SPAN = 16
WEIGHTS = 1 << 16
STEPS = 60
RATE = 0.5
DECAY = 1e-4
BEGIN, INSIDE, OUTSIDE = range(3)
NEVER = -1e9
_CAN_BEGIN = re.compile(r"[A-Za-z0-9+/_.-]{%d,}" % ODD)
_PART = re.compile("[_.-]+")
REACH = 6
# Words that name a secret, besides those of the base patterns.
CUES = ("passphrase", "pwd", "pass", "credential", "credentials", "auth", "authorization", "bearer", "private_key", "access_key",
        "client_secret", "client_id", "api_token", "auth_token", "session_key", "signing_key", "webhook_key", "pin_code", "login_key", "key")
VARIED = 1600
# Tokens whose bounds are kept, and tokens bounded at once.
KNOWN, AT_ONCE = 600_000, 20_000


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of every base span, sorted."""
    low, out = text.lower(), []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        if kind == "assign" and not any(k in low for k in KEYWORDS):
            continue
        # Runs are maximal, so the short ones of a pattern that is one run can be left out at once.
        pattern = _HEX_RUN if kind == "hex" else pattern
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % WEIGHTS


def own_features(token: str) -> list[int]:
    """Shape of a token.  Plain words fall into few classes."""
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    if len(token) == 1 and not token.isalnum():
        return [_bucket("mark=" + token)]
    if not digits and len(token) < LONG:
        shape = "title" if token.istitle() else "lower" if token.islower() else "upper" if token.isupper() else "mixed"
        return [_bucket(f) for f in ("plain", f"plain={min(len(token) // 3, 6)}", f"plain:{shape}", f"plain:inner={bool(_PART.search(token))}")]
    kinds = re.sub(r"(.)\1+", r"\1", re.sub("[a-z]", "x", re.sub("[A-Z]", "X", re.sub("[0-9]", "d", token))))
    mixed = len(set(token)) / len(token)
    return [_bucket(f) for f in (
        f"length={min(len(token) // 4, 12)}", f"shape={kinds[:4]}", f"whole={kinds if len(kinds) < 6 else ''}", f"changes={min(len(kinds) // 3, 6)}",
        f"digits={10 * digits // len(token)}", f"letters={10 * letters // len(token)}", f"hex={set(token) <= set('0123456789abcdef')}",
        f"upper={token.isupper()}", f"distinct={int(5 * mixed)}", f"number={bool(re.fullmatch('[0-9.,/-]+', token))}",
        f"start={token[:4] if token[:4].isupper() else ''}")]


def near_features(place: str, token: str) -> list[int]:
    """A neighbour: its word, or its class if it is odd itself."""
    if _ODD_TOKEN.fullmatch(token):
        return [_bucket(f"{place}=odd")]
    return [_bucket(f"{place}={token.lower()}")]


def namer(tokens: list[str], i: int) -> tuple[str, bool] | None:
    """The word that names the value at ``i``, over quotes and an assignment, and
    whether there is one."""
    assigned = False
    for j in range(i - 1, max(-1, i - 1 - REACH), -1):
        token = tokens[j]
        if token in (":", "=", ">"):
            assigned = True
        elif len(token) > 1 or token.isalnum():
            return (token.lower(), assigned) if assigned or j == i - 1 else None
    return None


def name_features(name: tuple[str, bool] | None) -> list[int]:
    if name is None:
        return [_bucket("name:none")]
    word, assigned = name
    parts = [p for p in _PART.split(word) if p]
    return [_bucket(f) for f in (f"name:assigned={assigned}", f"name={word}|{assigned}", *(f"part={p}|{assigned}" for p in parts),
                                 *(f"prefix={p[:4]}|{assigned}" for p in parts))]


def file_features(text: str) -> list[int]:
    low = text.lower()
    return [_bucket(f"file:keyword={any(k in low for k in KEYWORDS)}"),
            _bucket(f"file:code={sum(text.count(c) for c in '{}=();') * 200 > len(text)}"),
            _bucket(f"file:length={min(len(text).bit_length(), 16)}")]


PLACES = {"before2": -2, "before": -1, "after": 1, "after2": 2}
_DIGIT = re.compile(r"\d")
# Checksums of what the names of features begin with.
_HEADS = [zlib.crc32(f"{place}=".encode()) for place in PLACES]
_NAME, _A_PART, _PREFIX = (zlib.crc32(f) for f in (b"name=", b"part=", b"prefix="))


def features(tokens: list[str], i: int) -> list[int]:
    out = own_features(tokens[i])
    for place, step in PLACES.items():
        j = i + step
        out += near_features(place, tokens[j]) if 0 <= j < len(tokens) else [_bucket(place + "=edge")]
    return out + name_features(namer(tokens, i))


class Field:
    """Weights (feature bucket by tag) and transitions (tag to tag)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights.tolist(), moves.tolist()
        self.own: dict[str, list[float]] = {}
        self.near: dict[tuple[str, str], list[float]] = {}
        self.names: dict[tuple[str, bool] | None, list[float]] = {}
        self.some = bool(np.abs(weights).sum())
        self.bounds: Bounds | None = None

    def _sum(self, ids) -> list[float]:
        return [sum(self.weights[i][tag] for i in ids) for tag in range(3)]

    def _kept(self, table: dict, key, make) -> list[float]:
        if key not in table:
            if len(table) > 200_000:
                table.clear()
            table[key] = self._sum(make())
        return table[key]

    def emission(self, tokens: list[str], i: int, extra: list[float]) -> list[float]:
        parts = [extra, self._kept(self.own, tokens[i], lambda: own_features(tokens[i]))]
        for place, step in PLACES.items():
            j = i + step
            token = tokens[j] if 0 <= j < len(tokens) else None
            parts.append(self._kept(self.near, (place, token), lambda: near_features(place, token) if token is not None
                                    else [_bucket(place + "=edge")]))
        name = namer(tokens, i)
        parts.append(self._kept(self.names, name, lambda: name_features(name)))
        out = [sum(p[tag] for p in parts) for tag in range(3)]
        if not _CAN_BEGIN.fullmatch(tokens[i]):
            out[BEGIN] = NEVER
        return out

    def best(self, tokens: list[str], extra: list[float]) -> list[int]:
        """Viterbi; a chain starts as if after an outside token."""
        score, back = [0.0 if t == OUTSIDE else NEVER for t in range(3)], []
        for i in range(len(tokens)):
            e = self.emission(tokens, i, extra)
            come = [max((score[s] + self.moves[s][t], s) for s in range(3)) for t in range(3)]
            score = [come[t][0] + e[t] for t in range(3)]
            back.append([c[1] for c in come])
        tag, out = score.index(max(score)), []
        for step in reversed(back):
            out.append(tag)
            tag = step[tag]
        return out[::-1]

    def spans(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the tagged secrets of a whole text."""
        if not self.some:
            return []
        extra = self._sum(file_features(text))
        self.bounds = self.bounds or Bounds(self)
        out = []
        for start, line in self.bounds.lines(text, extra):
            found = list(TOKEN.finditer(line))
            begun = None
            tags = self.best([m[0] for m in found], extra)
            for m, tag in zip([*found, None], [*tags, OUTSIDE]):
                if tag != INSIDE and begun is not None:
                    out.append((start + begun[0], start + begun[1]))
                    begun = None
                if tag != OUTSIDE:
                    begun = (m.start() if tag == BEGIN else begun[0], m.end())
        return out


class Bounds:
    """Which lines a field can tag a secret in.

    Against tagging all tokens outside, a run of tagged tokens gains at most, per
    token, the better of its two tags and the best move into one, and the best move
    out once.  The greatest sum over a run is that of running sums over the lowest
    one before; a great loss stands between lines, so that no run spans two."""

    EDGE, BETWEEN, SLACK = 0, 2, 1e-3
    LOSS = 1e4

    def __init__(self, field: Field):
        self.field, moves = field, field.moves
        stay = moves[OUTSIDE][OUTSIDE]
        self.step = max(moves[s][t] for s in range(3) for t in (BEGIN, INSIDE) if (s, t) != (OUTSIDE, INSIDE)) - stay
        self.close = max(0.0, moves[BEGIN][OUTSIDE] - stay, moves[INSIDE][OUTSIDE] - stay)
        self.gains = [(b - o, i - o) for b, i, o in field.weights]
        self.unnamed = self._gain(name_features(None))
        self.named = [self._gain([_bucket(f"name:assigned={assigned}")]) for assigned in (False, True)]
        self.near_odd = [g for place in PLACES for g in self._gain([_bucket(place + "=odd")])]
        self.plain: dict[tuple, tuple[float, float]] = {}
        self._forget()

    def _gain(self, ids) -> tuple[float, float]:
        begin = inside = 0.0
        for i in ids:
            begin += self.gains[i][0]
            inside += self.gains[i][1]
        return begin, inside

    def _forget(self):
        self.number: dict[str, int] = {"": self.EDGE}
        self.word, self.assigns = bytearray(1), bytearray(1)
        # Per token: own, the four places, the name without and with an assignment.
        self.table = array("d", [0.0, 0.0])
        for place in PLACES:
            self.table.extend(self._gain([_bucket(place + "=edge")]))
        self.table.extend([*self.unnamed] * 2)

    def _own(self, token: str) -> tuple[float, float]:
        """Plain words fall into few classes, whose gain is kept."""
        if len(token) == 1 or len(token) >= LONG or _DIGIT.search(token):
            return self._gain(own_features(token))
        key = (len(token) // 3, token.istitle(), token.islower(), token.isupper(), bool(_PART.search(token)))
        if key not in self.plain:
            self.plain[key] = self._gain(own_features(token))
        return self.plain[key]

    def _add(self, token: str) -> int:
        """Bounds of a new token: the sums of ``own_features``, ``near_features`` and
        ``name_features``; a bucket's checksum goes on from that of its first part."""
        (begin, inside), low, gains = self._own(token), token.lower(), self.gains
        row = [begin if _CAN_BEGIN.fullmatch(token) else NEVER, inside]
        if _ODD_TOKEN.fullmatch(token):
            row += self.near_odd
        else:
            text = low.encode()
            for head in _HEADS:
                row += gains[zlib.crc32(text, head) % WEIGHTS]
        parts = [p for p in _PART.split(low) if p]
        for tail, (begin, inside) in zip(("|False", "|True"), self.named):
            for head, word in ((_NAME, low), *((_A_PART, p) for p in parts), *((_PREFIX, p[:4]) for p in parts)):
                gain = gains[zlib.crc32((word + tail).encode(), head) % WEIGHTS]
                begin += gain[0]
                inside += gain[1]
            row += (begin, inside)
        self.table.extend(row)
        self.word.append(len(token) > 1 or token.isalnum())
        self.assigns.append(token in (":", "=", ">"))
        self.number[token] = len(self.number)
        return self.number[token]

    def lines(self, text: str, extra: list[float]):
        """(start, line) of the lines that need decoding."""
        held, codes, first, start = [], [self.EDGE] * self.BETWEEN, [], 0
        for line in text.split("\n"):
            if _CAN_BEGIN.search(line):
                held.append((start, line))
                first.append(len(codes))
                number, add = self.number, self._add
                codes += [number[t] if t in number else add(t) for t in TOKEN.findall(line)]
                codes += [self.EDGE] * self.BETWEEN
                if len(codes) > AT_ONCE:
                    yield from (held[k] for k in self._open(codes, first, extra))
                    held, codes, first = [], [self.EDGE] * self.BETWEEN, []
                    if len(self.number) > KNOWN:
                        self._forget()
            start += len(line) + 1
        if held:
            yield from (held[k] for k in self._open(codes, first, extra))
            if len(self.number) > KNOWN:
                self._forget()

    def _open(self, codes: list[int], first: list[int], extra: list[float]) -> np.ndarray:
        """The lines in which a run of tokens may gain."""
        code = np.array(codes)
        table = np.frombuffer(self.table).reshape(-1, 7, 2)
        own, n = slice(self.BETWEEN, len(code) - self.BETWEEN), len(code) - 2 * self.BETWEEN
        gain = table[code[own], 0] + [extra[BEGIN] - extra[OUTSIDE], extra[INSIDE] - extra[OUTSIDE]]
        for k, step in enumerate(PLACES.values()):
            gain += table[code[self.BETWEEN + step:self.BETWEEN + step + n], 1 + k]
        gain += self._names(code, table)[own]
        best = np.where(code[own] == self.EDGE, -self.LOSS, gain.max(axis=1) + self.step)
        upto = np.concatenate([[0.0], np.cumsum(best)])
        run = upto[1:] - np.minimum.accumulate(upto[:-1])
        return np.flatnonzero(np.maximum.reduceat(run, np.array(first) - self.BETWEEN) + self.close > -self.SLACK)

    def _names(self, code: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Gain of the word that names each token, as ``namer`` finds it."""
        word, assigns = (np.frombuffer(bytes(t), np.uint8)[code].astype(bool) for t in (self.word, self.assigns))
        out = np.tile(np.array(self.unnamed), (len(code), 1))
        assigned, looking = np.zeros(len(code), bool), np.ones(len(code), bool)
        for back in range(1, min(REACH + 1, len(code))):
            looking[:back] = False
            there = slice(0, len(code) - back)
            found = np.zeros(len(code), bool)
            found[back:] = looking[back:] & word[there]
            named = np.flatnonzero(found & (assigned | (back == 1)))
            out[named] = table[code[named - back], 5 + assigned[named]]
            looking &= ~found
            looking[back:] &= code[there] != self.EDGE
            assigned[back:] |= looking[back:] & assigns[there]
            if not looking.any():
                break
        return out


def _tag_line(line: str, values: list[tuple[int, int]]):
    """Tokens and tags of a line whose secrets are at ``values`` (sorted)."""
    found, tags, k = list(TOKEN.finditer(line)), [], 0
    for m in found:
        while k < len(values) and values[k][1] <= m.start():
            k += 1
        hit = values[k] if k < len(values) and values[k][0] < m.end() else None
        if hit and m.start() <= hit[0] and _CAN_BEGIN.fullmatch(m[0]):
            tags.append(BEGIN)
        else:
            tags.append(INSIDE if hit and m.start() > hit[0] and tags and tags[-1] != OUTSIDE else OUTSIDE)
    return [m[0] for m in found], tags


def _windows(tokens: list[str], tags: list[int]):
    """(first, last) of windows around odd and tagged tokens, else one in the middle."""
    odd = [i for i, t in enumerate(tokens) if tags[i] != OUTSIDE or _ODD_TOKEN.fullmatch(t) or t in (":", "=")] or ([len(tokens) // 2] if tokens else [])
    taken = -1
    for i in odd:
        if i > taken:
            first, taken = max(taken + 1, i - SPAN // 2), min(len(tokens), max(0, i - SPAN // 2) + SPAN) - 1
            yield first, taken + 1


def _values(text: str) -> list[tuple[int, int]]:
    """Where the values of the base spans are, sorted, without overlaps."""
    out = []
    for a, b in sorted(m.span(group) for _, pattern, group, least in PATTERNS for m in pattern.finditer(text) if len(m[group]) >= least):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def _tagged(text: str):
    """(tokens, tags, first, last) of the windows of a text; tags from base spans."""
    values, start, k = _values(text), 0, 0
    for line in text.split("\n"):
        end, own = start + len(line), []
        while k < len(values) and values[k][0] < end:
            own.append((values[k][0] - start, values[k][1] - start))
            k += 1
        tokens, tags = _tag_line(line, own)
        for first, last in _windows(tokens, tags):
            yield tokens, tags, first, last
        start = end + 1


def _made_value(rng: random.Random, found: list[str], words: list[str]) -> str:
    """A value of the sample, or one of another shape that secrets have."""
    letters, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
    kind = rng.choice([0, 1, 2, 3, 4, 5, 5, 6])
    if kind == 0:
        return rng.choice(found)
    if kind == 1:
        return "".join(rng.choice(hexes) for _ in range(rng.choice([12, 16, 20, 22])))
    if kind == 2:
        return "".join(rng.choice(letters) for _ in range(rng.randint(12, 40)))
    if kind == 3:
        return rng.choice(["ghp_", "sk_", "pk_", "xoxb-", "key-", "tok_", "glpat-"]) + "".join(rng.choice(letters) for _ in range(rng.randint(16, 36)))
    if kind == 4:
        return "".join(rng.choice(words) for _ in range(2)) + str(rng.randint(1, 9999))
    if kind == 5:
        return rng.choice(["-", "_", "."]).join(rng.choice(words) for _ in range(rng.randint(3, 4)))
    return "".join(rng.choice(words) for _ in range(2))


def varied(texts: list[str], seed: int = 6):
    """(line, values) made from the texts; nothing if they have no base span."""
    found = [t[a:b] for t in texts for a, b in _values(t)]
    words = sorted({w for t in texts for w in re.findall("[A-Za-z]{3,9}", t[:2000])})
    if not found or len(words) < 20:
        return
    rng = random.Random(seed)
    names = [*CUES, *KEYWORDS]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def styled(name):
        return rng.choice([name, name.upper(), name.title(), name.replace("_", "-"), rng.choice(words).lower() + "_" + name])
    for i in range(VARIED):
        value, name = _made_value(rng, found, words), styled(rng.choice(names))
        before, after = prose(rng.randint(0, 5)), prose(rng.randint(0, 5))
        alone = re.search("[0-9]", value) and len(value) >= 16
        form = rng.randrange(8 if alone else 5)
        head = {0: f"{name}: ", 1: f"{name} = \"", 2: f"{name}=", 3: f"\"{name}\": \"", 4: rng.choice(["Authorization: Bearer ", "bearer: ", "auth: Basic "]),
                5: "Bearer ", 6: "", 7: f"{name} "}[form]
        tail = '"' if head.endswith('"') else ""
        at = len(before) + 1 + len(head)
        yield f"{before} {head}{value}{tail} {after}", [(at, at + len(value))]
    plain = [lambda: str(rng.randint(0, 99_999)), lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
             lambda: f"{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}", lambda: f"{rng.randint(1, 999)}-{rng.randint(1000, 9999)}",
             lambda: rng.choice(words), lambda: prose(3), lambda: rng.choice(words) + "_" + rng.choice(words),
             lambda: f"www.{rng.choice(words)}.com/{rng.choice(words)}/{rng.randint(1, 99)}", lambda: f"{rng.choice(words)}{rng.randint(1, 99)}@{rng.choice(words)}.org",
             lambda: f"{rng.choice(words)}/{rng.choice(words)}.txt", lambda: f"{rng.randint(1, 999)},{rng.randint(0, 999):03d}.{rng.randint(0, 99):02d}",
             lambda: f"{rng.choice(words)}{rng.randint(1, 999)}", lambda: f"+{rng.randint(1, 99)} {rng.randint(100, 999)} {rng.randint(100_000, 9_999_999)}"]
    for i in range(VARIED):
        before, after, value = prose(rng.randint(0, 5)), prose(rng.randint(0, 5)), rng.choice(plain)()
        name = rng.choice(words)
        line = rng.choice([f"{before} {name}: {value} {after}", f"{before} {name} = \"{value}\" {after}", f"{before} {value} {after}",
                           f"{before} the {rng.choice(names)} of {value} {after}", f"{before} {rng.choice(names).replace('_', ' ')} {rng.choice(words)} {after}",
                           f"{before} {name}={value} {after}", f"{before} {rng.choice(names)}: {rng.choice(words)[:5]} {after}"])
        yield line, []


def fit(texts: list[str]) -> Field:
    """Maximum likelihood on the windows of the texts and of the lines made from
    them; zero if none has a secret."""
    rows, plain = [], 0

    def add(tokens, tags, a, b, extra):
        begins = [bool(_CAN_BEGIN.fullmatch(t)) for t in tokens[a:b]]
        rows.append(([features(tokens, i) + extra for i in range(a, b)], tags[a:b], begins))
    for text in texts:
        extra = file_features(text)
        for tokens, tags, a, b in _tagged(text):
            secret = any(t != OUTSIDE for t in tags[a:b])
            odd = any(_ODD_TOKEN.fullmatch(t) or t in (":", "=") for t in tokens[a:b])
            plain += not secret and not odd
            if secret or odd or plain <= 1000:
                add(tokens, tags, a, b, extra)
    for line, values in varied(texts):
        tokens, tags = _tag_line(line, values)
        for a, b in _windows(tokens, tags):
            add(tokens, tags, a, b, [])
    weights, moves = np.zeros((WEIGHTS, 3)), np.zeros((3, 3))
    moves[OUTSIDE, INSIDE] = NEVER
    if not any(t != OUTSIDE for _, tags, _ in rows for t in tags):
        return Field(weights, moves)
    n, width = len(rows), max(len(f) for r, _, _ in rows for f in r)
    ids = np.zeros((n, SPAN, width), np.int64)  # bucket 0 pads and keeps weight 0
    bar = np.zeros((n, SPAN, 3))
    tags, real = np.full((n, SPAN), OUTSIDE), np.zeros((n, SPAN), bool)
    for k, (fs, ts, begins) in enumerate(rows):
        bar[k, :len(ts), BEGIN] = np.where(begins, 0.0, NEVER)
        for i, f in enumerate(fs):
            ids[k, i, :len(f)] = f
        tags[k, :len(ts)], real[k, :len(ts)] = ts, True
    square, square_moves = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    gold = np.eye(3)[tags] * real[:, :, None]
    before = np.concatenate([np.full((n, 1), OUTSIDE), tags[:, :-1]], axis=1)
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (before[real], tags[real]), 1)
    for _ in range(STEPS):
        grad, grad_moves = _expected(weights[ids].sum(axis=2) + bar, moves, real)
        delta = (gold - grad)
        g = np.zeros_like(weights)
        for tag in range(3):
            g[:, tag] = np.bincount(ids.ravel(), np.repeat(delta[:, :, tag].ravel(), width), minlength=WEIGHTS)
        g, gm = g / n - DECAY * weights, (gold_moves - grad_moves) / n - DECAY * np.maximum(moves, -100)
        g[0] = 0
        square += g * g
        square_moves += gm * gm
        weights += RATE * g / np.sqrt(square)
        moves += RATE * gm / np.sqrt(square_moves)
        moves[OUTSIDE, INSIDE] = NEVER
    return Field(weights, moves)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _expected(emit: np.ndarray, moves: np.ndarray, real: np.ndarray):
    """Expected tags and transitions under the field, by forward and backward sums."""
    n, length, _ = emit.shape
    start = np.where(np.arange(3) == OUTSIDE, 0.0, NEVER)
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    last = np.broadcast_to(start, (n, 3))
    for i in range(length):
        step = _logsum(last[:, :, None] + moves, 1) + emit[:, i]
        last = np.where(real[:, i, None], step, last)
        forward[:, i] = last
    total = _logsum(last, 1)
    for i in range(length - 2, -1, -1):
        step = _logsum(moves[None] + (emit[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
        backward[:, i] = np.where(real[:, i + 1, None], step, 0.0)
    tags = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
    pairs = np.zeros((3, 3))
    for i in range(length):
        came = forward[:, i - 1] if i else np.broadcast_to(start, (n, 3))
        p = came[:, :, None] + moves + (emit[:, i] + backward[:, i])[:, None, :] - total[:, None, None]
        pairs += (np.exp(p) * real[:, i, None, None]).sum(axis=0)
    return tags, pairs


def train(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Fits the field to about ``sample`` documents, chosen by a hash of the id."""
    n = docs.count()
    key = F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(1 << 30))
    picked = (docs.where(F.col("text").isNotNull() & (key < int(min(1.0, sample / max(n, 1)) * (1 << 30))))
              .select(key.alias("key"), _sampled(F.col("text")).alias("text")).orderBy("key", "text").limit(2 * sample).collect())
    return fit([r["text"] for r in picked])


def _sampled(text):
    """What the driver sees of a sampled text: the lines with a digit, ``:`` or
    ``=``, and the first of the others, ``SEEN`` characters at most."""
    lines = F.split(text, "\n")
    odd = F.filter(lines, lambda x: x.rlike("[0-9:=]"))
    return F.substring(F.array_join(F.concat(odd, F.slice(F.filter(lines, lambda x: ~x.rlike("[0-9:=]")), 1, 3)), "\n"), 1, SEEN)


def scan_text(field: Field, text: str):
    """Base spans, and all spans, sorted."""
    base = base_spans(text)
    added, k = [], 0
    for a, b in field.spans(text):
        while k < len(base) and base[k][3] <= a:
            k += 1
        if not any(s < b and a < e for s, _, _, e in base[max(0, k - len(PATTERNS)):k + len(PATTERNS)]):
            added.append((a, len(PATTERNS), "crf", b))
    return base, sorted(base + added)


def _scan(shared):
    def scan(batches):
        field = Field(*map(np.array, shared.value))
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base, every = scan_text(field, text)
                n = [sum(s[2] == kind for s in base) for kind, *_ in PATTERNS]
                out.append((*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(every), len(every) - len(base)))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"])
    return scan


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((field.weights, field.moves))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan(shared), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                          "spans string, n_crf long")
