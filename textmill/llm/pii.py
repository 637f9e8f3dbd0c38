"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns find plain e-mail addresses, IP addresses, card and phone numbers. The network, trained in
numpy from labelled spans, adds what is written otherwise (``name (at) host.org``, ``(555) 010-0199``); a
span it adds is grown to whole words, must be an address or number of its kind once normalised (of at most
``LONGEST`` characters), and must not touch a pattern's span. It is trained on ``STEPS`` batches of windows: spans of known place and kind put into passages of at
most ``SAMPLE`` documents, and those passages as they are, with the patterns' spans.

A text is laid out in cells of ``CELL`` characters. Every kind holds a decimal digit or a sign or word for
"at", so the network reads the cells with one of these and their neighbours, and no others. Each
cell is read with ``CONTEXT`` characters on both sides; where windows overlap, their scores are
averaged by nearness to the window's middle, and one Viterbi path runs over all adjoining cells of a text.

Null and empty texts have no spans. Repeated documents are read each on its own. Of very long texts
``BATCH`` cells are scored at a time; only back pointers stay, and those only until all best paths agree. An empty table gives an empty result. Other columns are kept; a column named ``_pii`` is replaced.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm import sampling, words

KINDS = ("email", "ip", "card", "phone")
CELL, CONTEXT = 64, 32
SPAN = CELL + 2 * CONTEXT
BATCH = 384
HIDDEN, EMBED = 28, 12
SAMPLE, PASSAGE = 400, 600
STEPS, ROWS, RATE, LEARNED = 700, 64, 0.015, 80
CHUNK = 4 << 20
LEAN = 3.0  # added to the score of a span's first character: what is no address or number is sorted out afterwards
LONGEST = 320  # 64 characters, a sign and 255 characters: no address is longer

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_GATE = re.compile(r"[\d@＠]|[(\[{]\s?at\s?[)\]}]|\bat\s+[a-z0-9-]+\s+dot\b", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of what the patterns find, by start, then kind as listed."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end, "email"))
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


_AT = r"(?:\s*(?:[(\[{]\s?at\s?[)\]}]|[@＠])\s*|\s+at\s+)"
_DOT = r"(?:\.|\s*[(\[{]\s?(?:dot|\.)\s?[)\]}]\s*|\s+dot\s+)"
_MAIL = re.compile(f"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.IGNORECASE)
_QUAD = re.compile(f"(?<![0-9])[0-9]{{1,3}}(?:(?:{_DOT}|\\s\\.\\s)[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
_NUMBER = re.compile(r"[+(]?[0-9][0-9 ().\-/]*[0-9]")
_CUT = re.compile(f"[A-Za-z0-9._%+-]+(?:{_AT}|\\s+)$", re.IGNORECASE)  # a name before a span that begins at or after its sign
_DIGITS = frozenset("0123456789")


def grown(kind: str, text: str, s: int, e: int) -> tuple[int, int]:
    """The span with the rest of the words or numbers that it cuts, ``LONGEST`` characters to a side at most."""
    left, right = (_LOCAL, _LOCAL) if kind == "email" else (_DIGITS, _DIGITS)
    least, most = max(0, s - LONGEST), min(len(text), e + LONGEST)
    while s > least and text[s] in left and text[s - 1] in left:
        s -= 1
    if kind == "email" and not _MAIL.search(text, s, e) and (cut := _CUT.search(text, least, s)):
        s = cut.start()
    if kind == "phone":
        while s > least and text[s - 1] in "+(":
            s -= 1
    while e < most and text[e - 1] in right and text[e] in right:
        e += 1
    return s, e


def fitted(kind: str, text: str) -> tuple[int, int] | None:
    """The part of a span that is of its kind once its disguise is off, if there is one."""
    if len(text) > LONGEST:
        return None
    found = {"email": _MAIL, "ip": _QUAD}.get(kind, _NUMBER).search(text)
    if found is None:
        return None
    digits = _digits(found[0])
    if kind == "ip" and any(int(p) > 255 for p in re.findall("[0-9]+", found[0])):
        return None
    if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
        return None
    if kind == "phone" and not 10 <= len(digits) <= 15:
        return None
    return found.span()


# characters as the network reads them
_SIGNS = "@.-+() _%/:,[]{}"
CLASSES = 30 + len(_SIGNS) + 3


def _alphabet() -> np.ndarray:
    table = np.full(0x10000, 29 + len(_SIGNS) + 3, np.uint8)  # anything else
    for c in range(0x80, 0x10000):
        if chr(c).isalpha():
            table[c] = 27
        elif chr(c).isdecimal():
            table[c] = 28
    for k in range(26):
        table[ord("a") + k] = table[ord("A") + k] = 1 + k
    table[0x30:0x3A] = 28
    for k, c in enumerate(_SIGNS):
        table[ord(c)] = 29 + k
    table[0x09:0x0E] = 29 + len(_SIGNS)
    table[[ord(c) for c in "\"'!?;"]] = 29 + len(_SIGNS) + 1
    table[[ord(c) for c in "#*$&|<>=^~`\\"]] = 29 + len(_SIGNS) + 2
    table[0xFF20] = 29
    return table


ALPHABET = _alphabet()
TAGS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind


def encoded(text: str) -> np.ndarray:
    """Class of each character; 0 stands for what lies outside the text."""
    out = np.empty(len(text), np.uint8)
    for a in range(0, len(text), CHUNK):
        points = np.frombuffer(text[a : a + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        out[a : a + CHUNK] = ALPHABET[np.minimum(points, 0xFFFF)]
    return out


def _allowed() -> np.ndarray:
    """0 where one tag may follow another, else a large negative number."""
    rule = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        rule[:, 2 + 2 * k] = -1e4
        rule[1 + 2 * k, 2 + 2 * k] = rule[2 + 2 * k, 2 + 2 * k] = 0
    return rule


RULE = _allowed()
START = np.array([0.0] + [0.0, -1e4] * len(KINDS))


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


class Tagger:
    """Embedding, one LSTM in each direction, a linear layer and CRF transitions."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        make = lambda *s: draw.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.p = {"embed": make(CLASSES, EMBED), "out": make(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": make(EMBED, 4 * HIDDEN), f"h{d}": make(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1.0

    def _direction(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states of one direction over ``(time, rows)``; with ``keep`` also what learning needs."""
        steps, rows = x.shape
        table = self.p["embed"] @ self.p[f"x{d}"] + self.p[f"c{d}"]
        h, c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
        states, kept = np.empty((steps, rows, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gate = table[x[t]] + h @ self.p[f"h{d}"]
            gate[:, : 3 * HIDDEN] *= 0.5
            gate = np.tanh(gate, out=gate)
            gate[:, : 3 * HIDDEN] = 0.5 * gate[:, : 3 * HIDDEN] + 0.5
            i, f, o, g = np.split(gate, 4, axis=1)
            before, last = c, h
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            if keep:
                kept.append((t, i, f, o, g, before, squashed, last))
        return states, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Scores ``(rows, time, tag)`` of class windows ``(rows, time)``."""
        x = np.ascontiguousarray(x.T)
        both = np.concatenate([self._direction(x, d, False)[0] for d in "fb"], axis=2)
        return np.swapaxes(both @ self.p["out"] + self.p["bias"], 0, 1)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tag paths ``(rows, time)`` and its gradients."""
        x, y = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
        steps, rows = x.shape
        parts = {d: self._direction(x, d, True) for d in "fb"}
        both = np.concatenate([parts["f"][0], parts["b"][0]], axis=2)
        score = (both @ self.p["out"] + self.p["bias"]).astype(np.float64)
        move = self.p["move"] + RULE
        leap = np.exp(move)
        ahead, back = np.empty_like(score), np.zeros_like(score)
        ahead[0] = score[0] + START
        for t in range(1, steps):
            top = ahead[t - 1].max(1, keepdims=True)
            ahead[t] = score[t] + np.log(np.exp(ahead[t - 1] - top) @ leap + 1e-300) + top
        for t in range(steps - 2, -1, -1):
            after = score[t + 1] + back[t + 1]
            top = after.max(1, keepdims=True)
            back[t] = np.log(np.exp(after - top) @ leap.T + 1e-300) + top
        total = _sum_exp(ahead[-1], 1)
        row = np.arange(rows)
        path = START[y[0]] + score[0][row, y[0]]
        path = path + (score[np.arange(1, steps)[:, None], row, y[1:]] + move[y[:-1], y[1:]]).sum(0)
        d_score = np.exp(ahead + back - total[:, None])
        d_score[np.arange(steps)[:, None], row, y] -= 1
        d_move = np.zeros((TAGS, TAGS))
        joint = ahead[:-1, :, :, None] + move + (score[1:] + back[1:])[:, :, None, :] - total[:, None, None]
        d_move += np.exp(joint).sum((0, 1))
        np.subtract.at(d_move, (y[:-1], y[1:]), 1)
        grads = {"move": d_move / rows}
        d_score = (d_score / rows).astype(np.float32)
        grads["out"] = both.reshape(-1, 2 * HIDDEN).T @ d_score.reshape(-1, TAGS)
        grads["bias"] = d_score.sum((0, 1))
        d_both = d_score @ self.p["out"].T
        grads["embed"] = np.zeros_like(self.p["embed"])
        for n, d in enumerate("fb"):
            outer = d_both[:, :, n * HIDDEN : (n + 1) * HIDDEN]
            d_h, d_c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
            back_gates, lasts = np.empty((steps, rows, 4 * HIDDEN), np.float32), np.empty((steps, rows, HIDDEN), np.float32)
            weight = np.ascontiguousarray(self.p[f"h{d}"].T)
            for t, i, f, o, g, before, squashed, last in reversed(parts[d][1]):
                d_h = d_h + outer[t]
                d_c = d_c + d_h * o * (1 - squashed**2)
                d_gate = back_gates[t]
                d_gate[:, :HIDDEN] = d_c * g * i * (1 - i)
                d_gate[:, HIDDEN : 2 * HIDDEN] = d_c * before * f * (1 - f)
                d_gate[:, 2 * HIDDEN : 3 * HIDDEN] = d_h * squashed * o * (1 - o)
                d_gate[:, 3 * HIDDEN :] = d_c * i * (1 - g**2)
                lasts[t] = last
                d_h, d_c = d_gate @ weight, d_c * f
            flat = back_gates.reshape(-1, 4 * HIDDEN)
            d_weight, d_table = lasts.reshape(-1, HIDDEN).T @ flat, (x.reshape(-1, 1) == np.arange(CLASSES)).astype(np.float32).T @ flat
            grads[f"h{d}"] = d_weight
            grads[f"c{d}"] = d_table.sum(0)
            grads[f"x{d}"] = self.p["embed"].T @ d_table
            grads["embed"] += d_table @ self.p[f"x{d}"].T
        return float((total - path).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 6) -> Tagger:
        """Adam over random batches of labelled windows."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v, dtype=np.float64) for k, v in self.p.items()}
        second = {k: np.zeros_like(v, dtype=np.float64) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            at = draw.integers(0, len(x), ROWS)
            _, grads = self.gradients(x[at], y[at])
            size = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grads.values()))
            rate = RATE * (1 - 0.9 * step / steps) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / max(size, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
        return self

    def decode(self, score: np.ndarray) -> np.ndarray:
        """Best tag path of each row ``(rows, time, tag)``."""
        move = (self.p["move"] + RULE).astype(np.float32)
        rows, steps, _ = score.shape
        best, came = score[:, 0] + START.astype(np.float32), np.empty((steps, rows, TAGS), np.int8)
        for t in range(1, steps):
            options = best[:, :, None] + move
            came[t] = options.argmax(1)
            best = options.max(1) + score[:, t]
        path = np.empty((rows, steps), np.int8)
        path[:, -1] = best.argmax(1)
        row = np.arange(rows)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = came[t, row, path[:, t]]
        return path


class Walk:
    """The best tag path of a text that comes block by block, ``(cells, time, tag)`` scores each.

    The cells of a block are walked side by side: first the best score from each tag before a cell to each tag at
    its end, then, with the scores before every cell known, back pointers. Once all paths through a block begin
    at one tag, everything before it is settled and its pointers go.
    """

    def __init__(self, tagger: Tagger):
        self.move = (tagger.p["move"] + RULE).astype(np.float32)
        self.before: np.ndarray | None = None
        self.open: list[tuple[np.ndarray, np.ndarray]] = []
        self.path: list[np.ndarray] = []

    def add(self, score: np.ndarray) -> None:
        cells, steps, _ = score.shape
        into = np.repeat(self.move[None], cells, 0)
        if self.before is None:
            self.before, into[0] = np.zeros(TAGS, np.float32), START.astype(np.float32)
        best = into + score[:, 0][:, None, :]
        for t in range(1, steps):
            best = (best[:, :, :, None] + self.move).max(2) + score[:, t][:, None, :]
        entry = np.empty((cells, TAGS), np.float32)
        for r in range(cells):
            entry[r] = self.before
            self.before = (self.before[:, None] + best[r]).max(0)
            self.before -= self.before.max()
        came = np.empty((steps, cells, TAGS), np.int8)
        at = entry
        for t in range(steps):
            options = at[:, :, None] + (into if t == 0 else self.move)
            came[t] = options.argmax(1)
            at = options.max(1) + score[:, t]
        tag, row = np.tile(np.arange(TAGS), (cells, 1)), np.arange(cells)[:, None]
        for t in range(steps - 1, -1, -1):
            tag = came[t][row, tag]
        first = np.arange(TAGS)
        for r in range(cells - 1, -1, -1):
            first = tag[r][first]
        if self.open and (first == first[0]).all():
            self._settle(int(first[0]))
        self.open.append((came, tag))

    def _settle(self, last: int) -> None:
        done = []
        for came, prior in reversed(self.open):
            steps, cells, _ = came.shape
            path, row = np.empty((cells, steps), np.int8), np.arange(cells)
            for r in range(cells - 1, -1, -1):
                path[r, -1], last = last, int(prior[r, last])
            for t in range(steps - 1, 0, -1):
                path[:, t - 1] = came[t, row, path[:, t]]
            done.append(path.ravel())
        self.path += reversed(done)
        self.open = []

    def end(self) -> np.ndarray:
        self._settle(int(self.before.argmax()))
        return np.concatenate(self.path)


def _spans_of(path: np.ndarray) -> list[tuple[int, int, str]]:
    out = []
    for a in np.flatnonzero((path > 0) & (path % 2 == 1)).tolist():
        b = a + 1
        while b < len(path) and path[b] == path[a] + 1:
            b += 1
        out.append((a, b, KINDS[(int(path[a]) - 1) // 2]))
    return out


_MIDDLE = np.minimum(np.arange(1, SPAN + 1), np.arange(SPAN, 0, -1)).astype(np.float32)


def tagged(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, str]]]:
    """Spans that the network finds in each text."""
    regions: list[tuple[int, int, int, np.ndarray]] = []  # text, first cell, cells, classes
    for k, text in enumerate(texts):
        near, m = set(), _GATE.search(text)
        while m:
            near.add(m.start() // CELL)
            m = _GATE.search(text, (m.start() // CELL + 1) * CELL)
        if not near:
            continue
        last = (len(text) - 1) // CELL
        cells = sorted({c for n in near for c in (n - 1, n, n + 1) if 0 <= c <= last})
        padded = np.zeros((last + 1) * CELL + 2 * CONTEXT, np.uint8)
        padded[CONTEXT : CONTEXT + len(text)] = encoded(text)
        begin = 0
        for e in range(1, len(cells) + 1):
            if e == len(cells) or cells[e] != cells[e - 1] + 1:
                regions.append((k, cells[begin], e - begin, padded))
                begin = e
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    regions.sort(key=lambda r: r[2])
    at = 0
    while at < len(regions):
        end, cells = at, 0
        while end < len(regions) and (end == at or (end - at + 1) * regions[end][2] <= BATCH):
            end += 1
        cells = regions[end - 1][2]
        (_decode_long if cells > BATCH else _decode_regions)(regions[at:end], cells, tagger, texts, out)
        at = end
    return out


def _decode_regions(group: list, cells: int, tagger: Tagger, texts: list[str], out: list) -> None:
    """Score the windows of regions of at most ``cells`` cells, average overlaps, find one path each."""
    length = cells * CELL + 2 * CONTEXT
    total = np.zeros((len(group), length, TAGS), np.float32)
    weight = np.full((len(group), length, 1), 1e-6, np.float32)
    places = [(g, c) for g, r in enumerate(group) for c in range(r[2])]
    for a in range(0, len(places), BATCH):
        part = places[a : a + BATCH]
        x = np.stack([group[g][3][(group[g][1] + c) * CELL : (group[g][1] + c) * CELL + SPAN] for g, c in part])
        scores = tagger.emissions(x)
        for (g, c), s in zip(part, scores):
            total[g, c * CELL : c * CELL + SPAN] += s * _MIDDLE[:, None]
            weight[g, c * CELL : c * CELL + SPAN] += _MIDDLE[:, None]
    total /= weight
    for g, r in enumerate(group):
        total[g, r[2] * CELL + 2 * CONTEXT :, 1:] = -1e4  # beyond a shorter region
    for r, path in zip(group, tagger.decode(total)):
        _place(r, path, texts, out)


def _decode_long(group: list, cells: int, tagger: Tagger, texts: list[str], out: list) -> None:
    """The same for one region of any length: scores of a block of cells, and the overlap with the next."""
    (region,) = group
    walk, edge = Walk(tagger), 2 * CONTEXT
    total, weight = np.zeros((edge, TAGS), np.float32), np.full((edge, 1), 1e-6, np.float32)
    for a in range(0, cells, BATCH):
        n = min(BATCH, cells - a)
        begins = [(region[1] + a + c) * CELL for c in range(n)]
        total = np.concatenate([total, np.zeros((n * CELL, TAGS), np.float32)])
        weight = np.concatenate([weight, np.full((n * CELL, 1), 1e-6, np.float32)])
        for c, s in enumerate(tagger.emissions(np.stack([region[3][b : b + SPAN] for b in begins]))):
            total[c * CELL : c * CELL + SPAN] += s * _MIDDLE[:, None]
            weight[c * CELL : c * CELL + SPAN] += _MIDDLE[:, None]
        ready = n * CELL + (edge if a + n == cells else 0)
        walk.add((total[:ready] / weight[:ready]).reshape(-1, CELL, TAGS))
        total, weight = total[ready:], weight[ready:]
    _place(region, walk.end(), texts, out)


def _place(region: tuple, path: np.ndarray, texts: list[str], out: list) -> None:
    first = region[1] * CELL - CONTEXT
    for s, e, kind in _spans_of(path):
        s, e = max(0, s + first), min(len(texts[region[0]]), e + first)
        if s < e:
            out[region[0]].append((s, e, kind))


def all_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, str, bool]]]:
    """``(start, end, kind, base)`` of each text: the patterns' spans and what the network adds."""
    out = []
    for text, found in zip(texts, tagged(texts, tagger)):
        base = base_spans(text)
        spans = [(*s, True) for s in base]
        begins, ends = [s for s, *_ in base], list(itertools.accumulate((e for _, e, _ in base), max))
        last = 0
        for s, e, kind in sorted(set(found)):
            if e - s > LONGEST:
                continue
            s, e = grown(kind, text, s, e)
            place = fitted(kind, text[s:e])
            if place is None:
                continue
            s, e = s + place[0], s + place[1]
            earlier = bisect.bisect_left(begins, e)  # base spans that begin before the end
            if s >= last and (earlier == 0 or ends[earlier - 1] <= s):
                spans.append((s, e, kind, False))
                last = e
        out.append(sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))
    return out


# labelled spans


def _number(draw: random.Random, n: int) -> str:
    return "".join(draw.choice("0123456789") for _ in range(n))


def _word(draw: random.Random, known: list[str], least: int = 3, most: int = 9) -> str:
    """A word of the passages, or letters: names and hosts may look like either."""
    if known and draw.random() < 0.6:
        return draw.choice(known)
    return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(least, most)))


def _card_number(draw: random.Random) -> str:
    head = _number(draw, draw.choice((13, 14, 15, 15, 15)))
    return next(head + c for c in "0123456789" if luhn(head + c))


def _example(draw: random.Random, kind: str, known: list[str]) -> str:
    """A span of a kind, plainly or otherwise written."""
    if kind == "email":
        at = draw.choice(("@", "@", "@", " (at) ", " (at) ", "(at)", "[at]", " [at] ", " @ ", "＠", " {at} ", " at ", " at "))
        dot = draw.choice((".", ".", ".", " (dot) ", " (dot) ", "[dot]", " [dot] ", "(.)", " dot ")) if at != "@" else "."
        dot = " dot " if at == " at " else dot
        local = draw.choice(("", _word(draw, known, 1, 6) + draw.choice("._-+"))) + _word(draw, known) + draw.choice(("", _number(draw, draw.randint(1, 4))))
        host = dot.join([_word(draw, known, 2, 9) + draw.choice(("", _number(draw, 2))), *[_word(draw, known, 2, 6)] * draw.randint(0, 1), draw.choice(("com", "org", "net", "de", "fr", "io", "example", "edu"))])
        return local + at + host
    if kind == "ip":
        dot = draw.choice((".", ".", ".", "[.]", "(.)", " . ", "[dot]"))
        return dot.join(str(draw.randint(0, 255)) for _ in range(4))
    if kind == "card":
        digits, gap = _card_number(draw), draw.choice(("", " ", "-", ".", "  ", "/"))
        return gap.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    a, b, c = _number(draw, 3), _number(draw, 3), _number(draw, 4)
    gap = draw.choice(("-", " ", ".", "/"))
    country = draw.choice(("+", "00")) + draw.choice("123456789") + draw.choice(("", _number(draw, 1)))
    return draw.choice((f"({a}) {b}{gap}{c}", f"{a}{gap}{b}{gap}{c}", f"{country} ({a}) {b}-{c}", f"{country}{gap}{a}{gap}{b}{gap}{c}", f"{country}{a}{b}{c}"))


def _other(draw: random.Random, known: list[str]) -> str:
    """What looks like a span and is none."""
    n = lambda k: _number(draw, k)
    hexed = "".join(draw.choice("0123456789abcdef") for _ in range(draw.randint(8, 32)))
    year, day, hour = f"{draw.choice((18, 19, 20))}{n(2)}", f"{draw.randint(1, 12):02}-{draw.randint(1, 31):02}", f"{draw.randint(0, 23):02}"
    minute = f"{hour}:{draw.randint(0, 59):02}"
    date = draw.choice((f"{year}-{day}", f"{year}/{day[:2]}/{day[3:]}", f"{day[3:]}.{day[:2]}.{year}"))
    word = _word(draw, known)
    return draw.choice(
        (
            *(n(1) + ".", n(draw.randint(1, 8)), f"{n(2)}:{n(2)}", f"v{n(1)}.{n(1)}.{n(2)}", f"{n(3)},{n(3)}.{n(2)}", f"{n(1)}.{n(2)}%"),
            *(hexed, f"key={hexed}", hexed.upper(), "@" + word, f"{n(3)}-{n(1)}-{n(2)}-{n(5)}-{n(1)}", f"({year})", f"{year}-{year}"),
            *(date, f"{date} {hour}", f"{date} {minute}", f"{date}T{minute}:{n(2)}", f"{date} {minute}:{n(2)}", f"{minute} {date}"),
            *(f"at {word}", f"{word} at {word}. {_word(draw, known)}", f"at a dot {word}", f"at {minute}", f"at {n(2)}.{n(2)}"),
        )
    )


def labelled_windows(passages: list[str], count: int = 6_000, seed: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Class windows and tag paths: spans put into passages, look-alikes, and passages as they are."""
    draw = random.Random(seed)
    passages = [p for p in passages if p] or ["and the other one said so, not without reason. "]
    known = sorted(set(re.findall(r"\b[A-Za-z][a-z]{2,8}\b", " ".join(passages), re.ASCII)))
    x, y = np.zeros((count, LEARNED), np.uint8), np.zeros((count, LEARNED), np.int64)
    for row in range(count):
        passage = draw.choice(passages)
        begin = draw.randrange(max(1, len(passage) - 30))
        text, spans = passage[begin : begin + draw.randint(0, LEARNED)], []
        for _ in range(draw.choice((0, 1, 1, 1, 2))):
            kind = draw.choice((*KINDS, *KINDS, "email", "phone", "", "", ""))  # these two have the most spellings
            made = _example(draw, kind, known) if kind else _other(draw, known)
            gap = draw.choice((0, *[draw.randint(0, len(text))] * 7))
            before = text[:gap].rstrip()
            text = before + (draw.choice((" ", "\n", " (", ": ", ", ")) if before else "") + made + draw.choice((" ", ". ", ", ", ")", "\n"))
            if kind:
                place = text.rindex(made)
                spans = [s for s in spans if s[1] <= place] + [(place, place + len(made), kind)]
            text += passage[begin + gap : begin + gap + draw.choice((0, draw.randint(1, 60), 60, 60))]
        shift = draw.randint(0, max(0, len(text) - LEARNED))
        spans += [s for s in base_spans(text) if all(s[1] <= a or b <= s[0] for a, b, _ in spans)]
        shift = min([shift, *(s for s, e, _ in spans if s < shift < e)])  # no window begins inside a span
        if draw.random() < 0.3:
            shift = -draw.randint(0, CONTEXT)  # the text's own begin
        for s, e, kind in spans:
            s, e = s - shift, e - shift
            if 0 <= s < LEARNED:
                tag = 1 + 2 * KINDS.index(kind)
                y[row, s] = tag
                y[row, s + 1 : min(e, LEARNED)] = tag + 1
        part = encoded(text[max(0, shift) : shift + LEARNED])
        x[row, max(0, -shift) : max(0, -shift) + len(part)] = part
    return x, y


def train(docs: DataFrame, most: int = SAMPLE, steps: int = STEPS) -> Tagger:
    """A tagger trained on passages of at most ``most`` documents with labelled spans."""
    few = sampling.by_hash(docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL"), "doc_id", most)
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.greatest(F.length("text") - PASSAGE, F.lit(1))) + 1
    passages = few.select("doc_id", F.substring("text", place.cast("int"), F.lit(PASSAGE)).alias("passage"))
    rows = sampling.one_of_each(passages, "doc_id", "passage").collect()
    passages = [r.passage for r in sorted(rows, key=lambda r: (r.doc_id, r.passage))]
    tagger = Tagger().train(*labelled_windows(passages), steps=steps)
    tagger.p["bias"][1::2] += LEAN
    return tagger


_PII = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def without(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """The text with each span replaced by its kind in brackets; of spans that meet the first one names both."""
    out, at = [], 0
    for s, e, kind, _ in spans:
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, tagger: Tagger, mask: bool = False) -> DataFrame:
    """The documents with ``_pii``: all spans, by start, then kind as listed; ``mask`` puts marks into the texts."""
    docs = docs.drop("_pii")
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    fields = T.StructType.fromDDL(f"_pii {_PII}").fields
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            place = names.index("text")
            for a, b in words.slices(words.byte_sizes(batch.column(place)), CHUNK):
                part = batch.slice(a, b - a)
                texts = part.column(place).to_pylist()
                found = all_spans([t or "" for t in texts], shared.value)
                spans = [[{"kind": k, "start": s, "end": e, "base": x} for s, e, k, x in row] for row in found]
                arrays = [part.column(k) for k in range(part.num_columns)] + [pa.array(spans, made)]
                if mask:
                    arrays[place] = pa.array([None if t is None else without(t, row) for t, row in zip(texts, found)], arrays[place].type)
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "_pii"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def report(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Per document: pattern spans by kind and their digest, and all spans as text."""
    found = find(docs.select("doc_id", "text"), tagger or train(docs))
    base = F.filter("_pii", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("_pii")).alias("spans"))


def masked(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``n_chars`` follows the text."""
    out = find(docs, tagger or train(docs), mask=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select([c for c in docs.columns if c != "_pii"])


def digest(spans: list[tuple[int, int, str]]) -> str:
    """What ``base_sha256`` holds for spans in order."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
