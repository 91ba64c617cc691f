"""Personal data: base patterns, and a character BiLSTM with a CRF on top.

Base patterns find e-mail addresses, IP addresses, card and phone numbers.
The tagger learns from their spans: windows around the spans of a bounded
sample of documents, part of them rewritten to forms that the patterns don't
cover (phone numbers without a plus, grouped or bracketed) or put beside other
numbers, with which the patterns would match them as one. It is trained in
numpy and reads overlapping windows. Every span of the four kinds holds a
digit or an ``@``, so windows without either can't hold one and aren't
decoded. Where windows overlap, each character takes its tag from the window
in which it stands furthest from an edge; runs of a tag are spans of the whole
text. They are trimmed at base spans and divided at separators, and the parts
that fit their kind are added. So are the cards and phone numbers in matches
that the base patterns drop because other numbers stand beside them.

Defined results: a NULL text counts as empty, with no spans; equal texts get
equal spans; with nothing to learn from, only base spans are found.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import key_hash60, pa_schema, small_batches, text_of

# Kinds in the order of output, and their patterns. E-mail is
# matched from its @ outward (the local part is all that precedes it), and a
# number can only begin where a run of digits begins, so both stay linear.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_EVIDENCE = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind, by kind and start."""
    out: list[Span] = []
    if "@" in text:
        end = 0
        for m in _DOMAIN.finditer(text):
            before = text[max(end, m.start() - 4096):m.start()]
            if len(before) == 4096 and not before.rstrip(_LOCAL):  # longer than that
                before = text[end:m.start()]
            start = m.start() - (len(before) - len(before.rstrip(_LOCAL)))
            if start < m.start():
                out.append((0, start, m.end()))
                end = m.end()
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in m.groups()):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


# ---- the tagger

WINDOW, STRIDE = 96, 48
HIDDEN, EMBED = 16, 8
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
TRAIN_DOCUMENTS, TRAIN_WINDOWS = 1500, 2400
EPOCHS, SIZE, RATE = 8, 64, 0.02
SEED = 7
BATCH = 512
DECODE = 2048
# character classes: pad, lower, upper, digit, other letter, white, rest; then signs one by one
_SIGNS = "@.+-()[]{}<>:;,/\\=\"'_%#&*!?|~^$`"
CLASSES = 7 + len(_SIGNS)


def _class_table() -> np.ndarray:
    out = np.full(1 << 16, 6, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c in _SIGNS:
            out[i] = 7 + _SIGNS.index(c)
        elif "a" <= c <= "z":
            out[i] = 1
        elif "A" <= c <= "Z":
            out[i] = 2
        elif "0" <= c <= "9":
            out[i] = 3
        elif c.isalpha():
            out[i] = 4
        elif c.isspace():
            out[i] = 5
    return out


_classes: list[np.ndarray] = []


def classes_of(text: str) -> np.ndarray:
    if not _classes:
        _classes.append(_class_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _classes[0][np.minimum(points, 0xFFFF)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Embedding, one LSTM in each direction, linear emissions, transitions."""

    w: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = SEED) -> Tagger:
        r = np.random.default_rng(seed)
        w = {"embed": r.normal(0, 0.3, (CLASSES, EMBED)), "out": r.normal(0, 0.2, (2 * HIDDEN, TAGS)),
             "out_b": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for side in "lr":
            w[f"x{side}"] = r.normal(0, 0.3, (EMBED, 4 * HIDDEN))
            w[f"h{side}"] = r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            w[f"b{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # gates: in, forget, out, cell
        return cls(w)

    def _lstm(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """x: time x batch x embed. Hidden states, and what the way back needs."""
        w, h, c = self.w, np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        pre = x @ w[f"x{side}"] + w[f"b{side}"]
        out, kept = np.empty((len(x), x.shape[1], HIDDEN)), []
        for t in (range(len(x)) if side == "l" else range(len(x) - 1, -1, -1)):
            z = pre[t] + h @ w[f"h{side}"]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            kept.append((t, i, f, o, g, c, tc, h))
            h, c = o * tc, c_new
            out[t] = h
        return out, kept

    def emissions(self, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        """ids: batch x time. Scores: time x batch x tags."""
        x = self.w["embed"][ids.T]
        left, kl = self._lstm(x, "l")
        right, kr = self._lstm(x, "r")
        both = np.concatenate([left, right], 2)
        return both @ self.w["out"] + self.w["out_b"], (ids, x, both, kl, kr)

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean CRF loss of a batch, and its gradient."""
        w = self.w
        e, (ids, x, both, kl, kr) = self.emissions(ids)
        n_t, n = e.shape[:2]
        y = tags.T
        alpha = np.empty_like(e)
        alpha[0] = w["first"] + e[0]
        for t in range(1, n_t):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + w["step"][None], 1) + e[t]
        log_z = _lse(alpha[-1], 1)
        beta = np.zeros_like(e)
        for t in range(n_t - 2, -1, -1):
            beta[t] = _lse(w["step"][None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        d_e = np.exp(alpha + beta - log_z[:, None])
        d_step = np.zeros_like(w["step"])
        for t in range(1, n_t):
            d_step += np.exp(alpha[t - 1][:, :, None] + w["step"][None] + (e[t] + beta[t])[:, None, :]
                             - log_z[:, None, None]).sum(0)
        rows = np.arange(n)
        gold = w["first"][y[0]].sum()
        for t in range(n_t):
            gold += e[t, rows, y[t]].sum() + (w["step"][y[t - 1], y[t]].sum() if t else 0)
            d_e[t, rows, y[t]] -= 1
            if t:
                np.add.at(d_step, (y[t - 1], y[t]), -1)
        grad = {"step": d_step, "first": d_e[0].sum(0), "out_b": d_e.sum((0, 1)),
                "out": np.tensordot(both, d_e, ((0, 1), (0, 1)))}
        d_both = d_e @ w["out"].T
        d_x = np.zeros_like(x)
        for side, kept, part in (("l", kl, d_both[:, :, :HIDDEN]), ("r", kr, d_both[:, :, HIDDEN:])):
            d_h, d_c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            g_h = np.zeros_like(w[f"h{side}"])
            d_pre = np.empty((n_t, n, 4 * HIDDEN))
            for t, i, f, o, g, c, tc, h in reversed(kept):
                d_h = d_h + part[t]
                d_c = d_c + d_h * o * (1 - tc * tc)
                dz = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f),
                                     d_h * tc * o * (1 - o), d_c * i * (1 - g * g)], 1)
                d_pre[t] = dz
                g_h += h.T @ dz
                d_h, d_c = dz @ w[f"h{side}"].T, d_c * f
            grad[f"h{side}"] = g_h
            grad[f"b{side}"] = d_pre.sum((0, 1))
            grad[f"x{side}"] = np.tensordot(x, d_pre, ((0, 1), (0, 1)))
            d_x += d_pre @ w[f"x{side}"].T
        grad["embed"] = np.zeros_like(w["embed"])
        np.add.at(grad["embed"], ids.T, d_x)
        return float(log_z.sum() - gold) / n, {k: v / n for k, v in grad.items()}

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> list[float]:
        r, m, v, k, losses = np.random.default_rng(seed), {}, {}, 0, []
        for epoch in range(epochs):
            order, total = r.permutation(len(ids)), 0.0
            for at in range(0, len(ids), SIZE):
                pick = order[at:at + SIZE]
                loss, grad = self.loss(ids[pick], tags[pick])
                norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
                k += 1
                for name, g in grad.items():
                    g = g * min(1.0, 5 / (norm + 1e-9))
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                    v[name] = 0.99 * v.get(name, 0) + 0.01 * g * g
                    rate = RATE * (1 - epoch / epochs)
                    self.w[name] -= rate * (m[name] / (1 - 0.9 ** k)) / (np.sqrt(v[name] / (1 - 0.99 ** k)) + 1e-8)
                total += loss * len(pick)
            losses.append(total / len(ids))
        return losses

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best tags of each window: batch x time."""
        e, _ = self.emissions(ids)
        score, back = self.w["first"] + e[0], []
        for t in range(1, len(e)):
            all_ = score[:, :, None] + self.w["step"][None]
            best = all_.argmax(1)
            back.append(best)
            score = np.take_along_axis(all_, best[:, None, :], 1)[:, 0] + e[t]
        out = np.empty(ids.shape, np.int8)
        tag = score.argmax(1)
        out[:, -1] = tag
        rows = np.arange(len(ids))
        for t in range(len(e) - 2, -1, -1):
            tag = back[t][rows, tag]
            out[:, t] = tag
        return out


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    out: set[int] = set()
    for m in _EVIDENCE.finditer(text):
        k = m.start() // STRIDE
        out.update((min(k, last), min(max(k - 1, 0), last)))
    return [k * STRIDE for k in sorted(out)]


def padded(classes: np.ndarray, start: int) -> np.ndarray:
    part = classes[start:start + WINDOW]
    return part if len(part) == WINDOW else np.concatenate([part, np.zeros(WINDOW - len(part), np.uint8)])


def reconciled(length: int, windows: list[tuple[int, np.ndarray]]) -> list[Span]:
    """Spans of a whole text from the tags of its windows (in order): each
    character counts in the window in which it is furthest from an edge."""
    spans: list[Span] = []
    inside = np.arange(WINDOW)
    depth = np.minimum(inside, WINDOW - 1 - inside)
    groups: list[list[tuple[int, np.ndarray]]] = []
    for start, tags in windows:
        if groups and start <= groups[-1][-1][0] + WINDOW:
            groups[-1].append((start, tags))
        else:
            groups.append([(start, tags)])
    for group in groups:
        low, high = group[0][0], min(length, group[-1][0] + WINDOW)
        tag, best = np.zeros(high - low, np.int8), np.full(high - low, -1)
        for start, tags in group:
            n = min(WINDOW, length - start)
            at = slice(start - low, start - low + n)
            own = depth[:n].copy()
            if start == 0:  # nothing stands before the text, or after it
                own = np.maximum(own, (WINDOW - 1 - inside)[:n])
            if start + WINDOW >= length:
                own = np.maximum(own, inside[:n])
            better = own > best[at]
            tag[at] = np.where(better, tags[:n], tag[at])
            best[at] = np.where(better, own, best[at])
        kind = (tag + 1) // 2  # 0: outside
        begins = (tag % 2 == 1) & (tag > 0)
        change = np.flatnonzero((np.diff(kind, prepend=0) != 0) | begins)
        for i, at in enumerate(change):
            if kind[at]:
                to = change[i + 1] if i + 1 < len(change) else len(kind)
                spans.append((int(kind[at]) - 1, low + int(at), low + int(to)))
    return spans


def fits(kind: int, found: str) -> bool:
    """What an added span must hold at least."""
    digits = sum("0" <= c <= "9" for c in found)
    letters = sum(c.isalpha() for c in found)
    if kind == 0:
        at = found.find("@")
        return 0 < at and "." in found[at + 2:] and not any(map(str.isspace, found))
    if kind == 1:
        return found.count(".") == 3 and digits >= 4 and digits + 3 == len(found)
    if kind == 2:
        return 16 <= digits <= 19 and not letters and luhn("".join([c for c in found if "0" <= c <= "9"]))
    return 8 <= digits <= 15 and not letters and any(c in found for c in " ()-.") and found.count(".") < 3


_TOKEN = re.compile(r"[^\s,;:/|-]+")
MOST_CHARS = 48  # of an added number


def sure_kind(found: str) -> int | None:
    """The kind whose base pattern matches the whole of ``found``."""
    digits = "".join([c for c in found if "0" <= c <= "9"])
    if not digits:
        return None
    if 16 <= len(digits) <= 19 and _CARD.fullmatch(found) and luhn(digits):
        return 2
    if 8 <= len(digits) <= 15 and found[0] == "+" and _PHONE.fullmatch(found):
        return 3
    if found.count(".") == 3 and (m := _IP.fullmatch(found)) and all(int(g) <= 255 for g in m.groups()):
        return 1
    return None


def dropped_matches(text: str) -> list[tuple[int, int]]:
    """Matches of the card and phone patterns that are no base spans."""
    out = []
    if _DIGIT.search(text):
        for m in _CARD.finditer(text):
            if m.end() - m.start() > 16 and sure_kind(text[m.start():min(m.end(), m.start() + 38)]) != 2:
                out.append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if sum(map(str.isdigit, m.group())) > 15:
                    out.append(m.span())
    return out


def divided(text: str, kind: int, s: int, e: int) -> list[Span]:
    """The parts of a decoded span between separators that fit: most
    characters in parts that match a base pattern, then most in parts that fit
    ``kind``, then fewest parts. In a dropped match (kind -1), parts that match
    a base pattern, cards in one piece or four by four only."""
    tokens = [m.span() for m in _TOKEN.finditer(text, s, e)]
    digits = [sum("0" <= c <= "9" for c in text[lo:hi]) for lo, hi in tokens]
    best: list[tuple[int, int, int]] = [(0, 0, 0)]
    last: list[tuple[int, Span] | None] = [None]
    for j in range(1, len(tokens) + 1):
        best.append(best[j - 1])
        last.append(None)
        n = 0
        for i in range(j - 1, -1, -1):
            lo, hi = tokens[i][0], tokens[j - 1][1]
            n += digits[i]
            if hi - lo > MOST_CHARS or n > 19:
                break
            if n < 4 or kind < 0 and i < j - 1 and "+" not in text[lo:lo + 2] and digits[i:j] != [4] * 4:
                continue
            while hi > lo and text[hi - 1] == ".":
                hi -= 1
            a, b = lo, hi
            while b > a and not "0" <= text[b - 1] <= "9":
                b -= 1
            while a < b and not ("0" <= text[a] <= "9" or text[a] == "+"):
                a += 1
            sure = sure_kind(text[a:b])
            if kind < 0:
                if sure is None:
                    continue
            elif sure is None and not fits(kind, text[lo:hi]):
                continue
            part = (kind, lo, hi) if sure is None else (sure, a, b)
            size = part[2] - part[1]
            score = (best[i][0] + size * (sure is not None), best[i][1] + size, best[i][2] - 1)
            if score > best[j]:
                best[j], last[j] = score, (i, part)
    out, j = [], len(tokens)
    while j:
        if last[j] is None:
            j -= 1
        else:
            j, part = last[j]
            out.append(part)
    return out[::-1]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _free(s: int, e: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a span that no span of ``taken`` (merged) covers."""
    out = []
    for k in range(max(0, bisect_right(taken, (s, s)) - 1), len(taken)):
        if taken[k][0] >= e:
            break
        if s < taken[k][0]:
            out.append((s, taken[k][0]))
        s = max(s, taken[k][1])
    return [*out, (s, e)] if s < e else out


def added_spans(text: str, base: list[Span], model: list[Span]) -> list[Span]:
    """What fits in dropped matches and decoded spans, outside base spans."""
    out: list[Span] = []
    taken = _merged([(s, e) for _, s, e in base])
    for low, high in _merged(dropped_matches(text)):
        for s, e in _free(low, high, taken):
            out += divided(text, -1, s, e)
    taken = _merged(taken + [(s, e) for _, s, e in out])
    done = 0
    for kind, s, e in model:
        if kind:  # whole runs of digits, as far as a number can be long
            low, high = max(0, s - MOST_CHARS), min(len(text), e + MOST_CHARS)
            while s > low and "0" <= text[s] <= "9" and "0" <= text[s - 1] <= "9":
                s -= 1
            while e < high and "0" <= text[e - 1] <= "9" and "0" <= text[e] <= "9":
                e += 1
        for s, e in _free(max(s, done), e, taken):
            while s < e and text[s] in " \t\r\n,;:":
                s += 1
            while e > s and text[e - 1] in " \t\r\n,;:.":
                e -= 1
            new = divided(text, kind, s, e) if kind else [(kind, s, e)] if s < e and fits(kind, text[s:e]) else []
            out += new
            done = max(done, new[-1][2] if new else 0)
    return out


def tag_texts(tagger: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, each by kind and start."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, b) for b in base]
    todo: list[tuple[int, int]] = []
    windows: list[np.ndarray] = []
    found: dict[int, list[tuple[int, np.ndarray]]] = {}

    def flush() -> None:
        if windows:
            for (i, start), tags in zip(todo, tagger.decode(np.stack(windows))):
                found.setdefault(i, []).append((start, tags))
            todo.clear()
            windows.clear()

    for i, text in enumerate(texts):
        starts = window_starts(text)
        if starts:
            classes = classes_of(text)
            for start in starts:
                todo.append((i, start))
                windows.append(padded(classes, start))
                if len(windows) == DECODE:
                    flush()
    flush()
    out = []
    for i, (text, b) in enumerate(zip(texts, base)):
        more = added_spans(text, b, reconciled(len(text), found[i])) if i in found else []
        out.append((b, sorted(b + more) if more else b))
    return out


# ---- training

def _other_form(kind: int, form: str, r: np.random.Generator) -> str:
    if kind == 3 and r.random() < 0.6:
        digits = [c for c in form if c.isdigit()][-10:]
        a, b, c = "".join(digits[:3]), "".join(digits[3:6]), "".join(digits[6:])
        return (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}")[r.integers(4)]
    if kind == 2 and r.random() < 0.3:
        digits = [c for c in form if c.isdigit()]
        return " -"[r.integers(2)].join("".join(digits[i:i + 4]) for i in range(0, len(digits), 4))
    return form


def _neighbour(pool: list[tuple[int, str]], r: np.random.Generator) -> tuple[int, str]:
    """Kind (-1: none) and form of a number to stand beside a span: one of the
    document's own, or an address, a card or another number of any digits."""
    pick = r.integers(6)
    if pick == 0:
        return 1, ".".join(str(x) for x in r.integers(1, 256, 4))
    if pick == 1:
        return 2, "".join(str(x) for x in r.integers(0, 10, 16))
    if pick == 2:
        return -1, str(r.integers(1, 10 ** int(r.integers(1, 6))))
    kind, form = pool[r.integers(len(pool))]
    return kind, _other_form(kind, form, r)


def _rewritten(text: str, spans: list[Span], r: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with some spans in other forms or beside other numbers, and
    where all spans now are."""
    out, at, to, moved = [], 0, 0, []
    pool = [(kind, text[s:e]) for kind, s, e in spans]

    def put(kind: int, form: str) -> None:
        nonlocal to
        out.append(form)
        if kind >= 0:
            moved.append((kind, to, to + len(form)))
        to += len(form)

    for kind, s, e in sorted(spans, key=lambda x: x[1]):
        if s < at:
            continue
        put(-1, text[at:s])
        own = (kind, _other_form(kind, text[s:e], r))
        row = [own]
        if r.random() < 0.35:
            row.insert(int(r.integers(2)), _neighbour(pool, r))
        for i, part in enumerate(row):
            if i:
                put(-1, (" ", " ", " ", ", ", "-")[r.integers(5)])
            put(*part)
        at = e
    return "".join([*out, text[at:]]), moved


def training_windows(text: str, r: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """(classes, tags) of the windows of a labelled text."""
    spans = base_spans(text)
    out = []
    for form, own in ((text, spans), _rewritten(text, spans, r) if spans else ("", [])):
        tags = np.zeros(len(form), np.uint8)
        for kind, s, e in own:
            tags[s:e] = 2 * kind + 2
            tags[s] = 2 * kind + 1
        classes = classes_of(form) if form else np.zeros(0, np.uint8)
        for start in window_starts(form):
            start = max(0, start + int(r.integers(-STRIDE // 2, STRIDE // 2)))
            out.append((padded(classes, start), padded(tags, start)))
    return out


def train(docs: DataFrame, most: int = TRAIN_DOCUMENTS, windows: int = TRAIN_WINDOWS) -> Tagger | None:
    """Fit on windows of at most about ``most`` documents that hold a digit
    or an @, drawn by key hash."""
    spark = docs.sparkSession
    small_batches(spark, BATCH)
    rows = docs.where(F.col("text").cast("string").rlike("[0-9@]"))
    n = rows.count()
    if not n:
        return None
    sample = rows.where(key_hash60("doc_id") < F.lit(int(min(1, most / n) * (1 << 60))))
    each = max(8, 4 * windows // most)
    schema = "draw bigint, classes binary, tags binary"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for draw, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                r = np.random.default_rng(draw % (1 << 32))
                found = training_windows(text, r)
                pick = sorted(r.permutation(len(found))[:each])
                got += [(draw, found[i][0].tobytes(), found[i][1].tobytes()) for i in pick]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in got], f.type) for i, f in enumerate(out)], schema=out)

    got = (sample.select(key_hash60("doc_id").alias("draw"), F.col("text").cast("string").alias("text"))
           .mapInArrow(run, schema).orderBy("draw", "classes", "tags").limit(windows).toArrow())
    if not got.num_rows:
        return None
    ids = np.frombuffer(b"".join(got["classes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    tags = np.frombuffer(b"".join(got["tags"].to_pylist()), np.uint8).reshape(-1, WINDOW).astype(np.int64)
    tagger = Tagger.new()
    tagger.fit(ids, tags)
    return tagger


# ---- on documents

def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


FOUND = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
         "base_sha256 string, spans string")


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans."""
    small_batches(docs.sparkSession, BATCH)
    schema = pa_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = tag_texts(tagger, batch.column(1).to_pylist())
            n = [[sum(s[0] == k for s in base) for base, _ in got] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in n],
                 pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in got]),
                 pa.array([written(spans) for _, spans in got])], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(run, FOUND)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each run of spans replaced by the first one's kind."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[kind].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def masked_documents(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced by its kind, and
    ``n_chars`` (where there is one) following. NULL texts stay NULL."""
    small_batches(docs.sparkSession, BATCH)

    @F.pandas_udf("string")
    def clean(texts):
        import pandas as pd
        own = [t if isinstance(t, str) else "" for t in texts]
        got = tag_texts(tagger, own)
        return pd.Series([mask(t, spans) if spans else t for t, (_, spans) in zip(own, got)], dtype=object)

    text = docs["text"].cast("string")
    new = docs.withColumn("text", F.when(text.isNotNull(), clean(text)))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast("long"))
    return new.select(*docs.columns)
